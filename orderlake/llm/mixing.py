"""Mixing sources to target weights by nested hash thresholds.

Every row has a fixed hash. A source's rows below a threshold are taken once more
than its other rows, so a larger budget takes a superset of a smaller one. The
threshold is found from histograms: words are summed by source and hash bucket, the running sum finds
the bucket in which the budget ends, and only rows of that bucket are counted
again by the next bits of the hash. Rows are never sorted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlake.llm.names import boxed
from orderlake.operators.ranking import with_global_position
from orderlake.session import scratch_path

#: Bits of the row hash, and of a bucket number.
HASH_BITS, BUCKET_BITS = 60, 12


def word_count(text: str = "text") -> Column:
    """Runs of characters other than white space; null texts have none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]++")), F.lit(0)).cast("long")


def row_hash(key: str = "_key") -> Column:
    """60 bits that depend on the key alone."""
    return F.conv(F.substring(F.md5(F.col(key).cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("long")


def keyed_rows(docs: DataFrame) -> DataFrame:
    """Each row of ``docs`` as ``_row``, with ``source``, ``text`` and the ``_key`` that its hash depends on.

    The key is the doc_id. Rows without one have the digest of their text and their number among equal texts, so that they are
    taken one by one; the numbers come from positions in the order of digests, which no group of equal texts brings to one task.
    """
    named = boxed(docs.where(F.col("doc_id").isNotNull()), "source", "text", F.col("doc_id").cast("string").alias("_key"))
    digest = F.md5(F.coalesce("text", F.lit("")).cast("binary"))
    nameless = boxed(docs.where(F.col("doc_id").isNull()), "source", "text", digest.alias("_key"))
    placed = _stored(with_global_position(nameless, [F.col("_key")], "_at", "_all").drop("_all"), "mix-nameless")
    firsts = placed.groupBy("_key").agg(F.min("_at").alias("_first"))
    number = F.col("_at") - F.col("_first") + 1
    numbered = placed.join(firsts, "_key").select("_row", "source", "text", F.concat(F.lit("null"), "_key", F.lit(":"), number.cast("string")).alias("_key"))
    return named.unionByName(numbered)


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def source_targets(sized: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """source, source_size and target from rows (source, size).

    Weights repeat over the sources in code point order (null last). The targets sum to
    ``share`` of all sizes; none is above ``most`` times its source's size, and what is cut
    off goes to the other sources by weight.
    """
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    placed = with_global_position(totals, [F.col("source").asc_nulls_last()], "_place", "_sources")
    table = F.array(*[F.lit(float(w)) for w in weights])
    placed = _stored(
        placed.select("source", "source_size", F.element_at(table, (F.col("_place") % len(weights) + 1).cast("int")).alias("w")),
        "mix-sources",
    )
    # Raise the words per weight until no further source is cut; two sums a round come to the driver.
    rate = 0.0
    while True:
        cut = F.col("w") * rate > F.col("source_size") * most
        sums = placed.agg(
            F.sum("source_size").alias("all"),
            F.coalesce(F.sum(F.when(cut, F.col("source_size"))), F.lit(0)).alias("cut"),
            F.coalesce(F.sum(F.when(~cut, F.col("w"))), F.lit(0.0)).alias("w"),
        ).first()
        new = (share * float(sums["all"] or 0) - most * float(sums["cut"])) / sums["w"] if sums["w"] else rate
        if new <= rate:
            break
        rate = new
    return placed.select("source", "source_size", F.least(F.col("source_size") * most, F.col("w") * rate).alias("target"))


def thresholds(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """source, source_size, target, full and below: rows are taken ``full`` times, and once more if their hash is less than ``below``.

    ``sized`` has source, size and h. The row in which a budget ends is taken
    if that comes nearer to it.
    """
    full = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    state = targets.withColumn("full", full.cast("long")).withColumn("rest", F.col("target") - F.col("full") * F.col("source_size"))
    state = _stored(state.withColumn("prefix", F.lit(0).cast("long")).withColumn("below", F.when(F.col("rest") <= 0, F.lit(0).cast("long"))), "mix-budgets")
    for level in range(HASH_BITS // BUCKET_BITS):
        if state.where("below IS NULL").isEmpty():
            break
        shift = HASH_BITS - BUCKET_BITS * (level + 1)
        keys = state.where("below IS NULL").select(F.col("source").alias("s"), "prefix", "rest")
        here = sized.join(keys, F.col("source").eqNullSafe(F.col("s")) & (F.shiftright("h", shift + BUCKET_BITS) == F.col("prefix")))
        buckets = here.groupBy("s", "rest", F.shiftright("h", shift).alias("bucket")).agg(
            F.sum("size").alias("n"), F.min("h").alias("lo"), F.max("h").alias("hi")
        )
        # At most 4096 buckets a source.
        run = Window.partitionBy("s").orderBy("bucket")
        whole = Window.partitionBy("s")
        buckets = buckets.withColumn("upto", F.sum("n").over(run)).withColumn("last", F.max("bucket").over(whole))
        ends = (
            buckets.where("upto >= rest OR bucket = last")
            .withColumn("k", F.row_number().over(run))
            .where("k = 1")
            .withColumn("before", F.col("upto") - F.col("n"))
        )
        nearer = F.col("upto") - F.col("rest") < F.col("rest") - F.col("before")
        ends = ends.select(
            "s",
            F.col("bucket").alias("next"),
            (F.col("rest") - F.col("before")).alias("left"),
            F.when(F.col("upto") <= F.col("rest"), F.col("hi") + 1)
            .when(F.col("lo") == F.col("hi"), F.when(nearer, F.col("hi") + 1).otherwise(F.col("lo")))
            .alias("found"),
        )
        state = _stored(
            state.join(ends, F.col("source").eqNullSafe(F.col("s")) & F.col("below").isNull(), "left").select(
                "source", "source_size", "target", "full", F.coalesce("left", "rest").alias("rest"),
                F.coalesce("next", "prefix").alias("prefix"), F.coalesce("below", "found").alias("below"),
            ),
            "mix-budgets",
        )
    return state.select("source", "source_size", "target", "full", F.coalesce("below", F.lit(0)).alias("below"))


def mix(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0, prefix: str = "_") -> DataFrame:
    """``docs`` with the columns _size, _source_size, _target and _copies (how often the mix takes the row).

    ``docs`` needs doc_id, text and source; all rows and columns are kept. ``prefix`` (lower case) stands before the names of the new columns;
    columns of ``docs`` with such a name are replaced. Null texts have size 0, texts of any length count whole. A null source is
    a source of its own, after the others. Rows with the same doc_id have the same hash and are
    taken together; rows without one are taken one by one, repeated rows included. Reruns take the same rows; of rows without
    an id that are equal in text, as many. Sources without words take each row 0 times, an empty table gives an empty result.
    """
    names = [f"{prefix}{n}" for n in ("size", "source_size", "target", "copies")]
    kept = [c for c in docs.columns if c.lower() not in names]
    rows = keyed_rows(docs)
    sized = _stored(rows.select("source", word_count().alias("size"), row_hash().alias("h")), "mix-sizes")
    plan = thresholds(sized, source_targets(sized, weights, share, most)).toDF("_s", "_source_size", "_target", "_full", "_below")
    joined = rows.join(plan, rows["source"].eqNullSafe(F.col("_s")), "left")
    values = [word_count(), F.col("_source_size"), F.col("_target"), F.col("_full") + (row_hash() < F.col("_below")).cast("long")]
    return joined.select(*[F.col("_row")[c].alias(c) for c in kept], *[v.alias(n) for v, n in zip(values, names)])
