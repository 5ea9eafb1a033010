"""Quality rules with cross-document line frequency, in DataFrame operations only.

Lines are normalised and hashed; per host (the source of a document) the distinct documents that have a
line are counted. Lines in more documents than the limit are boilerplate and count as removed. A document that
fails the base rules, or has too few words left, is rejected.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.llm.digest import text_digest
from orderlake.llm.names import boxed, unboxed
from orderlake.session import scratch_path

WINDOW = 8
_SPACE = r"\x20\x09-\x0D"


@dataclass(frozen=True)
class Limits:
    """Limits of the rules."""

    min_words: int = 20  # fewer fail the base rules, and deplete a document
    max_repeat_percent: int = 30  # more words in repeated windows fail the base rules
    max_line_docs: int = 50  # a line in more documents of its host is removed
    min_left_percent: int = 50  # with fewer words left a document is depleted


def _hashes(words: str) -> str:
    return f"transform({words}, w -> xxhash64(w))"


def _pairs(cells: str, apart: int) -> str:
    """Hash of each cell with the one ``apart`` places on; an array shorter by ``apart``."""
    size = f"greatest(size({cells}) - {apart}, 0)"
    return f"zip_with(slice({cells}, 1, {size}), slice({cells}, {apart + 1}, {size}), (a, b) -> xxhash64(a, b))"


def normal_line(line: Column) -> Column:
    """Lower case, white space runs as one space, digits as 0."""
    plain = F.regexp_replace(F.lower(line), rf"[{_SPACE}]+", " ")
    return F.regexp_replace(F.trim(plain), r"\d", "0")


def base_measures(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, digest, source, row, measures of the text and its lines as (a, b, n): two hashes and the words."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    word = rf"[^{_SPACE}]++"
    rows = rows.select(
        "doc_id",
        "source",
        text_digest().alias("digest"),
        F.length(F.translate("text", " \t\n\x0b\f\r", "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        F.filter(F.split("text", "\n", -1), lambda x: x.rlike(rf"[^{_SPACE}]")).alias("lines"),
        F.expr(_hashes(rf"regexp_extract_all(text, '[^{_SPACE}]++', 0)".replace("\\", "\\\\"))).alias("h1"),
    )
    rows = rows.select(
        "*",
        F.size("h1").cast("long").alias("n_words"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.transform(
            "lines",
            lambda x: F.struct(
                F.xxhash64(normal_line(x)).alias("a"), F.hash(normal_line(x)).alias("b"), F.regexp_count(x, F.lit(word)).alias("n")
            ),
        ).alias("line_hashes"),
        F.expr(_pairs("h1", 1)).alias("h2"),
    ).drop("lines", "h1")
    rows = rows.withColumn("h4", F.expr(_pairs("h2", 2))).drop("h2")
    rows = rows.withColumn("h8", F.expr(_pairs("h4", 4))).drop("h4")
    # Sort the windows of texts that have equal ones, find equal neighbours, and add up the words they cover.
    rows = rows.withColumn("distinct", F.size(F.array_distinct("h8")))
    rows = rows.withColumn(
        "sorted", F.when(F.col("distinct") < F.size("h8"), F.expr("sort_array(transform(h8, (x, i) -> struct(x AS x, i AS i)))"))
    ).drop("h8", "distinct")
    rows = rows.withColumn(
        "same", F.expr("zip_with(slice(sorted, 1, size(sorted) - 1), slice(sorted, 2, size(sorted) - 1), (a, b) -> a.x = b.x)")
    )
    rows = rows.withColumn("hit", F.expr("zip_with(concat(array(false), same), concat(same, array(false)), (a, b) -> a OR b)")).drop("same")
    rows = rows.withColumn(
        "places", F.expr("sort_array(filter(zip_with(sorted, hit, (s, f) -> if(f, s.i, CAST(null AS INT))), i -> i IS NOT NULL))")
    ).drop("sorted", "hit")
    covered = (
        f"coalesce(aggregate(places, struct(0L AS n, 0 AS upto), "
        f"(s, i) -> struct(s.n + i + {WINDOW} - greatest(s.upto, i) AS n, i + {WINDOW} AS upto), s -> s.n), 0L)"
    )
    return rows.withColumn("n_repeat_words", F.expr(covered)).drop("places").withColumn("row", F.monotonically_increasing_id())


def line_verdicts(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Measures and verdict per row.

    ``docs`` needs doc_id, text and source; other columns are ignored. Returns doc_id, digest (of the text), n_words,
    word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, n_left_words and removed (array of the hashes of
    the lines that are removed). Null texts count as empty and fail the base rules. A null source is a host of its
    own. Rows with the same doc_id count as one document in line counts, each row with a null doc_id as one; every row gets a result. Lines and windows
    that are equal count as such whichever comes first, so ties play no part; texts of any length are measured whole. Empty tables give an
    empty result.
    """
    path = scratch_path(docs.sparkSession, "line-measures")
    measures = base_measures(docs)
    measures.write.parquet(path)
    measures = docs.sparkSession.read.schema(measures.schema).parquet(path)
    lines = measures.select("row", "doc_id", "source", F.explode("line_hashes").alias("l")).select("row", "doc_id", "source", "l.*")
    document = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("row"), F.col("row")))
    # One row per host, line and document first, so a common line is counted in all tasks.
    common = (
        lines.select("source", "a", "b", document.alias("d")).distinct()
        .groupBy("source", "a", "b").agg(F.count(F.lit(1)).alias("docs"))
        .where(F.col("docs") > limits.max_line_docs).select(F.col("source").alias("s"), "a", "b")
    )
    removed = (
        lines.join(common, ["a", "b"])
        .where(F.col("source").eqNullSafe(F.col("s")))
        .groupBy("row")
        .agg(F.sum("n").alias("gone"), F.collect_set(F.struct("a", "b")).alias("removed"))
    )
    out = measures.drop("line_hashes", "source").join(removed, "row", "left")
    left = F.col("n_words") - F.coalesce("gone", F.lit(0))
    failed = (F.col("n_words") < limits.min_words) | (100 * F.col("n_repeat_words") > limits.max_repeat_percent * F.col("n_words"))
    depleted = (left < limits.min_words) | (100 * left < limits.min_left_percent * F.col("n_words"))
    return out.select(
        "doc_id", "digest", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & ~depleted).alias("kept"), left.cast("long").alias("n_left_words"), "removed",
    )


def without_common_lines(docs: DataFrame, verdicts: DataFrame) -> DataFrame:
    """The kept rows of docs, their texts without the removed lines; all columns of docs, whatever their names."""
    marks = verdicts.where("kept").select(F.col("doc_id").alias("_id"), F.col("digest").alias("_digest"), F.col("removed").alias("_removed")).distinct()
    keyed = boxed(docs, F.col("doc_id").cast("long").alias("_own"), text_digest().alias("_same"), F.col("text").alias("_text"))
    gone = lambda x: F.array_contains(F.col("_removed"), F.struct(F.xxhash64(normal_line(x)).alias("a"), F.hash(normal_line(x)).alias("b")))
    left = F.array_join(F.filter(F.split("_text", "\n", -1), lambda x: ~gone(x)), "\n")
    text = F.when(F.col("_removed").isNull(), F.col("_text")).otherwise(left)
    return unboxed(keyed.join(marks, F.col("_own").eqNullSafe(F.col("_id")) & (F.col("_same") == F.col("_digest"))), docs.columns, {"text": text})
