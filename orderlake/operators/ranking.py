"""Rank, ntile and position over a global order without a single-partition window.

A window with no ``partitionBy`` (or one partitioned by a handful of
values) moves every row into one task. Tiles need no order of all rows, only the first row of each tile, which
is searched by counting (:func:`with_ntiles`). Ranks need an order inside buckets and what lies
before each bucket (:func:`distributed_rank`). Both run their searches while the result is built.

:func:`with_global_position` numbers all rows. They are range-partitioned
on a total order, sorted inside each partition and numbered there;
per-partition counts (one row per partition, so their size is bounded by
the partition count) then turn local numbers into global positions.

Counts and numbered rows must see the same partitioning. Range bounds come
from sampling, so two executions of the range shuffle can cut the data
differently, and Spark does not reliably reuse one shuffle for both
(column pruning gives the counting branch its own exchange). The numbered
rows are therefore written once as a table in the session's checkpoint
folder, and both the counts and the positions are read
from that one copy; a lost executor cannot make them disagree.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlake.operators.splitters import SAMPLE, Key, keyed, literal_rows, place, reached, rows_at, sample, sorted_rows
from orderlake.operators.storing import stored_rows

_LOCAL_BITS = 33  # monotonically_increasing_id: partition index << 33 | row


def sort_key(name: str, direction: str = "asc", nulls: str | None = None) -> Column:
    """Sort key with Spark's default null placement unless ``nulls`` is given."""
    nulls = nulls or ("first" if direction == "asc" else "last")
    col = F.col(name)
    return {
        ("asc", "first"): col.asc_nulls_first(),
        ("asc", "last"): col.asc_nulls_last(),
        ("desc", "first"): col.desc_nulls_first(),
        ("desc", "last"): col.desc_nulls_last(),
    }[(direction, nulls)]


#: Rows per range partition when no count is given.
ROWS_PER_TASK = 1_000_000


def partitions_for(rows: int) -> int:
    """Range partitions for a counted number of rows: no ceiling, and never a single task."""
    return max(2, -(-rows // ROWS_PER_TASK))


def _sized(df: DataFrame, num_partitions: int | None) -> tuple[DataFrame, int]:
    """``df`` and the range partition count; without one the rows are stored and counted."""
    if num_partitions:
        return df, num_partitions
    stored, rows = stored_rows(df, "ranking-input")
    return stored, partitions_for(rows)


def with_global_position(
    df: DataFrame,
    order: Sequence[Column],
    position_col: str = "_pos",
    total_col: str = "_total",
    num_partitions: int | None = None,
    totals: dict[str, tuple[str, str]] | None = None,
) -> DataFrame:
    """Add the 0-based position of each row under ``order`` and the row count.

    ``order`` must be total (add tie-breakers), otherwise positions among
    equal keys are arbitrary. Equal keys may span partitions; nothing here
    needs one key to fit in one task.

    ``totals`` adds whole-table aggregates in the same pass, e.g.
    ``{"_latest": ("max", "order_date")}``; ``min``, ``max`` and ``sum``
    are supported (each is taken per partition, then over partitions).
    """
    if not order:
        raise ValueError("with_global_position needs at least one sort key")
    columns = df.columns
    df, parts = _sized(df, num_partitions)
    numbered, _ = stored_rows(
        df.repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .withColumn("_rowid", F.monotonically_increasing_id()),
        "positions",
    )
    part = F.shiftright(F.col("_rowid"), _LOCAL_BITS)
    local = F.col("_rowid").bitwiseAND((1 << _LOCAL_BITS) - 1)
    totals = totals or {}
    combine = {"min": F.min, "max": F.max, "sum": F.sum}
    counts = numbered.groupBy(part.alias("_part")).agg(
        F.count(F.lit(1)).alias("_n"),
        *[combine[fn](F.col(c)).alias(name) for name, (fn, c) in totals.items()],
    )
    # One row per partition: a single-partition window over it is cheap.
    by_part = Window.orderBy("_part")
    offsets = counts.select(
        "_part",
        F.coalesce(
            F.sum("_n").over(by_part.rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0),
        ).alias("_offset"),
        F.sum("_n").over(Window.partitionBy()).alias(total_col),
        *[
            combine[fn](F.col(name)).over(Window.partitionBy()).alias(name)
            for name, (fn, _) in totals.items()
        ],
    )
    return numbered.join(
        F.broadcast(offsets), part == F.col("_part"), "inner"
    ).select(
        *columns,
        (F.col("_offset") + local).alias(position_col),
        F.col(total_col),
        *[F.col(name) for name in totals],
    )


def with_ntiles(stored: DataFrame, rows: int, n: int, passes: dict[str, list[Key]], size: int = SAMPLE) -> DataFrame:
    """Add ``ntile(n)`` columns over several total orders to a stored table of ``rows`` rows.

    Building the result searches the first row of each tile of all orders together (:func:`rows_at`); nothing
    is sorted or moved. A row's tile is the number of first rows that it has reached. Orders must be total. ``size`` bounds
    the sample and what is fetched of one tile's surroundings at once.
    """
    if not all(passes.values()):
        raise ValueError("each pass needs at least one sort key")
    least, extra = divmod(rows, n)
    starts = [t * least + min(t, extra) for t in range(1, n)]
    starts = [p for p in starts if p < rows]
    keys, names = keyed(stored, passes)
    firsts = rows_at(keys, rows, passes, names, {name: starts for name in passes}, size)
    kinds = {f.name: f.dataType for f in keys.schema.fields}
    out = {}
    for name, order in passes.items():
        row = [F.unix_micros(k[0]) if isinstance(stored.select(k[0]).schema[0].dataType, T.TimestampType) else k[0] for k in order]
        bounds = [firsts[name][p] for p in starts]
        out[name] = (place(order, row, bounds, [kinds[c] for c in names[name]]) + 1).cast("int")
    return stored.withColumns(out)


#: Buckets that a rank deals the rows to, at most; their splitters are part of the plan.
MOST_BUCKETS = 4096


def distributed_rank(
    df: DataFrame,
    partition_by: Sequence[str],
    order_by: Sequence[tuple[str, str]],
    tiebreak: Sequence[str],
    out_col: str,
    num_partitions: int | None = None,
) -> DataFrame:
    """``rank() over (partition by .. order by ..)`` without one task per group.

    Splitters from a sample cut the total order (group columns, ranking keys, ``tiebreak``) into buckets of about
    a million rows, or into ``num_partitions``. A rank inside a bucket and group is Spark's own; the rows move once for it. What
    lies before a bucket is carried as a prefix over one row for each bucket: only the group and the
    tie of the splitter that the bucket begins with can go on from the bucket before. One counting pass gives, for each bucket, the
    rows of the next splitter's group and those before its tie; the sums go into the plan as constants,
    so nothing is joined.
    """
    if not order_by:
        raise ValueError("distributed_rank needs at least one ranking key")
    groups = list(partition_by)
    default = lambda c, d: (F.col(c), d, "first" if d == "asc" else "last")  # noqa: E731  Spark's place of nulls
    by_group, by_keys = [default(c, "asc") for c in groups], [default(c, d) for c, d in order_by]
    order = [*by_group, *by_keys, *[default(c, "asc") for c in tiebreak]]
    stored, rows = stored_rows(df, "ranking-input")
    count = min(num_partitions or partitions_for(rows), MOST_BUCKETS)
    keys, names = keyed(stored, {"rank": order})
    cols, kinds = names["rank"], [f.dataType for f in keys.schema.fields]
    picked = sorted_rows(sample(keys, rows, max(SAMPLE, 4 * count)), order, cols)
    cuts = [tuple(picked[len(picked) * i // count][c] for c in cols) for i in range(1, count)] if picked else []
    cuts = list(dict.fromkeys(cuts))
    tie = len(groups) + len(order_by)

    own = [F.unix_micros(k[0]) if isinstance(f.dataType, T.TimestampType) else k[0] for k, f in zip(order, stored.select(*[k[0].alias(c) for k, c in zip(order, cols)]).schema.fields)]
    tagged = stored.withColumn("_bucket", place(order, own, cuts, kinds))
    if not cuts:
        window = Window.partitionBy(*groups).orderBy(*[sort_key(c, d) for c, d in order_by])
        return stored.withColumn(out_col, F.rank().over(window).cast("int"))
    splitters = literal_rows(cuts, kinds)

    def of_splitter(at: Column, a: int, b: int) -> list[Column]:
        return [F.get(splitters, at)[f"k{i}"] for i in range(a, b)]

    def same(a: int, b: int, at: Column) -> Column:
        return functools.reduce(lambda x, y: x & y, [own[i].eqNullSafe(v) for i, v in zip(range(a, b), of_splitter(at, a, b))], F.lit(True))

    # Splitter b stands at the end of bucket b and begins bucket b + 1.
    ahead = F.col("_bucket")
    in_group = (ahead < len(cuts)) & same(0, len(groups), ahead)
    before_tie = in_group & ~reached(by_keys, own[len(groups) : tie], of_splitter(ahead, len(groups), tie))
    seen = {r["_bucket"]: (r["e"], r["f"]) for r in tagged.groupBy("_bucket").agg(F.count_if(in_group).alias("e"), F.count_if(before_tie).alias("f")).collect()}
    # Rows of a splitter's group before it, and those before its tie.
    group_rows, tie_rows = [], []
    for b, cut in enumerate(cuts):
        e, f = seen.get(b, (0, 0))
        goes_on = b > 0 and cuts[b - 1][: len(groups)] == cut[: len(groups)]
        if goes_on:
            f = tie_rows[-1] if cuts[b - 1][:tie] == cut[:tie] else f + group_rows[-1]
            e += group_rows[-1]
        group_rows.append(e)
        tie_rows.append(f)
    constant = lambda values: F.expr("array(" + ", ".join(f"{v}L" for v in values) + ")")
    begin = F.col("_bucket") - 1
    local = F.rank().over(Window.partitionBy("_bucket", *groups).orderBy(*[sort_key(c, d) for c, d in order_by]))
    carried = (F.col("_bucket") > 0) & same(0, len(groups), begin)
    ranked = tagged.withColumn("_local", local).withColumn(
        out_col,
        F.when(carried & same(len(groups), tie, begin), F.get(constant(tie_rows), begin) + 1)
        .when(carried, F.get(constant(group_rows), begin) + F.col("_local"))
        .otherwise(F.col("_local"))
        .cast("int"),
    )
    return ranked.drop("_bucket", "_local")
