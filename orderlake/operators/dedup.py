"""Keep the latest arrival of each order."""

from __future__ import annotations

import functools
import operator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlake import schema
from orderlake.operators.storing import stored_rows


def latest_first(df: DataFrame) -> list[Column]:
    """Latest arrival first, then a total order over the remaining columns.

    Rows of one ingestion run share ``_ingested_at``; ``created_at`` and the
    other columns break such ties so the survivor does not depend on
    shuffle order.
    """
    order = [F.col("_ingested_at").desc_nulls_last()]
    if "created_at" in df.columns:
        order.append(F.col("created_at").desc_nulls_last())
    order += [F.col(c).asc_nulls_first() for c in schema.DEDUP_TIEBREAK if c in df.columns]
    return order


def deduplicate(df: DataFrame, key: str = schema.DEDUP_KEY) -> DataFrame:
    """One row per ``key``: the latest arrival.

    ``row_number() = 1`` lets Spark put a partial top-1 before the shuffle,
    so a key repeated across many map tasks sends one row per task.
    """
    window = Window.partitionBy(key).orderBy(*latest_first(df))
    return (
        df.withColumn("_rank", F.row_number().over(window))
        .filter(F.col("_rank") == 1)
        .drop("_rank")
    )


def duplicates_removed(df: DataFrame, key: str = schema.DEDUP_KEY) -> DataFrame:
    """The rows :func:`deduplicate` drops (every copy but the survivor): ``df EXCEPT ALL survivors``.

    The rows are stored once with a number each, while the result is built. Which survive is found on their keys and arrivals
    alone (:func:`_survivors`); the others are picked out by their bits, so full rows don't move.
    """
    tagged, rows = _numbered_rows(df)
    return _by_bits(tagged, _bits(_survivors(tagged, key)), rows).where(~F.coalesce(_bit(_KEPT), F.lit(False))).select(*df.columns)


def stored_latest(df: DataFrame, key: str = schema.DEDUP_KEY, copies: str | None = None) -> DataFrame:
    """:func:`deduplicate` for rows that are wide or come from a costly plan: full rows are stored once and never moved.

    With ``copies`` a column of that name marks rows behind the first of their key, should there be any.
    """
    tagged, rows = _numbered_rows(df)
    return _latest(tagged, _survivors(tagged, key), key, copies, rows).drop(_ROW)


def _latest(tagged: DataFrame, survivors: DataFrame, key: str, copies: str | None, most: int) -> DataFrame:
    """Rows of ``tagged`` that survive, with their marks as copies."""
    if copies:
        survivors = survivors.withColumn(_COPY, F.row_number().over(Window.partitionBy(key).orderBy(_ROW)) > 1)
    kept = _by_bits(tagged, _bits(survivors), most).where(_bit(_KEPT))
    return kept.select(*tagged.columns, *([F.coalesce(_bit(_COPIES), F.lit(False)).alias(copies)] if copies else []))


@dataclass(frozen=True)
class FileRows:
    """Rows read from stored files, each with a number that all scans of the files agree on: its file's and its place there.

    Files don't change, so nothing is stored again for it. ``files`` has the files' paths, numbers and rows; ``count`` is the number of
    rows, and ``bits`` how many bits their bitmaps have.
    """

    rows: DataFrame
    files: DataFrame
    count: int
    bits: int

    def of(self, df: DataFrame) -> FileRows:
        """The rows of ``df``, read from some of the same files, with the same numbers."""
        return FileRows(_numbered(df, self.files), self.files, self.count, self.bits)

    def having(self, numbers: DataFrame) -> DataFrame:
        """The rows that have these numbers."""
        return _by_bits(self.rows, _bits(numbers), self.bits).where(_bit(_KEPT)).select(*self.rows.columns)

    def without(self, numbers: DataFrame) -> DataFrame:
        """The other rows."""
        return _by_bits(self.rows, _bits(numbers), self.bits).where(~F.coalesce(_bit(_KEPT), F.lit(False))).select(*self.rows.columns)

    def latest(self, key: str = schema.DEDUP_KEY, copies: str | None = None) -> DataFrame:
        """:func:`stored_latest` of the rows, with their numbers."""
        return _latest(self.rows, _survivors(self.rows, key), key, copies, self.bits)

    def grouped(self) -> bool:
        """Whether the rows lie in few files for each folder, or in large ones: what is written of them task by task, too, then does."""
        folder = F.regexp_replace(_FILE, "/[^/]*$", "")
        many, folders = self.files.agg(F.count(F.lit(1)), F.count_distinct(folder)).first()
        return many <= FOLDER_FILES * folders or self.count >= LARGE_FILE_ROWS * many

    def paths_of(self, numbers: DataFrame) -> list[str]:
        """URIs of the files that hold these rows."""
        held = numbers.select(F.shiftright(ROW, _FILE_BITS).alias(_FILE_NUMBER)).distinct()
        return [r[_FILE] for r in self.files.join(held, _FILE_NUMBER, "left_semi").select(_FILE).toLocalIterator()]


def rows_in_files(df: DataFrame) -> FileRows:
    """The rows of ``df``, read from storage, numbered. Its files are listed once, with the rows that each has."""
    files = df.groupBy(F.col("_metadata.file_path").alias(_FILE)).agg(F.count(F.lit(1)).alias("_rows"))
    # A row for each file: one task numbers them.
    stored, _ = stored_rows(files.withColumn(_FILE_NUMBER, F.row_number().over(Window.orderBy(_FILE)).cast("long")), "files")
    bitmaps = F.shiftright(F.col("_rows") + (1 << _BITMAP_BITS) - 1, _BITMAP_BITS)
    count, maps = stored.agg(F.coalesce(F.sum("_rows"), F.lit(0)), F.coalesce(F.sum(bitmaps), F.lit(0))).first()
    return FileRows(_numbered(df, stored), stored, int(count), int(maps) << _BITMAP_BITS)


def _numbered(df: DataFrame, files: DataFrame) -> DataFrame:
    placed = df.withColumns({_FILE: F.col("_metadata.file_path"), _AT: F.col("_metadata.row_index")}).join(F.broadcast(files.drop("_rows")), _FILE)
    return placed.select(*df.columns, F.shiftleft(_FILE_NUMBER, _FILE_BITS).bitwiseOR(F.col(_AT)).alias(ROW))


ROW = _ROW = "_row"
#: Files of a folder, and mean rows of a file, up to and from which files count as grouped by folder.
FOLDER_FILES, LARGE_FILE_ROWS = 4, 1 << 17
#: A row's number has the row's place in its file in so many bits, and the file's number above.
_FILE_BITS = 40
_FILE, _FILE_NUMBER, _AT = "_file", "_file_number", "_at"
_COPY, _BUCKET, _KEPT, _COPIES = "_copy", "_row_bucket", "_kept", "_copies"
#: Rows that one bitmap of four kilobytes stands for.
_BITMAP_BITS = 15
#: A bit for each row is broadcast up to so many rows (128 MB); beyond, Spark chooses the join.
_BROADCAST_ROWS = 1 << 30

#: Keys that are broadcast at most.
BROADCAST_KEYS = 1 << 20


def _numbered_rows(df: DataFrame) -> tuple[DataFrame, int]:
    return stored_rows(df.withColumn(_ROW, F.monotonically_increasing_id()), "dedup-rows")


def _survivors(tagged: DataFrame, key: str) -> DataFrame:
    """``key`` and number of the first row of each key.

    Of a key, the two first rows by arrival move, without the other columns. Where these arrived together the whole order decides
    among the key's rows; only such keys' rows are taken whole. Both limits have a partial step, so a key sends at most two
    rows for each task, however many copies it has.
    """
    order = latest_first(tagged)
    arrival = [c for c in ("_ingested_at", "created_at") if c in tagged.columns]
    times = [F.col(c).desc_nulls_last() for c in arrival]
    window = Window.partitionBy(key).orderBy(*times, _ROW)
    place = F.row_number().over(window)
    first = tagged.select(key, *arrival, _ROW).withColumn("_place", place).where(F.col("_place") <= 2)
    # The second row came with the first: equal arrivals, null ones too.
    same = functools.reduce(operator.and_, [F.col(c).eqNullSafe(F.lag(c).over(window)) for c in arrival], F.lit(True))
    first = first.withColumn("_again", (F.col("_place") == 2) & same)
    pair = first.groupBy(key).agg(
        F.min(F.when(F.col("_place") == 1, F.col(_ROW))).alias(_ROW),
        F.max("_again").alias("_tied"),
    )
    found, _ = stored_rows(pair, "dedup-first")
    tied, many = stored_rows(found.where("_tied").select(F.col(key).alias("_tied_key")), "dedup-tied")
    tied = F.broadcast(tied) if many <= BROADCAST_KEYS else tied
    whole = tagged.join(tied, F.col(key).eqNullSafe(F.col("_tied_key")), "left_semi")
    decided = whole.withColumn("_place", F.row_number().over(Window.partitionBy(key).orderBy(*order, _ROW))).where(F.col("_place") == 1)
    return found.where("NOT _tied").select(key, _ROW).unionByName(decided.select(key, _ROW))


def _bits(rows: DataFrame) -> DataFrame:
    """Numbers as bitmaps of 32,768 numbers each: a bit for each row that is kept, and for each that is a copy."""
    at = F.col(_ROW).bitwiseAND((1 << _BITMAP_BITS) - 1)
    bits = [F.bitmap_construct_agg(at).alias(_KEPT)]
    if _COPY in rows.columns:
        bits.append(F.bitmap_construct_agg(F.when(F.col(_COPY), at)).alias(_COPIES))
    return rows.groupBy(F.shiftright(_ROW, _BITMAP_BITS).alias(_BUCKET)).agg(*bits)


def _by_bits(tagged: DataFrame, bits: DataFrame, rows: int) -> DataFrame:
    """Rows beside the bitmaps of their numbers."""
    bits = F.broadcast(bits) if rows <= _BROADCAST_ROWS else bits
    return tagged.withColumn(_BUCKET, F.shiftright(_ROW, _BITMAP_BITS)).join(bits, _BUCKET, "left")


def _bit(bitmap: str) -> Column:
    """Whether the bitmap has the row's bit; null without a bitmap."""
    at = F.col(_ROW).bitwiseAND((1 << _BITMAP_BITS) - 1).cast("int")
    byte = F.conv(F.hex(F.substring(F.col(bitmap), F.shiftright(at, 3) + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, at.bitwiseAND(7)) == 1
