"""Surrogate keys.

``content_key`` hashes the business key: the same key gets the same id in every
run, on every cluster and in every table, so a row that carries the business key
carries the id too, without a join. ``dense_key`` numbers rows 1..n.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def content_key(*parts: Column) -> Column:
    """128-bit id of a tuple of values, as 32 hex digits.

    Each part is written with its length, NULL as its own mark, so no two
    different tuples share a text, whatever characters they hold.
    """

    def written(part: Column) -> Column:
        text = part.cast("string")
        marked = F.concat(F.length(text).cast("string"), F.lit(":"), text)
        return F.coalesce(marked, F.lit("n"))

    return F.md5(F.concat_ws("|", *[written(p) for p in parts]))


def content_key_if_complete(*parts: Column) -> Column:
    """``content_key``, or NULL if a part is NULL: what an equality join finds."""
    complete = parts[0].isNotNull()
    for part in parts[1:]:
        complete = complete & part.isNotNull()
    return F.when(complete, content_key(*parts))


def packed(df: DataFrame, ids: Sequence[str]) -> DataFrame:
    """Content keys as 16 bytes instead of 32 hex digits: half the width wherever they are stored,
    shuffled and compared. Packed tables join each other as they are."""
    return df.withColumns({c: F.unhex(c) for c in ids if c in df.columns})


def shown(df: DataFrame, ids: Sequence[str]) -> DataFrame:
    """Packed content keys as text again, for display."""
    return df.withColumns({c: F.lower(F.hex(c)) for c in ids if c in df.columns})


# Ranges of ids pass through one task and are broadcast: 16 ** 4 rows.
MOST_BUCKET_DIGITS = 4


def dense_key(
    df: DataFrame, id_column: str, by: Sequence[str], bucket_digits: int = 4,
    key: Column | None = None,
) -> DataFrame:
    """Number the rows of ``df`` 1..n; ``by`` must be unique (or ``key``, its content key).

    Rows are ordered by the hash of ``by`` and cut into ``16 ** bucket_digits``
    even ranges by its first digits. Each range is numbered by its own task and
    shifted by the size of the ranges before it; only that table of range sizes
    (65,536 rows at the default, which is the most allowed) passes through one task. The order
    depends on the values alone, so a second run or a lost executor gives the same numbers.
    """
    hashed = df.select(
        "*", (content_key(*[F.col(c) for c in by]) if key is None else key).alias("_hash"),
        F.lit(1).cast("bigint").alias("_n"),
    )
    placed = _place(_bucketed(hashed, bucket_digits))
    return placed.select((F.col("_before") + 1).alias(id_column), *df.columns)


def dense_key_of_copies(
    df: DataFrame, id_column: str, bucket_digits: int = 4, chunk: int = 100_000,
    pack: Sequence[str] = (),
) -> DataFrame:
    """Number the rows of ``df`` 1..n where rows may be equal, in the order of their hash.

    Only range sizes are added up first; then each row is shuffled once, to its range, and the
    content keys named in ``pack`` travel as 16 bytes. Where a range holds more than ``chunk`` rows,
    its equal rows are counted before that (combined before the shuffle), each distinct row gets a
    block of numbers, and blocks are written out in pieces that are dealt over all tasks, so a billion
    copies are not the work of one. The numbers are the same for any ``chunk``. ``df`` is read three
    times: store it first if it is dear.
    """
    names = df.columns
    hashed = _bucketed(
        df.withColumn("_hash", content_key(*[F.col(c) for c in names])), bucket_digits
    )
    ranges = _offsets(hashed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_size")), "_size")
    placed = packed(hashed, [*pack, "_hash"]).join(F.broadcast(ranges), "_bucket")

    # A range is told by its offset from here on.
    in_range = Window.partitionBy("_offset").orderBy("_hash")
    few = placed.where(F.col("_size") <= chunk).select(*names, "_hash", "_offset")
    numbered = few.select(
        (F.col("_offset") + F.row_number().over(in_range)).alias(id_column), *names
    )

    counted = placed.where(F.col("_size") > chunk).groupBy(*names, "_hash", "_offset").agg(
        F.count(F.lit(1)).alias("_n")
    )
    inside = F.sum("_n").over(in_range.rowsBetween(Window.unboundedPreceding, -1))
    pieces = counted.withColumn("_before", F.col("_offset") + F.coalesce(inside, F.lit(0))).select(
        *names, "_hash", "_before", "_n",
        F.explode(F.expr(f"sequence(0, (_n - 1) div {chunk})")).alias("_piece"),
    ).repartition("_hash", "_piece").withColumns({
        "_before": F.col("_before") + F.col("_piece") * chunk,
        "_n": F.least(F.lit(chunk), F.col("_n") - F.col("_piece") * chunk),
    })
    numbers = F.sequence(F.col("_before") + 1, F.col("_before") + F.col("_n"))
    written = pieces.select(F.explode(numbers).alias(id_column), *names)
    return shown(numbered.unionByName(written), pack)


def _offsets(sizes: DataFrame, size: str) -> DataFrame:
    """``_offset``: how many rows lie in the ranges before each one."""
    in_order = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.withColumn("_offset", F.coalesce(F.sum(size).over(in_order), F.lit(0)))


def _bucketed(hashed: DataFrame, digits: int) -> DataFrame:
    if not 1 <= digits <= MOST_BUCKET_DIGITS:
        raise ValueError(f"bucket_digits must be 1 to {MOST_BUCKET_DIGITS}")
    return hashed.withColumn("_bucket", F.substring("_hash", 1, digits))


def _place(hashed: DataFrame) -> DataFrame:
    """``_before``: how many rows come before this one in hash order."""
    # One row per bucket, so the unpartitioned window and the broadcast are bounded.
    sizes = hashed.groupBy("_bucket").agg(F.sum("_n").alias("_size"))
    offsets = _offsets(sizes, "_size").select("_bucket", "_offset")
    within = Window.partitionBy("_bucket").orderBy("_hash").rowsBetween(
        Window.unboundedPreceding, -1
    )
    counted = hashed.withColumn("_inside", F.coalesce(F.sum("_n").over(within), F.lit(0)))
    return counted.join(F.broadcast(offsets), "_bucket").withColumn(
        "_before", F.col("_offset") + F.col("_inside")
    )


# More files than this are looked up by a shuffled join: below it the table of files, two
# numbers each, is at most some 40 MB wherever it is sent.
MOST_FILES_SENT = 1 << 20


def key_by_place(written: DataFrame, id_column: str, after: int = 0) -> DataFrame:
    """Number the rows of a written parquet table ``after + 1`` to ``after + n`` by where they lie.

    ``written`` is the plain scan of the table. A file's rows follow those of the files before
    it, in order of their paths, and each other by their index in the file; only the row counts of
    files are added up, so no row is moved, whatever the size or skew. The numbers are as lasting as
    the files: write what this gives before the files go. A table without rows gives none.
    """
    placed = written.select(
        "*", F.col("_metadata.file_path").alias("_path"), F.col("_metadata.row_index").alias("_row")
    )
    files = written.select(F.col("_metadata.file_path").alias("_path")).groupBy("_path").agg(
        F.count(F.lit(1)).alias("_size")
    )
    in_order = Window.orderBy("_path").rowsBetween(Window.unboundedPreceding, -1)
    offsets = files.select(
        F.xxhash64("_path").alias("_file"),
        F.coalesce(F.sum("_size").over(in_order), F.lit(0)).alias("_before"),
    ).groupBy("_file").agg(
        F.when(F.count(F.lit(1)) > 1, F.raise_error(F.lit("two file names share a hash")))
        .otherwise(F.min("_before")).cast("bigint").alias("_before")
    )
    if len(written.inputFiles()) <= MOST_FILES_SENT:
        offsets = F.broadcast(offsets)
    numbered = placed.withColumn("_file", F.xxhash64("_path")).join(offsets, "_file")
    return numbered.select(
        (F.col("_before") + F.col("_row") + (after + 1)).alias(id_column), *written.columns
    )
