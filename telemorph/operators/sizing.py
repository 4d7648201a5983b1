"""Broadcasting behind a measured size, and staging of shared intermediates."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemorph.session import checkpoint_dir

BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024
ROW_OVERHEAD_BYTES = 64


def measured_bytes(df: DataFrame) -> int:
    """Size of a relation's values as text, by one aggregation job."""
    widths = [F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) for c in df.columns]
    total = F.lit(ROW_OVERHEAD_BYTES).cast("bigint")
    for width in widths:
        total = total + width
    return df.agg(F.coalesce(F.sum(total), F.lit(0)).alias("b")).first()["b"]


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_LIMIT_BYTES) -> tuple[DataFrame, bool]:
    """``df`` with a broadcast hint when its measured size is within ``limit``;
    otherwise ``df`` as it is, to be joined by shuffling (or handled another way
    by the caller). The size is measured before the join runs because a hint
    spares the other, large side its exchange; a switch at run time comes only
    after that exchange was written."""
    small = measured_bytes(df) <= limit
    return (F.broadcast(df) if small else df), small


def staged(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared folder and read back: later steps
    neither repeat its work nor depend on executors that may be lost, and Spark
    knows its true size when it plans joins."""
    path = f"{checkpoint_dir(df.sparkSession)}/staged-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, column: str) -> DataFrame:
    """Distribute rows evenly by a column's content, for work that is heavy per
    row: how the rows happen to lie in files then does not matter."""
    return df.repartition(F.xxhash64(F.col(column).cast("string")))


#: Words of the bitmap below: at most so many rows of 64 bits are broadcast.
SLOTS = 1 << 15


def only_maybe_in(rows: DataFrame, keys: list[str], wanted: DataFrame) -> DataFrame:
    """``rows`` without most of those whose ``keys`` are not in ``wanted``, dropped
    where they are read, before any shuffle. A bitmap of the wanted keys is
    broadcast; it has at most ``SLOTS`` words, so the more keys there are, the
    more other rows pass, and a join or lookup must follow."""
    slot = F.pmod(F.xxhash64(*keys), F.lit(SLOTS)).cast("int")
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(F.xxhash64(F.lit(7), *keys), F.lit(64)).cast("int"))
    bitmap = wanted.select(slot.alias("_slot"), bit.alias("_bit")).groupBy("_slot").agg(F.bit_or("_bit").alias("_bits"))
    marked = rows.withColumn("_at", slot).join(F.broadcast(bitmap), F.col("_at") == F.col("_slot"))
    return marked.where(F.col("_bits").bitwiseAND(bit) != 0).select(*rows.columns)
