"""Staging in the shared folder, and columns several operators use."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Words are maximal runs without these six characters (space, tab to carriage return).
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; where it is unset, one in the
    warehouse, which all executors share too."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return folder or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/llm-staging"


def stage(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared folder and read back: its lineage ends
    there, so a lost executor costs no rework."""
    path = f"{shared_folder(df.sparkSession)}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_pieces(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Slices of some ``size`` bytes of text, so that only those become Python
    strings; a longer text is one of its own."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
        place = np.cumsum(lengths, dtype=np.int64) // size
        starts = np.flatnonzero(np.r_[True, place[1:] != place[:-1]][: len(place)])
        for a, b in zip(starts, [*starts[1:], len(place)]):  # noqa: B905  an empty batch has no start
            yield batch.slice(a, b - a)


def lower_ascii(text: Column) -> Column:
    """A to Z lower-cased, everything else as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text: Column) -> Column:
    """The words of a text, in order; null and blank texts have none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def in_fold(key: Column, folds: int, fold: int) -> Column:
    """crc32 of the key as text modulo ``folds`` is ``fold``; false for null keys."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % folds == fold, F.lit(False))


def outside_fold(key: Column, folds: int, fold: int) -> Column:
    """The key is known and not in the fold; false for null keys."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % folds != fold, F.lit(False))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


#: Words of a key bitmap: 32,768 rows of 64 bits whatever the number of keys.
SLOTS = 1 << 15


def _slot(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(SLOTS)).cast("int")


def _bit(key: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.xxhash64(F.lit(7), key), F.lit(64)).cast("int"))


def marked(rows: DataFrame, key: Column, wanted: DataFrame, flag: str) -> DataFrame:
    """``rows`` with ``flag``: false where ``key`` is surely not in the one column
    of ``wanted``. A bitmap of fixed size is broadcast; the more keys it holds
    the more rows are flagged in vain, so an exact step must follow."""
    only = F.col(wanted.columns[0])
    bitmap = wanted.groupBy(_slot(only).alias("_slot")).agg(F.bit_or(_bit(only)).alias("_bits"))
    joined = rows.withColumn("_key_slot", _slot(key)).join(F.broadcast(bitmap), F.col("_key_slot") == F.col("_slot"), "left")
    return joined.withColumn(flag, F.coalesce(F.col("_bits").bitwiseAND(_bit(key)) != 0, F.lit(False))).drop("_key_slot", "_slot", "_bits")


def only_with(rows: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """Rows whose ``key`` is in ``wanted``; rows that surely are not never reach the shuffle."""
    return marked(rows, F.col(key), wanted, "_maybe").where("_maybe").drop("_maybe").join(wanted, key, "left_semi")


def without(rows: DataFrame, key: str, unwanted: DataFrame) -> DataFrame:
    """Rows whose ``key`` is not in ``unwanted``, null keys among them; only rows
    that may be in it are shuffled."""
    flagged = marked(rows, F.col(key), unwanted, "_maybe")
    return flagged.where(~F.col("_maybe")).drop("_maybe").unionByName(flagged.where("_maybe").drop("_maybe").join(unwanted, key, "left_anti"))
