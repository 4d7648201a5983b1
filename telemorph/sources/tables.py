"""Access to stored tables and document tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table. Timestamps stored without a zone are read as UTC."""
    df = spark.read.parquet(path)
    zoneless = [f.name for f in df.schema if isinstance(f.dataType, T.TimestampNTZType)]
    return df.withColumns({name: F.col(name).cast("timestamp") for name in zoneless}) if zoneless else df


class Tables:
    """The tables of one data folder, read on first use."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._read: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._read:
            self._read[name] = read_table(self.spark, f"{self.folder}/{name}.parquet")
        return self._read[name]


def parse_documents(docs: DataFrame, key: str = "id", data: str = "data") -> tuple[DataFrame, DataFrame]:
    """Split a document table into rows holding a JSON object and a quarantine
    of the rest; neither the text nor unknown fields are touched."""
    tagged = docs.withColumn("_object", F.try_parse_json(data).try_cast("map<string,variant>").isNotNull())
    good = tagged.where("_object").drop("_object")
    bad = tagged.where(~F.col("_object")).select(key, data, F.lit("not a JSON object").alias("reason"))
    return good, bad


def read_documents(spark: SparkSession, path: str, key: str = "id", data: str = "data") -> tuple[DataFrame, DataFrame]:
    return parse_documents(read_table(spark, path), key, data)
