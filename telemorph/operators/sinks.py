"""Writing upgraded tables and replacing documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_upgraded(
    df: DataFrame,
    path: str,
    partition_cols: list[str] | None = None,
    mode: str = "append",
    rows_per_file: int = 5_000_000,
    options: dict[str, str] | None = None,
) -> None:
    """Write an upgraded table as Parquet. ``mode='overwrite'`` replaces only the
    partitions present in ``df``, so a rerun of one range is idempotent."""
    writer = df.write.mode(mode).option("maxRecordsPerFile", rows_per_file).options(**(options or {}))
    if partition_cols:
        # Hash-cluster by partition so one task does not open a file per
        # partition; the rebalance hint lets AQE split a large partition.
        clustered = df.hint("rebalance", *partition_cols)
        writer = (
            clustered.write.mode(mode)
            .option("maxRecordsPerFile", rows_per_file)
            .option("partitionOverwriteMode", "dynamic")
            .options(**(options or {}))
            .partitionBy(*partition_cols)
        )
    writer.parquet(path)


def write_all(tables: dict[str, DataFrame], root: str, partition_cols: dict[str, list[str]] | None = None) -> dict[str, str]:
    """Write every output of a fan-out job under one root."""
    paths = {}
    for name, df in tables.items():
        paths[name] = f"{root}/{name}"
        write_upgraded(df, paths[name], (partition_cols or {}).get(name), mode="overwrite")
    return paths


def apply_updates(docs: DataFrame, changed: DataFrame, key: str = "id", data: str = "data") -> DataFrame:
    """The next snapshot of a document table: changed rows replace stored ones,
    everything else is carried over. Writing the snapshot is one commit, so all
    updates become visible together or not at all."""
    new = changed.select(F.col(key), F.col(data).alias("_new"))
    return docs.join(new, key, "left").withColumn(data, F.coalesce("_new", data)).drop("_new")


def reset_table(df: DataFrame) -> DataFrame:
    """An empty table of the same schema, for a derived table to be rebuilt."""
    return df.limit(0)


def finalise(spark: SparkSession, source_table: str, parity_ok: bool, drop_source: bool = False) -> bool:
    """Retire the source of a finished job, its files included: only on request,
    and only when the parity check passed. Returns whether the table was dropped."""
    if not drop_source:
        return False
    if not parity_ok:
        raise RuntimeError(f"not dropping {source_table}: row counts do not match")
    name = ".".join(f"`{part}`" for part in source_table.split("."))
    described = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    spark.sql(f"DROP TABLE {name}")
    # A table with a path of its own leaves its files behind.
    if described.get("Location"):
        path = spark._jvm.org.apache.hadoop.fs.Path(described["Location"])
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return True
