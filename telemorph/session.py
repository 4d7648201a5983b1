"""Session settings every job in this package relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings that change results: they must hold wherever the jobs run.
SEMANTICS = {
    "spark.sql.session.timeZone": "UTC",
    # A repeated key in an attribute list keeps its last value.
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    # The same rule for objects inside documents.
    "spark.sql.variant.allowDuplicateKeys": "true",
}

# Settings that only change how a plan runs.
SCALE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Document rewriting is heavy per byte: small inputs still use all cores.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64KB",
    # Split one hot join key over several tasks, also where the split costs an
    # extra exchange for the aggregation that follows the join.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings above to a session somebody else created."""
    for key, value in {**SEMANTICS, **SCALE}.items():
        spark.conf.set(key, value)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and staged tables: the one the cluster names
    in ``spark.checkpoint.dir``; where it names none, one beside the tables of the
    warehouse, which all executors share too."""
    return spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/_staged"


def local_session(cores: str = "*", app: str = "telemorph", shuffle_partitions: int = 8) -> SparkSession:
    """Single-machine session for tests and the benchmark."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)
