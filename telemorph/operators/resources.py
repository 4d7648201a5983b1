"""Resource fingerprints and the catalog of resources seen per bucket.

The fingerprint is a loop over bytes, much dearer than anything else done per
row, and few resources produce most rows. It is therefore computed once for each
of the most frequent resources and looked up from that table, which is broadcast
and has a fixed number of rows at most; rows of other resources compute their
own. So the log or span table is never shuffled, and nothing runs before the
result is asked for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemorph.functions.hashing import resource_fingerprint

#: Resources whose fingerprint is looked up.
FREQUENT = 4096


def _fingerprint_of(labels: str) -> Column:
    return resource_fingerprint(F.from_json(labels, "map<string,string>"))


def attach_fingerprint(rows: DataFrame, labels: str, frequent: int = FREQUENT) -> DataFrame:
    """Replace the canonical resource text ``labels`` by ``resource_fingerprint``."""
    common = rows.groupBy(labels).count().orderBy(F.desc("count"), labels).limit(frequent).select(labels, _fingerprint_of(labels).alias("_known"))
    joined = rows.join(F.broadcast(common), labels, "left")
    return joined.withColumn("resource_fingerprint", F.coalesce("_known", _fingerprint_of(labels))).drop(labels, "_known")


def fingerprint_resources(rows: DataFrame, labels: str, bucket: str = "ts_bucket_start") -> tuple[DataFrame, DataFrame]:
    """Rows with their fingerprint, and the distinct (labels, fingerprint, bucket)
    over the whole table, which needs the bucket and resource columns alone."""
    catalog = rows.select(bucket, labels).distinct().select(
        F.col(labels).alias("labels"), _fingerprint_of(labels).alias("fingerprint"), F.col(bucket).alias("seen_at_ts_bucket_start")
    )
    return attach_fingerprint(rows, labels), catalog
