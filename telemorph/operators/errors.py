"""Error rows: old layout to new layout."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemorph.functions.scalars import text_to_bool


def upgrade_errors(df: DataFrame) -> DataFrame:
    """Add the error group (MD5 of service, type and message), turn the escape
    flag into a boolean and drop the parent span."""
    return df.select(
        "timestamp",
        "errorID",
        F.md5(F.concat("serviceName", "exceptionType", "exceptionMessage")).alias("groupID"),
        "traceID",
        "spanID",
        "serviceName",
        "exceptionType",
        "exceptionMessage",
        "exceptionStacktrace",
        text_to_bool(F.col("exceptionEscaped")).alias("exceptionEscaped"),
    )
