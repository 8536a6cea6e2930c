"""How frames are computed: values that are computed once, and shuffles that go when what needs them is written."""

from __future__ import annotations

import contextlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def shuffles_removed(spark: SparkSession):
    """What is written meanwhile leaves no shuffle files on the executors; else they stay until the driver collects garbage."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)


def computed(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns whose values later expressions read. A plain column is written into each expression and each filter that
    uses it, and computed anew in all of them.
    """
    s = "__computed"
    return df.select("*", F.explode(F.array(F.struct(*(c.alias(n) for n, c in columns.items())))).alias(s)).select(*(c for c in df.columns if c not in columns), *(F.col(f"{s}.{n}").alias(n) for n in columns))
