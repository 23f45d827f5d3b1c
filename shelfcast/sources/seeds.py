"""Reference tables kept as CSV files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from shelfcast.contracts import RULE_SCHEMA, STORE_SCHEMA


def read_seed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A CSV seed with a declared schema; its header must name the same columns."""
    return spark.read.csv(
        path, schema=schema, header=True, enforceSchema=False, escape='"', mode="FAILFAST"
    )


def read_stores(spark: SparkSession, path: str) -> DataFrame:
    return read_seed(spark, path, STORE_SCHEMA)


def read_rules(spark: SparkSession, path: str) -> DataFrame:
    return read_seed(spark, path, RULE_SCHEMA)
