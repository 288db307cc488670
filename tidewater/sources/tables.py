"""Batch scans of the driver's parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewater.session import prepare_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy parquet scan; Catalyst prunes columns and pushes filters into it."""
    prepare_session(spark)
    return spark.read.parquet(table_path(sf_dir, name))


class Tables:
    """Named access to the driver's tables of one scale-factor directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = prepare_session(spark)
        self.sf_dir = sf_dir
        self._scans: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        # One scan per table and instance: the files are listed once for all
        # the views of a query built from the same instance.
        if name in TABLES:
            if name not in self._scans:
                self._scans[name] = read_table(self.spark, self.sf_dir, name)
            return self._scans[name]
        raise AttributeError(name)
