"""Registration of queries and access to their inputs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from jobmart.catalog.fixtures import fixture, oracle, table
from jobmart.session import work_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Inputs:
    """Tables and derived inputs of one data folder, and a place for written tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return table(self.spark, self.sf_dir, name)

    def fixture(self, name: str) -> DataFrame:
        return fixture(self.spark, self.sf_dir, name)

    def work_dir(self, purpose: str) -> str:
        return work_dir(self.spark, purpose)


def query(key: str, sql: str | None = None):
    """Register a function of ``Inputs`` under ``key``, with its SQL counterpart if there is one."""

    def register(build: Callable[[Inputs], DataFrame]):
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key}")
        QUERIES[key] = lambda spark, sf_dir: build(Inputs(spark, sf_dir))
        if sql is not None:
            ORACLES[key] = oracle(sql)
        return build

    return register
