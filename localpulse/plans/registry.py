"""A query and its DuckDB counterpart, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from localpulse.plans.bridges import frame, oracle

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


class Source:
    """Bridges and tables of one scale factor, as attributes."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        from localpulse.plans.bridges import BRIDGES

        if name in BRIDGES:
            return frame(self.spark, self.sf_dir, name)
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")


def query(name: str, sql: str | None = None, *names: str):
    """Register ``f(source)`` as a query; ``sql`` reads the bridges in ``names``."""

    def put(f: Callable[[Source], DataFrame]) -> Callable[[Source], DataFrame]:
        QUERIES[name] = lambda spark, sf_dir: f(Source(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = oracle(sql, *names)
        return f

    return put
