"""Registration of queries with the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from waymark.plans.durable import spread
from waymark.sources.views import view, with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Views:
    """Access to the tables and domain views of one directory: v.places, v.orders, ..."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return view(self.spark, self.sf_dir, name)

    def dealt(self, name: str) -> DataFrame:
        """The view over tables dealt to many tasks (their columns, not the texts made of them, are shuffled), for heavy work on each row."""
        return view(self.spark, self.sf_dir, name, spread)


def query(sql: str | None = None) -> Callable:
    """Register a function of Views under its own name, and its oracle SQL if SQL can express it."""

    def register(make: Callable[[Views], DataFrame]) -> Callable[[Views], DataFrame]:
        name = make.__name__
        QUERIES[name] = lambda spark, sf_dir: make(Views(spark, sf_dir))
        if sql:
            ORACLES[name] = with_views(sql)
        return make

    return register
