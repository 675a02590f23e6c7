"""Named queries over a folder of source tables, each with its SQL counterpart."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tallymill.plans.sql_views import VIEWS
from tallymill.session import scratch_path, stored
from tallymill.sources.lines import order_lines, source_table


@dataclass(frozen=True)
class Source:
    """What a query may read: the tables of one folder."""

    spark: SparkSession
    folder: str

    def lines(self, *columns: str) -> DataFrame:
        return order_lines(self.spark, self.folder, *columns)

    def table(self, name: str) -> DataFrame:
        return source_table(self.spark, self.folder, name)

    def scratch(self, label: str) -> str:
        return scratch_path(self.spark, label)


@dataclass(frozen=True)
class SourceOfLines(Source):
    """A source whose order lines, of some columns, are written already."""

    written: DataFrame

    def lines(self, *columns: str) -> DataFrame:
        return self.written.select(*columns)


def with_lines(source: Source, *columns: str) -> SourceOfLines:
    """``source`` with its lines put together and written once, for what reads them many times."""
    return SourceOfLines(source.spark, source.folder, stored(source.lines(*columns), "lines"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _with_views(sql: str) -> str:
    """Prefix the views that the text uses, and those they use in turn."""
    wanted: set[str] = set()

    def collect(text: str) -> None:
        for name in VIEWS:
            if name not in wanted and re.search(rf"\b{name}\b", text):
                wanted.add(name)
                collect(VIEWS[name])

    collect(sql)
    views = [f"{name} AS ({VIEWS[name]})" for name in VIEWS if name in wanted]
    recursive = "RECURSIVE " * any(re.search(rf"\b{name}\b", VIEWS[name]) for name in wanted)
    return f"WITH {recursive}{', '.join(views)} {sql}" if views else sql


def query(name: str, sql: str | None = None):
    """Register ``build(source)`` under ``name``, with its SQL if there is one."""
    def register(build: Callable[[Source], DataFrame]) -> Callable[[Source], DataFrame]:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return build(Source(spark, folder))

        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = _with_views(sql)
        return build

    return register
