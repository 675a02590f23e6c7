"""Whole versions of the finished tables, with a manifest, switched in one step.

A version is written in full into a folder of its own, then its manifest (per
table: rows, digest, when it was computed), and only then one row into
``served``, which says what readers get. Spark commits that one small file by
renaming it, so a reader sees the old version or the new one, and a run that
fails half-way leaves the old one served. Going back is one more row.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymill.functions.unions import union_rows
from tallymill.sources.publish import CATALOG, sort_for_publish
from tallymill.sources.tables import read_table, write_table

MANIFEST = "version string, table_name string, rows long, digest string, computed_at timestamp"
SERVED = "version string, step long, served_at timestamp"
MISSING = "\\N"


def _text(column: str, kind: str) -> Column:
    """A value as any engine writes it: amounts with six places, dates by ISO."""
    value = F.col(f"`{column}`")
    if kind in ("double", "float") or kind.startswith("decimal"):
        value = value.cast("decimal(38,6)")
    return F.coalesce(value.cast("string"), F.lit(MISSING))


def contents(df: DataFrame, *columns: str) -> DataFrame:
    """One row: ``rows``, and a ``digest`` of the given columns that no order of rows changes.

    The digest is the sum of 60 bits of each row's MD5, so equal rows count as
    often as they come and partial sums combine before the shuffle.
    """
    kinds = dict(df.dtypes)
    text = F.concat_ws("|", *(_text(c, kinds[c]) for c in columns or df.columns))
    bits = F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("decimal(38,0)")
    return df.agg(
        F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(bits), F.lit(0)).cast("string").alias("digest")
    )


def contents_of(tables: Mapping[str, DataFrame], columns: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """(table_name, rows, digest) of several tables."""
    return union_rows(
        contents(df, *(columns or {}).get(name, ())).select(F.lit(name).alias("table_name"), "rows", "digest")
        for name, df in tables.items()
    )


def contents_sql(name: str, sql: str, columns: Sequence[str]) -> str:
    """The same row in plain SQL, over a query's result."""
    text = ", ".join(
        f"coalesce(CASE WHEN typeof({c}) = 'DOUBLE' OR typeof({c}) LIKE 'DECIMAL%'"
        f" THEN cast(try_cast({c} AS decimal(38,6)) AS varchar) ELSE cast({c} AS varchar) END, '{MISSING}')"
        for c in columns
    )
    return f"""SELECT '{name}' AS table_name, count(*) AS rows,
        cast(coalesce(sum(cast('0x' || substr(md5(concat_ws('|', {text})), 1, 15) AS bigint)), 0) AS varchar) AS digest
        FROM ({sql})"""


def _folder(root: str, version: str, table: str) -> str:
    return f"{root}/versions/{version}/{table}"


def _switch(spark: SparkSession, root: str, version: str, moment: dt.datetime) -> None:
    last = served_steps(spark, root).agg(F.max("step")).first()[0] or 0
    row = spark.createDataFrame([(version, last + 1, moment)], SERVED)
    row.coalesce(1).write.mode("append").parquet(f"{root}/served")


def publish_version(
    tables: Mapping[str, DataFrame], root: str, computed_at: dt.datetime, version: str | None = None
) -> str:
    """Write all tables with ``computed_at``, then the manifest, then switch; returns the version.

    Rows and digest come from the files as stored. The tables are read only
    here; empty ones are published as such. A name that is already used for a
    version is an error.
    """
    spark = next(iter(tables.values())).sparkSession
    version = version or f"{computed_at:%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:12]}"
    if any(c == "computed_at" for df in tables.values() for c in df.columns):
        raise ValueError("computed_at is set by publishing")
    stamp = F.lit(computed_at).cast("timestamp")
    for name, df in tables.items():
        rows = sort_for_publish(df.withColumn("computed_at", stamp), CATALOG.get(name, ()))
        write_table(rows, _folder(root, version, name), mode="error")
    stored = {name: read_table(spark, _folder(root, version, name)) for name in tables}
    manifest = contents_of(stored, {n: df.columns for n, df in tables.items()}).select(
        F.lit(version).alias("version"), "table_name", "rows", "digest", stamp.alias("computed_at")
    )
    write_table(manifest.coalesce(1), _folder(root, version, "manifest"), mode="error")
    _switch(spark, root, version, dt.datetime.now(dt.timezone.utc))
    return version


def served_steps(spark: SparkSession, root: str) -> DataFrame:
    """Every switch so far: (version, step, served_at); empty before the first."""
    files = spark.sparkContext._jvm.org.apache.hadoop.fs
    path = files.Path(f"{root}/served")
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], SERVED)
    return spark.read.schema(SERVED).parquet(f"{root}/served")


def served_version(spark: SparkSession, root: str) -> str | None:
    """The version that readers get now, or None before the first."""
    return served_steps(spark, root).agg(F.max_by("version", F.struct("step", "version"))).first()[0]


def read_manifest(spark: SparkSession, root: str, version: str | None = None) -> DataFrame:
    version = version or served_version(spark, root)
    if version is None:
        raise LookupError(f"nothing is served under {root}")
    return spark.read.schema(MANIFEST).parquet(_folder(root, version, "manifest"))


def served_tables(spark: SparkSession, root: str, version: str | None = None) -> dict[str, DataFrame]:
    """The tables of one version, the served one by default; never parts of two."""
    rows = read_manifest(spark, root, version).select("version", "table_name").collect()
    return {r["table_name"]: read_table(spark, _folder(root, r["version"], r["table_name"])) for r in rows}


def serve_again(spark: SparkSession, root: str, version: str) -> None:
    """Switch to an earlier version, which must have its manifest."""
    if read_manifest(spark, root, version).isEmpty():
        raise LookupError(f"version {version} has no tables")
    _switch(spark, root, version, dt.datetime.now(dt.timezone.utc))


def changed_tables(spark: SparkSession, root: str, version: str | None = None) -> DataFrame:
    """(table_name, rows, digest, stored_rows, stored_digest) where files differ from the manifest."""
    manifest = read_manifest(spark, root, version)
    tables = served_tables(spark, root, version)
    plain = {n: [c for c in df.columns if c != "computed_at"] for n, df in tables.items()}
    stored = contents_of(tables, plain).select(
        "table_name", F.col("rows").alias("stored_rows"), F.col("digest").alias("stored_digest")
    )
    return manifest.select("table_name", "rows", "digest").join(stored, "table_name", "left").filter(
        ~F.col("rows").eqNullSafe(F.col("stored_rows")) | ~F.col("digest").eqNullSafe(F.col("stored_digest"))
    )
