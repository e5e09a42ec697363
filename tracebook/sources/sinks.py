"""Sinks: append, reload, typed layers, JSON archive and snapshot documents."""

from __future__ import annotations

import uuid
from datetime import UTC, datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracebook.fixed_values import NATURAL_KEY
from tracebook.schemas import MARTS


def _write_counted(df: DataFrame, path: str, mode: str) -> int:
    """Write a table partitioned by fiscal year, counting the rows on their way."""
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    # rebalancing gathers the rows of a year in few files and splits a year that is too big
    # static: a reload replaces every year, whatever the session's overwrite mode
    counted.hint("rebalance", "fiscal_year").write.mode(mode).option(
        "partitionOverwriteMode", "static"
    ).partitionBy("fiscal_year").parquet(path)
    return int(seen.get["rows"])


def append_rows(df: DataFrame, path: str) -> int:
    """Append to the landing table; returns the number of rows, 0 for empty input."""
    return _write_counted(df, path, "append")


def reload_rows(df: DataFrame, path: str) -> int:
    """Replace the whole landing table."""
    return _write_counted(df, path, "overwrite")


def create_table(
    spark: SparkSession, name: str, schema: T.StructType, partition_by: tuple[str, ...] = ()
) -> None:
    """Create a typed, empty table unless it exists."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    partitions = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{partitions}")


def create_layers(spark: SparkSession, raw_schema: T.StructType) -> None:
    """The three layers with the raw landing table and the declared mart tables."""
    for layer in ("raw", "staging", "marts"):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")
    create_table(spark, "raw.disclosure_extracted", raw_schema, ("fiscal_year",))
    for name, schema in MARTS.items():
        create_table(spark, f"marts.{name}", schema)


def write_clustered(
    df: DataFrame,
    path: str,
    columns: tuple[str, ...] = (*NATURAL_KEY, "extraction_timestamp"),
    mode: str = "overwrite",
) -> None:
    """Write files that each cover a narrow range of the key, for data skipping.

    The range goes down to the extraction time, so that a ticker with very many rows is cut
    into many files.
    """
    df.repartitionByRange(*columns).sortWithinPartitions(*columns).write.mode(mode).parquet(path)


def as_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def as_table(df: DataFrame, name: str, schema: T.StructType | None = None) -> DataFrame:
    """Full refresh of a stored table; a declared one keeps its columns and types."""
    if schema is None:
        df.write.mode("overwrite").format("parquet").saveAsTable(name)
    else:
        create_table(df.sparkSession, name, schema)
        typed = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
        typed.write.mode("overwrite").insertInto(name)
    return df.sparkSession.table(name)


def new_version() -> str:
    """A name for the tables of one refresh; later ones sort behind earlier ones."""
    return f"{datetime.now(UTC):%Y%m%d%H%M%S%f}_{uuid.uuid4().hex[:8]}"


def version_table(database: str, name: str, version: str) -> str:
    return f"{database}.{name}__{version}"


def versions(spark: SparkSession, database: str, name: str) -> list[str]:
    """The stored versions of a table, oldest first, whole or left by a refresh that failed."""
    found = spark.sql(f"SHOW TABLES IN {database} LIKE '{name}__*'").select("tableName").collect()
    return sorted(row.tableName.removeprefix(f"{name}__") for row in found)


def switch_version(
    spark: SparkSession, database: str, names: tuple[str, ...], version: str, keep: int = 2
) -> None:
    """Let the views ``database.name`` show one stored version of their tables.

    All tables of the version must be there before the first view is switched. A switch changes
    the catalog only and is done view by view in the order of ``names``. Versions beyond the
    newest ``keep`` up to this one are dropped, unfinished ones among them; a query that still
    reads the version before goes on. A table that stood under a view's name is replaced.
    """
    missing = [n for n in names if not spark.catalog.tableExists(version_table(database, n, version))]
    if missing:
        raise ValueError(f"version {version} has no {', '.join(missing)}")
    for name in names:
        view, table = f"{database}.{name}", version_table(database, name, version)
        if spark.catalog.tableExists(view) and spark.catalog.getTable(view).tableType != "VIEW":
            spark.sql(f"DROP TABLE {view}")
        spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT * FROM {table}")
    for name in names:
        earlier = [v for v in versions(spark, database, name) if v <= version]
        for old in earlier[: max(0, len(earlier) - keep)]:
            spark.sql(f"DROP TABLE {version_table(database, name, old)}")


def write_archive(records: DataFrame, path: str, max_records: int = 100_000) -> None:
    """JSON lines with one directory per company and year (see ``scans.archive_lines``).

    Rebalancing makes small groups one file each and cuts a large one into several.
    """
    records.hint("rebalance", "company_ticker", "fiscal_year").write.mode("overwrite").option(
        "maxRecordsPerFile", max_records
    ).partitionBy("company_ticker", "fiscal_year").json(path)


def write_documents(documents: DataFrame, header: DataFrame, path: str) -> None:
    """Snapshot: a header document and one document per company part."""
    header.select(F.col("header").alias("value")).write.mode("overwrite").text(f"{path}/header")
    documents.write.mode("overwrite").json(f"{path}/companies")
