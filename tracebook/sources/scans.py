"""Typed scans: reference lists, record archives, the landing table, landed files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracebook.fixed_values import FILE_MAGIC, METRIC_CATALOGUE, REGISTRY_MAX_ENTRIES
from tracebook.functions.keys import parent_code
from tracebook.functions.rules import landing_limits, record_rules, registry_rules, split_valid, type_limits, validate
from tracebook.schemas import METRICS, RAW, RECORD, REGISTRY


def reference_list(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header row and declared column types."""
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)


def registry(spark: SparkSession, path: str) -> DataFrame:
    """Company registry; refuses a list that is empty, too long, or has a bad entry."""
    entries = validate(reference_list(spark, path, REGISTRY), registry_rules())
    entry = F.struct("ticker", "violations")
    # one pass; the first bad entries, not all of them, are named in the message
    found = entries.agg(
        F.count("*").alias("n"),
        F.count_if(F.size("violations") > 0).alias("n_broken"),
        F.slice(F.array_sort(F.collect_set(F.when(F.size("violations") > 0, entry))), 1, 5).alias("broken"),
    ).first()
    if found["n_broken"]:
        raise ValueError(f"invalid registry entries: {found['n_broken']}, among them {found['broken']}")
    if not 1 <= found["n"] <= REGISTRY_MAX_ENTRIES:
        raise ValueError(f"registry must have 1 to {REGISTRY_MAX_ENTRIES} entries, has {found['n']}")
    return entries.drop("violations")


def metric_catalogue(spark: SparkSession) -> DataFrame:
    """The built-in metric catalogue under parent codes."""
    rows = spark.createDataFrame(METRIC_CATALOGUE, "esrs_topic string, id string, name string, unit string")
    return rows.select(
        "esrs_topic",
        parent_code("id").alias("esrs_disclosure"),
        F.col("name").alias("metric_name"),
        "unit",
    ).to(METRICS)


def record_archive(spark: SparkSession, path: str) -> DataFrame:
    """Nested records from a directory of JSON files, each one array of records."""
    return spark.read.schema(RECORD).option("multiLine", True).json(path)


def archive_lines(spark: SparkSession, path: str) -> DataFrame:
    """Nested records from an archive of JSON lines, as ``sinks.write_archive`` leaves it.

    Files of lines are split among tasks, and company and year are taken from the
    directories, so that filters on them skip files.
    """
    return spark.read.schema(RECORD).json(path).select(*RECORD.fieldNames())


def flat_sources(records: DataFrame) -> DataFrame:
    """Nested records with the 14 landing columns in order, still in the types they came in."""
    sources = {
        "source_page": F.col("source_citation.page"),
        "source_snippet": F.col("source_citation.snippet"),
        "extraction_timestamp": F.coalesce("extraction_timestamp", F.current_timestamp()),
    }
    return records.select(*[sources.get(f.name, F.col(f.name)).alias(f.name) for f in RAW.fields])


def landing_types(rows: DataFrame) -> DataFrame:
    """The landing columns in their declared types, other columns behind; what does not fit is null."""
    declared = [F.col(f.name).try_cast(f.dataType).alias(f.name) for f in RAW.fields]
    return rows.select(*declared, *[c for c in rows.columns if c not in RAW.fieldNames()])


def flatten_records(records: DataFrame) -> DataFrame:
    """Nested records as flat landing rows, 14 columns in fixed order."""
    return landing_types(flat_sources(records))


def landing_rows(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid landing rows, invalid rows with their violations) of nested records.

    The rules look at the values as they came, before any of them is rounded or cast.
    """
    valid, invalid = split_valid(
        flat_sources(records), record_rules() | landing_limits() | type_limits()
    )
    return landing_types(valid), landing_types(invalid)


def archive_rows(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(valid landing rows, invalid rows) of an archive; the record rules apply again."""
    return landing_rows(record_archive(spark, path))


def raw_table(spark: SparkSession, path: str) -> DataFrame:
    """The landing table with its declared schema and explicit projection."""
    return spark.read.schema(RAW).parquet(path).select(*RAW.fieldNames())


def landed_files(spark: SparkSession, path: str, suffix: str = ".pdf") -> DataFrame:
    """Files of a directory with their key (the file name without its suffix)."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", f"*{suffix}").load(path)
    name = F.element_at(F.split("path", "/"), -1)
    return files.withColumn("file_key", F.substring(name, F.lit(1), F.length(name) - len(suffix)))


def admitted_files(
    files: DataFrame,
    landed: DataFrame,
    content: Column,
    key: str = "file_key",
    magic: bytes | str = FILE_MAGIC,
) -> DataFrame:
    """Non-empty files that start with the format's magic and have not been landed yet.

    ``landed(key, length)`` lists earlier files; one of zero length is done again.
    """
    starts = F.substring(content, 1, len(magic)) == F.lit(magic)
    done = landed.where(F.col("length") > 0).select(key)
    # the files' own length column is read without opening them
    filled = F.col("length") > 0 if "length" in files.columns else F.length(content) > 0
    return files.where(filled).join(done, key, "left_anti").where(starts)
