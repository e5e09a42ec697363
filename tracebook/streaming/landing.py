"""Archive files landed as a stream; the latest record per key wins on read.

No watermark is needed: recency is decided by the extraction time in the record, not by
arrival, so late and repeated files change nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tracebook.fixed_values import NATURAL_KEY
from tracebook.operators.picks import latest_per_key
from tracebook.schemas import RAW, RECORD
from tracebook.session import checkpointed
from tracebook.sources.scans import landing_rows

# as a partition column the bucket comes last and may be null
_STATE = T.StructType([*[T.StructField(f.name, f.dataType) for f in RAW.fields], T.StructField("bucket", T.IntegerType())])


def archive_stream(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """New archive files as a stream of nested records."""
    return (
        spark.readStream.schema(RECORD)
        .option("multiLine", True)
        .option("maxFilesPerTrigger", files_per_batch)
        .json(path)
    )


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64(*NATURAL_KEY), F.lit(buckets)).cast("int")


def merge_latest(batch: DataFrame, state: str, buckets: int = 256) -> None:
    """Merge landed rows into the latest row per natural key, kept in hash buckets under ``state``.

    Only the buckets that the batch touches are read and replaced. The latest row does not depend
    on the order of arrival, so a batch that is merged again, or late, changes nothing. The number
    of buckets belongs to the table; all its batches take the same. One batch at a time may merge.
    """
    spark = batch.sparkSession
    # an empty append makes the folder of the first batch
    spark.createDataFrame([], _STATE).write.mode("append").partitionBy("bucket").parquet(state)
    rows = batch.select(*RAW.fieldNames()).withColumn("bucket", _bucket(buckets))
    touched = [r.bucket for r in rows.select("bucket").distinct().collect()]  # at most ``buckets`` numbers
    if not touched:
        return
    held = spark.read.schema(_STATE).parquet(state).where(F.col("bucket").isin(touched))
    # stored before the write, which replaces the files that it is made of
    merged = checkpointed(latest_per_key(held.unionByName(rows)))
    merged.hint("rebalance", "bucket").write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy("bucket").parquet(state)


def latest_state(spark: SparkSession, state: str) -> DataFrame:
    """Latest row per natural key as merged so far, without reading what was landed."""
    return spark.read.schema(_STATE).parquet(state).select(*RAW.fieldNames())


def land_stream(
    records: DataFrame, table: str, rejects: str, checkpoint: str, state: str | None = None, buckets: int = 256
) -> StreamingQuery:
    """Land valid rows under ``table`` and invalid ones under ``rejects``, then stop.

    A batch owns its directories and overwrites them, so a batch that is run again after a
    failure leaves its rows once. With ``state`` the batch is merged there too.
    """

    def land(batch: DataFrame, batch_id: int) -> None:
        held = batch.persist()  # read by both writes
        valid, invalid = landing_rows(held)
        for rows, path in ((valid, table), (invalid, rejects)):
            # one file per year; static, so that a batch done again replaces all it left
            rows.hint("rebalance", "fiscal_year").write.mode("overwrite").option(
                "partitionOverwriteMode", "static"
            ).partitionBy("fiscal_year").parquet(f"{path}/batch_id={batch_id}")
        if state is not None:
            merge_latest(valid, state, buckets)
        held.unpersist()

    return (
        records.writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def landed_rows(spark: SparkSession, table: str) -> DataFrame:
    """Everything landed so far."""
    return (
        spark.read.schema(RAW).option("basePath", table).parquet(f"{table}/batch_id=*").select(*RAW.fieldNames())
    )


def latest_landed(spark: SparkSession, table: str) -> DataFrame:
    """Latest landed row per natural key."""
    return latest_per_key(landed_rows(spark, table))

