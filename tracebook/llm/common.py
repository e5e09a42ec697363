"""What several operators share: reading tables, stored intermediates, chunks of bytes."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHUNK_BYTES = 4 << 20
MASK = (1 << 64) - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; a local session without one, as in tests, gets its own."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("name a folder that all executors share in spark.checkpoint.dir")
        named = f"file://{tempfile.mkdtemp(prefix='shared-')}"
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def stored(df: DataFrame) -> DataFrame:
    """Write an intermediate result to the shared folder and read it back.

    Later stages read columns of Parquet files that outlive executors instead of repeating
    the work, and the lineage ends there.
    """
    path = f"{shared_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def forget(df: DataFrame) -> None:
    """Delete the files of a stored table that nothing reads any more."""
    context = df.sparkSession.sparkContext
    jvm = context._jvm
    for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        if "/table-" in folder:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text modulo ``folds``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def chunks(texts: list[bytes | None], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of texts of about ``limit`` bytes; the position of the first goes along. Null: empty."""
    start, size, run = 0, 0, []
    for at, text in enumerate(texts):
        text = text or b""
        if run and size + len(text) > limit:
            yield start, run
            start, size, run = at, 0, []
        run.append(text)
        size += len(text)
    if run:
        yield start, run


def byte_texts(batch: pa.RecordBatch, name: str = "text") -> list[bytes | None]:
    """A string column as UTF-8 bytes, without decoding it."""
    return batch.column(batch.schema.get_field_index(name)).cast(pa.large_binary()).to_pylist()


def signed(values: np.ndarray) -> pa.Array:
    """64-bit patterns as Spark longs."""
    return pa.array(np.ascontiguousarray(values).view(np.int64))


class Memo(dict):
    """Values computed once per key; starts anew beyond ``limit`` keys, so it stays bounded."""

    def __init__(self, make, limit: int = 200_000):
        super().__init__()
        self.make, self.limit = make, limit

    def __missing__(self, key):
        value = self[key] = self.make(key)
        return value

    def trim(self) -> None:
        if len(self) > self.limit:
            self.clear()


def run_starts(sizes: np.ndarray) -> np.ndarray:
    """Where each of several concatenated runs starts."""
    return np.concatenate(([0], np.cumsum(sizes)[:-1])) if len(sizes) else np.zeros(0, np.int64)


def positions_within(sizes: np.ndarray) -> np.ndarray:
    """0, 1, 2, ... anew for each of several concatenated runs."""
    return np.arange(int(sizes.sum())) - np.repeat(run_starts(sizes), sizes)
