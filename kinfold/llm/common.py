"""Helpers that the operators share: shared folders, flat text buffers, gathers."""

from __future__ import annotations

import ctypes
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinfold.operators.components import ensure_checkpoint_dir


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write df to the shared checkpoint folder and go on from the files."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def settle(df: DataFrame) -> DataFrame:
    """cut_lineage; then what the shuffles before it wrote is deleted, as Spark does when the JVM collects garbage."""
    df = cut_lineage(df)
    df.sparkSession.sparkContext._jvm.System.gc()
    return df


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def write_stage(df: DataFrame, folder: str) -> DataFrame:
    """df written as Parquet to a folder, and read from it."""
    df.write.mode("overwrite").parquet(folder)
    return df.sparkSession.read.parquet(folder)


def new_shared_folder(spark: SparkSession) -> str:
    """A name in the shared checkpoint folder that no other run uses."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


#: Rows of a batch between the JVM and Python; rows here are texts, of a few KB on average.
BATCH_ROWS = 1000


def text_batches(spark: SparkSession) -> SparkSession:
    """The session with Arrow batches fit for rows of text, if their size is Spark's default."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(name) == "10000":
        spark.conf.set(name, BATCH_ROWS)
    return spark


def give_back() -> None:
    """Return freed memory of this Python worker, which Spark keeps for later tasks, to the machine."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not every C library can
        pass


def total_text_bytes(docs: DataFrame, text_col: str) -> int:
    return docs.agg(F.sum(F.octet_length(text_col).cast("long"))).first()[0] or 0


def utf8_buffer(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All texts of a column (null: empty) as one byte array, and the offsets of the texts."""
    if isinstance(column, pa.ChunkedArray):
        parts = [utf8_buffer(c) for c in column.chunks]
        if len(parts) == 1:
            return parts[0]
        sizes = [np.diff(o) for _, o in parts]
        lengths = np.concatenate(sizes) if sizes else np.zeros(0, np.int64)
        data = np.concatenate([d for d, _ in parts]) if parts else np.zeros(0, np.uint8)
        return data, np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    kind = np.int64 if wide else np.int32
    if offsets is None or len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offs = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offs[0] : offs[-1]], offs - offs[0]


def text_runs(batch: pa.RecordBatch, column: int, run_bytes: int):
    """The batch in slices whose texts have about run_bytes together."""
    _, offsets = utf8_buffer(batch.column(column))
    a = 0
    while a < batch.num_rows:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + run_bytes, "right")) - 1)
        yield batch.slice(a, b - a)
        a = b


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The concatenation of arange(s, s + n) for all s, n."""
    lengths = np.asarray(lengths, np.int64)
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total, dtype=np.int64) + np.repeat(np.asarray(starts, np.int64) - (ends - lengths), lengths)


def space_mask(data: np.ndarray) -> np.ndarray:
    """Where the separators of words are."""
    return (data == 0x20) | ((data >= 0x09) & (data <= 0x0D))


class Words:
    """The words of a run of texts, each followed by one space in `data`.

    starts, ends: of each word in data; counts: words of each text; first: index of each text's first word.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = False):
        data = np.insert(data, offsets[1:], 0x20)
        stops = offsets[1:] + np.arange(1, len(offsets))
        gap = space_mask(data)
        keep = ~gap
        keep[1:] |= ~gap[:-1]
        if len(keep):
            keep[0] = not gap[0]
        is_end = gap & keep
        data[is_end] = 0x20
        if lower:
            upper = (data >= 0x41) & (data <= 0x5A)
            data[upper] += 0x20
        before = np.concatenate([[0], np.cumsum(is_end)])[stops]
        self.counts = np.diff(np.concatenate([[0], before]))
        self.first = before - self.counts
        self.data = data[keep]
        self.ends = np.flatnonzero(self.data == 0x20)
        self.starts = np.concatenate([[0], self.ends[:-1] + 1]).astype(np.int64) if len(self.ends) else self.ends
