"""Token counts of documents in flat token files that have no index.

A flat file is one run of fixed-width token ids in which an end-of-document id closes every document.  Files are read in
blocks of any size, without regard to where documents end.  Each block is searched by itself: the places of the
end-of-document id come from one vectorised comparison, their distances are the lengths of the documents that lie inside
the block, and what stands before the first and after the last is left over.  A prefix scan over the few numbers of each
block then joins the leftovers of neighbouring blocks and numbers the documents.

Cases: two separators in a row close an empty document; tokens after the last separator are a document that isn't closed
(closed = false), an empty rest is none; an empty file has no documents; null blocks count as empty; blocks are told
apart by (file, block), and of equal pairs the order doesn't matter only if their content is equal too; other columns
are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from kinfold.llm.common import Words, cut_lineage, new_shared_folder, remove_folder, text_runs, utf8_buffer

#: The end-of-document id of the files that `write_flat_files` makes.
END = 0xFFFFFFFF
BLOCK_TOKENS = 1 << 16
#: Files of at most this many bytes are read whole.
WHOLE_BYTES = 1 << 26
#: Runs of texts in a file that `write_flat_files` makes: about 20 MB of ids.
FILE_RUNS = 16
#: Texts are taken in runs of about this many bytes; a longer text is a run of its own.
RUN_BYTES = 1 << 21
#: Chunks of a file's blocks whose sums make up the prefix scan's upper level.
SCAN_WIDTH = 4096


def read_flat_files(spark: SparkSession, path: str, token_bytes: int = 4, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Flat files as rows (file, block, payload); path may name several files, or a folder.

    All files of WHOLE_BYTES at most are read by one scan, and cut into blocks of block_tokens ids.  A larger one is cut
    into equal records of at most block_tokens ids, which Spark reads by many tasks; such a file is a scan of its own.
    """
    listed = spark.read.format("binaryFile").load(path)
    sizes = listed.select("path", "length")  # no content
    for row in sizes.where(F.col("length") % token_bytes != 0).take(1):
        raise ValueError(f"{row.path} is no whole number of ids long")

    def cut(batches):
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                raw = memoryview(content.as_buffer())
                for k, a in enumerate(range(0, len(raw), block_tokens * token_bytes)):
                    yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([k], pa.int64()), pa.array([bytes(raw[a : a + block_tokens * token_bytes])], pa.binary())], ["file", "block", "payload"])

    parts = listed.where(F.col("length") <= WHOLE_BYTES).select("path", "content").mapInArrow(cut, "file string, block long, payload binary")
    for row in sizes.where(F.col("length") > WHOLE_BYTES).toLocalIterator():
        parts = parts.unionByName(_read_records(spark, row.path, row.length // token_bytes, token_bytes, block_tokens))
    return parts


def _read_records(spark: SparkSession, path: str, n_tokens: int, token_bytes: int, block_tokens: int) -> DataFrame:
    record = max(d for d in range(1, min(block_tokens, n_tokens) + 1) if n_tokens % d == 0)

    def numbered(part: int, records):
        return ((path, (part << 33) + k, bytes(r)) for k, r in enumerate(records))

    records = spark.sparkContext.binaryRecords(path, record * token_bytes)
    return spark.createDataFrame(records.mapPartitionsWithIndex(numbered), "file string, block long, payload binary")


def write_flat_files(docs: DataFrame, folder: str, text_col: str = "text") -> None:
    """The texts as flat files of hashed words, several for each partition of docs, in the order of its rows.

    A word's id is the low 32 bits of its XXH3 hash; END is kept for the ends of documents.  A row that goes to the sink is
    a run of documents without its last END, which the sink writes as its line separator.  The sink is Spark's own, so
    that a task that is lost and run again leaves no half of a file.
    """

    def work(batches):
        for batch in (part for whole in batches for part in text_runs(whole, 0, RUN_BYTES)):
            data, offsets = utf8_buffer(batch.column(0))
            words = Words(data, offsets)
            raw, digest = memoryview(words.data.tobytes()), xxhash.xxh3_64_intdigest
            ids = np.fromiter((digest(raw[a:b]) & END for a, b in zip(words.starts.tolist(), words.ends.tolist(), strict=True)), np.uint32, len(words.starts))
            ids[ids == END] = 0
            stream = np.insert(ids, words.first + words.counts, END)
            yield pa.RecordBatch.from_arrays([pa.array([stream[:-1].astype("<u4").tobytes()], pa.binary())], ["ids"])

    runs = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(work, "ids binary")
    sink = runs.select(F.col("ids").cast("string").alias("value")).write.mode("overwrite").option("compression", "none")
    # in Latin-1 a character is the byte of its number
    end = END.to_bytes(4, "little").decode("latin-1")
    sink.option("maxRecordsPerFile", FILE_RUNS).option("encoding", "ISO-8859-1").option("lineSep", end).text(folder)


def scan_blocks(blocks: DataFrame, end_id: int = END, token_bytes: int = 4) -> DataFrame:
    """Rows (file, block, n_tokens, n_ends, head, tail, inner): of each block, by itself.

    head: tokens before the first separator; tail: after the last (head where there is none); inner: lengths between.
    """
    kind = {1: "u1", 2: "<u2", 4: "<u4", 8: "<u8"}[token_bytes]

    def work(batches):
        for batch in batches:
            out = []
            for payload in batch.column(2):
                ids = np.frombuffer(payload.as_buffer(), kind) if payload.is_valid else np.zeros(0, kind)
                ends = np.flatnonzero(ids == end_id)
                out.append((len(ids), len(ends), int(ends[0]) if len(ends) else len(ids), len(ids) - int(ends[-1]) - 1 if len(ends) else len(ids), (np.diff(ends) - 1).tolist()))
            columns = list(zip(*out, strict=True)) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(c, pa.int64()) for c in columns[:4]), pa.array(columns[4], pa.list_(pa.int64()))], ["file", "block", "n_tokens", "n_ends", "head", "tail", "inner"])

    return blocks.select("file", "block", "payload").mapInArrow(work, "file string, block long, n_tokens long, n_ends long, head long, tail long, inner array<long>")


def document_lengths(scanned: DataFrame) -> DataFrame:
    """scan_blocks' rows stitched: rows (file, ordinal, n_tokens, closed), ordinals from 0 in each file.

    The prefix scan has two levels, so that no task holds more than a chunk of a file's blocks at the lower one.
    """
    numbered = scanned.withColumn("chunk", F.floor(F.col("block") / SCAN_WIDTH))
    # what is open at the end of a run of blocks: all of it if the run has no separator, else what follows the last one
    inside = Window.partitionBy("file", "chunk").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    ends_before = F.coalesce(F.sum("n_ends").over(inside), F.lit(0))
    local = numbered.withColumn("ends_before", ends_before)
    # blocks since the last separator share its number of ends
    since = Window.partitionBy("file", "chunk", "ends_before").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    last_tail = F.last(F.when(F.col("n_ends") > 0, F.col("tail")), ignorenulls=True).over(inside)
    whole_since = F.coalesce(F.sum(F.when(F.col("n_ends") == 0, F.col("n_tokens")).otherwise(0)).over(since), F.lit(0))
    local = local.withColumn("open_before", whole_since + F.coalesce(last_tail, F.lit(0)))
    chunk = local.groupBy("file", "chunk").agg(
        F.sum("n_ends").alias("chunk_ends"),
        F.max_by(F.when(F.col("n_ends") > 0, F.col("tail")).otherwise(F.col("open_before") + F.col("n_tokens")), "block").alias("chunk_open"),
    )
    upper = Window.partitionBy("file").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = chunk.withColumn("earlier_ends", F.coalesce(F.sum("chunk_ends").over(upper), F.lit(0)))
    same = Window.partitionBy("file", "earlier_ends").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    closed_open = F.last(F.when(F.col("chunk_ends") > 0, F.col("chunk_open")), ignorenulls=True).over(upper)
    carried = carried.withColumn("carry", F.coalesce(F.sum(F.when(F.col("chunk_ends") == 0, F.col("chunk_open")).otherwise(0)).over(same), F.lit(0)) + F.coalesce(closed_open, F.lit(0)))
    joined = local.join(carried.select("file", "chunk", "earlier_ends", "carry"), ["file", "chunk"])
    opened = F.col("open_before") + F.when(F.col("ends_before") == 0, F.col("carry")).otherwise(0)
    stitched = joined.withColumn("opened", opened).withColumn("first", F.col("earlier_ends") + F.col("ends_before"))
    lengths = F.concat(F.array(F.col("opened") + F.col("head")), F.col("inner"))
    closed = stitched.where("n_ends > 0").select("file", "first", F.posexplode(lengths).alias("at", "n_tokens")).select("file", (F.col("first") + F.col("at")).alias("ordinal"), "n_tokens", F.lit(True).alias("closed"))
    rest = stitched.withColumn("open_after", F.when(F.col("n_ends") > 0, F.col("tail")).otherwise(F.col("opened") + F.col("n_tokens")))
    rest = rest.groupBy("file").agg(F.max_by("open_after", "block").alias("n_tokens"), F.sum("n_ends").alias("ordinal")).where("n_tokens > 0")
    return closed.unionByName(rest.select("file", "ordinal", "n_tokens", F.lit(False).alias("closed")))


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, n_tokens): the texts written as flat files, counted by the scan, matched to their rows by order.

    docs must be read from files or a checkpoint, whose rows keep their order from one reading to the next.  The files lie in
    the shared folder and are removed after the scan.  Should a partition not hold as many rows as its files hold
    documents, the result raises, so that no row is lost unseen.
    """
    spark = docs.sparkSession
    folder = new_shared_folder(spark)
    write_flat_files(docs, folder, text_col)
    # the sink names its files by partition and place; a partition's files are one after the other in one run of blocks
    name = r"part-(\d+)-[^/]*-c(\d+)\.[a-z]+$"
    part, place = (F.regexp_extract("file", name, k).cast("long") for k in (1, 2))
    blocks = read_flat_files(spark, folder).select(part.cast("string").alias("file"), (F.shiftleft(place, 40) + F.col("block")).alias("block"), "payload")
    found = document_lengths(cut_lineage(scan_blocks(blocks)))  # what the scan keeps of a block is small
    remove_folder(spark, folder)
    row = F.monotonically_increasing_id()
    named = docs.select(F.col(id_col).alias("doc_id"), F.shiftright(row, 33).cast("string").alias("file"), row.bitwiseAND(F.lit((1 << 33) - 1)).alias("ordinal"), F.lit(True).alias("named"))
    counted = F.when(F.col("named").isNull() | F.col("n_tokens").isNull(), F.raise_error(F.lit("the rows changed between two readings")).cast("long")).otherwise(F.col("n_tokens"))
    return named.join(found, ["file", "ordinal"], "full").select("doc_id", counted.alias("n_tokens"))
