"""SimHash near-duplicates found through the anchor points of a covering code.

A fingerprint has 64 bits; two link if they differ in at most `max_bits` = 4.  The bits are cut into three blocks of 22,
21 and 21 bits.  Of at most four differing bits, some two blocks hold at most two.  For each pair of blocks the anchors
are the pairs of binary Golay code words (each block padded to 23 bits): the code's covering radius is 3, so every block
has one code word within 3.  A fingerprint is replicated to every anchor within the covering radius plus the threshold,
which the triangle inequality lets us halve: of two fingerprints that differ in at most two bits of the joined blocks,
the point half way is at most one bit from each, so its anchor is within 3 of each block but one, where it is within 4.
That makes at most 11 anchors a pair of blocks, and a fingerprint meets about one in 2.8 million of the others at each.
At an anchor all fingerprints are compared in full, exactly.

Texts with equal fingerprints count once.  What an anchor's comparison gives is a spanning forest of its links, which
has fewer edges than the anchor has fingerprints; components come from the distributed star algorithm.

Cases: null, empty and blank texts have the fingerprint zero, which links like any other; doc_id may repeat (one row
out for each row in) and be null (never the smallest; a component of null ids only has a null id); an empty table gives
an empty table; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.llm.common import Words, cut_lineage, give_back, shuffle_partitions, text_runs, utf8_buffer
from kinfold.operators.components import star_components

SHINGLE = 4
MAX_BITS = 4
#: Fixed value: the generator polynomial of the binary Golay code of length 23.
GOLAY = 0b110001110101
#: First bit and number of bits of each block.
BLOCKS = ((0, 22), (22, 21), (43, 21))
#: Texts are hashed in runs of about this many bytes; a longer text is a run of its own.
RUN_BYTES = 2_000_000
#: Keys with more than this share of the rows are few enough to be broadcast: SHARES at most.
SHARES = 10_000
#: A column that names a row.
ROW = "row_of_simhash"
#: Links held before they are reduced to a forest.
HELD_LINKS = 2_000_000


def shingle_hashes(data: np.ndarray, offsets: np.ndarray, shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of the shingles of each text of a buffer, one text after the other, and how many each text has."""
    words = Words(data, offsets, lower=True)
    sizes = np.where(words.counts >= shingle, words.counts - shingle + 1, np.minimum(words.counts, 1))
    texts = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(texts)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    head = words.first[texts] + place
    tail = head + np.minimum(words.counts[texts], shingle) - 1
    raw, digest = memoryview(words.data.tobytes()), xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(raw[a:b], 42) for a, b in zip(words.starts[head].tolist(), words.ends[tail].tolist(), strict=True)), np.uint64, len(head))
    return hashes, sizes


def text_fingerprints(data: np.ndarray, offsets: np.ndarray, shingle: int = SHINGLE) -> np.ndarray:
    """The fingerprint of each text of a buffer."""
    hashes, sizes = shingle_hashes(data, offsets, shingle)
    out = np.zeros(len(sizes), np.uint64)
    some = np.flatnonzero(sizes)
    if len(some):
        at = np.concatenate([[0], np.cumsum(sizes[some])])
        votes = np.zeros((len(some), 64), np.int64)
        # as many rows of bits at a time as fit in a few MB; a long text is summed in parts
        for a in range(0, len(hashes), 100_000):
            part = np.unpackbits(hashes[a : a + 100_000].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            lo, hi = np.searchsorted(at, a, "right") - 1, np.searchsorted(at, a + len(part), "left")
            cuts = np.maximum(at[lo:hi] - a, 0)
            votes[lo:hi] += np.add.reduceat(part, cuts, axis=0, dtype=np.int64)
        bits = 2 * votes > sizes[some][:, None]
        out[some] = np.packbits(bits, axis=1, bitorder="little").view(np.uint64).ravel()
    return out


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """Rows (doc_id, fingerprint): a signed long with the 64 bits."""

    def work(batches):
        for batch in batches:
            for part in text_runs(batch, 1, RUN_BYTES):
                prints = text_fingerprints(*utf8_buffer(part.column(1)), shingle)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(prints.view(np.int64))], ["doc_id", "fingerprint"])
        give_back()

    id_type = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(work, f"doc_id {id_type}, fingerprint long")


def _syndrome(words: np.ndarray) -> np.ndarray:
    left = words.astype(np.int64).copy()
    for bit in range(22, 10, -1):
        left ^= ((left >> bit) & 1) * (GOLAY << (bit - 11))
    return left


def _golay_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By syndrome: the lightest error; the errors of weight 4, and how many there are (5 or none)."""
    one = _syndrome(1 << np.arange(23))
    light, heavy, many = np.zeros(2048, np.int64), np.zeros((2048, 5), np.int64), np.zeros(2048, np.int64)
    bit = 1 << np.arange(23)
    i = np.arange(23)
    light[one] = bit
    a, b = np.triu_indices(23, 1)
    light[one[a] ^ one[b]] = bit[a] | bit[b]
    a3, b3, c3 = (x.ravel() for x in np.meshgrid(i, i, i, indexing="ij"))
    ok = (a3 < b3) & (b3 < c3)
    a3, b3, c3 = a3[ok], b3[ok], c3[ok]
    light[one[a3] ^ one[b3] ^ one[c3]] = bit[a3] | bit[b3] | bit[c3]
    for d in range(23):
        ok = c3 < d
        syndromes, errors = one[a3[ok]] ^ one[b3[ok]] ^ one[c3[ok]] ^ one[d], bit[a3[ok]] | bit[b3[ok]] | bit[c3[ok]] | bit[d]
        for s, e in zip(syndromes.tolist(), errors.tolist(), strict=True):
            heavy[s, many[s]] = e
            many[s] += 1
    return light, heavy, many


_TABLES = None


def anchors(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The anchors of distinct fingerprints (uint64): index of the fingerprint, and anchor."""
    global _TABLES
    if _TABLES is None:
        _TABLES = _golay_tables()
    light, heavy, many = _TABLES
    home, near, n_near = [], [], []
    for first, size in BLOCKS:
        block = ((prints >> np.uint64(first)) & np.uint64((1 << size) - 1)).astype(np.int64)
        s = _syndrome(block)
        home.append(block ^ light[s])
        near.append(block[:, None] ^ heavy[s])
        n_near.append(many[s])
    which, found = [], []
    everyone = np.arange(len(prints))
    for table, (a, b) in enumerate(((0, 1), (0, 2), (1, 2))):
        base = np.int64(table) << 46
        which.append(everyone)
        found.append(base | home[a] << 23 | home[b])
        for k in range(5):
            for moved, kept, shift, other in ((a, b, 23, 0), (b, a, 0, 23)):
                some = np.flatnonzero(n_near[moved] > k)
                which.append(some)
                found.append(base | near[moved][some, k] << shift | home[kept][some] << other)
    return np.concatenate(which), np.concatenate(found)


def block_anchors(block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The code words within 4 of each 23-bit point: index of the point, and code word."""
    global _TABLES
    if _TABLES is None:
        _TABLES = _golay_tables()
    light, heavy, many = _TABLES
    s = _syndrome(block)
    which, found = [np.arange(len(block))], [block ^ light[s]]
    for k in range(5):
        some = np.flatnonzero(many[s] > k)
        which.append(some)
        found.append(block[some] ^ heavy[s[some], k])
    return np.concatenate(which), np.concatenate(found)


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (node, root) that connect what the links (a, b) connect."""
    nodes, inverse = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = inverse[: len(a)], inverse[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = root.copy()
        rx, ry = root[x], root[y]
        np.minimum.at(low, rx, ry)
        np.minimum.at(low, ry, rx)
        while not np.array_equal(low, low[low]):
            low = low[low]
        new = low[root]
        if np.array_equal(new, root):
            break
        root = new
    some = root != np.arange(len(nodes))
    return nodes[some], nodes[root[some]]


def links_at_anchors(anchor: np.ndarray, prints: np.ndarray, max_bits: int = MAX_BITS) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links between fingerprints that share an anchor."""
    order = np.argsort(anchor, kind="stable")
    anchor, prints = anchor[order], prints[order]
    size = np.diff(np.append(np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]])), len(anchor)))
    left_in_group = np.repeat(np.cumsum(size), size) - np.arange(len(anchor)) - 1
    held_a, held_b, held, step = [], [], 0, 1
    at = np.flatnonzero(left_in_group >= 1)
    while len(at):
        linked = at[np.bitwise_count(prints[at] ^ prints[at + step]) <= max_bits]
        held_a.append(prints[linked])
        held_b.append(prints[linked + step])
        held += len(linked)
        if held > HELD_LINKS:
            a, b = forest(np.concatenate(held_a), np.concatenate(held_b))
            held_a, held_b, held = [a], [b], len(a)
        step += 1
        at = at[left_in_group[at] >= step]
    if not held:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    return forest(np.concatenate(held_a), np.concatenate(held_b))


def links(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Edges (src, dst) that connect the distinct fingerprints as the links do."""
    if not 0 <= max_bits <= MAX_BITS:
        raise ValueError(f"the anchors cover up to {MAX_BITS} differing bits, not {max_bits}")
    buckets = 2 * shuffle_partitions(prints.sparkSession)

    def spread(batches):
        for batch in batches:
            own = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            which, anchor = anchors(own)
            bucket = ((anchor.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64) % buckets
            order = np.argsort(bucket, kind="stable")
            cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
            a, p = anchor[order].astype("<i8"), own[which[order]].astype("<u8")
            some = np.flatnonzero(np.diff(cuts))
            yield pa.RecordBatch.from_arrays(
                [pa.array(some.astype(np.int32))] + [pa.array([x[cuts[k] : cuts[k + 1]].tobytes() for k in some.tolist()], pa.binary()) for x in (a, p)],
                ["bucket", "anchors", "prints"],
            )

    def compare(table: pa.Table) -> pa.Table:
        anchor, own = (np.frombuffer(b"".join(table.column(c).to_pylist()), kind) for c, kind in (("anchors", "<i8"), ("prints", "<u8")))
        a, b = links_at_anchors(anchor, own, max_bits)
        return pa.table({"src": a.view(np.int64), "dst": b.view(np.int64)})

    return prints.select("fingerprint").mapInArrow(spread, "bucket int, anchors binary, prints binary").groupBy("bucket").applyInArrow(compare, "src long, dst long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """Rows (doc_id, fingerprint, component_id) for every row of docs; fingerprint is a signed long."""
    rows = cut_lineage(fingerprints(docs, id_col, text_col, shingle))
    classes = cut_lineage(rows.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n")))
    found = star_components(links(classes, max_bits)).withColumnRenamed("node", "fingerprint")
    joined = cut_lineage(classes.join(found, "fingerprint", "left"))
    # fingerprints without a link name themselves
    linked = joined.where("component IS NOT NULL")
    named = linked.groupBy("component").agg(F.min("first_id").alias("component_id"), F.count("*").alias("n_prints"))
    lone = joined.where("component IS NULL").select("fingerprint", "n", F.col("first_id").alias("component_id"))
    by_print = lone.unionByName(join_hot(linked, named, "component", "n_prints").select("fingerprint", "n", "component_id"))
    return join_hot(rows, by_print, "fingerprint", "n").select("doc_id", "fingerprint", "component_id")


def join_hot(many: DataFrame, few: DataFrame, key: str, count: str) -> DataFrame:
    """many joined with few, which has one row a key and the number of its rows in many.

    Keys with more than 1 / SHARES of the rows, of which there can't be more than SHARES, are broadcast; the rest is dealt
    by key.
    """
    few = cut_lineage(few)
    total = few.agg(F.sum(count)).first()[0] or 0
    hot = F.broadcast(few.where(F.col(count) * SHARES > total))
    return many.join(hot, key).unionByName(many.join(hot.select(key), key, "left_anti").join(few.where(F.col(count) * SHARES <= total), key))


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of docs, all columns, that come first by (doc_id, text's MD5) in their group of near-duplicates; one row
    of those with the same doc_id and text.  Rows with a null doc_id have no place in an order and stay."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    row = F.struct(F.col("doc_id").isNull().alias("unnamed"), F.col("doc_id").alias("id"), F.md5(text.cast("binary")).alias("md5"))
    found = near_duplicates(docs.select(row.alias("doc_id"), "text"))
    kept = cut_lineage(found.where("doc_id = component_id AND NOT doc_id.unnamed").groupBy(F.col("doc_id").alias(ROW)).agg(F.count("*").alias("n")))
    rows = docs.withColumn(ROW, row)
    once = rows.join(kept.where("n = 1"), ROW, "left_semi")
    again = rows.join(kept.where("n > 1"), ROW, "left_semi").dropDuplicates([ROW])
    return once.unionByName(again).unionByName(rows.where("doc_id IS NULL")).select(docs.columns)
