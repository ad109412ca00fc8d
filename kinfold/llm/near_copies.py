"""Near copies: texts whose sets of five-word shingles have a Jaccard similarity of at least 0.8.

This is operator 8's method, SimHash fingerprints compared at the anchor points of a covering code, made wide enough for
such a similarity: two texts that are 0.8 alike differ in 15 % of their fingerprints' bits, which is 5 to 18 of 64.  A
fingerprint here has 384 bits of the distinct shingles, cut into TABLES blocks of 23.  A block is a point of the binary
Golay code, whose covering radius is 3; it is replicated to every code word within 4, one or six of them.  At an anchor all
fingerprints are compared in full, exactly, and linked at MAX_BITS or fewer differing bits.

What is missed: bits of two texts at exactly 0.8 differ with probability 0.151 (large sets); then a block's two points
share an anchor with probability 0.60, so that no anchor brings them together with probability 0.4 ** 16 = 4e-7.  It is
less for more similar texts and nothing for equal sets, and most, 6e-5, for four of five shingles (texts of eight and nine
words; 0.19 of the bits).  Either limit on bits is passed by fewer than 1 in 100,000 such pairs.

Sizes of texts that are 0.8 alike are, too: texts meet by table and power of two of their size, those just above a power
also below it.  The components of the links hold whole groups of near copies.  Inside a component similarities are computed
exactly, from the full sets, in rounds: some texts, the leaders, are compared to all others, chunk by chunk, and what they
link becomes groups.  Texts of the largest group need no comparison with each other; the next leaders are among all others
that have not led yet, until none is left.  So no link between groups is lost, none below 0.8 is made, no task holds more
than a chunk of a component, and a group of near copies of any size takes one or two rounds.  (Many groups that are alike,
but less than 0.8, take all their pairs.)

Texts that are equal byte for byte are one class (MD5) and are compared once.  Words are as in kinfold.llm.simhash:
separated by U+0020 and U+0009..U+000D, A-Z lower-cased; a text of fewer than five words is one shingle.

Cases: null, empty and blank texts have no shingles and are near copies of each other only; rows are told apart by
doc_id and text, so rows with one doc_id and unlike texts are judged each by its own text; rows with a null doc_id have
no place in an order and stay, and never make another row go; an empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from kinfold.llm.common import cut_lineage, give_back, settle, shuffle_partitions, text_runs, utf8_buffer
from kinfold.llm.simhash import HELD_LINKS, RUN_BYTES, block_anchors, forest, join_hot, shingle_hashes
from kinfold.operators.components import star_components

SHINGLE = 5
LEAST = 0.8
#: Blocks of 23 bits, and words of 64 bits that hold them.
TABLES, BLOCK, WORDS = 16, 23, 6
#: Differing bits at which fingerprints link, of all, and of the first two words, which are looked at first.
MAX_BITS, FIRST_BITS = 108, 45
#: Classes of one table and power of two that one bucket takes, about; more are dealt by anchor.
BUCKET_CLASSES = 2_000_000
#: Fingerprints at an anchor above which a hot group is looked for; comparisons held at once.
HOT, HELD_PAIRS = 256, 1_000_000
#: Members of a component that one task compares at once; leaders of a component in the first round, and in any.
CHUNK, LEADERS, MOST_LEADERS = 1000, 256, 4096
CLASS = "near_copy_class"


def wide_prints(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A row of WORDS words for each text; hashes: the distinct shingles of one text after the other, sizes: how many each
    has.  A bit is 1 if it is in over half of the text's shingles, each hashed once for every word."""
    prints = np.zeros((len(sizes), WORDS), np.uint64)
    some = np.flatnonzero(sizes)
    if not len(some):
        return prints
    # eight counters of a byte in a word: no part of a text has more than 255 shingles
    parts = -(-sizes[some] // 255)
    first = np.cumsum(parts) - parts
    at = np.repeat(np.cumsum(sizes[some]) - sizes[some], parts) + 255 * (np.arange(int(parts.sum())) - np.repeat(first, parts))
    rng = np.random.default_rng(5)
    masks, odds, more = rng.integers(0, 2**64, (3, WORDS), dtype=np.uint64) | np.uint64(1)
    ones = np.uint64(0x0101010101010101)
    for word in range(WORDS):
        x = (hashes ^ masks[word]) * odds[word]
        x = (x ^ (x >> np.uint64(32))) * more[word]
        x ^= x >> np.uint64(29)
        found = np.zeros(len(some), np.uint64)
        for k in range(8):
            counts = np.add.reduceat((x >> np.uint64(k)) & ones, at).view(np.uint8).reshape(-1, 8)
            votes = np.add.reduceat(counts, first, axis=0, dtype=np.int64)
            bits = (2 * votes > sizes[some][:, None]).astype(np.uint8)
            found |= bits.view(np.uint64).ravel() << np.uint64(k)
        prints[some, word] = found
    return prints


def block_of(prints: np.ndarray, table: int) -> np.ndarray:
    """The bits of a table's block."""
    word, shift = divmod(table * BLOCK, 64)
    bits = prints[:, word] >> np.uint64(shift)
    if shift + BLOCK > 64:
        bits = bits | prints[:, word + 1] << np.uint64(64 - shift)
    return (bits & np.uint64((1 << BLOCK) - 1)).astype(np.int64)


def text_class(text_col: str = "text") -> Column:
    return F.md5(F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary"))


def _printed(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, class, size, print) for every row of docs."""

    def work(batches):
        for batch in batches:
            for part in text_runs(batch, 2, RUN_BYTES):
                hashes, sizes = shingle_hashes(*utf8_buffer(part.column(2)), SHINGLE)
                # distinct shingles of each text
                text = np.repeat(np.arange(len(sizes)), sizes)
                order = np.lexsort((hashes, text))
                hashes, text = hashes[order], text[order]
                first = np.ones(len(hashes), bool)
                first[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
                sizes = np.bincount(text[first], minlength=len(sizes))
                prints = wide_prints(hashes[first], sizes).astype("<u8")
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(sizes, pa.int64()), pa.array([x.tobytes() for x in prints], pa.binary())], ["doc_id", "class", "size", "print"])
        give_back()

    id_type = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", text_class().alias("class"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(work, f"doc_id {id_type}, class string, size long, print binary")


def _near(prints: np.ndarray, sizes: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places (a, b) of all linked fingerprints, a of `rows` (ascending); sizes ascend.  Each pair at least once."""
    held_a, held_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    many = max(1, HELD_PAIRS // len(sizes))
    every = len(rows) == len(sizes)
    for lo in range(0, len(rows), many):
        some = rows[lo : lo + many]
        # a pair of two rows is met from its smaller one if all are rows
        x = lo if every else int(np.searchsorted(sizes, LEAST * sizes[some[0]] - 1e-9))
        y = int(np.searchsorted(sizes, sizes[some[-1]] / LEAST + 1e-9, "right"))
        bits = np.bitwise_count(prints[some, None, 0] ^ prints[None, x:y, 0])
        bits += np.bitwise_count(prints[some, None, 1] ^ prints[None, x:y, 1])
        a, b = np.nonzero(bits <= FIRST_BITS)
        a, b = some[a], b + x
        a, b = a[a != b], b[a != b]
        for k in range(0, len(a), HELD_PAIRS // 8):
            own, other = a[k : k + HELD_PAIRS // 8], b[k : k + HELD_PAIRS // 8]
            hit = np.bitwise_count(prints[own] ^ prints[other]).sum(1) <= MAX_BITS
            held_a.append(own[hit])
            held_b.append(other[hit])
        if sum(map(len, held_a)) > HELD_LINKS:
            joined = _forest(np.concatenate(held_a), np.concatenate(held_b))
            held_a, held_b = [joined[0]], [joined[1]]
    return np.concatenate(held_a), np.concatenate(held_b)


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    a, b = forest(a.astype(np.uint64), b.astype(np.uint64))
    return a.astype(np.int64), b.astype(np.int64)


def links_of(prints: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (a, b) that connect what all links between the fingerprints at an anchor connect; sizes ascend."""
    everyone = np.arange(len(sizes))
    if len(sizes) <= HOT:
        return _near(prints, sizes, everyone)
    # what a few link is one group whose members need no comparison with each other
    a, b = _near(prints, sizes, everyone[:: len(sizes) // 8])
    if not len(a):
        return _near(prints, sizes, everyone)
    node, root = _forest(a, b)
    label = everyone.copy()
    label[node] = root
    rest = np.flatnonzero(label != np.argmax(np.bincount(label)))
    if 2 * len(rest) > len(sizes):  # half the pairs of all are fewer
        return _near(prints, sizes, everyone)
    c, d = _near(prints, sizes, rest) if len(rest) else (a[:0], b[:0])
    return np.concatenate([node, c]), np.concatenate([root, d])


def links_at_anchors(blocks: np.ndarray, prints: np.ndarray, sizes: np.ndarray, deal: int = 1, turn: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Links (a, b) that connect what the links at a table's anchors do; only anchors that are `turn` modulo `deal`."""
    which, anchor = block_anchors(blocks)
    if deal > 1:
        mine = _dealt(anchor, deal) == turn
        which, anchor = which[mine], anchor[mine]
    order = np.lexsort((sizes[which], anchor))
    which, anchor = which[order], anchor[order]
    cuts = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1], [True]])) if len(anchor) else np.zeros(1, np.int64)
    held_a, held_b, held = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0
    for x, y in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        if y - x > 1:
            here = which[x:y]
            a, b = links_of(prints[here], sizes[here])
            if len(a):
                held_a.append(here[a])
                held_b.append(here[b])
                held += len(a)
            if held > HELD_LINKS:
                a, b = _forest(np.concatenate(held_a), np.concatenate(held_b))
                held_a, held_b, held = [a], [b], len(a)
    return np.concatenate(held_a), np.concatenate(held_b)


def _dealt(anchor: np.ndarray, deal: np.ndarray | int) -> np.ndarray:
    return (anchor >> 11) % deal


def _power(sizes: np.ndarray) -> np.ndarray:
    """0 for no shingles, 1 for one, 2 for two and three, and so on."""
    return np.frexp(sizes.astype(np.float64))[1].astype(np.int64)


def _edges(a: np.ndarray, b: np.ndarray) -> list[pa.Array]:
    """As few edges as connect what the links (a, b) connect."""
    a, b = forest(a.astype(np.uint64), b.astype(np.uint64))
    return [pa.array(a.astype(np.int64)), pa.array(b.astype(np.int64))]


def candidates(classes: DataFrame) -> DataFrame:
    """Edges (src, dst) between classes (node, size, print) that connect all that may be near copies."""
    power = F.when(F.col("size") > 0, F.length(F.bin("size"))).otherwise(0)
    deals = np.ones(64, np.int64)
    for r in classes.groupBy(power.alias("power")).agg(F.count("*").alias("n")).collect():
        deals[r.power] = -(-r.n // BUCKET_CLASSES)

    def spread(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            names, sizes = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            prints = np.frombuffer(b"".join(batch.column(2).to_pylist()), "<u8").reshape(-1, WORDS)
            # the least size that is near enough may lie below the next power
            own, low = _power(sizes), _power(np.ceil(LEAST * sizes - 1e-9))
            also = np.flatnonzero(low != own)
            place, powers = np.concatenate([np.arange(len(sizes)), also]), np.concatenate([own, low[also]])
            for table in range(TABLES):
                which, turn = np.arange(len(place)), 0
                if deals[powers].max() > 1:
                    which, anchor = block_anchors(block_of(prints[place], table))
                    turn = _dealt(anchor, deals[powers[which]])
                bucket = (turn * 64 + powers[which]) * TABLES + table
                bucket, which = np.divmod(np.unique(bucket * len(place) + which), len(place))
                some = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
                cuts, rows = [*some.tolist(), len(bucket)], place[which]
                sent = (names[rows].astype("<i8"), sizes[rows].astype("<i8"), prints[rows])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(bucket[some])] + [pa.array([x[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary()) for x in sent],
                    ["bucket", "names", "sizes", "prints"],
                )

    def link(table: pa.Table) -> pa.Table:
        names, sizes, prints = (np.frombuffer(b"".join(table.column(c).to_pylist()), kind) for c, kind in (("names", "<i8"), ("sizes", "<i8"), ("prints", "<u8")))
        prints = prints.reshape(-1, WORDS)
        rest, number = divmod(table.column("bucket")[0].as_py(), TABLES)
        turn, power = divmod(rest, 64)
        a, b = links_at_anchors(block_of(prints, number), prints, sizes, int(deals[power]), turn)
        return pa.Table.from_arrays(_edges(names[a], names[b]), ["src", "dst"])

    few = classes.select("node", "size", "print")
    return few.mapInArrow(spread, "bucket long, names binary, sizes binary, prints binary").groupBy("bucket").applyInArrow(link, "src long, dst long")


def linked(members: list[np.ndarray], leaders: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (member, leader) of sets (distinct hashes, ascending) that are near copies.  Exact."""
    sizes = np.array([len(x) for x in members])
    known, tokens = np.unique(np.concatenate(members), return_inverse=True)
    some = np.flatnonzero(sizes)
    starts = (np.cumsum(sizes) - sizes)[some]
    a, b = [], []
    for k, leader in enumerate(leaders):
        at = np.minimum(np.searchsorted(known, leader), max(len(known) - 1, 0))
        mark = np.zeros(len(known), bool)
        mark[at[known[at] == leader] if len(known) else at] = True
        shared = np.zeros(len(sizes), np.int64)
        if len(some):
            shared[some] = np.add.reduceat(mark[tokens], starts, dtype=np.int64)
        # two empty sets are equal
        hit = np.flatnonzero(shared >= LEAST * (sizes + len(leader) - shared) - 1e-9)
        a.append(hit)
        b.append(np.full(len(hit), k))
    return np.concatenate(a), np.concatenate(b)


def compare(members: pa.Table, leaders: pa.Table) -> pa.Table:
    """Edges (src, dst) that connect what the links of a bucket's leaders with its members connect; chunk by chunk."""
    out_a, out_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    if members.num_rows and leaders.num_rows:
        spans = []
        columns = []
        for table in (members, leaders):
            table = table.sort_by([("component", "ascending"), ("chunk", "ascending")])
            key = list(zip(table.column("component").to_pylist(), table.column("chunk").to_pylist(), strict=True))
            heads = [k for k in range(len(key)) if not k or key[k] != key[k - 1]]
            spans.append({key[x]: (x, y) for x, y in zip(heads, [*heads[1:], len(key)], strict=True)})
            columns.append((table.column("node").to_numpy(), [np.frombuffer(x, "<u8") for x in table.column("shingles").to_pylist()]))
        (names, sets), (own_names, own_sets) = columns
        for key, (c, d) in spans[1].items():
            if key not in spans[0]:
                continue
            x, y = spans[0][key]
            a, b = linked(sets[x:y], own_sets[c:d])
            out_a.append(names[x:y][a])
            out_b.append(own_names[c:d][b])
    return pa.Table.from_arrays(_edges(np.concatenate(out_a), np.concatenate(out_b)), ["src", "dst"])


def _sets(docs: DataFrame, classes: DataFrame, found: DataFrame) -> DataFrame:
    """Rows (component, node, n, chunks, chunk, shingles) of the classes of found (node, component)."""
    sized = found.groupBy("component").agg(F.count("*").alias("n"))
    chunks = F.ceil(F.col("n") / CHUNK).cast("int")
    named = join_hot(found, sized, "component", "n").withColumn("chunks", chunks)
    first = classes.select("node", "class", "doc_id").join(named, "node").select("class", F.col("doc_id").alias("first_id"), "component", "node", "n", "chunks")
    texts = docs.select(F.col("doc_id").alias("own_id"), text_class().alias("own_class"), F.col("text").cast("string").alias("text"))
    texts = texts.join(first, (F.col("own_class") == F.col("class")) & F.col("own_id").eqNullSafe(F.col("first_id")))

    def work(batches):
        for batch in batches:
            for part in text_runs(batch, 4, RUN_BYTES):
                hashes, sizes = shingle_hashes(*utf8_buffer(part.column(4)), SHINGLE)
                sets = [np.unique(x).astype("<u8").tobytes() for x in np.split(hashes, np.cumsum(sizes)[:-1])]
                yield pa.RecordBatch.from_arrays([*part.columns[:4], pa.array(sets, pa.binary())], ["component", "node", "n", "chunks", "shingles"])
        give_back()

    rows = texts.select("component", "node", "n", "chunks", "text").mapInArrow(work, "component long, node long, n long, chunks int, shingles binary")
    # a repeated row is there twice
    return rows.dropDuplicates(["node"]).withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))


def _verified(docs: DataFrame, classes: DataFrame, found: DataFrame) -> DataFrame:
    """Rows (node, component) of the classes of found (node, component) that have a near copy, in exact groups."""
    members = settle(_sets(docs, classes, found))
    buckets = 2 * shuffle_partitions(docs.sparkSession)
    bucket = F.pmod(F.xxhash64("component", "chunk"), F.lit(buckets)).cast("int").alias("bucket")
    largest_component = members.agg(F.max("n")).first()[0] or 0
    waiting, edges, led, most = members.select("component", "node", "chunk"), None, None, LEADERS
    while True:
        by_node = lambda *keys: Window.partitionBy(*keys).orderBy("node")
        picked = waiting.withColumn("r", F.row_number().over(by_node("component", "chunk"))).where(F.col("r") <= most)
        picked = picked.withColumn("r", F.row_number().over(by_node("component"))).where(F.col("r") <= most).select("component", "node")
        picked = cut_lineage(picked)
        leaders = members.join(picked, ["component", "node"], "left_semi").withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        # renamed to themselves, as both sides come from one table
        dealt = lambda rows: rows.select(bucket, *(F.col(c).alias(c) for c in ("component", "chunk", "node", "shingles"))).groupBy("bucket")
        new = dealt(members).cogroup(dealt(leaders)).applyInArrow(compare, "src long, dst long")
        edges = cut_lineage(new if edges is None else edges.unionByName(new))
        grouped = star_components(edges)
        if largest_component <= LEADERS:  # all have led
            return grouped
        led = picked if led is None else led.unionByName(picked)
        labels = members.where(F.col("n") > LEADERS).select("component", "n", "node", "chunk")
        labels = labels.join(grouped.select("node", F.col("component").alias("label")), "node", "left").withColumn("label", F.coalesce("label", "node"))
        labels = cut_lineage(labels)
        sizes = labels.groupBy("component", "label").agg(F.count("*").alias("own"))
        main = sizes.groupBy("component").agg(F.max(F.struct("own", "label")).alias("main"), F.sum("own").alias("all"))
        main = main.select("component", F.col("main.label").alias("main"), "all")
        rest = join_hot(labels, main, "component", "all").where("label != main").join(led, ["component", "node"], "left_anti")
        waiting = cut_lineage(rest.select("component", "node", "chunk"))
        if waiting.isEmpty():
            return grouped
        most = min(4 * most, MOST_LEADERS)


def groups(docs: DataFrame) -> DataFrame:
    """Rows (class, doc_id, n, component) for each class of equal texts: its least doc_id (null if it has none), the rows
    that have it, and a number for its group of near copies."""
    by_id = _printed(docs).groupBy("class", "doc_id").agg(F.count("*").alias("n"), F.min("size").alias("size"), F.min("print").alias("print"))
    least = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n")))
    classes = by_id.groupBy("class").agg(least.alias("first"), F.min("size").alias("size"), F.min("print").alias("print"))
    # written, so that the numbers stay
    classes = settle(classes.select(F.monotonically_increasing_id().alias("node"), "class", F.col("first.doc_id").alias("doc_id"), F.col("first.n").alias("n"), "size", "print"))
    found = _verified(docs, classes, star_components(candidates(classes)))
    named = classes.select("node", "class", "doc_id", "n").join(found, "node", "left")
    return named.select("class", "doc_id", "n", F.coalesce("component", "node").alias("component"))


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of docs, all columns, that come first by (doc_id, text's MD5) in their group of near copies; one row of
    those with the same doc_id and text.  Rows with a null doc_id stay."""
    first = groups(docs).where("doc_id IS NOT NULL").groupBy("component").agg(F.min(F.struct("doc_id", "class", "n")).alias("first"))
    kept = settle(first.select("first.doc_id", F.col("first.class").alias(CLASS), "first.n"))
    rows = docs.withColumn(CLASS, text_class())
    once = rows.join(kept.where("n = 1"), ["doc_id", CLASS], "left_semi")
    again = rows.join(kept.where("n > 1"), ["doc_id", CLASS], "left_semi").dropDuplicates(["doc_id", CLASS])
    return once.unionByName(again).unionByName(rows.where("doc_id IS NULL")).select(docs.columns)
