"""N-gram Jaccard join with Bayesian pruning of candidates.

Texts are sets of five-word shingles. Texts with the same set are one node. Nodes that agree in
all rows of a MinHash band meet in a bucket; there their MinHash values are compared a few at a
time, and a pair is dropped once the posterior probability that its similarity reaches the
threshold is below a tolerance. The nodes that are left over form loose components; inside one,
the surviving pairs are verified on the full sets.

No pair is ever written out: buckets and components are cut into blocks of bounded bytes and numbers
of nodes, pairs of blocks are compared inside one task, a bounded run of pairs at a time, and what
leaves the task is a number of links per node and one link to the smallest node it hangs together
with. A group that holds a third of the table so is spread over many tasks.

Buckets only tell which nodes hang together. So every block of a large bucket is first compared
with itself and with the bucket's first block, which joins copies of one text in rows that grow with
the nodes; afterwards only nodes outside a bucket's largest component meet all of its blocks. Counting
all links of a component takes all pairs of its blocks.

With BANDS bands of ROWS rows a pair at the threshold of 0.8 misses every bucket with a
probability of 5e-8; the tolerance adds 1e-6 at most for each look.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prosemill.llm import frames
from prosemill.llm.components import components
from prosemill.llm.decontamination import words_of
from prosemill.llm.shared import kept

SHINGLE, THRESHOLD, TOLERANCE = 5, 0.8, 1e-6
BANDS, ROWS, LOOK = 32, 4, 16
FIRST_BANDS = 6
HASHES = BANDS * ROWS
#: Nodes of a bucket compared together; bytes of text and nodes of a component verified together.
BLOCK_NODES, BLOCK_BYTES, BLOCK_MEMBERS = 512, 2 << 20, 1024
#: Pairs looked at together, and hashes of words that a task remembers (memory, not results).
RUN_PAIRS, REMEMBERED = 200_000, 100_000

_random = np.random.default_rng(5)
_FACTORS = _random.integers(1, 1 << 63, HASHES, dtype=np.uint64) << np.uint64(1) | np.uint64(1)
_SHIFTS = _random.integers(0, 1 << 63, HASHES, dtype=np.uint64)
_PLACES = _random.integers(1, 1 << 63, SHINGLE, dtype=np.uint64) << np.uint64(1) | np.uint64(1)


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > REMEMBERED:
            self.clear()
        found = self[word] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        return found


HASH = WordHashes()


def forget() -> None:
    """Give up the hashes of this worker's words. (Workers find it by name, so it is their own.)"""
    HASH.clear()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingles(text: str) -> np.ndarray:
    """64-bit hashes of the distinct shingles of a text, sorted. A text of fewer words is one
    shingle; a text without words has none."""
    words = words_of(text)
    if not words:
        return np.zeros(0, dtype=np.uint64)
    hashes = np.fromiter(map(HASH.__getitem__, words), dtype=np.uint64, count=len(words))
    size = min(SHINGLE, len(words))
    total = np.zeros(len(words) - size + 1, dtype=np.uint64)
    for k in range(size):
        total += hashes[k : len(total) + k] * _PLACES[k]
    return np.unique(_mixed(total))


def minhashes(found: np.ndarray) -> np.ndarray:
    """The smallest value of each hash function over a set."""
    best = np.full(HASHES, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(found), 1024):  # pieces that stay in the processor's cache
        values = found[None, at : at + 1024] * _FACTORS[:, None] + _SHIFTS[:, None]
        np.minimum(best, values.min(axis=1), out=best)
    return best


def signature(text: str) -> tuple[bytes, int, bytes, list[int]]:
    """Key of the shingle set, its size, one byte of each MinHash value, and a number for each band."""
    found = shingles(text)
    if not len(found):
        return b"", 0, b"", []
    best = _mixed(minhashes(found))
    bands = best.reshape(BANDS, ROWS)
    mixed = np.zeros(BANDS, dtype=np.uint64)
    for k in range(ROWS):
        mixed = _mixed(mixed * np.uint64(31) + bands[:, k])
    mixed = _mixed(mixed + np.arange(BANDS, dtype=np.uint64))
    key = hashlib.blake2b(found.tobytes(), digest_size=16).digest()
    return key, len(found), best.astype(np.uint8).tobytes(), mixed.astype(np.int64).tolist()


def least_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> list[tuple[int, int]]:
    """For each number of compared values, the matches a pair needs to stay.

    With a uniform prior, the posterior probability of reaching the threshold after m matches in n
    is that of at most m successes in n + 1 trials at the threshold. One byte of a value is
    compared, so a match happens by chance once in 256.
    """
    chance = threshold + (1 - threshold) / 256
    out = []
    for n in range(LOOK, HASHES + 1, LOOK):
        total, m = 0.0, -1
        while total < tolerance:
            m += 1
            total += math.comb(n + 1, m) * chance**m * (1 - chance) ** (n + 1 - m)
        out.append((n, m))
    return out


LEAST = least_matches()


def surviving(values: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows that the Bayesian comparison does not drop."""
    matches = np.zeros(len(a), dtype=np.int16)
    for n, least in LEAST:
        look = slice(n - LOOK, n)
        matches += (values[a, look] == values[b, look]).sum(axis=1, dtype=np.int16)
        stay = matches >= least
        a, b, matches = a[stay], b[stay], matches[stay]
        if not len(a):
            break
    return a, b


def block_pairs(second: np.ndarray, crossing: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs to compare, in bounded runs: all of one block, or those across two blocks.

    `second` tells which rows belong to the second of two blocks. If one of the two has no rows
    there is nothing to compare; the pairs inside the other have a run of their own.
    """
    n = len(second)
    if crossing:
        left, right = np.flatnonzero(~second), np.flatnonzero(second)
        step = max(1, RUN_PAIRS // max(len(right), 1))
        if not len(right):
            return
        for at in range(0, len(left), step):
            some = left[at : at + step]
            yield np.repeat(some, len(right)), np.tile(right, len(some))
        return
    step = max(1, RUN_PAIRS // max(n, 1))
    for at in range(0, n, step):
        some = np.arange(at, min(n, at + step))
        sizes = n - 1 - some
        a = np.repeat(some, sizes)
        starts = np.cumsum(sizes) - sizes
        yield a, a + 1 + np.arange(len(a)) - np.repeat(starts, sizes)


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest row that each row hangs together with."""
    label = np.arange(n)
    while len(a):
        before = label.copy()
        low = np.minimum(before[a], before[b])
        for of in (a, b, before[a], before[b]):  # a row's label too, so that whole trees are hooked
            np.minimum.at(label, of, low)
        label = label[label]
        if (label == before).all():
            break
    return label


def joined(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest row that each row hangs together with, by what is known and some more pairs."""
    if not len(a):
        return label
    known = np.flatnonzero(label != np.arange(len(label)))
    return roots(len(label), np.concatenate([a, known]), np.concatenate([b, label[known]]))


def by_group(
    df: DataFrame, keys: list[str], order: list[str], fields: str, work: Callable[[list], list[list]], width: int
) -> DataFrame:
    """Rows with equal keys are brought together and handed to `work` as lists of columns.

    Groups must be bounded by the caller. Batches are cut at the groups' borders.
    """
    schema = frames.arrow_schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, rows = None, []
        out: list[list] = [[] for _ in range(width)]

        def flushed() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, schema, strict=True)], schema=schema)
            for column in out:
                column.clear()
            return made

        def finish() -> None:
            for column, more in zip(out, work(list(zip(*rows, strict=True))), strict=True):
                column.extend(more)

        try:
            for batch in batches:
                columns = [c.to_pylist() for c in batch.columns]
                for row in zip(*columns, strict=True):
                    group = row[: len(keys)]
                    if group != current:
                        if rows:
                            finish()
                        current, rows = group, []
                        if len(out[0]) > 5000:
                            yield flushed()
                    rows.append(row[len(keys) :])
            if rows:
                finish()
            if out[0]:
                yield flushed()
        finally:
            forget()

    placed = df.repartition(*keys).sortWithinPartitions(*keys, *order)
    return placed.mapInArrow(frames.handing_back(run), fields)


def _blocked(df: DataFrame, key: str, blocks: str, others: Column | None = None) -> DataFrame:
    """Each row once for every pair of blocks that its own block is part of, or for its pairs with
    the blocks in `others`, which may use `block`."""
    block = F.pmod(F.xxhash64("node"), F.col(blocks)).cast("int")
    every = F.sequence(F.lit(0), F.col(blocks).cast("int") - 1)
    rows = df.withColumn("block", block).withColumn("other", F.explode(every if others is None else others))
    return rows.select(
        key, F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
        (F.col("block") != F.col("other")).alias("crossing"), (F.col("block") > F.col("other")).alias("second"),
        *[c for c in df.columns if c not in (key, blocks)],
    )


def _compared(columns: list) -> list[list]:
    """One pair of blocks of a bucket: each node that survives with another, and the smallest such.
    Nodes that are known to hang together are not compared."""
    crossing, second, nodes, labels, values = columns
    node = np.array(nodes, dtype=np.int64)
    table = np.frombuffer(b"".join(values), dtype=np.uint8).reshape(len(node), HASHES)
    _, first, group = np.unique(np.array(labels, dtype=np.int64), return_index=True, return_inverse=True)
    known = first[group.reshape(-1)]
    label = joined(np.arange(len(node)), np.arange(len(node)), known)
    before = label
    for a, b in block_pairs(np.array(second), any(crossing)):
        apart = label[a] != label[b]
        label = joined(label, *surviving(table, a[apart], b[apart]))
    own = np.flatnonzero(label != before)
    return [node[own].tolist(), node[label[own]].tolist()]


class Sets:
    """The shingle sets of some nodes, as small numbers side by side."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets])
        _, local = np.unique(np.concatenate(sets), return_inverse=True)
        self.local = local.reshape(-1)
        self.ends = np.cumsum(self.sizes)
        self.marks = np.zeros(int(self.local.max()) + 1 if len(self.local) else 1, dtype=bool)

    def of(self, i: int) -> np.ndarray:
        return self.local[self.ends[i] - self.sizes[i] : self.ends[i]]

    def verified(self, left: np.ndarray, right: np.ndarray, threshold: float = THRESHOLD) -> tuple[np.ndarray, np.ndarray]:
        """Pairs whose similarity on the full sets reaches the threshold. `left` must be sorted."""
        if not len(left):
            return left, right
        keep = np.zeros(len(left), dtype=bool)
        borders = np.flatnonzero(np.append(True, left[1:] != left[:-1]))
        for start, stop in zip(borders, np.append(borders[1:], len(left)), strict=True):
            a = left[start]
            own = self.of(a)
            self.marks[own] = True
            for at in range(start, stop, 256):
                some = right[at : min(stop, at + 256)]
                together = np.concatenate([self.of(b) for b in some])
                begins = np.cumsum(self.sizes[some]) - self.sizes[some]
                both = np.add.reduceat(self.marks[together].astype(np.int64), begins)
                keep[at : at + len(some)] = both >= threshold * (self.sizes[a] + self.sizes[some] - both) - 1e-9
            self.marks[own] = False
        return left[keep], right[keep]


def _verified_block(columns: list) -> list[list]:
    """One pair of blocks of a component: nodes and different texts each node is linked to, and the
    smallest node it hangs together with. Pairs are verified and added up a run at a time."""
    crossing, second, nodes, values, variants, texts = columns
    node = np.array(nodes, dtype=np.int64)
    table = np.frombuffer(b"".join(values), dtype=np.uint8).reshape(len(node), HASHES)
    weights = np.array(variants, dtype=np.int64)
    sets = Sets([shingles(t) for t in texts])
    links, linked = np.zeros(len(node), dtype=np.int64), np.zeros(len(node), dtype=np.int64)
    label = np.arange(len(node))
    for a, b in block_pairs(np.array(second), any(crossing)):
        left, right = sets.verified(*surviving(table, a, b))
        links += np.bincount(left, minlength=len(node)) + np.bincount(right, minlength=len(node))
        np.add.at(linked, left, weights[right])
        np.add.at(linked, right, weights[left])
        label = joined(label, left, right)
    own = np.flatnonzero(links)
    return [node[own].tolist(), links[own].tolist(), linked[own].tolist(), node[label[own]].tolist()]


def _text() -> Column:
    return F.coalesce(F.col("row.text"), F.lit(""))


def _signatures(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every row as it is, with its place in the table; and its signature. Both are written once."""
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))
    rows = kept(rows.withColumn("place", F.monotonically_increasing_id()), "jaccard_rows")

    def prepare():
        def work(batch: list[str]) -> list:
            return list(map(list, zip(*map(signature, batch), strict=True)))

        return work

    texts = rows.select(F.col("row.doc_id").alias("doc_id"), "place", _text().alias("text"))
    texts = texts.withColumn("digest", F.unhex(F.md5("text")))
    signed = frames.map_texts(texts, "key binary, n int, sig binary, bands array<bigint>", prepare, finish=forget)
    return rows, kept(signed, "signatures")


def _met(nodes: DataFrame, labels: DataFrame | None, bands: int) -> tuple[DataFrame, DataFrame]:
    """Members (bucket, band, node, label) of the first bands, and buckets of more than one label."""
    if labels is None:
        known = nodes.withColumn("label", F.col("node"))
    else:
        known = nodes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    member = known.select("node", "label", F.posexplode(F.slice("bands", 1, bands)).alias("band", "bucket"))
    buckets = member.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("size"), F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("sum"), F.min("band").alias("band"),
        F.min("node").alias("first"), F.max("node").alias("last"),
        F.min("label").alias("low"), F.max("label").alias("high"),
    )
    return member, buckets.where("size > 1 AND low < high")


def _chosen(buckets: DataFrame) -> DataFrame:
    """Of buckets with the same nodes one is enough; and its number of blocks."""
    alike = buckets.groupBy("size", "sum", "first", "last").agg(F.min("bucket").alias("bucket"))
    return alike.select("bucket", F.ceil(F.col("size") / BLOCK_NODES).cast("int").alias("blocks"))


def _links(placed: DataFrame, nodes: DataFrame, others: Column) -> DataFrame:
    """Links (a, b) between nodes that survive the comparison in some pairs of blocks."""
    rows = placed.join(nodes.select("node", "sig"), "node")
    rows = rows.select("bucket", "blocks", "node", "label", "sig", *[c for c in ("minor", "mixed") if c in rows.columns])
    blocks = _blocked(rows, "bucket", "blocks", others).select("bucket", "low", "high", "crossing", "second", "node", "label", "sig")
    return by_group(blocks, ["bucket", "low", "high"], ["node"], "a bigint, b bigint", _compared, 2)


def _first_links(nodes: DataFrame) -> DataFrame:
    """A few bands join most of what belongs together: each block with itself and with the first."""
    member, buckets = _met(nodes, None, FIRST_BANDS)
    placed = member.join(_chosen(buckets), "bucket")
    block, blocks = F.col("block"), F.col("blocks")
    others = F.when(block == 0, F.sequence(F.lit(0), blocks - 1)).otherwise(F.array(F.lit(0), block))
    return kept(_links(placed, nodes, others), "loose")


def _other_links(nodes: DataFrame, labels: DataFrame) -> DataFrame:
    """Of all bands the buckets that hold several components can add to them. In a large one, the
    nodes outside its largest component meet all others: blocks without such a node need not meet."""
    member, buckets = _met(nodes, labels, BANDS)
    done = (F.col("band") < FIRST_BANDS) & (F.col("size") <= BLOCK_NODES)
    placed = kept(member.join(_chosen(buckets.where(~done)), "bucket").select("bucket", "blocks", "node", "label"), "placed")
    large = placed.where("blocks > 1")
    sizes = large.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("n"))
    largest = sizes.groupBy("bucket").agg(F.max_by("label", F.struct("n", "label")).alias("largest"))
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    marked = large.join(largest, "bucket").withColumn("minor", F.col("label") != F.col("largest")).drop("largest")
    mixed = marked.where("minor").groupBy("bucket").agg(F.collect_set(block).alias("mixed"))  # no more than its blocks
    marked = marked.join(mixed, "bucket")
    small = placed.where("blocks = 1").withColumns({"minor": F.lit(True), "mixed": F.array().cast("array<int>")})
    others = F.when(F.col("minor"), F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.col("mixed"))
    return kept(_links(small.unionByName(marked), nodes, others), "loose")


def jaccard_classes(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All rows, and for each row its place, class and numbers of links.

    A class is a set of texts that hang together by links, a link joins two different shingle sets
    with a similarity of THRESHOLD or more. `class_id` is the smallest id in the class; `n_links`
    counts the sets a text is linked to; `n_text_links` the different texts it is linked to, those
    with the same set as its own among them; `keeper` is the place of the row that stands for the
    class. Texts without words are never linked, each row is a class of its own; null texts count
    as empty. Repeated rows and rows with the same set share class and links. Null ids sort last.
    Texts of any length are compared whole, one longer than a block in a block of its own; an empty
    table gives no rows. Other columns stay with the rows as they came.
    """
    rows, signed = _signatures(df)
    found = signed.where("n > 0").groupBy("key").agg(
        F.min("place").alias("place"), F.first("sig").alias("sig"), F.first("bands").alias("bands")
    )
    variants = signed.where("n > 0").select("key", "digest").distinct().groupBy("key").agg(F.count(F.lit(1)).alias("variants"))
    nodes = kept(found.join(variants, "key").withColumn("node", F.monotonically_increasing_id()), "nodes")

    first = _first_links(nodes)
    groups = components(first.unionByName(_other_links(nodes, components(first))))

    # verify inside each loose component
    at = nodes.select("node", "place", "sig", "variants").join(groups, "node")
    texts = kept(at.join(rows.select("place", _text().alias("text")), "place").select("label", "node", "sig", "variants", "text"), "members")
    by_bytes, by_nodes = F.sum(F.octet_length("text") + 200) / BLOCK_BYTES, F.count(F.lit(1)) / BLOCK_MEMBERS
    sizes = texts.groupBy("label").agg(F.ceil(F.greatest(by_bytes, by_nodes)).alias("blocks"))
    pieces = _blocked(texts.join(sizes, "label").select("label", "blocks", "node", "sig", "variants", "text"), "label", "blocks")
    checked = kept(
        by_group(pieces, ["label", "low", "high"], ["node"], "node bigint, links bigint, texts bigint, root bigint", _verified_block, 4),
        "verified",
    )
    links = checked.groupBy("node").agg(F.sum("links").alias("n_links"), F.sum("texts").alias("n_text_links"))
    labels = components(checked.select(F.col("node").alias("a"), F.col("root").alias("b")))
    linked = links.join(labels, "node")

    # back to all rows: by key to the node, by label to the class
    numbered = signed.select("doc_id", "place", "key", "n").where("n > 0").join(nodes.select("key", "node", "variants"), "key")
    entry = F.struct(F.col("doc_id").isNull().alias("gone"), "doc_id", "place")
    per_node = numbered.groupBy("node").agg(F.min(entry).alias("first"), F.first("variants").alias("variants")).join(linked, "node", "left")
    text_links = F.coalesce("n_text_links", F.lit(0)) + F.col("variants") - 1
    per_node = kept(per_node.select(
        "node", "first", F.coalesce("n_links", F.lit(0)).alias("n_links"), text_links.alias("n_text_links"), F.coalesce("label", "node").alias("label")
    ), "node_classes")
    firsts = per_node.groupBy("label").agg(F.min("first").alias("best"))
    classes = per_node.join(firsts, "label").select("node", "best", "n_links", "n_text_links")
    known = numbered.join(classes, "node").select("doc_id", "place", F.col("best.doc_id").alias("class_id"), "n_links", "n_text_links", F.col("best.place").alias("keeper"))
    none = F.lit(0).cast("bigint")
    alone = signed.where("n = 0").select("doc_id", "place", F.col("doc_id").alias("class_id"), none.alias("n_links"), none.alias("n_text_links"), F.col("place").alias("keeper"))
    return rows, known.unionByName(alone)


def jaccard_report(df: DataFrame) -> DataFrame:
    """One row per row: id, class, and the numbers of shingle sets and of different texts it is linked to."""
    return jaccard_classes(df)[1].select("doc_id", "class_id", "n_links", "n_text_links")


def one_per_class(df: DataFrame) -> DataFrame:
    """Of each class the row with the smallest id, with all its columns as they came."""
    rows, classes = jaccard_classes(df)
    dropped = classes.where("place != keeper").select("place")
    return rows.join(dropped, "place", "left_anti").select("row.*")
