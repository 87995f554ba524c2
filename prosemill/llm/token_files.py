"""Token ids of a corpus as one run of numbers, kept as wavelet matrices, one per shard.

Documents are placed by ranges of their ids, so shard after shard holds the corpus in order. A
shard closes at a document's end once it has enough tokens; its image holds the ids of its
documents, their lengths and the matrix, and answers access, counting and occurrence lookup on
its own. Spark writes the images, so any store it can write to will do.
"""

from __future__ import annotations

import itertools
import json
import os
import string
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from prosemill.llm import frames
from prosemill.llm.wavelet import WaveletMatrix

#: A shard closes when it holds so many tokens.
SHARD_TOKENS = 1 << 20
#: Bytes that remembered words may take in a worker (memory, not results), and bytes of texts that
#: are encoded together.
REMEMBERED_BYTES, TOGETHER_BYTES = 160 << 20, 8 << 20
SHARDS = "part int, shard int, n_tokens bigint, image binary"
DOCUMENTS = "part int, shard int, doc_id bigint, begin bigint, n_tokens bigint, ids_crc32 bigint"


def stem_of(word: str) -> str:
    """A word without the ASCII punctuation behind its letters, in small letters if it is ASCII.
    The tokenizer cuts there too and does not tell letters' cases apart; other words stay whole."""
    stem = word.rstrip(string.punctuation)
    if not (stem.isalpha() and stem.lower().isalpha()):  # a small form may hold a mark
        return word
    return stem.lower() if stem.isascii() else stem


def listed(words: pa.Array) -> list[str]:
    """The words as a list; much faster by way of numpy."""
    return words.to_numpy(zero_copy_only=False).tolist()


def cut(words: pa.Array) -> tuple[pa.Array, pa.Array]:
    """Stems and tails of the words."""
    plain = pc.ascii_rtrim(words, string.punctuation)
    stems = pc.if_else(pc.ascii_is_alpha(plain), pc.ascii_lower(plain), words)  # right for words in ASCII
    wide = pc.invert(pc.string_is_ascii(words))
    if pc.any(wide).as_py():
        stems = pc.replace_with_mask(stems, wide, pa.array(list(map(stem_of, listed(words.filter(wide)))), pa.string()))
    starts, sizes = pc.binary_length(stems).to_numpy(), pc.binary_length(words).to_numpy()
    tails = pa.repeat("", len(words))
    longer = pa.array(sizes > starts)
    if pc.any(longer).as_py():
        some = zip(listed(words.filter(longer)), (starts - sizes)[sizes > starts].tolist(), strict=True)
        tails = pc.replace_with_mask(tails, longer, pa.array([w[n:] for w, n in some], pa.string()))  # ASCII, a byte each
    return stems, tails


def gathered(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Runs of the values, one behind the other."""
    ends = np.cumsum(sizes, dtype=np.int64)
    places = np.arange(ends[-1] if len(ends) else 0, dtype=np.int64)
    places += np.repeat(starts - (ends - sizes), sizes)
    return values[places]


class WordEncoder:
    """Ids by the tokenizers library, word by word: right for a tokenizer that drops white space,
    never joins across it, cuts letters from punctuation and lower-cases. Texts are cut at ASCII
    blanks (the library drops all others) and their words numbered in Arrow; each distinct stem and
    tail is encoded by the library once, and remembered within a bound of bytes."""

    def __init__(self, tokenizer: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_buffer(tokenizer)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        vocabulary = self.tokenizer.get_vocab()
        self.kind = np.uint16 if len(vocabulary) <= 1 << 16 else np.uint32
        suffix = json.loads(tokenizer)["model"].get("end_of_word_suffix")
        #: Which ids end a word, if the model marks them.
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        if suffix:
            self.ends[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
        self._forget()

    def _forget(self) -> None:
        """Row 0 is the empty word, which has no ids."""
        self.rows: dict[str, int] = {"": 0}
        self.ids = np.zeros(0, dtype=self.kind)
        self.starts = self.sizes = np.zeros(1, dtype=np.int64)
        self.size = 0

    def _by_library(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, and how many each has. Words of letters are encoded as one text if the
        ids tell where a word ends, all others in one call as words."""
        if self.ends.any() and all(map(str.isalpha, words)):
            found = self.tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0]
            ids = np.array(found.ids, dtype=self.kind)
            last = np.flatnonzero(self.ends[ids])
            if len(last) == len(words):
                return ids, np.diff(last, prepend=-1)
        found = self.tokenizer.encode(words, is_pretokenized=True, add_special_tokens=False)
        ids = np.array(found.ids, dtype=self.kind)
        return ids, np.bincount(np.array(found.word_ids, dtype=np.int64), minlength=len(words))

    def _learn(self, words: list[str]) -> None:
        plain = [w for w in words if w.isalpha()]
        for some in (plain, [w for w in words if not w.isalpha()] if len(plain) < len(words) else []):
            if some:
                ids, sizes = self._by_library(some)
                self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(sizes) - sizes])
                self.sizes = np.concatenate([self.sizes, sizes])
                self.ids = np.concatenate([self.ids, ids])
                self.rows.update(zip(some, range(len(self.rows), len(self.sizes)), strict=True))
                self.size += frames.ENTRY_BYTES * len(some) + sum(map(len, some)) + ids.nbytes

    def _places(self, parts: pa.Array) -> np.ndarray:
        """The row of each stem or tail."""
        numbered = parts.dictionary_encode()
        distinct = listed(numbered.dictionary)
        self._learn(list(itertools.filterfalse(self.rows.__contains__, distinct)))
        rows = np.fromiter(map(self.rows.__getitem__, distinct), dtype=np.int64, count=len(distinct))
        return rows[numbered.indices.to_numpy()]

    def encode(self, texts: list[str] | pa.Array, end: int) -> list[np.ndarray]:
        if self.size > REMEMBERED_BYTES:
            self._forget()
        split = pc.ascii_split_whitespace(pa.array(texts, pa.string()) if isinstance(texts, list) else texts)
        numbered = split.flatten().dictionary_encode()
        stems, tails = cut(numbered.dictionary)
        pairs = np.stack([self._places(stems), self._places(tails)], axis=1)
        # ids of each distinct word, and behind them the end as one more word
        each = self.sizes[pairs]
        of_words = gathered(self.ids, self.starts[pairs].reshape(-1), each.reshape(-1))
        sizes = np.append(each.sum(axis=1), 1)
        starts = np.cumsum(sizes) - sizes
        # the words of the texts in order, an end behind those of each
        counts = pc.list_value_length(split).to_numpy(zero_copy_only=False)
        ends = np.cumsum(counts + 1) - 1
        order = np.full(len(numbered) + len(counts), len(numbered.dictionary))
        inside = np.ones(len(order), dtype=bool)
        inside[ends] = False
        order[inside] = numbered.indices.to_numpy()
        sizes = sizes[order]
        tokens = gathered(np.append(of_words, np.array(end, dtype=self.kind)), starts[order], sizes)
        borders = np.cumsum(sizes)[ends].tolist()
        return [tokens[a:b] for a, b in zip([0, *borders], borders, strict=False)]


@lru_cache(maxsize=2)
def encoder(tokenizer: bytes) -> WordEncoder:
    return WordEncoder(tokenizer)


def image_of(doc_ids: list[int | None], lengths: list[int], tokens: np.ndarray) -> bytes:
    """A shard's image: number of documents, their ids, which ids are null, lengths, then the matrix."""
    ids = np.array([d or 0 for d in doc_ids], dtype="<i8")
    null = np.array([d is None for d in doc_ids], dtype=np.uint8)
    head = zlib.compress(ids.tobytes() + null.tobytes() + np.array(lengths, dtype="<i8").tobytes(), 1)
    return struct.pack("<QQ", len(doc_ids), len(head)) + head + WaveletMatrix.of(tokens).to_bytes()


def open_image(image: bytes) -> tuple[list[int | None], np.ndarray, WaveletMatrix]:
    """Document ids, their lengths in tokens, and the matrix of a shard."""
    n, size = struct.unpack_from("<QQ", image)
    head = zlib.decompress(image[16 : 16 + size])
    ids = np.frombuffer(head, dtype="<i8", count=n).tolist()
    null = np.frombuffer(head, dtype=np.uint8, count=n, offset=8 * n)
    lengths = np.frombuffer(head, dtype="<i8", count=n, offset=9 * n)
    return [None if gone else i for i, gone in zip(ids, null, strict=True)], lengths, WaveletMatrix.from_bytes(image[16 + size :])


def write_token_files(
    df: DataFrame, tokenizer: bytes, end: int, path: str, shard_tokens: int = SHARD_TOKENS
) -> None:
    """Encode every document, add the end id to each, and write the shards under `path`.

    A null text counts as empty (the end id alone); repeated rows are written each, ordered by
    text; a null id comes first; a text of any length stays in one shard; an empty table gives
    no shards. The tokenizer is a fixed small file, sent to every executor once.
    """
    sent = df.sparkSession.sparkContext.broadcast(tokenizer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, shard, ids, runs = TaskContext.get().partitionId(), 0, [], []

        def closed() -> pa.RecordBatch:
            lengths = [len(r) for r in runs]
            image = image_of(ids, lengths, np.concatenate(runs))
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([shard], pa.int32()),
                 pa.array([sum(lengths)], pa.int64()), pa.array([image], pa.binary())],
                schema=frames.arrow_schema(SHARDS))

        full = 0
        with frames.no_collector():
            for batch in batches:
                for rows in frames.slices(batch, limit=TOGETHER_BYTES):
                    encoded = encoder(sent.value).encode(rows.column("text"), end)
                    for doc_id, tokens in zip(rows.column("doc_id").to_pylist(), encoded, strict=True):
                        ids.append(doc_id)
                        runs.append(tokens)
                        full += len(tokens)
                        if full >= shard_tokens:
                            yield closed()
                            shard, ids, runs, full = shard + 1, [], [], 0
            if ids:
                yield closed()

    placed = frames.texts(df).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    placed.mapInArrow(run, SHARDS).write.parquet(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files alone: where its tokens start in the corpus, how many there
    are, and crc32 of them as little-endian 32-bit numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                part, shard, image = (batch.column(c)[row].as_py() for c in ("part", "shard", "image"))
                ids, lengths, matrix = open_image(image)
                tokens = matrix.tokens().astype("<u4")
                ends = np.cumsum(lengths)
                begins = ends - lengths
                crcs = [zlib.crc32(tokens[a:b].tobytes()) for a, b in zip(begins, ends, strict=True)]
                columns = [[part] * len(ids), [shard] * len(ids), ids, begins, lengths, crcs]
                schema = frames.arrow_schema(DOCUMENTS)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    shards = spark.read.schema(SHARDS).parquet(path)
    documents = shards.select("part", "shard", "image").mapInArrow(run, DOCUMENTS)
    return (
        documents.join(_shard_starts(shards), ["part", "shard"])
        .select("doc_id", (F.col("first") + F.col("begin")).alias("start"), "n_tokens", "ids_crc32")
    )


def _shard_starts(shards: DataFrame) -> DataFrame:
    """Tokens before each shard: running totals within a part, and over the parts' totals."""
    sizes = shards.select("part", "shard", "n_tokens")
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    order = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("total").over(order), F.lit(0)).alias("in_parts"))
    inside = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("in_part", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    return sizes.join(parts, "part").select("part", "shard", (F.col("in_parts") + F.col("in_part")).alias("first"))
