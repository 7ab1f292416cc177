"""Token-ID output: texts as token ids in Parquet list columns, and selective reads of them.

Layout under one folder:

* ``tokens/`` - one file per range of document ids, rows in ascending order of the id: ``doc_id``,
  ``shard`` (number of the file), ``first`` (ids of the shard before this row), ``n_tokens``,
  ``token_ids`` (array<int>, closed by the end id) and ``meta`` (struct of kept columns).
  The ids are dictionary encoded (a vocabulary fits one dictionary page, so an id takes as many bits
  as the vocabulary needs); the counters have no dictionary, so that the second writer version packs
  them as deltas. Row groups and pages have set sizes, and pages carry column indexes, so a read
  of some documents or some columns touches only their pages.
* ``manifest/`` - one row per shard: documents, tokens, and the ids of all shards before it.

Defined cases: a null or empty text is the end id alone; rows without an id come first; rows with the same
id keep their own row each, ordered by a hash of the text; an empty table gives empty files; columns
that are not kept are ignored, and kept ones sit inside ``meta``, so no name can clash.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlet.llm.text import FOLDED, SLICE_BYTES, mix, prepare, slices, span_hashes, tidied, word_spans

#: New words that are given to the library as one text, with a special token between them.
JOINED = 64
#: Words, and ids of them, that a worker remembers; beyond either it starts anew.
MEMO_WORDS = 1_000_000
MEMO_IDS = 6_000_000


_CLOSING = np.zeros(256, dtype=bool)
_CLOSING[list(b".,!?;:%$&*#")] = True
_ALPHANUMERIC = np.array([chr(i).isalnum() and i < 128 for i in range(256)])


def encoded_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and hashes of the spans that are encoded on their own, and the n + 1 span offsets of the texts.

    A word is cut before closing punctuation that follows an ASCII letter or digit, where the splitter
    cuts as well, and known by its lower-cased bytes, as the normalizer lower-cases; only words
    that might spell a special token, which is looked for before that, are known by their own bytes.
    """
    starts, ends, bounds = word_spans(data, offsets)
    if not len(starts):
        return starts, ends, np.zeros(0, np.uint64), bounds
    last_open = np.maximum.accumulate(np.where(_CLOSING[data], -1, np.arange(len(data))))
    core = np.maximum(last_open[ends - 1] + 1, starts)
    cut = (core > starts) & (core < ends) & _ALPHANUMERIC[data[core - 1]]
    second = np.flatnonzero(cut) + np.arange(1, cut.sum() + 1)
    span_starts = np.repeat(starts, 1 + cut)
    span_starts[second] = core[cut]
    span_ends = np.repeat(ends, 1 + cut)
    span_ends[second - 1] = core[cut]
    bounds = bounds + np.concatenate([[0], np.cumsum(cut)])[bounds]
    hashes = span_hashes(data, span_starts, span_ends, FOLDED)
    angle = np.concatenate([[0], np.cumsum(data == ord("<"))])
    special = np.flatnonzero(angle[span_ends] > angle[span_starts])
    if len(special):
        hashes[special] = mix(span_hashes(data, span_starts[special], span_ends[special]))
    return span_starts, span_ends, hashes, bounds


class WordEncoder:
    """Encodes texts with a ``tokenizers`` file that lower-cases and whose splitting never crosses white space.

    The normalizer and splitter of such a file treat each span of ``encoded_spans`` on its own,
    so each distinct one is encoded once by the library, and its ids are copied to
    every place it occurs in. Spans are known by a 64-bit hash.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        # A special token that is cut out before anything else looks at the text, with which words are joined.
        added = self._tokenizer.get_added_tokens_decoder()
        alters = ("normalized", "lstrip", "rstrip", "single_word")
        joiners = [(i, t.content) for i, t in sorted(added.items()) if t.special and not any(getattr(t, x) for x in alters)]
        self._joiner_id, self._joiner = joiners[0] if joiners else (-1, "")
        self._marks = {t.content[0] for t in added.values()}
        self._forget()

    def _forget(self) -> None:
        self._keys = np.zeros(0, np.uint64)  # sorted; _slots has the number of each
        self._slots = np.zeros(0, np.int64)
        self._starts = np.zeros(1, np.int64)  # of the ids of each slot
        self._ids = np.zeros(1 << 16, np.int32)

    def _encoded(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words, and how many each has. Joined words are encoded as fast as one text, and apart."""
        if not self._joiner or not all(map(self._marks.isdisjoint, words)):
            found = [e.ids for e in self._tokenizer.encode_batch_fast(words, add_special_tokens=False)]
            counts = np.array([len(ids) for ids in found], np.int64)
            return np.fromiter(chain.from_iterable(found), np.int32, counts.sum()), counts
        texts = [self._joiner.join(words[at : at + JOINED]) + self._joiner for at in range(0, len(words), JOINED)]
        found = self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        ids = np.concatenate([np.array(e.ids, np.int32) for e in found])
        ends = np.flatnonzero(ids == self._joiner_id)
        return np.delete(ids, ends), np.diff(ends, prepend=-1) - 1

    def _learn(self, keys: np.ndarray, words: list[str]) -> None:
        """Remember the ids of new words; ``keys`` ascend."""
        plain = np.fromiter(map(self._marks.isdisjoint, words), bool, len(words))
        for some in (np.flatnonzero(plain), np.flatnonzero(~plain)):
            for at in range(0, len(some), 10_000):
                part = some[at : at + 10_000]
                ids, counts = self._encoded([words[i] for i in part.tolist()])
                slots = len(self._keys) + np.arange(len(part))
                ends = self._starts[-1] + np.cumsum(counts)
                while ends[-1] > len(self._ids):
                    self._ids = np.concatenate([self._ids, np.zeros_like(self._ids)])
                self._ids[self._starts[-1] : ends[-1]] = ids
                self._starts = np.concatenate([self._starts, ends])
                place = np.searchsorted(self._keys, keys[part])
                self._slots = np.insert(self._slots, place, slots)
                self._keys = np.insert(self._keys, place, keys[part])

    def _slots_of(self, hashes: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        keys, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        at = np.searchsorted(self._keys, keys)
        new = np.ones(len(keys), bool)
        if len(self._keys):
            new = self._keys[np.minimum(at, len(self._keys) - 1)] != keys
        if new.any():
            raw = data.tobytes()
            spans = zip(starts[first[new]].tolist(), ends[first[new]].tolist())
            self._learn(keys[new], [raw[a:b].decode() for a, b in spans])
            at = np.searchsorted(self._keys, keys)
        return self._slots[at][inverse]

    def encode(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, each closed by ``end_id``, and the n + 1 offsets of the texts."""
        if len(self._keys) > MEMO_WORDS or self._starts[-1] > MEMO_IDS:
            self._forget()
        parts, counts = [], []
        for _, _, data, offsets in slices(texts):
            starts, ends, hashes, bounds = encoded_spans(data, offsets)
            slots = self._slots_of(hashes, data, starts, ends)
            sizes = (self._starts[1:] - self._starts[:-1])[slots]
            before = np.concatenate([[0], np.cumsum(sizes)])
            source = np.repeat(self._starts[:-1][slots] - before[:-1], sizes) + np.arange(before[-1])
            parts.append(np.insert(self._ids[source], before[bounds[1:]], end_id))
            counts.append(np.diff(before[bounds]) + 1)
        ids = np.concatenate(parts) if parts else np.zeros(0, np.int32)
        return ids, np.concatenate([[0], np.cumsum(np.concatenate(counts))]) if counts else np.zeros(1, np.int64)


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def _parts(batch: pa.RecordBatch, text: str) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in runs of a few slices of text."""
    sizes = pc.binary_length(batch.column(text).fill_null("")).to_numpy(zero_copy_only=False)
    groups = np.cumsum(sizes) // (4 * SLICE_BYTES)
    edges = [0, *(np.flatnonzero(np.diff(groups)) + 1), batch.num_rows]
    for a, b in zip(edges[:-1], edges[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def write_tokens(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: tuple[str, ...] = (),
    row_group_bytes: int = 32 << 20,
    page_bytes: int = 256 << 10,
) -> None:
    """Encode ``docs`` and write the layout above to ``path`` (replaced if present)."""
    spark = docs.sparkSession
    prepare(spark)
    id_type = docs.schema[id_col].dataType
    meta = F.struct(*[F.col(c) for c in keep]) if keep else F.struct(F.lit(None).cast("int").alias("none"))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), meta.alias("meta"))
    tie = F.xxhash64("text", "meta")
    ranged = rows.repartitionByRange("doc_id", tie).sortWithinPartitions(F.asc("doc_id"), tie)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, first = TaskContext.get().partitionId(), 0
        names = ["doc_id", "shard", "first", "n_tokens", "token_ids", "meta"]
        for whole in batches:
            for part in _parts(whole, "text"):
                ids, bounds = encoder(tokenizer).encode(part.column("text"), end_id)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array(np.full(part.num_rows, shard, np.int32)),
                        pa.array(first + bounds[:-1]),
                        pa.array(np.diff(bounds)),
                        pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids)),
                        part.column("meta"),
                    ],
                    names,
                )
                first += int(bounds[-1])

    schema = T.StructType(
        [
            T.StructField("doc_id", id_type),
            T.StructField("shard", T.IntegerType()),
            T.StructField("first", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("token_ids", T.ArrayType(T.IntegerType())),
            T.StructField("meta", rows.schema["meta"].dataType),
        ]
    )
    writer = ranged.mapInArrow(tidied(encode), schema).write.mode("overwrite").option("compression", "zstd")
    settings = {
        "parquet.block.size": row_group_bytes,
        "parquet.page.size": page_bytes,
        "parquet.writer.version": "PARQUET_2_0",
        "parquet.enable.dictionary": "true",
        "parquet.enable.dictionary#doc_id": "false",
        "parquet.enable.dictionary#first": "false",
        "parquet.enable.dictionary#n_tokens": "false",
        "parquet.page.write-checksum.enabled": "true",
    }
    for name, value in settings.items():
        writer = writer.option(name, value)
    writer.parquet(f"{path}/tokens")

    shards = (
        spark.read.parquet(f"{path}/tokens")
        .groupBy("shard")
        .agg(F.count("*").alias("docs"), F.sum("n_tokens").alias("tokens"))
    )
    # One row per written file, so one task is enough.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards.withColumn("offset", F.coalesce(F.sum("tokens").over(before), F.lit(0).cast("long"))).coalesce(
        1
    ).write.mode("overwrite").parquet(f"{path}/manifest")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The written rows with ``start``, the ids of all documents before. Unread columns and pages stay on disk."""
    tokens = spark.read.parquet(f"{path}/tokens")
    offsets = spark.read.parquet(f"{path}/manifest").select("shard", "offset")
    # The manifest has one row for each file that one task wrote.
    placed = tokens.join(F.broadcast(offsets), "shard")
    return placed.select("doc_id", (F.col("offset") + F.col("first")).alias("start"), "n_tokens", "token_ids", "meta")


def id_digest(tokens: DataFrame) -> DataFrame:
    """``doc_id``, ``start``, ``n_tokens`` and ``ids_crc32``: the crc32 of the ids as unsigned 32-bit little-endian."""
    prepare(tokens.sparkSession)
    id_type = tokens.schema["doc_id"].dataType

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("token_ids")
            raw = lists.values.to_numpy(zero_copy_only=False).astype("<u4")
            bounds = lists.offsets.to_numpy()
            sums = [zlib.crc32(raw[a:b].tobytes()) for a, b in zip(bounds[:-1], bounds[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("doc_id", "start", "n_tokens")] + [pa.array(sums, pa.int64())],
                ["doc_id", "start", "n_tokens", "ids_crc32"],
            )

    schema = T.StructType(
        [T.StructField("doc_id", id_type), *[T.StructField(c, T.LongType()) for c in ("start", "n_tokens", "ids_crc32")]]
    )
    return tokens.select("doc_id", "start", "n_tokens", "token_ids").mapInArrow(tidied(digest), schema)
