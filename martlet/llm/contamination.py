"""Benchmark decontamination: size-partitioned MinHash containment search, verified exactly.

An item counts as contained in a document if the document holds at least ``threshold`` of the
item's distinct five-word shingles. Plain MinHash cannot see a short item inside a long text, as their
Jaccard similarity is tiny. So both sides are partitioned by size: items into classes that double
in size, and every document, once for each class, into overlapping windows of twice the size of the
class. Any run as long as an item lies wholly inside one window, where its similarity is at least about a fifth,
so that one equal value among ``permutations`` MinHash values is enough to make the pair a candidate (a
miss at containment 0.8 has a probability of about ``0.82 ** permutations``). Candidates are verified
with the shingle sets of the whole item and the whole document.

MinHash values are kept as the shingle that attains them. A window can thus only match if it
holds one of the shingles in the items' signatures; windows without any need no signature, which
leaves one pass of hashing for most text. Documents never move: the work is a map over them.

The items travel to the tasks, in blocks of about ``shingles_per_block`` item shingles, one pass of the
documents for each block. Items are shingled once and their sets stored. With several blocks, what a block finds is stored before
the next is built, so the driver and the tasks hold one block at a time; documents to drop are then told by the MD5 of their
text, as equal texts contain the same items.

Defined cases: null or empty texts, and texts with fewer than five words, hold no shingle; such items are never found and
such documents never contain any. Repeated rows, on either side, give one result for each pair of rows. Ties do not
arise. Empty tables give empty results. Other columns are passed through or ignored by name.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlet.llm.text import by_position, mix, prepare, shingle_hashes, slices, tidied, word_hashes
from martlet.session import scratch_path

SHINGLE = 5
PERMUTATIONS = 128
THRESHOLD_PERCENT = 80
SHINGLES_PER_BLOCK = 1_000_000

_SEEDS = np.random.RandomState(7).randint(0, 2**63, 1024, dtype=np.int64).astype(np.uint64) | np.uint64(1)


def _ordered_shingles(texts: pa.Array) -> Iterator[np.ndarray]:
    """The shingle hashes of each text in order, none for texts under five words."""
    for _, _, data, offsets in slices(texts):
        words, bounds = word_hashes(data, offsets)
        shingles, at = shingle_hashes(words, bounds, SHINGLE)
        short = np.diff(bounds) < SHINGLE
        for i in range(len(short)):
            yield shingles[:0] if short[i] else shingles[at[i] : at[i + 1]]


def _minima(shingles: np.ndarray, permutations: int) -> np.ndarray:
    """For each permutation, the shingle whose image is smallest."""
    best = np.empty(permutations, np.uint64)
    step = max(1, (1 << 20) // max(1, len(shingles)))
    for j in range(0, permutations, step):
        seeds = _SEEDS[j : min(j + step, permutations)]
        images = shingles[:, None] * seeds[None, :]
        images ^= images >> np.uint64(29)
        best[j : j + len(seeds)] = shingles[images.argmin(axis=0)]
    return best


class ItemIndex:
    """Signatures and shingle sets of one block of items."""

    def __init__(self, sets: list[np.ndarray], permutations: int = PERMUTATIONS):
        self.sets, self.permutations = sets, permutations
        self._tags = mix(np.arange(1, permutations + 1, dtype=np.uint64))
        sizes = np.array([len(s) for s in sets])
        self.classes = []
        for c in np.unique(np.log2(sizes).astype(int)) if len(sets) else []:
            members = np.flatnonzero(np.log2(sizes).astype(int) == c)
            minima = np.stack([_minima(sets[i], permutations) for i in members])
            keys = (minima ^ self._tags).ravel()
            order = np.argsort(keys, kind="stable")
            self.classes.append(
                (int(sizes[members].max()), np.unique(minima), keys[order], np.repeat(members, permutations)[order])
            )
        seen = np.unique(np.concatenate([c[1] for c in self.classes])) if self.classes else np.zeros(0, np.uint64)
        bits = max(16, int(len(seen)).bit_length() + 5)
        self._shift = np.uint64(64 - bits)
        self._maybe = np.zeros(1 << bits, dtype=bool)
        self._maybe[seen >> self._shift] = True

    def _windows(self, shingles: np.ndarray, hits: np.ndarray, size: int) -> Iterator[np.ndarray]:
        """The windows of ``2 * size`` shingles, one every ``size``, that hold a hit."""
        last = max(0, -(-len(shingles) // size) - 2)
        numbers = np.unique(np.concatenate([hits // size, hits // size - 1]))
        for w in np.unique(np.clip(numbers, 0, last)):
            yield shingles[w * size : (w + 2) * size]

    def candidates(self, shingles: np.ndarray) -> set[int]:
        """Items that share a MinHash value with a window of the text."""
        maybe = np.flatnonzero(self._maybe[shingles >> self._shift])
        found: set[int] = set()
        if not len(maybe):
            return found
        for size, minima, keys, owners in self.classes:
            at = np.searchsorted(minima, shingles[maybe])
            hits = maybe[minima[np.minimum(at, len(minima) - 1)] == shingles[maybe]]
            for window in self._windows(shingles, hits, size):
                own = np.unique(_minima(np.unique(window), self.permutations) ^ self._tags)
                left, right = np.searchsorted(keys, own, "left"), np.searchsorted(keys, own, "right")
                for a, b in zip(left, right):
                    found.update(owners[a:b].tolist())
        return found

    def contained(self, shingles: np.ndarray, percent: int) -> list[tuple[int, int, int]]:
        """(item, shared shingles, item shingles) of the items that the text contains."""
        candidates = self.candidates(shingles)
        if not candidates:
            return []
        whole = np.unique(shingles)
        out = []
        for i in sorted(candidates):
            own = self.sets[i]
            at = np.minimum(np.searchsorted(whole, own), len(whole) - 1)
            shared = int((whole[at] == own).sum())
            if 100 * shared >= percent * len(own):
                out.append((i, shared, len(own)))
        return out


def _stored(df: DataFrame, name: str, *by: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _indexed(sets: DataFrame) -> tuple[list, ItemIndex]:
    own = sets.select("item_id", "shingles").collect()
    return [r["item_id"] for r in own], ItemIndex([np.frombuffer(r["shingles"], np.uint64) for r in own])


def _item_blocks(items: DataFrame, id_col: str, text_col: str, shingles_per_block: int) -> list[DataFrame]:
    """The stored shingle sets of each block of items; a block's size is bounded, so it may pass the driver."""
    prepare(items.sparkSession)

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [np.unique(s) for s in _ordered_shingles(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("item_id"), pa.array([len(s) for s in own], pa.int64()), pa.array([s.tobytes() for s in own], pa.binary())],
                ["item_id", "n", "shingles"],
            )

    schema = T.StructType(
        [
            T.StructField("item_id", items.schema[id_col].dataType),
            T.StructField("n", T.LongType()),
            T.StructField("shingles", T.BinaryType()),
        ]
    )
    made = items.select(F.col(id_col).alias("item_id"), F.col(text_col).alias("text")).mapInArrow(tidied(sets), schema)
    made = _stored(made.filter("n > 0"), "item-shingles")
    total = made.agg(F.sum("n")).first()[0] or 0
    blocks = -(-total // shingles_per_block)
    if blocks <= 1:
        return [made] * blocks
    dealt = made.withColumn("block", F.pmod(F.xxhash64("item_id", "shingles"), F.lit(blocks)).cast("int"))
    dealt = _stored(dealt.repartition(blocks, "block"), "item-blocks", "block")
    return [dealt.filter(F.col("block") == block) for block in range(blocks)]


def find_contained(
    docs: DataFrame,
    items: DataFrame,
    percent: int = THRESHOLD_PERCENT,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    shingles_per_block: int = SHINGLES_PER_BLOCK,
) -> DataFrame:
    """One row for each document and item it contains: ``doc_id``, ``item_id``, ``shared``, ``item_shingles``, ``containment``."""
    spark = docs.sparkSession
    id_type, item_type = docs.schema[id_col].dataType, items.schema[item_id_col].dataType
    schema = T.StructType(
        [
            T.StructField("doc_id", id_type),
            T.StructField("item_id", item_type),
            T.StructField("shared", T.LongType()),
            T.StructField("item_shingles", T.LongType()),
            T.StructField("containment", T.DoubleType()),
        ]
    )
    from pyspark.sql.pandas.types import to_arrow_type

    pa_item = to_arrow_type(item_type)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def found_in(block: DataFrame) -> DataFrame:
        ids, index = _indexed(block)

        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                at, found = [], []
                for i, shingles in enumerate(_ordered_shingles(batch.column("text"))):
                    for hit in index.contained(shingles, percent):
                        at.append(i)
                        found.append(hit)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(pa.array(at, pa.int64())),
                        pa.array([ids[i] for i, _, _ in found], pa_item),
                        pa.array([s for _, s, _ in found], pa.int64()),
                        pa.array([n for _, _, n in found], pa.int64()),
                        pa.array([s / n for _, s, n in found], pa.float64()),
                    ],
                    schema.names,
                )

        return rows.mapInArrow(tidied(search), schema)

    blocks = _item_blocks(items, item_id_col, item_text_col, shingles_per_block)
    if len(blocks) == 1:
        return found_in(blocks[0])
    result = spark.createDataFrame([], schema)
    for block in blocks:
        result = result.unionByName(_stored(found_in(block), "contained"))
    return result


def drop_contained(
    docs: DataFrame,
    items: DataFrame,
    percent: int = THRESHOLD_PERCENT,
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    shingles_per_block: int = SHINGLES_PER_BLOCK,
) -> DataFrame:
    """``docs`` without the rows that contain an item; columns as they are, no row moves while items fit one block."""

    def holding(block: DataFrame, rows: DataFrame, column: str, wanted: bool) -> DataFrame:
        """The rows that hold an item of the block, or the others."""
        _, index = _indexed(block)

        def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                chosen = [bool(index.contained(s, percent)) == wanted for s in _ordered_shingles(batch.column(column))]
                yield batch.filter(pa.array(chosen, pa.bool_()))

        return rows.mapInArrow(tidied(keep), rows.schema)

    blocks = _item_blocks(items, item_id_col, item_text_col, shingles_per_block)
    if not blocks:
        return docs
    own = f"c{docs.columns.index(text_col)}"
    if len(blocks) == 1:
        return holding(blocks[0], by_position(docs), own, False).toDF(*docs.columns)
    texts = by_position(docs).select(F.col(own).alias("text"))
    bad = [_stored(holding(block, texts, "text", True).select(F.md5("text").alias("bad")).distinct(), "contaminated") for block in blocks]
    bad = reduce(DataFrame.unionByName, bad).distinct()
    return by_position(docs).join(bad, F.md5(own) == F.col("bad"), "left_anti").toDF(*docs.columns)
