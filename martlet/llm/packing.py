"""Mixture-controlled packing: documents in fixed token windows, each filled to target shares by deficit round robin.

Every source is a queue of tokens: its documents in the order of the stored table, each closed by the end id. A document may be cut
anywhere, so windows have no padding; the few tokens after the last full window go into windows of falling powers of two.

* **Encoding.** Texts become token ids where they lie, stored with their place in their queue: the tokens of the queue
  before them in their file, and by one row for each file and queue, those of the files before.
* **Blocks.** The whole order is divided into blocks of ``windows`` windows' tokens. What a block takes of each queue follows from the
  totals alone (``Schedule``): queues are drawn on in proportion to their targets until one is empty, then the others go on.
  So blocks need nothing of each other but the fraction of a token that is owed to each queue at their border, and a block is all that
  ever meets in one task, however large a source or a document is. This is the only shuffle of tokens.
* **Deficit round robin** in a block: with each window every queue is credited its share of the window. Queues are served in turn, by packets of
  up to ``packet`` tokens of a document, while their credit lasts; if nobody's does and there is space left, the one with the
  largest credit goes first and pays in the next windows. Credits are carried from window to window.

Without targets, shares are those of all tokens, so that all queues end together. A window may begin in one block and end in the next.

Defined cases: a null or empty text is the end id alone; a null source is a queue of its own; rows of one id are documents of
their own; a queue without a positive target is an error when targets are given; other columns are ignored whatever their name;
an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlet.llm.text import prepare, tidied
from martlet.llm.tokens import _parts, encoder
from martlet.session import scratch_path

WINDOW = 4096
#: Windows in a block, and tokens of a document that are served at once.
WINDOWS = 64
PACKET = 256


def _binary(ids: np.ndarray, bounds: np.ndarray, width: int = 4) -> pa.Array:
    """``ids`` as little-endian unsigned integers of ``width`` bytes, cut at ``bounds``."""
    data = np.ascontiguousarray(ids, f"<u{width}")
    offsets = (width * bounds).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def _ids(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a binary column, one value after the other, and the n + 1 bounds of its values."""
    if not len(column):
        return np.zeros(0, f"<u{width}"), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]].view(f"<u{width}"), (offsets - offsets[0]) // width


def id_width(tokenizer: str, end_id: int) -> int:
    """Bytes that hold every id of a tokenizer, while ids are on their way."""
    from tokenizers import Tokenizer

    largest = max(end_id, *Tokenizer.from_file(tokenizer).get_vocab(with_added_tokens=True).values())
    return 2 if largest < 1 << 16 else 4


def encode_queues(
    docs: DataFrame, path: str, tokenizer: str, end_id: int, width: int, id_col: str, text_col: str, queue_col: str
) -> DataFrame:
    """Write ``id``, ``queue``, ``shard``, ``before`` (tokens of the queue earlier in the shard), ``n`` and ``ids``; read them back."""
    spark = docs.sparkSession
    prepare(spark)
    rows = docs.select(F.col(id_col).alias("id"), F.col(queue_col).alias("queue"), F.col(text_col).alias("text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, seen = TaskContext.get().partitionId(), {}
        for whole in batches:
            for part in _parts(whole, "text"):
                ids, bounds = encoder(tokenizer).encode(part.column("text"), end_id)
                counts = np.diff(bounds)
                before = []
                for queue, n in zip(part.column("queue").to_pylist(), counts.tolist()):
                    before.append(seen.get(queue, 0))
                    seen[queue] = before[-1] + n
                numbers = [pa.array(np.full(len(counts), shard, np.int32)), pa.array(before, pa.int64()), pa.array(counts)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("queue"), *numbers, _binary(ids, bounds, width)],
                    ["id", "queue", "shard", "before", "n", "ids"],
                )

    more = [("shard", T.IntegerType()), ("before", T.LongType()), ("n", T.LongType()), ("ids", T.BinaryType())]
    schema = T.StructType([rows.schema["id"], rows.schema["queue"], *[T.StructField(*field) for field in more]])
    writer = rows.mapInArrow(tidied(encode), schema).write.option("compression", "zstd")
    writer.option("parquet.enable.dictionary#ids", "false").parquet(path)
    return spark.read.parquet(path)


class Schedule:
    """What each block of windows takes of each queue, from the queues' totals and targets."""

    def __init__(self, totals: list[int], targets: list[float], window: int = WINDOW, windows: int = WINDOWS):
        if window & (window - 1):
            raise ValueError("a window is a power of two, as are the windows after the last full one")
        self.totals, self.targets = np.array(totals, np.int64), np.array(targets, np.float64)
        self.window, self.size, self.total = window, window * windows, int(self.totals.sum())
        self.blocks = -(-self.total // self.size)
        # Queue s has given min(total, target * level) tokens; levels at which a queue ends, and all tokens given by then.
        self._levels = np.concatenate([[0.0], np.unique(self.totals / self.targets)])
        self._given = np.array([np.minimum(self.totals, self.targets * level).sum() for level in self._levels])

    def owed(self, queue: np.ndarray, block: np.ndarray) -> np.ndarray:
        """Tokens, with fractions, that the queue should have given before the block."""
        level = np.interp(np.asarray(block, np.float64) * self.size, self._given, self._levels)
        return np.minimum(self.totals[queue], self.targets[queue] * level)

    def taken(self, queue: np.ndarray, block: np.ndarray) -> np.ndarray:
        """Tokens that the queue has given before the block."""
        whole = np.floor(self.owed(queue, block)).astype(np.int64)
        return np.where(np.asarray(block) >= self.blocks, self.totals[queue], whole)

    def block_of(self, queue: np.ndarray, place: np.ndarray) -> np.ndarray:
        """The block that takes the token at a place in its queue."""
        low, high = np.zeros(len(place), np.int64), np.full(len(place), self.blocks, np.int64)
        while (high - low > 1).any():
            middle = (low + high) // 2
            here = self.taken(queue, middle) <= place
            low, high = np.where(here, middle, low), np.where(here, high, middle)
        return low

    def start(self, block: int) -> int:
        """Tokens of all queues before the block."""
        queues = np.arange(len(self.totals))
        return int(self.taken(queues, np.full(len(queues), block)).sum())

    def window_of(self, place: int) -> tuple[int, int, int]:
        """Number, first and end place of the window of a place in the whole order."""
        number = place // self.window
        first, end = number * self.window, (number + 1) * self.window
        if end <= self.total:
            return number, first, end
        size = self.window // 2  # the rest, in falling powers of two
        while not (self.total % self.window & size and place < first + size):
            if self.total % self.window & size:
                number, first = number + 1, first + size
            size //= 2
        return number, first, first + size


def _cut(tokens: DataFrame, names: list, schedule: Schedule, width: int) -> DataFrame:
    """``tokens`` (with ``offset`` of their shard in their queue) cut where a block ends, each piece with its block."""
    numbers = {name: i for i, name in enumerate(names)}

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder.cache_clear()  # the worker has encoded before, and will not again
        for batch in batches:
            if not batch.num_rows:
                continue
            queue = np.array([numbers[q] for q in batch.column("queue").to_pylist()], np.int64)
            before, n, offset = (batch.column(c).to_numpy() for c in ("before", "n", "offset"))
            place = offset + before
            first, last = schedule.block_of(queue, place), schedule.block_of(queue, place + n - 1)
            rows = np.repeat(np.arange(len(n)), last - first + 1)
            ahead = np.cumsum(last - first + 1) - (last - first + 1)
            block = first[rows] + np.arange(len(rows)) - ahead[rows]
            begin = np.maximum(schedule.taken(queue[rows], block), place[rows])
            end = np.minimum(schedule.taken(queue[rows], block + 1), (place + n)[rows])
            some = end > begin
            rows, block, begin, end = rows[some], block[some], begin[some], end[some]
            bounds = np.concatenate([[0], np.cumsum(end - begin)])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(block), pa.array(queue[rows]), pa.array(begin), batch.column("id").take(pa.array(rows)),
                    pa.array(begin - place[rows]), pa.array(n[rows]), _binary(_ids(batch.column("ids"), width)[0], bounds, width),
                ],
                ["block", "queue", "place", "id", "start", "doc_tokens", "ids"],
            )

    longs = ["block", "queue", "place"], ["start", "doc_tokens"]
    fields = [T.StructField(c, T.LongType()) for c in longs[0]] + [tokens.schema["id"]] + [T.StructField(c, T.LongType()) for c in longs[1]]
    return tokens.mapInArrow(tidied(cut), T.StructType([*fields, T.StructField("ids", T.BinaryType())]))


def serve(schedule: Schedule, block: int, queue: np.ndarray, length: np.ndarray, packet: int = PACKET) -> list[list[int]]:
    """[row, start in the row, length, place in the whole order] of each piece, in the order of service.

    ``queue`` and ``length`` of the rows of a block, those of a queue in their order.
    """
    at = schedule.start(block)
    left = length.tolist()
    numbers, tokens = np.unique(queue, return_inverse=True)
    shares = (np.bincount(tokens, weights=length) / length.sum()).tolist()
    waiting = [np.flatnonzero(tokens == k).tolist()[::-1] for k in range(len(numbers))]
    here = np.full(len(numbers), block)
    credit = (schedule.owed(numbers, here) - schedule.taken(numbers, here)).tolist()
    pieces: list[list[int]] = []
    turn, rest = 0, int(length.sum())

    def give(k: int, space: int) -> int:
        row = waiting[k][-1]
        n = min(left[row], packet, space)
        done = int(length[row]) - left[row]
        if pieces and fresh != len(pieces) and pieces[-1][0] == row:
            pieces[-1][2] += n
        else:
            pieces.append([row, done, n, at])
        left[row] -= n
        credit[k] -= n
        if not left[row]:
            waiting[k].pop()
        return n

    while rest:
        end = min(schedule.window_of(at)[2], at + rest)
        credit = [c + share * (end - at) for c, share in zip(credit, shares)]
        fresh = len(pieces)
        while at < end:
            served = False
            for step in range(len(numbers)):
                k = (turn + step) % len(numbers)
                while at < end and waiting[k] and credit[k] >= min(left[waiting[k][-1]], packet, end - at):
                    n = give(k, end - at)
                    at, rest, served = at + n, rest - n, True
                if at == end:
                    turn = k
                    break
            if at < end and not served:
                turn = max((k for k in range(len(numbers)) if waiting[k]), key=lambda k: credit[k])
                n = give(turn, end - at)
                at, rest = at + n, rest - n
    return pieces


def pack(
    docs: DataFrame,
    tokenizer: str,
    end_id: int = 2,
    targets: dict | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    queue_col: str = "source",
    window: int = WINDOW,
    windows: int = WINDOWS,
    packet: int = PACKET,
) -> DataFrame:
    """Every piece of every document with its place in a sequence.

    ``id_col``, ``start`` and ``length`` in its document, ``doc_tokens``, ``sequence_id``, ``offset`` in the sequence, and ``ids``: its token
    ids as little-endian unsigned 32-bit integers.
    """
    spark = docs.sparkSession
    width = id_width(tokenizer, end_id)
    tokens = encode_queues(docs, scratch_path(spark, "packing-tokens"), tokenizer, end_id, width, id_col, text_col, queue_col)
    sums = tokens.groupBy("shard", "queue").agg(F.sum("n").alias("tokens"))
    before = Window.partitionBy("queue").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    path = scratch_path(spark, "packing-offsets")
    sums.withColumn("offset", F.coalesce(F.sum("tokens").over(before), F.lit(0))).write.parquet(path)
    offsets = spark.read.parquet(path)

    found = offsets.groupBy("queue").agg(F.sum("tokens")).collect()  # one row for each source
    found = sorted(map(tuple, found), key=lambda r: (r[0] is not None, r[0] or ""))
    names, totals = [r[0] for r in found], [r[1] for r in found]
    if targets is not None and any(not targets.get(name, 0) > 0 for name in names):
        raise ValueError("each source needs a positive target")
    schedule = Schedule(totals, totals if targets is None else [targets[name] for name in names], window, windows)

    keys = offsets.select(F.col("shard").alias("s"), F.col("queue").alias("q"), "offset")
    placed = tokens.join(keys, (F.col("shard") == F.col("s")) & F.col("queue").eqNullSafe(F.col("q")))
    pieces = _cut(placed.select("id", "queue", "before", "n", "offset", "ids"), names, schedule, width)

    def place(key: tuple, table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        queue, start = table["queue"].to_numpy(), table["place"].to_numpy()
        ids, bounds = _ids(table["ids"].chunk(0), width)
        length = np.diff(bounds)
        order = np.lexsort((start, queue))
        served = np.array(serve(schedule, key[0].as_py(), queue[order], length[order], packet), np.int64)
        served[:, 0] = order[served[:, 0]]
        served = served[np.lexsort((served[:, 1], served[:, 0]))]  # in this order their ids lie as those of the table
        rows, begin, n, at = served.T
        where = [schedule.window_of(p)[:2] for p in at.tolist()]
        number, first = np.array(where, np.int64).T
        columns = [
            table["id"].take(pa.array(rows)), table["start"].to_numpy()[rows] + begin, n, table["doc_tokens"].to_numpy()[rows],
            number, at - first, _binary(ids, np.concatenate([[0], np.cumsum(n)])),
        ]
        return pa.table(columns, names=[id_col, "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])

    longs = ("start", "length", "doc_tokens", "sequence_id", "offset")
    schema = T.StructType(
        [T.StructField(id_col, tokens.schema["id"].dataType), *[T.StructField(c, T.LongType()) for c in longs], T.StructField("ids", T.BinaryType())]
    )
    return pieces.groupBy("block").applyInArrow(place, schema)


def sequences(pieces: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``sequence_id``, ``ids`` of the whole sequence, and ``pieces`` (offset, length, document, start in it) in their order."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "length", F.col(id_col).alias("id"), "start", "ids")))
    gathered = pieces.groupBy("sequence_id").agg(parts.alias("parts"))  # at most one window's tokens each
    ids = F.aggregate("parts", F.lit(b""), lambda all_ids, part: F.concat(all_ids, part["ids"]))
    return gathered.select("sequence_id", ids.alias("ids"), F.transform("parts", lambda p: p.dropFields("ids")).alias("pieces"))
