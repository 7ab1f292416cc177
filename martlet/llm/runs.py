"""Periodic runs: every maximal stretch of words that repeats with some period, found through difference-cover LCE.

A run is a stretch with smallest period q (words q apart are identical) and a length of at least
``max(least, 2 * q)`` that no neighbouring word extends.

* **Longest common extensions.** Of all suffixes, only those at positions whose remainder lies in a difference cover
  are sorted (8 of every 57): first word by word, as far as the cover is wide, then by doubling ranks. Two positions are
  compared word by word until both reach sampled ones, which the cover guarantees within 57 words; the rest is the
  minimum of neighbouring common prefixes between the two sampled suffixes, read off a sparse table. Extensions to
  the left are the same on the reversed words.
* **Harmonic grid.** For each period q, pairs ``(i, i + q)`` at multiples of the spacing ``max(q, least - q)`` meet every run of that
  period, ``n log n`` pairs in all. Pairs of equal words are extended both ways, and a stretch found with several
  periods keeps the smallest, which divides the others.

Documents are rows and stay where they are: no shuffle. A slice of about half a megabyte of documents is worked on at once,
a longer document alone; memory and time are ``n log n`` in the longest document, whatever its words.

Defined cases: a null or empty text has no words, no runs and an empty collapsed text; rows with the same id, or without one, are
judged each on their own; other columns are ignored, so no name can clash; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlet.llm.text import prepare, slices, span_hashes, tidied, word_spans

#: A perfect difference set modulo 57, i.e. each remainder but 0 is one difference of two members.
COVER_WIDTH = 57
COVER = (0, 1, 3, 13, 32, 36, 43, 52)

_SAMPLED = np.zeros(COVER_WIDTH, bool)
_SAMPLED[list(COVER)] = True
#: For the distance of two positions: the remainder of the first one at which both are sampled.
_MEETING = np.array([next(d for d in COVER if _SAMPLED[(d + a) % COVER_WIDTH]) for a in range(COVER_WIDTH)])
#: Grid pairs that are looked at together.
PAIRS = 1 << 20

#: ``(ids, word counts) -> (first word, period)`` of documents whose words from ``first`` on are read in a loop; period 0: as they are.
Loops = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


class Extensions:
    """Longest common extensions to the right within sections of ``words`` that end in a 0."""

    def __init__(self, words: np.ndarray):
        self._words = words
        ends = words == 0
        at = np.flatnonzero(_SAMPLED[np.arange(len(words)) % COVER_WIDTH])
        self._sample = np.full(len(words), -1, np.int32)
        self._sample[at] = np.arange(len(at))
        section = (np.cumsum(ends) - ends)[at]
        self._sort(at, section)
        self._table = [self._common]

    def _sort(self, at: np.ndarray, section: np.ndarray) -> None:
        """Places of the samples in the order of (section, suffix), and the words each shares with the one before."""
        m = len(at)
        order = np.arange(m)
        head = np.ones(m + 1, bool)
        head[1:m] = section[1:] != section[:-1]
        self._common = np.zeros(m, np.int64)

        def split(values: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
            """Sort the groups of several samples by a value; the places at which new groups begin."""
            places = np.flatnonzero(~(head[:-1] & head[1:]))
            if not len(places):
                return places
            group = np.cumsum(head[:-1])[places]
            keys = values(order[places])
            keys = group * (int(keys.max()) + 1) + keys
            by_key = np.argsort(keys)
            order[places] = order[places][by_key]
            keys = keys[by_key]
            new = places[1:][(keys[1:] != keys[:-1]) & ~head[places[1:]]]
            head[new] = True
            return new

        for depth in range(COVER_WIDTH):
            if head.all():
                break
            self._common[split(lambda s, d=depth: self._words[at[s] + d].astype(np.int64))] = depth
        width, ranks = COVER_WIDTH, []
        while not head.all():
            rank = np.empty(m, np.int64)
            rank[order] = np.maximum.accumulate(np.where(head[:-1], np.arange(m), 0))
            ranks.append(rank)
            new = split(lambda s, w=width, r=rank: r[self._sample[at[s] + w]])
            left, right = at[order[new - 1]] + width, at[order[new]] + width
            shared = np.full(len(new), width, np.int64)
            for level in range(len(ranks) - 2, -1, -1):
                same = ranks[level][self._sample[left]] == ranks[level][self._sample[right]]
                step = same * (COVER_WIDTH << level)
                left, right, shared = left + step, right + step, shared + step
            self._common[new] = shared + self._direct(left, right, np.full(len(new), COVER_WIDTH))
            width *= 2
        self._place = np.empty(m, np.int64)
        self._place[order] = np.arange(m)

    def _direct(self, left: np.ndarray, right: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """Equal words from both positions on, counted one by one up to ``limit``."""
        found = np.zeros(len(left), np.int64)
        going = np.arange(len(left))
        while len(going):
            going = going[found[going] < limit[going]]
            k = found[going]
            going = going[self._words[left[going] + k] == self._words[right[going] + k]]
            found[going] += 1
        return found

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Words that the suffixes at ``left`` and ``right`` share; both in one section, at different positions."""
        reach = (_MEETING[(right - left) % COVER_WIDTH] - left) % COVER_WIDTH
        found = self._direct(left, right, reach)
        far = np.flatnonzero(found == reach)
        a = self._place[self._sample[left[far] + reach[far]]]
        b = self._place[self._sample[right[far] + reach[far]]]
        found[far] += self._least(np.minimum(a, b) + 1, np.maximum(a, b) + 1)
        return found

    def _least(self, first: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The least common prefix of places ``first`` up to ``end``."""
        level = np.frexp((end - first).astype(np.float64))[1] - 1
        least = np.empty(len(first), np.int64)
        for k in range(int(level.max(initial=0)) + 1):
            if k == len(self._table):
                last = self._table[-1]
                half = 1 << (k - 1)
                self._table.append(np.minimum(last[:-half], last[half:]))
            mine = np.flatnonzero(level == k)
            least[mine] = np.minimum(self._table[k][first[mine]], self._table[k][end[mine] - (1 << k)])
        return least


def grid_pairs(counts: np.ndarray, least: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(document, word, period) of the grid, in blocks of about ``PAIRS``."""
    able = np.flatnonzero(counts >= max(least, 2))
    periods = counts[able] // 2
    document = np.repeat(able, periods)
    period = np.arange(1, len(document) + 1) - np.repeat(np.cumsum(periods) - periods, periods)
    spacing = np.maximum(period, least - period)
    pairs = np.maximum(counts[document] - 1 - period, -1) // spacing + 1
    total = np.cumsum(pairs)
    first = 0
    while first < len(pairs):
        done = total[first - 1] if first else 0
        end = max(first + 1, int(np.searchsorted(total, done + PAIRS, "right")))
        some = pairs[first:end]
        step = np.arange(some.sum()) - np.repeat(np.cumsum(some) - some, some)
        yield np.repeat(document[first:end], some), step * np.repeat(spacing[first:end], some), np.repeat(period[first:end], some)
        first = end


def runs_of(words: np.ndarray, bounds: np.ndarray, least: int = 12) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Document, start, length and period of every run, ordered by the first three; ``words`` are numbers from 1 on."""
    counts = np.diff(bounds)
    inside = np.arange(len(words)) + np.repeat(np.arange(len(counts)), counts) + 1
    between = np.zeros(len(words) + len(counts) + 1, words.dtype)
    between[inside] = words
    offset = bounds[:-1] + np.arange(len(counts)) + 1
    seeds = []
    for document, word, period in grid_pairs(counts, least):
        at = offset[document] + word
        equal = between[at] == between[at + period]
        seeds.append((document[equal], at[equal], period[equal]))
    if not sum(len(s[0]) for s in seeds):
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    document, at, period = (np.concatenate(parts) for parts in zip(*seeds))
    last = len(between) - 1
    after = Extensions(between)(at, at + period)
    before = Extensions(between[::-1].copy())(last - at - period + 1, last - at + 1)
    length = period + before + after
    start = at - before - offset[document]
    long = np.flatnonzero(length >= np.maximum(least, 2 * period))
    long = long[np.lexsort((period[long], length[long], start[long], document[long]))]
    document, start, length, period = document[long], start[long], length[long], period[long]
    new = np.ones(len(long), bool)
    new[1:] = (document[1:] != document[:-1]) | (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    document, start, length, period = document[new], start[new], length[new], period[new]
    order = np.lexsort((length, period, start, document))
    return document[order], start[order], length[order], period[order]


def _kept(counts: np.ndarray, bounds: np.ndarray, document, start, length, period) -> np.ndarray:
    """Whether each word stays: no run contains it after its first period."""
    change = np.zeros(int(bounds[-1]) + 1, np.int64)
    np.add.at(change, bounds[document] + start + period, 1)
    np.add.at(change, bounds[document] + start + length, -1)
    return np.cumsum(change)[:-1] == 0


def _joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """For each document its words ``bounds[d]`` to ``bounds[d + 1]``, joined by one space."""
    sizes = ends - starts + 1
    last = bounds[1:][bounds[1:] > bounds[:-1]] - 1
    sizes[last] -= 1
    to = np.concatenate([[0], np.cumsum(sizes)])
    out = np.append(data, np.uint8(32))[np.repeat(starts - to[:-1], sizes) + np.arange(to[-1])]
    spaced = np.ones(len(sizes), bool)
    spaced[last] = False
    out[to[1:][spaced] - 1] = 32
    return pa.LargeStringArray.from_buffers(len(bounds) - 1, pa.py_buffer(to[bounds].astype(np.int64)), pa.py_buffer(out))


RUN = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])


def _scan(ids: np.ndarray, texts: pa.Array, least: int, loops: Loops | None) -> Iterator[tuple[pa.Array, pa.Array, pa.Array]]:
    """Word counts, runs and collapsed texts of the texts, slice by slice."""
    for first, end, data, offsets in slices(texts):
        starts, ends, bounds = word_spans(data, offsets)
        counts = np.diff(bounds)
        if loops is not None:
            begin, lap = loops(ids[first:end], counts)
            place = np.arange(len(starts)) - np.repeat(bounds[:-1], counts)
            begin, lap = np.repeat(begin, counts), np.repeat(lap, counts)
            place = np.where((lap > 0) & (place >= begin), begin + (place - begin) % np.maximum(lap, 1), place)
            source = np.repeat(bounds[:-1], counts) + place
            starts, ends = starts[source], ends[source]
        words = np.zeros(0, np.int32)
        if len(starts):
            words = np.unique(span_hashes(data, starts, ends), return_inverse=True)[1].astype(np.int32) + 1
        document, start, length, period = runs_of(words, bounds, least)
        stays = _kept(counts, bounds, document, start, length, period)
        left = np.concatenate([[0], np.cumsum(stays)])[bounds]
        fields = [pa.array(x, pa.int64()) for x in (start, length, period)]
        found = pa.StructArray.from_arrays(fields, ["start", "length", "period"])
        edges = np.searchsorted(document, np.arange(len(counts) + 1)).astype(np.int32)
        yield pa.array(counts, pa.int64()), pa.ListArray.from_arrays(pa.array(edges), found), _joined(data, starts[stays], ends[stays], left)


def find_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 12, loops: Loops | None = None
) -> DataFrame:
    """``id_col``, ``n_words``, ``runs`` (array of start, length, period, by start, then period) and ``collapsed``.

    ``collapsed`` is the text without the words that a run holds after its first period, joined by
    spaces. ``loops`` reads the words of some documents in a loop before they are searched.
    """
    prepare(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, done = batch.column("id"), 0
            numbers = np.array(ids.to_pylist(), object)
            for counts, found, collapsed in _scan(numbers, batch.column("text"), least, loops):
                part = ids.slice(done, len(counts))
                done += len(counts)
                yield pa.RecordBatch.from_arrays([part, counts, found, collapsed.cast(pa.string())], [id_col, "n_words", "runs", "collapsed"])

    schema = T.StructType(
        [
            T.StructField(id_col, rows.schema["id"].dataType),
            T.StructField("n_words", T.LongType()),
            T.StructField("runs", T.ArrayType(RUN)),
            T.StructField("collapsed", T.StringType()),
        ]
    )
    return rows.mapInArrow(tidied(search), schema)


def run_digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Of the rows of ``find_runs``: how many runs, the longest one, and digests of all runs and of the collapsed text."""
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        id_col,
        F.size("runs").cast("long").alias("n_runs"),
        longest.alias("top"),
        F.sha2(F.concat_ws("", lines), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    ).select(
        id_col,
        "n_runs",
        (-F.col("top.s")).alias("start"),
        F.col("top.length").alias("length"),
        (-F.col("top.p")).alias("period"),
        F.expr("1000 * top.length div -top.p").alias("exponent_milli"),
        "runs_sha256",
        "collapsed_sha256",
    )
