"""Words, shingles and their hashes, computed on whole Arrow batches with numpy.

A word is a maximal run of bytes outside ``[\\x20\\x09-\\x0D]`` with A-Z lower-cased.
Its hash is a polynomial over random per-byte values, read off two prefix sums, so
that no Python loop runs over words. Texts are taken whole, whatever their length.
"""

from __future__ import annotations

import ctypes
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Bytes of text that are hashed at once; a longer text is hashed on its own.
SLICE_BYTES = 1 << 19

_RANDOM = np.random.RandomState(20240229)
_BYTE = _RANDOM.randint(0, 2**63, 256, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
#: The same values with A-Z read as a-z.
FOLDED = _BYTE.copy()
FOLDED[65:91] = FOLDED[97:123]
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_STEP = _RANDOM.randint(0, 2**63, 64, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)


@lru_cache(maxsize=8)
def _ship(application_id: str, context) -> None:
    """Give the executors this package, for sessions whose Python path does not have it."""
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="package-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for module in sorted(package.rglob("*.py")):
            out.write(module, module.relative_to(package.parent))
    context.addPyFile(str(archive))


def by_position(df: DataFrame) -> DataFrame:
    """``df`` with its columns named c0, c1, ..., so that no column added beside them can clash; ``toDF(*names)`` names them again."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))])


def prepare(spark: SparkSession, rows: int = 1000, megabytes: int = 4) -> None:
    """Ready a session for Python workers: they get the package, and small batches, as texts may be long."""
    _ship(spark.sparkContext.applicationId, spark.sparkContext)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", megabytes << 20)


def tidied(work: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``work`` over the batches of a task, after which the worker gives the memory it has freed back to the machine."""

    def run(batches: Iterator) -> Iterator:
        yield from work(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim:
            trim(0)

    return run


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit values that spreads every input bit over the output."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_powers = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def _powers_to(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n:
        for at, base in enumerate((_BASE, _BASE_INVERSE)):
            steps = np.full(n, base, dtype=np.uint64)
            steps[0] = 1
            _powers[at] = np.cumprod(steps)
    return _powers


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts (null as empty) and the n + 1 offsets of the texts."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first text, end text, bytes, offsets) of runs of texts of about ``SLICE_BYTES``."""
    data, offsets = text_bytes(texts)
    first = 0
    while first < len(offsets) - 1:
        end = max(first + 1, int(np.searchsorted(offsets, offsets[first] + SLICE_BYTES, "right")) - 1)
        end = min(end, len(offsets) - 1)
        yield first, end, data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first]
        first = end


def word_spans(
    data: np.ndarray, offsets: np.ndarray, separator: np.ndarray = _IS_SPACE
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and the n + 1 word offsets of the texts."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    inside = ~separator[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    starts = inside & edge[:-1]
    starts[1:] |= inside[1:] & ~inside[:-1]
    ends = inside & edge[1:]
    ends[:-1] |= inside[:-1] & ~inside[1:]
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return starts, ends, np.searchsorted(starts, offsets, "left")


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, values: np.ndarray = _BYTE) -> np.ndarray:
    """A 64-bit hash of the bytes of every span."""
    power, inverse = _powers_to(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(values[data] * power[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverse[starts])


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every word with A-Z lower-cased, and the n + 1 word offsets of the texts."""
    starts, ends, bounds = word_spans(data, offsets)
    return span_hashes(data, starts, ends, FOLDED), bounds


def shingle_hashes(words: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all ``size``-word shingles in order, and their n + 1 offsets.

    A text with fewer words, but at least one, has its whole word sequence as its one shingle.
    """
    counts = np.diff(bounds)
    n = len(words)
    rolled = np.zeros(n, dtype=np.uint64)
    for j in range(min(size, n)):
        rolled[: n - j] += words[j:] * _STEP[j]
    made = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    out_bounds = np.concatenate([[0], np.cumsum(made)])
    keep = np.repeat(bounds[:-1] - out_bounds[:-1], made) + np.arange(out_bounds[-1])
    shingles = mix(rolled[keep])
    for i in np.flatnonzero((counts > 0) & (counts < size)):
        short = words[bounds[i] : bounds[i + 1]]
        shingles[out_bounds[i]] = mix((short * _STEP[: len(short)]).sum(keepdims=True) + _STEP[size + len(short)])[0]
    return shingles, out_bounds


def shingle_sets(texts: pa.Array, size: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    for _, _, data, offsets in slices(texts):
        shingles, bounds = shingle_hashes(*word_hashes(data, offsets), size)
        for a, b in zip(bounds[:-1], bounds[1:]):
            yield np.unique(shingles[a:b])
