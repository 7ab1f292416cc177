import zlib
from collections import Counter

import numpy as np
import pytest
from helpers import awkward, make_docs, numbered  # noqa: F401
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

public_tokenizers = pytest.importorskip("public_tokenizers")
from tokenizers import Tokenizer  # noqa: E402

from martlet.llm import packing  # noqa: E402
from martlet.llm import queries as Q  # noqa: E402

PATH = public_tokenizers.path("word_bpe_49k.json")
PLAIN = Tokenizer.from_file(PATH)


def plain(text):
    return PLAIN.encode(text or "", add_special_tokens=False).ids + [2]


def check_whole(pieces, texts, window):
    """Each id of each document lies in one piece, sequences have no gap and are full but for powers of two at the end."""
    rows = pieces.collect()
    got, places = Counter(), {}
    by_document = {}
    for r in rows:
        ids = np.frombuffer(r["ids"], "<u4").tolist()
        assert len(ids) == r["length"] > 0
        by_document.setdefault(r["doc_id"], []).append((r["start"], ids, r["doc_tokens"]))
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for found in by_document.values():
        open_ends = []
        for start, ids, n in sorted(found, key=lambda p: p[0]):
            if start == 0:
                open_ends.append((ids, n))
            else:  # goes on where a document with this id has stopped
                at = next(i for i, (before, m) in enumerate(open_ends) if len(before) == start and m == n)
                open_ends[at] = (open_ends[at][0] + ids, n)
        for ids, n in open_ends:
            assert len(ids) == n
            got[tuple(ids)] += 1
    assert got == Counter(tuple(plain(t)) for t in texts)
    sizes = []
    for _, parts in sorted(places.items()):
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        sizes.append(end)
    total = sum(len(plain(t)) for t in texts)
    full = total // window
    assert sizes[:full] == [window] * full
    rest = sizes[full:]
    assert sum(rest) == total % window and rest == sorted(set(rest), reverse=True) and all(s & (s - 1) == 0 for s in rest)
    assert sorted(places) == list(range(len(sizes)))


def test_awkward_rows(spark, make_docs, awkward):
    rows = [*awkward, *[(100 + i, numbered(i, i % 90), "bc"[i % 2]) for i in range(200)], (400, "x", None)]
    docs = make_docs(rows).withColumn("queue", F.lit("clash")).withColumn("n", F.lit(0)).withColumn("block", F.lit(1))
    check_whole(packing.pack(docs, PATH, window=256, windows=2, packet=16), [r[1] for r in rows], 256)
    check_whole(packing.pack(docs, PATH), [r[1] for r in rows], 4096)
    assert packing.pack(make_docs([]), PATH).collect() == []


def _mixtures(pieces, docs):
    """Tokens of each source in each sequence."""
    source = docs.select(F.col("doc_id").alias("d"), "source")
    rows = pieces.join(source, F.col("doc_id") == F.col("d")).groupBy("sequence_id", "source").agg(F.sum("length").alias("n")).collect()
    found = {}
    for r in rows:
        found.setdefault(r["sequence_id"], {})[r["source"]] = r["n"]
    return [found[k] for k in sorted(found)]


def test_windows_keep_to_the_shares(spark, make_docs):
    """At the end of every window, in any block, what each source has given differs from its share by at most two packets."""
    rows = [(i, numbered(i, 400), "a") for i in range(60)] + [(100 + i, numbered(i, 30), "b") for i in range(200)] + [(500, numbered(0, 3000), "c")]
    docs = make_docs(rows)
    mixtures = _mixtures(packing.pack(docs, PATH, window=1024, windows=4, packet=64), docs)
    totals = Counter()
    for m in mixtures:
        totals.update(m)
    given, seen = Counter(), 0
    for m in mixtures:
        given.update(m)
        seen += sum(m.values())
        for source, n in totals.items():
            assert abs(given[source] - n * seen / sum(totals.values())) <= 2 * 64


def test_targets_until_a_source_ends(spark, make_docs):
    rows = [(i, numbered(i, 100), "a") for i in range(40)] + [(100 + i, numbered(i, 100), "b") for i in range(120)]
    docs = make_docs(rows)
    mixtures = _mixtures(packing.pack(docs, PATH, targets={"a": 1, "b": 1}, window=512, windows=4, packet=32), docs)
    totals = {s: sum(len(plain(r[1])) for r in rows if r[2] == s) for s in "ab"}
    last = 2 * totals["a"] // 2048  # the block in which a ends; windows may begin in the block before
    assert last > 3 and all(abs(m["a"] - 256) <= 64 for m in mixtures[: 4 * last - 1])
    assert mixtures[4 * last + 5 : sum(totals.values()) // 512] and all(m == {"b": 512} for m in mixtures[4 * last + 5 : sum(totals.values()) // 512])
    check_whole(packing.pack(docs, PATH, targets={"a": 1, "b": 1}, window=512, windows=4, packet=32), [r[1] for r in rows], 512)
    with pytest.raises(ValueError):
        packing.pack(docs, PATH, targets={"a": 1})


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 900), st.floats(0.01, 50)), min_size=1, max_size=6), st.sampled_from([1, 2, 5]))
def test_schedule_gives_every_token_to_one_block(queues, windows):
    schedule = packing.Schedule([n for n, _ in queues], [w for _, w in queues], 16, windows)
    blocks = np.arange(schedule.blocks + 1)
    for k, (n, _) in enumerate(queues):
        taken = schedule.taken(np.full(len(blocks), k), blocks)
        assert taken[0] == 0 and taken[-1] == n and (np.diff(taken) >= 0).all()
        place = np.arange(n)
        found = schedule.block_of(np.full(n, k), place)
        assert (np.bincount(found, minlength=schedule.blocks) == np.diff(taken)).all()
    assert schedule.start(schedule.blocks) == schedule.total
    ends = [schedule.window_of(p) for p in range(schedule.total)]
    assert all(first <= p < end <= schedule.total for p, (_, first, end) in enumerate(ends))


def test_sequences_hold_their_pieces(spark, make_docs):
    docs = make_docs([(i, numbered(i, 50 + i), "ab"[i % 2]) for i in range(60)])
    pieces = packing.pack(docs, PATH, window=512, windows=3, packet=64)
    tokens = {i: plain(numbered(i, 50 + i)) for i in range(60)}
    rows = packing.sequences(pieces).collect()
    assert sum(len(r["ids"]) // 4 for r in rows) == sum(map(len, tokens.values()))
    for r in rows:
        ids = np.frombuffer(r["ids"], "<u4").tolist()
        for p in r["pieces"]:
            assert ids[p["offset"] : p["offset"] + p["length"]] == tokens[p["id"]][p["start"] : p["start"] + p["length"]]


def test_query(spark, make_docs, tmp_path):
    texts = [(i, numbered(i, 40 * (i % 9)), f"s{i % 4}") for i in range(150)]
    make_docs(texts).write.parquet(str(tmp_path / "documents.parquet"))
    rows = Q.op12_mixture_packing(spark, str(tmp_path)).collect()
    for r in rows:
        ids = plain(dict((t[0], t[1]) for t in texts)[r["doc_id"]])
        part = np.array(ids[r["start"] : r["start"] + r["length"]], "<u4")
        assert r["ids_crc32"] == zlib.crc32(part.tobytes()) and r["doc_tokens"] == len(ids) and r["offset"] + r["length"] <= 4096
