import hashlib
import re
import zlib

import numpy as np
from helpers import awkward, make_docs  # noqa: F401
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from martlet.llm import queries as Q
from martlet.llm import runs


def brute(words, least=12):
    """(start, length, period) of all runs, by comparing every word with that of every period."""
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i - start + q >= max(least, 2 * q):
                found.setdefault((start, i - start + q), q)
            i += 1
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def found_in(documents, least=12):
    bounds = np.concatenate([[0], np.cumsum([len(d) for d in documents])]).astype(np.int64)
    words = np.array([w for d in documents for w in d], np.int32)
    found = [[] for _ in documents]
    for document, *run in zip(*runs.runs_of(words, bounds, least)):
        found[document].append(tuple(map(int, run)))
    return found


def test_cover_has_every_distance():
    assert {(a - b) % runs.COVER_WIDTH for a in runs.COVER for b in runs.COVER} == set(range(runs.COVER_WIDTH))


@st.composite
def repetitive(draw):
    """Few different words, and often a stretch read in a loop, over the width of the cover as well."""
    words = draw(st.lists(st.integers(1, draw(st.sampled_from([1, 2, 3, 40]))), max_size=draw(st.sampled_from([14, 90, 400]))))
    if words and draw(st.booleans()):
        at, lap = draw(st.integers(0, len(words) - 1)), draw(st.integers(1, 90))
        words = [words[at + (i - at) % lap] if i >= at and at + (i - at) % lap < len(words) else w for i, w in enumerate(words)]
    return words * draw(st.sampled_from([1, 1, 2]))


@settings(max_examples=150, deadline=None)
@given(st.lists(repetitive(), min_size=1, max_size=4), st.sampled_from([2, 5, 12, 30]))
def test_runs_equal_brute_force(documents, least):
    assert found_in(documents, least) == [brute(d, least) for d in documents]


@settings(max_examples=60, deadline=None)
@given(repetitive().filter(lambda w: len(w) > 1))
def test_extensions_equal_plain_comparison(words):
    section = np.array([*words, 0], np.int32)
    left, right = np.triu_indices(len(words), 1)
    plain = [next(k for k in range(len(section)) if section[a + k] != section[b + k]) for a, b in zip(left, right)]
    assert runs.Extensions(section)(left, right).tolist() == plain


def test_grid_in_small_blocks(monkeypatch):
    documents = [[1, 2, 3] * 20, [5] * 40, list(range(1, 30)) * 3]
    monkeypatch.setattr(runs, "PAIRS", 7)
    assert found_in(documents) == [brute(d) for d in documents]


def test_long_loops_stay_quick():
    n = 120_000
    assert found_in([[1] * n, list(range(1, 101)) * (n // 100)]) == [[(0, n, 1)], [(0, n, 100)]]


def test_awkward_rows(spark, make_docs, awkward):
    loop = " ".join(["\ta\nb c"] * 9)
    docs = make_docs([*awkward, (20, loop), (20, loop), (21, "x " + "Y y " * 8 + "z")]).withColumn("runs", F.lit("clash")).withColumn("id", F.lit(0))
    rows = runs.find_runs(docs).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in rows) == sorted((d is None, d or 0) for d, *_ in [*awkward, (20,), (20,), (21,)])
    by_id = {r["doc_id"]: r for r in rows}
    assert (by_id[1]["n_words"], by_id[1]["runs"], by_id[1]["collapsed"]) == (0, [], "")
    assert by_id[3]["collapsed"] == "" and by_id[9]["collapsed"] == "é ü 日本語 \x00 <|endoftext|>"
    assert [tuple(x) for x in by_id[20]["runs"]] == [(0, 27, 3)] and by_id[20]["collapsed"] == "a b c"
    assert by_id[21]["collapsed"] == "x Y y z" and by_id[6]["runs"] == []
    assert runs.find_runs(make_docs([])).collect() == []


def test_query_against_brute_force(spark, make_docs, tmp_path):
    texts = [(i, " ".join(f"w{(i * j) % 97}" for j in range(i % 60))) for i in range(400)] + [(500, None), (None, "a b " * 9)]
    make_docs(texts).write.parquet(str(tmp_path / "documents.parquet"))
    wanted = []
    for key, text in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        h, n = zlib.crc32(str(key).encode()), len(w)
        if key is not None and h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[a + (i - a) % p] if i >= a else w[i] for i in range(n)]
        found = brute(w)
        gone = {i for s, length, q in found for i in range(s + q, s + length)}
        top = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        wanted.append(
            (key, len(found), *(top or (None,) * 3), top and 1000 * top[1] // top[2],
             sha("".join(f"{s},{length},{q}\n" for s, length, q in found)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))
        )
    rows = Q.op11_periodic_runs(spark, str(tmp_path))
    assert sorted(map(tuple, rows.collect()), key=repr) == sorted(wanted, key=repr)


def test_only_one_arrow_pass(spark, make_docs):
    plan = runs.run_digest(runs.find_runs(make_docs([(1, "a")]).coalesce(1)))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "Aggregate" not in plan and "Join" not in plan
