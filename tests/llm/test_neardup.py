import random
import re
from collections import defaultdict

import numpy as np
import pytest
from helpers import awkward, make_docs  # noqa: F401
from pyspark.sql import functions as F

from martlet.llm import components, neardup


def brute(rows, size, percent=80):
    """(n_shingles, component) of every row by comparing all pairs that share a shingle."""
    sets = []
    for _, text, *_ in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))
        sets.append({tuple(words[i : i + size]) for i in range(len(words) - size + 1)} or ({tuple(words)} if words else set()))
    parent = {r[0]: r[0] for r in rows}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and None not in (rows[i][0], rows[j][0]) and 100 * both >= percent * len(a | sets[j]):
                x, y = top(rows[i][0]), top(rows[j][0])
                parent[max(x, y)] = min(x, y)
    return sorted(((r[0], len(s), None if r[0] is None else top(r[0])) for r, s in zip(rows, sets)), key=str)


def family(rand, first, copies):
    """A text and edited copies of it and of each other, so that links form chains."""
    texts = [[f"v{first}x{rand.randint(0, 10**6)}" for _ in range(rand.choice([5, 20, 60, 200]))]]
    for _ in range(copies):
        own = list(rand.choice(texts))
        for _ in range(rand.choice([0, 1, 1, 3])):
            own[rand.randrange(len(own))] = f"e{rand.randint(0, 10**6)}"
        texts.append(own)
    return [" ".join(t) for t in texts]


def mixed(seed):
    rand = random.Random(seed)
    texts = [t for k in range(25) for t in family(rand, k, rand.choice([0, 1, 3, 12]))]
    rand.shuffle(texts)
    return list(enumerate(texts))


def found(df):
    rows = df.collect()
    assert all(r["kept"] == (r["doc_id"] is None or r["doc_id"] == r["component_id"]) for r in rows)
    return sorted([(r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows], key=str)


@pytest.mark.parametrize("size", [4, 5])
def test_equals_brute_force(make_docs, size):
    rows = mixed(size)
    expected = brute(rows, size)
    assert sum(d != c for d, _, c in expected) > 30
    assert found(neardup.near_duplicates(make_docs(rows), size)) == expected


def test_blocked_families(make_docs, monkeypatch):
    """The same result if families are cut into blocks and their texts are shuffled."""
    rows = mixed(11)
    monkeypatch.setattr(neardup, "BLOCK_SHINGLES", 300)
    monkeypatch.setattr(neardup, "BROADCAST_MEMBERS", 0)
    assert found(neardup.near_duplicates(make_docs(rows), 4)) == brute(rows, 4)


@pytest.mark.parametrize("partitions", [1, 40])
def test_ranges_of_any_number(spark, make_docs, partitions):
    """Regions that reach over the border between ranges, and ranges without rows."""
    rows = mixed(13)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        assert found(neardup.near_duplicates(make_docs(rows), 4)) == brute(rows, 4)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.mark.parametrize("region_rows, neighbours", [(3, 2), (8, 1)])
def test_deep_regions(make_docs, monkeypatch, region_rows, neighbours):
    """Where regions are cut deeper, no link is made up, and at least 0.9 of the documents stay with their component."""
    monkeypatch.setattr(neardup, "REGION_ROWS", region_rows)
    monkeypatch.setattr(neardup, "NEIGHBOURS", neighbours)
    right = total = 0
    for seed in (21, 22, 23):
        rows = mixed(seed)
        true = {d: c for d, _, c in brute(rows, 4)}
        got = {d: c for d, _, c in found(neardup.near_duplicates(make_docs(rows), 4))}
        assert all(true[d] == true[c] for d, c in got.items())
        linked = [d for d, c in true.items() if d != c]
        right, total = right + sum(got[d] == true[d] for d in linked), total + len(linked)
    assert total > 100 and right >= 0.9 * total


def test_regions_by_hand(monkeypatch):
    """Prefixes of neighbours, and what is compared: all rows of short stretches, parts and neighbours of long ones."""
    rand = random.Random(6)
    labels = sorted([tuple(rand.choice([0, 1]) if k > 1 else 0 for k in range(16)) for _ in range(400)])
    tree = np.zeros(len(labels), np.int64)
    shared = neardup.shared_prefixes(tree, np.array(labels))
    plain = [next((k for k in range(16) if a[k] != b[k]), 16) for a, b in zip(labels, labels[1:])]
    assert shared.tolist() == plain
    assert neardup.shared_prefixes(np.array([0, 1]), np.zeros((2, 16))).tolist() == [-1]
    monkeypatch.setattr(neardup, "REGION_ROWS", 20)
    monkeypatch.setattr(neardup, "NEIGHBOURS", 4)
    got = list(neardup.regions(shared, 0, len(labels), 2))
    assert all(0 <= a < b <= len(labels) and b - a <= 20 for a, b in got)
    together = {(i, i + 1) for a, b in got for i in range(a, b - 1)}
    assert together == {(i, i + 1) for i in range(len(labels) - 1)}
    # Rows that share the most are together wherever their stretch is short enough.
    for first in range(0, 380, 7):
        end = first + next((k for k, s in enumerate(plain[first:]) if s < 12), 0) + 1
        if end - first <= 8:
            assert any(a <= first and end <= b for a, b in got)
    assert sum(b - a for a, b in got) <= 16 * 4 * len(labels)


def test_a_family_of_many_different_near_copies(make_docs, spark):
    """One component, and edges and rows in proportion to the documents, not to their pairs."""
    rand, base = random.Random(9), [f"w{i}" for i in range(100)]
    edges = {}
    for n in (5_000, 20_000):
        rows = []
        for i in range(n):
            own = list(base)
            own[rand.randrange(100)] = f"e{i}"
            rows.append((i, " ".join(own)))
        docs = make_docs(rows, 8)
        neardup.prepare(spark)
        nodes = neardup._signatures(docs, 4, "doc_id", "text").select(neardup.F.col("doc_id").alias("node"), "n_shingles", "signature", "sketch")
        edges[n] = neardup._candidates(nodes).count()
    assert edges[20_000] <= 4.5 * edges[5_000]
    assert neardup.near_duplicates(docs, 4).select("component_id").distinct().count() == 1


def test_awkward_rows(make_docs, awkward):
    docs = make_docs(awkward).withColumn("component_id", F.lit("clash")).withColumn("node", F.lit(1))
    assert found(neardup.near_duplicates(docs, 4)) == brute(awkward, 4)
    assert neardup.near_duplicates(docs.limit(0), 4).collect() == []


def test_rows_of_one_id_are_one_document(make_docs):
    a, b = (" ".join(f"{c}{i}" for i in range(30)) for c in "ab")
    rows = [(5, a), (3, b), (9, a), (9, b), (12, b)]
    assert {c for _, _, c in found(neardup.near_duplicates(make_docs(rows), 4))} == {3}


def test_drop_duplicates(make_docs, awkward):
    rows = mixed(3)
    kept = neardup.drop_duplicates(make_docs(rows))
    assert kept.columns == make_docs(rows).columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({c for _, _, c in brute(rows, 5)})
    left = neardup.drop_duplicates(make_docs(awkward)).select("doc_id").collect()
    assert sorted(str(r[0]) for r in left) == sorted("1 2 3 4 6 7 8 9 None".split())


def test_drop_duplicates_of_rows_without_an_id(make_docs):
    """Of every group one row stays, one with an id if there is any; rows without an id and words all stay."""
    rand = random.Random(8)
    rows = mixed(7)
    rows += [(1000 + i, t) for i, (_, t) in enumerate(rows[:40])]
    known = brute(rows, 5)
    of = {d: c for d, _, c in known}
    hidden = {d for d, _ in rows if rand.random() < 0.5} | {d for d, c in of.items() if c % 5 == 0}
    blank = [(None, None), (None, None), (None, ""), (None, " \n"), (None, " \n")]
    left = neardup.drop_duplicates(make_docs([(None if d in hidden else d, t) for d, t in rows] + blank))
    got = [(r["doc_id"], r["text"]) for r in left.collect()]
    groups = defaultdict(list)
    for d, _ in rows:
        groups[of[d]].append(d)
    named = [min(set(g) - hidden) for g in groups.values() if set(g) - hidden]
    nameless = [c for c, g in groups.items() if set(g) <= hidden]
    assert len(nameless) > 5 and sorted(d for d, _ in got if d is not None) == sorted(named)
    text_of = {t: of[d] for d, t in rows}
    assert sorted(text_of[t] for d, t in got if d is None and (t or "").split()) == sorted(nameless)
    assert sorted((r for r in got if r[0] is None and not (r[1] or "").split()), key=str) == sorted(blank, key=str)


def test_components_of_paths_and_stars(spark):
    rand = random.Random(5)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 160)] + [(200, 201), (201, 202), (202, 200)]
    edges += [(rand.randint(300, 340), rand.randint(300, 340)) for _ in range(30)]
    adjacent = defaultdict(set)
    for a, b in edges:
        if a != b:
            adjacent[a].add(b)
            adjacent[b].add(a)
    expected = {}
    for node in sorted(adjacent):
        stack = [] if node in expected else [node]
        while stack:
            at = stack.pop()
            if at not in expected:
                expected[at] = node
                stack += adjacent[at]
    got = components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r["node"]: r["component"] for r in got} == expected and len(got) == len(expected)
