import gc
import random
import re
import weakref

import numpy as np
from helpers import awkward, make_docs, numbered  # noqa: F401
from pyspark.sql import functions as F

from martlet.llm import contamination


def brute(docs, items, percent=80):
    def shingles(text):
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
        return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}

    out = []
    for d, text, *_ in docs:
        whole = shingles(text)
        for i, item in items:
            own = shingles(item)
            if own and 100 * len(own & whole) >= percent * len(own):
                out.append((d, i, len(own & whole), len(own)))
    return sorted(out, key=str)


def found(df):
    return sorted([(r["doc_id"], r["item_id"], r["shared"], r["item_shingles"]) for r in df.collect()], key=str)


def planted(seed):
    """Items of many sizes, whole and damaged, at any place of documents of many sizes."""
    rand = random.Random(seed)
    word = lambda: f"{rand.choice('abcdefgh')}{rand.randint(0, 400)}"
    items = [(i, " ".join(word() for _ in range(rand.choice([3, 5, 6, 12, 30, 70, 300])))) for i in range(30)]
    docs = []
    for d in range(120):
        words = [word() for _ in range(rand.choice([4, 40, 400, 3000]))]
        for _ in range(rand.randint(0, 2)):
            own = rand.choice(items)[1].split()
            for at in rand.sample(range(len(own)), k=min(len(own), rand.choice([0, 0, 1, 2]))):
                own[at] = "changed"
            at = rand.randint(0, len(words))
            words[at:at] = [w.upper() if rand.random() < 0.1 else w for w in own]
        docs.append((d, " ".join(words)))
    return docs, items


def test_equals_brute_force(spark, make_docs):
    docs, items = planted(1)
    table = spark.createDataFrame(items, "item_id long, text string")
    expected = brute(docs, items)
    assert len(expected) > 20
    assert found(contamination.find_contained(make_docs(docs), table)) == expected
    # Items in many blocks give the same.
    assert found(contamination.find_contained(make_docs(docs), table, shingles_per_block=300)) == expected


def test_drop_keeps_the_rest(spark, make_docs):
    docs, items = planted(2)
    table = spark.createDataFrame(items, "item_id long, text string")
    bad = {d for d, *_ in brute(docs, items)}
    left = contamination.drop_contained(make_docs(docs), table)
    assert left.columns == make_docs(docs).columns
    assert sorted(r["doc_id"] for r in left.collect()) == sorted({d for d, _ in docs} - bad)


def test_one_block_at_a_time(spark, make_docs, monkeypatch):
    """However many blocks the items make, one index exists when the next is built, and rows that repeat all go or stay."""
    docs, items = planted(3)
    docs = docs + docs[:20] + [(None, None), (None, docs[0][1]), (7, None)]
    table = spark.createDataFrame(items, "item_id long, text string")
    real, alive, others = contamination.ItemIndex, weakref.WeakSet(), []

    def built(*given):
        gc.collect()
        others.append(len(alive))
        index = real(*given)
        alive.add(index)
        return index

    monkeypatch.setattr(contamination, "ItemIndex", built)
    expected = brute(docs, items)
    assert found(contamination.find_contained(make_docs(docs), table, shingles_per_block=300)) == expected
    assert len(others) > 3 and max(others) == 0
    others.clear()
    left = contamination.drop_contained(make_docs(docs), table, shingles_per_block=300)
    assert len(others) > 3 and max(others) == 0
    clean = [d for d, t in docs if not brute([(d, t)], items)]
    assert left.columns == make_docs(docs).columns and sorted(map(str, clean)) == sorted(str(r["doc_id"]) for r in left.collect())


def test_awkward_rows(spark, make_docs, awkward):
    items = [(1, None), (2, ""), (3, "one"), (None, numbered(100, 40)), (5, numbered(50_000, 80)), (5, numbered(50_000, 80))]
    table = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(1))
    docs = make_docs(awkward).withColumn("item_id", F.lit("clash"))
    assert found(contamination.find_contained(docs, table)) == brute(awkward, items)
    none = table.limit(0)
    assert contamination.find_contained(docs, none).collect() == []
    assert contamination.drop_contained(docs, none).count() == len(awkward)
    assert contamination.find_contained(docs.limit(0), table).collect() == []


def test_windows_cover_every_run():
    """Any run of as many shingles as the class holds lies inside one window."""
    index = contamination.ItemIndex([np.arange(1, 6, dtype=np.uint64)])
    for n in (1, 4, 5, 9, 10, 11, 23):
        shingles = np.arange(n, dtype=np.uint64)
        for size in (1, 2, 3, 5):
            windows = list(index._windows(shingles, np.arange(n), size))
            for a in range(n):
                run = set(range(a, min(n, a + size)))
                assert any(run <= set(w.tolist()) for w in windows)
