import dataclasses
import hashlib
import random

import pytest
from helpers import awkward, make_docs  # noqa: F401
from pyspark.sql import functions as F

from martlet.llm import merkle

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def root_of(nodes):
    while len(nodes) > 1:
        nodes = [sha("".join(nodes[i : i + 16])) for i in range(0, len(nodes), 16)]
    return nodes[0]


def siblings(nodes, at):
    """The siblings of node ``at``, level by level, as (left, right)."""
    found = []
    while len(nodes) > 1:
        first = at - at % 16
        found.append((nodes[first:at], nodes[at + 1 : first + 16]))
        nodes, at = [sha("".join(nodes[i : i + 16])) for i in range(0, len(nodes), 16)], at // 16
    return found


def expected(rows, changed):
    """{(id, leaf): (subroot, root, proof, folded root)} by hand; ``changed`` turns a row into another, or None."""
    trees = {}
    for row in rows:
        trees.setdefault(row[1], []).append(row)
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    for s in order:
        trees[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
    leaves = {s: [leaf_of(r) for r in trees[s]] for s in order}
    subroots = [root_of(leaves[s]) for s in order]
    found = []
    for t, s in enumerate(order):
        for i, row in enumerate(trees[s]):
            way = siblings(leaves[s], i) + siblings(subroots, t)
            new = changed(row)
            node = leaf_of(row if new is None else new)
            for left, right in way:
                node = sha("".join([*left, node, *right]))
            found.append((row[0], leaves[s][i], subroots[t], root_of(subroots), sha("".join("".join(a + b) for a, b in way)), node))
    return sorted(found, key=repr)


def judged(spark, rows):
    """What the operator makes of rows, of which those whose id 3 divides change their text."""
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(4)
    docs = docs.withColumn("index", F.lit("clash")).withColumn("digest", F.lit(1)).withColumn("t", F.lit(2))
    leaf = merkle.leaf_digest([F.col(c) for c in FIELDS])
    other = merkle.leaf_digest([*[F.col(c) for c in FIELDS[:4]], F.concat("text", F.lit("!"))])
    manifest = merkle.build(docs, leaf, F.when(F.col("doc_id") % 3 == 0, other))
    found = merkle.versions(manifest).withColumn("folded", F.coalesce(F.element_at("copied", -1), F.col("root")))
    rows = found.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded").collect()
    return manifest, sorted(map(tuple, rows), key=repr)


def altered(row):
    return (*row[:4], None if row[4] is None else row[4] + "!") if row[0] is not None and row[0] % 3 == 0 else None


def test_small_and_awkward(spark, awkward):
    rows = [(d, s, "en", None, t) for (d, t, *_), s in zip(awkward, [None, "", "é", "a", "b", "a", "z", "z", None, "a", "Z"])]
    rows += [(i, "full", None, i, "") for i in range(16)] + [(i, "more", None, i, "x") for i in range(17)] + [(1, "z", "en", 0, "q")] * 2
    manifest, found = judged(spark, rows)
    assert found == expected(rows, altered)
    assert manifest.root == found[0][3]


@pytest.mark.parametrize("block", [16, 256])
def test_many_rounds_equal_one(spark, monkeypatch, block):
    """With small blocks, groups of one to four levels take several rounds; more sources than a block has nodes."""
    monkeypatch.setattr(merkle, "BLOCK", block)
    monkeypatch.setattr(merkle, "ROUND_LEVELS", {16: 1, 256: 2}[block])
    sizes = {"hot": 1200, "mid": 257, "edge": 256, "one": 1} | {f"s{i:02}": 1 + i % 3 for i in range(40)}
    rows = [(random.Random(f"{s}{i}").randrange(10**6), s, "en", i, f"text {s} {i}") for s, n in sizes.items() for i in range(n)]
    _, found = judged(spark, rows)
    assert found == expected(rows, altered)


def test_nodes_and_copies(spark):
    """The stored nodes are those of the tree; a version copies one node for each level and shares the others."""
    rows = [(i, "a", "en", i, f"t{i}") for i in range(600)]
    manifest, _ = judged(spark, rows)
    counts = {r["level"]: r["count"] for r in manifest.nodes.groupBy("level").count().collect()}
    assert counts == {1: 38, 2: 3, 3: 1}
    copied = merkle.versions(manifest).filter("copied is not null").select(F.size("copied")).distinct().collect()
    assert [tuple(r) for r in copied] == [(4,)]


def test_empty_table(spark):
    manifest, found = judged(spark, [])
    assert found == [] and manifest.root is None


def test_every_leaf_is_folded(spark):
    """Unchanged leaves are recomputed up to the root as well: where a sibling is not what it was, they do not verify."""
    rows = [(i, "a", "en", i, f"t{i}") for i in range(40)] + [(i, "b", "en", i, f"t{i}") for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    manifest = merkle.build(docs, merkle.leaf_digest([F.col(c) for c in FIELDS]))
    assert merkle.versions(manifest).filter("folded_root = root").count() == 43
    third = (F.col("id") == 3) & (F.col("n") == 40)
    spoiled = manifest.leaves.withColumn("digest", F.when(third, sha("other")).otherwise(F.col("digest")))
    found = merkle.versions(dataclasses.replace(manifest, leaves=spoiled)).groupBy("subroot", F.expr("folded_root = root")).count()
    assert sorted((r[1], r[2]) for r in found.collect()) == [(False, 40), (True, 3)]
