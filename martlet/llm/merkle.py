"""Merkle manifest of a dataset as a persistent tree: each changed leaf makes a version that shares all untouched nodes.

Shape: a leaf is the digest of a row. In each group (source), leaves ascend by id and every 16 consecutive nodes are hashed
into one, level by level, while several remain. The group roots, ordered by group, form a tree of the same kind above them.

How it is built and versioned, all by rounds of three levels:

* Rows are hashed where they lie; only digests move on. They are range-partitioned on (group, id), and a leaf's number
  in its group is its place in its range plus the rows of the ranges before.
* **Up.** 4,096 consecutive nodes of one group are an aligned block: a task hashes it to its root, and block roots are the nodes
  of the next round. No group of rows is larger than a block, whatever the share of a source.
* **Down.** Each block gets the siblings along the way from its root to the top, one short row handed on from the round above.
* **Versions.** A changed leaf copies its ancestors: first the three within its block, then, with the row handed down, those
  of the upper rounds. Everything else is shared with the tree that was there before. Upper versions are never gathered under their
  node: they are carried on in the tasks of their leaves.

Every table between the steps is written to the shared folder, so lost executors cost a read of it.

Defined cases: null columns count as ``-``; a null group comes first, a null id first in its group; rows of one id are ordered
by their digest, so equal rows are interchangeable; other columns of a row are ignored whatever their name;
an empty table has no root and an empty result.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martlet.llm.text import prepare
from martlet.session import scratch_path

#: Nodes that one node stands for, levels of one round, and nodes of an aligned block.
FAN_OUT = 16
ROUND_LEVELS = 3
BLOCK = FAN_OUT**ROUND_LEVELS

_STEP = "struct<left: string, right: string>"
_NODE = "t long, level int, index long, digest string, n long, top boolean"
_ABOVE = f"t long, block long, subroot string, path array<{_STEP}>"


def leaf_digest(columns: list[Column]) -> Column:
    """SHA-256 (hex) of the columns as text, each ``-`` if null, else its UTF-8 byte count, ``:`` and itself."""
    texts = [c.cast("string") for c in columns]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def height(n: int) -> int:
    """Levels above ``n`` nodes until one remains."""
    levels = 0
    while n > 1:
        n, levels = -(-n // FAN_OUT), levels + 1
    return levels


def levels_above(digests: list[str], levels: int) -> list[list[str]]:
    """``digests`` and the nodes of so many levels above them."""
    tree = [digests]
    for _ in range(levels):
        below = tree[-1]
        tree.append([digest("".join(below[i : i + FAN_OUT])) for i in range(0, len(below), FAN_OUT)])
    return tree


def way_up(tree: list[list[str]], at: int) -> list[tuple[str, str]]:
    """For each level but the last, the siblings to the left and right of the ancestor of node ``at``."""
    way = []
    for nodes in tree[:-1]:
        first = at - at % FAN_OUT
        way.append(("".join(nodes[first:at]), "".join(nodes[at + 1 : first + FAN_OUT])))
        at //= FAN_OUT
    return way


def fold_up(leaf: str, way: list[tuple[str, str]]) -> list[str]:
    """``leaf`` and its ancestors, recomputed from it and the siblings on its ``way`` up."""
    nodes = [leaf]
    for left, right in way:
        nodes.append(digest(left + nodes[-1] + right))
    return nodes


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, f"merkle-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _numbered(rows: DataFrame, group: str, order: list[Column], number: str, name: str) -> DataFrame:
    """``rows`` with their number, from 0, in their group: place in a sorted range and rows of the ranges before."""
    bit = 33  # monotonically_increasing_id keeps the place in a partition below it
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id())
    stored = _stored(ranged, name)
    shard = F.shiftright("place", bit)
    parts = stored.groupBy(shard.alias("shard"), F.col(group).alias("g")).agg(F.min("place").alias("first"), F.count("*").alias("rows"))
    # One row for each range that a group reaches into.
    before = Window.partitionBy("g").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("shard", "g", (F.coalesce(F.sum("rows").over(before), F.lit(0)) - F.col("first")).alias("shift"))
    joined = stored.withColumn("of", shard).join(parts, (F.col("of") == F.col("shard")) & F.col(group).eqNullSafe(F.col("g")))
    return joined.withColumn(number, F.col("place") + F.col("shift")).drop("of", "place", "shard", "g", "shift")


def _hash_blocks(nodes: DataFrame, base: int) -> DataFrame:
    """The nodes of up to three levels above level ``base``, block by block."""

    def climb(table: pa.Table) -> pa.Table:
        table = table.sort_by("index")
        t, n, first = (table[c][0].as_py() for c in ("t", "n", "index"))
        top = height(n)
        tree = levels_above(table["digest"].to_pylist(), min(ROUND_LEVELS, top - base))
        rows = []
        for k, level in enumerate(tree):
            if k or top == 0:
                start = first // FAN_OUT**k
                rows += [(t, base + k, start + i, d, n, base + k == top) for i, d in enumerate(level)]
        return pa.table(dict(zip(("t", "level", "index", "digest", "n", "top"), zip(*rows))), schema=_NODE_ARROW)

    return nodes.groupBy("t", F.floor(F.col("index") / BLOCK)).applyInArrow(climb, _NODE)


_NODE_ARROW = pa.schema([("t", pa.int64()), ("level", pa.int32()), ("index", pa.int64()), ("digest", pa.string()), ("n", pa.int64()), ("top", pa.bool_())])


def _climb(leaves: DataFrame, most: int, name: str) -> tuple[list[DataFrame], DataFrame]:
    """The nodes that each round starts from, and all nodes above the leaves. ``most``: leaves of the largest tree."""
    rounds, made = [leaves], []
    while True:
        base = ROUND_LEVELS * (len(rounds) - 1)
        made.append(_stored(_hash_blocks(rounds[-1].select("t", "index", "digest", "n"), base), f"{name}-nodes"))
        if height(most) <= base + ROUND_LEVELS:
            break
        rounds.append(made[-1].filter(F.col("level") == base + ROUND_LEVELS).filter(~F.col("top")))
    nodes = made[0]
    for more in made[1:]:
        nodes = nodes.unionByName(more)
    return rounds, nodes


def _hand_down(nodes: DataFrame, above: DataFrame, base: int) -> DataFrame:
    """``above`` of every node of a round, from ``above`` of its blocks: a node is a block of the round below."""

    def extend(own: pa.Table, handed: pa.Table) -> pa.Table:
        own = own.sort_by("index")
        row = handed.slice(0, 1).to_pylist()[0]
        indexes = own["index"].to_pylist()
        tree = levels_above(own["digest"].to_pylist(), min(ROUND_LEVELS, height(own["n"][0].as_py()) - base))
        paths = [[{"left": a, "right": b} for a, b in way_up(tree, i)] + row["path"] for i in range(len(indexes))]
        columns = {"t": [row["t"]] * len(indexes), "block": indexes, "subroot": [row["subroot"]] * len(indexes), "path": paths}
        return pa.table(columns, schema=_ABOVE_ARROW)

    return _by_block(nodes).cogroup(above.groupBy("t", "block")).applyInArrow(extend, _ABOVE)


_ABOVE_ARROW = pa.schema(
    [("t", pa.int64()), ("block", pa.int64()), ("subroot", pa.string()), ("path", pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())])))]
)


def _by_block(nodes: DataFrame):
    return nodes.withColumn("block", F.floor(F.col("index") / BLOCK)).groupBy("t", "block")


def _above_leaf_blocks(rounds: list[DataFrame], tops: DataFrame) -> DataFrame:
    """``above`` of the blocks of round 0, from ``tops``: t, n, subroot and path of every tree."""
    above = None
    last_round = sum((F.col("n") > BLOCK**k).cast("int") for k in range(1, len(rounds))) if len(rounds) > 1 else F.lit(0)
    for k in range(len(rounds) - 1, -1, -1):
        ending = tops.filter(last_round == k).select("t", F.lit(0).cast("long").alias("block"), "subroot", "path")
        above = ending if above is None else _stored(above, "above").unionByName(ending)
        if k:
            above = _hand_down(rounds[k].select("t", "index", "digest", "n"), above, ROUND_LEVELS * k)
    return above


@dataclass(frozen=True)
class Manifest:
    """A stored tree. ``leaves``: t, index, id, digest, changed, n; ``nodes``: all nodes above them; ``groups``: t, its group and size."""

    leaves: DataFrame
    nodes: DataFrame
    groups: DataFrame
    root: str | None
    rounds: list[DataFrame]
    tops: DataFrame


def build(docs: DataFrame, leaf: Column, changed: Column | None = None, group_col: str = "source", id_col: str = "doc_id") -> Manifest:
    """The tree over ``docs``. ``leaf`` is the digest of a row, ``changed`` that of its changed form (null: unchanged)."""
    prepare(docs.sparkSession, rows=10_000)
    none = F.lit(None).cast("string")
    rows = docs.select(
        F.col(group_col).alias("tree"), F.col(id_col).alias("id"), leaf.alias("digest"), (none if changed is None else changed).alias("changed")
    )
    # Stored first, so that texts are hashed once; the number spreads rows that are alike.
    rows = _stored(rows.withColumn("row", F.monotonically_increasing_id()), "digests")
    in_group = [F.col("tree").asc_nulls_first(), F.col("id").asc_nulls_first(), F.col("digest"), F.col("row")]
    placed = _numbered(rows, "tree", in_group, "index", "placed")
    sizes = placed.groupBy("tree").agg(F.count("*").alias("n")).withColumn("all", F.lit(0))
    groups = _stored(_numbered(sizes, "all", [F.col("tree").asc_nulls_first()], "t", "groups").drop("all"), "sizes")
    named = groups.select(F.col("tree").alias("named"), "t", "n")
    leaves = _stored(placed.join(named, F.col("tree").eqNullSafe(F.col("named"))).drop("named", "tree", "row"), "leaves")

    most, count = groups.agg(F.max("n"), F.count("*")).first()
    rounds, nodes = _climb(leaves, most or 0, "group")
    subroots = _stored(nodes.filter("top").select("t", "digest"), "subroots")
    upper = subroots.select(F.lit(0).cast("long").alias("t"), F.col("t").alias("index"), "digest", F.lit(count).cast("long").alias("n"))
    upper_rounds, upper_nodes = _climb(upper, count, "upper")
    root = upper_nodes.filter("top").first()
    root = root["digest"] if root else None

    spark = docs.sparkSession
    summit = spark.createDataFrame([(0, count, root, [])], f"t long, n long, subroot string, path array<{_STEP}>")
    upper_above = _stored(_above_leaf_blocks(upper_rounds, summit), "above")
    paths = _hand_down(upper_rounds[0].select("t", "index", "digest", "n"), upper_above, 0).select(F.col("block").alias("t"), "path")
    tops = groups.select("t", "n").join(subroots.withColumnRenamed("digest", "subroot"), "t").join(paths, "t")
    return Manifest(leaves, nodes, groups.withColumnRenamed("tree", group_col), root, rounds, _stored(tops, "tops"))


def versions(manifest: Manifest, id_col: str = "doc_id") -> DataFrame:
    """Every leaf with its proof and, where it changed, the nodes that its version copies.

    ``id_col``, ``leaf``, ``subroot``, ``root``, ``proof_sha256`` (of all siblings on the way to the root, level by level, left to right)
    ``copied``: the digests from the changed leaf up to the version's root, null for an unchanged leaf; and ``folded_root``: the root
    that the leaf as it is now, changed or not, and the siblings give.
    """

    def fold(own: pa.Table, handed: pa.Table) -> pa.Table:
        own = own.sort_by("index")
        row = handed.slice(0, 1).to_pylist()[0]
        leaves = own["digest"].to_pylist()
        tree = levels_above(leaves, min(ROUND_LEVELS, height(own["n"][0].as_py())))
        upper = [(step["left"], step["right"]) for step in row["path"]]
        proofs, copies, folded = [], [], []
        for i, changed in enumerate(own["changed"].to_pylist()):
            way = way_up(tree, i) + upper
            proofs.append(digest("".join(left + right for left, right in way)))
            ancestors = fold_up(leaves[i] if changed is None else changed, way)
            copies.append(None if changed is None else ancestors)
            folded.append(ancestors[-1])
        columns = [
            own["id"], own["digest"], pa.array([row["subroot"]] * len(leaves)), pa.array(proofs), pa.array(copies, pa.list_(pa.string())),
            pa.array(folded, pa.string()),
        ]
        return pa.table(columns, names=["id", "leaf", "subroot", "proof_sha256", "copied", "folded_root"])

    above = _stored(_above_leaf_blocks(manifest.rounds, manifest.tops), "above")
    id_type = manifest.leaves.schema["id"].dataType.simpleString()
    schema = f"id {id_type}, leaf string, subroot string, proof_sha256 string, copied array<string>, folded_root string"
    own = manifest.leaves.select("t", "index", "id", "digest", "changed", "n")
    found = _by_block(own).cogroup(above.groupBy("t", "block")).applyInArrow(fold, schema)
    return found.select(F.col("id").alias(id_col), "leaf", "subroot", F.lit(manifest.root).alias("root"), "proof_sha256", "copied", "folded_root")
