"""Near-duplicate detection: MinHash signatures in an LSH forest, links confirmed on full shingle sets.

1. One pass turns every text into the set of its distinct shingles, a fingerprint of that set and a MinHash
   signature. Documents with equal sets are one *node* from here on, so copies, however many, cost
   one row each and no pair.
2. The forest: ``TREES`` orders of the signatures, each sorted, in ranges, by the MinHash values from its own first one on. In
   each order the longest common prefixes of neighbours are computed, and a region is a stretch whose neighbours share at
   least ``MIN_DEPTH`` values. Two sets of similarity 0.8 share such a prefix in at least one order with a probability of
   1 - (1 - 0.8^4)^24 = 0.999997. Inside a region, byte sketches of the signatures tell which rows may be similar, walking
   from row to row over those not yet reached, so a region of mutual near copies costs a few passes and not all pairs.
   A region of more than ``REGION_ROWS`` is cut where its neighbours share fewer values than a greater depth, each part as deep
   as its own size asks, up to ``MAX_DEPTH``; neighbours on both sides of a cut are compared too, and so are those on both
   sides of the border between two ranges. The work is proportional to the rows, whatever the size of a family.
   What a deep cut separates in one order meets in others: at depth d, with a probability of 1 - (1 - s^d)^24.
3. Connected rows of all orders are families. The texts of families, and only they, are read again, and
   each family's links are found on the full sets, exactly, again from row to row over those
   not yet reached. A family of many shingles is cut into blocks, each of which meets the first one; the rows that are not in the
   family's largest component by then, few in a family of near copies, meet all of its blocks. So no link is lost, and
   a family of near copies costs its texts about twice.
4. Components of the confirmed links give every document the smallest id it can reach.

Defined cases: a text with fewer words than a shingle is its whole word sequence; a null text or one without words
has no shingles, is linked with nothing and is its own component. Rows that share a doc_id are one document
with the links of all its rows. A row without a doc_id is linked with nothing and has no component, but is
kept. Ties do not arise: the smallest id stands for a group. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlet.llm.components import connected_components
from martlet.llm.text import by_position, mix, prepare, shingle_sets, tidied
from martlet.session import scratch_path

#: Orders, values from the start of one to that of the next, and the least and most values that rows of a region share.
TREES, STEP, MIN_DEPTH, MAX_DEPTH = 24, 6, 4, 16
#: Bytes that are kept of a MinHash value; four of them are as good as a hash of all of their bits.
VALUE = 2
#: Rows beyond which a region is taken deeper, and rows on either side of a cut that are compared.
REGION_ROWS, NEIGHBOURS = 1_000, 16
#: Bytes of a sketch, and the share of equal ones below which a pair is taken not to be similar: 5 deviations under 0.8.
SKETCH, SKETCH_SHARE = 96, 0.6
#: Shingles of a block of a family.
BLOCK_SHINGLES = 250_000
#: Most members of families that are sent to all tasks instead of joined by shuffling the texts.
BROADCAST_MEMBERS = 500_000

_SEEDS = np.random.RandomState(11).randint(0, 2**32, TREES * STEP, dtype=np.int64).astype(np.uint32) | np.uint32(1)
_SHIFTS = np.random.RandomState(12).randint(0, 2**32, TREES * STEP, dtype=np.int64).astype(np.uint32)


def minhash(shingles: np.ndarray) -> np.ndarray:
    """The smallest of each permuted 32-bit image of the shingles."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    best = np.full(len(_SEEDS), 0xFFFFFFFF, np.uint32)
    for at in range(0, len(x), 2048):
        images = (x[at : at + 2048, None] ^ _SHIFTS) * _SEEDS
        images ^= images >> np.uint32(15)
        images *= np.uint32(0x2C1B3C6D)
        np.minimum(best, images.min(axis=0), out=best)
    return best


def _signatures(docs: DataFrame, size: int, id_col: str, text_col: str) -> DataFrame:
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salt = np.uint64(0xD6E8FEB86659FD93)
        for batch in batches:
            counts, first, second, signatures, sketches = [], [], [], [], []
            for own in shingle_sets(batch.column("text"), size):
                counts.append(len(own))
                first.append(int(own.sum().astype(np.int64)))
                second.append(int(mix(own ^ salt).sum().astype(np.int64)))
                best = minhash(own)
                signatures.append((best & np.uint32(0xFFFF)).astype(">u2").tobytes())
                sketches.append(best[:SKETCH].astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(x, pa.int64()) for x in (counts, first, second)], *[pa.array(x, pa.binary()) for x in (signatures, sketches)]],
                schema.names,
            )

    schema = T.StructType(
        [
            T.StructField("doc_id", T.LongType()),
            *[T.StructField(c, T.LongType()) for c in ("n_shingles", "fp1", "fp2")],
            T.StructField("signature", T.BinaryType()),
            T.StructField("sketch", T.BinaryType()),
        ]
    )
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    path = scratch_path(docs.sparkSession, "signatures")
    rows.mapInArrow(tidied(sign), schema).write.parquet(path)
    return docs.sparkSession.read.parquet(path)


def _walk(n: int, alike) -> Iterator[tuple[int, np.ndarray]]:
    """(root, members) of the components of n rows; ``alike(i, rest)`` tells which of ``rest`` row i is linked with."""
    rest = np.arange(n)
    while len(rest):
        root, rest = rest[0], rest[1:]
        members, queue = [root], [root]
        while queue and len(rest):
            hit = alike(queue.pop(), rest)
            new, rest = rest[hit], rest[~hit]
            queue.extend(new)
            members.extend(new)
        yield root, np.array(members)


def _alike(sketches: np.ndarray, i: int, rest: np.ndarray) -> np.ndarray:
    return (sketches[rest] == sketches[i]).sum(axis=1) >= int(SKETCH_SHARE * SKETCH)


def _stacked(sketches) -> np.ndarray:
    return np.frombuffer(b"".join(sketches), np.uint8).reshape(len(sketches), -1)


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _forest(nodes: DataFrame) -> DataFrame:
    """One row for each node and order, in ranges sorted by order and label: ``MAX_DEPTH`` MinHash values from the order's first on."""
    trees = nodes.select("node", "signature", "sketch", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree"))
    ring = F.expr(f"concat(signature, substring(signature, 1, {VALUE * MAX_DEPTH}))")
    label = F.substring(ring, F.col("tree") * (VALUE * STEP) + 1, F.lit(VALUE * MAX_DEPTH))
    rows = trees.select("tree", label.alias("label"), "node", "sketch")
    # A range holds rows of one order, or of two where one order ends in it.
    ranges = max(TREES, int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return rows.repartitionByRange(ranges, "tree", "label", "node").sortWithinPartitions("tree", "label", "node")


def shared_prefixes(tree: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """For each row but the first, how many leading values of its label are those of the row before; -1 in another order."""
    same = labels[1:] == labels[:-1]
    return np.where(tree[1:] == tree[:-1], np.logical_and.accumulate(same, axis=1).sum(axis=1), -1)


def regions(shared: np.ndarray, first: int, end: int, depth: int) -> Iterator[tuple[int, int]]:
    """Stretches of rows ``first`` to ``end``, which share ``depth`` values, that are to be compared among themselves.

    A stretch of up to ``REGION_ROWS`` is one. A longer one is cut where neighbours share no more than ``depth`` values, and its parts
    are taken at the next depth, each as deep as its own size asks; the rows on both sides of a cut are neighbours of
    the lesser depth and compared as well. Rows that share all values of the label are taken by overlapping parts.
    """
    if end - first <= REGION_ROWS:
        yield first, end
    elif depth == MAX_DEPTH:
        for at in range(first, end - 1, REGION_ROWS - 1):
            yield at, min(at + REGION_ROWS, end)
    else:
        # shared[i] is of rows i and i + 1
        cuts = first + 1 + np.flatnonzero(shared[first : end - 1] <= depth)
        edges = [first, *cuts.tolist(), end]
        for a, b in zip(edges[:-1], edges[1:]):
            if b - a > 1:
                yield from regions(shared, a, b, depth + 1)
        for step in np.unique(cuts // NEIGHBOURS).tolist():
            yield max(first, (step - 1) * NEIGHBOURS), min(end, (step + 2) * NEIGHBOURS)


def _edges(tree: np.ndarray, labels: np.ndarray, ids: np.ndarray, sketches: np.ndarray) -> np.ndarray:
    """Edges (a, b) that connect the rows of sorted stretches which may be similar."""
    shared, found = shared_prefixes(tree, labels), []
    ends = np.concatenate([[0], np.flatnonzero(shared < MIN_DEPTH) + 1, [len(ids)]])
    for at in np.flatnonzero(np.diff(ends) > 1).tolist():
        for a, b in regions(shared, int(ends[at]), int(ends[at + 1]), MIN_DEPTH):
            for _, members in _walk(b - a, lambda i, rest, own=sketches[a:b]: _alike(own, i, rest)):
                if len(members) > 1:
                    own = ids[a:b][members]
                    low = own.min()
                    found.append(np.stack([own[own != low], np.full((own != low).sum(), low)], axis=1))
    return np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 2), np.int64)


def _columns(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    labels = np.frombuffer(b"".join(rows["label"].to_pylist()), f">u{VALUE}").reshape(len(rows), MAX_DEPTH)
    return rows["tree"].to_numpy(), labels, rows["node"].to_numpy(), _stacked(rows["sketch"].to_pylist())


_BORDER = "tree int, label binary, node long, sketch binary"


def _candidates(nodes: DataFrame) -> DataFrame:
    """Edges (a, b) that connect nodes which may be similar: those of each range, and those over the borders between ranges."""
    names = ["a", "b", "part", "head", "tree", "label", "node", "sketch"]

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, first, last = TaskContext.get().partitionId(), None, None, None

        def settle(rows: pa.Table) -> pa.RecordBatch:
            pairs = _edges(*_columns(rows))
            none = [pa.nulls(len(pairs), t) for t in (pa.int32(), pa.bool_(), pa.int32(), pa.binary(), pa.int64(), pa.binary())]
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1]), *none], names)

        def border(rows: pa.Table, head: bool) -> pa.RecordBatch:
            rows, n = rows.combine_chunks(), len(rows)
            own = [pa.nulls(n, pa.int64())] * 2 + [pa.array([part] * n, pa.int32()), pa.array([head] * n)]
            return pa.RecordBatch.from_arrays([*own, *[rows[c].chunk(0) for c in names[4:]]], names)

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch])
            first = rows if first is None else pa.concat_tables([first, rows.slice(0, NEIGHBOURS)])
            first = first.slice(0, NEIGHBOURS)
            last = rows if last is None else pa.concat_tables([last, rows])
            last = last.slice(max(0, len(last) - NEIGHBOURS))
            held = rows if held is None else pa.concat_tables([held, rows]).combine_chunks()
            # The last stretch may go on in the next batch.
            tree, label = held["tree"].chunk(0), held["label"].chunk(0)
            prefix = pc.binary_slice(label, 0, VALUE * MIN_DEPTH)
            same = pc.and_(pc.equal(prefix, prefix[-1]), pc.equal(tree, tree[-1]))
            whole = len(held) - int(pc.sum(same).as_py())
            if whole:
                yield settle(held.slice(0, whole).combine_chunks())
                held = held.slice(whole)
        if held is not None:
            yield settle(held.combine_chunks())
            yield border(first, True)
            yield border(last, False)

    made = _forest(nodes).mapInArrow(tidied(walk), f"a long, b long, part int, head boolean, {_BORDER}")
    made = _stored(made, "candidates")
    borders = made.filter("part is not null")
    # One row for each range; ranges without rows have none, so the next is the next number there is.
    after = Window.orderBy("part")
    parts = borders.groupBy("part").agg(F.count("*").alias("n")).select(F.col("part").alias("before"), F.lead("part").over(after).alias("after"))
    tails = borders.filter("not head").select(F.col("part").alias("border"), *names[4:])
    heads = borders.filter("head").join(parts, F.col("part") == F.col("after")).select(F.col("before").alias("border"), *names[4:])

    def over(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("tree", "ascending"), ("label", "ascending"), ("node", "ascending")]).combine_chunks()
        pairs = _edges(*_columns(rows))
        return pa.table({"a": pa.array(pairs[:, 0]), "b": pa.array(pairs[:, 1])})

    crossing = tails.unionByName(heads).groupBy("border").applyInArrow(over, "a long, b long")
    return made.filter("a is not null").select("a", "b").unionByName(crossing)


def exact_components(sets: list[np.ndarray], percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """Components of sets linked by 100 * |a and b| >= percent * |a or b|."""
    sizes = np.array([len(s) for s in sets], np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)

    def alike(i: int, rest: np.ndarray) -> np.ndarray:
        own, hit = sets[i], np.zeros(len(rest), bool)
        near = (100 * sizes[rest] >= percent * len(own)) & (100 * len(own) >= percent * sizes[rest])
        others = rest[near]
        if len(others):
            ends = np.cumsum(sizes[others])
            at = np.repeat(starts[others] - (ends - sizes[others]), sizes[others]) + np.arange(ends[-1])
            place = np.minimum(np.searchsorted(own, flat[at]), len(own) - 1)
            shared = np.add.reduceat((own[place] == flat[at]).astype(np.int64), ends - sizes[others])
            hit[near] = 100 * shared >= percent * (len(own) + sizes[others] - shared)
        return hit

    return _walk(len(sets), alike)


def _links(docs: DataFrame, families: DataFrame, sizes: DataFrame, size: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """Edges (a, b) that connect the nodes of each family whose full sets are linked."""

    def blocks_of(weight: Column) -> Column:
        return F.greatest(F.ceil(weight / BLOCK_SHINGLES).cast("int"), F.lit(1))

    weighed = families.join(sizes, "node")
    weights = weighed.groupBy("component").agg(blocks_of(F.sum("n_shingles")).alias("blocks"))
    members = _stored(weighed.join(weights, "component").select("node", "component", "blocks", "n_shingles"), "families")
    texts = docs.select(F.col(id_col).cast("long").alias("node"), F.col(text_col).alias("text"))

    def with_texts(rows: DataFrame) -> DataFrame:
        return texts.join(F.broadcast(rows) if rows.count() <= BROADCAST_MEMBERS else rows, "node")

    def confirm(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.drop_duplicates(["node", "text"])
        ids = rows["node"].to_numpy()
        order = np.argsort(ids, kind="stable")
        sets = list(shingle_sets(pa.array(rows["text"].to_numpy()[order], pa.large_string()), size))
        used = [k for k in range(len(sets)) if len(sets[k])]
        pairs = []
        for root, found in exact_components([sets[k] for k in used], percent):
            at = ids[order][[used[k] for k in found]]
            pairs += [(int(x), int(at.min())) for x in at if x != at.min()]
        return pd.DataFrame(pairs, columns=["a", "b"], dtype="int64")

    # Each block of a family meets the first one: a row goes to its own group, one of the first block to all.
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    groups = F.when(F.col("own") == 0, F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array("own"))
    met = with_texts(members.select("node", "component", "blocks", own.alias("own")))
    met = met.select("node", "text", "component", F.explode(groups).alias("block"))
    links = met.groupBy("component", "block").applyInPandas(confirm, "a long, b long")
    large = members.filter("blocks > 1")
    if not large.limit(1).count():
        return links

    # Rows of a large family outside its largest component by now, of which a family of near copies has few, meet all of its rows.
    links = _stored(links, "links")
    held = connected_components(links).withColumnRenamed("component", "part")
    held = _stored(large.join(held, "node", "left").withColumn("part", F.coalesce("part", "node")), "large-families")
    counts = held.groupBy("component", "part").agg(F.count("*").alias("n"))
    main = counts.groupBy("component").agg(F.max(F.struct("n", "part"))["part"].alias("main"))
    held = held.join(main, "component").withColumn("minor", F.col("part") != F.col("main"))
    rest = held.filter("minor").groupBy("component").agg(blocks_of(F.sum("n_shingles")).alias("minor_blocks"))
    rest = _stored(rest, "minor-blocks")
    if not rest.limit(1).count():
        return links
    held = held.join(rest, "component")
    all_rows = held.select("node", "component", F.explode(F.sequence(F.lit(0), F.col("minor_blocks") - 1)).alias("i"), own.alias("j"))
    block = F.pmod(F.xxhash64("node"), F.col("minor_blocks")).cast("int")
    minors = held.filter("minor").select("node", "component", block.alias("i"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("j"))
    spread = with_texts(_stored(all_rows.unionByName(minors).distinct(), "minors"))
    return links.unionByName(spread.groupBy("component", "i", "j").applyInPandas(confirm, "a long, b long"))


def near_duplicates(
    docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` and ``kept`` (the smallest id of a component) of every row."""
    prepare(docs.sparkSession)
    signed = _signatures(docs, size, id_col, text_col)
    full = signed.filter("n_shingles > 0 and doc_id is not null")
    groups = full.groupBy("fp1", "fp2").agg(F.min("doc_id").alias("node"))
    groups = _stored(groups, "nodes")
    nodes = full.join(groups.withColumn("doc_id", F.col("node")), ["fp1", "fp2", "doc_id"])
    nodes = nodes.select("node", "n_shingles", "signature", "sketch")

    families = connected_components(_candidates(nodes))
    links = _links(docs, families, nodes.select("node", "n_shingles"), size, percent, id_col, text_col)
    copies = full.join(groups, ["fp1", "fp2"]).select(F.col("doc_id").alias("a"), F.col("node").alias("b"))
    shared = copies.groupBy("a").agg(F.min("b").alias("low"), F.max("b").alias("high")).filter("low < high")
    # Only an id that several different texts carry joins their nodes.
    joined = copies.join(shared.select("a"), "a", "left_semi")
    components = connected_components(links.unionByName(joined))

    placed = copies.groupBy("a").agg(F.min("b").alias("node")).join(components, "node", "left")
    placed = placed.select(F.col("a").alias("doc_id"), F.coalesce("component", "node").alias("component_id"))
    placed = placed.filter("component_id <> doc_id")
    rows = signed.select("doc_id", "n_shingles").join(placed, "doc_id", "left")
    component = F.coalesce("component_id", "doc_id")
    return rows.select(
        "doc_id", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept")
    )


def drop_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each component, the one with the smallest id; columns as they are.

    Rows that share an id are one document, so of repeated rows one stays, and of different texts under
    the smallest id of a component the one with the smallest hash; of equal texts, the hash of all columns decides. Rows without an id are searched under a number from their
    text, 2 ** 62 or more, so that rows with a smaller id stay rather than they; equal ones are repeated rows. They keep their NULL.
    Those without an id and without words are copies of nothing and all stay.
    """
    own = [f"c{i}" for i in range(len(docs.columns))]
    text, key = (F.col(own[docs.columns.index(c)]) for c in (text_col, id_col))
    surrogate = F.xxhash64(text).bitwiseAND(F.lit(2**62 - 1)).bitwiseOR(F.lit(2**62))
    numbered = F.coalesce(key.cast("long"), F.when(text.rlike(r"[^\x20\x09-\x0D]"), surrogate))
    rows = by_position(docs).withColumn("node", numbered)
    found = near_duplicates(rows.select("node", text.alias("text")), size, percent, "node", "text")
    kept = found.filter("kept and doc_id is not null").select(F.col("doc_id").alias("kept_node")).distinct()
    stay = rows.join(kept, F.col("node") == F.col("kept_node"), "left_semi")
    repeated = rows.filter("node is not null").groupBy(F.col("node").alias("id")).agg(F.count("*").alias("n")).filter("n > 1")
    repeated = _stored(repeated.select("id"), "repeated-ids")
    if repeated.limit(1).count():
        again = stay.join(repeated, F.col("node") == F.col("id"), "left_semi").select("node", text.alias("text"), F.struct(*own).alias("row"))
        # Repeated rows may differ in other columns: all columns decide, so that a lost task chooses the same row again.
        first = again.groupBy("node").agg(F.min_by("row", F.struct(F.xxhash64("text"), F.sha2(F.to_json("row"), 256))).alias("row"))
        stay = stay.join(repeated, F.col("node") == F.col("id"), "left_anti").select(*own).unionByName(first.select("row.*"))
    return stay.select(*own).unionByName(rows.filter("node is null").select(*own)).toDF(*docs.columns)
