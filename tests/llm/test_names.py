"""Rows whose other columns have the names that operators use inside, dots, or values that tell repeated rows apart."""

import pytest
from helpers import make_docs, numbered  # noqa: F401
from pyspark.sql import functions as F

from martlet.llm import contamination, mixing, neardup

CLASHING = (
    "c0 c1 c9 "
    "_source _key _cdf _node _kept _id _n _first _digest _uniform row key node id name cdf uniform copies_ digest bad kept_node component "
    "block shingles signature sketch region n shard place t index"
).split()


def clashing(docs):
    """``docs`` with a column for each name, holding the id, and one with a dot and a backtick in its name."""
    more = {c: F.concat(F.lit(f"{c}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))) for c in [*CLASHING, "a.b", "c`d"]}
    return docs.withColumns(more)


def unharmed(rows):
    for row in rows:
        own = "-" if row["doc_id"] is None else str(row["doc_id"])
        assert all(row[c] == f"{c}:{own}" for c in [*CLASHING, "a.b", "c`d"])


def texts(n=40):
    rows = [(i, numbered(100 * i, 60), f"s{i % 3}") for i in range(n)]
    return rows + [(n + i, numbered(100 * i, 60)) for i in range(10)] + [(3, numbered(300, 60)), (None, numbered(9000, 60)), (None, None), (7, "other")]


def test_mixing(make_docs):
    docs = make_docs(texts())
    plain = sorted((str(r["doc_id"]), r["replica"], r["shuffle_key"]) for r in mixing.mix_sources(docs).collect())
    mixed = mixing.mix_sources(clashing(docs))
    assert mixed.columns == [*docs.columns, *CLASHING, "a.b", "c`d", "replica", "copies", "shuffle_key"]
    rows = mixed.collect()
    unharmed(rows)
    assert sorted((str(r["doc_id"]), r["replica"], r["shuffle_key"]) for r in rows) == plain


def test_near_dedup(make_docs):
    docs = make_docs(texts())
    left = neardup.drop_duplicates(clashing(docs))
    assert left.columns == clashing(docs).columns
    rows = left.collect()
    unharmed(rows)
    assert sorted(str(r["doc_id"]) for r in rows) == sorted([*map(str, range(40)), "None", "None"])


@pytest.mark.parametrize("per_block", [30, 1_000_000])
def test_decontamination(spark, make_docs, per_block):
    docs = make_docs(texts())
    items = spark.createDataFrame([(i, numbered(100 * i + 5, 20)) for i in (1, 4, 8)], "item_id long, text string")
    items = items.withColumns({c: F.lit(1) for c in ("n", "block", "shingles", "_digest")})
    left = contamination.drop_contained(clashing(docs), items, shingles_per_block=per_block)
    assert left.columns == clashing(docs).columns
    rows = left.collect()
    unharmed(rows)
    kept = {r["doc_id"] for r in rows}
    assert not kept & {1, 4, 8, 41, 44, 48} and len(rows) == len(texts()) - 6


def test_repeated_rows_that_differ_in_other_columns(make_docs):
    """The same row stays however the rows are dealt."""
    rows = make_docs([(5, numbered(0, 40))] * 30).withColumn("note", F.concat(F.lit("n"), F.monotonically_increasing_id() % 97))
    rows = rows.withColumn("kinds", F.create_map(F.lit("a"), F.col("note")))
    noted = rows.collect()
    spark = rows.sparkSession
    kept = {
        neardup.drop_duplicates(spark.createDataFrame(noted, rows.schema).repartition(n, "note")).select("note").collect()[0][0]
        for n in (1, 2, 5)
    }
    assert len(kept) == 1
