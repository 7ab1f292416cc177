"""The registered corpus queries and the pipeline on the smallest tables, against SQL or brute force."""

import re
import zlib

import numpy as np
import pandas as pd
import pytest
from compare import connect, differences
from conftest import SMALL
from test_urls import best
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from martlet.llm import queries as llm
from martlet.llm import toxicity

public_tokenizers = pytest.importorskip("public_tokenizers")
QUERIES, SQL = contract.queries(), llm.oracle_sql()


@pytest.fixture(scope="module")
def tables():
    return {t: pd.read_parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "pages", "benchmark", "labels")}


def run(spark, name):
    return QUERIES[name](spark, SMALL).toPandas()


def encoded(texts):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(public_tokenizers.path(llm.TOKENIZER))
    return [plain.encode(t or "", add_special_tokens=False).ids + [llm.END_ID] for t in texts]


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))


def shingles(text, size):
    own = words(text)
    return {tuple(own[i : i + size]) for i in range(len(own) - size + 1)} or ({tuple(own)} if own else set())


def components(docs, size):
    """The smallest linked doc_id of every document, by comparing all pairs."""
    ids, sets = docs.doc_id.tolist(), [shingles(t, size) for t in docs.text]
    parent = {i: i for i in ids}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                x, y = top(ids[i]), top(ids[j])
                parent[max(x, y)] = min(x, y)
    return {i: top(i) for i in ids}


def test_one_query_for_each_operator():
    numbers = sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES if re.match(r"op\d+_", n))
    assert numbers == list(range(1, 14)) and "pipeline" in QUERIES


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    assert differences(connect(SMALL), SQL[name], QUERIES[name](spark, SMALL)) == []


def test_op1(spark, tables):
    found = run(spark, "op1_token_output").sort_values("doc_id")
    docs = tables["documents"].sort_values("doc_id")
    ids = encoded(docs.text)
    assert found.doc_id.tolist() == docs.doc_id.tolist()
    assert found.n_tokens.tolist() == [len(i) for i in ids]
    assert found.start.tolist() == [0, *np.cumsum([len(i) for i in ids])[:-1]]
    assert found.ids_crc32.tolist() == [zlib.crc32(np.array(i, "<u4").tobytes()) for i in ids]


def test_op2(spark):
    """Hosts, paths and rules of every page; of what no rule decides, the verdict is inferred from other names."""
    larger = SMALL.replace("sf0.001", "sf0.1")  # the smallest table has three unwanted pages without a rule
    pages = pd.read_parquet(f"{larger}/pages.parquet")
    found = {row.page_id: row for row in QUERIES["op2_url_filter"](spark, larger).collect()}
    assert len(found) == len(pages)
    blocked = {True: [], False: []}
    for page, url in zip(pages.page_id, pages.url):
        row, (host, path) = found[page], re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1]).groups()
        host = host.lower()
        assert (row.host, row.path) == (host, path)
        rule, verdict = best(host, path, llm.URL_RULES)
        assert row["rule"] == rule and (rule is None or row.verdict == verdict)
        if rule is None:
            unwanted = bool(re.search(r"(^|\.)(adult-x|spam-farm|cheap-pills|ads-track|casino-win|free-bets)\.", host))
            blocked[unwanted].append(row.verdict == "block")
    assert np.mean(blocked[True]) >= 0.8 and np.mean(blocked[False]) <= 0.01


@pytest.mark.parametrize("name, label, modulus, held, cut", [("op4_quality", "quality", 5, 0, 0.3), ("op9_toxicity", "toxic", 3, 1, 0.7)])
def test_scores(spark, tables, name, label, modulus, held, cut):
    found = run(spark, name)
    assert sorted(found.doc_id) == sorted(tables["documents"].doc_id)
    assert all(h == (zlib.crc32(str(i).encode()) % modulus == held) for i, h in zip(found.doc_id, found.held_out))
    assert ((found.score >= cut) == (found.predicted == 1)).all() and found.score.between(0, 1).all()


def test_op5(spark, tables):
    found = run(spark, "op5_license_scan")
    notices = {
        "Licensed under the Apache License, Version 2.0.": "apache-2.0", "Released under the MIT License.": "mit",
        "This work is licensed under the GNU General Public License, version 3.": "gpl-3.0",
        "Licensed under CC BY-NC 4.0.": "cc-by-nc", "All rights reserved.": "all-rights-reserved",
    }
    expected = sorted(
        (d, i, notices[line])
        for d, t in zip(tables["documents"].doc_id, tables["documents"].text)
        for i, line in enumerate(t.split("\n"))
        if line in notices
    )
    assert expected == sorted(zip(found.doc_id, found.paragraph, found.family))


def test_op8(spark, tables):
    found = run(spark, "op8_near_duplicates").set_index("doc_id")
    expected = components(tables["documents"], 4)
    assert found.component_id.to_dict() == expected
    assert found.kept.to_dict() == {i: i == c for i, c in expected.items()}
    assert found.n_shingles.to_dict() == {i: len(shingles(t, 4)) for i, t in zip(tables["documents"].doc_id, tables["documents"].text)}


def test_pipeline_stage_by_stage(spark, tables, tmp_path):
    """Each stage against brute force on its own input, and the run against the last stage."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, given = docs.columns, docs.toPandas()
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SMALL)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
            out.write.parquet(str(tmp_path / name))
            docs = spark.read.parquet(str(tmp_path / name))
        got = (docs if k < len(corpus_pipeline.STAGES) - 1 else out).toPandas()
        if name == "toxicity":
            scores = toxicity.toxicity_scores(spark.read.parquet(f"{SMALL}/documents.parquet"), llm.table(spark, SMALL, "labels"))
            assert sorted(got.doc_id) == sorted(r["doc_id"] for r in scores.filter("predicted = 0").collect())
        elif name == "near_dedup":
            assert sorted(got.doc_id) == sorted(set(components(given, 5).values()))
        elif name == "decontamination":
            items = [shingles(t, 5) for t in tables["benchmark"].text if len(words(t)) >= 5]
            bad = {
                d for d, t in zip(given.doc_id, given.text)
                if any(100 * len(i & shingles(t, 5)) >= 80 * len(i) for i in items)
            }
            assert sorted(got.doc_id) == sorted(set(given.doc_id) - bad)
        elif name == "mixing":
            size = given.groupby("source").doc_id.count()
            rate = len(given) * np.sqrt(size) / np.sqrt(size).sum() / size
            assert set(got.doc_id) <= set(given.doc_id)
            assert abs(len(got) / len(given) - 1) < 0.25 and rate.notna().all()
        else:
            ordered = given.sort_values("doc_id", kind="stable")
            assert got.sort_values("start").doc_id.tolist() == ordered.doc_id.tolist()
            lengths = {d: len(i) for d, i in zip(given.doc_id, encoded(given.text))}
            assert got.n_tokens.tolist() == [lengths[d] for d in got.doc_id]
            whole = corpus_pipeline.run(spark, SMALL).toPandas()
            key = ["doc_id", "start", "n_tokens", "ids_crc32"]
            assert sorted(map(tuple, whole[key].values.tolist())) == sorted(map(tuple, got[key].values.tolist()))
        given = got


def test_pipeline_stands_awkward_rows(spark, tmp_path):
    """Nulls, empty, long and repeated rows pass all stages."""
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (2, "", "en", "a", 0), (3, "w " * 50_000, "en", "b", 100_000), (None, "no id", "en", "a", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for table in ("labels", "benchmark"):
        spark.read.parquet(f"{SMALL}/{table}.parquet").write.parquet(str(tmp_path / f"{table}.parquet"))
    for empty in (False, True):
        here = docs.limit(0) if empty else docs
        for _, stage in corpus_pipeline.STAGES:
            here = stage(spark, here, str(tmp_path))
        assert (here.count() == 0) if empty else (here.filter(F.col("n_tokens") > 0).count() == here.count() > 0)
