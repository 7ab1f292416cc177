import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from helpers import awkward, make_docs  # noqa: F401
from pyspark.sql import functions as F

public_tokenizers = pytest.importorskip("public_tokenizers")
from tokenizers import Tokenizer  # noqa: E402

from martlet.llm import tokens  # noqa: E402

PATH = public_tokenizers.path("word_bpe_49k.json")
PLAIN = Tokenizer.from_file(PATH)
ENCODER = tokens.WordEncoder(PATH)


def plain(text):
    return PLAIN.encode(text or "", add_special_tokens=False).ids + [2]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=60), st.text("abZ3 .,'s!-#\n<|>é…", max_size=60)), max_size=8))
def test_encoder_equals_library(texts):
    ids, bounds = ENCODER.encode(pa.array(texts, pa.string()), 2)
    assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])] == [plain(t) for t in texts]


def test_memory_starts_anew(monkeypatch):
    monkeypatch.setattr(tokens, "MEMO_WORDS", 3)
    encoder = tokens.WordEncoder(PATH)
    for text in ("one two three four five", "two six", "seven one"):
        ids, _ = encoder.encode(pa.array([text]), 2)
        assert ids.tolist() == plain(text)


def test_files_round_trip(spark, make_docs, awkward, tmp_path):
    docs = make_docs(awkward).withColumn("shard", F.lit("clash")).withColumn("start", F.lit(0))
    path = str(tmp_path / "out")
    tokens.write_tokens(docs, path, PATH, keep=("lang", "shard"), row_group_bytes=64 << 10, page_bytes=8 << 10)
    rows = tokens.read_tokens(spark, path).orderBy("start").collect()
    order = sorted(awkward, key=lambda r: -1 if r[0] is None else r[0])
    assert [r["doc_id"] for r in rows] == [r[0] for r in order]
    start = 0
    for row, (_, text, *_) in zip(rows, order):
        assert (row["start"], row["token_ids"], row["n_tokens"]) == (start, plain(text), len(plain(text)))
        assert row["meta"]["shard"] == "clash"
        start += row["n_tokens"]
    digest = {(r["start"], r["ids_crc32"]) for r in tokens.id_digest(tokens.read_tokens(spark, path)).collect()}
    assert digest == {(r["start"], zlib.crc32(np.array(r["token_ids"], "<u4").tobytes())) for r in rows}


def test_files_allow_selective_reads(make_docs, tmp_path):
    path = str(tmp_path / "out")
    docs = make_docs([(i, f"some words {i} " * 50) for i in range(400)])
    tokens.write_tokens(docs, path, PATH, row_group_bytes=16 << 10, page_bytes=2 << 10)
    files = sorted((tmp_path / "out" / "tokens").glob("part-*.parquet"))
    groups = [pq.ParquetFile(f).metadata.row_group(0) for f in files if pq.ParquetFile(f).metadata.num_row_groups]
    assert groups
    for group in groups:
        columns = {group.column(i).path_in_schema: group.column(i) for i in range(group.num_columns)}
        ids = next(c for name, c in columns.items() if name.startswith("token_ids"))
        assert any("DICTIONARY" in e for e in ids.encodings)
        assert "DELTA_BINARY_PACKED" in columns["first"].encodings and columns["doc_id"].has_column_index


def test_empty_table(spark, make_docs, tmp_path):
    tokens.write_tokens(make_docs([]), str(tmp_path / "out"), PATH)
    assert tokens.id_digest(tokens.read_tokens(spark, str(tmp_path / "out"))).collect() == []
