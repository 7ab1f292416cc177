"""One registered query for each corpus operator, over the whole of its table."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlet.llm import contamination, licenses, lines, merkle, mixing, neardup, packing, quality, rules, runs, tokens, toxicity, urls
from martlet.llm.sequence_sql import MANIFEST_SQL, RUNS_SQL
from martlet.session import scratch_path

TOKENIZER = "word_bpe_49k.json"
END_ID = 2


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes every text as token ids and reads position, length and checksum back from the files."""
    path = scratch_path(spark, "op1-tokens")
    tokens.write_tokens(
        table(spark, sf_dir, "documents"), path, public_tokenizers.path(TOKENIZER), END_ID, keep=("lang", "source")
    )
    return tokens.id_digest(tokens.read_tokens(spark, path))


#: The rules that op2 applies.
URL_RULES = [
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
]


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Allows or blocks every page by rule, or else by a regression on n-grams of host and path."""
    return urls.judge_urls(table(spark, sf_dir, "pages"), URL_RULES, urls.labelled_urls())


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds at least 80 % of the five-word shingles of a benchmark item, with the item."""
    return contamination.find_contained(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quality score for every document, learned from its labelled rows."""
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every paragraph of every document that is a licence notice, with its family."""
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's measures, failed rules and verdict under the production policy."""
    return rules.judge(table(spark, sf_dir, "documents"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, replicated so that sources weigh the square root of their size, in random order."""
    return mixing.mix_sources(table(spark, sf_dir, "documents"))


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The component of every document under links of 80 % of their four-word shingles."""
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), size=4)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A toxicity score for every document, learned from its labelled rows."""
    return toxicity.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the lines that at least eight sites share."""
    return lines.cut_shared_lines(table(spark, sf_dir, "documents"))


def looped_tenth(ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every tenth document, by the crc32 of its id, repeats its last words: where from, and how many."""
    begin, lap = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64)
    for i, (key, n) in enumerate(zip(ids.tolist(), counts.tolist())):
        h = zlib.crc32(str(key).encode())
        if key is not None and h % 10 == 0 and n > 0:
            g = h // 10
            begin[i] = g % n
            lap[i] = 1 + (n - begin[i]) // (3 + g % 8)
    return begin, lap


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The periodic runs of every document, and a digest of its text without their repetitions."""
    return runs.run_digest(runs.find_runs(table(spark, sf_dir, "documents"), loops=looped_tenth))


def op12_mixture_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document in sequences of 4096 tokens that mix the sources by their shares."""
    pieces = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), END_ID)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's leaf and proof in a Merkle tree, and the root of its version with the text of every fifth in lower case."""
    docs = table(spark, sf_dir, "documents")
    leaf = merkle.leaf_digest([F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")])
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tampered = merkle.leaf_digest([*[F.col(c) for c in ("doc_id", "source", "lang", "n_chars")], lowered])
    fifth = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    found = merkle.versions(merkle.build(docs, leaf, F.when(fifth, tampered)))
    verified = (F.col("folded_root") == F.col("root")).alias("verified")
    return found.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", verified)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_token_output,
        op2_url_filter,
        op3_decontamination,
        op4_quality,
        op5_license_scan,
        op6_quality_rules,
        op7_mixing,
        op8_near_duplicates,
        op9_toxicity,
        op10_line_dedup,
        op11_periodic_runs,
        op12_mixture_packing,
        op13_merkle_manifest,
    )
    return {f.__name__: f for f in found}


#: Five-word shingles of both sides and their exact containment; only A-Z are lower-cased.
CONTAINMENT_SQL = r"""
WITH words AS (
    SELECT 'd' AS side, doc_id AS id, text FROM documents UNION ALL SELECT 'i', item_id, text FROM benchmark
), split AS (
    SELECT side, id, regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM words
), shingles AS (
    SELECT DISTINCT side, id, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) AS s
    FROM split
), items AS (
    SELECT id AS item_id, s, count(*) OVER (PARTITION BY id) AS item_shingles FROM shingles WHERE side = 'i'
)
SELECT d.id AS doc_id, item_id, count(*) AS shared, item_shingles, count(*) / item_shingles AS containment
FROM shingles d JOIN items i ON d.side = 'd' AND d.s = i.s
GROUP BY d.id, item_id, item_shingles
HAVING 100 * count(*) >= 80 * item_shingles
"""

RULES_SQL = r"""
WITH split AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
           regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS solid,
           list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
    FROM documents
), windows AS (
    SELECT doc_id, unnest(range(1, len(w) - 1)) AS pos, w FROM split WHERE len(w) > 2
), named AS (
    SELECT doc_id, pos, w[pos] || ' ' || w[pos + 1] || ' ' || w[pos + 2] AS s FROM windows
), twice AS (
    SELECT doc_id, pos FROM (SELECT doc_id, pos, count(*) OVER (PARTITION BY doc_id, s) AS n FROM named) WHERE n > 1
), covered AS (
    SELECT doc_id, count(DISTINCT pos + o) AS n FROM twice, (SELECT unnest([0, 1, 2]) AS o) GROUP BY doc_id
), measured AS (
    SELECT s.doc_id, CAST(len(w) AS BIGINT) AS n_words, length(solid) AS word_chars,
           length(regexp_replace(solid, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
           CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words,
           CAST(len(lines) AS BIGINT) AS n_lines, length(regexp_replace(solid, '[^\p{Lu}]+', '', 'g')) AS n_upper,
           CAST(len(list_filter(w, lambda x: regexp_matches(x, '\p{L}'))) AS BIGINT) AS n_letter_words
    FROM split s LEFT JOIN covered c ON s.doc_id = c.doc_id
), judged AS (
    SELECT *, CAST(@bits@ AS BIGINT) AS fail_bits FROM measured
)
SELECT *, fail_bits & 3 <> 0 AS base_failed, fail_bits = 0 AS kept, 'production-1' AS policy FROM judged
""".replace("@bits@", " + ".join(f"CASE WHEN {c} THEN {rules.BITS[r]} ELSE 0 END" for r, c in rules.RULES.items()))

MIXING_SQL = """
WITH counts AS (
    SELECT coalesce(source, '') AS source, count(*) AS n, sqrt(count(*)) AS weight FROM documents GROUP BY 1
), rates AS (
    SELECT source, weight / sum(weight) OVER () * sum(n) OVER () / n AS rate FROM counts
), steps AS (
    SELECT source, rate, unnest(range(0, CAST(ceil(rate + 12 * sqrt(rate) + 30) AS BIGINT) + 1)) AS k FROM rates
), cdf AS (
    SELECT source, k, sum(exp(k * ln(rate) - rate - lgamma(k + 1))) OVER (PARTITION BY source ORDER BY k) AS p FROM steps
), tables AS (
    SELECT source, list(p ORDER BY k) AS cdf FROM cdf GROUP BY source
), drawn AS (
    SELECT d.*, CAST(CAST('0x' || substr(md5('mix-1:' || doc_id), 1, 13) AS BIGINT) AS DOUBLE) / 4503599627370496 AS u, cdf
    FROM documents d JOIN tables t ON coalesce(d.source, '') = t.source
), counted AS (
    SELECT *, CAST(len(list_filter(cdf, lambda c: c <= u)) AS INTEGER) AS copies FROM drawn
), copied AS (
    SELECT *, unnest(range(1, copies + 1)) AS r FROM counted
)
SELECT doc_id, text, lang, source, n_chars, CAST(r AS INTEGER) AS replica, copies,
       CAST('0x' || substr(md5('mix-1:' || doc_id || ':' || r), 1, 15) AS BIGINT) AS shuffle_key
FROM copied
"""


LINES_SQL = r"""
WITH lines AS (
    SELECT doc_id, coalesce(source, '') AS site, pos, line
    FROM (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos
          FROM documents)
), shared AS (
    SELECT trim(line, ' ') AS bare FROM lines WHERE length(trim(line, ' ')) >= 20
    GROUP BY 1 HAVING count(DISTINCT site) >= 8
), marked AS (
    SELECT l.*, s.bare IS NOT NULL AS cut FROM lines l LEFT JOIN shared s ON trim(l.line, ' ') = s.bare
)
SELECT doc_id, CAST(count(*) AS INTEGER) AS n_lines, CAST(count(*) FILTER (cut) AS INTEGER) AS n_cut,
       coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT cut), '') AS text
FROM marked GROUP BY doc_id
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op3_decontamination": CONTAINMENT_SQL,
        "op6_quality_rules": RULES_SQL,
        "op7_mixing": MIXING_SQL,
        "op10_line_dedup": LINES_SQL,
        "op11_periodic_runs": RUNS_SQL,
        "op13_merkle_manifest": MANIFEST_SQL,
    }
