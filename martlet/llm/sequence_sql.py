"""DuckDB counterparts of the run and manifest queries, by other means than the operators."""

from __future__ import annotations

#: The crc32 of the decimal ``doc_id`` of every document: the 256 remainders by rule, then byte after byte.
_CRC_SQL = """
remainders AS MATERIALIZED (
    SELECT list(c ORDER BY i) AS t FROM (
        SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
            lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, CAST(3988292384 AS BIGINT)) ELSE a >> 1 END) AS c
        FROM (SELECT unnest(range(256)) AS i))
), sums AS MATERIALIZED (
    SELECT doc_id, xor(CAST(4294967295 AS BIGINT), list_reduce(
        list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) AS crc
    FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL), remainders
)"""

#: A run makes the same six words appear a period later, at least once; equal six-word stretches are joined by value.
RUNS_SQL = (
    "WITH "
    + _CRC_SQL
    + r""", split AS MATERIALIZED (
    SELECT d.doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w, crc // 10 AS g, crc % 10 = 0 AS looped
    FROM documents d LEFT JOIN sums s ON d.doc_id = s.doc_id
), placed AS (
    SELECT *, len(w) AS n, CASE WHEN looped AND len(w) > 0 THEN g % len(w) END AS a FROM split
), lapped AS (
    SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM placed
), words AS MATERIALIZED (
    SELECT doc_id, i, w[CASE WHEN i >= a THEN a + (i - a) % p ELSE i END + 1] AS word
    FROM (SELECT *, unnest(range(n)) AS i FROM lapped)
), sixes AS MATERIALIZED (
    SELECT * FROM (
        SELECT doc_id, i, word || ' ' || lead(word, 1) OVER o || ' ' || lead(word, 2) OVER o || ' ' || lead(word, 3) OVER o
            || ' ' || lead(word, 4) OVER o || ' ' || lead(word, 5) OVER o AS six
        FROM words WINDOW o AS (PARTITION BY doc_id ORDER BY i))
    WHERE six IS NOT NULL
), pairs AS (
    SELECT x.doc_id, x.i, y.i - x.i AS q FROM sixes x JOIN sixes y ON x.doc_id = y.doc_id AND x.six = y.six AND x.i < y.i
), stretches AS (
    SELECT doc_id, q, min(i) AS start, count(*) + 5 + q AS length
    FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM pairs)
    GROUP BY doc_id, q, island
), runs AS MATERIALIZED (
    SELECT doc_id, start, length, min(q) AS period FROM stretches
    WHERE length >= 12 AND length >= 2 * q GROUP BY doc_id, start, length
), dropped AS (
    SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs
), collapsed AS (
    SELECT w.doc_id, string_agg(word, ' ' ORDER BY w.i) AS text
    FROM words w LEFT JOIN dropped d ON w.doc_id = d.doc_id AND w.i = d.i WHERE d.i IS NULL GROUP BY w.doc_id
), listed AS (
    SELECT doc_id, count(*) AS n_runs, string_agg(concat(start, ',', length, ',', period, chr(10)), '' ORDER BY start, period) AS lines
    FROM runs GROUP BY doc_id
), longest AS (
    SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY length DESC, start, period) = 1
)
SELECT s.doc_id, coalesce(n_runs, 0) AS n_runs, start, CAST(length AS BIGINT) AS length, period,
       CAST(1000 * length // period AS BIGINT) AS exponent_milli,
       sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(c.text, '')) AS collapsed_sha256
FROM split s LEFT JOIN listed l ON s.doc_id = l.doc_id LEFT JOIN longest t ON s.doc_id = t.doc_id LEFT JOIN collapsed c ON s.doc_id = c.doc_id
"""
)


def _levels(name: str, start: str, levels: int) -> str:
    """CTEs for so many levels above ``start`` (tree, i, d): each node with its siblings' digests to the left and right."""
    steps, below = [], start
    for k in range(levels):
        steps.append(
            f"""{name}{k}s AS MATERIALIZED (
    SELECT tree, i, d, count(*) OVER (PARTITION BY tree) > 1 AS more,
           coalesce(string_agg(d, '') OVER (PARTITION BY tree, i // 16 ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
           coalesce(string_agg(d, '') OVER (PARTITION BY tree, i // 16 ORDER BY i ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
    FROM {below}
), {name}{k + 1} AS MATERIALIZED (
    SELECT tree, i // 16 AS i, CASE WHEN any_value(more) THEN sha256(string_agg(d, '' ORDER BY i)) ELSE any_value(d) END AS d
    FROM {name}{k}s GROUP BY tree, i // 16
)"""
        )
        below = f"{name}{k + 1}"
    return ", ".join(steps)


def _folds(name: str, levels: int, before: str) -> str:
    """CTEs that carry each leaf (tree, i, cur, proof) of ``before`` through the levels."""
    steps = []
    for k in range(levels):
        steps.append(
            f"""{name}fold{k} AS (
    SELECT f.* REPLACE (f.i // 16 AS i, CASE WHEN more THEN sha256(l || cur || r) ELSE cur END AS cur,
                        CASE WHEN more THEN proof || l || r ELSE proof END AS proof)
    FROM {before} f JOIN {name}{k}s s ON f.tree IS NOT DISTINCT FROM s.tree AND f.i = s.i
)"""
        )
        before = f"{name}fold{k}"
    return ", ".join(steps)


def _leaf(text: str) -> str:
    parts = [f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || {c}, '-')" for c in ("d.doc_id", "source", "lang", "n_chars", text)]
    return "sha256(" + " || ".join(parts) + ")"


#: Levels that the SQL spells out: enough for 16^6 rows of a source and 16^3 sources.
_DEEP, _WIDE = 6, 3

MANIFEST_SQL = f"""WITH {_CRC_SQL}, leaves AS MATERIALIZED (
    SELECT d.doc_id, source, {_leaf("text")} AS leaf,
           CASE WHEN crc % 5 = 0 THEN {_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS tampered
    FROM documents d LEFT JOIN sums s ON d.doc_id = s.doc_id
), a0 AS MATERIALIZED (
    SELECT source AS tree, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, leaf AS d, doc_id, tampered FROM leaves
), {_levels("a", "a0", _DEEP)}, subroots AS MATERIALIZED (
    SELECT tree AS source, 0 AS tree, row_number() OVER (ORDER BY tree NULLS FIRST) - 1 AS i, d FROM a{_DEEP}
), {_levels("b", "subroots", _WIDE)}, leaffold AS (
    SELECT tree, i, doc_id, d AS leaf, coalesce(tampered, d) AS cur, '' AS proof FROM a0
), {_folds("a", _DEEP, "leaffold")}, handed AS (
    SELECT s.tree, s.i, doc_id, leaf, cur, proof, s.d AS subroot FROM afold{_DEEP - 1} f JOIN subroots s ON f.tree IS NOT DISTINCT FROM s.source
), {_folds("b", _WIDE, "handed")}
SELECT doc_id, leaf, subroot, d AS root, sha256(proof) AS proof_sha256, cur AS folded_root, cur = d AS verified
FROM bfold{_WIDE - 1}, b{_WIDE}
"""
