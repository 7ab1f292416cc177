"""Quality rules as a ledger of bits: measure every document once, apply any version of a policy later.

``ledger`` measures each text and sets one bit of ``fail_bits`` for each rule it breaks. Policies are masks of
rules with a version; applying one is a bitwise AND, and ``ablations`` counts, from one aggregation by
``fail_bits`` (at most one row for each combination of rules), what each rule removes alone, and what a policy
would keep without it. Only DataFrame functions, no shuffle of documents: the ledger is a map over them.

Words are ``[^\\x20\\x09-\\x0D]+`` of the whole text. ``n_repeat_words`` counts the words inside a three-word window that
the text has twice or more: windows are hashed, sorted with their place, and the places of equal neighbours are
merged, so long and repetitive texts take n log n steps.

Defined cases: null, empty and blank texts have no words, all measures 0, and break ``few_words``. Rows are judged one by one,
so repeated rows and ids do not matter. An empty table gives an empty ledger. Columns but id and text are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The rules in the order of their bits: name and the condition that breaks it.
RULES = {
    "few_words": "n_words < 50",
    "repeated_words": "100 * n_repeat_words > 50 * n_words",
    "many_words": "n_words > 100000",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 14 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "upper_case": "100 * n_upper > 40 * word_chars",
    "duplicate_lines": "100 * n_dup_lines > 50 * n_lines",
    "few_letters": "100 * n_letter_words < 50 * n_words",
}
BITS = {name: 1 << at for at, name in enumerate(RULES)}
MEASURES = "n_words word_chars n_symbols n_dup_lines n_repeat_words n_lines n_upper n_letter_words".split()


@dataclass(frozen=True)
class Policy:
    """A version of the rules that decide."""

    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(BITS[name] for name in self.rules)


BASE = Policy("base-1", ("few_words", "repeated_words"))
PRODUCTION = Policy("production-1", tuple(RULES))

_SPACE = r"[\x20\x09-\x0D]+"


def _repeat_words(words: str) -> Column:
    """Words inside windows found twice or more, by hash and place of every window in ``words``."""
    windows = f"transform(sequence(0, size({words}) - 3), i -> xxhash64({words}[i], {words}[i + 1], {words}[i + 2]))"
    return F.expr(f"CASE WHEN size({words}) < 4 THEN array() ELSE {windows} END")


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, the measures and ``fail_bits`` of every row."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    lines = F.expr(r"filter(split(text, '\n', -1), l -> length(translate(l, ' \t\n\u000B\f\r', '')) > 0)")
    rows = rows.select(
        "doc_id",
        F.filter(F.split("text", _SPACE), lambda w: w != "").alias("words"),
        F.translate("text", " \t\n\x0b\f\r", "").alias("solid"),
        lines.alias("lines"),
    )
    rows = rows.withColumn("windows", _repeat_words("words"))
    rows = rows.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.length("solid").cast("long").alias("word_chars"),
        (F.length("solid") - F.length(F.translate("solid", "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size("lines").cast("long").alias("n_lines"),
        F.length(F.regexp_replace("solid", r"[^\p{Lu}]+", "")).cast("long").alias("n_upper"),
        F.size(F.expr(r"filter(words, w -> w rlike '\\p{L}')")).cast("long").alias("n_letter_words"),
        # Windows with their places, only where a window occurs twice.
        F.expr(
            "CASE WHEN size(array_distinct(windows)) < size(windows) THEN "
            "array_sort(transform(windows, (h, i) -> struct(h, i))) END"
        ).alias("sorted"),
    )
    places = (
        "array_sort(transform(filter(sorted, (x, k) -> (k > 0 AND x.h = sorted[k - 1].h) OR "
        "(k + 1 < size(sorted) AND x.h = sorted[k + 1].h)), x -> x.i))"
    )
    rows = rows.withColumn("places", F.expr(f"CASE WHEN sorted IS NOT NULL THEN {places} END")).drop("sorted")
    covered = (
        "aggregate(places, struct(0L AS n, -3 AS last), "
        "(a, p) -> struct(a.n + least(3, p - a.last) AS n, p AS last), a -> a.n)"
    )
    rows = rows.withColumn("n_repeat_words", F.coalesce(F.expr(covered), F.lit(0).cast("long"))).drop("places")
    bits = [F.when(F.expr(condition), F.lit(BITS[name])).otherwise(F.lit(0)) for name, condition in RULES.items()]
    total = bits[0]
    for bit in bits[1:]:
        total = total.bitwiseOR(bit)
    return rows.select("doc_id", *MEASURES, total.cast("long").alias("fail_bits"))


def fails(policy: Policy) -> Column:
    return F.col("fail_bits").bitwiseAND(F.lit(policy.mask)) != 0


def apply_policy(judged: DataFrame, policy: Policy) -> DataFrame:
    """The ledger with ``kept`` and ``policy`` under one version of the rules."""
    return judged.withColumn("kept", ~fails(policy)).withColumn("policy", F.lit(policy.version))


def ablations(judged: DataFrame, policy: Policy) -> DataFrame:
    """For each rule of a policy: rows that break it, that only it removes, and that are kept with and without it."""
    spectrum = judged.groupBy(F.col("fail_bits").bitwiseAND(F.lit(policy.mask)).alias("bits")).agg(F.count("*").alias("n"))
    rules = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(BITS[r]).alias("bit")) for r in policy.rules]))
    each = spectrum.withColumn("r", rules).select("bits", "n", "r.rule", "r.bit")
    alone, none = F.col("bits") == F.col("bit"), F.col("bits") == 0
    return each.groupBy("rule").agg(
        F.sum(F.when(F.col("bits").bitwiseAND(F.col("bit")) != 0, F.col("n")).otherwise(0)).alias("broken"),
        F.sum(F.when(alone, F.col("n")).otherwise(0)).alias("removed_by_it_alone"),
        F.sum(F.when(none, F.col("n")).otherwise(0)).alias("kept"),
        F.sum(F.when(none | alone, F.col("n")).otherwise(0)).alias("kept_without"),
    ).withColumn("policy", F.lit(policy.version))


def judge(docs: DataFrame, policy: Policy = PRODUCTION) -> DataFrame:
    """The ledger with ``base_failed`` and the verdict of ``policy``, which never keeps what the base rules reject."""
    judged = ledger(docs).withColumn("base_failed", fails(BASE))
    return apply_policy(judged, policy).withColumn("kept", F.col("kept") & ~F.col("base_failed"))
