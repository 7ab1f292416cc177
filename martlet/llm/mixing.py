"""Mixing sources to target weights: Poisson replication and a global shuffle, in DataFrame functions alone.

A source with a share ``w`` of the target weights and ``n`` of all ``N`` rows is to appear ``rate = w * N / n`` times
per row. Every row draws its number of copies from the Poisson distribution with that mean: a hash of seed and id gives a
uniform number, and the number of values of the distribution function not above it is the draw. The draw depends on nothing but
seed, id and rate, so a lost task repeats it. Rows are exploded by their draw and dealt by a hash of seed, id and copy,
then sorted by it: every output file is a random part of the mixture, in random order.

Distribution functions are tables, one row a source, made with logarithms, so that any rate works. They are written
and read back, so that Spark knows their size when it chooses between a broadcast and a join in which it can
split a frequent source.

Defined cases: a null source counts as the source ''. A null id is replaced by a hash of the text. Rows with the same id
(repeated rows too) get the same number of copies each. A source without a target, or with a weight of 0 or less, gets no
copy; weights are relative, and those of sources that do not occur are left out of their sum. An empty table gives an
empty result. Other columns go along; ``replica``, ``copies`` and ``shuffle_key`` replace columns of these names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martlet.llm.text import by_position
from martlet.session import scratch_path

SEED = "mix-1"


def _source(source_col: str) -> Column:
    return F.coalesce(F.col(source_col).cast("string"), F.lit(""))


def temperature_targets(docs: DataFrame, exponent: float = 0.5, source_col: str = "source") -> DataFrame:
    """``source`` and ``weight``: the count of each source to the power ``exponent`` (1 keeps the mixture, 0 evens it out)."""
    counts = docs.groupBy(_source(source_col).alias("source")).agg(F.count("*").alias("n"))
    return counts.select("source", F.pow(F.col("n").cast("double"), F.lit(exponent)).alias("weight"))


def poisson_tables(docs: DataFrame, targets: DataFrame, source_col: str = "source") -> DataFrame:
    """``source``, ``rate`` and ``cdf`` (distribution function at 0, 1, ...) of every source with a positive weight."""
    counts = docs.groupBy(_source(source_col).alias("source")).agg(F.count("*").alias("n"))
    weights = targets.groupBy(_source("source").alias("source")).agg(F.sum("weight").alias("weight"))
    held = counts.join(weights.filter("weight > 0"), "source", "left")
    path = scratch_path(docs.sparkSession, "source-counts")
    held.write.parquet(path)
    held = docs.sparkSession.read.parquet(path)
    total = held.agg(F.sum("n").alias("n"), F.sum("weight").alias("weight")).first()
    rate = F.col("weight") / F.lit(total["weight"]) * F.lit(total["n"]) / F.col("n")
    rates = held.filter("weight is not null").select("source", rate.alias("rate"))
    last = F.ceil(F.col("rate") + 12 * F.sqrt("rate") + 30)
    steps = rates.select("source", "rate", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("k"))
    # The tables of one source, a few times its rate long.
    upto = Window.partitionBy("source").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    factorial = F.sum(F.when(F.col("k") > 0, F.ln("k")).otherwise(F.lit(0.0))).over(upto)
    mass = F.exp(F.col("k") * F.ln("rate") - F.col("rate") - F.col("ln_factorial"))
    steps = steps.withColumn("ln_factorial", factorial).withColumn("cdf", F.sum(mass).over(upto))
    points = F.array_sort(F.collect_list(F.struct("k", "cdf")))
    return steps.groupBy("source", "rate").agg(points.alias("points")).select("source", "rate", F.col("points.cdf").alias("cdf"))


def hashed(digits: int, *parts: Column) -> Column:
    """The first hexadecimal digits of an MD5 over the parts, as a long."""
    digest = F.md5(F.concat_ws(":", *parts).cast("binary"))
    return F.conv(F.substring(digest, 1, digits), 16, 10).cast("long")


def mix_sources(
    docs: DataFrame,
    targets: DataFrame | None = None,
    seed: str = SEED,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """``docs`` replicated to the target weights and shuffled, with ``replica`` (from 1), ``copies`` and ``shuffle_key``."""
    spark = docs.sparkSession
    targets = temperature_targets(docs, source_col=source_col) if targets is None else targets
    path = scratch_path(spark, "poisson")
    poisson_tables(docs, targets, source_col).write.parquet(path)
    tables = spark.read.parquet(path).select(F.col("source").alias("name"), "cdf")

    kept = [i for i, c in enumerate(docs.columns) if c not in ("replica", "copies", "shuffle_key")]
    own = [f"c{i}" for i in kept]
    place = {name: F.col(f"c{i}") for i, name in enumerate(docs.columns)}
    text = F.coalesce(place[text_col], F.lit(""))
    rows = by_position(docs).select(
        *own,
        F.coalesce(place[source_col].cast("string"), F.lit("")).alias("source"),
        F.coalesce(place[id_col].cast("string"), F.md5(text.cast("binary"))).alias("key"),
    )
    uniform = hashed(13, F.lit(seed), F.col("key")) / F.lit(float(1 << 52))
    drawn = rows.join(tables, F.col("source") == F.col("name")).withColumn("uniform", uniform)
    drawn = drawn.withColumn("copies", F.expr("size(filter(cdf, c -> c <= uniform))")).filter("copies > 0")
    copied = drawn.withColumn("replica", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    copied = copied.withColumn("shuffle_key", hashed(15, F.lit(seed), F.col("key"), F.col("replica").cast("string")))
    dealt = copied.select(*own, "replica", "copies", "shuffle_key").repartition("shuffle_key").sortWithinPartitions("shuffle_key")
    return dealt.toDF(*[docs.columns[i] for i in kept], "replica", "copies", "shuffle_key")
