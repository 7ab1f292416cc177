"""Line dedup by distinct-site spread: boilerplate lines that many sites share are cut from every document.

1. Texts are split at ``\\n``. A line's key is a hash of it without surrounding spaces; lines of fewer than
   ``min_chars`` characters have none. One row for each document and distinct key is written.
2. Keys in fewer than ``min_sites`` rows cannot be on as many sites and go no further. The rest get a HyperLogLog
   sketch of their sites, merged by aggregation: map-side, then first by (key, salt) and then by key, so that a line
   that a third of all documents carry is spread over tasks.
3. A key whose estimate is ``margin`` or more off the threshold is decided by it; keys near the threshold get an
   exact distinct count of their sites, from (key, site) pairs that are deduplicated before they are counted.
4. Documents with such a line get the list of its keys and lose the lines; all others pass.

Only DataFrame functions. Documents are shuffled once, by id (by a hash of the text where it is missing), for step 4; all else
moves keys.

Defined cases: null texts stay null, empty ones empty. A null site counts as the site ''. Rows that share an id lose the
boilerplate lines of all of them, which are cut wherever they stand. Rows without an id go by their text. Blank and short lines stay, and a
repeated line counts once for its document. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlet.session import scratch_path

MIN_SITES, MIN_CHARS = 8, 20
#: 2 ** LG_K registers: a relative error of about 1.04 / 64; MARGIN is over six such errors.
LG_K, MARGIN, SALTS = 12, 0.1, 16


def line_key(line: Column, min_chars: int) -> Column:
    """Hash of a line without surrounding spaces, NULL for a short one."""
    bare = F.trim(line)
    return F.when(F.length(bare) >= min_chars, F.xxhash64(bare))


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def site_spread(keys: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """``key`` and ``sites`` of the keys on at least ``min_sites`` sites; ``exact`` tells how it was counted."""
    frequent = keys.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") >= min_sites).select("key")
    # Stored first, so that the join has two plain sides and Spark can split the rows of a frequent line.
    frequent = _stored(frequent, "frequent-keys")
    rows = _stored(keys.join(frequent, "key", "left_semi").select("key", "site", "salt"), "frequent-lines")
    named = F.concat(F.lit("="), "site")  # sketches leave empty strings out
    sketched = rows.groupBy("key", "salt").agg(F.hll_sketch_agg(named, LG_K).alias("sketch"))
    spread = sketched.groupBy("key").agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("sites"))
    spread = _stored(spread, "line-spread")
    low, high = min_sites * (1 - MARGIN), min_sites * (1 + MARGIN)
    sure = spread.filter(F.col("sites") > high).select("key", "sites", F.lit(False).alias("exact"))
    near = spread.filter(F.col("sites").between(low, high)).select("key")
    counted = rows.join(near, "key", "left_semi").select("key", "site").distinct()
    counted = counted.groupBy("key").agg(F.count("*").alias("sites")).filter(F.col("sites") >= min_sites)
    return sure.unionByName(counted.withColumn("exact", F.lit(True)))


def cut_shared_lines(
    docs: DataFrame,
    min_sites: int = MIN_SITES,
    min_chars: int = MIN_CHARS,
    id_col: str = "doc_id",
    text_col: str = "text",
    site_col: str = "source",
) -> DataFrame:
    """``doc_id``, ``n_lines``, ``n_cut`` and the remaining ``text`` of every row."""
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.coalesce(F.col(site_col), F.lit("")).alias("site")
    )
    # Rows without an id are told apart by their text, so that they neither miss the join nor meet in one group.
    rows = rows.withColumn("instead", F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(F.lit(0)))
    keys = rows.select("doc_id", "instead", "site", F.explode(F.split("text", "\n", -1)).alias("line"))
    keys = keys.select("doc_id", "instead", "site", line_key(F.col("line"), min_chars).alias("key")).filter("key is not null")
    salt = F.pmod(F.xxhash64("doc_id", "instead"), F.lit(SALTS)).cast("int")
    keys = _stored(keys.withColumn("salt", salt), "line-keys")
    spread = _stored(site_spread(keys, min_sites), "shared-lines")

    shared = keys.join(spread.select("key"), "key").groupBy("doc_id", "instead").agg(F.collect_set("key").alias("keys"))
    lines = F.split("text", "\n", -1)
    own = rows.select("doc_id", "instead", "text").alias("r")
    same = F.col("r.doc_id").eqNullSafe(F.col("s.doc_id")) & (F.col("r.instead") == F.col("s.instead"))
    placed = own.join(shared.alias("s"), same, "left").select("r.doc_id", "r.text", "s.keys")
    stays = F.filter(
        lines, lambda line: F.coalesce(~F.array_contains(F.col("keys"), line_key(line, min_chars)), F.lit(True))
    )
    cut = placed.select(
        "doc_id",
        "text",
        F.when(F.col("text").isNull(), 0).otherwise(F.size(lines)).alias("n_lines"),
        F.when(F.col("keys").isNotNull(), stays).alias("left"),
    )
    return cut.select(
        "doc_id",
        "n_lines",
        F.when(F.col("left").isNull(), 0).otherwise(F.col("n_lines") - F.size("left")).alias("n_cut"),
        F.when(F.col("left").isNull(), F.col("text")).otherwise(F.array_join("left", "\n")).alias("text"),
    )
