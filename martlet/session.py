"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

#: Runtime SQL settings the jobs rely on. ``forceOptimizeSkewedJoin`` lets AQE
#: split a hot key even where the split costs one more exchange. ``fileCleanup`` deletes what an execution has shuffled as soon as it
#: ends; else the files stay until the driver happens to collect its garbage. Should a plan be run again, its stages are.
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings to an existing session."""
    for name, value in SQL_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, or the context's checkpoint folder. Having neither is an error."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not configured:
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    return configured.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no earlier run has used."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str = "stored") -> DataFrame:
    """Compute ``df`` once into Parquet files of the shared folder and read them from there.

    Columns are packed and a reader takes only those it uses; a checkpoint computes the last stage twice and keeps whole rows as they are in memory.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dropped(spark: SparkSession, files: list[str]) -> None:
    """Delete the folders of these files that ``stored`` has written, which nothing will read any more."""
    jvm, root = spark._jvm, scratch_root(spark)
    scratch = jvm.org.apache.hadoop.fs.Path(root)
    fs = scratch.getFileSystem(spark._jsc.hadoopConfiguration())
    home = fs.makeQualified(scratch)
    for folder in {jvm.org.apache.hadoop.fs.Path(f).getParent() for f in files}:
        if folder.getParent().equals(home):
            fs.delete(folder, True)


def pin(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into reliable storage and cut its lineage.

    Needed where a later step refers to physical positions (partition ids), which
    a recomputed partition would not reproduce. Uses a reliable checkpoint, so a
    lost executor costs a re-read and never a different answer.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(scratch_root(spark))
    return df.checkpoint(eager=True)
