"""Parquet tables in versioned folders.

A full refresh writes a new version folder; readers take the newest folder that
carries Spark's ``_SUCCESS`` marker. A refresh may therefore read the very table
it replaces, and a job that dies half-way leaves the previous version current.
A version may carry the id of the run that wrote it: repeating the newest run starts
from the version before it, and so gives the same table. Appends go to one folder per
load and one folder in it per attempt; of a load, readers take the newest complete attempt, so
a repeated load that dies leaves the earlier one in place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from martlet import schemas


def complete_folders(spark: SparkSession, base: str, kind: str, below: str = "") -> list[str]:
    """Folders ``base/kind=*`` that carry Spark's success marker, sorted; or those ``below`` them."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    marker = path(f"{base}/{kind}=*/_SUCCESS")
    fs = marker.getFileSystem(spark._jsc.hadoopConfiguration())
    done = sorted(s.getPath().getParent().toString() for s in fs.globStatus(marker) or [])
    if not below:
        return done
    inner = [s.getPath().toString() for s in fs.globStatus(path(f"{base}/{kind}=*/{below}=*")) or []]
    return sorted(f for f in inner if f.rsplit("/", 1)[0] in set(done))


class Tables:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, table: str) -> str:
        return f"{self.root}/{schemas.TABLES[table].layer}/{table}"

    def versions(self, table: str, before_run: str | None = None) -> list[str]:
        """Complete version folders, oldest first; without those of ``before_run``, which must be the newest run."""
        found = complete_folders(self.spark, self.path(table), "version")
        if before_run is not None:
            while found and _run_of(found[-1]) == before_run:
                found.pop()
            if any(_run_of(f) == before_run for f in found):
                raise ValueError(f"run {before_run!r} of {table} was followed by others and cannot be repeated")
        return found

    def exists(self, table: str, before_run: str | None = None) -> bool:
        return bool(self.versions(table, before_run))

    def read(self, table: str, before_run: str | None = None) -> DataFrame:
        """Newest version under the declared schema; an unwritten table is empty.

        A partitioned table is the newest version of each of its partitions and has
        the partition column last, so a filter on it selects folders. ``before_run`` reads
        the table as that run, should it be the newest, found it.
        """
        versions = self.versions(table, before_run)
        partition = schemas.TABLES[table].partition
        schema = schemas.stored_type(table)
        if partition:
            schema = schema.add(partition, "date")
            folders = complete_folders(self.spark, self.path(table), "version", partition)
            newest = {f.rsplit("/", 1)[1]: f for f in folders if f.rsplit("/", 1)[0] in set(versions)}
            found = sorted(newest.values())
        else:
            found = versions[-1:]
        if not found:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(schema)
        if partition:
            reader = reader.option("basePath", self.path(table))
        return reader.parquet(*found).select(*schema.fieldNames())

    def overwrite(self, table: str, df: DataFrame, run_id: str | None = None, placed: bool = False) -> int:
        """A new version that becomes current once it is complete. Returns its rows.

        Of a partitioned table it replaces the partitions that occur in ``df``; the
        others stay as they are and are not rewritten. ``placed``: ``df`` is in ranges of the partition column already.
        """
        found = self.versions(table)
        number = _number_of(found[-1]) + 1 if found else 1
        partition = schemas.TABLES[table].partition
        name = f"{number:08d}" if run_id is None else f"{number:08d}.{run_id}"
        return self._write(table, df, f"{self.path(table)}/version={name}", (partition,) if partition else (), placed)

    def append(self, table: str, df: DataFrame, load_id: str, partition_by: tuple[str, ...] = ()) -> int:
        """Add one load. Repeating a ``load_id`` replaces that load, so retries add nothing twice."""
        load = f"{self.path(table)}/load_id={load_id}"
        found = complete_folders(self.spark, load, "attempt")
        number = int(found[-1].rsplit("=", 1)[1]) + 1 if found else 1
        return self._write(table, df, f"{load}/attempt={number:08d}", partition_by)

    def _write(self, table: str, df: DataFrame, target: str, partition_by: tuple[str, ...], placed: bool = False) -> int:
        """Write and count in the same job."""
        shaped = conform(df, table, partition_by)
        if partition_by and not placed:  # AQE packs small partitions into one task and splits large ones
            shaped = shaped.hint("rebalance", *partition_by)
        cluster = schemas.TABLES[table].cluster
        if cluster:
            shaped = shaped.sortWithinPartitions(*partition_by, *cluster)
        rows = Observation()
        counted = shaped.observe(rows, F.count(F.lit(1)).alias("n"))
        writer = counted.write.mode("overwrite").partitionBy(*partition_by)
        for column in cluster:
            writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
        writer.option("parquet.bloom.filter.adaptive.enabled", "true").option("compression", "zstd").parquet(target)
        return rows.get["n"]

    def loads(self, table: str) -> list[str]:
        """Ids of the loads with a complete attempt."""
        attempts = complete_folders(self.spark, f"{self.path(table)}/load_id=*", "attempt")
        return sorted({p.rsplit("/", 2)[1].split("=", 1)[1] for p in attempts})

    def read_appended(self, table: str, without_load: str | None = None) -> DataFrame:
        """All complete loads; ``partition_by`` columns of the loads prune folders.

        ``without_load`` leaves one load out, as a repeated load must not see itself.
        """
        attempts = complete_folders(self.spark, f"{self.path(table)}/load_id=*", "attempt")
        newest = {p.rsplit("/", 1)[0]: p for p in attempts}
        paths = [p for load, p in newest.items() if not load.endswith(f"/load_id={without_load}")]
        schema = schemas.stored_type(table).add("load_id", "string")
        if not paths:
            return self.spark.createDataFrame([], schema)
        found = self.spark.read.schema(schema).option("basePath", self.path(table)).parquet(*paths)
        return found.drop("attempt")


def _number_of(folder: str) -> int:
    return int(folder.rsplit("=", 1)[1].split(".", 1)[0])


def _run_of(folder: str) -> str | None:
    return (folder.rsplit("=", 1)[1].split(".", 1) + [None])[1]


def conform(df: DataFrame, table: str, extra: tuple[str, ...] = ()) -> DataFrame:
    """Declared column order and types; columns the plan does not compute are NULL.

    ``extra`` columns follow as they are unless the table declares them.
    """
    present = set(df.columns)
    declared = {c.name: c.type for c in schemas.column_specs(table)} | schemas.audit_columns(table)
    return df.select(
        *[
            (F.col(name) if name in present else F.lit(None)).cast(kind).alias(name)
            for name, kind in declared.items()
        ],
        *[c for c in extra if c not in declared],
    )
