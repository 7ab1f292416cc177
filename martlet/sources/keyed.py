"""Parquet tables that grow by numbered loads and are laid out in hash buckets of a key.

A load is one folder ``loads=<n>-<n>`` with one sub-folder for each bucket that it has rows in; it counts once it
carries Spark's ``_SUCCESS`` marker, and repeating the newest load replaces it. Before a load is
written, folders are merged: as soon as ``fan`` neighbouring ones span about as many loads each, they become
one folder ``loads=<first>-<last>``. So a table has fewer than ``fan`` folders of each size class however many loads there were,
a row is rewritten once for each class, and the newest load is never merged, so that it can be repeated.
Merged folders go at the next load, when readers that had begun before have had one load's time.

A reader that knows which keys it needs selects their buckets as folders; within a file, rows are sorted by key and
carry Bloom filters on the key columns, so a lookup skips row groups that cannot hold it.
"""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martlet.operators.latest import latest_per_key
from martlet.operators.merge import fold_batch
from martlet.session import dropped, stored
from martlet.sources.tables import complete_folders

BUCKET = "key_bucket"
#: When the last upsert of a row came.
TOUCHED = "touched_at"
#: New keys of a batch up to which they are sent to the rows; of more, the rows go to the known keys.
FEW_KEYS = 100_000


@dataclass(frozen=True)
class Folder:
    first: int
    last: int
    path: str

    def covers(self, other: Folder) -> bool:
        return self.first <= other.first and other.last <= self.last and self != other


class KeyedTable:
    """``key`` identifies a row; ``bucket_by`` are the key columns whose hash chooses the bucket (all by default)."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        key: list[str],
        buckets: int = 32,
        bucket_by: list[str] | None = None,
        fan: int = 8,
        fold: Callable[[DataFrame], DataFrame] | None = None,
    ):
        if fan < 2 or buckets < 1:
            raise ValueError("at least two folders are merged, and there is at least one bucket")
        self.spark, self.root, self.key = spark, root.rstrip("/"), key
        self.buckets, self.bucket_by, self.fan = buckets, bucket_by or key, fan
        self.fold = fold or (lambda df: df)
        self._spent: list[str] = []

    # ---------------------------------------------------------------- folders

    def _complete(self) -> list[Folder]:
        found = []
        for path in complete_folders(self.spark, self.root, "loads"):
            first, last = path.rsplit("=", 1)[1].split("-")
            found.append(Folder(int(first), int(last), path))
        return found

    def folders(self, before: int | None = None) -> list[Folder]:
        """The folders that make up the table, in the order of their loads; or those of loads ``before`` a number."""
        found = [f for f in self._complete() if before is None or f.last < before]
        return sorted((f for f in found if not any(g.covers(f) for g in found)), key=lambda f: f.first)

    def _path(self, first: int, last: int) -> str:
        return f"{self.root}/loads={first:010d}-{last:010d}"

    # ---------------------------------------------------------------- reading

    def _read(self, folders: list[Folder]) -> DataFrame | None:
        """The rows of the folders, None where all are empty."""
        rows = self._rows(folders)
        return None if rows is None else rows.drop("loads")

    def _rows(self, folders: list[Folder]) -> DataFrame | None:
        """The rows of the folders with ``loads``, which sorts as they were loaded."""
        filled = {p.rsplit("/", 1)[0] for p in complete_folders(self.spark, self.root, "loads", BUCKET)}
        paths = [f.path for f in folders if f.path in filled]
        return self.spark.read.option("basePath", self.root).parquet(*paths) if paths else None

    def _folded(self, folders: list[Folder]) -> DataFrame | None:
        """The rows of several folders as those of one."""
        rows = self._read(folders)
        return None if rows is None else self.fold(rows)

    def read(self, before: int | None = None) -> DataFrame | None:
        """All rows with their bucket, or None where there is none."""
        return self._read(self.folders(before))

    def read_load(self, number: int) -> DataFrame | None:
        """The rows of one load, as long as it is not merged with others; None where it has none."""
        return self._read([f for f in self.folders() if f.first == f.last == number])

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.bucket_by), F.lit(self.buckets)).cast("int")

    def lookup(self, **values) -> DataFrame | None:
        """The rows with these key values: one bucket, and of it the row groups whose Bloom filters may hold them."""
        if set(values) != set(self.key):
            raise ValueError(f"a lookup names all of {self.key}")
        found = self.read()
        if found is None:
            return None
        typed = [F.lit(values[c]).cast(found.schema[c].dataType).alias(c) for c in self.key]
        row = self.spark.range(1).select(*typed).select(self.bucket()).first()[0]
        for c in self.key:
            found = found.filter(F.col(c) == F.lit(values[c]))
        return found.filter(F.col(BUCKET) == row).drop(BUCKET)

    def keys_near(self, rows: DataFrame, before: int | None = None) -> DataFrame | None:
        """The stored keys that may equal one of ``rows`` (with their bucket): those of the same buckets, in the same range.

        The buckets are listed on the driver: as many as the table has, at most.
        """
        stored = self.read(before)
        if stored is None:
            return None
        lead = self.bucket_by[0]
        touched = rows.agg(F.collect_set(BUCKET), F.min(lead), F.max(lead)).first()
        near = stored.select(BUCKET, *self.key).filter(F.col(BUCKET).isin(sorted(touched[0])))
        if touched[1] is not None:
            return near.filter(F.col(lead).between(touched[1], touched[2]) | F.col(lead).isNull())
        return near.filter(F.col(lead).isNull())

    # ---------------------------------------------------------------- writing

    def _write(self, rows: DataFrame, path: str) -> None:
        placed = rows.hint("rebalance", BUCKET).sortWithinPartitions(BUCKET, *self.key)
        writer = placed.write.mode("overwrite").partitionBy(BUCKET)
        for column in self.key:
            writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
        writer.option("parquet.bloom.filter.adaptive.enabled", "true").parquet(path)

    def store(self, number: int, rows: DataFrame) -> None:
        """Write ``rows`` as load ``number``, in place of an earlier attempt at it."""
        newer = [f for f in self._complete() if f.last > number or (f.last == number and f.first < number)]
        if newer:
            raise ValueError(f"load {number} was followed by others and cannot be repeated")
        self._remove_merged(number)
        self._merge(number)
        self._write(rows.withColumn(BUCKET, self.bucket()), self._path(number, number))
        if self._spent:
            dropped(self.spark, self._spent)
            self._spent = []

    def first_rows(self, batch: DataFrame, order: list[Column] | None = None) -> DataFrame:
        """The first row per key of ``batch`` (any, without ``order``) with its bucket."""
        first = latest_per_key(batch, self.key, order) if order else batch.dropDuplicates(self.key)
        return first.withColumn(BUCKET, self.bucket())

    def unseen(self, number: int, rows: DataFrame) -> DataFrame:
        """Those of ``rows``, which have their bucket, whose key no load before ``number`` has.

        Where there are earlier loads, the keys of ``rows`` are stored first, until the load is, to tell which buckets they touch and
        how many are new. A batch of known keys but a few, such as one sent again, then stays where it is; only its keys move.
        """
        if self.read(number) is None:
            return rows
        own = stored(rows.select(BUCKET, *self.key), "batch-keys")
        self._spent += own.inputFiles()
        known = self.keys_near(own, number)
        new = own.join(known.toDF(*[f"known_{c}" for c in known.columns]), self._same("known"), "left_anti")
        if new.limit(FEW_KEYS + 1).count() > FEW_KEYS:
            return rows.join(known.toDF(*[f"known_{c}" for c in known.columns]), self._same("known"), "left_anti")
        return rows.join(F.broadcast(new.toDF(*[f"new_{c}" for c in new.columns])), self._same("new"), "left_semi")

    def _same(self, prefix: str) -> list[Column]:
        return [F.col(c).eqNullSafe(F.col(f"{prefix}_{c}")) for c in (BUCKET, *self.key)]

    def new_rows(self, number: int, batch: DataFrame, order: list[Column] | None = None) -> DataFrame:
        """The first row per key of ``batch`` whose key no load before ``number`` has, with its bucket.

        Known keys are left out before the first rows are looked for, so that neither is kept between the two and a batch that
        was seen before moves once.
        """
        return self.first_rows(self.unseen(number, batch.withColumn(BUCKET, self.bucket())), order)

    def insert_ignore(self, number: int, batch: DataFrame, order: list[Column] | None = None) -> None:
        """Store the first row per key of ``batch`` (any, without ``order``) whose key no earlier load has."""
        self.store(number, self.new_rows(number, batch, order))

    def covers(self, number: int) -> bool:
        """Whether all loads from 0 up to ``number``, without it, are there."""
        return sum(f.last - f.first + 1 for f in self.folders(number)) == number

    def rebuild(self, number: int, rows: DataFrame) -> None:
        """Make ``rows`` the content of all loads from 0 up to ``number``, without it."""
        self._write(rows.withColumn(BUCKET, self.bucket()), self._path(0, number - 1))

    def _merge(self, before: int) -> None:
        """Merge neighbouring folders of one size class until no class has ``fan`` of them."""
        while True:
            live, at = self.folders(before), 0
            size = [round(math.log(f.last - f.first + 1, self.fan), 6) // 1 for f in live]
            while at + self.fan <= len(live) and len(set(size[at : at + self.fan])) > 1:
                at += 1
            if at + self.fan > len(live):
                return
            some = live[at : at + self.fan]
            rows = self._folded(some)
            path = self._path(some[0].first, some[-1].last)
            if rows is None:  # empty loads make an empty folder
                self.spark.createDataFrame([], f"{BUCKET} int, none int").write.mode("overwrite").partitionBy(BUCKET).parquet(path)
            else:
                self._write(rows, path)

    def _remove_merged(self, before: int) -> None:
        """Delete folders that a larger one has replaced before this load."""
        found = self._complete()
        for folder in found:
            if any(g.covers(folder) for g in found) and folder.last < before:
                path = self.spark._jvm.org.apache.hadoop.fs.Path(folder.path)
                path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


class MergedTable(KeyedTable):
    """Upserts of ``update_cols`` without rewriting the table: a load holds the rows of its batch, and readers merge by key.

    Of the rows of a key, the first gives the columns that upserts keep and the last those that they update, which is what
    ``merge_subset`` makes of the batches one by one. ``touch_col`` is the time of the last batch that met a stored row.
    Merging is associative, so merged folders hold one row a key and an upsert writes its batch and, now and then, a merged folder.
    """

    def __init__(self, spark: SparkSession, root: str, key: list[str], update_cols: list[str], touch_col: str | None = None, **layout):
        super().__init__(spark, root, key, **layout)
        self.update_cols, self.touch_col = update_cols, touch_col

    def upsert(self, number: int, batch: DataFrame, order: list[str], touched_at: dt.datetime | None = None) -> None:
        """Store a batch, a key repeated in it folded in ``order``, as load ``number``."""
        rows = fold_batch(batch, self.key, self.update_cols, order)
        if self.touch_col:
            rows = rows.drop(self.touch_col).withColumns(
                {self.touch_col: F.lit(None).cast("timestamp_ntz"), TOUCHED: F.lit(touched_at).cast("timestamp_ntz")}
            )
        stored = self.read(number)
        if stored is not None:  # the columns of the table, whatever else a batch brings along or lacks
            fields = [f for f in stored.schema.fields if f.name != BUCKET]
            rows = rows.select(*[(F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields])
        self.store(number, rows)

    def start(self, rows: DataFrame) -> None:
        """Make ``rows``, one for each key, the content of the table before all upserts: load 0."""
        self.store(0, rows.withColumn(TOUCHED, F.lit(None).cast("timestamp_ntz")) if self.touch_col else rows)

    def merged(self, before: int | None = None) -> DataFrame | None:
        """The table as it is: one row for each key."""
        rows = self._folded(self.folders(before))
        return None if rows is None else rows.drop(BUCKET, TOUCHED)

    def _folded(self, folders: list[Folder]) -> DataFrame | None:
        rows = self._rows(folders)
        if rows is None:
            return None
        own = [*self.update_cols, *([self.touch_col, TOUCHED] if self.touch_col else [])]
        kept = [c for c in rows.columns if c not in (*self.key, *own, BUCKET, "loads")]
        at = F.col("loads")
        merges = [F.min_by(F.struct(*(kept or self.key)), at).alias("_first"), F.max_by(F.struct(*(self.update_cols or self.key)), at).alias("_last")]
        if self.touch_col:
            touched = F.max_by(TOUCHED, at)
            merges += [F.when(F.count("*") == 1, F.first(self.touch_col)).otherwise(touched).alias(self.touch_col), touched.alias(TOUCHED)]
        found = rows.groupBy(BUCKET, *self.key).agg(*merges)
        values = {c: F.col(f"_first.{c}") for c in kept} | {c: F.col(f"_last.{c}") for c in self.update_cols}
        return found.select(*[values.get(c, F.col(c)).alias(c) for c in rows.columns if c != "loads"])
