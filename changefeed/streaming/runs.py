"""A keyed table as sorted runs in buckets, read bucket by bucket.

Rows go to a bucket by the hash of their key. Every epoch adds a run, one file per bucket that
it touches, sorted by key and with a Bloom filter. When a bucket has ``fan_in`` runs of one
level they are merged into one of the next, so a bucket of n rows has runs in the order of
log n. A manifest per epoch lists the runs that make up the table after it. It is written last:
a reader of epoch N takes the list of epoch N and nothing else, whatever is added or merged
meanwhile, and an epoch that runs again replaces its runs and its list.

What an epoch reads follows from the buckets of its own keys. Lists on the driver have at most
``fan_in - 1`` runs per bucket and level.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changefeed.schemas import ddl
from changefeed.session import delete_path, numbered_folders

BUCKETS, FAN_IN = 64, 4
# An older list and what only it needs is kept for so many epochs, for readers that began then.
KEEP = 4


@dataclass(frozen=True, order=True)
class Run:
    bucket: int
    level: int
    path: str


class Runs:
    """The keyed table under ``root``.

    ``columns`` maps names to types, ``keys`` are the first of them. If keys repeat, ``newest``
    names the column whose highest value wins when runs are merged; without it the rows of a
    key are equal, and one stays.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        columns: dict[str, str],
        keys: tuple[str, ...],
        *,
        newest: str | None = None,
        buckets: int = BUCKETS,
        fan_in: int = FAN_IN,
    ) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self.columns, self.keys, self.newest = columns, keys, newest
        self.buckets, self.fan_in = buckets, fan_in

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def listed(self, epoch: int) -> list[Run]:
        """The runs of the table after ``epoch``."""
        if epoch < 0:
            return []
        rows = self.spark.read.schema("bucket int, level int, path string").parquet(self._list_path(epoch))
        return sorted(Run(r["bucket"], r["level"], f"{self.root}/{r['path']}") for r in rows.collect())

    def rows(self, epoch: int) -> DataFrame:
        """The whole table after ``epoch``; a key may have several rows, as its runs hold it."""
        return self._read(run.path for run in self.listed(epoch))

    def matching(self, wanted: DataFrame, epoch: int) -> DataFrame:
        """The rows after ``epoch`` of the keys in ``wanted``: only their buckets are opened."""
        runs = self.listed(epoch)
        if not runs:
            return self._read(())
        found = wanted.select(self.bucket().alias("bucket")).distinct().collect()
        own = {row["bucket"] for row in found}
        rows = self._read(run.path for run in runs if run.bucket in own)
        return rows.join(wanted.select(*self.keys).distinct(), list(self.keys), "left_semi")

    def add(self, rows: DataFrame, epoch: int) -> None:
        """The table after ``epoch``: that of the epoch before with ``rows``, merged where due."""
        runs = self.listed(epoch - 1)
        runs += self._write(rows.select(*self.columns), epoch, 0)
        level = 0
        while due := self._due(runs, level):
            merged = [run for run in runs if run.bucket in due and run.level <= level]
            table = self._newest(self._read(run.path for run in merged))
            runs = [run for run in runs if run not in set(merged)]
            level += 1
            runs += self._write(table, epoch, level)
        places = [(run.bucket, run.level, run.path.removeprefix(f"{self.root}/")) for run in sorted(runs)]
        listing = self.spark.createDataFrame(places, "bucket int, level int, path string")
        listing.coalesce(1).write.mode("overwrite").parquet(self._list_path(epoch))

    def retire(self, epoch: int, *, keep: int = KEEP) -> None:
        """Delete lists older than ``keep`` epochs, and the runs that no kept list names."""
        lists = numbered_folders(self.spark, f"{self.root}/lists", "epoch")
        old = {n for n in lists if n <= epoch - keep}
        if not old:
            return
        # What an old list names that the oldest kept one does not was merged before it.
        used = {run.path for run in self.listed(min(lists - old))}
        for number in sorted(old):
            for run in self.listed(number):
                if run.path not in used:
                    delete_path(self.spark, run.path)
            delete_path(self.spark, self._list_path(number))

    def _list_path(self, epoch: int) -> str:
        return f"{self.root}/lists/epoch={epoch}"

    def _due(self, runs: list[Run], level: int) -> set[int]:
        counts = Counter(run.bucket for run in runs if run.level == level)
        return {bucket for bucket, n in counts.items() if n >= self.fan_in}

    def _newest(self, rows: DataFrame) -> DataFrame:
        if self.newest is None:
            return rows.dropDuplicates(list(self.keys))
        others = [name for name in self.columns if name not in self.keys]
        best = F.max_by(F.struct(*others), F.col(self.newest))
        return rows.groupBy(*self.keys).agg(best.alias("_row")).select(*self.keys, "_row.*")

    def _read(self, paths: Iterable[str]) -> DataFrame:
        schema = ddl(self.columns)
        listed = list(paths)
        if not listed:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*listed)

    def _write(self, rows: DataFrame, epoch: int, level: int) -> list[Run]:
        path = f"{self.root}/runs/epoch={epoch}/level={level}"
        (
            rows.withColumn("bucket", self.bucket())
            .repartition("bucket")
            .sortWithinPartitions("bucket", *self.keys)
            .write.mode("overwrite")
            .option(f"parquet.bloom.filter.enabled#{self.keys[-1]}", "true")
            .option("parquet.bloom.filter.adaptive.enabled", "true")
            .partitionBy("bucket")
            .parquet(path)
        )
        return [
            Run(bucket, level, f"{path}/bucket={bucket}")
            for bucket in sorted(numbered_folders(self.spark, path, "bucket"))
        ]
