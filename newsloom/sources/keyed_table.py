"""A table on disk with one row per key: an upsert rewrites only the buckets whose keys change.

Rows lie in ``bucket=<hash of the key>/version=<n>``. An upsert writes the changed buckets
under a new version beside the old ones, then a list of each bucket's version
below ``_versions``; with that the new state is in force, and only then are the old
versions taken away. A run that dies before leaves the table as it was; a bucket without
a changed key keeps its very files.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newsloom.session import read_or_empty, stored
from newsloom.sources.package_source import opened_folder

BUCKETS = 64
LIST_SCHEMA = "bucket int, version bigint, buckets int, state bigint"


class KeyedTable:
    """``schema`` is that of the rows, ``keys`` their key. Choose ``buckets`` so that one is
    some 100 MB; the number stays with the table once it is written."""

    def __init__(self, spark: SparkSession, path: str, schema: str, keys: list[str], buckets: int = BUCKETS):
        self.spark, self.path, self.schema, self.keys = spark, path.rstrip("/"), schema, keys
        self.buckets = buckets

    def _versions(self) -> tuple[int, dict[int, int]]:
        """The state in force and each bucket's version: one short row per bucket."""
        lists = read_or_empty(self.spark, f"{self.path}/_versions", LIST_SCHEMA)
        last = lists.agg(F.max("state")).first()[0]
        if last is None:
            return 0, {}
        rows = lists.where(F.col("state") == last).collect()
        self.buckets = rows[0].buckets
        return last, {row.bucket: row.version for row in rows}

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _of(self, versions: dict[int, int]) -> DataFrame:
        rows = read_or_empty(self.spark, self.path, f"{self.schema}, bucket int, version bigint")
        by_version: dict[int, list[int]] = {}
        for bucket, version in versions.items():
            by_version.setdefault(version, []).append(bucket)
        here = [(F.col("version") == v) & F.col("bucket").isin(sorted(b)) for v, b in sorted(by_version.items())]
        return rows.where(reduce(Column.__or__, here, F.lit(False)))

    def read(self) -> DataFrame:
        """The rows in force, with the columns of ``schema``."""
        return self._of(self._versions()[1]).drop("bucket", "version")

    def laid_out(self, rows: DataFrame, name: str) -> DataFrame:
        """Rows with each key once, stored as ``name`` with those of a bucket together, for ``upsert``."""
        self._versions()
        return stored(rows.withColumn("bucket", self._bucket()).hint("rebalance", "bucket").drop("bucket"), name)

    def upsert(
        self, rows: DataFrame, order: list[Column] | None = None, laid_out: bool = False
    ) -> list[int]:
        """Put rows in the place of those with the same key; returns the buckets that changed.

        Of several new rows with one key the first by ``order`` counts (without it, the
        least by all columns). A null key is a key like any other. ``laid_out`` rows come from
        ``laid_out`` of a table of these keys, other columns changed at most: they are not ranked, and
        shuffled only where old rows are in their buckets.
        """
        state, versions = self._versions()
        names = [field.name for field in self.spark.createDataFrame([], self.schema).schema]
        if not laid_out:
            place = Window.partitionBy(*self.keys).orderBy(*(order or [F.struct(*rows.columns)]))
            rows = rows.withColumn("_place", F.row_number().over(place)).where("_place = 1")
        new = rows.select(*names, self._bucket().alias("bucket"))
        if not laid_out:
            new = stored(new, "upsert")
        changed = sorted(row.bucket for row in new.select("bucket").distinct().collect())
        if not changed:
            return []
        version = state + 1
        replaced = {b: v for b, v in versions.items() if b in set(changed)}
        old = self._of(replaced).drop("version")
        same = reduce(Column.__and__, [old[k].eqNullSafe(F.col(f"_new.{k}")) for k in self.keys])
        rest = old.join(new.select(*self.keys).alias("_new"), same, "left_anti")
        merged = rest.unionByName(new) if replaced else new
        if replaced or not laid_out:
            # Large buckets are cut, small ones stay whole.
            merged = merged.hint("rebalance", "bucket")
        merged = merged.withColumn("version", F.lit(version))
        merged.write.mode("append").partitionBy("bucket", "version").parquet(self.path)
        now = {**versions, **dict.fromkeys(changed, version)}
        listed = [(b, v, self.buckets, version) for b, v in sorted(now.items())]
        self.spark.createDataFrame(listed, LIST_SCHEMA).coalesce(1).write.mode("append").parquet(
            f"{self.path}/_versions"
        )
        self._drop(replaced)
        return changed

    def _drop(self, versions: dict[int, int]) -> None:
        system, base = opened_folder(self.path)
        for bucket, version in versions.items():
            system.delete_dir_contents(f"{base}/bucket={bucket}/version={version}", missing_dir_ok=True)
            system.delete_dir(f"{base}/bucket={bucket}/version={version}")
