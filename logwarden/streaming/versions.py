"""A table with one row per key, kept in versions and published as a whole.

A refresh brings the rows that changed. They are written as a new version, dealt to buckets
by a hash of the key; buckets without changed rows are not touched. Where a bucket has
collected as many changed rows as it had at first, or many versions, they are merged into
one, so that over time each row is rewritten a logarithmic number of times.

A manifest names the versions that make up each bucket. It is one small file per refresh,
written last, and a file appears at once or not at all: readers look for the newest manifest
and see that refresh whole, whatever is being written meanwhile. Versions of older refreshes
are deleted when ``keep`` newer ones are published, so a reader has that long to finish. A
refresh that is retried writes the same versions again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logwarden.sources.folders import delete_folder

_MANIFEST = "name string, bucket int, version bigint, rows bigint"


@dataclass(frozen=True, order=True)
class Entry:
    """A version that a refresh is made of: of a bucket of the table, or of a named extra folder."""

    name: str
    bucket: int
    version: int
    rows: int


@dataclass(frozen=True)
class Refresh:
    batch: int
    entries: tuple[Entry, ...]

    def extra(self, name: str) -> int | None:
        """The version of an extra folder that belongs to this refresh."""
        return next((e.version for e in self.entries if e.name == name), None)


class VersionedTable:
    """Rows of ``schema`` under ``path``, one per ``key``. The number of buckets must not change."""

    ROWS = "rows"

    def __init__(self, spark: SparkSession, path: str, schema: str, key: str, buckets: int = 32, keep: int = 3, most_versions: int = 8):
        self.spark, self.path, self.schema, self.key = spark, path, T.StructType.fromDDL(schema), key
        self.buckets, self.keep, self.most_versions = buckets, keep, most_versions

    def folder(self, entry: Entry) -> str:
        if entry.name != self.ROWS:
            return self.extra_folder(entry.name, entry.version)
        return f"{self.path}/data/version={entry.version}/bucket={entry.bucket}"

    def extra_folder(self, name: str, version: int) -> str:
        return f"{self.path}/{name}/version={version}"

    # --- reading ----------------------------------------------------------------------

    def refreshes(self) -> list[Refresh]:
        """The published refreshes that are still kept, oldest first: a few rows per bucket and refresh."""
        reader = self.spark.read.schema(f"{_MANIFEST}, batch bigint").option("ignoreMissingFiles", True)
        try:
            rows = reader.json(f"{self.path}/manifest").collect()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return []
        batches = {r["batch"] for r in rows}
        return [Refresh(b, tuple(sorted(Entry(r["name"], r["bucket"], r["version"], r["rows"]) for r in rows if r["batch"] == b and r["name"]))) for b in sorted(batches)]

    def latest(self, before: int | None = None) -> Refresh | None:
        """The newest published refresh, or the newest one before a batch."""
        found = [r for r in self.refreshes() if before is None or r.batch < before]
        return found[-1] if found else None

    def read(self, refresh: Refresh | None, buckets: list[int] | None = None) -> DataFrame:
        """The rows of a refresh, one per key; of some buckets only, where these are given."""
        mine = [e for e in (refresh.entries if refresh else ()) if e.name == self.ROWS and (buckets is None or e.bucket in buckets)]
        return self._newest(mine)

    def _newest(self, entries: list[Entry]) -> DataFrame:
        versions: dict[int, int] = {}
        for e in entries:
            versions[e.bucket] = versions.get(e.bucket, 0) + 1
        columns = self.schema.names
        single = [e for e in entries if versions[e.bucket] == 1]
        several = [e for e in entries if versions[e.bucket] > 1]
        if not entries:
            return self.spark.createDataFrame([], self.schema)
        merged = None
        if several:
            latest = [F.max_by(c, "version").alias(c) for c in columns if c != self.key]
            merged = self._load(several).groupBy(self.key).agg(*latest).select(*columns)
        if not single:
            return merged
        plain = self._load(single).select(*columns)
        return plain if merged is None else plain.unionByName(merged)

    def _load(self, entries: list[Entry]) -> DataFrame:
        whole = T.StructType([*self.schema.fields, T.StructField("version", T.LongType()), T.StructField("bucket", T.IntegerType())])
        return self.spark.read.schema(whole).option("basePath", f"{self.path}/data").parquet(*[self.folder(e) for e in entries])

    # --- writing ----------------------------------------------------------------------

    def bucket_of(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def _write(self, rows: DataFrame, version: int) -> list[Entry]:
        """One file per bucket that has rows; what was written."""
        target = f"{self.path}/data/version={version}"
        dealt = rows.select(*self.schema.names, self.bucket_of().alias("bucket")).repartition("bucket")
        dealt.write.mode("overwrite").partitionBy("bucket").parquet(target)
        # with a schema, as a version without rows has no files to tell it
        written = self.spark.read.schema(T.StructType([*self.schema.fields, T.StructField("bucket", T.IntegerType())])).parquet(target)
        counts = written.groupBy("bucket").count().collect()
        return [Entry(self.ROWS, r["bucket"], version, r["count"]) for r in counts]

    def merge(self, changed: DataFrame, batch: int) -> tuple[DataFrame, Refresh]:
        """Write changed rows (one per key) as part of refresh ``batch``, which is not yet published.

        Returns the changed rows as stored, and the refresh.
        """
        before = self.latest(before=batch)
        fresh = self._write(changed, 2 * batch)
        stored = self._newest(fresh)
        entries = [e for e in (before.entries if before else ()) if e.name == self.ROWS] + fresh
        touched = {e.bucket for e in fresh}
        of_bucket: dict[int, list[Entry]] = {}
        for e in sorted(entries):
            of_bucket.setdefault(e.bucket, []).append(e)
        due = [b for b in touched if len(of_bucket[b]) > 1 and (len(of_bucket[b]) > self.most_versions or sum(e.rows for e in of_bucket[b][1:]) >= of_bucket[b][0].rows)]
        if due:
            rows = self._newest([e for b in due for e in of_bucket[b]])
            entries = [e for e in entries if e.bucket not in due] + self._write(rows, 2 * batch + 1)
        return stored, Refresh(batch, tuple(sorted(entries)))

    def publish(self, refresh: Refresh, **extras: int | None) -> Refresh:
        """Make a refresh the newest one, with the versions of extra folders; delete what only old ones need."""
        named = [Entry(name, 0, version, 0) for name, version in extras.items() if version is not None]
        rows = [(e.name, e.bucket, e.version, e.rows) for e in (*refresh.entries, *named)]
        # a refresh without any row is published as well
        table = self.spark.createDataFrame(rows or [(None, None, None, None)], _MANIFEST)
        table.coalesce(1).write.mode("overwrite").option("ignoreNullFields", False).json(f"{self.path}/manifest/batch={refresh.batch}")
        self._clean()
        return Refresh(refresh.batch, tuple(sorted([*refresh.entries, *named])))

    def _clean(self) -> None:
        known = self.refreshes()
        old, kept = known[: -self.keep], known[-self.keep :]
        needed = {(e.name, e.bucket, e.version) for r in kept for e in r.entries}
        for refresh in old:
            for e in refresh.entries:
                if (e.name, e.bucket, e.version) not in needed:
                    delete_folder(self.spark, self.folder(e))
            delete_folder(self.spark, f"{self.path}/manifest/batch={refresh.batch}")
