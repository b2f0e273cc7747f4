"""Stored tables: parquet folders with immutable versions."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from wayline.schemas import KEYED, PARTITIONED, TABLES
from wayline.session import materialize
from wayline.sources import files

#: From this many changed rows on a merge is never left to the optimizer's size estimate.
MANY_CHANGES = 20_000
_VERSION = re.compile(r"([va])(\d{8})(?:-(.+))?$")


class Tables:
    """Tables below one base folder.

    Each write makes a new version and never touches the files being read; a
    version counts once Spark's commit marker is there, so a lost job leaves
    the table as it was. A version holds the whole table (`v`) or rows added to
    the one before (`a`), so growing ledgers are never rewritten. A `token`
    names the run or batch that made a version: writing the same token again
    changes nothing. One writer per table at a time, as the schedules allow one
    active run.

    A keyed table's version is laid out in `buckets` folders by the hash of its
    key, and `merge` rewrites the folders that hold changed keys in place.
    """

    def __init__(self, spark: SparkSession, base: str, buckets: int = 32, more: Mapping[str, tuple[str, str]] | None = None):
        """`more`: further keyed tables, each with its schema and key."""
        self.spark = spark
        self.base = base.rstrip("/")
        self.buckets = buckets
        self.schemas = TABLES | {name: schema for name, (schema, _) in (more or {}).items()}
        self.keys = KEYED | {name: key for name, (_, key) in (more or {}).items()}

    def _versions(self, name: str) -> list[tuple[int, str, str | None, str]]:
        """(number, kind, token, path) of every committed version, in order."""
        found = []
        for child in files.children(self.spark, f"{self.base}/{name}"):
            match = _VERSION.match(child)
            path = f"{self.base}/{name}/{child}"
            if match and files.committed(self.spark, path):
                found.append((int(match.group(2)), match.group(1), match.group(3), path))
        return sorted(found)

    def exists(self, name: str) -> bool:
        return bool(self._versions(name))

    def applied(self, name: str, token: str) -> bool:
        """Whether a run or batch has written, also when its version has expired since."""
        token = _clean(token)
        return any(seen == token for _, _, seen, _ in self._versions(name)) or files.exists(self.spark, self._mark(name, token))

    def _mark(self, name: str, token: str) -> str:
        return f"{self.base}/{name}/_applied/{token}"

    def read(self, name: str) -> DataFrame:
        """Latest version; a known table never written yet reads as empty."""
        versions = self._versions(name)
        if versions:
            return self._load(name, *self._current(versions))
        if name not in self.schemas:
            raise KeyError(f"no table {name}")
        return self.spark.createDataFrame([], self.schemas[name])

    def _load(self, name: str, *paths: str) -> DataFrame:
        if name not in self.schemas:
            return self.spark.read.parquet(*paths)
        return self.spark.read.schema(self.schemas[name]).parquet(*paths).select(*self._columns(name))

    @staticmethod
    def _current(versions: list[tuple[int, str, str | None, str]]) -> list[str]:
        """Paths of the last whole version and of what was added since."""
        whole = [i for i, v in enumerate(versions) if v[1] == "v"]
        return [v[3] for v in versions[whole[-1] if whole else 0 :]]

    def write(self, name: str, df: DataFrame, token: str | None = None) -> DataFrame:
        """Publish `df` as the whole table; returns the table as stored."""
        return self._publish("v", name, df, token)

    def append(self, name: str, df: DataFrame, token: str | None = None) -> DataFrame:
        """Add the rows of `df`; returns the added rows as stored."""
        return self._publish("a", name, df, token)

    def _publish(self, kind: str, name: str, df: DataFrame, token: str | None) -> DataFrame:
        """Write one version."""
        versions = self._versions(name)
        if token is not None:
            token = _clean(token)
            for _, _, seen, path in versions:
                if seen == token:
                    return self._load(name, path)
            if files.exists(self.spark, self._mark(name, token)):
                return self.read(name)
        number = versions[-1][0] + 1 if versions else 1
        path = f"{self.base}/{name}/{kind}{number:08d}" + (f"-{token}" if token else "")
        if name in self.keys:
            self._write_buckets(self._declared(name, df), name, path, self.buckets)
        elif name in PARTITIONED:
            self._declared(name, df).write.mode("overwrite").partitionBy(*PARTITIONED[name]).parquet(path)
        else:
            self._declared(name, df).write.mode("overwrite").parquet(path)
        return self._load(name, path)

    def _write_buckets(self, df: DataFrame, name: str, path: str, buckets: int, mode: str = "static") -> None:
        column = f"bucket{buckets}"
        # One file for a small bucket, several for a large one.
        rows = df.withColumn(column, _bucket(self.keys[name], buckets)).hint("rebalance", column)
        rows.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy(column).parquet(path)

    def merge(self, name: str, changes: DataFrame, change: Callable[[DataFrame], DataFrame]) -> list[int]:
        """Rewrite the buckets of a keyed table that hold keys of `changes`; returns their numbers.

        `change` gets the stored rows of these buckets and returns them as they
        shall be. Its result is stored before a bucket is replaced, so a lost
        job leaves old or new buckets; merging the same changes again completes
        it. Frames read from the table earlier must be stored or done with.
        """
        versions = self._versions(name)
        if not versions:
            self.write(name, change(self.read(name).hint("merge")))
            return list(range(self.buckets))
        path = self._current(versions)[-1]
        # The folders say how many buckets the version has; an empty version has none yet.
        found = [re.match(r"bucket(\d+)=", child) for child in files.children(self.spark, path)]
        buckets = next((int(m.group(1)) for m in found if m), self.buckets)
        column = f"bucket{buckets}"
        key = _bucket(self.keys[name], buckets)
        counts = changes.groupBy(key.alias("b")).agg(F.count("*").alias("n")).collect()
        touched = sorted(r["b"] for r in counts)
        if not touched:
            return []
        stored = self.spark.read.schema(f"{self.schemas[name]}, {column} INT").parquet(path)
        stored = stored.where(F.col(column).isin(touched)).select(*self._columns(name))
        # The size of a stored file says little of rows read from it: most columns are compressed or empty.
        if sum(r["n"] for r in counts) > MANY_CHANGES:
            stored = stored.hint("merge")
        new = self._declared(name, change(stored))
        staged = materialize(new, "merge")
        kept = {r[0] for r in staged.select(key.alias("b")).distinct().collect()}
        if not kept <= set(touched):
            raise ValueError(f"{name}: rows of other keys than those of the changes")
        if kept:
            self._write_buckets(staged, name, path, buckets, "dynamic")
        for b in set(touched) - kept:  # nothing is left in them
            files.delete(self.spark, f"{path}/{column}={b}")
        return touched

    def _columns(self, name: str) -> list[Column]:
        return [F.col(f"`{f.name}`") for f in StructType.fromDDL(self.schemas[name]).fields]

    def _declared(self, name: str, df: DataFrame) -> DataFrame:
        """A declared table gets its declared columns and types."""
        if name not in self.schemas:
            return df
        fields = StructType.fromDDL(self.schemas[name]).fields
        return df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in fields])

    def additions(self, name: str) -> int:
        """How many versions a reader puts together."""
        return len(self._current(self._versions(name)))

    def compact(self, name: str) -> DataFrame:
        """Rewrite a table of many additions as one whole version."""
        return self.write(name, self.read(name))

    def expire(self, name: str, keep: int = 2) -> int:
        """Delete versions older than the newest `keep` whole ones, not what they applied; returns how many went."""
        versions = self._versions(name)
        whole = [i for i, v in enumerate(versions) if v[1] == "v"]
        old = versions[: whole[-keep]] if len(whole) >= max(1, keep) else []
        for _, _, token, path in old:
            if token:
                files.mark(self.spark, self._mark(name, token))
            files.delete(self.spark, path)
        return len(old)


def _bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _clean(token: str) -> str:
    return re.sub(r"[^0-9A-Za-z_.=-]", "_", token)


def code_table_scan(codes: DataFrame, columns: list[str], order_by: list[str], where=None) -> DataFrame:
    """Ordered, filtered key read of a code table."""
    rows = codes if where is None else codes.where(where)
    return rows.select(*columns).orderBy(*order_by)


def read_jdbc(spark: SparkSession, url: str, table: str, key: str, bounds: tuple[int, int], partitions: int, **options) -> DataFrame:
    """A table of an existing database, read in parallel key ranges."""
    return (
        spark.read.format("jdbc")
        .options(url=url, dbtable=table, partitionColumn=key, lowerBound=bounds[0], upperBound=bounds[1],
                 numPartitions=partitions, **options)
        .load()
    )
