"""Tables of which a change rewrites only the partitions that hold its keys.

A keyed table is a Parquet folder partitioned by a hash of its ``by`` columns.  A change reads the
partitions its keys fall into, applies one of the operators of ``operators.changes`` to them and writes them back with
Spark's dynamic partition overwrite; the files of all other partitions stay as they are.  Child tables partitioned by
the key of their parent change in the partitions of the parents at hand.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import changes as C
from ..session import stage

#: partitions of a table unless told otherwise; a table of 100 TB wants some ten thousand
BUCKETS = 64
_PREFIX = "bucket_of_"


class KeyedTable:
    """One table; it has one writer at a time.

    The partition column is called ``bucket_of_<number>``, so the folder itself tells how its keys are dealt.  A write that
    dies before Spark's commit leaves the table as it was; repeating a change gives the same rows.
    """

    def __init__(self, spark: SparkSession, path: str, by: Sequence[str]):
        self.spark, self.path, self.by = spark, path, list(by)
        # an empty file beside the partitions keeps the columns of a table without rows
        self.schema = spark.read.parquet(f"{path}/_shape").schema
        self.bucket = self.schema.names[-1]
        self.columns = self.schema.names[:-1]
        missing = [c for c in self.by if c not in self.columns]
        if missing or not self.bucket.startswith(_PREFIX):
            raise ValueError(f"{path} is no table keyed by {by}")

    @classmethod
    def create(cls, df: DataFrame, path: str, by: Sequence[str], buckets: int = BUCKETS) -> KeyedTable:
        """A new table with the rows of ``df``."""
        name = f"{_PREFIX}{buckets}"
        rows = df.withColumn(name, _bucket(by, buckets))
        rows.limit(0).coalesce(1).write.parquet(f"{path}/_shape")
        rows.hint("rebalance", name).write.mode("append").partitionBy(name).parquet(path)
        return cls(df.sparkSession, path, by)

    def bucket_of(self, columns: Sequence[str] | None = None) -> Column:
        return _bucket(columns or self.by, int(self.bucket[len(_PREFIX):]))

    def read(self, buckets: Sequence[int] | None = None) -> DataFrame:
        """All rows, or those of some partitions; the others are not listed in the plan."""
        rows = self.spark.read.schema(self.schema).parquet(self.path)
        if buckets is not None:
            rows = rows.filter(F.col(self.bucket).isin([int(b) for b in buckets]))
        return rows.select(*self.columns)

    def touched(self, keys: DataFrame) -> list[int]:
        """The partitions that keys fall into: at most as many numbers as there are partitions."""
        found = keys.select(self.bucket_of().alias("b")).distinct().collect()
        return sorted(r.b for r in found)

    def change(self, keys: DataFrame, how: Callable[[DataFrame], DataFrame]) -> list[int]:
        """Replace the touched partitions by what ``how`` makes of them, and return their numbers."""
        touched = self.touched(keys)
        if not touched:
            return touched
        after = stage(how(self.read(touched)).select(*self.columns).withColumn(self.bucket, self.bucket_of()))
        left = {r[0] for r in after.select(self.bucket).distinct().collect()}
        if not left <= set(touched):
            raise ValueError("a change moved rows to keys it did not name")
        after.hint("rebalance", self.bucket).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy(self.bucket).parquet(self.path)
        self._drop([b for b in touched if b not in left])
        self.spark.catalog.refreshByPath(self.path)
        return touched

    def _drop(self, buckets: Sequence[int]) -> None:
        """Remove partitions that have lost all rows, which an overwrite leaves alone."""
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for b in buckets:
            folder = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{self.bucket}={b}")
            folder.getFileSystem(conf).delete(folder, True)

    def _within(self, keys: Sequence[str]) -> None:
        if not set(self.by) <= set(keys):
            raise ValueError(f"the table is dealt by {self.by}, which {list(keys)} do not hold")

    # --- the operators of changes.py on the touched partitions ---

    def upsert(
        self, rows: DataFrame, keys: Sequence[str], audit: C.Audit | None = None, optional: Sequence[str] = (),
        keep_first: Sequence[str] = (),
    ) -> list[int]:
        self._within(keys)
        rows = rows.dropna(subset=list(keys))
        return self.change(rows, lambda old: C.upsert(old, rows, keys, audit, optional, keep_first))

    def replace_children(
        self, incoming: DataFrame, keys: Sequence[str], parent: Sequence[str], audit: C.Audit | None = None,
        on_empty: str = "keep", parents: DataFrame | None = None,
    ) -> list[int]:
        self._within(parent)
        named = incoming.dropna(subset=list(keys)).select(*parent)
        if parents is not None:
            named = named.unionByName(parents.select(*parent))
        return self.change(named, lambda old: C.replace_children(old, incoming, keys, parent, audit, on_empty, parents))

    def sync_children(
        self, incoming: DataFrame, parent: Sequence[str], child: Sequence[str], on_empty: str = "keep",
        parents: DataFrame | None = None,
    ) -> list[int]:
        self._within(parent)
        named = incoming.select(*parent)
        if parents is not None:
            named = named.unionByName(parents.select(*parent))
        return self.change(named, lambda old: C.sync_children(old, incoming, parent, child, on_empty, parents))

    def delete(self, ids: DataFrame) -> list[int]:
        """Remove the rows whose ``by`` columns are among ``ids``."""
        gone = ids.select(*self.by).distinct()
        return self.change(gone, lambda old: old.join(gone, self.by, "left_anti"))

    def mirror(self, eligible: DataFrame) -> list[int]:
        """Remove the rows whose ``by`` columns are not among those of ``eligible``; only key columns are compared."""
        gone = self.read().select(*self.by).distinct().join(eligible.select(*self.by), self.by, "left_anti")
        return self.delete(stage(gone))


def _bucket(by: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*by), F.lit(buckets)).cast("int")


def cascade_delete(tables: Mapping[str, KeyedTable], ids: DataFrame) -> dict[str, list[int]]:
    """Remove a set of ids from a master table and its child tables, all dealt by that id."""
    return {name: table.delete(ids) for name, table in tables.items()}
