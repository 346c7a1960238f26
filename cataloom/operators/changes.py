"""Keyed changes: upsert, child sync, deletes, enrichment, flags and ids.

Tables are DataFrames; each operator returns the new table.  Joins run on the
key, whose rows are unique on at least one side, and deletes are semi or anti
joins, so a hot key on the other side can be split by adaptive execution.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import present

_CHANGE = "_chg_"


@dataclass(frozen=True)
class Audit:
    """Who writes and when.  The time is passed in, so reruns give equal rows."""

    now: datetime
    user: int = 0

    def values(self) -> dict[str, Column]:
        now = F.lit(self.now.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")
        user = F.lit(self.user).cast("int")
        return {
            "TIM_UPDATED": now,
            "DELETED": F.lit(0),
            "DAT_CREAT": now.cast("date"),
            "ID_CREATOR": user,
            "ID_OWNER": user,
            "ID_USER_UPDATED": user,
        }


def with_audit(changes: DataFrame, is_insert: Column, audit: Audit) -> DataFrame:
    """Add the audit columns a write sets.  Columns already supplied stay as they are."""
    out = changes
    for name, value in audit.values().items():
        if name in changes.columns:
            continue
        out = out.withColumn(name, value if name == "TIM_UPDATED" else F.when(is_insert, value))
    return out


def _field(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def _merge(
    target: DataFrame, changes: DataFrame, keys: Sequence[str], audit: Audit | None,
    optional: Sequence[str] = (), keep_first: Sequence[str] = (),
) -> tuple[DataFrame, DataFrame]:
    """Target columns after an upsert, plus ``_new``: the row was written now.  Known rows and inserted ones."""
    keys = list(keys)
    supplied = [c for c in changes.columns if c not in keys]
    unknown = [c for c in supplied if c not in target.columns]
    if unknown:
        raise ValueError(f"columns missing in the target: {unknown}")
    # a null key names no row: such changes are refused
    new = changes.dropna(subset=keys).select(
        *keys, *[F.col(c).alias(_CHANGE + c) for c in supplied], F.lit(True).alias("_new")
    )
    stamps = audit.values() if audit else {}

    def value(name: str, insert: bool) -> Column:
        kind = _field(target, name)
        before = F.lit(None).cast(kind) if insert else F.col(name)
        if name in keys:
            return F.col(name).cast(kind)
        write = F.lit(True) if insert else F.col("_new").isNotNull()
        if name in supplied:
            after = F.col(_CHANGE + name).cast(kind)
            if name in optional:
                is_text = isinstance(_field(changes, name), T.StringType)
                write = write & (present(after) if is_text else after.isNotNull())
            if name in keep_first and not insert:
                return before
        elif name == "TIM_UPDATED" and name in stamps or insert and name in stamps:
            after = stamps[name].cast(kind)
        else:
            return before
        return F.when(write, after).otherwise(before)

    def rows(found: DataFrame, insert: bool) -> DataFrame:
        return found.select(*[value(c, insert).alias(c) for c in target.columns], "_new")

    # few changes can be broadcast here, so the wide target need not move
    known = rows(target.join(new, keys, "left"), False)
    return known, rows(new.join(target.select(*keys), keys, "left_anti"), True)


def upsert(
    target: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    audit: Audit | None = None,
    optional: Sequence[str] = (),
    keep_first: Sequence[str] = (),
) -> DataFrame:
    """Insert new keys; on known keys set the supplied columns only.

    A supplied null overwrites.  Columns in ``optional`` are written only when
    their new value is non-empty, columns in ``keep_first`` only on insert.
    Both inputs hold each key once; changes whose key holds a null are refused.  Known keys
    are set by a left join, new ones found by an anti join on the key columns alone, so a small
    batch can be broadcast and leaves the target where it is.
    """
    known, inserted = _merge(target, changes, keys, audit, optional, keep_first)
    return known.unionByName(inserted).drop("_new")


def _touched(
    incoming: DataFrame, parent: Sequence[str], on_empty: str, parents: DataFrame | None
) -> DataFrame:
    """Parents whose children a payload may remove."""
    if on_empty not in ("keep", "purge"):
        raise ValueError(on_empty)
    if on_empty == "purge" and parents is None:
        raise ValueError("purge needs the parents of the payload")
    source = incoming if on_empty == "keep" else parents
    return source.select(*parent).distinct().withColumn("_touched", F.lit(True))


def replace_children(
    target: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    parent: Sequence[str],
    audit: Audit | None = None,
    on_empty: str = "keep",
    parents: DataFrame | None = None,
) -> DataFrame:
    """``upsert`` and ``sync_children`` in one pass over the target.

    For children whose upsert key names the child: a row survives when it was
    written now or when its parent is not touched.  Only rows of the target are looked up
    among the touched parents: inserted ones survive anyway and stay where they are.
    """
    known, inserted = _merge(target, incoming, keys, audit)
    known = known.join(_touched(incoming, parent, on_empty, parents), list(parent), "left")
    known = known.filter(F.col("_new").isNotNull() | F.col("_touched").isNull())
    return known.select(*target.columns).unionByName(inserted.select(*target.columns))


def mirror_delete(target: DataFrame, eligible: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Keep the rows whose key still passes the source filter."""
    keys = [key] if isinstance(key, str) else list(key)
    return target.join(eligible.select(*keys), keys, "left_semi")


def sync_children(
    target: DataFrame,
    incoming: DataFrame,
    parent: Sequence[str],
    child: Sequence[str],
    on_empty: str = "keep",
    parents: DataFrame | None = None,
) -> DataFrame:
    """Per parent, drop the target rows the new payload no longer names.

    ``keep``: a parent without incoming rows keeps its children.
    ``purge``: every parent in ``parents`` is cleared down to its incoming rows.
    The target is read once; both markers are unique per key.
    """
    parent, link = list(parent), [*parent, *child]
    named = incoming.select(*link).distinct()
    rows = target.join(_touched(incoming, parent, on_empty, parents), parent, "left").join(
        named.withColumn("_named", F.lit(True)), link, "left"
    )
    rows = rows.filter(F.col("_touched").isNull() | F.col("_named").isNotNull())
    return rows.select(*target.columns)


def drop_orphans(bridge: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Remove bridge rows whose dimension row is gone."""
    return bridge.join(dim.select(key), key, "left_semi")


def cascade_delete(
    tables: Mapping[str, DataFrame], ids: DataFrame, key: str
) -> dict[str, DataFrame]:
    """Remove a set of ids from the master table and all its child tables."""
    gone = ids.select(key).distinct()
    return {name: df.join(gone, key, "left_anti") for name, df in tables.items()}


def enrich(
    target: DataFrame,
    lookup: DataFrame,
    on: Mapping[str, str],
    mapping: Mapping[str, str],
    where: Column | None = None,
) -> DataFrame:
    """Overwrite target columns of matched rows; unmatched rows keep their values.

    ``on`` maps target to lookup key columns, ``mapping`` target to lookup value
    columns.  A lookup key with several rows counts once, with its smallest values.
    """
    keys = [f"_k{i}" for i in range(len(on))]
    picked = F.min(F.struct(*mapping.values())).alias("_v")
    small = lookup.select(
        *[F.col(k).alias(a) for k, a in zip(on.values(), keys)], *mapping.values()
    )
    small = small.dropna(subset=keys).groupBy(*keys).agg(picked)
    match = [F.col(c) == F.col(a) for c, a in zip(on, keys)]
    rows = target.join(small, match, "left")
    hit = F.col("_v").isNotNull()
    if where is not None:
        hit = hit & where
    columns = []
    for name in target.columns:
        if name in mapping:
            after = F.col("_v")[mapping[name]].cast(_field(target, name))
            columns.append(F.when(hit, after).otherwise(F.col(name)).alias(name))
        else:
            columns.append(F.col(name))
    return rows.select(*columns)


def mark_used(dim: DataFrame, used: DataFrame, key: str, flag: str) -> DataFrame:
    """Set ``flag`` to 1 on the dimension rows whose key is used."""
    marks = used.select(key).distinct().withColumn("_used", F.lit(1))
    before = F.col(flag) if flag in dim.columns else F.lit(None).cast("int")
    rows = dim.join(marks, key, "left")
    names = dim.columns if flag in dim.columns else [*dim.columns, flag]
    return rows.select(
        *[F.coalesce("_used", before).alias(c) if c == flag else F.col(c) for c in names]
    )


def stamp(
    df: DataFrame, ids: DataFrame, key: str, columns: Sequence[str], now: datetime
) -> DataFrame:
    """Write a completion time on the rows whose key was processed."""
    done = ids.select(key).distinct().withColumn("_done", F.lit(True))
    time = F.lit(now.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")

    def value(name: str) -> Column:
        return F.when(F.col("_done"), time.cast(_field(df, name))).otherwise(F.col(name))

    rows = df.join(done, key, "left")
    return rows.select(*[value(c).alias(c) if c in columns else F.col(c) for c in df.columns])


def stamp_all(
    df: DataFrame, done: Mapping[str, Sequence[DataFrame]], key: str, now: datetime
) -> DataFrame:
    """Write a completion time into each column of ``done`` on the rows whose key was processed there.

    All marks are gathered per key first, so the rows are joined once.
    """
    marks = [ids.select(key, F.lit(name).alias("_what")) for name, found in done.items() for ids in found]
    if not marks:
        return df
    marked = reduce(DataFrame.unionByName, marks).groupBy(key).agg(F.collect_set("_what").alias("_what"))
    time = F.lit(now.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")

    def value(name: str) -> Column:
        hit = F.array_contains("_what", name)
        return F.when(hit, time.cast(_field(df, name))).otherwise(F.col(name)).alias(name)

    rows = df.join(marked, key, "left")
    return rows.select(*[value(c) if c in done else F.col(c) for c in df.columns])


def reset_slice(df: DataFrame, condition: Column) -> DataFrame:
    """Drop one slice, e.g. a language.  Rows with an unknown condition stay."""
    return df.filter(~F.coalesce(condition, F.lit(False)))


def reset_flag(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, F.lit(None).cast(_field(df, column)))


def number_values(values: DataFrame, natural_key: Sequence[str], out: str) -> DataFrame:
    """Dense numbers from 1 over distinct values, the same on every run.

    The values are ordered by the first three hex digits of the hash of their
    key, then by the key.  Each of the 4096 hash slices is numbered on its own and shifted by
    the size of the slices before it, so no task sees all values.
    """
    keys = list(natural_key)
    text = F.concat_ws("\x1f", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])
    sliced = values.withColumn("_slice", F.substring(F.md5(text), 1, 3))
    sizes = sliced.groupBy("_slice").agg(F.count(F.lit(1)).alias("_n"))
    # at most 4096 rows reach this unpartitioned window
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select("_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
    inside = Window.partitionBy("_slice").orderBy(*keys)
    rows = sliced.withColumn("_rn", F.row_number().over(inside))
    rows = rows.join(F.broadcast(shifts), "_slice")
    return rows.withColumn(out, F.col("_shift") + F.col("_rn")).drop("_slice", "_rn", "_shift")


def assign_ids(
    dim: DataFrame, values: DataFrame, natural_key: Sequence[str], id_column: str
) -> DataFrame:
    """Dimension grown by the values it lacks; new ids follow the largest known id."""
    keys = list(natural_key)
    # a key that holds a null is a key like others here
    known = dim.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)])
    same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    fresh = values.select(*keys).distinct().join(known, same, "left_anti")
    fresh = number_values(fresh, keys, "_n")
    top = dim.agg(F.coalesce(F.max(id_column), F.lit(0)).cast("long").alias("_top"))
    fresh = fresh.withColumn(id_column, F.col("_n") + top.scalar())
    fresh = fresh.select(F.col(id_column).cast(_field(dim, id_column)).alias(id_column), *keys)
    return dim.unionByName(fresh, allowMissingColumns=True)
