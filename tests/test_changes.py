"""Keyed changes: edge rows and properties."""

import pytest
from pyspark.sql import functions as F

from cataloom.operators import changes as U


def frame(spark, data, ddl):
    return spark.createDataFrame(data, ddl)


TARGET = "id long, a string, b int, DELETED int, DAT_CREAT date, TIM_UPDATED timestamp_ntz, ID_CREATOR int"


def target(spark):
    return frame(spark, [(1, "x", 1, 1, None, None, None), (2, "y", 2, 0, None, None, None)], TARGET)


def test_upsert_partial_columns_and_null(spark, rows_of):
    changes = frame(spark, [(2, None), (3, "z")], "id long, a string")
    out = U.upsert(target(spark), changes, ["id"])
    assert rows_of(out, "id", "a", "b") == [(1, "x", 1), (2, None, 2), (3, "z", None)]


def test_upsert_is_idempotent(spark, rows_of, audit):
    changes = frame(spark, [(2, None), (3, "z")], "id long, a string")
    once = U.upsert(target(spark), changes, ["id"], audit)
    assert rows_of(U.upsert(once, changes, ["id"], audit)) == rows_of(once)


def test_upsert_audit(spark, audit):
    changes = frame(spark, [(2, "k"), (3, "z")], "id long, a string")
    out = {r.id: r for r in U.upsert(target(spark), changes, ["id"], audit).collect()}
    assert (out[1].DELETED, out[1].TIM_UPDATED) == (1, None)
    assert (out[2].DELETED, out[2].ID_CREATOR, str(out[2].TIM_UPDATED)) == (0, None, "2024-01-02 03:04:05")
    assert (out[3].DELETED, out[3].ID_CREATOR, str(out[3].DAT_CREAT)) == (0, 7, "2024-01-02")


def test_upsert_supplied_date_and_keep_first(spark, audit):
    changes = frame(spark, [(2, "2020-01-01"), (3, "2020-01-01")], "id long, d string")
    changes = changes.select("id", F.col("d").cast("date").alias("DAT_CREAT"))
    out = {r.id: str(r.DAT_CREAT) for r in U.upsert(target(spark), changes, ["id"], audit).collect()}
    assert out == {1: "None", 2: "2020-01-01", 3: "2020-01-01"}
    kept = U.upsert(target(spark), changes, ["id"], audit, keep_first=["DAT_CREAT"])
    assert {r.id: str(r.DAT_CREAT) for r in kept.collect()} == {1: "None", 2: "None", 3: "2020-01-01"}


def test_upsert_optional_columns(spark, rows_of):
    changes = frame(spark, [(1, ""), (2, "new"), (3, "")], "id long, a string")
    out = U.upsert(target(spark), changes, ["id"], optional=["a"])
    assert rows_of(out, "id", "a") == [(1, "x"), (2, "new"), (3, None)]


def test_upsert_rejects_unknown_columns(spark):
    with pytest.raises(ValueError):
        U.upsert(target(spark), frame(spark, [(1, 2)], "id long, nope int"), ["id"])


def test_mirror_delete_leaves_eligible_only(spark, rows_of):
    eligible = frame(spark, [(2,), (5,)], "id long")
    assert rows_of(U.mirror_delete(target(spark), eligible, "id"), "id") == [(2,)]


@pytest.mark.parametrize("policy,expected", [
    ("keep", [(1, 1), (2, 1), (2, 2), (3, 1)]),
    ("purge", [(1, 1), (3, 1)]),
])
def test_sync_children(spark, rows_of, policy, expected):
    bridge = frame(spark, [(1, 1), (1, 2), (2, 1), (2, 2), (3, 1)], "p long, c long")
    incoming = frame(spark, [(1, 1)], "p long, c long")
    parents = frame(spark, [(1,), (2,)], "p long")
    out = U.sync_children(bridge, incoming, ["p"], ["c"], policy, parents)
    assert rows_of(out) == expected


def test_orphans_and_cascade(spark, rows_of):
    bridge = frame(spark, [(1, 1), (1, 2)], "p long, c long")
    assert rows_of(U.drop_orphans(bridge, frame(spark, [(1,)], "c long"), "c")) == [(1, 1)]
    out = U.cascade_delete({"m": target(spark).select("id"), "k": bridge.withColumnRenamed("p", "id")},
                           frame(spark, [(1,)], "id long"), "id")
    assert rows_of(out["m"]) == [(2,)] and rows_of(out["k"]) == []


def test_enrich(spark, rows_of):
    lookup = frame(spark, [("x", 9), ("x", 8), (None, 7)], "k string, v int")
    out = U.enrich(target(spark), lookup, {"a": "k"}, {"b": "v"})
    assert rows_of(out, "id", "b") == [(1, 8), (2, 2)]
    out = U.enrich(target(spark), lookup, {"a": "k"}, {"b": "v"}, F.col("id") > 1)
    assert rows_of(out, "id", "b") == [(1, 1), (2, 2)]


def test_mark_stamp_reset(spark, rows_of, audit):
    used = frame(spark, [(1,), (1,)], "id long")
    assert rows_of(U.mark_used(target(spark), used, "id", "b"), "id", "b") == [(1, 1), (2, 2)]
    done = U.stamp(target(spark), used, "id", ["TIM_UPDATED"], audit.now)
    assert [str(r.TIM_UPDATED) for r in done.orderBy("id").collect()] == ["2024-01-02 03:04:05", "None"]
    assert rows_of(U.reset_slice(target(spark), F.col("a") == "x"), "id") == [(2,)]
    assert rows_of(U.reset_flag(target(spark), "b"), "id", "b") == [(1, None), (2, None)]


def test_assign_ids_dense_stable_and_reused(spark, rows_of):
    dim = frame(spark, [(4, "b"), (9, "a")], "ID long, N string")
    values = frame(spark, [("a",), ("b",), ("c",), ("d",), ("c",), ("é",)], "N string")
    out = U.assign_ids(dim, values, ["N"], "ID")
    got = {r.N: r.ID for r in out.collect()}
    assert got["a"] == 9 and got["b"] == 4
    assert sorted(got[n] for n in ("c", "d", "é")) == [10, 11, 12]
    again = U.assign_ids(out, values, ["N"], "ID")
    assert rows_of(again) == rows_of(out)
    shuffled = U.assign_ids(dim, values.repartition(7), ["N"], "ID")
    assert rows_of(shuffled) == rows_of(out)


def test_assign_ids_to_empty_dimension(spark):
    dim = spark.createDataFrame([], "ID long, N string")
    out = U.assign_ids(dim, frame(spark, [("a",), ("b",)], "N string"), ["N"], "ID")
    assert sorted(r.ID for r in out.collect()) == [1, 2]


def test_null_keys_are_refused_and_known_null_values_keep_their_id(spark, audit, rows_of):
    target = frame(spark, [(1, "a")], "K long, V string")
    out = U.upsert(target, frame(spark, [(None, "x"), (1, "b"), (2, "c")], "K long, V string"), ["K"], audit)
    assert rows_of(out) == [(1, "b"), (2, "c")]
    dim = frame(spark, [(4, "a", None), (7, None, "x")], "ID long, N string, M string")
    values = frame(spark, [("a", None), (None, "x"), (None, None)], "N string, M string")
    grown = U.assign_ids(dim, values, ["N", "M"], "ID")
    assert rows_of(grown) == [(4, "a", None), (7, None, "x"), (8, None, None)]
    assert grown.count() == U.assign_ids(grown, values, ["N", "M"], "ID").count()


def test_all_times_are_stamped_in_one_join(spark, audit, rows_of):
    df = frame(spark, [(1, None, None), (2, None, None), (3, None, None)], "K long, A timestamp_ntz, B timestamp_ntz")
    done = {"A": [frame(spark, [(1,), (1,)], "K long"), frame(spark, [(2,)], "K long")], "B": [frame(spark, [(2,)], "K long")]}
    out = U.stamp_all(df, done, "K", audit.now)
    assert rows_of(out) == [(1, audit.now, None), (2, audit.now, audit.now), (3, None, None)]


def test_upsert_of_few_changes_leaves_the_target_in_place(spark, audit):
    target = spark.range(1000).selectExpr("id AS K", "'a' AS V")
    plan = U.upsert(target, frame(spark, [(1, "b")], "K long, V string"), ["K"], audit)._jdf.queryExecution().toString()
    assert "FullOuter" not in plan


def test_inserted_children_are_not_looked_up_among_the_parents(spark, rows_of):
    """They survive anyway, so they do not move by parent."""
    ddl = "c string, p long, v long"
    old = spark.createDataFrame([("a", 1, 1), ("b", 1, 2), ("x", 9, 3)], ddl)
    new = spark.createDataFrame([("b", 1, 5), ("n", 1, 6), ("m", None, 7), (None, 1, 8)], ddl)
    got = U.replace_children(old, new, ["c"], ["p"], None, "purge", spark.createDataFrame([(1,), (None,)], "p long"))
    assert rows_of(got) == [("b", 1, 5), ("m", None, 7), ("n", 1, 6), ("x", 9, 3)]
    assert got._jdf.queryExecution().optimizedPlan().nodeName() == "Union"
