"""Table versions, run state, lineage cuts and the streamed upsert."""

import random

import pytest
from pyspark.sql import functions as F

from cataloom.operators.changes import replace_children, upsert
from cataloom.plans import ranges
from cataloom.session import cut_lineage
from cataloom.sources import payloads
from cataloom.sources import tables as T
from cataloom.sources.keyed import KeyedTable
from cataloom.streaming import upsert as S


def test_versions(spark, tmp_path):
    root = str(tmp_path)
    T.write_table(spark.range(5), root, "t")
    one = T.read_table(spark, root, "t")
    assert T.write_table(one.filter("id > 2"), root, "t") == 2
    assert T.read_table(spark, root, "t").count() == 2 and one.count() == 5
    # a version without its success file does not count
    (tmp_path / "t" / "v=3").mkdir()
    assert T.read_table(spark, root, "t").count() == 2
    # two writers of the same number: both keep their rows, readers see one of them whole
    rows = spark.range(7)
    rows.write.parquet(f"{root}/t/v=4-a")
    rows.limit(3).write.parquet(f"{root}/t/v=4-b")
    assert T.read_table(spark, root, "t").count() == 3
    assert T.write_table(spark.range(1), root, "t") == 5


def test_pushdown(spark, tmp_path):
    T.write_table(spark.range(100).withColumn("x", F.lit("y")), str(tmp_path), "t")
    df = T.read_table(spark, str(tmp_path), "t", ["id"], F.col("id") > 5)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(id,5)" in plan and "ReadSchema: struct<id:bigint>" in plan


def test_state(spark, audit):
    state = T.set_state(T.empty_state(spark), "step", "1", audit)
    state = T.keep_previous(state, ["step"], audit)
    state = T.set_state(state, "step", "2", audit)
    assert (T.get_state(state, "step"), T.get_state(state, "stepprevious"), T.get_state(state, "none")) == ("2", "1", "")


def test_cut_lineage(spark):
    df = cut_lineage(spark.range(10).withColumn("x", F.rand()))
    assert df.collect() == df.collect()


DDL, KEYS, ORDER = "k long, t long, v string, b long", ["k"], ["t"]


class Feed:
    """A streamed table, its source files and its checkpoint."""

    def __init__(self, spark, path, partial=(), delete=None, children=None):
        self.spark, self.path, self.partial, self.delete, self.children = spark, path, partial, delete, children
        self.mark = "mark"

    def add(self, rows):
        self.spark.createDataFrame(rows, DDL).coalesce(1).write.mode("append").parquet(f"{self.path}/in")

    def run(self):
        table = S.streamed_table(self.spark, f"{self.path}/table", DDL, KEYS, ORDER, self.partial, buckets=8)
        stream = self.spark.readStream.schema(DDL).option("maxFilesPerTrigger", 1).parquet(f"{self.path}/in")
        S.stream_upsert(stream, table, f"{self.path}/{self.mark}", KEYS, ORDER, self.partial, self.delete, self.children)
        return sorted(tuple(r) for r in S.read_current(table, KEYS, ["k", "t", "v", "b"], self.partial).collect())


def test_stream_equals_batch_over_files_and_restart(spark, tmp_path, rows_of):
    rng = random.Random(1)
    data = [(rng.randint(1, 9), i, f"v{i}", i) for i in range(60)]
    rng.shuffle(data)
    feed = Feed(spark, str(tmp_path))
    whole = lambda rows: rows_of(S.latest_per_key(spark.createDataFrame(rows, DDL), KEYS, ORDER))
    feed.add(data[:20])
    feed.add(data[20:40])
    assert feed.run() == whole(data[:40])
    files = {p: p.stat().st_mtime_ns for p in (tmp_path / "table").rglob("*.parquet")}
    assert feed.run() == whole(data[:40])
    assert files == {p: p.stat().st_mtime_ns for p in (tmp_path / "table").rglob("*.parquet")}  # nothing new, nothing written
    # one event: one partition is written anew
    feed.add([(data[0][0], 1000, "last", 1)])
    feed.run()
    after = {p: p.stat().st_mtime_ns for p in (tmp_path / "table").rglob("*.parquet")}
    assert len({p.parent.name for p in files.keys() ^ after.keys()}) == 1
    feed.add([*data[40:], (None, 5, "no key", 1), (3, None, "no place", 1)])
    want = whole([*data, (data[0][0], 1000, "last", 1)])
    assert feed.run() == want
    # a new checkpoint reads everything again, in whatever order, and loses nothing
    feed.mark = "other"
    feed.add([(77, 1, "late", 1)])
    assert feed.run() == sorted([*want, (77, 1, "late", 1)])


def test_a_batch_lost_between_write_and_commit_is_repeated(spark, tmp_path):
    feed = Feed(spark, str(tmp_path), ["v", "b"])
    feed.add([(1, 1, "x", 10), (2, 1, None, None)])
    feed.run()
    feed.add([(1, 3, None, 30), (3, 1, "c", None)])
    want = feed.run()
    # the commit of the last batch is gone: Spark runs it again on the same files
    commits = sorted((tmp_path / "mark" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    commits[-1].unlink()
    for crc in (tmp_path / "mark" / "commits").glob(f".{commits[-1].name}.crc"):
        crc.unlink()
    assert feed.run() == want == [(1, 3, "x", 30), (2, 1, None, None), (3, 1, "c", None)]


def test_stream_keeps_columns_an_event_does_not_supply(spark, tmp_path):
    feed = Feed(spark, str(tmp_path), ["v", "b"])
    for part in [[(1, 1, "x", 10), (2, 1, None, None)], [(1, 3, None, 30)], [(1, 2, "y", 20), (2, 2, "z", None)]]:
        feed.add(part)
        got = feed.run()
    assert got == [(1, 3, "y", 30), (2, 2, "z", None)]


def test_deletes_in_the_stream(spark, tmp_path, rows_of):
    """A delete wins over what is earlier and loses to what is later, in whatever order they arrive."""
    events = [
        (1, 1, "a", 1), (1, 5, "delete", None),  # gone
        (2, 1, "a", 1), (2, 5, "delete", None), (2, 6, "back", None),  # back, without the value from before
        (3, 7, "delete", None), (3, 2, "late", 9),  # a late row does not bring it back
        (4, 3, "same place", 4), (4, 3, "delete", None),  # a delete counts last
        (5, 8, "kept", None), (5, 2, "delete", None), (5, 4, None, 5),  # a late delete
    ]
    child = spark.createDataFrame([(k, n) for k in range(1, 8) for n in range(3)], "k long, n long")
    for name, parts in {"whole": [events], "backwards": [events[k : k + 3] for k in range(9, -1, -3)]}.items():
        root = f"{tmp_path}/{name}"
        children = {"child": KeyedTable.create(child, f"{root}/child", ["k"], 4)}
        feed = Feed(spark, root, ["b"], F.col("v") == "delete", children)
        for part in parts:
            feed.add(part)
        assert feed.run() == [(2, 6, "back", None), (5, 8, "kept", 5)], name
        left = {r.k for r in children["child"].read().collect()}
        # children go with a key that a batch leaves deleted; later rows of the key do not bring them back
        assert {6, 7} <= left and not left & {1, 3, 4}


def test_current_rows_of_a_table_without_batches(spark, tmp_path):
    table = S.streamed_table(spark, str(tmp_path / "none"), "k long, t long", ["k"], ["t"])
    assert S.read_current(table, ["k"], ["k", "t"]).collect() == []
    assert S.streamed_table(spark, str(tmp_path / "none"), "k long, t long", ["k"], ["t"]).bucket == table.bucket


def files_of(path):
    return {p: (p.name, p.stat().st_mtime_ns) for p in path.rglob("*.parquet")}


def test_a_small_batch_leaves_other_partitions_alone(spark, tmp_path, rows_of, audit):
    rows = spark.range(1000).selectExpr("id", "id % 7 as a", "'x' as b", "cast(null as timestamp_ntz) as TIM_UPDATED")
    table = KeyedTable.create(rows, str(tmp_path / "t"), ["id"], 16)
    before = files_of(tmp_path / "t")
    batch = spark.createDataFrame([(3, 100), (5000, 1), (None, 9)], "id long, a long")
    touched = table.upsert(batch, ["id"], audit)
    after = files_of(tmp_path / "t")
    changed = {int(p.parent.name.split("=")[1]) for p in before.keys() ^ after.keys()}
    assert changed == set(touched) and 1 <= len(touched) <= 2
    assert all(before[p] == after[p] for p in before.keys() & after.keys())
    assert rows_of(table.read()) == rows_of(upsert(rows, batch, ["id"], audit))
    plan = table.read(touched)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and f"{table.bucket}#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    scan = spark.read.schema(table.schema).parquet(table.path).filter(F.col(table.bucket).isin(touched))
    assert {f.split("=")[1].split("/")[0] for f in (r[0] for r in scan.select(F.input_file_name()).distinct().collect())} == set(map(str, touched))


def test_changes_of_children_deletes_and_empty_partitions(spark, tmp_path, rows_of, audit):
    child = spark.createDataFrame([(p, c, "old") for p in range(40) for c in range(3)], "p long, c long, v string")
    incoming = spark.createDataFrame([(1, 0, "new"), (1, 7, "new"), (2, 1, "new"), (90, 1, "new")], "p long, c long, v string")
    parents = spark.createDataFrame([(1,), (2,), (3,), (90,)], "p long")
    for on_empty in ("keep", "purge"):
        table = KeyedTable.create(child, f"{tmp_path}/{on_empty}", ["p"], 8)
        named = parents if on_empty == "purge" else None
        table.replace_children(incoming, ["p", "c"], ["p"], None, on_empty, named)
        assert rows_of(table.read()) == rows_of(replace_children(child, incoming, ["p", "c"], ["p"], None, on_empty, named))
        table.sync_children(incoming.limit(0), ["p"], ["c"], on_empty, named)
        assert rows_of(table.read().filter("p = 1")) == ([] if on_empty == "purge" else [(1, 0, "new"), (1, 7, "new")])
    table.delete(spark.range(100).select(F.col("id").alias("p")).filter("p <> 5"))
    assert rows_of(table.read()) == [(5, c, "old") for c in range(3)]
    assert len(list((tmp_path / "purge").glob("bucket_of_8=*"))) == 1
    assert table.mirror(parents) and table.read().count() == 0 and table.columns == ["p", "c", "v"]
    table.upsert(incoming, ["p", "c"])
    assert KeyedTable(spark, table.path, ["p"]).read().count() == 4
    assert table.delete(parents.limit(0)) == []
    with pytest.raises(ValueError):
        table.upsert(incoming, ["c"])
    with pytest.raises(ValueError):
        table.change(parents.limit(1), lambda old: child)
    with pytest.raises(ValueError):
        KeyedTable(spark, table.path, ["other"])


def test_two_writers_of_one_version(spark, tmp_path):
    root = str(tmp_path)
    base = T.write_table(spark.range(5), root, "t")
    assert T.write_table(spark.range(6), root, "t", based_on=base) == 2
    with pytest.raises(T.LostUpdate):
        T.write_table(spark.range(7), root, "t", based_on=base)
    assert T.read_table(spark, root, "t").count() == 6
    assert [p.name for p in (tmp_path / "t").iterdir() if p.name.startswith("_")] == []


def test_a_narrow_range_of_a_clustered_table_touches_few_files(spark, tmp_path):
    rows = spark.range(20_000).select(F.pmod(F.xxhash64("id"), F.lit(1_000_000)).alias("id"), F.lit("x").alias("v"))
    T.write_table(rows, str(tmp_path), "t", cluster_by=["id"], files=16)
    table = T.read_table(spark, str(tmp_path), "t")
    every = table.select(F.input_file_name()).distinct().count()
    some = table.filter("id between 500000 and 510000").select(F.input_file_name()).distinct().count()
    assert every >= 12 and some <= 2
    assert table.count() == 20_000
    # sorted within the files, so the statistics of each file form one range
    spans = sorted(map(tuple, table.groupBy(F.input_file_name()).agg(F.min("id"), F.max("id")).select("min(id)", "max(id)").collect()))
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))


def test_resume(spark):
    df = spark.range(10)
    assert S.resume_from(df, "id", "7").count() == 3
    assert S.resume_from(df, "id", "").count() == 10


def test_ranges_go_on_where_a_run_stopped(spark, tmp_path, audit, rows_of):
    rng = random.Random(2)
    keys = [rng.getrandbits(62) for _ in range(300)] + [None, None]
    rows = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k long, v long").repartition(3)
    seen, job = [], ranges.RangeJob(spark, str(tmp_path), "copy", audit)

    def work(part):
        seen.append(part.count())
        return part

    with pytest.raises(ValueError):
        job.result()
    assert job.run(rows, "k", 6, work, stop_after=2) == 2 and job.position()[1] == 2
    files = files_of(tmp_path / "copy")

    def dies(part):
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        ranges.RangeJob(spark, str(tmp_path), "copy", audit).run(rows, "k", 6, dies)
    again = ranges.RangeJob(spark, str(tmp_path), "copy", audit)
    assert again.run(rows, "k", 6, work) == 4 and again.position() is None
    # the ranges that counted were not written again
    assert all(p.stat().st_mtime_ns == at for p, (_, at) in files.items())
    assert len(seen) == 6 and sum(seen) == 302 and max(seen) <= 60
    assert rows_of(job.result()) == rows_of(rows)
    assert again.run(rows.limit(0), "k", 6, work) == 1 and job.result().count() == 0


def test_refused_payloads_and_their_counts(spark):
    texts = [None, "", "{", "[1]", '{"id": 1}', '{"id": 2, "status_code": 1}', '{"id": 3, "status_code": 34}', '{"name": "x"}', '{"id": "word"}',
             '{"id": 4, "name": ["list"]}']
    df = spark.createDataFrame(list(enumerate(texts)), "n int, body string")
    shape = "id long, status_code int, name string"
    read, refused, counts = payloads.sort_payloads(df, "body", shape)
    assert sorted(r.n for r in read.collect()) == sorted(r.n for r in payloads.parse_payloads(df, "body", shape).collect())
    found = {r.n: (r.reason, r.body) for r in refused.collect()}
    assert found[0] == ("missing", None) and found[2] == ("unreadable", "{") and found[6] == ("error answer", texts[6]) and found[7][0] == "without id"
    assert counts["rows"] == 10 == counts["read"] + sum(counts[r] for r in payloads.REASONS)
    assert counts["read"] == read.count() and counts["missing"] == 1
    none = payloads.sort_payloads(df.limit(0), "body", shape)
    assert none[0].count() == none[1].count() == none[2]["rows"] == 0
