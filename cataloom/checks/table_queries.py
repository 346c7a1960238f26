"""Registered queries over written tables: touched partitions, range-clustered files, refused payloads, restartable ranges."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..plans.ranges import RangeJob, documents_in_ranges
from ..sources import payloads, tables
from ..sources.keyed import KeyedTable, cascade_delete
from . import job_queries, operator_queries
from .catalogue import Catalogue
from .registry import AUDIT, ORACLES, query, read, scratch

c = F.col


@query("u1_upsert_touched", ORACLES["u1_upsert_partial"])
def _(spark, sf):
    """The changes in three batches, each rewriting only the partitions it falls into."""
    table = KeyedTable.create(read(spark, sf, "customer"), f"{scratch(spark)}/customer", ["c_custkey"], 16)
    changes = operator_queries._customer_changes(spark, sf)
    for part in range(3):
        table.upsert(changes.filter(F.pmod(F.xxhash64("c_custkey"), F.lit(3)) == part), ["c_custkey"])
    return table.read()


@query("u4_mirror_touched", ORACLES["u4_mirror_delete"])
def _(spark, sf):
    eligible = read(spark, sf, "customer").filter(c("c_acctbal") > 0).select(c("c_custkey").alias("o_custkey"))
    orders = read(spark, sf, "orders").select("o_orderkey", "o_custkey")
    table = KeyedTable.create(orders, f"{scratch(spark)}/orders", ["o_custkey"], 16)
    table.mirror(eligible)
    return table.read()


@query("u5_sync_touched", ORACLES["u5_sync_children_purge"])
def _(spark, sf):
    target, incoming = operator_queries._links(spark, sf)
    parents = read(spark, sf, "orders").filter(c("o_orderstatus") == "F").select(c("o_orderkey").alias("l_orderkey"))
    table = KeyedTable.create(target, f"{scratch(spark)}/links", ["l_orderkey"], 16)
    table.sync_children(incoming, ["l_orderkey"], ["l_partkey"], "purge", parents)
    return table.read()


@query("u7_cascade_touched", ORACLES["u7_cascade_delete"])
def _(spark, sf):
    customer = read(spark, sf, "customer")
    orders = read(spark, sf, "orders").withColumnRenamed("o_custkey", "c_custkey")
    root = scratch(spark)
    kept = {
        "customer": KeyedTable.create(customer, f"{root}/customer", ["c_custkey"], 16),
        "orders": KeyedTable.create(orders, f"{root}/orders", ["c_custkey"], 16),
    }
    cascade_delete(kept, customer.filter(c("c_acctbal") < 0))
    keys = {"customer": "c_custkey", "orders": "o_orderkey"}
    parts = [table.read().select(F.lit(n).alias("tab"), c(keys[n]).alias("id")) for n, table in kept.items()]
    return parts[0].unionByName(parts[1])


@query("io4_range_clustered", """
SELECT l_orderkey, l_partkey, l_linenumber, l_quantity FROM lineitem
WHERE l_orderkey BETWEEN (SELECT min(o_orderkey) FROM orders WHERE o_custkey = 7) AND (SELECT max(o_orderkey) FROM orders WHERE o_custkey = 7)
ORDER BY l_orderkey, l_linenumber""")
def _(spark, sf):
    """A range of ids, in order, from a table whose files are ranges of ids."""
    root = scratch(spark)
    tables.write_table(read(spark, sf, "lineitem"), root, "lineitem", cluster_by=["l_orderkey", "l_linenumber"])
    lo, hi = read(spark, sf, "orders").filter(c("o_custkey") == 7).agg(F.min("o_orderkey"), F.max("o_orderkey")).first()
    columns = ["l_orderkey", "l_partkey", "l_linenumber", "l_quantity"]
    rows = tables.read_table(spark, root, "lineitem", columns, c("l_orderkey").between(lo, hi))
    return rows.orderBy("l_orderkey", "l_linenumber")


_LANDED = """
landed AS (SELECT event_id, CASE
  WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 7 = 0 THEN '{"id": '
  WHEN event_type = 'error' THEN '{"id": ' || event_id || ', "status_code": 34}'
  WHEN event_type = 'view' THEN '{"kind": "view"}' ELSE '{"id": ' || event_id || ', "kind": "' || event_type || '"}' END AS body FROM events)"""


def _landed(spark, sf):
    events = read(spark, sf, "events")
    n = c("event_id").cast("string")
    body = (
        F.when(c("event_id") % 11 == 0, F.lit(None)).when(c("event_id") % 7 == 0, '{"id": ')
        .when(c("event_type") == "error", F.concat(F.lit('{"id": '), n, F.lit(', "status_code": 34}')))
        .when(c("event_type") == "view", '{"kind": "view"}')
        .otherwise(F.concat(F.lit('{"id": '), n, F.lit(', "kind": "'), c("event_type"), F.lit('"}')))
    )
    return events.select("event_id", body.alias("body"))


_REASON = """CASE WHEN body IS NULL THEN 'missing' WHEN NOT json_valid(body) THEN 'unreadable'
  WHEN coalesce(CAST(json_extract_string(body, '$.status_code') AS int), 0) > 1 THEN 'error answer'
  WHEN json_extract_string(body, '$.id') IS NULL THEN 'without id' END"""


@query("io2_refused_payloads", f"""
WITH {_LANDED} SELECT event_id, body, reason FROM (SELECT *, {_REASON} AS reason FROM landed) WHERE reason IS NOT NULL""")
def _(spark, sf):
    return payloads.sort_payloads(_landed(spark, sf), "body", "id long, status_code int, kind string")[1]


@query("io2_payload_counts", f"""
WITH {_LANDED}, r AS (SELECT {_REASON} AS reason FROM landed)
SELECT what, n FROM (SELECT 'rows' AS what, count(*) AS n FROM r UNION ALL SELECT coalesce(reason, 'read'), count(*) FROM r GROUP BY reason)""")
def _(spark, sf):
    """Counts observed while the payloads are parsed, beside those of the rows that came out."""
    good, _, counts = payloads.sort_payloads(_landed(spark, sf), "body", "id long, status_code int, kind string")
    seen = spark.createDataFrame([(k, v) for k, v in counts.items() if v and k != "read"], "what string, n long")
    return seen.unionByName(good.agg(F.count(F.lit(1)).alias("n")).select(F.lit("read").alias("what"), "n"))


@query("s2_ranges", """
SELECT o_custkey, count(*) AS n, sum(o_orderkey) AS total FROM orders GROUP BY o_custkey""")
def _(spark, sf):
    """A job by key ranges that is stopped twice and goes on."""
    orders = read(spark, sf, "orders").select("o_custkey", "o_orderkey")
    job = RangeJob(spark, scratch(spark), "totals", AUDIT)

    def work(rows):
        return rows.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("total"))

    for stop in (1, 2, None):
        job.run(orders, "o_custkey", 5, work, stop)
    return job.result()


@query("g11_documents_in_ranges", ORACLES["g11_document_columns"])
def _(spark, sf):
    """Documents by ranges of movies, in a run that is stopped and goes on."""
    job = RangeJob(spark, scratch(spark), "movie_document_fr", AUDIT)
    catalogue = Catalogue(spark, sf)
    for stop in (1, None):
        documents_in_ranges(catalogue, "fr", job, 2, stop_after=stop)
    return job_queries.document_columns(job.result())
