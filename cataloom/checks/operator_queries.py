"""One query per operator, on the driver tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import formats as FM
from ..functions import text as TX
from ..functions import values as V
from ..operators import changes as U
from ..operators import relate as R
from ..operators import rollups as A
from ..operators import tagging as T
from ..plans.documents import lemma_bridge
from ..plans.publish import publish_columns
from ..sources import payloads, tables
from ..streaming import upsert as S
from .registry import AUDIT, NOW_SQL, query, read, scratch

c = F.col


def pick(items: list[str], index: Column) -> Column:
    """Text chosen by a number: derives test texts for every row."""
    texts = F.expr(f"array({', '.join(C.quoted(x) for x in items)})")
    return F.element_at(texts, (F.pmod(index, F.lit(len(items))) + 1).cast("int"))


def sql_list(items: list[str]) -> str:
    return "[" + ", ".join("'" + x.replace("'", "''") + "'" for x in items) + "]"


def pick_sql(items: list[str], index: str) -> str:
    return f"{sql_list(items)}[(({index}) % {len(items)}) + 1]"


# --- sources and sinks ------------------------------------------------------


@query("io1_read_table", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE o_orderstatus = 'F' AND o_totalprice > 100000""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    where = (c("o_orderstatus") == "F") & (c("o_totalprice") > 100000)
    return tables.read_table(spark, sf, "orders", ["o_orderkey", "o_custkey", "o_totalprice"], where)


@query("io2_parse_payloads", """
SELECT event_id, k, id FROM (
  SELECT event_id, CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS INTEGER) AS k, CAST(NULL AS BIGINT) AS id FROM events)
WHERE k IS NOT NULL
UNION ALL SELECT event_id, NULL, event_id FROM events WHERE event_id % 3 = 0 AND event_id % 5 > 0""")
def _(spark, sf):
    events = read(spark, sf, "events")
    rows = payloads.parse_payloads(events, "props", "k int, status_code int")
    # every third text has an id, one in five is an error answer, the others are cut off, without id or no JSON
    number = c("event_id").cast("string")
    body = F.concat(F.lit('{"id": '), number, F.lit(', "status_code": '), F.when(c("event_id") % 5 == 0, "34").otherwise("1"), F.lit("}"))
    body = (
        F.when(c("event_id") % 3 == 0, body).when(c("event_id") % 6 == 1, F.concat(F.lit("garbage{"), number))
        .when(c("event_id") % 6 == 2, F.lit('{"status_code": 1}')).when(c("event_id") % 6 == 4, F.lit("")).otherwise(F.lit(None))
    )
    named = payloads.parse_payloads(events.select("event_id", body.alias("body")), "body", "id bigint, status_code int")
    return rows.select("event_id", "payload.k", F.lit(None).cast("bigint").alias("id")).unionByName(
        named.select("event_id", F.lit(None).cast("int").alias("k"), "payload.id"))


@query("io3_explode_pages", """
WITH lines AS (
  SELECT conv_id, turn, t.line, t.pos FROM conversations,
    unnest(string_split(text, chr(10))) WITH ORDINALITY AS t(line, pos))
SELECT conv_id, turn, line AS item,
  CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn, pos) AS INTEGER) AS DISPLAY_ORDER
FROM lines""")
def _(spark, sf):
    pages = read(spark, sf, "conversations").select("conv_id", "turn", F.split("text", "\n").alias("items"))
    return payloads.explode_pages(pages, "conv_id", "turn", "items", width=4)


@query("io4_write_table", """
SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders""")
def _(spark, sf):
    root = scratch(spark)
    orders = read(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    tables.write_table(orders, root, "orders", ["o_orderpriority"])
    tables.write_table(tables.read_table(spark, root, "orders"), root, "orders")
    return tables.read_table(spark, root, "orders")


_FLAG_COUNTS = """
SELECT 'rows_' || l_returnflag AS VAR_NAME, CAST(count(*) AS VARCHAR) AS VAR_VALUE
FROM lineitem GROUP BY ALL"""


@query("io5_run_state", f"""
WITH s AS ({_FLAG_COUNTS}),
d AS (SELECT 'rows_' || l_returnflag AS VAR_NAME, CAST(count(*) FILTER (l_discount > 0.05) AS VARCHAR) AS VAR_VALUE
  FROM lineitem GROUP BY ALL)
SELECT VAR_NAME, VAR_VALUE, 0 AS DELETED FROM d
UNION ALL SELECT VAR_NAME || 'previous', VAR_VALUE, 0 FROM s""")
def _(spark, sf):
    names = F.concat(F.lit("rows_"), "l_returnflag").alias("VAR_NAME")
    lines = read(spark, sf, "lineitem")

    def values(count: Column) -> DataFrame:
        return lines.groupBy(names).agg(count.cast("string").alias("VAR_VALUE"))

    state = tables.write_state(tables.empty_state(spark), values(F.count(F.lit(1))), AUDIT)
    state = tables.keep_previous(state, ["rows_A", "rows_N", "rows_R"], AUDIT)
    state = tables.write_state(state, values(F.count_if(c("l_discount") > 0.05)), AUDIT)
    return state.select("VAR_NAME", "VAR_VALUE", "DELETED")


# --- keyed changes ----------------------------------------------------------

_CUSTOMER_CHANGES = """
changes AS (
  SELECT o_custkey AS c_custkey, max(o_totalprice) AS c_acctbal,
    CASE WHEN max(o_totalprice) > 400000 THEN NULL ELSE 'ACTIVE' END AS c_mktsegment
  FROM orders WHERE o_orderstatus = 'F' GROUP BY o_custkey
  UNION ALL
  SELECT 1000000000 + s_suppkey, s_acctbal, 'SUPPLY' FROM supplier)"""


def _customer_changes(spark, sf):
    top = F.max("o_totalprice")
    orders = read(spark, sf, "orders").filter(c("o_orderstatus") == "F")
    orders = orders.groupBy(c("o_custkey").alias("c_custkey")).agg(
        top.alias("c_acctbal"), F.when(top > 400000, F.lit(None)).otherwise("ACTIVE").alias("c_mktsegment")
    )
    new = read(spark, sf, "supplier").select(
        (c("s_suppkey") + 1000000000).alias("c_custkey"), c("s_acctbal").alias("c_acctbal"),
        F.lit("SUPPLY").alias("c_mktsegment"),
    )
    return orders.unionByName(new)


@query("u1_upsert_partial", f"""
WITH {_CUSTOMER_CHANGES}
SELECT coalesce(t.c_custkey, n.c_custkey) AS c_custkey, t.c_name, t.c_nationkey,
  CASE WHEN n.c_custkey IS NOT NULL THEN n.c_acctbal ELSE t.c_acctbal END AS c_acctbal,
  CASE WHEN n.c_custkey IS NOT NULL THEN n.c_mktsegment ELSE t.c_mktsegment END AS c_mktsegment
FROM customer t FULL JOIN changes n ON t.c_custkey = n.c_custkey""")
def _(spark, sf):
    return U.upsert(read(spark, sf, "customer"), _customer_changes(spark, sf), ["c_custkey"])


@query("u2_audit_columns", f"""
SELECT c_custkey, c_name, {NOW_SQL} AS TIM_UPDATED,
  CASE WHEN c_acctbal < 0 THEN 0 END AS DELETED,
  CASE WHEN c_acctbal < 0 THEN DATE '2024-01-02' END AS DAT_CREAT,
  CASE WHEN c_acctbal < 0 THEN 7 END AS ID_CREATOR,
  CASE WHEN c_acctbal < 0 THEN 7 END AS ID_OWNER,
  CASE WHEN c_acctbal < 0 THEN 7 END AS ID_USER_UPDATED
FROM customer""")
def _(spark, sf):
    rows = read(spark, sf, "customer")
    return U.with_audit(rows, c("c_acctbal") < 0, AUDIT).drop("c_nationkey", "c_acctbal", "c_mktsegment")


@query("u3_upsert_full_rows", """
WITH old AS (SELECT o_orderkey, 'old' AS o_orderstatus, 0.0 AS o_totalprice FROM orders WHERE o_orderstatus <> 'F'),
src AS (SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus <> 'P')
SELECT coalesce(o.o_orderkey, s.o_orderkey) AS o_orderkey,
  CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_orderstatus ELSE o.o_orderstatus END AS o_orderstatus,
  CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_totalprice ELSE o.o_totalprice END AS o_totalprice
FROM old o FULL JOIN src s ON o.o_orderkey = s.o_orderkey""")
def _(spark, sf):
    orders = read(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    old = orders.filter(c("o_orderstatus") != "F").select(
        "o_orderkey", F.lit("old").alias("o_orderstatus"), F.lit(0.0).alias("o_totalprice")
    )
    return U.upsert(old, orders.filter(c("o_orderstatus") != "P"), ["o_orderkey"])


@query("u4_mirror_delete", """
SELECT o_orderkey, o_custkey FROM orders
WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)""")
def _(spark, sf):
    eligible = read(spark, sf, "customer").filter(c("c_acctbal") > 0).select(c("c_custkey").alias("o_custkey"))
    target = read(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return U.mirror_delete(target, eligible, "o_custkey")


_LINKS = "links AS (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem)"
_NAMED = "named AS (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem WHERE l_returnflag <> 'R')"


def _links(spark, sf):
    lines = read(spark, sf, "lineitem")
    target = lines.select("l_orderkey", "l_partkey").distinct()
    incoming = lines.filter(c("l_returnflag") != "R").select("l_orderkey", "l_partkey").distinct()
    return target, incoming


@query("u5_sync_children_keep", f"""
WITH {_LINKS}, {_NAMED}
SELECT l_orderkey, l_partkey FROM links t
WHERE l_orderkey NOT IN (SELECT l_orderkey FROM named)
  OR EXISTS (SELECT 1 FROM named n WHERE n.l_orderkey = t.l_orderkey AND n.l_partkey = t.l_partkey)""")
def _(spark, sf):
    target, incoming = _links(spark, sf)
    return U.sync_children(target, incoming, ["l_orderkey"], ["l_partkey"])


@query("u5_sync_children_purge", f"""
WITH {_LINKS}, {_NAMED}
SELECT l_orderkey, l_partkey FROM links t
WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')
  OR EXISTS (SELECT 1 FROM named n WHERE n.l_orderkey = t.l_orderkey AND n.l_partkey = t.l_partkey)""")
def _(spark, sf):
    target, incoming = _links(spark, sf)
    parents = read(spark, sf, "orders").filter(c("o_orderstatus") == "F").select(c("o_orderkey").alias("l_orderkey"))
    return U.sync_children(target, incoming, ["l_orderkey"], ["l_partkey"], "purge", parents)


@query("u6_drop_orphans", """
SELECT l_orderkey, l_partkey, l_linenumber, l_extendedprice FROM lineitem
WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size > 5)""")
def _(spark, sf):
    bridge = read(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice")
    dim = read(spark, sf, "part").filter(c("p_size") > 5).select(c("p_partkey").alias("l_partkey"))
    return U.drop_orphans(bridge, dim, "l_partkey")


@query("u7_cascade_delete", """
WITH gone AS (SELECT c_custkey FROM customer WHERE c_acctbal < 0)
SELECT 'customer' AS tab, c_custkey AS id FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM gone)
UNION ALL SELECT 'orders', o_orderkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM gone)""")
def _(spark, sf):
    customer = read(spark, sf, "customer")
    orders = read(spark, sf, "orders").withColumnRenamed("o_custkey", "c_custkey")
    gone = customer.filter(c("c_acctbal") < 0)
    left = U.cascade_delete({"customer": customer, "orders": orders}, gone, "c_custkey")
    keys = {"customer": "c_custkey", "orders": "o_orderkey"}
    parts = [df.select(F.lit(n).alias("tab"), c(keys[n]).alias("id")) for n, df in left.items()]
    return parts[0].unionByName(parts[1])


@query("u8_enrich", """
SELECT d.doc_id, d.lang,
  CASE WHEN l.doc_id IS NOT NULL AND d.lang <> 'de' THEN l.quality ELSE -1 END AS quality,
  CASE WHEN l.doc_id IS NOT NULL AND d.lang <> 'de' THEN l.toxic ELSE -1 END AS toxic
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def _(spark, sf):
    target = read(spark, sf, "documents").select(
        "doc_id", "lang", F.lit(-1).alias("quality"), F.lit(-1).alias("toxic")
    )
    return U.enrich(
        target, read(spark, sf, "labels"), {"doc_id": "doc_id"},
        {"quality": "quality", "toxic": "toxic"}, c("lang") != "de",
    )


@query("u9_mark_used", """
SELECT p_partkey, p_name,
  CASE WHEN p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity >= 49) THEN 1 END AS used
FROM part""")
def _(spark, sf):
    used = read(spark, sf, "lineitem").filter(c("l_quantity") >= 49).select(c("l_partkey").alias("p_partkey"))
    return U.mark_used(read(spark, sf, "part").select("p_partkey", "p_name"), used, "p_partkey", "used")


@query("u10_stamp", f"""
SELECT o_orderkey, CASE WHEN o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')
  THEN {NOW_SQL} END AS TIM_CREDITS_COMPLETED
FROM orders""")
def _(spark, sf):
    rows = read(spark, sf, "orders").select(
        "o_orderkey", F.lit(None).cast("timestamp_ntz").alias("TIM_CREDITS_COMPLETED")
    )
    ids = read(spark, sf, "lineitem").filter(c("l_returnflag") == "R").select(c("l_orderkey").alias("o_orderkey"))
    return U.stamp(rows, ids, "o_orderkey", ["TIM_CREDITS_COMPLETED"], AUDIT.now)


@query("u11_reset", """
SELECT doc_id, lang, CAST(NULL AS VARCHAR) AS source FROM documents WHERE lang <> 'fr'""")
def _(spark, sf):
    rows = read(spark, sf, "documents").select("doc_id", "lang", "source")
    return U.reset_flag(U.reset_slice(rows, c("lang") == "fr"), "source")


@query("u12_assign_ids", """
WITH fresh AS (SELECT DISTINCT c_name AS NAME FROM customer WHERE c_name NOT IN (SELECT s_name FROM supplier)),
top AS (SELECT max(s_suppkey) AS m FROM supplier)
SELECT s_suppkey AS ID, s_name AS NAME FROM supplier
UNION ALL
SELECT (SELECT m FROM top) + row_number() OVER (ORDER BY left(md5(NAME), 3), NAME), NAME FROM fresh""")
def _(spark, sf):
    dim = read(spark, sf, "supplier").select(c("s_suppkey").alias("ID"), c("s_name").alias("NAME"))
    names = read(spark, sf, "customer").select(c("c_name").alias("NAME")).unionByName(dim.select("NAME"))
    return U.assign_ids(dim, names, ["NAME"], "ID")


# --- projections and predicates ---------------------------------------------


@query("p1_eligibility", """
SELECT 'title' AS kind, o_orderkey AS id FROM orders WHERE o_orderpriority <> '1-URGENT' AND o_orderstatus <> 'P'
UNION ALL SELECT 'person', c_custkey FROM customer
  WHERE c_mktsegment <> 'BUILDING' AND c_acctbal >= 0 AND c_nationkey > 3
UNION ALL SELECT 'member', o_orderkey FROM orders WHERE o_orderpriority <> '1-URGENT' AND o_totalprice > 1000
UNION ALL SELECT 'company', p_partkey FROM part WHERE p_size > 25 OR p_retailprice > 1500""")
def _(spark, sf):
    orders = read(spark, sf, "orders").select(
        c("o_orderkey").alias("id"), C.flag(c("o_orderpriority") == "1-URGENT").alias("ADULT"),
        F.when(c("o_orderstatus") == "P", "").otherwise("tt").alias("ID_IMDB"),
        F.when(c("o_totalprice") > 1000, "Q").alias("ID_WIKIDATA"),
    )
    persons = read(spark, sf, "customer").select(
        c("c_custkey").alias("id"), C.flag(c("c_mktsegment") == "BUILDING").alias("ADULT"),
        F.when(c("c_acctbal") >= 0, "nm").alias("ID_IMDB"),
        F.when(c("c_nationkey") > 3, "Q").otherwise("").alias("ID_WIKIDATA"),
    )
    companies = read(spark, sf, "part").select(
        c("p_partkey").alias("id"), F.when(c("p_size") > 25, c("p_size")).alias("MOVIE_COUNT"),
        F.when(c("p_retailprice") > 1500, 1).otherwise(0).alias("SERIE_COUNT"),
    )
    parts = [
        orders.filter(C.eligible_title()).select(F.lit("title").alias("kind"), "id"),
        persons.filter(C.eligible_person()).select(F.lit("person").alias("kind"), "id"),
        orders.filter(C.eligible_topic_member()).select(F.lit("member").alias("kind"), "id"),
        companies.filter(C.eligible_company()).select(F.lit("company").alias("kind"), "id"),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@query("p2_publish_columns", """
SELECT p_partkey, p_size, p_name AS PART_NAME, p_brand AS BRAND_NAME FROM part""")
def _(spark, sf):
    return publish_columns(
        read(spark, sf, "part"), ["p_partkey", "p_size"], {"p_name": "PART_NAME", "p_brand": "BRAND_NAME"}
    )


@query("p3_adjusted_rating", """
SELECT p_partkey,
  CASE WHEN p_type = 'PROMO' THEN p_size / 10.0 - 1.5 WHEN p_type <> 'LARGE' THEN p_size / 10.0 END AS movie_rating,
  CASE WHEN p_type = 'PROMO' THEN round(coalesce(CASE WHEN p_size > 3 THEN p_size / 10.0 END, 0.0) - 1.5, 1)
    ELSE coalesce(CASE WHEN p_size > 3 THEN p_size / 10.0 END, 0.0) END AS document_rating
FROM part""")
def _(spark, sf):
    rating = c("p_size") / 10.0
    promo = c("p_type") == "PROMO"
    return read(spark, sf, "part").select(
        "p_partkey", C.adjusted_rating(rating, promo, c("p_type") != "LARGE").alias("movie_rating"),
        C.document_rating(F.when(c("p_size") > 3, rating), promo).alias("document_rating"),
    )


@query("p4_type_flags", """
SELECT p_partkey, CASE WHEN p_type = 'PROMO' THEN 1 ELSE 0 END AS IS_DOCUMENTARY,
  CASE WHEN p_type = 'PROMO' THEN 0 ELSE 1 END AS IS_MOVIE,
  CASE WHEN p_size * 2 - 4 BETWEEN 1 AND 58 THEN 1 ELSE 0 END AS IS_SHORT_FILM
FROM part""")
def _(spark, sf):
    genres = F.array(F.when(c("p_type") == "PROMO", "Documentary").otherwise(c("p_type")), F.lit("Drama"))
    documentary = F.array_contains(genres, "Documentary")
    return read(spark, sf, "part").select(
        "p_partkey", C.flag(documentary).alias("IS_DOCUMENTARY"), C.flag(~documentary).alias("IS_MOVIE"),
        C.short_film_flag(c("p_size") * 2 - 4).alias("IS_SHORT_FILM"),
    )


@query("p5_clip", """
SELECT doc_id, left(text, 250) AS title, left(text, 500) AS url, left(text, 200) AS place FROM documents""")
def _(spark, sf):
    return read(spark, sf, "documents").select(
        "doc_id", C.clip("text", V.TITLE_CHARS).alias("title"), C.clip("text", V.URL_CHARS).alias("url"),
        C.clip("text", V.HEADQUARTERS_CHARS).alias("place"),
    )


@query("p6_split_date", """
WITH d AS (SELECT o_orderkey, CASE o_orderstatus
    WHEN 'P' THEN strftime(o_orderdate, '%Y/%m/%d')
    WHEN 'F' THEN strftime(o_orderdate, '%Y-13-%d') ELSE strftime(o_orderdate, '%Y-%m-%d') END AS s FROM orders)
SELECT o_orderkey, TRY_CAST(CASE WHEN s LIKE '____-__-__' THEN s END AS DATE) AS date,
  CASE WHEN s LIKE '____-__-__' THEN CAST(substr(s, 1, 4) AS INTEGER) ELSE 0 END AS year,
  CASE WHEN s LIKE '____-__-__' THEN CAST(substr(s, 6, 2) AS INTEGER) ELSE 0 END AS month,
  CASE WHEN s LIKE '____-__-__' THEN CAST(substr(s, 9, 2) AS INTEGER) ELSE 0 END AS day
FROM d""")
def _(spark, sf):
    day = c("o_orderdate")
    text = (
        F.when(c("o_orderstatus") == "P", F.date_format(day, "yyyy/MM/dd"))
        .when(c("o_orderstatus") == "F", F.date_format(day, "yyyy-'13'-dd"))
        .otherwise(F.date_format(day, "yyyy-MM-dd"))
    )
    rows = read(spark, sf, "orders").select("o_orderkey", text.alias("s"))
    return rows.select("o_orderkey", *[v.alias(n) for n, v in C.split_date("s").items()])


_RAW_EVENTS = """CASE event_type WHEN 'click' THEN '[a' || event_id || ',  b,, c ]' WHEN 'view' THEN '[]'
  WHEN 'error' THEN NULL WHEN 'signup' THEN CAST(user_id AS VARCHAR) || '.75' ELSE CAST(event_id AS VARCHAR) END"""


@query("p7_normalise", f"""
WITH e AS (SELECT event_id, {_RAW_EVENTS} AS raw FROM events)
SELECT event_id,
  CASE WHEN raw IS NULL OR raw = '' THEN ''
    WHEN raw LIKE '[%]' THEN array_to_string(list_filter(
      [trim(x) FOR x IN string_split(substr(raw, 2, length(raw) - 2), ',')], lambda x: x <> ''), ', ')
    ELSE raw END AS as_text,
  coalesce(CASE WHEN regexp_full_match(raw, '[0-9]+') THEN TRY_CAST(raw AS BIGINT)
    WHEN regexp_full_match(raw, '[0-9]+\\.[0-9]+') THEN CAST(trunc(CAST(raw AS DOUBLE)) AS BIGINT) END, 0) AS as_int
FROM e""")
def _(spark, sf):
    raw = (
        F.when(c("event_type") == "click", F.concat(F.lit("[a"), c("event_id").cast("string"), F.lit(",  b,, c ]")))
        .when(c("event_type") == "view", "[]")
        .when(c("event_type") == "error", F.lit(None))
        .when(c("event_type") == "signup", F.concat(c("user_id").cast("string"), F.lit(".75")))
        .otherwise(c("event_id").cast("string"))
    )
    rows = read(spark, sf, "events").select("event_id", raw.alias("raw"))
    return rows.select("event_id", C.norm_text("raw").alias("as_text"), C.norm_int("raw").alias("as_int"))


@query("p8_optional_columns", """
WITH n AS (SELECT s_suppkey, s_acctbal, CASE WHEN s_acctbal < 3000 THEN '' WHEN s_acctbal < 5000 THEN NULL
    ELSE 'renamed ' || s_suppkey END AS s_name FROM supplier WHERE s_nationkey > 4)
SELECT t.s_suppkey, CASE WHEN n.s_name <> '' THEN n.s_name ELSE t.s_name END AS s_name, t.s_nationkey,
  CASE WHEN n.s_suppkey IS NOT NULL THEN n.s_acctbal + 1 ELSE t.s_acctbal END AS s_acctbal
FROM supplier t LEFT JOIN n ON t.s_suppkey = n.s_suppkey""")
def _(spark, sf):
    supplier = read(spark, sf, "supplier")
    name = F.when(c("s_acctbal") < 3000, "").when(c("s_acctbal") < 5000, F.lit(None)).otherwise(
        F.concat(F.lit("renamed "), c("s_suppkey").cast("string"))
    )
    changes = supplier.filter(c("s_nationkey") > 4).select(
        "s_suppkey", name.alias("s_name"), (c("s_acctbal") + 1).alias("s_acctbal")
    )
    return U.upsert(supplier, changes, ["s_suppkey"], optional=["s_name"])


# --- joins ------------------------------------------------------------------


def _order_parts(spark, sf):
    orders = read(spark, sf, "orders").filter(c("o_orderstatus") == "F").select(c("o_orderkey").alias("ID_MOVIE"))
    lines = read(spark, sf, "lineitem").select(c("l_orderkey").alias("ID_MOVIE"), c("l_partkey").alias("ID_KEYWORD"))
    part = read(spark, sf, "part").select(c("p_partkey").alias("ID_KEYWORD"), c("p_name").alias("NAME"))
    return orders, lines, part


@query("j1_members", """
SELECT l_orderkey AS ID_MOVIE, l_partkey AS ID_KEYWORD, p_name AS NAME
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
WHERE o_orderstatus = 'F'""")
def _(spark, sf):
    return R.members(*_order_parts(spark, sf), "ID_MOVIE", "ID_KEYWORD")


@query("j2_publish_credits", """
SELECT l_orderkey AS ID_MOVIE, l_partkey AS ID_PERSON, l_linenumber, l_extendedprice FROM lineitem
WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size > 10)
  AND l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')""")
def _(spark, sf):
    credits = read(spark, sf, "lineitem").select(
        c("l_orderkey").alias("ID_MOVIE"), c("l_partkey").alias("ID_PERSON"), "l_linenumber", "l_extendedprice"
    )
    persons = read(spark, sf, "part").filter(c("p_size") > 10).select(c("p_partkey").alias("ID_PERSON"))
    titles = read(spark, sf, "orders").filter(c("o_orderstatus") == "F").select(c("o_orderkey").alias("ID_MOVIE"))
    return R.publish_credits(credits, persons, titles, "ID_MOVIE")


@query("j3_missing_from", """
SELECT c_custkey, c_name FROM customer t WHERE NOT EXISTS (
  SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')""")
def _(spark, sf):
    urgent = read(spark, sf, "orders").filter(c("o_orderpriority") == "1-URGENT")
    urgent = urgent.select(c("o_custkey").alias("c_custkey"))
    return R.missing_from(read(spark, sf, "customer").select("c_custkey", "c_name"), urgent, ["c_custkey"])


_EDGES = """
edges AS (SELECT 'Q' || l_orderkey AS ID_WIKIDATA,
    CASE l_returnflag WHEN 'A' THEN 'P31' WHEN 'N' THEN 'P136' ELSE 'P921' END AS ID_PROPERTY,
    'I' || l_partkey AS ID_ITEM, min(l_linenumber) AS DISPLAY_ORDER FROM lineitem GROUP BY ALL),
items AS (SELECT 'I' || p_partkey AS ID_WIKIDATA, CASE WHEN p_type = 'PROMO' THEN 'fr' ELSE 'en' END AS LANG,
    CASE WHEN p_size = 7 THEN '' WHEN p_size = 8 THEN 'I' || p_partkey ELSE p_name END AS LABEL
  FROM part WHERE p_size > 5)"""


def edges_and_items(spark, sf):
    kind = F.when(c("l_returnflag") == "A", "P31").when(c("l_returnflag") == "N", "P136").otherwise("P921")
    edges = read(spark, sf, "lineitem").groupBy(
        F.concat(F.lit("Q"), c("l_orderkey").cast("string")).alias("ID_WIKIDATA"), kind.alias("ID_PROPERTY"),
        F.concat(F.lit("I"), c("l_partkey").cast("string")).alias("ID_ITEM"),
    ).agg(F.min("l_linenumber").alias("DISPLAY_ORDER"))
    item = F.concat(F.lit("I"), c("p_partkey").cast("string"))
    items = read(spark, sf, "part").filter(c("p_size") > 5).select(
        item.alias("ID_WIKIDATA"), F.when(c("p_type") == "PROMO", "fr").otherwise("en").alias("LANG"),
        F.when(c("p_size") == 7, "").when(c("p_size") == 8, item).otherwise(c("p_name")).alias("LABEL"),
    )
    return edges, items


@query("j4_edge_labels", f"""
WITH {_EDGES}
SELECT e.ID_WIKIDATA, e.ID_PROPERTY, e.ID_ITEM, e.DISPLAY_ORDER, i.LANG, i.LABEL
FROM edges e LEFT JOIN items i ON e.ID_ITEM = i.ID_WIKIDATA""")
def _(spark, sf):
    return R.with_labels(*edges_and_items(spark, sf))


@query("j5_localised", """
SELECT c_custkey, c_name, coalesce(nullif(CASE WHEN source = 'src3' THEN '' ELSE source || '-' || doc_id END, ''),
  nullif(c_name, '')) AS shown
FROM customer LEFT JOIN (SELECT * FROM documents WHERE lang = 'fr') ON doc_id = c_custkey""")
def _(spark, sf):
    name = F.when(c("source") == "src3", "").otherwise(F.concat_ws("-", "source", c("doc_id").cast("string")))
    variants = read(spark, sf, "documents").select(
        c("doc_id").alias("c_custkey"), c("lang").alias("LANG"), name.alias("NAME")
    )
    base = read(spark, sf, "customer").select("c_custkey", "c_name")
    return R.localised(base, variants, "c_custkey", "c_name", "fr", "shown", "NAME")


@query("j6_lookup_ci", """
WITH v AS (SELECT p_partkey, CASE WHEN p_size < 10 THEN upper(p_name) WHEN p_size < 30 THEN p_name
    ELSE 'no ' || p_name END AS val FROM part),
x AS (SELECT p_name AS t, max(p_partkey) AS id, min(p_partkey) AS f FROM part WHERE p_type = 'LARGE' GROUP BY 1),
l AS (SELECT lower(t) AS t, arg_min(id, f) AS id FROM x GROUP BY 1)
SELECT p_partkey, val, coalesce(x.id, l.id) AS ID FROM v LEFT JOIN x ON val = x.t LEFT JOIN l ON lower(val) = l.t""")
def _(spark, sf):
    part = read(spark, sf, "part")
    val = F.when(c("p_size") < 10, F.upper("p_name")).when(c("p_size") < 30, c("p_name")).otherwise(
        F.concat(F.lit("no "), "p_name")
    )
    dim = part.filter(c("p_type") == "LARGE").select(c("p_partkey").alias("ID"), "p_name")
    return R.lookup_ci(part.select("p_partkey", val.alias("val")), dim, "val", "p_name", "ID")


@query("j7_flag_exists", """
SELECT p_partkey, p_name, CASE WHEN p_name IN (SELECT p_name FROM part WHERE p_type = 'PROMO' AND p_size > 40)
  THEN 1 ELSE 0 END AS IS_PERSON FROM part""")
def _(spark, sf):
    part = read(spark, sf, "part")
    names = part.filter((c("p_type") == "PROMO") & (c("p_size") > 40))
    return R.flag_exists(part.select("p_partkey", "p_name"), names, "p_name", "p_name", "IS_PERSON")


@query("j8_credit_rows", """
SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_suppkey AS ID_PERSON, s_name AS NAME,
  'Q' || s_nationkey AS ID_WIKIDATA, n_name AS ALIASES
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
WHERE s_acctbal >= 0""")
def _(spark, sf):
    credits = read(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", c("l_suppkey").alias("ID_PERSON")
    )
    letter = F.when(c("s_acctbal") >= 0, "Q").otherwise("")
    persons = read(spark, sf, "supplier").select(
        c("s_suppkey").alias("ID_PERSON"), c("s_name").alias("NAME"),
        F.concat(letter, c("s_nationkey").cast("string")).alias("ID_WIKIDATA"),
    )
    aliases = read(spark, sf, "nation").select(
        F.concat(F.lit("Q"), c("n_nationkey").cast("string")).alias("ID_WIKIDATA"), c("n_name").alias("ALIASES")
    )
    return R.credit_rows(credits, persons, aliases)


# --- aggregations -----------------------------------------------------------


@query("a1_member_counts", """
SELECT p_name AS NAME, count(DISTINCT l_orderkey) AS MOVIE_COUNT, min(p_partkey) AS ID_KEYWORD
FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN part ON l_partkey = p_partkey
WHERE o_orderstatus = 'F' GROUP BY p_name""")
def member_counts_query(spark, sf):
    return A.member_counts(*_order_parts(spark, sf), "ID_MOVIE", "ID_KEYWORD", "MOVIE_COUNT")


@query("a2_max_id", "SELECT coalesce(max(o_orderkey), 0) AS max_id FROM orders")
def _(spark, sf):
    return A.max_id(read(spark, sf, "orders"), "o_orderkey")


@query("a3_keyword_kpis", """
WITH n AS (SELECT l_partkey, count(*) FILTER (l_returnflag = 'R' AND l_quantity >= 40) AS m,
    count(*) FILTER (l_returnflag = 'A' AND l_quantity >= 45) AS s FROM lineitem GROUP BY 1)
SELECT p_partkey, p_name AS NAME, CAST(array_length(regexp_extract_all(p_name, '[\\p{L}\\p{N}_]+')) AS INTEGER) AS NAME_WORD_COUNT,
  CASE WHEN coalesce(m, 0) + coalesce(s, 0) < 2 THEN 1 ELSE 0 END AS IS_EMPTY,
  CASE WHEN p_name IN (SELECT p_name FROM part WHERE p_type = 'PROMO' AND p_size > 40) THEN 1 ELSE 0 END AS IS_PERSON
FROM part LEFT JOIN n ON p_partkey = l_partkey""")
def _(spark, sf):
    part = read(spark, sf, "part")
    flag, qty = c("l_returnflag"), c("l_quantity")
    counts = read(spark, sf, "lineitem").groupBy(c("l_partkey").alias("p_partkey")).agg(
        F.count_if((flag == "R") & (qty >= 40)).alias("MOVIE_COUNT"),
        F.count_if((flag == "A") & (qty >= 45)).alias("SERIE_COUNT"),
    )
    keywords = part.select("p_partkey", c("p_name").alias("NAME")).join(counts, "p_partkey", "left")
    persons = part.filter((c("p_type") == "PROMO") & (c("p_size") > 40)).select(c("p_name").alias("NAME"))
    return A.keyword_kpis(keywords, persons).drop("MOVIE_COUNT", "SERIE_COUNT")


@query("a4_gate", """
SELECT source, lang, count(*) AS MOVIE_COUNT, count(quality) AS SERIE_COUNT
FROM documents LEFT JOIN labels USING (doc_id) GROUP BY ALL HAVING count(*) + count(quality) >= 12""")
def _(spark, sf):
    docs = read(spark, sf, "documents").join(read(spark, sf, "labels"), "doc_id", "left")
    counts = docs.groupBy("source", "lang").agg(
        F.count(F.lit(1)).alias("MOVIE_COUNT"), F.count("quality").alias("SERIE_COUNT")
    )
    return A.gate(counts, ["MOVIE_COUNT", "SERIE_COUNT"], 12)


@query("a5_ordered_join", """
WITH v AS (SELECT l_orderkey, p_name, min(ROW(l_linenumber, l_partkey)) AS o
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL)
SELECT l_orderkey, string_agg(p_name, ', ' ORDER BY o) AS names FROM v GROUP BY 1""")
def _(spark, sf):
    part = read(spark, sf, "part").select(c("p_partkey").alias("l_partkey"), "p_name")
    rows = read(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey").join(part, "l_partkey")
    return A.ordered_join(rows, ["l_orderkey"], ["l_linenumber", "l_partkey"], "p_name", "names")


_PROPERTY_TEXT = f"""
{_EDGES},
labels_ AS (SELECT e.ID_WIKIDATA, ID_PROPERTY, LABEL, min(DISPLAY_ORDER) AS o, max(DISPLAY_ORDER) FILTER (i.LANG = 'fr') AS s
  FROM edges e JOIN items i ON e.ID_ITEM = i.ID_WIKIDATA WHERE LABEL <> '' AND LABEL <> ID_ITEM GROUP BY ALL),
texts AS (SELECT ID_WIKIDATA, ID_PROPERTY, coalesce(arg_max(LABEL, ROW(s, LABEL)) FILTER (s IS NOT NULL),
    string_agg(LABEL, ', ' ORDER BY o, LABEL)) AS TEXT
  FROM labels_ GROUP BY ALL)"""


@query("a6_property_text", f"WITH {_PROPERTY_TEXT} SELECT * FROM texts")
def _(spark, sf):
    return A.property_text(*edges_and_items(spark, sf), "fr")


@query("a6_pivot_properties", f"""
WITH {_PROPERTY_TEXT}
SELECT ID_WIKIDATA, max(TEXT) FILTER (ID_PROPERTY = 'P31') AS P31, max(TEXT) FILTER (ID_PROPERTY = 'P136') AS P136,
  max(TEXT) FILTER (ID_PROPERTY = 'P921') AS P921 FROM texts GROUP BY 1""")
def _(spark, sf):
    return A.pivot_properties(A.property_text(*edges_and_items(spark, sf), "fr"), ["P31", "P136", "P921"])


_SUPPLIER_LINES = """
lines AS (SELECT l_suppkey, l_partkey, p_name, p_brand, l_linenumber, l_returnflag, row_number() OVER (
    PARTITION BY l_suppkey ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_extendedprice) AS pos
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""
_LINE_ORDER = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"]


def _supplier_lines(spark, sf):
    part = read(spark, sf, "part").select(c("p_partkey").alias("l_partkey"), "p_name", "p_brand")
    lines = read(spark, sf, "lineitem").select("l_suppkey", "l_returnflag", *_LINE_ORDER)
    return lines.join(part, "l_partkey")


@query("a7_concat_until", f"""
WITH {_SUPPLIER_LINES},
k AS (SELECT *, sum(length(p_name)) OVER (PARTITION BY l_suppkey ORDER BY pos) + 2 * greatest(pos - 1, 1) <= 3000 AS kept
  FROM lines),
s AS (SELECT *, kept OR coalesce(lag(kept) OVER (PARTITION BY l_suppkey ORDER BY pos), true) AS seen FROM k)
SELECT l_suppkey, string_agg(p_name, ', ' ORDER BY pos) FILTER (kept) AS text,
  string_agg('k' || l_partkey, ' ' ORDER BY pos) FILTER (seen) AS tags FROM s GROUP BY 1""")
def _(spark, sf):
    marked = A.concat_until(
        _supplier_lines(spark, sf), ["l_suppkey"], _LINE_ORDER, "p_name", "l_partkey", V.MAX_KEYWORDS_CHARS
    )
    rows = A.limited_list(marked, ["l_suppkey"], "p_name", "l_partkey")
    tags = F.array_join(F.transform("tag_ids", lambda i: F.concat(F.lit("k"), i.cast("string"))), " ")
    return rows.select("l_suppkey", "text", tags.alias("tags"))


@query("a8_top_credits", f"""
WITH {_SUPPLIER_LINES},
k AS (SELECT *, coalesce(sum(length(p_name) + length(p_brand) + 1) OVER (PARTITION BY l_suppkey ORDER BY pos
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + length(p_name) + 2 * greatest(pos - 1, 1) <= 250 AS kept
  FROM lines WHERE pos <= 20)
SELECT l_suppkey, l_partkey, p_name AS NAME, CAST(pos AS INTEGER) AS pos FROM k WHERE kept""")
def _(spark, sf):
    rows = _supplier_lines(spark, sf).withColumnsRenamed({"p_name": "NAME", "p_brand": "ALIASES"})
    picked = A.top_credits(rows, ["l_suppkey"], _LINE_ORDER, V.MAX_CAST, 250)
    return picked.select("l_suppkey", "l_partkey", "NAME", "pos")


_DEPARTMENT_NAMES = ["Directing", "Writing", "Production", "Editing", "Art", "Sound", "Choir"]


@query("a9_department_credits", f"""
WITH RECURSIVE {_SUPPLIER_LINES},
crew AS (SELECT l_suppkey, l_partkey, pos, p_name || ' ' || p_brand AS name, {pick_sql(_DEPARTMENT_NAMES, "l_linenumber - 1")} AS dep,
  l_returnflag FROM lines),
listed AS (SELECT *, CASE WHEN dep = 'Directing' THEN CASE WHEN l_returnflag = 'A' THEN 'DIRECTORS' END
    WHEN dep = 'Writing' THEN 'WRITERS' WHEN dep = 'Production' THEN 'PRODUCERS' WHEN dep = 'Editing' THEN 'EDITORS'
    WHEN dep = 'Art' THEN 'ART' WHEN dep = 'Sound' THEN 'SOUND' ELSE 'CREW_TOP' END AS list FROM crew),
numbered AS (SELECT l_suppkey, list, name, row_number() OVER (PARTITION BY l_suppkey, list ORDER BY pos) AS i,
    CASE WHEN list = 'CREW_TOP' THEN 20 ELSE 10 END AS cap, CASE WHEN list = 'CREW_TOP' THEN 3000 ELSE 150 END AS mx
  FROM listed WHERE list IS NOT NULL),
fold AS (
  SELECT l_suppkey, list, CAST(0 AS BIGINT) AS i, '' AS names, 0 AS n FROM (SELECT DISTINCT l_suppkey, list FROM numbered)
  UNION ALL
  SELECT f.l_suppkey, f.list, m.i,
    CASE WHEN ok THEN CASE WHEN f.names = '' THEN m.name ELSE f.names || ', ' || m.name END ELSE f.names END,
    CASE WHEN ok THEN f.n + 1 ELSE f.n END
  FROM fold f JOIN numbered m ON f.l_suppkey = m.l_suppkey AND f.list = m.list AND m.i = f.i + 1,
    LATERAL (SELECT NOT contains(', ' || f.names || ', ', ', ' || m.name || ', ')
      AND length(f.names) + 2 + length(m.name) <= m.mx AND f.n < m.cap AS ok))
SELECT l_suppkey, list, arg_max(names, i) AS names FROM fold GROUP BY ALL""")
def _(spark, sf):
    rows = _supplier_lines(spark, sf)
    crew = rows.select(
        "l_suppkey", *[n for n in _LINE_ORDER if n != "l_partkey"], c("l_partkey").alias("ID_PERSON"),
        F.concat_ws(" ", "p_name", "p_brand").alias("NAME"), F.lit("").alias("ALIASES"),
        pick(_DEPARTMENT_NAMES, c("l_linenumber") - 1).alias("CREW_DEPARTMENT"),
        F.when(c("l_returnflag") == "A", "Director").otherwise("Assistant").alias("CREW_JOB"),
    )
    rules = [
        r if r.department is None else A.DepartmentRule(r.column, r.department, r.job, max_chars=150)
        for r in A.department_rules()
    ]
    order = ["l_shipdate", "l_orderkey", "l_linenumber", "ID_PERSON", "l_extendedprice"]
    return A.department_credits(crew, ["l_suppkey"], order, rules).drop("picks")


@query("a10_parse_stats", """
SELECT count(*) FILTER (n_chars > 100) AS parsed, count(*) FILTER (NOT n_chars > 100) AS failed FROM documents""")
def _(spark, sf):
    return A.parse_stats(read(spark, sf, "documents"), c("n_chars") > 100)


# --- ordered scans and picks ------------------------------------------------


@query("w1_forward_fill", """
SELECT user_id, event_id, coalesce(last_value(CASE WHEN event_type NOT IN ('error', 'view') THEN value END IGNORE NULLS)
  OVER (PARTITION BY user_id ORDER BY event_id), 0.0) AS value FROM events""")
def _(spark, sf):
    known = F.when(~c("event_type").isin("error", "view"), c("value"))
    rows = read(spark, sf, "events").select("user_id", "event_id", known.alias("value"))
    return R.forward_fill(rows, ["user_id"], "event_id", "value", 0.0, width=1000)


@query("w1_forward_fill_hashed", """
SELECT event_type, md5(CAST(event_id AS VARCHAR)) AS place, coalesce(last_value(CASE WHEN user_id % 3 = 0 THEN value END IGNORE NULLS)
  OVER (PARTITION BY event_type ORDER BY md5(CAST(event_id AS VARCHAR))), 0.0) AS value FROM events""")
def _(spark, sf):
    place = F.md5(c("event_id").cast("string")).alias("place")
    known = F.when(c("user_id") % 3 == 0, c("value")).alias("value")
    rows = read(spark, sf, "events").select("event_type", place, known)
    return R.forward_fill(rows, ["event_type"], "place", "value", 0.0, width=1000)


@query("w2_first_position", """
SELECT l_orderkey, l_linestatus, l_suppkey, l_linenumber, l_partkey, l_extendedprice,
  min(l_linenumber) OVER (PARTITION BY l_orderkey, l_linestatus, l_suppkey) AS DISPLAY_ORDER FROM lineitem""")
def _(spark, sf):
    rows = read(spark, sf, "lineitem").select(
        "l_orderkey", "l_linestatus", "l_suppkey", "l_linenumber", "l_partkey", "l_extendedprice"
    )
    return R.first_position(rows, ["l_orderkey", "l_linestatus"], "l_suppkey", "l_linenumber", "DISPLAY_ORDER")


@query("w3_number_items", """
SELECT doc_id, line AS item, CAST(pos AS INTEGER) AS DISPLAY_ORDER FROM documents,
  unnest(string_split(text, chr(10))) WITH ORDINALITY AS t(line, pos) WHERE line <> ''""")
def _(spark, sf):
    rows = R.number_items(read(spark, sf, "documents"), ["doc_id"], F.split("text", "\n"))
    return rows.filter(C.present("item"))


_SECTION_TITLES = [
    "Intro", "Plot", "Synopsis", "Cast", " Plot ", "Music", "Voice cast", "Premise", "Soundtrack", "Trivia",
    "Reception", "Release", "Development", "Production", "Release history", "Legacy",
]
_ROUTE = {**V.SECTIONS_EXACT, **V.SECTIONS_FALLBACK}
_CASE_ROUTE = " ".join(f"WHEN '{t}' THEN '{k}'" for t, k in _ROUTE.items())
_TARGETS = list(V.SECTIONS_EXACT.values())


@query("w4_route_sections", f"""
WITH s AS (SELECT conv_id, turn, trim({pick_sql(_SECTION_TITLES, "length(text)")}) AS t,
    regexp_replace(text, '^[\\s\\p{{Z}}]+|[\\s\\p{{Z}}]+$', '', 'g') AS x FROM conversations),
r AS (SELECT *, CASE t {_CASE_ROUTE} END AS k, t IN ({", ".join(f"'{t}'" for t in V.SECTIONS_EXACT)}) AS exact
  FROM s WHERE t NOT IN ({", ".join(f"'{t}'" for t in V.SECTIONS_SKIPPED)})),
f AS (SELECT *, row_number() OVER (PARTITION BY conv_id, k ORDER BY turn) AS rn FROM r)
SELECT conv_id, {", ".join(
    f"coalesce(arg_max(x, turn) FILTER (exact AND k = '{k}'), arg_min(x, turn) FILTER (NOT exact AND k = '{k}')) AS {k}"
    for k in _TARGETS)},
  '|' || string_agg(t || '|', '' ORDER BY turn) FILTER (k IS NULL OR (NOT exact AND rn > 1)) AS OTHER_SECTIONS
FROM f GROUP BY conv_id""")
def _(spark, sf):
    rows = read(spark, sf, "conversations").select(
        "conv_id", "turn", pick(_SECTION_TITLES, F.length("text")).alias("TITLE"), c("text").alias("CONTENT")
    )
    return R.route_sections(rows, "conv_id", ["turn"])


@query("w5_first_by", """
SELECT user_id, event_id, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def _(spark, sf):
    rows = read(spark, sf, "events").select("user_id", "ts", "event_id", "event_type", "value")
    return R.first_by(rows, ["user_id"], ["ts", "event_id"], latest=True).drop("ts")


@query("t1_order_by", """
SELECT p_name, count(*) AS n, min(p_partkey) AS first_id FROM part GROUP BY 1 ORDER BY n DESC, p_name""")
def _(spark, sf):
    counts = read(spark, sf, "part").groupBy("p_name").agg(
        F.count(F.lit(1)).alias("n"), F.min("p_partkey").alias("first_id")
    )
    return counts.orderBy(F.desc("n"), "p_name")


@query("t2_top_n", """
SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_linenumber, l_partkey) AS rank
  FROM lineitem) WHERE rank <= 3""")
def _(spark, sf):
    rows = read(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    return R.top_n(rows, ["l_orderkey"], [F.desc("l_extendedprice"), "l_linenumber", "l_partkey"], 3)


@query("x3_keep_in_both_and_difference", """
SELECT 'both' AS part, l_orderkey AS id FROM (
  SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'A' INTERSECT SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')
UNION ALL SELECT 'only', o_orderkey FROM (
  SELECT o_orderkey FROM orders EXCEPT SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'A')""")
def _(spark, sf):
    orders = read(spark, sf, "orders").select(c("o_orderkey").alias("id"), "o_orderstatus")
    linked = read(spark, sf, "lineitem").filter(c("l_returnflag") == "A").select(c("l_orderkey").alias("id"))
    both = U.mirror_delete(orders.filter(c("o_orderstatus") == "F"), linked, "id")
    only = R.missing_from(orders, linked, ["id"])
    return both.select(F.lit("both").alias("part"), "id").unionByName(only.select(F.lit("only").alias("part"), "id"))


# --- text, format and date functions ----------------------------------------

FORMAT_LINES = [
    "Couleur - 35 mm - 2.39:1 - Dolby 5.1", "noir et blanc – 1,37 : 1 – 16 mm – muet",
    "Couleurs (Technicolor) [note] 35 mm / 70 mm", "16/9 digital DCP", "IMAX 12-track sound", "IMAX",
    "Couleur stéréo 4:3", "monostéréo DTS/SDDS", "Todd-AO 70 mm 7.1", "ColorWorks", "Eastman Color 4 pistes Auro",
    "Deluxe Color — CinemaScope 2,35:1 — Westrex sound", "Super 16 b&w 1.66:1 silent",
]


def clean_sql(line: str) -> str:
    """The cleaning steps for a regex engine without look-around."""
    slash = r"'(^|[^0-9])/($|[^0-9])', '\1 \2', 'g'"
    steps = [
        r"'([0-9]+)\.([0-9]+):1', '\1,\2:1', 'g'", r"'([0-9]+,[0-9]+)\s*:\s*([0-9]+)', '\1:\2', 'g'",
        r"'\[.*?\]', '', 'g'", r"'\((.*?)\)', '\1', 'g'", "'[-–—]', ' ', 'g'", slash, slash,
        "'colorworks', '', 'g'", r"'[\s\p{Z}]+', ' ', 'g'",
    ]
    out = f"lower({line})"
    for step in steps:
        out = f"regexp_replace({out}, {step})"
    return f"trim({out})"


def tags_sql(column: str, dictionary: dict[str, list[str]]) -> str:
    """``|a|b|`` of a dictionary, empty when nothing matches."""
    hits = ", ".join(
        f"CASE WHEN {' OR '.join(f'contains({column}, {chr(39)}{v}{chr(39)})' for v in dictionary[t])} THEN '{t}' END"
        for t in sorted(dictionary)
    )
    return f"coalesce('|' || nullif(concat_ws('|', {hits}), '') || '|', '')"


def any_sql(column: str, terms: list[str]) -> str:
    return "(" + " OR ".join(f"contains({column}, '{t}')" for t in terms) + ")"


SOUND_SQL = (
    "'|' || concat_ws('|', CASE WHEN contains(l, '5.1') THEN '5.1' END, CASE WHEN contains(l, '7.1') THEN '7.1' END, "
    "CASE WHEN contains(l, 'auro') THEN 'auro' END, CASE WHEN contains(l, 'dolby') THEN 'dolby' END, "
    "CASE WHEN contains(l, 'dts') THEN 'dts' END, "
    "CASE WHEN contains(l, 'imax') AND (contains(l, 'track') OR contains(l, 'sound')) THEN 'imax' END, "
    "CASE WHEN contains(l, 'mono') THEN 'mono' END, CASE WHEN contains(l, 'sdds') THEN 'sdds' END, "
    r"CASE WHEN regexp_matches(l, '(^|[^\p{L}\p{N}_])st[eéèê]r[eéèê]o($|[^\p{L}\p{N}_])') THEN 'stereo' END) || '|'"
)
RATIO_SQL = "replace(coalesce(" + ", ".join(
    f"nullif(regexp_extract(l, '{p}', 1), '')" for p in V.ASPECT_RATIOS) + "), '.', ',')"
FILM_SQL = "CASE " + " ".join(f"WHEN contains(l, '{t}') THEN '{t}'" for t in V.FILM_FORMATS) + " END"
TRACK_SQL = f"coalesce(TRY_CAST(nullif(regexp_extract(l, '{V.TRACK_COUNT}', 1), '') AS BIGINT), 0)"
VALID_SQL = (
    f"CASE WHEN (regexp_matches(l, '{V.VALID_COLOR}') AND regexp_matches(l, '{V.VALID_RATIO}') "
    f"AND regexp_matches(l, '{V.VALID_MEDIUM}')) OR {any_sql('l', V.VALID_NAMED_FORMATS)} THEN 1 ELSE 0 END"
)
FORMAT_SQL = {
    "IS_COLOR": f"CASE WHEN {any_sql('l', V.COLOR_TERMS)} THEN 1 ELSE 0 END",
    "IS_BLACK_AND_WHITE": f"CASE WHEN {any_sql('l', V.BLACK_AND_WHITE_TERMS)} THEN 1 ELSE 0 END",
    "IS_SILENT": f"CASE WHEN {any_sql('l', V.SILENT_TERMS)} THEN 1 ELSE 0 END",
    "IS_3D": "CASE WHEN contains(l, 'imax') THEN 1 ELSE 0 END",
    "COLOR_TECHNOLOGY": tags_sql("l", V.COLOR_TECHNOLOGIES),
    "FILM_TECHNOLOGY": tags_sql("l", V.FILM_TECHNOLOGIES),
    "ASPECT_RATIO": RATIO_SQL,
    "FILM_FORMAT": FILM_SQL,
    "SOUND_SYSTEM": SOUND_SQL,
    "SOUND_TECHNOLOGY": tags_sql("l", V.SOUND_TECHNOLOGIES),
    "NUM_AUDIO_TRACKS": TRACK_SQL,
    "IS_VALID_FORMAT": VALID_SQL,
}
# every line of every document, behind a wording chosen by its place
LINE_SQL = pick_sql(FORMAT_LINES, "(doc_id + t.pos)") + " || ' - ' || t.line"
_LINES = f"""lines AS (SELECT doc_id, CAST(t.pos AS BIGINT) AS pos, {clean_sql(LINE_SQL)} AS l
  FROM documents, unnest(string_split(text, chr(10))) WITH ORDINALITY AS t(line, pos))"""


def _format_lines(spark, sf):
    rows = read(spark, sf, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    rows = rows.withColumn("pos", c("pos").cast("bigint") + 1)
    line = F.concat(pick(FORMAT_LINES, c("doc_id") + c("pos")), F.lit(" - "), c("line"))
    return rows.select("doc_id", "pos", FM.clean_format(line).alias("l"))


@query("f1_clean_format", f"WITH {_LINES} SELECT doc_id, pos, l FROM lines")
def _(spark, sf):
    return _format_lines(spark, sf)


@query("f2_tag_terms", f"""
WITH d AS (SELECT doc_id, lower(text) AS l FROM documents)
SELECT doc_id, {tags_sql("l", {"article": ["the", "les"], "verb": ["is ", "est "], "tion": ["tion"], "gear": ["gear"]})} AS tags
FROM d""")
def _(spark, sf):
    words = {"article": ["the", "les"], "verb": ["is ", "est "], "tion": ["tion"], "gear": ["gear"]}
    rows = read(spark, sf, "documents").select("doc_id", F.lower("text").alias("l"))
    return rows.select("doc_id", FM.tag_terms("l", words).alias("tags"))


def _format_query(name: str, columns: list[str]) -> None:
    """Query over some of the columns read from a cleaned line."""
    sql = ", ".join(f"{FORMAT_SQL[n]} AS {n}" for n in columns)

    @query(name, f"WITH {_LINES} SELECT doc_id, pos, {sql} FROM lines")
    def _(spark, sf):
        found = FM.format_columns("l")
        return _format_lines(spark, sf).select("doc_id", "pos", *[found[n].alias(n) for n in columns])


_format_query("f2_technology_tags", ["COLOR_TECHNOLOGY", "FILM_TECHNOLOGY", "SOUND_TECHNOLOGY"])
_TECHNOLOGIES = {
    tag: [v for d in (V.COLOR_TECHNOLOGIES, V.FILM_TECHNOLOGIES, V.SOUND_TECHNOLOGIES) for v in d.get(tag, [])]
    for tag in sorted({*V.COLOR_TECHNOLOGIES, *V.FILM_TECHNOLOGIES, *V.SOUND_TECHNOLOGIES})
}


@query("f2_dictionary_technologies", f"WITH {_LINES} SELECT doc_id, pos, {tags_sql('l', _TECHNOLOGIES)} AS TAGS FROM lines")
def _(spark, sf):
    entries = [(tag, v) for tag, variants in _TECHNOLOGIES.items() for v in variants]
    entries = spark.createDataFrame(entries, "tag string, variant string")
    return T.dictionary_tags(_format_lines(spark, sf), ["doc_id", "pos"], "l", entries, "tag", "variant")


@query("f2_dictionary_of_parts", """
WITH d AS (SELECT DISTINCT p_type || ' ' || p_size AS tag, p_partkey || ' ' || p_name AS variant FROM part),
t AS (SELECT l_orderkey, string_agg(DISTINCT l_partkey || ' ' || p_name, ', ') AS l
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1),
h AS (SELECT DISTINCT l_orderkey, tag FROM t JOIN d ON contains(l, variant))
SELECT l_orderkey, coalesce('|' || string_agg(tag, '|' ORDER BY tag) || '|', '') AS TAGS FROM t LEFT JOIN h USING (l_orderkey) GROUP BY 1""")
def _(spark, sf):
    part = read(spark, sf, "part")
    variant = F.concat_ws(" ", "p_partkey", "p_name").alias("variant")
    entries = part.select(F.concat_ws(" ", "p_type", "p_size").alias("tag"), variant)
    named = part.select(c("p_partkey").alias("l_partkey"), variant)
    rows = read(spark, sf, "lineitem").select("l_orderkey", "l_partkey").join(named, "l_partkey")
    texts = rows.groupBy("l_orderkey").agg(F.array_join(F.array_sort(F.collect_set("variant")), ", ").alias("l"))
    return T.dictionary_tags(texts, ["l_orderkey"], "l", entries, "tag", "variant")


_format_query("f3_aspect_ratio", ["ASPECT_RATIO"])
_format_query("f4_sound_system", ["SOUND_SYSTEM"])
_format_query("f5_film_format", ["FILM_FORMAT"])
_format_query("f6_format_flags", ["IS_COLOR", "IS_BLACK_AND_WHITE", "IS_SILENT", "IS_3D"])
_format_query("f7_track_count", ["NUM_AUDIO_TRACKS"])
_format_query("f8_is_valid_format", ["IS_VALID_FORMAT"])
_format_query("f3_f8_format_columns", list(FORMAT_SQL))


_GENRE_LISTS = ["|Drama|Unknown|TV Movie|", "|", "|Comedy|", "|Science Fiction|Action|War|", "|Documentary|Music|"]
_GENRE_CASE = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in V.GENRES_FR.items())


@query("f9_translate_terms", f"""
SELECT o_orderkey, array_to_string([CASE x {_GENRE_CASE} ELSE x END
  FOR x IN string_split({pick_sql(_GENRE_LISTS, "o_custkey")}, '|')], '|') AS genres FROM orders""")
def _(spark, sf):
    return read(spark, sf, "orders").select(
        "o_orderkey", C.translate_terms(pick(_GENRE_LISTS, c("o_custkey")), V.GENRES_FR).alias("genres")
    )


@query("f10_pipe_lists", """
SELECT p_partkey, '|' || array_to_string(string_split(p_name, ' '), '|') || '|' AS piped,
  array_to_string(string_split(p_name, ' '), ', ') AS shown FROM part""")
def _(spark, sf):
    rows = read(spark, sf, "part").select("p_partkey", C.list_to_pipe(F.split("p_name", " ")).alias("piped"))
    return rows.withColumn("shown", C.pipe_to_list("piped"))


@query("f11_word_count", r"""
SELECT doc_id, CAST(array_length(regexp_extract_all(text, '[\p{L}\p{N}_]+')) AS INTEGER) AS words FROM documents""")
def _(spark, sf):
    return read(spark, sf, "documents").select("doc_id", C.word_count("text").alias("words"))


@query("f12_tag_string", f"""
WITH o AS (SELECT o_orderkey, 'c' || o_custkey AS ct, {pick_sql(_GENRE_LISTS, "o_custkey")} AS g FROM orders),
g AS (SELECT o_orderkey, ct, nullif(replace(regexp_replace(regexp_replace(array_to_string(
    [CASE x {_GENRE_CASE} ELSE x END FOR x IN string_split(g, '|')], '|'), '^\\||\\|$', '', 'g'), '[- ]', '', 'g'),
    '|', ' '), '') AS gt FROM o),
k AS (SELECT l_orderkey, string_agg('k' || l_partkey, ' ' ORDER BY l_linenumber, l_partkey, l_extendedprice) AS kt FROM lineitem GROUP BY 1)
SELECT o_orderkey, concat_ws(' ', ct, gt, kt) AS tags FROM g LEFT JOIN k ON o_orderkey = l_orderkey""")
def _(spark, sf):
    listed = F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_extendedprice")))
    keywords = read(spark, sf, "lineitem").groupBy(c("l_orderkey").alias("o_orderkey")).agg(
        F.array_join(F.transform(listed, lambda x: F.concat(F.lit("k"), x["l_partkey"].cast("string"))), " ").alias("kt")
    )
    genres = C.translate_terms(pick(_GENRE_LISTS, c("o_custkey")), V.GENRES_FR)
    orders = read(spark, sf, "orders").select(
        "o_orderkey", F.concat(F.lit("c"), c("o_custkey").cast("string")).alias("ct"),
        C.text_or_null(C.genre_tags(genres)).alias("gt"),
    )
    rows = orders.join(keywords, "o_orderkey", "left")
    return rows.select("o_orderkey", F.concat_ws(" ", "ct", "gt", "kt").alias("tags"))


@query("f13_strip_aliases", """
SELECT p_partkey, replace(replace('|' || p_name || '|' || p_brand || '|' || p_type || '|', '|' || p_brand || '|', '|'),
  '|' || CASE WHEN p_size > 25 THEN p_type ELSE '' END || '|', '|') AS aliases FROM part""")
def _(spark, sf):
    listed = C.list_to_pipe(F.array("p_name", "p_brand", "p_type"))
    return read(spark, sf, "part").select(
        "p_partkey", C.strip_aliases(listed, "p_brand", F.when(c("p_size") > 25, c("p_type"))).alias("aliases")
    )


@query("f14_unescape_quotes", r"""
SELECT doc_id, replace(replace(replace(replace(text, 'e', 'e\'''), 'a', 'a\"'), '\''', ''''), '\"', '"') AS text FROM documents""")
def _(spark, sf):
    text = F.replace(c("text"), F.lit("e"), F.lit("e\\'"))
    text = F.replace(text, F.lit("a"), F.lit('a\\"'))
    return read(spark, sf, "documents").select("doc_id", C.unescape_quotes(text).alias("text"))


@query("f15_distinct_words", r"""
WITH w AS (SELECT doc_id, t.w, min(t.pos) AS pos FROM documents,
    unnest(regexp_split_to_array(text, '[\s\p{Z}\x1c-\x1f\x{85}]+')) WITH ORDINALITY AS t(w, pos)
  WHERE t.w <> '' GROUP BY doc_id, t.w)
SELECT d.doc_id, coalesce(string_agg(w, ' ' ORDER BY pos), '') AS words FROM documents d LEFT JOIN w ON d.doc_id = w.doc_id
GROUP BY d.doc_id""")
def _(spark, sf):
    return read(spark, sf, "documents").select("doc_id", C.distinct_words("text").alias("words"))


@query("f16_strip_between", """
SELECT page_id, regexp_replace(html, '<script>(?s:.*?)</script>', '<gone/>', 'g') AS html FROM pages""")
def _(spark, sf):
    return read(spark, sf, "pages").select(
        "page_id", C.strip_between("html", "<script>", "</script>", "<gone/>").alias("html")
    )


_TOKENS = r"""
pieces AS (SELECT doc_id, t.p, t.pos FROM documents,
    unnest(regexp_extract_all(text, '[\p{L}\p{N}_]+|[^\p{L}\p{N}_]+')) WITH ORDINALITY AS t(p, pos)),
toks AS (SELECT doc_id, CAST(coalesce(sum(length(p)) OVER (PARTITION BY doc_id ORDER BY pos
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS INTEGER) AS START_CHAR, p AS TOKEN FROM pieces)"""
_IS_WORD = r"regexp_matches(TOKEN, '^[\p{L}\p{N}_]')"
_EN_STOP = ", ".join(f"'{w}'" for w in V.STOP_WORDS["en"])


@query("f17_tokens", f"WITH {_TOKENS} SELECT * FROM toks WHERE {_IS_WORD}")
def _(spark, sf):
    return TX.tokens(read(spark, sf, "documents"), ["doc_id"], "text")


_DICTIONARY = """
dict AS (SELECT lower(split_part(p_name, ' ', 1)) AS FORM, 'adj-' || min(p_name) AS LEMMA, 'ADJ' AS LABEL FROM part GROUP BY 1
  UNION ALL SELECT * FROM (VALUES ('the1', 'the', 'DET'), ('onon', 'on', 'VERB'), ('la', 'le', 'DET')))"""


def small_dictionary(spark, sf):
    words = read(spark, sf, "part").groupBy(F.lower(F.split("p_name", " ")[0]).alias("FORM")).agg(
        F.concat(F.lit("adj-"), F.min("p_name")).alias("LEMMA"), F.lit("ADJ").alias("LABEL")
    )
    more = spark.createDataFrame(
        [("the1", "the", "DET"), ("onon", "on", "VERB"), ("la", "le", "DET")], "FORM string, LEMMA string, LABEL string"
    )
    return words.unionByName(more).withColumn("LANG", F.lit("en"))


_LEMMAS = rf"""
{_TOKENS}, {_DICTIONARY},
lem AS (SELECT doc_id, START_CHAR, coalesce(LEMMA, TOKEN) AS LEMMA,
    coalesce(LABEL, CASE WHEN regexp_matches(TOKEN, '^\p{{N}}+$') THEN 'NUM' ELSE 'X' END) AS LABEL
  FROM toks LEFT JOIN dict ON lower(TOKEN) = FORM WHERE {_IS_WORD} AND lower(TOKEN) NOT IN ({_EN_STOP}))"""


@query("f17_lemma_text", f"""
WITH {_LEMMAS}
SELECT doc_id, string_agg(LEMMA, ' ' ORDER BY START_CHAR) AS lemmas FROM lem
WHERE LABEL IN ('NOUN', 'PROPN', 'VERB', 'ADJ', 'X', 'NUM') GROUP BY 1""")
def _(spark, sf):
    docs = read(spark, sf, "documents").select("doc_id", "text")
    return TX.lemma_text(docs, ["doc_id"], "text", "en", small_dictionary(spark, sf), "lemmas")


@query("f18_lemma_bridge", f"""
WITH {_LEMMAS.replace("lem AS (", "lem AS MATERIALIZED (")},
kept AS MATERIALIZED (SELECT * FROM lem WHERE LABEL IN ('NOUN', 'PROPN', 'VERB', 'ADJ', 'X', 'NUM')),
heads AS (SELECT 10000000 + min(doc_id) AS ID_LEMME, regexp_extract(text, '^[A-Za-z]+') AS NAME FROM documents GROUP BY 2),
known AS MATERIALIZED (SELECT p_partkey AS ID_LEMME, 'en' AS LANG, 'X' AS LABEL, p_name AS NAME FROM part
  UNION ALL SELECT ID_LEMME, 'en', 'X', NAME FROM heads WHERE NAME <> '' AND NAME NOT IN (SELECT p_name FROM part)),
fresh AS (SELECT DISTINCT 'en' AS LANG, LEMMA AS NAME, LABEL FROM kept
  WHERE NOT EXISTS (SELECT 1 FROM known WHERE known.NAME = LEMMA AND known.LABEL = kept.LABEL)),
ids AS MATERIALIZED (SELECT ID_LEMME, NAME, LABEL FROM known
  UNION ALL SELECT (SELECT max(ID_LEMME) FROM known) + row_number() OVER (
    ORDER BY left(md5(LANG || chr(31) || NAME || chr(31) || LABEL), 3), LANG, NAME, LABEL), NAME, LABEL FROM fresh)
SELECT doc_id, ID_LEMME, START_CHAR FROM kept JOIN ids ON LEMMA = NAME AND kept.LABEL = ids.LABEL""")
def _(spark, sf):
    """Known lemmas: all part names, and the first word of every document."""
    docs = read(spark, sf, "documents").select("doc_id", "text")
    parts = read(spark, sf, "part").select(c("p_partkey").alias("ID_LEMME"), c("p_name").alias("NAME"))
    heads = docs.groupBy(F.regexp_extract("text", "^[A-Za-z]+", 0).alias("NAME")).agg(
        (F.min("doc_id") + 10000000).alias("ID_LEMME"))
    heads = heads.filter("NAME <> ''").join(parts, "NAME", "left_anti")
    known = parts.unionByName(heads).select(
        "ID_LEMME", F.lit("en").alias("LANG"), F.lit("X").alias("LABEL"), "NAME")
    return lemma_bridge(docs, "doc_id", "text", "en", known, small_dictionary(spark, sf))[1]


@query("f19_to_local", """
SELECT event_id, CASE event_type
    WHEN 'error' THEN NULL
    ELSE date_trunc('second', ts) AT TIME ZONE 'UTC' AT TIME ZONE 'Europe/Paris' END AS local_ts
FROM events""")
def _(spark, sf):
    day = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    text = (
        F.when(c("event_type") == "error", F.concat(day, F.lit("Z")))
        .when(c("event_type") == "click", day)
        .when(c("event_type") == "view", F.concat(day, F.lit("+00:00")))
        .otherwise(F.concat(day, F.lit(".000Z")))
    )
    return read(spark, sf, "events").select("event_id", C.to_local(text, "Europe/Paris").alias("local_ts"))


@query("f20_duration_text", """
WITH d AS (SELECT o_orderkey, CAST(floor(o_totalprice) AS BIGINT) - 1000 AS s FROM orders)
SELECT o_orderkey, CASE WHEN s < 0 THEN 'Invalid duration (negative seconds)' ELSE concat_ws(', ',
  CASE WHEN s // 86400 > 0 THEN s // 86400 || CASE WHEN s // 86400 = 1 THEN ' day' ELSE ' days' END END,
  CASE WHEN s % 86400 // 3600 > 0 THEN s % 86400 // 3600 || CASE WHEN s % 86400 // 3600 = 1 THEN ' hour' ELSE ' hours' END END,
  CASE WHEN s % 3600 // 60 > 0 THEN s % 3600 // 60 || CASE WHEN s % 3600 // 60 = 1 THEN ' minute' ELSE ' minutes' END END,
  CASE WHEN s % 60 > 0 THEN s % 60 || CASE WHEN s % 60 = 1 THEN ' second' ELSE ' seconds' END END) END AS duration
FROM d""")
def _(spark, sf):
    seconds = F.floor("o_totalprice") - 1000
    return read(spark, sf, "orders").select("o_orderkey", C.duration_text(seconds).alias("duration"))


@query("f21_length_class", """
SELECT p_partkey, CASE WHEN p_size * 2 - 4 > 58 THEN 'Long métrage' WHEN p_size * 2 - 4 > 0 THEN 'Court métrage' END AS fr,
  CASE WHEN p_size * 2 - 4 > 58 THEN 'Feature film' WHEN p_size * 2 - 4 > 0 THEN 'short film' END AS en FROM part""")
def _(spark, sf):
    minutes = c("p_size") * 2 - 4
    return read(spark, sf, "part").select(
        "p_partkey", C.length_class(minutes, "fr").alias("fr"), C.length_class(minutes, "en").alias("en")
    )


# --- streaming --------------------------------------------------------------


@query("s1_stream_upsert", """
WITH last AS (SELECT user_id, event_id, event_type FROM events
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1),
supplied AS (SELECT user_id, value FROM events WHERE event_type <> 'error'
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1)
SELECT last.*, value FROM last LEFT JOIN supplied USING (user_id)""")
def _(spark, sf):
    """Three batches folded in the state store, the last one by a run whose checkpoint was lost."""
    events = read(spark, sf, "events").withColumn("value", F.when(c("event_type") != "error", c("value")))
    return _streamed(spark, events, ["value"]).select("user_id", "event_id", "event_type", "value")


def _streamed(spark, events, partial=(), delete=None):
    root, keys, order = scratch(spark), ["user_id"], ["ts", "event_id"]
    table = S.streamed_table(spark, f"{root}/table", events.schema, keys, order, partial, buckets=16)
    for part in range(3):
        events.filter(c("event_id") % 3 == part).coalesce(1).write.parquet(f"{root}/in/{part}")
        stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in/*")
        S.stream_upsert(stream, table, f"{root}/{'first' if part < 2 else 'second'}", keys, order, partial, delete)
    return S.read_current(table, keys, events.columns, partial)


@query("s1_stream_deletes", """
WITH e AS (SELECT *, event_type = 'signup' AND value < 60 AS gone FROM events),
last AS (SELECT user_id, event_id, event_type, gone FROM e
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1),
deleted AS (SELECT user_id, ts AS d_ts, event_id AS d_id FROM e WHERE gone
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1),
supplied AS (SELECT user_id, props FROM e LEFT JOIN deleted USING (user_id)
  WHERE event_type = 'click' AND (d_ts IS NULL OR (ts, event_id) > (d_ts, d_id))
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1)
SELECT user_id, event_id, event_type, props FROM last LEFT JOIN supplied USING (user_id) WHERE NOT gone""")
def _(spark, sf):
    """Some sign-ups count as deletes: they remove the user and all values before them."""
    events = read(spark, sf, "events").withColumn("props", F.when(c("event_type") == "click", c("props")))
    delete = (c("event_type") == "signup") & (c("value") < 60)
    return _streamed(spark, events, ["props"], delete).select("user_id", "event_id", "event_type", "props")


@query("s2_resume_from", """
SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey >= (SELECT min(l_orderkey) FROM lineitem WHERE l_quantity >= 50)""")
def _(spark, sf):
    done = read(spark, sf, "lineitem").filter(c("l_quantity") >= 50).agg(F.min("l_orderkey")).scalar()
    return S.resume_from(read(spark, sf, "orders").select("o_orderkey", "o_totalprice"), "o_orderkey", done)
