"""Queries for the ingest jobs.

The payloads are JSON texts built from the driver tables and parsed back, so
every row of those tables passes through the JSON source.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..plans import ingest
from ..session import stage
from ..sources.payloads import parse_payloads
from .catalogue import DEPARTMENTS, GENRES, case, text
from .operator_queries import pick, pick_sql
from .registry import AUDIT, NOW_SQL, query, read

c = F.col
LINE = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"]
LINE_SQL = ", ".join(LINE)


def landed(rows: DataFrame, kind: str) -> DataFrame:
    """Rows as JSON texts, parsed with the payload schema and staged."""
    texts = rows.select(F.to_json(F.struct(*rows.columns)).alias("body"))
    return stage(parse_payloads(texts, "body", schemas.PAYLOADS[kind]).select("payload.*"), "zstd")


def current(spark, name: str, rows: DataFrame | None = None) -> DataFrame:
    """Table that holds only the given columns of some old rows."""
    empty = schemas.empty_table(spark, name)
    return empty if rows is None else empty.unionByName(rows, allowMissingColumns=True)


def credit_id(line: Callable[[str], Column] = c) -> Column:
    """Id of the credit made of a line, whose values ``line`` gives by name."""
    return F.concat_ws(
        "-", *[line(n).cast("string") for n in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")],
        F.round(line("l_extendedprice") * 100).cast("bigint").cast("string"), F.date_format(line("l_shipdate"), "yyyyMMdd"),
    )


CREDIT_SQL = """concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CAST(round(l_extendedprice * 100) AS BIGINT), strftime(l_shipdate, '%Y%m%d'))"""


# --- movies -----------------------------------------------------------------


def movie_payloads(spark, sf) -> DataFrame:
    orders = read(spark, sf, "orders")
    lines = read(spark, sf, "lineitem").select(
        c("l_orderkey").alias("o_orderkey"), F.struct(*LINE, "l_linestatus", "l_returnflag").alias("x")
    )
    # the items of one payload, as they arrive in one document; lines are sent as they are, texts made of them after that
    items = lines.repartition("o_orderkey").groupBy("o_orderkey").agg(F.array_sort(F.collect_list("x")).alias("xs"))

    def credit(x: Column) -> Column:
        return F.struct(
            F.pmod(x["l_partkey"], F.lit(50)).alias("id"), F.lit("n").alias("name"),
            credit_id(lambda n: x[n] if n in LINE else c("o_orderkey")).alias("credit_id"),
            F.concat(F.lit("Role "), x["l_suppkey"].cast("string")).alias("character"),
            pick(DEPARTMENTS, x["l_linenumber"] - 1).alias("department"), x["l_returnflag"].alias("job"),
        )

    def side(status: str) -> Column:
        return F.transform(F.filter("xs", lambda x: x["l_linestatus"] == status), credit)

    rows = orders.join(items, "o_orderkey", "left")
    names = F.split(F.trim(F.replace(case("o_orderpriority", GENRES), F.lit("|"), F.lit(";"))), ";")
    genres = F.transform(
        F.filter(names, lambda n: n != ""), lambda n: F.struct(F.length(n).cast("bigint").alias("id"), n.alias("name"))
    )
    return landed(rows.select(
        c("o_orderkey").alias("id"), F.when(c("o_orderpriority") == "1-URGENT", 1).alias("status_code"),
        F.repeat(text("Title ", "o_orderkey"), 40).alias("title"), F.lit("o").alias("original_title"),
        F.when(c("o_orderstatus") != "P", text("tt", "o_orderkey")).alias("imdb_id"),
        F.when(c("o_orderstatus") == "F", "soon").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("release_date"),
        (c("o_orderstatus") == "O").alias("adult"), c("o_totalprice").alias("budget"),
        F.floor(c("o_totalprice") / 5000).cast("int").alias("runtime"), genres.alias("genres"),
        F.struct(text("Q", "o_orderkey").alias("wikidata_id")).alias("external_ids"),
        F.struct(c("o_custkey").alias("id")).alias("belongs_to_collection"),
        F.transform("xs", lambda x: F.struct(x["l_suppkey"].alias("id"))).alias("production_companies"),
        F.struct(side("F").alias("cast"), side("O").alias("crew")).alias("credits"),
    ), "movie")


def _movie_tables(spark, sf) -> dict[str, DataFrame]:
    orders = read(spark, sf, "orders")
    key = c("o_orderkey").alias("ID_MOVIE")
    old = orders.filter(c("o_orderstatus") == "F").select(
        key, F.lit("old").alias("TITLE"), F.lit(1995).alias("RELEASE_YEAR"), F.lit("a line").alias("WIKIPEDIA_FORMAT_LINE"),
    )
    return {
        "movie": current(spark, "movie", old),
        "movie_company": current(spark, "movie_company", orders.select(key, F.lit(-1).cast("bigint").alias("ID_COMPANY"))),
        "movie_genre": current(spark, "movie_genre"),
        "movie_production_country": current(spark, "movie_production_country"),
        "movie_spoken_language": current(spark, "movie_spoken_language"),
        "person_movie": current(spark, "person_movie", orders.select(text("old-", "o_orderkey").alias("ID_CREDIT"), key)),
    }


def _movies(spark, sf) -> dict[str, DataFrame]:
    return ingest.ingest_movies(_movie_tables(spark, sf), movie_payloads(spark, sf), AUDIT)


@query("g12_movies", f"""
SELECT o_orderkey AS ID_MOVIE, left(repeat('Title ' || o_orderkey, 40), 250) AS TITLE,
  CASE WHEN o_orderstatus = 'P' THEN '' ELSE 'tt' || o_orderkey END AS ID_IMDB,
  CASE WHEN o_orderstatus <> 'F' THEN CAST(o_orderdate AS DATE) END AS DAT_RELEASE,
  CASE WHEN o_orderstatus = 'F' THEN 1995 ELSE CAST(year(o_orderdate) AS INTEGER) END AS RELEASE_YEAR,
  CASE WHEN o_orderstatus = 'F' THEN 'a line' END AS WIKIPEDIA_FORMAT_LINE,
  CASE o_orderpriority {" ".join(f"WHEN '{k}' THEN '{v}'" for k, v in GENRES.items())} END AS GENRES,
  o_custkey AS ID_COLLECTION, CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END AS ADULT, o_totalprice AS BUDGET,
  CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS IS_DOCUMENTARY,
  CASE WHEN floor(o_totalprice / 5000) BETWEEN 1 AND 58 THEN 1 ELSE 0 END AS IS_SHORT_FILM,
  {NOW_SQL} AS TIM_UPDATED, CASE WHEN o_orderstatus <> 'F' THEN 0 END AS DELETED
FROM orders""")
def _(spark, sf):
    return _movies(spark, sf)["movie"].select(
        "ID_MOVIE", "TITLE", "ID_IMDB", "DAT_RELEASE", "RELEASE_YEAR", "WIKIPEDIA_FORMAT_LINE", "GENRES",
        "ID_COLLECTION", "ADULT", "BUDGET", "IS_DOCUMENTARY", "IS_SHORT_FILM", "TIM_UPDATED", "DELETED",
    )


@query("g12_movie_companies", f"""
SELECT ID_MOVIE, ID_COMPANY, CAST(max(pos) AS INTEGER) AS DISPLAY_ORDER FROM (
  SELECT l_orderkey AS ID_MOVIE, l_suppkey AS ID_COMPANY, row_number() OVER (PARTITION BY l_orderkey ORDER BY {LINE_SQL}) AS pos
  FROM lineitem) GROUP BY 1, 2
UNION ALL SELECT o_orderkey, -1, NULL FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)""")
def _(spark, sf):
    return _movies(spark, sf)["movie_company"].select("ID_MOVIE", "ID_COMPANY", "DISPLAY_ORDER")


@query("g12_movie_credits", f"""
WITH x AS (SELECT *, l_partkey % 50 AS p, row_number() OVER (PARTITION BY l_orderkey, l_linestatus ORDER BY {LINE_SQL}) AS pos FROM lineitem)
SELECT {CREDIT_SQL} AS ID_CREDIT, l_orderkey AS ID_MOVIE, p AS ID_PERSON,
  CASE WHEN l_linestatus = 'F' THEN 'cast' ELSE 'crew' END AS CREDIT_TYPE,
  CASE WHEN l_linestatus = 'F' THEN 'Role ' || l_suppkey ELSE '' END AS CAST_CHARACTER,
  CASE WHEN l_linestatus = 'F' THEN '' ELSE {pick_sql(DEPARTMENTS, "l_linenumber - 1")} END AS CREW_DEPARTMENT,
  CASE WHEN l_linestatus = 'F' THEN '' ELSE l_returnflag END AS CREW_JOB,
  CAST(min(pos) OVER (PARTITION BY l_orderkey, l_linestatus, p) AS INTEGER) AS DISPLAY_ORDER FROM x""")
def _(spark, sf):
    return _movies(spark, sf)["person_movie"].select(
        "ID_CREDIT", "ID_MOVIE", "ID_PERSON", "CREDIT_TYPE", "CAST_CHARACTER", "CREW_DEPARTMENT", "CREW_JOB", "DISPLAY_ORDER"
    )


# --- series -----------------------------------------------------------------


def serie_payloads(spark, sf) -> DataFrame:
    """Persons are the order priorities 1 to 5; two creators per series, 3 and the nation."""
    person = F.substring("o_orderpriority", 1, 1).cast("bigint")
    orders = read(spark, sf, "orders").select(
        c("o_custkey").alias("c_custkey"), F.struct("o_orderkey", person.alias("person"), "o_orderstatus").alias("x")
    )
    items = orders.groupBy("c_custkey").agg(F.array_sort(F.collect_list("x")).alias("xs"))

    def credit(x: Column) -> Column:
        return F.struct(
            x["person"].alias("id"), text("", "c_custkey").alias("name"),
            F.concat(F.lit("o"), x["o_orderkey"].cast("string")).alias("credit_id"), F.lit("r").alias("character"),
            F.lit("Sound").alias("department"), F.lit("Mixer").alias("job"),
        )

    def side(cast: bool) -> Column:
        chosen = F.filter("xs", lambda x: (x["o_orderstatus"] == "F") if cast else (x["o_orderstatus"] != "F"))
        return F.transform(chosen, credit)

    rows = read(spark, sf, "customer").join(items, "c_custkey", "left")
    makers = F.array(
        F.struct(c("c_nationkey").cast("bigint").alias("id"), text("a", "c_custkey").alias("credit_id")),
        F.struct(F.lit(3).cast("bigint").alias("id"), text("b", "c_custkey").alias("credit_id")),
    )
    return landed(rows.select(
        c("c_custkey").alias("id"), c("c_name").alias("name"), F.lit("2001-02-03").alias("first_air_date"),
        c("c_mktsegment").alias("type"), F.array(F.struct(c("c_nationkey").alias("id"))).alias("networks"),
        F.struct(text("tt", "c_custkey").alias("imdb_id")).alias("external_ids"), makers.alias("created_by"),
        F.struct(side(True).alias("cast"), side(False).alias("crew")).alias("credits"),
    ), "serie")


def _series(spark, sf) -> dict[str, DataFrame]:
    old = read(spark, sf, "customer").select(
        text("old-", "c_custkey").alias("ID_CREDIT"), c("c_custkey").alias("ID_SERIE")
    )
    tables = {n: current(spark, n) for n in (
        "serie", "serie_company", "serie_genre", "serie_network", "serie_production_country", "serie_spoken_language",
    )}
    tables["person_serie"] = current(spark, "person_serie", old)
    return ingest.ingest_series(tables, serie_payloads(spark, sf), AUDIT)


@query("g13_series", f"""
SELECT c_custkey AS ID_SERIE, c_name AS TITLE, DATE '2001-02-03' AS DAT_FIRST_AIR, 2001 AS FIRST_AIR_YEAR,
  CAST(NULL AS DATE) AS DAT_LAST_AIR, c_mktsegment AS SERIE_TYPE, 'tt' || c_custkey AS ID_IMDB, {NOW_SQL} AS TIM_UPDATED
FROM customer""")
def _(spark, sf):
    return _series(spark, sf)["serie"].select(
        "ID_SERIE", "TITLE", "DAT_FIRST_AIR", "FIRST_AIR_YEAR", "DAT_LAST_AIR", "SERIE_TYPE", "ID_IMDB", "TIM_UPDATED"
    )


@query("g13_serie_credits", """
WITH x AS (SELECT o_custkey AS s, o_orderkey, CAST(left(o_orderpriority, 1) AS BIGINT) AS p, c_nationkey AS n,
    CASE WHEN o_orderstatus = 'F' THEN 'cast' ELSE 'crew' END AS kind,
    row_number() OVER (PARTITION BY o_custkey, o_orderstatus = 'F' ORDER BY o_orderkey) AS pos
  FROM orders JOIN customer ON o_custkey = c_custkey),
r AS (SELECT *, min(pos) OVER (PARTITION BY s, kind, p) AS first,
    CASE WHEN kind = 'crew' AND p IN (n, 3) THEN 1 ELSE 0 END AS made FROM x),
last AS (SELECT s, arg_max(first + made, pos + CASE WHEN kind = 'crew' THEN 1000000 ELSE 0 END) AS o FROM r GROUP BY 1),
makers AS (SELECT c_custkey AS s, 'a' || c_custkey AS cr, CAST(c_nationkey AS BIGINT) AS p, 1 AS i FROM customer
  UNION ALL SELECT c_custkey, 'b' || c_custkey, 3, 2 FROM customer),
late AS (SELECT m.*, row_number() OVER (PARTITION BY m.s ORDER BY i) AS k FROM makers m
  WHERE NOT EXISTS (SELECT 1 FROM x WHERE x.s = m.s AND x.p = m.p))
SELECT 'o' || o_orderkey AS ID_CREDIT, s AS ID_SERIE, p AS ID_PERSON, kind AS CREDIT_TYPE,
  CASE WHEN kind = 'crew' THEN 'Sound' ELSE '' END AS CREW_DEPARTMENT, CAST(first + made AS INTEGER) AS DISPLAY_ORDER FROM r
UNION ALL SELECT arg_min(cr, i), m.s, m.p, 'crew', 'Creator', CAST(min(first) AS INTEGER)
  FROM makers m JOIN r ON r.s = m.s AND r.p = m.p AND r.kind = 'crew' GROUP BY m.s, m.p
UNION ALL SELECT cr, late.s, p, 'crew', 'Creator', CAST(coalesce(o, 0) + k AS INTEGER) FROM late LEFT JOIN last ON late.s = last.s""")
def _(spark, sf):
    return _series(spark, sf)["person_serie"].select(
        "ID_CREDIT", "ID_SERIE", "ID_PERSON", "CREDIT_TYPE", "CREW_DEPARTMENT", "DISPLAY_ORDER"
    )


# --- persons ----------------------------------------------------------------


def person_payloads(spark, sf) -> DataFrame:
    media = F.when(c("o_orderstatus") == "F", "movie").when(c("o_orderstatus") == "O", "tv").otherwise("other")
    orders = read(spark, sf, "orders").select(
        c("o_custkey").alias("c_custkey"), F.struct("o_orderkey", media.alias("media"), "o_orderpriority").alias("x")
    )
    items = orders.groupBy("c_custkey").agg(F.array_sort(F.collect_list("x")).alias("xs"))

    def credit(x: Column) -> Column:
        return F.struct(
            x["media"].alias("media_type"), x["o_orderkey"].alias("id"),
            F.concat(F.lit("o"), x["o_orderkey"].cast("string")).alias("credit_id"), F.lit("r").alias("character"),
            F.lit("Art").alias("department"), x["o_orderpriority"].alias("job"),
        )

    def side(cast: bool) -> Column:
        chosen = F.filter("xs", lambda x: (x["o_orderpriority"] < "3") if cast else (x["o_orderpriority"] >= "3"))
        return F.transform(chosen, credit)

    rows = read(spark, sf, "customer").join(items, "c_custkey", "left")
    return landed(rows.select(
        c("c_custkey").alias("id"), c("c_name").alias("name"),
        F.when(c("c_acctbal") > 0, "1970-05-06").otherwise("1970").alias("birthday"),
        F.array(c("c_name"), c("c_mktsegment")).alias("also_known_as"), F.repeat(c("c_name"), 30).alias("homepage"),
        F.lit("  Paris ").alias("place_of_birth"), c("c_acctbal").alias("popularity"),
        F.struct(side(True).alias("cast"), side(False).alias("crew")).alias("combined_credits"),
    ), "person")


def _persons(spark, sf) -> dict[str, DataFrame]:
    customer, orders = read(spark, sf, "customer"), read(spark, sf, "orders")
    old = customer.select(c("c_custkey").alias("ID_PERSON"), F.lit("1900-01-01").cast("date").alias("BIRTHDAY"))
    links = orders.select(
        text("o", "o_orderkey").alias("ID_CREDIT"), c("o_orderkey").alias("ID_MOVIE"), c("o_custkey").alias("ID_PERSON"),
        F.lit(5).alias("DISPLAY_ORDER"),
    )
    tables = {
        "person": current(spark, "person", old), "person_movie": current(spark, "person_movie", links),
        "person_serie": current(spark, "person_serie"),
    }
    return ingest.ingest_persons(tables, person_payloads(spark, sf), AUDIT)


@query("g14_persons", """
SELECT c_custkey AS ID_PERSON, c_name AS NAME, CASE WHEN c_acctbal > 0 THEN DATE '1970-05-06' ELSE DATE '1900-01-01' END AS BIRTHDAY,
  CASE WHEN c_acctbal > 0 THEN 1970 ELSE 0 END AS BIRTH_YEAR, '|' || c_name || '|' || c_mktsegment || '|' AS ALSO_KNOWN_AS,
  left(repeat(c_name, 30), 250) AS HOMEPAGE_URL, 'Paris' AS PLACE_OF_BIRTH, c_acctbal AS POPULARITY FROM customer""")
def _(spark, sf):
    return _persons(spark, sf)["person"].select(
        "ID_PERSON", "NAME", "BIRTHDAY", "BIRTH_YEAR", "ALSO_KNOWN_AS", "HOMEPAGE_URL", "PLACE_OF_BIRTH", "POPULARITY"
    )


@query("g14_person_credits", """
WITH x AS (SELECT *, CASE WHEN o_orderpriority < '3' THEN 'cast' ELSE 'crew' END AS kind FROM orders)
SELECT 'movie' AS title, 'o' || o_orderkey AS ID_CREDIT, o_orderkey AS id, o_custkey AS ID_PERSON, kind AS CREDIT_TYPE,
  CASE WHEN kind = 'crew' THEN o_orderpriority ELSE '' END AS CREW_JOB, 5 AS DISPLAY_ORDER FROM x WHERE o_orderstatus = 'F'
UNION ALL SELECT 'serie', 'o' || o_orderkey, o_orderkey, o_custkey, kind,
  CASE WHEN kind = 'crew' THEN o_orderpriority ELSE '' END, NULL FROM x WHERE o_orderstatus = 'O'""")
def _(spark, sf):
    out = _persons(spark, sf)
    parts = [
        out[f"person_{t}"].select(
            F.lit(t).alias("title"), "ID_CREDIT", c(f"ID_{t.upper()}").alias("id"), "ID_PERSON", "CREDIT_TYPE",
            "CREW_JOB", "DISPLAY_ORDER",
        )
        for t in ("movie", "serie")
    ]
    return parts[0].unionByName(parts[1])


# --- language rows, keywords, small entities, lists --------------------------


@query("g15_language_rows", """
SELECT doc_id AS ID_MOVIE, lang AS LANG, CASE WHEN source = 'src3' THEN 'old' ELSE left(text, 250) END AS TITLE, text AS OVERVIEW
FROM documents""")
def _(spark, sf):
    docs = read(spark, sf, "documents")
    payloads = landed(docs.select(
        c("doc_id").alias("id"), "lang", F.when(c("source") == "src3", "").otherwise(c("text")).alias("title"),
        c("text").alias("overview"),
    ), "title_lang")
    old = docs.filter(c("source") == "src3").select(
        c("doc_id").alias("ID_MOVIE"), c("lang").alias("LANG"), F.lit("old").alias("TITLE")
    )
    tables = {"movie_lang": current(spark, "movie_lang", old)}
    rows = ingest.ingest_variants(tables, payloads, "movie", AUDIT)["movie_lang"]
    return rows.select("ID_MOVIE", "LANG", "TITLE", "OVERVIEW")


@query("g16_keyword_links", f"""
SELECT l_orderkey AS ID_MOVIE, l_partkey AS ID_KEYWORD, CAST(max(pos) AS INTEGER) AS DISPLAY_ORDER FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {LINE_SQL}) AS pos FROM lineitem) GROUP BY 1, 2
UNION ALL SELECT o_orderkey, -1, NULL FROM orders""")
def _(spark, sf):
    lines = read(spark, sf, "lineitem").groupBy(c("l_orderkey").alias("id")).agg(
        F.array_sort(F.collect_list(F.struct(*LINE))).alias("xs")
    )
    payloads = landed(lines.select(
        "id", F.transform("xs", lambda x: F.struct(x["l_partkey"].alias("id"), F.lit("k").alias("name"))).alias("keywords")
    ), "keywords")
    old = read(spark, sf, "orders").select(c("o_orderkey").alias("ID_MOVIE"), F.lit(-1).cast("bigint").alias("ID_KEYWORD"))
    tables = {"movie_keyword": current(spark, "movie_keyword", old)}
    rows = ingest.ingest_keyword_links(tables, payloads, "movie", AUDIT)["movie_keyword"]
    return rows.select("ID_MOVIE", "ID_KEYWORD", "DISPLAY_ORDER")


@query("g17_companies", """
SELECT s_suppkey AS ID_COMPANY, CASE WHEN s_acctbal < 0 THEN 'old' ELSE s_name END AS NAME,
  left(repeat(s_name, 40), 500) AS HOMEPAGE_URL, left(repeat(s_name, 40), 200) AS HEADQUARTERS, s_nationkey AS ID_PARENT FROM supplier""")
def _(spark, sf):
    supplier = read(spark, sf, "supplier")
    payloads = landed(supplier.select(
        c("s_suppkey").alias("id"), F.when(c("s_acctbal") < 0, "").otherwise(c("s_name")).alias("name"),
        F.repeat("s_name", 40).alias("homepage"), F.repeat("s_name", 40).alias("headquarters"),
        F.struct(c("s_nationkey").alias("id")).alias("parent_company"),
    ), "company")
    old = supplier.select(c("s_suppkey").alias("ID_COMPANY"), F.lit("old").alias("NAME"))
    rows = ingest.ingest_small({"company": current(spark, "company", old)}, payloads, "company", AUDIT)["company"]
    return rows.select("ID_COMPANY", "NAME", "HOMEPAGE_URL", "HEADQUARTERS", "ID_PARENT")


@query("g17_collections_networks_keywords", """
SELECT 'collection' AS kind, c_custkey AS id, c_name AS NAME FROM customer
UNION ALL SELECT 'network', n_nationkey, n_name FROM nation UNION ALL SELECT 'keyword', p_partkey, p_name FROM part""")
def _(spark, sf):
    parts = []
    for kind, table, key, name in (
        ("collection", "customer", "c_custkey", "c_name"), ("network", "nation", "n_nationkey", "n_name"),
        ("keyword", "part", "p_partkey", "p_name"),
    ):
        payloads = landed(read(spark, sf, table).select(c(key).alias("id"), c(name).alias("name")), kind)
        rows = ingest.refresh_entities({kind: current(spark, kind)}, {"main": payloads}, kind, AUDIT)[kind]
        parts.append(rows.select(F.lit(kind).alias("kind"), c(f"ID_{kind.upper()}").alias("id"), "NAME"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _list_pages(spark, sf) -> DataFrame:
    """One list per customer, one page per order year."""
    orders = read(spark, sf, "orders").select(
        "o_custkey", (F.year("o_orderdate") - 1994).alias("page"), F.struct("o_orderkey", "o_orderstatus").alias("x")
    )
    pages = orders.groupBy("o_custkey", "page").agg(F.array_sort(F.collect_list("x")).alias("xs"))
    media = lambda x: F.when(x["o_orderstatus"] == "F", "movie").otherwise("tv")
    return landed(pages.select(
        c("o_custkey").alias("id"), "page", F.lit(7).alias("total_pages"), text("List ", "o_custkey").alias("name"),
        F.transform("xs", lambda x: F.struct(x["o_orderkey"].alias("id"), media(x).alias("media_type"))).alias("items"),
    ), "list")


def _lists(spark, sf) -> dict[str, DataFrame]:
    old = read(spark, sf, "customer").select(c("c_custkey").alias("ID_LIST"), F.lit(-1).cast("bigint").alias("ID_MOVIE"))
    tables = {
        "list": current(spark, "list"), "movie_list": current(spark, "movie_list", old),
        "serie_list": current(spark, "serie_list"),
    }
    return ingest.ingest_lists(tables, _list_pages(spark, sf), AUDIT)


_LIST_ITEMS = """
WITH x AS (SELECT o_custkey AS ID_LIST, o_orderkey, o_orderstatus, CAST(row_number() OVER (
    PARTITION BY o_custkey ORDER BY year(o_orderdate), o_orderkey) AS INTEGER) AS DISPLAY_ORDER FROM orders)"""


@query("g18_lists", """
SELECT DISTINCT o_custkey AS ID_LIST, 'List ' || o_custkey AS NAME FROM orders WHERE year(o_orderdate) = 1995""")
def _(spark, sf):
    return _lists(spark, sf)["list"].select("ID_LIST", "NAME")


@query("g18_movie_list", f"""{_LIST_ITEMS}
SELECT ID_LIST, o_orderkey AS ID_MOVIE, DISPLAY_ORDER FROM x WHERE o_orderstatus = 'F'
UNION ALL SELECT c_custkey, -1, NULL FROM customer WHERE c_custkey NOT IN (SELECT ID_LIST FROM x WHERE o_orderstatus = 'F')""")
def _(spark, sf):
    return _lists(spark, sf)["movie_list"].select("ID_LIST", "ID_MOVIE", "DISPLAY_ORDER")


@query("g18_serie_list", f"""{_LIST_ITEMS}
SELECT ID_LIST, o_orderkey AS ID_SERIE, DISPLAY_ORDER FROM x WHERE o_orderstatus <> 'F'""")
def _(spark, sf):
    return _lists(spark, sf)["serie_list"].select("ID_LIST", "ID_SERIE", "DISPLAY_ORDER")


# --- images, videos, whole entities, tombstones ------------------------------


def image_payloads(spark, sf) -> DataFrame:
    lines = read(spark, sf, "lineitem").groupBy(c("l_orderkey").alias("id")).agg(
        F.array_sort(F.collect_list(F.struct(*LINE, "l_returnflag"))).alias("xs")
    )

    def side(letter: str) -> Column:
        chosen = F.filter("xs", lambda x: x["l_returnflag"] == letter)
        path = lambda x: F.when(
            x["l_linenumber"] != 3, F.concat(F.lit("/"), x["l_partkey"].cast("string"), F.lit("-"), x["l_suppkey"].cast("string"))
        )
        return F.transform(chosen, lambda x: F.struct(path(x).alias("file_path"), x["l_linenumber"].alias("width")))

    return landed(lines.select(
        "id", side("A").alias("backdrops"), side("N").alias("posters"), side("R").alias("logos")
    ), "images")


@query("g19_images", f"""
WITH x AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_returnflag ORDER BY {LINE_SQL}) AS pos FROM lineitem),
y AS (SELECT l_orderkey AS ID_MOVIE, CASE l_returnflag WHEN 'A' THEN 'backdrop' WHEN 'N' THEN 'poster' ELSE 'logo' END AS TYPE_IMAGE,
    '/' || l_partkey || '-' || l_suppkey AS IMAGE_PATH, pos, l_linenumber FROM x WHERE l_linenumber <> 3)
SELECT ID_MOVIE, TYPE_IMAGE, IMAGE_PATH, CAST(max(pos) AS INTEGER) AS DISPLAY_ORDER, arg_max(l_linenumber, pos) AS WIDTH FROM y GROUP BY 1, 2, 3
UNION ALL SELECT o_orderkey, 'poster', '/old', 1, NULL FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)""")
def _(spark, sf):
    orders = read(spark, sf, "orders").select(c("o_orderkey").alias("ID_MOVIE"))
    old = orders.select("ID_MOVIE", F.lit("poster").alias("TYPE_IMAGE"), F.lit("/old").alias("IMAGE_PATH"), F.lit(1).alias("DISPLAY_ORDER"))
    tables = {"movie": current(spark, "movie", orders), "movie_image": current(spark, "movie_image", old)}
    rows = ingest.ingest_images(tables, image_payloads(spark, sf), "movie", AUDIT)["movie_image"]
    return rows.select("ID_MOVIE", "TYPE_IMAGE", "IMAGE_PATH", "DISPLAY_ORDER", "WIDTH")


@query("g20_videos", """
WITH x AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS pos FROM events)
SELECT user_id AS ID_MOVIE, 'fr' AS LANG, 'v' || event_id AS ID_CREDIT,
  date_trunc('second', ts) AT TIME ZONE 'UTC' AT TIME ZONE 'Europe/Paris' AS DAT_PUBLISHED, event_type AS VIDEO_TYPE,
  CAST(floor(value) AS INTEGER) AS QUALITY, CAST(floor(value) AS INTEGER) || 'p' AS QUALITY_TEXT,
  CASE WHEN event_type = 'click' THEN 1 ELSE 0 END AS OFFICIAL, CAST(pos AS INTEGER) AS DISPLAY_ORDER
FROM x WHERE event_type <> 'error'""")
def _(spark, sf):
    stamp = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit(".000Z"))
    video = F.struct(
        "event_id", F.when(c("event_type") != "error", text("v", "event_id")).alias("id"), stamp.alias("published_at"),
        c("event_type").alias("type"), F.floor("value").cast("int").alias("size"),
        (c("event_type") == "click").alias("official"),
    )
    events = read(spark, sf, "events").groupBy(c("user_id").alias("id")).agg(
        F.array_sort(F.collect_list(video)).alias("results")
    )
    payloads = landed(events.withColumn("lang", F.lit("fr")), "videos")
    old = events.select(c("id").alias("ID_MOVIE"), F.lit("fr").alias("LANG"), F.lit("gone").alias("ID_CREDIT"))
    tables = {
        "movie": current(spark, "movie", events.select(c("id").alias("ID_MOVIE"))),
        "movie_video": current(spark, "movie_video", old),
    }
    rows = ingest.ingest_videos(tables, payloads, "movie", AUDIT)["movie_video"]
    return rows.select(
        "ID_MOVIE", "LANG", "ID_CREDIT", "DAT_PUBLISHED", "VIDEO_TYPE", "QUALITY", "QUALITY_TEXT", "OFFICIAL", "DISPLAY_ORDER"
    )


@query("g21_refresh_movies", f"""
SELECT o_orderkey AS ID_MOVIE, left(repeat('Title ' || o_orderkey, 40), 250) AS TITLE, {NOW_SQL} AS TIM_CREDITS_COMPLETED,
  CASE WHEN o_orderkey IN (SELECT l_orderkey FROM lineitem) THEN {NOW_SQL} END AS TIM_IMAGES_COMPLETED,
  CAST(NULL AS TIMESTAMP) AS TIM_VIDEOS_COMPLETED FROM orders""")
def _(spark, sf):
    tables = {**_movie_tables(spark, sf), "movie_image": current(spark, "movie_image")}
    landed_now = {"main": movie_payloads(spark, sf), "images": image_payloads(spark, sf)}
    rows = ingest.refresh_titles(tables, landed_now, "movie", AUDIT)["movie"]
    return rows.select("ID_MOVIE", "TITLE", "TIM_CREDITS_COMPLETED", "TIM_IMAGES_COMPLETED", "TIM_VIDEOS_COMPLETED")


@query("g22_remove_gone", """
WITH gone AS (SELECT s_suppkey FROM supplier WHERE s_acctbal < 1000)
SELECT 'person' AS tab, CAST(s_suppkey AS VARCHAR) AS id FROM supplier WHERE s_suppkey NOT IN (SELECT s_suppkey FROM gone)
UNION ALL SELECT 'person_movie', l_orderkey || '-' || l_linenumber FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM gone)""")
def _(spark, sf):
    supplier = read(spark, sf, "supplier").withColumnRenamed("s_suppkey", "ID_PERSON")
    credits = read(spark, sf, "lineitem").withColumnRenamed("l_suppkey", "ID_PERSON")
    tables = {"person": supplier, "person_movie": credits, "movie": read(spark, sf, "orders")}
    left = ingest.remove_gone(tables, supplier.filter(c("s_acctbal") < 1000), "person")
    person = left["person"].select(F.lit("person").alias("tab"), c("ID_PERSON").cast("string").alias("id"))
    credit = F.concat_ws("-", c("l_orderkey").cast("string"), c("l_linenumber").cast("string"))
    return person.unionByName(left["person_movie"].select(F.lit("person_movie").alias("tab"), credit.alias("id")))
