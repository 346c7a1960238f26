"""A catalogue derived from the driver tables, as DataFrames and as SQL.

Orders play the movies, customers the series and persons, parts the keywords,
suppliers the companies, nations the networks and lists.  Line items link them.
Every table covers all rows of its source, so the work grows with the data.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.columns import flag
from ..plans import publish
from .operator_queries import FORMAT_LINES, pick, pick_sql
from .registry import read

c = F.col
GENRES = {
    "1-URGENT": "|Drama|Documentary|", "2-HIGH": "|Comedy|", "3-MEDIUM": "|Science Fiction|Action|",
    "4-NOT SPECIFIED": "|TV Movie|Unknown|", "5-LOW": "|",
}
DEPARTMENTS = ["Directing", "Writing", "Production", "Editing", "Art", "Sound", "Choir"]
SECTIONS = [
    "Intro", "Plot", "Synopsis", "Cast", "Music", "Voice cast", "Premise", "Soundtrack", "Trivia",
    "Reception", "Release", "Production",
]
PROPERTIES = ["P31", "P136", "P921", "P840", "P166", "P135", "P9215"]


def case(column: str, mapping: dict[str, str]) -> Column:
    out = F.lit(None).cast("string")
    for k, v in mapping.items():
        out = F.when(c(column) == k, F.lit(v)).otherwise(out)
    return out


def text(prefix: str, column: str) -> Column:
    return F.concat(F.lit(prefix), c(column).cast("string"))


def filled(rows: DataFrame, table: str, columns: list[str], key: str) -> DataFrame:
    """Rows with a value made from the key in every listed column that they lack."""
    made = {
        "string": F.concat(F.lit("some text "), c(key).cast("string")), "int": F.pmod(c(key), F.lit(97)).cast("int"),
        "bigint": c(key) + 7, "double": c(key) / 4.0, "date": F.date_add(F.lit("2000-01-01").cast("date"), F.pmod(c(key), F.lit(1000)).cast("int")),
    }
    made["timestamp_ntz"] = made["date"].cast("timestamp_ntz")
    kinds = {f.name: f.dataType.simpleString() for f in schemas.empty_table(rows.sparkSession, table).schema}
    return rows.select("*", *[made[kinds[n]].alias(n) for n in columns if n not in rows.columns])


def filled_sql(table: str, columns: list[str], have: str, key: str) -> str:
    """The same values as select items; ``have`` names the columns the rows have."""
    day = f"CAST(DATE '2000-01-01' + CAST({key} % 1000 AS INTEGER) AS DATE)"
    made = {
        "string": f"'some text ' || {key}", "int": f"CAST({key} % 97 AS INTEGER)", "bigint": f"{key} + 7", "double": f"{key} / 4.0",
        "date": day, "timestamp_ntz": f"CAST({day} AS TIMESTAMP)",
    }
    kinds = dict(x.split() for x in schemas.TABLES[table].split(", "))
    return "".join(f", {made[kinds[n]]} AS {n}" for n in columns if n not in have.split())


def _movie(t: Callable[[str], DataFrame]) -> DataFrame:
    status, priority = c("o_orderstatus"), c("o_orderpriority")
    documentary = priority == "1-URGENT"
    minutes = F.floor(c("o_totalprice") / 5000).cast("int")
    day = c("o_orderdate").cast("date")
    empty = F.lit(None)
    return t("orders").select(
        c("o_orderkey").alias("ID_MOVIE"), text("Title ", "o_orderkey").alias("TITLE"),
        F.when(status == "F", text("Original ", "o_orderkey")).otherwise(text("Title ", "o_orderkey")).alias("ORIGINAL_TITLE"),
        F.when(status == "F", "fr").when(status == "O", "en").otherwise("de").alias("ORIGINAL_LANGUAGE"),
        text("An overview of order ", "o_orderkey").alias("OVERVIEW"), F.lit("").alias("TAGLINE"),
        status.alias("STATUS"), case("o_orderpriority", GENRES).alias("GENRES"),
        F.when(status == "P", "").otherwise(text("tt", "o_orderkey")).alias("ID_IMDB"),
        F.when(priority == "5-LOW", "").otherwise(text("Q", "o_orderkey")).alias("ID_WIKIDATA"),
        flag((priority == "4-NOT SPECIFIED") & (status == "O")).alias("ADULT"),
        c("o_custkey").alias("ID_COLLECTION"), F.lit(0).alias("VIDEO"), day.alias("DAT_RELEASE"),
        F.year(day).alias("RELEASE_YEAR"), F.month(day).alias("RELEASE_MONTH"), F.dayofmonth(day).alias("RELEASE_DAY"),
        c("o_totalprice").alias("POPULARITY"), empty.cast("double").alias("VOTE_AVERAGE"),
        empty.cast("int").alias("VOTE_COUNT"), minutes.alias("RUNTIME"),
        flag(~documentary).alias("IS_MOVIE"), flag(documentary).alias("IS_DOCUMENTARY"),
        flag(minutes.between(1, 58)).alias("IS_SHORT_FILM"),
        F.when(priority == "2-HIGH", F.lit(None)).otherwise(pick(FORMAT_LINES, c("o_custkey"))).alias("WIKIPEDIA_FORMAT_LINE"),
        *[empty.cast("int").alias(n) for n in ("IS_COLOR", "IS_BLACK_AND_WHITE", "IS_SILENT", "IS_3D", "IS_VALID_FORMAT")],
        *[empty.cast("string").alias(n) for n in ("COLOR_TECHNOLOGY", "FILM_TECHNOLOGY", "SOUND_TECHNOLOGY",
                                                  "SOUND_SYSTEM", "ASPECT_RATIO", "FILM_FORMAT")],
        empty.cast("bigint").alias("NUM_AUDIO_TRACKS"), F.lit(0).alias("DELETED"),
        empty.cast("timestamp_ntz").alias("TIM_UPDATED"),
    )


_MOVIE_HAS = """ID_MOVIE TITLE ORIGINAL_TITLE ORIGINAL_LANGUAGE OVERVIEW TAGLINE STATUS GENRES ID_IMDB ID_WIKIDATA ADULT
ID_COLLECTION VIDEO DAT_RELEASE RELEASE_YEAR RELEASE_MONTH RELEASE_DAY POPULARITY VOTE_AVERAGE VOTE_COUNT RUNTIME IS_MOVIE
IS_DOCUMENTARY IS_SHORT_FILM WIKIPEDIA_FORMAT_LINE IS_COLOR IS_BLACK_AND_WHITE IS_SILENT IS_3D IS_VALID_FORMAT COLOR_TECHNOLOGY
FILM_TECHNOLOGY SOUND_TECHNOLOGY SOUND_SYSTEM ASPECT_RATIO FILM_FORMAT NUM_AUDIO_TRACKS DELETED TIM_UPDATED"""
MOVIE_SQL = f"""
SELECT o_orderkey AS ID_MOVIE, 'Title ' || o_orderkey AS TITLE,
  CASE WHEN o_orderstatus = 'F' THEN 'Original ' ELSE 'Title ' END || o_orderkey AS ORIGINAL_TITLE,
  CASE o_orderstatus WHEN 'F' THEN 'fr' WHEN 'O' THEN 'en' ELSE 'de' END AS ORIGINAL_LANGUAGE,
  'An overview of order ' || o_orderkey AS OVERVIEW,
  CASE o_orderpriority {" ".join(f"WHEN '{k}' THEN '{v}'" for k, v in GENRES.items())} END AS GENRES,
  CASE WHEN o_orderstatus = 'P' THEN '' ELSE 'tt' || o_orderkey END AS ID_IMDB,
  CASE WHEN o_orderpriority = '5-LOW' THEN '' ELSE 'Q' || o_orderkey END AS ID_WIKIDATA,
  CASE WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'O' THEN 1 ELSE 0 END AS ADULT,
  o_custkey AS ID_COLLECTION, CAST(o_orderdate AS DATE) AS DAT_RELEASE, o_totalprice AS POPULARITY,
  CAST(floor(o_totalprice / 5000) AS INTEGER) AS RUNTIME,
  CASE WHEN o_orderpriority = '1-URGENT' THEN 0 ELSE 1 END AS IS_MOVIE,
  CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS IS_DOCUMENTARY,
  CASE WHEN o_orderpriority = '2-HIGH' THEN NULL ELSE {pick_sql(FORMAT_LINES, "o_custkey")} END AS WIKIPEDIA_FORMAT_LINE,
  '' AS TAGLINE, o_orderstatus AS STATUS, 0 AS VIDEO, CAST(year(o_orderdate) AS INTEGER) AS RELEASE_YEAR,
  CAST(month(o_orderdate) AS INTEGER) AS RELEASE_MONTH, CAST(day(o_orderdate) AS INTEGER) AS RELEASE_DAY,
  CAST(NULL AS DOUBLE) AS VOTE_AVERAGE, CAST(NULL AS INTEGER) AS VOTE_COUNT,
  CASE WHEN floor(o_totalprice / 5000) BETWEEN 1 AND 58 THEN 1 ELSE 0 END AS IS_SHORT_FILM,
  CAST(NULL AS INTEGER) AS IS_COLOR, CAST(NULL AS INTEGER) AS IS_BLACK_AND_WHITE, CAST(NULL AS INTEGER) AS IS_SILENT,
  CAST(NULL AS INTEGER) AS IS_3D, CAST(NULL AS VARCHAR) AS COLOR_TECHNOLOGY, CAST(NULL AS VARCHAR) AS FILM_TECHNOLOGY,
  CAST(NULL AS VARCHAR) AS SOUND_TECHNOLOGY, CAST(NULL AS VARCHAR) AS SOUND_SYSTEM, CAST(NULL AS VARCHAR) AS ASPECT_RATIO,
  CAST(NULL AS VARCHAR) AS FILM_FORMAT, 0 AS DELETED, CAST(NULL AS TIMESTAMP) AS TIM_UPDATED
  {filled_sql("movie", publish.MOVIE_COLUMNS, _MOVIE_HAS, "o_orderkey")}
FROM orders"""


def _serie(t: Callable[[str], DataFrame]) -> DataFrame:
    segment = c("c_mktsegment")
    return t("customer").select(
        c("c_custkey").alias("ID_SERIE"), text("Serie ", "c_custkey").alias("TITLE"),
        F.when(c("c_acctbal") < 0, "").otherwise(text("tt", "c_custkey")).alias("ID_IMDB"),
        F.when(c("c_nationkey") < 2, "").otherwise(text("Q", "c_custkey")).alias("ID_WIKIDATA"),
        flag(segment == "BUILDING").alias("ADULT"), c("c_acctbal").alias("POPULARITY"),
        F.when(segment == "MACHINERY", "Documentary").when(segment == "HOUSEHOLD", F.lit(None))
        .otherwise("Scripted").alias("SERIE_TYPE"), F.lit(0).alias("DELETED"),
    )


SERIE_SQL = f"""
SELECT c_custkey AS ID_SERIE, 'Serie ' || c_custkey AS TITLE,
  CASE WHEN c_acctbal < 0 THEN '' ELSE 'tt' || c_custkey END AS ID_IMDB,
  CASE WHEN c_nationkey < 2 THEN '' ELSE 'Q' || c_custkey END AS ID_WIKIDATA,
  CASE WHEN c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END AS ADULT, c_acctbal AS POPULARITY,
  CASE c_mktsegment WHEN 'MACHINERY' THEN 'Documentary' WHEN 'HOUSEHOLD' THEN NULL ELSE 'Scripted' END AS SERIE_TYPE,
  0 AS DELETED {filled_sql("serie", publish.SERIE_COLUMNS, "ID_SERIE TITLE ID_IMDB ID_WIKIDATA ADULT POPULARITY SERIE_TYPE DELETED", "c_custkey")}
FROM customer"""


def _person(t: Callable[[str], DataFrame]) -> DataFrame:
    return t("customer").join(
        t("part").select(c("p_partkey").alias("c_custkey"), "p_name"), "c_custkey", "left"
    ).select(
        c("c_custkey").alias("ID_PERSON"),
        F.when(c("c_acctbal") < -900, F.coalesce("p_name", "c_name")).otherwise(c("c_name")).alias("NAME"),
        F.when(c("c_mktsegment") == "FURNITURE", "").otherwise(text("nm", "c_custkey")).alias("ID_IMDB"),
        F.when(c("c_nationkey") < 3, "").otherwise(text("Q", "c_custkey")).alias("ID_WIKIDATA"),
        flag(c("c_mktsegment") == "BUILDING").alias("ADULT"), c("c_acctbal").alias("POPULARITY"),
        F.lit(0).alias("DELETED"),
    )


PERSON_SQL = f"""
SELECT c_custkey AS ID_PERSON, CASE WHEN c_acctbal < -900 THEN coalesce(p_name, c_name) ELSE c_name END AS NAME,
  CASE WHEN c_mktsegment = 'FURNITURE' THEN '' ELSE 'nm' || c_custkey END AS ID_IMDB,
  CASE WHEN c_nationkey < 3 THEN '' ELSE 'Q' || c_custkey END AS ID_WIKIDATA,
  CASE WHEN c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END AS ADULT, c_acctbal AS POPULARITY, 0 AS DELETED
  {filled_sql("person", publish.PERSON_COLUMNS, "ID_PERSON NAME ID_IMDB ID_WIKIDATA ADULT POPULARITY DELETED", "c_custkey")}
FROM customer LEFT JOIN part ON c_custkey = p_partkey"""


def _link(t: Callable[[str], DataFrame], parent: str, name: str, child: str, child_name: str) -> DataFrame:
    """Distinct links with a display order, some of it missing, and a deleted mark."""
    rows = t("lineitem")
    if parent == "o_custkey":
        rows = rows.join(t("orders").select(c("o_orderkey").alias("l_orderkey"), "o_custkey"), "l_orderkey")
    low = F.min("l_linenumber")
    return rows.groupBy(c(parent).alias(name), c(child).alias(child_name)).agg(
        F.when(F.min("l_quantity") >= 10, low).alias("DISPLAY_ORDER"), flag(F.min("l_tax") >= 0.08).alias("DELETED")
    )


def _link_sql(parent: str, name: str, child: str, child_name: str) -> str:
    source = "lineitem JOIN orders ON l_orderkey = o_orderkey" if parent == "o_custkey" else "lineitem"
    return (
        f"SELECT {parent} AS {name}, {child} AS {child_name}, CASE WHEN min(l_quantity) >= 10 THEN min(l_linenumber) END "
        f"AS DISPLAY_ORDER, CASE WHEN min(l_tax) >= 0.08 THEN 1 ELSE 0 END AS DELETED FROM {source} GROUP BY 1, 2"
    )


def _credits(t: Callable[[str], DataFrame], parent: str, name: str) -> DataFrame:
    rows = t("lineitem")
    if parent == "o_custkey":
        rows = rows.join(t("orders").select(c("o_orderkey").alias("l_orderkey"), "o_custkey"), "l_orderkey")
    credit = F.concat_ws(
        "-", *[c(n).cast("string") for n in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")],
        F.round(c("l_extendedprice") * 100).cast("bigint").cast("string"), F.date_format("l_shipdate", "yyyyMMdd"),
    )
    cast = c("l_linestatus") == "F"
    return rows.select(
        credit.alias("ID_CREDIT"), c("l_partkey").alias("ID_PERSON"), c(parent).alias(name),
        F.when(cast, "cast").otherwise("crew").alias("CREDIT_TYPE"),
        F.when(cast, F.concat(F.lit("Role "), c("l_suppkey").cast("string"))).otherwise("").alias("CAST_CHARACTER"),
        F.when(cast, "").otherwise(pick(DEPARTMENTS, c("l_linenumber") - 1)).alias("CREW_DEPARTMENT"),
        F.when(cast, "").when(c("l_returnflag") == "A", "Director").otherwise("Assistant").alias("CREW_JOB"),
        c("l_linenumber").alias("DISPLAY_ORDER"),
    )


def _credits_sql(parent: str, name: str) -> str:
    source = "lineitem JOIN orders ON l_orderkey = o_orderkey" if parent == "o_custkey" else "lineitem"
    return f"""
SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(round(l_extendedprice * 100) AS BIGINT),
    strftime(l_shipdate, '%Y%m%d')) AS ID_CREDIT, l_partkey AS ID_PERSON, {parent} AS {name},
  CASE WHEN l_linestatus = 'F' THEN 'cast' ELSE 'crew' END AS CREDIT_TYPE,
  CASE WHEN l_linestatus = 'F' THEN 'Role ' || l_suppkey ELSE '' END AS CAST_CHARACTER,
  CASE WHEN l_linestatus = 'F' THEN '' ELSE {pick_sql(DEPARTMENTS, "l_linenumber - 1")} END AS CREW_DEPARTMENT,
  CASE WHEN l_linestatus = 'F' THEN '' WHEN l_returnflag = 'A' THEN 'Director' ELSE 'Assistant' END AS CREW_JOB,
  l_linenumber AS DISPLAY_ORDER FROM {source}"""


def _builders(spark: SparkSession, sf: str) -> dict[str, Callable[[], DataFrame]]:
    def t(name: str) -> DataFrame:
        return read(spark, sf, name)

    none = F.lit(None)
    return {
        "movie": lambda: filled(_movie(t), "movie", publish.MOVIE_COLUMNS, "ID_MOVIE"),
        "serie": lambda: filled(_serie(t), "serie", publish.SERIE_COLUMNS, "ID_SERIE"),
        "person": lambda: filled(_person(t), "person", publish.PERSON_COLUMNS, "ID_PERSON"),
        "keyword": lambda: t("part").select(
            c("p_partkey").alias("ID_KEYWORD"), c("p_name").alias("NAME"),
            none.cast("bigint").alias("MOVIE_COUNT"), none.cast("bigint").alias("SERIE_COUNT"),
            none.cast("int").alias("NAME_WORD_COUNT"), none.cast("int").alias("IS_EMPTY"),
            none.cast("int").alias("IS_PERSON"), flag(c("p_size") > 20).alias("USE_FOR_TAGGING"),
            none.cast("int").alias("USED_FOR_SIMILARITY"),
        ),
        "keyword_lang": lambda: t("part").filter(c("p_type") != "LARGE").select(
            c("p_partkey").alias("ID_KEYWORD"), F.lit("fr").alias("LANG"), F.concat(F.lit("mot "), "p_name").alias("NAME")
        ),
        "company": lambda: filled(t("supplier").select(
            c("s_suppkey").alias("ID_COMPANY"), c("s_name").alias("NAME"), F.lit("").alias("HOMEPAGE_URL"),
            none.cast("bigint").alias("MOVIE_COUNT"), none.cast("bigint").alias("SERIE_COUNT"),
            none.cast("int").alias("USED_FOR_SIMILARITY"), F.lit(0).alias("DELETED"),
        ), "company", publish.COMPANY_COLUMNS, "ID_COMPANY"),
        "network": lambda: filled(t("nation").select(
            c("n_nationkey").cast("bigint").alias("ID_NETWORK"), c("n_name").alias("NAME"),
            none.cast("bigint").alias("SERIE_COUNT"), F.lit(0).alias("DELETED"),
        ), "network", publish.NETWORK_COLUMNS, "ID_NETWORK"),
        "movie_keyword": lambda: _link(t, "l_orderkey", "ID_MOVIE", "l_partkey", "ID_KEYWORD"),
        "serie_keyword": lambda: _link(t, "o_custkey", "ID_SERIE", "l_partkey", "ID_KEYWORD"),
        "movie_company": lambda: _link(t, "l_orderkey", "ID_MOVIE", "l_suppkey", "ID_COMPANY"),
        "serie_company": lambda: _link(t, "o_custkey", "ID_SERIE", "l_suppkey", "ID_COMPANY"),
        "serie_network": lambda: t("customer").filter(c("c_acctbal") > 0).select(
            c("c_custkey").alias("ID_SERIE"), c("c_nationkey").cast("bigint").alias("ID_NETWORK")
        ),
        "list": lambda: t("nation").select(
            c("n_nationkey").cast("bigint").alias("ID_LIST"), c("n_name").alias("NAME"),
            F.when(c("n_regionkey") == 1, F.lower("n_name")).alias("SHORT_NAME"),
            F.concat(F.lit("All of "), "n_name").alias("DESCRIPTION"), F.lit("/p").alias("POSTER_PATH"),
            flag(c("n_regionkey") != 2).alias("USE_FOR_TAGGING"), F.lit(0).alias("DELETED"),
        ),
        "list_lang": lambda: t("nation").filter(c("n_regionkey") != 3).select(
            c("n_nationkey").cast("bigint").alias("ID_LIST"), F.lit("fr").alias("LANG"),
            F.concat(F.lit("liste "), "n_name").alias("SHORT_NAME"), F.lit(0).alias("DELETED"),
        ),
        "movie_list": lambda: t("orders").join(
            t("customer").select(c("c_custkey").alias("o_custkey"), "c_nationkey"), "o_custkey"
        ).select(
            c("o_orderkey").alias("ID_MOVIE"), c("c_nationkey").cast("bigint").alias("ID_LIST"),
            F.when(c("o_orderstatus") != "O", F.dayofmonth("o_orderdate")).alias("DISPLAY_ORDER"),
            flag(c("o_totalprice") < 20000).alias("DELETED"),
        ),
        "serie_list": lambda: t("customer").select(
            c("c_custkey").alias("ID_SERIE"), c("c_nationkey").cast("bigint").alias("ID_LIST"),
            none.cast("int").alias("DISPLAY_ORDER"), F.lit(0).alias("DELETED"),
        ),
        "collection": lambda: t("customer").select(
            c("c_custkey").alias("ID_COLLECTION"), c("c_name").alias("NAME"), F.lit("about").alias("OVERVIEW"),
            F.lit("/c").alias("POSTER_PATH"),
        ),
        "collection_lang": lambda: t("customer").filter(c("c_mktsegment") != "MACHINERY").select(
            c("c_custkey").alias("ID_COLLECTION"), F.lit("fr").alias("LANG"),
            F.when(c("c_nationkey") < 5, "").otherwise(F.concat(F.lit("fr "), "c_name")).alias("NAME"),
            F.lit("sur").alias("OVERVIEW"), F.lit("/f").alias("POSTER_PATH"),
        ),
        "topic": lambda: t("customer").filter(c("c_nationkey") != 7).select(
            c("c_custkey").alias("ID_TOPIC"), F.lit("collection").alias("TOPIC_TYPE"),
            c("c_custkey").alias("ID_RECORD"), F.lit("en").alias("LANG"),
        ),
        "rating": lambda: t("part").select(
            text("tt", "p_partkey").alias("tconst"), (c("p_size") / 5.0).alias("averageRating")
        ),
        "movie_lang": lambda: t("orders").filter(c("o_orderpriority") != "3-MEDIUM").select(
            c("o_orderkey").alias("ID_MOVIE"), F.lit("fr").alias("LANG"),
            F.when(c("o_orderstatus") == "F", text("Titre ", "o_orderkey")).otherwise(text("Title ", "o_orderkey")).alias("TITLE"),
            text("Le résumé de la commande ", "o_orderkey").alias("OVERVIEW"),
        ),
        "serie_lang": lambda: t("customer").filter(c("c_nationkey") > 4).select(
            c("c_custkey").alias("ID_SERIE"), F.lit("fr").alias("LANG"), text("Série ", "c_custkey").alias("TITLE")
        ),
        "wikidata_movie": lambda: t("part").select(
            text("Q", "p_partkey").alias("ID_WIKIDATA"), c("p_name").alias("TITLE"),
            F.concat(F.lit("|"), "p_name", F.lit("|Title "), c("p_partkey").cast("string"), F.lit("|")).alias("ALIASES"),
            F.lit("Q11424").alias("INSTANCE_OF"), F.lit("k").alias("PLEX_MEDIA_KEY"),
            F.when(c("p_size") > 45, c("p_partkey")).alias("ID_CRITERION"),
            F.when(c("p_size") > 48, c("p_partkey")).alias("ID_CRITERION_SPINE"),
        ),
        "wikidata_serie": lambda: t("part").select(
            text("Q", "p_partkey").alias("ID_WIKIDATA"), c("p_name").alias("TITLE"), c("p_brand").alias("ALIASES"),
            F.lit("k").alias("PLEX_MEDIA_KEY"), F.lit("Q5398426").alias("INSTANCE_OF"),
        ),
        "wikidata_person": lambda: t("part").select(
            text("Q", "p_partkey").alias("ID_WIKIDATA"), c("p_name").alias("NAME"),
            F.when(c("p_size") > 10, F.concat(F.lit("|"), "p_brand", F.lit("|"))).alias("ALIASES"),
            F.lit("Q5").alias("INSTANCE_OF"),
        ),
        "person_movie": lambda: _credits(t, "l_orderkey", "ID_MOVIE"),
        "person_serie": lambda: _credits(t, "o_custkey", "ID_SERIE"),
        "page_section": lambda: t("conversations").select(
            text("Q", "conv_id").alias("ID_WIKIDATA"), F.lit("en").alias("LANG"), F.lit("movie").alias("ITEM_TYPE"),
            c("turn").alias("DISPLAY_ORDER"), pick(SECTIONS, F.length("text")).alias("TITLE"), c("text").alias("CONTENT"),
        ),
        "item_property": lambda: t("lineitem").groupBy(
            text("Q", "l_orderkey").alias("ID_WIKIDATA"), pick(PROPERTIES, c("l_linenumber") - 1).alias("ID_PROPERTY"),
            text("I", "l_partkey").alias("ID_ITEM"),
        ).agg(F.min("l_linenumber").alias("DISPLAY_ORDER")),
        "item": lambda: t("part").filter(c("p_size") > 5).select(
            text("I", "p_partkey").alias("ID_WIKIDATA"), F.when(c("p_type") == "PROMO", "fr").otherwise("en").alias("LANG"),
            c("p_name").alias("LABEL"),
        ),
        "lang_lang": lambda: t("region").select(
            pick(["fr", "en", "es", "it", "pt"], c("r_regionkey")).alias("LANG"), F.lit("fr").alias("LANG_DISPLAY"),
            pick(["français", "anglais", "espagnol", "italien", "portugais"], c("r_regionkey")).alias("DESCRIPTION"),
        ),
    }


class Catalogue(dict):
    """Tables by name, built on first use."""

    def __init__(self, spark: SparkSession, sf: str):
        super().__init__()
        self._make = _builders(spark, sf)

    def __missing__(self, name: str) -> DataFrame:
        self[name] = self._make[name]()
        return self[name]


SQL = {
    "movie": MOVIE_SQL, "serie": SERIE_SQL, "person": PERSON_SQL,
    "keyword": "SELECT p_partkey AS ID_KEYWORD, p_name AS NAME, CASE WHEN p_size > 20 THEN 1 ELSE 0 END AS USE_FOR_TAGGING FROM part",
    "company": "SELECT s_suppkey AS ID_COMPANY, s_name AS NAME, '' AS HOMEPAGE_URL, 0 AS DELETED"
    + filled_sql("company", publish.COMPANY_COLUMNS, "ID_COMPANY NAME HOMEPAGE_URL MOVIE_COUNT SERIE_COUNT DELETED", "s_suppkey")
    + " FROM supplier",
    "network": "SELECT CAST(n_nationkey AS BIGINT) AS ID_NETWORK, n_name AS NAME, 0 AS DELETED"
    + filled_sql("network", publish.NETWORK_COLUMNS, "ID_NETWORK NAME SERIE_COUNT DELETED", "n_nationkey") + " FROM nation",
    "movie_keyword": _link_sql("l_orderkey", "ID_MOVIE", "l_partkey", "ID_KEYWORD"),
    "serie_keyword": _link_sql("o_custkey", "ID_SERIE", "l_partkey", "ID_KEYWORD"),
    "movie_company": _link_sql("l_orderkey", "ID_MOVIE", "l_suppkey", "ID_COMPANY"),
    "serie_company": _link_sql("o_custkey", "ID_SERIE", "l_suppkey", "ID_COMPANY"),
    "serie_network": "SELECT c_custkey AS ID_SERIE, CAST(c_nationkey AS BIGINT) AS ID_NETWORK FROM customer WHERE c_acctbal > 0",
    "list": """SELECT CAST(n_nationkey AS BIGINT) AS ID_LIST, n_name AS NAME, 'All of ' || n_name AS DESCRIPTION,
  '/p' AS POSTER_PATH, CASE WHEN n_regionkey <> 2 THEN 1 ELSE 0 END AS USE_FOR_TAGGING FROM nation""",
    "list_lang": """SELECT CAST(n_nationkey AS BIGINT) AS ID_LIST, 'fr' AS LANG, 'liste ' || n_name AS SHORT_NAME
FROM nation WHERE n_regionkey <> 3""",
    "movie_list": """SELECT o_orderkey AS ID_MOVIE, CAST(c_nationkey AS BIGINT) AS ID_LIST,
  CASE WHEN o_orderstatus <> 'O' THEN CAST(day(o_orderdate) AS INTEGER) END AS DISPLAY_ORDER,
  CASE WHEN o_totalprice < 20000 THEN 1 ELSE 0 END AS DELETED FROM orders JOIN customer ON o_custkey = c_custkey""",
    "serie_list": """SELECT c_custkey AS ID_SERIE, CAST(c_nationkey AS BIGINT) AS ID_LIST,
  CAST(NULL AS INTEGER) AS DISPLAY_ORDER, 0 AS DELETED FROM customer""",
    "collection": "SELECT c_custkey AS ID_COLLECTION, c_name AS NAME, 'about' AS OVERVIEW, '/c' AS POSTER_PATH FROM customer",
    "collection_lang": """SELECT c_custkey AS ID_COLLECTION, 'fr' AS LANG,
  CASE WHEN c_nationkey < 5 THEN '' ELSE 'fr ' || c_name END AS NAME, 'sur' AS OVERVIEW, '/f' AS POSTER_PATH
FROM customer WHERE c_mktsegment <> 'MACHINERY'""",
    "rating": "SELECT 'tt' || p_partkey AS tconst, p_size / 5.0 AS averageRating FROM part",
    "movie_lang": """SELECT o_orderkey AS ID_MOVIE, 'fr' AS LANG,
  CASE WHEN o_orderstatus = 'F' THEN 'Titre ' ELSE 'Title ' END || o_orderkey AS TITLE,
  'Le résumé de la commande ' || o_orderkey AS OVERVIEW FROM orders WHERE o_orderpriority <> '3-MEDIUM'""",
    "serie_lang": "SELECT c_custkey AS ID_SERIE, 'fr' AS LANG, 'Série ' || c_custkey AS TITLE FROM customer WHERE c_nationkey > 4",
    "wikidata_movie": """SELECT 'Q' || p_partkey AS ID_WIKIDATA, p_name AS TITLE, '|' || p_name || '|Title ' || p_partkey || '|' AS ALIASES,
  CASE WHEN p_size > 45 THEN p_partkey END AS ID_CRITERION, CASE WHEN p_size > 48 THEN p_partkey END AS ID_CRITERION_SPINE,
  'k' AS PLEX_MEDIA_KEY, 'Q11424' AS INSTANCE_OF FROM part""",
    "wikidata_serie": "SELECT 'Q' || p_partkey AS ID_WIKIDATA, p_name AS TITLE, p_brand AS ALIASES, 'k' AS PLEX_MEDIA_KEY, 'Q5398426' AS INSTANCE_OF FROM part",
    "wikidata_person": """SELECT 'Q' || p_partkey AS ID_WIKIDATA, p_name AS NAME,
  CASE WHEN p_size > 10 THEN '|' || p_brand || '|' END AS ALIASES, 'Q5' AS INSTANCE_OF FROM part""",
    "person_movie": _credits_sql("l_orderkey", "ID_MOVIE"),
    "person_serie": _credits_sql("o_custkey", "ID_SERIE"),
    "page_section": f"""SELECT 'Q' || conv_id AS ID_WIKIDATA, turn AS DISPLAY_ORDER, {pick_sql(SECTIONS, "length(text)")} AS TITLE,
  regexp_replace(text, '^[\\s\\p{{Z}}]+|[\\s\\p{{Z}}]+$', '', 'g') AS CONTENT FROM conversations""",
    "item_property": f"""SELECT 'Q' || l_orderkey AS ID_WIKIDATA, {pick_sql(PROPERTIES, "l_linenumber - 1")} AS ID_PROPERTY, 'I' || l_partkey AS ID_ITEM,
  min(l_linenumber) AS DISPLAY_ORDER FROM lineitem GROUP BY ALL""",
    "item": """SELECT 'I' || p_partkey AS ID_WIKIDATA, CASE WHEN p_type = 'PROMO' THEN 'fr' ELSE 'en' END AS LANG, p_name AS LABEL
FROM part WHERE p_size > 5""",
    "lang_lang": f"""SELECT {pick_sql(["fr", "en", "es", "it", "pt"], "r_regionkey")} AS LANG, 'fr' AS LANG_DISPLAY,
  {pick_sql(["français", "anglais", "espagnol", "italien", "portugais"], "r_regionkey")} AS DESCRIPTION FROM region""",
    "pub_movie": "SELECT * FROM movie WHERE ADULT = 0 AND ID_IMDB <> ''",
    "pub_serie": "SELECT * FROM serie WHERE ADULT = 0 AND ID_IMDB <> ''",
    "pub_person": "SELECT * FROM person WHERE ADULT = 0 AND ID_IMDB <> '' AND ID_WIKIDATA <> ''",
}


def with_tables(names: str, query: str) -> str:
    """SQL text with the named derived tables in front."""
    parts = ",\n".join(f"{n if n != 'list' else 'list_'} AS ({SQL[n]})" for n in names.split())
    glue = "," if query.lstrip().startswith(",") else ""
    return f"WITH {parts}{glue}{query.lstrip().lstrip(',') if glue else query}"
