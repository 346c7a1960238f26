"""Queries for the jobs, on the derived catalogue."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions import text as TX
from ..functions.columns import eligible_person, eligible_title
from ..functions import values as V
from ..plans import documents, formats_job, publish, topics
from ..sources.tables import empty_state
from .catalogue import Catalogue, with_tables
from .operator_queries import FORMAT_SQL, clean_sql
from .registry import AUDIT, query, read

c = F.col


def published(cat: Catalogue) -> dict[str, DataFrame]:
    """Catalogue plus the published titles and persons, as keys only."""
    return {
        "pub_movie": cat["movie"].filter(eligible_title()).select("ID_MOVIE"),
        "pub_serie": cat["serie"].filter(eligible_title()).select("ID_SERIE"),
        "pub_person": cat["person"].filter(eligible_person()).select("ID_PERSON"),
    }


def full(spark, sf) -> Catalogue:
    cat = Catalogue(spark, sf)
    cat.update(published(cat))
    return cat


# --- format lines -----------------------------------------------------------

_LINES = f"""
, lines AS (SELECT ID_MOVIE, WIKIPEDIA_FORMAT_LINE, {clean_sql("WIKIPEDIA_FORMAT_LINE")} AS l FROM movie),
found AS (SELECT ID_MOVIE, WIKIPEDIA_FORMAT_LINE, {", ".join(f"CASE WHEN l IS NOT NULL THEN {s} END AS {n}" for n, s in FORMAT_SQL.items())}
  FROM lines)"""


@query("g1_format_extraction", with_tables("movie", _LINES + """
SELECT * FROM found"""))
def _(spark, sf):
    rows = formats_job.extract_formats(Catalogue(spark, sf)["movie"], AUDIT)
    return rows.select("ID_MOVIE", "WIKIPEDIA_FORMAT_LINE", *FORMAT_SQL)


def _technical(spark, sf):
    cat = Catalogue(spark, sf)
    movie = formats_job.extract_formats(cat["movie"], AUDIT)
    known = spark.createDataFrame(
        [(3, "Technicolor", "color_technology"), (9, "dolby", "sound_system")],
        "ID_TECHNICAL bigint, DESCRIPTION string, TECHNICAL_TYPE string",
    )
    linked = cat["movie"].select("ID_MOVIE", F.lit(9).cast("bigint").alias("ID_TECHNICAL"))
    return formats_job.link_technical(movie, known, linked, AUDIT)


_VALUES = _LINES + """,
vals AS (SELECT ID_MOVIE, rank, kind, trim(v) AS v FROM (
    SELECT ID_MOVIE, 0 AS rank, 'color_technology' AS kind, unnest(string_split(COLOR_TECHNOLOGY, '|')) AS v FROM found
    UNION ALL SELECT ID_MOVIE, 1, 'film_technology', unnest(string_split(FILM_TECHNOLOGY, '|')) FROM found
    UNION ALL SELECT ID_MOVIE, 2, 'sound_technology', unnest(string_split(SOUND_TECHNOLOGY, '|')) FROM found
    UNION ALL SELECT ID_MOVIE, 3, 'sound_system', unnest(string_split(SOUND_SYSTEM, '|')) FROM found
    UNION ALL SELECT ID_MOVIE, 4, 'film_format', unnest(string_split(FILM_FORMAT, '|')) FROM found) WHERE trim(v) <> ''),
known AS (SELECT * FROM (VALUES (3, 'Technicolor', 'color_technology'), (9, 'dolby', 'sound_system')) t(ID_TECHNICAL, DESCRIPTION, TECHNICAL_TYPE)),
fresh AS (SELECT v AS DESCRIPTION, arg_min(kind, rank) AS TECHNICAL_TYPE FROM vals
  WHERE lower(v) NOT IN (SELECT lower(DESCRIPTION) FROM known) GROUP BY v),
dim AS (SELECT * FROM known UNION ALL
  SELECT 9 + row_number() OVER (ORDER BY left(md5(DESCRIPTION), 3), DESCRIPTION), DESCRIPTION, TECHNICAL_TYPE FROM fresh)"""


@query("g2_technical", with_tables("movie", _VALUES + "SELECT * FROM dim"))
def _(spark, sf):
    return _technical(spark, sf)[0]


@query("g2_movie_technical", with_tables("movie", _VALUES + """
SELECT DISTINCT ID_MOVIE, ID_TECHNICAL FROM vals JOIN dim ON lower(v) = lower(DESCRIPTION)
UNION SELECT ID_MOVIE, 9 FROM movie WHERE ID_MOVIE NOT IN (SELECT ID_MOVIE FROM vals)"""))
def _(spark, sf):
    return _technical(spark, sf)[1]


# --- keywords and topics ----------------------------------------------------


def _count_sql(title: str, name: str, key: str) -> str:
    return f"""SELECT NAME, min(d.{key}) AS rep, count(DISTINCT e.ID_{title}) AS n
  FROM pub_{title.lower()} e JOIN {title.lower()}_{name} b ON e.ID_{title} = b.ID_{title} JOIN {name} d ON b.{key} = d.{key}
  GROUP BY NAME"""


@query("g3_keyword_statistics", with_tables(
    "movie serie person pub_movie pub_serie keyword movie_keyword serie_keyword", f"""
, m AS ({_count_sql("MOVIE", "keyword", "ID_KEYWORD")}), s AS ({_count_sql("SERIE", "keyword", "ID_KEYWORD")})
SELECT k.ID_KEYWORD, k.NAME, m.n AS MOVIE_COUNT, s.n AS SERIE_COUNT,
  CAST(array_length(regexp_extract_all(k.NAME, '[\\p{{L}}\\p{{N}}_]+')) AS INTEGER) AS NAME_WORD_COUNT,
  CASE WHEN coalesce(m.n, 0) + coalesce(s.n, 0) < 2 THEN 1 ELSE 0 END AS IS_EMPTY,
  CASE WHEN k.NAME IN (SELECT NAME FROM person) THEN 1 ELSE 0 END AS IS_PERSON
FROM keyword k LEFT JOIN m ON k.ID_KEYWORD = m.rep LEFT JOIN s ON k.ID_KEYWORD = s.rep"""))
def _(spark, sf):
    rows = topics.keyword_statistics(full(spark, sf))
    return rows.drop("USE_FOR_TAGGING", "USED_FOR_SIMILARITY")


_SOURCES = """
, sources AS (
  SELECT 'list' AS TOPIC_TYPE, ID_LIST AS ID_RECORD, NAME AS TOPIC_NAME, DESCRIPTION AS OVERVIEW, 'en' AS LANG, POSTER_PATH
    FROM list_ WHERE USE_FOR_TAGGING > 0
  UNION ALL SELECT 'list', l.ID_LIST, SHORT_NAME, '', LANG, '' FROM list_lang l JOIN list_ b ON l.ID_LIST = b.ID_LIST WHERE USE_FOR_TAGGING > 0
  UNION ALL SELECT 'collection', ID_COLLECTION, NAME, OVERVIEW, 'en', POSTER_PATH FROM collection
  UNION ALL SELECT 'collection', ID_COLLECTION, NAME, OVERVIEW, LANG, POSTER_PATH FROM collection_lang
  UNION ALL SELECT 'keyword', ID_KEYWORD, NAME, '', 'en', '' FROM keyword WHERE USE_FOR_TAGGING > 0)"""
_MEMBERS = """,
okm AS (SELECT * FROM movie WHERE ADULT = 0 AND ID_WIKIDATA <> ''), oks AS (SELECT * FROM serie WHERE ADULT = 0 AND ID_WIKIDATA <> ''),
mm AS (SELECT 'list' AS TOPIC_TYPE, ID_LIST AS ID_RECORD, ID_MOVIE, coalesce(DISPLAY_ORDER, 0) AS DISPLAY_ORDER
    FROM movie_list WHERE DELETED = 0 AND ID_MOVIE IN (SELECT ID_MOVIE FROM okm)
  UNION ALL SELECT 'keyword', ID_KEYWORD, ID_MOVIE, coalesce(last_value(DISPLAY_ORDER IGNORE NULLS) OVER (
      PARTITION BY ID_KEYWORD ORDER BY ID_MOVIE), 0)
    FROM movie_keyword WHERE DELETED = 0 AND ID_MOVIE IN (SELECT ID_MOVIE FROM okm)
  UNION ALL SELECT 'collection', ID_COLLECTION, ID_MOVIE, 0 FROM okm WHERE ID_COLLECTION <> 0),
ms AS (SELECT 'list' AS TOPIC_TYPE, ID_LIST AS ID_RECORD, ID_SERIE, coalesce(DISPLAY_ORDER, 0) AS DISPLAY_ORDER
    FROM serie_list WHERE DELETED = 0 AND ID_SERIE IN (SELECT ID_SERIE FROM oks)
  UNION ALL SELECT 'keyword', ID_KEYWORD, ID_SERIE, coalesce(DISPLAY_ORDER, 0)
    FROM serie_keyword WHERE DELETED = 0 AND ID_SERIE IN (SELECT ID_SERIE FROM oks))"""
_TOPICS = _SOURCES + _MEMBERS + """,
cm AS (SELECT TOPIC_TYPE, ID_RECORD, count(*) AS n FROM mm GROUP BY 1, 2),
cs AS (SELECT TOPIC_TYPE, ID_RECORD, count(*) AS n FROM ms GROUP BY 1, 2),
gated AS (SELECT s.*, coalesce(cm.n, 0) AS MOVIE_COUNT, coalesce(cs.n, 0) AS SERIE_COUNT FROM sources s
  LEFT JOIN cm USING (TOPIC_TYPE, ID_RECORD) LEFT JOIN cs USING (TOPIC_TYPE, ID_RECORD)
  WHERE coalesce(cm.n, 0) + coalesce(cs.n, 0) > 1),
known AS (SELECT c_custkey AS ID_TOPIC, 'collection' AS TOPIC_TYPE, c_custkey AS ID_RECORD, 'en' AS LANG FROM customer WHERE c_nationkey <> 7),
ids AS (SELECT * FROM known UNION ALL
  SELECT (SELECT max(ID_TOPIC) FROM known) + row_number() OVER (ORDER BY left(md5(TOPIC_TYPE || chr(31) || ID_RECORD || chr(31) || LANG), 3), TOPIC_TYPE, ID_RECORD, LANG),
    TOPIC_TYPE, ID_RECORD, LANG FROM (SELECT DISTINCT TOPIC_TYPE, ID_RECORD, LANG FROM gated EXCEPT SELECT TOPIC_TYPE, ID_RECORD, LANG FROM known)),
topics AS (SELECT ID_TOPIC, g.* FROM gated g JOIN ids USING (TOPIC_TYPE, ID_RECORD, LANG))"""
_TOPIC_TABLES = "movie serie list list_lang collection collection_lang keyword movie_list serie_list movie_keyword serie_keyword"


@query("x1_topic_sources", with_tables("list list_lang collection collection_lang keyword", _SOURCES + "SELECT * FROM sources"))
def _(spark, sf):
    return topics.topic_sources(Catalogue(spark, sf))


@query("x2_topic_members_movie", with_tables(_TOPIC_TABLES, _SOURCES + _MEMBERS + "SELECT * FROM mm"))
def _(spark, sf):
    return topics.topic_members(Catalogue(spark, sf), "movie")


@query("x2_topic_members_serie", with_tables(_TOPIC_TABLES, _SOURCES + _MEMBERS + "SELECT * FROM ms"))
def _(spark, sf):
    return topics.topic_members(Catalogue(spark, sf), "serie")


@query("g4_topics", with_tables(_TOPIC_TABLES, _TOPICS + "SELECT * FROM topics"))
def _(spark, sf):
    return topics.build_topics(Catalogue(spark, sf))["topic"]


@query("g4_movie_topics", with_tables(_TOPIC_TABLES, _TOPICS + """
SELECT DISTINCT ID_MOVIE, ID_TOPIC, DISPLAY_ORDER FROM mm JOIN topics USING (TOPIC_TYPE, ID_RECORD)"""))
def _(spark, sf):
    return topics.build_topics(Catalogue(spark, sf))["movie_topic"]


@query("g4_serie_topics", with_tables(_TOPIC_TABLES, _TOPICS + """
SELECT DISTINCT ID_SERIE, ID_TOPIC, DISPLAY_ORDER FROM ms JOIN topics USING (TOPIC_TYPE, ID_RECORD)"""))
def _(spark, sf):
    return topics.build_topics(Catalogue(spark, sf))["serie_topic"]


# --- published mirrors ------------------------------------------------------

_ROUTE = {**V.SECTIONS_EXACT, **V.SECTIONS_FALLBACK}
_ROUTED = f"""
, r AS (SELECT *, CASE TITLE {" ".join(f"WHEN '{t}' THEN '{k}'" for t, k in _ROUTE.items())} END AS k,
    TITLE IN ({", ".join(f"'{t}'" for t in V.SECTIONS_EXACT)}) AS exact
  FROM page_section WHERE TITLE NOT IN ({", ".join(f"'{t}'" for t in V.SECTIONS_SKIPPED)})),
f AS (SELECT *, row_number() OVER (PARTITION BY ID_WIKIDATA, k ORDER BY DISPLAY_ORDER) AS rn FROM r),
routed AS (SELECT ID_WIKIDATA, {", ".join(
    f"coalesce(arg_max(CONTENT, DISPLAY_ORDER) FILTER (exact AND k = '{k}'), "
    f"arg_min(CONTENT, DISPLAY_ORDER) FILTER (NOT exact AND k = '{k}')) AS \"{k}\""
    for k in V.SECTIONS_EXACT.values())},
  '|' || string_agg(TITLE || '|', '' ORDER BY DISPLAY_ORDER) FILTER (k IS NULL OR (NOT exact AND rn > 1)) AS OTHER_SECTIONS
  FROM f GROUP BY ID_WIKIDATA)"""


def _published(columns: list[str], table: str) -> str:
    return ", ".join(f"{table}.{n}" for n in columns)


@query("g5_published_movies", with_tables("movie pub_movie rating movie_lang wikidata_movie page_section", _ROUTED + f"""
SELECT {_published(publish.MOVIE_COLUMNS, "p")}, p.TITLE AS MOVIE_TITLE, averageRating AS IMDB_RATING,
  CASE WHEN IS_DOCUMENTARY = 1 THEN averageRating - 1.5 ELSE averageRating END AS IMDB_RATING_ADJUSTED,
  fr.TITLE AS MOVIE_TITLE_FR, w.TITLE AS WIKIDATA_TITLE, w.ALIASES, w.ID_CRITERION,
  w.ID_CRITERION_SPINE, w.PLEX_MEDIA_KEY, w.INSTANCE_OF,
  {", ".join(f'"{k}"' for k in V.SECTIONS_EXACT.values())}, OTHER_SECTIONS
FROM pub_movie p LEFT JOIN rating ON tconst = ID_IMDB LEFT JOIN movie_lang fr ON p.ID_MOVIE = fr.ID_MOVIE
  LEFT JOIN wikidata_movie w ON p.ID_WIKIDATA = w.ID_WIKIDATA LEFT JOIN routed r ON p.ID_WIKIDATA = r.ID_WIKIDATA"""))
def published_movies_query(spark, sf):
    return publish.publish_movies(Catalogue(spark, sf))


@query("g6_published_series", with_tables("serie pub_serie rating serie_lang wikidata_serie", f"""
SELECT {_published(publish.SERIE_COLUMNS, "p")}, p.TITLE AS SERIE_TITLE, averageRating AS IMDB_RATING,
  CASE WHEN SERIE_TYPE = 'Documentary' THEN averageRating - 1.5 WHEN SERIE_TYPE <> 'Documentary' THEN averageRating END AS IMDB_RATING_ADJUSTED,
  fr.TITLE AS SERIE_TITLE_FR, w.TITLE AS WIKIDATA_TITLE, w.ALIASES, w.PLEX_MEDIA_KEY, w.INSTANCE_OF
FROM pub_serie p LEFT JOIN rating ON tconst = ID_IMDB LEFT JOIN serie_lang fr ON p.ID_SERIE = fr.ID_SERIE
  LEFT JOIN wikidata_serie w ON p.ID_WIKIDATA = w.ID_WIKIDATA"""))
def _(spark, sf):
    return publish.publish_series(Catalogue(spark, sf))


@query("g7_published_persons", with_tables("person pub_person wikidata_person", f"""
SELECT {_published(publish.PERSON_COLUMNS, "p")}, p.NAME AS PERSON_NAME, w.NAME AS WIKIDATA_NAME, w.ALIASES, w.INSTANCE_OF
FROM pub_person p LEFT JOIN wikidata_person w ON p.ID_WIKIDATA = w.ID_WIKIDATA"""))
def _(spark, sf):
    return publish.publish_persons(Catalogue(spark, sf))


@query("g8_published_companies", with_tables(
    "movie serie pub_movie pub_serie company movie_company serie_company", f"""
, m AS ({_count_sql("MOVIE", "company", "ID_COMPANY")}), s AS ({_count_sql("SERIE", "company", "ID_COMPANY")})
SELECT {_published([n for n in publish.COMPANY_COLUMNS if not n.endswith("_COUNT")], "d")}, d.NAME AS COMPANY_NAME,
  m.n AS MOVIE_COUNT, s.n AS SERIE_COUNT
FROM company d LEFT JOIN m ON ID_COMPANY = m.rep LEFT JOIN s ON ID_COMPANY = s.rep WHERE m.n > 0 OR s.n > 0"""))
def _(spark, sf):
    return publish.publish_companies(publish.count_companies(full(spark, sf)))


@query("g9_published_networks", with_tables("serie pub_serie network serie_network", f"""
, s AS ({_count_sql("SERIE", "network", "ID_NETWORK")})
SELECT {_published([n for n in publish.NETWORK_COLUMNS if n != "SERIE_COUNT"], "d")}, d.NAME AS NETWORK_NAME,
  s.n AS SERIE_COUNT FROM network d JOIN s ON ID_NETWORK = s.rep"""))
def _(spark, sf):
    return publish.publish_networks(publish.count_networks(full(spark, sf)))


@query("g10_published_movie_credits", with_tables("movie person pub_movie pub_person person_movie", """
SELECT * FROM person_movie WHERE ID_PERSON IN (SELECT ID_PERSON FROM pub_person) AND ID_MOVIE IN (SELECT ID_MOVIE FROM pub_movie)"""))
def _(spark, sf):
    return publish.publish_title_credits(full(spark, sf), "movie")


@query("g10_published_serie_credits", with_tables("serie person pub_serie pub_person person_serie", """
SELECT * FROM person_serie WHERE ID_PERSON IN (SELECT ID_PERSON FROM pub_person) AND ID_SERIE IN (SELECT ID_SERIE FROM pub_serie)"""))
def _(spark, sf):
    return publish.publish_title_credits(full(spark, sf), "serie")


# --- document texts ---------------------------------------------------------

_FIELDS = {
    "title": ("p_name", lambda: c("p_name")),
    "kind": ("CASE WHEN p_type = 'PROMO' THEN 'documentaire' ELSE 'film' END",
             lambda: F.when(c("p_type") == "PROMO", "documentaire").otherwise("film")),
    "year": ("CAST(1950 + p_size AS VARCHAR)", lambda: (c("p_size") + 1950).cast("string")),
    "language": ("CASE WHEN p_size > 9 THEN 'anglais' ELSE '' END", lambda: F.when(c("p_size") > 9, "anglais").otherwise("")),
    "foreign_title": ("CASE WHEN p_size > 30 THEN p_brand END", lambda: F.when(c("p_size") > 30, c("p_brand"))),
    "same_title": ("CASE WHEN p_size <= 30 THEN p_name END", lambda: F.when(c("p_size") <= 30, c("p_name"))),
    "alt_title": ("CASE WHEN p_size > 40 THEN p_type END", lambda: F.when(c("p_size") > 40, c("p_type"))),
    "other_titles": ("CASE WHEN p_size < 5 THEN p_brand || ', ' || p_type END",
                     lambda: F.when(c("p_size") < 5, F.concat_ws(", ", "p_brand", "p_type"))),
    "feature_minutes": ("CASE WHEN p_size * 2 > 58 THEN p_size * 2 END", lambda: F.when(c("p_size") * 2 > 58, c("p_size") * 2)),
    "short_minutes": ("CASE WHEN p_size * 2 <= 58 THEN p_size * 2 END", lambda: F.when(c("p_size") * 2 <= 58, c("p_size") * 2)),
    "fiction": ("CASE WHEN p_type <> 'PROMO' THEN 'Film fiction' END", lambda: F.when(c("p_type") != "PROMO", "Film fiction")),
}
_NAMES = list(dict.fromkeys(
    n for test, fr, en in V.SENTENCES for n in [test, *re.findall(r"\{(\w+)\}", fr + en)] if n
))
_IN_TEXT = [n for n in V.PROPERTIES if n not in V.PROPERTIES_NOT_IN_TEXT]
_OTHERS = [n for n in [*_NAMES, *V.KEYWORD_FRAGMENTS, *_IN_TEXT] if n not in _FIELDS]


def _fields_sql() -> str:
    known = [f"{sql} AS f_{n}" for n, (sql, _) in _FIELDS.items()]
    rest = [f"CASE WHEN p_size > {(i * 7) % 50} THEN p_brand || '_{n} ' || p_type END AS f_{n}" for i, n in enumerate(dict.fromkeys(_OTHERS))]
    return ", ".join(known + rest)


def _fields_columns() -> dict[str, Column]:
    out = {n: column() for n, (_, column) in _FIELDS.items()}
    for i, n in enumerate(dict.fromkeys(_OTHERS)):
        out[n] = F.when(c("p_size") > (i * 7) % 50, F.concat(c("p_brand"), F.lit(f"_{n} "), c("p_type")))
    return out


def _part_fields(spark, sf) -> DataFrame:
    fields = [v.alias(n) for n, v in _fields_columns().items()]
    return read(spark, sf, "part").select("p_partkey", *fields)


def _sentences_sql(lang: str) -> str:
    parts = []
    for test, fr, en in V.SENTENCES:
        template = fr if lang == "fr" else en
        if not template:
            continue
        pieces = [
            f"coalesce(CAST(f_{p} AS VARCHAR), '')" if i % 2 else "'" + p.replace("'", "''") + "'"
            for i, p in enumerate(re.split(r"\{(\w+)\}", template))
        ]
        text = " || ".join(pieces)
        parts.append(text if test is None else f"CASE WHEN coalesce(CAST(f_{test} AS VARCHAR), '') <> '' THEN {text} ELSE '' END")
    return "substr(" + " || ".join(f"({p})" for p in parts) + ", 2)"


@query("f22_keyword_document", f"""
WITH f AS (SELECT p_partkey, {_fields_sql()} FROM part),
w AS (SELECT p_partkey, t.w, min(t.pos) AS pos FROM f, unnest(string_split(concat_ws(' ', {", ".join(f"f_{n}" for n in [*V.KEYWORD_FRAGMENTS, *_IN_TEXT])}), ' '))
    WITH ORDINALITY AS t(w, pos) WHERE t.w <> '' GROUP BY ALL)
SELECT p_partkey, string_agg(w, ' ' ORDER BY pos) AS TEXT_DOC FROM w GROUP BY 1""")
def _(spark, sf):
    return _part_fields(spark, sf).select("p_partkey", TX.keyword_document(_IN_TEXT).alias("TEXT_DOC"))


@query("f23_sentences", f"""
WITH f AS (SELECT p_partkey, {_fields_sql()} FROM part)
SELECT p_partkey, {_sentences_sql("fr")} AS TEXT_FR, {_sentences_sql("en")} AS TEXT_EN FROM f""")
def _(spark, sf):
    return _part_fields(spark, sf).select(
        "p_partkey", TX.sentences("fr").alias("TEXT_FR"), TX.sentences("en").alias("TEXT_EN")
    )


# --- documents --------------------------------------------------------------


_GENRE_CASE = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in V.GENRES_FR.items())
_CODES = ", ".join(f"'{x}'" for x in V.PROPERTIES)
_BUDGETED = ", ".join(f"'{x}'" for x in V.ALIAS_BUDGET_COLUMNS)
_LIST_OF = " ".join(
    f"WHEN CREW_DEPARTMENT = '{department}'{f" AND CREW_JOB = '{job}'" if job else ''} THEN '{column}'"
    for department, column, job in V.DEPARTMENTS if department in V.CREW_DEPARTMENTS_READ
)


def _limited_sql(links: str, prefix: str, limit: int) -> str:
    """Texts and tags of a list that stops at its first overflow; ``links`` has ``ID_MOVIE, id, NAME, pos``."""
    return f"""SELECT ID_MOVIE, string_agg(NAME, ', ' ORDER BY pos) FILTER (kept) AS shown, string_agg(NAME, ' ' ORDER BY pos) FILTER (seen) AS words,
    string_agg('{prefix}' || id, ' ' ORDER BY pos) FILTER (seen) AS tags
  FROM (SELECT *, kept OR coalesce(lag(kept) OVER (PARTITION BY ID_MOVIE ORDER BY pos), true) AS seen FROM (
    SELECT *, sum(length(NAME)) OVER (PARTITION BY ID_MOVIE ORDER BY pos) + 2 * greatest(pos - 1, 1) <= {limit} AS kept FROM ({links}))) GROUP BY 1"""


def _content_sql(text: str, lang: str) -> str:
    stop = ", ".join(f"'{w}'" for w in V.STOP_WORDS[lang])
    words = f"regexp_extract_all({text}, '[\\p{{L}}\\p{{N}}_]+')"
    return f"coalesce(array_to_string(list_filter({words}, lambda w: lower(w) NOT IN ({stop})), ' '), '')"


_DOC_SHARED = f"""
, docs AS (SELECT * FROM movie WHERE ID_IMDB <> '' AND ID_WIKIDATA <> ''),
co AS ({_limited_sql("""SELECT ID_MOVIE, ID_COMPANY AS id, s_name AS NAME, row_number() OVER (PARTITION BY ID_MOVIE ORDER BY DISPLAY_ORDER NULLS FIRST, ID_COMPANY) AS pos
    FROM movie_company JOIN supplier ON s_suppkey = ID_COMPANY WHERE DELETED = 0""", "o", V.MAX_COMPANIES_CHARS)}),
star AS (SELECT x.*, p.NAME, nullif(trim(replace(w.ALIASES, '|', ' ')), '') AS other FROM person_movie x JOIN person p USING (ID_PERSON)
  JOIN wikidata_person w USING (ID_WIKIDATA) WHERE p.ID_WIKIDATA LIKE 'Q%'),
ca AS (SELECT ID_MOVIE, string_agg(NAME, ', ' ORDER BY pos) AS shown, string_agg('p' || ID_PERSON, ' ' ORDER BY pos) AS tags FROM (
  SELECT *, coalesce(sum(length(NAME) + coalesce(length(other) + 1, 0)) OVER (PARTITION BY ID_MOVIE ORDER BY pos
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + length(NAME) + 2 * greatest(pos - 1, 1) <= {V.MAX_CAST_CHARS} AS kept
  FROM (SELECT *, row_number() OVER (PARTITION BY ID_MOVIE ORDER BY DISPLAY_ORDER, ID_CREDIT) AS pos FROM star WHERE CREDIT_TYPE = 'cast')
  WHERE pos <= {V.MAX_CAST}) WHERE kept GROUP BY 1),
numbered AS (SELECT *, row_number() OVER (PARTITION BY ID_MOVIE, list ORDER BY DISPLAY_ORDER, ID_CREDIT) AS i
  FROM (SELECT *, CASE {_LIST_OF} END AS list FROM star WHERE CREDIT_TYPE = 'crew' AND NAME <> '') WHERE list IS NOT NULL),
fold AS (
  SELECT ID_MOVIE, list, CAST(0 AS BIGINT) AS i, '' AS names, CAST(0 AS BIGINT) AS used, 0 AS n, false AS took,
    CAST(0 AS BIGINT) AS ID_PERSON, CAST(0 AS BIGINT) AS place, '' AS ID_CREDIT FROM (SELECT DISTINCT ID_MOVIE, list FROM numbered)
  UNION ALL
  SELECT f.ID_MOVIE, f.list, m.i, CASE WHEN ok THEN f.names || gap || m.NAME ELSE f.names END,
    CASE WHEN ok THEN f.used + length(gap) + length(m.NAME) + CASE WHEN f.list IN ({_BUDGETED}) THEN coalesce(length(m.other) + 1, 0) ELSE 0 END ELSE f.used END,
    CASE WHEN ok THEN f.n + 1 ELSE f.n END, ok, m.ID_PERSON, CAST(m.DISPLAY_ORDER AS BIGINT), m.ID_CREDIT
  FROM fold f JOIN numbered m ON f.ID_MOVIE = m.ID_MOVIE AND f.list = m.list AND m.i = f.i + 1,
    LATERAL (SELECT CASE WHEN f.names = '' THEN '' ELSE ', ' END AS gap, NOT contains(', ' || f.names || ', ', ', ' || m.NAME || ', ')
      AND f.used + 2 + length(m.NAME) <= {V.MAX_DEPARTMENT_CHARS} AND f.n < {V.MAX_DEPARTMENT} AS ok)),
crew_ends AS (SELECT ID_MOVIE, list, arg_max(names, i) AS names FROM fold GROUP BY ALL),
crew AS (SELECT ID_MOVIE, {", ".join(f"max(names) FILTER (list = '{column}') AS {column}" for column in documents.CREW_COLUMNS)} FROM crew_ends GROUP BY 1),
crew_tags AS (SELECT ID_MOVIE, string_agg('p' || ID_PERSON, ' ' ORDER BY place, ID_CREDIT, ID_PERSON) AS tags FROM fold WHERE took GROUP BY 1),
short_lists AS (SELECT l.*, CASE WHEN n_regionkey = 1 THEN lower(n_name) END AS SHORT_NAME FROM list_ l JOIN nation ON n_nationkey = ID_LIST),
labels_ AS (SELECT e.ID_WIKIDATA, ID_PROPERTY, LABEL, min(DISPLAY_ORDER) AS o, max(DISPLAY_ORDER) FILTER (i.LANG = 'fr') AS in_fr,
    max(DISPLAY_ORDER) FILTER (i.LANG = 'en') AS in_en
  FROM item_property e JOIN item i ON e.ID_ITEM = i.ID_WIKIDATA WHERE LABEL <> '' AND LABEL <> ID_ITEM AND ID_PROPERTY IN ({_CODES}) GROUP BY ALL)"""

_DOC_LOCAL = {
    "fr": {
        "title": "coalesce(t.TITLE, '')", "overview": "coalesce(t.OVERVIEW, '')", "alt_title": "d.TITLE",
        "keyword": "SELECT p_partkey AS id, 'mot ' || p_name AS NAME FROM part WHERE p_type <> 'LARGE'",
        "list": "coalesce(nullif(g.SHORT_NAME, ''), x.SHORT_NAME, x.NAME)", "collection": "coalesce(nullif(g.NAME, ''), x.NAME)",
    },
    "en": {
        "title": "d.TITLE", "overview": "d.OVERVIEW", "alt_title": "''", "keyword": "SELECT p_partkey AS id, p_name AS NAME FROM part",
        "list": "coalesce(x.SHORT_NAME, x.NAME)", "collection": "x.NAME",
    },
}
_SHOWN = ["directors", "writers", "producers"]


def _doc_fields_sql(lang: str) -> dict[str, str]:
    """Document fields over the joined parts of one language."""
    fiction, documentary = V.MOVIE_KIND[lang]
    feature, short = V.LENGTH_LABELS[lang]
    new_alt = "alt_title <> '' AND alt_title <> title AND alt_title <> ORIGINAL_TITLE"
    titled = "title <> '' AND ORIGINAL_TITLE <> ''"
    listed = "replace(al, '|', ', ')"
    fields = {
        "title": "title", "kind": f"CASE WHEN IS_DOCUMENTARY = 1 THEN '{documentary}' ELSE '{fiction}' END",
        "year": "coalesce(strftime(DAT_RELEASE, '%Y'), '')", "language": "coalesce(shown_language, '')",
        "title_lemma": f"CASE WHEN {_content_sql('title', lang)} <> title THEN {_content_sql('title', lang)} END",
        "foreign_title": f"CASE WHEN {titled} AND ORIGINAL_TITLE <> title THEN ORIGINAL_TITLE END",
        "same_title": f"CASE WHEN {titled} AND ORIGINAL_TITLE = title THEN ORIGINAL_TITLE END",
        "alt_title": f"CASE WHEN {titled} AND {new_alt} THEN alt_title END", "alias_words": "trim(replace(al, '|', ' '))",
        "other_titles": f"CASE WHEN length({listed}) > 4 THEN nullif(nullif(substr({listed}, 3, length({listed}) - 4), ''), ',') END",
        "fiction": f"CASE WHEN IS_DOCUMENTARY = 0 THEN '{V.FICTION_LABEL}' END", "genres": "nullif(array_to_string(genre_items, ', '), '')",
        "genres_plain": "replace(array_to_string(genre_items, ', '), ',', '')", "more_genres": "', ' || nullif(P136, '')",
        "length_label": f"CASE WHEN RUNTIME > {V.FEATURE_MINUTES} THEN '{feature}' WHEN RUNTIME > 0 THEN '{short}' END",
        "feature_minutes": f"CASE WHEN RUNTIME > {V.FEATURE_MINUTES} THEN RUNTIME END",
        "short_minutes": f"CASE WHEN RUNTIME BETWEEN 1 AND {V.FEATURE_MINUTES} THEN RUNTIME END",
        "keywords": "keywords", "keywords_lemma": f"CASE WHEN keywords <> '' THEN {_content_sql('keyword_words', lang)} END",
        "collection": "collection", "lists": "lists", "lists_lemma": f"CASE WHEN lists <> '' THEN {_content_sql('lists', lang)} END",
        "criterion": f"CASE WHEN ID_CRITERION > 0 THEN '{V.CRITERION_LABEL}' || CASE WHEN ID_CRITERION_SPINE > 0 "
                     f"THEN '{V.CRITERION_SPINE_LABEL}' || ID_CRITERION_SPINE ELSE '' END END",
        "companies": "companies", "overview": "overview",
        "overview_lemma": f"CASE WHEN title <> '' AND overview <> '' THEN {_content_sql('overview', lang) if lang == 'fr' else repr('')} END",
        "cast": "cast_top", "cast_plain": "replace(cast_top, ',', '')",
    }
    for tech in documents.TECH:
        shown = f"nullif(replace(regexp_replace({tech}, '^\\||\\|$', '', 'g'), '|', ', '), '')"
        fields |= {tech.lower(): shown, f"{tech.lower()}_plain": f"replace({shown}, ',', '')"}
    for name in _SHOWN:
        fields |= {name: name.upper(), f"{name}_plain": f"replace({name.upper()}, ',', '')"}
    return {**fields, **{code: code for code in V.PROPERTIES}}


def _doc_parts_sql(lang: str) -> str:
    """Common table expressions of one language, up to its fields and keyword document."""
    local = _DOC_LOCAL[lang]
    fields = ", ".join(f"{text} AS f_{name}" for name, text in _doc_fields_sql(lang).items())
    text = ", ".join(f"f_{n}" for n in [*V.KEYWORD_FRAGMENTS, *_IN_TEXT])
    links = f"""SELECT ID_MOVIE, id, NAME, row_number() OVER (PARTITION BY ID_MOVIE ORDER BY DISPLAY_ORDER NULLS FIRST, id) AS pos
    FROM movie_keyword JOIN ({local["keyword"]}) ON id = ID_KEYWORD WHERE DELETED = 0"""
    return f""",
kw_{lang} AS ({_limited_sql(links, "k", V.MAX_KEYWORDS_CHARS)}),
li_{lang} AS (SELECT ID_MOVIE, string_agg({local["list"]}, ', ' ORDER BY m.ID_LIST) AS shown, string_agg('l' || m.ID_LIST, ' ' ORDER BY m.ID_LIST) AS tags
  FROM movie_list m JOIN short_lists x ON x.ID_LIST = m.ID_LIST LEFT JOIN list_lang g ON g.ID_LIST = m.ID_LIST WHERE USE_FOR_TAGGING = 1 GROUP BY 1),
pr_{lang} AS (SELECT ID_WIKIDATA, {", ".join(f"max(TEXT) FILTER (ID_PROPERTY = '{x}') AS {x}" for x in V.PROPERTIES)} FROM (
  SELECT ID_WIKIDATA, ID_PROPERTY, coalesce(arg_max(LABEL, ROW(in_{lang}, LABEL)) FILTER (in_{lang} IS NOT NULL),
    string_agg(LABEL, ', ' ORDER BY o, LABEL)) AS TEXT FROM labels_ GROUP BY ALL) GROUP BY 1),
joined_{lang} AS (SELECT d.* EXCLUDE (TITLE, OVERVIEW), {local["title"]} AS title, {local["overview"]} AS overview, {local["alt_title"]} AS alt_title,
    l.DESCRIPTION AS shown_language, kw.shown AS keywords, kw.words AS keyword_words, kw.tags AS keyword_tags, co.shown AS companies, co.tags AS company_tags,
    li.shown AS lists, li.tags AS list_tags, averageRating AS rating, ID_CRITERION, ID_CRITERION_SPINE, ca.shown AS cast_top, ca.tags AS cast_tags,
    crew.* EXCLUDE (ID_MOVIE), ct.tags AS crew_tags, nullif({local["collection"]}, '') AS collection, pr.* EXCLUDE (ID_WIKIDATA),
    list_filter([CASE x {_GENRE_CASE} ELSE x END FOR x IN string_split(GENRES, '|')], lambda x: x <> '') AS genre_items,
    nullif(replace(replace(replace(w.ALIASES, '|' || {local["title"]} || '|', '|'), '|' || coalesce(ORIGINAL_TITLE, '') || '|', '|'),
      '|' || {local["alt_title"]} || '|', '|'), '') AS al
  FROM docs d LEFT JOIN movie_lang t ON t.ID_MOVIE = d.ID_MOVIE LEFT JOIN lang_lang l ON l.LANG = ORIGINAL_LANGUAGE AND l.LANG_DISPLAY = '{lang}'
    LEFT JOIN kw_{lang} kw ON kw.ID_MOVIE = d.ID_MOVIE LEFT JOIN co ON co.ID_MOVIE = d.ID_MOVIE LEFT JOIN li_{lang} li ON li.ID_MOVIE = d.ID_MOVIE
    LEFT JOIN rating ON tconst = ID_IMDB LEFT JOIN wikidata_movie w ON w.ID_WIKIDATA = d.ID_WIKIDATA LEFT JOIN ca ON ca.ID_MOVIE = d.ID_MOVIE
    LEFT JOIN crew ON crew.ID_MOVIE = d.ID_MOVIE LEFT JOIN crew_tags ct ON ct.ID_MOVIE = d.ID_MOVIE
    LEFT JOIN collection x ON x.ID_COLLECTION = d.ID_COLLECTION AND d.ID_COLLECTION <> 0
    LEFT JOIN collection_lang g ON g.ID_COLLECTION = x.ID_COLLECTION LEFT JOIN pr_{lang} pr ON pr.ID_WIKIDATA = d.ID_WIKIDATA),
f_{lang} AS (SELECT *, {fields} FROM joined_{lang}),
w_{lang} AS (SELECT ID_MOVIE, t.w, min(t.pos) AS pos FROM f_{lang}, unnest(string_split(concat_ws(' ', {text}), ' ')) WITH ORDINALITY AS t(w, pos)
  WHERE t.w <> '' GROUP BY ALL),
doc_{lang} AS (SELECT ID_MOVIE, string_agg(w, ' ' ORDER BY pos) AS TEXT_DOC FROM w_{lang} GROUP BY 1)"""


def _doc_select_sql(lang: str) -> str:
    crew = ", ".join(f"coalesce({column}, '') AS {column}" for column in documents.CREW_COLUMNS)
    genre_tags = "nullif(regexp_replace(array_to_string(list_transform(genre_items, lambda x: regexp_replace(x, '[- ]', '', 'g')), ' '), '^$', ''), '')"
    lemmas = ", ".join(f"coalesce(f_{n}, '') AS {n.upper()}" for n in ("overview_lemma", "keywords_lemma", "lists_lemma"))
    return f"""
SELECT f.ID_MOVIE, '{lang}' AS LANG, f_year AS YEAR_RELEASE, f_language AS ORIGINAL_LANGUAGE,
  concat_ws(' ', CASE WHEN ID_COLLECTION <> 0 THEN 'c' || ID_COLLECTION END, {genre_tags}, keyword_tags, company_tags, list_tags, cast_tags, crew_tags) AS TAGS,
  coalesce(rating, 0.0) AS IMDB_RATING,
  CASE WHEN IS_DOCUMENTARY = 1 THEN round(coalesce(rating, 0.0) - {V.DOCUMENTARY_PENALTY}, 1) ELSE coalesce(rating, 0.0) END AS IMDB_RATING_ADJUSTED,
  coalesce(keywords, '') AS KEYWORDS, coalesce(f_genres, '') AS GENRES, coalesce(collection, '') AS COLLECTION, coalesce(lists, '') AS LISTS,
  coalesce(cast_top, '') AS CAST_TOP, {crew}, {lemmas}, coalesce(TEXT_DOC, '') AS TEXT_DOC, {_sentences_sql(lang)} AS TEXT_SBERT
FROM f_{lang} f LEFT JOIN doc_{lang} USING (ID_MOVIE)"""


def documents_sql(*langs: str) -> str:
    """All columns of the documents in the given languages."""
    names = "movie movie_lang movie_keyword movie_company movie_list list list_lang person person_movie wikidata_person wikidata_movie rating " \
            "collection collection_lang lang_lang item item_property"
    parts = "".join(_doc_parts_sql(x) for x in langs)
    body = "\nUNION ALL".join(_doc_select_sql(x) for x in langs)
    return with_tables(names, _DOC_SHARED + parts + body).replace("WITH ", "WITH RECURSIVE ", 1)


@query("g11_movie_documents", documents_sql("fr"))
def movie_documents_query(spark, sf):
    return documents.movie_documents(Catalogue(spark, sf), "fr")


@query("g11_movie_documents_en", documents_sql("en"))
def _(spark, sf):
    return documents.movie_documents(Catalogue(spark, sf), "en")


@query("g11_documents_both", documents_sql("fr", "en"))
def _(spark, sf):
    """Both languages out of one pass over the tables."""
    return documents.movie_documents(Catalogue(spark, sf), ["fr", "en"])


_DOC_PARTS = f"""
, docs AS (SELECT * FROM movie WHERE ID_IMDB <> '' AND ID_WIKIDATA <> ''),
kw AS (SELECT ID_MOVIE, string_agg('mot ' || p_name, ', ' ORDER BY DISPLAY_ORDER NULLS FIRST, ID_KEYWORD) AS KEYWORDS
  FROM movie_keyword JOIN part ON p_partkey = ID_KEYWORD WHERE DELETED = 0 AND p_type <> 'LARGE' GROUP BY 1),
li AS (SELECT ID_MOVIE, string_agg(coalesce(g.SHORT_NAME, CASE WHEN n_regionkey = 1 THEN lower(n_name) ELSE n_name END), ', ' ORDER BY m.ID_LIST) AS LISTS
  FROM movie_list m JOIN nation ON n_nationkey = m.ID_LIST LEFT JOIN list_lang g ON g.ID_LIST = m.ID_LIST
  WHERE n_regionkey <> 2 GROUP BY 1),
star AS (SELECT x.*, p.NAME FROM person_movie x JOIN person p USING (ID_PERSON) JOIN wikidata_person w USING (ID_WIKIDATA) WHERE p.ID_WIKIDATA LIKE 'Q%'),
ca AS (SELECT ID_MOVIE, string_agg(NAME, ', ' ORDER BY DISPLAY_ORDER, ID_CREDIT) AS CAST_TOP FROM star WHERE CREDIT_TYPE = 'cast' GROUP BY 1),
ar AS (SELECT ID_MOVIE, string_agg(NAME, ', ' ORDER BY o) AS ART FROM (
    SELECT ID_MOVIE, NAME, min(ROW(DISPLAY_ORDER, ID_CREDIT)) AS o FROM star WHERE CREW_DEPARTMENT = 'Art' GROUP BY 1, 2) GROUP BY 1)"""


@query("g11_document_columns", with_tables(
    "movie movie_keyword movie_list list_lang person person_movie wikidata_person rating collection_lang", _DOC_PARTS + f"""
SELECT d.ID_MOVIE, strftime(DAT_RELEASE, '%Y') AS YEAR_RELEASE,
  array_to_string(list_filter([CASE x {_GENRE_CASE} ELSE x END FOR x IN string_split(GENRES, '|')], lambda x: x <> ''), ', ') AS GENRES,
  coalesce(KEYWORDS, '') AS KEYWORDS, coalesce(LISTS, '') AS LISTS, coalesce(CAST_TOP, '') AS CAST_TOP, coalesce(ART, '') AS ART,
  coalesce(averageRating, 0.0) AS IMDB_RATING,
  CASE WHEN IS_DOCUMENTARY = 1 THEN round(coalesce(averageRating, 0.0) - 1.5, 1) ELSE coalesce(averageRating, 0.0) END AS IMDB_RATING_ADJUSTED,
  coalesce(nullif(g.NAME, ''), c_name, '') AS COLLECTION
FROM docs d LEFT JOIN kw USING (ID_MOVIE) LEFT JOIN li USING (ID_MOVIE) LEFT JOIN ca USING (ID_MOVIE) LEFT JOIN ar USING (ID_MOVIE)
  LEFT JOIN rating ON tconst = ID_IMDB LEFT JOIN customer ON c_custkey = d.ID_COLLECTION AND d.ID_COLLECTION <> 0
  LEFT JOIN collection_lang g ON g.ID_COLLECTION = d.ID_COLLECTION AND d.ID_COLLECTION <> 0"""))
def _(spark, sf):
    return document_columns(documents.movie_documents(Catalogue(spark, sf), "fr"))


def document_columns(docs):
    return docs.select(
        "ID_MOVIE", "YEAR_RELEASE", "GENRES", "KEYWORDS", "LISTS", "CAST_TOP", "ART", "IMDB_RATING",
        "IMDB_RATING_ADJUSTED", "COLLECTION",
    )


@query("g11_usage_flags", with_tables("movie movie_keyword movie_company company person person_movie wikidata_person", """
, docs AS (SELECT * FROM movie WHERE ID_IMDB <> '' AND ID_WIKIDATA <> ''),
star AS (SELECT x.* FROM person_movie x JOIN person p USING (ID_PERSON) JOIN wikidata_person w USING (ID_WIKIDATA)
  WHERE p.ID_WIKIDATA LIKE 'Q%' AND ID_MOVIE IN (SELECT ID_MOVIE FROM docs)
    AND (CREDIT_TYPE = 'cast' OR (CREW_DEPARTMENT = 'Directing' AND CREW_JOB = 'Director')
      OR CREW_DEPARTMENT IN ('Writing', 'Production', 'Editing', 'Art', 'Sound')))
SELECT 'keyword' AS kind, ID_KEYWORD AS id FROM movie_keyword JOIN part ON p_partkey = ID_KEYWORD
  WHERE DELETED = 0 AND p_type <> 'LARGE' AND ID_MOVIE IN (SELECT ID_MOVIE FROM docs)
UNION SELECT 'company', ID_COMPANY FROM movie_company WHERE DELETED = 0 AND ID_MOVIE IN (SELECT ID_MOVIE FROM docs)
UNION SELECT 'person', ID_PERSON FROM star"""))
def _(spark, sf):
    flags = documents.usage_flags(Catalogue(spark, sf), "fr")
    parts = [
        flags[kind].filter(c("USED_FOR_SIMILARITY") == 1).select(F.lit(kind).alias("kind"), c(key).alias("id"))
        for kind, key in (("keyword", "ID_KEYWORD"), ("company", "ID_COMPANY"), ("person", "ID_PERSON"))
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# words of the derived overviews that are no stop words: start, word or null for the number, label
_OVERVIEW_WORDS = {
    "fr": [(3, "résumé", "X"), (16, "commande", "X"), (25, None, "NUM")], "en": [(3, "overview", "X"), (15, "order", "X"), (21, None, "NUM")],
}


def _overview_lemmas_sql(lang: str) -> str:
    words = ", ".join(
        f"({start}, {f"'{word}'" if word else 'CAST(NULL AS VARCHAR)'}, '{label}')" for start, word, label in _OVERVIEW_WORDS[lang])
    spoken = " AND o_orderpriority <> '3-MEDIUM'" if lang == "fr" else ""
    return f"""SELECT o_orderkey AS ID_MOVIE, '{lang}' AS LANG, strftime(CAST(o_orderdate AS DATE), '%Y') AS YEAR_RELEASE, START_CHAR,
  coalesce(word, CAST(o_orderkey AS VARCHAR)) AS NAME, LABEL
FROM orders, (VALUES {words}) AS v(START_CHAR, word, LABEL) WHERE o_orderstatus <> 'P' AND o_orderpriority <> '5-LOW'{spoken}"""


@query("g11_document_job", f"""
{_overview_lemmas_sql("fr")}
UNION ALL {_overview_lemmas_sql("en")}""")
def _(spark, sf):
    """Lemmas of the overviews beside their documents, from all tables that the job writes in both languages."""
    tables = Catalogue(spark, sf)
    for name in ("movie_document", "lemma", "movie_lemma"):
        tables[name] = schemas.empty_table(spark, name)
    tables["state"] = empty_state(spark)
    written = documents.document_job(tables, ["fr", "en"], AUDIT)
    lemma = written["lemma"].select("ID_LEMME", "NAME", "LABEL")
    docs = written["movie_document"].select("ID_MOVIE", "LANG", "YEAR_RELEASE")
    rows = written["movie_lemma"].join(lemma, "ID_LEMME").join(docs, ["ID_MOVIE", "LANG"])
    return rows.select("ID_MOVIE", "LANG", "YEAR_RELEASE", "START_CHAR", "NAME", "LABEL")
