"""Keyword statistics and topics."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import eligible_topic_member
from ..operators.changes import assign_ids
from ..operators.relate import forward_fill
from ..operators.rollups import gate, keyword_kpis, member_counts
from ..session import stage

TOPIC_KEY = ["TOPIC_TYPE", "ID_RECORD", "LANG"]


def with_counts(
    dim: DataFrame, key: str, counts: Mapping[str, DataFrame]
) -> DataFrame:
    """Dimension rows with fresh member counts; rows without members have null."""
    out = dim
    for column, counted in counts.items():
        fresh = counted.select(key, F.col(column).alias("_fresh"))
        out = out.join(fresh, key, "left").withColumn(column, F.col("_fresh")).drop("_fresh")
    return out.select(*dim.columns)


def keyword_statistics(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Keywords with member counts over published titles and their quality flags."""
    keyword = tables["keyword"]
    counts = {
        f"{title.upper()}_COUNT": member_counts(
            tables[f"pub_{title}"], tables[f"{title}_keyword"], keyword,
            f"ID_{title.upper()}", "ID_KEYWORD", f"{title.upper()}_COUNT",
        )
        for title in ("movie", "serie")
    }
    counted = with_counts(keyword, "ID_KEYWORD", counts)
    return keyword_kpis(counted, tables["person"]).select(*keyword.columns)


def topic_sources(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Lists, their language names, collections, their language rows, and keywords."""
    lists = tables["list"].filter(F.col("USE_FOR_TAGGING") > 0)
    names = tables["list_lang"].join(lists.select("ID_LIST"), "ID_LIST")
    collections = tables["collection"]
    variants = tables["collection_lang"].join(collections.select("ID_COLLECTION"), "ID_COLLECTION")
    keywords = tables["keyword"].filter(F.col("USE_FOR_TAGGING") > 0)

    def shape(df: DataFrame, kind: str, key: str, name: str, overview, lang, poster) -> DataFrame:
        return df.select(
            F.lit(kind).alias("TOPIC_TYPE"), F.col(key).cast("bigint").alias("ID_RECORD"),
            F.col(name).alias("TOPIC_NAME"), overview.alias("OVERVIEW"),
            lang.alias("LANG"), poster.alias("POSTER_PATH"),
        )

    english, empty = F.lit("en"), F.lit("")
    parts = [
        shape(lists, "list", "ID_LIST", "NAME", F.col("DESCRIPTION"), english, F.col("POSTER_PATH")),
        shape(names, "list", "ID_LIST", "SHORT_NAME", empty, F.col("LANG"), empty),
        shape(collections, "collection", "ID_COLLECTION", "NAME", F.col("OVERVIEW"), english,
              F.col("POSTER_PATH")),
        shape(variants, "collection", "ID_COLLECTION", "NAME", F.col("OVERVIEW"), F.col("LANG"),
              F.col("POSTER_PATH")),
        shape(keywords, "keyword", "ID_KEYWORD", "NAME", empty, english, empty),
    ]
    return reduce(DataFrame.unionByName, parts)


def topic_members(tables: Mapping[str, DataFrame], title: str) -> DataFrame:
    """Movies or series of every topic record, with a display order.

    A missing order takes the last order before it.  List and keyword-series
    members are read in order of that same column, where missing values come
    first, so theirs is 0; keyword movies are read in order of the movie.
    """
    key = f"ID_{title.upper()}"
    titles = tables[title].filter(eligible_topic_member())

    def live(name: str, record: str, kind: str) -> DataFrame:
        rows = tables[f"{title}_{name}"].filter(F.col("DELETED") == 0)
        rows = rows.join(titles.select(key), key, "left_semi")
        return rows.select(
            F.lit(kind).alias("TOPIC_TYPE"), F.col(record).cast("bigint").alias("ID_RECORD"), key,
            F.col("DISPLAY_ORDER").cast("int").alias("DISPLAY_ORDER"),
        )

    def zero_filled(df: DataFrame) -> DataFrame:
        return df.withColumn("DISPLAY_ORDER", F.coalesce("DISPLAY_ORDER", F.lit(0)))

    listed = zero_filled(live("list", "ID_LIST", "list"))
    tagged = live("keyword", "ID_KEYWORD", "keyword")
    if title != "movie":
        return listed.unionByName(zero_filled(tagged))
    tagged = forward_fill(tagged, ["TOPIC_TYPE", "ID_RECORD"], key, "DISPLAY_ORDER", 0)
    parts = titles.filter((F.col("DELETED") == 0) & (F.col("ID_COLLECTION") != 0)).select(
        F.lit("collection").alias("TOPIC_TYPE"),
        F.col("ID_COLLECTION").cast("bigint").alias("ID_RECORD"), key,
        F.lit(0).alias("DISPLAY_ORDER"),
    )
    return listed.unionByName(tagged).unionByName(parts)


def build_topics(tables: Mapping[str, DataFrame], staged: bool = True) -> dict[str, DataFrame]:
    """Topics with at least two members, and their movie and series bridges.

    The members feed the counts and both bridges, so members and topics are written once to the
    shared folder; without ``staged`` each of the three tables computes them anew.
    """
    record = ["TOPIC_TYPE", "ID_RECORD"]
    keep = stage if staged else lambda df: df
    movies, series = (keep(topic_members(tables, title)) for title in ("movie", "serie"))
    counted = topic_sources(tables)
    for column, rows in (("MOVIE_COUNT", movies), ("SERIE_COUNT", series)):
        sizes = rows.groupBy(*record).agg(F.count(F.lit(1)).alias(column))
        counted = counted.join(sizes, record, "left")
        counted = counted.withColumn(column, F.coalesce(column, F.lit(0)))
    topics = gate(counted, ["MOVIE_COUNT", "SERIE_COUNT"])
    ids = assign_ids(tables["topic"].select("ID_TOPIC", *TOPIC_KEY), topics, TOPIC_KEY, "ID_TOPIC")
    topics = keep(topics.join(ids, TOPIC_KEY))

    def bridge(rows: DataFrame, key: str) -> DataFrame:
        linked = rows.join(topics.select("ID_TOPIC", *record), record)
        return linked.select(key, "ID_TOPIC", "DISPLAY_ORDER").distinct()

    return {
        "topic": topics,
        "movie_topic": bridge(movies, "ID_MOVIE"),
        "serie_topic": bridge(series, "ID_SERIE"),
    }
