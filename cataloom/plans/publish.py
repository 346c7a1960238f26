"""Published mirrors of the raw tables.

Each mirror is recomputed from its inputs: eligible raw rows, renamed, plus
enrichment.  Lookups are first narrowed to one row per published key, so the
wide raw rows are shuffled once, on their own key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import (
    adjusted_rating, eligible_company, eligible_network, eligible_person, eligible_title, present,
)
from ..operators.relate import publish_credits, route_sections
from ..operators.rollups import member_counts
from .topics import with_counts

_TITLE = [
    "ID_IMDB", "ADULT", "OVERVIEW", "POSTER_PATH", "BACKDROP_PATH", "VOTE_AVERAGE", "VOTE_COUNT",
    "POPULARITY", "ORIGINAL_LANGUAGE", "ORIGINAL_TITLE", "DAT_CREAT", "TIM_UPDATED",
    "ID_WIKIDATA", "HOMEPAGE_URL", "STATUS", "TAGLINE", "DELETED",
]
MOVIE_COLUMNS = [
    "ID_MOVIE", *_TITLE, "DAT_RELEASE", "VIDEO", "RELEASE_YEAR", "RELEASE_MONTH", "RELEASE_DAY",
    "BUDGET", "REVENUE", "RUNTIME", "IS_COLOR", "IS_BLACK_AND_WHITE", "IS_SILENT", "IS_3D",
    "COLOR_TECHNOLOGY", "FILM_TECHNOLOGY", "ASPECT_RATIO", "FILM_FORMAT", "SOUND_SYSTEM",
    "SOUND_TECHNOLOGY", "IS_MOVIE", "IS_DOCUMENTARY", "IS_SHORT_FILM",
]
SERIE_COLUMNS = [
    "ID_SERIE", *_TITLE, "DAT_FIRST_AIR", "DAT_LAST_AIR", "SERIE_TYPE", "FIRST_AIR_YEAR",
    "FIRST_AIR_MONTH", "FIRST_AIR_DAY", "NUMBER_OF_EPISODES", "NUMBER_OF_SEASONS",
    "LAST_AIR_YEAR", "LAST_AIR_MONTH", "LAST_AIR_DAY",
]
PERSON_COLUMNS = [
    "ID_PERSON", "ID_IMDB", "ADULT", "BIRTHDAY", "DEATHDAY", "BIOGRAPHY", "PROFILE_PATH",
    "KNOWN_FOR_DEPARTMENT", "TIM_CREDITS_DOWNLOADED", "POPULARITY", "ALSO_KNOWN_AS", "DELETED",
    "COUNTRY_OF_BIRTH", "DAT_CREAT", "TIM_UPDATED", "ID_WIKIDATA", "HOMEPAGE_URL", "GENDER",
    "BIRTH_YEAR", "BIRTH_MONTH", "BIRTH_DAY", "DEATH_YEAR", "DEATH_MONTH", "DEATH_DAY",
]
COMPANY_COLUMNS = [
    "ID_COMPANY", "DESCRIPTION", "LOGO_PATH", "TIM_CREDITS_DOWNLOADED", "ORIGIN_COUNTRY",
    "HEADQUARTERS", "DAT_CREAT", "TIM_UPDATED", "DELETED", "ID_PARENT", "HOMEPAGE_URL",
    "MOVIE_COUNT", "SERIE_COUNT",
]
NETWORK_COLUMNS = [
    "ID_NETWORK", "LOGO_PATH", "TIM_CREDITS_DOWNLOADED", "ORIGIN_COUNTRY", "HEADQUARTERS",
    "DAT_CREAT", "TIM_UPDATED", "HOMEPAGE_URL", "SERIE_COUNT", "DELETED",
]


def publish_columns(df: DataFrame, columns: Sequence[str], renamed: Mapping[str, str]) -> DataFrame:
    """Project raw columns and rename some of them; a column the table lacks is an error."""
    missing = [c for c in [*columns, *renamed] if c not in df.columns]
    if missing:
        raise ValueError(f"columns missing in the raw table: {missing}")
    return df.select(*columns, *[F.col(old).alias(new) for old, new in renamed.items()])


def lookup_by(
    rows: DataFrame, key: str, link: str, lookup: DataFrame, lookup_key: str, renamed: Mapping[str, str]
) -> DataFrame:
    """Lookup values for each key of ``rows``, reached over its ``link`` column."""
    found = lookup.filter(present(lookup_key)).select(
        F.col(lookup_key).alias(link), F.struct(*[F.col(c).alias(n) for c, n in renamed.items()]).alias("_v")
    )
    found = found.groupBy(link).agg(F.min("_v").alias("_v"))
    linked = rows.filter(present(link)).select(key, link).join(found, link)
    return linked.select(key, "_v.*")


def _enriched_title(
    rows: DataFrame, key: str, title: str, tables: Mapping[str, DataFrame], wikidata: Mapping[str, str]
) -> DataFrame:
    ratings = tables["rating"].filter(F.col("averageRating").isNotNull())
    ratings = lookup_by(rows, key, "ID_IMDB", ratings, "tconst", {"averageRating": "IMDB_RATING"})
    french = tables[f"{title}_lang"].filter(F.col("LANG") == "fr")
    french = french.groupBy(key).agg(F.min("TITLE").alias(f"{title.upper()}_TITLE_FR"))
    graph = lookup_by(
        rows, key, "ID_WIKIDATA", tables[f"wikidata_{title}"], "ID_WIKIDATA", wikidata
    )
    return rows.join(ratings, key, "left").join(french, key, "left").join(graph, key, "left")


def publish_movies(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Eligible movies with ratings, French title, graph columns and page sections."""
    source = tables["movie"].filter(eligible_title())
    rows = publish_columns(source, MOVIE_COLUMNS, {"TITLE": "MOVIE_TITLE"})
    rows = _enriched_title(rows, "ID_MOVIE", "movie", tables, {
        "TITLE": "WIKIDATA_TITLE", "ALIASES": "ALIASES", "PLEX_MEDIA_KEY": "PLEX_MEDIA_KEY",
        "ID_CRITERION": "ID_CRITERION", "ID_CRITERION_SPINE": "ID_CRITERION_SPINE",
        "INSTANCE_OF": "INSTANCE_OF",
    })
    rating = adjusted_rating(
        "IMDB_RATING", F.col("IS_DOCUMENTARY") == 1, F.col("IS_MOVIE") == 1
    )
    rows = rows.withColumn("IMDB_RATING_ADJUSTED", rating)
    pages = tables["page_section"].filter((F.col("LANG") == "en") & (F.col("ITEM_TYPE") == "movie"))
    routed = route_sections(pages, "ID_WIKIDATA", ["DISPLAY_ORDER"])
    links = rows.filter(present("ID_WIKIDATA")).select("ID_MOVIE", "ID_WIKIDATA")
    routed = links.join(routed, "ID_WIKIDATA").drop("ID_WIKIDATA")
    return rows.join(routed, "ID_MOVIE", "left")


def publish_series(tables: Mapping[str, DataFrame]) -> DataFrame:
    source = tables["serie"].filter(eligible_title())
    rows = publish_columns(source, SERIE_COLUMNS, {"TITLE": "SERIE_TITLE"})
    rows = _enriched_title(rows, "ID_SERIE", "serie", tables, {
        "TITLE": "WIKIDATA_TITLE", "ALIASES": "ALIASES", "PLEX_MEDIA_KEY": "PLEX_MEDIA_KEY",
        "INSTANCE_OF": "INSTANCE_OF",
    })
    kind = F.col("SERIE_TYPE")
    rating = adjusted_rating("IMDB_RATING", kind == "Documentary", kind != "Documentary")
    return rows.withColumn("IMDB_RATING_ADJUSTED", rating)


def publish_persons(tables: Mapping[str, DataFrame]) -> DataFrame:
    source = tables["person"].filter(eligible_person())
    rows = publish_columns(source, PERSON_COLUMNS, {"NAME": "PERSON_NAME"})
    graph = lookup_by(
        rows, "ID_PERSON", "ID_WIKIDATA", tables["wikidata_person"], "ID_WIKIDATA",
        {"NAME": "WIKIDATA_NAME", "ALIASES": "ALIASES", "INSTANCE_OF": "INSTANCE_OF"},
    )
    return rows.join(graph, "ID_PERSON", "left")


def count_companies(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Companies with fresh member counts."""
    company = tables["company"]
    return with_counts(company, "ID_COMPANY", {
        "MOVIE_COUNT": member_counts(
            tables["pub_movie"], tables["movie_company"], company, "ID_MOVIE", "ID_COMPANY", "MOVIE_COUNT"),
        "SERIE_COUNT": member_counts(
            tables["pub_serie"], tables["serie_company"], company, "ID_SERIE", "ID_COMPANY", "SERIE_COUNT"),
    })


def publish_companies(counted: DataFrame) -> DataFrame:
    return publish_columns(
        counted.filter(eligible_company()), COMPANY_COLUMNS, {"NAME": "COMPANY_NAME"}
    )


def count_networks(tables: Mapping[str, DataFrame]) -> DataFrame:
    network = tables["network"]
    return with_counts(network, "ID_NETWORK", {
        "SERIE_COUNT": member_counts(
            tables["pub_serie"], tables["serie_network"], network, "ID_SERIE", "ID_NETWORK", "SERIE_COUNT"),
    })


def publish_networks(counted: DataFrame) -> DataFrame:
    return publish_columns(
        counted.filter(eligible_network()), NETWORK_COLUMNS, {"NAME": "NETWORK_NAME"}
    )


def publish_title_credits(tables: Mapping[str, DataFrame], title: str) -> DataFrame:
    """Credits whose person and title are both published."""
    return publish_credits(
        tables[f"person_{title}"], tables["pub_person"], tables[f"pub_{title}"], f"ID_{title.upper()}"
    )
