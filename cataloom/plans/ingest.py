"""Payloads to entity tables, bridges, credits, images and videos.

Each function takes the current tables and typed payload rows and returns the
tables it changed.  One payload per id is expected in a batch.  A job reads the
payloads once per table it writes: stage JSON payloads as Parquet first
(``session.stage``), then each of these reads only the columns it needs.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import values as V
from ..functions.columns import (
    clip, flag, list_to_pipe, present, short_film_flag, split_date, text_or_empty, to_local,
    trim_spaces,
)
from ..operators.changes import (
    Audit, cascade_delete, replace_children, stamp, stamp_all, sync_children, upsert,
)
from ..operators.relate import may_hold, membership_filter, number_items
from ..sources.payloads import explode_pages

Tables = dict[str, DataFrame]
c = F.col


def _or_zero(name: str) -> Column:
    return F.coalesce(c(name), F.lit(0))


def _fields(array: str, field: str) -> Column:
    return F.transform(array, lambda x: x[field])


def _dates(column: str, prefix: str, date_name: str) -> dict[str, Column]:
    """Date columns that are written only for a valid date."""
    parts = split_date(column)
    valid = parts["year"] > 0
    return {
        date_name: parts["date"],
        **{
            f"{prefix}_{unit.upper()}": F.when(valid, parts[unit]) for unit in ("year", "month", "day")
        },
    }


# --- bridges ----------------------------------------------------------------


def link_items(payloads: DataFrame, key: str, items: Column, child: str) -> DataFrame:
    """(entity, child, DISPLAY_ORDER) rows of an array; a repeated child keeps its last place."""
    rows = number_items(payloads.select(c("id").alias(key), items.alias("_items")), [key], "_items", child)
    return rows.groupBy(key, child).agg(F.max("DISPLAY_ORDER").alias("DISPLAY_ORDER"))


def write_links(
    target: DataFrame, links: DataFrame, key: str, child: str, audit: Audit, delete: bool = True
) -> DataFrame:
    """Upsert links and drop those a payload no longer names; empty arrays delete nothing."""
    if not delete:
        return upsert(target, links, [key, child], audit)
    return replace_children(target, links, [key, child], [key], audit)


_TITLE_LINKS = [
    ("production_country", "production_countries", "iso_3166_1", "COUNTRY_CODE"),
    ("spoken_language", "spoken_languages", "iso_639_1", "SPOKEN_LANGUAGE"),
    ("company", "production_companies", "id", "ID_COMPANY"),
    ("genre", "genres", "id", "ID_GENRE"),
]


# --- credits ----------------------------------------------------------------


def _credit(x: Column, kind: str, order: Column) -> Column:
    cast = kind == "cast"
    empty = F.lit("")
    return F.struct(
        x["credit_id"].alias("ID_CREDIT"), x["id"].alias("ID_PERSON"),
        F.lit(kind).alias("CREDIT_TYPE"),
        (x["character"] if cast else empty).alias("CAST_CHARACTER"),
        (empty if cast else x["department"]).alias("CREW_DEPARTMENT"),
        (empty if cast else x["job"]).alias("CREW_JOB"),
        order.cast("int").alias("DISPLAY_ORDER"),
    )


_CREDIT = (
    "array<struct<part:int,place:int,step:int,ID_CREDIT:string,ID_PERSON:bigint,CREDIT_TYPE:string,"
    "CAST_CHARACTER:string,CREW_DEPARTMENT:string,CREW_JOB:string,DISPLAY_ORDER:int>>"
)


def _written(part: int, place: Column, step: int, credit: Column) -> Column:
    """A credit with the position at which it is written."""
    names = ("ID_CREDIT", "ID_PERSON", "CREDIT_TYPE", "CAST_CHARACTER", "CREW_DEPARTMENT", "CREW_JOB", "DISPLAY_ORDER")
    return F.struct(
        F.lit(part).alias("part"), place.cast("int").alias("place"), F.lit(step).alias("step"),
        *[credit[n].alias(n) for n in names],
    )


def _entries(array: Column, kind: str) -> Column:
    """Credits of one payload array at their own places."""
    part = 0 if kind == "cast" else 1
    rows = F.transform(array, lambda x, i: _written(part, i, 1, _credit(x, kind, i + 1)))
    return F.coalesce(rows, F.array()).cast(_CREDIT)


def _first_places(rows: DataFrame, key: str) -> DataFrame:
    """Every entry of a person in one list of a payload takes the person's first place in it."""
    first = F.min("DISPLAY_ORDER").over(Window.partitionBy(key, "part", "ID_PERSON"))
    return rows.withColumn("DISPLAY_ORDER", first)


def _last_written(rows: DataFrame, key: str) -> DataFrame:
    """One row per credit: the one written last.  A credit without id is refused."""
    rest = [n for n in rows.columns if n not in ("ID_CREDIT", "part", "place", "step", key)]
    last = F.max(F.struct(key, "part", "place", "step", *rest)).alias("_last")
    picked = rows.filter("ID_CREDIT is not null").groupBy("ID_CREDIT").agg(last)
    return picked.select("ID_CREDIT", f"_last.{key}", *[f"_last.{n}" for n in rest])


def _placed(array: Column) -> Column:
    """Entries of one payload array, of which those of a person take the person's first place in it."""
    persons = F.transform(array, lambda x: F.coalesce(x["ID_PERSON"].cast("string"), F.lit("")))

    def placed(x: Column) -> Column:
        first = F.array_position(persons, F.coalesce(x["ID_PERSON"].cast("string"), F.lit("")))
        return x.withField("DISPLAY_ORDER", first.cast("int"))

    return F.transform(array, placed)


def payload_credits(payloads: DataFrame, key: str) -> DataFrame:
    """Cast and crew rows of title payloads, ordered inside each payload; the last entry of a credit counts.

    The places are found inside a payload, before its credits are sent.  Only payloads whose id comes again (and a few
    others, by a ``membership_filter`` of these ids) have theirs compared by movie.
    """
    cast, crew = _entries(c("credits.cast"), "cast"), _entries(c("credits.crew"), "crew")
    again = payloads.groupBy("id").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    repeated = may_hold(membership_filter(again.select(F.xxhash64("id").alias("_hash")), "_hash"), F.xxhash64("id"))
    whole = payloads.filter(~repeated).select(c("id").alias(key), F.inline(F.concat(_placed(cast), _placed(crew))))
    parts = payloads.filter(repeated).select(c("id").alias(key), F.inline(F.concat(cast, crew)))
    return _last_written(whole.unionByName(_first_places(parts, key).select(*whole.columns)), key)


def serie_credits(payloads: DataFrame) -> DataFrame:
    """Series credits with creators.

    A creator in the crew gets a Creator row at the person's place and the other
    credits of that person move one place down.  Creators found nowhere in the
    credits follow after the last credit.  Cast is written first, then crew, a
    Creator row just before the person's first entry; the last entry of a credit counts.
    """
    key = "ID_SERIE"
    rows = payloads.select(
        c("id").alias(key),
        c("credits.cast").alias("_cast"), c("credits.crew").alias("_crew"), c("created_by").alias("_by"),
    )
    nobody = F.array().cast("array<bigint>")
    rows = rows.withColumns({
        out: F.coalesce(_fields(array, "id"), nobody)
        for out, array in (("_makers", "_by"), ("_in_crew", "_crew"), ("_in_cast", "_cast"))
    })

    def creator(x: Column, order: Column) -> Column:
        named = F.struct(
            x["credit_id"].alias("credit_id"), x["id"].alias("id"), F.lit("").alias("character"),
            F.lit("Creator").alias("department"), F.lit("Creator").alias("job"),
        )
        return _credit(named, "crew", order)

    normal = F.concat(_entries(c("_cast"), "cast"), _entries(c("_crew"), "crew"))
    listed = _first_places(rows.select(key, "_makers", F.inline(normal)), key)
    moved = (c("part") == 1) & F.array_contains("_makers", c("ID_PERSON"))
    listed = listed.withColumn("DISPLAY_ORDER", c("DISPLAY_ORDER") + F.when(moved, 1).otherwise(0)).drop("_makers")
    # of several entries of one creator the first counts
    in_crew = F.filter(
        "_by",
        lambda x, i: F.array_contains(c("_in_crew"), x["id"])
        & (F.array_position(c("_makers"), x["id"]) == i + 1),
    )

    def at(x: Column) -> Column:
        return F.array_position(c("_in_crew"), x["id"])

    crew_creators = F.transform(in_crew, lambda x: _written(1, at(x) - 1, 0, creator(x, at(x))))
    absent = F.filter(
        "_by",
        lambda x: ~F.array_contains(c("_in_crew"), x["id"]) & ~F.array_contains(c("_in_cast"), x["id"]),
    )
    # the order of the last normal entry: the first place of its person, moved for a creator
    person = F.element_at("_in_crew", -1)
    last = (
        F.when(F.size("_in_crew") > 0, F.array_position("_in_crew", person)
               + F.when(F.array_contains("_makers", person), 1).otherwise(0))
        .when(F.size("_in_cast") > 0, F.array_position("_in_cast", F.element_at("_in_cast", -1)))
        .otherwise(0)
    )
    late = F.transform(absent, lambda x, i: _written(2, i, 0, creator(x, c("_end") + i + 1)))
    none = F.array().cast(_CREDIT)
    creators = rows.withColumn("_end", last).select(
        key, F.inline(F.concat(F.coalesce(crew_creators, none).cast(_CREDIT), F.coalesce(late, none).cast(_CREDIT))))
    return _last_written(listed.unionByName(creators), key)


def write_credits(
    target: DataFrame, credits: DataFrame, payloads: DataFrame, key: str, audit: Audit
) -> DataFrame:
    """Upsert credits; every payload clears its entity down to its own credits."""
    parents = payloads.select(c("id").alias(key))
    return replace_children(target, credits, ["ID_CREDIT"], [key], audit, "purge", parents)


# --- titles -----------------------------------------------------------------


def _title_row(extra: Mapping[str, Column]) -> list[Column]:
    columns = {
        "ID_WIKIDATA": text_or_empty("external_ids.wikidata_id"),
        "OVERVIEW": c("overview"), "TAGLINE": c("tagline"), "STATUS": c("status"),
        "POSTER_PATH": c("poster_path"), "BACKDROP_PATH": c("backdrop_path"),
        "HOMEPAGE_URL": clip("homepage", V.URL_CHARS),
        "ORIGINAL_LANGUAGE": c("original_language"), "ADULT": flag(c("adult")),
        "POPULARITY": _or_zero("popularity"), "VOTE_AVERAGE": _or_zero("vote_average"),
        "VOTE_COUNT": _or_zero("vote_count"),
        "GENRES": list_to_pipe(_fields("genres", "name")),
        "COUNTRIES": list_to_pipe(_fields("production_countries", "iso_3166_1")),
        "SPOKEN_LANGUAGES": list_to_pipe(_fields("spoken_languages", "iso_639_1")),
        **extra,
    }
    return [value.alias(name) for name, value in columns.items()]


def movie_rows(payloads: DataFrame) -> DataFrame:
    documentary = F.coalesce(F.array_contains(_fields("genres", "name"), "Documentary"), F.lit(False))
    return payloads.select(*_title_row({
        "ID_MOVIE": c("id"), "ID_IMDB": text_or_empty("imdb_id"),
        "TITLE": clip("title", V.TITLE_CHARS), "ORIGINAL_TITLE": clip("original_title", V.TITLE_CHARS),
        "VIDEO": flag(c("video")), "BUDGET": _or_zero("budget"), "REVENUE": _or_zero("revenue"),
        "RUNTIME": _or_zero("runtime"), "IS_SHORT_FILM": short_film_flag("runtime"),
        "ID_COLLECTION": F.coalesce("belongs_to_collection.id", F.lit(0)),
        "IS_DOCUMENTARY": flag(documentary), "IS_MOVIE": flag(~documentary),
        **_dates("release_date", "RELEASE", "DAT_RELEASE"),
    }))


def serie_rows(payloads: DataFrame) -> DataFrame:
    return payloads.select(*_title_row({
        "ID_SERIE": c("id"), "ID_IMDB": text_or_empty("external_ids.imdb_id"),
        "TITLE": clip("name", V.TITLE_CHARS), "ORIGINAL_TITLE": clip("original_name", V.TITLE_CHARS),
        "NUMBER_OF_EPISODES": _or_zero("number_of_episodes"),
        "NUMBER_OF_SEASONS": _or_zero("number_of_seasons"), "SERIE_TYPE": c("type"),
        **_dates("first_air_date", "FIRST_AIR", "DAT_FIRST_AIR"),
        **_dates("last_air_date", "LAST_AIR", "DAT_LAST_AIR"),
    }))


_MOVIE_DATES = ["DAT_RELEASE", "RELEASE_YEAR", "RELEASE_MONTH", "RELEASE_DAY"]
_SERIE_DATES = [
    "DAT_FIRST_AIR", "FIRST_AIR_YEAR", "FIRST_AIR_MONTH", "FIRST_AIR_DAY",
    "DAT_LAST_AIR", "LAST_AIR_YEAR", "LAST_AIR_MONTH", "LAST_AIR_DAY",
]


def _ingest_title(
    tables: Mapping[str, DataFrame], payloads: DataFrame, title: str, rows: DataFrame,
    credits: DataFrame, links: Sequence[tuple[str, str, str, str]], dates: Sequence[str], audit: Audit,
) -> Tables:
    key = f"ID_{title.upper()}"
    out = {title: upsert(tables[title], rows, [key], audit, optional=dates)}
    for name, array, field, child in links:
        found = link_items(payloads, key, _fields(array, field), child)
        out[f"{title}_{name}"] = write_links(tables[f"{title}_{name}"], found, key, child, audit)
    out[f"person_{title}"] = write_credits(tables[f"person_{title}"], credits, payloads, key, audit)
    return out


def ingest_movies(tables: Mapping[str, DataFrame], payloads: DataFrame, audit: Audit) -> Tables:
    return _ingest_title(
        tables, payloads, "movie", movie_rows(payloads), payload_credits(payloads, "ID_MOVIE"),
        _TITLE_LINKS, _MOVIE_DATES, audit,
    )


def ingest_series(tables: Mapping[str, DataFrame], payloads: DataFrame, audit: Audit) -> Tables:
    links = [*_TITLE_LINKS, ("network", "networks", "id", "ID_NETWORK")]
    return _ingest_title(
        tables, payloads, "serie", serie_rows(payloads), serie_credits(payloads), links,
        _SERIE_DATES, audit,
    )


# --- persons ----------------------------------------------------------------


def person_rows(payloads: DataFrame) -> DataFrame:
    born, died = split_date("birthday"), split_date("deathday")
    columns = {
        "ID_PERSON": c("id"), "NAME": c("name"),
        "ID_IMDB": text_or_empty("imdb_id"), "ID_WIKIDATA": text_or_empty("external_ids.wikidata_id"),
        "ALSO_KNOWN_AS": list_to_pipe(F.coalesce("also_known_as", F.array().cast("array<string>"))),
        "BIOGRAPHY": c("biography"),
        "BIRTHDAY": born["date"], "BIRTH_YEAR": born["year"], "BIRTH_MONTH": born["month"],
        "BIRTH_DAY": born["day"],
        "DEATHDAY": died["date"], "DEATH_YEAR": died["year"], "DEATH_MONTH": died["month"],
        "DEATH_DAY": died["day"],
        "GENDER": c("gender"), "ADULT": flag(c("adult")), "POPULARITY": c("popularity"),
        "KNOWN_FOR_DEPARTMENT": c("known_for_department"),
        "PLACE_OF_BIRTH": text_or_empty(trim_spaces("place_of_birth")),
        "PROFILE_PATH": c("profile_path"), "HOMEPAGE_URL": clip("homepage", V.PERSON_URL_CHARS),
    }
    return payloads.select(*[value.alias(name) for name, value in columns.items()])


def person_credits(payloads: DataFrame, media: str, key: str) -> DataFrame:
    """Credits of one media type, the last entry of a credit; a person payload carries no display order."""
    none = F.lit(None).cast("int")

    def side(kind: str) -> Column:
        rows = F.transform(
            f"combined_credits.{kind}",
            lambda x, i: F.struct(x["media_type"].alias("media"), i.alias("place"), x["id"].alias(key), _credit(
                F.struct(
                    x["credit_id"].alias("credit_id"), c("id").alias("id"),
                    x["character"].alias("character"), x["department"].alias("department"),
                    x["job"].alias("job"),
                ), kind, none).alias("credit"))
        )
        return F.explode_outer(rows)

    parts = [
        payloads.select(side(kind).alias("_c")).filter(c("_c.media") == media)
        .select(F.lit(part).alias("part"), "_c.place", F.lit(0).alias("step"), f"_c.{key}", "_c.credit.*")
        .drop("DISPLAY_ORDER")
        for part, kind in enumerate(("cast", "crew"))
    ]
    rows = reduce(DataFrame.unionByName, parts)
    return _last_written(rows, "ID_PERSON")


def ingest_persons(tables: Mapping[str, DataFrame], payloads: DataFrame, audit: Audit) -> Tables:
    out = {
        "person": upsert(
            tables["person"], person_rows(payloads), ["ID_PERSON"], audit, optional=["BIRTHDAY", "DEATHDAY"]
        )
    }
    for title, media in (("movie", "movie"), ("serie", "tv")):
        credits = person_credits(payloads, media, f"ID_{title.upper()}")
        out[f"person_{title}"] = write_credits(
            tables[f"person_{title}"], credits, payloads, "ID_PERSON", audit
        )
    return out


# --- language rows, keywords, small entities --------------------------------


def ingest_variants(
    tables: Mapping[str, DataFrame], payloads: DataFrame, entity: str, audit: Audit
) -> Tables:
    """Language rows of movies, series or collections; an empty name leaves the old one."""
    name = "NAME" if entity == "collection" else "TITLE"
    source = "title" if entity == "movie" else "name"
    key = f"ID_{entity.upper()}"
    columns = {
        key: c("id"), "LANG": c("lang"), name: clip(source, V.TITLE_CHARS), "OVERVIEW": c("overview"),
        "POSTER_PATH": c("poster_path"), "BACKDROP_PATH": c("backdrop_path"),
    }
    if entity != "collection":
        columns["TAGLINE"] = c("tagline")
    rows = payloads.select(*[v.alias(n) for n, v in columns.items()])
    table = f"{entity}_lang"
    return {table: upsert(tables[table], rows, [key, "LANG"], audit, optional=[name])}


def ingest_keyword_links(
    tables: Mapping[str, DataFrame], payloads: DataFrame, title: str, audit: Audit
) -> Tables:
    """Keyword links of titles.  Links a payload no longer names stay."""
    key, table = f"ID_{title.upper()}", f"{title}_keyword"
    array = "keywords" if title == "movie" else "results"
    links = link_items(payloads, key, _fields(array, "id"), "ID_KEYWORD")
    return {table: write_links(tables[table], links, key, "ID_KEYWORD", audit, delete=False)}


# columns of the small entities: always written, written when non-empty
def _small_columns(entity: str) -> tuple[dict[str, Column], dict[str, Column]]:
    homepage, head = clip("homepage", V.URL_CHARS), clip("headquarters", V.HEADQUARTERS_CHARS)
    if entity == "collection":
        return (
            {"OVERVIEW": c("overview"), "POSTER_PATH": c("poster_path"), "BACKDROP_PATH": c("backdrop_path")},
            {"NAME": c("name")},
        )
    if entity == "keyword":
        return {}, {"NAME": c("name")}
    shared = {
        "NAME": c("name"), "LOGO_PATH": c("logo_path"), "HEADQUARTERS": head,
        "HOMEPAGE_URL": homepage, "ORIGIN_COUNTRY": c("origin_country"),
    }
    if entity == "network":
        return {}, shared
    parent = F.coalesce("parent_company.id", F.lit(0))
    return {"ID_PARENT": parent}, {**shared, "DESCRIPTION": c("description")}


def ingest_small(tables: Mapping[str, DataFrame], payloads: DataFrame, entity: str, audit: Audit) -> Tables:
    """Collections, companies, networks and keywords."""
    always, optional = _small_columns(entity)
    key = f"ID_{entity.upper()}"
    columns = {key: c("id"), **always, **optional}
    rows = payloads.select(*[v.alias(n) for n, v in columns.items()])
    return {entity: upsert(tables[entity], rows, [key], audit, optional=list(optional))}


def ingest_lists(tables: Mapping[str, DataFrame], pages: DataFrame, audit: Audit) -> Tables:
    """Lists spread over pages: header from page 1, one numbering for all items."""
    header = pages.filter(c("page") == 1).select(
        c("id").alias("ID_LIST"), c("description").alias("DESCRIPTION"),
        c("poster_path").alias("POSTER_PATH"), c("name").alias("NAME"), c("created_by").alias("CREATED_BY"),
    )
    out = {"list": upsert(tables["list"], header, ["ID_LIST"], audit, optional=["NAME", "CREATED_BY"])}
    items = explode_pages(pages.select(c("id").alias("ID_LIST"), "page", "items"), "ID_LIST", "page", "items")
    movie = F.coalesce(c("item.media_type") == "movie", F.lit(False))
    for title, wanted in (("movie", movie), ("serie", ~movie)):
        key, table = f"ID_{title.upper()}", f"{title}_list"
        links = items.filter(wanted).groupBy("ID_LIST", c("item.id").alias(key))
        links = links.agg(F.max("DISPLAY_ORDER").alias("DISPLAY_ORDER"))
        out[table] = replace_children(tables[table], links, [key, "ID_LIST"], ["ID_LIST"], audit)
    return out


# --- images and videos ------------------------------------------------------

_IMAGE_ARRAYS = [("backdrops", "backdrop"), ("posters", "poster"), ("logos", "logo"), ("profiles", "profile")]


def image_rows(payloads: DataFrame, key: str) -> DataFrame:
    """Images numbered per array; an image without path still takes a number."""
    parts = []
    for array, kind in _IMAGE_ARRAYS:
        rows = number_items(payloads.select(c("id").alias(key), array), [key], array)
        parts.append(rows.filter(present("item.file_path")).select(
            key, F.lit(kind).alias("TYPE_IMAGE"), c("item.file_path").alias("IMAGE_PATH"),
            c("item.iso_639_1").alias("LANG"),
            *[
                F.coalesce(c(f"item.{field}"), F.lit(0)).alias(field.upper())
                for field in ("aspect_ratio", "width", "height", "vote_average", "vote_count")
            ],
            "DISPLAY_ORDER",
        ))
    rows = reduce(DataFrame.unionByName, parts)
    link = [key, "TYPE_IMAGE", "IMAGE_PATH"]
    rest = [n for n in rows.columns if n not in link and n != "DISPLAY_ORDER"]
    last = F.max(F.struct("DISPLAY_ORDER", *rest)).alias("_last")
    return rows.groupBy(*link).agg(last).select(*link, "_last.*")


def ingest_images(
    tables: Mapping[str, DataFrame], payloads: DataFrame, entity: str, audit: Audit, mark: bool = True
) -> Tables:
    """Images of any entity; those a payload no longer names are purged.  ``mark`` stamps the entity."""
    key, table = f"ID_{entity.upper()}", f"{entity}_image"
    rows = image_rows(payloads, key)
    written = upsert(tables[table], rows, [key, "TYPE_IMAGE", "IMAGE_PATH"], audit)
    parents = payloads.select(c("id").alias(key))
    out = {table: sync_children(written, rows, [key], ["IMAGE_PATH"], "purge", parents)}
    if mark:
        out[entity] = stamp(tables[entity], parents, key, ["TIM_IMAGES_COMPLETED"], audit.now)
    return out


def video_rows(payloads: DataFrame, key: str, tz: str) -> DataFrame:
    rows = number_items(
        payloads.select(c("id").alias(key), c("lang").alias("LANG"), "results"), [key, "LANG"], "results"
    )
    rows = rows.filter(present("item.id")).select(
        key, "LANG", c("item.id").alias("ID_CREDIT"),
        to_local("item.published_at", tz).alias("DAT_PUBLISHED"),
        c("item.type").alias("VIDEO_TYPE"), c("item.iso_3166_1").alias("COUNTRY_CODE"),
        c("item.key").alias("VIDEO_KEY"), c("item.name").alias("VIDEO_NAME"),
        c("item.site").alias("VIDEO_SITE"), F.coalesce("item.size", F.lit(0)).alias("QUALITY"),
        F.concat(F.coalesce("item.size", F.lit(0)).cast("string"), F.lit("p")).alias("QUALITY_TEXT"),
        flag(c("item.official")).alias("OFFICIAL"), "DISPLAY_ORDER",
    )
    # of several entries of one video the last counts
    link = [key, "LANG", "ID_CREDIT"]
    rest = [n for n in rows.columns if n not in link and n != "DISPLAY_ORDER"]
    last = F.max(F.struct("DISPLAY_ORDER", *rest)).alias("_last")
    return rows.groupBy(*link).agg(last).select(*link, "_last.*")


def ingest_videos(
    tables: Mapping[str, DataFrame], payloads: DataFrame, title: str, audit: Audit, tz: str = "Europe/Paris",
    mark: bool = True,
) -> Tables:
    """Videos of titles in the requested language; those no longer named are purged.  ``mark`` stamps the title."""
    key, table = f"ID_{title.upper()}", f"{title}_video"
    rows = video_rows(payloads, key, tz)
    parents = payloads.select(c("id").alias(key), c("lang").alias("LANG"))
    link = [key, "LANG", "ID_CREDIT"]
    out = {table: replace_children(tables[table], rows, link, [key, "LANG"], audit, "purge", parents)}
    if mark:
        out[title] = stamp(tables[title], parents, key, ["TIM_VIDEOS_COMPLETED"], audit.now)
    return out


# --- whole entities ---------------------------------------------------------


def refresh_titles(
    tables: Mapping[str, DataFrame], landed: Mapping[str, DataFrame], title: str, audit: Audit
) -> Tables:
    """Everything a title refresh writes, in dependency order.

    ``landed`` holds the payload kinds that arrived: ``main``, ``lang``,
    ``keywords``, ``images``, ``videos``.
    """
    current = dict(tables)
    key = f"ID_{title.upper()}"
    main = ingest_movies if title == "movie" else ingest_series
    steps = {
        "main": lambda p: main(current, p, audit),
        "lang": lambda p: ingest_variants(current, p, title, audit),
        "keywords": lambda p: ingest_keyword_links(current, p, title, audit),
        "images": lambda p: ingest_images(current, p, title, audit, mark=False),
        "videos": lambda p: ingest_videos(current, p, title, audit, mark=False),
    }
    stamps = {
        "main": ["TIM_CREDITS_COMPLETED", "TIM_UPDATED"], "keywords": ["TIM_KEYWORDS_COMPLETED"],
        "images": ["TIM_IMAGES_COMPLETED"], "videos": ["TIM_VIDEOS_COMPLETED"],
    }
    done: dict[str, list[DataFrame]] = {}
    for kind, step in steps.items():
        if kind not in landed:
            continue
        current.update(step(landed[kind]))
        for column in stamps.get(kind, ()):
            done.setdefault(column, []).append(landed[kind].select(c("id").alias(key)))
    # all completion times in one join
    current[title] = stamp_all(current[title], done, key, audit.now)
    return current


def refresh_entities(
    tables: Mapping[str, DataFrame], landed: Mapping[str, DataFrame], entity: str, audit: Audit
) -> Tables:
    """Everything a person, collection, company, network, keyword or list refresh writes."""
    current = dict(tables)
    key, main = f"ID_{entity.upper()}", landed["main"]
    if entity == "person":
        current.update(ingest_persons(current, main, audit))
    elif entity == "list":
        current.update(ingest_lists(current, main, audit))
    else:
        current.update(ingest_small(current, main, entity, audit))
    ids = main.select(c("id").alias(key))
    current[entity] = stamp(
        current[entity], ids, key, ["TIM_CREDITS_COMPLETED", "TIM_UPDATED"], audit.now
    )
    if entity == "collection" and "lang" in landed:
        current.update(ingest_variants(current, landed["lang"], entity, audit))
    if "images" in landed:
        current.update(ingest_images(current, landed["images"], entity, audit))
    return current


CHILD_TABLES = {
    "movie": ["movie", "movie_lang", "movie_lang_meta", "movie_list", "movie_genre", "movie_keyword",
              "movie_lemma", "movie_image", "movie_video", "person_movie"],
    "serie": ["serie", "serie_lang", "serie_lang_meta", "serie_list", "serie_genre", "serie_keyword",
              "serie_lemma", "serie_image", "serie_video", "person_serie"],
    "person": ["person", "person_movie", "person_serie", "person_image"],
}


def remove_gone(tables: Mapping[str, DataFrame], gone: DataFrame, entity: str) -> Tables:
    """Delete ids known to be gone upstream from the entity and its child tables."""
    owned = {n: tables[n] for n in CHILD_TABLES[entity] if n in tables}
    return cascade_delete(owned, gone, f"ID_{entity.upper()}")
