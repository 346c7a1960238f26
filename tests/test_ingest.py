"""Payload files to tables."""

import json
from datetime import date, datetime

import pytest

from cataloom import schemas
from cataloom.plans import ingest
from cataloom.sources.payloads import parse_payloads, read_payloads


@pytest.fixture
def land(spark, tmp_path):
    def write(kind, payloads):
        path = tmp_path / f"{kind}-{len(list(tmp_path.iterdir()))}.json"
        path.write_text("\n".join(json.dumps(p) for p in payloads))
        return read_payloads(spark, str(path), schemas.PAYLOADS[kind])
    return write


@pytest.fixture
def empty(spark):
    return {name: schemas.empty_table(spark, name) for name in schemas.TABLES}


def credit(i, person, **more):
    return {"id": person, "name": "n", "credit_id": f"c{i}", **more}


MOVIE = {
    "id": 1, "imdb_id": None, "title": "T" * 300, "original_title": "O", "release_date": "2024-02-29", "video": True,
    "runtime": 58, "genres": [{"id": 18, "name": "Drama"}, {"id": 99, "name": "Documentary"}], "overview": "o",
    "production_countries": [{"iso_3166_1": "FR"}, {"iso_3166_1": "US"}], "spoken_languages": [],
    "production_companies": [{"id": 5}, {"id": 6}, {"id": 5}], "belongs_to_collection": None,
    "external_ids": {"wikidata_id": "Q1"},
    "credits": {"cast": [credit(1, 7, character="A"), credit(2, 8, character="B"), credit(3, 7, character="C")],
                "crew": [credit(4, 7, department="Art", job="J")]},
}


def test_movie(land, empty, audit, rows_of):
    out = ingest.ingest_movies(empty, land("movie", [MOVIE, {"id": 2, "status_code": 34}]), audit)
    r = out["movie"].first()
    assert out["movie"].count() == 1
    assert (len(r.TITLE), r.ID_IMDB, r.ID_WIKIDATA, r.GENRES, r.COUNTRIES, r.SPOKEN_LANGUAGES) == (
        250, "", "Q1", "|Drama|Documentary|", "|FR|US|", "|")
    assert (r.DAT_RELEASE, r.RELEASE_DAY, r.VIDEO, r.IS_DOCUMENTARY, r.IS_MOVIE, r.IS_SHORT_FILM, r.ID_COLLECTION) == (
        date(2024, 2, 29), 29, 1, 1, 0, 1, 0)
    assert rows_of(out["movie_company"], "ID_COMPANY", "DISPLAY_ORDER") == [(5, 3), (6, 2)]
    assert rows_of(out["movie_production_country"], "COUNTRY_CODE", "DISPLAY_ORDER") == [("FR", 1), ("US", 2)]
    assert rows_of(out["person_movie"], "ID_CREDIT", "ID_PERSON", "CREDIT_TYPE", "DISPLAY_ORDER") == [
        ("c1", 7, "cast", 1), ("c2", 8, "cast", 2), ("c3", 7, "cast", 1), ("c4", 7, "crew", 1)]


def test_movie_again_shrinks_credits_but_keeps_links_of_empty_arrays(land, empty, audit, rows_of):
    first = {**empty, **ingest.ingest_movies(empty, land("movie", [MOVIE]), audit)}
    less = {**MOVIE, "release_date": "", "production_companies": [], "genres": [{"id": 18, "name": "Drama"}], "credits": {}}
    out = ingest.ingest_movies(first, land("movie", [less]), audit)
    assert out["person_movie"].count() == 0
    assert rows_of(out["movie_company"], "ID_COMPANY") == [(5,), (6,)]
    assert rows_of(out["movie_genre"], "ID_GENRE") == [(18,)]
    assert (out["movie"].first().DAT_RELEASE, out["movie"].first().IS_MOVIE) == (date(2024, 2, 29), 1)


def test_serie_creators(land, empty, audit, rows_of):
    payload = {
        "id": 3, "name": "S", "first_air_date": "2001-02-03", "last_air_date": "bad", "type": "Scripted",
        "networks": [{"id": 4}], "external_ids": {"imdb_id": "tt3"},
        "created_by": [{"id": 8, "credit_id": "k8"}, {"id": 7, "credit_id": "k7"}, {"id": 9, "credit_id": "k9"},
                       {"id": 8, "credit_id": "k8b"}],
        "credits": {"cast": [credit(1, 7, character="A")],
                    "crew": [credit(2, 6, department="Art", job="J"), credit(3, 8, department="Art", job="J"),
                             credit(4, 8, department="Sound", job="J")]},
    }
    out = ingest.ingest_series(empty, land("serie", [payload]), audit)
    r = out["serie"].first()
    assert (r.TITLE, r.DAT_FIRST_AIR, r.DAT_LAST_AIR, r.LAST_AIR_YEAR, r.ID_IMDB) == ("S", date(2001, 2, 3), None, None, "tt3")
    # 8 is in the crew at place 2; 7 only in the cast gets no row; 9 follows the last credit
    assert rows_of(out["person_serie"], "ID_CREDIT", "CREW_JOB", "DISPLAY_ORDER") == [
        ("c1", "", 1), ("c2", "J", 1), ("c3", "J", 3), ("c4", "J", 3), ("k8", "Creator", 2), ("k9", "Creator", 4)]


def test_serie_without_credits(land, empty, audit, rows_of):
    payload = {"id": 3, "name": "S", "created_by": [{"id": 8, "credit_id": "k8"}, {"id": 9, "credit_id": "k9"}]}
    out = ingest.ingest_series(empty, land("serie", [payload]), audit)
    assert rows_of(out["person_serie"], "ID_CREDIT", "DISPLAY_ORDER") == [("k8", 1), ("k9", 2)]


def test_person(land, empty, audit, rows_of):
    payload = {
        "id": 7, "name": "N", "birthday": "1950-01-02", "deathday": None, "also_known_as": ["a", "b"], "homepage": "h" * 300,
        "place_of_birth": " Paris ", "adult": False, "external_ids": {"wikidata_id": None},
        "combined_credits": {
            "cast": [{"media_type": "movie", "id": 1, "credit_id": "m1", "character": "A"},
                     {"media_type": "tv", "id": 2, "credit_id": "t1", "character": "B"}],
            "crew": [{"media_type": "movie", "id": 1, "credit_id": "m2", "department": "Art", "job": "J"}]},
    }
    out = ingest.ingest_persons(empty, land("person", [payload]), audit)
    r = out["person"].first()
    assert (r.ALSO_KNOWN_AS, len(r.HOMEPAGE_URL), r.PLACE_OF_BIRTH, r.BIRTH_YEAR, r.DEATH_YEAR, r.ID_WIKIDATA) == (
        "|a|b|", 250, "Paris", 1950, 0, "")
    assert rows_of(out["person_movie"], "ID_CREDIT", "ID_MOVIE", "CREW_JOB", "DISPLAY_ORDER") == [
        ("m1", 1, "", None), ("m2", 1, "J", None)]
    assert rows_of(out["person_serie"], "ID_CREDIT", "ID_SERIE", "CAST_CHARACTER") == [("t1", 2, "B")]
    gone = {**payload, "combined_credits": {}}
    again = ingest.ingest_persons({**empty, **out}, land("person", [gone]), audit)
    assert again["person_movie"].count() == 0 and again["person_serie"].count() == 0


def test_list_pages(land, empty, audit, rows_of):
    def page(n, items):
        return {"id": 9, "page": n, "total_pages": 3, "name": f"L{n}", "created_by": "",
                "items": [{"id": i, "media_type": m} for i, m in items]}
    pages = [page(2, [(3, "tv"), (4, "movie")]), page(1, [(1, "movie"), (2, "movie")]), page(3, [(1, "movie")])]
    out = ingest.ingest_lists(empty, land("list", pages), audit)
    assert rows_of(out["list"], "ID_LIST", "NAME", "CREATED_BY") == [(9, "L1", None)]
    assert rows_of(out["movie_list"], "ID_MOVIE", "DISPLAY_ORDER") == [(1, 5), (2, 2), (4, 4)]
    assert rows_of(out["serie_list"], "ID_SERIE", "DISPLAY_ORDER") == [(3, 3)]


def test_images(spark, land, empty, audit, rows_of):
    movie = empty["movie"].unionByName(spark.createDataFrame([(1,), (2,)], "ID_MOVIE long"), allowMissingColumns=True)
    payload = {"id": 1, "posters": [{"file_path": "/a", "width": 3}, {"file_path": ""}, {"file_path": "/c", "iso_639_1": "fr"}],
               "logos": [{"file_path": "/a"}]}
    out = ingest.ingest_images({**empty, "movie": movie}, land("images", [payload]), "movie", audit)
    assert rows_of(out["movie_image"], "TYPE_IMAGE", "IMAGE_PATH", "DISPLAY_ORDER", "WIDTH", "LANG") == [
        ("logo", "/a", 1, 0, None), ("poster", "/a", 1, 3, None), ("poster", "/c", 3, 0, "fr")]
    assert [str(r.TIM_IMAGES_COMPLETED) for r in out["movie"].orderBy("ID_MOVIE").collect()] == ["2024-01-02 03:04:05", "None"]
    again = ingest.ingest_images({**empty, **out}, land("images", [{"id": 1}]), "movie", audit)
    assert again["movie_image"].count() == 0


def test_videos(land, empty, audit, rows_of):
    payload = {"id": 1, "lang": "fr", "results": [
        {"id": "a", "published_at": "2024-07-01T10:00:00.000Z", "size": 1080, "official": True, "iso_639_1": "en"},
        {"id": ""}, {"id": "c", "published_at": "x"}]}
    out = ingest.ingest_videos(empty, land("videos", [payload]), "movie", audit)
    assert rows_of(out["movie_video"], "ID_CREDIT", "LANG", "DAT_PUBLISHED", "QUALITY_TEXT", "OFFICIAL", "DISPLAY_ORDER") == [
        ("a", "fr", datetime(2024, 7, 1, 12), "1080p", 1, 1), ("c", "fr", None, "0p", 0, 3)]
    other = {"id": 1, "lang": "de", "results": []}
    again = ingest.ingest_videos({**empty, **out}, land("videos", [other]), "movie", audit)
    assert again["movie_video"].count() == 2


def test_small_entities_keep_old_values(spark, land, empty, audit, rows_of):
    old = empty["company"].unionByName(
        spark.createDataFrame([(5, "old", "Paris")], "ID_COMPANY long, NAME string, HEADQUARTERS string"), allowMissingColumns=True)
    payload = [{"id": 5, "name": "", "headquarters": "x" * 300, "parent_company": None}, {"id": 6, "name": "new"}]
    out = ingest.ingest_small({"company": old}, land("company", payload), "company", audit)
    got = {r.ID_COMPANY: r for r in out["company"].collect()}
    assert (got[5].NAME, len(got[5].HEADQUARTERS), got[5].ID_PARENT, got[6].NAME) == ("old", 200, 0, "new")


def test_refresh_and_remove(spark, land, empty, audit, rows_of):
    landed = {"main": land("movie", [MOVIE]), "keywords": land("keywords", [{"id": 1, "keywords": [{"id": 3, "name": "k"}]}]),
              "lang": land("title_lang", [{"id": 1, "lang": "fr", "title": "", "overview": "r"}])}
    out = ingest.refresh_titles(empty, landed, "movie", audit)
    r = out["movie"].first()
    assert r.TIM_CREDITS_COMPLETED and r.TIM_KEYWORDS_COMPLETED and not r.TIM_IMAGES_COMPLETED
    assert rows_of(out["movie_keyword"], "ID_KEYWORD") == [(3,)]
    assert rows_of(out["movie_lang"], "LANG", "TITLE", "OVERVIEW") == [("fr", None, "r")]
    left = ingest.remove_gone(out, spark.createDataFrame([(1,)], "ID_MOVIE long"), "movie")
    assert all(df.count() == 0 for df in left.values()) and "person_movie" in left


def test_last_written_entry_of_a_credit_counts(land, empty, audit, rows_of):
    twice = {**MOVIE, "credits": {
        "cast": [credit(1, 7, character="A"), credit(2, 8, character="B"), credit(2, 9, character="C")],
        "crew": [credit(1, 6, department="Art", job="J"), {"id": 5, "name": "n", "department": "Art", "job": "K"},
                 {"id": 4, "name": "n", "department": "Art", "job": "L"}]}}
    out = ingest.ingest_movies(empty, land("movie", [twice]), audit)["person_movie"]
    assert rows_of(out, "ID_CREDIT", "ID_PERSON", "CREDIT_TYPE", "CREW_JOB", "DISPLAY_ORDER") == [
        ("c1", 6, "crew", "J", 1), ("c2", 9, "cast", "", 3)]


def test_normal_series_row_is_written_after_the_creator_row(land, empty, audit, rows_of):
    serie = {"id": 3, "name": "S", "created_by": [{"id": 6, "credit_id": "c4", "name": "n"}, {"id": 9, "credit_id": "c9", "name": "n"}],
             "credits": {"cast": [], "crew": [credit(4, 6, department="Art", job="J")]}}
    out = ingest.ingest_series(empty, land("serie", [serie]), audit)["person_serie"]
    assert rows_of(out, "ID_CREDIT", "ID_PERSON", "CREW_JOB", "DISPLAY_ORDER") == [("c4", 6, "J", 2), ("c9", 9, "Creator", 3)]


def test_last_entry_of_a_person_credit_and_of_a_video_counts(land, empty, audit, rows_of):
    entry = {"media_type": "movie", "id": 1, "credit_id": "c1"}
    person = {"id": 2, "name": "P", "combined_credits": {
        "cast": [{**entry, "character": "A"}], "crew": [{**entry, "department": "Art", "job": "J"}]}}
    out = ingest.ingest_persons(empty, land("person", [person]), audit)["person_movie"]
    assert rows_of(out, "ID_CREDIT", "CREDIT_TYPE", "CREW_JOB") == [("c1", "crew", "J")]
    videos = {"id": 1, "lang": "fr", "results": [{"id": "v", "name": "first"}, {"id": "v", "name": "second"}]}
    out = ingest.ingest_videos(empty, land("videos", [videos]), "movie", audit)["movie_video"]
    assert rows_of(out, "ID_CREDIT", "VIDEO_NAME", "DISPLAY_ORDER") == [("v", "second", 2)]


def test_unreadable_payloads_are_dropped(spark, empty, audit, tmp_path):
    path = tmp_path / "bad.json"
    path.write_text('garbage{\n{"title": "no id"}\n{"id": 1, "title": "T"}\n\n{"id": 2, "status_code": 34}\n')
    payloads = read_payloads(spark, str(path), schemas.PAYLOADS["movie"])
    assert [r.id for r in payloads.collect()] == [1]
    texts = spark.createDataFrame([("garbage{",), ("",), (None,), ('{"id": 3}',), ('{"x": 1}',)], "body string")
    assert [r.payload.id for r in parse_payloads(texts, "body", "id long, status_code int").collect()] == [3]
    assert [r.payload.k for r in parse_payloads(texts, "body", "k int, status_code int").collect()] == [None, None]


def test_places_of_a_person_are_found_inside_a_payload(spark, land, rows_of):
    """Payloads of one id share the first places of a person; other credits do not move before they meet by id."""
    def cast(*persons, start):
        return {"cast": [credit(start + k, p, character="A") for k, p in enumerate(persons)], "crew": []}

    landed = land("movie", [
        {"id": 1, "credits": cast(7, 8, 7, None, None, start=0)}, {"id": 2, "credits": cast(8, 7, start=10)},
        {"id": 2, "credits": cast(7, 7, 8, start=20)}, {"id": 3, "credits": None},
    ])
    got = ingest.payload_credits(landed, "ID_MOVIE")
    assert rows_of(got, "ID_CREDIT", "DISPLAY_ORDER") == [
        ("c0", 1), ("c1", 2), ("c10", 1), ("c11", 1), ("c2", 1), ("c20", 1), ("c21", 1), ("c22", 1), ("c3", 4), ("c4", 4)]
    plan = got._jdf.queryExecution().optimizedPlan()
    while plan.nodeName() != "Union":
        plan = plan.children().head()
    whole = plan.children().head()
    assert "Window" not in whole.toString()
    assert spark._jvm.org.apache.spark.sql.classic.Dataset.ofRows(spark._jsparkSession, whole).count() == 5
