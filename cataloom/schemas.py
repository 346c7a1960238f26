"""Schemas as DDL text: payload shapes and catalogue tables.

Nothing is inferred at run time; names are those users of the catalogue query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

AUDIT = (
    "DELETED int, DAT_CREAT date, TIM_UPDATED timestamp_ntz, ID_CREATOR int, ID_OWNER int, "
    "ID_USER_UPDATED int"
)

# --- payloads ---------------------------------------------------------------

_CREDIT = "struct<id:bigint,name:string,credit_id:string,character:string,department:string,job:string>"
_MEDIA_CREDIT = (
    "struct<media_type:string,id:bigint,credit_id:string,character:string,department:string,job:string>"
)
_NAMED = "array<struct<id:bigint,name:string>>"
_IDS = "array<struct<id:bigint>>"
_IMAGES = (
    "array<struct<file_path:string,iso_639_1:string,aspect_ratio:double,width:int,height:int,"
    "vote_average:double,vote_count:int>>"
)
_TITLE = (
    "id bigint, status_code int, original_language string, overview string, tagline string, "
    "status string, adult boolean, popularity double, vote_average double, vote_count int, "
    "poster_path string, backdrop_path string, homepage string, "
    f"genres {_NAMED}, production_countries array<struct<iso_3166_1:string>>, "
    f"spoken_languages array<struct<iso_639_1:string>>, production_companies {_IDS}, "
    f"credits struct<cast:array<{_CREDIT}>,crew:array<{_CREDIT}>>, "
)

PAYLOADS = {
    "movie": _TITLE
    + "imdb_id string, title string, original_title string, release_date string, video boolean, "
    "budget double, revenue double, runtime int, belongs_to_collection struct<id:bigint>, "
    "external_ids struct<wikidata_id:string>",
    "serie": _TITLE
    + "name string, original_name string, first_air_date string, last_air_date string, "
    "number_of_episodes int, number_of_seasons int, type string, "
    f"networks {_IDS}, created_by array<struct<id:bigint,credit_id:string>>, "
    "external_ids struct<imdb_id:string,wikidata_id:string>",
    "person": "id bigint, status_code int, name string, imdb_id string, biography string, "
    "birthday string, deathday string, gender int, profile_path string, homepage string, "
    "place_of_birth string, popularity double, known_for_department string, adult boolean, "
    "also_known_as array<string>, external_ids struct<wikidata_id:string>, "
    f"combined_credits struct<cast:array<{_MEDIA_CREDIT}>,crew:array<{_MEDIA_CREDIT}>>",
    "title_lang": "id bigint, status_code int, lang string, title string, name string, "
    "overview string, tagline string, poster_path string, backdrop_path string",
    "keywords": f"id bigint, status_code int, keywords {_NAMED}, results {_NAMED}",
    "collection": "id bigint, status_code int, lang string, name string, overview string, "
    "poster_path string, backdrop_path string",
    "company": "id bigint, status_code int, name string, description string, logo_path string, "
    "headquarters string, homepage string, origin_country string, parent_company struct<id:bigint>",
    "network": "id bigint, status_code int, name string, logo_path string, headquarters string, "
    "homepage string, origin_country string",
    "keyword": "id bigint, status_code int, name string",
    "list": "id bigint, status_code int, page int, total_pages int, name string, "
    "description string, poster_path string, created_by string, "
    "items array<struct<id:bigint,adult:boolean,media_type:string>>",
    "images": f"id bigint, status_code int, backdrops {_IMAGES}, posters {_IMAGES}, "
    f"logos {_IMAGES}, profiles {_IMAGES}",
    "videos": "id bigint, status_code int, lang string, results array<struct<id:string,"
    "published_at:string,type:string,iso_639_1:string,iso_3166_1:string,key:string,name:string,"
    "site:string,size:int,official:boolean>>",
}

# --- tables -----------------------------------------------------------------

_TITLE_COLUMNS = (
    "TITLE string, ORIGINAL_TITLE string, ORIGINAL_LANGUAGE string, OVERVIEW string, "
    "TAGLINE string, STATUS string, GENRES string, COUNTRIES string, SPOKEN_LANGUAGES string, "
    "ID_IMDB string, ID_WIKIDATA string, ADULT int, POSTER_PATH string, BACKDROP_PATH string, "
    "HOMEPAGE_URL string, POPULARITY double, VOTE_AVERAGE double, VOTE_COUNT int, "
)
_DONE = (
    "TIM_CREDITS_COMPLETED timestamp_ntz, TIM_KEYWORDS_COMPLETED timestamp_ntz, "
    "TIM_IMAGES_COMPLETED timestamp_ntz, TIM_VIDEOS_COMPLETED timestamp_ntz, "
    "TIM_WIKIDATA_COMPLETED timestamp_ntz, TIM_WIKIPEDIA_COMPLETED timestamp_ntz, "
)
_VARIANT = "TAGLINE string, OVERVIEW string, POSTER_PATH string, BACKDROP_PATH string, "
_CREDIT_COLUMNS = (
    "ID_PERSON bigint, CREDIT_TYPE string, CAST_CHARACTER string, CREW_DEPARTMENT string, "
    "CREW_JOB string, DISPLAY_ORDER int, "
)
_IMAGE_COLUMNS = (
    "TYPE_IMAGE string, IMAGE_PATH string, LANG string, ASPECT_RATIO double, WIDTH int, "
    "HEIGHT int, VOTE_AVERAGE double, VOTE_COUNT int, DISPLAY_ORDER int, "
)
_VIDEO_COLUMNS = (
    "LANG string, ID_CREDIT string, DAT_PUBLISHED timestamp_ntz, VIDEO_TYPE string, "
    "COUNTRY_CODE string, VIDEO_KEY string, VIDEO_NAME string, VIDEO_SITE string, QUALITY int, "
    "QUALITY_TEXT string, OFFICIAL int, DISPLAY_ORDER int, "
)

TABLES = {
    "movie": "ID_MOVIE bigint, " + _TITLE_COLUMNS
    + "ID_COLLECTION bigint, VIDEO int, DAT_RELEASE date, RELEASE_YEAR int, RELEASE_MONTH int, "
    "RELEASE_DAY int, BUDGET double, REVENUE double, RUNTIME int, IS_MOVIE int, "
    "IS_DOCUMENTARY int, IS_SHORT_FILM int, WIKIPEDIA_FORMAT_LINE string, IS_COLOR int, "
    "IS_BLACK_AND_WHITE int, IS_SILENT int, IS_3D int, COLOR_TECHNOLOGY string, "
    "FILM_TECHNOLOGY string, SOUND_TECHNOLOGY string, SOUND_SYSTEM string, ASPECT_RATIO string, "
    "FILM_FORMAT string, NUM_AUDIO_TRACKS bigint, IS_VALID_FORMAT int, " + _DONE + AUDIT,
    "serie": "ID_SERIE bigint, " + _TITLE_COLUMNS
    + "DAT_FIRST_AIR date, FIRST_AIR_YEAR int, FIRST_AIR_MONTH int, FIRST_AIR_DAY int, "
    "DAT_LAST_AIR date, LAST_AIR_YEAR int, LAST_AIR_MONTH int, LAST_AIR_DAY int, "
    "NUMBER_OF_EPISODES int, NUMBER_OF_SEASONS int, SERIE_TYPE string, " + _DONE + AUDIT,
    "person": "ID_PERSON bigint, NAME string, ALSO_KNOWN_AS string, BIOGRAPHY string, "
    "BIRTHDAY date, BIRTH_YEAR int, BIRTH_MONTH int, BIRTH_DAY int, DEATHDAY date, "
    "DEATH_YEAR int, DEATH_MONTH int, DEATH_DAY int, GENDER int, ADULT int, POPULARITY double, "
    "KNOWN_FOR_DEPARTMENT string, PLACE_OF_BIRTH string, COUNTRY_OF_BIRTH string, "
    "PROFILE_PATH string, HOMEPAGE_URL string, ID_IMDB string, ID_WIKIDATA string, "
    "USED_FOR_SIMILARITY int, TIM_CREDITS_DOWNLOADED timestamp_ntz, " + _DONE + AUDIT,
    "collection": "ID_COLLECTION bigint, NAME string, OVERVIEW string, POSTER_PATH string, "
    "BACKDROP_PATH string, " + _DONE + AUDIT,
    "company": "ID_COMPANY bigint, NAME string, DESCRIPTION string, LOGO_PATH string, "
    "HEADQUARTERS string, HOMEPAGE_URL string, ORIGIN_COUNTRY string, ID_PARENT bigint, "
    "MOVIE_COUNT bigint, SERIE_COUNT bigint, USED_FOR_SIMILARITY int, "
    "TIM_CREDITS_DOWNLOADED timestamp_ntz, " + _DONE + AUDIT,
    "network": "ID_NETWORK bigint, NAME string, LOGO_PATH string, HEADQUARTERS string, "
    "HOMEPAGE_URL string, ORIGIN_COUNTRY string, SERIE_COUNT bigint, "
    "TIM_CREDITS_DOWNLOADED timestamp_ntz, " + _DONE + AUDIT,
    "keyword": "ID_KEYWORD bigint, NAME string, MOVIE_COUNT bigint, SERIE_COUNT bigint, "
    "NAME_WORD_COUNT int, IS_EMPTY int, IS_PERSON int, USE_FOR_TAGGING int, "
    "USED_FOR_SIMILARITY int, " + _DONE + AUDIT,
    "list": "ID_LIST bigint, NAME string, SHORT_NAME string, DESCRIPTION string, "
    "CREATED_BY string, POSTER_PATH string, USE_FOR_TAGGING int, " + _DONE + AUDIT,
    "technical": "ID_TECHNICAL bigint, DESCRIPTION string, TECHNICAL_TYPE string, " + AUDIT,
    "topic": "ID_TOPIC bigint, TOPIC_TYPE string, ID_RECORD bigint, LANG string, "
    "TOPIC_NAME string, OVERVIEW string, POSTER_PATH string, MOVIE_COUNT bigint, "
    "SERIE_COUNT bigint, " + AUDIT,
    "lemma": "ID_LEMME bigint, LANG string, NAME string, LABEL string, " + AUDIT,
    "movie_lang": "ID_MOVIE bigint, LANG string, TITLE string, " + _VARIANT + AUDIT,
    "serie_lang": "ID_SERIE bigint, LANG string, TITLE string, " + _VARIANT + AUDIT,
    "collection_lang": "ID_COLLECTION bigint, LANG string, NAME string, " + _VARIANT + AUDIT,
    "person_movie": "ID_CREDIT string, ID_MOVIE bigint, " + _CREDIT_COLUMNS + AUDIT,
    "person_serie": "ID_CREDIT string, ID_SERIE bigint, " + _CREDIT_COLUMNS + AUDIT,
    "movie_technical": "ID_MOVIE bigint, ID_TECHNICAL bigint, " + AUDIT,
    "movie_lemma": "ID_MOVIE bigint, ID_LEMME bigint, START_CHAR int, LANG string",
    "movie_document": "ID_MOVIE bigint, LANG string, YEAR_RELEASE string, ORIGINAL_LANGUAGE string, TAGS string, IMDB_RATING double, "
    "IMDB_RATING_ADJUSTED double, KEYWORDS string, GENRES string, COLLECTION string, LISTS string, CAST_TOP string, CREW_TOP string, "
    "DIRECTORS string, WRITERS string, PRODUCERS string, EDITORS string, ART string, CAMERA string, LIGHTNING string, SOUND string, "
    "COSTUME_MAKEUP string, VISUAL_EFFECTS string, OVERVIEW_LEMMA string, KEYWORDS_LEMMA string, LISTS_LEMMA string, TEXT_DOC string, "
    "TEXT_SBERT string",
}
for _title, _id in (("movie", "ID_MOVIE"), ("serie", "ID_SERIE")):
    for _name, _child in (
        ("keyword", "ID_KEYWORD bigint"), ("company", "ID_COMPANY bigint"),
        ("genre", "ID_GENRE bigint"), ("network", "ID_NETWORK bigint"),
        ("list", "ID_LIST bigint"), ("production_country", "COUNTRY_CODE string"),
        ("spoken_language", "SPOKEN_LANGUAGE string"),
    ):
        TABLES[f"{_title}_{_name}"] = f"{_id} bigint, {_child}, DISPLAY_ORDER int, {AUDIT}"
for _owner in ("movie", "serie", "person", "collection", "company", "network"):
    TABLES[f"{_owner}_image"] = f"ID_{_owner.upper()} bigint, {_IMAGE_COLUMNS}{AUDIT}"
for _owner in ("movie", "serie"):
    TABLES[f"{_owner}_video"] = f"ID_{_owner.upper()} bigint, {_VIDEO_COLUMNS}{AUDIT}"


def empty_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.createDataFrame([], TABLES[name])
