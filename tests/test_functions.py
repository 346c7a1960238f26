"""Column functions on their edge rows."""

import re
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from cataloom.functions import columns as C
from cataloom.functions import formats as FM
from cataloom.functions import text as TX
from cataloom.functions import values as V


def apply(spark, values, fn, ddl="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {ddl}")
    return [r[0] for r in df.orderBy("i").select(fn("x").alias("y")).collect()]


def test_clean_format(spark):
    lines = ["Couleur - 35 mm - 2.39:1 - Dolby 5.1", "noir et blanc – 1,37 : 1 – 16 mm – muet",
             "Couleurs (Technicolor) [note] 35 mm / 70 mm", "16/9 digital DCP", "ColorWorks", "35 mm  a", None]
    assert apply(spark, lines, FM.clean_format) == [
        "couleur 35 mm 2,39:1 dolby 5.1", "noir et blanc 1,37:1 16 mm muet",
        "couleurs technicolor 35 mm 70 mm", "16/9 digital dcp", "", "35 mm a", None]


def format_of(spark, line):
    df = spark.createDataFrame([(line,)], "x string").select(FM.clean_format("x").alias("l"))
    return df.select(*[v.alias(k) for k, v in FM.format_columns("l").items()]).first().asDict()


def test_format_columns(spark):
    got = format_of(spark, "Couleur - 35 mm - 2.39:1 - Dolby 5.1")
    assert (got["IS_COLOR"], got["ASPECT_RATIO"], got["FILM_FORMAT"], got["SOUND_SYSTEM"], got["IS_VALID_FORMAT"]) == (
        1, "2,39", "35 mm", "|5.1|dolby|", 1)
    got = format_of(spark, "noir et blanc – 1,37 : 1 – 16 mm – muet")
    assert (got["IS_BLACK_AND_WHITE"], got["IS_SILENT"], got["SOUND_SYSTEM"], got["IS_VALID_FORMAT"]) == (1, 1, "||", 1)
    got = format_of(spark, "IMAX 12-track sound")
    assert (got["IS_3D"], got["SOUND_SYSTEM"], got["NUM_AUDIO_TRACKS"]) == (1, "|imax|", 12)
    assert format_of(spark, "IMAX")["SOUND_SYSTEM"] == "||"
    assert format_of(spark, "stéréo")["SOUND_SYSTEM"] == "|stereo|"
    assert format_of(spark, "monostéréo")["SOUND_SYSTEM"] == "|mono|"
    assert format_of(spark, "Todd-AO")["FILM_TECHNOLOGY"] == "|todd_ao|"
    assert format_of(spark, "Eastman Color")["COLOR_TECHNOLOGY"] == "|eastmancolor|"
    assert format_of(spark, "4 pistes")["NUM_AUDIO_TRACKS"] == 4
    assert format_of(spark, "ColorWorks")["IS_COLOR"] == 0
    assert format_of(spark, "Westrex sound")["SOUND_TECHNOLOGY"] == "|western_electric|westrex|"


def test_duration(spark):
    assert apply(spark, [-1, 0, 1, 59, 60, 3661, 86400, 90061], C.duration_text, "long") == [
        "Invalid duration (negative seconds)", "", "1 second", "59 seconds", "1 minute",
        "1 hour, 1 minute, 1 second", "1 day", "1 day, 1 hour, 1 minute, 1 second"]


def test_normalise(spark):
    assert apply(spark, [None, "", "[]", "[a,  b,, c ]", "3.7", "[ ]"], C.norm_text) == ["", "", "", "a, b, c", "3.7", ""]
    assert apply(spark, [None, "", "3.7", "x", "12", "-3.9", "1e5", "1.5e3", " 5 "], C.norm_int) == [
        0, 0, 3, 0, 12, -3, 0, 1500, 5]


def test_dates(spark):
    values = ["2024-02-29", "2024-13-01", "2024", "", None]
    df = spark.createDataFrame([(v,) for v in values], "x string")
    got = [tuple(r) for r in df.select(*[v.alias(k) for k, v in C.split_date("x").items()]).collect()]
    assert got == [(date(2024, 2, 29), 2024, 2, 29), (None, 2024, 13, 1), (None, 0, 0, 0), (None, 0, 0, 0), (None, 0, 0, 0)]


@pytest.mark.parametrize("tz", ["UTC", "America/New_York"])
def test_to_local_in_any_session_zone(spark, tz):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", tz)
    try:
        got = apply(spark, ["2024-01-01T10:00:00.000Z", "2024-07-01T10:00:00+02:00", "2024-07-01T10:00:00", "bad", None,
                            "2024-01-01T10:00:00Z"], lambda c: C.to_local(c, "Europe/Paris"))
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == [datetime(2024, 1, 1, 11), datetime(2024, 7, 1, 10), datetime(2024, 7, 1, 12), None, None, None]


def test_pipe_lists(spark):
    assert apply(spark, [["a", "b"], [], None], C.list_to_pipe, "array<string>") == ["|a|b|", "|", ""]
    assert apply(spark, ["|a|b|", "|", "", None], C.pipe_to_list) == ["a, b", "", "", None]
    assert apply(spark, ["|Drama|Unknown|TV Movie|", "|", "", None], lambda c: C.translate_terms(c, V.GENRES_FR)) == [
        "|Drame|Unknown|Téléfilm|", "|", "", None]
    assert apply(spark, ["|Science-Fiction|TV Movie|"], C.genre_tags) == ["ScienceFiction TVMovie"]


def test_aliases(spark):
    strip = lambda c: C.strip_aliases(c, F.lit("T"), F.lit("O"), F.lit(""))
    assert apply(spark, ["|T|x|O|", "|T|", "|x|"], strip) == ["|x|", "|", "|x|"]
    assert apply(spark, ["|a|b|", "|", "||", ""], C.alias_list) == ["a, b", None, None, None]
    assert apply(spark, ["|a|b|"], C.alias_words) == ["a b"]


def test_words(spark):
    texts = ["L'été déjà vu déjà Vu", "", "a a b a", None]
    assert apply(spark, texts, C.word_count) == [6, 0, 4, 0]
    assert apply(spark, texts, C.distinct_words) == ["L'été déjà vu Vu", "", "a b", None]
    assert apply(spark, ["a b a"], lambda c: C.distinct_words(C.distinct_words(c))) == ["a b"]


def test_strip_between(spark):
    got = apply(spark, ["a<x>1</x>b<x>2</x>c", "a<x>1", "abc"], lambda c: C.strip_between(c, "<x>", "</x>", "$"))
    assert got == ["a$b$c", "a<x>1", "abc"]


def test_unescape(spark):
    assert apply(spark, ["l\\'ami \\\"x\\\""], C.unescape_quotes) == ["l'ami \"x\""]


def test_ratings_and_flags(spark):
    df = spark.createDataFrame([(6.25, 1, 0), (6.25, 0, 1), (None, 1, 0), (5.0, 0, 0)], "r double, d int, m int")
    got = df.select(
        C.adjusted_rating("r", F.col("d") == 1, F.col("m") == 1).alias("a"),
        C.document_rating("r", F.col("d") == 1).alias("b"),
    ).collect()
    assert [tuple(r) for r in got] == [(4.75, 4.8), (6.25, 6.25), (None, -1.5), (None, 5.0)]
    assert apply(spark, [0, 1, 58, 59, None], C.short_film_flag, "int") == [0, 1, 1, 0, 0]
    assert apply(spark, [0, 1, 58, 59, None], lambda c: C.length_class(c, "fr"), "int") == [
        None, "Court métrage", "Court métrage", "Long métrage", None]


@pytest.mark.parametrize("text", [
    "Hé l'ami, 3 fois — déjà vu " * 60, "", "  ...  ", "one", "a_b c\n\td", "😀 emoji 😀x", None,
])
def test_token_offsets(spark, text):
    df = spark.createDataFrame([(1, text)], "id long, x string")
    got = sorted((r.START_CHAR, r.TOKEN) for r in TX.tokens(df, ["id"], "x").collect())
    assert got == [(m.start(), m.group()) for m in re.finditer(r"\w+", text or "")]


def test_lemma_text(spark):
    docs = spark.createDataFrame([(1, "Les chats mangent 3 souris"), (2, "le la"), (3, "")], "id long, x string")
    forms = spark.createDataFrame(
        [("fr", "chats", "chat", "NOUN"), ("fr", "mangent", "manger", "VERB"), ("fr", "souris", "souris", "ADV")],
        "LANG string, FORM string, LEMMA string, LABEL string")
    got = TX.lemma_text(docs, ["id"], "x", "fr", forms, "l").collect()
    assert [tuple(r) for r in got] == [(1, "chat manger 3")]
    plain = TX.lemma_text(docs, ["id"], "x", "fr", None, "l").orderBy("id").collect()
    assert [r.l for r in plain] == ["chats mangent 3 souris", "", ""]
