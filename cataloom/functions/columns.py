"""Column expressions for values, dates, lists and short texts.

Every function takes and returns Spark columns, so a query made of them stays
inside whole-stage code generation.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import values as V

# white space and word characters as Unicode classes: Java's \s and \w are ASCII
SPACE = r"[\s\p{Z}\x1c-\x1f\x85]"
WORD = r"[\p{L}\p{N}_]"
PIPE = "|"


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def present(c: Column | str) -> Column:
    """True when a text is neither null nor empty."""
    c = as_col(c)
    return c.isNotNull() & (c != "")


def quoted(text: str) -> str:
    """A text as an SQL literal."""
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def literal_map(mapping: Mapping[str, object]) -> Column:
    """Constant map column."""
    parts = [quoted(x) if isinstance(x, str) else str(x).lower() for pair in mapping.items() for x in pair]
    return F.expr(f"map({', '.join(parts)})")


def text_or_null(c: Column | str) -> Column:
    return F.nullif(as_col(c), F.lit(""))


def text_or_empty(c: Column | str) -> Column:
    return F.coalesce(as_col(c), F.lit(""))


def first_present(*columns: Column | str) -> Column:
    """First non-empty text, null if there is none."""
    return F.coalesce(*[text_or_null(c) for c in columns])


def trim_spaces(c: Column | str) -> Column:
    return F.regexp_replace(as_col(c), f"^{SPACE}+|{SPACE}+$", "")


# --- eligibility ------------------------------------------------------------


def eligible_title() -> Column:
    return (F.col("ADULT") == 0) & present("ID_IMDB")


def eligible_person() -> Column:
    return eligible_title() & present("ID_WIKIDATA")


def eligible_topic_member() -> Column:
    return (F.col("ADULT") == 0) & present("ID_WIKIDATA")


def eligible_company() -> Column:
    movies, series = F.col("MOVIE_COUNT"), F.col("SERIE_COUNT")
    return F.coalesce(movies > 0, F.lit(False)) | F.coalesce(series > 0, F.lit(False))


def eligible_network() -> Column:
    return F.coalesce(F.col("SERIE_COUNT") > 0, F.lit(False))


# --- numbers and flags ------------------------------------------------------


def adjusted_rating(
    rating: Column | str, documentary: Column, fiction: Column | None = None
) -> Column:
    """Documentaries lose a fixed part of their rating; other rows keep theirs.

    Rows that are neither (``fiction`` given and false) have no adjusted rating.
    """
    rating = as_col(rating)
    adjusted = F.when(documentary, rating - V.DOCUMENTARY_PENALTY)
    return adjusted.otherwise(rating) if fiction is None else adjusted.when(fiction, rating)


def document_rating(rating: Column | str, documentary: Column) -> Column:
    """Adjusted rating of a document: a missing rating counts as 0."""
    rating = F.coalesce(as_col(rating), F.lit(0.0))
    return F.when(documentary, F.round(rating - V.DOCUMENTARY_PENALTY, 1)).otherwise(rating)


def flag(condition: Column) -> Column:
    """0/1 column; a null condition counts as 0."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def short_film_flag(runtime: Column | str) -> Column:
    return flag(as_col(runtime).between(1, V.FEATURE_MINUTES))


def length_class(runtime: Column | str, lang: str) -> Column:
    feature, short = V.LENGTH_LABELS[lang]
    runtime = as_col(runtime)
    return F.when(runtime > V.FEATURE_MINUTES, F.lit(feature)).when(runtime > 0, F.lit(short))


def duration_text(seconds: Column | str) -> Column:
    """``90061`` -> ``1 day, 1 hour, 1 minute, 1 second``; zero parts are left out."""
    s = as_col(seconds).cast("long")
    amounts = [
        ("day", F.floor(s / 86400)),
        ("hour", F.floor((s % 86400) / 3600)),
        ("minute", F.floor((s % 3600) / 60)),
        ("second", s % 60),
    ]
    parts = [
        F.when(n == 1, F.lit(f"1 {unit}")).when(n > 1, F.concat(n.cast("string"), F.lit(f" {unit}s")))
        for unit, n in amounts
    ]
    return F.when(s < 0, F.lit("Invalid duration (negative seconds)")).when(
        s.isNotNull(), F.concat_ws(", ", *parts)
    )


# --- text cleaning ----------------------------------------------------------


def clip(c: Column | str, n: int) -> Column:
    return F.substring(as_col(c), 1, n)


def norm_text(c: Column | str) -> Column:
    """Null, ``''`` and ``[]`` become ``''``; ``[a, b]`` becomes ``a, b``."""
    c = as_col(c)
    items = F.split(c.substr(F.lit(2), F.length(c) - 2), ",")
    items = F.filter(F.transform(items, trim_spaces), lambda x: x != "")
    return (
        F.when(c.isNull() | (c == ""), F.lit(""))
        .when(c.startswith("[") & c.endswith("]"), F.array_join(items, V.SEPARATOR))
        .otherwise(c)
    )


def norm_int(c: Column | str) -> Column:
    """Whole number out of a text; decimals are cut, anything else is 0."""
    c = trim_spaces(c)
    whole = F.when(c.rlike(r"^[+-]?\d+$"), c.try_cast("bigint"))
    decimal = F.when(
        c.rlike(r"^[+-]?(\d+\.\d*|\d*\.\d+)([eE][+-]?\d+)?$"), c.try_cast("double").try_cast("bigint")
    )
    return F.coalesce(whole, decimal, F.lit(0).cast("bigint"))


def unescape_quotes(c: Column | str) -> Column:
    c = F.replace(as_col(c), F.lit("\\'"), F.lit("'"))
    return F.replace(c, F.lit('\\"'), F.lit('"'))


def strip_between(c: Column | str, begin: str, end: str, replacement: str = "") -> Column:
    """Replace every stretch from a begin marker to the next end marker."""
    pattern = rf"(?s)\Q{begin}\E.*?\Q{end}\E"
    safe = replacement.replace("\\", "\\\\").replace("$", "\\$")
    return F.regexp_replace(as_col(c), pattern, safe)


def word_count(c: Column | str) -> Column:
    return F.coalesce(
        F.size(F.regexp_extract_all(as_col(c), F.lit(f"{WORD}+"), F.lit(0))), F.lit(0)
    )


def distinct_words(c: Column | str) -> Column:
    """Words in first-seen order, each once, joined by single blanks."""
    words = F.filter(F.split(as_col(c), f"{SPACE}+"), lambda w: w != "")
    return F.array_join(F.array_distinct(words), " ")


# --- dates ------------------------------------------------------------------


def split_date(c: Column | str) -> dict[str, Column]:
    """``YYYY-MM-DD`` text as a date plus year, month and day numbers.

    A text of another shape gives a null date and zeros.  A text of that shape
    which is no calendar day keeps its numbers and has a null date.
    """
    c = as_col(c)
    valid = F.coalesce(c.rlike(V.DATE_PATTERN), F.lit(False))

    def number(start: int, length: int) -> Column:
        return F.when(valid, F.substring(c, start, length).try_cast("int")).otherwise(F.lit(0))

    return {
        "date": F.when(valid, c.try_cast("date")),
        "year": number(1, 4),
        "month": number(6, 2),
        "day": number(9, 2),
    }


def to_local(c: Column | str, tz: str) -> Column:
    """ISO time text to the wall-clock time of a zone, whole seconds, no zone kept.

    A text without zone counts as UTC.  A text ending in ``Z`` must carry a
    fraction of a second; other unreadable texts are null too.
    """
    c = as_col(c)
    zoned = c.rlike(r"(Z|[+-]\d{2}:\d{2})$")
    readable = F.when(c.endswith("Z") & ~c.rlike(r"\.\d{1,6}Z$"), F.lit(None)).otherwise(c)
    instant = F.when(zoned, readable).otherwise(F.concat(readable, F.lit("Z"))).try_cast("timestamp")
    seconds = F.unix_seconds(instant).cast("decimal(18,6)")
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    utc = epoch + F.make_dt_interval(secs=seconds)
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), utc)


# --- pipe lists -------------------------------------------------------------


def list_to_pipe(array: Column | str) -> Column:
    """``[a, b]`` -> ``|a|b|``; an empty array gives ``|``, null stays ``''``."""
    array = as_col(array)
    joined = F.concat(
        F.lit(PIPE), F.array_join(F.transform(array, lambda x: F.concat(x, F.lit(PIPE))), "")
    )
    return F.when(array.isNotNull(), joined).otherwise(F.lit(""))


def pipe_items(c: Column | str) -> Column:
    """Trimmed non-empty items of a pipe list."""
    items = F.transform(F.split(as_col(c), r"\|"), trim_spaces)
    return F.filter(items, lambda x: x != "")


def strip_pipes(c: Column | str) -> Column:
    """One leading and one trailing pipe removed."""
    return F.regexp_replace(as_col(c), r"^\||\|$", "")


def pipe_to_list(c: Column | str) -> Column:
    """``|a|b|`` -> ``a, b`` for display."""
    return F.replace(strip_pipes(c), F.lit(PIPE), F.lit(V.SEPARATOR))


def translate_terms(c: Column | str, mapping: Mapping[str, str]) -> Column:
    """Translate the items of a pipe list, keeping unknown items and empty ends."""
    table = literal_map(mapping)
    items = F.transform(
        F.split(as_col(c), r"\|"), lambda x: F.coalesce(F.try_element_at(table, x), x)
    )
    return F.array_join(items, PIPE)


def genre_tags(c: Column | str) -> Column:
    """Pipe list of genres as tag words: no blanks or dashes inside a genre."""
    bare = F.regexp_replace(strip_pipes(c), "[- ]", "")
    return F.replace(bare, F.lit(PIPE), F.lit(" "))


def strip_aliases(aliases: Column | str, *titles: Column | str) -> Column:
    """Pipe list of aliases without those equal to one of the titles."""
    out = as_col(aliases)
    for title in titles:
        wrapped = F.concat(F.lit(PIPE), text_or_empty(title), F.lit(PIPE))
        out = F.replace(out, wrapped, F.lit(PIPE))
    return out


def alias_words(aliases: Column | str) -> Column:
    return trim_spaces(F.replace(as_col(aliases), F.lit(PIPE), F.lit(" ")))


def alias_list(aliases: Column | str) -> Column:
    """Display list of a pipe list wrapped at both ends; null when nothing is left."""
    shown = F.replace(as_col(aliases), F.lit(PIPE), F.lit(V.SEPARATOR))
    inner = F.when(
        F.length(shown) > 4, shown.substr(F.lit(3), F.length(shown) - 4)
    ).otherwise(F.lit(""))
    return F.when(~inner.isin("", ","), inner)
