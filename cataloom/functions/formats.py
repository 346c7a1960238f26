"""Typed attributes out of a free-text technical format line.

All of it is native column work: one select per table, no shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import values as V
from .columns import SPACE, WORD, as_col, flag


def contains_any(c: Column, terms: Sequence[str]) -> Column:
    return reduce(or_, [F.contains(c, F.lit(t)) for t in terms])


def wrap_tags(conditions: Mapping[str, Column]) -> Column:
    """Tags whose condition holds, sorted, as ``|a|b|`` (``||`` when none holds)."""
    hits = [F.when(conditions[tag], F.lit(tag)) for tag in sorted(conditions)]
    return F.concat(F.lit("|"), F.concat_ws("|", *hits), F.lit("|"))


def clean_format(c: Column | str) -> Column:
    """Lower-case line with unified ratios, no brackets, dashes or loose slashes."""
    steps = [
        (r"(\d+)\.(\d+):1", "$1,$2:1"),
        (rf"(\d+,\d+){SPACE}*:{SPACE}*(\d+)", "$1:$2"),
        (r"\[.*?\]", ""),
        (r"\((.*?)\)", "$1"),
        (r"[-–—]", " "),
        (r"(?<!\d)/(?!\d)", " "),
        (V.IGNORED_FORMAT_TERM, ""),
        (f"{SPACE}+", " "),
    ]
    line = F.lower(as_col(c))
    for pattern, replacement in steps:
        line = F.regexp_replace(line, pattern, replacement)
    return F.trim(line)


def tag_terms(c: Column | str, dictionary: Mapping[str, Sequence[str]]) -> Column:
    """Canonical tags of a dictionary whose variants occur in a lower-case text."""
    c = as_col(c)
    hits = {tag: contains_any(c, variants) for tag, variants in dictionary.items()}
    tags = wrap_tags(hits)
    return F.when(tags == "||", F.lit("")).otherwise(tags)


def aspect_ratio(c: Column | str) -> Column:
    c = as_col(c)
    found = [F.nullif(F.regexp_extract(c, p, 1), F.lit("")) for p in V.ASPECT_RATIOS]
    return F.replace(F.coalesce(*found), F.lit("."), F.lit(","))


def sound_system(c: Column | str) -> Column:
    c = as_col(c)
    stereo = rf"(?<!{WORD})st[eéèê]r[eéèê]o(?!{WORD})"
    return wrap_tags({
        "stereo": c.rlike(stereo),
        "dolby": F.contains(c, F.lit("dolby")),
        "dts": F.contains(c, F.lit("dts")),
        "sdds": F.contains(c, F.lit("sdds")),
        "imax": F.contains(c, F.lit("imax")) & contains_any(c, ["track", "sound"]),
        "mono": F.contains(c, F.lit("mono")),
        "auro": F.contains(c, F.lit("auro")),
        "5.1": F.contains(c, F.lit("5.1")),
        "7.1": F.contains(c, F.lit("7.1")),
    })


def film_format(c: Column | str) -> Column:
    c = as_col(c)
    return F.coalesce(*[F.when(F.contains(c, F.lit(t)), F.lit(t)) for t in V.FILM_FORMATS])


def track_count(c: Column | str) -> Column:
    c = as_col(c)
    # the pattern is tried only where it can match: most lines name no track
    digits = F.when(contains_any(c, ["track", "piste"]), F.regexp_extract(c, V.TRACK_COUNT, 1))
    return F.coalesce(digits.try_cast("bigint"), F.lit(0).cast("bigint"))


def is_valid_format(c: Column | str) -> Column:
    c = as_col(c)
    complete = c.rlike(V.VALID_COLOR) & c.rlike(V.VALID_MEDIUM) & c.rlike(V.VALID_RATIO)
    return contains_any(c, V.VALID_NAMED_FORMATS) | complete


def format_flags(c: Column | str) -> dict[str, Column]:
    """0/1 flags.  ``IS_3D`` marks large-format lines; ``IS_STEREOSCOPIC`` marks 3-D."""
    c = as_col(c)
    return {
        "IS_COLOR": flag(contains_any(c, V.COLOR_TERMS)),
        "IS_BLACK_AND_WHITE": flag(contains_any(c, V.BLACK_AND_WHITE_TERMS)),
        "IS_SILENT": flag(contains_any(c, V.SILENT_TERMS)),
        "IS_3D": flag(F.contains(c, F.lit("imax"))),
        "IS_STEREOSCOPIC": flag(contains_any(c, V.THREE_D_TERMS)),
    }


def format_columns(line: Column | str) -> dict[str, Column]:
    """All attributes of an already cleaned line."""
    line = as_col(line)
    flags = format_flags(line)
    return {
        **{k: flags[k] for k in ("IS_COLOR", "IS_BLACK_AND_WHITE", "IS_SILENT", "IS_3D")},
        "COLOR_TECHNOLOGY": tag_terms(line, V.COLOR_TECHNOLOGIES),
        "FILM_TECHNOLOGY": tag_terms(line, V.FILM_TECHNOLOGIES),
        "ASPECT_RATIO": aspect_ratio(line),
        "FILM_FORMAT": film_format(line),
        "SOUND_SYSTEM": sound_system(line),
        "SOUND_TECHNOLOGY": tag_terms(line, V.SOUND_TECHNOLOGIES),
        "NUM_AUDIO_TRACKS": track_count(line),
        "IS_VALID_FORMAT": flag(is_valid_format(line)),
    }


__all__ = [
    "aspect_ratio", "clean_format", "contains_any", "film_format", "format_columns",
    "format_flags", "is_valid_format", "sound_system", "tag_terms", "track_count",
    "wrap_tags",
]
