"""Tags out of free text by a dictionary that is a table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import present
from .relate import may_hold, membership_filter

KEY_CHARS = 4
#: how often a key may double; of longer variants all have keys of this length
DOUBLINGS = 6
#: characters of a block that a text is cut into before its places
BLOCK = 4096
#: how many beginnings of keys the pattern of places may list, and their longest length
PATTERN_STEMS, PATTERN_CHARS = 512, 4


def _stems(key_chars: int) -> list[int]:
    """Lengths that keys of ``key_chars`` characters or more have."""
    return [key_chars << i for i in range(DOUBLINGS + 1)]


def dictionary_rows(dictionary: DataFrame, tag: str, variant: str, key_chars: int = KEY_CHARS) -> DataFrame:
    """Distinct ``TAG``, ``VARIANT`` and the key it is looked up by: its first characters.

    A key has ``key_chars`` characters, doubled (six times at most) while the variant is long enough, so it stays selective
    when many variants begin alike; a shorter variant is its own key.  Entries without a tag or variant are left out.
    """
    rows = dictionary.select(F.col(tag).alias("TAG"), F.col(variant).alias("VARIANT"))
    rows = rows.filter(present("TAG") & present("VARIANT")).distinct()
    chars = F.length("VARIANT")
    length = reduce(lambda shorter, n: F.when(chars >= n, F.lit(n)).otherwise(shorter), _stems(key_chars), chars)
    return rows.withColumn("_key", F.substring("VARIANT", F.lit(1), length))


def _begin(text: Column, length: Column) -> Column:
    return F.xxhash64(F.substring(text, F.lit(1), length))


def _key_filter(entries: DataFrame, key_chars: int) -> DataFrame:
    """``membership_filter`` of the beginnings of all keys."""
    chars = F.length("_key")
    grown = F.filter(F.array(*[F.lit(n) for n in _stems(key_chars)]), lambda n: n <= F.length("_key"))
    stems = entries.select("_key").distinct().select(
        "_key", F.explode(F.when(chars < key_chars, F.array(chars)).otherwise(grown)).alias("_stem"))
    hashes = stems.select(_begin(F.col("_key"), F.col("_stem")).alias("_hash")).distinct()
    return membership_filter(hashes, "_hash")


def _pattern_char(char: Column) -> Column:
    """A character as a regular expression that matches it alone; none as an empty one."""
    code = F.concat(F.lit("\\x{"), F.hex(F.encode(char, "UTF-32")), F.lit("}"))
    return F.when(F.rlike(char, F.lit(r"^[0-9A-Za-z]?\z")), char).otherwise(code)


def places_pattern(entries: DataFrame) -> DataFrame:
    """One row with ``pattern``, a regular expression that matches where a key of the dictionary may begin.

    It lists the distinct beginnings of the keys by their first character, of the greatest length of at most
    ``PATTERN_CHARS`` that leaves no more than ``PATTERN_STEMS``.  A dictionary whose keys have more first characters
    than that, or none, has no pattern.
    """
    sizes = range(1, PATTERN_CHARS + 1)
    cuts = F.array(*[F.struct(F.lit(n).alias("n"), F.substring("_key", 1, n).alias("stem")) for n in sizes])
    stems = entries.select(F.inline(cuts)).distinct()
    many = stems.groupBy("n").agg(F.count(F.lit(1)).alias("_many")).filter(F.col("_many") <= PATTERN_STEMS)
    best = many.agg(F.max("n").alias("n"))
    first, *rest = [_pattern_char(F.substring("stem", n, 1)) for n in sizes]
    begun = stems.filter(F.col("n") == best.scalar()).groupBy(first.alias("first")).agg(
        F.array_join(F.array_sort(F.collect_set(F.concat(F.lit(""), *rest))), "|").alias("rests"))
    listed = F.transform(
        F.array_sort(F.collect_list(F.struct("first", "rests"))), lambda x: F.concat(x["first"], F.lit("(?:"), x["rests"], F.lit(")")))
    # most places fall at the first character
    firsts = F.concat(F.lit("(?=["), F.array_join(F.array_sort(F.collect_list("first")), ""), F.lit("])(?:"))
    pattern = F.concat(firsts, F.array_join(listed, "|"), F.lit(")"))
    return begun.agg(F.when(F.count(F.lit(1)) > 0, pattern).alias("pattern"))


def dictionary_tags(
    lines: DataFrame, keys: Sequence[str], text: str, dictionary: DataFrame, tag: str, variant: str,
    out: str = "TAGS", key_chars: int = KEY_CHARS,
) -> DataFrame:
    """Per key the sorted tags whose variants occur in its texts, as ``|a|b|`` (empty when none does).

    A text has one piece per place, as long as the longest variant.  A regular expression made of the beginnings of the
    dictionary's keys, at most 512 of them, finds the places in one pass over the text; a Bloom filter of the keys, of
    bounded size, drops the pieces that begin like no variant all the same, before anything is sorted or sent: only
    about as many pieces as there are finds go on, and one mark per text.  These are joined with the keys of the
    dictionary and the rest is compared on a hit.  For a short fixed dictionary ``formats.tag_terms`` is the quicker
    way.  A dictionary under Spark's broadcast threshold is met where the texts are read; beyond it the pieces move, not
    the texts.  Tags combine before the one shuffle by key.

    Comparison is binary.  A key with several rows gets the tags of all of them; a null key is one like any other; null
    and empty texts have no tag; without a dictionary no text has one.
    """
    entries = dictionary_rows(dictionary, tag, variant, key_chars)
    longest = entries.agg(F.coalesce(F.max(F.length("VARIANT")), F.lit(0)).alias("longest"))
    lengths = entries.agg(F.sort_array(F.collect_set(F.length("_key"))).alias("lengths"))
    held, places = _key_filter(entries, key_chars), places_pattern(entries)

    def begins(length: Column) -> Column:
        """Some key may begin with the first ``length`` characters of the piece."""
        return (F.length("_piece") >= length) & may_hold(held, _begin(F.col("_piece"), length))

    # blocks first: the pieces of a long text are not all held at once
    froms = F.sequence(F.lit(1), F.greatest(F.length("_text"), F.lit(1)), F.lit(BLOCK))
    rows = lines.select(*keys, F.col(text).alias("_text"), longest.scalar().alias("_longest"))
    rows = rows.select(*keys, "_text", "_longest", F.explode_outer(froms).alias("_from"))
    block = F.substring("_text", F.col("_from"), F.col("_longest") + (BLOCK - 1))
    ends = F.col("_from") + BLOCK > F.length("_text")
    rows = rows.select(*keys, "_longest", "_from", block.alias("_block"), ends.alias("_ends"))

    def pattern_of(least: Column) -> Column:
        """Pieces of the places that have ``least`` characters from there on."""
        size = F.concat(F.lit(".{"), least.cast("string"), F.lit(","), longest.scalar().cast("string"), F.lit("}"))
        # without a pattern every place counts that is a whole character, not the second half of one
        here = F.coalesce("pattern", F.lit("[^\\uDC00-\\uDFFF]"))
        return F.concat(F.lit("(?s)(?="), here, F.lit(")(?=("), size, F.lit("))"))

    patterns = places.select(F.struct(pattern_of(F.lit(1)).alias("any"), pattern_of(longest.scalar()).alias("whole"))).scalar()

    def pieces_at(name: str) -> Column:
        return F.regexp_extract_all("_block", patterns[name], F.lit(1))

    # in a block that is not the last, places with less than a whole piece are those of the next block
    whole = F.when(F.col("_ends"), pieces_at("any")).otherwise(pieces_at("whole"))
    pieces = F.when((F.col("_longest") > 0) & (F.length("_block") > 0), whole)
    # a null piece is the mark of a text: one without a find has a row too
    marked = F.when(F.coalesce("_from", F.lit(1)) == 1, F.array(F.lit(None).cast("string")))
    none = F.array().cast("array<string>")
    rows = rows.select(*keys, F.explode(F.concat(F.coalesce(marked, none), F.coalesce(pieces, none))).alias("_piece"))
    mark = F.col("_piece").isNull()
    rows = rows.filter(mark | reduce(or_, [begins(F.lit(n)) for n in range(1, key_chars + 1)]))
    rows = rows.select(*keys, "_piece", F.explode(F.when(mark, F.array(F.lit(0))).otherwise(lengths.scalar())).alias("_length"))
    length = F.col("_length")
    tests = [(length != n) | begins(F.lit(n)) for n in range(1, key_chars)]
    tests += [(length < n) | begins(F.lit(n)) for n in _stems(key_chars)]
    rows = rows.filter(mark | reduce(and_, tests))
    # the mark of a text has a key that no variant has, a different one for each: they must not meet in one task
    nothing = F.concat(F.lit("\0"), F.xxhash64(*keys).cast("string"))
    rows = rows.select(*keys, "_piece", F.coalesce(F.substring("_piece", F.lit(1), F.col("_length")), nothing).alias("_key"))
    starts = F.startswith(F.col("_piece"), F.col("VARIANT"))
    hits = rows.join(entries, "_key", "left").groupBy(*keys).agg(F.collect_set(F.when(starts, F.col("TAG"))).alias("_tags"))
    return hits.select(*keys, _wrapped(F.array_sort("_tags")).alias(out))


def _wrapped(tags: Column) -> Column:
    listed = F.concat(F.lit("|"), F.array_join(tags, "|"), F.lit("|"))
    return F.when(F.size(tags) > 0, listed).otherwise(F.lit(""))
