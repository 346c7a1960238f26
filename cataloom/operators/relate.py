"""Joins, lookups, ordered scans and per-key picks."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import values as V
from ..functions.columns import first_present, flag, literal_map, present, trim_spaces

SLICE = 1_000_000
#: bits of a membership filter per value it holds, and its largest size in 64-bit words (32 MB)
FILTER_BITS, FILTER_WORDS = 16, 1 << 22
#: words of a segment of it, as a power of two
FILTER_SEGMENT = 10


# --- joins ------------------------------------------------------------------


def _bit(hashed: Column) -> Column:
    """One of the 64 bits of a word, by the high bits of the hash."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(hashed, 58).cast("int"))


def membership_filter(hashes: DataFrame, hashed: str) -> DataFrame:
    """One row with ``words``, a Bloom filter of the distinct ``xxhash64`` values in a column, of bounded size.

    The words come in segments, so that the one task that puts them together handles a few thousand arrays.
    """
    wanted = F.ceil(F.count(F.lit(1)) * FILTER_BITS / 64)
    words = hashes.agg(F.greatest(F.lit(1), F.least(F.lit(FILTER_WORDS), wanted)).cast("int").alias("_words"))
    bits = hashes.select(
        F.pmod(F.col(hashed), words.scalar()).cast("int").alias("_word"), _bit(F.col(hashed)).alias("_bits"))
    places = F.explode(F.sequence(F.lit(0), F.col("_words") - 1))
    empty = words.select(places.alias("_word"), F.lit(0).cast("long").alias("_bits"))
    filled = bits.unionByName(empty).groupBy("_word").agg(F.bit_or("_bits").alias("_bits"))

    def listed(rows: Column) -> Column:
        return F.transform(F.array_sort(F.collect_list(rows)), lambda x: x["_bits"])

    segments = filled.groupBy(F.shiftright("_word", FILTER_SEGMENT).alias("_segment")).agg(
        listed(F.struct("_word", "_bits")).alias("_bits"))
    return segments.agg(listed(F.struct("_segment", "_bits")).alias("words"), F.sum(F.size("_bits")).alias("n")).select(
        F.struct("n", "words").alias("words"))


def may_hold(held: DataFrame, hashed: Column) -> Column:
    """False for a hash that is surely not in a ``membership_filter``."""
    words = held.scalar()
    word = F.pmod(hashed, words["n"]).cast("int")
    segment = F.get(words["words"], F.shiftright(word, FILTER_SEGMENT))
    found = F.get(segment, word.bitwiseAND(F.lit((1 << FILTER_SEGMENT) - 1)))
    return found.bitwiseAND(_bit(hashed)) != 0


def likely_known(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Rows whose key occurs in another table, and some more: a ``membership_filter`` of its keys drops most of the others
    where they are read.  For rows that an exact join meets later on."""
    held = membership_filter(other.select(F.xxhash64(key).alias("_hash")), "_hash")
    return df.filter(may_hold(held, F.xxhash64(key)))


def only_known(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Rows whose key occurs in another table.

    ``likely_known`` drops most of the other rows where they are read, so that they are neither sorted nor sent; the
    semi join decides.
    """
    return likely_known(df, other, key).join(other.select(key), key, "left_semi")


def members(
    entity: DataFrame, bridge: DataFrame, dim: DataFrame, entity_key: str, dim_key: str
) -> DataFrame:
    """Bridge rows of existing entities with the columns of their dimension row."""
    return bridge.join(entity.select(entity_key), entity_key, "left_semi").join(dim, dim_key)


def publish_credits(credits: DataFrame, persons: DataFrame, titles: DataFrame, title_key: str) -> DataFrame:
    """Credits whose person and title are both published."""
    kept = only_known(only_known(credits, titles, title_key), persons, "ID_PERSON")
    return kept.select(*credits.columns)


def missing_from(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.join(other.select(*keys), list(keys), "left_anti")


def with_labels(edges: DataFrame, items: DataFrame) -> DataFrame:
    """Every edge with each label of its item; edges without item keep null labels."""
    labels = items.select(F.col("ID_WIKIDATA").alias("ID_ITEM"), "LANG", "LABEL")
    return edges.join(labels, "ID_ITEM", "left")


def in_languages(df: DataFrame, langs: Sequence[str]) -> DataFrame:
    """Every row once per language, with the language as ``LANG``."""
    return df.withColumn("LANG", F.explode(F.array(*[F.lit(x) for x in langs])))


def localised_in(
    base: DataFrame, variants: DataFrame, key: str, column: str, langs: Sequence[str], out: str,
    variant_column: str | None = None,
) -> DataFrame:
    """Base rows once per language with the text of that language, or the base text where that is empty."""
    text = variants.filter(F.col("LANG").isin(list(langs))).select(
        key, "LANG", F.col(variant_column or column).alias("_variant")
    )
    rows = in_languages(base, langs).join(text, [key, "LANG"], "left")
    return rows.withColumn(out, first_present("_variant", column)).drop("_variant")


def localised(
    base: DataFrame, variants: DataFrame, key: str, column: str, lang: str, out: str,
    variant_column: str | None = None,
) -> DataFrame:
    """``localised_in`` for one language, without a language column."""
    return localised_in(base, variants, key, column, [lang], out, variant_column).drop("LANG")


def lookup_ci(values: DataFrame, dim: DataFrame, text: str, name: str, id_column: str) -> DataFrame:
    """Add the id of a dimension text: equal text first, else equal but for case.

    Of several rows with an equal text the last id counts; of several spellings
    the one seen first (smallest id) counts.
    """
    named = dim.filter(present(name))
    spellings = named.groupBy(F.col(name).alias("_text")).agg(
        F.max(id_column).alias("_exact"), F.min(id_column).alias("_first")
    )
    folded = spellings.groupBy(F.lower("_text").alias("_folded")).agg(
        F.min_by("_exact", "_first").alias("_loose")
    )
    rows = values.withColumn("_folded", F.lower(text))
    rows = rows.join(spellings.select("_text", "_exact"), F.col(text) == F.col("_text"), "left")
    rows = rows.join(folded, "_folded", "left")
    rows = rows.withColumn(id_column, F.coalesce("_exact", "_loose"))
    return rows.select(*values.columns, id_column)


def flag_exists(df: DataFrame, other: DataFrame, column: str, other_column: str, out: str) -> DataFrame:
    """0/1 flag: the text occurs, letter for letter, in another table."""
    known = other.select(F.col(other_column).alias(column)).distinct()
    rows = df.join(known.withColumn("_known", F.lit(True)), column, "left")
    return rows.withColumn(out, flag(F.col("_known"))).drop("_known")


def credit_rows(credits: DataFrame, persons: DataFrame, aliases: DataFrame) -> DataFrame:
    """Credits of persons known to the knowledge graph, with name and aliases."""
    people = persons.filter(F.col("ID_WIKIDATA").startswith("Q"))
    people = people.select("ID_PERSON", "NAME", "ID_WIKIDATA")
    named = aliases.select("ID_WIKIDATA", "ALIASES")
    return credits.join(people.join(named, "ID_WIKIDATA"), "ID_PERSON")


# --- ordered scans over groups of any size ----------------------------------


def _range_at(order: Column, marks: Column) -> Column:
    """How many of the sorted ``marks`` lie at or below ``order``, by halving; 0 without marks."""
    size = F.size(marks)
    rounds = F.sequence(F.lit(1), F.ceil(F.log2(size + 1)).cast("int"))
    start = F.struct(F.lit(0).alias("low"), size.alias("high"))

    def halve(s: Column, _: Column) -> Column:
        middle = ((s["low"] + s["high"]) / 2).cast("int")
        below = (s["low"] < s["high"]) & (F.get(marks, middle) <= order)
        return F.struct(
            F.when(below, middle + 1).otherwise(s["low"]).alias("low"),
            F.when(below, s["high"]).otherwise(middle).alias("high"),
        )

    found = F.aggregate(rounds, start, halve, lambda s: s["low"])
    return F.when(marks.isNotNull() & order.isNotNull(), found).otherwise(0)


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join on keys of which null is one like any other."""
    named = right.select(
        *[F.col(k).alias(f"_key_{i}") for i, k in enumerate(keys)], *[c for c in right.columns if c not in keys]
    )
    same = [F.col(k).eqNullSafe(F.col(f"_key_{i}")) for i, k in enumerate(keys)]
    return left.join(named, reduce(and_, same, F.lit(True)), how).drop(*named.columns[: len(keys)])


def _sliced(df: DataFrame, keys: Sequence[str], order: str, width: int) -> DataFrame:
    """Rows with ``_slice``, the range of the order that they fall into within their key.

    The rows whose hash is a multiple of ``width`` bound the ranges, so a key has one bound for every ``width`` rows on
    average, wherever its order values lie, and most keys have none.  The draw is a function of the row: a task that
    runs again cuts at the same places.
    """
    drawn = F.col(order).isNotNull() & (F.pmod(F.xxhash64(*keys, order), F.lit(width)) == 0)
    bounds = df.filter(drawn).groupBy(*keys).agg(F.array_sort(F.collect_set(order)).alias("_marks"))
    rows = join_null_safe(df, bounds, keys, "left")
    return rows.withColumn("_slice", _range_at(F.col(order), F.col("_marks"))).drop("_marks")


def running_total(
    df: DataFrame, keys: Sequence[str], order: str, amount: Column, out: str, width: int = SLICE
) -> DataFrame:
    """Sum of ``amount`` over the earlier rows of the key (0 on the first row).

    ``order`` is any sortable column, unique per key; a null comes first.  Groups
    are cut into ranges of about ``width`` rows, so a task holds one range of a
    key and never a whole hot key; the totals of the ranges before it are added on.
    """
    rows = _sliced(df.withColumn("_amount", amount), keys, order, width)
    earlier = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = rows.groupBy(*keys, "_slice").agg(F.sum("_amount").alias("_sum"))
    slices = slices.select(*keys, "_slice", F.sum("_sum").over(earlier).alias("_carry"))
    inside = (
        Window.partitionBy(*keys, "_slice").orderBy(order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    rows = join_null_safe(rows, slices, [*keys, "_slice"], "inner")
    total = F.coalesce(F.sum("_amount").over(inside), F.lit(0)) + F.coalesce("_carry", F.lit(0))
    return rows.withColumn(out, total).select(*df.columns, out)


def forward_fill(
    df: DataFrame, keys: Sequence[str], order: str, column: str, default, width: int = SLICE
) -> DataFrame:
    """Replace nulls by the last earlier value of the key, or by ``default``.

    Cut into ranges like ``running_total``: each range takes over the last value
    of the ranges before it.
    """
    rows = _sliced(df, keys, order, width)
    place = F.struct(F.col(order).isNotNull(), order)  # a null order comes first
    known = F.when(F.col(column).isNotNull(), place)
    earlier = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = rows.groupBy(*keys, "_slice").agg(F.max_by(column, known).alias("_last"))
    carry = F.last("_last", ignorenulls=True).over(earlier).alias("_carry")
    slices = slices.select(*keys, "_slice", carry)
    inside = (
        Window.partitionBy(*keys, "_slice").orderBy(order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    rows = join_null_safe(rows, slices, [*keys, "_slice"], "inner")
    filled = F.coalesce(F.last(column, ignorenulls=True).over(inside), "_carry", F.lit(default))
    return rows.withColumn(column, filled).select(*df.columns)


def first_position(df: DataFrame, keys: Sequence[str], person: str, position: str, out: str) -> DataFrame:
    """All rows of a person within a key share the person's first position.

    The minimum is combined before the shuffle, then joined back, so adaptive
    execution can split a hot person.
    """
    group = [*keys, person]
    first = df.groupBy(*group).agg(F.min(position).alias(out))
    return df.join(first, group)


def number_items(df: DataFrame, keys: Sequence[str], items: Column | str, out: str = "item") -> DataFrame:
    """Array items as rows, numbered from 1 in ``DISPLAY_ORDER``; no shuffle."""
    items = F.col(items) if isinstance(items, str) else items
    rows = df.select(*keys, F.posexplode(items).alias("_pos", out))
    return rows.select(*keys, (F.col("_pos") + 1).alias("DISPLAY_ORDER"), out)


# --- picks ------------------------------------------------------------------


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[str], latest: bool = False) -> DataFrame:
    """One row per key: the first, or the latest, by the order columns."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    row = F.struct(*order, *rest)
    best = (F.max if latest else F.min)(row).alias("_row")
    picked = df.groupBy(*keys).agg(best)
    return picked.select(*[F.col(c) if c in keys else F.col("_row")[c].alias(c) for c in df.columns])


def top_n(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], n: int, rank: str = "rank") -> DataFrame:
    """First ``n`` rows per key with their rank.

    Spark keeps only the best rows of each key before the shuffle, up to the rank in
    ``spark.sql.optimizer.windowGroupLimitThreshold``; ``session.SETTINGS`` raises it to 4000.
    """
    whole = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(whole)).filter(F.col(rank) <= n)


# --- page sections ----------------------------------------------------------


def route_sections(
    sections: DataFrame, key: str, order: Sequence[str], title: str = "TITLE", content: str = "CONTENT"
) -> DataFrame:
    """Sections of a page as one row with a column per target.

    Of the exact titles of a target the last one counts.  Without an exact title
    the first fallback title counts.  Titles that found no place are listed in
    ``OTHER_SECTIONS`` in page order.  One shuffle; contents travel only as the
    best candidate of each map task.
    """
    targets = list(V.SECTIONS_EXACT.values())

    def lookup(mapping: dict[str, str]) -> Column:
        return F.try_element_at(literal_map(mapping), F.col("_title"))

    rows = sections.select(
        key,
        F.struct(*order).alias("_ord"),
        trim_spaces(title).alias("_title"),
        trim_spaces(content).alias("_content"),
    )
    rows = rows.filter(~F.col("_title").isin(V.SECTIONS_SKIPPED))
    rows = rows.withColumn("_exact", lookup(V.SECTIONS_EXACT))
    rows = rows.withColumn("_fallback", lookup(V.SECTIONS_FALLBACK))
    order_if = lambda test: F.when(test, F.col("_ord"))
    picks = []
    for t in targets:
        exact, fallback = F.col("_exact") == t, F.col("_fallback") == t
        picks += [
            F.max_by("_content", order_if(exact)).alias(f"_e_{t}"),
            F.min_by("_content", order_if(fallback)).alias(f"_f_{t}"),
            F.min(order_if(F.coalesce("_exact", "_fallback") == t)).alias(f"_o_{t}"),
        ]
    loose = F.when(F.col("_exact").isNull(), F.struct("_ord", "_title", "_fallback"))
    page = rows.groupBy(key).agg(*picks, F.array_sort(F.collect_list(loose)).alias("_loose"))
    first = F.create_map(*[x for t in targets for x in (F.lit(t), F.col(f"_o_{t}"))])
    others = F.filter(
        F.col("_loose"),
        lambda x: x["_fallback"].isNull() | (x["_ord"] != F.try_element_at(first, x["_fallback"])),
    )
    listed = F.array_join(F.transform(others, lambda x: F.concat(x["_title"], F.lit("|"))), "")
    return page.select(
        key,
        *[F.coalesce(f"_e_{t}", f"_f_{t}").alias(t) for t in targets],
        F.when(F.size(others) > 0, F.concat(F.lit("|"), listed)).alias("OTHER_SECTIONS"),
    )
