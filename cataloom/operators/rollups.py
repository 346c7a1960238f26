"""Counts, gates, ordered texts and length-limited lists."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import values as V
from ..functions.columns import alias_words, flag, literal_map, present, text_or_empty, word_count
from .relate import flag_exists, members, top_n, with_labels


def member_counts(
    entity: DataFrame, bridge: DataFrame, dim: DataFrame,
    entity_key: str, dim_key: str, out: str, name: str = "NAME",
) -> DataFrame:
    """Distinct members per dimension name, credited to the smallest id of the name.

    Distinct counting combines before each shuffle, so a name with a third of
    all links stays spread over the tasks.
    """
    links = bridge.select(entity_key, dim_key)
    rows = members(entity, links, dim.select(dim_key, name), entity_key, dim_key).select(entity_key, dim_key, name)
    return rows.groupBy(name).agg(
        F.count_distinct(entity_key).alias(out), F.min(dim_key).alias(dim_key)
    )


def max_id(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.coalesce(F.max(column), F.lit(0)).alias("max_id"))


def keyword_kpis(keywords: DataFrame, persons: DataFrame) -> DataFrame:
    """Word count, emptiness and person-name flag of every keyword."""
    total = F.coalesce("MOVIE_COUNT", F.lit(0)) + F.coalesce("SERIE_COUNT", F.lit(0))
    rows = flag_exists(keywords, persons, "NAME", "NAME", "IS_PERSON")
    rows = rows.withColumn("NAME_WORD_COUNT", word_count("NAME"))
    return rows.withColumn("IS_EMPTY", flag(total < 2))


def gate(counted: DataFrame, columns: Sequence[str], min_members: int = 2) -> DataFrame:
    """Rows whose counts add up to at least ``min_members``."""
    total = sum((F.coalesce(c, F.lit(0)) for c in columns), F.lit(0))
    return counted.filter(total >= min_members)


def ordered_join(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, out: str,
    sep: str = V.SEPARATOR,
) -> DataFrame:
    """Distinct values per key, joined in order of their first occurrence.

    Repeats are removed by a combining aggregate first, so only the distinct
    values that make up the result cell are collected.
    """
    rows = df.filter(present(value)).groupBy(*keys, value).agg(F.min(F.struct(*order)).alias("_ord"))
    listed = F.array_sort(F.collect_list(F.struct("_ord", F.col(value).alias("_v"))))
    text = F.array_join(F.transform(listed, lambda x: x["_v"]), sep)
    return rows.groupBy(*keys).agg(text.alias(out))


# --- knowledge graph --------------------------------------------------------


def property_texts(edges: DataFrame, items: DataFrame, langs: Sequence[str]) -> DataFrame:
    """Label text per entity, property and language.

    The last label of the wanted language stands alone; without one, all distinct
    labels are joined in display order. All languages come out of one fold.
    """
    keys = ["ID_WIKIDATA", "ID_PROPERTY"]
    rows = with_labels(edges, items)
    rows = rows.filter(present("LABEL") & (F.col("LABEL") != F.col("ID_ITEM")))
    # a missing order sorts first; equal orders are settled by the label
    order = F.coalesce("DISPLAY_ORDER", F.lit(-1))
    spoken = [F.max(F.when(F.col("LANG") == x, order)).alias(f"_in_{i}") for i, x in enumerate(langs)]
    labels = rows.groupBy(*keys, "LABEL").agg(F.min(order).alias("_ord"), *spoken)
    # distinct labels meet by entity once; folding, pivoting and joining go on from there
    labels = labels.repartition("ID_WIKIDATA")
    listed = F.array_sort(F.collect_list(F.struct("_ord", "LABEL")))
    last = [
        F.max(F.when(F.col(f"_in_{i}").isNotNull(), F.struct(f"_in_{i}", "LABEL")))["LABEL"].alias(f"_last_{i}")
        for i in range(len(langs))
    ]
    rows = labels.groupBy(*keys).agg(
        F.array_join(F.transform(listed, lambda x: x["LABEL"]), V.SEPARATOR).alias("_all"), *last
    )
    texts = [
        F.struct(F.lit(x).alias("LANG"), F.coalesce(f"_last_{i}", "_all").alias("TEXT")) for i, x in enumerate(langs)
    ]
    return rows.select(*keys, F.inline(F.array(*texts)))


def property_text(edges: DataFrame, items: DataFrame, lang: str) -> DataFrame:
    """``property_texts`` of one language, without a language column."""
    return property_texts(edges, items, [lang]).drop("LANG")


def pivot_properties(
    texts: DataFrame, codes: Sequence[str], keys: Sequence[str] = ("ID_WIKIDATA",)
) -> DataFrame:
    """One row per entity, or per other ``keys``, with a text column per property code."""
    wanted = texts.filter(F.col("ID_PROPERTY").isin(list(codes)))
    return wanted.groupBy(*keys).agg(
        *[F.max(F.when(F.col("ID_PROPERTY") == c, F.col("TEXT"))).alias(c) for c in codes]
    )


# --- length-limited lists ---------------------------------------------------


def concat_until(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, item_id: str, max_chars: int
) -> DataFrame:
    """Mark the items of a list that stops at the first overflow.

    Adds ``pos``, ``kept`` (the item is in the text) and ``seen`` (kept, or the
    item that overflowed).  Each item takes at least a separator, so no item
    beyond ``max_chars / 2 + 2`` can matter and hot keys are cut to that length.
    """
    rows = df.withColumn("_chars", F.length(text_or_empty(value)))
    rows = top_n(rows, keys, order, max_chars // 2 + 2, "pos")
    scan = Window.partitionBy(*keys).orderBy("pos")
    used = F.sum("_chars").over(scan.rowsBetween(Window.unboundedPreceding, 0))
    kept = used + 2 * F.greatest(F.col("pos") - 1, F.lit(1)) <= max_chars
    rows = rows.withColumn("kept", kept)
    seen = F.col("kept") | F.coalesce(F.lag("kept").over(scan), F.lit(True))
    return rows.withColumn("seen", seen).drop("_chars")


def limited_list(
    marked: DataFrame, keys: Sequence[str], value: str, item_id: str, kept_ids: str | None = None
) -> DataFrame:
    """Fold the marks of ``concat_until``: ``text``, ``tag_ids``, ``seen_names``, and the ids in the text if ``kept_ids`` names them."""
    def listed(mark: str, column: str) -> Column:
        hits = F.collect_list(F.when(F.col(mark), F.struct("pos", F.col(column).alias("v"))))
        return F.transform(F.array_sort(hits), lambda x: x["v"])

    return marked.groupBy(*keys).agg(
        F.array_join(listed("kept", value), V.SEPARATOR).alias("text"),
        listed("seen", item_id).alias("tag_ids"),
        listed("seen", value).alias("seen_names"),
        *([listed("kept", item_id).alias(kept_ids)] if kept_ids else []),
    )


def top_credits(
    credits: DataFrame, keys: Sequence[str], order: Sequence[str],
    n: int = V.MAX_CAST, max_chars: int = V.MAX_CAST_CHARS,
) -> DataFrame:
    """First ``n`` credits per key, stopping where names plus aliases overflow."""
    rows = top_n(credits, keys, order, n, "pos")
    alias = F.length(text_or_empty(alias_words("ALIASES")))
    rows = rows.withColumn("_full", F.length("NAME") + F.when(alias > 0, alias + 1).otherwise(0))
    before = Window.partitionBy(*keys).orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    used = F.coalesce(F.sum("_full").over(before), F.lit(0)) + F.length("NAME")
    kept = used + 2 * F.greatest(F.col("pos") - 1, F.lit(1)) <= max_chars
    return rows.withColumn("_kept", kept).filter("_kept").drop("_full", "_kept")


@dataclass(frozen=True)
class DepartmentRule:
    """One output list of crew names."""

    column: str
    department: str | None
    job: str | None = None
    cap: int = V.MAX_DEPARTMENT
    max_chars: int = V.MAX_DEPARTMENT_CHARS
    alias_budget: bool = False


def department_rules() -> list[DepartmentRule]:
    rules = [
        DepartmentRule(column, department, job, alias_budget=column in V.ALIAS_BUDGET_COLUMNS)
        for department, column, job in V.DEPARTMENTS
    ]
    other = DepartmentRule(
        V.OTHER_CREW_COLUMN, None, None, V.MAX_OTHER_CREW, V.MAX_OTHER_CREW_CHARS, True
    )
    return [*rules, other]


def department_credits(
    crew: DataFrame, keys: Sequence[str], order: Sequence[str], rules: Sequence[DepartmentRule], ahead: int = 64
) -> DataFrame:
    """Crew names per key and list: skip repeats and names that do not fit, up to a cap.

    Exact and bounded: a name is needed once per list, and of the names of one length only as many as can be accepted
    or blocked before the budget closes for that length, so a hot key never collects more than that.  The first
    ``ahead`` names of a list are walked; where they reach the cap, or leave no room for the shortest name after them,
    the list is closed.  Only lists still open walk on, over the later names that fit the room left.  All of it happens
    where the rows of a key have met: rows that already lie together by ``keys`` are not sent again.  ``picks`` holds
    the accepted rows: the order columns and ``ID_PERSON``.
    """
    named = {r.department for r in rules if r.department}
    column = F.lit(None).cast("string")
    for r in rules:
        if r.department is None:
            test = ~F.col("CREW_DEPARTMENT").isin(*named)
        else:
            test = F.col("CREW_DEPARTMENT") == r.department
        if r.job is not None:
            test = test & (F.col("CREW_JOB") == r.job)
        column = F.when(test, F.lit(r.column)).otherwise(column)

    def by_rule(pick) -> Column:
        return F.element_at(literal_map({r.column: pick(r) for r in rules}), F.col("list"))

    rows = crew.withColumn("list", column).filter(F.col("list").isNotNull() & present("NAME"))
    group = [*keys, "list"]
    alias = text_or_empty(alias_words("ALIASES"))
    first = F.min(F.struct(*order, "ID_PERSON", alias.alias("_alias"))).alias("_row")
    rows = rows.groupBy(*group, "NAME").agg(first)
    rows = rows.withColumn("_chars", F.length("NAME"))
    rows = rows.filter(F.col("_chars") + 2 <= by_rule(lambda r: r.max_chars))
    rows = rows.withColumn("_item", F.struct("_row", "NAME")).drop("_row", "NAME")

    def needed(r: DepartmentRule) -> int:
        return r.cap + r.max_chars // 2 + 1

    pick_type = rows.schema["_item"].dataType["_row"].dataType.simpleString()
    start = F.struct(
        F.lit("").alias("text"),
        F.lit(0).alias("used"),
        F.expr(f"cast(array() as array<{pick_type}>)").alias("picks"),
    )

    def step(s: Column, x: Column) -> Column:
        sep = F.lit(V.SEPARATOR)
        fits = s["used"] + 2 + F.length(x["NAME"]) <= F.col("_max")
        known = F.contains(F.concat(sep, s["text"], sep), F.concat(sep, x["NAME"], sep))
        gap = F.when(s["text"] != "", sep).otherwise(F.lit(""))
        extra = F.length(x["_row"]["_alias"])
        grown = F.struct(
            F.concat(s["text"], gap, x["NAME"]).alias("text"),
            (
                s["used"] + F.length(gap) + F.length(x["NAME"])
                + F.when(F.col("_full") & (extra > 0), extra + 1).otherwise(0)
            ).alias("used"),
            F.concat(s["picks"], F.array(x["_row"])).alias("picks"),
        )
        # the cheap tests come first; a full list is left alone
        return F.when((F.size(s["picks"]) < F.col("_cap")) & fits & ~known, grown).otherwise(s)

    # the first names of a list are among the first of their length, too
    rows = top_n(rows, [*group, "_chars"], ["_item"], ahead + max(map(needed, rules)), "_rank")
    lists = rows.groupBy(*group).agg(F.array_sort(F.collect_list("_item")).alias("_items"))
    lists = lists.withColumns({
        "_cap": by_rule(lambda r: r.cap), "_max": by_rule(lambda r: r.max_chars), "_full": by_rule(lambda r: r.alias_budget),
    })
    begun = lists.withColumn("_begun", F.aggregate(F.slice("_items", 1, ahead), start, step))

    # what is left of the lists that the first names did not close
    room = F.col("_max") - F.col("_begun")["used"] - 2
    unfilled = F.size(F.col("_begun")["picks"]) < F.col("_cap")
    later = F.filter(
        F.slice("_items", F.lit(ahead + 1), F.greatest(F.size("_items") - ahead, F.lit(0))),
        lambda x: F.length(x["NAME"]) <= F.col("_room"),
    )
    still_open = (F.size("_items") > ahead) & unfilled & (F.col("_room") > 0)
    walk = begun.withColumn("_room", room)
    walk = walk.withColumn("_end", F.when(still_open, F.aggregate(later, F.col("_begun"), step)).otherwise(F.col("_begun")))
    return walk.select(
        *group, F.col("_end")["text"].alias("names"), F.col("_end")["picks"].alias("picks")
    ).filter(F.col("names") != "")


def parse_stats(df: DataFrame, ok: Column) -> DataFrame:
    """Rows parsed and rows failed."""
    return df.agg(
        F.count_if(ok).alias("parsed"), F.count_if(~F.coalesce(ok, F.lit(False))).alias("failed")
    )
