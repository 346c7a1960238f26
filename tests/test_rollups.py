"""Rollups and ordered operators against plain loops on small random data."""

import random

import pytest
from pyspark.sql import functions as F

from cataloom.functions import values as V
from cataloom.operators import relate as R
from cataloom.operators import rollups as A


def test_member_counts(spark, rows_of):
    movie = spark.createDataFrame([(1,), (2,)], "m long")
    dim = spark.createDataFrame([(10, "n"), (11, "n"), (12, "o"), (13, "p")], "k long, NAME string")
    bridge = spark.createDataFrame([(1, 10), (1, 11), (2, 11), (1, 11), (3, 12), (2, 13)], "m long, k long")
    assert rows_of(A.member_counts(movie, bridge, dim, "m", "k", "n"), "NAME", "n", "k") == [("n", 2, 10), ("p", 1, 13)]


def test_keyword_kpis(spark, rows_of):
    keywords = spark.createDataFrame(
        [(1, "Jean Gabin", None, None), (2, "jean gabin", 1, None), (3, "x-ray l'été", 1, 1)],
        "ID long, NAME string, MOVIE_COUNT long, SERIE_COUNT long")
    persons = spark.createDataFrame([("Jean Gabin",), ("Jean Gabin",)], "NAME string")
    out = A.keyword_kpis(keywords, persons)
    assert rows_of(out, "ID", "NAME_WORD_COUNT", "IS_EMPTY", "IS_PERSON") == [(1, 2, 1, 1), (2, 2, 1, 0), (3, 4, 0, 0)]


def test_property_text(spark, rows_of):
    edges = spark.createDataFrame(
        [("Q1", "P31", f"I{i}", i) for i in range(1, 8)] + [("Q2", "P31", "I2", 1), ("Q2", "P31", "I5", 2), ("Q2", "P31", "I6", 3)],
        "ID_WIKIDATA string, ID_PROPERTY string, ID_ITEM string, DISPLAY_ORDER int")
    items = spark.createDataFrame(
        [("I2", "en", "b"), ("I3", "en", ""), ("I4", "en", "I4"), ("I5", "en", "a"), ("I7", "en", "b"),
         ("I6", "fr", "f6"), ("I2", "fr", "f2")], "ID_WIKIDATA string, LANG string, LABEL string")
    assert rows_of(A.property_text(edges, items, "de"), "ID_WIKIDATA", "TEXT") == [("Q1", "b, f2, a, f6"), ("Q2", "b, f2, a, f6")]
    assert rows_of(A.property_text(edges, items, "fr"), "ID_WIKIDATA", "TEXT") == [("Q1", "f6"), ("Q2", "f6")]


def loop_until(names, limit):
    text, tags = "", []
    for i, name in names:
        tags.append(i)
        if len(text + ", " + name) > limit:
            break
        text += (", " if text else "") + name
    return text, tags


@pytest.mark.parametrize("limit", [20, 60])
def test_concat_until_matches_loop(spark, limit):
    rng = random.Random(limit)
    data = [(g, i, "n" * rng.randint(1, 24)) for g in range(60) for i in range(rng.randint(1, 9))]
    df = spark.createDataFrame(data, "g long, i long, n string")
    out = A.limited_list(A.concat_until(df, ["g"], ["i"], "n", "i", limit), ["g"], "n", "i")
    got = {r.g: (r.text, r.tag_ids) for r in out.collect()}
    for g in {d[0] for d in data}:
        assert got[g] == loop_until([(i, n) for x, i, n in data if x == g], limit)


def test_concat_until_cuts_a_hot_key_exactly(spark):
    df = spark.range(20000).select(F.lit(1).alias("g"), F.col("id").alias("i"), F.lit("x").alias("n"))
    out = A.limited_list(A.concat_until(df, ["g"], ["i"], "n", "i", V.MAX_KEYWORDS_CHARS), ["g"], "n", "i").first()
    text, tags = loop_until([(i, "x") for i in range(20000)], V.MAX_KEYWORDS_CHARS)
    assert (out.text, out.tag_ids) == (text, tags)


def test_top_credits(spark):
    rng = random.Random(3)
    data = []
    for g in range(40):
        for i in range(rng.randint(1, 26)):
            data.append((g, i, "n" * rng.randint(1, 9), rng.choice([None, "", "|a|bb|", "|" + "z" * 30 + "|"])))
    df = spark.createDataFrame(data, "g long, i long, NAME string, ALIASES string")
    got = {}
    for r in A.top_credits(df, ["g"], ["i"], 20, 150).orderBy("g", "pos").collect():
        got.setdefault(r.g, []).append(r.i)
    for g in range(40):
        full, kept = "", []
        for _, i, name, alias in [d for d in data if d[0] == g]:
            if len(full + ", " + name) > 150:
                break
            kept.append(i)
            full += (", " if full else "") + name
            alias = (alias or "").replace("|", " ").strip()
            full += " " + alias if alias else ""
            if len(kept) >= 20:
                break
        assert got.get(g, []) == kept


def loop_department(items, cap, limit):
    text, picks = "", []
    for i, name in items:
        if ", " + name + ", " in ", " + text + ", ":
            continue
        if len(text + ", " + name) <= limit and len(picks) < cap:
            picks.append(i)
            text += (", " if text else "") + name
    return text, picks


@pytest.mark.parametrize("ahead", [1, 4, 64])
def test_department_credits_matches_loop(spark, ahead):
    rng = random.Random(5)
    names = ["a", "ab", "abc", "a, b", "b", "bb", "x" * 30, "y" * 31, "z" * 60, "Ann", "Anna"] + [f"p{i:02d}" for i in range(30)]
    data = [
        (g, i, i + 100, rng.choice(names), None, rng.choice(["Art", "Sound", "Directing", "Choir"]), rng.choice(["Director", "x"]))
        for g in range(50) for i in range(rng.randint(1, 40))
    ]
    crew = spark.createDataFrame(
        data, "g long, i long, ID_PERSON long, NAME string, ALIASES string, CREW_DEPARTMENT string, CREW_JOB string")
    rules = [
        A.DepartmentRule("ART", "Art", max_chars=90), A.DepartmentRule("SOUND", "Sound", max_chars=40, cap=3),
        A.DepartmentRule("DIRECTORS", "Directing", "Director", max_chars=60),
        A.DepartmentRule("OTHER", None, max_chars=100, cap=5),
    ]
    got = {(r.g, r.list): (r.names, [p.i for p in r.picks]) for r in A.department_credits(crew, ["g"], ["i"], rules, ahead).collect()}
    for rule in rules:
        for g in range(50):
            items = [
                (i, n) for x, i, _, n, _, dep, job in data
                if x == g and (dep == rule.department if rule.department else dep == "Choir") and rule.job in (None, job)
            ]
            text, picks = loop_department(items, rule.cap, rule.max_chars)
            assert got.get((g, rule.column), ("", [])) == (text, picks)


def test_department_budget_counts_aliases(spark):
    data = [(1, i, i, f"n{i}", "|" + "k" * 20 + "|", "Writing", "x") for i in range(5)]
    crew = spark.createDataFrame(
        data, "g long, i long, ID_PERSON long, NAME string, ALIASES string, CREW_DEPARTMENT string, CREW_JOB string")
    rules = [A.DepartmentRule("WRITERS", "Writing", max_chars=60, alias_budget=True)]
    assert A.department_credits(crew, ["g"], ["i"], rules).first().names == "n0, n1, n2"


TITLES = ["Intro", "Plot", "Synopsis", "Premise", "Cast", "Voice cast", " Plot ", "Trivia", "Music", "Soundtrack", "Notes"]


def loop_sections(sections):
    out, others = {}, "|"
    for title, content in sections:
        title = title.strip()
        if title in V.SECTIONS_SKIPPED:
            continue
        if title in V.SECTIONS_EXACT:
            out[V.SECTIONS_EXACT[title]] = content
        elif title in V.SECTIONS_FALLBACK and V.SECTIONS_FALLBACK[title] not in out:
            out[V.SECTIONS_FALLBACK[title]] = content
        else:
            others += title + "|"
            out["OTHER_SECTIONS"] = others
    return out


def test_route_sections_matches_loop(spark):
    rng = random.Random(11)
    data = [(g, i, rng.choice(TITLES), f"c{g}-{i}") for g in range(200) for i in range(rng.randint(1, 9))]
    df = spark.createDataFrame(data, "g long, i long, TITLE string, CONTENT string")
    got = {r.g: {k: v for k, v in r.asDict().items() if k != "g" and v is not None} for r in R.route_sections(df, "g", ["i"]).collect()}
    for g in range(200):
        assert got.get(g, {}) == loop_sections([(t, x) for n, _, t, x in data if n == g])


@pytest.mark.parametrize("width", [3, 1000])
def test_ordered_scans_match_loop(spark, width):
    rng = random.Random(2)
    data = [(g, i, rng.choice([None, i])) for g in range(20) for i in sorted(rng.sample(range(40), 15))]
    df = spark.createDataFrame(data, "g long, i long, v long")
    filled = {(r.g, r.i): r.v for r in R.forward_fill(df, ["g"], "i", "v", 0, width).collect()}
    totals = {(r.g, r.i): r.t for r in R.running_total(df, ["g"], "i", F.col("i"), "t", width).collect()}
    for g in range(20):
        last, total = 0, 0
        for _, i, v in [d for d in data if d[0] == g]:
            last = v if v is not None else last
            assert filled[(g, i)] == last
            assert totals[(g, i)] == total
            total += i


def test_ranges_of_a_hot_key_stay_small(spark):
    # sparse 64-bit order values: one key holds nearly all rows
    rows = spark.range(20_000).select(
        F.when(F.col("id") < 19_000, 1).otherwise(F.col("id")).alias("g"), F.xxhash64("id").alias("o"), "id")
    sizes = R._sliced(rows, ["g"], "o", 100).groupBy("g", "_slice").count()
    hot = [r["count"] for r in sizes.filter("g = 1").collect()]
    assert sum(hot) == 19_000 and 100 < len(hot) < 300 and max(hot) < 2_000


def test_ordered_scans_take_text_and_nulls(spark):
    data = [(None, f"k{i:03d}", i if i % 3 else None) for i in range(60)] + [(1, None, 5), (1, "a", None), (1, "b", None)]
    df = spark.createDataFrame(data, "g long, o string, v long")
    filled = {(r.g, r.o): r.v for r in R.forward_fill(df, ["g"], "o", "v", 0, 2).collect()}
    totals = {(r.g, r.o): r.t for r in R.running_total(df, ["g"], "o", F.lit(1), "t", 2).collect()}
    assert [filled[(None, f"k{i:03d}")] for i in range(60)] == [0 if i == 0 else i if i % 3 else i - 1 for i in range(60)]
    assert [totals[(None, f"k{i:03d}")] for i in range(60)] == list(range(60))
    assert [filled[(1, o)] for o in (None, "a", "b")] == [5, 5, 5]
    assert [totals[(1, o)] for o in (None, "a", "b")] == [0, 1, 2]
    empty = df.limit(0)
    assert R.forward_fill(empty, ["g"], "o", "v", 0).count() == R.running_total(empty, ["g"], "o", F.lit(1), "t").count() == 0


def test_lookup_ci(spark, rows_of):
    dim = spark.createDataFrame([(1, "Dolby"), (2, "dolby"), (3, "mono"), (4, ""), (5, "mono")], "ID long, N string")
    values = spark.createDataFrame([("Dolby",), ("DOLBY",), ("MONO",), ("mono",), ("x",), ("",)], "v string")
    got = rows_of(R.lookup_ci(values, dim, "v", "N", "ID"))
    assert got == [("", None), ("DOLBY", 1), ("Dolby", 1), ("MONO", 5), ("mono", 5), ("x", None)]


def test_localised(spark, rows_of):
    base = spark.createDataFrame([(1, "a"), (2, "b"), (3, ""), (4, "d")], "id long, N string")
    variants = spark.createDataFrame([(1, "fr", "A"), (2, "fr", ""), (4, "en", "D")], "id long, LANG string, N string")
    assert rows_of(R.localised(base, variants, "id", "N", "fr", "out"), "id", "out") == [(1, "A"), (2, "b"), (3, None), (4, "d")]


def test_top_n_beyond_the_group_limit(spark):
    df = spark.range(5000).select(F.lit(1).alias("g"), "id")
    out = R.top_n(df, ["g"], ["id"], 1500)
    assert [r.id for r in out.orderBy("rank").collect()] == list(range(1500))


def test_ordered_join_keeps_first_occurrence(spark):
    df = spark.createDataFrame([(1, 3, "a"), (1, 1, "b"), (1, 2, "a"), (1, 4, ""), (1, 5, None)], "g long, i long, v string")
    assert A.ordered_join(df, ["g"], ["i"], "v", "t").first().t == "b, a"


def test_first_position_and_numbering(spark, rows_of):
    df = spark.createDataFrame([(1, "cast", 7, 1), (1, "cast", 8, 2), (1, "cast", 7, 3), (1, "crew", 7, 1)], "t long, k string, p long, pos int")
    out = R.first_position(df, ["t", "k"], "p", "pos", "o")
    assert rows_of(out, "k", "p", "pos", "o") == [("cast", 7, 1, 1), ("cast", 7, 3, 1), ("cast", 8, 2, 2), ("crew", 7, 1, 1)]
    arrays = spark.createDataFrame([(1, ["a", None, "c"]), (2, [])], "id long, xs array<string>")
    numbered = R.number_items(arrays, ["id"], "xs").filter(F.col("item").isNotNull())
    assert rows_of(numbered) == [(1, 1, "a"), (1, 3, "c")]


def test_only_known_drops_rows_before_they_are_sent(spark, rows_of):
    rows = spark.createDataFrame([(i % 1000, i) for i in range(2000)] + [(None, -1)], "k long, v long")
    known = spark.createDataFrame([(3,), (3,), (None,), (5000,)], "k long")
    got = R.only_known(rows, known, "k")
    assert sorted(rows_of(got)) == [(3, 3), (3, 1003)]
    assert R.only_known(rows, known.limit(0), "k").count() == 0
    joined = got._jdf.queryExecution().optimizedPlan()
    while joined.nodeName() != "Join":
        joined = joined.children().head()
    sent = spark._jvm.org.apache.spark.sql.classic.Dataset.ofRows(spark._jsparkSession, joined.children().head())
    assert sent.count() < 600


def test_properties_meet_by_entity_once(spark):
    """Folding, pivoting and joining the texts of several languages take no further exchange."""
    edges = spark.createDataFrame([("Q1", "P1", "I1", 1)], "ID_WIKIDATA string, ID_PROPERTY string, ID_ITEM string, DISPLAY_ORDER int")
    items = spark.createDataFrame([("I1", "fr", "un"), ("I1", "en", "one")], "ID_WIKIDATA string, LANG string, LABEL string")
    texts = A.pivot_properties(A.property_texts(edges, items, ["fr", "en"]), ["P1"], ["ID_WIKIDATA", "LANG"])
    plan = texts._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 4  # two for the join with the items, labels, entities
    assert {(r.LANG, r.P1) for r in texts.collect()} == {("fr", "un"), ("en", "one")}


def test_department_lists_stay_where_their_rows_met(spark):
    crew = spark.createDataFrame(
        [(1, i, i, f"n{i}", None, "Art", "x") for i in range(5)],
        "g long, i long, ID_PERSON long, NAME string, ALIASES string, CREW_DEPARTMENT string, CREW_JOB string")
    lists = A.department_credits(crew.repartition("g"), ["g"], ["i"], [A.DepartmentRule("ART", "Art")])
    assert lists._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert lists.first().names == "n0, n1, n2, n3, n4"


def test_membership_filter_of_several_segments(spark):
    known = spark.range(20000).selectExpr("id * 3 as k")
    held = R.membership_filter(known.select(F.xxhash64("k").alias("_hash")), "_hash")
    words = held.first().words
    assert words.n == 5000 and [len(x) for x in words.words] == [1024] * 4 + [904]
    found = spark.range(60000).filter(R.may_hold(held, F.xxhash64("id")))
    assert found.filter("id % 3 = 0").count() == 20000 and found.count() < 25000
