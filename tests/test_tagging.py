import random

import pytest

from cataloom.operators import tagging as T

TEXTS = "id long, text string"
ENTRIES = "tag string, variant string"


@pytest.mark.parametrize("key_chars", [1, 3, 4, 9])
def test_dictionary_tags_match_loop(spark, key_chars):
    rng = random.Random(7)
    word = lambda n: "".join(rng.choice("abé ") for _ in range(n))
    texts = [(i, word(rng.randint(0, 30))) for i in range(200)]
    entries = [(f"t{rng.randint(0, 25)}", word(rng.randint(1, 7))) for _ in range(60)]
    got = T.dictionary_tags(
        spark.createDataFrame(texts, TEXTS), ["id"], "text", spark.createDataFrame(entries, ENTRIES), "tag", "variant",
        key_chars=key_chars)
    expected = {}
    for i, text in texts:
        tags = sorted({t for t, v in entries if v in text})
        expected[i] = f"|{'|'.join(tags)}|" if tags else ""
    assert {r.id: r.TAGS for r in got.collect()} == expected


def test_dictionary_tags_of_odd_rows(spark, rows_of):
    texts = spark.createDataFrame(
        [(None, "a dolby track"), (1, None), (2, ""), (3, "mono"), (3, "dolby"), (4, "dol")], TEXTS)
    entries = spark.createDataFrame(
        [("dolby", "dolby"), ("dolby", "dolby"), ("mono", "mo"), (None, "track"), ("x", None), ("y", "")], ENTRIES)
    got = T.dictionary_tags(texts, ["id"], "text", entries, "tag", "variant")
    assert rows_of(got) == [(None, "|dolby|"), (1, ""), (2, ""), (3, "|dolby|mono|"), (4, "")]
    none = T.dictionary_tags(texts, ["id"], "text", entries.limit(0), "tag", "variant")
    assert {r.TAGS for r in none.collect()} == {""} and none.count() == 5
    assert T.dictionary_tags(texts.limit(0), ["id"], "text", entries, "tag", "variant").count() == 0


def test_a_large_dictionary_meets_pieces_not_texts(spark):
    """Beyond the broadcast threshold the texts themselves are not shuffled."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        texts = spark.createDataFrame([(i, f"item {i} of many") for i in range(50)], TEXTS)
        entries = spark.createDataFrame([(f"t{i}", f"item {i} ") for i in range(50)], ENTRIES)
        got = T.dictionary_tags(texts, ["id"], "text", entries, "tag", "variant")
        plan = got._jdf.queryExecution().optimizedPlan().toString().splitlines()
        moved = next(below for line, below in zip(plan, plan[1:]) if "Join LeftOuter" in line)
        assert "_piece" in moved and "_text" not in moved
        assert {r.id: r.TAGS for r in got.collect()} == {i: f"|t{i}|" for i in range(50)}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_pieces_that_begin_like_no_variant_are_dropped_before_the_join(spark):
    """Of a long text only its finds and one mark reach the join and the grouping."""
    texts = spark.createDataFrame([(i, "abcdefgh " * 40 + f"item {i} of many") for i in range(30)], TEXTS)
    entries = spark.createDataFrame([(f"t{i}", f"item {i} of many") for i in range(30)], ENTRIES)
    got = T.dictionary_tags(texts, ["id"], "text", entries, "tag", "variant")
    assert {r.id: r.TAGS for r in got.collect()} == {i: f"|t{i}|" for i in range(30)}
    joined = got._jdf.queryExecution().optimizedPlan()
    while joined.nodeName() != "Join":
        joined = joined.children().head()
    pieces = spark._jvm.org.apache.spark.sql.classic.Dataset.ofRows(spark._jsparkSession, joined.children().head())
    assert pieces.count() <= 2 * 30 + 10


def test_keys_grow_with_their_variants(spark):
    entries = spark.createDataFrame([("a", "12"), ("b", "12345"), ("c", "12345678 x"), ("d", "é" * 700)], ENTRIES)
    keys = {r.TAG: r._key for r in T.dictionary_rows(entries, "tag", "variant").collect()}
    assert keys == {"a": "12", "b": "1234", "c": "12345678", "d": "é" * 256}
    texts = spark.createDataFrame([(1, "x" * 300 + "é" * 700), (2, "é" * 699 + "12345678 x"), (3, "1" + "12" * 200)], TEXTS)
    got = T.dictionary_tags(texts, ["id"], "text", entries, "tag", "variant")
    assert {r.id: r.TAGS for r in got.collect()} == {1: "|d|", 2: "|a|b|c|", 3: "|a|"}


def test_only_places_that_may_begin_a_variant_become_pieces(spark):
    """A text is not taken apart at every character."""
    texts = spark.createDataFrame([(i, "abcdefgh " * 40 + f"item {i} of many") for i in range(30)], TEXTS)
    entries = spark.createDataFrame([(f"t{i}", f"item {i} of many") for i in range(30)], ENTRIES)
    plan = T.dictionary_tags(texts, ["id"], "text", entries, "tag", "variant")._jdf.queryExecution().optimizedPlan()
    nodes, made = [plan], []
    while nodes:
        node = nodes.pop()
        nodes += [node.children().apply(i) for i in range(node.children().size())]
        if node.nodeName() == "Generate" and "_piece" in node.generatorOutput().toString():
            made.append(spark._jvm.org.apache.spark.sql.classic.Dataset.ofRows(spark._jsparkSession, node).count())
    assert made and max(made) <= 2 * 30 + 10


def test_dictionary_of_any_characters(spark):
    """Signs of regular expressions, line ends, characters beyond 16 bits, more first characters than a pattern lists."""
    odd = [("a", "a-b]"), ("b", "^["), ("c", "\\Q.*"), ("d", "\nx"), ("e", "\U0001F600"), ("f", "\uFFFD?"), ("g", "(?"), ("h", "\u0085e\u0301")]
    many = [(f"m{i}", chr(0x4E00 + i) + "z" * (i % 9)) for i in range(T.PATTERN_STEMS + 1)]
    texts = [(i, "q" * (T.BLOCK - 3 + i) + v + "\U0001F600" * 5 + "zz") for i, (_, v) in enumerate(odd + many[:20])]
    texts.append((99, "".join(v for _, v in odd) * 400))
    for entries in (odd, odd + many):
        got = T.dictionary_tags(
            spark.createDataFrame(texts, TEXTS), ["id"], "text", spark.createDataFrame(entries, ENTRIES), "tag", "variant")
        expected = {i: sorted({t for t, v in entries if v in text}) for i, text in texts}
        assert {r.id: r.TAGS for r in got.collect()} == {i: f"|{'|'.join(t)}|" if t else "" for i, t in expected.items()}
