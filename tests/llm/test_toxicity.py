"""Toxicity: decoding against all paths of the lattice, held-out accuracy, disguised words."""

import itertools
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from cataloom.llm import queries, toxicity

WORDS = ["idiot", "moron", "pathetic", "loser", "garden", "window", "yellow", "reading", "letter", "summer", "coffee", "little"]


@pytest.fixture(scope="module")
def channel():
    rng = random.Random(1)
    texts = [" ".join(rng.choice(WORDS) for _ in range(300)) for _ in range(20)]
    return toxicity.Channel(toxicity.letter_costs(toxicity.trigram_counts(texts)))


def cheapest(channel, token, spaced):
    """Cost of the best path, all paths tried."""
    runs = [channel._options(s, len(list(r))) for s, r in itertools.groupby(token)]
    best = {}
    for path in itertools.product(*runs):
        gaps = itertools.product((False, True), repeat=len(path)) if spaced else [(False,) * len(path)]
        for cut in gaps:
            total, a, b, out, ok = 0.0, 0, 0, "", True
            for (letters, price), c in zip(path, cut):
                if c:
                    if b == 0:
                        ok = False
                        break
                    total += toxicity.CUT + channel.costs[a][b][0]
                    a, b, out = 0, 0, out + " "
                total += price
                for x in letters:
                    k = toxicity.class_of(x)
                    total += channel.costs[a][b][k]
                    a, b = (b, k) if k else (0, 0)
                out += letters
            if ok:
                total += channel.costs[a][b][0]
                best[out.strip()] = min(best.get(out.strip(), 1e9), total)
    return min(best.values()), best


def test_decoding_finds_the_cheapest_path(channel):
    rng = random.Random(2)
    tokens = ["1d10t", "m0r0n", "l0s3r", "p@th3t1c", "iidiioot", "looooser", "i.d.i.o.t", "l-o-s-e-r", "a$$", "g4rd3n!x"]
    tokens += ["".join(rng.choice("idot10l3$.aa") for _ in range(rng.randint(2, 7))) for _ in range(40)]
    for token in tokens:
        for spaced in (False, True):
            if any(map(toxicity.class_of, token)):
                low, best = cheapest(channel, token, spaced)
                assert best[channel.restore(token, spaced)] == pytest.approx(low), (token, spaced)


def test_disguised_words_are_restored(channel):
    for seen, word in [("1d10t", "idiot"), ("m0r0n", "moron"), ("l0s3r", "loser"), ("p@th3t1c", "pathetic"), ("iiidiooot", "idiot"),
                       ("i.d.i.o.t", "idiot"), ("m-o-r-o-n", "moron"), ("l_o_s_e_r", "loser"), ("lettter", "letter"), ("coffeeee", "coffee")]:
        assert channel.restore(seen) == word
    assert channel.text("You 1d10t! The l o s e r, yes: i d i o t m o r o n (gard3n).") == "you idiot! the loser, yes: idiot moron (garden)."
    assert channel.words("Red i d i o t door l0ser!!") >= {"red", "idiot", "door", "loser"}
    # what shows no sign of disguise stays as it is
    assert channel.text("plain 1234 words\tstay ### 日本語 \n here") == "plain 1234 words\tstay ### 日本語 \n here"
    assert channel.restore("x" * 100_000) in ("x", "xx")


def test_letter_counts():
    counts = toxicity.trigram_counts(["Ab ab", "é!", ""])
    got = {(k // 784, k // 28 % 28, k % 28): int(counts[k]) for k in np.flatnonzero(counts)}
    assert got == Counter({(0, 0, 1): 2, (0, 1, 2): 2, (1, 2, 0): 2, (0, 0, 5): 1, (0, 5, 0): 1})


def disguise(rng, word):
    kind = rng.randrange(5)
    if kind == 0:
        return word
    if kind == 1:
        return "".join({"i": "1", "o": "0", "e": "3", "a": "@", "s": "$", "t": "7"}.get(c, c) for c in word)
    if kind == 2:
        return "".join(c * (3 if rng.random() < 0.5 else 1) for c in word)
    return (" " if kind == 3 else ".").join(word)


def prose(rng, n):
    return [rng.choice("abcdefghilmnoprstu") + "".join(rng.choice(["an", "er", "ing", "st", "ou", "le", "ti", "mo"]) for _ in range(rng.randint(1, 3)))
            for _ in range(n)]


def fold(i):
    return zlib.crc32(str(i).encode()) % 5


def test_held_out_accuracy_and_contract(spark, make_docs, tmp_path):
    rng = random.Random(3)
    rows, marks = [], []
    for i in range(900):
        words, toxic = prose(rng, rng.randint(20, 120)), int(i % 5 == 0)
        if toxic:
            for _ in range(3):
                # unseen endings of a known stem, and disguised words, occur in held-out rows
                word = rng.choice(["idiot", "moron", "loser", "krumpf" + rng.choice(["en", "isch", "ung", "er"])])
                words.insert(rng.randrange(len(words)), disguise(rng, word) if fold(i) == 0 else word)
        rows.append((i, " ".join(words)))
        if i < 800:
            marks.append((i, toxic))
    rows += [(2000, None), (2001, ""), (2002, " \n "), (None, "you idiot moron loser"), (7, rows[7][1]), (2003, "日本語 " * 50), (2004, "x" * 50_000)]
    marks += [(5000, 1), (None, 1), (0, None), (7, marks[7][1])]
    make_docs(rows).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(marks, "doc_id long, toxic int").selectExpr("*", "1 as quality", "'own' as id", "'own' as fold").write.parquet(
        f"{tmp_path}/labels.parquet")
    got = queries.op11(spark, str(tmp_path))
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    got = got.collect()
    assert sorted((r.doc_id is not None, r.doc_id or 0) for r in got) == sorted((i is not None, i or 0) for i, _ in rows)
    assert all(r.held_out == (r.doc_id is not None and fold(r.doc_id) == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    by = {r.doc_id: r.predicted for r in got}
    held = [i for i in range(900) if fold(i) == 0]
    toxic = [i for i in held if i % 5 == 0]
    assert sum(by[i] for i in toxic) >= 0.95 * len(toxic)
    assert sum(by[i] for i in held if i % 5) <= 0.02 * len(held)
    assert by[2000] == by[2001] == by[2002] == by[2003] == by[2004] == 0 and by[None] == 1


def test_held_out_labels_play_no_part(spark, make_docs):
    rng = random.Random(4)
    rows = [(i, " ".join(prose(rng, 30) + (["moron"] * (i % 4 == 0)))) for i in range(200)]
    labels = [(i, int(i % 4 == 0)) for i in range(200)]
    turned = [(i, 1 - t if fold(i) == 0 else t) for i, t in labels]
    docs = make_docs(rows)
    one, two = (sorted(toxicity.score(docs, spark.createDataFrame(x, "doc_id long, toxic int")).collect()) for x in (labels, turned))
    assert one == two


def test_no_rows_and_no_labels(spark, make_docs, empty):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    some = spark.createDataFrame([(1, 1)], "doc_id long, toxic int")
    assert toxicity.score(empty, some).collect() == []
    assert [(r.doc_id, r.score, r.predicted) for r in toxicity.score(make_docs([(1, "some words")]), none).collect()] == [(1, 0.25, 0)]
    model = toxicity.character_model(make_docs([(1, "idiot idiot")]))
    assert [tuple(r) for r in toxicity.restored(make_docs([(1, "1d10t"), (2, None)]), model).collect()] == [(1, "idiot"), (2, None)]
