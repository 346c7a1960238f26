"""Periodic runs against plain loops over all periods."""

import hashlib
import random
import re
import zlib

import numpy as np
from pyspark.sql import functions as F

from cataloom.llm import periodic, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(x):
    """All runs: every period, every longest stretch; the smallest period of each span."""
    found = {}
    for q in range(1, len(x) // 2 + 1):
        i = 0
        while i < len(x) - q:
            if x[i] != x[i + q]:
                i += 1
                continue
            j = i
            while j < len(x) - q and x[j] == x[j + q]:
                j += 1
            if j - i + q >= max(12, 2 * q):
                found.setdefault((i, j + q), q)
            i = j
    return sorted((a, b - a, q) for (a, b), q in found.items())


def check(texts):
    text, start, length, period = periodic.runs_of([np.array(t, np.int64) for t in texts])
    got = [[] for _ in texts]
    for k, *r in zip(text.tolist(), start.tolist(), length.tolist(), period.tolist()):
        got[k].append(tuple(r))
    for k, t in enumerate(texts):
        assert sorted(got[k]) == brute(t), (k, t)


def test_runs_of_random_words():
    rng = random.Random(5)
    check([[rng.randrange(a) for _ in range(rng.randint(0, n))] for a in (1, 2, 3, 50) for n in (15, 40, 150, 400) for _ in range(12)])


def test_runs_with_planted_periods():
    rng = random.Random(6)
    texts = []
    for _ in range(120):
        alphabet = rng.choice([2, 5, 1000])
        block = [rng.randrange(alphabet) for _ in range(rng.choice([1, 3, 20, 31, 32, 33, 63, 64, 65, 100, 128, 200]))]
        if rng.random() < 0.4:  # a block that repeats within itself
            block = (block * 40)[: rng.randint(20, 260)]
        tail = block[: rng.randint(0, len(block))]
        head = [rng.randrange(alphabet) for _ in range(rng.randint(0, 40))]
        texts.append(head + block * rng.randint(2, 4) + tail + [rng.randrange(alphabet) for _ in range(rng.randint(0, 40))])
    check(texts)


def test_runs_of_structured_words():
    fib = [[0], [0, 1]]
    while len(fib[-1]) < 700:
        fib.append(fib[-1] + fib[-2])
    thue = [bin(i).count("1") % 2 for i in range(600)]
    nested = ([0] * 50 + [1]) * 12
    junctions = [0, 1] * 40 + [0] + [0, 1] * 40 + [0] + [0, 1] * 33
    ladder = [v for k in range(1, 30) for v in [0] * k + [1]]
    check([fib[-1], thue, nested, junctions, ladder, ladder * 3, [0] * 900, ([0] * 70 + [1] * 70) * 4, list(range(80)) * 5, thue * 2])


def test_long_repeated_text_is_not_quadratic():
    text, start, length, period = periodic.runs_of([np.zeros(400_000, np.int64), np.tile(np.arange(3), 100_000)])
    assert list(zip(text.tolist(), start.tolist(), length.tolist(), period.tolist())) == [(0, 0, 400_000, 1), (1, 0, 300_000, 3)]


def expected(doc_id, text):
    words = WORD.findall(text or "")
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n, g = len(words), h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute(words)
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def test_registered_query(spark, make_docs, odd_rows, tmp_path, same_rows):
    rng = random.Random(8)
    rows = [r for r in odd_rows if len(r[1] or "") < 20_000]
    rows += [(100 + k, " ".join(rng.choice("abcdefgh") * rng.randint(1, 3) for _ in range(rng.randint(0, 300)))) for k in range(120)]
    tenth = [i for i in range(1000, 1100) if zlib.crc32(str(i).encode()) % 10 == 0]
    rows += [(tenth[0], None), (tenth[1], " "), (tenth[2], "one"), (tenth[3], "a b c d e f g h i j k l m n o p q r s t u v")]
    rows += [(300, "x " * 700), (301, "one two three four five six\n" * 60), (302, "　a b " * 8)]
    make_docs(rows).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op13(spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    same_rows(got.collect(), [expected(*r) for r in rows])


def test_collapsed_texts(spark, make_docs, empty):
    docs = make_docs([(1, "so " * 14 + "it goes"), (None, None), (2, " \n "), (2, " \n "), (3, "a b c d e f a b c d e f g")])
    got = {(r.doc_id, r.n_words, tuple(map(tuple, r.runs)), r.collapsed) for r in periodic.collapse_runs(docs).collect()}
    assert got == {(1, 16, ((0, 14, 1),), "so it goes"), (None, 0, (), ""), (2, 0, (), ""), (3, 13, ((0, 12, 6),), "a b c d e f g")}
    assert periodic.collapse_runs(docs).where(F.col("doc_id") == 2).count() == 2
    assert periodic.collapse_runs(empty).collect() == []
