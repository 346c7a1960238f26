"""Quality rules, sharding, fingerprints and LM scores against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cataloom.llm import fingerprints, lm, quality, shards, words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def statistics(text):
    w = WORD.findall(text or "")
    times = Counter(zip(w, w[1:], w[2:], strict=False))
    covered = {k + j for k in range(len(w) - 2) if times[w[k], w[k + 1], w[k + 2]] > 1 for j in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered))


def test_statistics_of_odd_documents(spark, odd, odd_rows, same_rows):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    got, rules = quality.quality_verdicts(odd, labels)
    assert rules == []
    want = []
    for i, t in odd_rows:
        s = statistics(t)
        failed = s[0] < 50 or 100 * s[4] > 50 * s[0]
        want.append((i, *s, failed, not failed))
    same_rows(got.collect(), want)


def test_statistics_of_no_documents(spark, empty):
    labels = spark.createDataFrame([(1, 0)], "doc_id long, quality int")
    assert quality.quality_verdicts(empty, labels)[0].collect() == []


def noisy_documents():
    rng = random.Random(3)
    good = lambda: " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8))) for _ in range(120))
    rows, labels = [], []
    for k in range(400):
        text, mark = good(), 1
        if k % 4 == 0:
            text, mark = " ".join(w + "***" for w in text.split()), 0
        elif k % 4 == 1:
            text, mark = text.upper(), 0
        rows.append((k, text))
        if k < 300:
            labels.append((k, mark))
    return rows, labels


def test_rules_are_learned_and_hold_on_unlabelled_documents(spark, make_docs):
    rows, labels = noisy_documents()
    marks = spark.createDataFrame([*labels, (2, None), (100_000, 0)], "doc_id long, quality int")
    found, rules = quality.quality_verdicts(make_docs(rows), marks)
    assert rules and all(r.precision >= 0.9 and r.conditions for r in rules)
    kept = {r.doc_id: r.kept for r in found.collect()}
    assert [kept[k] for k in range(300, 400)] == [k % 4 > 1 for k in range(300, 400)]
    passed = quality.keep_good(make_docs(rows), marks)
    assert passed.columns == make_docs(rows).columns
    assert {r.doc_id for r in passed.collect()} == {k for k, v in kept.items() if v}


def test_one_class_of_labels_teaches_nothing(spark, make_docs):
    rows, _ = noisy_documents()
    for mark in (0, 1):
        marks = spark.createDataFrame([(k, mark) for k in range(50)], "doc_id long, quality int")
        assert quality.quality_verdicts(make_docs(rows), marks)[1] == []


def check_shards(rows, wanted, n, slack):
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == wanted
    by = defaultdict(list)
    for r in rows:
        assert 0 <= r.shard < n
        by[r.shard].append(r)
    for found in by.values():
        assert sorted(r.slot for r in found) == list(range(len(found)))
    total, largest = sum(r.size for r in rows), max(r.size for r in rows)
    assert all(abs(sum(r.size for r in by[k]) - total / n) <= slack * largest for k in range(n))


def sizes_of(rows):
    return Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in rows)


def test_shards_of_odd_documents(odd, odd_rows):
    check_shards(shards.shard_by_bytes(odd, 5).collect(), sizes_of(odd_rows), 5, 2)


def test_shards_with_a_hot_text(make_docs):
    rng = random.Random(4)
    rows = [(k, "the one hot text" if k % 3 == 0 else "x" * rng.randint(0, 60)) for k in range(3000)]
    found = shards.shard_by_bytes(make_docs(rows), 8).collect()
    check_shards(found, sizes_of(rows), 8, 3)
    of = defaultdict(set)
    for r in found:
        of[r.text_crc32].add(r.shard)
    assert sum(len(v) > 1 for v in of.values()) <= 16  # only groups at a border, or too large, are split


def test_groups_up_to_the_largest_document_share_a_shard(make_docs):
    rng = random.Random(5)
    texts = [f"{k} " + "".join(rng.choice("abcdef") for _ in range(700)) for k in range(60)]
    rows = [(10 * k + j, t) for k, t in enumerate(texts) for j in range(10)] + [(5000, "y" * 60_000)]
    rows += [(6000 + k, "z" * rng.randint(0, 900)) for k in range(500)]
    found = shards.shard_by_bytes(make_docs(rows), 24).collect()
    check_shards(found, sizes_of(rows), 24, 3)
    of, size = defaultdict(set), Counter()
    for r in found:
        of[r.text_crc32].add(r.shard)
        size[r.text_crc32] += r.size
    assert all(len(v) == 1 for k, v in of.items() if size[k] <= 60_008)


def test_shards_of_no_documents(empty):
    assert shards.shard_by_bytes(empty, 4).collect() == []


def test_words_and_windows():
    texts = ["The the THE", "", " a b\n\x0bc ", None, "x" * 100 + " y", "é É a", "ab ba ab", "z" * 50]
    rows, hashes = words.word_hashes(pa.array(texts))
    want = [(k, w) for k, t in enumerate(texts) for w in WORD.findall(lower(t))]
    assert rows.tolist() == [k for k, _ in want]
    assert len({*hashes.tolist()}) == len({w for _, w in want}) == len({*zip([w for _, w in want], hashes.tolist(), strict=True)})
    at, grams = words.windows(rows, hashes, 3)
    wanted = []
    for k, t in enumerate(texts):
        w = WORD.findall(lower(t))
        wanted += [(k, tuple(w[j : j + 3])) for j in range(max(1, len(w) - 2))] if w else []
    assert Counter(at.tolist()) == Counter(k for k, _ in wanted)
    assert len({*zip(at.tolist(), grams.tolist(), strict=True)}) == len({*wanted})


def test_words_across_chunks(monkeypatch):
    texts = [" ".join(f"w{k % 50}" * (1 + k % 40) for k in range(600)), None, "q" * 400, "a " * 100 + "b" * 90]
    whole = words.word_hashes(pa.array(texts))
    monkeypatch.setattr(words, "CHUNK", 64)
    monkeypatch.setattr(words, "_powers", {})
    parts = words.word_hashes(pa.array(texts))
    assert all((a == b).all() for a, b in zip(whole, parts, strict=True))


def brute_simhash(text):
    rows, hashes = words.word_hashes(pa.array([text]))
    votes = [0] * 64
    for term, times in Counter(words.windows(rows, hashes, 2)[1].tolist()).items():
        weight = round(4 + 4 * math.log2(times))
        for b in range(64):
            votes[b] += weight if term >> b & 1 else -weight
    return sum(1 << b for b in range(64) if votes[b] > 0)


def test_fingerprints_and_edited_texts(odd, odd_rows):
    got = fingerprints.edited_fingerprints(odd).collect()
    order = sorted(odd_rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    want = Counter()
    for (i, t), (_, u) in zip(order, order[1:] + order[:1], strict=True):
        t, u = t or "", u or ""
        edited = t[: len(t) - len(t) // 2] + u[: len(t) // 2]
        want[i, len(t), hashlib.sha256(edited.encode()).hexdigest(), brute_simhash(t), brute_simhash(edited), brute_simhash(u)] += 1
    unsigned = lambda x: x & (1 << 64) - 1
    assert Counter((r.doc_id, r.n_chars, hashlib.sha256(r.edited.encode()).hexdigest(), unsigned(r.fingerprint),
                    unsigned(r.edited_fingerprint), unsigned(r.next_fingerprint)) for r in got) == want
    plain = {(r.doc_id, unsigned(r.fingerprint)) for r in fingerprints.fingerprint(odd).collect()}
    assert plain == {(i, p) for i, _, _, p, _, _ in want}


def test_edited_text_of_a_single_document_uses_itself(make_docs):
    (r,) = fingerprints.edited_fingerprints(make_docs([(5, "abcde")])).collect()
    assert (r.doc_id, r.n_chars, r.edited) == (5, 5, "abcab")


def test_fingerprints_of_no_documents(empty):
    assert fingerprints.edited_fingerprints(empty).collect() == []


@pytest.mark.parametrize("radius,blocks", [(0, 4), (3, 6), (5, 8)])
def test_block_tables_find_all_within_the_radius(spark, radius, blocks):
    rng = random.Random(radius)
    prints = [0, (1 << 64) - 1]
    for _ in range(60):
        p = rng.getrandbits(64)
        prints += [p, p]
        for flips in range(7):
            prints.append(p ^ sum(1 << b for b in rng.sample(range(64), flips)))
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    all_prints = spark.createDataFrame([(p,) for p in [*signed, None]], "fingerprint long")
    asked = spark.createDataFrame([(p,) for p in [*signed[::5], None]], "query long")
    got = {tuple(r) for r in fingerprints.within_radius(asked, all_prints, radius, blocks).collect()}
    want = {(a, b) for a in signed[::5] for b in signed if bin((a ^ b) & (1 << 64) - 1).count("1") <= radius}
    assert got == want


def lm_brute(rows, weight, damp):
    tokens = [(i, [*WORD.findall(lower(t)), None]) for i, t in rows]
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 10 == 0
    c, pairs = Counter(), Counter()
    for i, w in tokens:
        if not held(i):
            c.update(w)
            pairs.update(zip(w, w[1:], strict=False))
    n, v = sum(c.values()), len(c)
    for i, w in tokens:
        base = total = 0.0
        state = None
        for x in w:
            p = (c[x] + 0.1) / (n + 0.1 * (v + 1))
            base += math.log10(p)
            share = weight * c[state] / (c[state] + damp) if state is not None else 0
            total += math.log10((share * pairs[state, x] / c[state] if share else 0) + (1 - share) * p)
            state = x if x is not None and c[x] else None
        yield (i, held(i), len(w), sum(c[x] > 0 for x in w), n, base, total)


@pytest.mark.parametrize("block", [1_000_000, 50])
def test_lm_scores_of_odd_documents(odd, odd_rows, same_rows, monkeypatch, block):
    monkeypatch.setattr(lm, "BLOCK_TOKENS", block)
    near = lambda r: (*r[:5], round(r[5], 4), round(r[6], 3))
    got = lm.score(odd).collect()
    same_rows(map(near, got), map(near, lm_brute(odd_rows, lm.WEIGHT, lm.DAMP)))


def test_lm_without_training_documents(make_docs):
    held = [k for k in range(200) if zlib.crc32(str(k).encode()) % 10 == 0]
    got = lm.score(make_docs([(k, "a b") for k in held[:3]])).collect()
    assert [(r.held_out, r.n_known, r.train_tokens, r.score) for r in got] == [(True, 0, 0, 0.0)] * 3


def test_lm_of_no_documents(empty):
    assert lm.score(empty).collect() == []


def test_lm_arcs_of_each_state_sum_to_one():
    c, pairs, weight, damp = Counter("abracadabra"), Counter(zip("abracadabra", "bracadabra", strict=False)), lm.WEIGHT, lm.DAMP
    n, v = sum(c.values()), len(c)
    p = {w: (c[w] + 0.1) / (n + 0.1 * (v + 1)) for w in [*c, "unknown"]}
    for state in "abr":
        followed = sum(k for (x, _), k in pairs.items() if x == state)
        share = weight * followed / (followed + damp)
        assert math.isclose(sum(share * pairs[state, w] / followed + (1 - share) * p[w] for w in p), 1)


def test_lm_prefers_held_out_copies(make_docs, odd_rows):
    rows = [(k, odd_rows[8][1]) for k in range(40)]
    got = [r for r in lm.score(make_docs(rows)).collect() if r.held_out]
    assert got and all(r.score > r.base_score for r in got)


def test_range_tree(spark):
    df = spark.range(-3, 12).select("id", shards.range_of(F.col("id"), [0, 4, 5]).alias("r"))
    assert {r.id: r.r for r in df.collect()} == {k: int(np.searchsorted([0, 4, 5], k, "right")) for k in range(-3, 12)}
