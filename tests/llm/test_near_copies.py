"""Line dedup, Jaccard join and components against brute force; the pipeline stage by stage."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cataloom.llm import jaccard, lines
from cataloom.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def edits(a, b):
    before = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            now.append(min(before[j] + 1, now[-1] + 1, before[j - 1] + (x != y)))
        before = now
    return before[-1]


def changed(rng, text, most):
    out = list(text)
    for _ in range(rng.randint(0, most)):
        at = rng.randint(0, len(out))
        kind = rng.random()
        if kind < 0.4:
            out.insert(at, rng.choice("abcé"))
        elif out and kind < 0.7:
            out.pop(at % len(out))
        elif out:
            out[at % len(out)] = rng.choice("abcé")
    return "".join(out)


@pytest.mark.parametrize("threshold", [1, 2, 3])
def test_edit_distance_and_segments(threshold):
    rng = random.Random(threshold)
    first = ["".join(rng.choice("abcé") for _ in range(rng.randint(0, 30))) for _ in range(1500)]
    second = [changed(rng, a, 5) for a in first]
    near = lines.edit_within(first, second, threshold)
    for a, b, found in zip(first, second, near, strict=True):
        assert found == (edits(a, b) <= threshold)
        if found and a != b and min(len(a), len(b)) > threshold:
            x, y = lines.keys_of(a, threshold), lines.keys_of(b, threshold)
            own = lambda keys: {k for k, kind in zip(*keys, strict=True) if kind == 0}
            assert set(x[0]) & own(y) or set(y[0]) & own(x)
            letters = [lines.letter_counts([s]) for s in (a, b)]
            assert lines._compatible(*letters, threshold).all()


def test_edit_distance_of_nothing():
    assert lines.edit_within([], [], 2).tolist() == []
    assert lines.edit_within(["", "", "ab"], ["", "abc", ""], 2).tolist() == [True, False, True]


def dedup_brute(rows, threshold, min_chars):
    seen, out = [], []
    keyed = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    for i, text in keyed:
        kept = []
        for line in (text or "").split("\n"):
            if len(line) < min_chars:
                kept.append(line)
            elif line in seen or any(abs(len(s) - len(line)) <= threshold and edits(s, line) <= threshold for s in seen):
                if line not in seen:
                    seen.append(line)
            else:
                seen.append(line)
                kept.append(line)
        out.append((i, None if text is None else "\n".join(kept)))
    return out


def line_rows():
    rng = random.Random(11)
    pool = ["".join(rng.choice("abcé  ") for _ in range(rng.randint(10, 60))) for _ in range(25)]
    rows = [(1, None), (2, ""), (3, "short\nshort"), (4, "\n\n"), (5, " " * 30 + "\n" + " " * 30)]
    rows += [(10 + k, "\n".join(changed(rng, rng.choice(pool), 3) for _ in range(rng.randint(1, 6)))) for k in range(60)]
    return rows


@pytest.mark.parametrize("bucket", [4096, 2])
def test_line_dedup(make_docs, same_rows, monkeypatch, bucket):
    monkeypatch.setattr(lines, "BUCKET", bucket)
    rows = line_rows()
    docs = make_docs(rows)
    got = lines.dedup_lines(docs)
    assert got.columns == docs.columns
    same_rows(got.select("doc_id", "text").collect(), dedup_brute(rows, lines.THRESHOLD, lines.MIN_CHARS))
    assert got.where("line != 'own line' or gone != 'own gone'").count() == 0


def test_line_dedup_of_odd_documents(odd, odd_rows):
    got = lines.dedup_lines(odd, info="info").collect()
    assert len(got) == len(odd_rows)
    texts = {i: t for i, t in odd_rows if i != 90 and i is not None}
    for r in got:
        if r.doc_id in (1, 2, 3, 4, 5, 6, 7, 8):
            assert r.text == texts[r.doc_id] and r.info.n_removed == 0
        if r.doc_id in (11, 90):  # copies of document 10, or of the one without an id, which comes first
            assert r.text == "" and r.info.n_removed == r.info.n_lines == 6
        if r.doc_id is None and r.info.n_removed == 0:
            assert r.text
    assert sum(r.text == "" for r in got if r.doc_id == 90) == 2  # a repeated row is the same document


def test_line_dedup_of_no_documents(empty):
    assert lines.dedup_lines(empty).collect() == []


def test_short_lines_of_copies_go(make_docs, same_rows):
    rng = random.Random(12)
    long = lambda: " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "omega"]) + str(rng.random()) for _ in range(4))
    body = "\n".join([long(), "Les.", "", long(), "A"])
    rows = [(1, body), (2, body), (3, "\n".join([long(), "Les", "", "Les."])), (4, "Les.\nLes"), (5, "\n \n\n"), (6, body)]
    got = lines.dedup_lines(make_docs(rows), info="info", exact_chars=1).collect()
    third = rows[2][1].split("\n")
    same_rows([(r.doc_id, r.text) for r in got], [
        (1, body), (2, ""), (3, "\n".join(third[:3])), (4, ""), (5, "\n \n\n"), (6, "")])
    assert {r.doc_id: (r.info.n_lines, r.info.n_removed) for r in got} == {
        1: (4, 0), 2: (4, 4), 3: (3, 1), 4: (2, 2), 5: (0, 0), 6: (4, 4)}
    docs = make_docs(rows).withColumn("n_chars", F.length("text").cast("long"))
    kept = corpus_pipeline.line_dedup(docs.sparkSession, docs, "").collect()
    assert {r.doc_id for r in kept} == {1, 3, 5}


@pytest.mark.parametrize("size", [1, 2, 3, 4, 5, 100])
def test_heavy_buckets_lose_no_line_at_a_batch_edge(size):
    rng = random.Random(size)
    rows = sorted((key, line, 0, kind) for key in range(30) for line in range(rng.randint(1, 6)) for kind in range(rng.randint(1, 3)))
    batches = [pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows[at : at + size], strict=True), (pa.int64(), pa.int64(), pa.int32(), pa.int8()), strict=True)],
        ["key", "line", "counts", "kind"]) for at in range(0, len(rows), size)]
    out = [r for b in lines._buckets(2, 2)(iter(batches)) for r in b.to_pylist()]
    members = Counter(key for key, _ in {r[:2] for r in rows})
    heavy = sorted((r["key"], r["line"]) for r in out if r["heavy"])
    assert heavy == sorted({r[:2] for r in rows if members[r[0]] > 2})


@pytest.mark.parametrize("bucket", [5, 2])
def test_heavy_buckets_are_compared_at_every_threshold(make_docs, same_rows, monkeypatch, bucket):
    monkeypatch.setattr(lines, "BUCKET", bucket)
    rows = line_rows()
    got = lines.dedup_lines(make_docs(rows), 4).select("doc_id", "text").collect()
    same_rows(got, dedup_brute(rows, 4, lines.MIN_CHARS))


@pytest.mark.parametrize(("bucket", "batch"), [(4096, "10000"), (40, "7")])
def test_a_large_group_of_near_lines(spark, make_docs, same_rows, monkeypatch, bucket, batch):
    """Hundreds of lines near one another: each finds one earlier partner, and no pairs are made."""
    monkeypatch.setattr(lines, "BUCKET", bucket)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    rng = random.Random(13)
    base = "a line that many documents carry with a small change"
    rows = [(k, changed(rng, base, 2) + "\n" + "".join(rng.choice("abcdefgh ") for _ in range(40))) for k in range(300)]
    try:
        docs = make_docs(rows)
        same_rows(lines.dedup_lines(docs).select("doc_id", "text").collect(), dedup_brute(rows, lines.THRESHOLD, lines.MIN_CHARS))
        judged = lines.judged_lines(docs)
        first = judged.groupBy("line").agg(F.min(F.struct("doc_id", "twin", "line_no")).alias("first"))
        found = [r.line for r in lines.near_lines(docs, first).collect()]
        assert len(found) == len(set(found)) < judged.select("line").distinct().count()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_thresholds_beyond_the_edit_distance_are_refused(empty):
    with pytest.raises(ValueError):
        lines.dedup_lines(empty, 32)


def jaccard_brute(rows, size=5, percent=80):
    sets = []
    for _, text in rows:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets.append({tuple(w[j : j + size]) for j in range(max(1, len(w) - size + 1))} if w else set())
    head = list(range(len(rows)))

    def root(k):
        while head[k] != k:
            k = head[k]
        return k

    for k, x in enumerate(sets):
        for o in range(k):
            both = len(x & sets[o])
            same_id = rows[k][0] is not None and rows[k][0] == rows[o][0] and x and sets[o]
            if (x and sets[o] and 100 * both >= percent * (len(x) + len(sets[o]) - both)) or same_id:
                a, b = root(k), root(o)
                head[max(a, b)] = min(a, b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[root(k)] = min(least.get(root(k), i), i)
    return [(i, len(sets[k]), least.get(root(k))) for k, (i, _) in enumerate(rows)]


def near_rows(groups=6, seed=2):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(300)]
    shared = " ".join(rng.choice(words) for _ in range(40))
    rows, doc = [], 1000
    for _ in range(groups):
        base = [rng.choice(words) for _ in range(rng.randint(60, 140))]
        for _ in range(rng.randint(1, 30)):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                copy[rng.randrange(len(copy))] = f"new{rng.random()}"
            rows.append((doc, " ".join(copy) + (" " + shared if rng.random() < 0.3 else "")))
            doc += rng.randint(1, 5)
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("small,block", [(64, 1024), (2, 4)])
def test_jaccard_components(make_docs, odd_rows, same_rows, monkeypatch, small, block):
    monkeypatch.setattr(jaccard, "SMALL", small)
    monkeypatch.setattr(jaccard, "BLOCK_NODES", block)
    rows = near_rows() + odd_rows
    same_rows(jaccard.near_duplicates(make_docs(rows)).collect(), jaccard_brute(rows))


def test_common_tokens_are_not_held(make_docs, same_rows, monkeypatch):
    monkeypatch.setattr(jaccard, "RARE_LIMIT", 3)
    rows = near_rows(3, 5)
    same_rows(jaccard.near_duplicates(make_docs(rows)).collect(), jaccard_brute(rows))


def test_keep_one_of_each_group(make_docs):
    rows = near_rows(4, 8)
    docs = make_docs(rows)
    kept = jaccard.keep_one(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {c for _, _, c in jaccard_brute(rows)}


def test_keep_one_row_of_a_repeated_id(make_docs):
    rows = near_rows(2, 9)
    least = min(rows)
    other = "quite another text under the same id " * 3
    rows += [least, least, (least[0], other), (least[0], None), (5000, "one two"), (5000, "one two"), (5001, ""), (5001, " ")]
    rows += [(5002, ""), (5002, "three four"), (None, "five six"), (None, "five six")]
    docs = make_docs(rows)
    kept = jaccard.keep_one(docs)
    assert kept.columns == docs.columns
    times = Counter(r.doc_id for r in kept.collect())
    assert times.pop(None) == 2
    assert set(times.values()) == {1}
    assert set(times) == {c for _, _, c in jaccard_brute(rows) if c is not None} | {5001}
    texts = {r.doc_id: r.text for r in kept.collect()}
    assert texts[least[0]] in (least[1], other) and texts[5002] == "three four"
    assert kept.where("n != 'own n' or row != 'own row'").count() == 0


def test_jaccard_of_no_documents(empty):
    assert jaccard.near_duplicates(empty).collect() == []


def test_components(spark, same_rows):
    rng = random.Random(1)
    links = [(k, k + 1) for k in range(100, 160)] + [(7, 7), (None, 3), (5, None)]
    links += [(rng.randrange(1000, 1200), rng.randrange(1000, 1200)) for _ in range(90)] + [(2000, k) for k in range(2001, 2080)]
    got = components(spark.createDataFrame(links, "u long, v long")).collect()
    head = {}
    root = lambda k: k if head.setdefault(k, k) == k else root(head[k])
    for u, v in links:
        if u is not None and v is not None and u != v:
            a, b = root(u), root(v)
            head[max(a, b)] = min(a, b)
    same_rows(got, [(k, root(k)) for k in list(head)])


def test_components_of_no_links(spark):
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []


def test_pipeline_stages(spark, make_docs, tmp_path):
    rng = random.Random(6)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8))) for _ in range(500)]
    text = lambda: "\n".join(" ".join(rng.choice(words) for _ in range(30)) for _ in range(4))
    rows, marks = [], []
    for k in range(120):
        body = text()
        if k % 3 == 0:
            body = " ".join(w + "%%%" for w in body.split())
        rows.append((k, body))
        marks.append((k, int(k % 3 != 0)))
    copy = rows[1][1].split()
    rows += [(200, rows[1][1]), (201, " ".join([*copy[:60], "changed", *copy[61:]])), (202, "too short"), (203, None)]
    folder = str(tmp_path)
    make_docs(rows).withColumn("n_chars", F.length("text").cast("long")).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(marks, "doc_id long, quality int").write.parquet(f"{folder}/labels.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    good = corpus_pipeline.quality_rules(spark, docs, folder)
    assert {r.doc_id for r in good.collect()} == {k for k in range(120) if k % 3} | {200, 201}
    clean = corpus_pipeline.line_dedup(spark, good, folder)
    assert clean.columns == docs.columns
    assert {r.doc_id for r in clean.collect()} == {k for k in range(120) if k % 3} | {201}
    assert clean.where("n_chars != length(text)").count() == 0
    single = corpus_pipeline.jaccard_join(spark, clean, folder)
    assert {r.doc_id for r in single.collect()} == {k for k in range(120) if k % 3}
    out = corpus_pipeline.run(spark, folder).collect()
    assert {r.doc_id for r in out} == {k for k in range(120) if k % 3}
    assert Counter(r.doc_id for r in out)[1] == 1 and max(r.offset + r.length for r in out) <= 2048
