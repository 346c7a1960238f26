"""The Merkle manifest against a tree built level by level in a list."""

import hashlib
import itertools
import random
import zlib

import numpy as np
import pytest

from cataloom.llm import manifest, queries

SHAPE = "doc_id long, text string, lang string, source string, n_chars long, leaf string, node string, row string, place string, part string"


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def tree(leaves):
    """All levels, and the siblings of every leaf."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([h("".join(last[k : k + 3])) for k in range(0, len(last), 3)])
    paths = []
    for place in range(len(leaves)):
        path = []
        for level in levels[:-1]:
            run = place - place % 3
            path.append((level[run:place], level[place + 1 : run + 3]))
            place //= 3
        paths.append(path)
    return levels[-1][0], paths


def leaf_of(row):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row[0], row[3], row[2], row[4], row[1])))


def expected(rows):
    def key(v):
        return (v is not None, v.encode() if isinstance(v, str) else v)

    groups = {s: sorted((r for r in rows if r[3] == s), key=lambda r: (key(r[0]), leaf_of(r))) for s in {r[3] for r in rows}}
    names = sorted(groups, key=key)
    trees = {s: tree([leaf_of(r) for r in groups[s]]) for s in names}
    if not names:
        return []
    root, tops = tree([trees[s][0] for s in names])
    out = []
    for s, top in zip(names, tops):
        for r, path in zip(groups[s], trees[s][1]):
            path = path + top
            node, text = r, r[1]
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and text is not None:
                text = text.replace("\n", "")
            node = leaf_of((r[0], text, *r[2:]))
            for left, right in path:
                node = h("".join([*left, node, *right]))
            proof = h("".join(x for left, right in path for x in (*left, *right)))
            out.append((r[0], leaf_of(r), trees[s][0], root, proof, node, node == root))
    return out


def make(rng, n, sources, first=0):
    return [(first + i, rng.choice([None, "", "a\nb", "x\n" * rng.randint(0, 4) + str(i), "é" * (i % 7)]), rng.choice([None, "en", "de"]),
             rng.choice(sources), rng.choice([None, i])) for i in range(n)]


def cases():
    rng = random.Random(4)
    yield []
    yield make(rng, 1, [None])
    yield make(rng, 1, ["a"])
    for n in (2, 3, 4, 9, 10, 27, 28):
        yield make(rng, n, ["a"], 7)
    yield make(rng, 300, [None, "", "é", "z", "Z", "\U0001f600", "￮", "a" * 300, "hot", "hot", "hot", "hot"])
    yield make(rng, 80, [f"s{k}" for k in range(60)])
    odd = make(rng, 40, ["a", None])
    yield odd + odd[:3] + [(None, "t", None, "a", 1), (None, "t", None, "a", 1), (None, None, None, None, None), (3, "another", "en", "a", 2)]


@pytest.mark.parametrize(("height", "chosen"), [(1, (9, 10)), (2, (0, 2, 9, 12)), (6, (1, 10, 11))])
def test_registered_query(spark, tmp_path, same_rows, monkeypatch, height, chosen):
    monkeypatch.setattr(manifest, "HEIGHT", height)
    for k, rows in enumerate(cases()):
        if k not in chosen:
            continue
        folder = f"{tmp_path}/{k}"
        spark.createDataFrame([(*r, *["own"] * 5) for r in rows], SHAPE).repartition(3).write.parquet(f"{folder}/documents.parquet")
        got = queries.op12(spark, folder)
        assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
        same_rows(got.collect(), expected(rows))


def test_several_layers(spark, tmp_path, same_rows, monkeypatch):
    monkeypatch.setattr(manifest, "HEIGHT", 2)
    rows = make(random.Random(9), 900, ["one", "one", "one", "two", None])
    spark.createDataFrame([(*r, *["own"] * 5) for r in rows], SHAPE).repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    found, layers = manifest.build_manifest(docs)
    assert len(layers) == 4  # 81 and 729 leaves lie below two and three layers; the groups make one
    assert {(r.doc_id, r.leaf) for r in found.collect()} == {(r[0], leaf_of(r)) for r in rows}
    same_rows(queries.op12(spark, str(tmp_path)).collect(), expected(rows))


def test_layout_is_van_emde_boas():
    # four levels: the top two, then nine trees of two levels each
    places = manifest.layout(3, 27)
    assert places[0].tolist() == [0] and places[1].tolist() == [1, 2, 3]
    assert places[2].tolist() == [4 + 4 * k for k in range(9)]
    assert places[3].tolist() == [4 + 4 * (k // 3) + 1 + k % 3 for k in range(27)]
    for height, leaves in itertools.product(range(7), (1, 2, 3, 5, 27, 100, 729)):
        if leaves <= 3**height:
            every = np.concatenate(manifest.layout(height, leaves))
            assert sorted(every.tolist()) == list(range(len(every)))


def test_block_siblings():
    rng = random.Random(2)
    for n in (1, 2, 4, 9, 20, 27):
        leaves = [h(str(rng.random())) for _ in range(n)]
        height = manifest.height_of(n)
        nodes = manifest.build(leaves, height)
        root, paths = tree(leaves)
        assert nodes[0] == root
        for k in range(n):
            assert manifest.siblings(nodes, height, n, k) == [("".join(a), "".join(b)) for a, b in paths[k]]
