import random

import pytest

#: names that the operators use for their own columns
CLASHES = "node token key part words line lines block length size shard slot n q bad gone row held ids range cell".split()


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents with further columns whose names clash with those used inside."""

    def make(rows):
        shape = "doc_id long, text string, " + ", ".join(f"{c} string" for c in CLASHES)
        return spark.createDataFrame([(i, t, *(f"own {c}" for c in CLASHES)) for i, t in rows], shape)

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Null, empty, wordless, tiny, very long, copied and near-copied texts; a null id, a repeated row."""
    rng = random.Random(7)
    words = ["".join(rng.choice("abcdefgéß") for _ in range(rng.randint(1, 9))) for _ in range(400)]
    line = lambda n: " ".join(rng.choice(words) for _ in range(n))
    text = lambda lines, n: "\n".join(line(n).capitalize() for _ in range(lines))
    rows = [(1, None), (2, ""), (3, " \t\n\x0b "), (4, "One"), (5, "ONE"), (6, "a b c"), (7, "A b\tC"), (8, "\n\n")]
    base = text(6, 30)
    rows += [(10, base), (11, base), (12, base + " tail"), (13, base.replace(" ", "  ")), (14, base.upper())]
    rows += [(20 + k, text(rng.randint(1, 8), rng.randint(5, 60))) for k in range(40)]
    rows += [(70, "x" * 70_000), (71, line(30_000)), (72, ("same words again " * 3000).strip()), (73, "日本語 " * 500)]
    rows += [(80, "<|endoftext|> a <|endoftext|>b  <|startoftext|>"), (81, "it's we'll 12345 ½ !!! don't"), (82, "\U0001f600 é á")]
    # a Thue-Morse word and its complement: polynomial sums modulo 2 ** 64 take them as equal
    thue = "".join("az"[bin(k).count("1") & 1] for k in range(2048))
    rows += [(83, thue), (84, thue.translate({97: 122, 122: 97})), (85, f"one {thue} two"), (86, f"one {thue.translate({97: 122, 122: 97})} two")]
    # a text without an id is near two that are not near each other
    chain = [w + str(k) for k, w in enumerate(line(400).split())]
    links = [" ".join([*chain[:k], "new", *chain[k + 1 :]]) for k in (0,)]
    rows += [(60, " ".join(chain)), (None, " ".join(chain[20:])), (61, " ".join(chain[40:] + ["end"] * 1)), (62, links[0])]
    rows += [(63, " ".join(chain[75:]))]
    rows += [(90, base), (90, base), (None, base), (None, "a text without an id " + line(30))]
    return rows


@pytest.fixture(scope="session")
def odd(make_docs, odd_rows):
    return make_docs(odd_rows)


@pytest.fixture(scope="session")
def empty(make_docs):
    return make_docs([])


def key(row):
    return tuple((x is not None, x) for x in row)


@pytest.fixture
def same_rows():
    def check(got, want):
        assert sorted(map(key, map(tuple, got))) == sorted(map(key, want))

    return check
