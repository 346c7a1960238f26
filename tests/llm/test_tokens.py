"""BPE transducer, token counts, token files and packing against the libraries."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from cataloom.llm import bpe, counts, library, packing, token_files, units

BYTE = public_tokenizers.path("byte_bpe_50k.json")
WORD = public_tokenizers.path("word_bpe_49k.json")


def library_ids(path, texts):
    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return [x.ids for x in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def packed(ids):
    return np.array(ids, "<u4").tobytes()


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(BYTE)


PIECES = ["a", "b", " ", "  ", "\n", "\t", ".", "'s", "'", "<|endoftext|>", "é", "日本", "1", "23", "́", "\x1c", "\x85",
          "!!", "the", "ing", "-" * 70, "aaaa", "A", "ß", "\U0001f600", "_", "=====", "\x00", "\xa0", "　"]


def random_texts(n, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 14))) for _ in range(n)]


def test_encoder_agrees_with_the_library(encoder):
    texts = random_texts(3000)
    together = encoder.encode_all(pa.array(texts))
    for text, ids, found in zip(texts, library_ids(BYTE, texts), together, strict=True):
        assert encoder.encode(text) == found == packed(ids), text


def test_decoder_gives_the_text_back(encoder):
    decoder = bpe.Decoder(encoder.merges)
    for text in random_texts(500, 2):
        assert decoder.decode(np.frombuffer(encoder.encode(text), "<u4")) == text


def test_decoder_replaces_a_cut_character(encoder):
    ids = np.frombuffer(encoder.encode("a\U0001f600"), "<u4")
    want = Tokenizer.from_file(BYTE).decode(ids[:-1].tolist(), skip_special_tokens=False)
    assert bpe.Decoder(encoder.merges).decode(ids[:-1]) == want


def test_long_runs_are_emitted_early_and_right(encoder):
    rng = random.Random(5)
    runs = ["".join(rng.choice("abcdefghinrst") for _ in range(n)) for n in (500, 3000)]
    runs += [unit * 2000 for unit in ("a", "the", "ab", "-", "=")]
    for run, ids in zip(runs, library_ids(BYTE, runs), strict=True):
        t, out, waiting = bpe.Transducer(encoder.merges), [], 0
        for at in range(0, len(run), 37):
            out += t.feed(run[at : at + 37].encode())
            waiting = max(waiting, len(t.pending))
        assert out + t.finish() == ids
        assert waiting <= 5 * encoder.merges.lookahead  # what is kept does not grow with the run


def test_pairs_fit_as_the_merge_list_says(encoder):
    m, rng = encoder.merges, random.Random(3)
    ids = [i for i in m.ids.values() if len(m.bytes_of[i]) <= 4]
    for _ in range(20_000):
        a, b = rng.choice(ids), rng.choice(ids)
        x, y = m.bytes_of[a], m.bytes_of[b]
        assert m.fits(a, b) == (m.merge(x + y) == [x, y])


def test_small_memories_give_the_same_ids(monkeypatch):
    monkeypatch.setattr(units, "UNITS_KEPT", 5)
    monkeypatch.setattr(units, "CHUNK", 30)
    monkeypatch.setattr(bpe, "STATES_KEPT", 9)
    monkeypatch.setattr(bpe, "PAIRS_KEPT", 3)
    monkeypatch.setattr(bpe, "SLICE", 7)
    small, texts = bpe.Encoder(BYTE), random_texts(300, 4)
    want = [packed(x) for x in library_ids(BYTE, texts)]
    assert [small.encode(t) for t in texts] == want
    assert small.encode_all(pa.array(texts)) == want


def test_round_trip_of_odd_documents(odd, odd_rows, same_rows):
    want = [(i, packed(x), t or "") for (i, t), x in zip(odd_rows, library_ids(BYTE, [t for _, t in odd_rows]), strict=True)]
    got = [(r.doc_id, bytes(r.ids), r.text) for r in bpe.round_trip(odd, BYTE).collect()]
    same_rows(got, want)
    back = [(r.doc_id, r.text) for r in bpe.decode(bpe.encode(odd, BYTE), BYTE).collect()]
    same_rows(back, [(i, t) for i, _, t in want])


def test_counts_of_odd_documents(odd, odd_rows, same_rows):
    ids = library_ids(BYTE, [t for _, t in odd_rows])
    want = [(i, len((t or "").encode()), len(x)) for (i, t), x in zip(odd_rows, ids, strict=True)]
    same_rows(counts.count_tokens(odd, BYTE).collect(), want)


def test_whole_tokens_encode_alone():
    proved = sorted(counts.whole_tokens(BYTE))
    assert len(proved) > 40_000
    some = random.Random(2).sample(proved, 2000)
    assert all(len(x) == 1 for x in library_ids(BYTE, some))


def test_library_encoder_by_units_equals_whole_texts():
    for path in (BYTE, WORD):
        e, texts = library.LibraryEncoder(path), random_texts(2000, 6)
        want = [packed(x) for x in library_ids(path, texts)]
        assert e.cut
        assert e.encode_all(pa.array([*texts, None])) == [*want, b""]
        assert [e.encode(x) for x in texts] == want
        assert e.encode_all(pa.array([], pa.string())) == e.encode_all(pa.array([None], pa.string()))[1:] == []


@pytest.mark.parametrize("size", [2, 3, 256, 257, 49_408, 50_257, 70_000, 1 << 20])
def test_bit_packing(size):
    width = token_files.bits_for(size)
    ids = np.random.default_rng(1).integers(0, size, 1001).astype("<u4")
    ids[:2] = 0, size - 1
    payload = token_files.pack(ids, width)
    assert len(payload) == (len(ids) * width + 7) // 8
    assert (token_files.unpack(payload, width, len(ids)) == ids).all()
    for first, n in ((0, 1), (7, 13), (500, 501), (1000, 1), (3, 0)):
        assert (token_files.unpack(payload, width, n, first) == ids[first : first + n]).all()


@pytest.mark.parametrize("width", [16, 19])
def test_token_files(spark, odd, odd_rows, tmp_path, monkeypatch, width):
    monkeypatch.setattr(token_files, "bits_for", lambda size: width)
    folder = str(tmp_path / "tokens")
    token_files.write_tokens(odd, WORD, 1, folder, block_ids=300)
    got = sorted(token_files.read_tokens(spark, folder).collect(), key=lambda r: r.start)
    ids = library_ids(WORD, [t for _, t in odd_rows])
    want = Counter((i, packed([*x, 1])) for (i, _), x in zip(odd_rows, ids, strict=True))
    assert Counter((r.doc_id, bytes(r.ids)) for r in got) == want
    order = [r.doc_id for r in got]
    nulls = sum(i is None for i, _ in odd_rows)
    assert order[:nulls] == [None] * nulls and order[nulls:] == sorted(order[nulls:])
    at = 0
    for r in got:
        assert (r.start, r.n_tokens) == (at, len(r.ids) // 4)
        at += r.n_tokens
    stream = np.concatenate([np.frombuffer(bytes(r.ids), "<u4") for r in got])
    for first, n in ((0, 5), (290, 700), (at - 3, 3)):
        assert (token_files.read_span(spark, folder, first, n) == stream[first : first + n]).all()


def test_blocks_of_many_tiny_documents(spark, make_docs, tmp_path):
    folder = str(tmp_path / "tokens")
    docs = spark.range(66_000).selectExpr("id as doc_id", "cast(null as string) as text").coalesce(1)
    token_files.write_tokens(docs, WORD, 1, folder)
    got = token_files.read_tokens(spark, folder).selectExpr("count(*) n", "sum(n_tokens) t", "max(start) s", "sum(abs(start - doc_id)) d").first()
    assert tuple(got) == (66_000, 66_000, 65_999, 0)


def test_token_files_of_no_documents(spark, empty, tmp_path):
    folder = str(tmp_path / "none")
    token_files.write_tokens(empty, WORD, 1, folder)
    assert token_files.read_tokens(spark, folder).collect() == []


def check_packing(rows, capacity):
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append(r)
    for found in by.values():
        at = 0
        for r in sorted(found, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
    return len(by)


def test_packing_of_odd_documents(odd, odd_rows):
    rows = packing.best_fit(packing.pieces(odd, BYTE, 0, 256).cache(), ["doc_id", "piece"], 256).collect()
    ids = library_ids(BYTE, [t for _, t in odd_rows])
    want = Counter()
    for (i, _), x in zip(odd_rows, ids, strict=True):
        x = [*x, 0]
        for piece, (start, n) in enumerate(packing.cut(len(x), 256)):
            assert piece == 0 or n == 256
            want[i, piece, start, n, zlib.crc32(packed(x[start : start + n]))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, zlib.crc32(bytes(r.ids))) for r in rows) == want
    assert check_packing(rows, 256) <= 1.05 * sum(r.length for r in rows) / 256 + 2


def test_packing_of_no_documents(empty):
    assert packing.best_fit(packing.pieces(empty, BYTE, 0), ["doc_id", "piece"]).collect() == []


def test_plan_places_every_rank_once():
    rng = random.Random(9)
    for capacity in (1, 7, 60, 300):
        counts_ = Counter(rng.randint(1, capacity) for _ in range(rng.randint(0, 900)))
        ranks, bins = defaultdict(list), defaultdict(list)
        for size, lo, hi, first, offset in packing.plan(dict(counts_), capacity):
            for k in range(lo, hi):
                ranks[size].append(k)
                bins[first + k - lo].append((offset, size))
        assert all(sorted(ranks[s]) == list(range(c)) for s, c in counts_.items())
        for found in bins.values():
            at = 0
            for offset, size in sorted(found):
                assert offset == at
                at += size
            assert at <= capacity
            assert sum(3 * s > capacity for _, s in found) <= 2


def test_plan_rejects_impossible_lengths():
    with pytest.raises(ValueError):
        packing.plan({9: 1}, 8)
