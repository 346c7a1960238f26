"""Toxicity of restored texts: a noisy channel undoes disguised spelling, then learned words score the text.

A token that may be disguised (symbols or digits for letters, marks between letters, letters repeated, letters set apart by
blanks) is a lattice: every run of one character offers the letters it may stand for, once or twice, or nothing, each
at the channel's cost. Viterbi search finds the cheapest path under a character trigram model of the whole corpus. A token without
such signs has one path only, itself. Words of the restored text, and their beginnings (so that other endings
are known too), are weighed by how surely toxic documents use them; the strongest words make the score.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .bpe import _type
from .workers import map_arrow

#: fixed values: letters that a symbol or digit may stand for
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "£": "l", "(": "c", "<": "c",
}
#: channel costs in nats
SWAP, DROP_MARK, DROP_SYMBOL, REPEAT, CUT = 1.0, 0.5, 4.0, 0.5, 1.0
#: letters a to z, another letter, and the edge of a word
OTHER, EDGE = 27, 0
CLASSES = 28
#: what may follow or precede a word without being part of it
AROUND = ".,;:?!\"'`´’‘“”«»…()[]{}<>#*%&~^=/\\-_|"
TRIPLE = re.compile(r"(.)\1\1", re.S)
SPACED = re.compile(r"(?<!\S)(?:\S[ \t]){3,}\S(?=[.,;:?!)]*(?!\S))")
PREFIXES = (5, 6, 7)
#: labelled rows that the classifier is fitted on, at most; features it keeps, at most
LABELLED, LEXICON = 40_000, 20_000
#: standard errors that a feature's log-odds are lowered by
SURE = 2.0
#: remembered tokens and counted features per task
KEPT = 300_000
TOP = (1.0, 0.5, 0.25)


def _class_table() -> np.ndarray:
    """Class of each code point below 0x250: base letters of the Latin alphabets, others, edges."""
    out = np.zeros(0x250, np.int64)
    for code in range(0x250):
        c = chr(code).lower()
        base = unicodedata.normalize("NFD", c)[0]
        if "a" <= base <= "z":
            out[code] = ord(base) - 96
        elif c.isalpha():
            out[code] = OTHER
    return out


CLASS = _class_table()


def class_of(letter: str) -> int:
    code = ord(letter)
    return int(CLASS[code]) if code < len(CLASS) else OTHER if letter.isalpha() else EDGE


def trigram_counts(texts: list[str]) -> np.ndarray:
    """Counts of class trigrams within words; before the first letter stand two edges, after the last one."""
    codes = np.frombuffer("\n\n".join(["", *texts, ""]).encode("utf-32-le", "surrogatepass"), "<u4")
    classes = np.full(len(codes), OTHER, np.int64)
    small = codes < len(CLASS)
    classes[small] = CLASS[codes[small]]
    a, b, c = classes[:-2].copy(), classes[1:-1], classes[2:]
    a[b == EDGE] = EDGE
    held = (b != EDGE) | (c != EDGE)
    return np.bincount(((a * CLASSES + b) * CLASSES + c)[held], minlength=CLASSES**3)


def letter_costs(counts: np.ndarray) -> np.ndarray:
    """Nats of each letter after two others: trigrams mixed with bigrams and letters."""
    tri = counts.reshape(CLASSES, CLASSES, CLASSES).astype(float)
    uni = tri.sum((0, 1)) + 1
    uni /= uni.sum()
    bi = tri.sum(0) + 5 * uni
    bi /= bi.sum(1, keepdims=True)
    tri = tri + 5 * bi[None]
    tri /= tri.sum(2, keepdims=True)
    return -np.log(tri)


def character_model(docs: DataFrame) -> np.ndarray:
    """Letter costs from the words of all texts; the counts collected are at most 28 ** 3 rows."""

    def count(batches: Iterator[pa.RecordBatch]):
        total = np.zeros(CLASSES**3, np.int64)
        for batch in batches:
            held, size = [], 0
            for text in batch.column(0).to_pylist():
                if text:
                    held.append(text)
                    size += len(text)
                if size > 1 << 20:
                    total += trigram_counts(held)
                    held, size = [], 0
            if held:
                total += trigram_counts(held)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at], pa.int64())], ["gram", "n"])

    rows = map_arrow(docs.select("text"), count, "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(CLASSES**3, np.int64)
    for r in rows:
        counts[r.gram] = r.n
    return letter_costs(counts)


class Channel:
    """Restores tokens under a character model."""

    def __init__(self, costs: np.ndarray):
        self.costs = costs.tolist()
        self.known: dict[tuple[str, bool], str] = {}

    def words(self, text: str) -> set[str]:
        """Distinct words of a text as they stand and as restored, in lower case."""
        out: set[str] = set()
        text = text.lower()
        for token in set(text.split()):
            if not token.isalpha():
                token = token.strip(AROUND)
            if not token:
                continue
            if token.isalpha():
                out.add(token)
                if TRIPLE.search(token):
                    out.add(self.restore(token))
            else:
                out.update(p for p in re.split(r"[\W\d_]+", token) if p)
                out.update(self.restore(token).split())
        for found in SPACED.findall(text):
            out.update(self.restore("".join(found.split()), True).split())
        return out

    def text(self, text: str) -> str:
        """The text with its disguised words restored, in lower case; all else stays."""
        text = SPACED.sub(lambda m: self.restore("".join(m[0].split()), True), text.lower())

        def one(m):
            token = m[0]
            core = token if token.isalpha() else token.strip(AROUND)
            if not core or core.isalpha() and not TRIPLE.search(core):
                return token
            return token.replace(core, self.restore(core), 1)

        return re.sub(r"\S+", one, text)

    def restore(self, token: str, spaced: bool = False) -> str:
        """The likeliest word (or words, if its letters were set apart) behind a token in lower case."""
        out = self.known.get((token, spaced))
        if out is None:
            out = self._viterbi(token, spaced) if any(class_of(c) for c in token) else token
            if len(token) <= 64:
                if len(self.known) >= KEPT:
                    self.known.clear()
                self.known[token, spaced] = out
        return out

    def _viterbi(self, token: str, spaced: bool) -> str:
        costs = self.costs
        # state: the last two classes; value: cost and the path as nested pairs
        states: dict[tuple[int, int], tuple[float, tuple | None]] = {(EDGE, EDGE): (0.0, None)}
        for symbol, run in groupby(token):
            options = self._options(symbol, sum(1 for _ in run))
            after: dict[tuple[int, int], tuple[float, tuple | None]] = {}
            for (a, b), (so_far, path) in states.items():
                ways = [(so_far, a, b, path)]
                if spaced and b != EDGE:
                    ways.append((so_far + CUT + costs[a][b][EDGE], EDGE, EDGE, (path, " ")))
                for cost, a1, b1, path1 in ways:
                    for letters, price in options:
                        total, x, y = cost + price, a1, b1
                        for c in letters:
                            k = class_of(c)
                            total += costs[x][y][k]
                            x, y = (EDGE, EDGE) if k == EDGE else (y, k)
                        old = after.get((x, y))
                        if old is None or total < old[0]:
                            after[x, y] = total, (path1, letters) if letters else path1
            states = after
        best, path = min(((c + costs[a][b][EDGE], p) for (a, b), (c, p) in states.items()), key=lambda s: s[0])
        parts = []
        while path is not None:
            path, letters = path
            parts.append(letters)
        return "".join(reversed(parts)).strip()

    @staticmethod
    def _options(symbol: str, count: int) -> list[tuple[str, float]]:
        """What a run of one character may stand for, and the cost."""
        if class_of(symbol):
            if count == 1:
                return [(symbol, 0.0)]
            return [(symbol, REPEAT), (symbol * 2, 0.0 if count == 2 else REPEAT)]
        if symbol in LEET:
            out = [("", DROP_SYMBOL)]
            for c in LEET[symbol]:
                out.append((c, SWAP))
                if count > 1:
                    out.append((c * 2, SWAP if count == 2 else SWAP + REPEAT))
            return out
        if symbol.isalpha() or symbol.isdigit():
            return [(symbol * min(count, 2), 0.0)]
        return [("", DROP_MARK)]


def features(words: set[str]) -> dict[str, list[str]]:
    """Each word with its features: itself and its beginnings."""
    return {w: [w, *("^" + w[:k] for k in PREFIXES if len(w) >= k)] for w in words}


def evidence(words: set[str], weights: dict[str, float]) -> float:
    """Weighted sum of the three strongest words, each counted by its strongest feature, each feature once."""
    best: dict[str, float] = {}
    get = weights.get
    for w in words:
        top, name = get(w, 0.0), w
        for k in PREFIXES:
            if len(w) >= k:
                found = get("^" + w[:k], 0.0)
                if found > top:
                    top, name = found, "^" + w[:k]
        if top > 0:
            best[name] = top
    return sum(a * b for a, b in zip(TOP, sorted(best.values(), reverse=True), strict=False))


def fit(histogram: list[tuple[float, int, int]]) -> tuple[float, float]:
    """Bias and slope of a logistic curve through (evidence, toxic, clean) counts, with a weak ridge."""
    toxic, clean = sum(h[1] for h in histogram), sum(h[2] for h in histogram)
    beta = np.array([math.log((toxic + 0.5) / (clean + 1.5)), 1.0])
    if not histogram:
        return float(beta[0]), float(beta[1])
    x = np.array([[1.0, h[0]] for h in histogram])
    n, y = np.array([h[1] + h[2] for h in histogram], float), np.array([h[1] for h in histogram], float)
    ridge, center = np.diag([0.01, 0.1]), np.array([0.0, 1.0])

    def loss(b):
        z = x @ b
        return float(np.sum(n * np.logaddexp(0, z) - y * z) + (b - center) @ ridge @ (b - center) / 2)

    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (y - n * p) - ridge @ (beta - center)
        step = np.linalg.solve((x * (n * p * (1 - p))[:, None]).T @ x + ridge, slope)
        while loss(beta + step) > loss(beta) + 1e-12 and np.abs(step).max() > 1e-9:
            step = step / 2
        beta = beta + step
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0]), max(0.0, float(beta[1]))


def fold_of(doc_id):
    return F.crc32(doc_id.cast("string").cast("binary")) % 5


class Model:
    """Letter costs, feature weights and the logistic curve; its size does not grow with the data."""

    def __init__(self, costs: np.ndarray, weights: dict[str, float], bias: float, slope: float):
        self.costs, self.weights, self.bias, self.slope = costs, weights, bias, slope


def learn(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED) -> Model:
    """A model from all texts (letters) and from labelled rows outside the held-out fifth (words).

    At most ``labelled`` rows serve, those whose ids have the smallest hashes. Words are weighed on three of their four folds,
    the curve is drawn on the fourth, so that it knows how far the weights hold on texts not seen. Of labelled rows whose words
    have the same smallest hash, copies mostly, one serves: the words of a text copied a thousand times say no more than those of one.
    Null labels and ids are left out; of several labels of a document the highest counts.
    """
    costs = character_model(docs)
    marks = labels.where("toxic is not null and doc_id is not null").groupBy(F.col("doc_id").alias("id")).agg(
        (F.max("toxic") > 0).cast("int").alias("toxic")).withColumn("fold", fold_of(F.col("id"))).where("fold <> 0")
    # bounded: two numbers for each of the labelled rows
    marks = marks.orderBy(F.xxhash64("id"), "id").limit(labelled)
    texts = docs.select("doc_id", "text")
    words = F.split(F.lower(F.coalesce("text", F.lit(""))), r"\s+")
    least = F.array_min(F.transform(words, lambda w: F.xxhash64(w))).alias("least")
    seen = texts.join(F.broadcast(marks), F.col("doc_id") == F.col("id")).select("id", "toxic", "fold", least)
    marks = stage(seen.groupBy("least").agg(F.min(F.struct("id", "toxic", "fold")).alias("one")).select("one.*"))
    known = texts.join(F.broadcast(marks), F.col("doc_id") == F.col("id")).select("text", "toxic", "fold")

    def count(batches: Iterator[pa.RecordBatch]):
        channel, found = Channel(costs), {}
        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                seen = {f for fs in features(channel.words(text or "")).values() for f in fs}
                seen.add("")  # counts the documents
                for f in seen:
                    pair = found.get(f)
                    if pair is None:
                        pair = found[f] = [0, 0]
                    pair[toxic] += 1
                if len(found) > KEPT:
                    yield counted(found)
                    found = {}
        yield counted(found)

    def counted(found):
        return pa.RecordBatch.from_arrays(
            [pa.array(found, pa.string()), pa.array([v[1] for v in found.values()], pa.int64()),
             pa.array([v[0] for v in found.values()], pa.int64())], ["feature", "toxic", "clean"])

    counts = map_arrow(known.where("fold <> 1").select("text", "toxic"), count, "feature string, toxic long, clean long").groupBy(
        "feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    counts = counts.where("toxic >= 2 or feature = ''")
    every = F.broadcast(counts.where("feature = ''").select(F.col("toxic").alias("all_toxic"), F.col("clean").alias("all_clean")))
    t, c = F.col("toxic") + 0.5, F.col("clean") + 0.5
    odds = F.log(t / c) - F.log((F.col("all_toxic") + 0.5) / (F.col("all_clean") + 0.5))
    # one row beside each count
    chosen = counts.where("feature <> ''").join(every, F.lit(True)).select("feature", (odds - SURE * F.sqrt(1 / t + 1 / c)).alias("w"))
    weights = {r.feature: r.w for r in chosen.where("w > 0").orderBy(F.desc("w"), "feature").limit(LEXICON).collect()}

    def measure(batches: Iterator[pa.RecordBatch]):
        channel = Channel(costs)
        for batch in batches:
            found = [evidence(channel.words(x or ""), weights) for x in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.float64()), batch.column(1)], ["z", "toxic"])

    drawn = map_arrow(known.where("fold = 1").select("text", "toxic"), measure, "z double, toxic int").groupBy(
        F.round("z", 1).alias("z")).agg(F.sum("toxic").alias("toxic"), F.sum(1 - F.col("toxic")).alias("clean"))
    return Model(costs, weights, *fit([(r.z, r.toxic, r.clean) for r in drawn.orderBy("z").collect()]))


def restored(docs: DataFrame, costs: np.ndarray) -> DataFrame:
    """``doc_id`` and the restored ``text`` of every row; a null text stays null."""

    def run(batches: Iterator[pa.RecordBatch]):
        channel = Channel(costs)
        for batch in batches:
            texts = [x if x is None else channel.text(x) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return map_arrow(docs.select("doc_id", "text"), run, f"doc_id {_type(docs)}, text string")


def score(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED) -> DataFrame:
    """Toxicity of every row's whole text: ``doc_id``, ``held_out``, ``score`` (0 to 1), ``predicted``, ``evidence``.

    A null, empty or wordless text has no evidence and the score that such texts earn. Without labels that score is 0.25 (a
    cautious prior) and no evidence is known. Equal texts score alike, repeated rows and null ids pass through one by one
    (a null id is not held out), other columns play no part, no rows give no rows.
    """
    model = learn(docs, labels, labelled)
    costs, weights, bias, slope = model.costs, model.weights, model.bias, model.slope

    def run(batches: Iterator[pa.RecordBatch]):
        channel = Channel(costs)
        for batch in batches:
            z = np.array([evidence(channel.words(x or ""), weights) for x in batch.column(1).to_pylist()])
            p = 1 / (1 + np.exp(-np.clip(bias + slope * z, -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p, pa.float64()), pa.array(z, pa.float64())], ["doc_id", "score", "evidence"])

    found = map_arrow(docs.select("doc_id", "text"), run, f"doc_id {_type(docs)}, score double, evidence double")
    return found.select(
        "doc_id", F.coalesce(fold_of(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), "evidence")
