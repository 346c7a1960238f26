"""Registered queries of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import stage, staging_path
from . import bpe, counts, fingerprints, jaccard, lines, lm, manifest, packing, periodic, quality, shards, token_files, toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


@query("op1_ngram_jaccard_join", r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
g AS MATERIALIZED (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS s FROM w),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM g GROUP BY 1),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM g a JOIN g b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS MATERIALIZED (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 80 * (a.n + b.n - c)),
e AS MATERIALIZED (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r AS (SELECT x AS a, x AS b FROM e UNION SELECT r.a, e.y FROM r JOIN e ON r.b = e.x),
c AS (SELECT a, min(b) AS m FROM r GROUP BY 1)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(c.m, d.doc_id) AS component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN c ON c.a = d.doc_id""")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(read(spark, sf_dir, "documents"))


@query("op2_bpe_round_trip")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(read(spark, sf_dir, "documents"), BYTE_BPE).select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"))


@query("op3_token_files")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = staging_path(spark)
    token_files.write_tokens(read(spark, sf_dir, "documents"), WORD_BPE, 1, folder)
    return token_files.read_tokens(spark, folder).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query("op4_lm_scoring")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(read(spark, sf_dir, "documents"))


@query("op5_document_fingerprints")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Besides the contract: how many other documents lie within 3 bits of every hundredth one."""
    found = fingerprints.edited_fingerprints(read(spark, sf_dir, "documents"))
    found = stage(found.withColumn("edited_sha256", F.sha2("edited", 256)).drop("edited"))
    asked = found.where(F.col("doc_id") % 100 == 0).select(F.col("fingerprint").alias("query"))
    copies = found.groupBy("fingerprint").agg(F.count("*").alias("copies"))
    near = (
        fingerprints.within_radius(asked, found).join(copies, "fingerprint")
        .groupBy("query").agg(F.sum("copies").alias("n"))
    )
    own = F.col("fingerprint")
    return found.join(near, (own == F.col("query")) & (F.col("doc_id") % 100 == 0), "left").select(
        "doc_id", "n_chars", "edited_sha256", _hex(own).alias("fingerprint"),
        _hex(F.col("edited_fingerprint")).alias("edited_fingerprint"),
        fingerprints.likeness(own, F.col("edited_fingerprint")).alias("near_edited"),
        fingerprints.likeness(own, F.col("next_fingerprint")).alias("near_next"),
        (F.col("n") - 1).alias("others_within_3_bits"))


def _hex(value):
    return F.lower(F.lpad(F.hex(value), 16, "0"))


@query("op6_best_fit_packing")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = packing.pieces(read(spark, sf_dir, "documents"), BYTE_BPE, 0)
    parts = stage(parts.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))
    return packing.best_fit(parts, ["doc_id", "piece"])


@query("op7_token_counts")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.count_tokens(read(spark, sf_dir, "documents"), BYTE_BPE).select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 512).alias("over_limit"))


@query("op10_quality_rules")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    verdicts, _ = quality.quality_verdicts(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return verdicts


@query("op8_line_dedup")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents with repeated lines taken out, and how many lines that were."""
    cleaned = lines.dedup_lines(read(spark, sf_dir, "documents"), info="info", exact_chars=1)
    return cleaned.select("doc_id", "info.n_lines", "info.n_removed", "text")


@query("op9_sharding")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.shard_by_bytes(read(spark, sf_dir, "documents"), 24).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


@query("op13_periodic_runs")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every tenth text is first made periodic from some word on, as the contract of this query says."""
    docs = read(spark, sf_dir, "documents")
    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))
    h = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(1))
    asked = docs.select("doc_id", "text", h.alias("h"), F.when(h % 10 == 0, words).alias("w"))
    n, g = F.nullif(F.size("w").cast("long"), F.lit(0)), F.floor(F.col("h") / 10)
    asked = asked.withColumn("a", g % n).withColumn("p", 1 + F.floor((n - F.col("a")) / (3 + g % 8)))
    place = F.transform(
        F.sequence(F.lit(0).cast("long"), n - 1),
        lambda i: F.get("w", F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p")).cast("int")))
    asked = asked.select("doc_id", F.when(n > 0, F.array_join(place, " ")).otherwise(F.col("text")).alias("text"))
    found = periodic.collapse_runs(asked)
    best = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"), (-F.col("best.period")).alias("period"),
        F.floor(1000 * F.col("best.length") / -F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


@query("op12_merkle_manifest")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every second document the proof is tried with a text that has lost its line ends."""
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    tampered = F.when(even, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    found, _ = manifest.build_manifest(read(spark, sf_dir, "documents"), tampered)
    found = found.withColumn("folded_root", manifest.folded(F.col("other"), F.col("proof")))
    return found.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(manifest.proof_text(F.col("proof")), 256).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"))


@query("op11_toxicity")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = toxicity.score(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels").select("doc_id", "toxic"))
    return found.select("doc_id", "held_out", "score", "predicted")
