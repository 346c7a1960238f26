"""JSON payloads as typed rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.relate import SLICE, running_total
from ..session import stage


def _usable(status: Column) -> Column:
    return F.coalesce(status, F.lit(0)) <= 1


def read_payloads(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Landed JSON lines with a fixed schema; error answers, unreadable lines and those without id are dropped."""
    rows = spark.read.schema(schema).json(path)
    rows = rows.filter(_usable(F.col("status_code")))
    return rows.filter(F.col("id").isNotNull()) if "id" in rows.columns else rows


def parse_payloads(df: DataFrame, column: str, schema: str, out: str = "payload") -> DataFrame:
    """Parse a JSON text column; unreadable texts, error answers and payloads without id are dropped.

    An unreadable text parses to nulls.  A schema without ``id`` keeps a marker of the parser instead.
    """
    names = df.select(F.from_json(F.lit("{}"), schema).alias("x")).schema["x"].dataType.fieldNames()
    if "id" in names:
        parsed = df.withColumn(out, F.from_json(F.col(column), schema)).filter(F.col(out)["id"].isNotNull())
    else:
        marked = F.from_json(F.col(column), f"{schema}, _bad string", {"columnNameOfCorruptRecord": "_bad"})
        parsed = df.withColumn(out, marked).filter(F.col(out).isNotNull() & F.col(out)["_bad"].isNull())
        parsed = parsed.withColumn(out, F.col(out).dropFields("_bad"))
    if "status_code" in names:
        parsed = parsed.filter(_usable(F.col(out)["status_code"]))
    return parsed.drop(column)


def explode_pages(df: DataFrame, parent: str, page: str, items: str, width: int = SLICE) -> DataFrame:
    """Items of a list spread over pages, numbered from 1 across the pages."""
    # only the sizes go through the running total
    sizes = df.select(parent, page, F.coalesce(F.size(items), F.lit(0)).alias("_n"))
    before = running_total(sizes, [parent], page, F.col("_n"), "_before", width).drop("_n")
    rows = df.join(before, [parent, page]).select(parent, page, "_before", F.posexplode(items).alias("_pos", "item"))
    order = (F.col("_before") + F.col("_pos") + 1).cast("int")
    return rows.select(parent, page, order.alias("DISPLAY_ORDER"), "item")


#: why a payload is refused
REASONS = ("missing", "unreadable", "error answer", "without id")


def sort_payloads(
    df: DataFrame, column: str, schema: str, out: str = "payload",
) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """Readable payloads, refused ones with their ``reason``, and the counts ``rows``, ``read`` and one per reason.

    The texts are parsed once, on the way to a staged table, and the counts are observed in that same pass.  The readable
    rows are those of ``parse_payloads``; the refused ones keep their text, so that they can be looked at and landed again.
    """
    names = df.select(F.from_json(F.lit("{}"), schema).alias("x")).schema["x"].dataType.fieldNames()
    parsed = df.withColumn(out, F.from_json(F.col(column), f"{schema}, _bad string", {"columnNameOfCorruptRecord": "_bad"}))
    item, bad = F.col(out), F.col(out)["_bad"].isNotNull() | F.col(out).isNull()
    if "id" in names:
        bad = bad & item["id"].isNull()
    reason = F.when(F.col(column).isNull(), REASONS[0]).when(bad, REASONS[1])
    if "status_code" in names:
        reason = reason.when(~_usable(item["status_code"]), REASONS[2])
    if "id" in names:
        reason = reason.when(item["id"].isNull(), REASONS[3])
    parsed = parsed.withColumn("reason", reason).withColumn(out, item.dropFields("_bad"))
    counts = Observation()
    observed = parsed.observe(
        counts, F.count(F.lit(1)).alias("rows"), F.count_if(F.col("reason").isNull()).alias("read"),
        *[F.count_if(F.col("reason") == r).alias(r) for r in REASONS])
    kept = stage(observed.withColumn(column, F.when(F.col("reason").isNotNull(), F.col(column))))
    read = kept.filter(F.col("reason").isNull()).drop(column, "reason")
    return read, kept.filter(F.col("reason").isNotNull()).drop(out), dict(counts.get)
