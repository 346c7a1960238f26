"""Format lines to typed movie columns, then to a dimension with bridge."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import values as V
from ..functions.columns import pipe_items, present
from ..functions.formats import clean_format, format_columns
from ..operators.changes import Audit, number_values, replace_children
from ..operators.relate import lookup_ci


def extract_formats(movie: DataFrame, audit: Audit) -> DataFrame:
    """Movies with the columns read from their format line.

    Movies without a line keep what they have.  Old and new values meet in the
    same row, so the update needs no join.
    """
    rows = movie.withColumn(
        "_line", F.when(present("WIKIPEDIA_FORMAT_LINE"), clean_format("WIKIPEDIA_FORMAT_LINE"))
    )
    found = {**format_columns("_line"), "TIM_UPDATED": audit.values()["TIM_UPDATED"]}
    has_line = F.col("_line").isNotNull()
    return rows.select(*[
        F.when(has_line, found[c].cast(movie.schema[c].dataType)).otherwise(F.col(c)).alias(c)
        if c in found else F.col(c)
        for c in movie.columns
    ])


def technical_values(movie: DataFrame) -> DataFrame:
    """One row per movie and technical value, with the rank of its type."""
    def typed(rank: int, kind: str, column: str) -> Column:
        return F.transform(
            pipe_items(column),
            lambda v: F.struct(
                F.lit(rank).alias("rank"), F.lit(kind).alias("TECHNICAL_TYPE"), v.alias("DESCRIPTION")
            ),
        )

    lists = [typed(rank, kind, column) for rank, (kind, column) in enumerate(V.TECHNICAL_TYPES)]
    none = F.expr("cast(array() as array<struct<rank:int,TECHNICAL_TYPE:string,DESCRIPTION:string>>)")
    rows = movie.filter(F.col("WIKIPEDIA_FORMAT_LINE").isNotNull())
    return rows.select(
        "ID_MOVIE", F.inline(F.concat(*[F.coalesce(items, none) for items in lists]))
    )


def grow_technical(technical: DataFrame, found: DataFrame) -> DataFrame:
    """Dimension plus the values it lacks, spelled and typed as first met."""
    spelled = found.groupBy("DESCRIPTION").agg(F.min("rank").alias("rank"))
    unknown = lookup_ci(spelled, technical, "DESCRIPTION", "DESCRIPTION", "ID_TECHNICAL")
    unknown = unknown.filter(F.col("ID_TECHNICAL").isNull())
    first = F.min(F.struct("rank", "DESCRIPTION")).alias("_first")
    fresh = unknown.groupBy(F.lower("DESCRIPTION").alias("_folded")).agg(first)
    kinds = F.array(*[F.lit(kind) for kind, _ in V.TECHNICAL_TYPES])
    fresh = fresh.select(
        F.col("_first")["DESCRIPTION"].alias("DESCRIPTION"),
        F.element_at(kinds, F.col("_first")["rank"] + 1).alias("TECHNICAL_TYPE"),
    )
    top = technical.agg(F.coalesce(F.max("ID_TECHNICAL"), F.lit(0)).alias("_top"))
    fresh = number_values(fresh, ["DESCRIPTION"], "_n")
    fresh = fresh.withColumn("ID_TECHNICAL", (F.col("_n") + top.scalar()).cast("bigint")).drop("_n")
    return technical.unionByName(fresh, allowMissingColumns=True)


def link_technical(
    movie: DataFrame, technical: DataFrame, bridge: DataFrame, audit: Audit
) -> tuple[DataFrame, DataFrame]:
    """New dimension and new movie bridge.  Movies without any value keep their links."""
    found = technical_values(movie)
    grown = grow_technical(technical, found)
    spelled = found.select("DESCRIPTION").distinct()
    ids = lookup_ci(spelled, grown, "DESCRIPTION", "DESCRIPTION", "ID_TECHNICAL")
    links = found.join(ids, "DESCRIPTION").select("ID_MOVIE", "ID_TECHNICAL").distinct()
    return grown, replace_children(bridge, links, ["ID_MOVIE", "ID_TECHNICAL"], ["ID_MOVIE"], audit)
