"""Jobs that go through a table by key ranges and go on where a lost run stopped.

The ranges are quantiles of the key, so each holds about as many rows whatever the keys look like.  Ranges and position
are kept in the run-state table: a range counts once its rows are written and the state says so, and a rerun starts at the first
range that does not count.
"""

from __future__ import annotations

from collections import ChainMap
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.changes import Audit
from ..sources import tables as T
from . import documents


def key_cuts(rows: DataFrame, key: str, pieces: int) -> list[int]:
    """First keys of all ranges but the first: at most ``pieces - 1`` numbers."""
    if pieces < 2:
        return []
    found = rows.agg(F.percentile_approx(key, [k / pieces for k in range(1, pieces)], 100 * pieces)).first()[0]
    return sorted({int(x) for x in found or []})


def in_range(key: str, cuts: list[int], k: int) -> Column:
    """Rows of the range ``k``; null keys are in the first.  The bounds reach the scan."""
    column = F.col(key)
    if k == 0:
        return (column < cuts[0]) | column.isNull() if cuts else F.lit(True)
    above = column >= cuts[k - 1]
    return above & (column < cuts[k]) if k < len(cuts) else above


@dataclass
class RangeJob:
    """A named job whose state and results lie below ``root``."""

    spark: SparkSession
    root: str
    name: str
    audit: Audit

    def _state(self) -> DataFrame:
        if T.has_version(self.spark, self.root, "state"):
            return T.read_table(self.spark, self.root, "state")
        return T.empty_state(self.spark)

    def _record(self, values: Mapping[str, str]) -> None:
        rows = self.spark.createDataFrame(list(values.items()), "VAR_NAME string, VAR_VALUE string")
        T.write_table(T.write_state(self._state(), rows, self.audit, "position of a job by key ranges"), self.root, "state")

    def position(self) -> tuple[list[int], int] | None:
        """Cuts and the first range that does not count yet; nothing if no run is under way."""
        state = self._state()
        at = T.get_state(state, f"{self.name}_next")
        if at == "":
            return None
        cuts = T.get_state(state, f"{self.name}_cuts")
        return [int(x) for x in cuts.split(",") if x], int(at)

    def run(
        self, rows: DataFrame, key: str, pieces: int, work: Callable[[DataFrame], DataFrame], stop_after: int | None = None,
    ) -> int:
        """Do the ranges that do not count yet, and return how many that were.

        ``work`` makes the results of one range from its rows.  A range is written to a folder of its own, so one that was lost
        half-way is written again as a whole.  ``stop_after`` ends the run after so many ranges, for time windows and tests.
        """
        found = self.position()
        if found is None:
            cuts, at = key_cuts(rows, key, pieces), 0
            self._record({f"{self.name}_cuts": ",".join(map(str, cuts)), f"{self.name}_next": "0"})
        else:
            cuts, at = found
        done = 0
        for k in range(at, len(cuts) + 1):
            if stop_after is not None and done == stop_after:
                return done
            work(rows.filter(in_range(key, cuts, k))).write.mode("overwrite").parquet(f"{self.root}/{self.name}/range={k}")
            done += 1
            self._record({f"{self.name}_next": str(k + 1)})
        self._record({f"{self.name}_next": "", f"{self.name}_ranges": str(len(cuts) + 1)})
        return done

    def result(self) -> DataFrame:
        """Rows of all ranges of the last run that went through."""
        n = int(T.get_state(self._state(), f"{self.name}_ranges") or 0)
        if not n:
            raise ValueError(f"{self.name} has not gone through yet")
        return self.spark.read.parquet(*[f"{self.root}/{self.name}/range={k}" for k in range(n)])


def documents_in_ranges(
    tables: Mapping[str, DataFrame], lang: str, job: RangeJob, pieces: int, dictionary: DataFrame | None = None,
    stop_after: int | None = None,
) -> int:
    """Movie documents of one language, range by range of movie ids; a lost run goes on at its first open range."""

    def work(movies: DataFrame) -> DataFrame:
        # links of other movies are dropped before anything of theirs is folded
        return documents.movie_documents(ChainMap({"movie": movies}, tables), lang, dictionary)

    return job.run(tables["movie"], "ID_MOVIE", pieces, work, stop_after)
