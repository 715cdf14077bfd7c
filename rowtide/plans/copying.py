"""A copy in key ranges that goes on where it died.

The ranges come from a sorted sample of the primary key, so they preserve its order for any
types and any number of columns, and each holds about as many rows. They are planned once
and written down; a range counts as copied once its records and then its entry in the
ledger are written. A run that dies leaves its range without an entry, and the next run
copies that range anew, to the same place, and then the rest; what has an entry is not
read again.

    <folder>/plan/generation=G            the keys that end the ranges, the last but for its end
    <folder>/done/generation=G/range=I    one for each finished range
    <folder>/end/generation=G             the copy is complete
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.operators.sinks import read_if_there
from rowtide.sources.log import after_key

#: Sampled keys for each range that is planned.
SAMPLES = 100


@dataclass
class Copy:
    """A copy under way: the keys that end its ranges, and the ranges that are finished."""

    folder: str
    generation: int
    ends: list[tuple]
    done: set[int] = field(default_factory=set)

    def left(self) -> list[int]:
        return [i for i in range(len(self.ends) + 1) if i not in self.done]

    def rows(self, snapshot: DataFrame, pk: Sequence[str], i: int) -> DataFrame:
        """The rows of one range: after the end of the one before, up to its own end.

        Plain comparisons, with bounds on the leading column that reach the files.
        """
        part = snapshot
        if i > 0:
            part = part.filter(after_key(pk, self.ends[i - 1]))
        if i < len(self.ends):
            end = self.ends[i]
            part = part.filter((F.col(pk[0]) <= F.lit(end[0])) & ~after_key(pk, end))
        return part

    def finish(self, spark: SparkSession, i: int) -> None:
        spark.range(1).coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/done/generation={self.generation}/range={i}")
        self.done.add(i)

    def close(self, spark: SparkSession) -> None:
        spark.range(1).coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/end/generation={self.generation}")


def plan_copy(snapshot: DataFrame, folder: str, pk: Sequence[str], ranges: int, generation: int) -> Copy:
    """Begin a copy in about ``ranges`` ranges; the sample has ``SAMPLES`` keys a range, whatever the table's size."""
    keys = snapshot.select(*pk)
    size = keys.count()
    share = min(1.0, ranges * SAMPLES / max(1, size))
    drawn = [tuple(r) for r in keys.sample(fraction=share, seed=7).orderBy(*pk).collect()]
    at = [len(drawn) * (i + 1) // ranges - 1 for i in range(ranges - 1)]
    ends = list(dict.fromkeys(drawn[i] for i in at if i >= 0))
    rows = [(i, tuple(e)) for i, e in enumerate(ends)]
    key = ", ".join(f"`{c}`: {snapshot.schema[c].dataType.simpleString()}" for c in pk)
    plan = snapshot.sparkSession.createDataFrame(rows, f"i int, key struct<{key}>")
    plan.coalesce(1).write.mode("overwrite").parquet(f"{folder}/plan/generation={generation}")
    return Copy(folder, generation, ends)


def open_copy(spark: SparkSession, folder: str, generation: int) -> Copy | None:
    """The copy of that generation if it was begun and is not complete."""
    plan = read_if_there(spark, f"{folder}/plan/generation={generation}")
    if plan is None or read_if_there(spark, f"{folder}/end/generation={generation}") is not None:
        return None
    ends = [tuple(r["key"]) for r in plan.orderBy("i").collect()]  # one for each range
    done = read_if_there(spark, f"{folder}/done/generation={generation}")
    finished = {r["range"] for r in done.select("range").distinct().collect()} if done is not None else set()
    return Copy(folder, generation, ends, finished)
