"""Running totals as a run goes: counted while tables are written, and held against the files that are registered."""

from __future__ import annotations

import contextlib
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from folioflow.sources import sinks

TOTALS = "done long, failed long, skipped long, n_speeches long, n_flagged long, batch_id int"
COUNTS = tuple(p.split()[0] for p in TOTALS.split(", ")[:-1])


def observed(log: DataFrame) -> tuple[DataFrame, Observation]:
    """A batch's log that is counted in passing by whoever writes it: no pass of its own."""
    of = lambda s: F.count_if(F.col("status").startswith(s))
    seen = Observation()
    counts = [*(of(s).alias(s) for s in ("done", "failed", "skipped")), *(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n_speeches", "n_flagged"))]
    return log.observe(seen, *counts), seen


def keep(spark: SparkSession, seen: dict[str, int], number: int, root: str) -> None:
    """A batch's totals, as a partition of one row: a batch that is run again replaces its own."""
    row = spark.createDataFrame([(*(int(seen[c]) for c in COUNTS), number)], TOTALS)
    row.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(f"{root}/totals")


def totals(spark: SparkSession, root: str, files: DataFrame) -> dict[str, float]:
    """Sums over the batches of a run, the number of registered files, and the share of these that is over."""
    sums = sinks.existing(spark, f"{root}/totals", TOTALS).agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in COUNTS)).first().asDict()
    return _with_share(sums, files.count())


def _with_share(sums: dict[str, int], files: int) -> dict[str, float]:
    over = sums["done"] + sums["failed"] + sums["skipped"]
    return {"files": files, **sums, "percent": round(100 * over / files, 1) if files else 0.0}


class Progress(StreamingQueryListener):
    """Tells after each batch of a run what is over, from what its batches counted."""

    def __init__(self, spark: SparkSession, root: str, files: int, tell: Callable[[dict], None]) -> None:
        self.files, self.tell = files, tell
        self.batches = {r["batch_id"]: {c: r[c] for c in COUNTS} for r in sinks.existing(spark, f"{root}/totals", TOTALS).collect()}  # a row a batch

    def count(self, number: int, seen: dict[str, int]) -> None:
        self.batches[number] = seen

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        number = event.progress.batchId
        if number in self.batches:
            self.tell({"batch": number, **_with_share({c: sum(b[c] for b in list(self.batches.values())) for c in COUNTS}, self.files)})

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


@contextlib.contextmanager
def listening(spark: SparkSession, listener: Progress) -> Iterator[Progress]:
    spark.streams.addListener(listener)
    try:
        yield listener
    finally:
        spark.streams.removeListener(listener)
