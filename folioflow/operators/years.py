"""Year ids of a run that goes on: a persisted index of ranks, by year and month.

A session's number in its year is its rank in its month plus the sessions of the year's earlier months. Ranks are stored by month, sizes of months in an index of a row
each; a batch renumbers the months that it has sessions of, and later months move by the index alone. Their rows are neither read nor written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folioflow.operators import ids
from folioflow.session import PLAIN_FILES, materialize
from folioflow.sources import sinks

RANKS = "file_id string, _d string, _g decimal(38,0), place long, year string, month string"
INDEX = "n long, month string, year string"

def _months(rows: DataFrame) -> list[tuple[str, str]]:
    return [(r["year"], r["month"]) for r in rows.select("year", "month").distinct().collect()]  # a row a month


def add(sessions: DataFrame, root: str) -> list[tuple[str, str]]:
    """Takes sessions (file_id, session_date, gaceta_number) into the index at root; the months that were written.

    A batch that is run again changes nothing: a file that is there is replaced. It must come with the date that it had. Repeated files of a batch count once, the earliest of them.
    """
    spark = sessions.sparkSession
    keyed = ids.by_year(sessions.select(F.col("file_id").cast("string").alias("file_id"), "session_date", "gaceta_number"))
    fresh = keyed.groupBy("file_id").agg(F.min(F.struct("_y", "_d", "_g")).alias("k")).select("file_id", "k._d", "k._g", F.col("k._y").alias("year"), F.left("k._d", F.lit(7)).alias("month"))
    months = _months(fresh)
    if not months:
        return []
    there = sinks.existing(spark, f"{root}/ranks", RANKS)
    wanted = F.broadcast(spark.createDataFrame(months, "year string, month string"))
    old = there.drop("place").join(wanted, ["year", "month"], "left_semi").join(fresh.select("file_id"), "file_id", "left_anti")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    names = ["file_id", "_d", "_g", "year", "month"]
    placed = ids.numbered(old.select(names).unionByName(fresh.select(names)), ["year", "month", "_d", "_g", "file_id"], "_n", parts)
    sizes = placed.groupBy("year", "month").agg(F.min("_n").alias("_first"), F.count(F.lit(1)).alias("n"))
    ranked = placed.join(F.broadcast(sizes.select("year", "month", "_first")), ["year", "month"]).withColumn("place", F.col("_n") - F.col("_first") + 1)
    write = lambda df, name, *by: df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").options(**PLAIN_FILES).partitionBy(*by).parquet(f"{root}/{name}")
    write(sinks.shaped(ranked, RANKS), "ranks", "year", "month")
    # The index's rows of these years, those of the other months as they are: a row a month.
    kept = sinks.existing(spark, f"{root}/index", INDEX).join(wanted.select("year").distinct(), "year", "left_semi").join(wanted, ["year", "month"], "left_anti")
    write(materialize(sinks.shaped(sizes, INDEX).unionByName(sinks.shaped(kept, INDEX)), "index", rows=0), "index", "year")
    return months


def numbers(spark: SparkSession, root: str) -> DataFrame:
    """(file_id, year_id) of all sessions in the index."""
    before = Window.partitionBy("year").orderBy("month").rowsBetween(Window.unboundedPreceding, -1)
    earlier = sinks.existing(spark, f"{root}/index", INDEX).withColumn("_before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    ranks = sinks.existing(spark, f"{root}/ranks", RANKS).select("file_id", "place", "year", "month")
    return ranks.join(F.broadcast(earlier), ["year", "month"]).select("file_id", ids.year_id("year", F.col("place") + F.col("_before")).alias("year_id"))
