"""Identifiers: session numbers, batches, and ids by year."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folioflow.session import materialize


def numbered(files: DataFrame, order: list[str], out: str = "session_id", parts: int = 200) -> DataFrame:
    """Adds out: the row's place, from 1, in the order of all rows.

    Rows are ranged over partitions and ranked there; the sizes of earlier ranges, one row each, move them up. A window
    over all rows would be one task.
    """
    # The ranges are cut by sampling, which another evaluation may do otherwise: the rows are written with the range they got.
    ranged = files.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id())
    ranked = materialize(ranged.withColumn("_in", F.row_number().over(Window.partitionBy("_part").orderBy(*order))), "ranges")
    sizes = ranked.groupBy("_part").agg(F.max("_in").alias("_n"))
    before = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("_part", "_before")
    return ranked.join(F.broadcast(before), "_part").withColumn(out, F.col("_before") + F.col("_in")).drop("_part", "_in", "_before")


def batches(files: DataFrame, number: str = "session_id", size: int = 50) -> DataFrame:
    return files.withColumn("batch_id", F.floor((F.col(number) - 1) / size))


def by_year(sessions: DataFrame) -> DataFrame:
    """Adds what sessions are numbered by in a year: _y, the year (0000 without a date), _d, the date (last of all without one), and _g, the gazette's number (99999 without one)."""
    date = F.coalesce(F.nullif("session_date", F.lit("")), F.lit("9999-12-31"))
    digits = F.regexp_replace(F.coalesce(F.nullif("gaceta_number", F.lit("")), F.lit("99999")), r"[^\d]", "")
    number = F.coalesce(digits.try_cast("decimal(38,0)"), F.lit(99999).cast("decimal(38,0)"))
    given = F.coalesce("session_date", F.lit(""))
    year = F.when(F.length(given) >= 4, F.left(given, F.lit(4))).otherwise("0000")
    return sessions.withColumn("_y", year).withColumn("_d", date).withColumn("_g", number)


def year_id(year: str, number: Column) -> Column:
    return F.format_string("%s_%04d", year, number)


def year_ids(sessions: DataFrame, ties: list[str]) -> DataFrame:
    """Adds year_id: year and number by (date, gazette number) in the year; what has no date comes last, in year 0000.

    All sessions are numbered, and a year's numbers begin after those of the years before: no year is one task.
    """
    parts = int(sessions.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = numbered(by_year(sessions), ["_y", "_d", "_g", *ties], "_n", parts)
    firsts = placed.groupBy(F.col("_y").alias("_year")).agg(F.min("_n").alias("_first"))  # a row for each year
    joined = placed.join(F.broadcast(firsts), F.col("_y") == F.col("_year"))
    return joined.withColumn("year_id", year_id("_y", F.col("_n") - F.col("_first") + 1)).drop("_y", "_d", "_g", "_n", "_year", "_first")


def with_year_ids(speeches: DataFrame, sessions: DataFrame) -> DataFrame:
    """speeches with year_id and the speech_id built from it. The last of equal file ids counts; unknown files get ''."""
    ids = sessions.groupBy(F.col("file_id").alias("_f")).agg(F.max("year_id").alias("year_id"))
    joined = speeches.join(ids, F.col("file_id") == F.col("_f"), "left").withColumn("year_id", F.coalesce("year_id", F.lit("")))
    position = F.col("position_in_session").try_cast("int")
    return joined.withColumn("speech_id", F.when(position.isNotNull(), F.format_string("%s_%03d", "year_id", position)).otherwise(F.col("speech_id"))).drop("_f")


def pending(files: DataFrame, done: DataFrame) -> DataFrame:
    """Files that are not among done (file_id, status); what was being processed counts as pending, what failed does not."""
    over = done.filter("status <> 'processing' and status <> 'pending'").select("file_id")
    return files.join(over, "file_id", "left_anti")
