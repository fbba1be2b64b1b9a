"""Writers of the corpus. Parquet is the store; CSV and JSON are exports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from folioflow.operators import ids, qa
from folioflow.operators import schemas as S


def shaped(df: DataFrame, schema: str) -> DataFrame:
    """df in a sink's layout: unknown columns go, missing ones are null, types are the sink's."""
    kinds = [p.split(" ", 1) for p in schema.split(", ")]
    return df.select(*(F.col(n).cast(t).alias(n) if n in df.columns else F.lit(None).cast(t).alias(n) for n, t in kinds))


def append(df: DataFrame, path: str, schema: str) -> None:
    shaped(df, schema).write.mode("append").parquet(path)


def rewrite(df: DataFrame, path: str, schema: str) -> None:
    """Replaces a table. path must not be what df reads."""
    shaped(df, schema).write.mode("overwrite").parquet(path)


def reset(spark: SparkSession, root: str, names: tuple[str, ...] = ("speeches", "sessions", "log", "flagged")) -> None:
    for name in names:
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root}/{name}")
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def existing(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The table at path; empty where there is none yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)


def upsert_flags(flags: DataFrame, path: str) -> None:
    """Appends flags whose keys are not there yet."""
    append(qa.new_flags(flags, existing(flags.sparkSession, path, S.FLAGS)), path, S.FLAGS)


def session_numbers(files: DataFrame, path: str) -> DataFrame:
    """(file_id, session_id) of files (file_id): numbers from 1 in the order of ids, written at path once; files that come later follow on."""
    spark = files.sparkSession
    known = existing(spark, path, "file_id string, session_id long")
    fresh = files.select("file_id").distinct().join(known, "file_id", "left_anti")
    last = known.agg(F.coalesce(F.max("session_id"), F.lit(0)).alias("n")).first()["n"]
    numbered = ids.numbered(fresh, ["file_id"], parts=int(spark.conf.get("spark.sql.shuffle.partitions")))
    append(numbered.withColumn("session_id", F.col("session_id") + last), path, "file_id string, session_id long")
    return existing(spark, path, "file_id string, session_id long")


def log(df: DataFrame, path: str) -> None:
    """Appends to the run log; error details are cut to 500 characters."""
    append(df.withColumns({"error_detail": F.left(F.coalesce("error_detail", F.lit("")), F.lit(500)), "processing_timestamp": F.current_timestamp()}), path, S.LOG)


def export_csv(df: DataFrame, path: str, schema: str) -> None:
    """CSV as the reports read it: nulls are empty, booleans are words."""
    text = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in S.columns(schema)]
    shaped(df, schema).select(*text).write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"').option("emptyValue", "").csv(path)


def export_pages(pages: DataFrame, path: str) -> None:
    """Page JSON, one folder a file."""
    pages.write.mode("overwrite").partitionBy("file_id").json(path)
