"""Tables, ranks and worker settings that every operator of this subpackage uses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folioflow import session
from folioflow.session import broadcast, materialize

__all__ = ["broadcast", "carried", "doc_remainder", "kinds", "materialize", "ship", "table", "with_rank"]

#: Rows of whole texts in an Arrow batch. Spark's default of 10,000 fits short rows.
BATCH_ROWS = 1000
_BATCH_KEY, _BATCH_DEFAULT = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000"


def ship(spark: SparkSession) -> None:
    """Makes the package importable in Python workers, and Arrow batches small where the session has the default."""
    session.ship(spark)
    if spark.conf.get(_BATCH_KEY, _BATCH_DEFAULT) == _BATCH_DEFAULT:
        spark.conf.set(_BATCH_KEY, BATCH_ROWS)


def carried(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """docs with every column under a name of its own, and these names by the given ones: so no column of docs can clash with one that is added."""
    names = {c: f"_k{i}" for i, c in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names


def kinds(df: DataFrame, columns: list[str]) -> str:
    """DDL of some columns of df."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*columns).schema)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def doc_remainder(modulus: int = 5, key: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo modulus; a null id counts as the empty string."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % F.lit(modulus)


def with_rank(df: DataFrame, keys: list[str], order: list[str], out: str, chunks: int, weight: str | None = None) -> DataFrame:
    """Adds out: the row's place, from 0, among the rows of equal keys; with weight, the weights of the rows before it.

    A plain window over a few hot keys would sort each of them in one task. Here rows are first dealt
    to chunks (as many as given, or as shuffles have partitions, if these are more) by a hash of `order`, ranked in their (key, chunk), and moved up by the totals of the
    earlier chunks, which are summed in a table of only keys x chunks rows. Keys must not be null.
    """
    chunks = max(chunks, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    chunked = df.withColumn("_chunk", F.pmod(F.xxhash64(*[F.col(c) for c in order]), F.lit(chunks)).cast("int")).withColumn("_w", F.col(weight).cast("long") if weight else F.lit(1).cast("long"))
    upto = Window.partitionBy(*keys, "_chunk").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = chunked.withColumn("_in", F.sum("_w").over(upto) - F.col("_w"))
    sizes = chunked.groupBy(*keys, "_chunk").agg(F.sum("_w").alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_chunk").alias("_c"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    cond = F.col("_chunk") == F.col("_c")
    for i, k in reversed(list(enumerate(keys))):
        cond = (F.col(k) == F.col(f"_k{i}")) & cond
    return ranked.join(offsets, cond, "inner").withColumn(out, F.col("_before") + F.col("_in")).drop("_chunk", "_w", "_in", "_c", "_before", *[f"_k{i}" for i in range(len(keys))])
