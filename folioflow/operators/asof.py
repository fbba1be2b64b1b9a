"""As-of joins within an order: the last value that a row's predecessors have.

A window over each key would sort a key that holds a third of all rows in one task. Rows are ranged by (key, order) instead, so such a key spans many ranges; each
range carries its values forward, and takes in what the ranges before it had last of the key with which it begins: one row a range.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folioflow.session import materialize


def carried(rows: DataFrame, keys: list[str], order: list[str], values: dict[str, str], parts: int | None = None) -> DataFrame:
    """rows with, for each (out, column) of values, the last non-null value of the column among earlier rows of equal keys; null where there is none.

    Rows of equal keys and order see each other in an order of their own; null keys are a key.
    """
    spark = rows.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # The ranges are cut by sampling, which another evaluation may do otherwise: rows are written with the range they got.
    ranged = materialize(rows.repartitionByRange(parts, *keys, *order).withColumn("_range", F.spark_partition_id()), "ranges")
    before = Window.partitionBy("_range", *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    place = F.struct(*order)
    ends = ranged.groupBy("_range", *keys).agg(*(F.max_by(c, F.when(F.col(c).isNotNull(), place)).alias(f"_end_{out}") for out, c in values.items()))
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    taken = ends.select(F.col("_range").alias("_r"), *(F.col(k).alias(f"_key_{k}") for k in keys), *(F.last(f"_end_{out}", True).over(earlier).alias(f"_in_{out}") for out in values))
    # A range goes on with one key at most, so this is a row for each range.
    taken = F.broadcast(taken.filter(" or ".join(f"`_in_{out}` is not null" for out in values)))
    same = F.col("_range") == F.col("_r")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_key_{k}"))
    own = ranged.withColumns({f"_own_{out}": F.last(c, True).over(before) for out, c in values.items()})
    return own.join(taken, same, "left").select(*rows.columns, *(F.coalesce(f"_own_{out}", f"_in_{out}").alias(out) for out in values))
