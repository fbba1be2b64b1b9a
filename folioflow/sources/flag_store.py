"""The flags of a run that goes on: a table in buckets of their keys, with a Bloom filter for each bucket of each batch.

An upsert sends its keys to the filters of their buckets, and reads the parts of the table (bucket, batch) whose filter may hold one of them; the others are not opened. A filter takes BITS bits a key and
is wrong for a new key about once in five million, so a batch of new flags reads filters only, whatever is there already.

A batch replaces its own parts: run again, it leaves the store as it was.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.operators import qa
from folioflow.operators import schemas as S
from folioflow.session import PLAIN_FILES, materialize, ship
from folioflow.sources import sinks

BUCKETS = 64
BITS, HASHES = 32, 22
#: Keys that are looked up together.
SLICE = 50_000
FLAGS = S.FLAGS + ", bucket int, batch_id int"
FILTERS = "bits binary, n long, bucket int, batch_id int"


def _places(hashes: np.ndarray, size: int) -> np.ndarray:
    """HASHES bit places of each 64-bit hash in a filter of `size` bits."""
    low, high = hashes.astype(np.uint64) & np.uint64(0xFFFFFFFF), (hashes.astype(np.uint64) >> np.uint64(32)) | np.uint64(1)
    return (low[:, None] + high[:, None] * np.arange(HASHES, dtype=np.uint64)) % np.uint64(size)


def bloom(hashes: np.ndarray) -> bytes:
    bits = np.zeros(max(64, BITS * len(hashes)), bool)
    for at in range(0, len(hashes), SLICE):
        bits[_places(hashes[at : at + SLICE], len(bits)).ravel()] = True
    return np.packbits(bits).tobytes()


def may_hold(bits: bytes, n: int, hashes: np.ndarray) -> np.ndarray:
    """False for hashes that the filter of n keys does not hold."""
    there = np.unpackbits(np.frombuffer(bits, np.uint8))
    return there[_places(hashes, max(64, BITS * n))].all(axis=1)


def _filter(rows: pa.Table) -> pa.Table:
    hashes = np.asarray(rows["hash"]).astype(np.int64).view(np.uint64)
    return pa.table({"bits": pa.array([bloom(hashes)], pa.binary()), "n": pa.array([len(hashes)], pa.int64()), "bucket": rows["bucket"][:1].cast(pa.int32()), "batch_id": rows["batch_id"][:1].cast(pa.int32())})


def _asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        hold = []
        for bits, n, hashes in zip(*(b.column(c) for c in ("bits", "n", "hashes")), strict=True):
            hold.append(bool(may_hold(bits.as_py(), n.as_py(), np.asarray(hashes.values).astype(np.int64).view(np.uint64)).any()))
        yield pa.RecordBatch.from_arrays([b.column("bucket"), b.column("batch_id"), pa.array(hold)], names=["bucket", "batch_id", "hold"])


def _keyed(flags: DataFrame, number: int, buckets: int) -> DataFrame:
    """Flags in the store's layout, one for each key: the least by all its columns."""
    shaped = sinks.shaped(flags, S.FLAGS)
    rest = [c for c in shaped.columns if c not in qa.KEY]
    one = shaped.groupBy(*qa.KEY).agg(F.min(F.struct(*rest)).alias("r")).select(*qa.KEY, "r.*").select(*shaped.columns)
    key = F.xxhash64(*(F.coalesce(c, F.lit("")) for c in qa.KEY))
    return one.withColumn("hash", key).withColumn("bucket", F.pmod("hash", F.lit(buckets)).cast("int")).withColumn("batch_id", F.lit(number))


def parts_to_read(keyed: DataFrame, path: str) -> list[tuple[int, int]]:
    """The (bucket, batch) whose filter may hold a key of `keyed`, which is one batch; its own parts are left out."""
    spark = keyed.sparkSession
    ship(spark)
    own = keyed.select("batch_id").first()
    if own is None:
        return []
    filters = sinks.existing(spark, f"{path}_filters", FILTERS).filter(F.col("batch_id") != own["batch_id"])
    slices = keyed.count() // SLICE + 1
    mine = keyed.groupBy(F.col("bucket").alias("_b"), F.pmod(F.shiftrightunsigned("hash", 20), F.lit(slices))).agg(F.collect_list("hash").alias("hashes"))
    met = filters.join(mine, F.col("bucket") == F.col("_b")).select("bits", "n", "bucket", "batch_id", "hashes")
    return [(r["bucket"], r["batch_id"]) for r in met.mapInArrow(_asked, "bucket int, batch_id int, hold boolean").filter("hold").select("bucket", "batch_id").distinct().collect()]


def upsert(flags: DataFrame, path: str, number: int, buckets: int = BUCKETS) -> list[tuple[int, int]]:
    """Adds batch `number` of flags, but for those whose key another batch has; the parts (bucket, batch) that were read for it."""
    spark = flags.sparkSession
    keyed = materialize(_keyed(flags, number, buckets), "flags")
    read = parts_to_read(keyed, path)
    fresh = keyed
    if read:
        parts = [f"{path}/bucket={b}/batch_id={n}" for b, n in read]
        known = spark.read.schema(S.FLAGS).parquet(*parts).select(*qa.KEY)
        same = F.lit(True)
        for k in qa.KEY:
            same = same & F.col(f"k.{k}").eqNullSafe(F.col(f"f.{k}"))
        fresh = materialize(keyed.alias("f").join(known.alias("k"), same, "left_anti"), "fresh")
    made = fresh.select("hash", "bucket", "batch_id").groupBy("bucket", "batch_id").applyInArrow(_filter, FILTERS)
    # Filters first: a part without a filter would be overlooked, a filter without a part is not.
    for name, df in ((f"{path}_filters", made), (path, sinks.shaped(fresh, FLAGS))):
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").options(**PLAIN_FILES).partitionBy("bucket", "batch_id").parquet(name)
    return read


def flags(spark: SparkSession, path: str) -> DataFrame:
    """All flags of the store, with bucket and batch_id."""
    return sinks.existing(spark, path, FLAGS)
