"""The resumable run: a file stream of pages, in bounded batches, each written once.

A restarted query continues at its checkpoint. A batch that was cut off is run again under the same number and replaces its own
partition, so rows are neither lost nor doubled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from folioflow.operators import layout, years
from folioflow.operators import schemas as S
from folioflow.plans import corpus
from folioflow.session import passing
from folioflow.sources import flag_store, readers, sinks
from folioflow.streaming import progress

FILES = 50


def pages_stream(spark: SparkSession, folder: str, files: int = FILES, kind: str = "parquet") -> DataFrame:
    """Page files as a stream: Parquet (schema PAGES), or page JSON named by file. All pages of a file must be in one of them."""
    read = spark.readStream.option("maxFilesPerTrigger", files)
    if kind == "parquet":
        return read.schema(S.PAGES).parquet(folder)
    pages = read.schema(readers.PAGE_JSON).option("multiLine", True).json(folder)
    return pages.select(readers.stem("_metadata.file_name").alias("file_id"), *S.columns(readers.PAGE_JSON))


def write_batch(batch: DataFrame, number: int, root: str, session_ids: DataFrame | None = None, by_year: bool = False) -> dict[str, int]:
    """Writes a batch's tables as its own partitions; its counts, which are taken as its log is written, and kept.

    Flags that another batch has are not written again: `flag_store` reads what may hold one of their keys. Without session_ids, files are numbered as they come. by_year also
    takes the sessions into the index of year ids.
    """
    spark = batch.sparkSession
    with passing():
        names = session_ids if session_ids is not None else sinks.session_numbers(batch, f"{root}/session_ids")
        made = corpus.build(batch, strict_skip=False, session_ids=names)
        scanned = sinks.shaped(layout.scanned_pages(batch), S.SCANNED)
        log, seen = progress.observed(made.log)
        tables = {"speeches": made.speeches, "sessions": made.sessions, "log": log, "scanned_pages": scanned}
        for name, df in tables.items():
            df.withColumn("batch_id", F.lit(number)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(f"{root}/{name}")
        flag_store.upsert(made.flags, f"{root}/flagged", number)
        if by_year:
            years.add(made.sessions, f"{root}/years")
        progress.keep(spark, seen.get, number, root)
    return seen.get


def run(spark: SparkSession, folder: str, root: str, checkpoint: str, files: int = FILES, session_ids: DataFrame | None = None, kind: str = "parquet", by_year: bool = False, listener: progress.Progress | None = None) -> StreamingQuery:
    """Processes all page files that are there and not yet done, then ends."""

    def batch(df: DataFrame, number: int) -> None:
        df.persist()
        try:
            seen = write_batch(df, number, root, session_ids, by_year)
            if listener is not None:
                listener.count(number, seen)
        finally:
            df.unpersist()

    return pages_stream(spark, folder, files, kind).writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
