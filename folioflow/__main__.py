"""Command line: pages from words or PDFs, a calibration run over a folder of page JSON, or the resumable full run."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.operators import layout
from folioflow.operators import schemas as S
from folioflow.plans import corpus
from folioflow.sources import readers, sinks
from folioflow.streaming import incremental, progress


def _converted(spark: SparkSession, kind: str, source: str) -> DataFrame:
    if kind == "pdf":
        return layout.pages(*readers.words_of_pdf(spark, source))
    return layout.pages(spark.read.schema(S.WORDS).parquet(source))


def _summary(pages: DataFrame) -> None:
    for r in layout.page_counts(pages).orderBy("file_id").toLocalIterator():
        print(f"{r['file_id']}: {r['n_pages_total']} pages, {r['n_ok']} ok, {r['n_pages_scanned']} scanned, {r['n_empty']} empty, {r['n_error']} error, {r['n_two_column']} two-column")


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    p = argparse.ArgumentParser(prog="folioflow", description=__doc__)
    p.add_argument("--mode", choices=("convert", "calibration", "full"), default="calibration")
    p.add_argument("--pages", required=True, help="folder of page JSON; of words or PDFs in mode convert")
    p.add_argument("--kind", choices=("words", "pdf"), default="words", help="what mode convert reads")
    p.add_argument("--out", required=True, help="folder of the tables, or of page JSON; - prints pages")
    p.add_argument("--summary", action="store_true", help="print a line of page counts for each file")
    p.add_argument("--batch-size", type=int, default=incremental.FILES, help="files in a batch of the full run")
    p.add_argument("--year-ids", action="store_true", help="keep numbers by year as the full run goes")
    a = p.parse_args(argv)
    spark = spark or SparkSession.builder.appName("folioflow").getOrCreate()
    if a.mode == "convert":
        pages = _converted(spark, a.kind, a.pages)
        if a.out == "-":
            for r in pages.orderBy("file_id", "page_num").select(F.to_json(F.struct(*pages.columns))).toLocalIterator():
                print(json.dumps(json.loads(r[0]), ensure_ascii=False))
        else:
            sinks.export_pages(pages, a.out)
        if a.summary:
            _summary(pages)
        return
    if a.summary:
        _summary(readers.page_json(spark, a.pages))
    if a.mode == "calibration":
        pages = readers.page_json(spark, a.pages)
        corpus.calibrate(pages, a.out)
        print(corpus.totals(corpus.manifest(spark, a.out), pages.select("file_id").distinct()).first().asDict())
        return
    numbers = sinks.session_numbers(readers.files(spark, a.pages, "*.json"), f"{a.out}/session_ids")
    listener = progress.Progress(spark, a.out, numbers.count(), print)
    with progress.listening(spark, listener):
        incremental.run(spark, a.pages, a.out, f"{a.out}/_state", a.batch_size, numbers, kind="json", by_year=a.year_ids, listener=listener).awaitTermination()
    print(progress.totals(spark, a.out, numbers))


if __name__ == "__main__":
    main()
