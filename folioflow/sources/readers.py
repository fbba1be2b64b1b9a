"""Readers of pages and of earlier runs' tables. Schemas are given, never inferred."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.operators import schemas as S

PAGE_JSON = ", ".join(p for p in S.PAGES.split(", ") if not p.startswith("file_id "))


def stem(path: str) -> Column:
    """A file's name without folders and its last extension."""
    return F.url_decode(F.replace(F.regexp_extract(path, r"([^/]+?)\.[^./]+$", 1), F.lit("+"), F.lit("%2B")))


def page_json(spark: SparkSession, folder: str) -> DataFrame:
    """Pages of a folder of JSON files, each an array of pages; the file's stem is its id. A file that is none has one page without a number."""
    read = spark.read.schema(PAGE_JSON).option("multiLine", True).json(folder)
    return read.select(stem("_metadata.file_name").alias("file_id"), *read.columns)


def table_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A sink's CSV: quoted fields of any length, with newlines."""
    return spark.read.schema(schema).option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"').option("maxCharsPerColumn", -1).csv(path)


def scanned_before(log: DataFrame) -> DataFrame:
    """(file_id, scanned) of a log of scanned pages as text: pages that are no numbers are passed over, repeats stay."""
    page = F.col("page_num").try_cast("int")
    return log.withColumn("p", page).filter("p is not null").groupBy("file_id").agg(F.array_sort(F.collect_list("p")).alias("scanned"))


def files(spark: SparkSession, folder: str, pattern: str = "*.pdf") -> DataFrame:
    """(file_id, path, modified, length) of a folder."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    return found.select(stem("path").alias("file_id"), "path", F.col("modificationTime").alias("modified"), "length")


def words_of_pdf(spark: SparkSession, folder: str, extract: Callable[[bytes], list[dict]] | None = None) -> tuple[DataFrame, DataFrame]:
    """Words (schema WORDS) and read errors (file_id, page_num, error_detail) of a folder of PDFs.

    extract turns a file's bytes into word records, or {page_num, error} for a page that fails; the default needs the optional
    pdfplumber. A file that cannot be opened is one error at page 0.
    """
    extract = extract or _pdfplumber_words
    both = S.WORDS + ", error_detail string"
    names = S.columns(both)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for file_id, content in zip(part.file_id, part.content, strict=True):
                try:
                    rows = extract(content)
                except Exception as e:  # noqa: BLE001 - an unreadable file is data here
                    rows = [{"page_num": 0, "error_detail": f"{type(e).__name__}: {e}"[:500]}]
                yield pd.DataFrame([{n: r.get(n) for n in names} | {"file_id": file_id} for r in rows], columns=names)

    content = spark.read.format("binaryFile").option("pathGlobFilter", "*.pdf").load(folder)
    read = content.select(stem("path").alias("file_id"), "content").mapInPandas(run, both)
    return read.filter("error_detail is null").drop("error_detail"), read.filter("error_detail is not null").select("file_id", "page_num", "error_detail")


def _pdfplumber_words(content: bytes) -> list[dict]:
    import io

    import pdfplumber  # optional

    out = []
    with pdfplumber.open(io.BytesIO(content)) as pdf:
        for number, page in enumerate(pdf.pages, 1):
            try:
                found = page.extract_words(extra_attrs=["size", "fontname", "non_stroking_color"])
            except Exception as e:  # noqa: BLE001 - one bad page does not lose the others
                out.append({"page_num": number, "error_detail": f"{type(e).__name__}: {e}"[:500]})
                continue
            for seq, w in enumerate(found):
                c = w.get("non_stroking_color")
                kind = None if c is None else "tuple" if isinstance(c, list | tuple) else "float" if isinstance(c, float) else "int"
                color = None if c is None else [float(x) for x in c] if kind == "tuple" else [float(c)]
                out.append({"page_num": number, "word_seq": seq, "text": w["text"], "x0": float(w["x0"]), "top": float(w["top"]), "size": w.get("size"), "fontname": w.get("fontname"), "color_kind": kind, "color": color, "page_w": float(page.width), "page_h": float(page.height)})
    return out
