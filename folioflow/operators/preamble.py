"""Where a transcript begins, and the text before it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.functions import rules as R
from folioflow.functions.text import hyphen_join


def begins(text: Column) -> Column:
    """A floor grant in any case, or a role at a line's start, and no roll call. Only a newline ends a line."""
    joined = hyphen_join(F.coalesce(text, F.lit("")))
    grant = joined.rlike("(?iu)" + "|".join(R.FLOOR_GRANTS))
    role = joined.rlike("(?md)" + "|".join(R.ROLE_LINES))
    return (grant | role) & ~joined.rlike(f"(?imdU){R.ADMINISTRATIVE}")


def gathered(pages: DataFrame) -> DataFrame:
    """A row for each file: its pages in order, as an array. The one shuffle by file; what follows are functions of the row."""
    page = F.struct("page_num", "status", (F.coalesce("text", F.lit("")) if "text" in pages.columns else F.lit("")).alias("text"), ((F.col("status") == "ok") & begins(F.col("text"))).alias("begins") if "text" in pages.columns else F.lit(False).alias("begins"))
    return pages.groupBy("file_id").agg(F.array_sort(F.collect_list(page)).alias("pages"))


def _readable() -> Column:
    return F.filter("pages", lambda p: p["status"] == "ok")


def with_starts(files: DataFrame) -> DataFrame:
    """Adds transcript_start_page, preamble_pages and detection_method to gathered files."""
    numbers = F.transform(_readable(), lambda p: p["page_num"])
    first = F.array_min(F.transform(F.filter("pages", lambda p: p["begins"]), lambda p: p["page_num"]))
    out = files.withColumns({"_numbers": numbers, "_first": first})
    start = F.coalesce("_first", F.try_element_at("_numbers", F.lit(2)), F.try_element_at("_numbers", F.lit(1)))
    method = F.when(F.size("_numbers") == 0, "no_extractable_text").when(F.col("_first").isNotNull(), "floor_grant_pattern").otherwise("fallback_page_2")
    out = out.withColumns({"transcript_start_page": start, "detection_method": method})
    return out.withColumn("preamble_pages", F.filter("_numbers", lambda p: p < F.col("transcript_start_page"))).drop("_numbers", "_first")


def start_pages(pages: DataFrame) -> DataFrame:
    """Per file: transcript_start_page, preamble_pages and detection_method."""
    return with_starts(gathered(pages)).select("file_id", "transcript_start_page", "preamble_pages", "detection_method")


def preamble_text() -> Column:
    """Of gathered files with starts: page 1 first, then readable pages before the start (all, if there is none); null where there is none."""
    start = F.col("transcript_start_page")
    kept = F.filter(_readable(), lambda p: (p["page_num"] == 1) | start.isNull() | (p["page_num"] < start))
    return F.when(F.size(kept) > 0, F.array_join(F.transform(kept, lambda p: p["text"]), "\n"))


def transcript_text() -> Column:
    """Of gathered files with starts: the readable pages from the start on (all, if there is none), each behind its mark; null where there is none."""
    start = F.col("transcript_start_page")
    kept = F.filter(_readable(), lambda p: start.isNull() | (p["page_num"] >= start))
    return F.when(F.size(kept) > 0, F.array_join(F.transform(kept, lambda p: marked(p["page_num"], p["text"])), "\n"))


def marked(number: Column, text: Column) -> Column:
    return F.concat(F.lit("\n[PAGE "), number.cast("string"), F.lit("]\n"), F.coalesce(text, F.lit("")))
