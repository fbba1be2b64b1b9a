"""Assertions over the sinks after a run: (check, verdict, detail, files)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folioflow.functions import rules as R
from folioflow.session import materialize

#: Files and excerpts that a report shows, and characters around a match.
FILES, EXCERPTS, AROUND = 5, 3, 40
RETIRED = ("act_number", "presiding_officer", "legislature")


class Leak(NamedTuple):
    """What must not be in a column of speeches: the verdict where it is, and the pattern."""

    check: str
    verdict: str
    column: str
    pattern: str


def excerpt(text: Column, pattern: str, around: int = AROUND) -> Column:
    """The first match with so many characters before and after it."""
    at, end = F.regexp_instr(text, F.lit(pattern)), F.length(F.regexp_extract(text, pattern, 0))
    return F.substring(text, F.greatest(at - around, F.lit(1)), F.least(at - 1, F.lit(around)) + end + around)


def leaks_by_file(speeches: DataFrame, leaks: Sequence[Leak], key: str = "speech_id") -> DataFrame:
    """(check, file_id, n, first_id, excerpt): per check and file the rows that match, the first of them by key, and its excerpt. One scan for all checks, a row a file out of every task."""
    hits = [F.when(F.col(x.column).rlike(x.pattern), F.struct(F.lit(x.check).alias("check"), F.struct(F.col(key).alias("id"), excerpt(F.col(x.column), x.pattern).alias("excerpt")).alias("hit"))) for x in leaks]
    found = speeches.select("file_id", F.inline(F.array_compact(F.array(*hits))))
    first = found.groupBy("check", "file_id").agg(F.count(F.lit(1)).alias("n"), F.min("hit").alias("hit"))
    return first.select("check", "file_id", "n", F.col("hit.id").alias("first_id"), F.col("hit.excerpt").alias("excerpt"))


def first_files(by_file: DataFrame, files: int) -> DataFrame:
    """The first files of each check, with their place. Every task ranks its own rows and sends on that many a check (a group limit below the shuffle), so no task holds all files of a check."""
    ranked = by_file.withColumn("place", F.row_number().over(Window.partitionBy("check").orderBy("file_id")))
    return ranked.filter(F.col("place") <= files)


def leak_report(speeches: DataFrame, leaks: Sequence[Leak], files: int = FILES, excerpts: int = EXCERPTS, key: str = "speech_id") -> DataFrame:
    """(check, verdict, n, n_files, slices) of every leak check: rows and files that leak, and of the first `files` files (file_id, n, first_id, excerpt), the excerpt of the first `excerpts`.

    Nulls do not leak. A check that finds nothing passes and has no slices.
    """
    found = materialize(leaks_by_file(speeches, leaks, key), "leaks")
    totals = found.groupBy(F.col("check").alias("_c")).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("n_files"))
    entry = F.struct("place", "file_id", "n", "first_id", F.when(F.col("place") <= excerpts, F.col("excerpt")).alias("excerpt"))
    first = first_files(found, files).groupBy(F.col("check").alias("_s")).agg(F.array_sort(F.collect_list(entry)).alias("slices"))
    names = speeches.sparkSession.createDataFrame([(x.check, x.verdict) for x in leaks], "check string, verdict string")
    both = names.join(F.broadcast(totals), F.col("check") == F.col("_c"), "left").join(F.broadcast(first), F.col("check") == F.col("_s"), "left")  # a row a check
    verdict = F.when(F.col("n") > 0, F.col("verdict")).otherwise("PASS")
    return both.select("check", verdict.alias("verdict"), *(F.coalesce(c, F.lit(0)).alias(c) for c in ("n", "n_files")), "slices")


def leak_checks(speeches: DataFrame, leaks: Sequence[Leak]) -> DataFrame:
    """The report in the layout of a check: files are the first ones."""
    none = F.array().cast("array<string>")
    return leak_report(speeches, leaks).select("check", "verdict", F.concat(F.col("n").cast("string"), F.lit(" rows")).alias("detail"), F.coalesce(F.transform("slices", lambda x: x["file_id"]), none).alias("files"))


def columns_absent(frames: dict[str, DataFrame], names: tuple[str, ...] = RETIRED) -> DataFrame:
    spark = next(iter(frames.values())).sparkSession
    rows = [(f"{n} absent from {k}", "FAIL" if n in d.columns else "PASS", "", []) for k, d in frames.items() for n in names]
    return spark.createDataFrame(rows, "check string, verdict string, detail string, files array<string>")


def populated(df: DataFrame, column: str, name: str) -> DataFrame:
    if column not in df.columns:
        return df.sparkSession.createDataFrame([(name, "FAIL", "missing", [])], "check string, verdict string, detail string, files array<string>")
    filled = F.count_if(F.coalesce(F.col(column).cast("string"), F.lit("")) != "")
    return df.agg(filled.alias("n"), F.count(F.lit(1)).alias("all")).select(F.lit(name).alias("check"), F.when((F.col("n") == F.col("all")) & (F.col("n") > 0), "PASS").otherwise("FAIL").alias("verdict"), F.concat_ws("/", F.col("n").cast("string"), F.col("all").cast("string")).alias("detail"), F.array().cast("array<string>").alias("files"))


def count_check(rows: DataFrame, bounds: DataFrame) -> DataFrame:
    """Counts per file against bounds (file_id, least, most): PASS inside, WARN at one below least, FAIL elsewhere. Files without rows count 0."""
    n = rows.groupBy("file_id").agg(F.count(F.lit(1)).alias("n"))
    both = bounds.join(n, "file_id", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    verdict = F.when((F.col("n") >= F.coalesce("least", F.lit(0))) & (F.col("n") <= F.coalesce("most", F.col("n"))), "PASS").when(F.col("n") == F.col("least") - 1, "WARN").otherwise("FAIL")
    return both.select(F.concat(F.lit("count "), "file_id").alias("check"), verdict.alias("verdict"), F.col("n").cast("string").alias("detail"), F.array("file_id").alias("files"))


def substring_check(rows: DataFrame, file_id: str, column: str, forbidden: str) -> DataFrame:
    hit = rows.filter((F.col("file_id") == file_id) & F.contains(F.col(column), F.lit(forbidden)))
    return hit.agg(F.count(F.lit(1)).alias("n")).select(F.lit(f"{column} without {forbidden}").alias("check"), F.when(F.col("n") > 0, "FAIL").otherwise("PASS").alias("verdict"), F.col("n").cast("string").alias("detail"), F.array(F.lit(file_id)).alias("files"))


def golden_check(sessions: DataFrame, golden: DataFrame, column: str) -> DataFrame:
    """column against golden (file_id, expected); a null is an expected null."""
    both = golden.join(sessions.select("file_id", F.col(column).alias("got")), "file_id", "left")
    return both.select(F.concat(F.lit(f"{column} of "), "file_id").alias("check"), F.when(F.nullif("got", F.lit("")).eqNullSafe(F.col("expected")), "PASS").otherwise("FAIL").alias("verdict"), F.coalesce("got", F.lit("null")).alias("detail"), F.array("file_id").alias("files"))


def standing(speaker: str = "attribution_raw") -> list[Leak]:
    """The leaks that every run is checked for."""
    return [
        Leak("running header in text", "FAIL", "speech_text", "(?iu)" + R.RUNNING_HEADER),
        Leak("session close in text", "WARN", "speech_text", "(?iu)" + R.SESSION_CLOSE),
        Leak("dash line in text", "WARN", "speech_text", "(?d)" + R.DASH_START),
        Leak("trailing verb in speaker", "FAIL", speaker, "(?iuU)" + R.TRAILING_VERB),
        Leak("unclean speaker name", "WARN", speaker, r"[\p{Nd}§]|\(cid:"),
    ]


def suite(speeches: DataFrame, sessions: DataFrame, bounds: DataFrame | None = None, golden: DataFrame | None = None) -> DataFrame:
    """The standing checks, and those for which expectations are given."""
    speaker = "speaker_raw" if "speaker_raw" in speeches.columns else "attribution_raw"
    parts = [
        columns_absent({"speeches": speeches, "sessions": sessions}),
        populated(sessions, "year_id", "year_id populated"),
        leak_checks(speeches, standing(speaker)),
    ]
    if bounds is not None:
        parts.append(count_check(speeches, bounds))
    if golden is not None:
        parts.append(golden_check(sessions, golden, "session_date"))
    return reduce(DataFrame.unionByName, parts)


