"""Structural quality flags of turns and files, and their upsert."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folioflow.functions import rules as R
from folioflow.functions.text import SPACE, word_count

@functools.cache
def digits() -> str:
    """A class of all characters that Python's isdigit takes, super- and subscript and circled ones too."""
    out, start = [], None
    for i in range(0x110001):
        there = i < 0x110000 and chr(i).isdigit()
        if there and start is None:
            start = i
        elif not there and start is not None:
            out.append(f"\\x{{{start:X}}}-\\x{{{i - 1:X}}}")
            start = None
    return "[" + "".join(out) + "]"


KEY = ("file_id", "speech_id", "failure_type")


def _flag(kind: str, severity: str, excerpt: Column, diagnosis: Column) -> Column:
    return F.struct(F.lit(kind).alias("failure_type"), F.lit(severity).alias("severity"), F.left(F.coalesce(excerpt, F.lit("")), F.lit(500)).alias("original_excerpt"), diagnosis.alias("diagnosis"))


def is_role(attribution: Column) -> Column:
    """Roles speak briefly: few words, a role as the first word, or a role with its article anywhere."""
    first = F.regexp_extract(attribution, f"^[{SPACE}]*([^{SPACE}]+)", 1)
    named = F.lit(False)
    for phrase in R.ROLE_PHRASES:
        named = named | F.contains(attribution, F.lit(phrase))
    return (word_count(attribution) <= R.ROLE_LENGTH) | first.isin(*R.ROLE_WORDS) | named


def length_flags(words: Column, text: Column, attribution: Column) -> list[Column]:
    """Too long and too short, as structs or null."""
    excerpt, count = F.left(F.coalesce(text, F.lit("")), F.lit(200)), F.concat(F.lit("word_count="), words.cast("string"))
    return [
        F.when(words > R.TOO_LONG, _flag("speech_too_long", "warning", excerpt, count)),
        F.when((words < R.TOO_SHORT) & ~is_role(attribution), _flag("speech_too_short", "warning", excerpt, count)),
    ]


def runs(turns: DataFrame, keys: list[str], order: list[str], who: str, restart: Column | None = None) -> DataFrame:
    """Adds run: the row's place in its island of equal who. restart breaks islands."""
    w = Window.partitionBy(*keys).orderBy(*order)
    same = F.col(who).eqNullSafe(F.lag(who).over(w)) & (F.row_number().over(w) > 1) & ~(restart if restart is not None else F.lit(False))
    marked = turns.withColumn("_island", F.sum(F.when(same, 0).otherwise(1)).over(w))
    return marked.withColumn("run", F.row_number().over(Window.partitionBy(*keys, "_island").orderBy(*order))).drop("_island")


def turn_flags(turns: DataFrame) -> DataFrame:
    """(file_id, speech_id, failure_type, ...) of turns: one pass, one window by file."""
    who = F.coalesce("attribution_raw", F.lit(""))
    placed = runs(turns.withColumn("_who", who), ["file_id"], ["position_in_session"], "_who", F.coalesce("is_continuation", F.lit(False)))
    anomaly = who.rlike(digits()) | (F.length(who) > R.ATTRIBUTION_LENGTH)
    message = F.concat(F.lit("Attribution '"), who, F.lit("' appears "), F.col("run").cast("string"), F.lit("x consecutively"))
    all_ = F.array(
        *length_flags(F.col("word_count"), F.col("speech_text"), who),
        F.when(anomaly, _flag("attribution_anomaly", "warning", who, F.lit("Attribution raw string contains digits or is unusually long"))),
        F.when(F.col("run") >= R.RUN, _flag("consecutive_same_speaker", "info", message, F.lit(""))),
    )
    return placed.select("file_id", "speech_id", F.col("rule_version"), F.inline(F.array_compact(all_)))


def file_flags(sessions: DataFrame) -> DataFrame:
    """Flags of files (file_id, session_date, n_speeches, n_pages_total, scanned: array of page numbers, rule_version)."""
    scanned = F.concat(F.lit("Scanned pages: ["), F.array_join(F.transform("scanned", lambda p: p.cast("string")), ", "), F.lit("]"))
    few = F.concat(F.lit("Only "), F.col("n_speeches").cast("string"), F.lit(" speeches found in "), F.col("n_pages_total").cast("string"), F.lit("-page file"))
    none = F.lit("")
    all_ = F.array(
        F.when(F.coalesce("session_date", F.lit("")) == "", _flag("no_date_extracted", "blocking", none, F.lit("session_date is null after header parsing"))),
        F.when((F.coalesce("n_speeches", F.lit(0)) < 3) & (F.coalesce("n_pages_total", F.lit(0)) > 2), _flag("few_speeches_extracted", "blocking", none, few)),
        F.when(F.size(F.coalesce("scanned", F.array().cast("array<int>"))) > 0, _flag("scanned_pages_present", "info", none, scanned)),
    )
    return sessions.select("file_id", F.lit("").alias("speech_id"), "rule_version", F.inline(F.array_compact(all_)))


def flags(turns: DataFrame, sessions: DataFrame) -> DataFrame:
    """All flags in the sink's layout."""
    all_ = file_flags(sessions).unionByName(turn_flags(turns))
    years = sessions.select("file_id", "year_extracted")
    return all_.join(years, "file_id", "left").select("file_id", "speech_id", F.lit("").alias("page_num"), "year_extracted", "failure_type", "severity", "original_excerpt", "diagnosis", "rule_version", F.lit("false").alias("resolved"))


def new_flags(found: DataFrame, existing: DataFrame, order: list[str] | None = None) -> DataFrame:
    """Flags to append: keys not there yet, the first of equal keys."""
    fresh = found.join(existing.select(*KEY), [*KEY], "left_anti")
    if not order:
        return fresh.dropDuplicates([*KEY])
    return fresh.withColumn("_n", F.row_number().over(Window.partitionBy(*KEY).orderBy(*order))).filter("_n = 1").drop("_n")


def with_qa_flag(turns: DataFrame, flags: DataFrame) -> DataFrame:
    """turns with qa_flag: whether any flag names the turn."""
    named = flags.filter("speech_id <> ''").select(F.col("speech_id").alias("_s")).distinct().withColumn("_f", F.lit(True))
    return turns.join(named, F.col("speech_id") == F.col("_s"), "left").withColumn("qa_flag", F.coalesce("_f", F.lit(False))).drop("_s", "_f")
