"""Whole runs: pages to speeches, sessions, flags and log, as one DAG with one shuffle on file_id for each stage."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.functions import rules as R
from folioflow.operators import header, ids, layout, preamble, qa, segment
from folioflow.operators import schemas as S
from folioflow.session import materialize, passing
from folioflow.sources import sinks


UNREADABLE = "no array of pages"


@dataclass
class Corpus:
    speeches: DataFrame
    sessions: DataFrame
    flags: DataFrame
    log: DataFrame


def build(pages: DataFrame, answers: DataFrame | None = None, strict_skip: bool = True, session_ids: DataFrame | None = None, version: str = R.VERSION) -> Corpus:
    """The corpus of pages (schema PAGES).

    strict_skip passes over files whose pages are all scanned, else files without any readable page. answers of the header service
    are optional. session_ids (file_id, session_id) name speeches and sessions; without them the durable key is (file_id, position).
    A file that cannot be read or cut gets a row of status failed in the log, and the others go on. Pages are read once and meet in one row a file; what several of the four tables read is written once to the shared folder.
    """
    held = preamble.with_starts(preamble.gathered(pages))
    of = lambda x: F.filter("pages", lambda p: p["status"].isin(x))
    unusable = of(["scanned"] if strict_skip else ["scanned", "empty", "error"])
    facts = held.select(
        "file_id",
        "transcript_start_page",
        (F.size(unusable) == F.size("pages")).alias("skip"),
        F.size("pages").cast("int").alias("n_pages_total"),
        F.size(of(["scanned"])).cast("int").alias("n_pages_scanned"),
        F.transform(of(["scanned"]), lambda p: p["page_num"]).alias("scanned"),
        preamble.preamble_text().alias("preamble_text"),
        preamble.transcript_text().alias("text"),
        F.exists("pages", lambda p: p["page_num"].isNull()).alias("unreadable"),
    )
    facts = materialize(segment.with_cuts(facts).withColumn("error", F.when(F.col("unreadable"), UNREADABLE).otherwise(F.col("error"))), "files")
    usable = facts.filter("not skip and error is null")
    texts = usable.select("file_id", "preamble_text")
    heads = header.with_service(texts, answers) if answers is not None else header.by_rule(texts)
    turns = materialize(segment.turns_of(usable.select("file_id", "turns"), version), "turns")
    spoken = turns.groupBy("file_id").agg(F.count(F.lit(1)).cast("int").alias("n_speeches"))
    base = heads.join(usable.select("file_id", "transcript_start_page", "n_pages_total", "n_pages_scanned", "scanned"), "file_id").join(spoken, "file_id", "left")
    base = base.withColumns({"n_speeches": F.coalesce("n_speeches", F.lit(0)), "year_extracted": header.year(F.col("session_date")), "rule_version": F.lit(version)})
    base = materialize(base, "sessions")
    flags = materialize(qa.flags(turns, base), "flags")
    flagged = flags.groupBy("file_id").agg(F.count(F.lit(1)).cast("int").alias("n_flagged"))
    names = session_ids if session_ids is not None else base.select("file_id", F.lit(None).cast("string").alias("session_id"))
    names = names.select("file_id", F.col("session_id").cast("string").alias("session_id"))
    sessions = base.join(flagged, "file_id", "left").join(names, "file_id", "left").withColumns(
        {
            "n_flagged": F.coalesce("n_flagged", F.lit(0)),
            "processing_status": F.lit("done"),
            "processing_timestamp": F.current_timestamp(),
            "header_confidence": header.lowest_confidence(F.col("publication_date_confidence"), F.col("session_date_confidence"), F.col("committee_confidence")),
        }
    )
    carried = sessions.select("file_id", "session_id", "gaceta_number", "publication_date", "session_date", "chamber", "committee", "date_source")
    speeches = qa.with_qa_flag(turns, flags).join(carried, "file_id", "left")
    speeches = speeches.withColumn("speech_id", F.when(F.col("session_id").isNotNull(), F.format_string("%s_%03d", "session_id", "position_in_session")).otherwise(F.col("speech_id")))
    status = F.when(F.col("error").isNotNull(), "failed").otherwise("skipped_all_scanned")
    passed = facts.filter("skip or error is not null").select("file_id", status.alias("status"), F.lit(0).alias("n_speeches"), F.lit(0).alias("n_flagged"), F.coalesce("error", F.lit("")).alias("error_detail"))
    log = sessions.select("file_id", F.lit("done").alias("status"), "n_speeches", "n_flagged", F.lit("").alias("error_detail")).unionByName(passed)
    log = log.withColumns({"rule_version": F.lit(version), "processing_timestamp": F.current_timestamp()})
    return Corpus(sinks.shaped(speeches, S.SPEECHES), sinks.shaped(sessions, S.SESSIONS), flags, sinks.shaped(log, S.LOG))


def calibrate(pages: DataFrame, root: str, answers: DataFrame | None = None) -> None:
    """A fresh run: outputs are reset, and speeches and sessions get ids by year."""
    spark = pages.sparkSession
    sinks.reset(spark, root)
    with passing():
        made = build(pages, answers)
        dated = ids.year_ids(made.sessions, ["file_id"])
        speeches = ids.with_year_ids(made.speeches, dated)
        speeches.select(*S.columns(S.SPEECHES), "year_id").write.mode("overwrite").parquet(f"{root}/speeches")
        in_order = dated.orderBy(F.coalesce(F.nullif("session_date", F.lit("")), F.lit("9999-12-31")), F.length("year_id"), "year_id")
        in_order.select(*S.columns(S.SESSIONS), "year_id").write.mode("overwrite").parquet(f"{root}/sessions")
        sinks.upsert_flags(made.flags, f"{root}/flagged")
        sinks.log(made.log, f"{root}/log")
        sinks.rewrite(layout.scanned_pages(pages), f"{root}/scanned_pages", S.SCANNED)


def manifest(spark: SparkSession, root: str) -> DataFrame:
    """The state of files is a view of the sessions and the log."""
    done = sinks.existing(spark, f"{root}/sessions", S.SESSIONS)
    log = sinks.existing(spark, f"{root}/log", S.LOG).groupBy("file_id").agg(F.max_by(F.struct("status", "rule_version", "processing_timestamp", "n_speeches", "n_flagged"), "processing_timestamp").alias("l"))
    facts = done.select("file_id", F.col("session_id").try_cast("int").alias("session_id"), "session_date", "year_extracted", "document_type").dropDuplicates(["file_id"])
    return sinks.shaped(log.select("file_id", "l.*").join(facts, "file_id", "left"), S.MANIFEST)


def totals(manifest: DataFrame, files: DataFrame) -> DataFrame:
    """Running totals: files, done, failed, skipped, speeches, flags and the share that is over."""
    of = lambda s: F.count_if(F.col("status") == s)
    over = manifest.agg(of("done").alias("done"), of("failed").alias("failed"), F.count_if(F.col("status").startswith("skipped")).alias("skipped"), F.coalesce(F.sum("n_speeches"), F.lit(0)).alias("n_speeches"), F.coalesce(F.sum("n_flagged"), F.lit(0)).alias("n_flagged"))
    n = files.agg(F.count(F.lit(1)).alias("files"))
    return n.crossJoin(over).withColumn("percent", F.when(F.col("files") > 0, F.round(100 * (F.col("done") + F.col("failed") + F.col("skipped")) / F.col("files"), 1)).otherwise(0.0))
