"""A corpus from raw documents to packed training sequences.

quality rules -> near duplicates -> benchmark decontamination -> secrets -> packing. Each stage reads all rows that the one
before kept, from Parquet in the shared folder; all but the last return the columns of `documents`.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from folioflow.llm import decontaminate, ngram_join, packing, quality, secrets
from folioflow.llm.scratch import materialize, table
from folioflow.session import Scope, adopt, passing, scoped

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
#: By (session, folder, place in STAGES): scopes of stages that were called by hand. Their results are written before the next stage is called.
_by_hand: dict[tuple, list[Scope]] = {}


def _stage(f: Stage) -> Stage:
    """A stage that is called by hand gives back what the one before wrote and sent, if that was called once since; the last one's tables go with the driver.

    In `run`, stages use `plain`, and the run gives their tables back.
    """

    @functools.wraps(f)
    def staged(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        place = [s for _, s in STAGES].index(staged)
        before = _by_hand.pop((id(spark), sf_dir, place - 1), [])
        for scope in before if len(before) == 1 else ():
            scope.release()
        with scoped() as scope:
            out = f(spark, docs, sf_dir)
        _by_hand.setdefault((id(spark), sf_dir, place), []).append(scope)
        return out

    staged.plain = f
    return staged


@_stage
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts that fail the base rules or lie outside their language's perplexity band."""
    return quality.select(docs)


@_stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one text of each component of near duplicates."""
    return ngram_join.keep_one(docs)


@_stage
def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts benchmark passages out, and drops texts that are mostly benchmark."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


@_stage
def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks secrets that look live."""
    return secrets.redact(docs)


@_stage
def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the tokens of the texts that are left into sequences."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("ngram_jaccard_join", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scans", secret_scan),
    ("best_fit_packing", best_fit_packing),
]

#: Kneser-Ney bands, similarity components and packing plans are not SQL; the tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage. Each stage's tables go as soon as the next one's docs are written, also after an error; those of the result belong to the caller's scope."""
    docs, held = table(spark, sf_dir, "documents"), Scope()
    try:
        for name, stage in STAGES[:-1]:
            with passing():
                found = stage.plain(spark, docs, sf_dir)
                with scoped() as written:
                    docs = materialize(found, name)
            held.release()
            held = written
        out = STAGES[-1][1].plain(spark, docs, sf_dir)
    except BaseException:
        held.release()
        raise
    adopt(held)
    return out
