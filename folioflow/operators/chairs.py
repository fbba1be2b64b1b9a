"""Optional: who speaks as the president or the secretary. No run includes this stage unless it is asked for.

The session header names the first chair; marks in the transcript (`segment.new_chair`) change it. A turn of the president's role is the chair's as of its place in
the file: that of the last mark before it, else the header's.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.operators import asof, segment, speakers

PRESIDENT, SECRETARY = r"(?iu)\A\s*president[ea]\s*\z", r"(?iu)\A\s*secretari[oa]\s*\z"


def resolved(cuts: DataFrame, officers: DataFrame) -> DataFrame:
    """Turns of files (file_id, turns of `segment.with_cuts`) with speaker_type, speaker_name and uncertain_context.

    officers (file_id, presiding_officer, secretary) come from `header.officers`; a file without a row there has none. A turn of `Presidente` or `Presidenta` is the chair's, a
    legislator; without a known chair, or after a mark that names nobody, it is uncertain. A turn of `Secretario` or `Secretaria` is the named secretary's; without a name it keeps its role. Other turns have
    their attribution's kind and no name. uncertain_context is what `with_cuts` was told to keep around a boundary.
    """
    named = officers.groupBy(F.col("file_id").alias("_f")).agg(F.max("presiding_officer").alias("_first"), F.max("secretary").alias("_secretary"))
    rows = asof.carried(segment.all_turns(cuts), ["file_id"], ["number"], {"_chair": "chair"})
    turns = rows.filter("position is not null").join(named, F.col("file_id") == F.col("_f"), "left")
    who = F.col("shown")
    president, secretary = who.rlike(PRESIDENT), who.rlike(SECRETARY)
    name = F.when(president, F.nullif(F.coalesce("_chair", "_first"), F.lit(""))).when(secretary, F.col("_secretary"))
    kind = F.when(president & name.isNotNull(), "legislator").when(president, "uncertain").otherwise(speakers.kind(who))
    return turns.select(
        "file_id",
        F.format_string("%s_%03d", "file_id", "position").alias("speech_id"),
        F.col("position").alias("position_in_session"),
        who.alias("attribution_raw"),
        kind.alias("speaker_type"),
        name.alias("speaker_name"),
        F.when(kind == "uncertain", F.col("context")).alias("uncertain_context"),
    )
