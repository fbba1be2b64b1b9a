"""Optional: kinds of speakers, by the documented signals. No run includes this stage unless it is asked for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Signals of each kind, in the order in which they are tried.
SIGNALS = (
    ("legislator", r"\bhonorable\s+(?:Representante|Senador[a]?|Congresista)\b"),
    ("minister", r"\bse[ñn]or[a]?\s+(?:Vice)?[Mm]inistr[oa]\b|\bdoctor[a]?\s+[^,]+,\s*(?:Vice)?[Mm]inistr[oa]\b"),
    ("role", r"^(?:(?:El|La)\s+)?(?:se[ñn]or[a]?\s+)?(?:Presidente|Presidenta|Vicepresidente|Vicepresidenta|Secretario|Secretaria|Subsecretario|Subsecretaria|Presidencia)\b"),
    ("citizen", r"\bciudadan[oa]\b|\b(?:padre|madre)\s+cuidador[a]?\b"),
)
LONGEST = 100


def kind(attribution: Column) -> Column:
    """legislator, minister, role or citizen; uncertain for long or damaged attributions and for those without a signal."""
    damaged = (F.length(attribution) > LONGEST) | attribution.rlike(r"\p{Nd}") | F.contains(attribution, F.lit("(cid:"))
    out = F.when(attribution.isNull() | damaged, "uncertain")
    for name, pattern in SIGNALS:
        out = out.when(attribution.rlike("(?iuU)" + pattern), name)
    return out.otherwise("uncertain")


def classified(turns: DataFrame) -> DataFrame:
    return turns.withColumn("speaker_type", kind(F.col("attribution_raw")))
