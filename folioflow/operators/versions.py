"""What a change of the rules does to turns: spans of two versions, held against each other by a sweep over their ends.

Spans of one version of a file do not overlap. All starts and ends of both versions are laid out in order, and each carries forward which span of either side is open there
(`asof.carried`); a stretch on which both are open is an overlap. So there are at most as many overlaps as spans, and no pairs of a file's spans are formed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.operators import asof
from folioflow.session import materialize

#: Of a stretch that no span covers.
CLOSED = -1


def overlaps(old: DataFrame, new: DataFrame) -> DataFrame:
    """(file_id, old, new): numbers of spans (file_id, number, start, end; end excluded) of two versions that share a place."""
    sides = {"old": old, "new": new}

    def events(side: str) -> DataFrame:
        spans = sides[side].filter(F.col("start") < F.col("end"))
        both = F.array(F.struct(F.col("start").alias("at"), F.col("number").cast("long").alias("span")), F.struct(F.col("end").alias("at"), F.lit(CLOSED).cast("long").alias("span")))
        flat = spans.select("file_id", F.inline(both))
        return flat.select("file_id", "at", *((F.col("span") if s == side else F.lit(None).cast("long")).alias(s) for s in sides))

    # Where a span ends and the next begins, the one that begins is open.
    points = events("old").unionByName(events("new")).groupBy("file_id", "at").agg(*(F.max(s).alias(s) for s in sides))
    swept = asof.carried(points, ["file_id"], ["at"], {f"_{s}": s for s in sides})
    open_ = swept.select("file_id", *(F.coalesce(s, f"_{s}").alias(s) for s in sides))
    return open_.filter(f"old > {CLOSED} and new > {CLOSED}").distinct()


def outcome(n: Column, m: Column, equal: Column) -> Column:
    """n: overlapping spans of the other side; m: the most spans of this side that one of them overlaps."""
    return F.when(n == 0, "lost").when((n == 1) & (m == 1) & equal, "same").when((n > 1) & (m == 1), "split").when((n == 1) & (m > 1), "merged").otherwise("moved")


def compared(old: DataFrame, new: DataFrame) -> DataFrame:
    """(file_id, side, number, start, end, n_others, outcome) of every span of both versions.

    An old span is same, moved (one other, or several that shift each other), split, merged or lost; a new span likewise, seen from its side: split where it takes in several old ones, and
    new where it overlaps none. Empty spans overlap nothing. Numbers are unique within a file and version.
    """
    pairs = materialize(overlaps(old, new), "overlaps")
    counts = {s: pairs.groupBy("file_id", s).agg(F.count(F.lit(1)).alias(f"n_{s}")) for s in ("old", "new")}
    spans = {"old": old, "new": new}
    out = []
    for side, other in (("old", "new"), ("new", "old")):
        far = spans[other].select(F.col("file_id").alias("_f"), F.col("number").alias("_n"), F.col("start").alias("_s"), F.col("end").alias("_e"))
        met = pairs.join(counts[other], ["file_id", other]).join(far, (F.col("file_id") == F.col("_f")) & (F.col(other) == F.col("_n")))
        facts = met.groupBy(F.col("file_id").alias("_file"), F.col(side).alias("_number")).agg(F.count(F.lit(1)).alias("n_others"), F.max(f"n_{other}").alias("_most"), F.min("_s").alias("_from"), F.max("_e").alias("_to"))
        mine = spans[side].select("file_id", F.lit(side).alias("side"), "number", "start", "end")
        joined = mine.join(facts, (F.col("file_id") == F.col("_file")) & (F.col("number") == F.col("_number")), "left").withColumn("n_others", F.coalesce("n_others", F.lit(0)))
        kind = outcome(F.col("n_others"), F.col("_most"), (F.col("start") == F.col("_from")) & (F.col("end") == F.col("_to")))
        out.append(joined.select("file_id", "side", "number", "start", "end", "n_others", F.when((kind == "lost") & F.lit(side == "new"), "new").otherwise(kind).alias("outcome")))
    return out[0].unionByName(out[1])
