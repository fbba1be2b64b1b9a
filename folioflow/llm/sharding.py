"""Balanced label propagation: linked documents gather in few shards, and shards stay equal.

Method
------
Documents with equal texts are linked. Copies that share a shard behave alike, so the state of the propagation is a table of bundles
(text, shard, copies): at most one row for each text and shard, however many copies a text has. Each round is a few joins:

1. Shards report the linked documents that they hold, and so their room: quota less linked documents. Documents without links give way.
2. Each text picks the shard with room that holds most of its copies; bundles of fewer copies ask to move there.
3. Requests are granted in the order of running sums (in salted chunks) until the room is used; the last grant may be a part.
4. When less than half of what is asked for is granted, shards exchange: as many documents go from one to another as come back.

A grant joins smaller bundles to a larger one, or, where the shard of most copies is full, a whole text in one shard that has
room for all of it; so the rounds come to rest. Copies beyond a shard's quota stay in the next shard of most copies. At the end every copy takes a place in its text's bundles by its rank, and the
documents without links fill the quotas by theirs.

The law is `rows`: counts of shards are at most one apart. Defined results: a null text is empty and linked with other
empty ones. Repeated rows are documents of their own. A null doc_id is placed by its text. Fewer documents than shards leave shards
empty. Other columns are ignored. Texts are told apart by 64-bit hashes of text, checksum and size.
"""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folioflow.llm.scratch import materialize, table, with_rank

SHARDS = 24
ROUNDS = 16
CHUNKS = 64
EXTRA = 8


def described(docs: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, copy_of) of every document."""
    raw = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select("doc_id", (F.octet_length(raw) + F.lit(EXTRA)).cast("long").alias("size"), F.crc32(raw.cast("binary")).alias("text_crc32"), F.xxhash64(raw).alias("_h"))
    return rows.select("doc_id", "size", "text_crc32", F.xxhash64("_h", "text_crc32", "size").alias("copy_of"))


def _of(values: list[int], shard: Column) -> Column:
    return F.element_at(F.array(*(F.lit(int(v)) for v in values)), shard + 1)


def propagate(bundles: DataFrame, quotas: list[int], rounds: int = ROUNDS, chunks: int = CHUNKS) -> DataFrame:
    """bundles (copy_of, shard, n), after as many rounds as move documents."""
    for _ in range(rounds):
        held = {r["shard"]: r["n"] for r in bundles.groupBy("shard").agg(F.sum("n").alias("n")).collect()}
        room = [q - held.get(s, 0) for s, q in enumerate(quotas)]
        rank = F.struct("n", F.xxhash64("copy_of", "shard").alias("tie"), "shard")
        best = bundles.groupBy("copy_of").agg(F.count(F.lit(1)).alias("parts"), F.sum("n").alias("copies"), F.max(rank).alias("top"), F.max(F.when(_of(room, F.col("shard")) > 0, rank)).alias("to"))
        best = best.filter("parts > 1 and to is not null").withColumn("whole", (F.col("to") < F.col("top")) & (F.col("copies") - F.col("to.n") <= _of(room, F.col("to.shard"))))
        best = best.select(F.col("copy_of").alias("_c"), "to", "whole")
        asking = bundles.withColumn("me", rank).join(best, F.col("copy_of") == F.col("_c")).filter("me < to or (whole and me <> to)").select("copy_of", "shard", "n", F.col("to.shard").alias("target"), "whole")
        asking = materialize(asking, "asking")
        wanted = asking.groupBy("target", "copy_of", "whole").agg(F.sum("n").alias("ask"))
        granted = with_rank(wanted, ["target"], ["copy_of"], "before", chunks, "ask")
        grant = F.greatest(F.least(_of(room, F.col("target")) - F.col("before"), F.col("ask")), F.lit(0))
        granted = granted.withColumn("grant", F.when(~F.col("whole") | (grant == F.col("ask")), grant).otherwise(0)).select(F.col("copy_of").alias("_c"), "grant").filter("grant > 0")
        smallest = Window.partitionBy("copy_of").orderBy("n", "shard").rowsBetween(Window.unboundedPreceding, -1)  # at most one row a shard
        moved = asking.join(granted, F.col("copy_of") == F.col("_c")).withColumn("done", F.coalesce(F.sum("n").over(smallest), F.lit(0)))
        moved = moved.withColumn("go", F.greatest(F.least("n", F.col("grant") - F.col("done")), F.lit(0))).filter("go > 0")
        moved = materialize(moved.select("copy_of", "shard", "target", "go"), "moved")
        asked, went = (d.agg(F.coalesce(F.sum(c), F.lit(0)).alias("n")).first()["n"] for d, c in ((asking, "n"), (moved, "go")))
        if went:
            bundles = _moved(bundles, moved)
        if 2 * went <= asked:
            swapped = _exchange(bundles, rank, chunks)
            if not swapped.isEmpty():
                bundles = _moved(bundles, swapped)
            elif not went:
                break
    else:
        logging.getLogger(__name__).warning("documents still moved after %d rounds; counts are even, but more copies may share a shard", rounds)
    return bundles


def cut_edges(bundles: DataFrame) -> DataFrame:
    """(links, cut): pairs of copies of one text, and those whose ends lie in different shards, of bundles (copy_of, shard, n)."""
    n = F.col("n").cast("decimal(38,0)")
    of_text = bundles.groupBy("copy_of").agg(F.sum(n).alias("all"), F.sum(n * n).alias("same"))
    half = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("decimal(38,0)") / 2
    return of_text.agg(half(F.col("all") * F.col("all") - F.col("all")).cast("long").alias("links"), half(F.col("all") * F.col("all") - F.col("same")).cast("long").alias("cut"))


def _moved(bundles: DataFrame, moves: DataFrame) -> DataFrame:
    changes = bundles.union(moves.select("copy_of", "shard", -F.col("go"))).union(moves.select("copy_of", "target", "go"))
    return materialize(changes.groupBy("copy_of", "shard").agg(F.sum("n").alias("n")).filter("n > 0"), "bundles")


def _exchange(bundles: DataFrame, rank: Column, chunks: int) -> DataFrame:
    """Moves (copy_of, shard, target, go) towards each text's largest bundle, as many from one shard to another as back."""
    top = bundles.groupBy("copy_of").agg(F.count(F.lit(1)).alias("parts"), F.max(rank).alias("top")).filter("parts > 1").select(F.col("copy_of").alias("_c"), "top")
    asking = bundles.withColumn("me", rank).join(top, F.col("copy_of") == F.col("_c")).filter("me < top").select("copy_of", "shard", F.col("top.shard").alias("target"), "n")
    asking = materialize(asking, "asking")
    flow = {(r["shard"], r["target"]): r["n"] for r in asking.groupBy("shard", "target").agg(F.sum("n").alias("n")).collect()}
    both = [(a, b, min(n, flow[b, a])) for (a, b), n in flow.items() if (b, a) in flow]
    if not both:
        return asking.limit(0).withColumnRenamed("n", "go")
    bounds = F.broadcast(bundles.sparkSession.createDataFrame(both, "a int, b int, most long"))  # at most one row for two shards
    ranked = with_rank(asking, ["shard", "target"], ["copy_of"], "before", chunks, "n").join(bounds, (F.col("shard") == F.col("a")) & (F.col("target") == F.col("b")))
    go = F.least("n", F.col("most") - F.col("before"))
    return materialize(ranked.withColumn("go", go).filter("go > 0").select("copy_of", "shard", "target", "go"), "moved")


def assign(docs: DataFrame, shards: int = SHARDS, chunks: int = CHUNKS) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) of every document of docs (doc_id, text)."""
    rows = materialize(described(docs), "described")
    total = rows.count()
    quotas = [total // shards + (s < total % shards) for s in range(shards)]
    # Written first: a join of two plain shuffles is one whose hot keys Spark can split.
    groups = materialize(rows.groupBy("copy_of").agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1").select(F.col("copy_of").alias("_g")), "groups")
    marked = materialize(rows.join(groups, F.col("copy_of") == F.col("_g"), "left").withColumn("linked", F.col("_g").isNotNull()).drop("_g"), "marked")
    linked, single = marked.filter("linked"), marked.filter("not linked")
    start = F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(shards)).cast("int")
    bundles = propagate(_fitted(linked.groupBy("copy_of", start.alias("shard")).agg(F.count(F.lit(1)).alias("n")), quotas), quotas, chunks=chunks)

    upto = Window.partitionBy("copy_of").orderBy("shard").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = bundles.withColumn("end", F.sum("n").over(upto)).groupBy(F.col("copy_of").alias("_c")).agg(F.array_sort(F.collect_list(F.struct("end", "shard"))).alias("ends"))
    placed = with_rank(linked, ["copy_of"], ["doc_id", "size", "text_crc32"], "rank", chunks).join(ends, F.col("copy_of") == F.col("_c"))
    placed = placed.withColumn("shard", F.element_at(F.filter("ends", lambda e: e["end"] > F.col("rank")), 1)["shard"])

    held = {r["shard"]: r["n"] for r in bundles.groupBy("shard").agg(F.sum("n").alias("n")).collect()}
    edges, at = [], 0
    for s, q in enumerate(quotas):
        at += q - held.get(s, 0)
        edges.append(F.struct(F.lit(at).cast("long").alias("end"), F.lit(s).alias("shard")))
    filled = with_rank(single, [], ["doc_id", "size", "text_crc32"], "rank", chunks)
    filled = filled.withColumn("shard", F.element_at(F.filter(F.array(*edges), lambda e: e["end"] > F.col("rank")), 1)["shard"])
    keep = ["doc_id", "size", "text_crc32", "shard"]
    whole = materialize(placed.select(*keep).unionByName(filled.select(*keep)), "placed")
    return with_rank(whole, ["shard"], ["doc_id", "size", "text_crc32"], "slot", chunks)


def _fitted(bundles: DataFrame, quotas: list[int]) -> DataFrame:
    """bundles with what exceeds a quota at the start moved on; a hash start exceeds it only where nearly all documents are linked."""
    bundles = materialize(bundles, "start")
    held = [0] * len(quotas)
    for r in bundles.groupBy("shard").agg(F.sum("n").alias("n")).collect():
        held[r["shard"]] = r["n"]
    if all(h <= q for h, q in zip(held, quotas, strict=True)):
        return bundles
    # Running numbers of all copies, cut anew at the quotas: at most one bundle is split at each quota's end.
    at = with_rank(bundles, [], ["shard", "copy_of"], "before", CHUNKS, "n")
    edges, end = [], 0
    for s, q in enumerate(quotas):
        edges.append(F.struct(F.lit(end).cast("long").alias("lo"), F.lit(end + q).cast("long").alias("hi"), F.lit(s).alias("s")))
        end += q
    parts = at.select("copy_of", "n", "before", F.explode(F.filter(F.array(*edges), lambda e: (e["lo"] < F.col("before") + F.col("n")) & (e["hi"] > F.col("before")))).alias("e"))
    n = F.least(F.col("e.hi"), F.col("before") + F.col("n")) - F.greatest(F.col("e.lo"), F.col("before"))
    return materialize(parts.select("copy_of", F.col("e.s").alias("shard"), n.alias("n")).groupBy("copy_of", "shard").agg(F.sum("n").alias("n")), "start")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = assign(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
