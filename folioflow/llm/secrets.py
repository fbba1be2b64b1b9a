"""Secret scans by corpus-wide ownership frequency, in DataFrame operations only.

Method
------
1. Every text is matched against the patterns of all kinds. Matches of one kind are leftmost and do not overlap; the text
   between them (by `split` on the same pattern) gives their places, as running sums of code points.
2. Candidate values are hashed and aggregated over the corpus: in how many repositories and by how many
   owners each value occurs (three partial aggregations, so that a value copied everywhere is no hot spot).
3. A value of `EXAMPLE_OWNERS` owners or more is a widely copied example, and so is one of several owners that is in `EXAMPLE_REPOSITORIES`
   repositories or more; any other is specific to its owners, and live-looking, in however many repositories of one owner it is. Kinds beyond the base ones ("vendor", "random") become spans only
   where their value is live-looking and no span of an earlier kind covers part of them. Base spans always stay.

`spans` finds them, `redact` replaces the live-looking ones in the texts.

Defined results: a null text is empty and has no spans. Repeated rows are separate rows with equal spans; their owner
counts once for a value. A null owner is an owner of its own. A text may hold any number of matches. Columns
that are not named as text, owner or repository are ignored by `spans` and kept by `redact`, whatever their names. Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folioflow.llm.scratch import carried, materialize, table

EXAMPLE_OWNERS, EXAMPLE_REPOSITORIES = 5, 25
MASK = "[SECRET]"
BROADCAST_ROWS = 500_000

# Kinds in order, with the pattern, the group of the value, and the least length of the value.
ASSIGN = r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
KINDS = (
    ("assign", ASSIGN, 2, 6),
    ("access", r"AKIA[A-Z0-9]{16,}", 0, 20),
    ("hex", r"(?<![0-9a-f])[0-9a-f]{24,}", 0, 24),
    ("vendor", r"\b(?:gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{20,}|eyJ[A-Za-z0-9_-]{16,}\.eyJ[A-Za-z0-9_-]{16,}\.[A-Za-z0-9_-]{16,})", 0, 20),
    ("random", r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*+[0-9])[A-Za-z0-9+/_-]{32,}+", 0, 32),
)
BASE = ("assign", "access", "hex")
#: A value of kind "random" has lower and upper case letters and at least four digits.
RANDOM_MIX = r"^(?=.*[a-z])(?=.*[A-Z])(?:[^0-9]*[0-9]){4}"


def _matches(text: Column, order: int, kind: str, pattern: str) -> Column:
    """(kind number, number, code points since the last match, match) of all matches."""
    p = F.lit(pattern)
    pairs = F.zip_with(F.regexp_extract_all(text, p, F.lit(0)), F.split(text, pattern, -1), lambda m, gap: F.struct(F.lit(order).alias("kind"), F.length(gap).cast("long").alias("gap"), m.alias("match")))
    found = F.filter(pairs, lambda x: x["match"].isNotNull())
    numbered = F.transform(found, lambda x, i: F.struct(x["kind"].alias("kind"), i.alias("number"), x["gap"].alias("gap"), x["match"].alias("match")))
    return F.when(text.rlike(pattern), numbered).otherwise(F.array().cast("array<struct<kind:int,number:int,gap:bigint,match:string>>"))


def candidates(docs: DataFrame, text: str = "text", owner: str = "source", repository: str = "doc_id", keep: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """The rows (row, the columns in keep) and their candidates (row, kind, start, end, hash of the value, owner, repository)."""
    whole = F.coalesce(F.col(text), F.lit(""))
    keep = keep if keep is not None else ["doc_id"]
    found = F.concat(*(_matches(F.col("_text"), i, kind, pattern) for i, (kind, pattern, _, _) in enumerate(KINDS)))
    read = docs.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)], F.col(owner).alias("_owner"), F.col(repository).cast("string").alias("_repo"), whole.alias("_text"))
    read = read.select(F.monotonically_increasing_id().alias("row"), *[f"_k{i}" for i in range(len(keep))], "_owner", "_repo", found.alias("_found"))
    flat = materialize(read.select("row", *[f"_k{i}" for i in range(len(keep))], "_owner", "_repo", F.posexplode_outer("_found").alias("_pos", "_m")), "candidates")
    rows = flat.filter("coalesce(_pos, 0) = 0").select("row", *[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)])
    hits = flat.filter("_m is not null").select("row", "_owner", "_repo", "_m.*")
    upto = Window.partitionBy("row", "kind").orderBy("number")
    size = F.length("match").cast("long")
    hits = hits.withColumn("end", F.sum(F.col("gap") + size).over(upto)).withColumn("start", F.col("end") - size)
    value, fits = F.col("match"), F.lit(True)
    for i, (kind, pattern, group, least) in enumerate(KINDS):
        mine = F.col("kind") == i
        if group:
            value = F.when(mine, F.regexp_extract("match", pattern, group)).otherwise(value)
        fits = F.when(mine, (F.length("value") >= least) & (F.col("value").rlike(RANDOM_MIX) if kind == "random" else F.lit(True))).otherwise(fits)
    hits = hits.withColumn("value", value).filter(fits)
    return rows, hits.select("row", "kind", "start", "end", F.sha2("value", 256).alias("hash"), "_owner", "_repo")


def ownership(hits: DataFrame) -> DataFrame:
    """(hash, owners, repositories) over the corpus."""
    once = hits.groupBy("hash", "_owner", "_repo").agg(F.lit(1).alias("one"))
    by_owner = once.groupBy("hash", "_owner").agg(F.count(F.lit(1)).alias("repositories"))
    return by_owner.groupBy("hash").agg(F.count(F.lit(1)).alias("owners"), F.sum("repositories").alias("repositories"))


def spans(docs: DataFrame, text: str = "text", owner: str = "source", repository: str = "doc_id", keep: list[str] | None = None, example_owners: int = EXAMPLE_OWNERS, example_repositories: int = EXAMPLE_REPOSITORIES) -> DataFrame:
    """The columns in keep, and `found`: the row's spans by start and kind, each with its owners, repositories and live."""
    rows, hits = candidates(docs, text, owner, repository, keep)
    known = ownership(hits).select(F.col("hash").alias("_h"), "owners", "repositories")
    example = (F.col("owners") >= example_owners) | (F.col("owners") > 1) & (F.col("repositories") >= example_repositories)
    rated = hits.join(known, F.col("hash") == F.col("_h")).withColumn("live", ~example)
    rated = rated.filter((F.col("kind") < len(BASE)) | F.col("live"))
    # Spans of one kind do not overlap: the last one that begins before, and the first that begins after, tell of every earlier kind.
    before = Window.partitionBy("row").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy("row").orderBy("start", "kind").rowsBetween(1, Window.unboundedFollowing)
    covered = F.lit(False)
    for k in range(len(BASE), len(KINDS)):
        earlier = F.col("kind") < k
        ends, begins = F.max(F.when(earlier, F.col("end"))).over(before), F.min(F.when(earlier, F.col("start"))).over(after)
        covered = F.when(F.col("kind") == k, F.coalesce(ends > F.col("start"), F.lit(False)) | F.coalesce(begins < F.col("end"), F.lit(False))).otherwise(covered)
    rated = rated.withColumn("covered", covered).filter("not covered")
    merged = rated.groupBy(F.col("row").alias("_row")).agg(F.array_sort(F.collect_list(F.struct("start", "kind", "end", "live", "owners", "repositories"))).alias("found"))
    empty = F.array().cast(merged.schema["found"].dataType)
    return rows.join(merged, F.col("row") == F.col("_row"), "left").withColumn("found", F.coalesce("found", empty)).drop("_row", "row")


def _named(array: Column) -> Column:
    kinds = F.array(*(F.lit(k[0]) for k in KINDS))
    return F.array_join(F.transform(array, lambda x: F.concat_ws(":", F.element_at(kinds, x["kind"] + 1), x["start"].cast("string"), x["end"].cast("string"))), ",")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = spans(table(spark, sf_dir, "documents"))
    of = lambda i: F.size(F.filter("found", lambda x: x["kind"] == i)).cast("long")
    base = F.filter("found", lambda x: x["kind"] < len(BASE))
    live = F.size(F.filter("found", lambda x: x["live"])).cast("long")
    return found.select("doc_id", *(of(i).alias(f"n_{k}") for i, k in enumerate(BASE)), F.sha2(_named(base), 256).alias("base_sha256"), _named(F.col("found")).alias("spans"), live.alias("n_live"), (F.size("found") - live).alias("n_example"))


def redact(docs: DataFrame, text: str = "text", owner: str = "source", repository: str = "doc_id", example_owners: int = EXAMPLE_OWNERS, example_repositories: int = EXAMPLE_REPOSITORIES) -> DataFrame:
    """docs with live-looking secrets replaced by MASK. Widely copied examples stay as they are."""
    rows, names = carried(docs)
    whole, repo = names[text], names[repository]
    marked = rows.withColumn("hash", F.xxhash64(whole))
    found = spans(marked, whole, names[owner], repo, [repo, "hash"], example_owners, example_repositories)
    live = F.filter("found", lambda x: x["live"])
    cut = found.select(F.col(repo).alias("r"), F.col("hash").alias("h"), F.transform(live, lambda x: F.struct(x["start"].cast("int").alias("s"), x["end"].cast("int").alias("e"))).alias("cut")).filter(F.size("cut") > 0)
    cut = materialize(cut.dropDuplicates(["r", "h"]), "redact")
    cut = F.broadcast(cut) if cut.count() <= BROADCAST_ROWS else cut
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    step = lambda acc, x: F.struct(F.when(x["s"] >= acc["at"], F.concat(acc["out"], F.substring(F.col(whole), acc["at"] + 1, x["s"] - acc["at"]), F.lit(MASK))).otherwise(acc["out"]).alias("out"), F.greatest(acc["at"], x["e"]).alias("at"))
    rest = lambda acc: F.concat(acc["out"], F.substring(F.col(whole), acc["at"] + 1, F.length(whole)))
    joined = marked.join(cut, F.col(repo).eqNullSafe(F.col("r")) & (F.col("hash") == F.col("h")), "left")
    values = {c: F.col(v) for c, v in names.items()} | {text: F.when(F.col("cut").isNotNull(), F.aggregate("cut", start, step, rest)).otherwise(F.col(whole))}
    if "n_chars" in names:
        joined = joined.withColumn("new", values[text])
        values |= {text: F.col("new"), "n_chars": F.when(F.col("cut").isNotNull(), F.length("new").cast(docs.schema["n_chars"].dataType)).otherwise(values["n_chars"])}
    return joined.select(*(values[c].alias(c) for c in docs.columns))
