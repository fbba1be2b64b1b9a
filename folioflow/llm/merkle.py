"""Merkle dataset manifest: a hash tree over the documents of each language, and for each document the proof that it is in it.

Method
------
* A leaf is the SHA-256 of a document's fields. Leaves of a language are numbered by id within ranges of ids (`ids.numbered`), and 1024 consecutive ones, an aligned block,
  meet in one task.
* `ladder` closes each block with a stack of at most one node for each height; the roots of blocks are the leaves of the next, 1024 times smaller table, until a
  language has one node. The languages' nodes are the leaves of the last tree.
* `paths` goes through a block's leaves in turn by fractal traversal: for each level of subtrees (of HEIGHT) it keeps the subtree that the present leaf is in, and builds the next one
  with a stack, two steps for each leaf that is passed; so each leaf's path is at hand when its turn comes, and no more than
  two subtrees a level are kept.
* The upper part of a path is the same for all leaves of a block: `descended` finds it by the same traversal of the table above, and a block meets it in the shuffle that
  gathers its leaves.

A path is an array, from the leaf upwards: `L` or `R` and the digest of the sibling at that side, or an empty string where a node is alone in its run. `climbed` folds it.

Defined results: a null field is `-`; null languages come first and null ids first of a language; repeated rows are leaves of their own, of equal ids the smaller
digest first. A null id is not tampered with. Other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.llm.scratch import materialize, ship, table
from folioflow.operators import ids

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Height of a block, and of the subtrees in it.
BLOCK, HEIGHT = 10, 5
#: Rows of tables that are broadcast; beyond, they are joined by a shuffle.
SMALL = 20_000


def _parent(left: str | None, right: str | None) -> str | None:
    return None if left is None else hashlib.sha256((left + (right or "")).encode()).hexdigest()


class Stack:
    """Tree hash: leaves go in from the left, and nodes of equal height close as soon as both are there."""

    def __init__(self, leaves: list[str], start: int, top: int) -> None:
        self.leaves, self.at, self.top, self.open = leaves, start, top, []

    def step(self) -> tuple[int, int, str | None] | None:
        """The (height, place, digest) that one more leaf or one more hash yields; None when the node of height `top` is there."""
        if len(self.open) > 1 and self.open[-1][0] == self.open[-2][0]:
            (height, _, right), (_, place, left) = self.open.pop(), self.open.pop()
            made = (height + 1, place >> 1, _parent(left, right))
        elif len(self.open) == 1 and self.open[0][0] == self.top:
            return None
        else:
            made = (0, self.at, self.leaves[self.at] if self.at < len(self.leaves) else None)
            self.at += 1
        self.open.append(made)
        return made


def height(n: int) -> int:
    """Levels above n nodes."""
    return max(0, n - 1).bit_length()


def root(leaves: list[str], top: int) -> str:
    stack = Stack(leaves, 0, top)
    while stack.step():
        pass
    return stack.open[0][2]


def paths(leaves: list[str], top: int, sub: int = HEIGHT) -> Iterator[list[str]]:
    """The path from each leaf, in turn, to the node of height `top`."""
    levels = range(0, top, sub)
    held = [{} for _ in levels]  # nodes of the subtree that the present leaf is in, of each level
    first = Stack(leaves, 0, top)
    while made := first.step():
        at, place, digest = made
        if at < top and place >> (min(at // sub * sub + sub, top) - at) == 0:
            held[at // sub][at, place] = digest
    ends = [min(low + sub, top) for low in levels]
    growing = [Stack(leaves, 1 << end, end) for end in ends]
    coming: list[dict] = [{} for _ in levels]
    for j in range(len(leaves)):
        for i, end in enumerate(ends):
            if j and j % (1 << end) == 0:
                held[i], coming[i], growing[i] = coming[i], {}, Stack(leaves, j + (1 << end), end)
        path = []
        for at in range(top):
            beside = (j >> at) ^ 1
            digest = held[at // sub].get((at, beside))
            path.append("" if digest is None else ("L" if beside < j >> at else "R") + digest)
        yield path
        for i, (low, end) in enumerate(zip(levels, ends, strict=True)):
            if growing[i].at - (1 << end) < len(leaves):
                for _ in range(2):
                    if (made := growing[i].step()) and low <= made[0] < end:
                        coming[i][made[0], made[1]] = made[2]


def climbed(digest: str, path: str) -> Column:
    """The node that a path leads to."""
    up = lambda node, s: F.when(s.startswith("L"), F.sha2(F.concat(F.substr(s, F.lit(2)), node), 256)).when(s.startswith("R"), F.sha2(F.concat(node, F.substr(s, F.lit(2))), 256)).otherwise(F.sha2(node, 256))
    return F.aggregate(path, F.col(digest), up)


def siblings(path: str) -> Column:
    return F.array_join(F.transform(F.filter(path, lambda s: s != ""), lambda s: F.substr(s, F.lit(2))), "")


def _in_order(leaves: pa.Table) -> pa.Table:
    return leaves.sort_by("place")


def _roots(leaves: pa.Table) -> pa.Table:
    """The node that closes a block: a leaf of the level above."""
    leaves = _in_order(leaves)
    of = leaves["of"][0].as_py()
    digest = root(leaves["leaf"].to_pylist(), min(BLOCK, height(of)))
    return pa.table({"tree": leaves["tree"][:1], "place": pa.array([leaves["place"][0].as_py() >> BLOCK], pa.int64()), "of": pa.array([-(-of >> BLOCK)], pa.int64()), "leaf": [digest]})


def _paths(leaves: pa.Table, upper: pa.Table) -> pa.Table:
    """Every leaf of a block with its path, the block's own path after it."""
    if not leaves.num_rows:
        return leaves.append_column("path", pa.array([], pa.list_(pa.string())))
    leaves = _in_order(leaves)
    rest = upper["path"][0].as_py()
    found = [p + rest for p in paths(leaves["leaf"].to_pylist(), min(BLOCK, height(leaves["of"][0].as_py())))]
    return leaves.append_column("path", pa.array(found, pa.list_(pa.string())))


NODES = "tree long, place long, of long, leaf string"


def ladder(leaves: DataFrame) -> list[DataFrame]:
    """leaves (tree, place, of, leaf; `of` leaves in a tree, at places from 0), and above them the roots of blocks, up to one node a tree."""
    levels = [leaves]
    while True:
        block = F.shiftright("place", BLOCK).alias("block")
        levels.append(materialize(levels[-1].select("tree", "place", "of", "leaf").groupBy("tree", block).applyInArrow(_roots, NODES), "roots"))
        if levels[-1].filter("of > 1").isEmpty():
            return levels


def descended(levels: list[DataFrame], path: DataFrame) -> DataFrame:
    """levels[0] with the path from each leaf to the end of its tree's path (tree, path). Each level's blocks meet their own path in one shuffle."""
    above = path.withColumn("place", F.lit(0).cast("long"))
    for k, level in reversed(list(enumerate(levels[:-1]))):
        kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in level.schema) + ", path array<string>"
        mine = level.groupBy("tree", F.shiftright("place", BLOCK).alias("block"))
        above = mine.cogroup(above.select("tree", "place", "path").groupBy("tree", F.col("place").alias("block"))).applyInArrow(_paths, kinds)
        if k:
            above = materialize(above, "paths")
    return above


def _leaf(values: dict[str, Column]) -> Column:
    coded = [F.when(v.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(v.cast("string")).cast("string"), F.lit(":"), v.cast("string"))) for v in values.values()]
    return F.sha2(F.concat(*coded).cast("binary"), 256)


def manifest(docs: DataFrame, changed: dict[str, Column] | None = None, tampered: Column | None = None) -> DataFrame:
    """(doc_id, lang, leaf, claimed, path, subroot, root) of every document: `claimed` is the leaf after `changed` where `tampered` holds, the path leads from the leaf to the root."""
    spark = docs.sparkSession
    ship(spark)
    fields = {c: F.col(c) for c in FIELDS}
    claimed = F.when(tampered, _leaf(fields | (changed or {}))) if tampered is not None else F.lit(None).cast("string")
    rows = materialize(docs.select("doc_id", "lang", _leaf(fields).alias("leaf"), claimed.alias("claimed")), "leaves")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = materialize(ids.numbered(rows, ["lang", "doc_id", "leaf"], "_n", parts), "numbered")
    trees = materialize(placed.groupBy(F.col("lang").alias("_lang")).agg(F.min("_n").alias("tree"), F.count(F.lit(1)).alias("of")), "trees")
    n = trees.count()
    small = F.broadcast if n <= SMALL else lambda df: df
    leaves = placed.join(small(trees), F.col("lang").eqNullSafe(F.col("_lang"))).select("tree", (F.col("_n") - F.col("tree")).alias("place"), "of", "leaf", "doc_id", "lang", "claimed")
    own = ladder(leaves)
    subroots = materialize(ids.numbered(own[-1].select("tree", F.col("leaf").alias("subroot")), ["tree"], "_n", min(parts, n // SMALL + 1)), "subroots")
    whole = ladder(subroots.select(F.lit(0).cast("long").alias("tree"), (F.col("_n") - 1).alias("place"), F.lit(n).cast("long").alias("of"), F.col("subroot").alias("leaf"), F.col("tree").alias("lang_tree")))
    top = whole[-1].first()
    start = spark.createDataFrame([(0, [])], "tree long, path array<string>")
    of_tree = materialize(descended(whole, start).select(F.col("lang_tree").alias("tree"), "path", F.col("leaf").alias("subroot")), "uppers")
    out = descended(own, of_tree).join(small(of_tree.select("tree", "subroot")), "tree")
    return out.select("doc_id", "lang", "leaf", F.coalesce("claimed", "leaf").alias("claimed"), "path", "subroot", F.lit(top["leaf"] if top else None).cast("string").alias("root"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, F.lit(False))
    made = manifest(docs, {"n_chars": F.col("n_chars").cast("decimal(38,0)") + 1}, hit)
    made = made.withColumns({"proof_sha256": F.sha2(siblings("path").cast("binary"), 256), "folded_root": climbed("claimed", "path")})
    return made.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


#: Levels of the SQL below; a tree of more than two to this power of documents needs more.
SQL_LEVELS = 40


def _oracle() -> str:
    """Both kinds of trees level by level; a table of all leaves climbs beside them."""
    coded = lambda c: f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen(({c})::VARCHAR) || ':' || ({c})::VARCHAR END"
    leaf = lambda n_chars: f"sha256({' || '.join(coded(n_chars if c == 'n_chars' else c) for c in FIELDS)})"
    # crc32, bit by bit, of the bytes of an id's digits
    crc = "xor(list_reduce(list_transform(string_split(doc_id::VARCHAR, ''), lambda ch: ascii(ch)::UBIGINT), lambda r, b: list_reduce(list_concat([xor(r, b)], list_transform(range(8), lambda i: 0::UBIGINT)), lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::UBIGINT) ELSE x >> 1 END), 4294967295::UBIGINT), 4294967295::UBIGINT)"

    def climb(name: str, source: str, key: str) -> list[str]:
        """Tables name0 (key, pos, h) to the top, and for each start its place and the siblings so far."""
        out = [f"{name}0 AS MATERIALIZED ({source})"]
        for i in range(SQL_LEVELS):
            out.append(
                f"{name}{i + 1} AS MATERIALIZED (SELECT {key}, pos // 2 AS pos, CASE WHEN any_value(n) > 1 THEN sha256(string_agg(h, '' ORDER BY pos)) ELSE any_value(h) END AS h, (any_value(n) + 1) // 2 AS n FROM {name}{i} GROUP BY {key}, pos // 2)"
            )
        return out

    def walk(name: str, tree: str, start: str, key: str) -> list[str]:
        out = [f"{name}0 AS MATERIALIZED ({start})"]
        for i in range(SQL_LEVELS):
            beside = "CASE WHEN w.n = 1 THEN w.folded WHEN s.h IS NULL THEN sha256(w.folded) WHEN w.pos % 2 = 1 THEN sha256(s.h || w.folded) ELSE sha256(w.folded || s.h) END"
            out.append(
                f"{name}{i + 1} AS MATERIALIZED (SELECT w.id, w.{key}, w.pos // 2 AS pos, (w.n + 1) // 2 AS n, {beside} AS folded, w.proof || coalesce(s.h, '') AS proof FROM {name}{i} w LEFT JOIN {tree}{i} s ON s.{key} = w.{key} AND s.pos = xor(w.pos, 1::BIGINT))"
            )
        return out

    steps = [
        f"docs AS MATERIALIZED (SELECT doc_id, lang, {leaf('n_chars')} AS leaf, CASE WHEN {crc} % 7 = 0 THEN {leaf('n_chars + 1')} ELSE {leaf('n_chars')} END AS claimed FROM documents)",
        "placed AS MATERIALIZED (SELECT row_number() OVER (ORDER BY doc_id NULLS FIRST, leaf) AS id, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n, doc_id, leaf, claimed FROM docs)",
        *climb("t", "SELECT tree, pos, leaf AS h, n FROM placed", "tree"),
        *climb("u", f"SELECT 0 AS one, tree AS pos, h, count(*) OVER () AS n FROM t{SQL_LEVELS}", "one"),
        *walk("w", "t", "SELECT id, tree, pos, n, claimed AS folded, '' AS proof FROM placed", "tree"),
        *walk("v", "u", f"SELECT id, 0 AS one, tree AS pos, (SELECT count(*) FROM t{SQL_LEVELS}) AS n, folded, proof FROM w{SQL_LEVELS}", "one"),
    ]
    return "WITH " + ",\n".join(steps) + f"\nSELECT p.doc_id, p.leaf, t.h AS subroot, u.h AS root, sha256(v.proof) AS proof_sha256, v.folded AS folded_root, v.folded = u.h AS verified FROM placed p JOIN v{SQL_LEVELS} v USING (id) JOIN t{SQL_LEVELS} t ON t.tree = p.tree, u{SQL_LEVELS} u"


ORACLE_SQL = _oracle()
