"""Approximate nearest neighbours: an inverted file of coarse centroids with product-quantised residuals, and exact reranking.

Method
------
* `fit` takes at most SAMPLE vectors (a hash of the row picks them) and finds coarse centroids by k-means, as many as the root of the
  number of vectors (at most LISTS). What is left of a vector, divided by the mean length of what is left in its cell, is cut into SUBSPACES parts of 256
  entries each. The division lets a cell of near copies use all entries, though its vectors lie closer together than all others.
* `encoded` gives every vector its cell and code. Rows of a cell are dealt to blocks of about BLOCK rows, so a cell that
  holds a third of all vectors is as many rows as any other part of that size.
* Each query asks the cells of its nearest centroids. How many, `probes_for` measures: for at most TRIALS queries the nearest vectors are
  found among all rows, and as many cells are asked as hold TARGET of these. The fraction is the same at any size.
* `scanned` meets blocks of queries with blocks of codes by cell, in a join that Spark can split, and adds up asymmetric distances from
  a table for each query and cell. A task keeps the DEPTH nearest of each query that it has seen; a window takes the nearest of all tasks.
* The vectors of these are fetched by a join, and exact distances in double precision decide.

Defined results: vectors that are null, zero, or hold null or non-finite components take no part, nor those of a null id or of another length than most
have. Rows that repeat an id are rows of their own, and neighbours of each other; ties go to the smaller id. Fewer vectors than asked for: all are returned.
Distances beyond the range of doubles are infinite. Other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folioflow.llm.scratch import broadcast, materialize, ship, table
from folioflow.llm.vectors import finite, matrix, usual_length

SAMPLE = 20_000
LISTS = 256
SUBSPACES = 32
ENTRIES = 256
BLOCK = 1024
ASKING = 64
TRIALS = 128
TARGET = 0.97
DEPTH = 64
ROUNDS = 8
#: Candidates that a task keeps before it gives out what it has.
HELD = 1_000_000

Batches = Iterator[pa.RecordBatch]


@dataclass
class Index:
    """All of it is bounded by the constants above and the length of a vector."""

    unit: float
    centroids: np.ndarray
    spread: np.ndarray
    parts: list[np.ndarray]
    books: list[np.ndarray]

    def cells(self, x: np.ndarray) -> np.ndarray:
        """Squared distances to all centroids."""
        return _squares(x, self.centroids)


def _squares(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return (x * x).sum(1)[:, None] - 2 * x @ y.T + (y * y).sum(1)


def _means(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = ROUNDS) -> np.ndarray:
    """k-means from rows of x; a centre without rows stays."""
    centres = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        near = _squares(x, centres).argmin(1)
        n = np.bincount(near, minlength=len(centres))
        total = np.stack([np.bincount(near, x[:, j], len(centres)) for j in range(x.shape[1])], 1)
        centres[n > 0] = total[n > 0] / n[n > 0, None]
    return centres


def fit(sample: np.ndarray, lists: int, unit: float, seed: int = 7) -> Index:
    rng = np.random.default_rng(seed)
    x = sample / unit
    centroids = _means(x, lists, rng)
    near = _squares(x, centroids).argmin(1)
    left = x - centroids[near]
    n = np.bincount(near, minlength=len(centroids))
    spread = np.bincount(near, np.sqrt((left * left).sum(1)), len(centroids)) / np.maximum(n, 1)
    spread[spread == 0] = 1.0
    left /= spread[near][:, None]
    parts = np.array_split(np.arange(x.shape[1]), min(SUBSPACES, x.shape[1]))
    return Index(unit, centroids, spread, parts, [_means(left[:, p], ENTRIES, rng) for p in parts])


def _encode(index: Broadcast):
    def run(batches: Batches) -> Batches:
        ix = index.value
        for b in batches:
            x = matrix(b.column("vec"), ix.centroids.shape[1]) / ix.unit
            cell = ix.cells(x).argmin(1)
            left = (x - ix.centroids[cell]) / ix.spread[cell][:, None]
            codes = np.stack([_squares(left[:, p], book).argmin(1) for p, book in zip(ix.parts, ix.books, strict=True)], 1).astype(np.uint8)
            code = pa.array([c.tobytes() for c in codes], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column("row"), b.column("vec_id"), pa.array(cell.astype(np.int32)), code], names=["row", "vec_id", "cell", "code"])

    return run


def _nearest(n: int, q: np.ndarray, keys: list[np.ndarray]) -> np.ndarray:
    """Places of the n first by keys of each q."""
    order = np.lexsort([*reversed(keys), q])
    q = q[order]
    first = np.r_[True, q[1:] != q[:-1]]
    start = np.maximum.accumulate(np.where(first, np.arange(len(q)), 0))
    return order[np.arange(len(q)) - start < n]


class _Held:
    """The nearest candidates of the queries that a task has met: (query, estimate, id, row)."""

    def __init__(self, depth: int) -> None:
        self.depth, self.parts, self.n = depth, [], 0

    def add(self, *columns: np.ndarray) -> Batches:
        self.parts.append(columns)
        self.n += len(columns[0])
        if self.n > 2 * HELD:
            self._settle()
            if self.n > HELD:
                yield from self.out()

    def _settle(self) -> None:
        if self.parts:
            q, est, vec_id, row = (np.concatenate(c) for c in zip(*self.parts, strict=True))
            keep = _nearest(self.depth, q, [est, vec_id, row])
            self.parts, self.n = [(q[keep], est[keep], vec_id[keep], row[keep])], len(keep)

    def out(self) -> Batches:
        self._settle()
        for columns in self.parts:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["q", "est", "vec_id", "row"])
        self.parts, self.n = [], 0


def _scan(index: Broadcast, depth: int):
    def run(batches: Batches) -> Batches:
        ix, held = index.value, _Held(depth)
        length = ix.centroids.shape[1]
        for b in batches:
            for i in range(b.num_rows):
                codes, asking, cell = b.column("codes")[i].values, b.column("asking")[i].values, b.column("cell")[i].as_py()
                row, vec_id = (np.asarray(codes.field(c)) for c in ("row", "vec_id"))
                code = np.frombuffer(b"".join(codes.field("code").to_pylist()), np.uint8).reshape(len(row), -1)
                q = np.asarray(asking.field("q"))
                x = matrix(asking.field("vec"), length) / ix.unit - ix.centroids[cell]
                est = np.zeros((len(q), len(row)))
                for m, (p, book) in enumerate(zip(ix.parts, ix.books, strict=True)):
                    est += _squares(x[:, p], book * ix.spread[cell])[:, code[:, m]]
                est[q[:, None] == row[None, :]] = np.inf
                if depth < len(row):
                    near = np.partition(est, depth - 1, axis=1)[:, depth - 1]
                    at, to = np.nonzero(est <= near[:, None])
                else:
                    at, to = np.indices(est.shape).reshape(2, -1)
                mine = q[at] != row[to]
                yield from held.add(q[at][mine], est[at, to][mine], vec_id[to][mine], row[to][mine])
        yield from held.out()

    return run


def _rerank(length: int):
    def run(batches: Batches) -> Batches:
        for b in batches:
            with np.errstate(over="ignore"):
                gap = matrix(b.column("q_vec"), length) - matrix(b.column("vec"), length)
                score = np.sqrt((gap * gap).sum(1))
            yield pa.RecordBatch.from_arrays([b.column("q"), b.column("query_id"), b.column("row"), b.column("vec_id"), pa.array(score)], names=["q", "query_id", "row", "vec_id", "score"])

    return run


def _exact(trials: Broadcast, k: int):
    """The k nearest of each trial query among the rows of a task."""

    def run(batches: Batches) -> Batches:
        ids, x = trials.value
        held = _Held(k)
        for b in batches:
            y, row, vec_id = matrix(b.column("vec"), x.shape[1]), np.asarray(b.column("row")), np.asarray(b.column("vec_id"))
            with np.errstate(over="ignore", invalid="ignore"):
                d = np.nan_to_num(_squares(x, y), nan=np.inf)
            d[ids[:, None] == row[None, :]] = np.inf
            at, to = np.nonzero(d <= np.partition(d, min(k, len(row)) - 1, axis=1)[:, min(k, len(row)) - 1][:, None])
            mine = ids[at] != row[to]
            yield from held.add(ids[at][mine], d[at, to][mine], vec_id[to][mine], row[to][mine])
        yield from held.out()

    return run


FOUND = "q long, est double, vec_id long, row long"


def _first(df: DataFrame, n: int, by: list[str]) -> DataFrame:
    return df.withColumn("_at", F.row_number().over(Window.partitionBy("q").orderBy(*by, "vec_id", "row"))).filter(F.col("_at") <= n)


def probes_for(kept: DataFrame, coded: DataFrame, queries: DataFrame, index: Index, k: int, target: float = TARGET, trials: int = TRIALS) -> int:
    """How many cells hold `target` of the true neighbours of at most `trials` queries."""
    spark = kept.sparkSession
    asked = queries.orderBy(F.xxhash64("row")).limit(trials).select("row", "vec").collect()
    if not asked:
        return 1
    ids, x = np.array([r["row"] for r in asked]), np.array([r["vec"] for r in asked], dtype=np.float64)
    near = _first(kept.mapInArrow(_exact(broadcast(spark, (ids, x)), k), FOUND), k, ["est"]).select("q", "row")
    cells = F.broadcast(near).join(coded.select("row", "cell"), "row").select("q", "cell").collect()  # trials x k rows
    order = np.argsort(index.cells(x / index.unit), axis=1, kind="stable")
    place = {(q, c): n for q, cs in zip(ids.tolist(), order.tolist(), strict=True) for n, c in enumerate(cs, 1)}
    places = sorted(place[r["q"], r["cell"]] for r in cells)
    return places[min(len(places) - 1, math.ceil(target * len(places)))] if places else 1


def _ask(index: Broadcast, probes: int):
    def run(batches: Batches) -> Batches:
        ix = index.value
        for b in batches:
            cells = np.argsort(ix.cells(matrix(b.column("vec"), ix.centroids.shape[1]) / ix.unit), axis=1, kind="stable")[:, :probes]
            yield pa.RecordBatch.from_arrays([b.column("row"), b.column("vec"), pa.array(cells.astype(np.int32).tolist(), pa.list_(pa.int32()))], names=["q", "vec", "cells"])

    return run


def _blocks(rows: DataFrame, key: str, size: int, columns: list[str], out: str) -> DataFrame:
    """Rows of a cell, about `size` to a block, as one row (cell, out) a block."""
    n = rows.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / F.lit(size)).alias("_blocks"))  # a row for each centroid
    dealt = rows.join(F.broadcast(n), "cell").withColumn("_block", F.pmod(F.xxhash64(key), F.col("_blocks")))
    return dealt.groupBy("cell", "_block").agg(F.collect_list(F.struct(*columns)).alias(out)).drop("_block")


def search(vectors: DataFrame, is_query: str, k: int = 10, depth: int = DEPTH, target: float = TARGET, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each row of vectors for which the SQL condition is_query on `vec_id` holds."""
    spark = vectors.sparkSession
    ship(spark)
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).alias("vec")).filter(F.col("vec_id").isNotNull() & finite("vec") & F.exists("vec", lambda x: x != 0))
    kept = materialize(rows.select(F.monotonically_increasing_id().alias("row"), "vec_id", "vec"), "vectors")
    length = usual_length(kept, "vec")
    if length is None:
        return empty
    kept = kept.filter(F.size("vec") == length)
    n, largest = kept.agg(F.count(F.lit(1)), F.max(F.array_max(F.transform("vec", lambda x: F.abs(x).cast("double"))))).first()
    draw = F.pmod(F.xxhash64("row"), F.lit(1 << 30)) < F.lit(int((1 << 30) * min(1.0, SAMPLE / n)))
    sample = kept.filter(draw).limit(2 * SAMPLE).select("vec").toArrow()
    index = fit(matrix((sample if sample.num_rows else kept.limit(1).select("vec").toArrow())["vec"], length), min(LISTS, math.isqrt(n)), largest)
    sent = broadcast(spark, index)
    coded = materialize(kept.mapInArrow(_encode(sent), "row long, vec_id long, cell int, code binary"), "codes")
    queries = kept.filter(is_query)
    probes = probes_for(kept, coded, queries, index, k, target)

    asking = queries.mapInArrow(_ask(sent, probes), f"q long, vec {kept.schema['vec'].dataType.simpleString()}, cells array<int>")
    asking = asking.select("q", "vec", F.explode("cells").alias("cell"))
    pairs = _blocks(coded, "row", BLOCK, ["row", "vec_id", "code"], "codes").join(_blocks(asking, "q", ASKING, ["q", "vec"], "asking"), "cell")
    near = materialize(_first(pairs.mapInArrow(_scan(sent, depth), FOUND), depth, ["est"]).select("q", "row"), "near")

    whole = near.join(kept, "row").join(queries.select(F.col("row").alias("q"), F.col("vec_id").alias("query_id"), F.col("vec").alias("q_vec")), "q")
    scored = whole.mapInArrow(_rerank(length), "q long, query_id long, row long, vec_id long, score double")
    return _first(scored, k, ["score"]).select("query_id", F.col("_at").alias("rank"), "vec_id", "score")


def recall(found: DataFrame, exact: DataFrame) -> float:
    """The share of exact (query_id, vec_id) that is among found."""
    pair = ["query_id", "vec_id"]
    n = exact.select(pair).distinct().count()
    return found.select(pair).distinct().join(exact.select(pair).distinct(), pair).count() / n if n else 1.0


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"), "vec_id % 100 = 0")
