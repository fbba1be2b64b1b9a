"""Vector code compression: product codes of integer vectors, with exact k-means by Exponion search.

Method
------
Components become floor(4096 x), exactly: 4096 is a power of two. Vectors are cut into 8 parts, each with a codebook of 16 entries that starts as
the parts of the smallest ids. In each round a part is assigned to its nearest entry:

* It starts at the entry it had in the round before, at distance u. An entry that is as near lies within 2u of that one (triangle inequality), so only
  those neighbour entries whose squared distance to it is at most 4u² are looked at, in the order of a list sorted by distance.
* Distances are integers and compared squared, so nothing is rounded; of equally near entries the one of the lower index is taken.

A round is one pass that writes rows with their new codes, and one that adds up parts by entry: tasks give out at most one row
for each entry, and these are added up again in Spark; the driver sees 8 x 16 entries. Each round's table replaces the one before, and a lost executor repeats one round
at most. Integers beyond 64 bits (large components) are computed as Python's, with equal results.

Defined results: vectors that are null or hold null or non-finite components are dropped, and those of another length than most have. A length that 8 does not divide is filled up
with zeros, which change no distance. Fewer than 16 vectors make fewer entries. Rows that repeat an id are rows of their own; of equal ids the smaller vector comes first, a
null id first of all. An error beyond a long is null, and so is the sum of a label that has such an error. Other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.llm.scratch import broadcast, materialize, ship, table
from folioflow.llm.vectors import finite, matrix, usual_length
from folioflow.session import Scope, scoped

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
#: Components and lengths below these bounds leave four times a squared distance below 2**62.
SMALL, SHORT = 2**24, 2**12
#: Labels whose sums are broadcast; beyond, they are joined by a shuffle.
LABELS = 100_000

Batches = Iterator[pa.RecordBatch]


def integers(x: np.ndarray) -> np.ndarray:
    """floor(SCALE x), filled up to a length that PARTS divides: int64 where every squared distance fits, Python integers elsewhere."""
    x = np.pad(x, ((0, 0), (0, -x.shape[1] % PARTS)))
    with np.errstate(over="ignore"):
        scaled = np.floor(x * SCALE)
    most = float(np.abs(scaled).max(initial=0))
    if most < SMALL and x.shape[1] < SHORT:
        return scaled.astype(np.int64)
    return np.array([[int(s) if np.isfinite(s) else int(v) * SCALE for s, v in zip(a, b, strict=True)] for a, b in zip(scaled, x, strict=True)], dtype=object).reshape(x.shape)


def _cut(x: np.ndarray) -> list[np.ndarray]:
    return np.split(x, PARTS, axis=1)


def _squares(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    gap = x - y
    return (gap * gap).sum(1)


def neighbours(entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each entry the other ones by (squared distance, index), and these distances."""
    k = len(entries)
    away = np.stack([_squares(entries, e[None, :]) for e in entries])
    order = [sorted((j for j in range(k) if j != a), key=lambda j, a=a: (away[a, j], j)) for a in range(k)]
    return np.array(order, dtype=np.int64).reshape(k, k - 1), np.array([[away[a, j] for j in order[a]] for a in range(k)], dtype=away.dtype).reshape(k, k - 1)


def assign(x: np.ndarray, entries: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index, squared distance) of the nearest entry of each row of x, searched from entry `start`."""
    if x.dtype != entries.dtype:
        x, entries = x.astype(object), entries.astype(object)
    order, away = neighbours(entries)
    best, least = start.copy(), _squares(x, entries[start])
    reach = 4 * least
    open_ = np.arange(len(x))
    for s in range(order.shape[1]):
        open_ = open_[away[start[open_], s] <= reach[open_]]
        if not len(open_):
            break
        other = order[start[open_], s]
        d = _squares(x[open_], entries[other])
        nearer = (d < least[open_]) | ((d == least[open_]) & (other < best[open_]))
        best[open_[nearer]], least[open_[nearer]] = other[nearer], d[nearer]
    return best, least


def _coded(books: Broadcast, length: int, final: bool):
    """Rows with the codes of the nearest entries, and at the end with their error."""

    def run(batches: Batches) -> Batches:
        entries = books.value
        for b in batches:
            x, old = _cut(integers(matrix(b.column("vec"), length))), b.column("code").to_pylist()
            starts = np.array([list(c) if c else [0] * PARTS for c in old], dtype=np.int64).reshape(-1, PARTS)
            found = [assign(x[p], entries[p], starts[:, p]) for p in range(PARTS)]
            code = pa.array([c.tobytes() for c in np.stack([f[0] for f in found], 1).astype(np.uint8)], pa.binary())
            if final:
                errors = [sum(int(d) for d in ds) for ds in zip(*(f[1] for f in found), strict=True)]
                yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("label"), code, pa.array([e if e < 2**63 else None for e in errors], pa.int64())], names=["vec_id", "label", "code", "error"])
            else:
                yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("label"), b.column("vec"), code], names=["vec_id", "label", "vec", "code"])

    return run


SUMS = "part int, entry int, n long, sums array<string>"


def _sums(length: int):
    """A row for each entry that a task's parts have: their number, and sums as decimal numbers of any size."""

    def run(batches: Batches) -> Batches:
        total: dict[tuple[int, int], list] = {}
        for b in batches:
            x, codes = _cut(integers(matrix(b.column("vec"), length))), np.frombuffer(b"".join(b.column("code").to_pylist()), np.uint8).reshape(-1, PARTS)
            for p in range(PARTS):
                for e in np.unique(codes[:, p]):
                    mine = x[p][codes[:, p] == e]
                    n, sums = total.get((p, int(e)), (0, [0] * x[p].shape[1]))
                    total[p, int(e)] = (n + len(mine), [a + int(s) for a, s in zip(sums, mine.sum(0), strict=True)])
        yield _sum_rows(total)

    return run


def _sum_rows(total: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([k[0] for k in total], pa.int32()), pa.array([k[1] for k in total], pa.int32()), pa.array([n for n, _ in total.values()], pa.int64()), pa.array([[str(s) for s in sums] for _, sums in total.values()], pa.list_(pa.string()))],
        names=["part", "entry", "n", "sums"],
    )


def _added(rows: pa.Table) -> pa.Table:
    n, sums = sum(rows["n"].to_pylist()), [sum(map(int, s)) for s in zip(*rows["sums"].to_pylist(), strict=True)]
    return pa.Table.from_batches([_sum_rows({(rows["part"][0].as_py(), rows["entry"][0].as_py()): (n, sums)})])


def first_books(rows: DataFrame, length: int) -> list[np.ndarray]:
    first = [r["vec"] for r in rows.orderBy(F.asc_nulls_first("vec_id"), "vec").limit(ENTRIES).select("vec").collect()]
    return [p.copy() for p in _cut(integers(np.array(first, dtype=np.float64).reshape(len(first), length)))]


def moved(books: list[np.ndarray], sums: list) -> list[np.ndarray]:
    """Entries as the floored means of their parts; those without parts stay."""
    out = [b.astype(object) for b in books]
    for r in sums:
        out[r["part"]][r["entry"]] = [int(s) // r["n"] for s in r["sums"]]
    small = all(abs(v) < SMALL for b in out for v in b.flat) and sum(b.shape[1] for b in out) < SHORT
    return [b.astype(np.int64) for b in out] if small else out


def digest(books: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(int(v)) for b in books for v in b.flat).encode()).hexdigest()


def compress(vectors: DataFrame, rounds: int = ROUNDS, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> tuple[DataFrame, list[np.ndarray]]:
    """((vec_id, label, code, error) of every vector that counts, the entries of each part)."""
    spark = vectors.sparkSession
    ship(spark)
    rows = vectors.select(F.col(vec_id).alias("vec_id"), F.col(label).alias("label"), F.col(vector).alias("vec")).filter(finite("vec"))
    length = usual_length(rows, "vec")
    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in ("vec_id", "label"))
    if length is None:
        return spark.createDataFrame([], f"{kinds}, code binary, error long"), []
    rows = rows.filter(F.size("vec") == length)
    books = first_books(rows, length)
    coded, held = rows.withColumn("code", F.lit(None).cast("binary")), Scope()
    try:
        for _ in range(rounds):
            with scoped() as scope:
                coded = materialize(coded.mapInArrow(_coded(broadcast(spark, books), length, False), f"{kinds}, vec {rows.schema['vec'].dataType.simpleString()}, code binary"), "round")
            held.release()
            held = scope
            sums = coded.select("vec", "code").mapInArrow(_sums(length), SUMS).groupBy("part", "entry").applyInArrow(_added, SUMS)
            books = moved(books, sums.collect())  # a row for each entry
        last = materialize(coded.mapInArrow(_coded(broadcast(spark, books), length, True), f"{kinds}, code binary, error long"), "codes")
    finally:
        held.release()
    return last, books


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = compress(table(spark, sf_dir, "embeddings"))
    total = F.when(F.count_if(F.col("error").isNull()) == 0, F.sum(F.col("error").cast("decimal(38,0)"))).try_cast("long")
    by_label = coded.groupBy(F.col("label").alias("_label")).agg(total.alias("label_error"))
    few = by_label.limit(LABELS + 1).count() <= LABELS
    out = coded.join(F.broadcast(by_label) if few else by_label, F.col("label").eqNullSafe(F.col("_label")), "left")
    return out.select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))


def _oracle() -> str:
    """The rounds, one after the other, with every distance."""
    part = "list_transform(range(length(v) // 8), lambda j: v[p * (length(v) // 8) + j + 1])"
    steps = [
        "rows AS MATERIALIZED (SELECT vec_id, label, list_transform(embedding, lambda x: floor(4096 * x::DOUBLE)::BIGINT) v FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)",
        f"parts AS MATERIALIZED (SELECT vec_id, p, {part} x FROM rows, range(8) r(p))",
        "book0 AS MATERIALIZED (SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 e, x c FROM parts WHERE vec_id IN (SELECT vec_id FROM rows ORDER BY vec_id LIMIT 16))",
    ]
    for r in range(ROUNDS + 1):
        steps.append(f"all{r} AS (SELECT vec_id, p, x, e, list_sum(list_transform(range(length(x)), lambda j: (x[j + 1] - c[j + 1]) ** 2))::HUGEINT d FROM parts JOIN book{r} USING (p))")
        steps.append(f"near{r} AS MATERIALIZED (SELECT vec_id, p, x, min_by(e, (d, e)) e, min(d) d FROM all{r} GROUP BY ALL)")
        if r < ROUNDS:
            steps.append(f"mean{r} AS MATERIALIZED (SELECT p, e, list(m ORDER BY j) c FROM (SELECT p, e, j, floor(sum(x[j + 1])::DOUBLE / count(*))::BIGINT m FROM near{r}, range((SELECT max(length(x)) FROM parts)) g(j) GROUP BY p, e, j) GROUP BY p, e)")
            steps.append(f"book{r + 1} AS MATERIALIZED (SELECT p, e, coalesce(m.c, b.c) c FROM book{r} b LEFT JOIN mean{r} m USING (p, e))")
    steps.append(f"coded AS (SELECT vec_id, string_agg(printf('%02x', e), '' ORDER BY p) code, sum(d)::BIGINT error FROM near{ROUNDS} GROUP BY vec_id)")
    steps.append(f"books AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) h FROM book{ROUNDS})")
    return "WITH " + ",\n".join(steps) + "\nSELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, h AS codebooks_sha256 FROM coded JOIN rows USING (vec_id), books"


ORACLE_SQL = _oracle()
