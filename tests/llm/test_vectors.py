"""Nearest neighbours, vector codes and the Merkle manifest against plain versions, on odd tables too."""

import hashlib
import math
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from folioflow.llm import ann, exponion, merkle
from folioflow.llm.scratch import table

from . import brute

SF = "/root/testdata/sf0.001"
NAN, INF = float("nan"), float("inf")
DDL = "vec_id long, embedding array<double>, label int"


def counts(v, zero):
    return v is not None and all(x is not None and math.isfinite(x) for x in v) and (zero or any(v))


def nearest(rows, wanted, k=10):
    """(query place, [(score, id)]) over all rows, each a neighbour of all others."""
    rows = [(i, np.array(v, dtype=float)) for i, v, *_ in rows if i is not None and counts(v, False)]
    out = []
    for a, (i, v) in enumerate(rows):
        if wanted(i):
            found = sorted((float(np.sqrt(((v - w) ** 2).sum())), j) for b, (j, w) in enumerate(rows) if a != b)
            out.append((i, found[:k]))
    return sorted(out, key=lambda x: (x[0], x[1]))


def found(df):
    by = {}
    for r in df.collect():
        by.setdefault(r["query_id"], []).append((r["rank"], r["score"], r["vec_id"]))
    return {q: sorted(x) for q, x in by.items()}


def test_recall_and_exact_scores(spark):
    vectors = table(spark, "/root/testdata/sf0.1", "embeddings")
    rows = [tuple(r) for r in vectors.collect()]
    got = found(ann.search(vectors, "vec_id % 100 = 0"))
    want = dict(nearest(rows, lambda i: i % 100 == 0))
    assert set(got) == set(want) and all([x[0] for x in got[q]] == list(range(1, 11)) for q in got)
    place = {i: np.array(v, dtype=float) for i, v, _ in rows}
    for q, hits in got.items():
        assert [(s, i) for _, s, i in hits] == sorted((float(np.sqrt(((place[q] - place[i]) ** 2).sum())), i) for _, _, i in hits)
    shared = sum(len({i for _, i in want[q]} & {i for _, _, i in got[q]}) for q in want)
    assert shared >= 0.95 * 10 * len(want)
    exact = spark.createDataFrame([(q, i) for q, hits in want.items() for _, i in hits], "query_id long, vec_id long")
    assert ann.recall(ann.search(vectors, "vec_id % 100 = 0"), exact) == shared / (10 * len(want))


def test_a_third_of_equal_and_a_third_of_near_vectors(spark):
    rng = np.random.default_rng(3)
    spread = rng.normal(size=(700, 24))
    rows = [(i, (spread[0] if i % 3 == 0 else spread[1] + rng.normal(size=24) * 1e-3 if i % 3 == 1 else spread[i % 700]).tolist(), 0) for i in range(2100)]
    got = found(ann.search(spark.createDataFrame(rows, DDL), "vec_id % 50 = 0"))
    want = dict(nearest(rows, lambda i: i % 50 == 0))
    equal = [q for q in want if q % 3 == 0]
    assert all([i for _, _, i in got[q]] == [i for _, i in want[q]] for q in equal)  # ties go to the smaller id
    assert sum(len({i for _, i in want[q]} & {i for _, _, i in got[q]}) for q in want) >= 0.9 * 10 * len(want)


ODD = [(0, [1.0, 0.0, 2.0], 1), (1, [1.0, 0.0, 2.0], None), (2, None, 1), (3, [0.0, 0.0, 0.0], 2), (4, [NAN, 0.0, 1.0], 2), (5, [INF, 0.0, 1.0], 2), (6, [None, 0.0, 1.0], 2), (7, [1.0, 2.0], 3), (8, [], 3), (None, [3.0, 1.0, 1.0], 3), (100, [1.0, 0.5, 2.0], 1), (100, [1.0, 0.5, 2.0], 1), (-100, [-1.0, 1e-300, 3.0], None), (9, [1e200, -1e200, 0.0], 9)]


def odd_vectors(spark, rows=ODD):
    return spark.createDataFrame(rows, DDL).selectExpr("*", "1 as row", "2 as vec", "3 as q", "4 as code", "5 as cell", "6 as error", "7 as _label", "8 as n")


def test_search_of_odd_rows(spark):
    got = sorted(tuple(r) for r in ann.search(odd_vectors(spark), "vec_id % 100 = 0").collect())
    with np.errstate(over="ignore"):
        want = nearest([r for r in ODD if r[1] is None or len(r[1]) == 3], lambda i: i % 100 == 0)
    assert got == sorted((q, n, i, s) for q, hits in want for n, (s, i) in enumerate(hits, 1))
    assert ann.search(odd_vectors(spark, ODD[2:7]), "vec_id % 100 = 0").count() == 0
    assert ann.search(odd_vectors(spark, []), "vec_id % 100 = 0").count() == 0
    assert ann.search(odd_vectors(spark, ODD[:1]), "vec_id % 100 = 0").count() == 0


def plain_codes(rows, rounds=6):
    """Every distance, in Python's integers."""
    rows = sorted(((i, v, label) for i, v, label in rows if counts(v, True)), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    long = max((len(v) for _, v, _ in rows), key=lambda n: (sum(len(v) == n for _, v, _ in rows), n), default=0)
    rows = [r for r in rows if len(r[1]) == long]
    width = -(-long // 8)
    whole = [[math.floor(Fraction(x) * 4096) for x in v] + [0] * (8 * width - long) for _, v, _ in rows]
    parts = [[w[p * width : (p + 1) * width] for w in whole] for p in range(8)]
    books = [[list(x) for x in p[:16]] for p in parts]
    far = lambda x, c: sum((a - b) ** 2 for a, b in zip(x, c, strict=True))
    near = lambda p: [min((far(x, c), e) for e, c in enumerate(books[p])) for x in parts[p]]
    for _ in range(rounds if rows else 0):
        for p in range(8):
            got = [e for _, e in near(p)]
            for e in set(got):
                mine = [x for x, g in zip(parts[p], got, strict=True) if g == e]
                books[p][e] = [sum(c) // len(mine) for c in zip(*mine, strict=True)]
    last = [near(p) for p in range(8)]
    digest = hashlib.sha256(",".join(str(v) for p in books for c in p for v in c).encode()).hexdigest()
    return [(i, "".join(f"{last[p][k][1]:02x}" for p in range(8)), sum(last[p][k][0] for p in range(8)), label) for k, (i, _, label) in enumerate(rows)], digest


@pytest.mark.parametrize("rows", ["odd", "large", "few", "none", "real"])
def test_codes(spark, rows):
    rng = np.random.default_rng(5)
    many = [(i, [round(float(x), 2) for x in rng.normal(size=11)], i % 3 or None) for i in range(60)]
    given_ = {"odd": ODD, "large": [(i, [x * 1e9 for x in v], label) for i, v, label in many], "few": many[:5], "none": ODD[2:3], "real": [tuple(r) for r in table(spark, SF, "embeddings").collect()]}[rows]
    df = odd_vectors(spark, given_) if rows != "real" else table(spark, SF, "embeddings")
    coded, books = exponion.compress(df)
    want, digest = plain_codes(given_)
    order = lambda r: tuple((x is not None, x or 0) for x in r)
    got = sorted(((r["vec_id"], bytes(r["code"]).hex(), r["error"], r["label"]) for r in coded.collect()), key=order)
    assert got == sorted(((i, c, e if e < 2**63 else None, label) for i, c, e, label in want), key=order)
    assert not want or exponion.digest(books) == digest


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(-9, 9), st.integers(-9, 9)), min_size=1, max_size=40), st.lists(st.tuples(st.integers(-9, 9), st.integers(-9, 9)), min_size=1, max_size=16), st.randoms())
def test_search_finds_the_nearest_entry_from_any_start(points, entries, random):
    x, c = np.array(points, dtype=np.int64), np.array(entries, dtype=np.int64)
    start = np.array([random.randrange(len(entries)) for _ in points], dtype=np.int64)
    best, least = exponion.assign(x, c, start)
    far = ((x[:, None] - c[None]) ** 2).sum(2)
    assert best.tolist() == far.argmin(1).tolist() and least.tolist() == far.min(1).tolist()


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_manifest(rows):
    """{place: ...} of (doc_id, text, lang, source, n_chars) rows, each tree as a list of lists."""
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda d, t, lang, s, n: sha("".join(map(field, (d, s, lang, n, t))))
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))

    def tree(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            out.append([sha("".join(out[-1][i : i + 2])) for i in range(0, len(out[-1]), 2)])
        return out

    def beside(levels, at):
        for level in levels[:-1]:
            yield [(k < at, level[k]) for k in [at ^ 1] if k < len(level)], at
            at >>= 1

    trees = {x: sorted((r for r in rows if r[2] == x), key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r))) for x in langs}
    levels = {x: tree([leaf(*r) for r in trees[x]]) for x in langs}
    top = tree([levels[x][-1][0] for x in langs])
    out = []
    for at_top, x in enumerate(langs):
        for at, r in enumerate(trees[x]):
            claimed = leaf(*r[:4], r[4] + 1) if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[4] is not None else leaf(*r)
            siblings = [s for s, _ in [*beside(levels[x], at), *beside(top, at_top)]]
            folded = claimed
            for s in siblings:
                folded = sha((s[0][1] + folded) if s and s[0][0] else folded + (s[0][1] if s else ""))
            out.append((r[0], leaf(*r), levels[x][-1][0], top[-1][0], sha("".join(h for s in siblings for _, h in s)), folded, folded == top[-1][0]))
    return out


@pytest.mark.parametrize("block", [1, 3, 10])
def test_manifest_of_odd_rows(spark, tmp_path, monkeypatch, block):
    """Blocks of 2, 8 and 1024 leaves; with small ones the tree has blocks of many levels."""
    monkeypatch.setattr(merkle, "BLOCK", block)
    monkeypatch.setattr(merkle, "_paths", _with_block(merkle._paths, block))
    monkeypatch.setattr(merkle, "_roots", _with_block(merkle._roots, block))
    path = f"file://{tmp_path}"
    rows = [*brute.odd_rows(), *[(i, f"t{i}", "zz" if i % 5 else "en", None, 2**63 - 1 if i % 2 else i) for i in range(200, 240)]]
    spark.createDataFrame(rows, brute.DDL).selectExpr("*", "1 as tree", "2 as place", "3 as leaf", "4 as path", "5 as _n", "6 as claimed").write.parquet(f"{path}/documents.parquet")
    got = sorted(tuple(r) for r in merkle.query(spark, path).fillna(-1, ["doc_id"]).collect())
    assert got == sorted((-1 if r[0] is None else r[0], *r[1:]) for r in plain_manifest(rows))


def _with_block(f, block):
    """f for workers, which import the module anew."""

    def run(*tables):
        from folioflow.llm import merkle as there

        there.BLOCK = block
        try:
            return f(*tables)
        finally:
            there.BLOCK = 10

    run.__annotations__ = f.__annotations__
    return (lambda leaves: run(leaves)) if f.__name__ == "_roots" else (lambda leaves, upper: run(leaves, upper))


def test_manifest_of_one_and_of_no_document(spark, tmp_path):
    for n in (1, 0):
        path = f"file://{tmp_path}/{n}"
        rows = [(7, "one", None, "s", 3)][:n]
        spark.createDataFrame(rows, brute.DDL).write.parquet(f"{path}/documents.parquet")
        assert [tuple(r) for r in merkle.query(spark, path).collect()] == plain_manifest(rows)


@pytest.mark.parametrize("sub", [1, 2, 3, 5])
def test_traversal_needs_two_subtrees_a_level(sub, monkeypatch):
    leaves, top = [sha(str(i)) for i in range(200)], 8
    rows = [leaves]
    for _ in range(top):
        rows.append([sha("".join(rows[-1][i : i + 2])) for i in range(0, len(rows[-1]), 2)])
    steps = []
    monkeypatch.setattr(merkle.Stack, "step", lambda self, f=merkle.Stack.step: steps.append(len(self.open)) or f(self))
    for j, path in enumerate(merkle.paths(leaves, top, sub)):
        assert [p[1:] for p in path] == [rows[t][(j >> t) ^ 1] if (j >> t) ^ 1 < len(rows[t]) else "" for t in range(top)]
        if j:
            assert len(steps) <= 2 * -(-top // sub)  # two steps a level for each leaf that was passed
        steps.clear()


def test_a_changed_leaf_does_not_climb_to_the_root(spark):
    docs = table(spark, SF, "documents")
    made = merkle.manifest(docs, {"text": F.concat("text", F.lit(" "))}, F.col("doc_id") % 2 == 0)
    made = made.withColumn("ok", merkle.climbed("claimed", "path") == F.col("root"))
    assert {(r["even"], r["ok"]) for r in made.select((F.col("doc_id") % 2 == 0).alias("even"), "ok").distinct().collect()} == {(True, False), (False, True)}
