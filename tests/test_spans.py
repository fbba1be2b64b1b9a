"""As-of carry-forward, chairs, versions of rules and running lines against plain versions."""

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from folioflow.operators import asof, chairs, header, running, segment, versions


@pytest.mark.parametrize("parts", [1, 3, 16])
def test_carried_forward(spark, parts):
    """A key with most of the rows spans many ranges; some ranges of it have no value of their own."""
    rng = random.Random(parts)
    rows = [(rng.choice(["hot"] * 8 + ["a", "b", None]), i, rng.choice([None] * 60 + ["x", "y"]), rng.choice([None, 7]) if i % 200 == 0 else None) for i in range(3000)]
    rng.shuffle(rows)
    got = asof.carried(spark.createDataFrame(rows, "k string, at int, v string, w int"), ["k"], ["at"], {"last_v": "v", "last_w": "w"}, parts)
    last, want = defaultdict(lambda: [None, None]), []
    for k, at, v, w in sorted(rows, key=lambda r: r[1]):
        want.append((k, at, v, w, *last[k]))
        last[k] = [x if x is not None else old for x, old in zip((v, w), last[k], strict=True)]
    assert sorted(map(tuple, got.collect()), key=lambda r: r[1]) == want
    assert asof.carried(got.select("k", "at", "v").limit(0), ["k"], ["at"], {"x": "v"}, parts).count() == 0


def cuts(spark, files, **how):
    return segment.with_cuts(spark.createDataFrame(files, "file_id string, text string"), **how)


def test_chairs(spark):
    text = "\n".join(["§Presidente:\nUno.", "§Asume la Presidencia el honorable Senador Luis Paz:\nNada.", "§Presidenta:\nDos.\nPreside la sesión la honorable Representante Ana de la Cruz Gil\nTres.", "§ Presidente :\nCuatro.", "§Secretario:\nCinco.", "§Asume la Presidencia quien sigue:\nNada.", "§Presidente:\nSeis.", "§Honorable Senadora Eva Sanz:\nSiete.", "§Ana 2 Ruiz:\nOcho."])
    officers = header.officers(spark.createDataFrame([("f", "ACTA\nPresidente: honorable Senador Juan Mora\nSecretaria General, doctora Rosa Luz\n"), ("g", None)], "file_id string, preamble_text string"))
    assert {r["file_id"]: (r["presiding_officer"], r["secretary"]) for r in officers.collect()} == {"f": ("Juan Mora", "Rosa Luz"), "g": (None, None)}
    files = [("f", text), ("g", text), ("h", "§Presidente:\nUno."), ("i", None)]
    got = {f: [] for f, _ in files}
    for r in chairs.resolved(cuts(spark, files, context=5), officers).orderBy("file_id", "position_in_session").collect():
        got[r["file_id"]].append((r["speaker_type"], r["speaker_name"], r["uncertain_context"]))
    first = lambda who: ("legislator", who, None)
    rest = [first("Luis Paz"), first("Ana de la Cruz Gil")]
    tail = [("uncertain", None, "ada.\n§Presidente:\nSeis"), ("legislator", None, None), ("uncertain", None, "ete.\n§Ana 2 Ruiz:\nOcho")]
    assert got["f"] == [first("Juan Mora"), *rest, ("role", "Rosa Luz", None), *tail]
    assert got["g"] == [("uncertain", None, "§Presidente:\nUno."), *rest, ("role", None, None), *tail]
    assert got["h"] == [("uncertain", None, "§Presidente:\nUno.")] and got["i"] == []
    assert [t["position_in_session"] for t in segment.turns_of(cuts(spark, files[:1])).orderBy("position_in_session").collect()] == list(range(1, 8))


def test_each_rule_runs_once_over_a_text(spark):
    """Turns are cleaned where they are cut: no pattern is left in the plan, and no shuffle numbers them."""
    plan = segment.turns_of(cuts(spark, [("f", "§Presidente:\nUno.")]))._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp" not in plan.lower() and "Window" not in plan
    answers = spark.createDataFrame([("f", "{}", None)], "file_id string, answer string, error string")
    texts = spark.createDataFrame([("f", "x")], "file_id string, preamble_text string")
    plan = header.with_service(texts, answers)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("de\\s+(\\d{4})") == 1 and plan.count("<think>") == 1


def spans(rng, n):
    at, out = 0, []
    for i in range(n):
        start = at + rng.choice([0, 0, 1, 3])
        at = start + rng.choice([0, 1, 2, 5])
        out.append((i, start, at))
    return out


def test_versions_against_all_pairs(spark):
    rng = random.Random(5)
    sides = {s: [(f"f{f}", *x) for f, n in (("0", 300), ("1", 20), ("2", 0 if s == "old" else 9), ("3", 40)) for x in spans(rng, n)] for s in ("old", "new")}
    sides["new"] += [("same", i, i * 5, i * 5 + 5) for i in range(9)]
    sides["old"] += [("same", i, i * 5, i * 5 + 5) for i in range(9)]
    got = {(r["file_id"], r["side"], r["number"]): (r["n_others"], r["outcome"]) for r in versions.compared(*(spark.createDataFrame(sides[s], "file_id string, number int, start int, end int") for s in ("old", "new"))).collect()}
    meet = [(a, b) for a in sides["old"] for b in sides["new"] if a[0] == b[0] and max(a[2], b[2]) < min(a[3], b[3])]
    n = Counter(("old", a[0], a[1]) for a, _ in meet) + Counter(("new", b[0], b[1]) for _, b in meet)
    want = {}
    for side, i in (("old", 0), ("new", 1)):
        other = ("new", "old")[i]
        for s in sides[side]:
            mine = [p for p in meet if p[i] == s]
            most = max((n[other, p[1 - i][0], p[1 - i][1]] for p in mine), default=0)
            kind = ("lost", "new")[i] if not mine else "same" if len(mine) == most == 1 and s[2:] == mine[0][1 - i][2:] else "split" if most == 1 and len(mine) > 1 else "merged" if len(mine) == 1 and most > 1 else "moved"
            want[s[0], side, s[1]] = (len(mine), kind)
    assert got == want and {k for _, k in want.values()} == {"lost", "new", "same", "split", "merged", "moved"}


def plain_running(pages, share=0.5, least=3, depth=2):
    key = lambda x: re.sub("[0-9]+", "#", " ".join(x.split()))
    at, of = Counter(), Counter(f for f, _, _, status in pages if status == "ok")

    def edges(text):
        full = [(i, key(x)) for i, x in enumerate((text or "").split("\n")) if key(x)]
        return [(p, *full[p - 1 if p > 0 else p]) for p in (*range(1, depth + 1), *range(-depth, 0)) if len(full) >= abs(p)]

    for f, _, text, status in pages:
        at.update((f, p, line) for p, _, line in edges(text) if status == "ok")
    out = []
    for f, number, text, status in pages:
        gone = {i for p, i, line in edges(text) if status == "ok" and at[f, p, line] >= max(least, share * of[f])}
        out.append((f, number, "\n".join(x for i, x in enumerate((text or "").split("\n")) if i not in gone), len(gone)))
    return out


@pytest.mark.parametrize("share", [0.5, 0.2])
def test_running_lines(spark, share):
    rng = random.Random(8)
    pages = []
    for f, n in (("hot", 400), ("b", 12), ("c", 2), (None, 5)):
        for i in range(n):
            body = [f"line {rng.randrange(10**6)} of text" if rng.random() < 0.9 else "the same" for _ in range(rng.randrange(6))]
            head = ["GACETA  DEL CONGRESO", f"  page {i} "] if rng.random() < 0.7 else [""]
            pages.append((f, i, "\n".join([*head, *body, *([f"- {i} -", ""] if rng.random() < 0.25 else [])]) if rng.random() < 0.95 else None, rng.choice(["ok"] * 9 + ["scanned"])))
    df = spark.createDataFrame(pages, "file_id string, page_num int, text string, status string").repartition(7)
    got = running.without(df, share).select("file_id", "page_num", "text", "n_suppressed").collect()
    known = [p for p in pages if p[0] is not None]
    assert sorted((tuple(r) for r in got if r["file_id"] is not None)) == sorted(plain_running(known, share))
    assert sum(r["n_suppressed"] for r in got) > 300
    assert running.without(df.limit(0)).count() == 0


def test_a_summary_keeps_every_frequent_line(spark):
    """However the rows are dealt out, lines on more than one in cells + 1 rows stay, and no more than `cells` lines of a key do."""
    rng = random.Random(4)
    rows = [("f", 1, rng.choice(["a", "b", f"x{i}", f"y{i}", f"z{i}"])) for i in range(5000)]
    for parts in (1, 5, 40):
        got = [r["line"] for r in running.candidates(spark.createDataFrame(rows, "file_id string, place int, line string").repartition(parts), 6).collect()]
        assert {"a", "b"} <= set(got) and len(got) <= 6
