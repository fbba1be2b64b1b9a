"""Stores that outlive a batch: flags, year ids, answers, totals; files in several batches; the page source."""

import json
import os
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from folioflow.__main__ import main
from folioflow.operators import checks, ids, qa, years
from folioflow.operators import schemas as S
from folioflow.sources import enrich, flag_store, page_source, sinks
from folioflow.streaming import gather, incremental, progress


def flags(spark, ids_, note="x"):
    return sinks.shaped(spark.createDataFrame([(f"f{i % 3}", str(i), "kind", note) for i in ids_], "file_id string, speech_id string, failure_type string, diagnosis string"), S.FLAGS)


def test_a_filter_holds_its_keys_and_few_others():
    rng = np.random.default_rng(1)
    keys, others = rng.integers(0, 2**63, 5000).astype(np.uint64), rng.integers(0, 2**63, 50_000).astype(np.uint64)
    bits = flag_store.bloom(keys)
    assert flag_store.may_hold(bits, len(keys), keys).all() and flag_store.may_hold(bits, len(keys), others).sum() <= 1
    assert len(bits) == len(keys) * flag_store.BITS // 8


def test_a_batch_reads_only_parts_that_may_hold_its_keys(spark, tmp_path):
    path = f"file://{tmp_path}/flags"
    read = [len(flag_store.upsert(flags(spark, range(100 * n, 100 * n + 100)), path, n, buckets=4)) for n in range(4)]
    assert read == [0, 0, 0, 0]  # new keys open no part, however many batches there are
    again = flag_store.upsert(flags(spark, [5, 6, *range(1000, 1050)], "later"), path, 4, buckets=4)
    assert {n for _, n in again} == {0} and len(again) <= 2
    flag_store.upsert(flags(spark, range(200, 300), "again"), path, 2, buckets=4)
    got = flag_store.flags(spark, path)
    assert got.count() == got.select(*qa.KEY).distinct().count() == 450
    assert {r["batch_id"]: r["n"] for r in got.groupBy("batch_id").agg(F.count(F.lit(1)).alias("n")).collect()} == {0: 100, 1: 100, 2: 100, 3: 100, 4: 50}
    assert got.filter("diagnosis = 'later'").count() == 50
    assert flag_store.upsert(flags(spark, []), path, 9) == [] and flag_store.upsert(flags(spark, [5]).withColumn("speech_id", F.lit(None).cast("string")), path, 10, 4) == []


def test_year_ids_in_batches(spark, tmp_path):
    rng = random.Random(3)
    rows = [(f"f{i}", rng.choice([None, "", "2021-05-03", "2021-05-04", f"20{rng.randrange(20, 23)}-{rng.randrange(1, 13):02d}-11"]), rng.choice([None, "", "No 12", "7", "x"])) for i in range(300)]
    sessions = spark.createDataFrame(rows, "file_id string, session_date string, gaceta_number string")
    root = f"file://{tmp_path}/years"
    for part in (2, 0, 1, 0):
        years.add(sessions.filter(F.substring("file_id", 2, 9).cast("int") % 3 == part), root)
    want = {r["file_id"]: r["year_id"] for r in ids.year_ids(sessions, ["file_id"]).collect()}
    assert {r["file_id"]: r["year_id"] for r in years.numbers(spark, root).collect()} == want
    files = lambda: {p: os.stat(p).st_mtime_ns for d, _, names in os.walk(tmp_path / "years/ranks") for n in names if n.endswith("parquet") for p in [f"{d}/{n}"]}
    before = files()
    late = spark.createDataFrame([("late", "2021-01-01", "1")], "file_id string, session_date string, gaceta_number string")
    assert years.add(late, root) == [("2021", "2021-01")]
    after = files()
    changed = {p for p in before.keys() | after.keys() if before.get(p) != after.get(p)}
    assert changed and all("month=2021-01" in p for p in changed)  # only the session's own month is written
    want = {r["file_id"]: r["year_id"] for r in ids.year_ids(sessions.unionByName(late), ["file_id"]).collect()}
    assert {r["file_id"]: r["year_id"] for r in years.numbers(spark, root).collect()} == want
    assert years.add(late.limit(0), root) == [] and years.numbers(spark, f"{root}x").count() == 0


def counting(folder):
    """A service that leaves a file for each call."""

    def service(prompt):
        with open(f"{folder}/{time.monotonic_ns()}-{random.random()}", "w") as f:
            f.write(prompt)
        if "down" in prompt:
            raise ConnectionError
        return json.dumps({"gaceta_number": prompt})

    return service


def calls(folder):
    return sorted((folder / n).read_text() for n in os.listdir(folder))


def test_a_prompt_is_asked_once(spark, tmp_path):
    seen, root = tmp_path / "calls", f"file://{tmp_path}/store"
    seen.mkdir()
    texts = spark.createDataFrame([(f"f{i}", f"p{i % 7}" if i % 10 else None) for i in range(60)] + [("d", "down")], "file_id string, preamble_text string").repartition(5)
    for _ in range(2):
        got = {r["file_id"]: (r["answer"], r["error"]) for r in enrich.ask_once(texts, counting(str(seen)), root).collect()}
        assert got["f3"] == ('{"gaceta_number": "p3"}', None) and got["f10"] == ('{"gaceta_number": ""}', None) and got["d"] == (None, "unreachable") and len(got) == 61
    asked = calls(seen)
    assert [x for x in asked if x != "down"] == sorted(["", *(f"p{i}" for i in range(7))])  # repeated preambles and the second run ask nobody
    assert asked.count("down") == 2  # errors are not kept
    assert not (tmp_path / "store/pending").exists()


def test_a_task_that_is_run_again_asks_only_what_is_open(spark, tmp_path):
    """The first run is lost in the midst of its calls; the second asks for the rest."""
    seen, root = tmp_path / "calls", f"file://{tmp_path}/store"
    seen.mkdir()
    mark = tmp_path / "lost"
    texts = spark.createDataFrame([(f"f{i:02d}", f"p{i:02d}") for i in range(40)], "file_id string, preamble_text string").coalesce(1)
    service = counting(str(seen))

    def dying(rows):
        for n, row in enumerate(enrich_answered(*rows[0], **rows[1])):
            if n == 20 and not os.path.exists(mark):
                open(mark, "w").close()
                raise RuntimeError("executor lost")
            yield row

    enrich_answered = enrich.answered
    held = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        with pytest.MonkeyPatch.context() as m:
            m.setattr(enrich, "answered", lambda *a, **k: dying((a, k)))
            run = _frozen(enrich.ask_once, enrich)
            with pytest.raises(Exception, match="executor lost"):
                run(texts, service, root, window=4)
        got = enrich.ask_once(texts, service, root, window=4)
        assert got.filter("answer is not null").count() == 40
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", held)
    asked = calls(seen)
    assert set(asked) == {f"p{i:02d}" for i in range(40)} and len(asked) <= 40 + 4


def _frozen(f, module):
    """f with the module's names as they are now, sent to workers by value."""
    import types

    return types.FunctionType(f.__code__, dict(vars(module), __name__="__main__"), f.__name__, f.__defaults__, f.__closure__)


def test_calls_share_a_window(spark):
    """Eight calls of 0.2 s take far less than 1.6 s, and one that hangs holds up no other."""
    slow = lambda prompt: time.sleep(5 if prompt == "hang" else 0.2) or "{}"
    began = time.monotonic()
    got = list(enrich.answered([(str(i), "hang" if i == 3 else "x") for i in range(24)], slow, 8, 1.0))
    assert time.monotonic() - began < 3 and [g[2] for g in got] == [None] * 3 + ["unreachable"] + [None] * 20


def pages(spark, *files):
    rows = [(f, 1, "§Presidente:\nBuenos días.\n§Honorable Senador Luis Paz:\nGracias.", "ok", "single_column", None, None) for f in files]
    return spark.createDataFrame(rows, S.PAGES)


def test_totals_of_a_run_that_stops_midway(spark, tmp_path):
    source, root, state = (f"file://{tmp_path}/{x}" for x in ("pages", "out", "state"))
    for f in "ab":
        pages(spark, f).coalesce(1).write.mode("append").parquet(source)
    registered = sinks.session_numbers(spark.createDataFrame([(f,) for f in "abcd"], "file_id string"), f"{root}/session_ids")  # two of them have not come yet
    told = []
    listener = progress.Progress(spark, root, registered.count(), told.append)

    def stops(number, seen, count=listener.count):
        count(number, seen)
        if number == 1:
            raise RuntimeError("stopped")

    listener.count = stops
    with progress.listening(spark, listener):
        with pytest.raises(Exception, match="stopped"):
            incremental.run(spark, source, root, state, files=1, session_ids=registered, listener=listener).awaitTermination()
        time.sleep(1)
    assert [t["percent"] for t in told] == [25.0]
    total = progress.totals(spark, root, registered)
    assert (total["files"], total["done"], total["percent"], total["n_speeches"]) == (4, 2, 50.0, 4)
    again = progress.Progress(spark, root, registered.count(), told.append)
    with progress.listening(spark, again):
        incremental.run(spark, source, root, state, files=1, session_ids=registered, by_year=True, listener=again).awaitTermination()
        time.sleep(1)
    assert told[-1]["percent"] == 50.0 and progress.totals(spark, root, registered)["n_speeches"] == 4
    assert years.numbers(spark, f"{root}/years").count() == 1  # of the batch that was repeated


def test_registered_files_count_on_the_command_line(spark, tmp_path, capsys):
    (tmp_path / "in").mkdir()
    for name in "ab":
        (tmp_path / "in" / f"{name}.json").write_text(json.dumps([{"page_num": 1, "text": "§Presidente:\nUno.", "status": "ok", "column_layout": "single_column"}]))
    out = f"file://{tmp_path}/out"
    main(["--mode", "full", "--pages", f"file://{tmp_path}/in", "--out", out, "--batch-size", "1", "--year-ids"], spark)
    assert "'files': 2" in capsys.readouterr().out.strip().split("\n")[-1]
    (tmp_path / "in" / "c.json").write_text("[]")
    numbers = sinks.session_numbers(spark.createDataFrame([("c",)], "file_id string"), f"{out}/session_ids")
    assert progress.totals(spark, out, numbers)["percent"] == 66.7


@pytest.fixture
def stateful(spark):
    held = {k: spark.conf.get(k) for k in gather.SETTINGS}
    for k, v in gather.SETTINGS.items():
        spark.conf.set(k, v)
    yield
    for k, v in held.items():
        spark.conf.set(k, v)


def test_files_in_several_batches(spark, tmp_path, stateful):
    """Pages of a and b come in three batches, with a restart between; c never gets its second page."""
    source, out, state = (f"file://{tmp_path}/{x}" for x in ("loose", "out", "state"))
    page = lambda f, n, of, text="t": (f, n, f"{text}{n}", "ok", "single_column", None, None, of)

    def come(*rows):
        spark.createDataFrame(list(rows), gather.LOOSE).coalesce(1).write.mode("append").parquet(source)

    def run(wait=3_600_000):
        whole = gather.whole_files(gather.loose_pages(spark, source, 1), wait)
        whole.writeStream.format("parquet").option("path", out).option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination()
        found = {}
        for r in spark.read.schema(S.PAGES).parquet(out).orderBy("file_id", "page_num").collect():
            found.setdefault(r["file_id"], []).append((r["page_num"], r["text"], r["error_detail"]))
        return found

    come(page("a", 2, 3), page("b", 1, 2), page("c", 1, 2))
    assert run() == {}
    come(page("a", 1, None), page("b", 2, 2))
    assert run() == {"b": [(1, "t1", None), (2, "t2", None)]}
    come(page("a", 3, 3), page("a", 2, 3, "new"), page("b", 1, 2, "late"))
    assert run()["a"] == [(1, "t1", None), (2, "new2", None), (3, "t3", None)] and len(run()["b"]) == 2
    come(page("d", 1, 2))
    run(wait=1)
    time.sleep(0.1)
    come(page("e", 1, 1))
    got = run(wait=1)
    assert got["d"] == [(1, "t1", None), (2, "", gather.MISSING)] and got["e"] == [(1, "t1", None)] and "c" not in got


def test_page_source(spark, tmp_path):
    page_source.register(spark)
    folder = tmp_path / "in"
    folder.mkdir()
    page = lambda *texts: json.dumps([{"page_num": i, "text": t, "status": "ok", "column_layout": "single_column", "cid_word_pct": None} for i, t in enumerate(texts, 1)])
    (folder / "a (1).json").write_text(page("uno", "dos"))
    (folder / "b.json").write_text("[{")
    (folder / "c.json").write_text(page("tres"))
    (folder / "notes.txt").write_text("no")
    read = spark.read.format("folio_pages").option("path", f"file://{folder}").option("splitBytes", 10).load()
    assert read.rdd.getNumPartitions() == 3
    rows = {(r["file_id"], r["page_num"]): (r["text"], r["status"], (r["error_detail"] or "")[:17]) for r in read.collect()}
    assert rows == {("a (1)", 1): ("uno", "ok", ""), ("a (1)", 2): ("dos", "ok", ""), ("b", None): (None, "error", page_source.UNREADABLE), ("c", 1): ("tres", "ok", "")}
    assert spark.read.format("folio_pages").option("path", f"file://{folder}").load().rdd.getNumPartitions() == 1

    def run():
        stream = spark.readStream.format("folio_pages").option("path", f"file://{folder}").option("log", f"file://{tmp_path}/log").load()
        stream.writeStream.format("parquet").option("path", f"file://{tmp_path}/out").option("checkpointLocation", f"file://{tmp_path}/state").trigger(availableNow=True).start().awaitTermination()
        return sorted((r["file_id"], r["page_num"] or 0) for r in spark.read.schema(S.PAGES).parquet(f"file://{tmp_path}/out").collect())

    assert run() == [("a (1)", 1), ("a (1)", 2), ("b", 0), ("c", 1)]
    (folder / "0.json").write_text(page("old"))
    os.utime(folder / "0.json", (1, 1))  # older than all that was read
    assert run() == run() == [("0", 1), ("a (1)", 1), ("a (1)", 2), ("b", 0), ("c", 1)]


def test_report_slices(spark):
    rows = [(f"f{i % 9}", f"{i:04d}", "x" * 50 + (" Se levanta la sesión " if i % 2 else " nada ") + "y" * 50) for i in range(200)] + [("z", "0", None)]
    report = checks.leak_report(spark.createDataFrame(rows, "file_id string, speech_id string, speech_text string").withColumn("attribution_raw", F.lit("Ana")), checks.standing())
    got = {r["check"]: r for r in report.collect()}
    close = got["session close in text"]
    assert (close["verdict"], close["n"], close["n_files"]) == ("WARN", 100, 9) and [(x["file_id"], x["first_id"]) for x in close["slices"]] == [("f0", "0009"), ("f1", "0001"), ("f2", "0011"), ("f3", "0003"), ("f4", "0013")]
    assert [x["excerpt"] for x in close["slices"]] == ["x" * 39 + " Se levanta la sesión " + "y" * 39] * 3 + [None] * 2
    assert got["dash line in text"]["verdict"] == "PASS" and got["dash line in text"]["slices"] is None and len(got) == 5
    plan = checks.first_files(checks.leaks_by_file(spark.createDataFrame(rows, "file_id string, speech_id string, speech_text string"), checks.standing()[:3]), 5)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
