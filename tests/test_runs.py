"""Whole runs: calibration, sinks, restart of the stream."""

import json
import time

import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from folioflow import queries
from folioflow.__main__ import main
from folioflow.operators import layout, preamble, segment
from folioflow.operators import schemas as S
from folioflow.plans import corpus
from folioflow.sources import enrich, readers, sinks
from folioflow.streaming import incremental


def pages(spark, *files):
    rows = []
    for f in files:
        rows += [(f, 1, f"Gaceta N° {len(f)}\n5 de marzo de 2021\n6 de marzo de 2021", "ok", "single_column", None, None), (f, 2, "§Presidente:\nBuenos días.\n§Honorable Senador Luis Paz:\nGracias.", "ok", "single_column", None, None), (f, 3, "", "scanned", "single_column", None, 0.5)]
    return spark.createDataFrame(rows, S.PAGES)


def test_calibration_writes_all_sinks_and_is_idempotent(spark, tmp_path):
    root = f"file://{tmp_path}/out"
    skipped = spark.createDataFrame([("z", 1, "", "scanned", "single_column", None, 0.9)], S.PAGES)
    for _ in range(2):
        corpus.calibrate(pages(spark, "a", "bb").unionByName(skipped), root)
        speeches, sessions = spark.read.parquet(f"{root}/speeches"), spark.read.parquet(f"{root}/sessions")
        assert sorted(r["speech_id"] for r in speeches.collect()) == ["2021_0001_001", "2021_0001_002", "2021_0002_001", "2021_0002_002"]
        assert {r["file_id"]: (r["n_speeches"], r["n_flagged"], r["n_pages_scanned"]) for r in sessions.collect()} == {"a": (2, 3, 1), "bb": (2, 3, 1)}
        assert {r["status"] for r in spark.read.parquet(f"{root}/log").collect()} == {"done", "skipped_all_scanned"}
    flags = spark.read.parquet(f"{root}/flagged")
    assert flags.filter("failure_type = 'scanned_pages_present'").first()["diagnosis"] == "Scanned pages: [3]"
    sinks.upsert_flags(flags.cache(), f"{root}/flagged")
    assert spark.read.parquet(f"{root}/flagged").count() == 6
    state = corpus.manifest(spark, root)
    assert {r["file_id"]: r["status"] for r in state.collect()} == {"a": "done", "bb": "done", "z": "skipped_all_scanned"}
    total = corpus.totals(state, state.select("file_id")).first()
    assert (total["done"], total["skipped"], total["percent"]) == (2, 1, 100.0)


def test_csv_round_trip(spark, tmp_path):
    made = corpus.build(pages(spark, "a"))
    sinks.export_csv(made.speeches, f"file://{tmp_path}/csv", S.SPEECHES)
    back = readers.table_csv(spark, f"file://{tmp_path}/csv", S.SPEECHES)
    assert sorted(r["speech_text"] for r in back.collect()) == sorted(r["speech_text"] for r in made.speeches.collect())


def test_page_json(spark, tmp_path):
    (tmp_path / "acta 88 (6).json").write_text(json.dumps([{"page_num": 1, "text": "x", "status": "ok", "column_layout": "single_column"}]))
    row = readers.page_json(spark, f"file://{tmp_path}").first()
    assert (row["file_id"], row["text"], row["cid_word_pct"]) == ("acta 88 (6)", "x", None)


def test_scanned_log(spark):
    log = spark.createDataFrame([("f", "3"), ("f", "x"), ("f", "1"), ("f", "3")], "file_id string, page_num string")
    assert readers.scanned_before(log).first()["scanned"] == [1, 3, 3]


def test_command_line(spark, tmp_path):
    (tmp_path / "in").mkdir()
    text = "§Presidente:\nBuenos días.\n§Honorable Senador Luis Paz:\nGracias."
    for name in ("a", "b"):
        (tmp_path / "in" / f"{name}.json").write_text(json.dumps([{"page_num": 1, "text": text, "status": "ok", "column_layout": "single_column"}]))
    for mode in ("calibration", "full"):
        out = f"file://{tmp_path}/{mode}"
        main(["--mode", mode, "--pages", f"file://{tmp_path}/in", "--out", out, "--batch-size", "1"], spark)
        assert spark.read.parquet(f"{out}/speeches").count() == 4
    assert sorted(r["speech_id"] for r in spark.read.parquet(f"{out}/speeches").collect()) == ["1_001", "1_002", "2_001", "2_002"]


def test_conversion(spark, tmp_path, capsys):
    words = spark.createDataFrame([("f", 1, i, w, 60.0 + 40 * i, 300.0, 10.0, "Times", None, None, 609.4, 963.8) for i, w in enumerate(("hola", "mundo"))], S.WORDS)
    words.write.parquet(f"file://{tmp_path}/words")
    main(["--mode", "convert", "--pages", f"file://{tmp_path}/words", "--out", "-", "--summary"], spark)
    first, second = capsys.readouterr().out.strip().split("\n")
    assert json.loads(first)["text"] == "hola mundo" and second == "f: 1 pages, 1 ok, 0 scanned, 0 empty, 0 error, 0 two-column"


def test_a_bad_file_fails_alone(spark, tmp_path, monkeypatch):
    """Of three files one is no array of pages and one cannot be cut: both are logged as failed, with the reason, and the third is done."""
    folder = tmp_path / "in"
    folder.mkdir()
    page = lambda text: json.dumps([{"page_num": 1, "text": text, "status": "ok", "column_layout": "single_column"}])
    (folder / "a.json").write_text(page("§Presidente:\nBuenos días."))
    (folder / "b.json").write_text("[{")
    (folder / "c.json").write_text(page("§Presidente:\nveneno"))

    def poisoned(text, cut=segment.cut):
        if "veneno" in text:
            raise ValueError("veneno " * 200)
        return cut(text)

    monkeypatch.setattr(segment, "cut_file", F.pandas_udf(_one_by_one(poisoned), segment.CUT))
    out = f"file://{tmp_path}/out"
    main(["--mode", "full", "--pages", f"file://{folder}", "--out", out], spark)
    log = {r["file_id"]: r for r in spark.read.parquet(f"{out}/log").collect()}
    assert {k: r["status"] for k, r in log.items()} == {"a": "done", "b": "failed", "c": "failed"}
    assert log["b"]["error_detail"] == corpus.UNREADABLE and log["c"]["error_detail"].startswith("ValueError: veneno") and len(log["c"]["error_detail"]) == 500
    assert [r["file_id"] for r in spark.read.parquet(f"{out}/sessions").collect()] == ["a"]
    total = corpus.totals(*[corpus.manifest(spark, out)] * 2).first()
    assert (total["done"], total["failed"]) == (1, 2)


def _one_by_one(cut):
    def run(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for t in texts:
            try:
                rows.append((cut(t or ""), None))
            except Exception as e:  # noqa: BLE001
                rows.append((None, f"{type(e).__name__}: {e}"[:500]))
        return pd.DataFrame(rows, columns=["turns", "error"])

    return run


def test_one_scan_and_one_shuffle_by_page_and_by_file(spark, tmp_path):
    spark.createDataFrame([], S.WORDS).write.parquet(f"file://{tmp_path}/words")
    plan = layout.pages(spark.read.schema(S.WORDS).parquet(f"file://{tmp_path}/words"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1
    spark.createDataFrame([], S.PAGES).write.parquet(f"file://{tmp_path}/pages")
    held = preamble.with_starts(preamble.gathered(spark.read.schema(S.PAGES).parquet(f"file://{tmp_path}/pages")))
    plan = held.select("file_id", preamble.preamble_text(), preamble.transcript_text())._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1


def test_flags_of_an_earlier_batch_are_not_written_again(spark, tmp_path):
    root = f"file://{tmp_path}/out"
    for number in (0, 1):
        incremental.write_batch(pages(spark, "a"), number, root)
    flags = spark.read.parquet(f"{root}/flagged")
    assert flags.count() == flags.dropDuplicates(["file_id", "speech_id", "failure_type"]).count() > 0


def test_service_back_ends(spark):
    assert enrich.chosen({}) is None and enrich.chosen({"x": len}, "x") is len
    slow = lambda prompt: time.sleep(3) or "{}"
    texts = spark.createDataFrame([("a", "x")], "file_id string, preamble_text string")
    assert [(r["answer"], r["error"]) for r in enrich.ask(texts, slow, timeout=0.1).collect()] == [(None, "unreachable")]


def test_pdf_plug_in(spark, tmp_path):
    (tmp_path / "a.pdf").write_bytes(b"good")
    (tmp_path / "b.pdf").write_bytes(b"bad")

    def extract(content):
        if content == b"bad":
            raise ValueError("no pdf")
        return [{"page_num": 1, "word_seq": 0, "text": "hola", "x0": 60.0, "top": 300.0}]

    words, errors = readers.words_of_pdf(spark, f"file://{tmp_path}", extract)
    assert [(r["file_id"], r["text"]) for r in words.collect()] == [("a", "hola")]
    assert [(r["file_id"], r["page_num"], r["error_detail"]) for r in errors.collect()] == [("b", 0, "ValueError: no pdf")]


def test_service_retries_only_what_is_no_json(spark):
    def service(prompt):
        if "down" in prompt:
            raise ConnectionError
        return "{}" if "ok" in prompt else "words"

    texts = spark.createDataFrame([("a", "ok"), ("b", "down"), ("c", "x")], "file_id string, preamble_text string")
    assert {r["file_id"]: (r["answer"], r["error"]) for r in enrich.ask(texts, service).collect()} == {"a": ("{}", None), "b": (None, "unreachable"), "c": ("words", None)}


def test_stream_resumes_where_it_ended(spark, tmp_path):
    source, root, state = (f"file://{tmp_path}/{x}" for x in ("pages", "out", "state"))
    pages(spark, "a").coalesce(1).write.mode("append").parquet(source)
    incremental.run(spark, source, root, state, files=1).awaitTermination()
    pages(spark, "b", "c").coalesce(1).write.mode("append").parquet(source)
    for _ in range(2):
        incremental.run(spark, source, root, state, files=1).awaitTermination()
    got = spark.read.parquet(f"{root}/speeches")
    assert sorted((r["file_id"], r["position_in_session"]) for r in got.collect()) == [(f, i) for f in "abc" for i in (1, 2)]
    incremental.write_batch(pages(spark, "b", "c"), 1, root)
    assert spark.read.parquet(f"{root}/speeches").count() == 6


def _batch(words):
    """Packed input of layout: (file_id, page_num, top, x0, seq, text, flags) by word."""
    columns = zip(*words, strict=True)
    return pa.record_batch([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int32(), pa.float64(), pa.float64(), pa.float64(), pa.string(), pa.int8()), strict=True)], ["file_id", "page_num", "top", "x0", "seq", "text", "flags"])


def test_words_are_packed_before_the_shuffle(spark, tmp_path):
    """column_layout, scan_ratio: what a page's words cost in the shuffle is about their text, not a row with all their places for each."""
    docs = [(d, " ".join(f"palabra{(i * 7919 + d) % 1000}" for i in range(400)), "es", "s", 1) for d in range(40)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"file://{tmp_path}/documents.parquet")
    store = spark.sparkContext._jsc.sc().statusStore()

    def shuffled():
        stages = store.stageList(None, False, False, spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.double, 0), spark.sparkContext._jvm.java.util.ArrayList())
        return sum(stages.apply(i).shuffleWriteBytes() for i in range(stages.size()))

    for name in ("column_layout", "scan_ratio"):
        before = shuffled()
        assert queries.QUERIES[name](spark, f"file://{tmp_path}").count() == 40
        assert 0 < shuffled() - before < sum(len(d[1]) for d in docs)


def test_blocks_of_a_page_from_several_batches(monkeypatch):
    """Words of two pages and of a page without a name, mixed, with texts of all kinds: every word comes back with its numbers, whatever the task holds at a time."""
    visible = layout.SEEN | layout.BODY | layout.FULL
    words = [(f, p, 200.5 + i, -1.25 * i, float(i), t * (i % 5), visible if i % 3 else layout.SEEN | layout.CODED) for i in range(60) for f, p, t in (("a", 1, "ñandú€𝄞"), ("a", 2, "x"), (None, None, "é"))]
    for held in (1, 50, 1000):
        monkeypatch.setattr(layout, "HELD_WORDS", held)
        rows = [r for b in layout._packed(_batch(words[i : i + 25]) for i in range(0, len(words), 25)) for r in b.to_pylist()]
        for page in {w[:2] for w in words}:
            mine = [r for r in rows if (r["file_id"], r["page_num"]) == page]
            got = [(*n, t) for r in mine if r["block"] for n, t in zip(layout._unpack(r["block"])[0].tolist(), layout._unpack(r["block"])[2], strict=True)]
            assert got == [w[2:6] for w in words if w[:2] == page and w[6] == visible]
            assert (sum(r["n_seen"] for r in mine), sum(r["n_coded"] for r in mine)) == (60, 20)


def test_large_pages_are_given_out_a_few_at_a_time():
    """page_furniture: a batch of 400 pages, each one word of 50,000 characters, is never held as texts all at once, and none is lost or moved."""
    visible = layout.SEEN | layout.BODY | layout.FULL
    packed = [b for b in layout._packed(_batch([("a", i, 400.0, 60.0, 0.0, f"{i} " + "largo " * 8333, visible)]) for i in range(400))]
    assert len(packed) > 1  # a task does not hold all words either
    rows = [r for b in packed for r in b.to_pylist()]
    batch = pa.record_batch([pa.array([r["file_id"] for r in rows]), pa.array([r["page_num"] for r in rows], pa.int32()), pa.array([0.0] * 400), pa.array([[r["block"]] for r in rows], pa.list_(pa.binary()))], ["file_id", "page_num", "cid_word_pct", "blocks"])
    made = list(layout._pages([batch, batch.slice(0, 0)]))
    assert max(b.nbytes for b in made) < 3 << 20 and sum(b.num_rows for b in made) == 400
    assert all(r["text"].startswith(f"{r['page_num']} largo") and r["error_detail"] is None for b in made for r in b.to_pylist())
