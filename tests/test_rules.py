"""Golden cases of the rules, one small transcript or page each."""

import re

import pytest
from pyspark.sql import functions as F

from folioflow.functions import rules as R
from folioflow.functions.text import decode, glyph, squash, strip, word_count
from folioflow.operators import checks, header, ids, layout, preamble, qa, segment, speakers


def turns(spark, *texts):
    pages = spark.createDataFrame([("f", i + 1, t, "ok") for i, t in enumerate(texts)], "file_id string, page_num int, text string, status string")
    return [r.asDict() for r in segment.turns(pages).orderBy("position_in_session").collect()]


def test_two_turns_and_their_flags(spark):
    got = turns(spark, "§Presidente:\nBuenos días.\n§Honorable Representante Ana Ruiz:\nGracias, señor Presidente.")
    assert [(t["position_in_session"], t["attribution_raw"], t["speech_text"], t["word_count"]) for t in got] == [(1, "Presidente", "Buenos días.", 2), (2, "Honorable Representante Ana Ruiz", "Gracias, señor Presidente.", 3)]
    flags = qa.turn_flags(spark.createDataFrame(got)).collect()
    assert [(f["speech_id"], f["failure_type"]) for f in flags] == [("f_002", "speech_too_short")]


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("§Honorable Re-\n§presentante Ana Ruiz:\nHola.", [("Honorable Representante Ana Ruiz", "Hola.")]),
        ("§Presidente:\nGracias. Se levanta la sesión. Adiós.", [("Presidente", "Gracias.")]),
        ("§Presidente:\nCon esto se da fin a la sesión", [("Presidente", "Con esto")]),
        ("§Presidente:\n(RECESO)\nContinuamos.\n§Secretario:\nSí.", [("Secretario", "Sí.")]),
        ("§Proyecto:\nUno.", []),
        ("§VOTACIÓN ACEPTACIÓN X:\nUno.", [("VOTACIÓN ACEPTACIÓN X", "Uno.")]),
        ("Presidenta:\nHola.", []),
        ("PRESIDENTE:\nHola.", [("PRESIDENTE", "Hola.")]),
        ("§La Presidencia otorga el uso de la palabra al doctor Luis Paz, quien manifiesta:\nHola.", [("La Presidencia otorga el uso de la palabra al doctor Luis Paz, quien manifiesta", "Hola.")]),
        ("§Presidente:\nUno.\n- Leída el Acta\nDos.", [("Presidente", "Uno.\n\nDos.")]),
        ("§" + "(cid:40)" * 3 + ":\nHola.", [("[CID_ATTRIBUTION]", "Hola.")]),
        ("", []),
    ],
)
def test_segmentation(spark, text, want):
    assert [(t["attribution_raw"], t["speech_text"]) for t in turns(spark, text)] == want


def test_votes_continuation_and_chair(spark):
    got = turns(spark, "§Secretario:\n" + "Vota sí\n" * 3 + "§Secretaria:\n" + "Vota no\n" * 2 + "§Ana Ruiz Continúa con el uso de la palabra:\nHola.\n§Preside la sesión el honorable Luis Paz:\nHola.")
    assert [t["record_type"] for t in got] == ["vote_tally", "speech", "speech"]
    assert [t["is_continuation"] for t in got] == [False, False, True]


def test_decomposed_letters_and_pages(spark):
    got = turns(spark, "§Secretario:\nsesio\u0301n", "ordinaria")
    assert [t["speech_text"] for t in got] == ["sesión\n\n\nordinaria"]


def test_positions_pass_999(spark):
    got = turns(spark, "\n".join("§Presidente:\nHola." for _ in range(1001)))
    assert got[-1]["speech_id"] == "f_1001"


def test_accepted_starts_lie_outside_earlier_matches():
    text = "§Honorable Senador Luis Paz:\nEl honorable Senador Luis Paz manifiesta: sí.\nSenador Luis Paz:\nno.\n"
    found = sorted(segment.boundaries(text))
    for i, (_, pos, _, _) in enumerate(found):
        assert not any(p <= pos < e for _, p, e, _ in found[:i])


def test_every_rule_compiles_with_one_attribution_group():
    assert len(R.BOUNDARIES) == 23
    assert all(re.compile(r.pattern).groups == 1 for r in R.BOUNDARIES)


def test_glyphs():
    assert decode("(cid:40)(cid:79)(cid:3)") == "El "
    assert decode("(cid:112)") == "é"
    assert decode("(cid:29)") == ":"
    assert decode("(cid:4)") == "(cid:4)"
    assert glyph(10**7) is None


def test_text_helpers(spark):
    row = spark.range(1).select(strip(F.lit(" \u00a0a b\u3000")), squash(F.lit("a\u00a0 b\n")), word_count(F.lit("")), word_count(F.lit("a\u2003b c"))).first()
    assert tuple(row) == ("a b", "a b", 0, 3)


def test_claims_are_recursive():
    """What starts inside an accepted match takes nothing from later ones."""
    text = "§Senador Luis Paz, tiene la palabra el honorable Senador Eva Gil:\nSenador Luis Paz Gil:\nno.\n"
    assert [b[3] for b in segment.boundaries(text)] == ["Senador Luis Paz, tiene la palabra el honorable Senador Eva Gil", "Senador Luis Paz Gil"]


def words(spark, rows):
    ddl = "file_id string, page_num int, word_seq int, text string, x0 double, top double, size double, fontname string, color_kind string, color array<double>, page_w double, page_h double"
    full = [("f", r.get("page", 2), i, r["text"], float(r.get("x", 60 + 10 * i)), float(r.get("top", 300)), 10.0, r.get("font", "Times"), r.get("kind"), r.get("color"), 609.4, 963.8) for i, r in enumerate(rows)]
    return spark.createDataFrame(full, ddl)


def page(spark, rows):
    return layout.pages(words(spark, rows)).first()


def test_lines_are_anchored(spark):
    got = page(spark, [{"text": str(i), "top": 300 + t} for i, t in enumerate((10, 12, 14, 16, 30))])
    assert got["text"] == "0 1\n2 3\n4"


def test_columns(spark):
    assert page(spark, [{"text": "w", "x": 400, "top": 100 + 10 * i} for i in range(9)])["column_layout"] == "single_column"
    assert page(spark, [{"text": "w", "x": 400, "top": 100 + 10 * i} for i in range(10)])["column_layout"] == "two_column"


def test_scanned_share(spark):
    coded = lambda n: page(spark, [{"text": "(cid:1)" if i < n else "w"} for i in range(10)])["status"]
    assert (coded(3), coded(4)) == ("ok", "scanned")


def test_white_bold_header_and_footer(spark):
    got = page(spark, [
        {"text": "gone", "kind": "tuple", "color": [1.0, 1.0, 1.0]}, {"text": "stays", "kind": "tuple", "color": [1.0]}, {"text": "faint", "kind": "float", "color": [0.95], "top": 320},
        {"text": "top", "top": 80}, {"text": "Bold", "font": "X-BoldMT", "top": 340}, {"text": "IMPRENTA", "top": 900}, {"text": "NACIONAL", "top": 901},
    ])
    assert got["text"] == "stays\n§Bold"


def test_empty_and_error_pages(spark):
    known = spark.createDataFrame([("f", 7, "bad"), ("f", 8, None)], "file_id string, page_num int, error_detail string")
    got = {r["page_num"]: r["status"] for r in layout.pages(words(spark, [{"text": "x", "top": 10}]), known).collect()}
    assert got == {2: "empty", 7: "error", 8: "empty"}


@pytest.mark.parametrize(("texts", "want"), [(["a", "tiene el uso de la palabra", "b"], (2, "floor_grant_pattern")), (["a", "b", "c"], (2, "fallback_page_2")), (["a"], (1, "fallback_page_2")), ([], (None, "no_extractable_text")), (["Registro manual\nPresidente:", "x", "Presidente:"], (3, "floor_grant_pattern")), (["§Presidente:", "b"], (2, "fallback_page_2"))])
def test_start_pages(spark, texts, want):
    rows = [("f", i + 1, t, "ok") for i, t in enumerate(texts)] + [("f", 99, "", "scanned")]
    got = preamble.start_pages(spark.createDataFrame(rows, "file_id string, page_num int, text string, status string")).first()
    assert (got["transcript_start_page"], got["detection_method"]) == want


def test_header(spark):
    text = "Gaceta No 12\nNº 12\n5 de marzo de 2021 y 31 de febrero de 2021, Cámara de Representantes\nCOMISIÓN PRIMERA CONSTITUCIONAL:\nACTA NÚMERO 3"
    got = header.by_rule(spark.createDataFrame([("f", text)], "file_id string, preamble_text string")).first()
    assert (got["publication_date"], got["session_date"], got["chamber"], got["document_type"]) == ("2021-03-05", "2021-02-31", "camara", "session_transcript")
    assert got["committee"] == "COMISIÓN PRIMERA CONSTITUCIONAL"


def test_service_answers(spark):
    texts = spark.createDataFrame([(x, "5 de mayo de 2020") for x in "abcd"], "file_id string, preamble_text string")
    answers = spark.createDataFrame([("a", '<think>x</think>```json\n{"chamber": "senado"}\n```', None), ("b", None, "unreachable"), ("c", "no", None)], "file_id string, answer string, error string")
    got = {r["file_id"]: (r["extraction_status"], r["chamber"], r["publication_date"]) for r in header.with_service(texts, answers).collect()}
    assert got == {"a": ("llm", "senado", None), "b": ("rule_based_ollama_unreachable", None, "2020-05-05"), "c": ("rule_based_error:JSONDecodeError", None, "2020-05-05"), "d": ("rule_based", None, "2020-05-05")}


def test_confidence(spark):
    low = lambda *c: spark.range(1).select(header.lowest_confidence(*(F.lit(x).cast("string") for x in c))).first()[0]
    assert (low("high", "low", None), low(None, ""), low("odd", "medium")) == ("low", "unknown", "medium")


def test_year_ids(spark):
    rows = [("a", "2021-03-05", "12"), ("b", "2021-03-05", "9"), ("c", None, "7")]
    got = ids.year_ids(spark.createDataFrame(rows, "file_id string, session_date string, gaceta_number string"), ["file_id"])
    assert {r["file_id"]: r["year_id"] for r in got.collect()} == {"a": "2021_0002", "b": "2021_0001", "c": "0000_0001"}


def test_runs_break_at_continuations(spark):
    rows = [("f", f"f_{i}", i, "A", "uno dos " * 20, 40, i == 3, "0.9") for i in range(1, 7)]
    got = qa.turn_flags(spark.createDataFrame(rows, "file_id string, speech_id string, position_in_session int, attribution_raw string, speech_text string, word_count int, is_continuation boolean, rule_version string"))
    assert [(r["speech_id"], r["original_excerpt"].split()[-2]) for r in got.orderBy("speech_id").collect()] == [("f_5", "3x"), ("f_6", "4x")]


def test_new_flags(spark):
    ddl = "file_id string, speech_id string, failure_type string"
    got = qa.new_flags(spark.createDataFrame([("f", "s", "too_long")] * 2 + [("f", "s", "too_short")], ddl), spark.createDataFrame([("f", "s", "too_long")], ddl))
    assert [tuple(r) for r in got.collect()] == [("f", "s", "too_short")]


def test_checks(spark):
    speeches = spark.createDataFrame([("f", "f_1", "Ana, quien manifiesta", "x 12 de marzo de 2021 Gaceta 5")], "file_id string, speech_id string, attribution_raw string, speech_text string")
    sessions = spark.createDataFrame([("f", "2020-10-23"), ("g", None)], "file_id string, session_date string")
    golden = spark.createDataFrame([("f", "2020-10-23"), ("g", None), ("h", "2020-01-01")], "file_id string, expected string")
    got = {r["check"]: r["verdict"] for r in checks.suite(speeches, sessions, golden=golden).collect()}
    assert got["running header in text"] == got["trailing verb in speaker"] == got["year_id populated"] == "FAIL"
    assert got["session close in text"] == got["act_number absent from speeches"] == "PASS"
    assert [got[f"session_date of {x}"] for x in "fgh"] == ["PASS", "PASS", "FAIL"]


def test_speaker_kinds(spark):
    rows = [("Honorable Senadora Eva Sanz", "legislator"), ("La señora Ministra de Minas", "minister"), ("doctor Luis Paz, Ministro del Interior", "minister"), ("Secretaria", "role"), ("El señor Presidente", "role"), ("ciudadano Luis Paz", "citizen"), ("Luis Paz", "uncertain"), ("Honorable Senador 5", "uncertain"), (None, "uncertain")]
    got = speakers.classified(spark.createDataFrame(rows, "attribution_raw string, want string"))
    assert got.filter("speaker_type <> want").isEmpty()
