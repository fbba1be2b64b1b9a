"""Queries over the driver's tables, with the same in SQL.

Rules need transcripts, and the tables have none: `rendered` writes the conversations as transcripts, so that the table itself
says what the rules must find.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folioflow.functions import rules as R
from folioflow.functions.text import decode_glyphs, drop, hyphen_join, ordered_join, strip, word_count
from folioflow.operators import chairs, checks, header, ids, layout, preamble, qa, running, segment, versions, years
from folioflow.plans import corpus
from folioflow.session import folder
from folioflow.sources import enrich, flag_store

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

# The same roles as speakers, in both languages of a query.
SPEAKERS = {"user": "Honorable Representante Ana Ruiz", "assistant": "Honorable Senadora Eva Sanz", "system": "Secretario General"}
SPEAKER_SQL = "CASE role WHEN 'user' THEN 'Honorable Representante Ana Ruiz' WHEN 'assistant' THEN 'Honorable Senadora Eva Sanz' ELSE 'Secretario General' END"
#: Python's white space, for RE2.
WS = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql.replace("{WS}", WS).replace("{SPEAKER}", SPEAKER_SQL).replace("{DASH}", r"(?m)^-\s+[A-Z][^\n]{0,200}$")
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rendered(spark: SparkSession, sf_dir: str, before: str = "", after: str = "", text: str = "text") -> DataFrame:
    """Pages of conversations: a bold line with the speaker, then the text; a page for each two turns. text is SQL for the text, before and after are SQL that wraps it."""
    rows = table(spark, sf_dir, "conversations")
    who = F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for kv in SPEAKERS.items() for x in kv)), F.col("role")), F.lit(SPEAKERS["system"]))
    said = F.concat(F.expr(before or "''"), F.expr(text), F.expr(after or "''"))
    turn = F.concat(F.lit(R.BOLD), who, F.lit(":\n"), said)
    lines = rows.select(F.format_string("conv_%d", "conv_id").alias("file_id"), (F.floor(F.col("turn") / 2) + 1).cast("int").alias("page_num"), "turn", turn.alias("line"))
    pages = lines.groupBy("file_id", "page_num").agg(ordered_join("turn", "line", "\n").alias("text"))
    return pages.select("file_id", "page_num", "text", F.lit("ok").alias("status"), F.lit("single_column").alias("column_layout"), F.lit(None).cast("string").alias("error_detail"), F.lit(None).cast("double").alias("cid_word_pct"))


@query("""
SELECT doc_id, failure_type, n_words FROM (
  SELECT doc_id, source, CAST(len(list_filter(regexp_split_to_array(text, '{WS}+'), lambda x: x <> '')) AS BIGINT) AS n_words FROM documents
) d, (VALUES ('speech_too_long'), ('speech_too_short')) f(failure_type)
WHERE (failure_type = 'speech_too_long' AND n_words > 3000) OR (failure_type = 'speech_too_short' AND n_words < 15)""")
def word_count_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", word_count(F.col("text")).alias("n_words"))
    who = F.lit("Honorable Representante Ana Ruiz")
    return docs.select("doc_id", "n_words", F.inline(F.array_compact(F.array(*qa.length_flags(F.col("n_words"), F.col("text"), who))))).select("doc_id", "failure_type", "n_words")


@query("""
SELECT event_id, user_id, CAST(run AS BIGINT) AS run FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, island ORDER BY ts, event_id) AS run FROM (
    SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS island FROM (
      SELECT *, CASE WHEN event_type IS NOT DISTINCT FROM lag(event_type) OVER w AND row_number() OVER w > 1 THEN 0 ELSE 1 END AS fresh
      FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)))) WHERE run >= 3""")
def consecutive_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type")
    return qa.runs(events, ["user_id"], ["ts", "event_id"], "event_type").filter(F.col("run") >= R.RUN).select("event_id", "user_id", F.col("run").cast("long").alias("run"))


@query("""
SELECT CAST(o_orderkey AS VARCHAR) AS file_id,
  strftime(o_orderdate, '%Y') || '_' || printf('%04d', row_number() OVER (PARTITION BY year(o_orderdate) ORDER BY CAST(o_orderdate AS DATE), o_custkey, o_orderkey)) AS year_id
FROM orders""")
def year_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderkey").cast("string").alias("file_id"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("session_date"), F.concat(F.lit("No "), F.col("o_custkey").cast("string")).alias("gaceta_number"))
    return ids.year_ids(orders, ["o_orderkey"]).select("file_id", "year_id")


@query("""
SELECT c_name AS file_id, CAST(n AS BIGINT) AS session_id, CAST(floor((n - 1) / 50) AS BIGINT) AS batch_id
FROM (SELECT c_name, row_number() OVER (ORDER BY c_name, c_custkey) AS n FROM customer)""")
def session_ids_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = table(spark, sf_dir, "customer").select(F.col("c_name").alias("file_id"), "c_custkey")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return ids.batches(ids.numbered(files, ["file_id", "c_custkey"], parts=parts)).select("file_id", F.col("session_id").cast("long").alias("session_id"), F.col("batch_id").cast("long").alias("batch_id"))


@query("""
SELECT doc_id, EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.quality = 0) AS qa_flag FROM documents d""")
def qa_flag_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "documents").select("doc_id", F.col("doc_id").cast("string").alias("speech_id"))
    flags = table(spark, sf_dir, "labels").filter("quality = 0").select(F.col("doc_id").cast("string").alias("speech_id"))
    return qa.with_qa_flag(turns, flags).select("doc_id", "qa_flag")


@query("""
WITH found AS (SELECT source AS file_id, CAST(doc_id AS VARCHAR) AS speech_id, CASE WHEN n_chars < 500 THEN 'short' ELSE 'long' END AS failure_type FROM documents),
there AS (SELECT f.* FROM found f JOIN labels l ON f.speech_id = CAST(l.doc_id AS VARCHAR) WHERE l.toxic = 0)
SELECT DISTINCT file_id, speech_id, failure_type FROM found f WHERE NOT EXISTS
  (SELECT 1 FROM there t WHERE t.file_id = f.file_id AND t.speech_id = f.speech_id AND t.failure_type = f.failure_type)""")
def flag_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = table(spark, sf_dir, "documents").select(F.col("source").alias("file_id"), F.col("doc_id").cast("string").alias("speech_id"), F.when(F.col("n_chars") < 500, "short").otherwise("long").alias("failure_type"))
    known = table(spark, sf_dir, "labels").filter("toxic = 0").select(F.col("doc_id").cast("string").alias("speech_id"))
    twice = found.unionAll(found)
    return qa.new_flags(twice, found.join(known, "speech_id", "left_semi"))


@query("""
SELECT DISTINCT conv_id FROM conversations c WHERE NOT EXISTS
  (SELECT 1 FROM conversations d WHERE d.conv_id = c.conv_id AND d.role = 'system')""")
def pending_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    done = rows.filter("role = 'system'").select(F.col("conv_id").alias("file_id"), F.lit("done").alias("status"))
    return ids.pending(rows.select(F.col("conv_id").alias("file_id")).distinct(), done).withColumnRenamed("file_id", "conv_id")


@query("""
SELECT file_id, string_agg(chr(10) || '[PAGE ' || page_num || ']' || chr(10) || text, chr(10) ORDER BY page_num) AS text FROM (
  SELECT 'conv_' || conv_id AS file_id, CAST(floor(turn / 2) + 1 AS INTEGER) AS page_num,
    string_agg('§' || {SPEAKER} || ':' || chr(10) || text, chr(10) ORDER BY turn) AS text
  FROM conversations GROUP BY 1, 2) GROUP BY 1""")
def transcript_render(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segment.file_text(rendered(spark, sf_dir))


@query("""
SELECT file_id, CAST(row_number() OVER (PARTITION BY file_id ORDER BY turn) AS BIGINT) AS position_in_session, attribution_raw, speech_text,
  CAST(len(list_filter(regexp_split_to_array(speech_text, '{WS}+'), lambda x: x <> '')) AS BIGINT) AS word_count FROM (
  SELECT 'conv_' || conv_id AS file_id, turn, {SPEAKER} AS attribution_raw,
    regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '-\\n([a-z])', '\\1', 'g'), '{DASH}', '', 'g'), '^{WS}+', ''), '{WS}+$', '') AS speech_text
  FROM conversations WHERE text IS NOT NULL) WHERE speech_text <> ''""")
def segment_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = segment.turns(rendered(spark, sf_dir))
    return found.select("file_id", F.col("position_in_session").cast("long").alias("position_in_session"), "attribution_raw", "speech_text", F.col("word_count").cast("long").alias("word_count"))


TURN_SQL = r"""
SELECT 'conv_' || conv_id AS file_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS BIGINT) AS position_in_session, {SPEAKER} AS attribution_raw, {VALUE}, speech_text
FROM (SELECT *, regexp_replace(regexp_replace(regexp_replace(regexp_replace({TEXT}, '-\\n([a-z])', '\\1', 'g'), '{DASH}', '', 'g'), '^{WS}+', ''), '{WS}+$', '') AS speech_text FROM conversations WHERE text IS NOT NULL)
WHERE speech_text <> ''{KEEP}"""


def _turns(found: DataFrame, *more: str) -> DataFrame:
    return found.select("file_id", F.col("position_in_session").cast("long").alias("position_in_session"), "attribution_raw", *more, "speech_text")


@query(TURN_SQL.replace("{TEXT}", r"text || chr(10) || repeat('Ana Ruiz Vota sí' || chr(10), CASE WHEN turn % 3 = 0 THEN 3 ELSE 2 END)").replace("{VALUE}", "CASE WHEN turn % 3 = 0 THEN 'vote_tally' ELSE 'speech' END AS record_type").replace("{KEEP}", ""))
def vote_tally(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = segment.turns(rendered(spark, sf_dir, after=r"concat('\n', repeat('Ana Ruiz Vota sí\n', if(turn % 3 = 0, 3, 2)))"))
    return _turns(found, "record_type")


@query(TURN_SQL.replace("{TEXT}", "CASE WHEN turn % 2 = 0 THEN 'Gracias.' ELSE 'Gracias. Sigue el debate. ' || text END").replace("{VALUE}", "turn % 2 = 0 AS closed").replace("{KEEP}", ""))
def close_truncation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Even turns close the session after one word; what follows, the turn's own text, goes."""
    before = "if(turn % 2 = 0, 'Gracias. Se levanta la sesión. ', 'Gracias. Sigue el debate. ')"
    found = segment.turns(rendered(spark, sf_dir, before=before))
    return _turns(found.withColumn("closed", F.col("speech_text") == "Gracias."), "closed")


@query(TURN_SQL.replace("{TEXT}", "'Señor Presidente, ' || text").replace("{VALUE}", "false AS is_continuation").replace("{KEEP}", " AND turn % 3 <> 1"))
def procedural_skip(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = segment.turns(rendered(spark, sf_dir, before=r"if(turn % 3 = 1, '(RECESO)\n', 'Señor Presidente, ')"))
    return _turns(found, "is_continuation")


@query("""
SELECT doc_id, text FROM (SELECT doc_id, regexp_replace(regexp_replace(text, '([a-z]) ([a-z])', '\\1-' || chr(10) || '\\2', 'g'), '-\\n([a-z])', '\\1', 'g') AS text FROM documents)""")
def hyphen_joins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", hyphen_join(F.regexp_replace("text", "([a-z]) ([a-z])", "$1-\n$2")).alias("text"))


@query("""
WITH p AS (SELECT conv_id, turn + 1 AS page, conv_id % 5 <> 0 AND turn = conv_id % 4 AS begins FROM conversations),
s AS (SELECT conv_id, min(page) FILTER (WHERE begins) AS first, list(page ORDER BY page) AS pages FROM p GROUP BY 1)
SELECT 'conv_' || conv_id AS file_id, CAST(coalesce(first, pages[2], pages[1]) AS BIGINT) AS transcript_start_page,
  CASE WHEN first IS NULL THEN 'fallback_page_2' ELSE 'floor_grant_pattern' END AS detection_method,
  CAST(len(list_filter(pages, lambda x: x < coalesce(first, pages[2], pages[1]))) AS BIGINT) AS n_preamble FROM s""")
def preamble_start(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page for each turn; in four of five files the page conv_id % 4 opens with a floor grant, and page 1 is always a roll call's neighbour."""
    rows = table(spark, sf_dir, "conversations")
    text = F.when((F.col("conv_id") % 5 != 0) & (F.col("turn") == F.col("conv_id") % 4), F.concat(F.lit("LA PRESIDENCIA CONCEDE EL USO DE LA PALA-\nbra a todos. "), F.coalesce("text", F.lit("")))).otherwise(F.coalesce("text", F.lit("")))
    pages = rows.select(F.format_string("conv_%d", "conv_id").alias("file_id"), (F.col("turn") + 1).alias("page_num"), text.alias("text"), F.lit("ok").alias("status"))
    found = preamble.start_pages(pages)
    return found.select("file_id", F.col("transcript_start_page").cast("long").alias("transcript_start_page"), "detection_method", F.size("preamble_pages").cast("long").alias("n_preamble"))


@query("""
SELECT o_orderkey AS file_id, CAST(o_custkey AS VARCHAR) AS gaceta_number, strftime(o_orderdate, '%Y-%m-%d') AS publication_date,
  CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE strftime(o_orderdate + INTERVAL 40 DAY, '%Y-%m-%d') END AS session_date,
  CASE o_orderkey % 4 WHEN 0 THEN 'camara' WHEN 1 THEN 'senado' WHEN 2 THEN 'mixed' ELSE NULL END AS chamber,
  CASE WHEN o_orderkey % 2 = 0 THEN 'session_transcript' ELSE 'unknown' END AS document_type,
  CASE WHEN o_orderkey % 5 = 0 THEN 'COMISIÓN PRIMERA CONSTITUCIONAL' ELSE NULL END AS committee
FROM orders""")
def header_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    key, months = F.col("o_orderkey"), F.array(*(F.lit(m) for m in R.MONTHS))
    spoken = lambda d: F.concat(F.day(d).cast("string"), F.lit(" de "), F.element_at(months, F.month(d)), F.lit(" de "), F.year(d).cast("string"))
    date = F.to_date("o_orderdate")
    chamber = F.when(key % 4 == 0, "CÁMARA DE REPRESENTANTES").when(key % 4 == 1, "Senado de la República").when(key % 4 == 2, "Comisiones conjuntas").otherwise("Congreso")
    text = F.concat_ws("\n", F.concat(F.lit("GACETA N° "), F.format_string("%,d", "o_custkey")), F.concat(F.lit("Bogotá, "), spoken(date)), chamber, F.when(key % 2 == 0, "ACTA NÚMERO 12").otherwise("Informe"), F.when(key % 5 == 0, "COMISIÓN PRIMERA CONSTITUCIONAL:"), F.when(key % 3 != 0, F.concat(F.lit("Sesión del "), spoken(F.date_add(date, 40)))))
    found = header.by_rule(orders.select(key.alias("file_id"), text.alias("preamble_text")))
    return found.select("file_id", "gaceta_number", "publication_date", "session_date", "chamber", "document_type", "committee")


@query("""
SELECT doc_id, CASE WHEN 'low' IN (a, b, c) THEN 'low' WHEN 'medium' IN (a, b, c) THEN 'medium' WHEN 'high' IN (a, b, c) THEN 'high' ELSE 'unknown' END AS confidence FROM (
  SELECT doc_id, CASE quality WHEN 1 THEN 'high' ELSE '' END AS a, CASE toxic WHEN 1 THEN 'medium' END AS b, CASE WHEN doc_id % 7 = 0 THEN 'low' END AS c FROM (
    SELECT doc_id, coalesce(quality, 0) AS quality, coalesce(toxic, 0) AS toxic FROM labels))""")
def confidence_min(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "labels")
    a, b, c = F.when(F.col("quality") == 1, "high").otherwise(""), F.when(F.col("toxic") == 1, "medium"), F.when(F.col("doc_id") % 7 == 0, "low")
    return rows.select("doc_id", header.lowest_confidence(a, b, c).alias("confidence"))


def _synthetic_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as pages of their source; their length chooses the status."""
    n = F.col("n_chars")
    status = F.when(n % 11 == 0, "scanned").when(n % 13 == 0, "empty").when(n % 17 == 0, "error").otherwise("ok")
    return table(spark, sf_dir, "documents").select(F.col("source").alias("file_id"), F.col("doc_id").alias("page_num"), status.alias("status"), F.when(n > 2000, "two_column").otherwise("single_column").alias("column_layout"))


@query("""
SELECT source AS file_id, count(*) AS n_pages_total, count(*) FILTER (WHERE s = 'ok') AS n_ok, count(*) FILTER (WHERE s = 'scanned') AS n_pages_scanned,
  count(*) FILTER (WHERE s = 'empty') AS n_empty, count(*) FILTER (WHERE s = 'error') AS n_error, count(*) FILTER (WHERE n_chars > 2000) AS n_two_column,
  bool_and(s = 'scanned') AS skip_strict, bool_and(s <> 'ok') AS skip
FROM (SELECT *, CASE WHEN n_chars % 11 = 0 THEN 'scanned' WHEN n_chars % 13 = 0 THEN 'empty' WHEN n_chars % 17 = 0 THEN 'error' ELSE 'ok' END AS s FROM documents) GROUP BY 1""")
def page_status_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.page_counts(_synthetic_pages(spark, sf_dir))


def _words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All words of all documents at computed places, ten to a line, in one column (odd ids) or two: a page of 609.4 by 963.8, as long as it takes, for each document."""
    split = F.posexplode(F.filter(F.split("text", r"[ \t\n\x0B\f\r]+"), lambda w: w != "")).alias("i", "word")
    flat = table(spark, sf_dir, "documents").select("doc_id", split)
    i, two = F.col("i"), F.col("doc_id") % 2 == 0
    line = F.floor(i / 10)
    right = two & (line % 2 == 1)
    x = F.when(two, F.when(right, 320.0).otherwise(60.0) + (i % 10) * 20).otherwise(60.0 + (i % 10) * 50)
    top = 220.0 + F.when(two, F.floor(line / 2)).otherwise(line) * 12 + (i % 3)
    text = F.when((F.col("doc_id") % 10 == 3) & (i % 2 == 0), F.lit("(cid:40)")).otherwise(F.col("word"))
    return flat.select(F.format_string("doc_%d", "doc_id").alias("file_id"), F.lit(1).alias("page_num"), i.cast("int").alias("word_seq"), text.alias("text"), x.alias("x0"), top.cast("double").alias("top"), F.lit(10.0).alias("size"), F.when(line % 7 == 0, "Times-Bold").otherwise("Times").alias("fontname"), F.when(i % 29 == 5, "tuple").alias("color_kind"), F.when(i % 29 == 5, F.array(F.lit(1.0), F.lit(1.0), F.lit(1.0))).alias("color"), F.lit(609.4).alias("page_w"), F.lit(963.8).alias("page_h"))


_WORDS_SQL = r"""
WITH w AS (SELECT doc_id, unnest(x) AS word, generate_subscripts(x, 1) - 1 AS i FROM (
  SELECT doc_id, list_filter(regexp_split_to_array(text, '[ \t\n\x0B\f\r]+'), lambda t: t <> '') AS x FROM documents)),
v AS (SELECT doc_id, i, CASE WHEN doc_id % 10 = 3 AND i % 2 = 0 THEN '(cid:40)' ELSE word END AS word, i // 10 AS line,
  CAST(CASE WHEN doc_id % 2 = 0 THEN i // 10 % 2 = 1 ELSE i % 10 >= 5 END AS INTEGER) AS col FROM w WHERE i % 29 <> 5),
n AS (SELECT doc_id, count(*) AS n_words, count(*) FILTER (WHERE contains(word, '(cid:')) AS n_coded, count(*) FILTER (WHERE col = 1) AS n_right FROM v GROUP BY 1)
"""


@query(_WORDS_SQL + """
SELECT 'doc_' || doc_id AS file_id, 1 AS page_num, 10 * n_coded > 3 * n_words AS scanned, CASE WHEN 10 * n_coded > 3 * n_words THEN round(n_coded / n_words, 4) END AS cid_word_pct FROM n""")
def scan_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which pages are scanned, and the log of these."""
    found = layout.pages(_words(spark, sf_dir))
    return found.select("file_id", "page_num", (F.col("status") == "scanned").alias("scanned"), layout.logged_share().alias("cid_word_pct"))


@query(_WORDS_SQL + """
, d AS (SELECT *, n_right >= 10 AS two, 10 * n_coded > 3 * n_words AS scanned FROM n),
l AS (SELECT doc_id, CASE WHEN two THEN col ELSE 0 END AS part, CASE WHEN doc_id % 2 = 0 THEN line // 2 ELSE line END AS place,
    CASE WHEN bool_and(line % 7 = 0) THEN '§' ELSE '' END || string_agg(word, ' ' ORDER BY v.col, i) AS text FROM v JOIN d USING (doc_id) GROUP BY 1, 2, 3),
c AS (SELECT doc_id, part, string_agg(text, chr(10) ORDER BY place) AS text FROM l GROUP BY 1, 2),
p AS (SELECT doc_id, string_agg(text, chr(10) ORDER BY part) AS text FROM c GROUP BY 1)
SELECT 'doc_' || doc_id AS file_id, CASE WHEN scanned THEN 'scanned' ELSE 'ok' END AS status, CASE WHEN two AND NOT scanned THEN 'two_column' ELSE 'single_column' END AS column_layout,
  CASE WHEN scanned THEN '' ELSE p.text END AS text FROM p JOIN d USING (doc_id)""")
def column_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of synthetic words come back line by line, in one column or two; lines of odd ids, which cross the middle of a page of two, are read as two halves."""
    return layout.pages(_words(spark, sf_dir)).select("file_id", "status", "column_layout", "text")


@query("""
SELECT doc_id, array_to_string(regexp_extract_all(text, '[A-Za-z]+'), ' ') AS text FROM documents""")
def glyph_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ASCII letters and blanks of all documents, coded by the offset, come back."""
    plain = F.array_join(F.regexp_extract_all("text", F.lit("[A-Za-z]+"), F.lit(0)), " ")
    chars = F.filter(F.split(plain, ""), lambda c: c != "")
    coded = F.array_join(F.transform(chars, lambda c: F.concat(F.lit("(cid:"), (F.ascii(c) - 29).cast("string"), F.lit(")"))), "")
    return table(spark, sf_dir, "documents").select("doc_id", decode_glyphs(coded).alias("text"))


@query("""
SELECT 'conv_' || conv_id AS file_id, CAST(count(*) AS BIGINT) AS n, list(turn ORDER BY turn)[1] AS first_turn FROM conversations WHERE turn % 2 = 1 GROUP BY 1""")
def leak_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    text = F.when(F.col("turn") % 2 == 1, F.concat(F.coalesce("text", F.lit("")), F.lit(" 12 de Marzo de 2021 GACETA"))).otherwise(F.coalesce("text", F.lit("")))
    speeches = rows.select(F.format_string("conv_%d", "conv_id").alias("file_id"), F.format_string("%03d", "turn").alias("speech_id"), text.alias("speech_text"))
    found = checks.leaks_by_file(speeches, checks.standing()[:1])
    return found.select("file_id", "n", F.col("first_id").cast("long").alias("first_turn"))


@query("""
SELECT 'count conv_' || conv_id AS "check", CASE WHEN count(*) FILTER (WHERE role = 'user') BETWEEN 2 AND 3 THEN 'PASS'
  WHEN count(*) FILTER (WHERE role = 'user') = 1 THEN 'WARN' ELSE 'FAIL' END AS verdict, CAST(count(*) FILTER (WHERE role = 'user') AS VARCHAR) AS detail
FROM conversations GROUP BY conv_id""")
def dq_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select(F.format_string("conv_%d", "conv_id").alias("file_id"), "role")
    bounds = rows.select("file_id").distinct().withColumns({"least": F.lit(2), "most": F.lit(3)})
    return checks.count_check(rows.filter("role = 'user'"), bounds).select("check", "verdict", "detail")


@query("""
WITH t AS (SELECT * FROM (SELECT 'conv_' || conv_id AS file_id, turn, {SPEAKER} AS who, max(turn) OVER (PARTITION BY conv_id) AS last,
    len(list_filter(regexp_split_to_array(text, '{WS}+'), lambda x: x <> '')) AS n_words FROM conversations) WHERE turn >= 2 OR last < 2)
SELECT failure_type, CAST(count(*) AS BIGINT) AS n FROM (
  SELECT 'no_date_extracted' AS failure_type FROM (SELECT DISTINCT file_id FROM t)
  UNION ALL SELECT 'few_speeches_extracted' FROM (SELECT file_id FROM t GROUP BY 1 HAVING count(*) < 3 AND floor(max(last) / 2) + 1 > 2)
  UNION ALL SELECT 'speech_too_short' FROM t WHERE n_words < 15 AND who <> 'Secretario General'
  UNION ALL SELECT 'speech_too_long' FROM t WHERE n_words > 3000) GROUP BY 1""")
def corpus_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole run over rendered transcripts, which begin on page 2 for want of a floor grant: its flags by kind."""
    made = corpus.build(rendered(spark, sf_dir))
    return made.flags.groupBy("failure_type").agg(F.count(F.lit(1)).alias("n"))


@query("""
SELECT file_id, CAST(count(*) FILTER (WHERE page >= 2 OR last = 1) AS BIGINT) AS n_speeches, CAST(max(page) AS BIGINT) AS n_pages_total, 'unknown' AS header_confidence
FROM (SELECT 'conv_' || conv_id AS file_id, floor(turn / 2) + 1 AS page, max(floor(turn / 2) + 1) OVER (PARTITION BY conv_id) AS last FROM conversations) GROUP BY 1""")
def corpus_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = corpus.build(rendered(spark, sf_dir))
    return made.sessions.select("file_id", F.col("n_speeches").cast("long").alias("n_speeches"), F.col("n_pages_total").cast("long").alias("n_pages_total"), "header_confidence")


@query("""
SELECT 'conv_' || conv_id AS file_id, CAST(turn + 1 AS BIGINT) AS position_in_session,
  regexp_replace(regexp_replace(regexp_replace(text, '{DASH}', '', 'g'), '^{WS}+', ''), '{WS}+$', '') AS text FROM conversations WHERE text IS NOT NULL""")
def dash_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dash lines that are put in go again."""
    rows = table(spark, sf_dir, "conversations").filter("text is not null")
    text = F.concat(F.lit("- Acta leída en 1999\n"), F.col("text"), F.lit("\n- Fin de la lectura"))
    return rows.select(F.format_string("conv_%d", "conv_id").alias("file_id"), (F.col("turn") + 1).cast("long").alias("position_in_session"), drop(text, "(?d)" + R.DASH_LINE).alias("text"))


# ---------------------------------------------------------------- one shape of each rule

#: By priority: what stands before the speaker's words, what it is attributed to, and whether it may stand inside a line.
SHAPES = (
    ("§Honorable Senadora Eva Sanz:", "Honorable Senadora Eva Sanz", False),
    ("La Presidencia concede el uso de la palabra al honorable Representante Luis Paz:", "La Presidencia concede el uso de la palabra al honorable Representante Luis Paz", False),
    ("Con la venia de la Presidencia\nel doctor Luis Paz:", "Con la venia de la Presidencia el doctor Luis Paz", False),
    ("Se le concede el uso de la palabra a la honorable Senadora Eva Sanz:", "Se le concede el uso de la palabra a la honorable Senadora Eva Sanz", False),
    ("- El señor Presidente de la Comisión, manifiesta:", "Presidente", False),
    ("- La doctora Eva Sanz, directora de la entidad, expresa:", "Eva Sanz", False),
    ("Tiene el uso de la palabra Luis Paz:", "Tiene el uso de la palabra Luis Paz", False),
    ("honorable Senador Luis Paz, tiene la palabra.", "Luis Paz", True),
    ("Tiene la palabra el honorable Representante Luis Paz.", "Luis Paz", True),
    ("tiene la palabra el honorable Senador Luis Paz:", "Luis Paz", True),
    ("interviene el honorable Senador Luis Paz, quien manifiesta:", "Luis Paz", True),
    ("la honorable Representante Eva Sanz expresa:", "Eva Sanz", True),
    ("le otorga el uso de la palabra al honorable Representante Luis Paz, quien expone:", "Luis Paz", True),
    ("otorga el uso de la palabra al señor doctor Luis Paz, de la entidad, quien afirma:", "Luis Paz", True),
    ("Intervención del Representante a la Cámara Luis Paz:", "Intervención del Representante a la Cámara Luis Paz", False),
    ("Dirección de Presidencia, Luis Paz:", "Dirección de Presidencia, Luis Paz", False),
    ("PRESIDENTE:", "PRESIDENTE", False),
    ("Secretaria; Eva Sanz Gil:", "Secretaria; Eva Sanz Gil", False),
    ("Vicepresidente Luis Paz:", "Vicepresidente Luis Paz", False),
    ("Honorable Congresista Eva Sanz:", "Honorable Congresista Eva Sanz", False),
    ("Ministro de Hacienda, doctor Luis Paz:", "Ministro de Hacienda, doctor Luis Paz", False),
    ("Senadora Eva Sanz:", "Senadora Eva Sanz", False),
    ("Luis Alberto Paz:", "Luis Alberto Paz", False),
)
#: First line of the speaker's words, longer than any pattern reads on.
OPENING = "Continuamos con el orden del día previsto para la sesión ordinaria de hoy y con los demás asuntos pendientes"
#: By number: what stands before the speaker's words; what the turn is attributed to (null: no turn of its own); whether its words stay with the turn before.
ODDITIES = (
    ("§Eva Sanz Continúa con el uso de la palabra:", "Eva Sanz Continúa con el uso de la palabra", ""),
    ("§Preside la sesión el honorable Luis Paz:", None, None),
    ("§(cid:40)(cid:41)(cid:42) y otros:", "[CID_ATTRIBUTION]", ""),
    ("§Honorable Repre-\n§sentante Ana\n§Ruiz:", "Honorable Representante Ana Ruiz", ""),
    ("§Proyecto de ley:", None, "Proyecto de ley:\n"),
    ("§(RECESO) Luis Paz:", "Luis Paz", ""),
    ("§el pueblo:", None, "el pueblo:\n"),
    ("§Senadora Eva (cid:54)anz:", "Senadora Eva Sanz", ""),
)


def _quoted(text: str | None) -> str:
    return "NULL" if text is None else "'" + text.replace("\n", "' || chr(10) || '") + "'"


def _case(of: str, values: tuple) -> str:
    return f"CASE {of} " + " ".join(f"WHEN {i} THEN {_quoted(v)}" for i, v in enumerate(values)) + " END"


_CLEAN_SQL = r"""regexp_replace(regexp_replace(regexp_replace(regexp_replace({OPENING} || chr(10) || coalesce(text, ''), '-\\n([a-z])', '\\1', 'g'), '{DASH}', '', 'g'), '^{WS}+', ''), '{WS}+$', '')""".replace("{OPENING}", _quoted(OPENING))


def _staged(spark: SparkSession, sf_dir: str, shapes: tuple) -> DataFrame:
    """A page for each turn of a conversation: two words of a chair, one of the shapes, and the turn's text."""
    rows = table(spark, sf_dir, "conversations").withColumn("k", F.pmod(F.col("conv_id") * 8 + F.col("turn"), F.lit(len(shapes))).cast("int"))
    shape = F.element_at(F.array(*(F.lit(x) for x in shapes)), F.col("k") + 1)
    text = F.concat(F.lit(R.BOLD + "Presidente:\nUno dos.\n"), shape, F.lit("\n" + OPENING + "\n"), F.coalesce("text", F.lit("")))
    return rows.select(F.format_string("turn_%d_%d", "conv_id", "turn").alias("file_id"), F.lit(1).alias("page_num"), text.alias("text"), F.lit("ok").alias("status"))


def _spoken(found: DataFrame) -> DataFrame:
    return found.select("file_id", F.col("position_in_session").cast("long").alias("position_in_session"), "attribution_raw", "is_continuation", "speech_text")


@query("WITH r AS (SELECT *, (conv_id * 8 + turn) % 23 AS k FROM conversations)" + """
SELECT 'turn_' || conv_id || '_' || turn AS file_id, 1::BIGINT AS position_in_session, 'Presidente' AS attribution_raw, false AS is_continuation,
  'Uno dos.' || CASE WHEN k IN (7, 8, 9, 10, 11, 12, 13) THEN chr(10) || 'Y ahora' ELSE '' END AS speech_text FROM r
UNION ALL SELECT 'turn_' || conv_id || '_' || turn, 2::BIGINT, """ + _case("k", tuple(x[1] for x in SHAPES)) + ", false, " + _CLEAN_SQL + " FROM r")
def boundary_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every rule for boundaries has its shape in every 23rd turn, and finds it; what stands before a shape inside a line stays with the turn before."""
    return _spoken(segment.turns(_staged(spark, sf_dir, tuple("Y ahora " + x if inside else x for x, _, inside in SHAPES))))


@query("WITH r AS (SELECT *, (conv_id * 8 + turn) % 8 AS k FROM conversations), c AS (SELECT *, " + _CLEAN_SQL + " AS body, " + _case("k", tuple(x[1] for x in ODDITIES)) + " AS who, " + _case("k", tuple(x[2] for x in ODDITIES)) + """ AS stays FROM r)
SELECT 'turn_' || conv_id || '_' || turn AS file_id, 1::BIGINT AS position_in_session, 'Presidente' AS attribution_raw, false AS is_continuation,
  'Uno dos.' || CASE WHEN stays <> '' THEN chr(10) || stays || body ELSE '' END AS speech_text FROM c
UNION ALL SELECT 'turn_' || conv_id || '_' || turn, 2::BIGINT, who, k = 0, body FROM c WHERE who IS NOT NULL""")
def attribution_oddities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Continuations, changes of the chair, undecodable bold lines, bold lines that run on, rejected prefixes, leading recesses, and codes inside names."""
    return _spoken(segment.turns(_staged(spark, sf_dir, tuple(x for x, _, _ in ODDITIES))))


@query(TURN_SQL.replace("{TEXT}", "text || ' sesión'").replace("{VALUE}", "conv_id").replace("{KEEP}", ""))
def normal_form(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Letters that are written as a letter and a mark become one character, in every turn."""
    found = segment.turns(rendered(spark, sf_dir, after="' sesio\u0301n'", text="replace(text, '\u00e9', 'e\u0301')"))
    return _turns(found.withColumn("conv_id", F.substring("file_id", 6, 20).cast("long")), "conv_id")


# ---------------------------------------------------------------- furniture of pages, flags, checks and headers


@query("""
WITH p AS (SELECT doc_id, doc_id % 2 + 1 AS page, doc_id % 3 = 0 AS large, doc_id % 5 AS k, regexp_replace(regexp_replace(coalesce(text, ''), '^{WS}+', ''), '{WS}+$', '') AS body FROM documents),
l AS (SELECT *, CASE WHEN page = 2 THEN 'CABECERA' END AS a, CASE WHEN page = 2 THEN 'GACETA' END AS b, CASE WHEN k = 1 THEN 'IMPRENTA y NACIONAL' END AS c FROM p)
SELECT 'doc_' || doc_id AS file_id, CAST(page AS INTEGER) AS page_num, CASE WHEN k = 4 AND page = 1 THEN 'empty' ELSE 'ok' END AS status,
  CASE WHEN k = 4 THEN coalesce(concat_ws(chr(10), a, b), '') ELSE regexp_replace(regexp_replace(concat_ws(chr(10), a, b, body, c), '^{WS}+', ''), '{WS}+$', '') END AS text
FROM l WHERE NOT (k <> 4 AND body = '')""")
def page_furniture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's text as one word of a page 1 or 2, in two scales, among words of the masthead, the header and the footer, and of white ink of all kinds."""
    docs = table(spark, sf_dir, "documents").withColumn("_body", strip(F.coalesce("text", F.lit("")))).filter((F.col("_body") != "") | (F.col("doc_id") % 5 == 4))
    k, page, scale = F.col("doc_id") % 5, (F.col("doc_id") % 2 + 1).cast("int"), F.when(F.col("doc_id") % 3 == 0, 2.0).otherwise(1.0)

    def word(text: object, x: float, top: float, size: float = 10.0, when: object = None, kind: str | None = None, color: list[float] | None = None) -> object:
        made = F.struct((text if isinstance(text, Column) else F.lit(text)).alias("text"), (F.lit(x) * scale).alias("x0"), (F.lit(top) * scale).alias("top"), F.lit(size).alias("size"), F.lit(kind).cast("string").alias("color_kind"), F.lit(color).cast("array<double>").alias("color"))
        return made if when is None else F.when(when, made)

    words = F.array_compact(F.array(
        word("MARCA", 60.0, 20.0),  # above every header
        word("CABECERA", 60.0, 90.0),  # below the header of page 2 only
        word("GACETA", 60.0, 220.0, 48.0),  # a masthead on page 1
        word("int", 60.0, 300.0, kind="int", color=[1.0]), word("float", 70.0, 300.0, kind="float", color=[0.95]), word("tuple", 80.0, 300.0, kind="tuple", color=[1.0, 1.0, 1.0, 0.2]),
        word(F.col("_body"), 60.0, 400.0, when=k != 4),
        word("tinta", 700.0, 420.0),  # beyond the page's zones
        word("IMPRENTA", 60.0, 900.0, when=k != 1), word("NACIONAL", 120.0, 900.0, when=k != 1),
        word("IMPRENTA", 60.0, 900.0, when=k == 1), word("y", 100.0, 900.0, when=k == 1), word("NACIONAL", 120.0, 900.0, when=k == 1),
    ))
    flat = docs.select(F.format_string("doc_%d", "doc_id").alias("file_id"), page.alias("page_num"), (F.lit(R.CANONICAL[0]) * scale).alias("page_w"), (F.lit(R.CANONICAL[1]) * scale).alias("page_h"), F.posexplode(words).alias("word_seq", "w"))
    found = layout.pages(flat.select("file_id", "page_num", "word_seq", "w.*", F.lit("Times").alias("fontname"), "page_w", "page_h"))
    return found.select("file_id", "page_num", "status", "text")


_WHO = ("Ana Ruiz", "Ana 2 Ruiz", "Ana ² Ruiz", "Ana ₂ Ruiz", "Ana ② Ruiz", "Ana ٣ Ruiz", "Ana " + "Ruiz " * 60)


@query("""
SELECT 'doc_' || doc_id AS speech_id, 'attribution_anomaly' AS failure_type, 'warning' AS severity, left(who, 500) AS original_excerpt
FROM (SELECT doc_id, """ + _case("doc_id % 7", _WHO) + """ AS who FROM documents) WHERE who <> 'Ana Ruiz'""")
def attribution_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attributions with digits of all kinds, or longer than 300 characters."""
    who = F.element_at(F.array(*(F.lit(x) for x in _WHO)), (F.col("doc_id") % 7 + 1).cast("int"))
    turns = table(spark, sf_dir, "documents").select(F.concat(F.lit("file_"), F.col("source")).alias("file_id"), F.format_string("doc_%d", "doc_id").alias("speech_id"), F.col("doc_id").alias("position_in_session"), who.alias("attribution_raw"), F.lit("uno " * 20).alias("speech_text"), F.lit(20).alias("word_count"), F.lit(True).alias("is_continuation"), F.lit(R.VERSION).alias("rule_version"))
    return qa.turn_flags(turns).filter("failure_type = 'attribution_anomaly'").select("speech_id", "failure_type", "severity", "original_excerpt")


@query("""
WITH f AS (SELECT source, count(*) AS n, CASE WHEN min(doc_id) % 2 = 0 THEN '2021-03-05' END AS day, [x for x in list(doc_id ORDER BY doc_id) if x % 11 = 0] AS scanned FROM documents GROUP BY 1)
SELECT source AS file_id, 'no_date_extracted' AS failure_type, 'blocking' AS severity, 'session_date is null after header parsing' AS diagnosis FROM f WHERE day IS NULL
UNION ALL SELECT source, 'few_speeches_extracted', 'blocking', 'Only ' || (n % 4) || ' speeches found in ' || n || '-page file' FROM f WHERE n % 4 < 3 AND n > 2
UNION ALL SELECT source, 'scanned_pages_present', 'info', 'Scanned pages: [' || array_to_string(scanned, ', ') || ']' FROM f WHERE len(scanned) > 0""")
def file_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    files = docs.groupBy(F.col("source").alias("file_id")).agg(F.count(F.lit(1)).cast("int").alias("n_pages_total"), F.min("doc_id").alias("least"), F.array_sort(F.collect_list(F.when(F.col("doc_id") % 11 == 0, F.col("doc_id")))).alias("scanned"))
    files = files.select("file_id", "n_pages_total", "scanned", F.when(F.col("least") % 2 == 0, "2021-03-05").alias("session_date"), (F.col("n_pages_total") % 4).cast("int").alias("n_speeches"), F.lit(R.VERSION).alias("rule_version"))
    return qa.file_flags(files).select("file_id", "failure_type", "severity", "diagnosis")


#: Leaks by turn, and speakers.
_LEAKS = ("\n12 de Marzo de 2021 GACETA", " Se levanta la sesión", "\n- Acta", "", "")
_LEAK_SQL = "coalesce(text, '') || CASE turn % 5 WHEN 0 THEN chr(10) || '12 de Marzo de 2021 GACETA' WHEN 1 THEN ' Se levanta la sesión' WHEN 2 THEN chr(10) || '- Acta' ELSE '' END"
_LEAKED_SQL = {
    "running header in text": ("FAIL", "said", "(?i)" + R.RUNNING_HEADER),
    "session close in text": ("WARN", "said", "(?i)" + R.SESSION_CLOSE),
    "dash line in text": ("WARN", "said", R.DASH_START),
    "trailing verb in speaker": ("FAIL", "who", "(?i)" + R.TRAILING_VERB),
    "unclean speaker name": ("WARN", "who", r"[\p{Nd}§]|\(cid:"),
}


def _leaking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The conversations' texts as speeches, three of five with a leak behind them and two with one in the speaker's name."""
    leak = F.element_at(F.array(*(F.lit(x) for x in _LEAKS)), (F.col("turn") % 5 + 1).cast("int"))
    who = F.when(F.col("turn") % 5 == 3, "Ana Ruiz, quien manifiesta").when(F.col("turn") % 5 == 4, "Ana codes §Ruiz").otherwise("Ana Ruiz")
    return table(spark, sf_dir, "conversations").select(F.format_string("conv_%d", "conv_id").alias("file_id"), F.format_string("%d_%03d", "conv_id", "turn").alias("speech_id"), "turn", F.concat(F.coalesce("text", F.lit("")), leak).alias("speech_text"), who.alias("speaker_raw"))


_HITS_SQL = " UNION ALL ".join(f"SELECT '{name}' AS name, '{verdict}' AS verdict, file_id, turn, {column} AS x, regexp_extract({column}, '{pattern}') AS m FROM t WHERE regexp_matches({column}, '{pattern}')" for name, (verdict, column, pattern) in _LEAKED_SQL.items())
_NAMES_SQL = ", ".join(f"('{name}', '{verdict}')" for name, (verdict, _, _) in _LEAKED_SQL.items())
_SAID_SQL = f"""
WITH t AS (SELECT 'conv_' || conv_id AS file_id, turn, conv_id, {_LEAK_SQL} AS said, CASE turn % 5 WHEN 3 THEN 'Ana Ruiz, quien manifiesta' WHEN 4 THEN 'Ana codes §Ruiz' ELSE 'Ana Ruiz' END AS who FROM conversations),
hits AS ({_HITS_SQL}),
names AS (SELECT * FROM (VALUES {_NAMES_SQL}) n(name, verdict))"""


@query(_SAID_SQL + """,
f AS (SELECT DISTINCT file_id, conv_id FROM t)
SELECT x || ' absent from ' || y AS "check", 'PASS' AS verdict, '' AS detail FROM (VALUES ('act_number'), ('presiding_officer'), ('legislature')) a(x), (VALUES ('speeches'), ('sessions')) b(y)
UNION ALL SELECT 'year_id populated', CASE WHEN count(*) FILTER (WHERE conv_id % 4 <> 0) = count(*) THEN 'PASS' ELSE 'FAIL' END, count(*) FILTER (WHERE conv_id % 4 <> 0) || '/' || count(*) FROM f
UNION ALL SELECT name, CASE WHEN count(h.x) > 0 THEN n.verdict ELSE 'PASS' END, count(h.x) || ' rows' FROM names n LEFT JOIN hits h USING (name) GROUP BY name, n.verdict
UNION ALL SELECT 'speaker_raw without codes', CASE WHEN count(*) FILTER (WHERE turn % 5 = 4) > 0 THEN 'FAIL' ELSE 'PASS' END, CAST(count(*) FILTER (WHERE turn % 5 = 4) AS VARCHAR) FROM t WHERE file_id = 'conv_1'
UNION ALL SELECT 'count ' || file_id, CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'FAIL' END, CAST(count(*) AS VARCHAR) FROM t WHERE file_id = 'conv_2' GROUP BY file_id
UNION ALL SELECT 'session_date of ' || file_id, CASE WHEN conv_id % 4 = 0 THEN 'FAIL' ELSE 'PASS' END, CASE WHEN conv_id % 3 = 0 THEN 'null' ELSE '2020-10-2' || conv_id % 3 END FROM f""")
def check_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The standing checks over turns with every fifth kind of leak, per-file checks, and golden dates of which every fourth is wrong."""
    rows, speeches = table(spark, sf_dir, "conversations"), _leaking(spark, sf_dir)
    files = rows.select("conv_id", F.format_string("conv_%d", "conv_id").alias("file_id")).distinct()
    day = F.when(F.col("conv_id") % 3 != 0, F.concat(F.lit("2020-10-2"), (F.col("conv_id") % 3).cast("string")))
    sessions = files.select("file_id", day.alias("session_date"), F.when(F.col("conv_id") % 4 != 0, F.concat(F.lit("2020_"), F.col("conv_id").cast("string"))).alias("year_id"))
    golden = files.select("file_id", F.when(F.col("conv_id") % 4 == 0, "1999-01-01").otherwise(day).alias("expected"))
    none = files.filter("file_id = 'conv_2'").select("file_id", F.lit(0).alias("least"), F.lit(0).alias("most"))
    found = checks.suite(speeches, sessions, bounds=none, golden=golden).unionByName(checks.substring_check(speeches, "conv_1", "speaker_raw", "codes"))
    return found.select("check", "verdict", "detail")


@query("""
SELECT o_orderkey AS file_id, CASE WHEN o_orderkey % 5 IN (0, 1) THEN 'c' || o_custkey ELSE CAST(o_custkey AS VARCHAR) END AS gaceta_number,
  CASE o_orderkey % 5 WHEN 0 THEN 'llm' WHEN 1 THEN 'llm' WHEN 2 THEN 'rule_based_error:JSONDecodeError' WHEN 3 THEN 'rule_based_ollama_unreachable' ELSE 'rule_based' END AS extraction_status,
  CASE WHEN o_orderkey % 5 IN (0, 1) THEN 'high' ELSE 'low' END AS session_date_confidence, CAST(year(o_orderdate) AS INTEGER) AS year_extracted
FROM orders""")
def service_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers with thoughts and fences are repaired; where there is none, or none that parses, rules read the preamble. The year is the session's."""
    orders = table(spark, sf_dir, "orders")
    k, months = F.col("o_orderkey") % 5, F.array(*(F.lit(m) for m in R.MONTHS))
    spoken = F.concat(F.day("o_orderdate").cast("string"), F.lit(" de "), F.element_at(months, F.month("o_orderdate")), F.lit(" de "), F.year("o_orderdate").cast("string"))
    texts = orders.select(F.col("o_orderkey").alias("file_id"), F.concat(F.lit("GACETA N° "), F.col("o_custkey").cast("string"), F.lit("\nBogotá, "), spoken, F.lit("\nSesión del "), spoken).alias("preamble_text"))
    made = F.to_json(F.struct(F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("gaceta_number"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("session_date"), F.lit("high").alias("session_date_confidence")))
    answer = F.when(k == 0, F.concat(F.lit("<think>{ no }</think>\nHere: "), made)).when(k == 1, F.concat(F.lit("```json\n"), made, F.lit("\n```"))).when(k == 2, "no json")
    answers = orders.filter("o_orderkey % 5 < 4").select(F.col("o_orderkey").alias("file_id"), answer.alias("answer"), F.when(k == 3, "unreachable").alias("error"))
    found = header.with_service(texts, answers)
    return found.select("file_id", "gaceta_number", "extraction_status", "session_date_confidence", header.year(F.col("session_date")).alias("year_extracted"))


@query("""
WITH p AS (SELECT conv_id, turn + 1 AS page, coalesce(text, '') AS text, CASE conv_id % 3 WHEN 0 THEN 3 WHEN 1 THEN NULL ELSE 1 END AS begins, count(*) OVER (PARTITION BY conv_id) AS n FROM conversations),
s AS (SELECT *, CASE WHEN begins <= n THEN begins ELSE least(2, n) END AS start FROM p)
SELECT 'conv_' || conv_id AS file_id, string_agg(CASE WHEN page = begins THEN 'Registro' || chr(10) || 'Secretario:' || chr(10) ELSE CASE WHEN page = 1 THEN '§Registro manual' || chr(10) || 'Secretario:' || chr(10) ELSE '' END END || text, chr(10) ORDER BY page)
  AS preamble_text FROM s WHERE page = 1 OR page < start GROUP BY 1""")
def preamble_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A roll call on page 1 begins no transcript; page 1 is always of the preamble, and so are the pages before the start."""
    rows = table(spark, sf_dir, "conversations")
    begins = F.when(F.col("conv_id") % 3 == 0, 3).when(F.col("conv_id") % 3 == 2, 1)
    page = (F.col("turn") + 1).cast("int")
    head = F.when(F.coalesce(page == begins, F.lit(False)), "Registro\nSecretario:\n").when(page == 1, "§Registro manual\nSecretario:\n").otherwise("")
    pages = rows.select(F.format_string("conv_%d", "conv_id").alias("file_id"), page.alias("page_num"), F.concat(head, F.coalesce("text", F.lit(""))).alias("text"), F.lit("ok").alias("status"))
    return preamble.with_starts(preamble.gathered(pages)).select("file_id", preamble.preamble_text().alias("preamble_text"))


# ---------------------------------------------------------------- chairs, versions of rules, running lines


def _one_page(spark: SparkSession, sf_dir: str, head: Column) -> DataFrame:
    """(file_id, text): a conversation's turns on one page, each a line `head` and then its text."""
    line = F.concat(head, F.lit("\nUno. "), F.coalesce("text", F.lit("")))
    rows = table(spark, sf_dir, "conversations").select(F.format_string("conv_%d", "conv_id").alias("file_id"), "turn", line.alias("line"))
    return rows.groupBy("file_id").agg(F.concat(F.lit("\n[PAGE 1]\n"), ordered_join("turn", "line", "\n")).alias("text"))


#: Lines of `_one_page` with their places in the prepared text.
_PLACED_SQL = r"""
line AS (SELECT *, head || chr(10) || 'Uno. ' || regexp_replace(coalesce(text, ''), '-\n([a-z])', '\1', 'g') AS line FROM heads),
placed AS (SELECT *, CAST(10 + coalesce(sum(length(line) + 1) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS pos FROM line),
whole AS (SELECT conv_id, chr(10) || '[PAGE 1]' || chr(10) || string_agg(line, chr(10) ORDER BY turn) AS file FROM line GROUP BY 1)"""

_CHAIRS = ("Luis Paz", "María del Mar Ruiz", "Eva Sanz Gil")


@query("WITH heads AS (SELECT *, CASE turn % 4 WHEN 1 THEN '§Presidente:' WHEN 2 THEN CASE WHEN (conv_id + turn) % 5 = 0 THEN '§Asume la Presidencia un miembro:' ELSE '§Preside la sesión el honorable Representante ' || " + _case("(conv_id + turn) % 3", _CHAIRS) + """ || ':' END WHEN 3 THEN '§Presidenta:' ELSE '§Secretaria:' END AS head,
  CASE WHEN turn % 4 = 2 THEN CASE WHEN (conv_id + turn) % 5 = 0 THEN '' ELSE """ + _case("(conv_id + turn) % 3", _CHAIRS) + """ END END AS chair FROM conversations),
{PLACED},
spoken AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS n FROM placed WHERE chair IS NULL),
marks AS (SELECT conv_id AS c, turn AS t, chair AS by FROM placed WHERE chair IS NOT NULL),
named AS (SELECT s.*, nullif(coalesce(m.by, CASE WHEN conv_id % 3 = 0 THEN 'Ana Ruiz Gil' END), '') AS president FROM spoken s ASOF LEFT JOIN marks m ON s.conv_id = m.c AND s.turn > m.t)
SELECT 'conv_' || conv_id AS file_id, n AS position_in_session, regexp_extract(head, '§(.*):', 1) AS attribution_raw,
  CASE WHEN turn % 4 = 0 THEN 'role' WHEN president IS NULL THEN 'uncertain' ELSE 'legislator' END AS speaker_type,
  CASE WHEN turn % 4 = 0 THEN CASE WHEN conv_id % 2 = 0 THEN 'Pedro Gil' END ELSE president END AS speaker_name,
  CASE WHEN turn % 4 <> 0 AND president IS NULL THEN substring(file, greatest(pos - 200, 0) + 1, pos + length(head) + 200 - greatest(pos - 200, 0)) END AS uncertain_context
FROM named JOIN whole USING (conv_id)""".replace("{PLACED}", _PLACED_SQL))
def chair_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Who presides at each turn: the header's chair, then that of the last mark before it; some marks name nobody, some headers name no chair."""
    who = F.element_at(F.array(*(F.lit(x) for x in _CHAIRS)), ((F.col("conv_id") + F.col("turn")) % 3 + 1).cast("int"))
    mark = F.when((F.col("conv_id") + F.col("turn")) % 5 == 0, "§Asume la Presidencia un miembro:").otherwise(F.concat(F.lit("§Preside la sesión el honorable Representante "), who, F.lit(":")))
    k = F.col("turn") % 4
    texts = _one_page(spark, sf_dir, F.when(k == 1, "§Presidente:").when(k == 2, mark).when(k == 3, "§Presidenta:").otherwise("§Secretaria:"))
    number = F.substring("file_id", 6, 20).cast("long")
    named = F.concat(F.lit("ACTA\n"), F.when(number % 3 == 0, "Presidente: honorable Representante Ana Ruiz Gil\n").otherwise(""), F.when(number % 2 == 0, "Secretario General, doctor Pedro Gil\n").otherwise(""))
    found = chairs.resolved(segment.with_cuts(texts, context=segment.CONTEXT), header.officers(texts.select("file_id", named.alias("preamble_text"))))
    return found.select("file_id", F.col("position_in_session").cast("long").alias("position_in_session"), "attribution_raw", "speaker_type", "speaker_name", "uncertain_context")


_OLD_RULES, _NEW_RULES = frozenset(("bold_boundary", "honorable")), frozenset(("honorable", "role_label"))
_HEADS = ("§Secretario General:", "Honorable Senadora Eva Sanz:", "Presidente:", "§Honorable Representante Ana Ruiz:")


@query("WITH heads AS (SELECT *, (conv_id + turn) % 4 AS k, " + _case("(conv_id + turn) % 4", _HEADS) + """ AS head FROM conversations),
{PLACED},
starts AS (SELECT conv_id, 'old' AS side, pos FROM placed WHERE k <> 2 UNION ALL SELECT conv_id, 'new', pos FROM placed WHERE k IN (1, 2)),
spans AS (SELECT conv_id, side, row_number() OVER w AS number, pos AS "start", coalesce(lead(pos) OVER w, length(file)) AS "end" FROM starts JOIN whole USING (conv_id) WINDOW w AS (PARTITION BY conv_id, side ORDER BY pos)),
pairs AS (SELECT a.conv_id, a.number AS a, b.number AS b, a.start = b.start AND a.end = b.end AS equal FROM spans a JOIN spans b ON a.conv_id = b.conv_id AND a.side = 'old' AND b.side = 'new' AND a.start < b.end AND b.start < a.end),
counted AS (SELECT *, count(*) OVER (PARTITION BY conv_id, a) AS of_a, count(*) OVER (PARTITION BY conv_id, b) AS of_b FROM pairs),
facts AS (SELECT conv_id, 'old' AS side, a AS number, of_a AS n, max(of_b) AS m, bool_and(equal) AS equal FROM counted GROUP BY 1, 2, 3, 4 UNION ALL SELECT conv_id, 'new', b, of_b, max(of_a), bool_and(equal) FROM counted GROUP BY 1, 2, 3, 4)
SELECT 'conv_' || conv_id AS file_id, side, number, "start", "end", coalesce(n, 0) AS n_others,
  CASE WHEN n IS NULL THEN CASE side WHEN 'old' THEN 'lost' ELSE 'new' END WHEN n = 1 AND m = 1 AND equal THEN 'same' WHEN n > 1 AND m = 1 THEN 'split' WHEN n = 1 AND m > 1 THEN 'merged' ELSE 'moved' END AS outcome
FROM spans LEFT JOIN facts USING (conv_id, side, number)""".replace("{PLACED}", _PLACED_SQL))
def rule_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transcripts cut by two sets of rules: which turns of either stay, shift, split, merge or go."""
    texts = _one_page(spark, sf_dir, F.element_at(F.array(*(F.lit(x) for x in _HEADS)), ((F.col("conv_id") + F.col("turn")) % 4 + 1).cast("int")))
    spans = [segment.all_turns(segment.with_cuts(texts, rules=r)).select("file_id", "number", "start", "end") for r in (_OLD_RULES, _NEW_RULES)]
    found = versions.compared(*spans)
    return found.select("file_id", "side", *(F.col(c).cast("long").alias(c) for c in ("number", "start", "end", "n_others")), "outcome")


@query("""
WITH p AS (SELECT doc_id, source, CASE WHEN doc_id % 4 = 0 THEN coalesce(text, '') ELSE 'GACETA  DEL CONGRESO ' || doc_id || chr(10) || chr(10) || coalesce(text, '') || chr(10) || 'Página ' || doc_id || ' ' END AS text FROM documents),
l AS (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS raw, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM p),
k AS (SELECT *, regexp_replace(regexp_replace(regexp_replace(regexp_replace(raw, '{WS}+', ' ', 'g'), '^ ', ''), ' $', ''), '[0-9]+', '#', 'g') AS line FROM l),
r AS (SELECT doc_id, source, i, line, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS up, row_number() OVER (PARTITION BY doc_id ORDER BY i DESC) AS down FROM k WHERE line <> ''),
e AS (SELECT doc_id, source, i, line, up AS place FROM r WHERE up <= 2 UNION ALL SELECT doc_id, source, i, line, -down FROM r WHERE down <= 2),
n AS (SELECT source, count(*) AS pages FROM documents GROUP BY 1),
f AS (SELECT source, place, line FROM e JOIN n USING (source) GROUP BY source, place, line, pages HAVING count(*) >= 3 AND count(*) >= 0.5 * pages),
gone AS (SELECT DISTINCT doc_id, i FROM e JOIN f USING (source, place, line))
SELECT doc_id, count(g.i) AS n_suppressed, coalesce(string_agg(raw, chr(10) ORDER BY k.i) FILTER (WHERE g.i IS NULL), '') AS text FROM k LEFT JOIN gone g USING (doc_id, i) GROUP BY 1""")
def running_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as pages of their source, three of four with a head and a numbered foot: both go, and whatever else comes back at a page's edges."""
    docs = table(spark, sf_dir, "documents")
    number, text = F.col("doc_id").cast("string"), F.coalesce("text", F.lit(""))
    framed = F.when(F.col("doc_id") % 4 == 0, text).otherwise(F.concat(F.lit("GACETA  DEL CONGRESO "), number, F.lit("\n\n"), text, F.lit("\nPágina "), number, F.lit(" ")))
    pages = docs.select(F.col("source").alias("file_id"), F.col("doc_id").alias("page_num"), framed.alias("text"), F.lit("ok").alias("status"))
    return running.without(pages).select(F.col("page_num").alias("doc_id"), F.col("n_suppressed").cast("long").alias("n_suppressed"), "text")


# ---------------------------------------------------------------- reports, totals, stores and late files


@query(_SAID_SQL + """,
files AS (SELECT name, file_id, count(*) AS n, min(turn) AS first_turn FROM hits GROUP BY 1, 2),
ranked AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY file_id) AS place, sum(n) OVER (PARTITION BY name) AS n_rows, count(*) OVER (PARTITION BY name) AS n_files FROM files)
SELECT name AS "check", verdict, CAST(n_rows AS BIGINT) AS n_rows, n_files, place, r.file_id, n, first_turn,
  CASE WHEN place <= 3 THEN substring(x, greatest(instr(x, m) - 40, 1), least(instr(x, m) - 1, 40) + length(m) + 40) END AS excerpt
FROM ranked r JOIN hits h USING (name, file_id) WHERE r.first_turn = h.turn AND place <= 5""")
def leak_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per check the first five files that leak, the first leak of each, and excerpts from three."""
    found = checks.leak_report(_leaking(spark, sf_dir), checks.standing("speaker_raw"))
    flat = found.select("check", "verdict", F.col("n").alias("n_rows"), "n_files", F.inline("slices"))
    return flat.select("check", "verdict", "n_rows", "n_files", F.col("place").cast("long").alias("place"), "file_id", "n", F.element_at(F.split("first_id", "_"), 2).cast("long").alias("first_turn"), "excerpt")


@query(SQL["year_ids"])
def year_ids_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Year ids of orders that come in three batches, out of order and one of them twice: each renumbers its months only, and the ids are those of one run."""
    orders = table(spark, sf_dir, "orders")
    store, number = folder(spark, "years"), F.col("o_custkey") * 100_000_000 + F.col("o_orderkey")
    sessions = orders.select("o_orderkey", F.col("o_orderkey").cast("string").alias("file_id"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("session_date"), F.concat(F.lit("No "), number.cast("string")).alias("gaceta_number"))
    for part in (2, 0, 1, 0):
        years.add(sessions.filter(F.col("o_orderkey") % 3 == part), store)
    return years.numbers(spark, store)


@query("""
WITH f AS (SELECT DISTINCT source AS file_id, CAST(doc_id AS VARCHAR) AS speech_id, CASE WHEN n_chars < 500 THEN 'short' ELSE 'long' END AS failure_type, doc_id % 3 AS batch_id FROM documents)
SELECT file_id, speech_id, failure_type, CAST(min(b) AS INTEGER) AS batch_id FROM (SELECT *, batch_id AS b FROM f UNION ALL SELECT file_id, speech_id, failure_type, batch_id, batch_id + 1 FROM f WHERE batch_id < 2) GROUP BY 1, 2, 3""")
def flag_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flags of documents in three batches, each with those of the batch before once more, the last batch twice: every key once, from the batch that had it first."""
    docs = table(spark, sf_dir, "documents")
    found = docs.select(F.col("source").alias("file_id"), F.col("doc_id").cast("string").alias("speech_id"), F.when(F.col("n_chars") < 500, "short").otherwise("long").alias("failure_type"), "doc_id", F.left("text", F.lit(500)).alias("original_excerpt"))
    store = folder(spark, "flags")
    for number in (0, 1, 2, 2):
        flag_store.upsert(found.filter((F.col("doc_id") % 3).isin(number, number - 1)), store, number, buckets=8)
    return flag_store.flags(spark, store).select("file_id", "speech_id", "failure_type", "batch_id")


def _measures(prompt: str) -> str:
    """A stand-in for the header service: it answers with the prompt's length."""
    return f'{{"gaceta_number": "{len(prompt)}"}}'


@query("""
SELECT conv_id, turn, CAST(length(left(coalesce(text, ''), 4000)) AS VARCHAR) AS gaceta_number, 'llm' AS extraction_status FROM conversations""")
def header_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text asked for through the answer store, user turns first and then all: equal texts share an answer, and the second time only the others are asked for."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.format_string("%d_%d", "conv_id", "turn").alias("file_id"), F.col("text").alias("preamble_text"))
    store = folder(spark, "answers")
    enrich.ask_once(rows.filter("role = 'user'"), _measures, store)
    answers = enrich.ask_once(rows, _measures, store)
    found = header.with_service(rows, answers)
    part = lambda i: F.element_at(F.split("file_id", "_"), i).cast("long")
    return found.select(part(1).alias("conv_id"), part(2).alias("turn"), "gaceta_number", "extraction_status")
