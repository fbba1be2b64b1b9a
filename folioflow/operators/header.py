"""Header fields by rule, repair of service answers, and confidences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.functions import rules as R
from folioflow.functions.text import strip

SERVICE = "gaceta_number string, publication_date string, publication_date_confidence string, session_date string, session_date_confidence string, chamber string, committee string, committee_confidence string, document_type string"


def _first(text: Column, pattern: str, group: int) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def _iso(dates: Column, number: int) -> Column:
    """The number-th of long dates as ISO text. The day is not checked against the calendar."""
    months = F.create_map(*(F.lit(x) for i, m in enumerate(R.MONTHS, 1) for x in (m, f"{i:02d}")))
    words = F.split(F.try_element_at(dates, F.lit(number)), r"\s+")  # day, de, month, de, year
    return F.when(F.size(dates) >= number, F.format_string("%s-%s-%02d", words[4], F.try_element_at(months, F.lower(words[2])), words[0].cast("int")))


def fields(texts: DataFrame, text: Column) -> tuple[DataFrame, dict[str, Column]]:
    """texts with what several fields are made of, found once, and the header fields of `text` as columns of it."""
    committee = F.regexp_replace(strip(_first(text, "(?iud)" + R.COMMITTEE, 0)), r"[:\n]+\z", "")
    found = texts.withColumns({"_dates": F.regexp_extract_all(text, F.lit("(?iu)" + R.LONG_DATE), F.lit(0)), "_house": F.lower(_first(text, "(?iu)" + R.CHAMBER, 1)), "_committee": committee})
    house, dates = F.col("_house"), F.col("_dates")
    return found, {
        "gaceta_number": F.translate(_first(text, "(?iu)" + R.GAZETTE_NUMBER, 1), ".,", ""),
        "publication_date": _iso(dates, 1),
        "publication_date_confidence": F.when(F.size(dates) >= 1, "low"),
        "session_date": _iso(dates, 2),
        "session_date_confidence": F.when(F.size(dates) >= 2, "low"),
        "chamber": F.when(F.contains(house, F.lit("mara")), "camara").when(F.contains(house, F.lit("senado")), "senado").when(F.contains(house, F.lit("conjunta")), "mixed"),
        "committee": F.col("_committee"),
        "committee_confidence": F.when(F.col("_committee").isNotNull(), "low"),
        "document_type": F.when(text.rlike("(?iu)" + R.ACT), "session_transcript").otherwise("unknown"),
        "date_source": F.lit("header_extracted"),
    }


def by_rule(preambles: DataFrame, status: str = "rule_based") -> DataFrame:
    """(file_id, preamble_text) to header fields."""
    found, made = fields(preambles.select("file_id", "preamble_text"), F.coalesce("preamble_text", F.lit("")))
    return found.select("file_id", *(c.alias(k) for k, c in made.items()), F.lit(status).alias("extraction_status"))


def officers(preambles: DataFrame) -> DataFrame:
    """(file_id, presiding_officer, secretary) that a preamble (file_id, preamble_text) names behind their roles at a line's start; null where it names none."""
    named = lambda role: _first(F.coalesce("preamble_text", F.lit("")), rf"(?md)^§?{role}\s*[:,]?\s+(?i:el |la |honorable |representante |senadora? |doctora? )*({R.NAME})", 1)
    return preambles.select("file_id", named("President[ea]").alias("presiding_officer"), named("Secretari[oa](?: General)?").alias("secretary"))


def repaired(answer: Column) -> Column:
    """A service's answer without thinking blocks, fences and words before the first brace."""
    text = strip(F.regexp_replace(strip(answer), r"(?s)<think>.*?</think>", ""))
    text = strip(F.regexp_replace(F.regexp_replace(text, r"^```[a-z]*\n?", ""), r"\n?```\z", ""))
    return F.regexp_replace(text, r"\A[^{]+(?=\{)", "")


def with_service(preambles: DataFrame, answers: DataFrame, status: str = "llm") -> DataFrame:
    """Header fields from answers (file_id, answer, error) where they parse, by rule elsewhere.

    The service itself is a plug-in (`sources.enrich`); its errors choose the status: unreachable, or the error's name.
    """
    names = [f.split()[0] for f in SERVICE.split(", ")]
    given = answers.select("file_id", "answer", "error", repaired(F.col("answer")).alias("_fixed"))
    good = F.col("answer").isNotNull() & F.col("error").isNull() & F.try_parse_json("_fixed").isNotNull()
    joined = preambles.select("file_id", "preamble_text").join(given, "file_id", "left").withColumn("p", F.when(good, F.from_json("_fixed", SERVICE)))
    # Rules read the texts that have no answer.
    joined = joined.withColumn("_text", F.when(F.col("p").isNull(), F.coalesce("preamble_text", F.lit(""))))
    found, ruled = fields(joined, F.col("_text"))
    state = F.when(F.col("p").isNotNull(), status).when(F.col("error") == "unreachable", "rule_based_ollama_unreachable").when(F.col("error").isNotNull(), F.concat(F.lit("rule_based_error:"), "error")).when(F.col("answer").isNotNull(), "rule_based_error:JSONDecodeError").otherwise("rule_based")
    return found.select("file_id", *(F.when(F.col("p").isNotNull(), F.col(f"p.{n}")).otherwise(ruled[n]).alias(n) for n in names), ruled["date_source"].alias("date_source"), state.alias("extraction_status"))


def lowest_confidence(*confidences: Column) -> Column:
    """The lowest of the given confidences; unknown words rank last, the first of equals wins, `unknown` if there is none."""
    ranks = F.create_map(*(F.lit(x) for i, c in enumerate(R.CONFIDENCE) for x in (c, i)))
    all_ = F.filter(F.array(*confidences), lambda c: c.isNotNull() & (c != ""))
    ranked = F.transform(all_, lambda c, i: F.struct(F.coalesce(F.try_element_at(ranks, c), F.lit(9)).alias("rank"), i.alias("i"), c.alias("c")))
    return F.coalesce(F.array_min(ranked)["c"], F.lit("unknown"))


def year(date: Column) -> Column:
    return F.substring(date, 1, 4).try_cast("int")
