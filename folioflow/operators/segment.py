"""Transcript text to attributed turns.

One Arrow function takes a file's text to its clean, numbered turns, in Python's `re`, because that dialect is what the rules are written for, and because
acceptance and numbers depend on earlier turns of the file. Each pattern runs once over a text. One shuffle by file assembles the text; turns of a file stay on its
row until they are exploded.
"""

from __future__ import annotations

import functools
import re
import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioflow.functions import rules as R
from folioflow.functions.text import decode, ordered_join
from folioflow.operators import preamble
from folioflow.session import ship

@functools.cache
def _rules() -> tuple:
    return tuple(r.compiled() for r in R.BOUNDARIES), re.compile(R.NOT_SPEAKERS, re.M), re.compile(R.LETTER_REFERENCE, re.I), re.compile(R.LEADING_RECESS, re.I)


def attribution(match: re.Match) -> str | None:
    """What a match attributes a turn to; None where that is no speaker."""
    _, banned, letter, recess = _rules()
    text = recess.sub("", match[1].replace(R.BOLD, "").strip()).strip()
    head = text[:1]
    if banned.match(text) or letter.search(text) or (head.isalpha() and head == head.lower()):
        return None
    return text if len(" ".join(text.split())) <= R.LONGEST_ATTRIBUTION else None


def boundaries(text: str, rules: frozenset[str] | None = None) -> list[tuple[int, int, int, str]]:
    """Accepted (priority, pos, end, attribution) by position, of all rules or of those named.

    Matches are weighed rule by rule. One that starts inside an accepted match is not accepted, and takes nothing from later ones.
    """
    taken = bytearray(len(text) + 1)
    found = []
    folded = text.casefold()
    for priority, pattern in enumerate(_rules()[0], 1):
        if rules is not None and R.BOUNDARIES[priority - 1].name not in rules:
            continue
        needs = R.BOUNDARIES[priority - 1].needs
        for m in () if needs and not any(x in folded for x in needs) else pattern.finditer(text):
            if not taken[m.start()] and (who := attribution(m)) is not None:
                taken[m.start() : m.end()] = b"\1" * (m.end() - m.start())
                found.append((priority, m.start(), m.end(), who))
    return sorted(found, key=lambda b: b[1])


@functools.cache
def _in_turns() -> dict[str, re.Pattern]:
    flags = {"PAGE_MARK": 0, "GLYPH_LINE": 0, "SESSION_CLOSE": re.I, "DASH_LINE": 0, "PROCEDURAL": re.M, "CHAIR_CHANGE": re.I, "CHAIR_MARK": re.I, "CONTINUATION": re.I, "VOTE": re.I, "NAME": 0, "TITLES": re.I}
    return {name: re.compile(getattr(R, name), flag) for name, flag in flags.items()}


def cleaned(raw: str) -> str:
    """A turn's text without marks, glyph lines, what follows the session's close, dash lines and marks of bold print."""
    rule, text = _in_turns(), raw.strip()
    if "[PAGE " in text:
        text = rule["PAGE_MARK"].sub("", text).strip()
    if text.count("(cid:") >= 10:
        text = rule["GLYPH_LINE"].sub("", text).strip()
    close = rule["SESSION_CLOSE"].search(text)
    if close:
        text = text[: close.start()].strip()
    if text.startswith("-") or "\n-" in text:
        text = rule["DASH_LINE"].sub("", text).strip()
    if R.BOLD in text:
        text = re.sub("(?m)^" + R.BOLD, "", text).strip()
    return text


def new_chair(attribution: str, raw: str) -> str | None:
    """Who takes the chair by the last mark in an attribution or at a line's start; empty where a mark names nobody, None without a mark."""
    rule, found = _in_turns(), None
    lines = [attribution] if rule["CHAIR_CHANGE"].search(attribution) else []
    for line in [*lines, *raw.split("\n")]:
        mark = rule["CHAIR_MARK"].match(line.lstrip(R.BOLD + " "))
        if mark:
            name = rule["NAME"].search(rule["TITLES"].sub("", mark.string[mark.end() :], count=1))
            found = " ".join(name[0].split()) if name else ""
    return found


_INT, _TEXT, _FLAG = T.IntegerType(), T.StringType(), T.BooleanType()
_FIELDS = {"number": _INT, "position": _INT, "start": _INT, "end": _INT, "attribution": _TEXT, "shown": _TEXT, "speech_text": _TEXT, "word_count": _INT, "is_continuation": _FLAG, "record_type": _TEXT, "chair": _TEXT, "context": _TEXT}
TURN = T.StructType([T.StructField(n, kind) for n, kind in _FIELDS.items()])
#: Code points before and after a boundary that `context` has.
CONTEXT = 200


def cut(text: str, rules: frozenset[str] | None = None, context: int = 0) -> list[dict[str, object]]:
    """The turns of a file's text, and the changes of the chair between them (position None).

    rules names the rules for boundaries that are used; start and end are the turn's place in the prepared text, its mark included.
    """
    text = prepared(text)
    found = boundaries(text, rules)
    if not found:
        return []
    upto = [b[1] for b in found[1:]] + [len(text)]
    rule, out, position = _in_turns(), [], 0
    for number, ((_, start, after, who), end) in enumerate(zip(found, upto, strict=True), 1):
        raw = text[after : max(after, end)]
        speech = cleaned(raw)
        chair = new_chair(who, raw)
        turn = dict.fromkeys(TURN.names) | {"number": number, "start": start, "end": end, "attribution": who, "chair": chair}
        if speech and not rule["PROCEDURAL"].match(speech[:50]) and not rule["CHAIR_CHANGE"].search(who):
            position += 1
            votes = len(rule["VOTE"].findall(speech))
            turn |= {"position": position, "shown": decode(" ".join(who.split())), "speech_text": speech, "word_count": len(speech.split()), "is_continuation": bool(rule["CONTINUATION"].search(who)), "record_type": "vote_tally" if votes >= R.VOTES else "speech"}
            turn["context"] = text[max(0, start - context) : after + context] if context else None
            out.append(turn)
        elif chair is not None:
            out.append(turn)
    return out


CUT = T.StructType([T.StructField("turns", T.ArrayType(TURN)), T.StructField("error", T.StringType())])


def cutter(rules: frozenset[str] | None = None, context: int = 0) -> Callable[[Column | str], Column]:
    """A column of turns of each text, or the error that it makes: one bad file is a row, and does not lose the others."""

    def run(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for t in texts:
            try:
                rows.append((cut(t or "", rules, context), None))
            except Exception as e:  # noqa: BLE001
                rows.append((None, f"{type(e).__name__}: {e}"[:500]))
        return pd.DataFrame(rows, columns=["turns", "error"])

    run.__annotations__ = {"texts": pd.Series, "return": pd.DataFrame}
    return F.pandas_udf(run, CUT)


cut_file = cutter()


def prepared(text: str) -> str:
    """Normal form C, divided words joined, bold runs merged, undecodable bold lines replaced."""
    if not text.isascii():
        text = unicodedata.normalize("NFC", text)
    return re.sub(R.GLYPH_BOLD_LINE, R.GLYPH_ATTRIBUTION, merge_bold(re.sub(R.DIVIDED, "", text)))


def merge_bold(text: str) -> str:
    """Runs of bold lines become one line; words divided inside it are joined."""
    out: list[str] = []
    run: list[str] = []

    def close() -> None:
        if len(run) > 1:
            joined = " ".join([run[0], *(line.lstrip(R.BOLD) for line in run[1:])])
            out.append(re.sub(r"-\s+([a-záéíóúñü])", r"\1", joined))
        else:
            out.extend(run)
        run.clear()

    for line in text.split("\n"):
        if len(line) > 1 and line[0] == R.BOLD:
            run.append(line)
        else:
            close()
            out.append(line)
    close()
    return "\n".join(out)


def file_text(pages: DataFrame) -> DataFrame:
    """(file_id, text) of the readable pages, each behind its mark."""
    ok = pages.filter("status = 'ok'").select("file_id", "page_num", preamble.marked(F.col("page_num"), F.col("text")).alias("text"))
    return ok.groupBy("file_id").agg(ordered_join("page_num", "text", "\n").alias("text"))


def turns(pages: DataFrame, version: str = R.VERSION) -> DataFrame:
    """Turns of transcript pages (file_id, page_num, text, status). A file that cannot be cut is an error here."""
    texts = with_cuts(file_text(pages))
    return turns_of(texts.withColumn("turns", F.when(F.col("error").isNotNull(), F.raise_error(F.concat_ws(": ", "file_id", "error"))).otherwise(F.col("turns"))), version)


def with_cuts(texts: DataFrame, rules: frozenset[str] | None = None, context: int = 0) -> DataFrame:
    """Replaces text of files' texts (file_id, text, ...) by turns and error."""
    ship(texts.sparkSession)
    by = cut_file if rules is None and not context else cutter(rules, context)
    return texts.withColumn("_cut", by("text")).withColumns({"turns": F.col("_cut.turns"), "error": F.col("_cut.error")}).drop("_cut", "text")


def all_turns(cuts: DataFrame) -> DataFrame:
    """A row for each entry of `turns`, changes of the chair included."""
    return cuts.select("file_id", F.inline("turns"))


def turns_of(cuts: DataFrame, version: str = R.VERSION, *more: str) -> DataFrame:
    """Turns of files (file_id, turns of `with_cuts`); more names further fields of them."""
    return all_turns(cuts).filter("position is not null").select(
        "file_id",
        F.format_string("%s_%03d", "file_id", "position").alias("speech_id"),
        F.col("position").alias("position_in_session"),
        F.col("shown").alias("attribution_raw"),
        "speech_text",
        "word_count",
        "is_continuation",
        "record_type",
        F.lit(version).alias("rule_version"),
        *more,
    )
