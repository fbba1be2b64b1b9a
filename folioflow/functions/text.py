"""Column helpers with Python's notion of white space, and the few Unicode functions that Spark lacks."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioflow.functions import rules as R
from folioflow.session import ship

#: What str.strip() and str.split() take for white space, as a Java character class.
SPACE = r"\x09-\x0D\x1C-\x20\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000"

# Glyph codes whose offset falls outside the letters, and punctuation that the offset may yield.
GLYPHS = {105: "á", 112: "é", 116: "í", 120: "ñ", 121: "ó", 126: "ú"}
GLYPH_PUNCTUATION = ",.:-"
GLYPH_OFFSET = 29
GLYPH_MARK = "(cid:"
#: Codes of more digits are beyond every character.
_CODE = re.compile(r"0*(\d{1,7})\)")


def strip(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, f"^[{SPACE}]+", ""), f"[{SPACE}]+\\z", "")


def squash(c: Column) -> Column:
    """Words joined by single blanks."""
    return strip(F.regexp_replace(c, f"[{SPACE}]+", " "))


def word_count(c: Column) -> Column:
    return F.regexp_count(c, F.lit(f"[^{SPACE}]+")).cast("long")


def hyphen_join(c: Column) -> Column:
    """Joins words that were divided at a line's end before an ASCII lower-case letter."""
    return F.regexp_replace(c, R.DIVIDED, "")


def drop(c: Column, *patterns: str) -> Column:
    """Removes the matches of one pattern after the other, stripping after each."""
    for p in patterns:
        c = strip(F.regexp_replace(c, p, ""))
    return c


def ordered_join(order: str, value: str, separator: str) -> Column:
    """Aggregate: values joined in order."""
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, value))), lambda x: x[value]), separator)


def glyph(number: int) -> str | None:
    """The character of a glyph code; None where the code's offset is no letter, white space or listed punctuation."""
    if number in GLYPHS:
        return GLYPHS[number]
    if number + GLYPH_OFFSET > 0x10FFFF:
        return None
    c = chr(number + GLYPH_OFFSET)
    return c if c.isalpha() or c.isspace() or c in GLYPH_PUNCTUATION else None


class _Decoded(dict):
    """What stands behind a mark, with its code decoded. Texts have few of them, many times."""

    def __missing__(self, part: str) -> str:
        found = _CODE.match(part)
        c = glyph(int(found[1])) if found else None
        value = GLYPH_MARK + part if c is None else c + part[found.end() :]
        if len(part) < 32 and len(self) < 100_000:
            self[part] = value
        return value


_decoded = _Decoded()


def decode(text: str) -> str:
    head, *parts = text.split(GLYPH_MARK)
    return head + "".join(map(_decoded.__getitem__, parts)) if parts else text


@F.pandas_udf(T.StringType())
def _decode_udf(s: pd.Series) -> pd.Series:
    return s.map(decode, na_action="ignore")


def decode_glyphs(c: Column) -> Column:
    """Residual `(cid:n)` codes as characters."""
    ship(SparkSession.active())
    return _decode_udf(c)

