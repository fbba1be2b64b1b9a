"""Language identification by compression with zstandard raw-content dictionaries.

Method
------
1. For each language a bounded sample of the labelled training texts becomes the content of its dictionary: at most
   `SAMPLE_TEXTS` distinct texts, those of up to `MODERATE` bytes and the smallest hashes first, and `DICTIONARY` bytes in all. Texts enter whole;
   one that no longer fits is passed over. These three are the documented bounds of the fit; classification reads every whole text.
2. Texts and dictionaries are lower-cased, ASCII other than letters becomes white space, and of a word's repeats in
   a row one stays. A text is encoded with every language's dictionary. The smallest encoding names the language; equal sizes go
   to the language of more training texts, then by name.
3. The margin to the second smallest, in bits, gives the score; narrow margins mark the answer as rejected (it is still named).

Defined results: a null text or one without a letter is "und" with score 0. Repeated rows get equal answers. Rows with a null language
teach nothing. Without any training language all answers are "und". Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folioflow.llm import kernel as K
from folioflow.llm.scratch import broadcast, doc_remainder, ship, table

SAMPLE_TEXTS = 256
MODERATE = 4096
DICTIONARY = 192 * 1024
WIDER = 8
LEVEL = 3
#: Rejected where the second smallest encoding is less than this share larger.
MARGIN = 0.01
#: Bits of margin for each step of the score.
SCALE = 24.0
_BLANK = bytes(c if c >= 0x80 or chr(c).isalpha() else 0x20 for c in range(256))


def normal(text: str) -> bytes:
    words = text.lower().encode().translate(_BLANK).split()
    return b" ".join(w for w, before in zip(words, [b"", *words], strict=False) if w != before)


def sample(train: DataFrame, texts: dict[str, int], most: int = SAMPLE_TEXTS) -> DataFrame:
    """(lang, rank, text) of the dictionaries: of each language (with its number of distinct texts) distinct ones in the order in which they enter.

    A threshold on the hash, several times wider than needed, leaves only candidates to be shuffled.
    """
    if not texts:
        return train.select("lang", F.lit(0).alias("rank"), "text").limit(0)
    bounds = train.sparkSession.createDataFrame([(k, min(1.0, WIDER * most / max(n, 1))) for k, n in texts.items()], "_l string, _share double")
    h = F.pmod(F.xxhash64("text"), F.lit(1 << 40))
    rows = train.filter("lang is not null and text is not null").join(F.broadcast(bounds), F.col("lang") == F.col("_l"))  # a row for each language
    near = rows.withColumn("h", h).filter(F.col("h") <= F.col("_share") * F.lit(float(1 << 40)))
    once = near.groupBy("lang", "h").agg(F.first("text").alias("text"))
    order = Window.partitionBy("lang").orderBy(F.octet_length("text") > MODERATE, "h")
    return once.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most).select("lang", "rank", "text")


def dictionaries(train: DataFrame, size: int = DICTIONARY) -> list[tuple[str, bytes]]:
    """Content of each language's dictionary, the language of the most texts first."""
    # Copies count for the order, but not for the share of the hashes: a language of many copies would get too few texts.
    copies = train.filter("lang is not null and text is not null").groupBy("lang", F.xxhash64("text").alias("h")).agg(F.count(F.lit(1)).alias("rows"))
    found = copies.groupBy("lang").agg(F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("distinct")).collect()
    texts = {r["lang"]: r["rows"] for r in found}
    out: dict[str, bytes] = {}
    for row in sorted(sample(train, {r["lang"]: r["distinct"] for r in found}).collect(), key=lambda r: (r["lang"], r["rank"])):
        had, more = out.get(row["lang"], b""), b" " + normal(row["text"])
        if not had or len(had) + len(more) <= size:
            out[row["lang"]] = had + more
    return sorted(out.items(), key=lambda x: (-texts[x[0]], x[0]))


class Classifier:
    def __init__(self, content: list[tuple[str, bytes]], level: int = LEVEL):
        self.names = [n for n, _ in content]
        self.coders = [_coder(data, level) for _, data in content]

    def __call__(self, text: str | None) -> tuple[str, float, bool]:
        if not self.names or text is None or not any(map(str.isalpha, text)):
            return "und", 0.0, True
        raw = normal(text)
        sizes = np.array([len(c.compress(raw)) for c in self.coders])
        best = int(sizes.argmin())
        more = sizes - sizes[best]
        score = float(1 / np.exp2(-8.0 * more / SCALE).sum())
        return self.names[best], score, len(more) > 1 and bool(np.partition(more, 1)[1] < MARGIN * sizes[best])


def _coder(content: bytes, level: int):
    import zstandard as z

    d = z.ZstdCompressionDict(content, dict_type=z.DICT_TYPE_RAWCONTENT)
    d.precompute_compress(level=level)
    return z.ZstdCompressor(dict_data=d, write_checksum=False, write_content_size=False, write_dict_id=False)


def classify(docs: DataFrame, content: list[tuple[str, bytes]], keep: list[str], text: str = "text", level: int = LEVEL) -> DataFrame:
    """The columns in keep, lang_pred, score and rejected."""
    ship(docs.sparkSession)
    shared = broadcast(docs.sparkSession, content)
    names = [*keep, "lang_pred", "score", "rejected"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = Classifier(shared.value, level)
        for batch in batches:
            found = [of(x.as_py()) for x in batch.column(0)]
            lang, score, rejected = zip(*found, strict=True) if found else ((), (), ())
            yield pa.record_batch([*batch.columns[1:], pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())], names)

    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.select(*keep).schema) + "lang_pred string, score double, rejected boolean"
    return docs.select(F.col(text).alias("_text"), *keep).mapInArrow(K.tidy(run), schema)


def identify(docs: DataFrame, held_out: Column, keep: list[str]) -> DataFrame:
    """Learns from rows that are not held out, and classifies all."""
    content = dictionaries(docs.filter(~held_out).select("lang", "text"))
    return classify(docs.withColumn("held_out", held_out).select(*keep, "held_out", "text"), content, [*keep, "held_out"])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"), doc_remainder() == 0, ["doc_id"])
