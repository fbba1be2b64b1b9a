"""Quality rules: a modified Kneser-Ney n-gram model, with a perplexity band for each language.

Method
------
1. `count_ngrams` counts byte n-grams (default order 5) of the running text, in which single blanks stand between words, by language,
   over all texts: the first bytes of a word are predicted from the words before it. A Python combiner sums them by task, Spark sums them over the corpus.
2. `fit` turns the counts into an interpolated modified Kneser-Ney model (three discounts an order,
   continuation counts below the top). Each order is one sorted array of 64-bit hashes of
   (language, n-gram) with log probabilities beside it, and one of contexts with back-off weights.
   Every counted n-gram of every language enters, so the model grows with the corpus. The driver takes
   the counts of a few languages at a time. Nothing is cut or sampled.
3. `measure` gives each text its base metrics and its mean log probability a byte (a word may be one of another language, at a
   price, so that clean texts that mix languages are not rejected for it); `bands` takes
   the median and the spreads below and above it of the languages' perplexities over all texts that pass the base rules;
   `verdict` rejects texts outside the band, which narrows with the root of a text's length.

Defined results: a null text has no words and fails the base rules, like an empty one. A null language is a
language of its own, "und". Rows are judged one by one: repeated rows get equal verdicts. `select` gives back all columns of its
input with their values, whatever their names; in `judge`, a column to be kept that has the name of an added one gives way to it. An empty table gives
an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.llm import kernel as K
from folioflow.llm.scratch import broadcast, carried, kinds, materialize, ship, table

ORDER = 5
#: Counts that the driver takes at once; a language is never split.
FIT_ROWS = 2_000_000
#: Bytes of texts that are worked on at once; distinct n-grams that a task holds.
CHUNK_BYTES, FLUSH = 1 << 19, 1 << 21
REPEAT_WINDOW = 5
#: Half widths of the band in robust standard deviations, and the least deviation of a text of one byte, in bits.
BAND_Z, LEAST_SPREAD = 4.0, 1.0
#: Bits a byte from which a word is odd in its text's language, and what a word of another language costs.
ODD_BITS, SWITCH_BITS = 2.8, 2.0
SYMBOLS = K.byte_set(*((ord(c), ord(c)) for c in "#*$%&|<>"))
_LANG_SALT = np.uint64(0xD6E8FEB86659FD93)


# ---------------------------------------------------------------- texts


def base_metrics(chunk: K.Chunk, starts: np.ndarray, ends: np.ndarray, first: np.ndarray, prefix: np.ndarray, hashes: np.ndarray) -> dict[str, np.ndarray]:
    """Words, code points in words, symbols, repeated lines and words in repeated windows, by document."""
    data, offs, docs = chunk.data, chunk.offs, chunk.docs
    heads = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    symbols = np.concatenate([[0], np.cumsum(SYMBOLS[data])])
    out = {"n_words": np.diff(first), "word_chars": K.per_doc(heads[ends] - heads[starts], first), "n_symbols": symbols[offs[1:]] - symbols[offs[:-1]]}

    owner = K.of_doc(first).astype(np.uint64)
    newline = K.byte_set((0x0A, 0x0A))
    l_starts, l_ends, l_first = K.spans(chunk, newline)
    worded = np.searchsorted(starts, l_starts) < np.searchsorted(starts, l_ends)
    l_doc = K.of_doc(l_first)[worded]
    l_hash = K.span_hash(prefix, l_starts[worded], l_ends[worded])
    _, where = np.unique(K.mix(l_hash + l_doc.astype(np.uint64) * _LANG_SALT), return_index=True)
    again = np.ones(len(l_doc), bool)
    again[where] = False
    out["n_dup_lines"] = np.bincount(l_doc[again], minlength=docs)

    k = REPEAT_WINDOW
    rolled = K.windows(hashes, k)
    covered = np.zeros(len(hashes), np.int64)
    if len(rolled):
        fits = np.flatnonzero(owner[: len(rolled)] == owner[k - 1 :])
        keys = K.mix(rolled[fits] + owner[fits] * _LANG_SALT)
        order = np.argsort(keys)
        ranked = keys[order]
        same = ranked[1:] == ranked[:-1]
        twice = np.zeros(len(keys), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        at = fits[twice]
        edges = np.bincount(at, minlength=len(hashes) + 1) - np.bincount(at + k, minlength=len(hashes) + 1)[: len(hashes) + 1]
        covered = np.cumsum(edges)[: len(hashes)] > 0
    out["n_repeat_words"] = K.per_doc(covered, first)
    return out


def running(chunk: K.Chunk, starts: np.ndarray, ends: np.ndarray, first: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed n-grams of the running texts (of each byte of a word, and the blank behind it), and each word's first and number."""
    events = ends - starts + 1
    edges = np.concatenate([[0], np.cumsum(events)])
    at, total = edges[:-1], int(edges[-1])
    own = np.repeat(np.arange(len(events)), events)
    # Every text begins with order - 1 bytes of which the last is a blank; a blank stands behind every word.
    place = np.arange(total) + (order - 1) * (K.of_doc(first)[own] + 1)
    flat = np.zeros(total + (order - 1) * (len(first) - 1), np.uint8)
    inside = np.ones(total, bool)
    inside[edges[1:] - 1] = False
    flat[place] = 0x20
    flat[place[inside]] = chunk.data[(starts[own] + np.arange(total) - at[own])[inside]]
    flat[edges[first[:-1]] + (order - 1) * np.arange(1, len(first)) - 1] = 0x20
    keys = np.zeros(max(0, len(flat) - order + 1), np.uint64)
    for j in range(order):
        keys = (keys << np.uint64(8)) | flat[j : j + len(keys)]
    return keys[place - (order - 1)], at, events


def _by_lang(lang: pa.Array, chunk: K.Chunk) -> tuple[list[str], np.ndarray]:
    codes = lang.slice(chunk.lo, chunk.docs).fill_null("und").dictionary_encode()
    return codes.dictionary.to_pylist(), codes.indices.to_numpy(zero_copy_only=False)


# ---------------------------------------------------------------- model


def count_ngrams(docs: DataFrame, order: int = ORDER, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, ngram, n) over all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, K.Counter] = {}

        def counted() -> Iterator[pa.RecordBatch]:
            for name, c in sums.items():
                keys, n = c.result()
                for a in range(0, len(keys), 1 << 17):
                    part = keys[a : a + (1 << 17)]
                    yield pa.record_batch([pa.array([name] * len(part)), pa.array(part.view(np.int64)), pa.array(n[a : a + (1 << 17)])], ["lang", "ngram", "n"])

        for batch in batches:
            for chunk in K.chunks(batch.column(1), CHUNK_BYTES):
                names, code = _by_lang(batch.column(0), chunk)
                starts, ends, first = K.spans(chunk, K.WHITE)
                keys, _, events = running(chunk, starts, ends, first, order)
                owner = np.repeat(code[K.of_doc(first)], events)
                for i, name in enumerate(names):
                    sums.setdefault(name, K.Counter()).add(keys[owner == i] if len(names) > 1 else keys)
            if sum(len(c.keys) for c in sums.values()) > FLUSH:
                yield from counted()
                sums.clear()
        yield from counted()

    ship(docs.sparkSession)
    return docs.select(F.col(lang).alias("lang"), F.col(text).alias("text")).mapInArrow(K.tidy(count), "lang string, ngram long, n long").groupBy("lang", "ngram").agg(F.sum("n").alias("n"))


class KneserNey:
    """Interpolated modified Kneser-Ney over packed byte n-grams, in sorted hash arrays."""

    def __init__(self, order: int, langs: list[str]):
        self.order, self.langs = order, {x: i for i, x in enumerate(langs)}
        self.grams: list[tuple[np.ndarray, np.ndarray]] = []  # by order, lowest first: hashes, log probability
        self.contexts: list[tuple[np.ndarray, np.ndarray]] = []  # hashes, log back-off weight

    @staticmethod
    def _hash(keys: np.ndarray, lang: np.ndarray | int) -> np.ndarray:
        return K.mix(keys + (np.atleast_1d(lang).astype(np.uint64) + np.uint64(1)) * _LANG_SALT)

    @classmethod
    def fit(cls, counts: Mapping[str, tuple[np.ndarray, np.ndarray]], order: int) -> KneserNey:
        """counts is read once for each language, in sorted order."""
        model = cls(order, sorted(counts))
        grams: list[list] = [[] for _ in range(order)]
        contexts: list[list] = [[] for _ in range(order)]
        for name, i in model.langs.items():
            levels = [K.sum_by(*counts[name])]
            for k in range(order - 1, 0, -1):
                lower = levels[0][0] & np.uint64((1 << (8 * k)) - 1)
                levels.insert(0, K.sum_by(lower, np.ones(len(lower), np.int64)))
            below_keys, below_p = None, None
            for k, (keys, n) in enumerate(levels):
                n = n.astype(np.float64)
                discounts = _discounts(n)
                head = keys >> np.uint64(8)
                new = np.flatnonzero(np.concatenate([[True], head[1:] != head[:-1]])) if len(keys) else np.zeros(0, np.int64)
                total = np.add.reduceat(n, new) if len(keys) else n
                taken = discounts[np.minimum(n, 3).astype(int)]
                gamma = np.add.reduceat(taken, new) / total if len(keys) else n
                place = np.repeat(np.arange(len(new)), np.diff(np.append(new, len(keys))))
                if k:
                    lower = below_p[np.searchsorted(below_keys, keys & np.uint64((1 << (8 * k)) - 1))]
                else:
                    lower = np.full(len(keys), 1 / 256)
                p = (n - taken) / total[place] + gamma[place] * lower
                grams[k].append((cls._hash(keys, i), np.log(p).astype(np.float32)))
                contexts[k].append((cls._hash(head[new], i), np.log(gamma).astype(np.float32)))
                below_keys, below_p = keys, p
        for source, target in ((grams, model.grams), (contexts, model.contexts)):
            for parts in source:
                hashes = np.concatenate([h for h, _ in parts] or [np.zeros(0, np.uint64)])
                values = np.concatenate([v for _, v in parts] or [np.zeros(0, np.float32)])
                parts.clear()
                by = np.argsort(hashes)
                target.append((hashes[by], values[by]))
        return model

    def log_p(self, keys: np.ndarray, lang: np.ndarray) -> np.ndarray:
        """Natural log probability of each n-gram's last byte after its first ones."""
        out, left, at = np.zeros(len(keys)), np.arange(len(keys)), self.order
        while at and len(left):
            table, p = self.grams[at - 1]
            where, hit = K.find(table, self._hash(keys, lang))
            out[left[hit]] += p[where[hit]] if len(table) else 0
            left, keys, lang = left[~hit], keys[~hit], lang[~hit]
            table, gamma = self.contexts[at - 1]
            where, hit = K.find(table, self._hash(keys >> np.uint64(8), lang))
            out[left[hit]] += gamma[where[hit]] if len(table) else 0
            at -= 1
            keys = keys & np.uint64((1 << (8 * at)) - 1)
        out[left] += np.log(1 / 256)
        return out

    def switched(self, own: np.ndarray, keys: np.ndarray, at: np.ndarray, events: np.ndarray) -> np.ndarray:
        """Log probabilities of words, where a word that is odd in its text's language may be one of another for SWITCH_BITS more."""
        odd = np.flatnonzero(own < -ODD_BITS * np.log(2) * events)
        size = events[odd]
        first = np.cumsum(size) - size
        mine = keys[np.repeat(at[odd], size) + np.arange(int(size.sum())) - np.repeat(first, size)]
        out = own.copy()
        for i in self.langs.values() if len(odd) else ():
            lp = np.concatenate([[0], np.cumsum(self.log_p(mine, np.full(len(mine), i)))])
            out[odd] = np.maximum(out[odd], lp[first + size] - lp[first] - SWITCH_BITS * np.log(2))
        return out


def _discounts(n: np.ndarray) -> np.ndarray:
    """0 and the discounts of counts 1, 2, and 3 or more, by Chen and Goodman's estimate."""
    n1, n2, n3, n4 = (max(int((n == i).sum()), 1) for i in (1, 2, 3, 4))
    y = n1 / (n1 + 2 * n2)
    return np.array([0, *(float(np.clip(i - (i + 1) * y * b / a, 0.1, i - 0.1)) for i, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4)))])


class _Counts(Mapping):
    """Counts by language, fetched for a few languages at a time in sorted order."""

    def __init__(self, counted: DataFrame, rows: int):
        self.counted, self.held = counted, {}
        self.batch: dict[str, list[str]] = {}
        batch, size = [], 0
        for r in sorted(counted.groupBy("lang").agg(F.count(F.lit(1)).alias("grams")).collect(), key=lambda r: r["lang"]):
            if batch and size + r["grams"] > rows:
                batch, size = [], 0
            batch.append(r["lang"])
            size += r["grams"]
            self.batch[r["lang"]] = batch

    def __iter__(self) -> Iterator[str]:
        return iter(self.batch)

    def __len__(self) -> int:
        return len(self.batch)

    def __getitem__(self, name: str) -> tuple[np.ndarray, np.ndarray]:
        if name not in self.held:
            self.held = {}
            got = self.counted.filter(F.col("lang").isin(self.batch[name])).toArrow()
            langs = got.column("lang").combine_chunks().dictionary_encode()
            keys, n, of = got.column("ngram").to_numpy(), got.column("n").to_numpy(), langs.indices.to_numpy()
            self.held = {x: (keys[of == i].view(np.uint64), n[of == i]) for i, x in enumerate(langs.dictionary.to_pylist())}
        return self.held.pop(name)


def fit(docs: DataFrame, order: int = ORDER, rows: int = FIT_ROWS, text: str = "text", lang: str = "lang") -> KneserNey:
    """The model of all counted n-grams; rows bounds what is fetched at once, not what enters."""
    return KneserNey.fit(_Counts(materialize(count_ngrams(docs, order, text, lang), "ngrams"), rows), order)


# ---------------------------------------------------------------- verdicts

METRICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
ADDED = (*METRICS, "n_events", "bits")
VERDICT = ("base_failed", "kept", "band_low", "band_high", "band_lang", "band_mid", "band_below", "band_above")


def measure(docs: DataFrame, model: KneserNey, keep: list[str], text: str = "text", lang: str = "lang") -> DataFrame:
    """The columns in keep, the base metrics, n_events (bytes predicted) and bits (mean bits a byte; null without words)."""
    spark = docs.sparkSession
    ship(spark)
    shared = broadcast(spark, model)
    keep = [c for c in keep if c not in ADDED]
    columns = list(dict.fromkeys([*keep, text, lang]))
    of_text, of_lang = columns.index(text), columns.index(lang)
    names = [*keep, *ADDED]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        shift = np.uint64(8 * m.order)
        for batch in batches:
            for chunk in K.chunks(batch.column(of_text), CHUNK_BYTES):
                langs, code = _by_lang(batch.column(of_lang), chunk)
                starts, ends, first = K.spans(chunk, K.WHITE)
                prefix = K.prefix_hash(chunk.data)
                hashes = K.span_hash(prefix, starts, ends)
                base = base_metrics(chunk, starts, ends, first, prefix, hashes)
                ids = np.array([m.langs.get(x, len(m.langs)) for x in langs] or [0])
                keys, at, events = running(chunk, starts, ends, first, m.order)
                owner = np.repeat(ids[code][K.of_doc(first)] if len(hashes) else np.zeros(0, np.int64), events)
                # The language stands above the n-gram.
                unique, back = np.unique(keys | (owner.astype(np.uint64) << shift), return_inverse=True)
                lp = np.concatenate([[0], np.cumsum(m.log_p(unique & ((np.uint64(1) << shift) - np.uint64(1)), unique >> shift)[back])])
                of_word = m.switched(lp[at + events] - lp[at], keys, at, events)
                n_events = K.per_doc(events, first).astype(np.int64)
                with np.errstate(invalid="ignore", divide="ignore"):
                    bits = -K.per_doc(of_word, first) / n_events / np.log(2)
                rows = batch.slice(chunk.lo, chunk.docs)
                yield pa.record_batch([*(rows.column(i) for i in range(len(keep))), *(pa.array(base[c].astype(np.int64)) for c in METRICS), pa.array(n_events), pa.array(bits, mask=n_events == 0)], names)

    schema = "".join(f"{k}, " for k in [kinds(docs, keep)] if k) + "".join(f"{c} long, " for c in METRICS) + "n_events long, bits double"
    return docs.select(*columns).mapInArrow(K.tidy(score), schema)


def base_failed() -> F.Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def bands(measured: DataFrame, lang: str = "lang") -> DataFrame:
    """By language, over all texts that pass the base rules: the median of the bits a byte, and how far they lie below and above it, times the root of the text's length."""
    key = F.coalesce(lang, F.lit("und"))
    passed = measured.filter(~base_failed() & F.col("bits").isNotNull()).select(key.alias("band_lang"), "bits", "n_events")
    mids = passed.groupBy("band_lang").agg(F.percentile_approx("bits", 0.5, 10_000).alias("band_mid"))
    far = (F.col("bits") - F.col("band_mid")) * F.sqrt("n_events")
    q = F.percentile_approx(far, F.array(F.lit(0.25), F.lit(0.75)), 10_000)
    spread = lambda c: F.greatest(c / F.lit(0.6745), F.lit(LEAST_SPREAD))
    wide = passed.join(F.broadcast(mids), "band_lang").groupBy("band_lang", "band_mid").agg(q.alias("_q"))  # a row for each language
    return wide.select("band_lang", "band_mid", spread(-F.col("_q")[0]).alias("band_below"), spread(F.col("_q")[1]).alias("band_above"))


def _rule(joined: DataFrame, z: float) -> DataFrame:
    root = F.sqrt(F.greatest("n_events", F.lit(1)))
    out = joined.withColumn("base_failed", base_failed()).withColumn("band_low", F.col("band_mid") - z * F.col("band_below") / root).withColumn("band_high", F.col("band_mid") + z * F.col("band_above") / root)
    return out.withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("bits").between(F.col("band_low"), F.col("band_high")), F.lit(False))).drop("band_lang", "band_mid", "band_below", "band_above")


def verdict(measured: DataFrame, z: float = BAND_Z, lang: str = "lang") -> DataFrame:
    """Adds base_failed, band_low, band_high and kept. Bands are one row a language."""
    return _rule(measured.join(F.broadcast(bands(measured, lang)), F.coalesce(F.col(lang), F.lit("und")) == F.col("band_lang"), "left"), z)


def judge(docs: DataFrame, keep: list[str] | None = None, z: float = BAND_Z, text: str = "text", lang: str = "lang") -> DataFrame:
    """Fits the model to docs and judges every row: the columns in keep (all by default), metrics and verdict."""
    keep = [c for c in (keep if keep is not None else docs.columns) if c not in (*ADDED, *VERDICT)]
    if lang not in keep:
        keep = [*keep, lang]
    measured = materialize(measure(docs, fit(docs, text=text, lang=lang), keep, text, lang), "quality")
    return verdict(measured, z, lang)


def select(docs: DataFrame, z: float = BAND_Z) -> DataFrame:
    """The rows of docs that are kept. Texts are written once beside their metrics: neither scored twice nor shuffled."""
    rows, names = carried(docs)
    judged = judge(rows, None, z, names["text"], names["lang"])
    return judged.filter("kept").select(*(F.col(v).alias(c) for c, v in names.items()))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = judge(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), ["doc_id", "lang"])
    return out.select("doc_id", *METRICS, "base_failed", "kept", "n_events", "bits", "band_low", "band_high")
