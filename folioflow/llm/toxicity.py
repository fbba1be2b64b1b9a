"""Toxicity by noisy-channel deobfuscation: character lattices, a character model, and scores of the restored text.

Method
------
1. A character trigram model is counted over all training texts (28 symbols: a-z, other, edge).
2. Words of any length that look disguised (letters with signs or digits, at most two for each letter unless all of them resemble letters;
   resembling signs alone, with no more digits than signs; a letter three times or several doubled letters) and rows of
   letters that stand alone become lattices: each character stands for itself, for letters that it resembles, for
   nothing (signs and digits), or repeats the last letter; a fourth and further equal character in a row says no more than three. A Viterbi search under
   channel costs and the character model restores the word (scores also take its best reading in which no resembling sign is left out). A restored row is cut into words of any length by a second search, for the most
   probable places of blanks under the same model; besides, every stretch of `WITHIN` letters of it may be a word.
   Two or three neighbours that together are a weighed word (`st upid`) count as that word; this is for scores only, no weight is learned from it.
3. Words and word beginnings (4 to 7 bytes) of the restored texts are weighed by the log odds of the documents that have them, from the labelled training
   texts of three of the four training folds; the fourth calibrates a logistic score on the strongest, the sum and the number of weights in
   a text. Candidates are those that `LEAST` toxic texts have; up to `CANDIDATES` of them are sent to the clean texts, more are joined, with the same counts. Only those
   of strong weight reach the driver. Calibration reads `CALIBRATION` rows at most.
4. Every whole text is restored and scored. `restore` returns the restored texts themselves.

Defined results: a null text is empty; an empty text gets the score of a text without any weighed word. Rows with a null label, or without one,
teach nothing; of several labels for an id the highest counts. Repeated rows get equal scores. Without training labels
all scores are 0. Other columns are ignored.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.llm import kernel as K
from folioflow.llm.scratch import broadcast, doc_remainder, materialize, ship, table

LEAST = 4
STRONG = 2.0
CANDIDATES = 1 << 20
CALIBRATION = 50_000
BROADCAST_ROWS = 2_000_000
PREFIXES = (4, 5, 6, 7)
ALONE = 3
WITHIN = range(3, 17)
#: Longest words that the decoder remembers.
REMEMBERED = 64

# What a character may stand for, besides itself.
RESEMBLES = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "*": "aeiou"}
COST_RESEMBLES, COST_NOTHING, COST_LOST, COST_REPEAT, COST_SIGN = 1.0, 1.0, 6.0, 0.7, 4.0

_RUN = re.compile(r"(.)\1{3,}", re.S)
_LETTERS = K.byte_set((0x61, 0x7A))
_DIGITS = K.byte_set((0x30, 0x39))
_RESEMBLING = np.isin(np.arange(256), [ord(c) for c in RESEMBLES if ord(c) < 128])
_CORE = K.byte_set((0x30, 0x39), (0x40, 0x40), (0x61, 0x7A), (0x80, 0xFF))
_SYMBOL = np.full(256, 26)
_SYMBOL[0x61:0x7B] = np.arange(26)
_SYMBOL[K.WHITE] = 27
SIZE = 28


def character_counts(texts: DataFrame) -> np.ndarray:
    """Trigram counts over all texts; at most 28 cubed numbers reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SIZE**3, np.int64)
        for batch in batches:
            for chunk in K.chunks(batch.column(0)):
                s = _SYMBOL[K.LOWER[chunk.data]]
                s = np.concatenate([[27, 27], s, [27]])
                total += np.bincount((s[:-2] * SIZE + s[1:-1]) * SIZE + s[2:], minlength=SIZE**3)
        keys = np.flatnonzero(total)
        yield pa.record_batch([pa.array(keys), pa.array(total[keys])], ["gram", "n"])

    got = texts.mapInArrow(K.tidy(run), "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(SIZE**3, np.int64)
    out[got.column("gram").to_numpy()] = got.column("n").to_numpy()
    return out.reshape(SIZE, SIZE, SIZE)


class Decoder:
    """Viterbi search over the lattice of a disguised word."""

    def __init__(self, counts: np.ndarray):
        two = counts.sum(axis=0)
        one = two.sum(axis=0)
        p1 = (one + 1) / (one.sum() + SIZE)
        p2 = (two + 5 * p1) / (two.sum(axis=1, keepdims=True) + 5)
        p3 = (counts + 5 * p2) / (counts.sum(axis=2, keepdims=True) + 5)
        self.log = np.log(p3).tolist()
        self.known: dict[str, str] = {}
        self.full: dict[str, str] = {}

    @staticmethod
    def symbol(c: str) -> int:
        return ord(c) - 97 if "a" <= c <= "z" else 26

    def __call__(self, word: str) -> str:
        word = _RUN.sub(r"\1\1\1", word)
        found = self.known.get(word)
        if found is None:
            found = self._search(word)
            if len(self.known) > 100_000:
                self.known.clear()
            if len(word) <= REMEMBERED:
                self.known[word] = found
        return found

    def readings(self, word: str) -> list[str]:
        """The most probable word, and where a sign may repeat the letter before it or be one more (`a$$`) also the most probable in which every such sign is a letter."""
        best = self(word)
        if all(b not in RESEMBLES or a != b and a not in RESEMBLES[b] for a, b in itertools.pairwise(word)):
            return [best]
        word = _RUN.sub(r"\1\1\1", word)
        found = self.full.get(word)
        if found is None:
            found = self._search(word, True)
            if len(self.full) > 100_000:
                self.full.clear()
            if len(word) <= REMEMBERED:
                self.full[word] = found
        return [best] if found == best else [best, found]

    def _search(self, word: str, full: bool = False) -> str:
        # By the last two symbols: log probability, last letter, and the word so far as a linked list.
        states: dict[tuple[int, int], tuple[float, str, tuple | None]] = {(27, 27): (0.0, "", None)}
        for c in word:
            after: dict[tuple[int, int], tuple[float, str, tuple | None]] = {}
            letter = c.isalpha()
            ways = [(c, 0.0 if letter else COST_SIGN)] + [(x, COST_RESEMBLES) for x in RESEMBLES.get(c, "")]
            for (a, b), (p, last, path) in states.items():
                for x, cost in ways:
                    s = self.symbol(x)
                    q = p - cost + self.log[a][b][s]
                    if (b, s) not in after or after[b, s][0] < q:
                        after[b, s] = (q, x, (x, path))
                if full and c in RESEMBLES:
                    continue
                skip = COST_REPEAT if c == last or last in RESEMBLES.get(c, "") and last else None if letter else COST_LOST if c in RESEMBLES else COST_NOTHING
                if skip is not None:
                    q = p - skip
                    if (a, b) not in after or after[a, b][0] < q:
                        after[a, b] = (q, last, path)
            states = after
        best = max(states.items(), key=lambda x: x[1][0] + self.log[x[0][0]][x[0][1]][27])
        out, path = [], best[1][2]
        while path:
            out.append(path[0])
            path = path[1]
        return "".join(reversed(out))


    def parted(self, row: str) -> list[str]:
        """A row of letters without blanks as words: the most probable places of blanks under the character model. Two states a letter: before it stands a blank, or the letter before it."""
        # State: log probability, the symbol before the last one, and the starts of words as a linked list.
        blank = 27
        last, states = blank, [(0.0, blank, None)]
        for i, c in enumerate(row):
            s = self.symbol(c)
            on = max(((p + self.log[a][last][s], last, starts) for p, a, starts in states), key=lambda x: x[0])
            if i:
                p, a, starts = max(((p + self.log[a][last][blank], a, starts) for p, a, starts in states), key=lambda x: x[0])
                states = [on, (p + self.log[last][blank][s], blank, (i, starts))]
            else:
                states = [on]
            last = s
        _, _, starts = max(states, key=lambda x: x[0] + self.log[x[1]][last][blank])
        edges = [len(row)]
        while starts:
            edges.append(starts[0])
            starts = starts[1]
        edges.append(0)
        return [row[a:b] for a, b in zip(reversed(edges[1:]), reversed(edges[:-1]), strict=True) if b > a]


@dataclass
class Words:
    """Types of a chunk's words without their edges, which of them look disguised, and joined rows of lone letters."""

    text: list[str] = field(default_factory=list)
    first: np.ndarray = None
    back: np.ndarray = None
    features: np.ndarray = None  # by type: the word's and its beginnings' hashes (0: none)
    odd: np.ndarray = None  # types that look disguised
    spelled: list[tuple[int, str, int, int]] = field(default_factory=list)  # document, joined letters, and their words' numbers


def _features(data: np.ndarray, prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    out = np.zeros((len(starts), 1 + len(PREFIXES)), np.uint64)
    there = ends > starts
    out[there, 0] = K.span_hash(prefix, starts[there], ends[there])
    for i, n in enumerate(PREFIXES):
        long = ends - starts > n
        out[long, i + 1] = K.mix(K.span_hash(prefix, starts[long], starts[long] + n) + np.uint64(n))
    return out


def read_words(chunk: K.Chunk) -> tuple[Words, np.ndarray, np.ndarray, np.ndarray]:
    data = K.LOWER[chunk.data]
    low = K.Chunk(chunk.lo, chunk.hi, data, chunk.offs)
    starts, ends, first = K.spans(low, K.WHITE)
    core = np.append(np.flatnonzero(_CORE[data]), len(data))
    s = np.minimum(core[np.searchsorted(core, starts)], ends)
    e = core[np.maximum(np.searchsorted(core, ends) - 1, 0)] + 1
    e = np.where(s >= ends, s, e)
    money = data == 0x24
    left = (s > starts) & (s < ends) & (s - starts <= 2) & money[np.maximum(s - 1, 0)]
    right = (e < ends) & (e > s) & (ends - e <= 2) & money[np.minimum(e, len(data) - 1)] if len(data) else left
    s, e = np.where(left, starts, s), np.where(right, ends, e)
    prefix = K.prefix_hash(data)
    hashes = K.span_hash(prefix, s, e)
    _, where, back = np.unique(hashes, return_index=True, return_inverse=True)
    ts, te = s[where], e[where]
    size = te - ts

    upto = lambda flags: np.concatenate([[0], np.cumsum(flags)])
    letters = upto(_LETTERS[data] | (data >= 0x80))
    same = (data[1:] == data[:-1]) & _LETTERS[data[1:]]
    doubled = upto(np.append(same, False))
    tripled = upto(np.append(same[1:] & same[:-1], [False, False])[: len(data)]) if len(data) > 1 else np.zeros(len(data) + 1, int)
    n_letters = letters[te] - letters[ts]
    signs = size - n_letters
    inside = lambda total, less: total[np.maximum(te - less, ts)] - total[ts]
    alike, digits = upto(_RESEMBLING[data]), upto(_DIGITS[data])
    alike, digits = alike[te] - alike[ts], digits[te] - digits[ts]
    signed = (n_letters >= 1) & (signs > 0) & ((signs <= n_letters * 2) | (alike == signs))
    only_signs = (n_letters == 0) & (alike == size) & (digits * 2 <= size)
    odd = (size >= 3) & (signed | only_signs | (n_letters >= 2) & ((inside(tripled, 2) > 0) | (inside(doubled, 1) > 2)))

    found = Words(first=first, back=back, features=_features(data, prefix, ts, te), odd=np.flatnonzero(odd))
    raw = data.tobytes()
    found.text = [raw[a:b].decode("utf-8", "replace") for a, b in zip(ts[found.odd].tolist(), te[found.odd].tolist(), strict=True)]
    # Letters that stand alone, several in a row in one document.
    owner = K.of_doc(first)
    alone = (e - s == 1) & ~K.WHITE[data[np.minimum(s, max(len(data) - 1, 0))]] if len(s) else np.zeros(0, bool)
    edge = np.flatnonzero(np.concatenate([[True], (alone[1:] != alone[:-1]) | (owner[1:] != owner[:-1]), [True]])) if len(s) else np.zeros(1, int)
    for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
        if alone[a] and b - a >= ALONE:
            found.spelled.append((int(owner[a]), data[s[a:b]].tobytes().decode("utf-8", "replace"), a, b))
    return found, s, e, data


def _of_strings(words: list[str]) -> np.ndarray:
    """Features of restored words."""
    raw = [w.encode() for w in words]
    data = np.frombuffer(b"".join(raw), np.uint8)
    ends = np.cumsum([len(w) for w in raw]) if raw else np.zeros(0, np.int64)
    return _features(data, K.prefix_hash(data), ends - np.array([len(w) for w in raw], np.int64), ends)


def _joined(first: np.ndarray, s: np.ndarray, e: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, hash) of any two and three neighbouring words of a document written as one, but for lone letters only, which are rows."""
    size = e - s
    owner, hashes, alone = K.of_doc(first), K.span_sum(K.prefix_hash(data), s, e), size == 1
    docs, out = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    last, length, only = hashes, size, alone
    for n in (2, 3):
        # What ends at a word and begins n - 1 words before it: the word before, then the n - 1 words.
        last, only = hashes[: len(last) - 1] + last[1:] * K.powers(size[: len(last) - 1]), alone[: len(only) - 1] & only[1:]
        length = np.minimum(size[: len(length) - 1], length[1:])
        good = np.flatnonzero((owner[: len(last)] == owner[n - 1 :]) & (length > 0) & ~only) if len(last) else np.zeros(0, np.int64)
        docs.append(owner[good])
        out.append(K.mix(last[good]))
    return np.concatenate(docs), np.concatenate(out)


def doc_features(chunk: K.Chunk, decode: Decoder) -> tuple[np.ndarray, np.ndarray]:
    """(document, rows of feature hashes) of all words, restored ones besides as they stand."""
    return _word_features(read_words(chunk)[0], decode)


def _word_features(found: Words, decode: Decoder) -> tuple[np.ndarray, np.ndarray]:
    docs = [K.of_doc(found.first)]
    rows = [found.features[found.back]] if len(found.back) else [np.zeros((0, 1 + len(PREFIXES)), np.uint64)]
    if len(found.odd):
        readings = [decode.readings(w) for w in found.text]
        restored, number = _of_strings([x for words in readings for x in words]), np.array([len(words) for words in readings])
        at = np.full(len(found.features), -1)
        at[found.odd] = np.cumsum(number) - number
        mine = at[found.back]
        where = np.flatnonzero(mine >= 0)
        times = np.zeros(len(found.features), np.int64)
        times[found.odd] = number
        times = times[found.back[where]]
        docs.append(np.repeat(docs[0][where], times))
        rows.append(restored[np.repeat(mine[where] - np.cumsum(times) + times, times) + np.arange(times.sum())])
    for d, w, _, _ in found.spelled:
        row = decode(w)
        inside = _of_strings(sorted({row[i : i + n] for n in WITHIN for i in range(len(row) - n + 1)}))
        inside[:, 1:] = 0
        words = [row, *(w for w in decode.parted(row) if w != row and len(w) not in WITHIN)]
        docs.append(np.full(len(inside) + len(words), d))
        rows += [inside, _of_strings(words)]
    return np.concatenate(docs), np.concatenate(rows)


def _text_counts(texts: DataFrame, decode: Decoder, wanted: np.ndarray | None) -> DataFrame:
    """(feature, n): the texts that have each feature; only the wanted (sorted) ones, if given."""
    shared = broadcast(texts.sparkSession, (decode, wanted))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d, only = shared.value
        sums = K.Counter()
        for batch in batches:
            for chunk in K.chunks(batch.column(0)):
                doc, rows = doc_features(chunk, d)
                doc, flat = np.repeat(doc, rows.shape[1]), rows.ravel()
                keep = flat != 0
                if only is not None:
                    at, hit = K.find(only, flat)
                    keep &= hit
                doc, flat = doc[keep].astype(np.uint64), flat[keep]
                _, once = np.unique(K.mix(flat + doc * np.uint64(0xD6E8FEB86659FD93)), return_index=True)
                sums.add(flat[once])
        keys, n = sums.result()
        for a in range(0, len(keys), 1 << 17):
            yield pa.record_batch([pa.array(keys[a : a + (1 << 17)].view(np.int64)), pa.array(n[a : a + (1 << 17)])], ["feature", "n"])

    return texts.select("text").mapInArrow(K.tidy(run), "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n"))


@dataclass
class Model:
    decode: Decoder
    features: np.ndarray
    weights: np.ndarray
    logistic: np.ndarray  # of 1, strongest, sum, number

    def summary(self, chunk: K.Chunk) -> np.ndarray:
        """Strongest weight, damped sum and number of weighed words, by document."""
        found, s, e, data = read_words(chunk)
        doc, rows = _word_features(found, self.decode)
        out = np.zeros((chunk.docs, 3))
        if not len(self.features) or not len(doc):
            return out
        at, hit = K.find(self.features, rows.ravel())
        weight = np.where(hit, self.weights[at], 0.0).reshape(rows.shape).max(axis=1)
        strong = np.flatnonzero(weight > 0)
        joined, hashes = _joined(found.first, s, e, data)
        at, hit = K.find(self.features, hashes)
        d, w = np.concatenate([doc[strong], joined[hit]]), np.concatenate([weight[strong], self.weights[at[hit]]])
        np.maximum.at(out[:, 0], d, w)
        out[:, 1] = np.log1p(np.bincount(d, w, chunk.docs))
        out[:, 2] = np.log1p(np.bincount(d, minlength=chunk.docs))
        return out

    def score(self, chunk: K.Chunk) -> np.ndarray:
        if not self.logistic.any():
            return np.zeros(chunk.docs)
        x = self.summary(chunk)
        return 1 / (1 + np.exp(-np.clip(self.logistic[0] + x @ self.logistic[1:], -30, 30)))


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, text, toxic, fold) of labelled texts; fold 0 is held out and not among them."""
    one = labels.filter("toxic is not null and doc_id is not null").groupBy(F.col("doc_id").alias("_d")).agg(F.max("toxic").alias("toxic"))
    one = materialize(one, "labels")
    one = F.broadcast(one) if one.count() <= BROADCAST_ROWS else one
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), doc_remainder().alias("fold")).filter("fold != 0")
    return rows.join(one, F.col("doc_id") == F.col("_d")).select("doc_id", "text", "toxic", "fold")


def _logistic(x: np.ndarray, y: np.ndarray, rounds: int = 50, ridge: float = 1e-2) -> np.ndarray:
    """Newton's method, with a small ridge."""
    x = np.column_stack([np.ones(len(x)), x])
    b = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(b)), x.T @ (y - p) - ridge * b)
        b += step
        if np.abs(step).max() < 1e-8:
            break
    return b


def fit(docs: DataFrame, labels: DataFrame, least: int = LEAST, candidates: int = CANDIDATES, calibration: int = CALIBRATION) -> Model:
    spark = docs.sparkSession
    ship(spark)
    decode = Decoder(character_counts(docs.filter(doc_remainder() != 0).select(F.coalesce("text", F.lit("")).alias("text"))))
    rows = labelled(docs, labels)
    learn = rows.filter("fold != 4")
    numbers = {bool(r["toxic"]): r["count"] for r in learn.select((F.col("toxic") > 0).alias("toxic")).groupBy("toxic").count().collect()}
    toxic, clean = numbers.get(True, 0), numbers.get(False, 0)
    none = Model(decode, np.zeros(0, np.uint64), np.zeros(0), np.zeros(4))
    if not toxic or not clean:
        return none
    of_toxic = materialize(_text_counts(learn.filter("toxic > 0"), decode, None).filter(F.col("n") >= least), "toxic")
    wanted = None
    if of_toxic.count() <= candidates:
        wanted = np.sort(of_toxic.select("feature").toArrow().column("feature").to_numpy().view(np.uint64))
    of_clean = _text_counts(learn.filter("toxic <= 0"), decode, wanted).withColumnsRenamed({"feature": "_f", "n": "_n"})
    odds = lambda n, all_: F.log((F.coalesce(n, F.lit(0)) + 0.5) / F.lit(all_ + 1.0))
    weighed = of_toxic.join(of_clean, F.col("feature") == F.col("_f"), "left").select("feature", (odds(F.col("n"), toxic) - odds(F.col("_n"), clean)).alias("weight"))
    got = weighed.filter(F.col("weight") >= STRONG).toArrow()
    keys, weight = got.column("feature").to_numpy().view(np.uint64), got.column("weight").to_numpy()
    by = np.argsort(keys)
    model = Model(decode, keys[by], weight[by], np.zeros(4))
    shared = broadcast(spark, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in K.chunks(batch.column(0)):
                x = shared.value.summary(chunk)
                yield pa.record_batch([*map(pa.array, x.T), batch.column(1).slice(chunk.lo, chunk.docs)], ["a", "b", "c", "y"])

    sample = rows.filter("fold = 4").select("text", (F.col("toxic") > 0).cast("double").alias("y"), F.xxhash64("doc_id").alias("h"))
    share = calibration / max(1, sample.count())
    if share < 1:  # documented bound of the calibration sample, by a hash of the id
        sample = sample.filter(F.pmod("h", F.lit(1_000_000)) < int(share * 1_000_000))
    got = sample.select("text", "y").mapInArrow(K.tidy(run), "a double, b double, c double, y double").toArrow()
    y = got.column("y").to_numpy()
    if 0 < y.sum() < len(y):
        model.logistic = _logistic(np.column_stack([got.column(c).to_numpy() for c in "abc"]), y)
    return model


def score(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """The columns in keep and score, of every row."""
    ship(docs.sparkSession)
    shared = broadcast(docs.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in K.chunks(batch.column(0)):
                rows = batch.slice(chunk.lo, chunk.docs)
                yield pa.record_batch([*rows.columns[1:], pa.array(shared.value.score(chunk))], [*keep, "score"])

    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.select(*keep).schema) + "score double"
    return docs.select(F.col("text").alias("_text"), *keep).mapInArrow(K.tidy(run), schema)


def restore(docs: DataFrame, decode: Decoder, keep: list[str]) -> DataFrame:
    """The columns in keep and `restored`: the lower-cased text with disguised words, and rows of lone letters joined, in their restored form."""
    ship(docs.sparkSession)
    shared = broadcast(docs.sparkSession, decode)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d = shared.value
        for batch in batches:
            for chunk in K.chunks(batch.column(0)):
                found, s, e, data = read_words(chunk)
                place = {int(t): i for i, t in enumerate(found.odd)}
                lone = {a: (b, w) for _, w, a, b in found.spelled}
                raw, texts = data.tobytes(), []
                for doc in range(chunk.docs):
                    at, out = int(chunk.offs[doc]), []
                    for w in range(int(found.first[doc]), int(found.first[doc + 1])):
                        i = place.get(int(found.back[w]))
                        if w in lone:
                            out += [raw[at : s[w]], d(lone[w][1]).encode()]
                            at = int(e[lone[w][0] - 1])
                        elif i is not None:
                            out += [raw[at : s[w]], d(found.text[i]).encode()]
                            at = int(e[w])
                    texts.append(b"".join([*out, raw[at : chunk.offs[doc + 1]]]).decode("utf-8", "replace"))
                rows = batch.slice(chunk.lo, chunk.docs)
                yield pa.record_batch([*rows.columns[1:], pa.array(texts, pa.string())], [*keep, "restored"])

    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.select(*keep).schema) + "restored string"
    return docs.select(F.col("text").alias("_text"), *keep).mapInArrow(K.tidy(run), schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels"))
    out = score(docs.withColumn("held_out", doc_remainder() == 0), model, ["doc_id", "held_out"])
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
