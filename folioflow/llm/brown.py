"""Brown class-based n-gram scores: exchange clustering, class transitions and word emissions.

Method
------
1. Words of the training texts are counted over the corpus (64-bit hashes; a combiner in each task, then Spark).
2. The most frequent words, `HEAD` at most, are broadcast as sorted hash arrays; the rest are the tail, whose counts and classes
   stay a distributed table. Where a word is held does not enter its class.
3. Seeds: pairs of neighbours are counted over all training texts, with the `SEEDS` commonest words apart and every other word
   as one of 8 shapes (non-ASCII or not, kind of last character), and the exchange algorithm moves the seeds between
   `CLASSES` classes while the class bigram likelihood rises. Only this table, of (SEEDS + 9) squared, goes to the driver.
4. All other words are exchanged in one round: each word's neighbours are counted by class over all training texts in Spark,
   and it moves from its shape to the class of the highest class bigram likelihood, or stays. The classes of
   all words are a table that grows with the vocabulary. Words that no training text has are of their shape's class.
5. Class pairs are counted again, and each text is scored as a sum of log10 P(class | class before) + log10 P(word | class), both
   with additive smoothing of 0.5. Pairs with a word of the tail are looked up by joins, as (row, word before, word); each such
   word is rare, so no key of it is hot.

Lower-casing of A-Z; tokens are the words `[^\\x20\\x09-\\x0D]+` and then one end.

Defined results: a null text is empty: one end. A null doc_id counts as the empty string for the split. Repeated rows
count and are scored each. Without training texts every probability follows from the smoothing alone. Other columns
are ignored. Words are told apart by 61-bit hashes and their shape.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.llm import kernel as K
from folioflow.llm.scratch import broadcast, doc_remainder, materialize, ship, table

HEAD = 1 << 20
SEEDS = 1000
CLASSES = 48
SHAPES = 8
SMOOTH = 0.5
EXCHANGES = 8


@dataclass
class Vocabulary:
    """The head: sorted ids, counts, and each word's unit: a seed or a shape, later a class (of `clustered` made ones) or a shape."""

    hashes: np.ndarray
    counts: np.ndarray
    units: np.ndarray
    clustered: int
    ends: int
    tokens: int
    types: int
    threshold: int

    @property
    def end(self) -> int:
        return self.clustered + SHAPES

    def units_of(self, chunk: K.Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Types of a chunk: ids, units and counts (0 in the tail); and each word's type, and first words."""
        ids, first = word_ids(chunk)
        types, back = np.unique(ids, return_inverse=True)
        at, hit = K.find(self.hashes, types)
        units = self.clustered + (types & np.uint64(SHAPES - 1)).astype(np.int64)
        counts = np.zeros(len(types), np.int64)
        if len(self.hashes):
            units = np.where(hit, self.units[at], units)
            counts = np.where(hit, self.counts[at], 0)
        return types, units, counts, back, first


_LAST = np.full(256, 3)
for _kind, _codes in enumerate(((*range(0x61, 0x7B), *range(0x80, 0x100)), range(0x30, 0x3A), b".,;:!?")):
    _LAST[list(_codes)] = _kind


def word_ids(chunk: K.Chunk) -> tuple[np.ndarray, np.ndarray]:
    """61 bits of each word's hash and its shape in the last 3, and the first word of each document."""
    low = K.Chunk(chunk.lo, chunk.hi, K.LOWER[chunk.data], chunk.offs)
    starts, ends, first = K.spans(low, K.WHITE)
    wide = np.concatenate([[0], np.cumsum(low.data >= 0x80)])
    shape = (wide[ends] > wide[starts]) * 4 + _LAST[low.data[ends - 1]]
    return (K.span_hash(K.prefix_hash(low.data), starts, ends) & ~np.uint64(SHAPES - 1)) | shape.astype(np.uint64), first


def neighbours(back: np.ndarray, first: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers before and after each transition: words in order, with an end before and after each document."""
    docs = len(first) - 1
    flat = np.full(len(back) + docs, end)
    at = np.arange(len(back)) + K.of_doc(first)
    flat[at] = back
    before = np.empty_like(flat)
    before[1:] = flat[:-1]
    before[:1] = end
    return before, flat


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, n) of all texts; the row with a null word counts the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, docs = K.Counter(), 0
        for batch in batches:
            docs += batch.num_rows
            for chunk in K.chunks(batch.column(0)):
                sums.add(word_ids(chunk)[0])
        keys, n = sums.result()
        yield pa.record_batch([pa.array([None], pa.int64()), pa.array([docs], pa.int64())], ["word", "n"])
        for a in range(0, len(keys), 1 << 17):
            yield pa.record_batch([pa.array(keys[a : a + (1 << 17)].view(np.int64)), pa.array(n[a : a + (1 << 17)])], ["word", "n"])

    return texts.mapInArrow(K.tidy(run), "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


def vocabulary(counts: DataFrame, head: int = HEAD, clustered: int = SEEDS) -> Vocabulary:
    """counts of `word_counts`, materialised. The head holds all words of a count from a threshold on, `head` at most."""
    level = F.when(F.col("n") < 4096, F.col("n")).otherwise(F.lit(2).cast("long") ** F.floor(F.log2("n"))).cast("long")
    totals = counts.filter("word is not null").groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("types"), F.sum("n").alias("n")).collect()
    ends = counts.filter("word is null").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    threshold, kept = 1 << 62, 0
    for row in sorted(totals, key=lambda r: -r["level"]):
        if kept + row["types"] > head:
            break
        threshold, kept = row["level"], kept + row["types"]
    got = counts.filter(F.col("word").isNotNull() & (F.col("n") >= threshold)).toArrow()
    hashes, n = got.column("word").to_numpy().view(np.uint64), got.column("n").to_numpy()
    by = np.argsort(hashes)
    hashes, n = hashes[by], n[by]
    top = np.lexsort((hashes, -n))[:clustered]
    units = len(top) + (hashes & np.uint64(SHAPES - 1)).astype(np.int64)
    units[top] = np.arange(len(top))
    return Vocabulary(hashes, n, units, len(top), ends, sum(r["n"] for r in totals) + ends, sum(r["types"] for r in totals) + (ends > 0), threshold)


def unit_pairs(texts: DataFrame, words: Vocabulary) -> np.ndarray:
    """Counts of neighbouring units over all texts."""
    shared = broadcast(texts.sparkSession, words)
    size = words.end + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, total = shared.value, np.zeros(size * size, np.int64)
        for batch in batches:
            for chunk in K.chunks(batch.column(0)):
                _, units, _, back, first = v.units_of(chunk)
                a, b = neighbours(units[back], first, v.end)
                total += np.bincount(a * size + b, minlength=size * size)
        keys = np.flatnonzero(total)
        for at in range(0, len(keys), 1 << 17):
            part = keys[at : at + (1 << 17)]
            yield pa.record_batch([pa.array(part), pa.array(total[part])], ["pair", "n"])

    got = texts.mapInArrow(K.tidy(run), "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(size * size, np.int64)
    out[got.column("pair").to_numpy()] = got.column("n").to_numpy()
    return out.reshape(size, size)


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def exchange(pairs: np.ndarray, clustered: int, classes: int = CLASSES, rounds: int = EXCHANGES) -> np.ndarray:
    """The class of each unit: clustered words are moved to the class of the highest class bigram likelihood until none moves."""
    units = len(pairs)
    classes = max(1, min(classes, clustered))
    of = np.concatenate([np.arange(clustered) % classes, classes + np.arange(units - clustered)])
    size = classes + units - clustered
    member = np.zeros((units, size))
    member[np.arange(units), of] = 1
    after, before = pairs @ member, pairs.T @ member  # units by class
    joint = member.T @ after
    out, own = pairs.sum(axis=1).astype(float), pairs.diagonal().astype(float)
    into = pairs.sum(axis=0).astype(float)

    for _ in range(rounds):
        moved = 0
        for w in range(clustered):
            c = of[w]
            row, col, self_ = after[w].copy(), before[w].copy(), own[w]
            row[c] -= self_
            col[c] -= self_
            joint[c] -= row
            joint[:, c] -= col
            joint[c, c] -= self_
            row_sum, col_sum = joint.sum(axis=1), joint.sum(axis=0)
            k = np.arange(classes)
            gain = (_xlogx(joint[:classes] + row) - _xlogx(joint[:classes])).sum(axis=1) + (_xlogx(joint[:, :classes].T + col) - _xlogx(joint[:, :classes].T)).sum(axis=1)
            corner = joint[k, k]
            gain += _xlogx(corner + row[k] + col[k] + self_) - _xlogx(corner + row[k]) - _xlogx(corner + col[k]) + _xlogx(corner)
            gain -= _xlogx(row_sum[:classes] + out[w]) - _xlogx(row_sum[:classes]) + _xlogx(col_sum[:classes] + into[w]) - _xlogx(col_sum[:classes])
            best = int(gain.argmax())
            if gain[best] <= gain[c] + 1e-9:
                best = c
            joint[best] += row
            joint[:, best] += col
            joint[best, best] += self_
            if best != c:
                moved += 1
                of[w] = best
                after[:, c] -= pairs[:, w]
                after[:, best] += pairs[:, w]
                before[:, c] -= pairs[w]
                before[:, best] += pairs[w]
        if not moved:
            break
    return of


def contexts(texts: DataFrame, words: Vocabulary, of: np.ndarray) -> DataFrame:
    """(word, key, n): how often each word stands after (key: the class) or before (size + class) a word of a class. No ends among the words."""
    shared, size = broadcast(texts.sparkSession, (words, of)), int(of.max()) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (v, of), held, waiting = shared.value, [], 0

        def merged() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            word, key, n = (np.concatenate(x) for x in zip(*held, strict=True))
            by = np.lexsort((key, word))
            word, key, n = word[by], key[by], n[by]
            new = np.flatnonzero(np.concatenate([[True], (word[1:] != word[:-1]) | (key[1:] != key[:-1])]))
            return word[new], key[new], np.add.reduceat(n, new)

        def batches_of(word: np.ndarray, key: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
            for at in range(0, len(word), 1 << 17):
                part = slice(at, at + (1 << 17))
                yield pa.record_batch([pa.array(word[part].view(np.int64)), pa.array(key[part].astype(np.int32)), pa.array(n[part])], ["word", "key", "n"])

        for batch in batches:
            for chunk in K.chunks(batch.column(0)):
                types, units, _, back, first = v.units_of(chunk)
                a, b = neighbours(back, first, len(types))
                classes = of[np.append(units, v.end)]
                left, right = b < len(types), a < len(types)
                codes = np.concatenate([b[left] * (2 * size) + classes[a[left]], a[right] * (2 * size) + size + classes[b[right]]])
                codes, n = np.unique(codes, return_counts=True)
                held.append((types[codes // (2 * size)], codes % (2 * size), n))
                waiting += len(codes)
                if waiting > 1 << 21:
                    held = [merged()]
                    waiting = len(held[0][0])
                    if waiting > 1 << 20:
                        yield from batches_of(*held[0])
                        held, waiting = [], 0
        if held:
            yield from batches_of(*merged())

    raw = texts.mapInArrow(K.tidy(run), "word long, key int, n long")
    return raw.repartition("word").groupBy("word", "key").agg(F.sum("n").alias("n")).sortWithinPartitions("word")


def best_classes(joint: np.ndarray, word: np.ndarray, now: np.ndarray, first: np.ndarray, key: np.ndarray, n: np.ndarray, made: int) -> np.ndarray:
    """The class of each word (of class now, its entries from first on) with the highest class bigram likelihood, the others as they are."""
    size = len(joint)
    entries = np.diff(np.append(first, len(key)))
    each, n = np.repeat(now, entries), n.astype(float)
    cells = np.where((key >= size)[:, None], joint.T[key % size], joint[key % size])
    at = np.arange(len(key))
    own = cells[at, each]
    gain = _xlogx(cells + n[:, None]) - _xlogx(cells)
    gain[at, each] = _xlogx(own) - _xlogx(np.maximum(own - n, 0))
    gain = np.add.reduceat(gain, first, axis=0)
    times = np.add.reduceat(np.where(key >= size, n, 0), first)
    at = np.arange(len(word))
    for sums in (joint.sum(axis=1), joint.sum(axis=0)):
        cost = _xlogx(sums + times[:, None]) - _xlogx(sums)
        cost[at, now] = _xlogx(sums[now]) - _xlogx(np.maximum(sums[now] - times, 0))
        gain -= cost
    stay = gain[at, now]
    gain[:, made:] = -np.inf
    best = gain.argmax(axis=1)
    return np.where(gain[at, best] > stay + 1e-9, best, now)


def word_classes(texts: DataFrame, words: Vocabulary, of: np.ndarray, joint: np.ndarray) -> DataFrame:
    """(word, n, class) of all words: seeds as they are, the others after a round of exchange."""
    made = int(of[words.clustered])  # classes before those of shapes
    top = np.flatnonzero(words.units < words.clustered)
    shared = broadcast(texts.sparkSession, (words.hashes[top], of[words.units[top]], joint))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seeds, seed_class, joint = shared.value
        held, waiting = [], 0

        def placed(last: bool) -> tuple[pa.RecordBatch | None, list]:
            word, key, n = (np.concatenate(x) for x in zip(*held, strict=True))
            end = len(word) if last else int(np.searchsorted(word, word[-1]))
            rest = [(word[end:], key[end:], n[end:])]
            word, key, n = word[:end], key[:end], n[:end]
            if not end:
                return None, rest
            first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            ids = word[first].view(np.uint64)
            at, hit = K.find(seeds, ids)
            now = made + (ids & np.uint64(SHAPES - 1)).astype(np.int64)
            found = best_classes(joint, ids, now, first, key, n, made)
            if len(seeds):
                found = np.where(hit, seed_class[at], found)
            total = np.add.reduceat(np.where(key >= len(joint), n, 0), first)
            return pa.record_batch([pa.array(word[first]), pa.array(total), pa.array(found.astype(np.int32))], ["word", "n", "class"]), rest

        for batch in batches:
            if batch.num_rows:
                held.append(tuple(c.to_numpy() for c in batch.columns))
                waiting += batch.num_rows
            if waiting > 1 << 15:
                out, held = placed(False)
                waiting = 0
                if out is not None:
                    yield out
        if held and len(held[0][0]) + len(held) > 1:
            out, _ = placed(True)
            if out is not None:
                yield out

    return materialize(contexts(texts, words, of).mapInArrow(K.tidy(run), "word long, n long, class int"), "classes")


@dataclass
class Model:
    words: Vocabulary  # with classes for units
    transition: np.ndarray  # log10
    emission: np.ndarray  # log10 of the denominator, by class


class Links:
    """Transitions of a chunk: classes on both sides, and which need a word of the tail."""

    def __init__(self, v: Vocabulary, chunk: K.Chunk):
        types, units, counts, self.back, self.first = v.units_of(chunk)
        self.counts = counts[self.back]
        self.before, self.at = neighbours(self.back, self.first, len(types))
        self.types, self.classes, self.tail = np.append(types, np.uint64(0)), np.append(units, v.end), np.append(counts == 0, False)
        self.open = self.tail[self.before] | self.tail[self.at]

    def columns(self, at: np.ndarray) -> list[pa.Array]:
        """Word and class before, word and class: words of the tail, classes of the others."""
        out = []
        for side in (self.before[at], self.at[at]):
            out += [pa.array(self.types[side].view(np.int64), mask=~self.tail[side]), pa.array(self.classes[side].astype(np.int32), mask=self.tail[side])]
        return out


_LINK = "word_a long, class_a int, word_b long, class_b int"


def linked(links: DataFrame, tail: DataFrame, made: int) -> DataFrame:
    """Fills class_a and class_b from the tail's (word, n, class), and adds n_b, null where word_b is no word of the tail's."""
    for x in "ab":
        of = tail.select(F.col("word").alias(f"_w{x}"), F.col("class").alias(f"_c{x}"), F.col("n").alias(f"n_{x}"))
        shape = (F.lit(made) + F.col(f"word_{x}").bitwiseAND(F.lit(SHAPES - 1))).cast("int")
        open_, rest = links.filter(f"word_{x} is not null"), links.filter(f"word_{x} is null")
        found = open_.join(of, F.col(f"word_{x}") == F.col(f"_w{x}"), "left").withColumn(f"class_{x}", F.coalesce(f"_c{x}", shape)).drop(f"_w{x}", f"_c{x}")
        links = found.unionByName(rest.withColumn(f"n_{x}", F.lit(None).cast("long")))
    return links


def class_pairs(texts: DataFrame, words: Vocabulary, tail: DataFrame) -> np.ndarray:
    """Counts of neighbouring classes over all texts."""
    shared = broadcast(texts.sparkSession, words)
    size = words.end + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, total, names = shared.value, np.zeros(size * size, np.int64), ["word_a", "class_a", "word_b", "class_b", "n"]
        for batch in batches:
            for chunk in K.chunks(batch.column(0)):
                x = Links(v, chunk)
                a, b = (x.classes[side[~x.open]] for side in (x.before, x.at))
                total += np.bincount(a * size + b, minlength=size * size)
                open_ = np.flatnonzero(x.open)
                if len(open_):
                    yield pa.record_batch([*x.columns(open_), pa.array(np.ones(len(open_), np.int64))], names)
        keys = np.flatnonzero(total)
        none = pa.nulls(len(keys), pa.int64())
        yield pa.record_batch([none, pa.array((keys // size).astype(np.int32)), none, pa.array((keys % size).astype(np.int32)), pa.array(total[keys])], names)

    links = materialize(texts.mapInArrow(K.tidy(run), _LINK + ", n long"), "pairs")
    got = linked(links, tail, words.clustered).groupBy("class_a", "class_b").agg(F.sum("n").alias("n")).collect()
    out = np.zeros((size, size), np.int64)
    for r in got:
        out[r["class_a"], r["class_b"]] = r["n"]
    return out


def fit(texts: DataFrame, counts: DataFrame, head: int = HEAD, clustered: int = SEEDS, classes: int = CLASSES) -> tuple[Model, DataFrame]:
    """The model, and the tail's (word, n, class)."""
    seeds = vocabulary(counts, head, clustered)
    pairs = unit_pairs(texts, seeds)
    of = exchange(pairs, seeds.clustered, classes)
    made, size = int(of[seeds.clustered]), int(of.max()) + 1
    joint = np.zeros((size, size))
    np.add.at(joint, (of[:, None], of[None, :]), pairs)
    every = word_classes(texts, seeds, of, joint)
    got = every.filter(F.col("n") >= seeds.threshold).select("word", "class").toArrow()
    hashes, units = got.column("word").to_numpy().view(np.uint64), got.column("class").to_numpy().astype(np.int64)
    units = units[np.argsort(hashes)]
    words = Vocabulary(seeds.hashes, seeds.counts, units, made, seeds.ends, seeds.tokens, seeds.types, seeds.threshold)
    tail = every.filter(F.col("n") < seeds.threshold)
    joint = class_pairs(texts, words, tail)
    transition = np.log10((joint + SMOOTH) / (joint.sum(axis=1, keepdims=True) + SMOOTH * size))
    types = np.zeros(size, np.int64)
    for r in every.groupBy("class").agg(F.count(F.lit(1)).alias("types")).collect():
        types[r["class"]] = r["types"]
    types[-1] = seeds.ends > 0
    return Model(words, transition, np.log10(joint.sum(axis=0) + SMOOTH * (types + 1))), tail


def score(docs: DataFrame, model: Model, tail: DataFrame) -> DataFrame:
    """Per row of docs (doc_id, text, held_out): n_tokens, n_known, train_tokens, base_score and score."""
    spark = docs.sparkSession
    shared = broadcast(spark, model)
    names = ["row", "doc_id", "held_out", "n_tokens", "n_known", "base", "score", "word_a", "class_a", "word_b", "class_b"]
    kind = docs.schema["doc_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        v = m.words
        for batch in batches:
            for chunk in K.chunks(batch.column(3)):
                x = Links(v, chunk)
                first, hidden = x.first, x.counts == 0
                a, b = x.classes[x.before], x.classes[x.at]
                step = np.where(x.open, 0.0, m.transition[a, b]) - np.where(x.tail[x.at], 0.0, m.emission[b])
                step = np.concatenate([[0.0], np.cumsum(step)])
                edge = first + np.arange(len(first))
                seen = K.per_doc(np.where(hidden, 0.0, np.log10(x.counts + SMOOTH)), first) + np.log10(v.ends + SMOOTH)
                known = K.per_doc(~hidden, first) + (v.ends > 0)
                rows = batch.slice(chunk.lo, chunk.docs)
                n = chunk.docs
                none = [pa.nulls(n, t) for t in (pa.int64(), pa.int32(), pa.int64(), pa.int32())]
                yield pa.record_batch([*(rows.column(i) for i in range(3)), pa.array(np.diff(first) + 1), pa.array(known.astype(np.int64)), pa.array(seen), pa.array(seen + step[edge[1:]] - step[edge[:-1]]), *none], names)
                at = np.flatnonzero(x.open)
                if len(at):
                    owner = np.repeat(np.arange(n), np.diff(edge))
                    n = len(at)
                    ids = rows.column(0).take(pa.array(owner[at]))
                    yield pa.record_batch([ids, pa.nulls(n, rows.column(1).type), pa.nulls(n, pa.bool_()), *(pa.nulls(n, t) for t in (pa.int64(), pa.int64(), pa.float64(), pa.float64())), *x.columns(at)], names)

    marked = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "held_out", "text")
    flat = materialize(marked.mapInArrow(K.tidy(run), f"row long, doc_id {kind.simpleString()}, held_out boolean, n_tokens long, n_known long, base double, score double, {_LINK}"), "scores")
    v = model.words
    size = len(model.emission)
    steps = spark.createDataFrame([(a, b, float(model.transition[a, b]), float(model.emission[b])) for a in range(size) for b in range(size)], "_a int, _b int, _t double, _e double")
    links = linked(flat.filter("n_tokens is null").select("row", "word_a", "class_a", "word_b", "class_b"), tail, v.clustered)
    links = links.join(F.broadcast(steps), (F.col("class_a") == F.col("_a")) & (F.col("class_b") == F.col("_b")))
    hidden = F.col("word_b").isNotNull()
    log = F.when(hidden, F.log10(F.coalesce("n_b", F.lit(0)) + F.lit(SMOOTH))).otherwise(0.0)
    sums = links.groupBy(F.col("row").alias("_row")).agg(F.sum(log).alias("_log"), F.sum(F.col("_t") - F.when(hidden, F.col("_e")).otherwise(0.0) + log).alias("_more"), F.count_if(F.col("n_b") > 0).alias("_known"))
    whole = flat.filter("n_tokens is not null").join(sums, F.col("row") == F.col("_row"), "left")
    base = F.col("base") + F.coalesce("_log", F.lit(0.0)) - F.col("n_tokens") * F.lit(float(np.log10(v.tokens + SMOOTH * (v.types + 1))))
    return whole.select("doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("_known", F.lit(0))).alias("n_known"), F.lit(v.tokens).cast("long").alias("train_tokens"), base.alias("base_score"), (F.col("score") + F.coalesce("_more", F.lit(0.0))).alias("score"))


def score_corpus(docs: DataFrame, held_out: Column, head: int = HEAD, clustered: int = SEEDS, classes: int = CLASSES) -> DataFrame:
    """Learns from the rows that are not held out, and scores all."""
    ship(docs.sparkSession)
    docs = docs.select("doc_id", "text", held_out.alias("held_out"))
    texts = docs.filter(~F.col("held_out")).select("text")
    counts = materialize(word_counts(texts), "words")
    return score(docs, *fit(texts, counts, head, clustered, classes))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_corpus(table(spark, sf_dir, "documents"), doc_remainder() == 1)
