"""Benchmark decontamination with a generalised suffix automaton of the benchmark's words.

Method
------
* `Automaton` is the suffix automaton of all normalised test items. A text's words are streamed through
  it; at each word the state and the matched length say how long a word sequence that ends there occurs in an item.
* Where the length reaches the window (or a short item as a whole), the words that the window covers are hit,
  and the items of the state are noted: each state knows the items whose words pass through it.
* A word that no item has, or a pair of neighbours that is nowhere neighbours in the items, sets the automaton back
  to length 0 or 1. Such places are found with vectorised lookups in sorted arrays, and
  the stretches between them that are too short for any window are passed over; all others are streamed.
* Items beyond `BLOCK_WORDS` words are dealt to several automata. Each is broadcast to a pass of its own over the texts, which
  carries the hits of the passes before it, so that a worker holds one bounded automaton whatever the benchmark's size.

Normalisation: A-Z become lower case; words are `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`.

Defined results: null and empty texts have no words and no hits. Items that are null, or without words or
item_id, match nothing. Items with equal words all count. Repeated rows get equal results. Other columns are ignored
by `query` and kept by `clean`. An empty benchmark hits nothing.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.llm import kernel as K
from folioflow.llm.scratch import broadcast, carried, kinds, materialize, ship, table

WINDOW = 10
BLOCK_WORDS = 100_000
#: `clean` drops a text when more than this share of its words is hit; otherwise it cuts the hit words out.
MAX_SHARE = 0.5
BROADCAST_ROWS = 100_000
ADDED = ("n_words", "n_hit", "items", "hit_spans")
SEPARATORS = K.byte_set((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))


class Automaton:
    """Generalised suffix automaton over word numbers. An id has one word sequence, or a list of them."""

    def __init__(self, items: dict[str, np.ndarray | list[np.ndarray]], window: int = WINDOW):
        self.window = window
        rows = [(i, words) for i in sorted(items) for words in (items[i] if isinstance(items[i], list) else [items[i]])]
        self.ids = [i for i, _ in rows]
        self.vocabulary = np.unique(np.concatenate([*(words for _, words in rows), np.zeros(0, np.uint64)]))
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        sequences = [np.searchsorted(self.vocabulary, words).tolist() for _, words in rows]
        for words in sequences:
            last = 0
            for w in words:
                last = self._extend(last, w)
        pairs = [np.array(s[:-1], np.uint64) * np.uint64(len(self.vocabulary)) + np.array(s[1:], np.uint64) for s in sequences]
        self.pairs = np.unique(np.concatenate([*pairs, np.zeros(0, np.uint64)]))
        self.least = min([min(len(s), window) for s in sequences if s], default=0)
        #: By state: items that have the state's words of the window's length, and (length, items) of whole short items.
        self.items: dict[int, set[int]] = {}
        self.short: dict[int, list[tuple[int, set[int]]]] = {}
        for i, words in enumerate(sequences):
            if len(words) >= window:
                for state, length in self._walk(words):
                    if length >= window:
                        self.items.setdefault(self._cut(state, window), set()).add(i)
            elif words:
                state, length = list(self._walk(words))[-1]
                state = self._cut(state, len(words))
                kept = self.short.setdefault(state, [])
                same = next((s for n, s in kept if n == len(words)), None)
                if same is None:
                    kept.append((len(words), {i}))
                else:
                    same.add(i)

    def _extend(self, last: int, w: int) -> int:
        if w in self.next[last]:
            q = self.next[last][w]
            return q if self.length[q] == self.length[last] + 1 else self._split(last, w, q)
        new = self._state(self.length[last] + 1)
        p = last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = new
            p = self.link[p]
        if p < 0:
            self.link[new] = 0
        else:
            q = self.next[p][w]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, w, q)
        return new

    def _state(self, length: int) -> int:
        self.next.append({})
        self.link.append(0)
        self.length.append(length)
        return len(self.length) - 1

    def _split(self, p: int, w: int, q: int) -> int:
        copy = self._state(self.length[p] + 1)
        self.next[copy] = dict(self.next[q])
        self.link[copy] = self.link[q]
        self.link[q] = copy
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = copy
            p = self.link[p]
        return copy

    def _walk(self, words: list[int]) -> Iterator[tuple[int, int]]:
        """State and longest matching length after each word; -1 is a word of no item."""
        state = length = 0
        for w in words:
            while state and w not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            state = self.next[state].get(w, 0)
            length = length + 1 if state else 0
            yield state, length

    def _cut(self, state: int, length: int) -> int:
        """The state of the last `length` words."""
        while self.length[self.link[state]] >= length:
            state = self.link[state]
        return state

    def hits(self, words: list[int]) -> tuple[list[tuple[int, int]], set[int]]:
        """Spans of words that windows cover, and the items of these windows."""
        spans, found = [], set()
        for i, (state, length) in enumerate(self._walk(words)):
            if length >= self.window:
                spans.append((i + 1 - self.window, i + 1))
                found |= self.items.get(self._cut(state, self.window), set())
            if self.short:
                at = state
                while at > 0:
                    for n, ids in self.short.get(at, ()):
                        if n <= length:
                            spans.append((i + 1 - n, i + 1))
                            found |= ids
                    at = self.link[at]
        return spans, found

    def stretches(self, hashes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Word numbers (-1: unknown), and starts and ends of the stretches that can hold a window."""
        at, known = K.find(self.vocabulary, hashes)
        numbers = np.where(known, at, -1)
        if not self.least or not known.any():
            return numbers, np.zeros(0, np.int64), np.zeros(0, np.int64)
        joined = known[1:] & known[:-1] & (owner[1:] == owner[:-1])
        where = np.flatnonzero(joined)
        _, neighbours = K.find(self.pairs, numbers[where].astype(np.uint64) * np.uint64(len(self.vocabulary)) + numbers[where + 1].astype(np.uint64))
        joined[where] = neighbours
        start = np.flatnonzero(known & np.concatenate([[True], ~joined]))
        end = np.flatnonzero(known & np.concatenate([~joined, [True]])) + 1
        long = end - start >= self.least
        return numbers, start[long], end[long]


def item_blocks(benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> Iterator[Automaton]:
    """Automata of the items, each of bounded size (or of one single item)."""
    rows = benchmark.filter("item_id is not null and text is not null").select(F.col("item_id").cast("string").alias("i"), "text")
    block: dict[str, list[np.ndarray]] = {}
    known: set[tuple[str, int]] = set()
    size = 0
    for row in rows.toLocalIterator():
        for chunk in K.chunks(pa.array([row["text"]])):
            hashes, _ = K.words(chunk, SEPARATORS)
        if not len(hashes):
            continue
        if size + len(hashes) > block_words and block:
            yield Automaton(block, window)
            block, known, size = {}, set(), 0
        same = (row["i"], int(K.whole_hash(hashes)))
        if same not in known:
            known.add(same)
            block.setdefault(row["i"], []).append(hashes)
            size += len(hashes)
    if block:
        yield Automaton(block, window)


def scan(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, keep: list[str] | None = None, text: str = "text", rewrite: bool = False, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The columns in keep, n_words, n_hit, items (matched item ids, sorted as strings) and hit_spans (byte offsets of hit stretches).

    With rewrite, also `cleaned`: the text without its hit stretches. A column to be kept that has the name of an added one gives way to it.

    The last block's pass reports. Passes of earlier blocks read the texts and write only the hits of the texts that have any, which join by the text's hash.
    """
    ship(docs.sparkSession)
    added = [*ADDED, *["cleaned"] * rewrite]
    keep = [c for c in (keep if keep is not None else docs.columns) if c not in added]
    rows = docs.select(F.col(text).alias("_text"), *[F.col(c).alias(f"_c{i}") for i, c in enumerate(keep)])
    blocks = item_blocks(benchmark, window, block_words)
    current = next(blocks, Automaton({}, window))
    earlier: list[DataFrame] = []
    for following in blocks:
        hits = rows.select("_text", F.xxhash64("_text").alias("_h"), F.lit(None).cast("array<bigint>").alias("_hits"), F.lit(None).cast("array<string>").alias("_items"))
        found = _pass(hits, current, ["_h"], False, False).groupBy("_h").agg(F.first("hits").alias("hits"), F.first("items").alias("items"))
        earlier.append(materialize(found, "hits"))
        current = following
    if earlier:
        every = functools.reduce(DataFrame.unionByName, earlier).groupBy("_h").agg(F.flatten(F.collect_list("hits")).alias("_hits"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("_items"))
        every = materialize(every, "hits")
        every = F.broadcast(every) if every.count() <= BROADCAST_ROWS else every
        rows = rows.withColumn("_h", F.xxhash64("_text")).join(every, "_h", "left")
    else:
        rows = rows.withColumns({"_hits": F.lit(None).cast("array<bigint>"), "_items": F.lit(None).cast("array<string>")})
    state = rows.select("_text", "_hits", "_items", *[f"_c{i}" for i in range(len(keep))])
    return _pass(state, current, state.columns[3:], True, rewrite).toDF(*keep, *added)


def _pass(state: DataFrame, automaton: Automaton, kept: list[str], last: bool, rewrite: bool) -> DataFrame:
    """The hits of one automaton and those known before (_text, _hits: word spans, _items, columns in kept): of all rows, or where not last of those that have any."""
    shared = broadcast(state.sparkSession, automaton)
    names = [*kept, *ADDED, *["cleaned"] * rewrite] if last else [*kept, "hits", "items"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = shared.value
        for batch in batches:
            for chunk in K.chunks(batch.column("_text")):
                rows = batch.slice(chunk.lo, chunk.docs)
                low = K.Chunk(chunk.lo, chunk.hi, K.LOWER[chunk.data], chunk.offs)
                starts, ends, first = K.spans(low, SEPARATORS)
                hashes, owner = K.span_hash(K.prefix_hash(low.data), starts, ends), K.of_doc(first)
                edges = np.zeros(len(hashes) + 1, np.int64)
                items = [set(x or ()) for x in rows.column("_items").to_pylist()]
                for doc, before in enumerate(rows.column("_hits").to_pylist()):
                    for s, t in zip((before or ())[::2], (before or ())[1::2], strict=True):
                        edges[first[doc] + s] += 1
                        edges[first[doc] + t] -= 1
                numbers, begin, stop = a.stretches(hashes, owner)
                for b, e in zip(begin.tolist(), stop.tolist(), strict=True):
                    found, ids = a.hits(numbers[b:e].tolist())
                    for s, t in found:
                        edges[b + s] += 1
                        edges[b + t] -= 1
                    if ids:
                        items[owner[b]] |= {a.ids[i] for i in ids}
                hit = np.cumsum(edges)[: len(hashes)] > 0
                stretches: list[list[tuple[int, int]]] = [[] for _ in range(chunk.docs)]
                at = np.flatnonzero(hit)
                if len(at):
                    cut = (at[1:] != at[:-1] + 1) | (owner[at[1:]] != owner[at[:-1]])
                    for i, j in zip(at[np.concatenate([[True], cut])].tolist(), at[np.concatenate([cut, [True]])].tolist(), strict=True):
                        stretches[owner[i]].append((i, j))
                if not last:
                    some = [doc for doc, found in enumerate(stretches) if found]
                    words = [[int(x) for i, j in stretches[doc] for x in (i - first[doc], j + 1 - first[doc])] for doc in some]
                    yield pa.record_batch([*(rows.column(c).take(pa.array(some, pa.int64())) for c in kept), pa.array(words, pa.list_(pa.int64())), pa.array([sorted(items[doc]) for doc in some], pa.list_(pa.string()))], names)
                    continue
                spans = [[int(x) for i, j in found for x in (starts[i] - chunk.offs[doc], ends[j] - chunk.offs[doc])] for doc, found in enumerate(stretches)]
                out = [*(rows.column(c) for c in kept), pa.array(np.diff(first)), pa.array(K.per_doc(hit, first).astype(np.int64)), pa.array([sorted(x) for x in items], pa.list_(pa.string())), pa.array(spans, pa.list_(pa.int64()))]
                if rewrite:
                    out.append(pa.array([_without(x, s) for x, s in zip(rows.column("_text").to_pylist(), spans, strict=True)], pa.string()))
                yield pa.record_batch(out, names)

    made = "n_words long, n_hit long, items array<string>, hit_spans array<long>" + ", cleaned string" * rewrite if last else "hits array<long>, items array<string>"
    return state.mapInArrow(K.tidy(run), "".join(f"{k}, " for k in [kinds(state, kept)] if k) + made)


def _without(text: str | None, spans: list[int]) -> str | None:
    if not spans:
        return text
    raw, at, out = text.encode(), 0, []
    for a, b in zip(spans[::2], spans[1::2], strict=True):
        out.append(raw[at:a])
        at = b
    return b"".join([*out, raw[at:]]).decode()


def clean(docs: DataFrame, benchmark: DataFrame, max_share: float = MAX_SHARE) -> DataFrame:
    """docs, without texts of which more than max_share is benchmark, and without the hit words of the others. Columns keep their values, whatever their names."""
    rows, names = carried(docs)
    text = names["text"]
    found = scan(rows, benchmark, keep=[c for c in rows.columns if c != text], text=text, rewrite=True)
    left = found.filter(F.col("n_hit") <= F.lit(max_share) * F.col("n_words"))
    values = {c: F.col(v) for c, v in names.items() if c != "text"} | {"text": F.col("cleaned")}
    if "n_chars" in names:
        values["n_chars"] = F.when(F.col("n_hit") > 0, F.length("cleaned").cast(docs.schema["n_chars"].dataType)).otherwise(values["n_chars"])
    return left.select(*(values[c].alias(c) for c in docs.columns))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    digest = F.sha2(F.array_join("items", ","), 256)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), digest.alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


_WORDS_SQL = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
ORACLE_SQL = f"""
WITH t AS (SELECT doc_id, coalesce({_WORDS_SQL}, []) AS w FROM documents),
k AS (SELECT item, least(len(w), {WINDOW}) AS size, w FROM (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS_SQL} AS w FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL) WHERE len(w) > 0),
win AS (SELECT DISTINCT item, size, array_to_string(w[i:i + size - 1], ' ') AS win FROM k, unnest(range(1, len(w) - size + 2)) u(i)),
d AS (SELECT doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') AS win FROM t, (SELECT DISTINCT size FROM win) s, unnest(range(1, len(w) - size + 2)) u(i)),
h AS (SELECT doc_id, item, i, size FROM d JOIN win USING (size, win)),
p AS (SELECT doc_id, count(DISTINCT i + j) AS n_hit FROM h, unnest(range(0, size)) u(j) GROUP BY 1),
n AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM h GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM t LEFT JOIN p USING (doc_id) LEFT JOIN n USING (doc_id)
"""
