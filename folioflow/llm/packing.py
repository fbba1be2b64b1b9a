"""Best-fit packing by a linear grouping scheme over the histogram of lengths.

Method
------
1. Texts are tokenised and cut; only (id, piece, start, length, checksum) of each piece is kept.
2. The lengths 1 to C are counted: a histogram of at most C numbers, whatever the corpus' size, goes to the driver.
3. `plan` sorts the large lengths into groups of equal cardinality and rounds each up to its group's largest;
   configurations of these few sizes are optimised by column generation (a revised simplex method
   with a knapsack for prices), and rounded down to whole sequences. Actual lengths then take the places of the rounded ones, and
   what is left over and the small lengths go, longest first, where they fit best. All of this works on runs of equal sequences, never on
   single documents: the plan is a list of (length, first rank, count, first sequence, offset).
4. Spark ranks the pieces of each length (in salted chunks, so that no length is one task), and each
   piece finds its run by its rank.

Defined results: a null text is empty: one piece of the end token alone. Repeated rows are packed each. A null doc_id is kept. Other
columns are ignored. An empty table gives an empty result. Only texts longer than C tokens are cut, into pieces of C with the shorter one first.
"""

from __future__ import annotations

import array
import json
import logging
import os
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.llm import kernel as K
from folioflow.llm.scratch import broadcast, materialize, ship, table, with_rank

CAPACITY = 1024
END = 2
#: Numbers of groups that are planned with; the plan of fewest sequences stays. From the capacity on, each length is a group.
GROUPS = (400, CAPACITY)
#: Lengths up to this share of the capacity are small.
SMALL = 0.4
#: Bytes of texts and ids that an encoder remembers, and of texts that are encoded at once.
CACHE_BYTES, BATCH_BYTES = 128 << 20, 4 << 20
CHUNKS = 64

# ---------------------------------------------------------------- tokens

_SPACE = r"\t-\r\x20\x85\xa0"
_LETTER = r"A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-ɏ"
_NUMBER = r"0-9\xb2\xb3\xb9\xbc-\xbe"
#: The byte-level pre-tokenisation rule, with its classes written out for code points below U+0250.
_PIECES = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTER}]+| ?[{_NUMBER}]+| ?[^{_SPACE}{_LETTER}{_NUMBER}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")
_BEYOND = re.compile("[^\\x00-ɏ]")

#: Byte-level vocabularies write printable bytes as themselves and the others as code points from U+0100 on.
_PRINTABLE = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_BYTE_LEVEL = {b: chr(0x100 + i) for i, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}

_encoders: dict[str, Encoder] = {}


class Encoder:
    """Little-endian 32-bit ids of texts by a tokenizers file.

    A byte-level tokeniser without a normaliser works inside the pieces of its pre-tokenisation, so these go to its model directly and
    their ids are kept. Texts with code points from U+0250 on, or with an added token, and all texts of other
    tokenisers are encoded as a whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        before = json.loads(self.tokenizer.to_str())
        rule = before["pre_tokenizer"] or {}
        self.by_piece = before["normalizer"] is None and rule.get("type") == "ByteLevel" and not rule.get("add_prefix_space") and rule.get("use_regex", True)
        self.whole = re.compile("|".join([_BEYOND.pattern, *map(re.escape, added)]))
        self.known: dict[str, bytes] = _Cache(self._of_piece)

    def _of_text(self, text: str) -> bytes:
        return array.array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _of_piece(self, piece: str) -> bytes:
        # Of printable ASCII only the blank is written otherwise.
        plain = piece.isascii() and piece.isprintable()
        written = piece.replace(" ", _BYTE_LEVEL[0x20]) if plain else piece.encode().decode("latin-1").translate(_BYTE_LEVEL)
        return array.array("I", [t.id for t in self.tokenizer.model.tokenize(written)]).tobytes()

    def __call__(self, text: str) -> bytes:
        if not self.by_piece or self.whole.search(text):
            return self._of_text(text)
        self.known.bound()
        return b"".join(map(self.known.__getitem__, _PIECES.findall(text)))


#: What an entry of a dictionary takes besides its characters.
_ENTRY = 180


class _Cache(dict):
    """Two generations: what was not asked for while one filled up is forgotten."""

    def __init__(self, make):
        super().__init__()
        self.make, self.bytes, self.older = make, 0, {}

    def __missing__(self, key: str) -> bytes:
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        self[key] = value
        self.bytes += _ENTRY + len(key) + len(value)
        return value

    def bound(self) -> None:
        if self.bytes > CACHE_BYTES // 2:
            self.older = dict(self)
            self.clear()
            self.bytes = 0


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def cut(n: int, capacity: int) -> Iterator[tuple[int, int]]:
    """(start, end) of the pieces of n tokens; only the first may be shorter than the capacity."""
    first = n % capacity or min(n, capacity)
    yield 0, first
    for a in range(first, n, capacity):
        yield a, a + capacity


def pieces(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None, end: int = END, with_ids: bool = False, text: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every piece; with_ids adds its ids."""
    ship(docs.sparkSession)
    names = ["doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file = path or tokenizer_path()
        encode = _encoders.get(file) or _encoders.setdefault(file, Encoder(file))
        tail = array.array("I", [end]).tobytes()
        for batch in batches:
            for chunk in K.chunks(batch.column(1), BATCH_BYTES):
                part = batch.slice(chunk.lo, chunk.docs)
                rows: list[list] = [[] for _ in names]
                source = []
                for i, x in enumerate(part.column(1).to_pylist()):
                    ids = encode(x or "") + tail
                    for number, (a, b) in enumerate(cut(len(ids) // 4, capacity)):
                        own = ids[4 * a : 4 * b]
                        source.append(i)
                        for column, value in zip(rows[1:], (number, a, b - a, zlib.crc32(own), np.frombuffer(own, np.uint32).astype(np.int32) if with_ids else None), strict=False):
                            column.append(value)
                out = [part.column(0).take(pa.array(source, pa.int32())), pa.array(rows[1], pa.int32()), *(pa.array(r, pa.int64()) for r in rows[2:5])]
                if with_ids:
                    out.append(pa.array(rows[5], pa.list_(pa.int32())))
                yield pa.record_batch(out, names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", text).mapInArrow(K.tidy(run), f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids)


# ---------------------------------------------------------------- plan


@dataclass
class Plan:
    """Runs: pieces of a length, from a rank on, one to each of as many sequences, at an offset."""

    sequences: int = 0
    runs: list[tuple[int, int, int, int, int]] = field(default_factory=list)

    def arrays(self) -> tuple[np.ndarray, ...]:
        runs = np.array(sorted(self.runs), np.int64).reshape(-1, 5)
        return tuple(runs.T)


def configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int, rounds: int = 4000) -> tuple[np.ndarray, np.ndarray]:
    """Columns (numbers of each size in a sequence) and how often each is used, by column generation, in fractions."""
    m = len(sizes)
    columns = np.diag((capacity // sizes).astype(float))
    inverse = np.diag(1 / np.diag(columns))
    x = inverse @ demand
    depth = int(capacity // sizes.min())
    for left_rounds in range(rounds, 0, -1):
        if left_rounds == 1:
            logging.getLogger(__name__).warning("configurations are not optimal after %d rounds; sequences are whole, but may be more than needed", rounds)
        price = inverse.sum(axis=0)
        best = np.zeros(capacity + 1)
        choice = []
        for _layer in range(depth):  # one more document a layer
            more = np.full((m, capacity + 1), -1.0)
            for i in np.flatnonzero(price > 1e-12):
                more[i, sizes[i] :] = best[: capacity + 1 - sizes[i]] + price[i]
            top = more.argmax(axis=0)
            value = more[top, np.arange(capacity + 1)]
            take = value > best + 1e-12
            choice.append(np.where(take, top, -1))
            if not take.any():
                break
            best = np.where(take, value, best)
        if best[capacity] <= 1 + 1e-7:
            break
        column, left = np.zeros(m), capacity
        for layer in reversed(choice):
            if layer[left] >= 0:
                column[layer[left]] += 1
                left -= sizes[layer[left]]
        way = inverse @ column
        ok = way > 1e-9
        if not ok.any():
            break
        ratio = np.full(m, np.inf)
        ratio[ok] = x[ok] / way[ok]
        out = int(ratio.argmin())
        x -= ratio[out] * way
        x[out] = ratio[out]
        columns[:, out] = column
        inverse[out] /= way[out]
        others = np.arange(m) != out
        inverse[others] -= np.outer(way[others], inverse[out])
    return columns.astype(np.int64), np.maximum(x, 0)


def plan(histogram: np.ndarray, capacity: int = CAPACITY, groups: int = GROUPS[0], small: float = SMALL) -> Plan:
    """histogram[n]: pieces of length n, for n from 0 to capacity."""
    out = Plan()
    left = histogram.astype(np.int64).copy()
    ranks = np.zeros(capacity + 1, np.int64)  # the next rank of each length
    free: dict[int, list[tuple[int, int]]] = {}  # room left: runs of (first sequence, count)

    def place(length: int, count: int, sequence: int, offset: int) -> None:
        out.runs.append((length, int(ranks[length]), count, sequence, offset))
        ranks[length] += count
        left[length] -= count

    if left[capacity]:
        n = int(left[capacity])
        place(capacity, n, 0, 0)
        out.sequences = n

    least = int(capacity * small) + 1
    lengths = np.arange(capacity - 1, least - 1, -1)
    total = int(left[lengths].sum())
    if total:
        # Groups of equal cardinality, longest first; each size is its group's largest.
        upto = np.cumsum(left[lengths])
        number = np.minimum((upto - 1) * groups // total, groups - 1) if groups < capacity else np.arange(len(lengths))
        there = left[lengths] > 0
        ids = np.unique(number[there])
        members = [lengths[there & (number == g)] for g in ids]
        sizes = np.array([x[0] for x in members])
        demand = np.array([left[x].sum() for x in members])
        columns, used = configurations(sizes, demand.astype(float), capacity)
        for j in np.argsort(-used):
            times = int(used[j] + 1e-6)
            if not times:
                continue
            slots = np.repeat(np.arange(len(sizes)), columns[:, j])
            spans = [(out.sequences, times, 0)]  # (first sequence, count, filled)
            out.sequences += times
            for g in slots:
                todo, spans = spans, []
                for first, count, filled in todo:
                    while count:
                        have = next((n for n in members[g] if left[n]), None)
                        take = min(count, int(left[have])) if have is not None else count
                        if have is not None:
                            place(int(have), take, first, filled)
                        spans.append((first, take, filled + (int(have) if have is not None else 0)))
                        first, count = first + take, count - take
            for first, count, filled in spans:
                free.setdefault(capacity - filled, []).append((first, count))

    # What is left over and small, longest first, to the fullest sequence that takes it.
    for n in range(capacity - 1, 0, -1):
        room = n
        while left[n]:
            while room <= capacity and not free.get(room):
                room += 1
            if room > capacity:
                per = capacity // n
                count = int(-(-left[n] // per))
                first = out.sequences
                out.sequences += count
                free.setdefault(capacity, []).append((first, count))
                room = n
                continue
            first, count = free[room].pop()
            take = min(count, int(left[n])) if room < 2 * n or left[n] < count else count
            if take < count:
                free[room].append((first + take, count - take))
            place(n, take, first, capacity - room)
            free.setdefault(room - n, []).append((first, take))
            room = n  # the same sequences are the fullest ones if they take another
    return out


# ---------------------------------------------------------------- packing


def best_plan(histogram: np.ndarray, capacity: int = CAPACITY, groups: tuple[int, ...] = GROUPS) -> Plan:
    """The plan of fewest sequences. Coarse groups round more, fine ones leave more fractions of configurations."""
    return min((plan(histogram, capacity, g) for g in groups), key=lambda p: p.sequences)


def pack(found: DataFrame, capacity: int = CAPACITY, groups: tuple[int, ...] = GROUPS, chunks: int = CHUNKS) -> DataFrame:
    """found (of `pieces`, materialised) with sequence_id and offset."""
    spark = found.sparkSession
    histogram = np.zeros(capacity + 1, np.int64)
    for row in found.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect():
        histogram[row["length"]] = row["n"]
    made = best_plan(histogram, capacity, groups)
    shared = broadcast(spark, made.arrays())
    ranked = with_rank(found, ["length"], ["doc_id", "piece", "ids_crc32"], "rank", chunks)
    carried = found.columns
    names = [*carried, "sequence_id", "offset"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length, rank, _, sequence, offset = shared.value
        keys = (length << 48) | rank
        for batch in batches:
            n, r = (batch.column(c).to_numpy() for c in ("length", "rank"))
            at = np.searchsorted(keys, (n << 48) | r, "right") - 1
            yield pa.record_batch([*(batch.column(c) for c in carried), pa.array(sequence[at] + r - rank[at]), pa.array(offset[at])], names)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in found.schema) + ", sequence_id long, offset long"
    return ranked.select(*carried, "rank").mapInArrow(K.tidy(run), schema)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids, doc_ids) of packed pieces with ids; a sequence is at most one capacity long."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids")))
    return packed.groupBy("sequence_id").agg(parts.alias("_p")).select("sequence_id", F.flatten(F.transform("_p", lambda p: p["ids"])).alias("ids"), F.transform("_p", lambda p: p["doc_id"]).alias("doc_ids"))


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None) -> DataFrame:
    return pack(materialize(pieces(docs, capacity, path), "pieces"), capacity)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))
