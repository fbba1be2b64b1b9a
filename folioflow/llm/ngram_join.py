"""N-gram Jaccard self-join with PartEnum signatures.

A text's set holds its distinct k-word shingles; two texts link when |A and B| / |A or B| >= p / q.

Method
------
* Sets fall into bands of sizes that double. In band b the shingle domain is cut by hash into n_b partitions of the first level, and
  each of these into `SECOND` of the second. Linked sets of sizes a and b differ in at most d = (a + b)(q - p)/(q + p) shingles. A
  signature is a partition, a subset of all but one of its second-level parts, and what the set holds there: every subset is
  enumerated, so a partition in which the sets differ in one shingle still gives an equal signature. A set signs in the band of its own
  size and, where a linked set may be that large, in the next.
* A differing shingle spoils two signatures, and a whole partition three, so at most e = d + min(d, n_b) of a set's signatures are not the
  other set's. Under one global order of signatures the first e + 1 of each set must meet (the prefix rule), so only these are
  emitted: the ones seen least in a sample of texts (1 in 12, by hash), then those of the most shingles. The order
  decides speed only; any order gives the same links. Passages that thousands of texts share thus leave
  the index without being lost. Signatures of empty parts are left out; a set with no more than e others emits them too.
* Texts with equal sets are one node, named by a 64-bit hash of the set.
* Signatures travel packed in binary blocks, in as many buckets as their number asks for (by rounds of at most `FAN` buckets from each, so that
  blocks stay large and what a flush costs does not grow with the corpus); those that very many texts of the sample
  have travel as rows, so that none fills a bucket. Nodes that share a signature form a group.
* A sketch has a bit for each of 2048 or more parts of the domain: the parity of its shingles there. The bits in which two sketches differ
  are never more than the shingles in which the sets differ, so what it rules out is no link.
* Groups are compared block by block by sketch, and never expanded into all pairs. First, in one group of each node, it gives
  out its nearest of some leaders that are not in its component. Then, in all groups, each node outside the group's largest component gives
  out its nearest few of other components; where that leaves candidates out, the group comes again with more. So the rows given out are a
  constant times the rows read, and none is lost. Every pair given out is verified on whole sets.
* Components of links between components: up to `EDGES` links in one task, more of them by large-star / small-star
  rounds in Spark. Both give the same labels.

Defined results: a null or empty text has an empty set, links with nothing, and is its own component. Repeated
rows have equal sets and fall into one component, the smallest non-null id names it. A null doc_id joins by
its text and never names a component unless all its members are null. Other columns are ignored. An empty table gives an
empty result. Hash equality (64 bits) stands for equality of words and shingles.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folioflow.llm import kernel as K
from folioflow.llm.scratch import broadcast, carried, materialize, ship, table

SHINGLE = 5
P, Q = 75, 100
SAMPLE = 12
HOT_LIMIT = 1 << 19
#: Texts of the sample from which a signature travels as rows; signatures in a bucket, and the least number of buckets.
HEAVY = 256
BUCKET_SIGS, LEAST_BUCKETS = 1 << 21, 64
#: Blocks into which the signatures of one flush are cut; more buckets are reached in further rounds. Signatures in a task of such a round.
FAN, SPLIT_SIGS = 4096, 1 << 23
#: Second-level parts of a partition, shingles of a full set in one, and the least number of partitions.
SECOND, FILL, LEAST_PARTS = 3, 5.5, 6
SKETCH_BITS = 2048
#: A sketch takes the room of so many small rows in a broadcast.
SKETCH_COST = 12
BROADCAST_ROWS = 250_000
#: Rounds with leaders, leaders of a group, and the links for each node that a round must find for another one.
LEADER_ROUNDS, LEADERS, LEADER_GAIN = 3, 128, 0.02
#: Members of a block, rows in a task, candidates that a node gives out at first and the factor of each further time, and pairs of one node in a task.
BLOCK, TASK_ROWS, FIRST, MORE, SALT_ROWS = 1024, 16_384, 4, 16, 512
#: Members of a group that is small: those of one lead, which has a few hundred groups at most, are compared by one task.
NEIGHBOURS = 64
#: Verified pairs in a task.
VERIFIED_ROWS = 1_000
EDGES = 1_000_000
MOST_TASKS = 100_000
FLUSH = 1 << 19
_KEY_BITS = np.uint64(32)
_CODEC = pa.Codec("zstd", compression_level=1)


# ---------------------------------------------------------------- signatures


def bands(n: int, p: int, q: int) -> list[tuple[int, int, int]]:
    """(largest size, partitions, signatures at most that a linked set lacks) of each band in which a set of size n signs."""
    reach = n * q // p
    out, upper = [], 16
    while upper < n:
        upper *= 2
    while True:
        parts = max(LEAST_PARTS, int(upper / FILL))
        differ = (n + min(reach, upper)) * (q - p) // (q + p)
        out.append((upper, parts, differ + min(differ, parts)))
        if reach <= upper:
            return out
        upper *= 2


def signatures(shingles: np.ndarray, upper: int, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """The signatures of every partition and subset, and the number of shingles in each."""
    cells = SECOND * parts
    cell = (((shingles >> np.uint64(32)) * np.uint64(cells)) >> np.uint64(32)).astype(np.int64)
    new = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
    total, size = np.zeros(cells, np.uint64), np.zeros(cells, np.int64)
    total[cell[new]] = np.add.reduceat(K.mix(shingles), new)
    size[cell[new]] = np.diff(np.append(new, len(shingles)))
    total, size = total.reshape(parts, SECOND), size.reshape(parts, SECOND)
    # Subset j leaves part j out.
    held, n = total.sum(axis=1, keepdims=True) - total, size.sum(axis=1, keepdims=True) - size
    return K.mix(held + _subsets(upper, parts)).ravel(), n.ravel()


@functools.cache
def _subsets(upper: int, parts: int) -> np.ndarray:
    return K.mix(np.arange(SECOND * parts, dtype=np.uint64) + np.uint64(upper << 32)).reshape(parts, SECOND)


class Hot:
    """How many texts of the sample have each of the signatures that several have. A table of flags spares most searches."""

    BITS = np.uint64(42)

    def __init__(self, keys: np.ndarray, times: np.ndarray):
        self.keys, self.times = keys, np.minimum(times, 4095)
        self.flags = np.zeros(1 << 22, bool)
        self.flags[keys >> self.BITS] = True
        self.heavy = keys[times >= HEAVY]

    def of(self, sigs: np.ndarray) -> np.ndarray:
        out = np.zeros(len(sigs), np.uint64)
        maybe = np.flatnonzero(self.flags[sigs >> self.BITS])
        where, hit = K.find(self.keys, sigs[maybe])
        out[maybe[hit]] = self.times[where[hit]]
        return out


def chosen(shingles: np.ndarray, p: int, q: int, hot: Hot) -> np.ndarray:
    """The signatures that a set emits, over all its bands. Their order: times in the sample, then size, then 44 bits of their hash."""
    out = []
    for upper, parts, lacking in bands(len(shingles), p, q):
        every, sizes = signatures(shingles, upper, parts)
        filled = np.flatnonzero(sizes)
        if len(filled) <= lacking:
            out.append(every)
            continue
        sigs, rank = every[filled], np.uint64(255) - np.minimum(sizes[filled], 255).astype(np.uint64)
        order = (((hot.of(sigs) << np.uint64(8)) | rank) << np.uint64(44)) | (sigs >> np.uint64(20))
        out.append(sigs[np.argpartition(order, lacking)[: lacking + 1]])
    return np.concatenate(out)


def node_of(shingles: np.ndarray) -> int:
    return int(K.mix(np.atleast_1d(K.mix(shingles).sum() + np.uint64(len(shingles)))).view(np.int64)[0])


def sketch_of(shingles: np.ndarray) -> bytes:
    """Parities, of the more parts of the domain the larger the set is."""
    bits = SKETCH_BITS
    while bits < 4 * len(shingles) and bits < 1 << 16:
        bits *= 2
    at = (K.mix(shingles) >> np.uint64(40)).astype(np.int64) & (bits - 1)
    return np.packbits(np.bincount(at, minlength=bits).astype(np.uint8) & 1, bitorder="little").tobytes()


def closed(sketch: bytes) -> bytes:
    """A sketch as it travels: few of its bits are set. Its first byte is the number of bits of its length."""
    return bytes([len(sketch).bit_length()]) + _CODEC.compress(sketch, asbytes=True)


def opened(sketch: bytes) -> bytes:
    return _CODEC.decompress(sketch[1:], 1 << (sketch[0] - 1), asbytes=True)


def folded(sketches: list[bytes]) -> np.ndarray:
    """Sketches as rows of equal length, that of the shortest: parts that fall together add their parities."""
    size = min(map(len, sketches), default=8)
    if all(len(x) == size for x in sketches):
        return np.frombuffer(b"".join(sketches), np.uint64).reshape(len(sketches), -1)
    return np.stack([np.bitwise_xor.reduce(np.frombuffer(x, np.uint64).reshape(-1, size // 8), axis=0) for x in sketches])


def node_sets(docs: DataFrame, k: int, p: int, q: int, sample: int = SAMPLE) -> DataFrame:
    """One row per text (kind 0: doc_id, text_hash, node, n, sketch), and signature counts of a sample of texts (kind 1: node is the signature)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["kind", "doc_id", "text_hash", "node", "n", "sketch"]
        seen = K.Counter()

        def counted() -> Iterator[pa.RecordBatch]:
            keys, n = seen.result()
            for a in range(0, len(keys), 1 << 17):
                part = keys[a : a + (1 << 17)].view(np.int64)
                none = pa.nulls(len(part), pa.int64())
                yield pa.record_batch([pa.array(np.ones(len(part), np.int32)), none, none, pa.array(part), pa.array(n[a : a + (1 << 17)]), pa.nulls(len(part), pa.binary())], names)

        for batch in batches:
            picked = batch.column(2).to_numpy(zero_copy_only=False)
            for chunk in K.chunks(batch.column(1)):
                nodes, sizes, sketches, sampled = [], [], [], []
                for i, s in enumerate(K.shingle_sets(*K.words(chunk), k)):
                    sizes.append(len(s))
                    nodes.append(node_of(s) if len(s) else None)
                    sketches.append(closed(sketch_of(s)) if len(s) > 2 else None)
                    if picked[chunk.lo + i] and len(s) > 2:
                        for u, m, _ in bands(len(s), p, q):
                            sigs, filled = signatures(s, u, m)
                            sampled.append(sigs[filled > 0])
                if sampled:
                    seen.add(np.concatenate(sampled))
                    if len(seen.keys) > FLUSH:
                        yield from counted()
                        seen = K.Counter()
                ids, hashes = (batch.column(c).slice(chunk.lo, chunk.docs) for c in (0, 3))
                yield pa.record_batch([pa.array(np.zeros(len(sizes), np.int32)), ids, hashes, pa.array(nodes, pa.int64()), pa.array(sizes, pa.int64()), pa.array(sketches, pa.binary())], names)
        yield from counted()

    ship(docs.sparkSession)
    picked = F.pmod(F.xxhash64("doc_id"), F.lit(sample)) == 0
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", picked.alias("picked"), F.xxhash64("text").alias("text_hash")).mapInArrow(K.tidy(run), "kind int, doc_id long, text_hash long, node long, n long, sketch binary")


def hot_signatures(sets: DataFrame, limit: int = HOT_LIMIT) -> tuple[np.ndarray, np.ndarray]:
    """Signatures that several sampled texts have, at most `limit` of them, and how many have them."""
    counts = sets.filter("kind = 1").groupBy("node").agg(F.sum("n").alias("n")).filter("n > 1")
    got = counts.orderBy(F.desc("n"), "node").limit(limit).toArrow()
    keys, n = got.column("node").to_numpy().view(np.uint64), got.column("n").to_numpy()
    by = np.argsort(keys)
    return keys[by], n[by]


def buckets_of(shingles: int) -> int:
    """Buckets for the signatures of sets of so many shingles in all; a set has hardly more signatures than shingles.

    A block names a node once, so the fewer buckets there are, the less a signature takes.
    """
    return max(LEAST_BUCKETS, shingles // BUCKET_SIGS)


def fans(buckets: int) -> list[int]:
    """Fan-outs of the rounds that reach so many buckets (or some more): equal ones, none above FAN."""
    most = FAN
    rounds = 1
    while most**rounds < buckets:
        rounds += 1
    if rounds == 1:
        return [buckets]
    fan = next(f for f in range(2, most + 1) if f**rounds >= buckets)
    return [fan] * rounds


def pack(nodes: np.ndarray, sizes: np.ndarray, owner: np.ndarray, sigs: np.ndarray, buckets: int, fine: int = 1) -> tuple[list[int], list[bytes]]:
    """Blocks by bucket: the nodes with a signature there, their sizes and numbers of signatures, and 32 bits of each signature. The bucket stands for further ones.

    Nodes and signatures are hashes, which no codec makes smaller; nodes stand in the order of their sizes, so that sizes and numbers take next to no room.
    With fine, that many neighbouring buckets are one here, and signatures stay whole for the rounds that follow.
    """
    if not len(sigs):
        return [], []
    bucket = ((sigs >> _KEY_BITS) % np.uint64(buckets) // np.uint64(fine)).astype(np.int64)
    order = np.argsort(sizes, kind="stable")
    nodes, sizes, place = nodes[order], sizes[order], np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    owner = place[owner]
    by = np.argsort(bucket * len(nodes) + owner, kind="stable")
    bucket, owner, key = bucket[by], owner[by], sigs[by] if fine > 1 else sigs[by].astype(np.uint32)
    edges = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]]))
    out = []
    for lo, hi in zip(edges[:-1], edges[1:], strict=True):
        new = np.flatnonzero(np.concatenate([[True], owner[lo + 1 : hi] != owner[lo : hi - 1]]))
        mine = owner[lo:hi][new]
        counts = np.diff(np.append(new, hi - lo)).astype(np.uint32)
        steps = np.stack([np.diff(sizes[mine], prepend=0).astype(np.uint32), counts]).view(np.uint8).reshape(2, -1, 4)
        small = _CODEC.compress(steps.transpose(0, 2, 1).tobytes(), asbytes=True)
        head = np.array([len(mine), hi - lo, len(small)], np.uint32)
        out.append(b"".join((head.tobytes(), small, nodes[mine].tobytes(), key[lo:hi].tobytes())))
    return bucket[edges[:-1]].tolist(), out


def _parts(block: bytes, whole: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Nodes, their sizes and numbers of signatures, and the signatures (or 32 bits of them) of a block."""
    n, s, small = np.frombuffer(block, np.uint32, 3).tolist()
    raw = np.frombuffer(_CODEC.decompress(block[12 : 12 + small], 8 * n, asbytes=True), np.uint8).reshape(2, 4, n)
    steps, counts = np.ascontiguousarray(raw.transpose(0, 2, 1)).view(np.uint32).reshape(2, n)
    at = 12 + small
    return np.frombuffer(block, np.int64, n, at), np.cumsum(steps, dtype=np.uint32), counts, np.frombuffer(block, np.uint64 if whole else np.uint32, s, at + 8 * n)


def finer(blocks: DataFrame, buckets: int, before: int, fine: int) -> DataFrame:
    """Blocks of whole signatures, each of `before` neighbouring buckets, as blocks of `fine` ones.

    A block of a round is a row of one bucket, which goes to as many tasks as its signatures ask for; a task cuts what it has read of them, a bounded number at a time.
    """
    names = blocks.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        waiting = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nodes, sizes, counts, sigs = (np.concatenate(x) for x in zip(*held, strict=True))
            b, made = pack(nodes, sizes, np.repeat(np.arange(len(nodes)), counts), sigs, buckets, fine)
            none = pa.nulls(len(b), pa.int64())
            yield pa.record_batch([pa.array(b, pa.int32()), pa.array(made, pa.binary()), none, none, none], names)

        for batch in batches:
            heavy = batch.filter(pc.is_null(batch.column("block")))
            if heavy.num_rows:
                yield heavy
            for block in batch.column("block").drop_null().to_pylist():
                held.append(_parts(block, True))
                waiting += len(held[-1][3])
                if waiting > FLUSH:
                    yield from flush()
                    held, waiting = [], 0
        if held:
            yield from flush()

    salts = max(1, before * BUCKET_SIGS // SPLIT_SIGS)
    tasks = min(-(-buckets // before) * salts, MOST_TASKS)
    salt = F.pmod(F.xxhash64("block", "node"), F.lit(salts))
    return blocks.repartition(tasks, "bucket", salt).mapInArrow(K.tidy(run), blocks.schema)


def signed(docs: DataFrame, k: int, p: int, q: int, hot: tuple[np.ndarray, np.ndarray], buckets: int) -> DataFrame:
    """Signatures of all nodes, each node once for each task that meets it: packed (bucket, block), heavy ones as rows (gid, node, n) of negative buckets."""
    rounds = fans(buckets)
    buckets = math.prod(rounds)
    fine = buckets // rounds[0]
    shared = broadcast(docs.sparkSession, hot)
    names = ["bucket", "block", "gid", "node", "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: set[int] = set()
        nodes: list[int] = []
        sizes: list[int] = []
        sigs: list[np.ndarray] = []
        waiting = 0
        keys = Hot(*shared.value)

        def flush() -> Iterator[pa.RecordBatch]:
            owner, every = np.repeat(np.arange(len(sigs)), [len(s) for s in sigs]), np.concatenate(sigs)
            of, n = np.array(nodes, np.int64), np.array(sizes, np.int64)
            _, rows = K.find(keys.heavy, every)
            at = owner[rows]
            if len(at):
                yield pa.record_batch([pa.array((-1 - of[at] % buckets).astype(np.int32)), pa.nulls(len(at), pa.binary()), pa.array(every[rows].view(np.int64)), pa.array(of[at]), pa.array(n[at])], names)
            b, blocks = pack(of, n, owner[~rows], every[~rows], buckets, fine)
            none = pa.nulls(len(b), pa.int64())
            yield pa.record_batch([pa.array(b, pa.int32()), pa.array(blocks, pa.binary()), none, none, none], names)

        for batch in batches:
            for chunk in K.chunks(batch.column(0)):
                for s in K.shingle_sets(*K.words(chunk), k):
                    if len(s) <= 2 or (node := node_of(s)) in known:
                        continue
                    known.add(node)
                    nodes.append(node)
                    sizes.append(len(s))
                    sigs.append(chosen(s, p, q, keys))
                    waiting += len(sigs[-1])
                if waiting > FLUSH:
                    yield from flush()
                    nodes, sizes, sigs, waiting = [], [], [], 0
        if sigs:
            yield from flush()

    out = docs.select("text").mapInArrow(K.tidy(run), "bucket int, block binary, gid long, node long, n long")
    for fan in rounds[1:]:
        out, fine = finer(out, buckets, fine, fine // fan), fine // fan
    return out


def groups(blocks: DataFrame) -> DataFrame:
    """(gid, node, n, size) of each distinct set of two or more nodes that share a signature; the size of one of a heavy signature is null."""

    def run(rows: pa.Table) -> pa.Table:
        if rows.column("bucket")[0].as_py() < 0:
            return rows.select(["gid", "node", "n"]).append_column("size", pa.nulls(rows.num_rows, pa.int64()))
        node, size, counts, key = (np.concatenate(x) for x in zip(*(_parts(b.as_py(), False) for b in rows.column("block")), strict=True))
        node, first, place = np.unique(node, return_index=True, return_inverse=True)
        size = size[first]
        # A signature and the place of its node are one number, so that one plain sort brings signatures together and drops what comes twice.
        met = (key.astype(np.uint64) << _KEY_BITS) | np.repeat(place.astype(np.uint32), counts)
        del key, place, counts
        met.sort()
        met = met[np.concatenate([[True], met[1:] != met[:-1]])]
        key, place = (met >> _KEY_BITS).astype(np.uint32), met.astype(np.uint32)
        new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        count = np.diff(np.append(new, len(key)))
        new, count = new[count > 1], count[count > 1]
        starts = np.cumsum(count) - count
        place = place[np.repeat(new - starts, count) + np.arange(int(count.sum()))]
        gid = K.mix(np.add.reduceat(K.mix(node.view(np.uint64))[place], starts) + count.astype(np.uint64)) if len(starts) else np.zeros(0, np.uint64)
        _, where = np.unique(gid, return_index=True)
        gid, count, new = gid[where], count[where], starts[where]
        take = place[np.repeat(new - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))]
        return pa.table({"gid": pa.array(np.repeat(gid, count).view(np.int64)), "node": pa.array(node[take]), "n": pa.array(size[take].astype(np.int64)), "size": pa.array(np.repeat(count, count))})

    return blocks.groupBy("bucket").applyInArrow(run, "gid long, node long, n long, size long").dropDuplicates(["gid", "node"])


# ---------------------------------------------------------------- components


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts = [(x.column(0).to_numpy(), x.column(1).to_numpy()) for x in batches]
    if not parts:
        return
    ends = np.concatenate([np.concatenate(x) for x in zip(*parts, strict=True)])
    nodes, at = np.unique(ends, return_inverse=True)
    a, b = at[: len(at) // 2], at[len(at) // 2 :]
    label = np.arange(len(nodes))
    while True:
        least = np.minimum(label[a], label[b])
        new = label.copy()
        for end in (a, b):
            np.minimum.at(new, label[end], least)
            np.minimum.at(new, end, least)
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    yield pa.record_batch([pa.array(nodes), pa.array(nodes[label])], ["node", "label"])


def components(edges: DataFrame, count: int, limit: int = EDGES) -> DataFrame:
    """(node, label) of all nodes of edges (a, b), at most count of them; label the smallest node that can be reached."""
    ship(edges.sparkSession)
    name = "stars"
    pairs = edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    if count <= limit:
        return pairs.coalesce(1).mapInArrow(K.tidy(_solve), "node long, label long")
    pairs, before = materialize(pairs.distinct(), name), None
    while True:
        state = pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            return pairs.select(F.col("a").alias("node"), F.col("b").alias("label")).union(pairs.select(F.col("b"), F.col("b"))).groupBy("node").agg(F.min("label").alias("label"))
        before = state
        both = pairs.union(pairs.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(least, F.col("a") == F.col("u")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.union(least.filter("u != m").select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), "m")
        small = large.join(low, F.col("a") == F.col("u")).select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a != b")
        pairs = materialize(small.union(low.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct(), name)


def _sets_of(docs: DataFrame, wanted: DataFrame, k: int, rows: int) -> DataFrame:
    """(node, shingles) of the texts whose doc_id is wanted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in K.chunks(batch.column(0)):
                sets = [s for s in K.shingle_sets(*K.words(chunk), k) if len(s)]
                offs = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
                flat = np.concatenate([*sets, np.zeros(0, np.uint64)]).view(np.int64)
                yield pa.record_batch([pa.array([node_of(s) for s in sets], pa.int64()), pa.ListArray.from_arrays(pa.array(offs), pa.array(flat))], ["node", "shingles"])

    found = docs.select("doc_id", "text").join(_small(wanted, rows), F.col("doc_id").cast("long").eqNullSafe(F.col("wanted")), "left_semi")
    return found.select("text").mapInArrow(K.tidy(run), "node long, shingles array<long>")


def _small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def dealt(state: DataFrame, open_: DataFrame, leaders: bool, turn: int) -> DataFrame:
    """Members (gid, node, n, label) of open groups, dealt to cells of a block of probes and a block of members: gid, cell, probe, twice, both, node, n, label, home.

    Probes are some leaders, or all nodes outside the largest component. A member is in a cell for each block of probes, a probe in one for each
    block of members. both: a member that is a probe as well; in the cell where it is dealt as either, one row stands for both of them (twice).
    Cells of one home meet in one task: small groups of one lead have most of their members in common.
    """
    rows = state.join(open_.select("gid", "members", "main", "main_size", "lead"), "gid")
    if leaders:
        share = F.pmod(F.xxhash64("node", "gid", F.lit(turn)), F.lit(1 << 30)).cast("double") / float(1 << 30)
        probe, probes = (share * F.col("members") < LEADERS) | (F.col("node") == F.col("lead")), F.lit(1)
    else:
        probe, probes = F.col("label") != F.col("main"), F.col("members") - F.col("main_size")
    blocks = lambda n: F.ceil(n / F.lit(float(BLOCK))).cast("int")
    rows = rows.withColumns({"both": probe, "_p": blocks(probes), "_m": blocks(F.col("members"))})
    h = F.xxhash64("gid", "node")
    rows = rows.withColumns({"_i": F.pmod(h, F.col("_p")).cast("int"), "_j": F.pmod(h, F.col("_m")).cast("int")})
    as_member = F.transform(F.sequence(F.lit(0), F.col("_p") - 1), lambda i: F.struct((i * F.col("_m") + F.col("_j")).alias("cell"), F.lit(False).alias("probe"), (F.col("both") & (i == F.col("_i"))).alias("twice")))
    others = F.filter(F.sequence(F.lit(0), F.col("_m") - 1), lambda j: j != F.col("_j"))
    as_probe = F.transform(others, lambda j: F.struct((F.col("_i") * F.col("_m") + j).alias("cell"), F.lit(True).alias("probe"), F.lit(False).alias("twice")))
    cells = F.when(F.col("both"), F.concat(as_member, as_probe)).otherwise(as_member)
    rows = rows.select("gid", "node", "n", "label", "both", "members", "lead", F.inline(cells))
    home = F.when(F.col("members") <= NEIGHBOURS, F.xxhash64("lead")).otherwise(F.xxhash64("gid", "cell"))
    return rows.withColumn("home", home).drop("members", "lead")


def compared(rows: DataFrame, p: int, q: int, leaders: bool, most: int) -> DataFrame:
    """Pairs (gid, a, b) of rows (part, gid, cell, probe, twice, both, node, n, label, sketch) in different components that their sizes and sketches let link.

    A node has its sketch in one of its rows of a part. With leaders, the nearest probe of each member; else the `most` nearest members of each probe, and a row without a pair where there are more.
    """

    def run(table: pa.Table) -> pa.Table:
        gid, cell, probe, both, node, n, label = (table.column(c).to_numpy() for c in ("gid", "cell", "probe", "both", "node", "n", "label"))
        again = np.flatnonzero(table.column("twice").to_numpy())
        probe = np.concatenate([probe, np.ones(len(again), bool)])
        rows = np.concatenate([np.arange(len(gid)), again])
        by = rows[at := np.lexsort((n[rows], probe, cell[rows], gid[rows]))]
        probe = probe[at]
        gid, cell, both, node, n, label = (x[by] for x in (gid, cell, both, node, n, label))
        held = np.flatnonzero(table.column("sketch").is_valid().to_numpy())
        of = table.column("node").to_numpy()[held]
        held = held[np.argsort(of, kind="stable")]
        sketches = table.column("sketch").take(pa.array(held[np.searchsorted(np.sort(of), node)]))
        edges = np.flatnonzero(np.concatenate([[True], (gid[1:] != gid[:-1]) | (cell[1:] != cell[:-1]), [True]])).tolist()
        out: list[tuple] = []
        cut = set()
        for lo, hi in zip(edges[:-1], edges[1:], strict=True):
            first = lo + int(np.count_nonzero(~probe[lo:hi]))  # members, then probes
            if first == hi or first == lo:
                continue
            sketch = folded([opened(x) for x in sketches.slice(lo, hi - lo).to_pylist()])
            size, found = n[lo:first], []
            for i in range(first, hi):
                start, last = np.searchsorted(size, -(-n[i] * p // q)), np.searchsorted(size, n[i] * q // p, "right")
                others = slice(lo + int(start), lo + int(last))
                at = np.flatnonzero((label[others] != label[i]) & (~both[others] | (node[others] > node[i]))) + others.start
                if len(at):
                    bits = np.bitwise_count(sketch[at - lo] ^ sketch[i - lo]).sum(axis=1)
                    near = bits <= (n[at] + n[i]) * (q - p) // (q + p)
                    at, bits = at[near], bits[near]
                    if not leaders and len(at) > most:
                        cut.add(int(gid[lo]))
                        keep = np.argpartition(bits, most)[:most]
                        at, bits = at[keep], bits[keep]
                    found.append((at, np.full(len(at), i), bits))
            if found:
                at, i, bits = (np.concatenate(x) for x in zip(*found, strict=True))
                if leaders:
                    best = np.lexsort((bits, at))
                    best = best[np.concatenate([[True], at[best][1:] != at[best][:-1]])[: len(best)]]
                    at, i = at[best], i[best]
                out.append((gid[at], np.minimum(node[at], node[i]), np.maximum(node[at], node[i])))
        ids, a, b = (np.concatenate(x) for x in zip(*out, strict=True)) if out else [np.zeros(0, np.int64)] * 3
        more = pa.array(sorted(cut), pa.int64())
        none = pa.nulls(len(more), pa.int64())
        return pa.table({c: pa.concat_arrays([pa.array(x, pa.int64()), y]) for c, x, y in (("gid", ids, more), ("a", a, none), ("b", b, none))})

    return rows.groupBy("part").applyInArrow(run, "gid long, a long, b long")


def _verified(docs: DataFrame, pairs: DataFrame, count: int, nodes: DataFrame, k: int, p: int, q: int) -> DataFrame:
    """Pairs (a, b), count of them, with whether they link, on whole sets, which are made again from the texts that are needed.

    A node of many pairs goes to as many tasks as these ask for.
    """
    ends = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    wanted = nodes.join(_small(ends, 2 * count), "node", "left_semi").select(F.col("class_id").alias("wanted")).distinct()
    sets = materialize(_sets_of(docs, wanted, k, 2 * count), "node_sets").dropDuplicates(["node"])
    shares = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / float(SALT_ROWS)).cast("int").alias("_n"))
    salted = pairs.join(_small(shares, count), "a").select("a", "b", F.pmod(F.xxhash64("a", "b"), F.col("_n")).cast("int").alias("_s"))
    of_b = sets.select(F.col("node").alias("b"), F.col("shingles").alias("_sb")).join(salted, "b")
    of_a = sets.select(F.col("node").alias("a"), F.col("shingles").alias("_sa")).join(_small(shares, count), "a")
    both = of_b.join(of_a.select("a", "_sa", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)).alias("_s")), ["a", "_s"])
    shared = F.size(F.array_intersect("_sa", "_sb"))
    return both.select("a", "b", (q * shared >= p * (F.size("_sa") + F.size("_sb") - shared)).alias("link"))


def near_components(docs: DataFrame, k: int = SHINGLE, p: int = P, q: int = Q) -> DataFrame:
    """Per row of docs (doc_id, text): doc_id, text_hash, n_shingles, node, component_id, and kept_hash: the text hash of the component's first row."""
    sets = materialize(node_sets(docs, k, p, q), "sets")
    texts = sets.filter("kind = 0").select("doc_id", "text_hash", "node", F.col("n").alias("n_shingles"))
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    classes = texts.filter("node is not null").groupBy("node").agg(F.min(rank).alias("first")).withColumn("class_id", F.col("first.doc_id"))
    total = sets.filter("kind = 0").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    members = materialize(groups(signed(docs, k, p, q, hot_signatures(sets), buckets_of(total))), "groups")
    # Tables that many copies join are written first: a join of two plain shuffles is one whose hot keys Spark can split.
    grouped = materialize(members.select("node").distinct().join(classes, "node").select(F.col("node").alias("_n"), "class_id"), "grouped")
    named = sets.filter("kind = 0").join(grouped, (F.col("node") == F.col("_n")) & F.col("doc_id").eqNullSafe(F.col("class_id")))
    nodes = materialize(named.select("node", "class_id", "n", "sketch").dropDuplicates(["node"]), "nodes")
    labels = _link(docs, members, nodes, k, p, q)
    count = labels.count()
    least = labels.join(classes, "node").groupBy("label").agg(F.min("first").alias("least"))
    named = materialize(classes.join(labels.join(_small(least, count), "label").select("node", "least"), "node", "left").select("node", F.coalesce("least", "first").alias("least")), "named")
    joined = texts.join(named, "node", "left")
    of = lambda c: F.when(F.col("node").isNull(), F.col(c)).otherwise(F.col(f"least.{c}"))
    return joined.select("doc_id", "text_hash", "n_shingles", "node", of("doc_id").alias("component_id"), of("text_hash").alias("kept_hash"))


def _link(docs: DataFrame, members: DataFrame, nodes: DataFrame, k: int, p: int, q: int) -> DataFrame:
    """Labels of nodes by component."""
    labels = nodes.select("node", F.col("node").alias("label"))
    count, rows_of_all = nodes.count(), members.count()
    sketches = _small(nodes.select("node", "sketch"), SKETCH_COST * count)
    tested: list[DataFrame] = []
    # Near copies share many groups. One group of each node (the largest, then any) joins most of them, so that few pairs are open when all are compared.
    size = F.coalesce("size", F.lit(1 << 62))
    turn, most, todo, leaders = 0, FIRST, members, True
    while True:
        rank = F.struct((F.xxhash64("gid", F.lit(turn)) if turn else size).alias("rank"), "gid", "n")
        one = members.groupBy("node").agg(F.max(rank).alias("top")).select("node", "top.gid", "top.n")
        state = (one if leaders else todo).join(_small(labels, count), "node")
        sizes = state.groupBy("gid", "label").agg(F.count(F.lit(1)).alias("size"), F.min(F.struct(F.xxhash64("node", F.lit(turn)).alias("h"), "node")).alias("first"))
        all_, double = F.sum("size"), F.col("size").cast("double")
        open_ = sizes.groupBy("gid").agg(all_.alias("members"), ((all_.cast("double") ** 2 - F.sum(double * double)) / 2).alias("pairs"), F.max(F.struct("size", "label")).alias("top"), F.min("first").alias("lead"))
        open_ = materialize(open_.filter("pairs > 0").select("gid", "members", "pairs", F.col("top.label").alias("main"), F.col("top.size").alias("main_size"), F.col("lead.node").alias("lead")), "open", rows_of_all)
        cells = F.lit(1.0) if leaders else F.ceil((F.col("members") - F.col("main_size")) / float(BLOCK))
        total = open_.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("members") * cells).alias("rows")).first()
        if not total["n"]:
            if not leaders:
                break
            leaders = False
            continue
        rows = dealt(state, _small(open_, total["n"]), leaders, turn).withColumn("part", F.pmod("home", F.lit(max(64, int(2 * total["rows"]) // TASK_ROWS))))
        # Sketches are most of what is sent: a part gets each node's once.
        before = F.lag("part").over(Window.partitionBy("node").orderBy("part"))
        rows = rows.withColumn("_once", ~before.eqNullSafe(F.col("part"))).join(sketches, "node").withColumn("sketch", F.when(F.col("_once"), F.col("sketch"))).drop("_once", "home")
        found = materialize(compared(rows, p, q, leaders, most), "found")
        given = found.agg(F.count("a").alias("pairs"), F.count_if(F.col("a").isNull()).alias("cut")).first()
        cut = given["cut"]
        pairs = found.filter("a is not null").select("a", "b").distinct()
        if tested:
            pairs = pairs.join(reduce(DataFrame.union, tested), ["a", "b"], "left_anti")
        pairs = materialize(pairs, "pairs", given["pairs"])
        number = pairs.count()
        checked = materialize(_verified(docs, pairs, number, nodes, k, p, q), "tested", number, VERIFIED_ROWS)
        tested.append(checked.select("a", "b"))
        links = checked.filter("link")
        number = links.count()
        if number:
            of_a = labels.select(F.col("node").alias("a"), F.col("label").alias("la"))
            of_b = labels.select(F.col("node").alias("b"), F.col("label").alias("lb"))
            merged = components(links.join(_small(of_a, count), "a").join(_small(of_b, count), "b").select(F.col("la").alias("a"), F.col("lb").alias("b")), number)
            merged = merged.select(F.col("node").alias("label"), F.col("label").alias("to"))
            labels = materialize(labels.join(_small(merged, number), "label", "left").select("node", F.coalesce("to", "label").alias("label")), "labels", count)
        turn += 1
        if leaders:
            leaders = turn < LEADER_ROUNDS and number > LEADER_GAIN * count
        else:
            if not cut:
                break
            todo, most = todo.join(_small(found.filter("a is null").select("gid").distinct(), cut), "gid", "left_semi"), MORE * most
    return labels


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_components(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "n_shingles", "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """docs without all but one row of each component: the one with the smallest id (of equal ids, by text hash). Rows without words all stay."""
    rows, restored = carried(docs)
    found = materialize(near_components(docs.select("doc_id", "text")), "components")
    worded = found.filter("node is not null").select(F.col("doc_id").alias("d"), F.col("text_hash").alias("h"), (F.col("doc_id").eqNullSafe(F.col("component_id")) & F.col("text_hash").eqNullSafe(F.col("kept_hash"))).alias("first"))
    drop = materialize(worded.filter("not first").select("d", "h").distinct(), "drop")
    rows = rows.withColumns({"doc": F.col(restored["doc_id"]).cast("long"), "hash": F.xxhash64(restored["text"])})
    same = F.col("doc").eqNullSafe(F.col("d")) & (F.col("hash") == F.col("h"))
    kept = rows.join(_small(drop, drop.count()), same, "left_anti")
    twice = materialize(worded.filter("first").groupBy("d", "h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("d", "h"), "twice")
    if not twice.isEmpty():
        # Repeated rows: one of them stays.
        others = _small(twice, twice.count())
        kept = kept.join(others, same, "left_anti").unionByName(kept.join(others, same, "left_semi").dropDuplicates(["doc", "hash"]))
    return kept.select(*(F.col(v).alias(c) for c, v in restored.items()))


ORACLE_SQL = r"""
WITH RECURSIVE t AS (SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + size - 1], ' ') AS shingle FROM (SELECT *, least(len(w), 5) AS size FROM t WHERE len(w) > 0), unnest(range(1, len(w) - size + 2)) u(i)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
o AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS o FROM s a JOIN s b USING (shingle) WHERE a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM o JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * o >= 75 * (a.n + b.n - o)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r AS (SELECT x, y FROM e UNION SELECT r.x, e.y FROM r JOIN e ON e.x = r.y)
SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(m, doc_id)) AS component_id
FROM t LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT x AS doc_id, min(y) AS m FROM r GROUP BY 1) USING (doc_id)
"""
