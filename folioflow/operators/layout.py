"""Positioned words to page text. One shuffle, on (file_id, page_num), of packed words; a page is a small group by nature."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.functions import rules as R
from folioflow.functions.text import decode, strip
from folioflow.session import ship

PAGE = ("file_id", "page_num")
#: Words, and bytes of them, that a task holds before it packs them.
HELD_WORDS, HELD_BYTES = 1 << 17, 8 << 20
#: Characters of finished pages that it holds before it gives them out.
OUT_CHARS = 1 << 21
#: Bits of a word's flags. A word that is no BODY word counts for the share of coded words only.
LEFT, RIGHT, FULL, BOLD, SEEN, CODED, BODY = (1 << i for i in range(7))
#: Bytes of a packed word beside its text: top, x0 and seq, the length of its text, flags.
_NUMBERS, _LENGTH = 24, 28


def is_white(kind: str = "color_kind", color: str = "color") -> Column:
    """Invisible ink. kind: null, 'int' or 'float' for a number (color has one value), 'tuple' for a sequence."""
    number, parts = F.element_at(F.col(color), 1), F.col(color)
    light = (F.size(parts) >= 3) & F.forall(F.slice(parts, 1, 3), lambda c: c > 0.9)
    one = (number == 1) | ((F.col(kind) == "float") & (number > 0.9))
    return F.coalesce(F.when(F.col(kind) == "tuple", light).when(F.col(kind).isNotNull(), one), F.lit(False))


def scaled(words: DataFrame) -> DataFrame:
    """Adds xs and ys, the page's size over the canonical one (1 where the size is missing or 0)."""
    w, h = R.CANONICAL
    return words.withColumn("xs", F.coalesce(F.nullif("page_w", F.lit(0.0)), F.lit(w)) / w).withColumn("ys", F.coalesce(F.nullif("page_h", F.lit(0.0)), F.lit(h)) / h)


def zone(bounds: tuple[int, int]) -> Column:
    lo, hi = bounds
    edge = F.least(hi * F.col("xs"), F.coalesce(F.nullif("page_w", F.lit(0.0)), F.lit(R.CANONICAL[0])))
    return (F.col("x0") >= lo * F.col("xs")) & (F.col("x0") <= edge)


def _page(seq: np.ndarray, text: list[str], x0: np.ndarray, top: np.ndarray, bold: np.ndarray, bucket: np.ndarray, zones: np.ndarray) -> tuple[str, int, int]:
    """Text of a page of visible words below its header, its words without the footer's, and those in the right column."""
    gone = set()
    if R.FOOTER.split()[-1] in "\n".join(text):
        # The footer's mark has one blank: it lies in one word, or in two that follow each other in a bucket.
        order = np.lexsort((seq, bucket))
        gone = {bucket[b] for a, b in zip(order[:-1], order[1:], strict=True) if bucket[a] == bucket[b] and R.FOOTER in f"{text[a]} {text[b]}"}
        gone |= {bucket[i] for i in order if R.FOOTER in text[i]}
    kept = np.flatnonzero(~np.isin(bucket, list(gone))) if gone else np.arange(len(text))
    right = int(zones[1, kept].sum())
    parts = []
    for zone_ in (0, 1) if right >= R.RIGHT_WORDS else (2,):
        at = kept[zones[zone_, kept]]
        at = at[np.lexsort((seq[at], x0[at], top[at]))]
        line, anchor, number = [], 0.0, -1
        for height in top[at].tolist():
            # A line is as far as the tolerance reaches from its first word, not from word to word.
            if number < 0 or height - anchor > R.LINE_TOLERANCE:
                anchor, number = height, number + 1
            line.append(number)
        at = at[np.lexsort((seq[at], x0[at], line))]
        words, edges = [text[i] for i in at.tolist()], np.searchsorted(line, np.arange(number + 2)).tolist()
        lines = [" ".join(words[a:b]) for a, b in zip(edges[:-1], edges[1:], strict=True)]
        all_bold = np.logical_and.reduceat(bold[at], edges[:-1]).tolist() if lines else []
        parts.append("\n".join(R.BOLD + x if b and x.strip() else x for x, b in zip(lines, all_bold, strict=True)).strip())
    return decode("\n".join(parts).strip()), len(kept), right


def _pack(cells: np.ndarray, text: memoryview) -> bytes:
    """Words as one block: the bytes of their numbers, those of equal weight side by side, and their text. A word takes a few bytes more than its text."""
    raw = cells.T.tobytes() + bytes(text)
    return np.array([len(cells), len(raw)], np.int64).tobytes() + pa.Codec("zstd", compression_level=1).compress(raw, asbytes=True)


def _unpack(block: bytes) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """(top, x0, seq) by word, flags and texts of a block."""
    n, size = np.frombuffer(block, np.int64, 2).tolist()
    raw = pa.Codec("zstd").decompress(memoryview(block)[16:], size, asbytes=True)
    cells = np.frombuffer(raw, np.uint8, (_LENGTH + 1) * n).reshape(-1, n)
    numbers = np.ascontiguousarray(cells[:_NUMBERS].T).view(np.float64)
    offsets = np.concatenate([[0], np.cumsum(np.ascontiguousarray(cells[_NUMBERS:_LENGTH].T).view(np.uint32).ravel())]).astype(np.int64)
    text = pa.LargeStringArray.from_buffers(n, pa.py_buffer(offsets), pa.py_buffer(raw[cells.size :]))
    return numbers, cells[_LENGTH], text.to_pylist()


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words (file_id, page_num, top, x0, seq, text, flags) as blocks: a row for each page among those that the task holds."""

    def flush(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        words = pa.Table.from_batches(held).combine_chunks()
        file, page = (words.column(c).combine_chunks().dictionary_encode("encode") for c in PAGE)
        key = file.indices.to_numpy().astype(np.int64) * len(page.dictionary) + page.indices.to_numpy()
        order = np.argsort(key, kind="stable")
        first = np.flatnonzero(np.concatenate([[True], np.diff(key[order]) != 0]))
        flags = words.column("flags").to_numpy().view(np.uint8)[order]
        body = (flags & BODY) > 0
        at = order[body]
        text = words.column("text").take(pa.array(at)).combine_chunks()
        offsets = np.frombuffer(text.buffers()[1], np.int32)[text.offset : text.offset + len(text) + 1] if len(text) else np.zeros(1, np.int32)
        data = memoryview(text.buffers()[2] or b"")
        numbers = np.stack([words.column(c).to_numpy()[at] for c in ("top", "x0", "seq")], axis=1)
        cells = np.concatenate([numbers.view(np.uint8), np.diff(offsets).astype(np.uint32)[:, None].view(np.uint8), flags[body][:, None]], axis=1)
        edges = np.concatenate([[0], np.cumsum(np.add.reduceat(body, first, dtype=np.int64))]).tolist()
        blocks = [_pack(cells[a:b], data[offsets[a] : offsets[b]]) if b > a else None for a, b in zip(edges[:-1], edges[1:], strict=True)]
        counts = [pa.array(np.add.reduceat((flags & bits) == bits, first, dtype=np.int64)) for bits in (SEEN, SEEN | CODED)]
        return pa.record_batch([*(words.column(c).take(pa.array(order[first])).combine_chunks() for c in PAGE), *counts, pa.array(blocks, pa.binary())], [*PAGE, "n_seen", "n_coded", "block"])

    held, rows, size = [], 0, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows, size = rows + batch.num_rows, size + batch.nbytes
        if rows >= HELD_WORDS or size >= HELD_BYTES:
            yield flush(held)
            held, rows, size = [], 0, 0
    if held:
        yield flush(held)


def _read(blocks: list[bytes]) -> tuple[str, int, int]:
    parts = [_unpack(b) for b in blocks]
    if not parts:
        return "", 0, 0
    numbers, flags = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
    top, x0, seq = numbers.T
    # Footer lines: words of a rounded height, half to even.
    return _page(seq, [t for p in parts for t in p[2]], x0, top, (flags & BOLD) > 0, np.rint(top / R.FOOTER_BUCKET), np.stack([(flags & z) > 0 for z in (LEFT, RIGHT, FULL)]))


def _pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The kernel of `pages`: blocks of words to texts, page by page."""
    names = ["file_id", "page_num", "cid_word_pct", "text", "n_body", "n_right", "error_detail"]
    for batch in batches:
        made, size, start = [], 0, 0
        for end, blocks in enumerate(batch.column("blocks"), 1):
            try:
                made.append((*_read(blocks.as_py()), None))
            except Exception as e:  # noqa: BLE001 - one bad page is a row, and does not lose the others
                made.append(("", 0, 0, f"{type(e).__name__}: {e}"[:500]))
            size += len(made[-1][0])
            if size >= OUT_CHARS or end == batch.num_rows:
                # A batch of Spark's is so many rows, whatever their size.
                texts, n_body, n_right, error = zip(*made, strict=True)
                yield pa.record_batch([*(batch.column(c).slice(start, end - start) for c in names[:3]), pa.array(texts, pa.string()), pa.array(n_body, pa.int32()), pa.array(n_right, pa.int32()), pa.array(error, pa.string())], names)
                made, size, start = [], 0, end


def pages(words: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Pages of words. known (file_id, page_num, error_detail) names further pages: read errors, and pages without words.

    One scan and one shuffle: invisible, masthead and header words go before it, and a task packs what it has of a page's words into
    one block, so that what is shuffled is hardly more than their text. A page's blocks meet in one row, where an Arrow kernel
    orders the words. A page is a small group by nature.
    """
    ship(words.sparkSession)
    text = F.coalesce("text", F.lit(""))
    limit = F.when(F.col("page_num") == 1, R.HEADER_TOP_FIRST).otherwise(R.HEADER_TOP_REST) * F.col("ys")
    seen = scaled(words).withColumn("_seen", ~is_white())
    body = F.col("_seen") & ((F.col("page_num") != 1) | (F.coalesce("size", F.lit(0.0)) < R.MASTHEAD_SIZE)) & (F.col("top") >= limit)
    bold = F.contains(F.lower(F.coalesce("fontname", F.lit(""))), F.lit("bold"))
    bits = {LEFT: zone(R.LEFT), RIGHT: zone(R.RIGHT), FULL: zone(R.FULL), BOLD: bold, SEEN: F.col("_seen"), CODED: F.contains(text, F.lit("(cid:")), BODY: body}
    flags = reduce(Column.__add__, (F.when(c, n).otherwise(0) for n, c in bits.items())).cast("tinyint")
    number = lambda c, null: F.coalesce(F.col(c).cast("double"), F.lit(null))
    flat = seen.select(*PAGE, number("top", 0.0).alias("top"), number("x0", 0.0).alias("x0"), number("word_seq", float("nan")).alias("seq"), F.when(body, text).alias("text"), flags.alias("flags"))
    blocks = flat.mapInArrow(_packed, f"file_id string, page_num int, n_seen long, n_coded long, block binary")
    found = blocks.groupBy(*PAGE).agg(F.try_divide(F.sum("n_coded"), F.sum("n_seen")).alias("cid_word_pct"), F.collect_list("block").alias("blocks"))
    out = found.mapInArrow(_pages, "file_id string, page_num int, cid_word_pct double, text string, n_body int, n_right int, error_detail string")
    if known is not None:
        out = out.join(known.select(*PAGE), [*PAGE], "left_anti").unionByName(known.select(*PAGE, "error_detail"), allowMissingColumns=True)
    scanned = F.coalesce(F.col("cid_word_pct") > R.SCANNED_SHARE, F.lit(False))
    status = F.when(F.col("error_detail").isNotNull(), "error").when(scanned, "scanned").when(F.coalesce("n_body", F.lit(0)) == 0, "empty").when(strip(F.coalesce("text", F.lit(""))) == "", "empty").otherwise("ok")
    return out.select(
        *PAGE,
        F.when(status == "ok", F.col("text")).otherwise(F.lit("")).alias("text"),
        status.alias("status"),
        F.when(~scanned & (F.coalesce("n_right", F.lit(0)) >= R.RIGHT_WORDS), "two_column").otherwise("single_column").alias("column_layout"),
        "error_detail",
        F.when(scanned, F.col("cid_word_pct")).alias("cid_word_pct"),
    )


def logged_share() -> Column:
    """The share of coded words as the log has it; null for pages that are not scanned."""
    return F.when(F.col("status") == "scanned", F.round("cid_word_pct", 4))


def scanned_pages(pages: DataFrame) -> DataFrame:
    """The log of scanned pages is a view of the pages."""
    return pages.filter("status = 'scanned'").select(*PAGE, logged_share().alias("cid_word_pct"))


def page_counts(pages: DataFrame) -> DataFrame:
    """Per file: pages by status and layout, and whether it can be skipped (strict: all scanned; else none readable)."""
    of = lambda s: F.count_if(F.col("status") == s)
    return pages.groupBy("file_id").agg(
        F.count(F.lit(1)).alias("n_pages_total"),
        of("ok").alias("n_ok"),
        of("scanned").alias("n_pages_scanned"),
        of("empty").alias("n_empty"),
        of("error").alias("n_error"),
        F.count_if(F.col("column_layout") == "two_column").alias("n_two_column"),
        F.bool_and(F.col("status") == "scanned").alias("skip_strict"),
        F.bool_and(F.col("status").isin("scanned", "empty", "error")).alias("skip"),
    )
