"""Running lines: page heads and feet that come back on page after page of a file, found and taken out.

Candidates come from mergeable summaries of heavy hitters (Misra and Gries): for each file and place, a task keeps at most CELLS lines with counters; when a further line comes, all counters go
down by one. A line on more than one in CELLS + 1 of the pages stays in the merged summary whatever the order, so nothing that is asked for is missed, and however many different lines a file has, at most CELLS
of them are sent on. A second pass counts the candidates exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.functions.text import squash
from folioflow.session import materialize, ship

#: Lines from the top and from the bottom of a page that are looked at.
DEPTH = 2
#: A line is running if it has its place on this share of a file's readable pages, and on so many of them.
SHARE, LEAST = 0.5, 3
CELLS = 4
#: Summaries that a task holds before it gives them out.
HELD = 100_000
#: Candidates that are broadcast; beyond, they are joined by a shuffle.
FEW = 100_000

SUMMARY = "file_id string, place int, line string, n long"


def line_key(line: Column) -> Column:
    """What equal running lines share: words joined by single blanks, numbers as #."""
    return F.regexp_replace(squash(line), r"[0-9]+", "#")


def edge_lines(pages: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(file_id, page_num, place, number, line) of lines that are not blank, near the edges of readable pages: places 1, 2 from the top and -1, -2 from the bottom. A line of a short page has several places."""
    number = F.sequence(F.lit(0), F.size(F.split("text", "\n", -1)) - 1)
    lines = F.arrays_zip(number.alias("number"), F.transform(F.split("text", "\n", -1), line_key).alias("line"))
    kept = pages.filter("status = 'ok'").select("file_id", "page_num", F.filter(lines, lambda x: x["line"] != "").alias("lines"))
    n = F.size("lines")
    placed = [F.when(n >= abs(i), F.struct(F.lit(i).alias("place"), F.try_element_at("lines", F.lit(i)).alias("at"))) for i in (*range(1, depth + 1), *range(-depth, 0))]
    return kept.select("file_id", "page_num", F.inline(F.array_compact(F.array(*placed)))).select("file_id", "page_num", "place", F.col("at.number").alias("number"), F.col("at.line").alias("line"))


class _Summary(dict):
    """line -> counter, of at most `cells` lines."""

    def add(self, line: str, n: int, cells: int) -> None:
        if line in self or len(self) < cells:
            self[line] = self.get(line, 0) + n
            return
        least = min(n, min(self.values()))
        for k in [*self]:
            self[k] -= least
            if not self[k]:
                del self[k]
        if n > least:
            self.add(line, n - least, cells)


def _rows(found: dict) -> pa.RecordBatch:
    flat = [(f, p, line, n) for (f, p), lines in found.items() for line, n in lines.items()]
    columns = [[r[i] for r in flat] for i in range(4)]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int32(), pa.string(), pa.int64()), strict=True)], names=["file_id", "place", "line", "n"])


def candidates(lines: DataFrame, cells: int = CELLS) -> DataFrame:
    """(file_id, place, line): every line of (file_id, place, line) on more than one in cells + 1 rows of its file and place, and others, at most `cells` of them."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple, _Summary] = {}
        for b in batches:
            for f, p, line in zip(*(b.column(c).to_pylist() for c in ("file_id", "place", "line")), strict=True):
                found.setdefault((f, p), _Summary()).add(line, 1, cells)
                if len(found) > HELD:
                    yield _rows(found)
                    found.clear()
        yield _rows(found)

    def merged(rows: pa.Table) -> pa.Table:
        one = _Summary()
        for line, n in zip(rows["line"].to_pylist(), rows["n"].to_pylist(), strict=True):
            one.add(line, n, cells)
        return pa.Table.from_batches([_rows({(rows["file_id"][0].as_py(), rows["place"][0].as_py()): one})])

    ship(lines.sparkSession)
    parts = lines.select("file_id", F.col("place").cast("int").alias("place"), "line").mapInArrow(summed, SUMMARY)
    return parts.groupBy("file_id", "place").applyInArrow(merged, SUMMARY).select("file_id", "place", "line")


def found(pages: DataFrame, share: float = SHARE, least: int = LEAST, depth: int = DEPTH) -> DataFrame:
    """(file_id, place, line, n_pages, n_of): the running lines of files, on n_pages of n_of readable pages."""
    lines = materialize(edge_lines(pages, depth), "edge_lines")
    asked = candidates(lines, max(CELLS, int(1 / share) + 1))
    few = asked.limit(FEW + 1).count() <= FEW
    counted = lines.join(F.broadcast(asked) if few else asked, ["file_id", "place", "line"]).groupBy("file_id", "place", "line").agg(F.count(F.lit(1)).alias("n_pages"))
    of = pages.filter("status = 'ok'").groupBy("file_id").agg(F.count(F.lit(1)).alias("n_of"))
    return counted.join(of, "file_id").filter((F.col("n_pages") >= least) & (F.col("n_pages") >= share * F.col("n_of")))


def without(pages: DataFrame, share: float = SHARE, least: int = LEAST, depth: int = DEPTH) -> DataFrame:
    """pages without their running lines, and with n_suppressed, the number of lines that went. Pages that are not readable stay as they are; null texts are empty."""
    running = materialize(found(pages, share, least, depth).groupBy("file_id").agg(F.collect_list(F.struct("place", "line")).alias("_running")), "running")  # at most 2 * depth / share lines a file
    few = running.limit(FEW + 1).count() <= FEW
    joined = pages.withColumn("text", F.coalesce("text", F.lit(""))).join(F.broadcast(running) if few else running, "file_id", "left")
    lines = F.transform(F.split("text", "\n", -1), lambda x: F.struct(x.alias("raw"), line_key(x).alias("line")))
    out = joined.withColumn("_lines", F.when(F.col("_running").isNotNull() & (F.col("status") == "ok"), lines))
    # A line's place is its rank among those that are not blank, from either side.
    full = F.filter(F.transform("_lines", lambda x, i: F.struct(x["line"].alias("line"), i.alias("i"))), lambda x: x["line"] != "")
    out = out.withColumn("_full", full)
    gone = F.array_union(
        F.transform(F.filter(F.transform(F.slice("_full", 1, depth), lambda x, i: F.struct(x["i"].alias("i"), (i + 1).alias("place"), x["line"].alias("line"))), lambda x: F.array_contains("_running", F.struct(x["place"].alias("place"), x["line"].alias("line")))), lambda x: x["i"]),
        F.transform(F.filter(F.transform(F.slice(F.reverse("_full"), 1, depth), lambda x, i: F.struct(x["i"].alias("i"), (-1 - i).alias("place"), x["line"].alias("line"))), lambda x: F.array_contains("_running", F.struct(x["place"].alias("place"), x["line"].alias("line")))), lambda x: x["i"]),
    )
    out = out.withColumn("_gone", gone)
    kept = F.array_join(F.transform(F.filter("_lines", lambda x, i: ~F.array_contains("_gone", i)), lambda x: x["raw"]), "\n")
    return out.withColumns({"text": F.coalesce(F.when(F.size("_gone") > 0, kept), F.col("text")), "n_suppressed": F.greatest(F.coalesce(F.size("_gone"), F.lit(0)), F.lit(0))}).drop("_running", "_lines", "_full", "_gone")
