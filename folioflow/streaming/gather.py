"""Files whose pages come in several batches: pages wait in keyed state until their file is whole.

Needs the session settings of `SETTINGS` before the stream starts: a state store that keeps several kinds of state, and, for a run that ends when its files are done
(availableNow), no batches without data: with timers Spark would go on with these for ever. Timers are then looked at when pages come; a stream that
stays up can leave the second setting as it is.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from folioflow.operators import schemas as S

SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}
#: A file that lacks pages is given out after this time without a new one.
WAIT_MS = 3_600_000
#: So long pages of a file that was given out are known, and passed over.
KNOWN_MS = 7 * 24 * 3_600_000
MISSING = "page did not arrive"
#: Pages as they come, with the number of pages that their file has (null where the page does not know).
LOOSE = S.PAGES + ", n_pages int"


class Gather(StatefulProcessor):
    """Gives out a file's pages together. State of a file: its pages by number, how many there will be, and, afterwards, that it is over."""

    def __init__(self, wait_ms: int, known_ms: int) -> None:
        self.wait_ms, self.known_ms = wait_ms, known_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        text = T.StringType()
        page = T.StructType([T.StructField("text", text), T.StructField("status", text), T.StructField("column_layout", text), T.StructField("error_detail", text), T.StructField("cid_word_pct", T.DoubleType())])
        self.handle = handle
        self.pages = handle.getMapState("pages", T.StructType([T.StructField("page_num", T.IntegerType())]), page)
        self.expected = handle.getValueState("expected", T.StructType([T.StructField("n", T.IntegerType())]))
        self.over = handle.getValueState("over", T.StructType([T.StructField("over", T.BooleanType())]), self.known_ms)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        if self.over.exists():
            for _ in rows:
                pass
            return
        known = self.expected.get()[0] if self.expected.exists() else 0
        for part in rows:
            for r in part.itertuples(index=False):
                if not pd.isna(r.page_num):
                    self.pages.updateValue((int(r.page_num),), tuple(None if pd.isna(x) else x for x in (r.text, r.status, r.column_layout, r.error_detail, r.cid_word_pct)))
                if not pd.isna(r.n_pages):
                    known = max(known, int(r.n_pages))
        self.expected.update((known,))
        if known and sum(1 for _ in self.pages.keys()) >= known:
            yield from self._out(key, known)
            return
        for timer in self.handle.listTimers():
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.wait_ms)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if not self.over.exists():
            yield from self._out(key, self.expected.get()[0] if self.expected.exists() else 0)

    def _out(self, key: tuple, known: int) -> Iterator[pd.DataFrame]:
        pages = {number[0]: page for number, page in self.pages.iterator()}
        lost = [n for n in range(1, known + 1) if n not in pages] if len(pages) < known else []
        rows = [(key[0], n, *page) for n, page in pages.items()] + [(key[0], n, "", "error", "single_column", MISSING, None) for n in lost]
        frame = pd.DataFrame(sorted(rows, key=lambda r: r[1]), columns=S.columns(S.PAGES))
        yield frame.astype({"page_num": "int32", "cid_word_pct": "float64"})
        self.pages.clear()
        self.expected.clear()
        for timer in self.handle.listTimers():
            self.handle.deleteTimer(timer)
        self.over.update((True,))

    def close(self) -> None:
        pass


def whole_files(pages: DataFrame, wait_ms: int = WAIT_MS, known_ms: int = KNOWN_MS) -> DataFrame:
    """Pages (schema PAGES) of files that are whole, or have waited for wait_ms, from a stream of LOOSE pages.

    A page that comes twice counts once, as it came last. Missing pages are of status error. A null file_id is a file; pages without a number only tell how many there are.
    """
    return pages.groupBy("file_id").transformWithStateInPandas(Gather(wait_ms, known_ms), S.PAGES, "Append", "ProcessingTime")


def loose_pages(spark: SparkSession, folder: str, files: int) -> DataFrame:
    """A stream of Parquet files of loose pages."""
    return spark.readStream.option("maxFilesPerTrigger", files).schema(LOOSE).parquet(folder)
