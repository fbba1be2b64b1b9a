"""Page JSON as a data source of its own, for batches and streams: `spark.read.format("folio_pages")`.

Files are dealt to tasks by their bytes, a file that is no array of pages is a row with the reason, and a stream keeps a log of the files that it has taken: each file is
read once, whenever it came and whatever its time says.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from urllib.parse import unquote

from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from folioflow.operators import schemas as S

SPLIT_BYTES = 16 << 20
UNREADABLE = "no array of pages"


class Split(InputPartition):
    """Files of about a task's bytes; a larger file is a split of its own."""

    def __init__(self, files: Sequence[str]) -> None:
        self.files = tuple(files)


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(f"file://{path.removeprefix('file:')}" if path.startswith("file:/") and not path.startswith("file://") else path)


def _listed(path: str) -> list[tuple[str, int]]:
    """(path, bytes) of the JSON files of a folder, by name."""
    store, folder = _open(path)
    found = store.get_file_info(fs.FileSelector(folder, allow_not_found=True))
    return sorted((f.path, f.size) for f in found if f.type == fs.FileType.File and f.extension == "json")


def _dealt(files: Sequence[tuple[str, int]], size: int) -> list[Split]:
    out, held, n = [], [], 0
    for path, length in files:
        if held and n + length > size:
            out.append(Split(held))
            held, n = [], 0
        held.append(path)
        n += length
    return [*out, Split(held)] if held else out


def _value(page: dict, name: str, kind: str) -> object:
    value = page.get(name)
    if value is None:
        return None
    return value if kind == "string" and isinstance(value, str) else json.dumps(value, ensure_ascii=False) if kind == "string" else int(value) if kind == "int" else float(value)


_FIELDS = [tuple(p.split()) for p in S.PAGES.split(", ")][1:]


def _rows(path: str, files: Sequence[str]) -> Iterator[tuple]:
    store, _ = _open(path)
    for name in files:
        file_id = unquote(name.rpartition("/")[2].rpartition(".")[0])
        try:
            with store.open_input_stream(name) as f:
                pages = json.loads(f.read())
            if not isinstance(pages, list) or not all(isinstance(p, dict) for p in pages):
                raise ValueError(UNREADABLE)
            rows = [(file_id, *(_value(p, n, kind) for n, kind in _FIELDS)) for p in pages]
        except (OSError, ValueError, TypeError, RecursionError) as e:
            rows = [(file_id, None, None, "error", None, f"{UNREADABLE}: {type(e).__name__}: {e}"[:500], None)]
        yield from rows


class PageReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.path, self.size = options["path"], int(options.get("splitbytes", SPLIT_BYTES))

    def partitions(self) -> list[Split]:
        return _dealt(_listed(self.path), self.size) or [Split([])]

    def read(self, partition: Split) -> Iterator[tuple]:
        return _rows(self.path, partition.files)


class PageStream(DataSourceStreamReader):
    """Offsets count the entries of a log: entry n holds the files that were new when offset n + 1 was asked for, with their bytes."""

    def __init__(self, options: dict) -> None:
        self.path, self.size, self.most = options["path"], int(options.get("splitbytes", SPLIT_BYTES)), int(options.get("maxfiles", "0"))
        self.store, self.log = _open(options["log"])
        self.store.create_dir(self.log, recursive=True)

    def _entry(self, n: int) -> list[tuple[str, int]]:
        with self.store.open_input_stream(f"{self.log}/{n:09d}") as f:
            return [tuple(x) for x in json.loads(f.read())]

    def _entries(self) -> int:
        return sum(f.type == fs.FileType.File and f.base_name.isdigit() for f in self.store.get_file_info(fs.FileSelector(self.log)))

    def initialOffset(self) -> dict:
        return {"entries": 0}

    def latestOffset(self) -> dict:
        n = self._entries()
        taken = {name for i in range(n) for name, _ in self._entry(i)}
        fresh = [f for f in _listed(self.path) if f[0] not in taken]
        for at in range(0, len(fresh), self.most or max(1, len(fresh))):
            half = f"{self.log}/_{n}"
            with self.store.open_output_stream(half) as f:
                f.write(json.dumps(fresh[at : at + (self.most or len(fresh))]).encode())
            self.store.move(half, f"{self.log}/{n:09d}")
            n += 1
        return {"entries": n}

    def partitions(self, start: dict, end: dict) -> list[Split]:
        return [s for n in range(start["entries"], end["entries"]) for s in _dealt(self._entry(n), self.size)] or [Split([])]

    def read(self, partition: Split) -> Iterator[tuple]:
        return _rows(self.path, partition.files)

    def commit(self, end: dict) -> None:
        pass


class Pages(DataSource):
    """Options: path, splitBytes; of a stream also log, a folder that belongs to it as its checkpoint does."""

    @classmethod
    def name(cls) -> str:
        return "folio_pages"

    def schema(self) -> str:
        return S.PAGES

    def reader(self, schema: StructType) -> PageReader:
        return PageReader({k.lower(): v for k, v in self.options.items()})

    def streamReader(self, schema: StructType) -> PageStream:
        return PageStream({k.lower(): v for k, v in self.options.items()})


def register(spark: SparkSession) -> None:
    """Makes the format known to a session."""
    from folioflow.session import ship

    ship(spark)
    spark.dataSource.register(Pages)
