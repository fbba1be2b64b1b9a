"""The header service as a plug-in: any function of a prompt. Offline, nothing calls it and headers go by rule."""

from __future__ import annotations

import json
import threading
import time
from collections import deque
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import Future
from concurrent.futures import TimeoutError as Late

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.session import materialize, release, ship
from folioflow.sources import sinks

PROMPT_CHARS = 4000
ATTEMPTS = 2
TIMEOUT = 10.0
#: Calls of a task that are open at the same time.
WINDOW = 8
#: The name of the back-end that asks nobody.
BY_RULE = "rule_based"
ANSWERS = "prompt_key string, answer string"
RESULTS = "prompt_key string, answer string, error string"

Service = Callable[[str], str]


def chosen(services: dict[str, Service], name: str = BY_RULE) -> Service | None:
    """The back-end of that name; None where headers go by rule."""
    if name == BY_RULE:
        return None
    if name not in services:
        raise ValueError(f"no header service {name}: {', '.join([BY_RULE, *services])}")
    return services[name]


def _insisting(service: Service, attempts: int) -> Service:
    """Asks again where an answer is no JSON."""

    def call(prompt: str) -> str:
        answer = ""
        for _ in range(attempts):
            answer = service(prompt)
            try:
                json.loads(answer[answer.find("{") :].removesuffix("```"))
                break
            except ValueError:
                continue
        return answer

    return call


def _started(call: Service, prompt: str) -> Future:
    """A call in a thread of its own: one that hangs holds neither the task nor a later call."""
    out: Future = Future()

    def run() -> None:
        try:
            out.set_result(call(prompt))
        except BaseException as e:  # noqa: BLE001 - the caller sees it
            out.set_exception(e)

    threading.Thread(target=run, daemon=True).start()
    return out


def answered(prompts: Iterable[tuple[str, str]], call: Service, window: int, timeout: float) -> Iterator[tuple[str, str | None, str | None]]:
    """(key, answer, error) of (key, prompt), in order, with at most `window` calls open. A lost connection, or no answer in time, is 'unreachable'; another error is its name."""
    open_: deque[tuple[str, Future, float]] = deque()

    def oldest() -> tuple[str, str | None, str | None]:
        key, future, until = open_.popleft()
        try:
            return key, future.result(max(0.0, until - time.monotonic())), None
        except (ConnectionError, Late, TimeoutError):
            return key, None, "unreachable"
        except Exception as e:  # noqa: BLE001 - the error's name is the status
            return key, None, type(e).__name__

    for key, prompt in prompts:
        if len(open_) >= window:
            yield oldest()
        open_.append((key, _started(call, prompt), time.monotonic() + timeout))
    while open_:
        yield oldest()


def _prompts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, str]]:
    for b in batches:
        yield from zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)


def _chunks(rows: Iterator[tuple], names: list[str], size: int = 100) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in held], pa.schema([(n, pa.string()) for n in names]))
            held = []
    yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in held], pa.schema([(n, pa.string()) for n in names]))


def _prompt(template: str) -> Column:
    return F.replace(F.lit(template), F.lit("{preamble_text}"), F.left(F.coalesce("preamble_text", F.lit("")), F.lit(PROMPT_CHARS)))


def ask(preambles: DataFrame, service: Service, attempts: int = ATTEMPTS, prompt: str = "{preamble_text}", timeout: float = TIMEOUT, window: int = WINDOW) -> DataFrame:
    """(file_id, answer, error), asked for each file and each time that the result is evaluated. Only answers that are no JSON are asked for again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _chunks(answered(_prompts(batches), _insisting(service, attempts), window, timeout * attempts), ["file_id", "answer", "error"])

    ship(preambles.sparkSession)
    return preambles.select("file_id", _prompt(prompt).alias("prompt")).mapInArrow(run, "file_id string, answer string, error string")


class Written:
    """Answers by key, each written once as soon as it is there: a task that is run again finds what the one before was told."""

    def __init__(self, root: str) -> None:
        self.fs, self.path = fs.FileSystem.from_uri(root.replace("file:/", "file:///", 1) if root.startswith("file:/") and not root.startswith("file://") else root)
        self.fs.create_dir(self.path, recursive=True)

    def __call__(self, key: str, call: Callable[[], str]) -> str:
        target = f"{self.path}/{key}"
        if self.fs.get_file_info(target).type == fs.FileType.File:
            with self.fs.open_input_stream(target) as f:
                return f.read().decode()
        answer = call()
        half = f"{target}.{threading.get_ident()}.{time.monotonic_ns()}"
        with self.fs.open_output_stream(half) as f:
            f.write(answer.encode())
        self.fs.move(half, target)
        return answer


def ask_once(preambles: DataFrame, service: Service, root: str, attempts: int = ATTEMPTS, prompt: str = "{preamble_text}", timeout: float = TIMEOUT, window: int = WINDOW) -> DataFrame:
    """(file_id, answer, error) with answers kept at root, a folder that the executors share: a prompt that was answered once is not asked again.

    Answers go by the SHA-256 of their prompt, so equal preambles, files that come again and later runs share one call. Within a run each answer is a file of its own before the next call
    begins, and a lost executor's task goes on where it ended; what is open at that moment, at most `window` calls, may be asked again. When all are there they become one
    table, and the files go. Errors are not kept.
    """
    spark = preambles.sparkSession
    ship(spark)
    asked = preambles.select("file_id", _prompt(prompt).alias("prompt")).withColumn("prompt_key", F.sha2("prompt", 256))
    known = sinks.existing(spark, f"{root}/answers", ANSWERS)
    todo = asked.groupBy("prompt_key").agg(F.first("prompt").alias("prompt")).join(known.select("prompt_key"), "prompt_key", "left_anti")
    pending = f"{root}/pending"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        written, call = Written(pending), _insisting(service, attempts)
        prompts = ((key, f"{key} {text}") for key, text in _prompts(batches))
        yield from _chunks(answered(prompts, lambda x: written(x[:64], lambda: call(x[65:])), window, timeout * attempts), ["prompt_key", "answer", "error"])

    results = materialize(todo.select("prompt_key", "prompt").mapInArrow(run, RESULTS), "answers")
    sinks.append(results.filter("error is null"), f"{root}/answers", ANSWERS)
    release(spark, pending)
    failed = results.filter("error is not null").select("prompt_key", "error")
    told = sinks.existing(spark, f"{root}/answers", ANSWERS).dropDuplicates(["prompt_key"])
    return asked.select("file_id", "prompt_key").join(told, "prompt_key", "left").join(failed, "prompt_key", "left").select("file_id", "answer", "error")
