"""Chunks of texts with a dictionary of their own.

A chunk is a run of rows of one task with a bounded number of characters (a longer text is a chunk of its own). Its
texts are sequences of places in the chunk's list of distinct strings, so what is shuffled per string
is a row for each chunk that has it, not one for each time it occurs, however frequent it is.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from sitepulse.llm.common import ROWS_PER_BATCH

#: Characters of the texts of a chunk, but for the last text.
CHUNK_CHARS = 1 << 24


class Places(dict):
    """Distinct strings numbered in the order of their first look-up."""

    def __missing__(self, key: str) -> int:
        place = self[key] = len(self)
        return place


def pack(numbers: np.ndarray) -> bytes:
    """Whole numbers below 2^32, byte by byte of equal weight, compressed."""
    planes = np.ascontiguousarray(numbers, dtype="<u4").view(np.uint8).reshape(-1, 4).T
    return pa.compress(np.ascontiguousarray(planes).tobytes(), codec="zstd", asbytes=True)


def unpack(data: bytes, count: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data, 4 * count, codec="zstd", asbytes=True), np.uint8).reshape(4, count)
    return np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)


def pack_strings(strings: list[str]) -> dict:
    """Strings as their sizes in bytes and their bytes, both compressed."""
    raw = [s.encode("utf-8", "surrogatepass") for s in strings]
    body = b"".join(raw)
    sizes = np.fromiter(map(len, raw), np.uint32, len(raw))
    packed = pa.compress(body, codec="zstd", asbytes=True)
    return {"count": len(raw), "length": len(body), "sizes": pack(sizes), "body": packed}


def unpack_strings(packed: dict) -> list[bytes]:
    """The bytes of strings packed by ``pack_strings``."""
    body = pa.decompress(packed["body"], packed["length"], codec="zstd", asbytes=True)
    ends = np.cumsum(unpack(packed["sizes"], packed["count"])).tolist()
    return [body[a:b] for a, b in zip([0, *ends], ends)]


def slices(numbers: np.ndarray, sizes: Iterable[int]) -> Iterator[np.ndarray]:
    at = 0
    for size in sizes:
        yield numbers[at : at + size]
        at += size


def by_frequency(places: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Places renumbered so that the most frequent are smallest, and the old places in their new order."""
    order = np.argsort(-np.bincount(places, minlength=count), kind="stable")
    rank = np.empty(count, np.int64)
    rank[order] = np.arange(count)
    return rank[places], order


class ChunkWork(Protocol):
    """What a task does with its chunks."""

    def cut(self, text: str) -> list[str]:
        """The strings of a text."""

    def row(self, ids: list, texts: list[np.ndarray], strings: list[str]) -> dict:
        """The columns of a chunk from its ids, the places of its texts and its distinct strings."""

    def last(self) -> dict | None:
        """The columns of a last row for the whole task, if there is one."""


def map_chunks(
    docs: DataFrame,
    prepare: Callable[[], ChunkWork],
    schema: str,
    doc_id: str = "doc_id",
    text: str = "text",
    chunk_chars: int = CHUNK_CHARS,
) -> DataFrame:
    """A row per chunk of ``docs``: its number ``chunk`` and the columns that the work makes of it.

    ``prepare`` runs in the task. A null text is an empty one. Numbers are those of the task and of the
    chunk in it: write the table before using it twice, as ``common.stored_by`` does.
    """
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ROWS_PER_BATCH)
    kinds = docs.sparkSession.createDataFrame([], f"chunk bigint, {schema}").schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(kinds)
        work = prepare()
        number = TaskContext.get().partitionId() << 32

        def row(values: dict) -> pa.RecordBatch:
            nonlocal number
            values = {"chunk": number, **values}
            number += 1
            return pa.RecordBatch.from_arrays([pa.array([values.get(f.name)], f.type) for f in arrow], schema=arrow)

        ids, texts, places, chars = [], [], Places(), 0
        for batch in batches:
            for key, value in zip(batch.column(0), batch.column(1)):
                body = value.as_py() or ""
                strings = work.cut(body)
                ids.append(key.as_py())
                texts.append(np.fromiter(map(places.__getitem__, strings), np.uint32, len(strings)))
                chars += len(body)
                if chars >= chunk_chars:
                    yield row(work.row(ids, texts, list(places)))
                    ids, texts, places, chars = [], [], Places(), 0
        if ids:
            yield row(work.row(ids, texts, list(places)))
        if (last := work.last()) is not None:
            yield row(last)

    return docs.selectExpr(f"cast(`{doc_id}` as bigint) doc_id", f"cast(`{text}` as string) text").mapInArrow(
        run, kinds
    )
