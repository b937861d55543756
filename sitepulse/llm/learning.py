"""Fitting a small network on all rows: blocks of rows fit it side by side, their weights are averaged, scores are counted."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Weights are added up in whole numbers of this size, so their sum doesn't hang on the order of blocks.
UNIT = 1.0 / (1 << 20)
#: Weights of a piece in which they are added up.
PIECE = 1 << 16
#: Steps of the logits whose labels are counted, in a unit, and the largest logit told apart.
STEPS, MOST = 256, 30
#: Bytes of examples that a block may hold.
BLOCK_BYTES = 48 << 20

PIECES = "piece int, weights binary, seen binary"


def blocks(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[list[list]]:
    """Rows (shard, ...) as lists of columns: a block ends with its shard, at 2 * ``rows`` rows and at BLOCK_BYTES.

    The last column holds the bytes of the examples.
    """
    held: list[tuple] = []
    size = 0
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if held and (row[0] != held[-1][0] or len(held) >= 2 * rows or size >= BLOCK_BYTES):
                yield [list(c) for c in zip(*held)]
                held, size = [], 0
            held.append(row)
            size += len(row[-1])
    if held:
        yield [list(c) for c in zip(*held)]


def _packed(weights: np.ndarray, seen: np.ndarray) -> Iterator[pa.RecordBatch]:
    for piece, at in enumerate(range(0, len(weights), PIECE)):
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([piece], pa.int32()),
                *[pa.array([a[at : at + PIECE].astype("<i8").tobytes()], pa.binary()) for a in (weights, seen)],
            ],
            names=["piece", "weights", "seen"],
        )


def _sum(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for piece, *parts in zip(*(batch.column(i).to_pylist() for i in range(3))):
            values = np.stack([np.frombuffer(p, "<i8") for p in parts])
            total[piece] = total[piece] + values if piece in total else values
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(total), pa.int32()), *[pa.array([v[i].tobytes() for v in total.values()], pa.binary()) for i in (0, 1)]],
        names=["piece", "weights", "seen"],
    )


def averaged(rows: DataFrame, start: np.ndarray, block: int, fit: Callable[[list[list]], tuple[np.ndarray, np.ndarray, int]]) -> np.ndarray:
    """The weights that the blocks of ``rows`` reach from ``start`` on average, by their rows; all rows are used.

    ``rows`` are dealt and sorted by their first column, the shard. ``fit`` gives a block's weights, which of
    them its rows touch, and its number of rows; a weight that no block touches stays as it is.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for columns in blocks(batches, block):
            weights, seen, n = fit(columns)
            moved = np.round((weights - start) * seen / UNIT).astype(np.int64) * n
            found = np.stack([moved, seen.astype(np.int64) * n])
            total = found if total is None else total + found
        if total is not None:
            yield from _packed(*total)

    pieces = -(-len(start) // PIECE)
    once = rows.mapInArrow(run, PIECES).withColumn("salt", F.spark_partition_id() % 16)
    summed = once.repartition(16 * pieces, "piece", "salt").mapInArrow(lambda b: _sum(b), PIECES)
    out = start.copy()
    for row in summed.repartition(pieces, "piece").mapInArrow(lambda b: _sum(b), PIECES).collect():
        weights, seen = (np.frombuffer(row[c], "<i8") for c in ("weights", "seen"))
        at = slice(row["piece"] * PIECE, row["piece"] * PIECE + len(weights))
        out[at] += weights / np.maximum(seen, 1) * UNIT
    return out


def steps(logits: np.ndarray) -> np.ndarray:
    """The steps in which logits are counted."""
    return np.round(np.clip(logits, -MOST, MOST) * STEPS).astype(np.int32)


def scale(logits: np.ndarray, labels: np.ndarray, n: np.ndarray) -> tuple[float, float]:
    """(a, b) of sigmoid(a * logit + b) by Newton steps of a logistic fit to ``n`` rows of each kind, with a weak prior at (1, 0).

    A step that raises the loss is halved, as labels that the logits tell apart well send whole steps far off.
    """

    def loss(at: np.ndarray) -> float:
        z = at[0] * logits + at[1]
        return float((n * (np.logaddexp(0, z) - labels * z)).sum() + (at[0] - 1) ** 2 / 2 + 0.05 * at[1] ** 2)

    at = np.array([1.0, 0.0])
    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(at[0] * logits + at[1], -30, 30)))
        g = np.array([(n * (p - labels) * logits).sum() + (at[0] - 1), (n * (p - labels)).sum() + 0.1 * at[1]])
        v = n * p * (1 - p)
        h = np.array([[(v * logits * logits).sum() + 1, (v * logits).sum()], [(v * logits).sum(), v.sum() + 0.1]])
        change = np.linalg.solve(h, g)
        while np.abs(change).max() >= 1e-8 and loss(at - change) > loss(at):
            change = change / 2
        at = at - change
        if np.abs(change).max() < 1e-8:
            break
    return float(at[0]), float(at[1])
