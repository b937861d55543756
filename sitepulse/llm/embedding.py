"""Near-duplicate vectors by randomly rotated binary codes with bounds, over all pairs of a label.

A vector is normalized, padded, rotated by a random orthogonal matrix and kept as the signs of its
coordinates, with the inner product between the vector and its code as correction factor. The product of
another rotated vector with the code, divided by the factor, estimates their cosine without bias, and the
factor gives the estimate's confidence bound. The angles between both vectors and the code also give a
bound that holds without chance; only pairs for which it reaches the limit are computed again in double
precision. So every link is found, and none is below the limit.

Code and factor are stored with each vector. Vectors of one label meet in blocks, each block with every
other one, so the work is quadratic in the size of a label.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitepulse.llm.common import components, stored

#: Bits of a code; vectors are padded to it, longer ones get as many bits as they have dimensions.
CODE_BITS = 128
#: Width of the confidence bound in standard errors of the estimate.
DEVIATIONS = 4.0
#: Vectors of one label that meet in a task; larger labels go in pairs of blocks.
BLOCK = 4_096
#: Rows of a block that are held against another block at a time.
STRIP = 512
#: Slack of the bound for rounding.
SLACK = 1e-9
SEED = 20_240_229


def rotation(size: int, seed: int = SEED) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).normal(size=(size, size)))
    return q * np.sign(np.diag(r))


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    x = np.asarray(vectors, np.float64)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def codes_of(unit: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rotated vectors, their signs as +-1/sqrt(bits), and the correction factors."""
    size = len(turn)
    padded = np.zeros((len(unit), size))
    padded[:, : unit.shape[1]] = unit
    turned = padded @ turn
    code = np.where(turned >= 0, 1.0, -1.0) / math.sqrt(size)
    return turned, code, (turned * code).sum(axis=1)


def estimate(turned: np.ndarray, code: np.ndarray, factor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unbiased estimates of the cosine of every row of ``turned`` with every code, and their bounds."""
    found = (turned @ code.T) / factor
    bound = DEVIATIONS * np.sqrt((1 - factor**2) / factor**2) / math.sqrt(max(1, code.shape[1] - 1))
    return found, bound


def highest(turned: np.ndarray, code: np.ndarray, factor: np.ndarray) -> np.ndarray:
    """The most that the cosine of every row of ``turned`` with every coded vector can be, by their angles to the code."""
    found = np.clip(turned @ code.T, -1, 1)
    kept = np.clip(factor, -1, 1)
    return found * kept + np.sqrt((1 - found**2) * (1 - kept**2)) + SLACK


def link_block(
    left: np.ndarray, right: np.ndarray, limit: float, turn: np.ndarray, code: np.ndarray, factor: np.ndarray
) -> np.ndarray:
    """Pairs (row of left, row of right) of unit rows with a cosine of at least ``limit``.

    ``code`` and ``factor`` are those of ``right``; they leave few pairs open, which are computed exactly.
    """
    links = []
    for start in range(0, len(left), STRIP):
        turned, _, _ = codes_of(left[start : start + STRIP], turn)
        a, b = np.nonzero(highest(turned, code, factor) >= limit)
        a += start
        for at in range(0, len(a), 100_000):
            i, j = a[at : at + 100_000], b[at : at + 100_000]
            linked = (left[i] * right[j]).sum(axis=1) >= limit
            links.append(np.stack([i[linked], j[linked]], axis=1))
    return np.concatenate(links) if links else np.zeros((0, 2), np.int64)


def _lowest_reachable(n: int, pairs: np.ndarray) -> np.ndarray:
    """Smallest node reachable by the pairs, for nodes 0..n-1."""
    low = np.arange(n)
    while True:
        before = low.copy()
        np.minimum.at(low, pairs[:, 0], low[pairs[:, 1]])
        np.minimum.at(low, pairs[:, 1], low[pairs[:, 0]])
        low = low[low]
        if (low == before).all():
            return low


def link_vectors(
    table: DataFrame,
    limit: float = 0.93,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """One row per row of ``table``: vec_id, n_links, component_id, kept.

    Vectors are compared when their labels are equal and not null. Vectors that are null, empty, zero or
    hold null or non-finite components, and those without a label, link with nothing; vectors of
    different length don't link. Equal vectors of a label are one class, compared once and counted with
    their number. Rows with a null id take part as others do but give no component; a repeated id counts
    as often as it is there.

    Classes of a label and length meet in blocks: where they are more than ``BLOCK`` they are cut into
    blocks by a hash, and every pair of blocks is a task of its own. Such a task returns a row per vector,
    with its links counted and one link to the lowest class reachable in the block; pairs never become rows.
    """
    value = F.col("v").cast("array<double>")
    sound = F.coalesce(
        F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
        & F.exists(value, lambda x: x != 0)
        & F.col("label").isNotNull(),
        F.lit(False),
    )
    rows = stored(
        table.select(
            F.col(vec_id).cast("bigint").alias("vec_id"), F.col(label).cast("string").alias("label"), F.col(embedding).alias("v")
        ).select("vec_id", "label", F.when(sound, value).alias("v")),
        "vectors",
    )
    classes = stored(
        rows.where("v IS NOT NULL")
        .groupBy("label", "v")
        .agg(F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("copies"))
        .withColumn("class", F.xxhash64("label", "v")),
        "vector-classes",
    )

    def encoded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        turns: dict[int, np.ndarray] = {}
        for batch in batches:
            out: list[list] = [[None] * len(batch) for _ in range(3)]
            sizes = batch["v"].map(len)
            for size in sizes.unique():
                at = np.flatnonzero(sizes == size)
                unit = unit_rows(np.stack(batch["v"].to_numpy()[at]))
                if size not in turns:
                    turns[size] = rotation(max(CODE_BITS, size))
                _, code, factor = codes_of(unit, turns[size])
                for i, u, c, f in zip(at, unit, np.packbits(code > 0, axis=1), factor):
                    out[0][i], out[1][i], out[2][i] = u.tobytes(), c.tobytes(), float(f)
            yield batch.drop(columns="v").assign(size=sizes, unit=out[0], code=out[1], factor=out[2])

    kinds = "label string, node bigint, copies bigint, class bigint, size int, unit binary, code binary, factor double"
    coded = stored(classes.mapInPandas(encoded, kinds), "vector-codes")
    spot = ["label", "size"]
    blocks = stored(
        coded.groupBy(*spot).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(*spot, F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")),
        "vector-blocks",
    )
    dealt = (
        coded.join(blocks, spot)
        .withColumn("block", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int"))
        # A block meets itself and every other one once: one copy of it for each.
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("low", F.least("block", "other"))
        .withColumn("high", F.greatest("block", "other"))
        .drop("blocks", "other")
    )
    turns: dict[int, np.ndarray] = {}

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        size = int(group["size"].iloc[0])
        bits = max(CODE_BITS, size)
        if bits not in turns:
            turns[bits] = rotation(bits)
        unit = np.frombuffer(b"".join(group["unit"]), np.float64).reshape(-1, size)
        low, high = int(group["low"].iloc[0]), int(group["high"].iloc[0])
        own = group["block"].to_numpy() == low
        left = np.flatnonzero(own)
        right = left if low == high else np.flatnonzero(~own)
        packed = np.frombuffer(b"".join(group["code"].iloc[right]), np.uint8).reshape(-1, (bits + 7) // 8)
        code = (np.unpackbits(packed, axis=1, count=bits) * 2.0 - 1) / math.sqrt(bits)
        factor = group["factor"].to_numpy()[right]
        pairs = link_block(unit[left], unit[right], limit, turns[bits], code, factor)
        a, b = left[pairs[:, 0]], right[pairs[:, 1]]
        if low == high:
            # A pair met from both sides; sums of products don't hang on the order of factors.
            a, b = a[a < b], b[a < b]
        copies = group["copies"].to_numpy()
        counts = np.bincount(a, copies[b], len(group)) + np.bincount(b, copies[a], len(group))
        reach = _lowest_reachable(len(group), np.stack([a, b], axis=1))
        found = pd.DataFrame(
            {
                "class": group["class"].to_numpy(),
                "label": group["label"].to_numpy(),
                "links": counts.astype(np.int64),
                "node": group["node"].to_numpy(),
                "to": group["node"].to_numpy()[reach],
            }
        )
        return found[counts > 0]

    met = stored(
        dealt.groupBy(*spot, "low", "high").applyInPandas(
            compare, "class bigint, label string, links bigint, node bigint, to bigint"
        ),
        "vector-links",
    )
    linked = components(met.select(F.col("node").alias("a"), F.col("to").alias("b")).distinct(), "vector-components")
    counted = met.groupBy("class", "label").agg(F.sum("links").alias("links"))
    judged = stored(
        classes.join(counted, ["class", "label"], "left")
        .join(linked, "node", "left")
        .select(
            "label",
            "v",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"),
            F.coalesce("component", "node").alias("component"),
        ),
        "vector-judged",
    )
    return rows.join(judged, ["label", "v"], "left").select(
        "vec_id",
        F.coalesce("links", F.lit(0)).cast("bigint").alias("n_links"),
        F.coalesce("component", "vec_id").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.coalesce("component", "vec_id"), F.lit(False)).alias("kept"),
    )
