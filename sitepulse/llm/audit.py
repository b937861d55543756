"""How filters overlap and what each removes in any order, kept up to date as files of documents arrive.

Every file is a piece of a stream. A document's failures are one code; only whether its text stands in a document
with a smaller id depends on others. The state keeps, for each distinct text, the smallest id so far and the codes of
the rows with it. When a smaller id arrives, the codes counted before are taken back from the counters of
their parts and counted again as failures. The report for all orders is computed from the counters.
"""

from __future__ import annotations

import itertools
import json
from collections import Counter
from collections.abc import Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sitepulse.session import scratch_folder

# The filters by letter, what they look at and their limits.
LETTERS = "ABCDE"
WORDS = r"[^\x20\x09-\x0D]+"
MARKS = r"[#$%&*|]"
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS = 200, 50, 2

#: Bits of a code: one per filter that fails, then the two labels.
_BIT = {letter: 1 << i for i, letter in enumerate(LETTERS)}
_FILTERS, _GOOD, _TOXIC = (1 << len(LETTERS)) - 1, 32, 64
_REPEATED = _BIT["E"]

#: Texts that share one entry of the state, on average; entries rather than texts are what a batch reads and writes.
TEXTS_PER_KEY = 128
#: Micro-batches over the files that are there; a file is never split between two.
BATCHES = 4
#: Distinct texts that a task combines before it passes them on.
COMBINED = 100_000


def own_failures(text: Column) -> Column:
    """Bits of the filters A to D, which look at one text."""
    words = F.regexp_extract_all(text, F.lit(WORDS), F.lit(0))
    count, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    fails = {
        "A": count < LEAST_WORDS,
        "B": 100 * distinct < LEAST_DISTINCT * count,
        "C": 100 * capitals > MOST_CAPITALS * F.length(text),
        "D": text.rlike(MARKS),
    }
    return sum((F.when(fail, _BIT[letter]).otherwise(0) for letter, fail in fails.items()), F.lit(0))


def label_bits(labels: DataFrame) -> DataFrame:
    """(label_id, label_bits) with one row per labelled document; of repeated labels any 1 counts."""
    good, toxic = (F.max(F.coalesce(F.col(c) == 1, F.lit(False))) for c in ("quality", "toxic"))
    bits = F.when(good, _GOOD).otherwise(0) + F.when(toxic, _TOXIC).otherwise(0)
    found = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("bigint").alias("label_id"))
    return found.agg(bits.alias("label_bits"))


def coded_rows(docs: DataFrame, labels: DataFrame, buckets: int) -> DataFrame:
    """(bucket, digest, doc_id, part, code) of documents; long texts stay behind and only their digests go on."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    digest = F.sha2(text, 256)
    narrow = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
        digest.alias("digest"),
        own_failures(text).alias("own"),
    )
    joined = narrow.join(label_bits(labels), F.col("doc_id") == F.col("label_id"), "left")
    return joined.select(
        F.pmod(F.xxhash64("digest"), F.lit(buckets)).alias("bucket"),
        "digest",
        "doc_id",
        "part",
        (F.col("own") + F.coalesce("label_bits", F.lit(0))).alias("code"),
    )


class FirstRows:
    """The smallest id of a text and the codes of the rows with it; larger ids are counted as failures of E."""

    def __init__(self, low: int | None = None, rows: Iterable = ()):
        self.low, self.rows = low, Counter({(part, code): n for part, code, n in rows})

    def add(self, key: int, part: str, code: int, n: int, settled: Counter, counted: bool) -> None:
        """Take in n rows; ``settled`` gets what is now known of them, ``counted`` says whether first rows are in it."""
        if self.low is not None and key > self.low:
            settled[part, code | _REPEATED] += n
            return
        if self.low is not None and key < self.low:
            for (old_part, old_code), m in self.rows.items():
                settled[old_part, old_code | _REPEATED] += m
                if counted:
                    settled[old_part, old_code] -= m
            self.rows.clear()
        self.low = key
        self.rows[part, code] += n
        if counted:
            settled[part, code] += n


_COMBINED = "bucket bigint, digest string, doc_id bigint, part string, code int, n bigint"


def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a task added up before the shuffle: of each text only those with the smallest id go on as such.

    The others, and rows without id, are settled: they have no digest any more.
    """

    def made(texts: dict, settled: Counter) -> pa.RecordBatch:
        rows = [
            (bucket, digest, first.low, part, code, n)
            for (bucket, digest), first in texts.items()
            for (part, code), n in first.rows.items()
        ]
        spread = next((bucket for bucket, _ in texts), 0)
        rows += [(spread, None, None, part, code, n) for (part, code), n in settled.items()]
        columns = list(zip(*rows)) or [()] * 6
        types = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int32(), pa.int64())
        names = [c.split()[0] for c in _COMBINED.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(columns, types)], names)

    texts: dict = {}
    settled: Counter = Counter()
    for batch in batches:
        for bucket, digest, key, part, code in zip(*(batch.column(i).to_pylist() for i in range(5))):
            if key is None:
                settled[part, code] += 1
                continue
            first = texts.get((bucket, digest))
            if first is None:
                first = texts[bucket, digest] = FirstRows()
            first.add(key, part, code, 1, settled, counted=False)
        if len(texts) >= COMBINED:
            yield made(texts, settled)
            texts, settled = {}, Counter()
    if texts or settled:
        yield made(texts, settled)


_CHANGES = "part string, code int, n bigint"


def update(key: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
    """Changes of the counters by the rows of one entry of the state, which holds the first rows of its texts."""
    texts = {d: FirstRows(low, rows) for d, (low, rows) in json.loads(state.get[0]).items()} if state.exists else {}
    changes: Counter = Counter()
    for frame in frames:
        columns = (frame[c].tolist() for c in ("digest", "doc_id", "part", "code", "n"))
        for digest, low, part, code, n in zip(*columns):
            if digest is None:
                changes[part, code] += n
            else:
                texts.setdefault(digest, FirstRows()).add(int(low), part, code, n, changes, counted=True)
    kept = {d: [first.low, [[*k, n] for k, n in first.rows.items()]] for d, first in texts.items()}
    state.update((json.dumps(kept),))
    rows = [(part, code, n) for (part, code), n in changes.items() if n]
    yield pd.DataFrame(rows, columns=["part", "code", "n"]).astype({"code": "int32", "n": "int64"})


def count_failures(spark: SparkSession, path: str, labels: DataFrame, batches: int = BATCHES) -> DataFrame:
    """(part, code, n): documents by source and by all that is known of them, from a stream of the files at ``path``.

    Each micro-batch writes its changes to a folder of its own, so one that is repeated after a failure replaces what
    it wrote before. The checkpoint, with the state, is below the shared folder.
    """
    table = spark.read.parquet(path)
    buckets = max(1, table.count() // TEXTS_PER_KEY)  # from the footers of the files
    per_batch = -(-len(table.inputFiles()) // batches)
    # As a pattern the path may be one file or a folder.
    arriving = (
        spark.readStream.schema(table.schema)
        .option("maxFilesPerTrigger", max(1, per_batch))
        .parquet(f"{path[:-1]}[{path[-1]}]")
    )
    coded = coded_rows(arriving, labels, buckets).mapInArrow(combine, _COMBINED)
    changes = coded.groupBy("bucket").applyInPandasWithState(update, _CHANGES, "texts string", "update", "NoTimeout")
    folder = scratch_folder(spark, "audit-counters")

    def write(batch: DataFrame, number: int) -> None:
        summed = batch.groupBy("part", "code").agg(F.sum("n").alias("n"))
        summed.coalesce(1).write.mode("overwrite").parquet(f"{folder}/batch={number}")

    query = (
        changes.writeStream.foreachBatch(write)
        .outputMode("update")
        .option("checkpointLocation", scratch_folder(spark, "audit-checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if query.lastProgress is None or table.isEmpty():
        return spark.createDataFrame([], _CHANGES)
    written = spark.read.schema(_CHANGES).parquet(folder)
    return written.groupBy("part", "code").agg(F.sum("n").alias("n")).where("n != 0")


def order_report(counts: DataFrame) -> DataFrame:
    """What every step of every order of the filters keeps and removes in each part, from (part, code, n).

    A part has at most 128 counters. In how many orders a filter comes first among those that fail is 120
    over their number, which gives its share over all orders without going through them.
    """
    parts = counts.groupBy("part").agg(F.collect_list(F.struct("code", "n")).alias("cells"))
    orders = ",".join("".join(order) for order in itertools.permutations(LETTERS))
    rows = parts.select("part", "cells", F.explode(F.split(F.lit(orders), ",")).alias("filter_order")).select(
        "*", F.explode(F.sequence(F.lit(1), F.lit(len(LETTERS)))).alias("step")
    )
    letter = F.col("filter_order").substr(F.col("step"), F.lit(1))
    earlier = F.col("filter_order").substr(F.lit(1), F.col("step") - 1)
    before = sum((F.when(F.contains(earlier, F.lit(x)), bit).otherwise(0) for x, bit in _BIT.items()), F.lit(0))
    bit = sum((F.when(letter == x, b).otherwise(0) for x, b in _BIT.items()), F.lit(0))
    steps = rows.withColumns({"before": before, "bit": bit})

    def total(where, weight=lambda code: F.lit(1)) -> Column:
        zero = F.lit(0).cast("bigint")
        add = lambda sum_, c: sum_ + F.when(where(c["code"]), c["n"] * weight(c["code"])).otherwise(zero)
        return F.aggregate("cells", zero, add)

    def fails(code: Column) -> Column:
        return code.bitwiseAND(F.col("bit")) != 0

    def gone(code: Column) -> Column:
        return code.bitwiseAND(F.col("before")) != 0

    orders_first = lambda code: F.floor(F.lit(120) / F.bit_count(code.bitwiseAND(_FILTERS))).cast("bigint")
    return steps.select(
        "part",
        "filter_order",
        "step",
        total(lambda c: ~gone(c) & ~fails(c)).alias("kept"),
        total(lambda c: ~gone(c) & fails(c)).alias("removed"),
        total(lambda c: gone(c) & fails(c)).alias("redundant"),
        total(lambda c: c.bitwiseAND(_FILTERS) == F.col("bit")).alias("unique_fails"),
        total(lambda c: ~gone(c) & fails(c) & (c.bitwiseAND(_GOOD) != 0)).alias("good_lost"),
        total(lambda c: ~gone(c) & fails(c) & (c.bitwiseAND(_TOXIC) != 0)).alias("toxic_lost"),
        total(fails, orders_first).alias("shapley"),
    )


def audit_filters(spark: SparkSession, path: str, labels: DataFrame, batches: int = BATCHES) -> DataFrame:
    """A row per part, order of the five filters and step, over all documents at ``path`` (doc_id, text, source).

    A null text is an empty one, and so is a null source. A row without id fails E never and makes no other
    fail it; rows of one id and text don't either among themselves. A label without document is ignored;
    of repeated labels any 1 counts. Files may arrive in any order. An empty table gives no rows.
    """
    return order_report(count_failures(spark, path, labels, batches))
