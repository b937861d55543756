"""Substring removal: windows of words that also start in an earlier document, by super-k-mers.

The windows of a document that follow each other and share their minimiser (the smallest hash of
``MINIMISER`` words inside the window) form a super-k-mer. Equal windows have equal minimisers, so only
minimisers found in more than one document matter; their super-k-mers travel as one packed string to
the bucket of the minimiser, where sorting brings equal windows together.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitepulse.llm.common import ROWS_PER_BATCH, WORD, map_batches, stored
from sitepulse.llm.pieces import Memo

#: Words of a window and of a minimiser.
WINDOW = 50
MINIMISER = 8
#: Super-k-mers of one minimiser that meet in a task; those of hotter ones are dealt out over salts.
ROWS_PER_SALT = 1_000
#: Windows of a hot minimiser that a task holds at once.
WINDOWS_PER_PART = 100_000
_MIX = np.uint64(0x9E3779B97F4A7C15)
_MIX2 = np.uint64(0xD6E8FEB86659FD93)

_memo: Memo | None = None


def word_hashes(words: list[str]) -> np.ndarray:
    global _memo
    if _memo is None:
        _memo = Memo(lambda w: xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass")) - (1 << 63))
    memo = _memo
    return np.array([memo[w] for w in words], dtype=np.int64).view(np.uint64)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _MIX2
    return h ^ (h >> np.uint64(29))


def super_kmers(hashes: np.ndarray, window: int = WINDOW, size: int = MINIMISER) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(minimiser, first window, windows) of every super-k-mer of a document, in order."""
    n = len(hashes) - window + 1
    if n <= 0:
        none = np.zeros(0, np.int64)
        return none, none, none
    m = np.zeros(len(hashes) - size + 1, np.uint64)
    for j in range(size):
        m = _mixed(m * _MIX + hashes[j : len(m) + j])
    view = np.lib.stride_tricks.sliding_window_view(m, window - size + 1)
    place = view.argmin(axis=1) + np.arange(n)  # the leftmost of the smallest
    first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    counts = np.diff(np.concatenate([first, [n]]))
    return m[place[first]].view(np.int64), first, counts


def _first_pass(rows: dict) -> dict:
    out: dict[str, list] = {k: [] for k in ("doc_id", "text_hash", "n_words", "kept_sha256", "minimisers", "firsts", "counts")}
    for doc_id, text_hash, text in zip(rows["doc_id"], rows["text_hash"], rows["text"]):
        words = WORD.findall(text or "")
        minimisers, firsts, counts = super_kmers(word_hashes(words))
        for name, value in zip(
            out,
            (
                doc_id,
                text_hash,
                len(words),
                hashlib.sha256(" ".join(words).encode("utf-8", "surrogatepass")).hexdigest(),
                minimisers.tolist(),
                firsts.tolist(),
                counts.tolist(),
            ),
        ):
            out[name].append(value)
    return out


def _cut(rows: dict) -> dict:
    """The packed strings of a document's wanted super-k-mers."""
    strings = []
    for text, firsts, counts in zip(rows["text"], rows["firsts"], rows["counts"]):
        words = WORD.findall(text or "")
        strings.append([" ".join(words[f : f + n + WINDOW - 1]) for f, n in zip(firsts, counts)])
    return {k: v for k, v in rows.items() if k != "text"} | {"strings": strings}


BUCKET = "hot boolean, minimiser bigint, window binary, salts int, low bigint, high bigint, doc_id bigint, text_hash bigint, starts array<int>"


def _window_keys(string: str, count: int) -> list[str]:
    words = string.split(" ")
    return [" ".join(words[i : i + WINDOW]) for i in range(count)]


def _window_digest(key: str) -> bytes:
    return hashlib.sha256(key.encode("utf-8", "surrogatepass")).digest()[:16]


def _sort_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sort the windows of each minimiser; rows come sorted by minimiser and salt.

    Where a minimiser has one salt, the windows that also start in a smaller document come out per
    document; else the least and largest document of each window, to be brought together with other salts.
    """
    names = ["hot", "minimiser", "window", "salts", "low", "high", "doc_id", "text_hash", "starts"]
    schema = pa.schema(
        [
            ("hot", pa.bool_()),
            ("minimiser", pa.int64()),
            ("window", pa.binary()),
            ("salts", pa.int32()),
            ("low", pa.int64()),
            ("high", pa.int64()),
            ("doc_id", pa.int64()),
            ("text_hash", pa.int64()),
            ("starts", pa.list_(pa.int32())),
        ]
    )
    out: dict[str, list] = {n: [] for n in names}

    def finish(minimiser: int, group: list[tuple], salts: int) -> None:
        windows = []
        for doc_id, text_hash, first, count, string in group:
            windows += [(key, doc_id, text_hash, first + i) for i, key in enumerate(_window_keys(string, count))]
        windows.sort()
        marks: dict[tuple[int, int], list[int]] = {}
        at = 0
        while at < len(windows):
            key, low = windows[at][:2]
            end = at + 1
            while end < len(windows) and windows[end][0] == key:
                if windows[end][1] > low and salts == 1:
                    marks.setdefault(windows[end][1:3], []).append(windows[end][3])
                end += 1
            if salts > 1:
                row = (True, minimiser, _window_digest(key), salts, low, windows[end - 1][1], None, None, None)
                for n, v in zip(names, row):
                    out[n].append(v)
            at = end
        for (doc_id, text_hash), starts in marks.items():
            for n, v in zip(names, (False, None, None, None, None, None, doc_id, text_hash, starts)):
                out[n].append(v)

    def flush() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in schema], schema=schema)
        for values in out.values():
            values.clear()
        return batch

    key, salts, group = None, 1, []
    for batch in batches:
        columns = {name: batch.column(i).to_pylist() for i, name in enumerate(batch.schema.names)}
        for row in zip(*(columns[c] for c in ("minimiser", "salt", "salts", "doc_id", "text_hash", "first", "count", "string"))):
            if row[:2] != key:
                if group:
                    finish(key[0], group, salts)
                key, salts, group = row[:2], row[2], []
            group.append(row[3:])
        if len(out["hot"]) >= ROWS_PER_BATCH:
            yield flush()
    if group:
        finish(key[0], group, salts)
    yield flush()


def _match_hot(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by minimiser, salt and part, windows with their least document before super-k-mers."""
    schema = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("starts", pa.list_(pa.int32()))])
    current, least = None, {}
    for batch in batches:
        found: list[list] = [[], [], []]
        columns = {name: batch.column(i).to_pylist() for i, name in enumerate(batch.schema.names)}
        rows = zip(*(columns[c] for c in ("minimiser", "salt", "part", "window", "low", "doc_id", "text_hash", "first", "string")))
        for *key, window, low, doc_id, text_hash, first, string in rows:
            if key != current:
                current, least = key, {}
            if window is not None:
                least[window] = low
            elif least:
                count = string.count(" ") + 2 - WINDOW
                keys = map(_window_digest, _window_keys(string, count))
                starts = [first + i for i, k in enumerate(keys) if least.get(k, doc_id) < doc_id]
                if starts:
                    for values, value in zip(found, (doc_id, text_hash, starts)):
                        values.append(value)
        yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(found, schema)], schema=schema)


def covered_words(n_words: int, starts: list[int], window: int = WINDOW) -> np.ndarray:
    """Which words lie in a window that starts at one of ``starts``."""
    change = np.zeros(n_words + 1, np.int64)
    s = np.unique(np.asarray(starts, np.int64))
    change[s] += 1
    np.subtract.at(change, np.minimum(s + window, n_words), 1)
    return np.cumsum(change[:-1]) > 0


def remove_repeats(docs: DataFrame, keep_text: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, kept_sha256.

    A word goes if it lies in a window of 50 words that also starts in a document with a smaller id;
    windows are judged on the input. ``keep_text`` adds the words that stay, joined by one space. Texts
    with fewer words than a window, null and empty ones lose nothing. Rows with one id count as one
    document for "smaller", each with its own text; rows with a null id lose nothing and remove nothing.

    Of documents with equal word sequences only those of the smallest id enter the search; the others
    lose all words if they have a window. Texts are shuffled once, to cut the wanted super-k-mers.
    """
    rows = docs.selectExpr(
        "cast(doc_id as bigint) doc_id", "xxhash64(cast(text as string)) text_hash", "cast(text as string) text"
    )
    scanned = stored(
        map_batches(
            rows,
            _first_pass,
            "doc_id bigint, text_hash bigint, n_words bigint, kept_sha256 string, minimisers array<bigint>, "
            "firsts array<int>, counts array<int>",
        ),
        "repeats-scan",
    )
    whole = stored(
        scanned.where(F.col("n_words") >= WINDOW)
        .groupBy("kept_sha256")
        .agg(F.min(F.struct("doc_id", "text_hash")).alias("low"), F.min("doc_id").alias("low_id"))
        .select("kept_sha256", "low_id"),
        "repeats-whole",
    )
    summary = stored(
        scanned.join(whole, "kept_sha256", "left").select(
            "doc_id",
            "text_hash",
            "n_words",
            "kept_sha256",
            F.coalesce(F.col("doc_id") > F.col("low_id"), F.lit(False)).alias("copy"),
            F.when((F.col("doc_id") == F.col("low_id")), F.col("minimisers")).alias("minimisers"),
            "firsts",
            "counts",
        ),
        "repeats-summary",
    )
    found = (
        summary.where("minimisers IS NOT NULL")
        .dropDuplicates(["doc_id", "text_hash"])
        .select("doc_id", "text_hash", F.explode(F.arrays_zip("minimisers", "firsts", "counts")).alias("k"))
        .select(
            "doc_id",
            "text_hash",
            F.col("k.minimisers").alias("minimiser"),
            F.col("k.firsts").alias("first"),
            F.col("k.counts").alias("count"),
        )
    )
    found = stored(found, "repeats-found")
    shared = stored(
        found.groupBy("minimiser")
        .agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count(F.lit(1)).alias("n"))
        .where("low < high")
        .select("minimiser", F.ceil(F.col("n") / ROWS_PER_SALT).cast("int").alias("salts")),
        "repeats-shared",
    )
    wanted = (
        found.join(shared, "minimiser")
        .groupBy("doc_id", "text_hash")
        .agg(F.collect_list(F.struct("first", "count", "minimiser", "salts")).alias("w"))
        .select(
            "doc_id",
            "text_hash",
            F.col("w.first").alias("firsts"),
            F.col("w.count").alias("counts"),
            F.col("w.minimiser").alias("minimisers"),
            F.col("w.salts").alias("salts"),
        )
    )
    # One of the rows that repeat an id and a text is enough.
    texts = stored(rows.join(wanted, ["doc_id", "text_hash"]).dropDuplicates(["doc_id", "text_hash"]), "repeats-texts")
    cut = (
        map_batches(
            texts,
            _cut,
            "doc_id bigint, text_hash bigint, firsts array<int>, counts array<int>, minimisers array<bigint>, "
            "salts array<int>, strings array<string>",
        )
        .select(
            "doc_id", "text_hash", F.explode(F.arrays_zip("minimisers", "salts", "firsts", "counts", "strings")).alias("k")
        )
        .select(
            "doc_id",
            "text_hash",
            F.col("k.minimisers").alias("minimiser"),
            F.col("k.salts").alias("salts"),
            F.pmod(F.xxhash64("doc_id", "k.firsts"), F.col("k.salts")).cast("int").alias("salt"),
            F.col("k.firsts").alias("first"),
            F.col("k.counts").alias("count"),
            F.col("k.strings").alias("string"),
        )
    )
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_out = stored(
        cut.repartition(partitions, "minimiser", "salt")
        .sortWithinPartitions("minimiser", "salt")
        .mapInArrow(_sort_buckets, BUCKET),
        "repeats-buckets",
    )
    # Windows of hot minimisers: the least document over all salts goes to each of them. Should one
    # minimiser have very many windows, they go in parts, and its super-k-mers to each part.
    least = stored(
        sorted_out.where("hot")
        .groupBy("minimiser", "window")
        .agg(F.min("low").alias("low"), F.max("high").alias("high"), F.max("salts").alias("salts"))
        .where("low < high"),
        "repeats-least",
    )
    parts = stored(
        least.groupBy("minimiser").agg(F.ceil(F.count(F.lit(1)) / WINDOWS_PER_PART).cast("int").alias("parts")), "repeats-parts"
    )
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    strings = (
        cut.where("salts > 1")
        .join(parts, "minimiser")
        .select("minimiser", "salt", every(F.col("parts")).alias("part"), "doc_id", "text_hash", "first", "string")
    )
    windows = (
        least.join(parts, "minimiser")
        .withColumn("part", F.pmod(F.xxhash64("window"), F.col("parts")).cast("int"))
        .select("minimiser", every(F.col("salts")).alias("salt"), "part", "window", "low")
    )
    hot_marks = (
        windows.unionByName(strings, allowMissingColumns=True)
        .repartition(partitions, "minimiser", "salt", "part")
        .sortWithinPartitions("minimiser", "salt", "part", F.col("window").asc_nulls_last())
        .mapInArrow(_match_hot, "doc_id bigint, text_hash bigint, starts array<int>")
    )
    marks = (
        sorted_out.where("NOT hot")
        .select("doc_id", "text_hash", "starts")
        .union(stored(hot_marks, "repeats-hot"))
        .groupBy("doc_id", "text_hash")
        .agg(F.flatten(F.collect_list("starts")).alias("starts"))
    )

    def clean(batch: dict) -> dict:
        out: dict[str, list] = {"doc_id": batch["doc_id"], "text_hash": batch["text_hash"], "removed": [], "sha": []}
        if keep_text:
            out["kept_text"] = []
        for text, starts in zip(batch["text"], batch["starts"]):
            words = WORD.findall(text)
            gone = covered_words(len(words), starts)
            kept = " ".join([w for w, g in zip(words, gone.tolist()) if not g])
            out["removed"].append(int(gone.sum()))
            out["sha"].append(hashlib.sha256(kept.encode("utf-8", "surrogatepass")).hexdigest())
            if keep_text:
                out["kept_text"].append(kept)
        return out

    cleaned = map_batches(
        texts.select("doc_id", "text_hash", "text").join(marks, ["doc_id", "text_hash"]),
        clean,
        "doc_id bigint, text_hash bigint, removed bigint, sha string" + (", kept_text string" if keep_text else ""),
    )
    nothing = hashlib.sha256(b"").hexdigest()
    result = summary.drop("minimisers", "firsts", "counts").join(
        stored(cleaned, "repeats-cleaned"), ["doc_id", "text_hash"], "left"
    )
    columns = [
        "doc_id",
        "n_words",
        F.when(F.col("copy"), F.col("n_words")).otherwise(F.coalesce("removed", F.lit(0))).alias("n_removed"),
        F.when(F.col("copy"), nothing).otherwise(F.coalesce("sha", "kept_sha256")).alias("kept_sha256"),
    ]
    if keep_text:
        columns.append(F.when(F.col("copy"), "").otherwise(F.col("kept_text")).alias("kept_text"))
    return result.select(*columns)
