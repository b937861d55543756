"""Exact Jaccard join of word-shingle sets through a matrix of tokens and groups.

Sets with a high Jaccard similarity (0.9 unless said otherwise) differ in few shingles. A set is hashed into as many
buckets as its size class has, and what falls into one bucket makes one element, so that sets that differ
in d shingles differ in at most d elements. Elements are ordered from rare to frequent by a sketch of
their counts; two linked sets then share one of their first d + 1 elements. That order is only a matter
of speed: any order gives the same links.

Every element's set with the fewest rarer elements is compared with the others of that element; what
links forms groups of similar documents. The matrix of elements and groups then says which groups a
set might still reach; the token union of a group's slices bounds the overlap, and only slices that can
reach it are opened.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitepulse.llm.common import ROWS_PER_BATCH, WORD, components, dropped, map_batches, stored

#: Words of a shingle; two sets link when 100 * intersection >= PERCENT * union. Values where none are given.
WORDS, PERCENT = 3, 90
#: A set of n shingles has over n / 4 buckets; below this percentage linked sets may differ in all of them.
LEAST_PERCENT = 80
#: Slots of the count sketch and of the pieces in which it is summed.
SLOT_BITS, PIECE_BITS = 22, 16
#: Bits of a bucket's number that its element shows.
BUCKET_BITS = 7
#: log2 of the bits of a filter of wanted numbers; a full one lets all pass and nothing goes missing.
FILTER_BITS = 24
#: log2 of the least bits of a sign, which is as long as those of a pair of rows of the matrix.
SIGN_BITS = 9
#: Members of a slice of a group, whose tokens are united in one row.
SLICE = 256
_MIX = np.uint64(0x9E3779B97F4A7C15)
_MIX2 = np.uint64(0xD6E8FEB86659FD93)
#: Bytes of a word for whose places there is a number of every letter; those of later places are mixed with how far they are.
LETTERS = 64
_IN_WORD = np.array([WORD.match(chr(b)) is not None for b in range(256)])
_LETTER = np.random.default_rng(29).integers(0, 1 << 64, (LETTERS, 256), np.uint64)
_LETTER[:, ord("A") : ord("Z") + 1] = _LETTER[:, ord("a") : ord("z") + 1]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _MIX2
    return h ^ (h >> np.uint64(29))


def word_hashes(text: str) -> np.ndarray:
    """A 64-bit hash of every word, the same for A-Z as for a-z: the sum of a random number for each letter and place."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    inside = _IN_WORD[data]
    edges = np.flatnonzero(np.diff(inside.view(np.int8), prepend=np.int8(0), append=np.int8(0)))
    lengths = edges[1::2] - edges[::2]
    if not len(lengths):
        return np.zeros(0, np.uint64)
    starts = np.cumsum(lengths) - lengths
    letters = data[inside]
    place = np.arange(len(letters)) - np.repeat(starts, lengths)
    found = _LETTER.reshape(-1)[((place & (LETTERS - 1)) << 8) | letters]
    if lengths.max() > LETTERS:
        far = place >= LETTERS
        found[far] = _mixed(found[far] + (place[far] // LETTERS).astype(np.uint64) * _MIX)
    return np.add.reduceat(found, starts)


def shingles(text: str | None, size: int = WORDS) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct word shingles; of fewer words the whole sequence as one."""
    h = word_hashes(text or "")
    if not len(h):
        return h
    span = min(size, len(h))
    found = np.full(len(h) - span + 1, span, np.uint64)
    for j in range(span):
        found = _mixed(found * _MIX + h[j : len(found) + j])
    found.sort()
    return found[np.concatenate([[True], found[1:] != found[:-1]])]


def digest(tokens: np.ndarray) -> int:
    """A signed 64-bit name of a set, used beside the id of a document."""
    return xxhash.xxh3_64_intdigest(tokens.tobytes()) - (1 << 63)


def elements(tokens: np.ndarray, size_class: int, least: int) -> tuple[np.ndarray, int]:
    """The elements of a set in a size class, one per bucket that holds something, and their number.

    The lowest ``BUCKET_BITS`` bits of an element are those of its bucket's number.

    Where they are fewer than ``least``, elements of empty buckets follow, which two sets may share as well.
    """
    found, full = _buckets(tokens, size_class)
    low = np.uint64((1 << BUCKET_BITS) - 1)
    found = (found & ~low) | (np.arange(len(found), dtype=np.uint64) & low)
    filled = int(full.sum())
    return np.concatenate([found[full], found[~full][: max(0, least - filled)]]), filled


def sign(tokens: np.ndarray) -> bytes:
    """Whether an odd number of shingles falls on a bit, for two to four times as many bits as shingles.

    Sets that differ in d shingles have signs that differ in at most d bits, and so have the folded ones.
    """
    bits = 1 << max(SIGN_BITS, (2 * len(tokens)).bit_length())
    at = (_mixed(tokens ^ _MIX2) >> np.uint64(8)).astype(np.int64) & (bits - 1)
    return np.packbits((np.bincount(at, minlength=bits) & 1).astype(np.uint8)).tobytes()


def folded(bits: np.ndarray, size: int) -> np.ndarray:
    """The signs in the rows of ``bits`` at a length of ``size`` bytes: both halves of a longer one over each other."""
    while bits.shape[1] > size:
        half = bits.shape[1] // 2
        bits = bits[:, :half] ^ bits[:, half:]
    return bits


def _buckets(tokens: np.ndarray, size_class: int) -> tuple[np.ndarray, np.ndarray]:
    """A number for every bucket of a size class by what is in it, and whether anything is."""
    buckets = max(1, 1 << max(0, size_class - 1))
    at = ((_mixed(tokens ^ _MIX) >> np.uint64(1)) & np.uint64(buckets - 1)).astype(np.int64)
    own = np.zeros(buckets, np.uint64)
    # A sum of mixed tokens names what is in the bucket, whatever its order.
    np.add.at(own, at, _mixed(tokens * _MIX2 + np.uint64(size_class)))
    full = np.bincount(at, minlength=buckets) > 0
    number = np.arange(buckets, dtype=np.uint64)
    return _mixed(own * _MIX + number * np.uint64(64) + np.uint64(size_class)), full


def size_classes(size: int, percent: int = PERCENT) -> list[int]:
    """The class of a set, and the next one where a linked set may be in it."""
    own = size.bit_length() - 1
    return [own, own + 1] if 100 * size // percent >= 1 << (own + 1) else [own]


def most_differing(size: int, percent: int = PERCENT) -> int:
    """Shingles that a set and a linked one may differ in.

    With p percent these are (100 - p) / (100 + p) of |x| + |y|, and |y| <= 100 |x| / p.
    """
    return (100 - percent) * size // percent


SCAN = (
    "doc_id bigint, n_shingles bigint, set_key bigint, sign binary, own array<bigint>, own_filled int, next array<bigint>, "
    "next_filled int, piece int, counts binary"
)


def _slot(found: np.ndarray) -> np.ndarray:
    return (found.view(np.uint64) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def _scan(words: int, percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Size, name, sign and elements of every document's set; at the end of a task, its counts of elements in pieces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        longs = pa.list_(pa.int64())
        schema = pa.schema(
            [
                ("doc_id", pa.int64()),
                ("n_shingles", pa.int64()),
                ("set_key", pa.int64()),
                ("sign", pa.binary()),
                ("own", longs),
                ("own_filled", pa.int32()),
                ("next", longs),
                ("next_filled", pa.int32()),
                ("piece", pa.int32()),
                ("counts", pa.binary()),
            ]
        )
        sketch = np.zeros(1 << SLOT_BITS, np.int32)  # a task has fewer elements
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_PER_BATCH):
                part = batch.slice(at, ROWS_PER_BATCH)
                out: list[list] = [[] for _ in range(7)]
                slots = []
                for text in part.column(1).to_pylist():
                    tokens = shingles(text, words)
                    row: list = [len(tokens), digest(tokens), sign(tokens)]
                    for c in size_classes(len(tokens), percent) if len(tokens) else ():
                        found, filled = elements(tokens, c, most_differing(len(tokens), percent) + 1)
                        slots.append(_slot(found[:filled]))
                        row += [found.view(np.int64), filled]
                    row += [None] * (7 - len(row))
                    for values, value in zip(out, row):
                        values.append(value)
                if slots:
                    np.add.at(sketch, np.concatenate(slots), 1)
                n = part.num_rows
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).cast(pa.int64()),
                        *[pa.array(v, f.type) for v, f in zip(out, list(schema)[1:8])],
                        pa.nulls(n, pa.int32()),
                        pa.nulls(n, pa.binary()),
                    ],
                    schema=schema,
                )
        if sketch.any():
            for piece, at in enumerate(range(0, len(sketch), 1 << PIECE_BITS)):  # one by one, so that no second copy is held
                counts = sketch[at : at + (1 << PIECE_BITS)].tobytes()
                yield pa.RecordBatch.from_arrays(
                    [*[pa.nulls(1, f.type) for f in list(schema)[:8]], pa.array([piece], pa.int32()), pa.array([counts], pa.binary())],
                    schema=schema,
                )

    return run


def _sum_pieces(kind: type, as_levels: bool = False) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Add up pieces whose counts are of ``kind``, into 64-bit counts or their levels, four per doubling."""

    def packed(counts: np.ndarray) -> bytes:
        if as_levels:
            return np.minimum(np.floor(4 * np.log2(counts + 1.0)), 254).astype(np.uint8).tobytes()
        return counts.tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for piece, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                values = np.frombuffer(counts, kind).astype(np.int64)
                total[piece] = total[piece] + values if piece in total else values
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.int32()), pa.array([packed(v) for v in total.values()], pa.binary())],
            names=["piece", "counts"],
        )

    return run


def _levels(scanned: DataFrame) -> np.ndarray:
    """Frequency level of every slot: four per doubling. 2^22 bytes, whatever the input."""
    pieces = scanned.where("piece IS NOT NULL").select("piece", "counts")
    n = 1 << (SLOT_BITS - PIECE_BITS)
    schema = "piece int, counts binary"
    salted = pieces.withColumn("salt", F.spark_partition_id() % 16)
    once = salted.repartition(n, "piece", "salt").mapInArrow(_sum_pieces(np.int32), schema)
    levels = np.zeros(1 << SLOT_BITS, np.uint8)
    for row in once.repartition(n, "piece").mapInArrow(_sum_pieces(np.int64, True), schema).collect():
        at = row["piece"] << PIECE_BITS
        levels[at : at + (1 << PIECE_BITS)] = np.frombuffer(row["counts"], np.uint8)
    return levels


def _close(size: Column, other: Column, percent: int) -> Column:
    """Sizes that linked sets may have."""
    size, other = size.cast("bigint"), other.cast("bigint")
    return (100 * size >= percent * other) & (100 * other >= percent * size)


def _linked(common: Column, size: Column, other: Column, percent: int) -> Column:
    common = common.cast("bigint")
    return 100 * common >= percent * (size + other - common)


def _common(a: str, b: str) -> Column:
    return F.size(F.array_intersect(a, b))


def _places(numbers: np.ndarray) -> np.ndarray:
    return (_mixed(numbers.view(np.uint64) ^ _MIX) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def _mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    flags = np.zeros(1 << FILTER_BITS, bool)
    for batch in batches:
        flags[_places(batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64))] = True
    bits = np.packbits(flags).reshape(16, -1)
    used = np.flatnonzero(bits.any(axis=1))
    yield pa.RecordBatch.from_arrays(
        [pa.array(used, pa.int32()), pa.array([bits[i].tobytes() for i in used], pa.binary())], names=["piece", "bits"]
    )


def _unite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for piece, bits in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            values = np.frombuffer(bits, np.uint8)
            total[piece] = total[piece] | values if piece in total else values
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(total), pa.int32()), pa.array([v.tobytes() for v in total.values()], pa.binary())],
        names=["piece", "bits"],
    )


def _filter_of(wanted: DataFrame) -> Broadcast:
    """Which numbers may be in the one column of ``wanted``: 2 MB, whatever their number.

    It only saves shuffling rows that a join would drop; the join still follows.
    """
    schema = "piece int, bits binary"
    marked = wanted.mapInArrow(_mark, schema).repartition(16, "piece").mapInArrow(_unite, schema)
    bits = np.zeros((16, 1 << (FILTER_BITS - 7)), np.uint8)
    for row in marked.collect():
        bits[row["piece"]] |= np.frombuffer(row["bits"], np.uint8)
    return wanted.sparkSession.sparkContext.broadcast(bits.reshape(-1))


def _may_be_in(bits: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    at = _places(numbers)
    return (bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 > 0


def _only(table: DataFrame, column: str, bits: Broadcast) -> DataFrame:
    """The rows of ``table`` whose number the filter lets pass."""
    at = table.columns.index(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = batch.column(at).to_numpy(zero_copy_only=False).astype(np.int64)
            yield batch.filter(pa.array(_may_be_in(bits.value, numbers)))

    return table.mapInArrow(run, table.schema)


def _few_differ(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs (a, b) of rows (a, b, most, x, y) where the signs x and y differ in ``most`` bits or fewer."""
    for batch in batches:
        x, y = (batch.column(i).to_pylist() for i in (3, 4))
        most = batch.column(2).to_numpy(zero_copy_only=False)
        lengths = np.array([(len(v), len(w)) for v, w in zip(x, y)], np.int64).reshape(-1, 2)
        few = np.zeros(len(x), bool)
        for n, m in np.unique(lengths, axis=0).tolist():
            own = np.flatnonzero((lengths == (n, m)).all(axis=1))
            left, right = (
                folded(np.frombuffer(b"".join([v[i] for i in own]), np.uint8).reshape(len(own), -1), min(n, m)) for v in (x, y)
            )
            few[own] = np.bitwise_count(left ^ right).sum(axis=1, dtype=np.int64) <= most[own]
        yield batch.select(["a", "b"]).filter(pa.array(few))


def _near(pairs: DataFrame, signs: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) among the stored ones whose signs don't rule a link out: few enough bits differ. The pairs are dropped."""
    own = _only(signs.select("node", "size", "sign"), "node", _filter_of(_ends(pairs)))
    left, right = (own.select(F.col("node").alias(x), *[F.col(c).alias(f"{x}_{c}") for c in ("size", "sign")]) for x in ("a", "b"))
    most = F.floor((100 - percent) * (F.col("a_size") + F.col("b_size")).cast("bigint") / (100 + percent))
    compared = (
        pairs.join(left, "a")
        .join(right, "b")
        .where(_close(F.col("a_size"), F.col("b_size"), percent))
        .select("a", "b", most.cast("bigint").alias("most"), F.col("a_sign").alias("x"), F.col("b_sign").alias("y"))
    )
    near = stored(compared.mapInArrow(_few_differ, "a bigint, b bigint"), "jaccard-near")
    dropped(pairs)
    return near


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("node"))


def _verify(near: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) among the stored pairs (a, b), by their whole sets; the pairs are dropped."""
    tokens = _only(sets, "node", _filter_of(_ends(near)))
    left, right = (tokens.select(F.col("node").alias(x), F.col("tokens").alias(f"{x}_tokens")) for x in ("a", "b"))
    links = (
        near.join(left, "a")
        .join(right, "b")
        .where(_linked(_common("a_tokens", "b_tokens"), F.size("a_tokens"), F.size("b_tokens"), percent))
        .select("a", "b")
        .distinct()
    )
    links = stored(links, "jaccard-links")
    dropped(near)
    return links


def _lists(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """The values of the lists of a column, one behind the other, and the lengths of the lists."""
    lengths = pc.list_value_length(column).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    return column.flatten().to_numpy(zero_copy_only=False), lengths


def _as_lists(values: np.ndarray, lengths: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32()), pa.array(values))


def _prefixes(levels: Broadcast, percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The first elements of every set in the order of levels, and their places in it, from the columns of a scan."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            most = most_differing(batch.column("n_shingles").to_numpy(zero_copy_only=False).astype(np.int64), percent) + 1
            parts = []
            for name in ("own", "next"):
                found, lengths = _lists(batch.column(name))
                filled = batch.column(f"{name}_filled").fill_null(0).to_numpy(zero_copy_only=False)
                row = np.repeat(np.arange(n), lengths)
                at = np.arange(len(found)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
                real = at < filled[row]
                level = np.where(real, levels.value[_slot(found)], 255)
                # Those of empty buckets come last, by bucket, as they were cut off in that order.
                order = np.lexsort((np.where(real, found, at), row << 8 | level))
                kept = at < most[row]  # rows are as long in their new order
                parts.append((row[kept], found[order][kept], at[kept].astype(np.int32)))
            row, found, places = (np.concatenate(x) for x in zip(*parts))
            order = np.argsort(row, kind="stable")
            lengths = np.bincount(row, minlength=n)
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c) for c in ("doc_id", "set_key", "n_shingles")],
                    _as_lists(found[order], lengths),
                    _as_lists(places[order], lengths),
                ],
                names=["node", "set_key", "n_shingles", "elements", "places"],
            )

    return run


def _known_elements(known: Broadcast) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (node, size, elements, places) with those elements that the filter lets pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, lengths = _lists(batch.column("elements"))
            places, _ = _lists(batch.column("places"))
            kept = _may_be_in(known.value, found)
            lengths = np.bincount(np.repeat(np.arange(len(lengths)), lengths)[kept], minlength=len(lengths))
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), batch.column("size"), _as_lists(found[kept], lengths), _as_lists(places[kept], lengths)],
                names=["node", "size", "elements", "places"],
            )

    return run


def join_documents(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id.

    Sets are of shingles of ``words`` words and link from a similarity of ``percent`` / 100 on, at least 0.8.

    Rows with equal sets are one class, carried by its smallest id. component_id is the smallest id
    reachable over links; texts without a word have no shingles and are linked with nothing, so theirs is
    their own. Rows that repeat an id count as one document for reaching others; a row with a null id
    gets the component of its class's smallest id, and null where there is none.
    """
    if words < 1 or not LEAST_PERCENT <= percent <= 100:
        raise ValueError(f"no join for {words} words and {percent} percent")
    spark = docs.sparkSession
    rows = docs.selectExpr("cast(doc_id as bigint) doc_id", "cast(text as string) text")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ROWS_PER_BATCH)
    scanned = stored(rows.mapInArrow(_scan(words, percent), SCAN), "jaccard-scan")
    levels = spark.sparkContext.broadcast(_levels(scanned))
    sets_of = stored(scanned.where("piece IS NULL").select("doc_id", "n_shingles", "set_key", "sign"), "jaccard-sizes")
    classes = stored(
        sets_of.where("n_shingles > 0")
        .groupBy("set_key", "n_shingles")
        .agg(F.min("doc_id").alias("node"))
        .where("node IS NOT NULL"),
        "jaccard-classes",
    )

    prefix = stored(
        scanned.where("piece IS NULL AND doc_id IS NOT NULL AND n_shingles > 0")
        .drop("piece", "counts", "sign")
        .mapInArrow(
            _prefixes(levels, percent), "node bigint, set_key bigint, n_shingles bigint, elements array<bigint>, places array<int>"
        )
        .join(classes, ["node", "set_key", "n_shingles"], "left_semi")
        .select("node", F.col("n_shingles").cast("int").alias("size"), "elements", "places"),
        "jaccard-prefix",
    )
    dropped(scanned)
    common = stored(
        prefix.select(F.explode("elements").alias("element")).groupBy("element").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("element"), "jaccard-common"
    )
    left = prefix.select("node", "size", "elements", "places").mapInArrow(
        _known_elements(_filter_of(common)), "node bigint, size int, elements array<bigint>, places array<int>"
    )
    shared = stored(_exploded(left).join(common, "element"), "jaccard-shared")
    dropped(common)
    heads = stored(
        shared.groupBy("element").agg(F.min(F.struct("place", "size", "node")).alias("head")), "jaccard-heads"
    )
    size, other = F.col("size"), F.col("head.size")
    stars = stored(
        shared.join(heads, "element")
        .where(F.col("node") != F.col("head.node"))
        .where(_close(size, other, percent))
        .where((100 + percent) * F.greatest("place", "head.place").cast("bigint") <= (100 - percent) * (size + other).cast("bigint"))
        .select(F.col("node").alias("a"), F.col("head.node").alias("b"))
        .distinct(),
        "jaccard-stars",
    )
    dropped(heads)
    # Signs of all that share an element. Whole sets are made of those alone whose signs leave a link open.
    wanted = stored(shared.select("node").distinct(), "jaccard-wanted")

    def shorter(batch: dict) -> dict:
        short = [folded(np.frombuffer(x, np.uint8)[None], 1 << (SIGN_BITS - 3))[0].view(np.int64) for x in batch["sign"]]
        return {c: batch[c] for c in ("node", "size", "sign")} | {"short": short}

    named = sets_of.where("doc_id IS NOT NULL").select(F.col("doc_id").alias("node"), F.col("n_shingles").cast("int").alias("size"), "set_key", "sign")
    signs = stored(
        map_batches(
            _only(named, "node", _filter_of(wanted)).join(wanted, "node").dropDuplicates(["node", "set_key"]),
            shorter,
            "node bigint, size int, sign binary, short array<bigint>",
        ),
        "jaccard-signs",
    )
    dropped(wanted)

    def whole(nodes: DataFrame) -> DataFrame:
        """(node, tokens): the whole sets of the documents in the one column of ``nodes``, made anew from their texts."""
        own = stored(nodes.select(F.col("node").alias("doc_id")).distinct(), "jaccard-whole")
        sets = stored(
            map_batches(
                _only(rows.where("doc_id IS NOT NULL"), "doc_id", _filter_of(own)).join(own, "doc_id").dropDuplicates(["doc_id", "text"]),
                lambda batch: {"node": batch["doc_id"], "tokens": [shingles(t, words).view(np.int64) for t in batch["text"]]},
                "node bigint, tokens array<bigint>",
            ),
            "jaccard-sets",
        )
        dropped(own)
        return sets

    near = _near(stars, signs, percent)
    sets = whole(_ends(near))
    links = _verify(near, sets, percent)
    dropped(sets)
    groups = components(links, "jaccard-groups")
    placed = stored(
        shared.join(groups, "node", "left").withColumn("group", F.coalesce("component", "node")).drop("component"),
        "jaccard-placed",
    )
    dropped(shared)
    # Elements of more than one group, as a matrix of elements and groups.
    mixed = stored(
        placed.groupBy("element")
        .agg(F.min("group").alias("low"), F.max("group").alias("high"))
        .where("low < high")
        .select("element"),
        "jaccard-mixed",
    )
    if not mixed.isEmpty():
        more = _open_groups(placed, mixed, prefix, signs, whole, percent)
        groups = components(links.union(more), "jaccard-components")
    nodes = stored(
        classes.join(groups, "node", "left").select("set_key", "n_shingles", F.coalesce("component", "node").alias("low")),
        "jaccard-nodes",
    )
    dropped(signs, prefix, placed, classes)
    return sets_of.join(nodes, ["set_key", "n_shingles"], "left").select(
        "doc_id", "n_shingles", F.coalesce("low", "doc_id").alias("component_id")
    )


def _exploded(prefix: DataFrame) -> DataFrame:
    return prefix.select("node", "size", F.explode(F.arrays_zip("elements", "places")).alias("e")).select(
        "node", "size", F.col("e.elements").alias("element"), F.col("e.places").alias("place")
    )


def _masks(batch: dict) -> dict:
    """For every first element the buckets of the rarer ones before it, as 128 bits."""
    out: dict[str, list] = {**{k: batch[k] for k in ("node", "size", "elements", "places")}, "low": [], "high": []}
    for found, places in zip(batch["elements"], batch["places"]):
        masks, mask = [], 0
        for element, place in zip(found, places):
            if not place:
                mask = 0
            masks.append(mask)
            mask |= 1 << (element & ((1 << BUCKET_BITS) - 1))
        for name, shift in (("low", 0), ("high", 64)):
            part = [(m >> shift) & (2**64 - 1) for m in masks]
            out[name].append([p - 2**64 if p >> 63 else p for p in part])
    return out


def _open_groups(
    placed: DataFrame, mixed: DataFrame, prefix: DataFrame, signs: DataFrame, whole: Callable[[DataFrame], DataFrame], percent: int
) -> DataFrame:
    """Links (a, b) between different groups, from the rows (element, node, size, place, group).

    Up to the first element that two sets share, the buckets of both sets' elements differ. So the
    buckets before it, of both together, may be no more than the shingles that linked sets differ in, and
    so may the bits of a set's short sign that no member of a group has as they are.

    ``signs`` are those of all sets that share an element, ``whole`` makes the whole sets of documents.
    """
    words = [f"s{i}" for i in range(1 << (SIGN_BITS - 6))]
    nodes = stored(placed.join(mixed, "element", "left_semi").select("node", "group").distinct(), "jaccard-nodes-open")
    # Only sets and elements that the joins may keep are moved.
    arrays = _only(prefix, "node", _filter_of(nodes.select("node"))).join(nodes, "node")
    known = _filter_of(mixed)

    def masks(batch: dict) -> dict:
        out = _masks(batch)
        kept = [_may_be_in(known.value, np.array(e, np.int64)) for e in out["elements"]]
        for name in ("elements", "places", "low", "high"):
            out[name] = [list(itertools.compress(values, k)) for values, k in zip(out[name], kept)]
        return out

    short = signs.select("node", *[F.col("short")[i].alias(c) for i, c in enumerate(words)])
    groups = arrays.select("node", "group").distinct().join(short, "node")
    rows = stored(
        map_batches(
            arrays.drop("group"),
            masks,
            "node bigint, size int, elements array<bigint>, places array<int>, low array<bigint>, high array<bigint>",
        )
        .select("node", "size", F.explode(F.arrays_zip("elements", "low", "high")).alias("e"))
        .select("node", "size", F.col("e.elements").alias("element"), F.col("e.low").alias("low"), F.col("e.high").alias("high"))
        .join(mixed, "element")
        .join(groups, "node"),
        "jaccard-open",
    )
    dropped(placed, prefix)
    matrix = stored(
        rows.groupBy("element", "group").agg(
            F.min("size").alias("least"),
            F.max("size").alias("most"),
            F.min("node").alias("one"),
            F.max("node").alias("other"),
            F.bit_and("low").alias("low"),
            F.bit_and("high").alias("high"),
            *[F.bit_and(c).alias(f"all_{c}") for c in words],
            *[F.bit_or(c).alias(f"any_{c}") for c in words],
        ),
        "jaccard-matrix",
    )
    # What a set might reach: sizes that fit, and few enough buckets and bits that differ. Where one
    # member of the group has the element, it is that one.
    apart = " + ".join(f"bit_count((q.{c} & ~g.any_{c}) | (g.all_{c} & ~q.{c}))" for c in words)
    found = stored(
        rows.alias("q")
        .join(matrix.alias("g"), "element")
        .where(f"q.group != g.group AND 100L * q.size >= {percent}L * g.least AND 100L * g.most >= {percent}L * q.size")
        .where(
            f"{100 + percent} * (bit_count(q.low | g.low) + bit_count(q.high | g.high))"
            f" <= {100 - percent}L * (q.size + least(g.most, 100L * q.size / {percent}))"
        )
        .where(f"{100 + percent} * ({apart}) <= {100 - percent}L * (q.size + least(g.most, 100L * q.size / {percent}))")
        .selectExpr("q.node", "g.group", "CASE WHEN g.one = g.other THEN g.one END AS one")
        .distinct(),
        "jaccard-found",
    )
    dropped(matrix)
    direct = found.where("one IS NOT NULL").select(F.least("node", "one").alias("a"), F.greatest("node", "one").alias("b")).distinct()
    near = _near(stored(direct, "jaccard-direct"), signs, percent)
    reach = found.where("one IS NULL").select("node", "group")
    if reach.isEmpty():
        sets = whole(_ends(near))
        more = _verify(near, sets, percent)
        dropped(sets)
        return more
    # A group is cut into slices of about SLICE members by a hash.
    members = stored(
        rows.select("node", "group").distinct().join(reach.select("group").distinct(), "group", "left_semi"), "jaccard-members"
    )
    counts = members.groupBy("group").agg(F.ceil(F.count(F.lit(1)) / SLICE).cast("int").alias("slices"))
    sliced = stored(
        members.join(stored(counts, "jaccard-counts"), "group").withColumn(
            "slice", F.pmod(F.xxhash64("node"), F.col("slices")).cast("int")
        ),
        "jaccard-sliced",
    )
    # Only the sets of these groups and of what might reach them are moved; those of pairs are made along with them.
    nodes = reach.select("node").union(sliced.select("node"))
    sets = whole(nodes.union(_ends(near)))
    more = _verify(near, sets, percent)
    tokens = _only(sets, "node", _filter_of(nodes))
    unions = stored(
        sliced.join(tokens, "node")
        .groupBy("group", "slice")
        .agg(
            F.array_distinct(F.flatten(F.collect_list("tokens"))).alias("union_tokens"),
            F.min(F.size("tokens")).alias("least"),
        ),
        "jaccard-unions",
    )
    qualified = stored(
        reach.join(tokens, "node")
        .join(unions, "group")
        .withColumn("common", _common("tokens", "union_tokens"))
        # Linked sets share p/100 of either and p/(100 + p) of both sizes' sum.
        .withColumns({"common": F.col("common").cast("bigint"), "size": F.size("tokens").cast("bigint")})
        .where(100 * F.col("common") >= percent * F.col("size"))
        .where((100 + percent) * F.col("common") >= percent * (F.col("size") + F.greatest("least", F.ceil(percent * F.col("size") / 100) - 1)))
        .select("node", "group", "slice"),
        "jaccard-qualified",
    )
    dropped(unions)
    left = rows.join(qualified, "node").select(
        "element",
        "slice",
        qualified["group"],
        *[F.col(c).alias(f"a_{c}") for c in ("size", "low", "high", *words)],
        F.col("node").alias("a"),
    )
    right = rows.join(sliced.select("node", "slice"), "node").select(
        "element", "slice", "group", *[F.col(c).alias(f"b_{c}") for c in ("size", "low", "high", *words)], F.col("node").alias("b")
    )
    apart = " + ".join(f"bit_count(a_{c} ^ b_{c})" for c in words)
    pairs = (
        left.join(right, ["element", "group", "slice"])
        .where(_close(F.col("a_size"), F.col("b_size"), percent))
        .where(f"{100 + percent} * (bit_count(a_low | b_low) + bit_count(a_high | b_high)) <= {100 - percent}L * (a_size + b_size)")
        .where(f"{100 + percent} * ({apart}) <= {100 - percent}L * (a_size + b_size)")
        .select("a", "b")
        .distinct()
    )
    pairs = stored(pairs, "jaccard-pairs")
    dropped(rows, found, qualified)
    last = _verify(_near(pairs, signs, percent), sets, percent)
    dropped(sets)
    return more.union(last)


def keep_one(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` that carry the smallest id of their component, one for each, with all columns.

    ``words`` and ``percent`` are those of ``join_documents``.

    Of rows that repeat an id the smallest in the order of the columns stays. Rows with a null id stay only
    where no equal text has an id.
    """
    found = stored(join_documents(docs, words, percent), "jaccard-found")
    low = found.where("doc_id = component_id").select("doc_id").distinct()
    others = [c for c in docs.columns if c != "doc_id"]
    named = (
        docs.join(low, "doc_id", "left_semi").groupBy("doc_id").agg(F.min(F.struct(*others)).alias("_row")).select("doc_id", "_row.*")
    )
    if found.where("doc_id IS NULL AND component_id IS NULL").isEmpty():
        return named.select(*docs.columns)
    # Which of the rows without id have no equal text with one is told by their text.
    texts = docs.where("doc_id IS NOT NULL").select("text").distinct()
    unnamed = docs.where("doc_id IS NULL").join(texts, "text", "left_anti").dropDuplicates(["text"])
    return named.select(*docs.columns).union(unnamed.select(*docs.columns))
