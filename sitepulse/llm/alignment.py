"""Alignment of the tokens of two tokenizers over the same bytes.

Tokenizer A is a byte-level BPE, B a piece model. Where a token of both ends, a group ends. Most groups are one token
of A and the token of B with the same bytes; which one that is says a map made once from the two
vocabularies, so such links are counted in one vector over the vocabulary of A for each task. Only links of other
pairs are counted in a shuffle, after each chunk of texts has added its own up.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tiktoken import Encoding

from sitepulse.llm import bpe, pieces
from sitepulse.llm.chunks import CHUNK_CHARS, map_chunks, pack, unpack
from sitepulse.llm.common import stored, stored_by

#: Stands between two words of a segment; no text holds half of a surrogate pair.
BETWEEN = "\ud800"
#: Characters of a chunk of texts to align: their links and groups are held until the chunk ends, many times the texts.
ALIGN_CHARS = CHUNK_CHARS // 4
_LOW = 0xFFFFFFFF


class Aligner:
    """Cuts a text into segments on which both tokenizers work independently, and aligns a segment.

    A text is cut where a word of A ends and no piece of B has the two characters in a row.
    """

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = bpe.byte_bpe(path_a, special=False), pieces.piece_model(path_b)
        if self.b.prefix != pieces.SPACE:
            raise ValueError("the piece model must put a space before a text")
        byte_tokens = {self.b.raw[i]: i for i in self.b.byte_ids}
        by_bytes = byte_tokens | {piece.replace(pieces.SPACE, " ").encode(): i for piece, i in self.b.ids.items()}
        #: Id in B of the same bytes, or -1, for every id of A.
        self.same = np.full(max(self.a.raw) + 1, -1, np.int64)
        for i, raw in self.a.raw.items():
            self.same[i] = by_bytes.get(raw, -1)
        self.joined = {(c + d).replace(pieces.SPACE, " ") for c, d in self.b.follows}
        self.library_a = self._ranked(self.a)
        self.library_b = SentencePieceProcessor(model_file=path_b)
        self.id_of_rank = [*self.a.first, *self.a.merged]
        top = len(self.same)
        self.size_a, self.name_a = [len(self.a.raw.get(i, b"")) for i in range(top)], [str(i) for i in range(top)]
        self.size_b, self.name_b = [len(r) for r in self.b.raw], [str(i) for i in range(len(self.b.raw))]

    @staticmethod
    def _ranked(model: bpe.ByteBpe) -> Encoding:
        """The merges of A for the library that takes a whole word as it is; its ids are the ranks of the merges."""
        order = [*model.first, *model.merged]
        ranks = {model.raw[i]: rank for rank, i in enumerate(order)}
        if len(ranks) != len(order):
            raise ValueError("two merges of A make the same piece")
        return Encoding("words", pat_str="(?s:.+)", mergeable_ranks=ranks, special_tokens={})

    def cut(self, text: str) -> list[str]:
        """Segments of space + text, with a mark between their words; an empty text has none."""
        if not text:
            return []
        words, joined = self.a.split(" " + text), self.joined
        firsts, lasts = [w[0] for w in words[1:]], [w[-1] for w in words]
        if joined.isdisjoint(map(add, lasts, firsts)):
            return words
        segments, run = [], [words[0]]
        for last, first, word in zip(lasts, firsts, words[1:]):
            if last + first in joined:
                run.append(word)
            else:
                segments.append(BETWEEN.join(run))
                run = [word]
        segments.append(BETWEEN.join(run))
        return segments

    def _tokens_a(self, segments: list[str]) -> list[list[int]]:
        """Ids of segments in A."""
        encode, id_of = self.library_a.encode_ordinary, self.id_of_rank
        return [[id_of[r] for word in s.split(BETWEEN) for r in encode(word)] for s in segments]

    def _tokens_b(self, plain: list[str]) -> list[list[int]]:
        """Ids of segments in B. The library puts the space that a segment begins with; others are rare."""
        spaced = self.library_b.encode([p[1:] for p in plain if len(p) > 1 and p[0] == " "], num_threads=1)
        following = iter(spaced)
        return [
            next(following)
            if len(p) > 1 and p[0] == " "
            else pieces.unpacked(
                b"".join([self.b.segments[s] for s in self.b.split.findall(p.replace(" ", pieces.SPACE))])
            ).tolist()
            for p in plain
        ]

    def align(self, segments: list[str]) -> list[tuple[int, int, list[int], list[str]] | None]:
        """Per segment: numbers of tokens in A and B, links as a << 32 | b, groups as text; None where bytes differ."""
        plain = [s.replace(BETWEEN, "") for s in segments]
        found = []
        for body, ids_a, ids_b in zip(plain, self._tokens_a(segments), self._tokens_b(plain)):
            # B gives back every text but one with its own mark for a space.
            found.append(None if pieces.SPACE in body else self._pair(ids_a, ids_b))  # A gives back any text
        return found

    def _pair(self, ids_a: list[int], ids_b: list[int]) -> tuple[int, int, list[int], list[str]]:
        size_a, size_b, name_a, name_b = self.size_a, self.size_b, self.name_a, self.name_b
        links, groups = [], []
        i = j = 0
        while i < len(ids_a):
            a, b = ids_a[i], ids_b[j]
            links.append(a << 32 | b)
            ahead = size_a[a] - size_b[b]
            if ahead == 0:
                groups.append(f"{name_a[a]}|{name_b[b]}")
            else:
                first_a, first_b = i, j
                while ahead:  # the side that ends first goes on, and its next token overlaps the other's
                    if ahead < 0:
                        i += 1
                        a = ids_a[i]
                        ahead += size_a[a]
                    else:
                        j += 1
                        b = ids_b[j]
                        ahead -= size_b[b]
                    links.append(a << 32 | b)
                left = ",".join([name_a[x] for x in ids_a[first_a : i + 1]])
                right = ",".join([name_b[x] for x in ids_b[first_b : j + 1]])
                groups.append(f"{left}|{right}")
            i, j = i + 1, j + 1
        return len(ids_a), len(ids_b), links, groups


@lru_cache(maxsize=2)
def aligner(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of the given sizes, in whole numbers."""
    ends = np.cumsum(sizes)
    total = np.concatenate([[0], np.cumsum(values.astype(np.int64))])
    return total[ends] - total[ends - sizes]


def _rows_of(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Indices of the rows of several runs, one run after the other."""
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts - before, sizes) + np.arange(sizes.sum())


class PairChunks:
    """Chunks of linked ids: results of the documents, their links by pair, documents that hold each odd pair."""

    SCHEMA = """
        docs array<struct<doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint,
                          groups_sha256 string, n_same bigint, n_odd bigint>>,
        same_a binary, same_links binary, odd_at binary, odd_links binary,
        keys array<bigint>, holders array<bigint>, vector array<bigint>
    """

    def __init__(self, path_a: str, path_b: str):
        self.aligner = aligner(path_a, path_b)
        self.cut = self.aligner.cut
        self.vector = np.zeros(len(self.aligner.same), np.int64)

    def row(self, ids: list, texts: list[np.ndarray], strings: list[str]) -> dict:
        found = self.aligner.align(strings)
        sound = np.array([f is not None for f in found], bool)
        found = [f or (0, 0, [], []) for f in found]
        n_a, n_b, n_links, n_groups = (
            np.array(x, np.int64)
            for x in ([f[0] for f in found], [f[1] for f in found], [len(f[2]) for f in found], [len(f[3]) for f in found])
        )
        starts = np.cumsum(n_links) - n_links
        keys, pair_of = np.unique(np.array([k for f in found for k in f[2]], np.int64), return_inverse=True)
        body = [";".join(f[3]) for f in found]
        texts = [t if len(t) and sound[t].all() else t[:0] for t in texts]
        docs, owners, distinct, times = [], [], [], []
        for at, (key, own) in enumerate(zip(ids, texts)):
            groups = ";".join([body[i] for i in own.tolist()])
            docs.append(
                {
                    "doc_id": key,
                    "n_a": int(n_a[own].sum()),
                    "n_b": int(n_b[own].sum()),
                    "n_groups": int(n_groups[own].sum()),
                    "n_links": int(n_links[own].sum()),
                    "groups_sha256": hashlib.sha256(groups.encode()).hexdigest() if len(own) else "",
                }
            )
            segments, count = np.unique(own, return_counts=True)
            owners.append(np.full(len(segments), at))
            distinct.append(segments)
            times.append(count)
        segments = np.concatenate(distinct).astype(np.int64)
        sizes = n_links[segments]
        pair = pair_of[_rows_of(starts[segments], sizes)].astype(np.int64)
        place = np.repeat(np.concatenate(owners).astype(np.int64), sizes) * max(len(keys), 1) + pair
        weight = np.repeat(np.concatenate(times), sizes)
        order = np.argsort(place, kind="stable")
        first = np.flatnonzero(np.diff(place[order], prepend=-1))
        weight = np.add.reduceat(weight[order], first) if len(first) else weight[:0]
        # One row per document and pair from here on.
        doc, pair = np.divmod(place[order][first], max(len(keys), 1))
        is_same = (self.aligner.same[keys >> 32] == (keys & _LOW)) if len(keys) else np.zeros(0, bool)
        holders = np.bincount(pair, minlength=len(keys))
        self.vector[keys[is_same] >> 32] += holders[is_same]
        odd = ~is_same & (holders > 0)  # a segment may stand in texts without tokens only
        odd_place = np.cumsum(odd) - 1
        same = is_same[pair] if len(keys) else np.zeros(0, bool)
        for name, mine in (("n_same", same), ("n_odd", ~same)):
            for row, size in zip(docs, np.bincount(doc[mine], minlength=len(docs)).tolist()):
                row[name] = size
        return {
            "docs": docs,
            "same_a": pack(keys[pair[same]] >> 32),
            "same_links": pack(weight[same]),
            "odd_at": pack(odd_place[pair[~same]]),
            "odd_links": pack(weight[~same]),
            "keys": keys[odd],
            "holders": holders[odd],
        }

    def last(self) -> dict:
        return {"vector": self.vector}


def _vector(rows: DataFrame, size: int) -> np.ndarray:
    """Rows (id, n) as a vector over the vocabulary, which bounds their number."""
    found = np.zeros(size, np.int64)
    for row in rows.collect():
        found[row["id"]] = row["n"]
    return found


def _counts(chunks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Documents that hold a pair: (id, n) of the pairs of equal bytes by their id in A, (key, n) of all others."""
    same = chunks.where("vector IS NOT NULL").select(F.posexplode("vector").alias("id", "n")).where("n > 0")
    odd = chunks.where("keys IS NOT NULL").select(F.inline(F.arrays_zip("keys", "holders")).alias("key", "n"))
    return same.groupBy("id").agg(F.sum("n").alias("n")), odd.groupBy("key").agg(F.sum("n").alias("n"))


def pair_counts(docs: DataFrame, path_a: str | None = None, path_b: str | None = None, **columns) -> DataFrame:
    """(id_a, id_b, documents) of every pair of ids that any document of ``docs`` links."""
    path_a, path_b = path_a or bpe.default_path(), path_b or pieces.default_path()
    cut = map_chunks(docs, lambda: PairChunks(path_a, path_b), PairChunks.SCHEMA, **{"chunk_chars": ALIGN_CHARS, **columns})
    same, odd = _counts(stored_by(cut, "align-chunks", "chunk"))
    partner = [(a, int(b)) for a, b in enumerate(aligner(path_a, path_b).same) if b >= 0]
    partners = F.broadcast(docs.sparkSession.createDataFrame(partner, "id int, id_b bigint"))  # a row per id of A at most
    halves = odd.select(F.shiftright("key", 32).alias("id_a"), F.col("key").bitwiseAND(_LOW).alias("id_b"), "n")
    alike = same.join(partners, "id").select(F.col("id").cast("bigint").alias("id_a"), "id_b", "n")
    return alike.union(halves).withColumnRenamed("n", "documents")


def align_documents(
    docs: DataFrame,
    path_a: str | None = None,
    path_b: str | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    chunk_chars: int = ALIGN_CHARS,
) -> DataFrame:
    """One row per row of ``docs``: tokens, groups and links of its text, and how its links stand in the corpus.

    ``count_sum`` adds up, over the links, how many rows of ``docs`` hold the pair; ``n_best`` counts the
    links whose pair is held by as many rows as any pair of its id in A. Texts that are null or empty,
    or that B does not give back byte by byte, have no tokens: all numbers are 0 and ``groups_sha256`` is empty.
    Repeated rows each count and each get their own row; a null id stays null; an empty table gives no rows.
    Strings of special tokens are plain text.
    """
    path_a, path_b = path_a or bpe.default_path(), path_b or pieces.default_path()
    spark = docs.sparkSession
    cut = map_chunks(docs, lambda: PairChunks(path_a, path_b), PairChunks.SCHEMA, doc_id, text, chunk_chars)
    chunks = stored_by(cut, "align-chunks", "chunk")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", bpe.WORDS_PER_BATCH)
    same, odd = _counts(chunks)
    odd = stored(odd, "align-pairs")
    size = len(aligner(path_a, path_b).same)
    held = _vector(same, size)
    best_odd = odd.groupBy(F.shiftright("key", 32).alias("id")).agg(F.max("n").alias("n"))
    vectors = spark.sparkContext.broadcast((held, np.maximum(held, _vector(best_odd, size))))
    kept = chunks.where("docs IS NOT NULL")
    own = kept.select("chunk", F.posexplode("keys").alias("at", "key"))
    back = own.join(odd, "key").select("chunk", "at", "key", "n")
    schema = (
        "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, "
        "groups_sha256 string"
    )
    kinds = spark.createDataFrame([], schema).schema

    def assemble(chunk: pa.Table, found: pa.Table) -> pa.Table:
        from pyspark.sql.pandas.types import to_arrow_schema

        held, best = vectors.value
        order = np.argsort(found.column("at").to_numpy())
        odd_n, odd_a = found.column("n").to_numpy()[order], found.column("key").to_numpy()[order] >> 32
        tables = []
        for row in chunk.to_pylist():  # one
            docs = pa.Table.from_pylist(row["docs"])
            n_same, n_odd = (docs.column(c).to_numpy().astype(np.int64) for c in ("n_same", "n_odd"))
            same_a, same_links = (unpack(row[c], int(n_same.sum())) for c in ("same_a", "same_links"))
            odd_at, odd_links = (unpack(row[c], int(n_odd.sum())) for c in ("odd_at", "odd_links"))
            top_odd = odd_n == best[odd_a]
            numbers = {
                "n_best": _sums(same_links * (held[same_a] == best[same_a]), n_same)
                + _sums(odd_links * top_odd[odd_at], n_odd),
                "count_sum": _sums(same_links * held[same_a], n_same) + _sums(odd_links * odd_n[odd_at], n_odd),
            }
            arrow = to_arrow_schema(kinds)
            columns = [pa.array(numbers[f.name]) if f.name in numbers else docs.column(f.name) for f in arrow]
            tables.append(pa.table([c.cast(f.type) for c, f in zip(columns, arrow)], schema=arrow))
        return pa.concat_tables(tables)

    left = kept.select(F.col("chunk").alias("of"), "docs", "same_a", "same_links", "odd_at", "odd_links")
    return left.groupBy("of").cogroup(back.groupBy("chunk")).applyInArrow(assemble, kinds)
