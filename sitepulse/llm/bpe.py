"""Byte-level BPE over a table of distinct words, and decoding through a table of pieces.

Texts are split into words chunk by chunk. The words of all chunks meet in a table of distinct words, dealt into
buckets by their hash; each word is encoded once, and its ids meet the bytes of their pieces in a join. A chunk
then gets back the ids of its words by position and puts them where the words stand. What moves are packed lists of
words and ids, so each word costs a few bytes.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitepulse.llm.chunks import CHUNK_CHARS, by_frequency, map_chunks, pack, pack_strings, slices, unpack, unpack_strings
from sitepulse.llm.common import ROWS_PER_BATCH, stored_by

#: Words of at most so many bytes are merged by plain search, longer ones with a heap.
SHORT = 48


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte: visible Latin ones for themselves, the others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(others)}


def _ranges(codes: list[int]) -> str:
    """Code points as the inside of a character class."""
    runs: list[list[int]] = []
    for code in codes:
        if runs and runs[-1][1] == code - 1:
            runs[-1][1] = code
        else:
            runs.append([code, code])
    return "".join(f"\\U{a:08x}" if a == b else f"\\U{a:08x}-\\U{b:08x}" for a, b in runs)


def _classes(splitter) -> dict[str, str]:
    """Letters, numbers and white space (L, N, S) as ``splitter`` sees them, as insides of character classes.

    Tables of different Unicode versions agree on all but new characters. Those on which the two at hand
    differ are put before the splitter itself, which says what it takes them for.
    """
    import regex

    # Nothing beyond these planes is a letter, a number or white space.
    every = "".join(chr(c) for c in range(0x40000) if not 0xD800 <= c < 0xE000)
    kinds = {c: k for k, p in (("L", r"\p{L}"), ("N", r"\p{N}"), ("S", r"\s")) for c in regex.findall(p, every)}
    members: dict[str, list[int]] = {"L": [], "N": [], "S": []}
    for c in every:
        kind, other = kinds.get(c), unicodedata.category(c)[0]
        if kind != "S" and kind != (other if other in "LN" else None):
            alike = (k for k, mate in (("L", "a"), ("N", "1")) if len(splitter.pre_tokenize_str(mate + c)) == 1)
            kind = next(alike, None)
        if kind:
            members[kind].append(ord(c))
    return {kind: _ranges(codes) for kind, codes in members.items()}


class ByteBpe:
    """Splits and encodes as the tokenizers library does with a byte-level BPE file.

    ``special`` says whether the strings of added tokens count as those tokens; else they are plain text.
    """

    def __init__(self, path: str, special: bool = True):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, before = spec["model"], spec["pre_tokenizer"]
        plain = not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix"))
        known = before["type"] == "ByteLevel" and before["use_regex"] and not before["add_prefix_space"]
        added = spec["added_tokens"]
        if not (plain and known) or model.get("ignore_merges") or model.get("byte_fallback") or spec["normalizer"]:
            raise ValueError("the file must hold a byte-level BPE without normalization, dropout or marks of word parts")
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in added):
            raise ValueError("added tokens must match anywhere and alone")
        letters = _byte_letters()
        vocabulary: dict[str, int] = model["vocab"]
        #: Bytes of every piece; an added token stands for its own text.
        self.raw: dict[int, bytes] = {i: bytes([letters[c] for c in piece]) for piece, i in vocabulary.items()}
        self.raw |= {t["id"]: t["content"].encode() for t in added}
        letter_of = {b: c for c, b in letters.items()}
        self.first = [vocabulary[letter_of[b]] for b in range(256)]
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.ranks = {(vocabulary[left], vocabulary[right]): rank for rank, (left, right) in enumerate(merges)}
        self.merged = [vocabulary[left + right] for left, right in merges]
        self.added = {t["content"]: t["id"] for t in added} if special else {}
        longest = sorted(self.added, key=len, reverse=True)
        self.marks = re.compile("(" + "|".join(map(re.escape, longest)) + ")") if self.added else None
        kind = _classes(Tokenizer.from_file(path).pre_tokenizer)
        ascii_kind = {"L": "A-Za-z", "N": "0-9", "S": r"\x09-\x0D\x20"}
        self.any_words, self.ascii_words = (self._word_pattern(k) for k in (kind, ascii_kind))

    @staticmethod
    def _word_pattern(kind: dict[str, str]) -> re.Pattern:
        letter, number, space = kind["L"], kind["N"], kind["S"]
        return re.compile(
            rf" ?[{letter}]+| ?[{number}]+|'(?:[stmd]|re|ve|ll)| ?[^{letter}{number}{space}]+"
            rf"|[{space}]+(?![^{space}])|[{space}]+"
        )

    def _plain(self, text: str) -> list[str]:
        return (self.ascii_words if text.isascii() else self.any_words).findall(text)

    def split(self, text: str) -> list[str]:
        """The words of a text; together they are the text. An added token is a word, which no plain word equals."""
        if self.marks is None or self.marks.search(text) is None:
            return self._plain(text)
        words: list[str] = []
        for part in self.marks.split(text):
            words += [part] if part in self.added else self._plain(part)
        return words

    def encode_word(self, word: str) -> list[int]:
        """Ids of a word: again and again the adjacent pair of lowest rank is joined, leftmost first."""
        if word in self.added:
            return [self.added[word]]
        ids = [self.first[b] for b in word.encode("utf-8", "replace")]
        return self._merge_short(ids) if len(ids) <= SHORT else self._merge_long(ids)

    def _merge_short(self, ids: list[int]) -> list[int]:
        rank_of, never = self.ranks.get, len(self.merged)
        ranks = [rank_of(pair, never) for pair in zip(ids, ids[1:])]
        while ranks and (best := min(ranks)) < never:
            at = ranks.index(best)
            ids[at : at + 2] = [self.merged[best]]
            del ranks[at]
            if at:
                ranks[at - 1] = rank_of((ids[at - 1], ids[at]), never)
            if at < len(ranks):
                ranks[at] = rank_of((ids[at], ids[at + 1]), never)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """As above by a heap of pairs and links between neighbours, so a text without any space is no trouble."""
        ranks, size = self.ranks, len(ids)
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        heap = [(ranks[pair], i, *pair) for i, pair in enumerate(zip(ids, ids[1:])) if pair in ranks]
        heapq.heapify(heap)
        while heap:
            rank, i, left, right = heapq.heappop(heap)
            j = after[i]
            if ids[i] != left or j >= size or ids[j] != right:
                continue  # one of the two has been joined otherwise
            ids[i], ids[j] = self.merged[rank], -1
            after[i] = k = after[j]
            if k < size:
                before[k] = i
            for a, b in ((before[i], i), (i, k)):
                if a >= 0 and b < size and (pair := (ids[a], ids[b])) in ranks:
                    heapq.heappush(heap, (ranks[pair], a, *pair))
        return [i for i in ids if i >= 0]


@lru_cache(maxsize=4)
def byte_bpe(path: str, special: bool = True) -> ByteBpe:
    return ByteBpe(path, special)


def piece_table(spark, path: str | None = None) -> DataFrame:
    """(id, piece): the bytes of every id. As many rows as the vocabulary has, whatever the corpus holds."""
    rows = [(i, bytearray(raw)) for i, raw in sorted(byte_bpe(path or default_path()).raw.items())]
    return spark.createDataFrame(rows, "id int, piece binary")


def decode_ids(tokens: DataFrame, key: str, path: str | None = None, ids: str = "ids") -> DataFrame:
    """(key, decoded): the bytes that the ids of each row stand for, through a join with the table of pieces.

    ``key`` must tell the rows apart. Ids that the vocabulary lacks stand for nothing; a row without ids gives no bytes.
    The table of pieces is broadcast, as its size is that of the vocabulary.
    """
    pieces = F.broadcast(piece_table(tokens.sparkSession, path).select("id", F.hex("piece").alias("piece")))
    placed = tokens.select(key, F.posexplode_outer(ids).alias("at", "id"))
    joined = placed.join(pieces, "id", "left").groupBy(key)
    in_order = F.sort_array(F.collect_list(F.struct("at", F.coalesce("piece", F.lit("")).alias("piece"))))
    hexed = F.array_join(F.transform(in_order, lambda x: x["piece"]), "")
    return joined.agg(F.unhex(hexed).alias("decoded"))


#: Words are short, and their rows are many.
WORDS_PER_BATCH = 4096
#: Bytes of words of a bucket of the table of words, counted once per chunk that has the word.
BUCKET_BYTES = 1 << 22
_PACKED = "struct<count:bigint,length:bigint,sizes:binary,body:binary>"


class WordChunks:
    """Chunks of words: ids of the documents, their numbers of words, packed places of the words, distinct words."""

    SCHEMA = f"doc_ids array<bigint>, sizes array<bigint>, places binary, words {_PACKED}"

    def __init__(self, path: str):
        self.cut = byte_bpe(path).split

    def row(self, ids: list, texts: list[np.ndarray], strings: list[str]) -> dict:
        places, order = by_frequency(np.concatenate(texts), len(strings))
        words = pack_strings([strings[i] for i in order.tolist()])
        return {"doc_ids": ids, "sizes": [len(t) for t in texts], "places": pack(places), "words": words}

    def last(self) -> None:
        return None


def _buckets_of(words: list[bytes], buckets: int) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, words), np.uint32, len(words)) % buckets


def _deal(chunks: DataFrame, buckets: int) -> DataFrame:
    """(bucket, chunk, words): the words of a chunk that belong to a bucket, in the order of their places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = unpack_strings(packed)
                of = _buckets_of(words, buckets)
                order = np.argsort(of, kind="stable")
                cells = slices(order, np.bincount(of, minlength=buckets))
                found = [(b, pack_strings([words[i].decode() for i in own])) for b, own in enumerate(cells) if len(own)]
                for at in range(0, len(found), ROWS_PER_BATCH):
                    part = found[at : at + ROWS_PER_BATCH]
                    columns = [[b for b, _ in part], [chunk] * len(part), [w for _, w in part]]
                    yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(columns, arrow)], schema=arrow)

    arrow = pa.schema(
        [
            ("bucket", pa.int64()),
            ("chunk", pa.int64()),
            ("words", pa.struct([("count", pa.int64()), ("length", pa.int64()), ("sizes", pa.binary()), ("body", pa.binary())])),
        ]
    )
    return chunks.select("chunk", "words").mapInArrow(run, f"bucket bigint, chunk bigint, words {_PACKED}")


def word_table(dealt: DataFrame, path: str) -> DataFrame:
    """The table of distinct words, bucket by bucket: each word with its number and ids, and behind them the chunks.

    A row of a chunk names the words it has by their numbers. A word has one place per chunk that has it,
    and so a frequent one is no hot key of the size of the corpus.
    """

    def table_of(rows: pa.Table) -> pa.Table:
        encode = byte_bpe(path).encode_word
        number: dict[bytes, int] = {}
        chunks = []
        for row in rows.select(["chunk", "words"]).to_pylist():
            words = unpack_strings(row["words"])
            places = [number.setdefault(w, len(number)) for w in words]
            chunks.append({"chunk": row["chunk"], "count": len(places), "members": pack(np.array(places))})
        bucket = rows.column("bucket")[0].as_py()
        words = [{"number": i, "word": w, "ids": encode(w.decode())} for w, i in number.items()]
        return pa.Table.from_pylist([{"bucket": bucket, **row} for row in words + chunks], schema=arrow)

    arrow = pa.schema(
        [
            ("bucket", pa.int64()),
            ("number", pa.int32()),
            ("word", pa.binary()),
            ("ids", pa.list_(pa.int32())),
            ("chunk", pa.int64()),
            ("count", pa.int64()),
            ("members", pa.binary()),
        ]
    )
    schema = "bucket bigint, number int, word binary, ids array<int>, chunk bigint, count bigint, members binary"
    return dealt.groupBy("bucket").applyInArrow(table_of, schema)


_BACK = "chunk bigint, bucket bigint, count bigint, total bigint, sizes binary, ids binary, odd_at array<int>, odd array<binary>"


def decode_table(table: DataFrame, path: str) -> DataFrame:
    """What a chunk gets back from a bucket: ids of its words, and bytes of their pieces where these aren't the word.

    The bytes come from a join of the ids with the table of pieces. Neither the unfolding of ids nor a broadcast join
    moves rows, so the pieces of a word arrive one after the other, before the chunks; that they do is checked.
    """
    pieces = F.broadcast(piece_table(table.sparkSession, path))
    first = F.coalesce(F.col("pos"), F.lit(0)) == 0
    unfolded = table.select("*", F.posexplode_outer("ids").alias("pos", "id"))
    joined = unfolded.join(pieces, "id", "left").select(
        "id", "pos", "piece", "bucket", "number", *[F.when(first, F.col(c)).alias(c) for c in ("word", "chunk", "count", "members")]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[list[int]] = []
        raw: list[list[bytes]] = []
        words: list[bytes] = []
        for batch in batches:
            out = []
            columns = (batch.column(c).to_pylist() for c in range(9))
            for i, pos, piece, bucket, number, word, chunk, count, members in zip(*columns):
                if chunk is not None:
                    own = unpack(members, count).tolist()
                    found = [ids[n] for n in own]
                    flat = np.array([i for f in found for i in f], np.int64)
                    decoded = [b"".join(raw[n]) for n in own]
                    odd = [at for at, (n, d) in enumerate(zip(own, decoded)) if d != words[n]]
                    sizes = pack(np.fromiter(map(len, found), np.int64, count))
                    out.append((chunk, bucket, count, len(flat), sizes, pack(flat), odd, [decoded[at] for at in odd]))
                    continue
                if pos == 0:
                    if number == 0:
                        ids, raw, words = [], [], []
                    ids.append([])
                    raw.append([])
                    words.append(word)
                if number != len(ids) - 1 or pos != len(ids[-1]):
                    raise ValueError("the pieces of a word are out of order")
                ids[-1].append(i)
                raw[-1].append(piece or b"")
            columns = list(zip(*out)) or [()] * len(arrow)
            yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(columns, arrow)], schema=arrow)

    arrow = pa.schema(
        [
            *[(c, pa.int64()) for c in ("chunk", "bucket", "count", "total")],
            ("sizes", pa.binary()),
            ("ids", pa.binary()),
            ("odd_at", pa.list_(pa.int32())),
            ("odd", pa.list_(pa.binary())),
        ]
    )
    return joined.mapInArrow(run, _BACK)


def encode_documents(
    docs: DataFrame,
    path: str | None = None,
    keep_ids: bool = False,
    doc_id: str = "doc_id",
    text: str = "text",
    chunk_chars: int = CHUNK_CHARS,
) -> DataFrame:
    """One row per row of ``docs``: its ids counted and hashed, and the hash of the text decoded from them.

    ``path`` names the file, which every executor must have; ``keep_ids`` adds the ids and the decoded
    text. A null or empty text has no ids and decodes to nothing. Repeated rows each get their own row;
    a null id stays null; an empty table gives no rows. Strings of added tokens are encoded as these.
    """
    path = path or default_path()
    cut = map_chunks(docs, lambda: WordChunks(path), WordChunks.SCHEMA, doc_id, text, chunk_chars)
    chunks = stored_by(cut, "bpe-chunks", "chunk")
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", WORDS_PER_BATCH)
    buckets = max(1, (chunks.agg(F.sum("words.length")).first()[0] or 0) // BUCKET_BYTES)
    back = decode_table(word_table(_deal(chunks, buckets), path), path)
    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    kinds = docs.sparkSession.createDataFrame([], schema + (", ids array<bigint>, decoded string" if keep_ids else "")).schema

    def assemble(chunk: pa.Table, found: pa.Table) -> pa.Table:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(kinds)
        back = found.sort_by("bucket").to_pylist()
        out: dict[str, list] = {name: [] for name in arrow.names}
        for row in chunk.to_pylist():  # one
            out["doc_id"] += row["doc_ids"]
            words = unpack_strings(row["words"])
            order = np.argsort(_buckets_of(words, buckets), kind="stable").tolist()
            raw, ids, at = list(words), [b""] * len(words), 0
            for cell in back:
                own = order[at : at + cell["count"]]
                at += cell["count"]
                flat = unpack(cell["ids"], cell["total"]).astype("<u4")
                for place, part in zip(own, slices(flat, unpack(cell["sizes"], cell["count"]))):
                    ids[place] = part.tobytes()
                for odd, decoded in zip(cell["odd_at"], cell["odd"]):
                    raw[own[odd]] = decoded
            places = unpack(row["places"], sum(row["sizes"]))
            for own in slices(places, row["sizes"]):
                at = own.tolist()
                data = b"".join([ids[i] for i in at])
                decoded = b"".join([raw[i] for i in at])
                try:
                    decoded.decode("utf-8")
                except UnicodeDecodeError:
                    decoded = decoded.decode("utf-8", "replace").encode()
                out["n_tokens"].append(len(data) // 4)
                out["ids_sha256"].append(hashlib.sha256(data).hexdigest())
                out["decoded_sha256"].append(hashlib.sha256(decoded).hexdigest())
                if keep_ids:
                    out["ids"].append(np.frombuffer(data, "<u4").tolist())
                    out["decoded"].append(decoded.decode("utf-8"))
        return pa.table([pa.array(out[f.name], f.type) for f in arrow], schema=arrow)

    texts = chunks.select(F.col("chunk").alias("of"), "doc_ids", "sizes", "places", "words")
    return texts.groupBy("of").cogroup(back.groupBy("chunk")).applyInArrow(assemble, kinds)
