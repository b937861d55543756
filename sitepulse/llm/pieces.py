"""Merge-type piece encoding by backtracking, and decoding."""

from __future__ import annotations

import hashlib
import re
import sys
from array import array
from functools import lru_cache

import ahocorasick
from pyspark.sql import DataFrame

from sitepulse.llm.common import map_batches

SPACE = "▁"
#: Bytes of a cache; two generations of it are kept, so a worker's memory is bounded.
CACHE_BYTES = 16 << 20
#: The same for the encoded segments of a piece model, which cost most to make anew.
SEGMENT_BYTES = 48 << 20
#: Entries of more bytes are made each time anew; what a dictionary needs for an entry besides key and value.
LARGE_ENTRY, ENTRY_BYTES = 4096, 100
#: Segments of so many known characters are encoded whole; longer ones are cut first.
WHOLE = 64
_NORMAL, _CONTROL, _BYTE = 1, 3, 6


class Memo(dict):
    """A mapping of bounded bytes: when it is full, the older half is forgotten; large entries are never kept."""

    def __init__(self, make, size: int = CACHE_BYTES):
        super().__init__()
        self.make, self.size, self.held, self.older = make, size, 0, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        needs = sys.getsizeof(key) + sys.getsizeof(value) + ENTRY_BYTES
        if needs > LARGE_ENTRY:
            return value
        if self.held + needs > self.size:
            self.older = dict(self)
            self.clear()
            self.held = 0
        self[key] = value
        self.held += needs
        return value


class PieceModel:
    """Encodes and decodes as the sentencepiece library does with a BPE model with byte fallback.

    A sequence of pieces is the encoding of its text exactly if every piece is the encoding of its
    own text and every two adjacent pieces are the encoding of theirs: the first merge that crossed
    a border in the whole text would cross it in the text of the two pieces as well. So the encoder
    takes the longest matching piece, checks it against the piece before, falls back to shorter
    ones, and steps back where none fits; positions from which nothing fits are remembered as bits.
    """

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        normal = model.normalizer_spec
        if model.trainer_spec.model_type != 2 or normal.name != "identity" or normal.remove_extra_whitespaces:
            raise ValueError("the model must be of merge type, without normalization of the text")
        self.prefix = SPACE if normal.add_dummy_prefix else ""
        kinds = [p.type for p in model.pieces]
        self.begin, self.end = (next(i for i, p in enumerate(model.pieces) if p.piece == s) for s in ("<s>", "</s>"))
        self.bytes = {int(p.piece[3:5], 16): i for i, p in enumerate(model.pieces) if p.type == _BYTE}
        self.control = frozenset(i for i, k in enumerate(kinds) if k == _CONTROL)
        self.byte_ids = frozenset(self.bytes.values())
        self.text = [p.piece if k == _NORMAL else "" for p, k in zip(model.pieces, kinds)]
        self.ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type == _NORMAL}
        self.score = [p.score for p in model.pieces]
        byte_of = {i: b for b, i in self.bytes.items()}
        self.raw = [
            bytes([byte_of[i]]) if k == _BYTE else b" \xe2\x81\x87 " if k == 2 else t.replace(SPACE, " ").encode()
            for i, (k, t) in enumerate(zip(kinds, self.text))
        ]
        self.follows = {pair for piece in self.ids for pair in zip(piece, piece[1:])}
        self.automaton = ahocorasick.Automaton()
        for piece, i in self.ids.items():
            if self.merge(piece) == [i]:  # others never come out of merging
                self.automaton.add_word(piece, (len(piece), i))
        self.automaton.make_automaton()
        #: Characters that are pieces themselves.
        self.single = frozenset(p for p in self.ids if len(p) == 1)
        self.fits = Memo(self._fits)
        self.segments = Memo(self._encode_segment, SEGMENT_BYTES)
        self.split = re.compile(self._segment_pattern())

    def _segment_pattern(self) -> str:
        """Runs of letters and runs of others, each with the spaces before it.

        Characters that some piece joins across that border count as others, so no piece crosses a cut.
        """
        others: set[str] = {SPACE}

        def letter(c: str) -> bool:
            return c not in others and bool(re.match(r"[^\W\d_]", c))

        grown = True
        while grown:
            grown = False
            for c, d in self.follows:
                if SPACE not in (c, d) and letter(c) != letter(d):
                    others.add(c if letter(c) else d)
                    grown = True
        if any(d == SPACE and c != SPACE for c, d in self.follows):
            return r"(?s).+"
        no = re.escape("".join(sorted(others - {SPACE})))
        letters = rf"[^\W\d_{no}]"
        return rf"{SPACE}*(?:{letters}+|(?:(?!{letters})[^{SPACE}])+)|{SPACE}+"

    def merge(self, text: str) -> list[int]:
        """Encoding by its definition: again and again join the adjacent pair of the best piece, leftmost first."""
        parts = list(text)
        ids, score = self.ids, self.score
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                piece = ids.get(parts[i] + parts[i + 1])
                if piece is not None and (best is None or score[piece] > best):
                    best, at = score[piece], i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [ids.get(p, -1) for p in parts]

    def _fits(self, pair: int) -> bool:
        left, right = pair >> 32, pair & 0xFFFFFFFF
        return self.merge(self.text[left] + self.text[right]) == [left, right]

    def backtrack(self, text: str) -> list[int]:
        """Encoding of a text of known characters."""
        size = len(text)
        matches = list(self.automaton.iter(text))
        longest: list[tuple[int, int]] = [(0, -1)] * size
        for end, match in matches:
            longest[end + 1 - match[0]] = match  # rising in length, as ends rise
        out: list[int] = []
        at, last, fits = 0, -1, self.fits
        while at < size:  # mostly the longest match fits everywhere
            length, piece = longest[at]
            if piece < 0 or (last >= 0 and not fits[last << 32 | piece]):
                return self._step_back(text, matches, out, at)
            out.append(piece)
            at, last = at + length, piece
        return out

    def _step_back(self, text: str, matches: list[tuple[int, tuple[int, int]]], out: list[int], at: int) -> list[int]:
        """Encoding of a text whose longest matches ``out`` reach ``at``, where the longest one doesn't fit."""
        size = len(text)
        starts: list[list[tuple[int, int]]] = [[] for _ in range(size)]
        for end, match in matches:
            starts[end + 1 - match[0]].append(match)
        taken: list[int] = []  # index of the match taken at each start
        begin = 0
        for piece in out:
            taken.append(len(starts[begin]) - 1)
            begin += len(self.text[piece])
        failed = bytearray((size >> 3) + 1)  # bit p: no encoding goes on from p
        choice, fits = len(starts[at]) - 1, self.fits
        while at < size:
            options = starts[at]
            last = out[-1] << 32 if out else -1
            while choice >= 0:
                length, piece = options[choice]
                end = at + length
                if not failed[end >> 3] >> (end & 7) & 1 and (last < 0 or fits[last | piece]):
                    break
                choice -= 1
            if choice >= 0:
                out.append(piece)
                taken.append(choice)
                at += length
                choice = len(starts[at]) - 1 if at < size else -1
            else:
                if not out:
                    raise ValueError(f"no encoding of {text!r}")
                failed[at >> 3] |= 1 << (at & 7)
                at -= len(self.text[out.pop()])
                choice = taken.pop() - 1
        return out

    def _encode_segment(self, segment: str) -> bytes:
        """Ids as little-endian 32-bit integers; cut wherever no piece has the two characters in a row."""
        if len(segment) <= WHOLE and self.single.issuperset(segment):
            return _packed(self.backtrack(segment))
        ids: list[int] = []
        known, follows, first = self.ids, self.follows, 0
        for i in range(1, len(segment) + 1):
            if i == len(segment) or (segment[i - 1], segment[i]) not in follows:
                part = segment[first:i]
                first = i
                if part in known and len(part) == 1:
                    ids.append(known[part])
                elif len(part) == 1:
                    ids.extend(self.bytes[b] for b in part.encode("utf-8", "replace"))
                else:
                    ids.extend(self.backtrack(part))
        return _packed(ids)

    def encode(self, text: str) -> bytes:
        """All ids with begin and end, as little-endian unsigned 32-bit integers."""
        marked = self.prefix + text.replace(" ", SPACE) if text else ""
        segments = self.segments
        return b"".join(
            [_packed([self.begin]), *[segments[s] for s in self.split.findall(marked)], _packed([self.end])]
        )

    def decode(self, ids) -> str:
        """The text of ids; begin and end give nothing, and the space that encoding put first goes."""
        raw = self.raw
        data = b"".join([raw[i] for i in ids])
        first = next((i for i in ids if i not in self.control), None)
        if self.prefix and first is not None and self.text[first].startswith(SPACE):
            data = data[1:]
        try:
            return data.decode("utf-8")
        except UnicodeDecodeError:
            return self._decode_broken(ids)

    def _decode_broken(self, ids) -> str:
        """As ``decode``, with a replacement mark for every byte that belongs to no character."""
        out: list[str] = []
        run = bytearray()
        seen = False

        def flush() -> None:
            at = 0
            while at < len(run):
                for size in (1, 2, 3, 4):
                    try:
                        out.append(bytes(run[at : at + size]).decode("utf-8"))
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    size = 1
                    out.append("�")
                at += size
            run.clear()

        for i in ids:
            if i in self.byte_ids:
                run += self.raw[i]
                continue
            flush()
            piece = self.raw[i].decode("utf-8")
            if self.prefix and not seen and not out and self.text[i].startswith(SPACE):
                piece, seen = piece[1:], True
            if piece:
                out.append(piece)
        flush()
        return "".join(out)


def _packed(ids: list[int]) -> bytes:
    packed = array("I", ids)
    if sys.byteorder == "big":
        packed.byteswap()
    return packed.tobytes()


def unpacked(data: bytes) -> array:
    ids = array("I")
    ids.frombytes(data)
    if sys.byteorder == "big":
        ids.byteswap()
    return ids


@lru_cache(maxsize=2)
def piece_model(path: str) -> PieceModel:
    return PieceModel(path)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


SCHEMA = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"


def encode_documents(
    docs: DataFrame, path: str | None = None, keep_ids: bool = False, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: its ids counted and hashed, and the hash of the text decoded from them.

    ``path`` names the model, which every executor must have; ``keep_ids`` adds the ids and the
    decoded text. A null or empty text has only the begin and end ids and decodes to nothing. Repeated
    rows each get their own row; a null id stays null.
    """
    path = path or default_path()

    def work(rows: dict) -> dict:
        model = piece_model(path)
        out: dict[str, list] = {"doc_id": rows["doc_id"], "n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
        if keep_ids:
            out |= {"ids": [], "decoded": []}
        for text in rows["text"]:
            data = model.encode(text or "")
            ids = unpacked(data)
            decoded = model.decode(ids)
            out["n_tokens"].append(len(ids))
            out["ids_sha256"].append(hashlib.sha256(data).hexdigest())
            out["decoded_sha256"].append(hashlib.sha256(decoded.encode("utf-8")).hexdigest())
            if keep_ids:
                out["ids"].append(ids.tolist())
                out["decoded"].append(decoded)
        return out

    return map_batches(
        docs.selectExpr(f"cast(`{doc_id}` as bigint) doc_id", f"cast(`{text}` as string) text"),
        work,
        SCHEMA + (", ids array<bigint>, decoded string" if keep_ids else ""),
    )
