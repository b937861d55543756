"""Byte-level BPE through the table of words, and the alignment of two tokenizers."""

import hashlib
import inspect
import random
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from sitepulse.llm import alignment, bpe, chunks, pieces

ODD = [(1, None), (2, ""), (3, " \n\t "), (None, "one two three"), (5, "a"), (5, "a"), (6, "word. " * 60_000), (7, "x" * 50_000)]
STRANGE = "aZ é́ß1²½٣ \t\r\n  　'’sS,.!?#▁–日本語กำ🙂‍\U0001f1e9\U000105c0Ɤ\x1c\x00"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(bpe.default_path())


def digest(ids):
    return hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()


def strange_texts(count, size, seed):
    rnd = random.Random(seed)
    marks = ["'s", "'ll", "'re", "<|endoftext|>", "  ", " the", "2024", "ing"]
    return ["".join(rnd.choice(STRANGE) if rnd.random() < 0.7 else rnd.choice(marks) for _ in range(rnd.randint(0, size))) for _ in range(count)]


def test_words_and_ids_equal_the_library(library):
    model = bpe.byte_bpe(bpe.default_path())
    for text in strange_texts(2_000, 40, 1):
        words = model.split(text)
        assert "".join(words) == text
        ids = [i for w in words for i in model.encode_word(w)]
        assert ids == library.encode(text, add_special_tokens=False).ids


def test_every_character_falls_into_the_class_of_the_library(library):
    """In 16 characters at a time, each between a letter, a number and a mark, so that its class shows in the cuts."""
    model = bpe.byte_bpe(bpe.default_path())
    codes = [c for c in range(0x34000) if not 0xD800 <= c < 0xE000] + list(range(0xE0000, 0xE0200))
    for at in range(0, len(codes), 4096):
        text = "".join(f"a{chr(c)}1{chr(c)}!{chr(c)}" for c in codes[at : at + 4096])
        cuts, end = [], 0
        for word in model.split(text):
            end += len(word)
            cuts.append(end)
        assert cuts == [b for _, (_, b) in library.pre_tokenizer.pre_tokenize_str(text)]


def test_long_words_merge_as_short_ones():
    model, rnd = bpe.byte_bpe(bpe.default_path()), random.Random(2)
    for _ in range(200):
        ids = [model.first[b] for b in "".join(rnd.choice("aeinrst") for _ in range(rnd.randint(1, 120))).encode()]
        assert model._merge_long(list(ids)) == model._merge_short(list(ids))


@pytest.mark.parametrize("chunk_chars", [1, 50, chunks.CHUNK_CHARS])
def test_bpe_documents_equal_the_library(documents, library, chunk_chars):
    rows = [(i, t) for i, t in enumerate(strange_texts(60, 60, 3))] + [(1000, "same text"), (1000, "same text")]
    found = bpe.encode_documents(documents(*rows), keep_ids=True, chunk_chars=chunk_chars).collect()
    assert sorted(r["doc_id"] for r in found) == sorted(i for i, _ in rows)
    texts = dict(rows)
    for row in found:
        ids = library.encode(texts[row["doc_id"]], add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert (row["ids"], row["n_tokens"], row["ids_sha256"]) == (ids, len(ids), digest(ids))
        assert row["decoded"] == decoded
        assert row["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()


def test_bpe_of_odd_rows(documents, library):
    found = bpe.encode_documents(documents(*ODD)).collect()
    texts = {i: t or "" for i, t in ODD}
    assert len(found) == len(ODD)
    for row in found:
        ids = library.encode(texts[row["doc_id"]], add_special_tokens=False).ids
        assert (row["n_tokens"], row["ids_sha256"]) == (len(ids), digest(ids))
    assert bpe.encode_documents(documents(*ODD).where("false")).count() == 0


def test_decoding_any_ids(spark, library):
    rnd = random.Random(4)
    rows = [(i, [rnd.randrange(50_257) for _ in range(rnd.randint(0, 30))]) for i in range(40)] + [(99, None)]
    found = {r["k"]: r["decoded"] for r in bpe.decode_ids(spark.createDataFrame(rows, "k int, ids array<int>"), "k").collect()}
    for key, ids in rows:
        assert bytes(found[key]).decode("utf-8", "replace") == library.decode(ids or [], skip_special_tokens=False)


def plain_alignment(rows):
    """The contract's words: byte offsets of the tokens of whole texts, overlaps, counts over all rows."""
    a = Tokenizer.from_file(bpe.default_path())
    a.encode_special_tokens = True
    raw_a = bpe.byte_bpe(bpe.default_path()).raw
    b = sentencepiece.SentencePieceProcessor(model_file=pieces.default_path())

    def bytes_b(i):
        piece = b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()

    made = []
    for key, text in rows:
        ids_a = a.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        body = (" " + text).encode() if text else b""
        tokens_a, tokens_b = [raw_a[i] for i in ids_a], [bytes_b(i) for i in ids_b]
        if b"".join(tokens_a) != body or b"".join(tokens_b) != body:
            ids_a, ids_b, tokens_a, tokens_b = [], [], [], []
        ends_a, ends_b = np.cumsum([0] + [len(t) for t in tokens_a]), np.cumsum([0] + [len(t) for t in tokens_b])
        both = [x for x in ends_a[1:].tolist() if x in set(ends_b[1:].tolist())]
        groups, start = [], 0
        for end in both:
            parts = [
                ",".join(str(i) for i, s, e in zip(ids, ends, ends[1:]) if start <= s and e <= end)
                for ids, ends in ((ids_a, ends_a), (ids_b, ends_b))
            ]
            groups.append("|".join(parts))
            start = end
        links = [
            (i, j)
            for i, s, e in zip(ids_a, ends_a, ends_a[1:])
            for j, t, f in zip(ids_b, ends_b, ends_b[1:])
            if s < f and t < e
        ]
        made.append((key, len(ids_a), len(ids_b), groups, links))
    count = Counter(pair for *_, links in made for pair in set(links))
    best = {}
    for (i, _), n in count.items():
        best[i] = max(best.get(i, 0), n)
    return count, [
        {
            "doc_id": key,
            "n_a": n_a,
            "n_b": n_b,
            "n_groups": len(groups),
            "n_links": len(links),
            "n_best": sum(count[p] == best[p[0]] for p in links),
            "count_sum": sum(count[p] for p in links),
            "groups_sha256": hashlib.sha256(";".join(groups).encode()).hexdigest() if n_a else "",
        }
        for key, n_a, n_b, groups, links in made
    ]


def sorted_rows(rows):
    return sorted(rows, key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["groups_sha256"]))


@pytest.mark.parametrize("chunk_chars", [1, 120, chunks.CHUNK_CHARS])
def test_alignment_equals_plain_overlaps(documents, chunk_chars):
    texts = strange_texts(40, 50, 5) + [t.replace("▁", "") for t in strange_texts(60, 60, 6)]
    texts += ["The quick brown fox. Straßenbahn, " * k for k in range(1, 6)] + ["aaaaaaa aaaaa\n\n\nx   y", "<|endoftext|> a </s>"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(500, "same text"), (500, "same text"), (None, "no id"), (501, None), (502, "")]
    count, expected = plain_alignment([(i, t or "") for i, t in rows])
    found = [r.asDict() for r in alignment.align_documents(documents(*rows), chunk_chars=chunk_chars).collect()]
    assert sorted_rows(found) == sorted_rows(expected)
    if chunk_chars == 120:
        pairs = alignment.pair_counts(documents(*rows), chunk_chars=chunk_chars).collect()
        assert {(r["id_a"], r["id_b"]): r["documents"] for r in pairs} == count


def test_alignment_of_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r["doc_id"], r["text"] or "") for r in docs.collect() if len(r["text"] or "") < 3_000]
    short = docs.where("coalesce(length(text), 0) < 3000")
    _, expected = plain_alignment(rows)
    found = [r.asDict() for r in alignment.align_documents(short).collect()]
    assert sorted_rows(found) == sorted_rows(expected)


def test_alignment_of_odd_rows(documents):
    found = alignment.align_documents(documents(*ODD)).collect()
    assert len(found) == len(ODD)
    assert all((r["n_links"], r["groups_sha256"]) == (0, "") for r in found if r["doc_id"] in (1, 2))
    assert all(r["n_links"] for r in found if r["doc_id"] not in (1, 2))
    assert alignment.align_documents(documents(*ODD).where("false")).count() == 0


def test_segments_of_pieces_are_kept_longer_and_encoded_whole():
    model = pieces.piece_model(pieces.default_path())
    assert model.segments.size > pieces.CACHE_BYTES
    rng = random.Random(4)
    known = sorted(c for c in model.single if c.isalpha())[:60]
    for _ in range(300):
        text = pieces.SPACE + "".join(rng.choices(known, k=rng.randint(1, 14)))
        assert model.backtrack(text) == model.merge(text)
        assert pieces.unpacked(model._encode_segment(text)).tolist() == model.merge(text)


def test_links_of_a_chunk_are_held_for_fewer_characters():
    assert inspect.signature(alignment.align_documents).parameters["chunk_chars"].default <= 1 << 22
