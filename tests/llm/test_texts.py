"""Operators that judge one text at a time: quality, licences, pieces, secrets."""

import hashlib
import random
import re

import numpy as np
import pytest
import sentencepiece

from sitepulse.llm import license, pieces, quality, secrets

ODD = [(1, None), (2, ""), (3, " \n\t "), (None, "one two three"), (5, "a"), (5, "a"), (6, "word. " * 60_000)]


@pytest.mark.parametrize("run", [quality.clean_lines, license.scan_licenses, pieces.encode_documents, secrets.scan_secrets])
def test_odd_rows_and_empty_tables(documents, run):
    rows = run(documents(*ODD)).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in rows) == sorted((i is None, i or 0) for i, _ in ODD)
    assert run(documents(*ODD).where("false")).count() == 0


def test_base_counts_of_quality():
    text = "a b c\n\na b c\n# one|two\n a b c\n"
    found = quality.judge_text(text)
    assert found["n_words"] == 11
    assert found["word_chars"] == 9 + 8
    assert found["n_symbols"] == 2
    assert found["n_dup_lines"] == 1
    assert found["n_repeat_words"] == 9
    assert found["base_failed"] and not found["kept"]


def test_repeated_words_against_all_pairs():
    rnd = random.Random(3)
    for _ in range(200):
        words = [rnd.choice("abc") for _ in range(rnd.randint(0, 25))]
        windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
        covered = {i + j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(3)}
        assert quality.repeated_words(words) == len(covered)


def test_line_rules_decide_what_stays():
    good = " ".join(f"word{i}" for i in range(60)) + "."
    nav = "Home | News | Sport | About | Contact us"
    found = quality.judge_text(f"{good}\n{nav}\nRead more\n")
    assert found["kept"] and found["removed_lines"] == 2
    assert found["cleaned"] == f"{good}\n"
    many = "\n".join(f"menu{i} | item{i} | link{i} | page{i}" for i in range(30))
    assert not quality.judge_text(f"{good}\n{many}")["kept"]


@pytest.mark.parametrize(
    "text, postfix, usable",
    [
        ("mit", "mit", True),
        ("mit or gpl-3.0-only", "mit gpl-3.0-only or", True),
        ("mit and gpl-3.0-only", "mit gpl-3.0-only and", False),
        ("gpl-2.0-only or mit and isc", "gpl-2.0-only mit isc and or", True),
        ("(gpl-2.0-only or mit) and lgpl-2.1-only", "gpl-2.0-only mit or lgpl-2.1-only and", False),
        ("apache-2.0 with llvm-exception */", "apache-2.0 llvm-exception with", True),
        ("mit and", None, None),
        ("or mit", None, None),
        ("(mit", None, None),
        ("", None, None),
    ],
)
def test_licence_expressions(text, postfix, usable):
    found = license.parse_expression(text)
    assert (" ".join(found) if found else None) == postfix
    if found:
        assert license.evaluate_expression(found) == usable


def test_licence_places_against_a_plain_search():
    rnd = random.Random(5)
    vocabulary = "under the mit license apache version 2 cc by nc and Ä-b".split()
    for _ in range(300):
        text = " ".join(rnd.choice(vocabulary).upper() if rnd.random() < 0.2 else rnd.choice(vocabulary) for _ in range(30))
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.encode().lower().decode())
        places = [
            (i, label)
            for phrase, label in license.BASE_PHRASES.items()
            for i in range(len(words))
            if words[i : i + len(phrase.split())] == phrase.split()
        ]
        found = license.scan_text(text)
        assert found["n_words"] == len(words)
        assert found["n_base"] == len(places)
        assert found["first_word"] == min((i for i, _ in places), default=None)
        assert found["last_word"] == max((i for i, _ in places), default=None)
        assert found["base_labels"] == ",".join(sorted({x for _, x in places}))


def test_licence_tags_add_labels():
    found = license.scan_text("// SPDX-License-Identifier: MIT OR (GPL-2.0-only WITH Classpath-exception-2.0)\ncode")
    assert found["labels"] == "gpl-2.0-only,mit"
    assert found["base_labels"] == "" and found["permissive"] and 0 < found["score"] <= 1
    assert license.scan_text("nothing here")["score"] == 0


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=pieces.default_path())


def test_pieces_equal_the_library(library):
    model = pieces.piece_model(pieces.default_path())
    rnd = random.Random(7)
    texts = ["", " ", "  a  b", "\n\t", "▁ ▁▁x", "日本 text 😀", "m²..²", "aaaa" * 40, "<s> </s> <0x0A>", "\x00\x7f"]
    texts += ["".join(rnd.choice("abetionrs  .,ñéß12²日▁\n") for _ in range(rnd.randint(1, 60))) for _ in range(1500)]
    for text in texts:
        ids = library.encode(text, add_bos=True, add_eos=True)
        assert list(pieces.unpacked(model.encode(text))) == ids
        assert model.decode(ids) == library.decode(ids)


def test_decoding_any_ids_equals_the_library(library):
    model = pieces.piece_model(pieces.default_path())
    rnd = random.Random(8)
    for _ in range(1500):
        ids = [rnd.choice([rnd.randrange(32_000), rnd.randrange(260), 29871, 13]) for _ in range(rnd.randint(0, 12))]
        assert model.decode(ids) == library.decode(ids)


def test_small_caches_give_the_same_pieces(library):
    model = pieces.PieceModel(pieces.default_path())
    model.segments.size = model.fits.size = 3
    text = "the quick brown fox jumps over the lazy dog and the other one " * 3
    assert list(pieces.unpacked(model.encode(text))) == library.encode(text, add_bos=True, add_eos=True)


def test_pieces_of_the_given_documents(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for row in pieces.encode_documents(docs, keep_ids=True).collect():
        ids = library.encode(texts[row["doc_id"]] or "", add_bos=True, add_eos=True)
        assert row["ids"] == ids and row["n_tokens"] == len(ids)
        assert row["decoded"] == library.decode(ids)
        assert row["ids_sha256"] == hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(row["decoded"].encode()).hexdigest()


def plain_secrets(text):
    assign = r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    found = [(m.start(), 0, m.end(), "assign") for m in re.finditer(assign, text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return ",".join(f"{k}:{s}:{e}" for s, _, e, k in sorted(found))


def test_base_secrets_against_plain_patterns(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for row in secrets.scan_secrets(docs).collect():
        expected = plain_secrets(texts[row["doc_id"]])
        assert row["spans"] == expected
        assert row["base_sha256"] == hashlib.sha256(expected.encode()).hexdigest()


def test_a_failing_match_uses_up_its_characters():
    assert secrets.scan_text("secret=token:abcdefg")["spans"] == ""
    assert secrets.scan_text("pasſword=abcdefgh")["spans"] == ""
    assert secrets.scan_text('API_KEY: "abc.DEF-1"')["spans"] == "assign:0:19"
    assert secrets.scan_text("é" * 3 + "AKIA" + "A1" * 8)["spans"] == "access:3:23"


@pytest.fixture(scope="module")
def secret_model(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    return secrets.train(docs.where("doc_id % 7 <> 3"), rows=6_000)


def test_places_of_many_phrases_in_a_long_text():
    """Overlapping phrases too, and in time that grows with the text alone."""
    unit = "under the mit license x apache license version 2 cc by nc "
    found = license.scan_text(unit * 20_000)
    assert (found["n_words"], found["n_base"]) == (12 * 20_000, 3 * 20_000)
    assert (found["first_word"], found["last_word"]) == (0, 12 * 20_000 - 3)


def test_network_finds_every_kind_in_other_documents(spark, secret_model):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("doc_id % 7 = 3")
    found = {(r["label"], r["kind"]): r for r in secrets.evaluate(docs, secret_model).collect()}
    for kind in ("assign", "hex", *secrets.SECRET_SHAPES):
        assert found[1, kind]["flagged"] >= 0.93 * found[1, kind]["n"], kind
    plain = [r for (label, _), r in found.items() if not label]
    assert sum(r["flagged"] for r in plain) <= 0.05 * sum(r["n"] for r in plain)
    assert found[0, "text"]["flagged"] <= 0.01 * found[0, "text"]["n"]


def test_network_adds_spans_and_keeps_base_spans(spark, secret_model):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("doc_id % 50 = 3")
    for row in secrets.scan_secrets(docs, secret_model).join(docs, "doc_id").collect():
        base = plain_secrets(row["text"])
        assert set(filter(None, base.split(","))) <= set(filter(None, row["spans"].split(",")))
    rng = np.random.default_rng(77)
    hits = 0
    for i in range(100):
        body = secrets.made_secret(secrets.SECRET_SHAPES[i % 5], rng)
        text = f"we sent the note to them and {body} was in it, as ever."
        hits += any(p.startswith("net:29:") for p in secrets.scan_text(text, secret_model)["spans"].split(","))
    assert hits >= 90
    quiet = "The file /usr/share/doc/python3/examples was read at 2024-10-11T10-11-12Z by user_name_counter_17 again."
    assert "net" not in secrets.scan_text(quiet, secret_model)["spans"]


def test_a_candidate_beyond_a_base_span_is_judged(secret_model):
    text = "x deadbeefdeadbeefdeadbeef7XQ9zLm2Kp4Vt8RwYb3Nc6Hs y"
    spans = secrets.scan_text(text, secret_model)["spans"].split(",")
    assert "hex:2:27" in spans and f"net:2:{len(text) - 2}" in spans
    assert secrets.redact(text, ",".join(spans)) == "x [secret] y"


def test_network_learns_from_every_text(documents):
    rows = [(i, f"report {i} was sent to the {i % 7} other desks and read there by all of the staff") for i in range(60)]
    docs = documents(*rows)
    model = secrets.train(docs, rows=20)
    again = secrets.train(docs.repartition(5).union(docs), rows=20)
    assert (model.row() == again.row()).all() and (model.scale, model.threshold) == (again.scale, again.threshold)
    # Whichever text goes, the network is another one, however small the blocks are.
    for gone in (0, 17, 42):
        less = secrets.train(docs.where(f"doc_id <> {gone}"), rows=20)
        assert (less.row() != model.row()).any() or less.scale != model.scale


def test_examples_take_no_match_for_each_word_and_gap(monkeypatch):
    word = "x" * 11
    texts = ["", " \u3000\x1c", f"{word} {word}y\x85{word}zz\u2003{word}", "\ud800 \U0001f600" + "q" * 12, f"a {word}12345 b/{word}9+0 c"]
    for text in texts:
        long_words = {m[0] for m in re.finditer(r"\S{12,}", text)}
        found = {body for _, body, _, _, kind in secrets.examples(text) if kind == "text"}
        assert found == long_words | {text[a:b] for a, b in secrets.candidates(text)}

    class Counted:
        """Patterns over a whole text that were asked for one match object after the other."""

        finditer = None
        findall = staticmethod(re.findall)

    usual = [secrets.examples(text) for text in texts]
    monkeypatch.setattr(secrets, "re", Counted)
    assert [secrets.examples(text) for text in texts] == usual


def test_a_step_adds_up_what_each_character_shares_in():
    """The first step against derivatives by differences: each goes the learning rate against the sign of its derivative."""
    rng = np.random.default_rng(5)
    codes = rng.integers(40, 60, (20, secrets.LENGTH)).astype(np.uint8)
    labels = np.arange(20) % 2.0
    start, model = secrets.CharCnn(), secrets.CharCnn()
    model.fit(codes, labels, 1, rate=1.0)

    def loss(table):
        own = secrets.CharCnn()
        own.weights["table"] = table
        z = own.logits(codes)
        return float((np.logaddexp(0, z) - labels * z).mean())

    for at in [(45, 0), (52, 3), (59, 7), (40, 5)]:
        step = np.zeros_like(start.weights["table"])
        step[at] = 1e-6
        d = (loss(start.weights["table"] + step) - loss(start.weights["table"] - step)) / 2e-6
        moved = (start.weights["table"] - model.weights["table"])[at]
        assert abs(moved - d / np.sqrt(1e-2 + d * d)) < 1e-4
    assert (start.weights["table"][:40] == model.weights["table"][:40]).all()


def test_parts_show_all_of_a_candidate():
    body = "".join(chr(33 + i % 90) for i in range(301))
    seen = {bytes(p[i : i + 5]) for p in secrets.parts("left", body, "right") for i in range(secrets.SIDE, secrets.SIDE + secrets.BODY - 4)}
    assert {body[i : i + 5].encode() for i in range(len(body) - 4)} <= seen
    assert len(secrets.parts("", "a" * 20, "")) == 1


def test_redacting_odd_rows(documents):
    rows = [(1, None), (2, ""), (None, "token=abcdefgh"), (3, "token=abcdefgh"), (3, "token=abcdefgh"), (4, "x " * 90_000)]
    found = secrets.redact_documents(documents(*rows)).collect()
    assert sorted((r["doc_id"] or 0, r["text"] or "", r["n_chars"] or 0) for r in found)[:4] == [
        (0, "[secret]", 8), (1, "", 0), (2, "", 0), (3, "[secret]", 8)
    ]
    assert len(found) == 6 and secrets.redact_documents(documents(*rows).where("false")).count() == 0


def test_redaction():
    text = "x token = abcdefghij y"
    spans = secrets.scan_text(text)["spans"]
    assert secrets.redact(text, spans) == "x [secret] y"
    assert secrets.redact("abcdef", "hex:0:3,assign:2:5") == "[secret]f"
    assert secrets.redact(None, "") is None


def test_memo_is_bounded_in_bytes():
    made = []
    memo = pieces.Memo(lambda key: made.append(key) or len(key), size=10_000)
    words = [f"word{i}" for i in range(5_000)]
    assert [memo[w] for w in words] == [len(w) for w in words]
    assert len(memo) + len(memo.older) < 200 and memo.held <= 10_000
    assert memo[words[-1]] == 8 and made.count(words[-1]) == 1
    long = "x" * 100_000
    assert memo[long] == memo[long] == 100_000 and long not in memo and made.count(long) == 2
