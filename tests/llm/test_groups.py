"""Operators on many documents: near copies, vectors, repeats, archives, mixing, toxicity, pipeline."""

import collections
import hashlib
import itertools
import random
import re
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece

import corpus_pipeline
from sitepulse.llm import embedding, jaccard, learning, mixing, pieces, secrets, substring, toxicity, warc
from sitepulse.llm.catalog import TARGETS
from sitepulse.llm.common import stored

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    words = WORD.findall((text or "").encode().lower().decode())
    return {tuple(words[i : i + 3]) for i in range(len(words) - 2)} or ({tuple(words)} if words else set())


def plain_components(ids, linked):
    low = {i: i for i in ids}
    for a, b in linked:
        ra, rb = a, b
        while low[ra] != ra:
            ra = low[ra]
        while low[rb] != rb:
            rb = low[rb]
        low[max(ra, rb)] = min(ra, rb)
    out = {}
    for i in ids:
        r = i
        while low[r] != r:
            r = low[r]
        out[i] = r
    return out


def near_texts(seed, sizes=(9, 10, 11, 12, 40, 150)):
    """Families of texts with few edits, so that many pairs are close to the limit on both sides."""
    rnd = random.Random(seed)
    texts = []
    for size in sizes:
        base = [f"w{rnd.randrange(4000)}" for _ in range(size + 2)]
        for _ in range(22):
            words = list(base)
            for _ in range(rnd.choice((0, 0, 1, 1, 2, 3))):
                at = rnd.randrange(len(words))
                kind = rnd.randrange(3)
                if kind == 0:
                    words[at] = f"x{rnd.randrange(4000)}"
                elif kind == 1:
                    words.insert(at, f"y{rnd.randrange(4000)}")
                else:
                    del words[at]
            texts.append(" ".join(words))
    return texts


@pytest.mark.parametrize("seed", [1, 2])
def test_jaccard_join_against_all_pairs(documents, by_id, seed):
    texts = near_texts(seed) + [None, "", "one", "One", "two words", "Two  Words", "a b c", "a b c a b c"]
    rows = [(i * 3 + 1, t) for i, t in enumerate(texts)]
    sets = {i: shingles(t) for i, t in rows}
    linked = [
        (a, b)
        for a, b in itertools.combinations(sets, 2)
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 90 * len(sets[a] | sets[b])
    ]
    expected = plain_components(sets, linked)
    found = by_id(jaccard.join_documents(documents(*rows)))
    assert {i: r["component_id"] for i, r in found.items()} == expected
    assert {i: r["n_shingles"] for i, r in found.items()} == {i: len(s) for i, s in sets.items()}


def test_any_order_of_elements_gives_the_same_links(documents, by_id, monkeypatch):
    rows = list(enumerate(near_texts(5, (11, 30, 60))))
    usual = by_id(jaccard.join_documents(documents(*rows)))
    noise = np.random.default_rng(0).integers(0, 250, 1 << jaccard.SLOT_BITS).astype(np.uint8)
    monkeypatch.setattr(jaccard, "_levels", lambda scanned: noise)
    monkeypatch.setattr(jaccard, "SLICE", 2)
    assert by_id(jaccard.join_documents(documents(*rows))) == usual


def test_jaccard_odd_rows(documents):
    rows = [(5, "a b c d"), (5, "a b c d"), (None, "a b c d"), (None, "other text here"), (3, "A B C D"), (9, None)]
    found = sorted(jaccard.join_documents(documents(*rows)).collect(), key=str)
    pairs = sorted(((r["doc_id"], r["component_id"]) for r in found), key=str)
    assert pairs == sorted([(5, 3), (5, 3), (None, 3), (None, None), (3, 3), (9, 9)], key=str)
    assert jaccard.join_documents(documents(*rows).where("false")).count() == 0
    kept = jaccard.keep_one(documents(*rows))
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in kept.collect()) == [(0, "other text here"), (3, "A B C D"), (9, "")]


def word_sets(rows, words):
    out = {}
    for i, text in rows:
        found = WORD.findall((text or "").encode().lower().decode())
        out[i] = {tuple(found[k : k + words]) for k in range(len(found) - words + 1)} or ({tuple(found)} if found else set())
    return out


def all_links(sets, percent):
    pairs = itertools.combinations(sets, 2)
    return [(a, b) for a, b in pairs if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]


@pytest.mark.parametrize(("seed", "words", "percent"), [(11, 5, 80), (12, 4, 85)])
def test_jaccard_join_with_other_shingles_against_all_pairs(documents, by_id, seed, words, percent):
    rows = list(enumerate([*near_texts(seed, (9, 11, 19, 35, 67, 70, 131)), "a b c d", "a b c d", "a b c", None, ""]))
    sets = word_sets(rows, words)
    linked = all_links(sets, percent)
    found = by_id(jaccard.join_documents(documents(*rows), words, percent))
    assert {i: r["component_id"] for i, r in found.items()} == plain_components(sets, linked)
    assert {i: r["n_shingles"] for i, r in found.items()} == {i: len(s) for i, s in sets.items()}
    with pytest.raises(ValueError, match="percent"):
        jaccard.join_documents(documents(*rows), words, 79)


def test_copies_that_just_miss_a_link_are_not_compared_one_by_one(documents, by_id, monkeypatch):
    rnd = random.Random(4)
    base = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(50):
        words = list(base)
        for at in rnd.sample(range(300), 5):
            words[at] = f"x{i}y{at}"
        rows.append((i, " ".join(words)))
    sets = word_sets(rows, 5)
    linked = all_links(sets, 80)
    compared = []

    def counted(table, name):
        found = stored(table, name)
        if name in ("jaccard-direct", "jaccard-pairs"):
            compared.append(found.count())
        return found

    monkeypatch.setattr(jaccard, "stored", counted)
    found = by_id(jaccard.join_documents(documents(*rows), 5, 80))
    assert {i: r["component_id"] for i, r in found.items()} == plain_components(sets, linked)
    assert compared and sum(compared) <= 5 * len(rows) < 50 * 49 / 2 - len(linked)


def test_whole_sets_are_made_of_possible_links_alone(documents, by_id, monkeypatch):
    """Texts that differ in too many places share first elements; only those that nearly are the same are read again."""
    rows = [(i, " ".join(f"u{i}v{k}" if k % 29 == 13 and k < 280 else f"p{k}" for k in range(300))) for i in range(40)]
    rows += [(50, rows[7][1] + " end"), (51, rows[9][1].replace("p40 ", "")), (52, None), (9, "of another text")]
    sets = {}
    for i, text in rows:
        sets.setdefault(i, []).append(word_sets([(i, text)], 3)[i])
    made = []

    def counted(table, name):
        found = stored(table, name)
        if name == "jaccard-sets":
            made.append(sorted(r["node"] for r in found.select("node").collect()))
        return found

    monkeypatch.setattr(jaccard, "stored", counted)
    found = jaccard.join_documents(documents(*rows)).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == {i: {50: 7, 51: 9}.get(i, i) for i in sets}
    assert sorted((r["doc_id"], r["n_shingles"]) for r in found) == sorted((i, len(s)) for i, each in sets.items() for s in each)
    assert made and {i for each in made for i in each} <= {7, 9, 50, 51} and max(map(len, made)) <= 5


def test_words_are_told_apart_by_their_letters_alone():
    texts = ["", " \t\n\x0b\x0c\r", "One oNE one", "a\x1cb c\x85d e\xa0f É é", "\ud800 x\ud800", "ab ba a b aa", "x" * 64 + "Y " + "x" * 64 + "y"]
    texts += [" ".join(["k" * n for n in range(1, 200)]), "k" * 5000 + " " + "k" * 4999 + "j", "y" + "x" * 64 + " " + "x" * 64 + "Y"]
    number, word = {}, {}
    for text in texts:
        words = [w.encode("utf-8", "surrogatepass").lower() for w in WORD.findall(text)]
        hashes = jaccard.word_hashes(text).tolist()
        assert len(words) == len(hashes)
        for w, h in zip(words, hashes):
            assert number.setdefault(w, h) == h and word.setdefault(h, w) == w


@pytest.mark.parametrize("size", [0, 1, 100, 300, 5000])
def test_signs_differ_in_no_more_bits_than_sets(size):
    rng = np.random.default_rng(size)
    x = np.unique(rng.integers(0, 1 << 63, size).astype(np.uint64))
    y = np.unique(np.concatenate([x[: size // 2], rng.integers(0, 1 << 63, size).astype(np.uint64)]))
    one, other = (np.frombuffer(jaccard.sign(t), np.uint8)[None] for t in (x, y))
    for length in (64, min(one.size, other.size)):
        apart = np.bitwise_count(jaccard.folded(one, length) ^ jaccard.folded(other, length)).sum()
        assert apart <= len(np.setxor1d(x, y))
    assert 8 * one.size >= 2 * len(x)


def test_pipeline_drops_near_copies_by_five_words(spark, documents):
    fifty, hundred = [[f"{x}{i}" for i in range(n)] for x, n in (("a", 50), ("b", 100))]
    rows = [(1, fifty), (2, [*fifty[:20], "new", *fifty[21:]]), (3, hundred), (4, [*hundred[:30], "new", *hundred[31:70], "new", *hundred[71:]])]
    rows += [(5, [*fifty[:20], "new", "newer", *fifty[22:]])]  # 40 of 52, over 41 of 51 with 2
    texts = [(i, " ".join(w)) for i, w in rows] + list(enumerate(near_texts(21, (12, 40, 90)), 10))
    sets = word_sets(texts, 5)
    expected = {i for i, low in plain_components(sets, all_links(sets, 80)).items() if i == low}
    assert 2 not in expected and 4 not in expected
    left = corpus_pipeline.drop_near_duplicates(spark, documents(*texts), "")
    assert {r["doc_id"] for r in left.collect()} == expected


def plain_repeats(rows, window=50):
    words = {i: WORD.findall(t or "") for i, t in rows}
    first = {}
    for i in sorted(words):
        for at in range(len(words[i]) - window + 1):
            first.setdefault(tuple(words[i][at : at + window]), i)
    out = {}
    for i, w in words.items():
        gone = set()
        for at in range(len(w) - window + 1):
            if first[tuple(w[at : at + window])] < i:
                gone.update(range(at, at + window))
        out[i] = (len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone))
    return out


@pytest.mark.parametrize("salt", [1000, 2])
def test_repeats_against_all_windows(documents, by_id, monkeypatch, salt):
    monkeypatch.setattr(substring, "ROWS_PER_SALT", salt)
    monkeypatch.setattr(substring, "WINDOWS_PER_PART", salt * 5)
    rnd = random.Random(salt)
    passages = [[f"p{rnd.randrange(900)}" for _ in range(rnd.choice((49, 50, 51, 70, 130)))] for _ in range(6)]
    rows = []
    for i in range(60):
        words = []
        for _ in range(rnd.randint(0, 3)):
            words += [f"u{rnd.randrange(10**6)}" for _ in range(rnd.randint(0, 60))]
            if rnd.random() < 0.7:
                words += rnd.choice(passages)
        rows.append((i * 2, " ".join(words)))
    rows += [(1001, rows[5][1]), (1003, None), (1005, ""), (1007, "a " * 300), (1009, "a\n" * 400), (1011, rows[7][1].replace(" ", "\n"))]
    found = by_id(substring.remove_repeats(documents(*rows), keep_text=True))
    for i, (n, gone, kept) in plain_repeats(rows).items():
        assert (found[i]["n_words"], found[i]["n_removed"]) == (n, gone), i
        assert found[i]["kept_sha256"] == __import__("hashlib").sha256(kept.encode()).hexdigest()


def test_repeats_odd_rows(documents):
    text = " ".join(f"w{i}" for i in range(80))
    rows = [(None, text), (4, text), (4, text), (7, text), (8, None)]
    found = sorted((r["doc_id"] or 0, r["n_words"], r["n_removed"]) for r in substring.remove_repeats(documents(*rows)).collect())
    assert found == [(0, 80, 0), (4, 80, 0), (4, 80, 0), (7, 80, 80), (8, 0, 0)]
    assert substring.remove_repeats(documents(*rows).where("false")).count() == 0


def test_vectors_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(embedding, "BLOCK", 16)
    rng = np.random.default_rng(3)
    rows, n = [], 0
    for label in (0, 1):
        for _ in range(6):
            centre = rng.normal(size=64)
            for _ in range(15):
                rows.append((n, (centre + rng.normal(size=64) * rng.choice([0.02, 0.2])).tolist(), label))
                n += 1
    rows += [(n + k, rows[3][1], 0) for k in range(3)] + [(n + 3, rows[3][1], None), (n + 4, [0.0] * 64, 0), (n + 5, None, 1)]
    rows += [(n + 6, [float("nan")] * 64, 0), (n + 7, [None] + [1.0] * 63, 0), (n + 8, [1.0, 2.0], 0), (n + 9, [], 1)]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int").selectExpr("*", "'x' as class", "1 as links")
    sound = [(i, np.array(v), x) for i, v, x in rows if x is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    linked = [
        (a[0], b[0])
        for a, b in itertools.combinations(sound, 2)
        if a[2] == b[2] and len(a[1]) == len(b[1]) and a[1] @ b[1] / np.linalg.norm(a[1]) / np.linalg.norm(b[1]) >= 0.93
    ]
    found = {r["vec_id"]: r for r in embedding.link_vectors(table).collect()}
    assert set(found) == {r[0] for r in rows}
    expected = plain_components([r[0] for r in rows], linked)
    links = {i: sum(i in pair for pair in linked) for i in found}
    total = sum(links.values())
    assert all(found[i]["n_links"] <= links[i] for i in found)
    assert sum(found[i]["n_links"] for i in found) >= 0.97 * total
    assert np.mean([found[i]["component_id"] == expected[i] for i in found]) >= 0.97
    assert embedding.link_vectors(table.where("false")).count() == 0


def test_code_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(5)
    x = embedding.unit_rows(rng.normal(size=(200, 64)))
    y = embedding.unit_rows(x + rng.normal(size=(200, 64)) * 0.05)
    turn = embedding.rotation(embedding.CODE_BITS)
    turned, _, _ = embedding.codes_of(x, turn)
    _, code, factor = embedding.codes_of(y, turn)
    found, bound = embedding.estimate(turned, code, factor)
    error = found - x @ y.T
    assert abs(error.mean()) < 0.01
    assert (np.abs(error) <= bound).mean() > 0.999


@pytest.fixture
def pages(spark):
    long = "<p>Ä</p>" * 300
    rows = [(1, "http://a/1", long), (2, "http://a/2\r\nX: y", long), (7, None, long), (3, "u", "short"), (4, "u", "short")]
    rows += [(5, "u", None), (6, "u", ""), (8, "u", "x\r\n\r\nWARC/1.1\r\n" * 90)]
    return spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "'z' as payload", "'z' as record_id")


def test_archive_round_trip(spark, pages, tmp_path):
    folder = str(tmp_path / "archive")
    warc.write_archive(pages, folder)
    assert spark.read.parquet(f"{folder}/payloads").count() == 4  # one for each content, the empty one too
    bodies = {r["page_id"]: (r["html"] or "").encode() for r in pages.collect()}
    records = warc.read_archive(spark, folder)
    assert {r["record_id"]: bytes(r["payload"]) for r in records.collect()} == bodies
    found = {r["page_id"]: r for r in warc.parse_records(records).collect()}
    assert {i: r["refers_to"] for i, r in found.items()} == {1: 7, 2: 7, 7: None, 3: None, 4: None, 5: None, 6: None, 8: None}
    assert found[2]["uri"] == "http://a/2 X: y" and found[1]["record_type"] == "revisit"
    warc.export_warc(records, str(tmp_path / "plain"))
    text = b"".join(p.read_bytes() for p in sorted((tmp_path / "plain").glob("part-*")))
    assert text.count(b"WARC-Record-ID") == 8 and bodies[8] + b"\r\n\r\n" in text


def test_archive_deals_out_copies_and_reports_damage(spark, pages, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "COPIES_PER_SALT", 1)
    folder = str(tmp_path / "archive")
    warc.write_archive(pages, folder)
    assert warc.parse_records(warc.read_archive(spark, folder)).count() == 8
    broken = spark.read.parquet(f"{folder}/payloads").selectExpr("payload_key", "cast('no' as binary) packed", "copies")
    bad = str(tmp_path / "bad")
    spark.read.parquet(f"{folder}/headers").write.parquet(f"{bad}/headers")
    broken.write.parquet(f"{bad}/payloads")
    with pytest.raises(Exception, match="damaged"):
        warc.read_archive(spark, bad).collect()


def test_empty_archive(spark, pages, tmp_path):
    warc.write_archive(pages.where("false"), str(tmp_path / "none"))
    assert warc.parse_records(warc.read_archive(spark, str(tmp_path / "none"))).count() == 0


def test_rates_meet_the_targets(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    rows = mixing.mix_documents(docs, labels, TARGETS).collect()
    assert len(rows) == docs.count() and all(r["rate"] >= 0 for r in rows)
    sums = {d: sum(r["rate"] * r["tokens"] * r["posteriors"][d] for r in rows) for d in TARGETS}
    total = sum(r["tokens"] for r in rows)
    for d, weight in TARGETS.items():
        assert abs(sums[d] / total - weight) < 1e-3


def test_rates_against_plain_projected_gradients(spark):
    rng = np.random.default_rng(2)
    p = rng.dirichlet([0.4, 0.4, 0.4], 60)
    tokens = rng.integers(0, 300, 60)
    aim = np.array([0.7, 0.29, 0.01])
    frame = spark.createDataFrame([(i, i, int(t), *map(float, q)) for i, (t, q) in enumerate(zip(tokens, p))], "doc_id bigint, text_hash bigint, tokens bigint, p0 double, p1 double, p2 double")
    found = mixing.fit_rates(frame, aim.tolist(), tolerance=1e-7)
    rate = np.array([r["rate"] for r in found.orderBy("doc_id").collect()])
    a = (tokens[:, None] * p) / tokens.sum()
    weight = np.linalg.inv(a.T @ a)
    plain = np.ones(60)
    for _ in range(3000):
        plain = np.maximum(0, plain - a @ weight @ (plain @ a - aim))
    assert np.abs(rate @ a - aim).max() <= np.abs(plain @ a - aim).max() + 2e-3
    assert (rate >= 0).all()


def test_rates_go_on_while_small_steps_close_the_gap_and_tell_what_is_left(spark, caplog, monkeypatch):
    monkeypatch.setattr(mixing, "STEPS", 7)  # the fixed step size ended this one after five
    p = np.random.default_rng(0).dirichlet([0.5, 0.5], 1000)
    rows = [(i, 10, *map(float, q)) for i, q in enumerate(p)] + [(1000, 1_000_000, 0.5, 0.5), (1001, 1_000_000, 0.52, 0.48)]
    frame = spark.createDataFrame(rows, "doc_id bigint, tokens bigint, p0 double, p1 double")
    total = sum(r[1] for r in rows)
    aim = [0.5 + 4_000 / total, 0.5 - 4_000 / total]
    mixing.fit_rates(frame, aim, 1.0, 1.2, tolerance=5e-3)
    assert "miss their targets" in caplog.text and "after 7 steps" in caplog.text
    caplog.clear()
    monkeypatch.setattr(mixing, "STEPS", 1)
    mixing.fit_rates(frame, [0.99, 0.01], 1.0, 4.0, upsample=True)
    assert "most copies" in caplog.text and "miss their targets" in caplog.text


def test_pipeline_mixes_to_the_tolerance_of_op9(spark, documents, monkeypatch):
    seen = []
    monkeypatch.setattr(mixing, "fit_rates", lambda shares, *a: seen.append(a) or shares.selectExpr("*", "1.0D rate"))
    corpus_pipeline.mix(spark, documents((1, "some words")), "/root/testdata/sf0.001")
    mixing.mix_documents(documents((1, "some words")), spark.read.parquet("/root/testdata/sf0.001/labels.parquet"), TARGETS)
    assert seen[0][-1] == seen[1][-1]


def test_mixing_odd_rows(spark, documents):
    rows = [(1, None), (2, ""), (None, "some words here"), (4, "some words here"), (4, "some words here"), (5, "other words")]
    labels = spark.createDataFrame([(4, 1, 0), (4, 1, 0), (5, 0, 0), (None, 1, 1), (9, None, 1)], "doc_id bigint, quality int, toxic int")
    found = mixing.mix_documents(documents(*rows), labels, TARGETS)
    assert found.count() == 6
    assert {r["rate"] for r in found.where("tokens = 0").collect()} == {1.0}
    assert mixing.mix_documents(documents(*rows).where("false"), labels, TARGETS).count() == 0
    assert mixing.mix_documents(documents(*rows), labels.where("false"), TARGETS).count() == 6


def test_toxicity_on_the_held_out_quarter(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.train(docs, labels)
    held = toxicity.score_documents(docs, model).where("held_out").join(labels, "doc_id").collect()
    hits = sum(r["predicted"] and r["toxic"] for r in held)
    assert hits >= 0.85 * sum(r["toxic"] for r in held)
    assert hits >= 0.85 * sum(r["predicted"] for r in held)


def test_toxicity_odd_rows_and_long_texts(spark, documents, monkeypatch):
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id bigint, toxic int")
    texts = [(i, ("nice words " if i % 2 == 0 else "horrid words ") * 5) for i in range(40)]
    odd = [(None, "horrid"), (50, None), (51, ""), (52, "x " * 90_000), (52, "x " * 90_000)]
    model = toxicity.train(documents(*texts), labels)
    found = toxicity.score_documents(documents(*texts, *odd), model).collect()
    assert len(found) == 45 and all(0 <= r["score"] <= 1 for r in found)
    assert toxicity.score_documents(documents(*odd).where("false"), model).count() == 0
    toxicity.train(documents(*texts), labels.where("false"))
    rows = toxicity.word_rows("a b c d e f g h " * 50)
    whole = model.logit(rows)
    monkeypatch.setattr(toxicity, "PART", 7)
    assert abs(model.logit(rows) - whole) < 1e-5


def test_toxicity_learns_from_every_labelled_row(spark, documents):
    rnd = random.Random(9)
    texts = []
    for i in range(900):
        words = [rnd.choice(["calm", "plain", "river", "stone", "table", "window"]) for _ in range(12)]
        texts.append((i, " ".join([*words, f"nasty{chr(97 + i // 3 % 20)}word" if i % 3 == 0 else "kind"])))
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(900)], "doc_id bigint, toxic int")
    docs = documents(*texts)
    model = toxicity.train(docs, labels, rows=300)
    again = toxicity.train(docs.repartition(7), labels.repartition(3), rows=300)
    assert (model.weights() == again.weights()).all() and model.scale == again.scale
    found = toxicity.score_documents(docs, model).collect()
    assert sum(r["predicted"] == (r["doc_id"] % 3 == 0) for r in found) >= 0.95 * len(found)
    # Whichever row goes, the model is another one, however small the blocks are.
    for gone in [i for i, _ in texts if zlib.crc32(str(i).encode()) % 4 != 2][:3]:
        less = toxicity.train(docs, labels.where(f"doc_id <> {gone}"), rows=300)
        assert (less.weights() != model.weights()).any() or less.scale != model.scale


def test_scale_of_well_separated_logits_keeps_their_order():
    rng = np.random.default_rng(5)
    logits = np.concatenate([rng.normal(-6, 1, 130), rng.normal(6, 1, 8), rng.normal(-5, 1, 4)])
    labels = np.repeat([0.0, 1.0], [130, 12])
    a, _ = learning.scale(logits, labels, np.ones(142))
    assert 0 < a < 2


def test_pipeline_against_plain_stages(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    rows = {r["doc_id"]: r for r in docs.collect()}
    model = toxicity.train(docs, labels)
    clean = stored(corpus_pipeline.drop_toxic(spark, docs, folder), "test-clean")
    limits = {i: model.thresholds.get(r["lang"], model.threshold) for i, r in rows.items()}
    expected = {i for i, r in rows.items() if model.score(toxicity.word_rows(r["text"])) < limits[i]}
    assert {r["doc_id"] for r in clean.collect()} == expected and clean.columns == docs.columns
    one = stored(corpus_pipeline.drop_near_duplicates(spark, clean, folder), "test-one")
    sets = word_sets([(i, rows[i]["text"]) for i in expected], 5)
    groups = plain_components(sets, all_links(sets, 80))
    left = {r["doc_id"]: r for r in one.collect()}
    assert set(left) == {i for i in groups if groups[i] == i} and one.columns == docs.columns
    found = secrets.train(one)
    hidden = stored(secrets.redact_documents(one, found), "test-hidden")
    assert hidden.columns == docs.columns
    for r in hidden.collect():
        text = rows[r["doc_id"]]["text"]
        assert r["text"] == secrets.redact(text, secrets.scan_text(text, found)["spans"]) and r["n_chars"] == len(r["text"])
        base = secrets.scan_text(text)["spans"]
        assert ("[secret]" in r["text"]) if base else (r["text"] == text or "[secret]" in r["text"])
    mixed = stored(corpus_pipeline.mix(spark, hidden, folder), "test-mixed")
    assert mixed.columns == docs.columns
    rates = mixing.mix_documents(hidden, labels, corpus_pipeline.CLEAN_TARGETS, least=1.0, most=corpus_pipeline.MOST_COPIES, upsample=True)
    rate = {r["doc_id"]: r["rate"] for r in rates.collect()}
    copies = collections.Counter(r["doc_id"] for r in mixed.collect())
    assert set(copies) == set(left)
    assert all(np.floor(rate[i] + 1e-9) <= n <= np.ceil(rate[i] - 1e-9) for i, n in copies.items())
    assert len(mixed.distinct().collect()) == len(left)
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.default_path())
    texts = {r["doc_id"]: r["text"] for r in hidden.collect()}
    plain = {}
    for i, text in texts.items():
        ids = library.encode(text, add_bos=True, add_eos=True)
        plain[i] = (
            len(ids),
            hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
            hashlib.sha256(library.decode(ids).encode()).hexdigest(),
        )
    tokens = corpus_pipeline.encode(spark, mixed, folder).collect()
    assert collections.Counter(r["doc_id"] for r in tokens) == copies
    assert all((r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == plain[r["doc_id"]] for r in tokens)


def test_pipeline_on_an_empty_table(spark, documents):
    docs = documents((1, "x")).where("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "/root/testdata/sf0.001")
        assert docs.count() == 0


def test_the_sketch_of_a_scan_is_held_once():
    texts = [" ".join(f"w{i}x{j}" for j in range(60)) for i in range(40)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(40)), pa.array(texts)], ["doc_id", "text"])
    tracemalloc.start()
    rows = [r.num_rows for r in jaccard._scan(3, 90)(iter([batch]))]
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(rows) == 40 + (1 << (jaccard.SLOT_BITS - jaccard.PIECE_BITS)) and most < 30 << 20
