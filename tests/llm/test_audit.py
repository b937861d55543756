"""The audit of filters against going through all orders row by row."""

import itertools
import random
import re

import pytest

from sitepulse.llm import audit

SCHEMA = "doc_id bigint, text string, source string, part string, code int, n bigint, bucket string"
TEXTS = [
    None,
    "",
    "short",
    "Short & Loud",
    "a b " * 150,
    " ".join(f"word{i}" for i in range(250)),
    " ".join(f"Word{i}" for i in range(250)),
    "X Y " * 150 + "#",
    "\t\n",
]


def files(spark, folder, *tables):
    for rows in tables:
        rows = [(*row, "p", 7, 9, "b") for row in rows]
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(str(folder))
    return str(folder)


def label_table(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


def plain_report(rows, labels):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t, _ in rows]
    fails = []
    for (key, text, _), w in zip(rows, words):
        text = text or ""
        mine = "A" * (len(w) < 200) + "B" * (100 * len(set(w)) < 50 * len(w))
        mine += "C" * (100 * sum("A" <= c <= "Z" for c in text) > 2 * len(text)) + "D" * any(c in "#$%&*|" for c in text)
        first = [k for k, t, _ in rows if (t or "") == text and k is not None and key is not None and k < key]
        fails.append(mine + "E" * bool(first))
    good = {k for k, q, _ in labels if q == 1 and k is not None}
    toxic = {k for k, _, x in labels if x == 1 and k is not None}
    out = {}
    for part in {s or "" for *_, s in rows}:
        shapley = dict.fromkeys("ABCDE", 0)
        for order in itertools.permutations("ABCDE"):
            left = [i for i, row in enumerate(rows) if (row[2] or "") == part]
            everyone, gone = list(left), set()
            for step, letter in enumerate(order, 1):
                removed = [i for i in left if letter in fails[i]]
                left = [i for i in left if letter not in fails[i]]
                out[part, "".join(order), step] = {
                    "kept": len(left),
                    "removed": len(removed),
                    "redundant": sum(letter in fails[i] for i in gone),
                    "unique_fails": sum(fails[i] == letter for i in everyone),
                    "good_lost": sum(rows[i][0] in good for i in removed),
                    "toxic_lost": sum(rows[i][0] in toxic for i in removed),
                }
                gone |= set(removed)
                shapley[letter] += len(removed)
        for (p, order, step), row in out.items():
            if p == part:
                row["shapley"] = shapley[order[step - 1]]
    return out


def found_report(frame):
    rows = [r.asDict() for r in frame.collect()]
    found = {(r.pop("part"), r.pop("filter_order"), r.pop("step")): r for r in rows}
    assert len(found) == len(rows)
    return found


@pytest.mark.parametrize("seed, batches", [(1, 1), (2, 3), (3, 100)])
def test_audit_equals_all_orders(spark, tmp_path, seed, batches):
    rnd = random.Random(seed)
    keys = rnd.sample(range(1000), 60)
    rows = [(k, rnd.choice(TEXTS), rnd.choice(["s", "s", "t", None, ""])) for k in keys]
    rows += [rows[0], rows[5], (rows[7][0], rows[7][1], "u"), (None, "short", "s"), (None, "only here", "s")]
    rnd.shuffle(rows)
    labels = [(k, rnd.choice([0, 1, None]), rnd.choice([0, 1])) for k in keys[:40]] + [(keys[0], 1, 0), (5000, 1, 1), (None, 1, 1)]
    path = files(spark, tmp_path / "documents.parquet", *[rows[i::5] for i in range(5)])
    assert found_report(audit.audit_filters(spark, path, label_table(spark, labels), batches)) == plain_report(rows, labels)


def test_smaller_ids_of_later_files_take_counts_back(spark, tmp_path):
    """Copies arrive with falling ids, one in a file; each takes the place of the one before."""
    rows = [(k, TEXTS[5], source) for k, source in ((9, "s"), (7, "t"), (3, "s"))]
    path = files(spark, tmp_path / "falling.parquet", *[[row] for row in rows])
    counts = {(r["part"], r["code"]): r["n"] for r in audit.count_failures(spark, path, label_table(spark, []), 3).collect()}
    assert counts == {("s", 0): 1, ("s", 16): 1, ("t", 16): 1}


def test_state_of_a_text():
    settled = audit.Counter()
    first = audit.FirstRows()
    for key, part in ((5, "a"), (5, "b"), (8, "a"), (2, "c"), (5, "a"), (2, "c")):
        first.add(key, part, 1, 1, settled, counted=True)
    assert first.low == 2 and dict(first.rows) == {("c", 1): 2}
    assert {k: n for k, n in settled.items() if n} == {("a", 17): 3, ("b", 17): 1, ("c", 1): 2}


def test_one_large_group_of_copies(spark, tmp_path):
    """Copies are added up in the tasks, so the state sees a row per task."""
    many = spark.range(40_000).selectExpr("id AS doc_id", "'same text' AS text", "'s' AS source")
    many.repartition(6).write.parquet(str(tmp_path / "copies.parquet"))
    path = str(tmp_path / "copies.parquet")
    counts = {(r["part"], r["code"]): r["n"] for r in audit.count_failures(spark, path, label_table(spark, [])).collect()}
    assert counts == {("s", 1): 1, ("s", 17): 39_999}


def test_empty_table_and_single_file(spark, tmp_path):
    empty = files(spark, tmp_path / "empty.parquet", [])
    assert audit.audit_filters(spark, empty, label_table(spark, [])).count() == 0
    table = files(spark, tmp_path / "one.parquet", [(1, "a " * 100_000, None)])
    (single,) = (str(p) for p in (tmp_path / "one.parquet").iterdir() if p.suffix == ".parquet")
    for path in (table, single):
        report = found_report(audit.audit_filters(spark, path, label_table(spark, [])))
        assert len(report) == 600 and report["", "ABCDE", 2]["removed"] == 1
