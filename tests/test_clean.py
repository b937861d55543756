import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from sitepulse.functions.distribution import quantiles, quantiles_by_range, value_counts
from sitepulse.operators import clean
from tests.conftest import values


def test_duplicates_sum_and_first(readings):
    frame = readings((2, 8, 1, 5), (1, 8, 1, 10), (3, 9, 1, 7))
    assert values(clean.merge_duplicates(frame), "Vehicles", "ID") == [(7, 3), (15, 1)]
    assert values(clean.keep_first(frame), "Vehicles", "ID") == [(7, 3), (10, 1)]
    assert clean.duplicate_count(frame).first()["Duplicates"] == 1


def test_merge_keeps_total_and_drops_null_keys(readings):
    frame = readings((1, 8, None, 10), (2, 8, 1, None), (3, 8, 1, None), (4, 9, 2, 3), (5, 9, 2, 4))
    assert values(clean.merge_duplicates(frame), "Junction", "Vehicles") == [(1, 0), (2, 7)]


def test_duplicate_count_treats_null_keys_as_equal(readings):
    frame = readings((1, 8, None, 10), (2, 8, None, 5), (3, 9, None, 5))
    assert clean.duplicate_count(frame).first()["Duplicates"] == 1
    assert clean.null_count(frame).first()["Nulls"] == 3


def test_merge_without_id(readings):
    frame = readings((1, 8, 1, 5), (2, 8, 1, 10)).drop("ID")
    assert values(clean.merge_duplicates(frame), "Vehicles") == [(15,)]


def test_gap_stays_inside_its_junction(readings):
    frame = readings((1, 1, 1, 10), (2, 2, 1, None), (3, 3, 1, 12), (4, 1, 2, None), (5, 2, 2, 7))
    filled = clean.fill_gaps(frame)
    assert values(filled, "ID", "Vehicles") == [(1, 10), (2, 10), (3, 12), (4, 7), (5, 7)]


@pytest.mark.parametrize("pieces", [1, 5, 60, None])
def test_fill_equals_brute_force(spark, readings, pieces):
    """One junction holds most rows, one clock time holds most of those, months lie between readings."""
    rng = random.Random(pieces or 0)
    ids = rng.sample(range(100_000), 400)
    rows = []
    for i in ids:
        junction = rng.choice([1, 1, 1, 2, 3])
        hour = 50 if rng.random() < 0.4 else rng.choice([1, 2, 3, 60, 900, 901, 2500, 2501, 6000])
        rows.append((i, hour, junction, rng.randrange(100) if rng.random() < 0.3 else None))
    rows += [(200_000 + n, n, 9, None) for n in range(3)]  # nothing to fill from
    frame = readings(*rows)
    expected = pd.DataFrame(rows, columns=["ID", "hour", "Junction", "Vehicles"]).sort_values(["Junction", "hour", "ID"])
    expected["Vehicles"] = expected.groupby("Junction")["Vehicles"].transform(lambda s: s.ffill().bfill())
    want = {int(i): None if pd.isna(v) else int(v) for i, v in zip(expected["ID"], expected["Vehicles"])}
    filled = clean.fill_gaps(frame, pieces=pieces)
    assert {row["ID"]: row["Vehicles"] for row in filled.collect()} == want
    assert filled.columns == frame.columns


def test_fill_several_columns(readings):
    frame = readings((1, 1, 1, 4), (2, 2, 1, None), (3, 3, 1, None)).withColumn(
        "Speed", F.when(F.col("ID") == 3, 9.0)
    )
    filled = clean.fill_gaps(frame, ["Vehicles", "Speed"])
    assert values(filled, "ID", "Vehicles", "Speed") == [(1, 4, 9.0), (2, 4, 9.0), (3, 4, 9.0)]


def test_outliers(readings):
    frame = readings(*[(i, i, 1, 10 + i) for i in range(10)], (10, 10, 1, 500), (11, 11, 1, None))
    bounds = clean.outlier_bounds(frame).first()
    assert tuple(bounds) == (12.5, 17.5, 5.0, -2.5, 32.5)
    assert clean.outlier_count(frame).first()["Outliers"] == 1
    capped = {row["ID"]: row["Vehicles"] for row in clean.cap_outliers(frame).collect()}
    assert capped[10] == 32.5 and capped[3] == 13.0 and capped[11] is None


def test_keep_first_keeps_whole_rows_without_an_id(readings):
    frame = readings((None, 8, 1, 7), (None, 9, 1, 9), (None, 9, 1, 4), (5, 9, 2, 1), (None, 9, 2, 0))
    assert values(clean.keep_first(frame), "Junction", "Vehicles") == [(1, 4), (1, 7), (2, 1)]
    assert values(clean.keep_first(frame.drop("ID")), "Junction", "Vehicles") == [(1, 4), (1, 7), (2, 0)]


def test_crowded_clock_with_one_distant_id(spark, readings):
    rows = [(i, 8, 1, None if i % 3 else i) for i in range(1, 2000)] + [(10**12, 8, 1, None)]
    filled = {r["ID"]: r["Vehicles"] for r in clean.fill_gaps(readings(*rows), pieces=20).collect()}
    assert all(filled[i] == (i - i % 3 if i >= 3 else 3) for i in range(1, 2000)) and filled[10**12] == 1998


def test_rows_without_gaps_are_not_sorted(readings):
    frame = readings((1, 8, 1, 5), (2, 9, 1, None), (3, 10, 1, 7), (4, 10, None, None))
    assert values(clean.fill_gaps(frame), "ID", "Vehicles") == [(1, 5), (2, 5), (3, 7), (4, None)]


def test_readings_without_clock_neither_give_nor_take(spark, readings):
    frame = readings((1, 8, 1, None), (2, 9, 1, 6), (3, 10, 1, None)).withColumn(
        "DateTime", F.when(F.col("ID") != 1, F.col("DateTime"))
    )
    extra = spark.createDataFrame([(4, None, 1, 50)], frame.schema)
    for pieces in (1, 4):
        assert values(clean.fill_gaps(frame.union(extra), pieces=pieces), "ID", "Vehicles") == [(1, None), (2, 6), (3, 6), (4, 50)]


def test_fill_reads_the_readings_once(spark, readings, tmp_path):
    readings((1, 8, 1, 5), (2, 9, 1, None), (3, 8, 2, 1)).write.parquet(str(tmp_path / "raw"))
    raw = spark.read.parquet(str(tmp_path / "raw"))
    assert not any(str(tmp_path) in file for file in clean.fill_gaps(raw).inputFiles())
    assert clean.fill_gaps(raw.where("false")).count() == 0


def test_ranged_quantiles_equal_counted_ones(spark):
    rnd = random.Random(4)
    frame = spark.createDataFrame([(round(rnd.gauss(0, 50), 3),) for _ in range(4000)], "Vehicles double")
    counts = value_counts(frame)
    probs = (0.0, 0.25, 0.333, 0.75, 1.0)
    expected = quantiles(counts, probs=probs).first()["Quantiles"]
    found = quantiles_by_range(counts, probs=probs, rows_at_end=50, ranges=8).first()["Quantiles"]
    assert found == pytest.approx(expected, abs=1e-9)
    assert quantiles_by_range(counts.where("false"), probs=probs).first()["Quantiles"] is None
