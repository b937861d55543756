import pytest
from pyspark.errors import PySparkException

from sitepulse.functions.temporal import add_calendar
from sitepulse.operators import clean, recommend
from sitepulse.plans import analysis
from sitepulse.sources import readings as source
from sitepulse.sources import tables
from tests.conftest import values


@pytest.fixture
def csv(tmp_path):
    def write(text):
        path = tmp_path / "readings.csv"
        path.write_text(text)
        return str(path)

    return write


def test_columns_match_by_name(spark, csv):
    path = csv("Vehicles,ID,DateTime,Junction\n15,20151101001,2015-11-01 00:00:00,1\n,2,2015-11-01 01:00:00,1\n7.0,3,2015-11-01 02:00:00,2\n")
    frame = source.load_readings(spark, path)
    assert dict(frame.dtypes) == {"DateTime": "timestamp_ntz", "Junction": "bigint", "Vehicles": "bigint", "ID": "bigint"}
    assert [(r["Junction"], r["Vehicles"]) for r in frame.orderBy("DateTime").collect()] == [(1, 15), (1, None), (2, 7)]
    assert "ID" not in source.load_readings(spark, path, drop_id=True).columns
    span = source.clock_range(frame).first()
    assert (span["First"].hour, span["Last"].hour) == (0, 2)


def test_each_file_is_read_by_its_own_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("DateTime,Junction,Vehicles,ID\n2024-01-01 00:00:00,2,30,1\n")
    (tmp_path / "b.csv").write_text("DateTime,Vehicles,Junction,ID\n2024-01-01 01:00:00,40,3,2\n")
    (tmp_path / "c.csv").write_text("Junction,DateTime,Vehicles\n4,2024-01-01 02:00:00,50\n")
    found = source.load_readings(spark, str(tmp_path))
    assert values(found.na.fill(0), "Junction", "Vehicles", "ID") == [(2, 30, 1), (3, 40, 2), (4, 50, 0)]


def test_fractions_fail_unless_asked_for(spark, csv):
    path = csv("DateTime,Junction,Vehicles\n2024-01-01 00:00:00,1,15.7\n2024-01-01 01:00:00,1,9007199254740993\n")
    with pytest.raises(PySparkException, match="no whole count"):
        source.load_readings(spark, path).collect()
    assert values(source.load_readings(spark, path, vehicles_type="double"), "Vehicles")[0] == (15.7,)
    path = csv("DateTime,Junction,Vehicles\n2024-01-01 01:00:00,1,9007199254740993\n")
    assert source.load_readings(spark, path).first()["Vehicles"] == 9007199254740993


def test_ranges_of_days_reach_the_scan(spark, readings, tmp_path, capsys):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    source.readings_from_events(events, days=("2024-01-08", "2024-01-14")).explain("formatted")
    pushed = [x for x in capsys.readouterr().out.splitlines() if "PushedFilters" in x]
    assert "GreaterThanOrEqual(ts" in pushed[0] and "LessThan(ts" in pushed[0]
    path = str(tmp_path / "months")
    tables.write_readings(readings((1, 0, 1, 5), (2, 24 * 40, 1, 7), (3, 24 * 70, 1, 9)), path)
    february = tables.read_readings(spark, path, "2024-02-01", "2024-02-29")
    february.explain("formatted")
    filters = [x for x in capsys.readouterr().out.splitlines() if "PartitionFilters" in x]
    assert "ReadingMonth" in filters[0]
    assert values(february, "ID") == [(2,)] and tables.read_readings(spark, path).count() == 3


def test_bad_clock(spark, csv):
    path = csv("DateTime,Junction,Vehicles\nyesterday,1,5\n")
    with pytest.raises(PySparkException):
        source.load_readings(spark, path).collect()
    assert source.load_readings(spark, path, lenient=True).first()["DateTime"] is None
    with pytest.raises(ValueError):
        source.load_readings(spark, path, fmt="xml")


def test_file_order_stands_in_for_an_id(spark, csv):
    path = csv("DateTime,Junction,Vehicles\n2024-01-01 00:00:00,1,5\n2024-01-01 00:00:00,1,3\n")
    frame = source.load_readings(spark, path, keep_file_order=True)
    assert clean.keep_first(frame, "SourceOrder").first()["Vehicles"] == 5
    assert values(analysis.prepare(frame, "first", cap=False, order="SourceOrder"), "Vehicles") == [(5,)]


def test_processed_roundtrips(spark, readings, tmp_path):
    processed = analysis.prepare(readings((1, 0, 1, 4), (2, 0, 1, 5), (3, 800, 2, 6)), "sum")
    tables.write_csv(processed, str(tmp_path / "csv"))
    again = tables.read_processed(spark, str(tmp_path / "csv"))
    assert sorted(again.collect()) == sorted(processed.select(*again.columns).collect())
    tables.write_readings(processed, str(tmp_path / "parquet"))
    stored = spark.read.parquet(str(tmp_path / "parquet"))
    assert values(stored, "ID", "ReadingMonth") == [(1, "2024-01"), (3, "2024-02")]


def test_missing_results(spark, tmp_path):
    assert tables.load_results(spark, str(tmp_path / "nowhere")) == {"loaded": False}


def test_array_columns_are_joined(spark, tmp_path):
    frame = spark.createDataFrame([(1, ["a, b", 'c "d"']), (2, [])], "Junction bigint, Recommendations array<string>")
    tables.write_csv(frame, str(tmp_path / "out"))
    again = spark.read.option("header", True).option("escape", '"').csv(str(tmp_path / "out"))
    assert values(again, "Junction", "Recommendations") == [("1", 'a, b | c "d"'), ("2", "None")]


def test_calendar_is_derived_from_the_clock(readings):
    row = add_calendar(readings((1, "2016-02-29 13:00:00", 1, 1))).first()
    assert (row["Hour"], row["DayOfWeek"], row["Month"], row["IsWeekend"]) == (13, 0, 2, 0)


def test_many_files_take_one_job(spark, tmp_path):
    """Two kinds of headers and some empty files; names with blanks."""
    folder = tmp_path / "many files"
    folder.mkdir()
    for i in range(300):
        head = "DateTime,Junction,Vehicles,ID" if i % 3 else "ID,Vehicles,Junction,DateTime"
        row = f"2024-01-01 00:00:00,{i},7,{i}" if i % 3 else f"{i},7,{i},2024-01-01 00:00:00"
        (folder / f"part {i:04d}.csv").write_text("" if i % 100 == 50 else f"{head}\n{row}\n")
    spark.sparkContext.setJobGroup("headers", "headers")
    headers = source._headers(spark, str(folder))
    spark.sparkContext.setJobGroup("other", "other")
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("headers")) <= 2  # both stages of one query
    assert sorted(len(files) for _, files in headers) == [99, 198]
    found = values(source.load_readings(spark, str(folder)), "Junction", "Vehicles", "ID")
    assert found == [(i, 7, i) for i in range(300) if i % 100 != 50]


def test_a_file_without_a_needed_column_fails(spark, tmp_path):
    (tmp_path / "a.csv").write_text("DateTime,Junction,Vehicles\n2024-01-01 00:00:00,1,2\n")
    (tmp_path / "b.csv").write_text("DateTime,Site,Vehicles\n2024-01-01 00:00:00,1,2\n")
    with pytest.raises(ValueError, match="Junction"):
        source.load_readings(spark, str(tmp_path))
    with pytest.raises(ValueError, match="Junction"):
        source.load_readings(spark, str(tmp_path / "b.csv"))
    assert source.load_readings(spark, str(tmp_path / "a.csv")).count() == 1


def test_headers_of_files_in_pieces(spark, tmp_path):
    """Pieces behind the first one have no header of their own."""
    lines = "".join(f"2024-01-01 00:00:00,{i},1\n" for i in range(5000))
    (tmp_path / "a.csv").write_text("\nDateTime,Junction,Vehicles\n" + lines)
    (tmp_path / "b.csv").write_text("Junction,DateTime,Vehicles\n-1,2024-01-01 00:00:00,1\n")
    usual = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
        assert sorted(len(files) for _, files in source._headers(spark, str(tmp_path))) == [1, 1]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", usual)
    assert source.load_readings(spark, str(tmp_path)).count() == 5001


def test_file_order_is_by_name_then_line(spark, tmp_path):
    """The larger file is read first but comes second."""
    (tmp_path / "b second.csv").write_text("DateTime,Junction,Vehicles\n" + "2024-01-01 00:00:00,1,3\n" * 500)
    (tmp_path / "a first.csv").write_text("DateTime,Vehicles,Junction\n2024-01-01 00:00:00,1,1\n2024-01-01 00:00:00,2,1\n")
    frame = source.load_readings(spark, str(tmp_path), keep_file_order=True)
    assert [r["Vehicles"] for r in frame.orderBy("SourceOrder").take(3)] == [1, 2, 3]
    assert frame.select("SourceOrder").distinct().count() == 502
    assert clean.keep_first(frame, "SourceOrder").first()["Vehicles"] == 1
    assert values(analysis.prepare(frame, "first", cap=False), "Vehicles") == [(1,)]


def test_log_holds_every_run_once(spark, tmp_path):
    rows = spark.createDataFrame([(1, "High", 5.0, 6.0, ["a", "b"]), (2, None, 1.0, 2.0, [])], recommend.HISTORY.removesuffix(", Run string"))
    path = str(tmp_path / "log")
    recommend.append_history(rows, path, "first")
    recommend.append_history(rows, path, "second")
    recommend.append_history(rows.where("Junction = 1"), path, "second")
    log = recommend.read_history(spark, path)
    assert values(log, "Run", "Junction") == [("first", 1), ("first", 2), ("second", 1)]
    assert values(recommend.read_history(spark, path, "second"), "Junction", "Recommendations") == [(1, ["a", "b"])]
    plan = recommend.read_history(spark, path, "second")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(Run" in plan or "PartitionFilters: [Run" in plan
