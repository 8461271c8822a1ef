"""Raw files are taken in once, whatever happens between two runs."""

import pytest
from pyspark.errors import StreamingQueryException

from ledgermart.plans import medallion
from ledgermart.plans.lake import Lake
from ledgermart.sources import stores
from ledgermart.sources.sample_tables import SampleTables

HEAD = "Customer_ID,snapshot_date,fe_1\n"


@pytest.fixture()
def place(tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()

    def put(name, *rows, head=HEAD):
        (folder / name).write_text(head + "".join(f"{r}\n" for r in rows))

    return put, str(folder), Lake(str(tmp_path / "lake"))


def _landed(spark, lake):
    rows = spark.read.parquet(lake.landed("clickstream")).select("Customer_ID", "snapshot_date", "fe_1", "data_source")
    return sorted((r[0], str(r[1]), r[2], r[3]) for r in rows.collect())


def _rejected(spark, lake):
    rows = spark.read.parquet(lake.landed_rejects("clickstream")).collect()
    return sorted((r["Customer_ID"], r["reject_reason"], r["source_file"].rpartition("/")[2]) for r in rows)


FIRST = [("a", "2024-01-01", "1", "clickstream"), ("a", "2024-01-01", "1", "clickstream")]
SECOND = [("b", "2024-02-01", None, "clickstream"), ("c", "2024-01-01", "3", "clickstream")]


def test_a_second_run_reads_new_files_only_and_keeps_rejects(spark, place):
    put, folder, lake = place
    put("one.csv", "a,2024-01-01,1", "a,2024-01-01,1", "x,never,2")
    medallion.land(spark, lake, "clickstream", folder)
    assert _landed(spark, lake) == FIRST
    put("one.csv", "not,2024-01-01,read", "y,never,again")
    put("two.csv", "b,2024-02-01,", "c,2024-01-01,3", "z,2024-02-15,4")
    for _ in range(2):
        medallion.land(spark, lake, "clickstream", folder)
        assert _landed(spark, lake) == sorted(FIRST + SECOND)
        assert _rejected(spark, lake) == [("x", "unreadable date", "one.csv"), ("z", "not a first of month", "two.csv")]


def test_a_run_that_ended_between_the_stores_is_finished_by_the_next(spark, place, monkeypatch):
    put, folder, lake = place
    put("one.csv", "a,2024-01-01,1", "a,2024-01-01,1", "x,never,2")
    append, calls = stores.append_new, []

    def once(*args):
        calls.append(args)
        if len(calls) == 2:
            raise RuntimeError("lost")
        append(*args)

    monkeypatch.setattr(stores, "append_new", once)
    with pytest.raises(RuntimeError, match="lost"):
        medallion.land(spark, lake, "clickstream", folder)
    medallion.land(spark, lake, "clickstream", folder)
    assert _landed(spark, lake) == FIRST
    assert _rejected(spark, lake) == [("x", "unreadable date", "one.csv")]


def test_a_batch_without_its_commit_is_written_once(spark, place, tmp_path):
    put, folder, lake = place
    put("one.csv", "a,2024-01-01,1", "a,2024-01-01,1")
    medallion.land(spark, lake, "clickstream", folder)
    commits = tmp_path / "lake" / "landing_progress" / "clickstream" / "rows" / "commits"
    for name in ("0", ".0.crc"):
        (commits / name).unlink()
    put("two.csv", "b,2024-02-01,", "c,2024-01-01,3")
    medallion.land(spark, lake, "clickstream", folder)
    assert _landed(spark, lake) == sorted(FIRST + SECOND)


def test_other_columns_are_an_error_until_corrected_in_place(spark, place):
    put, folder, lake = place
    columns = HEAD.strip().split(",")
    put("one.csv", "a,2024-01-01,1", "a,2024-01-01,1")
    medallion.land(spark, lake, "clickstream", folder, columns)
    put("two.csv", "2024-02-01,b,", "2024-01-01,c,3", head="snapshot_date,Customer_ID,fe_1\n")
    with pytest.raises(StreamingQueryException):
        medallion.land(spark, lake, "clickstream", folder, columns)
    assert _landed(spark, lake) == FIRST
    put("two.csv", "b,2024-02-01,", "c,2024-01-01,3")
    medallion.land(spark, lake, "clickstream", folder, columns)
    assert _landed(spark, lake) == sorted(FIRST + SECOND)


def test_months_that_land_one_by_one_give_the_stores_of_one_run(spark, small_dir, tmp_path):
    tables, whole, folders = SampleTables(spark, small_dir), {}, {}
    months = ["1997-01-01", "1997-02-01"]
    frames = {s: getattr(tables, s).toPandas() for s in ("loans", "clickstream", "attributes", "financials")}
    for source, frame in frames.items():
        folders[source] = str(tmp_path / source)
        (tmp_path / source).mkdir()
        frame = frame[frame["snapshot_date"].astype(str).isin(months)]
        whole[source] = str(tmp_path / f"{source}.csv")
        frame.to_csv(whole[source], index=False)
        frames[source] = frame
    step, once = Lake(str(tmp_path / "step")), Lake(str(tmp_path / "once"))
    for month in months:
        for source, frame in frames.items():
            frame[frame["snapshot_date"].astype(str) == month].to_csv(f"{folders[source]}/{month}.csv", index=False)
        medallion.run_medallion(spark, step, folders, month, month, months=1, history_start=months[0], landed=True)
    medallion.run_medallion(spark, once, whole, months[0], months[1], months=1)
    for source in frames:
        a, b = (spark.read.parquet(x.silver(source)).drop("ingestion_timestamp") for x in (step, once))
        assert a.count() == b.count() > 0
        assert a.exceptAll(b.select(a.columns)).count() == 0
    features = [spark.read.parquet(x.features).count() for x in (step, once)]
    assert features[0] == features[1] > 0
    report = medallion.medallion_report(spark, step, months[0], months[1], landed=True).collect()
    assert all(r["success"] for r in report if r["store"].startswith(("bronze", "silver")))
