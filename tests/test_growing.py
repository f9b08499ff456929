"""Rollups that grow by files, versions that a failure can't tear, numbers in file order, quantiles of counts."""

import pathlib
import random
import statistics

import clicktally as ct
import numpy as np
import pytest
from clicktally.jobs import report, scalability
from clicktally.operators.quantiles import counted_quantiles
from clicktally.sinks import versions
from clicktally.sources.files import file_table
from clicktally.sources.scratch import scratch_path, scratch_scope
from compare import spark_rows
from edge_rows import LINES, write_edge_file

HEADER = LINES.splitlines()[0]


def month(folder, name, n, first=0):
    body = "\n".join(
        f"2019-{10 + i % 2}-0{1 + i % 9} x,{'purchase' if i % 3 else 'view'},{i},2,c,b{i % 4},{i / 100},5,s" for i in range(first, first + n)
    )
    return write_edge_file(folder, name, text=f"{HEADER}\n{body}\n")


class Reader:
    """Reads CSV and remembers which files."""

    def __init__(self):
        self.files = []

    def __call__(self, spark, paths):
        self.files += [path.rpartition("/")[2] for path in paths]
        return ct.read_events_csv(spark, paths, keep_rejected=True)


def test_a_new_month_is_all_that_is_read(spark, tmp_path):
    base, read = scratch_path(spark, "growing"), Reader()
    for name, n in (("2019-10.csv", 40), ("2019-11.csv", 70), ("2019-12.csv", 1)):
        month(tmp_path, f"in/{name}", n)
        grown = ct.update_rollup(spark, base, f"{tmp_path}/in/*.csv", read=read)
    assert read.files == ["2019-10.csv", "2019-11.csv", "2019-12.csv"]
    whole = ct.event_rollup(ct.read_events_csv(spark, f"{tmp_path}/in/*.csv", keep_rejected=True))
    assert spark_rows(grown) == spark_rows(whole)
    assert spark_rows(ct.daily_purchase_revenue_from_rollup(grown)) == spark_rows(ct.daily_purchase_revenue_from_rollup(whole))

    version = ct.current_version(spark, base)
    again = ct.update_rollup(spark, base, f"{tmp_path}/in/*.csv", read=read)
    assert len(read.files) == 3 and ct.current_version(spark, base) == version
    assert spark_rows(again) == spark_rows(whole)


def test_files_go_in_by_lots(spark, tmp_path):
    for i in range(7):
        month(tmp_path, f"in/{i}.csv", 5 + i, first=i)
    base, read = scratch_path(spark, "growing"), Reader()
    grown = ct.update_rollup(spark, base, f"{tmp_path}/in", recursive=True, file_name="*.csv", read=read, files_a_lot=3)
    assert sorted(read.files) == [f"{i}.csv" for i in range(7)]
    whole = ct.event_rollup(ct.read_events_csv(spark, f"{tmp_path}/in", keep_rejected=True))
    assert spark_rows(grown) == spark_rows(whole)


def test_a_run_that_dies_is_run_again(spark, tmp_path, monkeypatch):
    base = scratch_path(spark, "growing")
    month(tmp_path, "in/a.csv", 30)
    before = spark_rows(ct.update_rollup(spark, base, f"{tmp_path}/in/*.csv"))
    month(tmp_path, "in/b.csv", 20)

    def lost(*_):
        raise OSError("lost before the pointer was put")

    with monkeypatch.context() as patch:
        patch.setattr(versions, "_point", lost)
        with pytest.raises(OSError, match="lost"):
            ct.update_rollup(spark, base, f"{tmp_path}/in/*.csv")
    assert spark_rows(ct.read_growing_rollup(spark, base)) == before
    grown = ct.update_rollup(spark, base, f"{tmp_path}/in/*.csv")
    assert spark_rows(grown) == spark_rows(ct.event_rollup(ct.read_events_csv(spark, f"{tmp_path}/in/*.csv")))


def test_a_changed_file_is_an_error(spark, tmp_path):
    base = scratch_path(spark, "growing")
    month(tmp_path, "in/a.csv", 30)
    ct.update_rollup(spark, base, f"{tmp_path}/in/*.csv")
    month(tmp_path, "in/a.csv", 31)
    with pytest.raises(ValueError, match="a.csv has changed"):
        ct.update_rollup(spark, base, f"{tmp_path}/in/*.csv")


def test_no_rollup_before_the_first_file(spark, tmp_path):
    assert ct.read_growing_rollup(spark, f"{tmp_path}/none") is None
    (tmp_path / "in").mkdir()
    assert ct.update_rollup(spark, f"{tmp_path}/none", f"{tmp_path}/in", recursive=True) is None


def test_readers_see_one_whole_version(spark, tmp_path):
    base = f"{tmp_path}/table"
    assert ct.current_version(spark, base) is None
    first = ct.publish(spark, base, spark.range(3).write.parquet)
    assert ct.current_version(spark, base) == first
    reading = spark.read.parquet(first)

    def half(folder):
        spark.range(5).write.parquet(f"{folder}/part")
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        ct.publish(spark, base, half)
    assert ct.current_version(spark, base) == first
    second = ct.publish(spark, base, spark.range(7).write.parquet)
    assert spark.read.parquet(ct.current_version(spark, base)).count() == 7
    assert reading.count() == 3  # the version before stays for those that read it
    third = ct.publish(spark, base, spark.range(9).write.parquet)

    def kept():
        return sorted(p.name for p in (tmp_path / "table").iterdir() if p.name.startswith("v-"))

    assert {second, third} <= {f"{base}/{name}" for name in kept()}
    # What the failed attempt has left goes with the versions of its number.
    ct.publish(spark, base, spark.range(11).write.parquet)
    assert [name.split("-")[1] for name in kept()] == ["00000003", "00000004"]


def test_a_report_is_published_whole(spark, tmp_path, monkeypatch):
    source, out = write_edge_file(tmp_path, "in/edge.csv"), f"{tmp_path}/out"
    report.run(spark, [source, out, "--versions", "--count-rejected"])
    first = ct.current_version(spark, out)
    rows = spark.read.csv(f"{first}/input_rows", header=True, inferSchema=True).collect()
    assert [tuple(row) for row in rows] == [(11, 2)]

    original = report.write_result

    def fails_at_the_brands(result, base, name, **options):
        if name == "top10_brands":
            raise RuntimeError("lost")
        return original(result, base, name, **options)

    monkeypatch.setattr(report, "write_result", fails_at_the_brands)
    with pytest.raises(RuntimeError, match="lost"):
        report.run(spark, [source, out, "--versions"])
    assert ct.current_version(spark, out) == first
    assert spark.read.csv(f"{first}/top10_brands", header=True).count() > 0


def test_rejected_rows_come_from_the_rollup(spark, tmp_path):
    events = ct.read_events_csv(spark, write_edge_file(tmp_path), keep_rejected=True)
    assert [tuple(r) for r in ct.rejected_rows_from_rollup(ct.event_rollup(events)).collect()] == [(11, 2)]
    with pytest.raises(ValueError, match="CSV"):
        report.run(spark, [str(tmp_path), f"{tmp_path}/out", "--format", "parquet", "--count-rejected"])


@pytest.mark.parametrize("split", ["16k", "128m"])
def test_rows_of_several_files_are_numbered_by_name_and_line(spark, tmp_path, split):
    sizes = {"1.csv": 1, "2.csv": 50, "3.csv": 5000}
    number = 0
    for name, n in sizes.items():
        lines = [f"2019-11-01 x,view,1,2,,b,{number + i},5,s" for i in range(n)]
        write_edge_file(tmp_path, f"in/{name}", text="\n".join([HEADER, *lines]) + "\n")
        number += n
    previous = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        events = ct.read_events_csv(spark, f"{tmp_path}/in/*.csv")
        staged = ct.stage_events(events, scratch_path(spark, "staged"), file_order=True)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", previous)
    assert staged.columns == ["row_id", "event_type", "event_date", "brand", "price"]
    assert [(r.row_id, r.price) for r in staged.orderBy("row_id").collect()] == [(i, float(i)) for i in range(number)]
    assert ct.first_n(staged, 60, "row_id").count() == 60


def test_scratch_goes_with_its_scope(spark, tmp_path):
    shared = pathlib.Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"))
    outside = scratch_path(spark, "outside")
    spark.range(3).write.parquet(outside)
    with pytest.raises(RuntimeError, match="lost"), scratch_scope(spark):
        spark.range(3).write.parquet(scratch_path(spark, "first"))
        with scratch_scope(spark):
            spark.range(3).write.parquet(scratch_path(spark, "second"))
        assert not list(shared.glob("second-*"))
        assert list(shared.glob("first-*"))
        raise RuntimeError("lost")
    assert not list(shared.glob("first-*"))
    assert spark.read.parquet(outside).count() == 3


def test_jobs_leave_no_scratch_behind(spark, tmp_path):
    shared = pathlib.Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"))
    before = set(shared.iterdir())
    scalability.run(spark, [write_edge_file(tmp_path), f"{tmp_path}/out", "--sizes", "5", "--repeats", "1"])
    assert set(shared.iterdir()) == before


def test_file_table(spark, tmp_path):
    for name in ("a/x.csv", "a/b/x.csv", "a/b/y.csv"):
        write_edge_file(tmp_path, name)
    found = file_table(spark, str(tmp_path), recursive=True, file_name="x.csv").collect()
    assert sorted(r.path.rpartition(str(tmp_path))[2] for r in found) == ["/a/b/x.csv", "/a/x.csv"]
    assert all(r.length > 0 and r.modified for r in found)


@pytest.mark.parametrize("partitions", [1, 5])
def test_quantiles_of_counts_are_those_of_the_rows(spark, partitions):
    rng = random.Random(partitions)
    rows = [("hot", rng.choice([0.5, 1.25, 3.0, rng.random() * 100])) for _ in range(4000)]
    rows += [(f"g{i % 60}", rng.randint(1, 9) / 4) for i in range(900)] + [("one", 7.0), ("two", 1.0), ("two", 2.0), (None, 4.0)]
    counts = spark.createDataFrame(rows, "g string, v double").groupBy("g", "v").count()
    previous = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        names = {"least": 0.0, "low": 0.25, "middle": 0.5, "high": 0.75, "most": 1.0}
        found = {r.g: r for r in counted_quantiles(counts, "g", "v", "count", names).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", previous)
    groups = {}
    for g, v in rows:
        groups.setdefault(g, []).append(v)
    assert set(found) == set(groups) - {None}
    for g, values in groups.items():
        if g is not None:
            wanted = np.quantile(values, list(names.values()))
            assert [found[g][name] for name in names] == pytest.approx(wanted.tolist(), abs=1e-12)
            assert found[g]["count"] == len(values) and found[g].middle == pytest.approx(statistics.median(values))


def test_quantiles_of_nothing(spark):
    empty = spark.createDataFrame([], "g string, v double, n bigint")
    assert counted_quantiles(empty, "g", "v", "n", {"middle": 0.5}).count() == 0


def test_price_counts_add_up(spark):
    events = spark.createDataFrame(
        [("purchase", "a", p) for p in (1.0, 2.0, 2.0, 10.0, None, -1.0, 0.0, float("nan"))] + [("view", "a", 9.0), ("purchase", "", 1.0)],
        "event_type string, brand string, price double",
    )
    counts = ct.price_counts(events)
    quartiles = ct.brand_price_quartiles(counts.unionByName(counts)).collect()
    assert [tuple(r) for r in quartiles] == [("a", 8, 1.75, 2.0, 4.0)]
