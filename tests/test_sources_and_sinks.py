"""Reading event files and writing results."""

import glob

import clicktally as ct
import pytest
from clicktally.schema import event_columns
from clicktally.sources.scratch import scratch_path
from edge_rows import LINES, write_edge_file
from pyspark.sql import functions as F

HEADER = LINES.splitlines()[0]


def test_schema_is_applied_without_inference(spark, tmp_path):
    events = ct.read_events_csv(spark, write_edge_file(tmp_path))
    assert events.columns == event_columns()
    assert dict(events.dtypes)["price"] == "double"
    assert events.count() == 11


def test_bad_numbers_become_null_and_are_counted(spark, tmp_path):
    path = write_edge_file(tmp_path)
    assert ct.read_events_csv(spark, path).filter("product_id IS NULL").count() == 1
    rejected = ct.rejected_rows(ct.read_events_csv(spark, path, keep_rejected=True))
    assert [tuple(row) for row in rejected.collect()] == [(11, 2)]


def test_swapped_header_fails_the_read(spark, tmp_path):
    swapped = HEADER.replace("event_time,event_type", "event_type,event_time")
    path = write_edge_file(tmp_path, text=f"{swapped}\npurchase,2019-11-01 00:00:00 UTC,1,2,a,b,1,5,s\n")
    with pytest.raises(Exception, match="(?i)header|FAILED_READ_FILE"):
        ct.read_events_csv(spark, path).select("event_type").collect()


def test_texts_that_look_missing_stay_text(spark, tmp_path):
    body = "\n".join(f"2019-11-01 x,purchase,1,2,,{brand},1,5,s" for brand in ("NA", "null", "None"))
    events = ct.read_events_csv(spark, write_edge_file(tmp_path, text=f"{HEADER}\n{body}\n"))
    assert {row[0] for row in events.select("brand").collect()} == {"NA", "null", "None"}


def test_several_paths_and_globs(spark, tmp_path):
    october = write_edge_file(tmp_path, "2019-Oct.csv")
    november = write_edge_file(tmp_path, "2019-Nov.csv")
    write_edge_file(tmp_path, "2018-Nov.csv")
    assert ct.read_events_csv(spark, [october, november]).count() == 22
    assert ct.read_events_csv(spark, f"{tmp_path}/2019-*.csv").count() == 22


def test_recursive_search_reads_every_match(spark, tmp_path):
    for name in ("a/2019-Nov.csv", "a/b/2019-Nov.csv", "a/b/other.csv"):
        write_edge_file(tmp_path, name)
    found = ct.read_events_csv(spark, str(tmp_path), recursive=True, file_name="2019-Nov.csv")
    assert found.count() == 22


def test_recursive_search_without_a_match(spark, tmp_path):
    write_edge_file(tmp_path, "a/other.csv")
    with pytest.raises(FileNotFoundError):
        ct.read_events_csv(spark, str(tmp_path), recursive=True, file_name="2019-Nov.csv")


def test_required_columns(spark):
    events = spark.createDataFrame([], ", ".join(f"{name} string" for name in event_columns()))
    assert ct.require_columns(events) is events
    with pytest.raises(ValueError, match="brand, price"):
        ct.require_columns(events.drop("price", "brand"))
    with pytest.raises(ValueError, match="nope"):
        ct.require_columns(events, ["brand", "nope"])


def test_parquet_reader_checks_columns(spark, tmp_path):
    events = ct.read_events_csv(spark, write_edge_file(tmp_path))
    events.write.parquet(f"{tmp_path}/good")
    events.drop("price").write.parquet(f"{tmp_path}/bad")
    assert ct.read_events_parquet(spark, f"{tmp_path}/good").count() == 11
    with pytest.raises(ValueError, match="price"):
        ct.read_events_parquet(spark, f"{tmp_path}/bad")


def test_staged_rows_follow_the_file(spark, tmp_path):
    """Reading order equals line order although the file is cut into many splits."""
    body = "\n".join(f"2019-11-01 x,view,1,2,,b{i},{i},5,s" for i in range(5000))
    path = write_edge_file(tmp_path, text=f"{HEADER}\n{body}\n")
    previous = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        events = ct.read_events_csv(spark, path)
        assert events.rdd.getNumPartitions() > 4
        staged = ct.stage_events(events, scratch_path(spark, "staged"))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", previous)
    assert staged.columns == ["row_id", "event_type", "event_date", "brand", "price"]
    first = ct.first_n(staged, 1234, "row_id")
    assert sorted(row[0] for row in first.select("price").collect()) == list(map(float, range(1234)))
    assert [row[0] for row in staged.orderBy("row_id").select("price").collect()] == list(map(float, range(5000)))


def test_result_is_one_file_and_reads_back(spark, tmp_path):
    result = spark.range(1000).select("id", (F.col("id") / 8).alias("x")).repartition(7).orderBy("id")
    path = ct.write_result(result, str(tmp_path), "numbers", single_file=True)
    assert len(glob.glob(f"{path}/part-*.csv")) == 1
    back = ct.read_result(spark, path, result.schema)
    assert back.collect() == result.collect()
    ct.write_result(result.limit(3), str(tmp_path), "numbers")
    assert ct.read_result(spark, path, result.schema).count() == 3


def test_result_of_unbounded_size_keeps_its_partitions(spark, tmp_path):
    result = spark.range(0, 1000, numPartitions=4)
    path = ct.write_result(result, str(tmp_path), "many")
    assert len(glob.glob(f"{path}/part-*.csv")) == 4
    assert ct.read_result(spark, path, result.schema).count() == 1000


def test_preview_prints_what_was_written(spark, tmp_path, capsys):
    ct.write_result(spark.range(3), str(tmp_path), "shown", preview_rows=2)
    assert "only showing top 2 rows" in capsys.readouterr().out


def test_writing_with_preview_runs_the_query_once(spark, tmp_path):
    runs = spark.sparkContext.accumulator(0)

    def counted(batches):
        runs.add(1)
        yield from batches

    result = spark.range(0, 3, numPartitions=1).mapInPandas(counted, "id bigint")
    ct.write_result(result, str(tmp_path), "once", preview_rows=3, single_file=True)
    assert runs.value == 1


def test_dates_are_written_as_iso_text(spark, tmp_path):
    path = ct.write_result(spark.sql("SELECT DATE '2019-11-01' AS event_date"), str(tmp_path), "day", single_file=True)
    (part,) = glob.glob(f"{path}/part-*.csv")
    assert open(part).read().split() == ["event_date", "2019-11-01"]


def test_scratch_path_uses_the_shared_folder(spark):
    assert scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


class ClusterSession:
    """Stands in for a session on a cluster that names no shared folder."""

    class conf:
        @staticmethod
        def get(name, default=None):
            return {"spark.master": "yarn"}.get(name, default)


def test_no_machine_local_scratch_on_a_cluster():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_path(ClusterSession, "x")


def test_texts_come_back_as_they_were(spark, tmp_path):
    texts = ["   ", " lg ", "lg", "", None, 'a "b" c', "a,b", "two\nlines", '"', "\\N", "\\", "NULL"]
    result = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "n int, brand string")
    path = ct.write_result(result, str(tmp_path), "texts")
    back = ct.read_result(spark, path, result.schema)
    assert [row["brand"] for row in back.orderBy("n").collect()] == texts


def test_search_finds_files_without_events(spark, tmp_path):
    write_edge_file(tmp_path, "a/2019-Nov.csv", text=f"{HEADER}\n")
    found = ct.read_events_csv(spark, str(tmp_path), recursive=True, file_name="2019-Nov.csv")
    assert found.count() == 0


def test_timestamps_give_the_same_day_in_any_zone(spark, tmp_path):
    events = ct.read_events_csv(spark, write_edge_file(tmp_path)).filter("event_type = 'purchase'")
    previous = spark.conf.get("spark.sql.session.timeZone")
    events.withColumn("event_time", F.expr("timestamp '2019-11-01 23:30:00 UTC'")).write.parquet(f"{tmp_path}/zoned")
    try:
        for zone in ("UTC", "Asia/Tokyo", "America/Los_Angeles"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            daily = ct.daily_purchase_revenue(ct.read_events_parquet(spark, f"{tmp_path}/zoned"))
            assert [str(row["event_date"]) for row in daily.collect()] == ["2019-11-01"], zone
    finally:
        spark.conf.set("spark.sql.session.timeZone", previous)


def test_parquet_types_are_converted_or_rejected(spark, tmp_path):
    events = ct.read_events_csv(spark, write_edge_file(tmp_path))
    events.withColumn("price", F.col("price").cast("float")).withColumn("user_id", F.col("user_id").cast("int")).write.parquet(
        f"{tmp_path}/narrow"
    )
    assert dict(ct.read_events_parquet(spark, f"{tmp_path}/narrow").dtypes)["price"] == "double"
    events.withColumn("price", F.array("price")).write.parquet(f"{tmp_path}/unfit")
    with pytest.raises(ValueError, match="price .array"):
        ct.read_events_parquet(spark, f"{tmp_path}/unfit")


def test_an_event_date_that_is_no_date_is_derived_anew(spark):
    events = spark.createDataFrame([("2019-11-01 x", "whatever")], "event_time string, event_date string")
    assert str(ct.missing_days(events).schema["event_date"].dataType) == "DateType()"


def test_a_failed_rollup_leaves_the_old_one(spark, tmp_path):
    from clicktally.plans.rollup import write_rollup

    path = f"{tmp_path}/rollup"
    events = ct.read_events_csv(spark, write_edge_file(tmp_path))
    before = write_rollup(events, path).count()
    with pytest.raises(Exception, match="lost"):
        write_rollup(events.withColumn("price", F.raise_error(F.lit("lost")).cast("double")), path)
    assert spark.read.parquet(path).count() == before
