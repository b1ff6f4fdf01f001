import json

import pytest
from pyspark.sql import functions as F

from helpers import rows_of
import tables
from tallyforge.plans import integration
from tallyforge.sources import incremental, readers, writers
from tallyforge.streaming import activity


def test_empty_source_is_rejected(spark):
    spark.createDataFrame([], "a int").createOrReplaceTempView("nothing_here")
    with pytest.raises(readers.EmptySourceError):
        readers.read_table(spark, "nothing_here")


def test_fallback_on_missing_empty_and_failed_check(spark, folder):
    backup = f"{folder}/backup"
    spark.range(3).write.parquet(backup)
    assert readers.read_with_fallback(spark, "not_a_table", backup).count() == 3
    spark.createDataFrame([], "id long").createOrReplaceTempView("empty_source")
    assert readers.read_with_fallback(spark, "empty_source", backup).count() == 3
    spark.range(7).createOrReplaceTempView("full_source")
    assert readers.read_with_fallback(spark, "full_source", backup).count() == 7

    def reject(df):
        raise ValueError("no")

    assert readers.read_with_fallback(spark, "full_source", backup, reject).count() == 3


def test_csv_options(spark, folder):
    path = f"{folder}/in.csv"
    with open(path, "w", encoding="utf-8") as f:
        f.write("a;b\n1;'x;y'\n2;'z'\n")
    df = readers.read_csv(spark, path, sep=";", quote="'", register_as="from_csv")
    assert df.dtypes == [("a", "int"), ("b", "string")]
    assert spark.table("from_csv").collect()[0].b == "x;y"


def test_staged_write_replaces_or_keeps(spark, folder):
    final, staging, rejected = f"{folder}/final", f"{folder}/staging", f"{folder}/rejected"
    assert writers.staged_write(spark.range(5), final, staging, rejected) == 5
    with pytest.raises(writers.StagedWriteError):
        writers.staged_write(spark.range(9), final, staging, rejected, validate=lambda df: False)
    assert spark.read.parquet(final).count() == 5  # old output untouched
    assert spark.read.parquet(f"{rejected}/*").count() == 9  # rejected output kept
    with pytest.raises(writers.StagedWriteError):
        writers.staged_write(spark.range(0), final, staging, rejected)
    assert writers.staged_write(spark.range(2), final, staging, rejected) == 2
    assert spark.read.parquet(final).count() == 2


def test_checkpointed_step_runs_once(spark, folder):
    calls = []

    def compute():
        calls.append(1)
        return spark.range(4)

    assert writers.load_step(spark, folder, "job", "step") is None
    for _ in range(2):
        assert writers.checkpointed(spark, folder, "job", "step", compute).count() == 4
    assert len(calls) == 1


def test_cap_categories(spark):
    rows = [("a",)] * 5 + [("b",)] * 3 + [("c",)] * 3 + [("d",)] + [(None,)]
    df = spark.createDataFrame(rows, "c string")
    out = {r.c_partition: r["count"] for r in writers.cap_categories(df, "c", 3).groupBy("c_partition").count().collect()}
    assert out == {"a": 5, "b": 3, "others": 5}
    kept = {r.c_partition for r in writers.cap_categories(df, "c", 5).select("c_partition").distinct().collect()}
    assert kept == {"a", "b", "c", "d", None}


def test_target_partitions():
    assert writers.target_partitions(0, 100.0) == 1
    assert writers.target_partitions(1_000_000, 1024.0, 128) == 7


def test_size_files(spark):
    df = spark.range(20000).select(F.col("id"), F.lpad(F.lit("x"), 1000, "x").alias("t"))
    assert writers.size_files(df, target_mb=5).rdd.getNumPartitions() in (3, 4)


def test_sized_files_come_from_one_pass(spark, folder):
    rows = spark.range(200_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("h"))
    seen = spark.sparkContext.accumulator(0)
    counted = rows.mapInPandas(lambda it: (seen.add(len(b)) or b for b in it), rows.schema)
    writers.write_sized(counted, f"{folder}/a", target_mb=2)
    assert seen.value == 200_000
    report = readers.file_report(spark.read.parquet(f"{folder}/a")).collect()
    assert sum(r.record_count for r in report) == 200_000 and len(report) > 3
    assert max(r.file_size_mb for r in report) < 5
    assert abs(writers.written_row_bytes(spark, f"{folder}/a") - sum(r.file_size_bytes for r in report) / 200_000) < 1e-6
    writers.write_sized(rows, f"{folder}/b", target_mb=1, like=f"{folder}/a")
    assert max(r.file_size_mb for r in readers.file_report(spark.read.parquet(f"{folder}/b")).collect()) < 1.3
    assert writers.written_row_bytes(spark, f"{folder}/none") is None


def test_partition_pruning_and_pushdown(spark, folder):
    path = f"{folder}/p"
    df = spark.range(1000).select(F.col("id"), (F.col("id") % 4).alias("part"), F.col("id").cast("string").alias("wide"))
    writers.write_parquet(df, path, ["part"])
    plan = spark.read.parquet(path).filter((F.col("part") == 2) & (F.col("id") > 10)).select("id")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(part" in text and "PushedFilters: [IsNotNull(id), GreaterThan(id,10)]" in text
    assert "ReadSchema: struct<id:bigint>" in text


def test_external_table_lists_partitions(spark, folder):
    writers.write_parquet(spark.range(10).withColumn("g", F.col("id") % 2), f"{folder}/t", ["g"])
    t = writers.create_partitioned_table(spark, "ext_table_test", "id long, g long", "g", f"{folder}/t")
    assert t.count() == 10
    assert spark.sql("SHOW PARTITIONS ext_table_test").count() == 2


def test_incremental_load_reads_each_file_once(spark, folder):
    df = spark.range(10)
    df.write.parquet(f"{folder}/in")
    args = (spark, f"{folder}/in", df.schema, f"{folder}/out", f"{folder}/mark")
    assert incremental.load_new_files(*args) == 10
    assert incremental.load_new_files(*args) == 0
    spark.range(10, 15).write.mode("append").parquet(f"{folder}/in")
    assert incremental.load_new_files(*args, transform=lambda d: d.filter("id > 11")) >= 3
    assert sorted(r.id for r in incremental.loaded(spark, f"{folder}/out").collect()) == [*range(10), 12, 13, 14]


def test_load_that_dies_before_its_commit_is_repeated_once(spark, folder, monkeypatch):
    from tallyforge.streaming import ledger

    df = spark.range(10)
    df.write.parquet(f"{folder}/in")
    args = (spark, f"{folder}/in", df.schema, f"{folder}/out", f"{folder}/mark")
    enter, died = ledger.enter, []

    def die_once(*a, **k):
        if not died:
            died.append(1)
            raise RuntimeError("killed between write and commit")
        enter(*a, **k)

    monkeypatch.setattr(ledger, "enter", die_once)
    with pytest.raises(Exception, match="killed"):
        incremental.load_new_files(*args)
    assert incremental.loaded(spark, f"{folder}/out").count() == 10  # written, not committed
    assert incremental.load_new_files(*args) == 10
    assert incremental.loaded(spark, f"{folder}/out").count() == 10
    assert incremental.load_new_files(*args) == 0


@pytest.mark.parametrize("cap", [2, 4])
def test_cap_keeps_type_and_nulls_alike(spark, cap):
    df = spark.createDataFrame([(1,), (1,), (1,), (None,), (None,), (2,), (3,)], "c int")
    out = writers.cap_categories(df, "c", cap)
    assert dict(out.dtypes)["c_partition"] == "string"
    found = {r.c_partition: r["count"] for r in out.groupBy("c_partition").count().collect()}
    assert found == ({"1": 3, "others": 4} if cap == 2 else {"1": 3, None: 2, "2": 1, "3": 1})


def test_rows_after(spark):
    df = spark.range(10)
    assert incremental.rows_after(df, df.filter("id < 6"), "id").count() == 4
    assert incremental.rows_after(df, df.filter("id < 0"), "id").count() == 10


def test_rows_after_at_the_bookmark(spark):
    done = spark.createDataFrame([(1, 5), (2, 7), (3, None)], "k int, v int")
    df = spark.createDataFrame([(1, 5), (2, 7), (4, 7), (3, None), (5, None), (6, 8), (7, 6)], "k int, v int")
    assert sorted(r.k for r in incremental.rows_after(df, done, "v", ["k"]).collect()) == [4, 5, 6]
    assert incremental.rows_after(df, done, "v", []).count() == 1
    assert sorted(r.k for r in incremental.rows_after(df, done, "v").collect()) == [4, 5, 6]
    nulls = spark.createDataFrame([(None, 7), (None, None)], "k int, v int")
    assert incremental.rows_after(nulls, nulls, "v").count() == incremental.rows_after(nulls, nulls, "v", ["k"]).count() == 0
    assert incremental.rows_after(df, done.limit(0), "v").count() == incremental.rows_after(df, done.limit(0), "v", []).count() == 7


def test_backlog_in_many_batches(spark, folder):
    rows = spark.range(130)
    rows.repartition(130).write.parquet(f"{folder}/in")
    assert incremental.load_new_files(spark, f"{folder}/in", rows.schema, f"{folder}/out", f"{folder}/state", files_per_batch=1) == 130
    assert incremental.loaded(spark, f"{folder}/out").count() == 130


def run_stream(stream, spark, folder, name):
    activity.write_windows(stream, f"{folder}/{name}", f"{folder}/{name}-state").awaitTermination()
    return spark.read.parquet(f"{folder}/{name}")


def test_stream_equals_batch_on_closed_windows(spark, folder):
    logs = tables.visits(spark, 3000)
    logs.write.json(f"{folder}/in")
    timed = activity.with_event_time(activity.read_json_stream(spark, f"{folder}/in"), delay="30 minutes")
    got = run_stream(activity.window_summary(timed), spark, folder, "out").drop("window_date")
    batch = logs.withColumn("event_time", F.col("timestamp").cast("timestamp"))
    last = batch.agg(F.max("event_time") - F.expr("INTERVAL 30 MINUTES")).first()[0]
    want = (
        batch.groupBy(F.window("event_time", "10 minutes").alias("w"), "ai_tool_used")
        .agg(F.count(F.lit(1)).alias("activity_count"), F.avg("session_duration").alias("avg_value"), F.count_distinct("student_id").alias("unique_actors"))
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "ai_tool_used", "activity_count", "avg_value", "unique_actors")
        .filter(F.col("window_end") <= F.lit(last))
    )
    assert rows_of(got) == rows_of(want)


def event(minute, student="s1", tool="A", key="e"):
    return json.dumps({"student_id": student, "timestamp": f"2024-01-01T{minute // 60:02d}:{minute % 60:02d}:00", "session_duration": 10, "ai_tool_used": tool, "activity_type": key})


def put(folder, name, *events):
    with open(f"{folder}/{name}.json", "w") as f:
        f.write("\n".join(events))


def test_late_rows_are_dropped_and_restart_adds_nothing(spark, folder):
    import os

    source = f"{folder}/in"
    os.mkdir(source)
    put(source, "a", event(5), event(125))

    def run():
        timed = activity.with_event_time(activity.read_json_stream(spark, source), delay="30 minutes")
        return run_stream(activity.window_summary(timed), spark, folder, "out")

    assert run().agg(F.sum("activity_count")).first()[0] == 1
    put(source, "b", event(6), event(300))  # minute 6 is behind the watermark
    out = run()
    assert sorted(r.activity_count for r in out.collect()) == [1, 1]
    assert run().count() == 2


def late_windows(folder):
    from tallyforge.streaming.late import LateAwareWindows

    return LateAwareWindows(f"{folder}/out", 600, 1800, actor="student_id")


def take(windows, spark, folder):
    rows = activity.read_json_stream(spark, f"{folder}/in").withColumn("event_time", F.col("timestamp").cast("timestamp"))
    windows.start(rows, f"{folder}/mark").awaitTermination()


def test_no_event_is_lost(spark, folder):
    import os

    os.mkdir(f"{folder}/in")
    windows = late_windows(folder)
    put(f"{folder}/in", "a", event(5), event(5, "s2"), event(125), json.dumps({"student_id": "s9"}))
    take(windows, spark, folder)
    put(f"{folder}/in", "b", event(6), event(96), event(94), event(300))  # 6 and 84 are behind 95 minutes; the window of 94 is still open
    take(windows, spark, folder)
    take(windows, spark, folder)
    closed = windows.windows(spark)
    assert sorted((r.window_start.hour * 60 + r.window_start.minute, r.activity_count, r.unique_actors) for r in closed.collect()) == [(0, 2, 2), (90, 2, 1), (120, 1, 1)]
    windows.close(spark)
    assert windows.windows(spark).agg(F.sum("activity_count")).first()[0] == 6
    assert windows.late(spark).count() == 2
    assert sorted(map(tuple, windows.batches(spark).select("batch", "rows", "late", "untimed").collect())) == [(0, 4, 1, 1), (1, 4, 1, 0)]


def test_a_repeated_batch_changes_nothing(spark, folder):
    windows = late_windows(folder)
    kinds = "student_id string, ai_tool_used string, session_duration int, event_time timestamp"
    first = spark.createDataFrame([("s1", "A", 10)], "student_id string, ai_tool_used string, session_duration int").withColumn("event_time", F.lit("2024-01-01 00:05:00").cast("timestamp"))
    second = first.withColumn("event_time", F.lit("2024-01-01 05:00:00").cast("timestamp")).unionByName(first)
    for number, rows in ((0, first), (1, second), (1, second), (0, first), (1, second)):
        windows.step(rows, number)
    windows.step(spark.createDataFrame([], kinds), 2)
    windows.close(spark)
    windows.close(spark)
    assert sorted(r.activity_count for r in windows.windows(spark).collect()) == [1, 2]  # the watermark moves after the batch
    assert windows.late(spark).count() == 0 and windows.batches(spark).agg(F.sum("rows")).first()[0] == 3


def test_stream_dedup_within_watermark(spark, folder):
    import os

    source = f"{folder}/in"
    os.mkdir(source)
    put(source, "a", event(1, key="x"), event(1, key="x"), event(2, key="y"), event(200, key="z"))
    timed = activity.with_event_time(activity.read_json_stream(spark, source), delay="30 minutes")
    out = run_stream(activity.window_summary(activity.dedup(timed, ["activity_type"])), spark, folder, "out")
    assert out.agg(F.sum("activity_count")).first()[0] == 2


def test_sketch_variant_runs(spark, folder):
    tables.visits(spark, 500).write.json(f"{folder}/in")
    timed = activity.with_event_time(activity.read_json_stream(spark, f"{folder}/in"))
    assert run_stream(activity.window_summary(timed, rsd=0.02), spark, folder, "out").count() > 0


def test_payload_parsing(spark):
    df = spark.createDataFrame([(bytearray(event(1).encode()),)], "value binary")
    assert activity.parse_payload(df).first().student_id == "s1"
    flat = activity.flatten_json(spark.createDataFrame([(1, '{"device":"tablet","location":"home"}'), (2, "broken")], "id int, metadata string"))
    assert [tuple(r) for r in flat.collect()] == [(1, "tablet", "home"), (2, None, None)]


def test_integration_run_writes_all_outputs(spark, folder):
    tables.tool_survey(spark).createOrReplaceTempView("ai_tool_usage")
    tables.marks(spark).createOrReplaceTempView("academic_performance")
    tables.enrolments(spark).createOrReplaceTempView("course_enrollment")
    paths = integration.run(spark, folder)
    integrated = spark.read.parquet(paths["integrated"])
    assert integrated.count() == 500
    assert integrated.filter(F.col("total_courses").isNull()).count() > 0  # left join keeps students without courses
    assert spark.read.parquet(paths["insights"]).filter("student_count < 5").count() == 0
    assert set(spark.read.parquet(paths["outliers"]).columns) >= {"outlier_type", "gpa_z_score"}


def test_school_run(spark, folder):
    from tallyforge.operators.joins import assign_weighted

    schools = tables.school_list(spark)
    assigned = assign_weighted(tables.exams(spark), "student_id", schools, "school_id", "student_count")
    paths = integration.run_schools(assigned, schools, tables.regions(spark), folder)
    detailed = spark.read.parquet(paths["detailed-school-analysis"])
    assert detailed.agg(F.sum("total_students")).first()[0] == 1000
    best = detailed.filter("regional_rank = 1").collect()
    assert {r.regional_percentile for r in best} == {1.0} and len(best) == 3


def test_publication_survives_a_crash_at_every_step(spark, folder, monkeypatch):
    from tallyforge.sources import published

    root = f"{folder}/out"
    with pytest.raises(FileNotFoundError):
        published.current(spark, root)
    assert published.publish(spark.range(10), root) == 1

    def dies(*a, **k):
        raise RuntimeError("killed")

    put = published._put_manifest
    for step in ("before the manifest", "within the manifest"):
        torn = dies if step.startswith("before") else lambda s, r, n, text: put(s, r, n, text[: len(text) // 2]) or dies()
        monkeypatch.setattr(published, "_put_manifest", torn)
        with pytest.raises(RuntimeError):
            published.publish(spark.range(20), root)
        monkeypatch.setattr(published, "_put_manifest", put)
        assert published.current(spark, root).count() == 10
    with pytest.raises(writers.StagedWriteError):
        published.publish(spark.range(0), root)
    with pytest.raises(writers.StagedWriteError):
        published.publish(spark.range(5), root, validate=lambda d: d.count() > 9)
    assert published.current(spark, root).count() == 10
    assert published.publish(spark.range(30), root) == 3  # the torn one keeps its number
    assert published.current(spark, root).count() == 30 and published.current(spark, root, 1).count() == 10
    with pytest.raises(Exception, match="exist"):
        published._put_manifest(spark, root, 3, "another writer")
    assert published.retire(spark, root, 1) == [1] and published.current(spark, root).count() == 30


def test_integration_run_joins_its_tables_once(spark, sf_dir):
    from workload import QUERIES

    old = {t.name for t in spark.catalog.listTables()}
    QUERIES["integration_run"](spark, sf_dir)
    views = {t.name for t in spark.catalog.listTables()} - old
    assert sorted(v.split("_")[0] for v in views) == ["academic", "enrollment", "usage"]
    for view in views:
        plan = spark.table(view)._jdf.queryExecution().executedPlan().toString()
        assert "Join" not in plan and "Aggregate" not in plan
