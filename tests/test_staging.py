"""Staging and merging whole streams."""

import datetime

import pytest
from pyspark.sql import functions as F

from millrace.functions.types import ColumnSpec as C
from millrace.operators import merge as m
from millrace.operators import months
from millrace.operators.staging import latest_payloads, stage
from millrace.plans.raw_stream import load_stream
from millrace.session import TASK_SETTINGS, folder_names, pin_session, shared_folder
from millrace.sources.landing import RAW_DATA, RAW_ID, RAW_TIME

CDC = [
    C("id", "id", "integer", is_key=True), C("v", "v", "string"),
    C("ab_cdc_cursor", "_ab_cdc_cursor", "integer"),
    C("ab_cdc_updated_at", "_ab_cdc_updated_at", "timestamp"),
]
PLAIN = [C("id", "id", "integer", is_key=True), C("v", "v", "string")]


def raw(spark, rows):
    df = spark.createDataFrame(rows, "i string, t string, d string")
    return df.select(
        F.col("i").alias(RAW_ID), F.col("t").cast("timestamp").alias(RAW_TIME),
        F.col("d").alias(RAW_DATA),
    )


def change(i, key, value, at, emitted=None):
    data = f'{{"id": {key}, "v": "{value}", "_ab_cdc_cursor": 1, "_ab_cdc_updated_at": "{at}"}}'
    return (str(i), emitted or at, data)


CHANGES = [
    change(1, 1, "a", "2024-01-01 10:00:00"), change(2, 1, "b", "2024-01-02 10:00:00"),
    change(3, 2, "a", "2024-01-01 11:00:00"), change(4, 3, "x", "2024-01-03 09:00:00"),
    change(5, 2, "c", "2024-02-05 09:00:00"), change(6, 1, "z", "2024-02-06 09:00:00"),
    change(7, 4, "n", "2024-02-06 09:30:00"),
]


def values(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def test_equal_payloads_keep_the_newest(spark):
    df = raw(spark, [("1", "2024-01-01", "{}"), ("2", "2024-01-02", "{}"), ("3", "2024-01-02", "{}"),
                     ("4", None, "{}"), ("5", "2024-01-01", None), ("6", "2024-01-03", None)])
    assert values(latest_payloads(df), RAW_ID) == [("3",), ("6",)]


def test_two_payloads_of_one_key_both_stay_without_change_data(spark):
    df = raw(spark, [("1", "2024-01-01", '{"id": 1, "v": "a"}'), ("2", "2024-01-02", '{"id": 1, "v": "b"}')])
    assert values(stage(df, PLAIN, "2024-01-02"), "unique_id", "v") == [(1, "a"), (1, "b")]


def test_change_data_needs_one_shuffle_only(spark):
    plan = stage(raw(spark, CHANGES), CDC, "2024-02-10")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1


def test_change_data_equals_both_steps(spark):
    copies = CHANGES + [(f"{i}c", "2024-02-07 00:00:00", d) for i, _, d in CHANGES]
    both = stage(latest_payloads(raw(spark, copies)), CDC, "2024-02-10")
    once = stage(raw(spark, copies), CDC, "2024-02-10")
    assert values(once, *once.columns) == values(both, *both.columns)


def test_day_bounds(spark):
    df = raw(spark, CHANGES)
    day = lambda d, **how: values(stage(df, CDC, d, key=[], **how), "ab_id")
    assert day("2024-01-02") == [("1",), ("2",), ("3",)]
    assert day("2024-01-03", date_from="2024-01-02") == [("2",), ("4",)]
    # The look-back begins the day before and has no end.
    assert day("2024-01-03", incremental=True) == [("2",), ("4",), ("5",), ("6",), ("7",)]


def test_day_by_day_equals_full_load(spark):
    df, days = raw(spark, CHANGES), ["2024-01-01", "2024-01-02", "2024-01-03", "2024-02-05", "2024-02-06"]
    path = shared_folder(spark, "t")
    for d in days:
        end = (datetime.date.fromisoformat(d) + datetime.timedelta(days=1)).isoformat()
        load_stream(df.where(F.col(RAW_TIME) < end), CDC, d, path)
    full = stage(df, CDC, days[-1])
    columns = ("unique_id", "v", "ab_id")
    assert values(months.read_months(spark, path), *columns) == values(full, *columns)
    # Keys moved on with their last run's date; key 3 was last seen in January.
    assert values(months.read_months(spark, path), "unique_id", "_month") == [
        (1, "2024-02"), (2, "2024-02"), (3, "2024-01"), (4, "2024-02")]


def test_merging_twice_changes_nothing(spark):
    df, path = raw(spark, CHANGES), shared_folder(spark, "t")
    load_stream(df, CDC, "2024-01-03", path, full_refresh=True)
    load_stream(df, CDC, "2024-02-06", path)
    first = values(months.read_months(spark, path), "unique_id", "v", "execution_date")
    load_stream(df, CDC, "2024-02-06", path)
    assert values(months.read_months(spark, path), "unique_id", "v", "execution_date") == first


def table(spark, rows):
    return spark.createDataFrame(rows, "unique_id long, v string, d string").withColumn(
        "execution_date", F.col("d").cast("date")
    ).drop("d")


OLD = [(1, "a", "2024-01-05"), (2, "b", "2024-01-06"), (3, "c", "2024-02-01"), (None, "n", "2024-01-01")]
NEW = [(2, "B", "2024-03-01"), (4, "D", "2024-03-01"), (None, "m", "2024-03-02")]
MERGED = [(1, "a"), (2, "B"), (3, "c"), (4, "D"), (None, "m"), (None, "n")]


def test_merge(spark):
    got = m.merge(table(spark, OLD), table(spark, NEW))
    assert sorted(map(tuple, got.select("unique_id", "v").collect()), key=str) == sorted(MERGED, key=str)


def test_merge_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(m, "BROADCAST_BYTES", -1)
    got = m.merge(table(spark, OLD), table(spark, NEW))
    assert sorted(map(tuple, got.select("unique_id", "v").collect()), key=str) == sorted(MERGED, key=str)


def test_duplicate_source_keys(spark):
    twice = table(spark, NEW + [(4, "E", "2024-03-05")])
    with pytest.raises(ValueError, match="duplicate source key 4"):
        m.merge(table(spark, OLD), twice)
    got = m.merge(table(spark, OLD), twice, on_duplicate="latest", order_by=["execution_date"])
    assert (4, "E") in [tuple(r) for r in got.select("unique_id", "v").collect()]
    with pytest.raises(ValueError):
        m.merge(table(spark, OLD), twice, on_duplicate="latest")


def test_only_touched_months_are_rewritten(spark):
    path = shared_folder(spark, "t")
    m.merge_into_months(table(spark, OLD), path)
    files = lambda month: set(
        r[0] for r in months.read_months(spark, path).where(F.col("_month") == month)
        .select(F.input_file_name()).distinct().collect()
    )
    untouched = files("2024-02")
    assert m.merge_into_months(table(spark, NEW), path) == ["2024-01", "2024-03"]
    assert files("2024-02") == untouched
    got = months.read_months(spark, path).select("unique_id", "v")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(MERGED, key=str)


def test_a_month_that_loses_all_rows_is_emptied(spark):
    path = shared_folder(spark, "t")
    m.merge_into_months(table(spark, [(1, "a", "2024-01-05"), (2, "b", "2024-02-05")]), path)
    m.merge_into_months(table(spark, [(1, "A", "2024-03-05")]), path)
    assert values(months.read_months(spark, path), "unique_id", "v", "_month") == [
        (1, "A", "2024-03"), (2, "b", "2024-02")]


def folders(spark, path):
    return {n for n in folder_names(spark, path) if not n.startswith(".")}


def test_readers_have_the_old_table_or_the_new_one(spark, monkeypatch):
    """A table that was opened before a merge reads as it was, also after it; one change later it is gone."""
    path = shared_folder(spark, "t")
    m.merge_into_months(table(spark, OLD), path)
    opened, seen = months.read_months(spark, path), []
    publish = m.publish

    def watched(*args):
        seen.append(values(months.read_months(spark, path).na.fill(0), "unique_id", "v"))
        publish(*args)
        seen.append(values(months.read_months(spark, path).na.fill(0), "unique_id", "v"))

    monkeypatch.setattr(m, "publish", watched)
    m.merge_into_months(table(spark, NEW), path)
    plain = lambda rows: sorted((k or 0, v) for k, v, *_ in rows)
    assert seen == [plain(OLD), plain(MERGED)]
    assert values(opened.na.fill(0), "unique_id", "v") == plain(OLD)


def test_a_run_that_dies_leaves_the_old_table(spark, monkeypatch):
    path = shared_folder(spark, "t")
    m.merge_into_months(table(spark, OLD[:3]), path)

    def dies(*args):
        raise KeyboardInterrupt

    for step in ("write_version", "publish"):
        with monkeypatch.context() as patched, pytest.raises(KeyboardInterrupt):
            patched.setattr(m, step, dies)
            m.merge_into_months(table(spark, NEW[:2]), path)
        assert values(months.read_months(spark, path), "unique_id", "v") == [(1, "a"), (2, "b"), (3, "c")]
    with monkeypatch.context() as patched, pytest.raises(KeyboardInterrupt):
        patched.setattr(months, "put_text", dies)
        m.merge_into_months(table(spark, NEW[:2]), path)
    assert values(months.read_months(spark, path), "unique_id", "v") == [(1, "a"), (2, "b"), (3, "c")]
    assert len(months.remove_unpublished(spark, path)) == 2
    assert m.merge_into_months(table(spark, NEW[:2]), path) == ["2024-01", "2024-03"]
    assert values(months.read_months(spark, path), "unique_id", "v") == [(1, "a"), (2, "B"), (3, "c"), (4, "D")]


def test_each_month_is_written_once_and_two_generations_stay(spark, monkeypatch):
    path = shared_folder(spark, "t")
    m.merge_into_months(table(spark, [(i, "x", f"2024-0{1 + i % 3}-01") for i in range(30)]), path)
    for n in range(4):
        m.merge_into_months(table(spark, [(0, f"y{n}", "2024-01-01")]), path)
        names = folders(spark, path)
        assert len([x for x in names if x.startswith("_live-")]) == 2
        # the first version has the untouched months; two more are the live month's and the one before
        assert len([x for x in names if x.startswith("_version=")]) <= 3
        assert months.read_months(spark, path).count() == 30
    first = months.live(spark, path).months["2024-02"]
    assert folders(spark, f"{path}/_version={first}") & {"_month=2024-01", "_month=2024-02"} == {"_month=2024-02"}


def test_two_writers_do_not_overwrite_each_other(spark):
    path = shared_folder(spark, "t")
    m.merge_into_months(table(spark, OLD[:3]), path)
    before = months.live(spark, path)
    m.merge_into_months(table(spark, NEW[:2]), path)
    with pytest.raises(ValueError, match="another run"):
        months.publish(spark, path, before, before.months, table(spark, OLD).schema)


def test_a_table_that_loses_all_rows_keeps_its_columns(spark):
    path = shared_folder(spark, "t")
    months.write_months(table(spark, OLD), path, "execution_date")
    with pytest.raises(ValueError, match="already"):
        months.write_months(table(spark, OLD), path, "execution_date")
    m.merge_into_months(table(spark, OLD).limit(0), path, full_refresh=True)
    assert months.read_months(spark, path).columns == ["unique_id", "v", "execution_date", "_month"]
    assert months.read_months(spark, path).count() == 0
    assert m.merge_into_months(table(spark, NEW), path) == ["2024-03"]
    with pytest.raises(ValueError, match="no table"):
        months.read_months(spark, shared_folder(spark, "none"))


def rows_scanned(df):
    """Rows that the scan of a query that ran gave out, and what ran."""
    rows = len(df.collect())
    plan = df._jdf.queryExecution().executedPlan()
    if "AdaptiveSparkPlan" in plan.nodeName():
        plan = plan.executedPlan()
    scan = plan.collectLeaves().head()
    return rows, scan.metrics().apply("numOutputRows").value(), scan.toString()


@pytest.mark.parametrize("hashed", [False, True])
def test_a_merge_skips_row_groups_without_its_keys(spark, hashed):
    path = shared_folder(spark, "t")
    key = F.md5(F.col("id").cast("string")) if hashed else F.col("id")
    rows = spark.range(0, 40_000, 1, 4).select(
        key.alias("unique_id"), F.lit("x").alias("v"), F.lit("2024-01-05").cast("date").alias("execution_date")
    )
    spark.conf.set("parquet.block.size", 1 << 14)
    try:
        size = spark.sparkContext._jsc.hadoopConfiguration()
        size.set("parquet.block.size", str(1 << 14))
        m.merge_into_months(rows, path, on_duplicate="trust")
    finally:
        size.unset("parquet.block.size")
        spark.conf.unset("parquet.block.size")
    batch = rows.where(F.col("unique_id").isin([rows.first()[0]] + [r[0] for r in rows.where("rand(3) < 0.0003").collect()])
                       if hashed else F.col("unique_id").between(20_000, 20_500))
    found, read, text = rows_scanned(months.read_months(spark, path).where(m._keys_of(batch, "unique_id")).select("unique_id"))
    assert found == batch.count() > 0
    assert "unique_id" in text.split("PushedFilters")[1]
    assert read < 20_000, read
    m.merge_into_months(batch.withColumn("v", F.lit("y")), path)
    assert months.read_months(spark, path).where("v = 'y'").count() == found
    assert months.read_months(spark, path).count() == 40_000


def test_full_refresh_drops_old_months(spark):
    path = shared_folder(spark, "t")
    m.merge_into_months(table(spark, OLD), path)
    m.merge_into_months(table(spark, NEW[:2]), path, full_refresh=True)
    assert values(months.read_months(spark, path), "unique_id") == [(2,), (4,)]


def test_failed_check_leaves_the_table_alone(spark):
    path = shared_folder(spark, "t")
    m.merge_into_months(table(spark, OLD[:3]), path)
    with pytest.raises(ValueError):
        m.merge_into_months(table(spark, NEW + NEW), path)
    assert values(months.read_months(spark, path), "unique_id") == [(1,), (2,), (3,)]


def test_hot_key_is_reduced_before_the_shuffle(spark):
    """A third of all rows share one payload: each task sends one row for it."""
    rows = spark.range(30_000, numPartitions=4)
    payload = F.when(F.col("id") % 3 == 0, F.lit("{}")).otherwise(F.concat(F.lit('{"k":'), "id", F.lit("}")))
    df = rows.select(
        F.col("id").cast("string").alias(RAW_ID), F.timestamp_seconds("id").alias(RAW_TIME),
        payload.alias(RAW_DATA),
    )
    newest = latest_payloads(df)
    plan = newest._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_max_by") > plan.index("Exchange")
    assert newest.count() == 20_001
    assert newest.where(F.col(RAW_DATA) == "{}").first()[RAW_ID] == "29997"


def test_months_prune(spark):
    path = shared_folder(spark, "t")
    m.merge_into_months(table(spark, OLD), path)
    one = months.read_months(spark, path).where(F.col("_month") == "2024-02")
    text = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_month" in text and "_month#" in text
    assert one.count() == 1


def test_landed_day_bounds_reach_the_files(spark, tmp_path):
    path = str(tmp_path / "raw")
    raw(spark, CHANGES).write.parquet(path)
    from millrace.sources.landing import raw_landing

    plan = stage(raw_landing(spark, path), CDC, "2024-01-03", incremental=True)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(_airbyte_emitted_at," in text


def test_one_name_is_one_column(spark):
    df = raw(spark, [("1", "2024-01-01", '{"orderId": 1, "order_id": 2, "x": 3}')])
    lines = [C("order_id", "orderId", "string"), C("x", "x", "integer"), C("order_id", "order_id", "integer")]
    staged = stage(df, lines, "2024-01-01", key=["order_id"])
    assert staged.columns[:2] == ["order_id", "x"]
    assert values(staged, "order_id", "x", "unique_id") == [(2, 3, 2)]


def test_rows_without_a_date_form_a_month(spark):
    path = shared_folder(spark, "undated")
    schema = "unique_id string, day date, v int"
    day = datetime.date(2024, 1, 5)
    first = spark.createDataFrame([("a", None, 1), ("b", day, 1), ("c", None, 1)], schema)
    assert m.merge_into_months(first, path, "day") == [None, "2024-01"]
    assert months.months_of(spark, path) == [None, "2024-01"]
    second = spark.createDataFrame([("a", day, 2), ("b", None, 2), ("d", None, 2)], schema)
    assert m.merge_into_months(second, path, "day") == [None, "2024-01"]
    got = {(r.unique_id, r.day, r.v) for r in months.read_months(spark, path).collect()}
    assert got == {("a", day, 2), ("b", None, 2), ("c", None, 1), ("d", None, 2)}
    third = spark.createDataFrame([("a", None, 3)], schema)
    assert m.merge_into_months(third, path, "day") == [None, "2024-01"]
    assert {r.day for r in months.read_months(spark, path).collect()} == {None}


def test_a_first_load_that_died_can_be_repeated(spark, tmp_path):
    path = str(tmp_path / "t")
    (tmp_path / "t").mkdir()  # what a task that failed while writing leaves
    (tmp_path / "t" / "_temporary").mkdir()
    rows = spark.createDataFrame([("a", datetime.date(2024, 1, 5), 1)], "unique_id string, day date, v int")
    assert m.merge_into_months(rows, path, "day", on_duplicate="trust", one_month=True) == ["2024-01"]
    assert months.read_months(spark, path).count() == 1


def test_payloads_that_begin_alike_are_grouped_by_their_hash(spark):
    df = spark.range(60).selectExpr(
        f"CAST(id AS STRING) AS {RAW_ID}", f"TIMESTAMP '2024-01-01' + make_dt_interval(CAST(id AS INT)) AS {RAW_TIME}",
        f"concat(repeat('x', 4000), id % 7) AS {RAW_DATA}")
    newest = latest_payloads(df)
    assert sorted(int(r[RAW_ID]) for r in newest.collect()) == list(range(53, 60))
    plan = newest._jdf.queryExecution().executedPlan().toString()
    assert "xxhash64" in plan and "RoundRobin" not in plan


def test_pinned_sessions_keep_what_a_task_sorts_small(spark):
    before = {key: spark.conf.get(key) for key in TASK_SETTINGS}
    try:
        for key in TASK_SETTINGS:
            spark.conf.set(key, "128m")
        pin_session(spark)
        assert {key: spark.conf.get(key) for key in TASK_SETTINGS} == {k: str(v) for k, v in TASK_SETTINGS.items()}
        for key in TASK_SETTINGS:
            spark.conf.set(key, "64k")
        pin_session(spark)
        assert {spark.conf.get(key) for key in TASK_SETTINGS} == {"64k"}
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


@pytest.mark.parametrize("order", ["bca", "cab", "abc"])
def test_changes_equal_in_all_but_the_payload_have_one_winner(spark, order):
    rows = [change(1, 1, v, "2024-01-01 10:00:00") for v in order]
    staged = stage(raw(spark, rows).coalesce(1), CDC, "2024-02-10")
    assert values(staged, "v") == [("c",)]
    plan = staged._jdf.queryExecution().executedPlan().toString()
    assert "max_by" not in plan  # which takes the order's columns along, beside the row's
