"""Data tests, history, registry and project operators on small tables."""

import datetime

import pytest
from pyspark.sql import functions as F

from millrace import session
from millrace.functions.types import ColumnSpec
from millrace.operators import configs, months, projects, quality, registry, snapshot, validation
from millrace.plans.registry import change_registry
from millrace.sources import projects as files
from millrace.sources.registry import read_registry

HOUR = datetime.timedelta(hours=1)
AT = datetime.datetime(2024, 1, 10)


def test_freshness_limits_are_exclusive(spark):
    rows = [(str(h), AT - h * HOUR) for h in (0, 24, 36)] + [
        ("late", AT - 24 * HOUR - datetime.timedelta(microseconds=1)),
        ("error", AT - 36 * HOUR - datetime.timedelta(microseconds=1)), ("never", None)]
    df = spark.createDataFrame(rows, "k string, ts timestamp")
    got = {r.k: r.status for r in quality.freshness(df, "ts", AT, by=["k"]).collect()}
    assert got == {"0": "pass", "24": "pass", "36": "warn", "late": "warn", "error": "error", "never": "error"}


def test_an_empty_table_is_not_fresh(spark):
    empty = spark.createDataFrame([], "ts timestamp")
    row = quality.freshness_test(empty, "m", "ts", AT).first()
    assert (row.failures, row.status) == (1, "error")


def test_key_tests(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "b"), (None, "c")], "id int, v string")
    got = {(r["column"], r.test): (r.failures, r.status) for r in quality.primary_key(df, "m", ["id", "v"]).collect()}
    assert got == {("id", "not_null"): (2, "fail"), ("id", "unique"): (1, "fail"),
                   ("v", "not_null"): (0, "pass"), ("v", "unique"): (1, "fail")}
    whole = {r.test: r.failures for r in quality.primary_key(df, "m", ["id", "v"], composite=True).collect()}
    assert whole == {"not_null": 2, "unique": 0}


def test_dictionary_tests(spark):
    df = spark.createDataFrame([(1, 1), (2, 2)], "id int, unique_id int")
    report = quality.dictionary_tests(df, "m", [ColumnSpec("id", "id", "integer", "", True)])
    assert {(r["column"], r.test, r.status) for r in report.collect()} == {
        (c, t, "pass") for c in ("id", "unique_id") for t in ("not_null", "unique")}


def test_unique_reads_its_column_only(spark, tmp_path):
    spark.range(10).selectExpr("id AS a", "id AS b").write.parquet(str(tmp_path / "t"))
    plan = quality.unique(spark.read.parquet(str(tmp_path / "t")), "m", ["a"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<a:bigint>" in text and "IsNotNull(a)" in text


def history(spark, rows):
    df = spark.createDataFrame(rows, "id long, v string, f string, t string")
    return df.select("id", "v", F.col("f").cast("timestamp").alias(snapshot.VALID_FROM),
                     F.col("t").cast("timestamp").alias(snapshot.VALID_TO))


def test_a_stored_history_is_that_of_the_runs_and_closed_parts_stay(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "history")
    runs = [[(1, "a"), (2, None), (None, "k")], [(1, "b"), (2, None), (3, "n")], [(1, "b"), (3, "m"), (None, "k")], []]
    whole, parts = None, []
    for month, rows in enumerate(runs, 1):
        source = spark.createDataFrame(rows, "id long, v string")
        run = {"check": ["v"], "at": f"2024-{month:02}-01 00:00:00"}
        if whole is None:
            whole = snapshot.first_snapshot(source, F.lit(run["at"]))
        else:
            whole = snapshot.snapshot(whole, source, "id", **run)
        snapshot.take_snapshot(source, path, "id", **run)
        assert sorted(map(str, snapshot.read_history(spark, path).collect())) == sorted(map(str, whole.collect()))
        parts.append(dict(months.live(spark, path).months))
        keyed = whole.where("id IS NOT NULL AND dbt_valid_to IS NULL")
        assert sorted(map(str, snapshot.read_current(spark, path).collect())) == sorted(map(str, keyed.collect()))
    for earlier, later in zip(parts, parts[1:]):
        assert earlier["open"] != later["open"]
        assert earlier.items() - {("open", earlier["open"])} <= later.items()
    assert sorted(parts[-1]) == ["closed-00000001", "closed-00000002", "closed-00000003", "open"]
    assert "closed-" not in "".join(snapshot.read_current(spark, path).inputFiles())

    def die(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(snapshot, "publish", die)
    before = sorted(map(str, snapshot.read_history(spark, path).collect()))
    with pytest.raises(RuntimeError):
        snapshot.take_snapshot(spark.createDataFrame([(1, "z")], "id long, v string"), path, "id", check=["v"], at="2024-06-01 00:00:00")
    assert sorted(map(str, snapshot.read_history(spark, path).collect())) == before
    with pytest.raises(ValueError):
        snapshot.take_snapshot(source, path, "id")


def test_snapshot_by_check(spark):
    old = history(spark, [(1, "a", "2024-01-01", "2024-01-02"), (1, "b", "2024-01-02", None),
                          (2, None, "2024-01-01", None), (3, "c", "2024-01-01", None)])
    source = spark.createDataFrame([(1, "c"), (2, None), (4, "n")], "id long, v string")
    got = snapshot.snapshot(old, source, "id", check=["v"], at="2024-02-01 00:00:00")
    day = lambda v: v and v.strftime("%m-%d")
    assert sorted((r.id, r.v, day(r.dbt_valid_from), day(r.dbt_valid_to)) for r in got.collect()
                  if r.id != 2) == [
        (1, "a", "01-01", "01-02"), (1, "b", "01-02", "02-01"), (1, "c", "02-01", None),
        (3, "c", "01-01", None), (4, "n", "02-01", None)]
    again = snapshot.snapshot(got, source, "id", check=["v"], at="2024-03-01 00:00:00")
    assert again.exceptAll(got).count() == got.exceptAll(again).count() == 0
    with pytest.raises(ValueError):
        snapshot.snapshot(old, source, "id")


def test_rows_without_a_key_never_match(spark):
    old = history(spark, [(None, "a", "2024-01-01", None), (1, "a", "2024-01-01", None)])
    source = spark.createDataFrame([(None, "a"), (1, "a")], "id long, v string")
    got = snapshot.snapshot(old, source, "id", check=["v"], at="2024-02-01 00:00:00")
    assert sorted(str(r.id) for r in got.collect()) == ["1", "None", "None"]


RECORD = {"dbt_project_name": "p", "dbt_project_version": "1", "dbt_project_owner": "o",
          "dbt_project_endpoint_link": "l"}


def test_registry_round_trip(spark):
    df = spark.createDataFrame([], registry.METADATA_SCHEMA)
    for _ in range(3):
        df = registry.insert(df, RECORD, now=AT)
    df = registry.delete(df, 2)
    df = registry.set_online(df, 1, False, AT + HOUR)
    df = registry.insert(df, RECORD | {"dbt_project_name": "q"}, now=AT)
    rows = {r.id: r for r in df.collect()}
    assert sorted(rows) == [1, 3, 4]
    assert (rows[1].online_status, rows[1].updated_at, rows[1].created_at) == (False, AT + HOUR, AT)
    assert registry.refresh(df, 1, AT).where("id = 1").first().online_status is True
    assert registry.by_project(df, "p").first().id == 1
    assert registry.by_id(df, 9).count() == 0
    with pytest.raises(ValueError, match="dbt_project_owner"):
        registry.insert(df, {k: v for k, v in RECORD.items() if k != "dbt_project_owner"})


def test_stored_registry(spark, tmp_path):
    folder, name = str(tmp_path), "data_catalog_metadata"
    for _ in range(2):
        change_registry(spark, folder, name, lambda df: registry.insert(df, RECORD, now=AT))
    left = change_registry(spark, folder, name, lambda df: registry.delete(df, 1))
    assert [r.id for r in left.collect()] == [2]
    assert read_registry(spark, folder, "user_groups").count() == 0


FLAGS = """
API_SECRETS_DBT_PRJ_SHOP:
  DAG_OWNER: 'me'
  DAG_ID: 'api_operator_shop'
  DEBUG: True
  PORT: 8080
  DAG_TAG:
    - one
    - 2
OTHER:
  DAG_OWNER: 'nobody'
"""


def parsed(spark, text):
    df = spark.createDataFrame([("shop", text)], "project string, content string")
    return files.project_configs(df)


def test_flag_files(spark):
    rows = {r.config_key: r for r in parsed(spark, FLAGS).collect()}
    assert rows["API_SECRETS_DBT_PRJ_SHOP"].vars == {
        "DAG_OWNER": "me", "DAG_ID": "api_operator_shop", "DEBUG": "True", "PORT": "8080",
        "DAG_TAG": '["one", "2"]'}
    in_force = files.project_flags(parsed(spark, FLAGS)).collect()
    assert [r.config_key for r in in_force] == ["API_SECRETS_DBT_PRJ_SHOP"]


@pytest.mark.parametrize("text", ["", "just text", "- a\n- b\n", "a: [unclosed", None])
def test_unreadable_flag_files_hold_nothing(spark, text):
    configs_ = parsed(spark, text)
    assert [(r.project, r.config_key, r.vars) for r in configs_.collect()] == [("shop", None, {})]
    assert files.project_flags(configs_).count() == 1


def test_flag_files_in_folders(spark, tmp_path):
    for name in ("shop", "bank"):
        (tmp_path / name).mkdir()
        (tmp_path / name / "flags.yml").write_text(FLAGS.replace("shop", name))
    found = files.project_configs(files.project_files(spark, str(tmp_path), "flags.yml"))
    assert {(r.project, r.vars["DAG_ID"]) for r in files.project_flags(found).collect()} == {
        ("shop", "api_operator_shop"), ("bank", "api_operator_bank")}


def test_config_changes(spark):
    df = parsed(spark, FLAGS).drop("ord")
    owned = configs.set_owner(df, F.col("project") == "shop", F.lit("you")).collect()
    assert {r.vars["DAG_OWNER"] for r in owned} == {"you"}
    renamed = configs.rename(df.where("config_key <> 'OTHER'"), "shop", "market").first()
    assert (renamed.project, renamed.config_key, renamed.vars["DAG_ID"], renamed.vars["DAG_OWNER"]) == (
        "market", "API_SECRETS_DBT_PRJ_MARKET", "api_operator_market", "me")
    both = {r.config_key: r for r in configs.rename(df, "shop", "market").collect()}
    assert set(both) == {"API_SECRETS_DBT_PRJ_MARKET", "OTHER"} and both["OTHER"].project == "market"
    with pytest.raises(Exception, match="no configuration key for project shop"):
        configs.rename(df.where("config_key = 'OTHER'"), "shop", "market").collect()


def test_profiles_move_to_the_new_name(spark):
    df = spark.sql("SELECT 'shop' AS project, map('shop', 'a', 'other', 'b') AS profiles")
    row = configs.rename_profiles(df, F.lit("shop"), F.lit("market")).first()
    assert (row.project, row.profiles) == ("market", {"market": "a", "other": "b"})


def test_override_leaves_other_projects_as_they_are(spark):
    df = spark.sql("SELECT p AS project, k AS config_key, map('X', CAST(NULL AS STRING)) AS vars "
                   "FROM VALUES ('a', 'one'), ('a', 'two'), ('b', 'one') v(p, k)")
    given = spark.sql("SELECT 'a' AS project, 'one' AS config_key, map('Y', 'y') AS vars")
    got = {(r.project, r.config_key): r.vars for r in configs.override(df, given).collect()}
    assert got == {("a", "one"): {"Y": "y"}, ("a", "two"): {"X": "None"}, ("b", "one"): {"X": None}}


def test_metrics_of_text_columns_and_chosen_ones(spark):
    from millrace.operators import quality

    df = spark.sql("SELECT TIMESTAMP '2024-01-01' AS at, t, n FROM VALUES ('x', 1), ('7', 2) v(t, n)")
    rows = quality.monitored_metrics(df, "at", {"t": ("min", "max"), "n": ("max",)}).collect()
    assert {(r.column, r.metric): r.value for r in rows if r.column} == {
        ("t", "min"): 7.0, ("t", "max"): None, ("n", "max"): 2.0}
    with pytest.raises(ValueError, match="unknown metrics"):
        quality.monitored_metrics(df, "at", {"t": ("median",)})


def test_limits_by_operator(spark):
    from millrace.operators import validation

    df = spark.createDataFrame([("k8s", "p" * 69, ""), ("gke", "p" * 255, "s")], "operator string, dbt_k8s_pod_name string, snowflake_role string")
    assert [r.errors for r in validation.validate(df, "k8s").collect()] == [
        ["dbt_k8s_pod_name", "snowflake_role"], ["operator", "dbt_k8s_pod_name"]]
    assert validation.validate(df, "gke").collect()[1].errors == []


def test_override_replaces_whole_keys(spark):
    df = parsed(spark, FLAGS).drop("ord")
    given = spark.createDataFrame(
        [("shop", "OTHER", {"X": None}), ("shop", "NEW", {"Y": "1"}), ("gone", "NEW", {"Y": "1"})],
        "project string, config_key string, vars map<string,string>")
    got = {r.config_key: r.vars for r in configs.override(df, given).collect()}
    assert got["OTHER"] == {"X": "None"} and got["NEW"] == {"Y": "1"}
    assert got["API_SECRETS_DBT_PRJ_SHOP"]["DAG_OWNER"] == "me" and len(got) == 3


def test_project_file_rename(spark):
    df = spark.sql("SELECT 'shop' AS name, 'shop' AS profile, map('shop', 1, '+meta', 2) AS models")
    row = configs.rename_project_file(df, F.lit("shop"), F.lit("market")).first()
    assert (row.name, row.profile, row.models) == ("market", "market", {"market": 1, "+meta": 2})


def test_dates_fall_back_together(spark):
    folders = spark.createDataFrame([("a",), ("b",), ("c",)], "project string").select(
        "project", F.lit(AT).alias("file_created"), F.lit(AT + HOUR).alias("file_modified"))
    log = spark.createDataFrame(
        [("a", AT - 2 * HOUR, "A"), ("a", AT - 3 * HOUR, "M"), ("a", AT + 5 * HOUR, "M"),
         ("b", AT + 9 * HOUR, "M")], "project string, ts timestamp, kind string")
    rows = projects.project_list(folders, projects.project_dates(log)).collect()
    assert [(r.project, r.created_at, r.last_modified) for r in rows] == [
        ("b", AT, AT + HOUR), ("c", AT, AT + HOUR), ("a", AT - 2 * HOUR, AT + 5 * HOUR)]


def test_flag_defaults(spark):
    flags = spark.sql("SELECT 'p_x' AS project, map('DATA_QUALITY', 'TRUE') AS vars")
    dated = spark.sql("SELECT 'p_x' AS project, 'data/p_x' AS repo_path, "
                      "TIMESTAMP '2024-01-01' AS created_at, TIMESTAMP '2024-01-02' AS last_modified")
    row = projects.project_info(flags, dated, "acme", "example.com").first()
    assert (row.repo_path, row.last_modified.day) == ("data/p_x", 2)
    assert (row.owner, row.airflow_dag_name, row.dbt_docs_enabled) == ("Default", "dbt_p_x", "True")
    assert "/p-x/%23/alerts" in row.data_quality_url and "/p-x/%23!/overview" in row.dbt_docs_url


@pytest.mark.parametrize("value, valid", [
    ("@daily", True), ("@always", False), ("* * * * * *", True), ("0 30 12 * * 1", True),
    ("30 12 * * 1", False), ("0 60 12 * * 1", False), ("", False),
])
def test_schedules(spark, value, valid):
    df = spark.createDataFrame([(value,)], "s string")
    assert df.select(validation.valid_schedule(F.col("s"))).first()[0] is valid


def test_requests_name_what_they_break(spark):
    df = spark.createDataFrame(
        [("ok", "PROD", "Airflow"), ("", "PROD", "Cron"), (None, "LAB", None)],
        "dbt_project_name string, project_level string, workload_platform string")
    assert [r.errors for r in validation.validate(df).collect()] == [
        [], ["dbt_project_name", "workload_platform"],
        ["dbt_project_name", "project_level", "workload_platform"]]


class FakeSession:
    """Settings and context of a session, as far as the shared folder looks at them."""

    def __init__(self, master, configured=None):
        self.conf = {session.CHECKPOINT_DIR: configured}
        self.sparkContext, self.master, self.folder = self, master, None

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def test_shared_folder_follows_the_session():
    cluster = FakeSession("yarn", "hdfs:///shared/")
    a, b = session.shared_folder(cluster, "x"), session.shared_folder(cluster, "x")
    assert a.startswith("hdfs:///shared/x-") and a != b


def test_only_a_local_session_may_make_its_own_folder():
    local = FakeSession("local[2]")
    first, second = session.shared_folder(local, "x"), session.shared_folder(local, "y")
    assert first.rsplit("/", 1)[0] == second.rsplit("/", 1)[0] == local.folder
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(FakeSession("spark://host:7077"), "x")
