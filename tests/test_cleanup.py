"""A dry run as a table."""

import pytest

import workload
from millrace.plans import cleanup


def test_a_dry_run_keeps_its_commands_off_the_driver(spark, monkeypatch):
    def refuse(*_, **__):
        raise AssertionError("commands went through the driver")

    with monkeypatch.context() as patched:
        patched.setattr(type(spark.range(0)), "toLocalIterator", refuse)
        found = workload.QUERIES["clean_up_dry_run"](spark, "/root/testdata/sf0.001")
    rows = [r["command"] for r in found.collect()]
    assert len(rows) > 1 and rows == sorted(rows, reverse=True)


@pytest.mark.parametrize("commands", [["DROP TABLE a;", "DROP VIEW b;", "DROP SCHEMA IF EXISTS s CASCADE;"], []])
def test_its_rows_are_what_a_dry_run_logs(spark, commands):
    plan, said = spark.createDataFrame([(c,) for c in commands], "command string"), []
    cleanup.run_drop_plan(plan, log=said.append)
    assert [r["command"] for r in cleanup.dry_run_log(plan).collect()] == said
