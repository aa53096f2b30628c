"""Carry out a drop plan, or only show it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import stored

NOTHING = "No relations to clean."


def run_drop_plan(
    plan: DataFrame, dry_run: bool = True, drop_schemas: bool = False, log=print
) -> int:
    """Log every command and, unless it is a dry run, run it; returns how many were run.

    The plan is stored before the first command runs, as drops change the catalog it comes
    from. Commands then stream through the driver one partition at a time, each being a
    statement of its own. Schemas may hold relations of others, so they need their own consent.
    """
    seen = done = 0
    fixed = stored(plan, "drop-plan").orderBy(F.col("command").desc())
    for row in fixed.toLocalIterator():
        seen += 1
        log(row.command)
        is_schema = row.command.startswith("DROP SCHEMA")
        if not dry_run and (drop_schemas or not is_schema):
            plan.sparkSession.sql(row.command.rstrip(";"))
            done += 1
    if not seen:
        log(NOTHING)
    return done


def dry_run_log(plan: DataFrame) -> DataFrame:
    """What a dry run logs, one command a row in the order of the run; nothing goes through the driver."""
    fixed = stored(plan, "drop-plan").select("command")
    if fixed.isEmpty():
        return plan.sparkSession.range(1).select(F.lit(NOTHING).alias("command"))
    return fixed.orderBy(F.col("command").desc())
