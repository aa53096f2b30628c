"""Operators the projects switch on: seeds, snapshots, monitored metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import quality, snapshot
from millrace.session import shared_folder
from millrace.sources import seeds
from workload import inputs
from workload.registered import query


@query("seed_load", "SELECT * FROM customer")
def seed_load(spark, sf_dir):
    path = shared_folder(spark, "seed-customer")
    customer = inputs.table(spark, sf_dir, "customer")
    seeds.write_seed(customer, path)
    return seeds.read_seed(spark, path, customer.schema.simpleString()[7:-1].replace(":", " "))


# Orders as they were placed, then as they ended: the status of some changed, some are gone
# and some are new.
HISTORY_SQL = """
    WITH old AS (SELECT o_orderkey AS id, 'N' AS status, o_orderdate AS "at" FROM orders
                 WHERE o_orderstatus <> 'P'),
    new AS (SELECT o_orderkey AS id, CASE o_orderstatus WHEN 'F' THEN 'F' ELSE 'N' END AS status,
                   o_orderdate + INTERVAL 40 DAY AS "at" FROM orders
            WHERE o_orderpriority <> '5-LOW')"""


def _versions(spark, sf_dir):
    o = inputs.table(spark, sf_dir, "orders")
    placed = o.where("o_orderstatus <> 'P'").select(
        o.o_orderkey.alias("id"), F.lit("N").alias("status"), o.o_orderdate.alias("at")
    )
    ended = o.where("o_orderpriority <> '5-LOW'").select(
        o.o_orderkey.alias("id"),
        F.when(o.o_orderstatus == "F", F.lit("F")).otherwise("N").alias("status"),
        (o.o_orderdate + F.expr("INTERVAL 40 DAY")).alias("at"),
    )
    return placed, ended


@query("snapshot_by_check", HISTORY_SQL + """
    SELECT old.id, old.status, old.at, TIMESTAMP '2024-01-01' AS dbt_valid_from,
           CASE WHEN new.status <> old.status THEN TIMESTAMP '2024-02-01' END AS dbt_valid_to
    FROM old LEFT JOIN new USING (id)
    UNION ALL
    SELECT new.id, new.status, new.at, TIMESTAMP '2024-02-01', NULL
    FROM new LEFT JOIN old USING (id) WHERE old.status IS DISTINCT FROM new.status""")
def snapshot_by_check(spark, sf_dir):
    placed, ended = _versions(spark, sf_dir)
    history = snapshot.first_snapshot(placed, F.lit("2024-01-01 00:00:00"))
    return snapshot.snapshot(history, ended, "id", check=["status"], at="2024-02-01 00:00:00")


@query("snapshot_by_time", HISTORY_SQL + """
    SELECT old.id, old.status, old.at, old.at AS dbt_valid_from, new.at AS dbt_valid_to
    FROM old LEFT JOIN new USING (id)
    UNION ALL SELECT id, status, new.at, new.at, NULL FROM new""")
def snapshot_by_time(spark, sf_dir):
    placed, ended = _versions(spark, sf_dir)
    history = snapshot.first_snapshot(placed, F.col("at"))
    return snapshot.snapshot(history, ended, "id", updated_at="at")


# All orders on three days: as placed, as they ended, and once more after open ones were cancelled.
@query("snapshot_stored", """
    WITH days AS (SELECT o_orderkey AS id, CASE o_orderstatus WHEN 'P' THEN 'P' ELSE 'N' END AS placed,
                         o_orderstatus AS ended, CASE o_orderstatus WHEN 'O' THEN 'X' ELSE o_orderstatus END AS later
                  FROM orders)
    SELECT id, placed AS status, TIMESTAMP '2024-01-01' AS dbt_valid_from,
           CASE WHEN ended <> placed THEN TIMESTAMP '2024-02-01' END AS dbt_valid_to FROM days
    UNION ALL SELECT id, ended, TIMESTAMP '2024-02-01',
           CASE WHEN later <> ended THEN TIMESTAMP '2024-03-01' END FROM days WHERE ended <> placed
    UNION ALL SELECT id, later, TIMESTAMP '2024-03-01', NULL FROM days WHERE later <> ended""")
def snapshot_stored(spark, sf_dir):
    o = inputs.table(spark, sf_dir, "orders")
    path = shared_folder(spark, "order-history")
    placed = F.when(o.o_orderstatus == "P", "P").otherwise("N")
    later = F.when(o.o_orderstatus == "O", "X").otherwise(o.o_orderstatus)
    for day, status in (("2024-01-01", placed), ("2024-02-01", o.o_orderstatus), ("2024-03-01", later)):
        rows = o.select(o.o_orderkey.alias("id"), status.alias("status"))
        snapshot.take_snapshot(rows, path, "id", check=["status"], at=f"{day} 00:00:00")
    return snapshot.read_history(spark, path)


@query("monitored_metrics", """
    WITH daily AS (
      SELECT ts::DATE AS day, count(*) AS n, max(ts) AS latest, count(*) - count(value) AS nulls,
             min(value) AS low, max(value) AS high, min(user_id) AS ulow, max(user_id) AS uhigh
      FROM events GROUP BY ALL)
    SELECT day, v.* FROM daily, LATERAL (VALUES
      (NULL, 'row_count', n::DOUBLE),
      (NULL, 'freshness', floor(epoch(day + INTERVAL 1 DAY) - floor(epoch(latest)))::DOUBLE),
      ('value', 'null_count', nulls::DOUBLE), ('value', 'min', low), ('value', 'max', high),
      ('user_id', 'null_count', 0.0::DOUBLE), ('user_id', 'min', ulow::DOUBLE),
      ('user_id', 'max', uhigh::DOUBLE)) v("column", metric, value)""")
def monitored_metrics(spark, sf_dir):
    return quality.monitored_metrics(
        inputs.table(spark, sf_dir, "events"), "ts", ["value", "user_id"]
    )
