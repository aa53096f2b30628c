"""Latest row per key."""

from __future__ import annotations

from millrace.operators.staging import stage
from workload import inputs
from workload.registered import query


@query("latest_change_per_user", """
    SELECT user_id, event_type, CAST(CAST(value AS VARCHAR) AS DECIMAL(38,9)) AS value,
           event_id AS ab_cdc_cursor, ts AS ab_cdc_updated_at, DATE '2024-01-20' AS execution_date,
           CAST(event_id AS VARCHAR) AS ab_id, ts AS ab_emitted_at, user_id AS unique_id
    FROM events WHERE ts < DATE '2024-01-21'
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, CAST(event_id AS VARCHAR) DESC) = 1""")
def latest_change_per_user(spark, sf_dir):
    return stage(inputs.landed_user_events(spark, sf_dir), inputs.USER_COLUMNS, "2024-01-20")


@query("latest_change_per_line", """
    SELECT l_orderkey AS order_key, CAST(l_linenumber AS BIGINT) AS line_number, l_partkey AS part_key,
           CAST(l_quantity AS DECIMAL(38,9)) AS quantity,
           CAST(CAST(l_extendedprice AS VARCHAR) AS DECIMAL(38,9)) AS extended_price,
           l_returnflag AS return_flag, l_linestatus AS line_status, l_partkey AS ab_cdc_cursor,
           l_shipdate AS ab_cdc_updated_at, DATE '2010-01-01' AS execution_date,
           concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice)
             AS ab_id,
           l_shipdate AS ab_emitted_at, md5(l_orderkey || '-' || l_linenumber) AS unique_id
    FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, ab_id DESC) = 1""")
def latest_change_per_line(spark, sf_dir):
    return stage(inputs.landed_lines(spark, sf_dir), inputs.LINE_COLUMNS, "2010-01-01")


@query("latest_turn", """
    SELECT conv_id, turn, role, text, turn AS ab_cdc_cursor,
           TIMESTAMP '1970-01-01' + to_minutes(turn) AS ab_cdc_updated_at,
           DATE '2024-01-01' AS execution_date, conv_id || '-' || turn AS ab_id,
           TIMESTAMP '1970-01-01' + to_minutes(turn) AS ab_emitted_at, conv_id AS unique_id
    FROM conversations QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) = 1""")
def latest_turn(spark, sf_dir):
    return stage(inputs.landed_turns(spark, sf_dir), inputs.TURN_COLUMNS, "2024-01-01")
