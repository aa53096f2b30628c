"""Data tests."""

from __future__ import annotations

from millrace.operators import quality as tests
from workload import inputs
from workload.registered import query


def _labelled(spark, sf_dir):
    documents = inputs.table(spark, sf_dir, "documents").select("doc_id", "lang")
    return documents.join(inputs.table(spark, sf_dir, "labels"), "doc_id", "left")


def _line(model: str, column: str, test: str, failures: str) -> str:
    return f"""SELECT '{model}' AS model, '{column}' AS "column", '{test}' AS test,
        CAST(({failures}) AS BIGINT) AS failures,
        CASE WHEN ({failures}) > 0 THEN 'fail' ELSE 'pass' END AS status"""


def _nulls(model, column, table):
    return _line(model, column, "not_null", f'SELECT count(*) FROM {table} WHERE "{column}" IS NULL')


def _twice(model, column, table):
    return _line(model, column, "unique", f"""SELECT count(*) FROM (SELECT 1 FROM {table}
        WHERE "{column}" IS NOT NULL GROUP BY "{column}" HAVING count(*) > 1)""")


LABELLED = "(SELECT doc_id, lang, quality, toxic FROM documents LEFT JOIN labels USING (doc_id))"


@query("not_null_test", " UNION ALL ".join(
    _nulls("labelled", c, LABELLED) for c in ("doc_id", "lang", "quality", "toxic")))
def not_null_test(spark, sf_dir):
    return tests.not_null(_labelled(spark, sf_dir), "labelled", ["doc_id", "lang", "quality", "toxic"])


@query("unique_test", " UNION ALL ".join(
    _twice("lineitem", c, "lineitem") for c in ("l_orderkey", "l_linenumber", "l_extendedprice")))
def unique_test(spark, sf_dir):
    return tests.unique(
        inputs.table(spark, sf_dir, "lineitem"), "lineitem",
        ["l_orderkey", "l_linenumber", "l_extendedprice"],
    )


@query("primary_key_test", " UNION ALL ".join(
    [_nulls("lineitem", c, "lineitem") for c in ("l_orderkey", "l_linenumber")]
    + [_twice("lineitem", c, "lineitem") for c in ("l_orderkey", "l_linenumber")]))
def primary_key_test(spark, sf_dir):
    return tests.primary_key(
        inputs.table(spark, sf_dir, "lineitem"), "lineitem", ["l_orderkey", "l_linenumber"]
    )


@query("composite_key_test", " UNION ALL ".join([
    _line("lineitem", "l_orderkey, l_linenumber", "not_null",
          "SELECT count(*) FROM lineitem WHERE l_orderkey IS NULL OR l_linenumber IS NULL"),
    _line("lineitem", "l_orderkey, l_linenumber", "unique",
          """SELECT count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber
             HAVING count(*) > 1)""")]))
def composite_key_test(spark, sf_dir):
    return tests.primary_key(
        inputs.table(spark, sf_dir, "lineitem"), "lineitem", ["l_orderkey", "l_linenumber"],
        composite=True,
    )


@query("freshness_test", """
    SELECT 'events' AS model, 'ts' AS "column", 'freshness' AS test, CAST(1 AS BIGINT) AS failures,
           CASE WHEN TIMESTAMP '2024-02-01 06:00:00' - max(ts) > INTERVAL 36 HOUR THEN 'error'
                ELSE 'warn' END AS status
    FROM events""")
def freshness_test(spark, sf_dir):
    return tests.freshness_test(
        inputs.table(spark, sf_dir, "events"), "events", "ts", "2024-02-01 06:00:00"
    )


@query("test_report", " UNION ALL ".join([
    _nulls("orders", "o_orderkey", "orders"), _twice("orders", "o_orderkey", "orders"),
    _nulls("labelled", "quality", LABELLED), _twice("customer", "c_mktsegment", "customer"),
    """SELECT 'events', 'ts', 'freshness', CAST(CASE WHEN max(ts) >= TIMESTAMP '2024-01-30 00:00:00'
         THEN 0 ELSE 1 END AS BIGINT), CASE WHEN max(ts) >= TIMESTAMP '2024-01-30 00:00:00' THEN 'pass'
         ELSE 'warn' END FROM events"""]))
def test_report(spark, sf_dir):
    return tests.report([
        tests.primary_key(inputs.table(spark, sf_dir, "orders"), "orders", ["o_orderkey"]),
        tests.not_null(_labelled(spark, sf_dir), "labelled", ["quality"]),
        tests.unique(inputs.table(spark, sf_dir, "customer"), "customer", ["c_mktsegment"]),
        tests.freshness_test(
            inputs.table(spark, sf_dir, "events"), "events", "ts", "2024-01-31 00:00:00"
        ),
    ])
