"""Names, types, keys and values out of JSON."""

import json

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from millrace.functions import json_values, keys, names, types
from millrace.functions.types import ColumnSpec as C
from millrace.operators.staging import typed_columns
from millrace.sources.landing import RAW_DATA, RAW_ID, RAW_TIME

NAMES = {
    "__CustomerID.orderDate X": "customer_id_order_date_x",
    "_ab_cdc_cursor": "ab_cdc_cursor",
    "orderId": "order_id",
    "a.b.cD": "a_b_c_d",
    "HTTPServer2Go": "http_server2_go",
    "user._id": "user_id",
}


@pytest.mark.parametrize("identifier", NAMES)
def test_standard_name(identifier):
    assert names.standard_name(identifier) == NAMES[identifier]


def test_standard_name_column_agrees(spark):
    extra = ["Größe Maß", "é_ x", "straßeÉcole._Id", " _x", "ÀBc.Def"]
    df = spark.createDataFrame([(n,) for n in [*NAMES, *extra]], "n string")
    for row in df.select("n", names.standard_name_col(F.col("n")).alias("s")).collect():
        assert row.s == names.standard_name(row.n)


@settings(max_examples=200, deadline=None)
@given(st.text("abC_. 1", max_size=12))
def test_standard_name_is_lower_and_undotted(identifier):
    name = names.standard_name(identifier)
    assert name == name.lower() and "." not in name and " " not in name


@pytest.mark.parametrize("tag, expected", [
    ("1.10.2", 1), ("1.10.3", 2), ("1.2.20", 1), ("2.0", 2), ("1.10.2-rc1", 1), ("1.10.3rc1", 2),
    ("1.10.2.post1", 2), ("1.10.2.0", 1), ("1.10.2.1", 2), ("1.10", 1), ("1!0.1", 2), ("v2.1", 2),
    ("1.10.2+x", 2), ("1.10.2.dev1+x", 1), ("dev", None), ("latest", None), ("", None), (None, None),
])
def test_landing_format(spark, tag, expected):
    df = spark.createDataFrame([(tag,)], "tag string")
    assert df.select(types.landing_format(F.col("tag"))).first()[0] == expected


def test_key_text_prints_as_the_warehouse(spark):
    df = spark.sql(
        "SELECT 1.50BD AS d0, cast('100' AS decimal(38,9)) AS d1, cast(0 AS decimal(38,9)) AS d2, "
        "cast('0.000000001' AS decimal(38,9)) AS d3, timestamp'2024-01-02 03:04:05' AS t, "
        "date'2024-01-02' AS d, true AS b, 7L AS n"
    )
    texts = df.select(*[keys.key_text(F.col(f.name), f.dataType).alias(f.name) for f in df.schema])
    assert list(texts.first()) == [
        "1.5", "100", "0", "0.000000001", "2024-01-02 03:04:05+00", "2024-01-02", "true", "7",
    ]


def test_single_key_is_not_digested(spark):
    df = spark.createDataFrame([(1, None)], "a long, b string")
    assert df.select(keys.unique_id(df, ["a"])).first()[0] == 1
    expected = spark.sql("SELECT md5('1-_dbt_utils_surrogate_key_null_')").first()[0]
    assert df.select(keys.unique_id(df, ["a", "b"])).first()[0] == expected


PAYLOADS = [
    '{"n": 1.50, "o": {"z": 1}, "a": ["x", 1, null, 1.5, {"b": 1, "a": [2, 3]}], "s": "{not}", '
    '"f g": 3, "t": "20240102", "yes": true}',
    '{"o": "text", "a": [], "s": "[1]", "t": "2024-01-02", "o2": {"k": {"deep": 5}}}',
    '{"a": "[1]", "s": "{\\"k\\": 1}", "t": "", "o2": {"k": "flat"}, "N": 9}',
    '{"a": {"x": 1}, "s": {"k": 1}, "t": "2024-01-02T03:04:05Z", "o": null, "n": "12"}',
    "{broken", "[1, 2]", None,
]
COLUMNS = [
    C("n", "n", "numeric"), C("big_n", "N", "integer"), C("o", "o", "string"), C("o_z", "o.z", "integer"),
    C("a", "a", "array"), C("s", "s", "string"), C("f_g", "f g", "integer"), C("t", "t", "timestamp"),
    C("yes", "yes", "bool"), C("deep", "o2.k.deep", "integer"),
]


def landed(spark, payloads):
    return spark.createDataFrame(
        [(str(i), p) for i, p in enumerate(payloads)], f"{RAW_ID} string, {RAW_DATA} string"
    ).withColumn(RAW_TIME, F.lit("2024-01-01").cast("timestamp"))


def test_values_of_every_kind(spark):
    got = {
        r.ab_id: r.asDict()
        for r in typed_columns(landed(spark, PAYLOADS), COLUMNS, "2024-01-01", "null").collect()
    }
    pick = lambda i, *cs: tuple(None if got[i][c] is None else str(got[i][c]) for c in cs)
    # Objects and arrays are no scalars, strings that look like them are.
    assert pick("0", "n", "o", "o_z", "s", "f_g", "yes") == ("1.500000000", None, "1", "{not}", "3", "True")
    assert pick("1", "o", "o_z", "s", "deep") == ("text", None, "[1]", "5")
    assert pick("2", "s", "big_n", "n", "deep") == ('{"k": 1}', "9", None, None)
    assert pick("3", "s", "o", "n") == (None, None, "12.000000000")
    # Array elements keep their quotes, their nulls and their key order.
    assert [got[i]["a"] for i in "0123"] == ['"x"1null1.5{"b":1,"a":[2,3]}', "", None, None]
    assert pick("0", "t") == pick("1", "t") == ("2024-01-02 00:00:00",)
    assert pick("2", "t") == (None,) and pick("3", "t") == ("2024-01-02 03:04:05",)
    for i in "456":
        assert all(got[i][c.name] is None for c in COLUMNS)
    assert typed_columns(landed(spark, PAYLOADS[:4]), COLUMNS, "2024-01-01").count() == 4
    for broken in PAYLOADS[4:6]:
        with pytest.raises(Exception, match="MALFORMED_RECORD"):
            typed_columns(landed(spark, [broken]), COLUMNS, "2024-01-01").collect()


def test_long_numbers_keep_their_digits(spark):
    payload = '{"n": 12345678901234567.89, "o": {"z": 12345678901234567890123456.789}, "a": [12345678901234567.89, 1.50]}'
    columns = [C("n", "n", "numeric"), C("z", "o.z", "numeric"), C("text", "n", "string"), C("path", "o", "string"), C("a", "a", "array")]
    row = typed_columns(landed(spark, [payload]), columns, "2024-01-01").first()
    assert (str(row.n), row.text, row.a) == ("12345678901234567.890000000", "12345678901234567.89", "12345678901234567.891.5")
    assert str(row.z) == "12345678901234567890123456.789000000"


@pytest.mark.parametrize("payload, column", [
    ('{"v": "3.7"}', C("v", "v", "integer")), ('{"v": "x"}', C("v", "v", "numeric")),
    ('{"v": "nope"}', C("v", "v", "bool")), ('{"v": "2024-13-01"}', C("v", "v", "timestamp")),
    ('{"v": "soon, maybe"}', C("v", "v", "timestamp")),
])
def test_bad_values_fail_or_turn_null(spark, payload, column):
    raw = landed(spark, [payload])
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|CANNOT_PARSE_TIMESTAMP"):
        typed_columns(raw, [column], "2024-01-01").collect()
    lenient = typed_columns(raw, [column], "2024-01-01", on_error="null")
    assert lenient.first()["v"] is None


@settings(max_examples=15, deadline=None)
@given(st.lists(
    st.dictionaries(
        st.sampled_from(["a", "b", "c d", "e"]),
        st.one_of(st.none(), st.text(max_size=6), st.booleans(), st.integers(-10**6, 10**6),
                  st.lists(st.one_of(st.none(), st.integers(-9, 9), st.text(max_size=3)), max_size=3)),
    ), min_size=1, max_size=8,
))
def test_scalars_against_python(spark, documents):
    columns = [C(k, k, "string") for k in ("a", "b", "c d", "e")]
    payloads = [json.dumps(d) for d in documents]
    rows = typed_columns(landed(spark, payloads), columns, "2024-01-01").collect()
    got = {int(r.ab_id): r for r in rows}
    for i, d in enumerate(documents):
        for c in columns:
            value = d.get(c.identifier)
            if value is None or isinstance(value, list):
                expected = None
            elif isinstance(value, bool):
                expected = str(value).lower()
            else:
                expected = str(value)
            assert got[i][c.name] == expected


def test_leaves_that_share_no_struct():
    fits, rest = json_values.split_leaves(["a", "A", "b", "b.z", "q.r", "Q.s", "q.t", "u.v.w", "u.v"])
    assert fits == ["a", "b", "q.r", "q.t", "u.v.w"]
    assert rest == ["A", "b.z", "Q.s", "u.v"]


def test_one_parse_per_row(spark):
    plan = typed_columns(landed(spark, PAYLOADS), COLUMNS[5:9], "2024-01-01")
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("from_json(") == 1


def test_json_path_quotes_odd_steps():
    assert json_values.json_path("a.b c") == "$.a['b c']"


def test_repository_and_dataset_names(spark):
    one = spark.range(1)
    remotes = ["git@h.example:o/r.git", "https://oauth2:t@h.example/o/r.git", "https://h.example/o/r"]
    for remote in remotes:
        assert one.select(names.repository_base(F.lit(remote))).first()[0] == "h.example/o/r"
    # A host that contains the suffix keeps its name.
    kept = one.select(names.repository_base(F.lit("https://my.github.example/o/r.git"))).first()[0]
    assert kept == "my.github.example/o/r"


def test_quote_ident(spark):
    values = {"plain_1": "plain_1", "Mixed": '"Mixed"', 'a"b': '"a""b"', "select": '"select"', "1a": '"1a"'}
    df = spark.createDataFrame([(v,) for v in values], "n string")
    for row in df.select("n", names.quote_ident(F.col("n"), ["select"]).alias("q")).collect():
        assert row.q == values[row.n]


@pytest.mark.parametrize("date_format, text", [
    ("%Y%m%d", "20240203"), ("%d/%m/%Y", "03/02/2024"), ("yyyy-MM-dd", "2024-02-03"),
    ("%Y-%m-%dT%H:%M:%S", "2024-02-03T04:05:06"), ("%F", "2024-02-03"),
])
def test_partition_date(spark, date_format, text):
    df = spark.createDataFrame([(json.dumps({"a": {"day": text}}),)], "d string")
    value = df.select(json_values.partition_date(F.col("d"), "a.day", date_format)).first()[0]
    assert str(value) == "2024-02-03"


def test_unknown_date_directives():
    with pytest.raises(ValueError):
        json_values.date_pattern("%Q")
