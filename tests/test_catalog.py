"""Dictionaries from catalogs, manifests, drop plans and sources."""

import json

import pytest
from pyspark.sql import functions as F

from millrace.functions.types import ColumnSpec
from millrace.operators import dictionary as d
from millrace.operators import manifest, relations
from millrace.operators.staging import key_columns
from millrace.plans import cleanup, raw_stream, schema_docs
from millrace.session import shared_folder
from millrace.sources import documents, resolver

PROPERTIES = {
    "id": {"type": ["null", "integer"]},
    "orderDate": {"type": "string", "airbyte_type": "timestamp_with_timezone", "anyOf": [{"type": "string"}]},
    "up_date": {"type": "string"},
    "zebra": {"type": "number"},
    "obj": {"type": "object", "description": "o", "properties": {
        "a": {"type": "object", "properties": {
            "b": {"type": "number", "airbyte_type": "integer"},
            "c": {"type": ["null", "object"], "properties": {"deep": {"description": "dd"}}},
        }},
        "date_free": {"type": "object", "description": "f"},
        "zz": {"type": ["string", "integer"]},
        "list": {"type": "array", "items": {"type": "object", "properties": {"not": {"type": "string"}}}},
    }},
    "free": {"type": "object"},
    "any": {"anyOf": [{"type": "object", "properties": {"x": {"type": "boolean"}}},
                      {"type": "object", "properties": {"y": {"type": "array"}}}, {"type": "string"}]},
    "any2": {"anyOf": [{"type": "string"}], "description": 'quoted "d"'},
    "emptyAny": {"anyOf": [], "type": "boolean"},
    "none": {}, "nulls": {"type": ["null"]}, "multi": {"type": ["string", "integer"]},
    "empty": {"type": "object", "properties": {}},
    "nt": {"type": "string", "airbyte_type": ""},
    "odd": {"type": "date"},
}
# identifier, raw type, typed type
EXPECTED = [
    ("id", "integer", "integer"), ("orderDate", "timestamp", "timestamp"),
    ("up_date", "string", "timestamp"), ("zebra", "numeric", "numeric"),
    ("obj.a.b", "numeric", "numeric"), ("obj.a.c.deep", "string", "string"),
    ("obj.date_free", "string", "timestamp"), ("obj.zz", "string", "string"),
    ("obj.list", "array", "array"), ("free", "string", "string"), ("any.x", "bool", "bool"),
    ("any.y", "array", "array"), ("any2", "array", "array"), ("emptyAny", "bool", "bool"),
    ("none", "string", "string"), ("nulls", "string", "string"), ("multi", "string", "string"),
    ("nt", "string", "string"), ("odd", "string", "string"),
]


def connection(**over):
    return {
        "connectionId": "c1", "destinationId": "d1", "namespaceFormat": "ns_${SOURCE_NAMESPACE}",
        "prefix": "p_", "syncCatalog": {"streams": [
            {"stream": {"name": "Order Lines", "namespace": "pub", "jsonSchema": {"properties": PROPERTIES}},
             "config": {"primaryKey": [["id"], ["orderDate"]]}},
            {"stream": {"name": "noKey", "jsonSchema": {}}, "config": {}},
        ]}, **over,
    }


def catalog(spark, *connections):
    text = json.dumps({"connections": list(connections)})
    return documents.connections(spark.createDataFrame([(text,)], "document string"))


def columns(spark, **how):
    return d.stream_columns(d.streams(catalog(spark, connection())), **how).orderBy("ord").collect()


@pytest.mark.parametrize("date_names", [False, True])
def test_dictionary_follows_the_document(spark, date_names):
    rows = columns(spark, date_names=date_names)
    assert [r.identifier for r in rows] == [e[0] for e in EXPECTED]
    assert [r.data_type for r in rows] == [e[2 if date_names else 1] for e in EXPECTED]
    assert [r.identifier for r in rows if r.is_key] == ["id", "orderDate"]
    assert {r.identifier: r.description for r in rows if r.description} == {
        "obj.a.c.deep": "dd", "obj.date_free": "f", "any2": 'quoted "d"'}


def test_names_that_only_contain_the_letters_of_date_count(spark):
    """The rule looks for the letters, wherever they are."""
    text = json.dumps({"updated_by": {"type": "string"}, "candidate": {"type": "string"}})
    streams = spark.createDataFrame(
        [("c", "s", text, [])], "connectionId string, stream string, properties string, primary_key array<string>")
    assert {r.data_type for r in d.stream_columns(streams, date_names=True).collect()} == {"timestamp"}


def test_any_depth(spark):
    """Deeper than any fixed number of rounds."""
    schema, depth = {"type": "integer"}, 60
    for i in reversed(range(depth)):
        schema = {"type": "object", "properties": {f"l{i}": schema, f"side{i}": {"type": "string"}}}
    text = json.dumps({"top": schema})
    df = spark.createDataFrame([(text,)], "p string")
    got = df.select(F.explode(d.flattened_properties(F.col("p"))).alias("e")).select("e.*").collect()
    assert len(got) == depth + 1
    assert got[0].identifier == "top." + ".".join(f"l{i}" for i in range(depth))
    assert got[1].identifier.endswith(f"l{depth - 2}.side{depth - 1}")


def test_streams_without_key_or_prefix(spark):
    rows = d.streams(catalog(spark, connection(prefix=None))).orderBy("stream").collect()
    assert [(r.stream, r.prefix, r.primary_key) for r in rows] == [
        ("Order Lines", "", ["id", "orderDate"]), ("noKey", "", [])]


def test_single_documents_are_read_like_lists(spark):
    df = spark.createDataFrame([(json.dumps(connection()),)], "document string")
    assert documents.connections(df).first().connectionId == "c1"


def test_documents_in_files(spark, tmp_path):
    for i in range(3):
        document = {"connections": [connection(connectionId=f"c{i}")]}
        (tmp_path / f"{i}.json").write_text(json.dumps(document, indent=2))
    files = documents.document_files(spark, str(tmp_path))
    found = documents.connections(files).select("connectionId").collect()
    assert sorted(r[0] for r in found) == ["c0", "c1", "c2"]


def test_connection_lists(spark):
    many = catalog(spark, connection(), connection(connectionId="c2"), connection(connectionId="c3"))
    assert d.connections_of(many, ["c1", "c3"]).count() == 2


def test_column_specs_end_with_metadata(spark):
    specs = raw_stream.stream_dictionary(catalog(spark, connection()), "c1", "Order Lines")
    assert specs[0] == ColumnSpec("id", "id", "integer", "", True, 1)
    assert [s.name for s in specs[-4:]] == ["execution_date", "ab_id", "ab_emitted_at", "unique_id"]


def test_the_key_keeps_its_own_order(spark):
    over = connection()
    over["syncCatalog"]["streams"][0]["config"]["primaryKey"] = [["orderDate"], ["id"]]
    specs = raw_stream.stream_dictionary(catalog(spark, over), "c1", "Order Lines")
    assert key_columns(specs) == ["order_date", "id"]
    assert key_columns([ColumnSpec("b", "b", "string"), ColumnSpec("a", "a", "string")]) == ["b", "a"]


def destinations(spark):
    text = json.dumps({"destinations": [{
        "destinationId": "d1", "workspaceId": "w1", "destinationDefinitionId": "f1",
        "connectionConfiguration": {"project_id": "proj", "database": "db", "dataset_id": "set"}}]})
    return documents.destinations(spark.createDataFrame([(text,)], "document string"))


def test_schema_documents(spark):
    folder = shared_folder(spark, "docs")
    raw = schema_docs.raw_documents(catalog(spark, connection()), destinations(spark))
    schema_docs.write_documents(raw, f"{folder}/raw", "json")
    sources = spark.read.json(f"{folder}/raw/sources").orderBy("stream").collect()
    assert [(s.source, s.database, s.name, s.identifier) for s in sources] == [
        ("set", "proj", "raw_order_lines", "_airbyte_raw_p_Order Lines"),
        ("set", "proj", "raw_no_key", "_airbyte_raw_p_noKey")]
    assert [c["name"] for c in sources[0]["columns"]] == [
        "_airbyte_ab_id", "_airbyte_emitted_at", "_airbyte_data"]
    typed = schema_docs.typed_documents(catalog(spark, connection()), destinations(spark), "snowflake")
    rows = typed["sources"].orderBy("stream").collect()
    assert [(s.source, s.database, s.model, s.loaded_at_field) for s in rows] == [
        ("ns_pub", "db", "stg_p_Order Lines", "_airbyte_extracted_at"),
        ("ns_unknown", "db", "stg_p_noKey", "_airbyte_extracted_at")]
    names = [r.name for r in typed["source_columns"].orderBy("ord").collect()]
    assert names == [e[0] for e in EXPECTED]


def test_landing_formats_along_the_chain(spark):
    tags = spark.createDataFrame([("f1", "1.11.0")], "destinationDefinitionId string, dockerImageTag string")
    found = d.landing_formats(
        catalog(spark, connection(), connection(connectionId="c2", destinationId="gone")),
        destinations(spark), tags,
    )
    assert {r.connectionId: r.init_version for r in found.collect()} == {"c1": 2, "c2": None}


NODES = {
    "m1": {"resource_type": "model", "package_name": "own", "name": "a", "alias": None, "database": "db",
           "schema": "s", "raw_code": "SELECT 1"},
    "m2": {"resource_type": "model", "package_name": "own", "name": "b", "alias": "B2", "database": "db",
           "schema": "s", "raw_code": "CREATE MODEL x"},
    "m3": {"resource_type": "model", "package_name": "re_data", "name": "c", "alias": "", "database": "db",
           "schema": "s", "raw_code": "ALTER TABLE t ADD CONSTRAINT c"},
    "t1": {"resource_type": "test", "package_name": "own", "name": "t", "schema": "s"},
}


def manifests(spark, **document):
    df = spark.createDataFrame([("p", json.dumps(document))], "project string, document string")
    return documents.manifests(df, F.col("project"))


def test_item_counts(spark):
    row = manifest.item_counts(manifests(spark, nodes=NODES)).first()
    assert (row.models_count, row.tests_count, row.seeds_count, row.sources_count, row.total_tasks) == (2, 1, 0, 0, 3)
    with pytest.raises(ValueError):
        manifest.item_count("macros")


def test_ml_guard(spark):
    nodes = documents.manifest_nodes(manifests(spark, nodes=NODES))
    flags = {r.name: (r.a, r.b) for r in nodes.select(
        "name", resolver.uses_ml(F.col("raw_code")).alias("a"),
        resolver.uses_ml(F.col("raw_code"), whole_words=True).alias("b")).collect()}
    assert flags == {"a": (False, False), "b": (True, True), "c": (True, False), "t": (False, False)}


LISTING = [("db", "s", "a", "BASE TABLE"), ("db", "s", "B2", "VIEW"), ("db", "s", "c", "EXTERNAL"),
           ("db", "other", "a", "BASE TABLE"), ("db", "s", "t", "BASE TABLE")]


def listing(spark, rows=LISTING):
    return spark.createDataFrame(
        rows, "table_catalog string, table_schema string, table_name string, table_type string")


@pytest.mark.parametrize("dialect, commands", [
    ("bigquery", ["DROP VIEW `db.s.B2`;", "DROP TABLE `db.s.a`;", "DROP SCHEMA IF EXISTS `db.s` CASCADE;"]),
    ("snowflake", ["DROP VIEW db.s.B2;", "DROP TABLE db.s.a;", "DROP SCHEMA IF EXISTS db.s CASCADE;"]),
    ("redshift", ['DROP VIEW db.s."B2";', "DROP TABLE db.s.a;", "DROP SCHEMA IF EXISTS db.s CASCADE;"]),
    ("spark", ["DROP VIEW `db`.`s`.`B2`;", "DROP TABLE `db`.`s`.`a`;", "DROP SCHEMA IF EXISTS `db`.`s` CASCADE;"]),
])
def test_drop_plan(spark, dialect, commands):
    nodes = documents.manifest_nodes(manifests(spark, nodes=NODES))
    plan = relations.drop_plan(listing(spark), nodes, dialect)
    assert [r.command for r in plan.collect()] == commands
    only = relations.drop_plan(listing(spark), nodes, dialect, schemas=False)
    assert [r.command for r in only.collect()] == commands[:2]


def test_clean_up_is_a_dry_run_unless_told(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS clean_me")
    spark.sql("CREATE VIEW IF NOT EXISTS clean_me.a AS SELECT 1 AS x")
    nodes = documents.manifest_nodes(manifests(
        spark, nodes={"m": NODES["m1"] | {"schema": "clean_me", "database": "spark_catalog"}}))
    found = listing(spark, [("spark_catalog", "clean_me", "a", "VIEW")])
    plan, said = relations.drop_plan(found, nodes, "spark"), []
    assert cleanup.run_drop_plan(plan, log=said.append) == 0
    assert said == ["DROP VIEW `spark_catalog`.`clean_me`.`a`;",
                    "DROP SCHEMA IF EXISTS `spark_catalog`.`clean_me` CASCADE;"]
    assert spark.catalog.tableExists("clean_me.a")
    assert cleanup.run_drop_plan(plan, dry_run=False, log=said.append) == 1
    assert not spark.catalog.tableExists("clean_me.a") and spark.catalog.databaseExists("clean_me")
    schema_only = plan.where("command LIKE 'DROP SCHEMA%'")
    assert cleanup.run_drop_plan(schema_only, dry_run=False, drop_schemas=True, log=said.append) == 1
    assert not spark.catalog.databaseExists("clean_me")
    cleanup.run_drop_plan(relations.drop_plan(listing(spark, LISTING[3:4]), nodes), log=said.append)
    assert said[-1] == "No relations to clean."


def test_source_redirect(spark):
    test = resolver.Target("bigquery", "e2e", "proj", "branch")
    assert resolver.source_name("src", "t", test) == "`branch_src`.`t`"
    assert resolver.source_name("src", "t", test, model_uses_ml=True) == "`src`.`t`"
    for target in (resolver.Target("bigquery", "prod", "proj", "branch"),
                   resolver.Target("snowflake", "test", "proj", "branch")):
        assert resolver.source_name("src", "t", target) == "`src`.`t`"
    resolver.write_sample(spark.range(3), "src", "t", test)
    assert resolver.read_source(spark, "src", "t", test).count() == 3
    spark.sql("DROP DATABASE branch_src CASCADE")
    with pytest.raises(ValueError):
        resolver.write_sample(spark.range(3), "src", "t", target)


def test_samples_of_two_tables_still_join(spark):
    a = spark.range(5000).withColumnRenamed("id", "k")
    b = spark.range(2500, 7500).withColumnRenamed("id", "k")
    sa, sb = (resolver.repeatable_sample(x, ["k"], 0.2) for x in (a, b))
    common = {r.k for r in sa.collect()} & set(range(2500, 5000))
    assert common == {r.k for r in sb.collect()} & set(range(2500, 5000))
    assert 700 < sa.count() < 1300


def test_other_databases_and_reserved_words(spark):
    nodes = documents.manifest_nodes(manifests(spark, nodes={
        "m": NODES["m1"] | {"database": "db", "schema": "s", "name": "order", "alias": None}}))
    found = listing(spark, [("db", "s", "order", "VIEW"), ("other", "s", "order", "VIEW")])
    for dialect in ("redshift", "postgres", "fabric"):
        plan = relations.drop_plan(found, nodes, dialect)
        assert [r.command for r in plan.collect()] == [
            'DROP VIEW db.s."order";', "DROP SCHEMA IF EXISTS db.s CASCADE;"]


def test_types_without_items_count_zero(spark):
    from millrace.operators import manifest

    nodes = spark.sql("SELECT 'nodes' AS section, 'model' AS resource_type, 'own' AS package_name")
    counts = {r.resource_type: r.n_items for r in manifest.counts_by_type(nodes).collect()}
    assert counts == {"model": 1, "source": 0, "seed": 0, "snapshot": 0, "test": 0}


def test_flat_schemas_take_rounds_of_their_depth(spark):
    from millrace.operators import dictionary

    flat = "{" + ", ".join(f'"o{i}": {{"type": "object", "properties": {{"a}}{i}": {{"type": "integer"}}}}}}' for i in range(300)) + "}"
    deep = '{"x0": {"type": "integer"}}'
    for i in range(1, 30):
        deep = f'{{"x{i}": {{"type": "object", "properties": {deep}}}}}'
    rows = spark.createDataFrame([(flat,), (deep,), ("{}",)], "p string").select(
        dictionary.flattened_properties(F.col("p")).alias("leaves")
    ).collect()
    assert [e.identifier for e in rows[0].leaves] == [f"o{i}.a}}{i}" for i in range(300)]
    assert [e.identifier for e in rows[1].leaves] == [".".join(f"x{i}" for i in range(29, -1, -1))]


def test_leaves_of_all_depths_keep_the_order_of_the_document(spark):
    from millrace.operators import dictionary

    def schema(tree):
        return "{" + ", ".join(
            f'"{k}": ' + ('{"type": "integer"}' if v is None else f'{{"type": "object", "properties": {schema(v)}}}')
            for k, v in tree.items()) + "}"

    def leaves(tree, above=""):
        return [x for k, v in tree.items() for x in ([above + k] if v is None else leaves(v, f"{above}{k}."))]

    tree = {"z": {"y": None, "b": {"q": None, "a": None}, "c": None}, "m": None, "a": {"k": {"l": {"x": None}}, "j": None}, "b": None}
    got = spark.createDataFrame([(schema(tree),)], "p string").select(dictionary.flattened_properties(F.col("p")).alias("e")).first().e
    assert [e.identifier for e in got] == leaves(tree)


def test_streams_of_one_export_are_spread(spark):
    from pyspark.sql import functions as F

    from millrace.operators import dictionary
    from millrace.sources import documents

    member = '{"connectionId": "c%d", "syncCatalog": {"streams": [{"stream": {"name": "s"}}]}}'
    export = '{"connections": [' + ", ".join(member % i for i in range(400)) + "]}"
    found = dictionary.streams(documents.connections(spark.createDataFrame([(export,)], "document string")))
    sizes = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 400 and len(sizes) == spark.sparkContext.defaultParallelism and max(sizes) < 100


def test_listing_of_the_session_catalog(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS listing_of_tests")
    spark.range(3).write.mode("overwrite").saveAsTable("listing_of_tests.t")
    spark.sql("CREATE OR REPLACE VIEW listing_of_tests.v AS SELECT * FROM listing_of_tests.t")
    spark.range(1).createOrReplaceTempView("only_of_this_session")
    found = relations.catalog_listing(spark, ["listing_of_tests"])
    assert sorted(map(tuple, found.collect())) == [
        ("spark_catalog", "listing_of_tests", "t", "BASE TABLE"), ("spark_catalog", "listing_of_tests", "v", "VIEW")]
    nodes = documents.manifest_nodes(manifests(spark, nodes={
        "m": NODES["m1"] | {"database": "spark_catalog", "schema": "listing_of_tests", "name": "t", "alias": None}}))
    assert [r.command for r in relations.drop_plan(found, nodes, "spark", schemas=False).collect()] == [
        "DROP TABLE `spark_catalog`.`listing_of_tests`.`t`;"]
    assert ("spark_catalog", "listing_of_tests", "t", "BASE TABLE") in map(tuple, relations.catalog_listing(spark).collect())
    assert relations.catalog_listing(spark, []).count() == 0
    spark.sql("DROP DATABASE listing_of_tests CASCADE")


def test_listing_out_of_an_export(spark):
    rows = [("DB", "S", "A", "base table "), ("DB", "S", "B", "VIEW"), ("DB", "S", "C", None)]
    export = spark.createDataFrame(rows, "TABLE_CATALOG string, TABLE_SCHEMA string, Table_Name string, TABLE_TYPE string")
    found = relations.exported_listing(export.withColumn("ROW_COUNT", F.lit(1)))
    assert found.columns == list(relations.LISTING)
    assert sorted(map(str, found.collect())) == sorted(map(str, relations.exported_listing(found).collect()))
    assert {r.table_type for r in found.collect()} == {"BASE TABLE", "VIEW", None}
    with pytest.raises(ValueError, match="table_type"):
        relations.exported_listing(export.drop("TABLE_TYPE"))
