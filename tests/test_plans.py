"""Plan shape: the scale properties the operators promise."""

from sluice.operators import envelope as env
from sluice.operators import validate as val
from sluice.operators.rules import validate_rules
from sluice.sources import testdata as td

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_compiled_validation_is_map_only_and_pruned(spark, registry):
    msgs = env.to_envelope(td.order_records(spark, SF))
    plan = _plan(val.validate(msgs, registry, design="compiled"))
    # the only exchange allowed is the spread of a single-split test file
    assert "hashpartitioning" not in plan and "SortMergeJoin" not in plan
    assert "BroadcastHashJoin" not in plan
    scan = [line for line in plan.splitlines() if "FileScan parquet" in line][0]
    assert "o_orderdate" in scan and "o_orderpriority" not in scan  # only used columns are read


def test_rules_validation_broadcasts_the_rules(spark, registry):
    msgs = env.to_envelope(td.order_records(spark, SF))
    plan = _plan(validate_rules(msgs, registry, broadcast=True))
    assert "BroadcastHashJoin" in plan or "BroadcastExchange" in plan
    assert "SortMergeJoin" not in plan


def test_salted_rules_join_partitions_on_uri_and_salt(spark, registry):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        msgs = env.to_envelope(td.order_records(spark, SF))
        plan = _plan(validate_rules(msgs, registry, broadcast=False))
        assert "__salt" in plan and "BroadcastHashJoin" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_filter_on_envelope_column_reaches_the_scan(spark, registry):
    msgs = env.to_envelope(td.order_records(spark, SF))
    out = val.validate(msgs, registry, design="compiled").where("offset < 100")
    scan = [line for line in _plan(out).splitlines() if "FileScan parquet" in line][0]
    assert "PushedFilters: [IsNotNull(o_orderkey), LessThan(o_orderkey,100)]" in scan


def test_many_splits_are_not_shuffled(spark, registry):
    rows = spark.range(0, 1000, 1, numPartitions=50).selectExpr(
        "cast(id as string) k", "'t' origin", "'http://schema-repository:8080/schemas/order/2.0.0' schemaURI",
        "timestamp'2024-01-02' timestamp", "'{}' data")
    for design in ("compiled", "rules"):
        plan = _plan(val.validate(rows, registry, design=design))
        assert "Exchange" not in plan.replace("BroadcastExchange", "")


def test_building_a_query_runs_only_registry_jobs(spark):
    from sluice.plans import queries as q
    q.q06_validate_status(spark, SF)  # the registry is compiled once per content
    ids = lambda: set(spark.sparkContext.statusTracker().getJobIdsForGroup("building"))
    spark.sparkContext.setJobGroup("building", "plans")
    try:
        for f in (q.q01_record_to_envelope, q.q18_read_group, q.q22_upsert_latest):
            f(spark, SF)
        # reading a parquet footer for its schema is the one job a read may start
        assert len(ids()) <= 6
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_single_file_tables_are_dealt_out_and_larger_ones_left(spark, tmp_path):
    spark.range(10).repartition(3).write.parquet(f"{tmp_path}/orders.parquet")
    assert "Exchange" not in _plan(td.table(spark, str(tmp_path), "orders"))
    assert "RoundRobin" in _plan(td.table(spark, SF, "orders"))


def test_element_schemas_stay_map_only(spark):
    import json
    line = {"type": "object", "required": ["qty"], "properties": {"qty": {"type": "integer", "minimum": 1}, "tags": {"items": {"minLength": 2}}},
            "anyOf": [{"required": ["a"]}, {"properties": {"qty": {"maximum": 9}}}]}
    doc = {"type": "object", "properties": {"lines": {"type": "array", "items": line}}}
    reg = spark.createDataFrame([("http://t/schemas/l/1.0.0", json.dumps(doc))], "schemaURI string, schema string")
    texts = ['{"lines":[{"qty":1,"tags":["ab"]},{"qty":10,"a":1}]}', '{"lines":[{"qty":10},{"tags":["a","bc"]}]}', '{"lines":[3]}', '{"lines":{}}', "{}"]
    msgs = spark.createDataFrame([(str(i), "http://t/schemas/l/1", t) for i, t in enumerate(texts)], "k string, schemaURI string, data string")
    out = val.validate(msgs, reg, design="compiled")
    plan = _plan(out)
    assert "Exchange" not in plan and "Python" not in plan and "Join" not in plan
    assert {r.k: sorted(r.errors) for r in out.collect()} == {
        "0": [], "1": ["anyOf:lines[]", "minLength:lines[].tags[]", "required:lines[].qty"], "2": ["type:lines[]"],
        "3": ["type:lines"], "4": []}
