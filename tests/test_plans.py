"""Plan shape: no single-partition data exchange, pushdown, pruning, partial aggregation."""

import re

from conftest import SF01
from loadcast.operators import kv as KV
from loadcast.operators.features import final_features, lag_profile
from loadcast.plans import forecast as FC
from loadcast.sources import adapters as AD


def explain(df) -> str:
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def _single_partition_inputs(text: str) -> list[str]:
    """Input column lists of every Exchange SinglePartition node."""
    nodes = re.split(r"\n\(\d+\) ", text)
    out = []
    for n in nodes:
        if n.startswith("Exchange") and "SinglePartition" in n:
            m = re.search(r"Input \[\d+\]: \[(.*)\]", n)
            out.append(m.group(1) if m else "")
    return out


def test_feature_query_has_no_single_partition_data_exchange(spark):
    ev = AD.read_table(spark, SF01, "events")
    df = final_features(AD.load_series(ev), AD.weather_series(ev))
    for cols in _single_partition_inputs(explain(df)):
        names = {c.split("#")[0].strip() for c in cols.split(",")}
        assert names <= {"_pid", "_opid", "_first", "_n", "_off"}, names  # only the per-partition offsets table


def test_global_form_would_use_single_partition(spark):
    ev = AD.event_series(AD.read_table(spark, SF01, "events"))
    glob = lag_profile(ev, method="global")
    assert _single_partition_inputs(explain(glob))
    halo = lag_profile(ev, block=8192)
    for cols in _single_partition_inputs(explain(halo)):
        assert "mw" not in cols


def test_filter_and_columns_reach_the_scan(spark):
    ev = AD.read_table(spark, SF01, "events")
    text = explain(AD.weather_series(ev))
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(event_type,error\)", text)
    load_text = explain(AD.load_series(ev))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", load_text).group(1)
    assert set(re.findall(r"(\w+):", schema)) == {"ts", "value"}


def test_keyed_merge_aggregates_partially_before_shuffle(spark):
    ups = AD.keyed_upserts(AD.read_table(spark, SF01, "events"))
    text = explain(KV.kv_current(ups, "key", ("seq",), ["value", "props"]))
    assert "partial_max_by" in text


def test_export_is_top_k(spark):
    ev = AD.read_table(spark, SF01, "events")
    preds = FC.seasonal_predictions(final_features(AD.load_series(ev), AD.weather_series(ev)))
    assert "TakeOrderedAndProject" in explain(KV.export_latest(preds, 24))


def test_many_series_plan_has_no_single_partition_exchange(spark):
    ev = AD.event_series(AD.read_table(spark, SF01, "events"))
    df = lag_profile(ev, order=("ts", "event_id"), series_keys=("user_id",), block=8192)
    assert _single_partition_inputs(explain(df)) == []


def test_no_python_evaluation_in_any_catalogue_plan(spark):
    import __spark_entry__ as E

    for name in ("final_features", "halo_lag_events", "kv_current", "serve_combined", "forecast_inputs"):
        text = explain(E.queries()[name](spark, SF01))
        assert not re.search(r"(BatchEvalPython|ArrowEvalPython|MapInPandas|FlatMapGroupsInPandas)", text), name


def test_cluster_settings_and_size_rule(spark):
    from loadcast.session import cluster_conf, parse_bytes, target_partitions

    conf = cluster_conf(4000)
    assert int(conf["spark.sql.shuffle.partitions"]) == 12000
    assert parse_bytes(conf["spark.sql.adaptive.advisoryPartitionSizeInBytes"]) == 256 << 20
    assert conf["spark.sql.adaptive.skewJoin.enabled"] == "true"
    ev = AD.read_table(spark, SF01, "events")
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    try:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1k")
        assert target_partitions(ev) is not None  # a plain scan: the estimate is trusted
        assert target_partitions(AD.load_series(ev)) is None  # after an aggregate: not trusted
        assert target_partitions(final_features(AD.load_series(ev), AD.weather_series(ev))) is None
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
