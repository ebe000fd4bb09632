"""Results must not depend on the physical plan: rerun oracle queries with AQE off,
no automatic broadcast (sort-merge joins as with large tables) and many partitions."""

import pytest

import __spark_entry__ as E
from ratecraft.plans.compare import digest, duck_connect

SF = "/root/testdata/sf0.001"
KEYS = ["rate_pivot", "rate_with_survey", "top5_nations", "describe", "median_fill", "mutual_info",
        "ordinal_codes", "interval_summary", "early_stop", "early_stop_delta", "median_prune",
        "rank_segments", "resume"]
CONF = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "64"}


@pytest.fixture(scope="module")
def big_cluster_conf(spark):
    old = {k: spark.conf.get(k) for k in CONF}
    for k, v in CONF.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("key", KEYS)
def test_same_result_without_broadcast_or_aqe(big_cluster_conf, key):
    spark = big_cluster_conf
    con = duck_connect(SF)
    df = E.queries()[key](spark, SF)
    plan = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    assert "AdaptiveSparkPlan" not in plan
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[key])
    assert digest(df.columns, rows)[0] == digest([d[0] for d in res.description], res.fetchall())[0]
