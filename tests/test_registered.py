"""Registered queries against SQL, and the shape of their plans."""

import pytest

import __spark_entry__ as contract
from workload.compare import connect, differences
from workload.oracle import ORACLE
from workload.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def database():
    return connect(FOLDER)


def test_every_query_has_a_counterpart():
    assert set(QUERIES) == set(ORACLE)
    assert set(ORACLE) <= set(contract.oracle_sql()) <= set(contract.queries())


def test_entry_gives_rows(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_as_sql(spark, database, name):
    assert differences(QUERIES[name](spark, FOLDER), database, contract.oracle_sql()[name]) is None


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_or_nested_loop_join(spark, name):
    text = plan(QUERIES[name](spark, FOLDER))
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    if name not in {"profile_trips", "slice_max_global"}:
        assert all("partial_" in below for below in to_one_partition(text))


def to_one_partition(text: str) -> list[str]:
    """What stands below each exchange into one partition: partial sums, a row a task."""
    lines = text.splitlines()
    return [lines[i + 1] for i, line in enumerate(lines) if "Exchange SinglePartition" in line]


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(QUERIES["filter_in"](spark, FOLDER))
    assert "PushedFilters: [" in text and "l_suppkey" in text.split("DataFilters")[1]
    text = plan(QUERIES["drop_na_rows"](spark, FOLDER))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double>" in text


def test_first_rows_are_limited_before_the_shuffle(spark):
    before_shuffle = plan(QUERIES["distinct_keep_first"](spark, FOLDER)).split(
        "Exchange hashpartitioning"
    )[-1]
    assert "WindowGroupLimit" in before_shuffle


def test_large_layers_are_not_broadcast(spark):
    from headway.operators import spatial
    from workload.queries import Tables, _stops
    from workload import mapping as m

    tables = Tables(spark, FOLDER)
    areas = tables.areas(m.AREAS_FEET, 2926)
    small = plan(spatial.spatial_join(_stops(tables), areas))
    large = plan(spatial.spatial_join(_stops(tables), areas, shuffled=True))
    assert "BroadcastHashJoin" in small
    assert "SortMergeJoin" in large and "Broadcast" not in large


def test_every_measure_of_the_survey_is_kept(spark):
    lines = spark.read.parquet(f"{FOLDER}/lineitem.parquet")
    groups = lines.select("l_suppkey", "l_linenumber", "l_linestatus").distinct().count()
    for name in ("moe_sum", "moe_interval"):
        found = QUERIES[name](spark, FOLDER)
        assert found.count() == groups and found.where("variable = 'vacant'").count() > 0
    assert QUERIES["moe_sum"](spark, FOLDER).where("variable = 'vacant' AND mf_variable IS NULL").count() > 0


def test_measures_pass_over_other_variables(spark):
    from headway.plans import equity
    from workload import mapping as m

    survey = m.view(spark, FOLDER, m.ACS)
    listed = equity.area_measures(survey.where("variable <> 'vacant'")).orderBy("geoid").collect()
    assert equity.area_measures(survey).orderBy("geoid").collect() == listed
