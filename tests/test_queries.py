"""Every registered query against its SQL, and the shape of the plans that matter at scale."""

import pytest
from conftest import SF_DIR

import __spark_entry__ as entry
from compare import connect, differences, force_hot_keys
from sessionflow import plans
from sessionflow.sources import bindings as B

ORACLES = plans.all_oracles()
SAME = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
HOT = "event_enrichment session_assign recent_tracks session_track_lists recommendations_next candidate_pick".split()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.fixture
def hot_keys():
    before = B.QUERY_SKEW
    force_hot_keys()
    yield
    B.QUERY_SKEW = before


def test_every_query_has_its_sql():
    assert set(plans.all_queries()) == set(ORACLES)
    assert set(ORACLES) <= set(entry.queries())


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    """Same rows, same column types, and a plan without Python, cross joins or nested loops."""
    df = entry.queries()[name](spark, SF_DIR)
    plan = plan_of(df)
    for node in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan, node
    described = con.execute(f"DESCRIBE {ORACLES[name]}").fetchall()
    assert {column: SAME[kind] for column, kind in df.dtypes} == {row[0]: row[1] for row in described}
    assert differences(df, con, ORACLES[name]) == ""


@pytest.mark.parametrize("name", HOT)
def test_query_equals_sql_with_hot_keys(spark, con, name, hot_keys):
    assert differences(entry.queries()[name](spark, SF_DIR), con, ORACLES[name]) == ""


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["session_id", "last_track", "next_track", "strategy", "weight", "user_id"]


def test_topn_limits_before_the_shuffle(spark):
    plan = plan_of(entry.queries()["cooccurrence_topn"](spark, SF_DIR))
    assert plan.index("Final") < plan.index("Partial", plan.index("WindowGroupLimit"))
    assert "TakeOrderedAndProject" in plan_of(entry.queries()["popularity_topn"](spark, SF_DIR))
    assert "WindowGroupLimit" in plan_of(entry.queries()["catalog_sample"](spark, SF_DIR))


def test_scan_reads_only_the_needed_columns(spark):
    plan = plan_of(entry.queries()["cooccurrence_counts"](spark, SF_DIR))
    assert "l_extendedprice" not in plan
    assert "PushedFilters" in plan


def test_hot_users_are_cut_and_cold_sessions_left_alone(spark, hot_keys):
    """The few users of the small tables are hot, none of their many sessions is."""
    assert "_part" in plan_of(entry.queries()["recent_tracks"](spark, SF_DIR))
    assert "_slice" in plan_of(entry.queries()["event_enrichment"](spark, SF_DIR))
    assert "_slice" not in plan_of(entry.queries()["cooccurrence_counts"](spark, SF_DIR))


@pytest.mark.parametrize("name", ["plays_filter", "event_time_parse", "event_json_parse"])
def test_a_message_is_decoded_once(spark, name):
    plan = entry.queries()[name](spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1
