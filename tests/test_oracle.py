"""Every registered query with comparison SQL gives the same rows as that SQL."""

import oracle
import pytest

import __spark_entry__ as entry

QUERIES = entry.queries()
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf):
    return oracle.duck(sf)


@pytest.mark.parametrize("key", sorted(SQL))
def test_same_as_sql(spark, con, sf, key):
    assert oracle.compare(spark, con, sf, key, QUERIES[key], SQL[key]) == ""


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() == 200


def test_spine_counts(spark, sf):
    """Counts worked out by hand when the fixture views were designed."""
    features = QUERIES["c18_feature_table"](spark, sf)
    by_label = {r["y_acute_90"]: r["count"] for r in features.groupBy("y_acute_90").count().collect()}
    assert by_label == {0: 1170, 1: 225}


@pytest.fixture(scope="module")
def skewed(tmp_path_factory, con, sf):
    """The same tables, with a third of the orders on one customer, a third of the lines on
    one part and supplier, and a third of the events at one score and instant."""
    folder = tmp_path_factory.mktemp("skewed")
    changed = {
        "orders": "select * replace (case when o_orderkey % 3 = 0 then 1 else o_custkey end as o_custkey,"
        " case when o_orderkey % 3 = 1 then timestamp '1998-02-28' else o_orderdate end as o_orderdate) from orders",
        "lineitem": "select * replace (case when l_orderkey % 3 = 0 then 7 else l_partkey end as l_partkey,"
        " case when l_orderkey % 3 = 0 then 3 else l_suppkey end as l_suppkey,"
        " case when l_orderkey % 3 = 1 then 5 else l_quantity end as l_quantity) from lineitem",
    }
    for name in oracle.TABLES:
        query = changed.get(name, f"select * from {name}")
        con.execute(f"copy ({query}) to '{folder}/{name}.parquet' (format parquet)")
    return str(folder)


@pytest.mark.parametrize(
    "key",
    ["c18_feature_table", "c20_top_200", "e05_quantiles", "e08_mutual_information", "f06_target_mean",
     "f08_stratified_split", "v05_pr_curve", "v06_threshold", "s01_select"],
)
def test_same_as_sql_when_one_key_dominates(spark, skewed, key):
    with oracle.duck(skewed) as con:
        assert oracle.compare(spark, con, skewed, key, QUERIES[key], SQL[key]) == ""
