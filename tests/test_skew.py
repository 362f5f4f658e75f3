"""Every query on copies of the tables in which one key holds a third of all rows."""

import os
from pathlib import Path

import pytest

import compare
from workload.oracle import ORACLE
from workload.queries import REGISTRY

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables not found")

HOT_LINE = "hash(l_partkey, l_suppkey, l_extendedprice) % 3 = 0"
SKEWED = {
    "lineitem": f"""* replace (case when {HOT_LINE} then 0 else l_orderkey end as l_orderkey,
        case when {HOT_LINE} then 1 else l_linenumber end as l_linenumber)""",
    "orders": """* replace (case when o_orderkey % 3 = 0 then 7 else o_custkey end as o_custkey,
        case when o_orderkey % 3 = 1 then timestamp '1997-05-05' else o_orderdate end as o_orderdate)""",
    "customer": "* replace (case when c_custkey % 3 = 0 then 4 else c_nationkey end as c_nationkey)",
    "part": "* replace (case when p_partkey % 3 = 0 then 'SMALL' else p_type end as p_type)",
}


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    out = tmp_path_factory.mktemp("skewed")
    with compare.connect(SF_DIR) as con:
        for path in Path(SF_DIR).glob("*.parquet"):
            columns = SKEWED.get(path.stem, "*")
            con.execute(f"copy (select {columns} from {path.stem}) to '{out / path.name}'")
    with compare.connect(str(out)) as con:
        yield str(out), con


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_on_skewed_tables(spark, skewed, name):
    folder, con = skewed
    df = REGISTRY[name](spark, folder)
    assert compare.differences(df, con, ORACLE[name]) == []
