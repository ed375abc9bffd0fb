"""Every query against its SQL twin, at the smallest scale."""

import os

import pytest

import __spark_entry__ as entry
import oracle

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return oracle.database(SF)


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(spark, con, name):
    assert oracle.differences(spark, con, name, SF) == []


def test_flagship(spark):
    row = entry.entry(spark).first()
    assert row["MS1_ClusterID"] > 0 and row["protein_groups"] == 116 and row["peptides_with_mods"] == 143


def test_fixture_counts(spark):
    """Counts that are known for these tables."""
    q = entry.queries()
    assert q["confidence_filter"](spark, SF).count() == 514
    assert q["edge_counts"](spark, SF).first().asDict() == {
        "MS1_ClusterID": 1473, "MS2_ClusterID": 200, "edges": 5942,
    }
    assert q["refined_edges"](spark, SF).count() == 5474
    assert q["capped_ranks"](spark, SF).count() == 2400
    assert q["range_match"](spark, SF).count() == 129
