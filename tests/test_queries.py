"""Registered queries against their checking SQL at the smallest scale.

``ALL_QUERIES=1`` runs every one of them; by default the quick ones run.
"""

import os

import pandas as pd
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check_queries import compare, oracle
from paperweave.driver_oracles import ORACLES
from paperweave.driver_queries import QUERIES

SF = "/root/testdata/sf0.001"
QUICK = (
    "xml_records schema_discovery csv_read_clean typed_header tsv_edges citation_counts coerce_year "
    "keywords_topk venue_last_mention assign_reviewers relation_normalize nodes_all edges_all "
    "review_evolve sssp_path pagerank_sweep graph_max_reach abox_triples author_titles_by_keyword"
).split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables absent")


@pytest.fixture(scope="module")
def con():
    return oracle(SF)


def test_every_query_has_checking_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries()) and set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() == 10


@pytest.mark.parametrize("key", list(QUERIES) if os.environ.get("ALL_QUERIES") else QUICK)
def test_query(spark, con, key):
    result = queries()[key](spark, SF)
    actual = pd.DataFrame([tuple(r) for r in result.collect()], columns=result.columns, dtype=object)
    found = con.execute(oracle_sql()[key])
    expected = pd.DataFrame(found.fetchall(), columns=[d[0] for d in found.description], dtype=object)
    assert compare(actual, expected) is None
