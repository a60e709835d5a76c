"""Registered queries against their SQL at the smallest scale.

By default one or two queries per operator family run; ALL_QUERIES=1 runs all of them (about
a quarter of an hour). ``compare.py`` does the same for all queries at sf0.01.
"""

import os

import pytest
from compare import duck, same

import __spark_entry__ as contract

SF = "/root/testdata/sf0.001"
ORACLES = contract.oracle_sql()
FEW = [
    "a3_corpus_load_v2", "a6_expand_zip", "b1_normalize_ws", "b7_encode", "c1_list_entries",
    "d2_validate", "d8_anomaly_tail", "e3_near_duplicates", "f8_markov_train", "g14_nucleus_filter",
    "g8_answer_question", "h3_restore_entries", "i2_stream_activity", "l4_beacon_detection",
]
ALL = bool(os.environ.get("ALL_QUERIES"))
CHECKED = sorted(ORACLES) if ALL else FEW
UNCHECKED = sorted(set(contract.queries()) - set(ORACLES)) if ALL else ["d7_anomaly_iforest"]


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_sql(spark, name):
    ok, note = same(contract.queries()[name](spark, SF), duck(SF), ORACLES[name])
    assert ok, note


@pytest.mark.parametrize("name", UNCHECKED)
def test_query_without_sql_runs(spark, name):
    df = contract.queries()[name](spark, SF)
    assert df.columns
    assert df.count() > 0


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(contract.queries())
