"""Every registered query against its SQL, on the smallest tables."""

import functools

import pytest
from oracle_check import compare, database

from paywatch.contract import queries
from paywatch.contract.oracle import all_oracles
from paywatch.contract.queries import all_queries
from paywatch.plans import training

FOLDER = "/root/testdata/sf0.001"
ORACLES = all_oracles()


@pytest.fixture(scope="module")
def con():
    return database(FOLDER)


def test_sql_names_belong_to_queries():
    assert set(ORACLES) <= set(all_queries())
    assert {name for name in all_queries() if name not in ORACLES} == {
        "m3_m7_logistic_scores",
        "m5_s8_trees_scores",
        "m8_s4_importances",
        "e8_s9_model_report",
    }


@pytest.fixture(scope="module", autouse=True)
def few_rounds():
    """Models of five rounds here, for time; test_training holds the queries to all rounds."""
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(queries, "_FITTED", {})
        patch.setattr(training, "train_and_compare", functools.partial(training.train_and_compare, rounds=5))
        yield


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, con, name):
    assert compare(spark, con, all_queries()[name], ORACLES[name], FOLDER) is None
