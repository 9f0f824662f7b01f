"""The driver contract."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from postpulse import session
from postpulse.checks.queries import ORACLES, QUERIES

CHECKED = ("generate_signals", "pick_partition_cols", "tfidf_row_stats", "rate_audit_busy_clients", "repair_encoding")


def test_entry_runs(spark):
    assert contract.entry(spark).count() > 0


def test_every_query_has_sql():
    assert set(contract.oracle_sql()) - set(contract.TEXT_ORACLES) == set(QUERIES) == set(ORACLES)
    assert set(contract.TEXT_ORACLES) <= set(contract.TEXT_QUERIES)
    assert len(QUERIES) > 90


@pytest.mark.parametrize("name", CHECKED)
def test_queries_match_sql(spark, data, name):
    from postpulse.checks.compare import connect, difference

    result = difference(spark, connect(data), data, name)
    assert not result or result.startswith("(types")


def test_shared_dir_follows_the_session(spark):
    assert session.shared_dir(spark) == spark.sparkContext.getCheckpointDir()
    assert session.scratch_path(spark, "x") != session.scratch_path(spark, "x")


def test_no_temporary_folder_on_a_cluster():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError):
        session.shared_dir(Session())
