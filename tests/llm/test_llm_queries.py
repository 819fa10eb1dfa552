"""Properties of the registered queries; those with SQL are compared in tests/test_queries.py."""

from roadstream.llm.queries import ORACLE, QUERIES


def test_every_sql_has_a_query():
    assert set(ORACLE) <= set(QUERIES)
