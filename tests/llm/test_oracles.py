"""The oracles are SQL of registered queries."""
from sensorloom.llm import queries as q


def test_oracles_are_sql():
    assert set(q.oracle_sql()) <= set(q.queries())
    assert [n for n, sql in q.oracle_sql().items() if not isinstance(sql, str)] == []
