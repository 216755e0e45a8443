import pytest

from folioscope.llm import registry

SQL = {name: (m.QUERIES[name], sql) for m in registry.modules() for name, sql in m.SQL.items()}


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(twin, name):
    twin(*SQL[name])
