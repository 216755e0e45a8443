import importlib
import pathlib

import pytest

import __spark_entry__ as entry

MODULES = [importlib.import_module(f"folioscope.plans.{name}") for name in entry.PLANS]
SQL = {name: (m.QUERIES[name], sql) for m in MODULES for name, sql in m.SQL.items()}


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(twin, name):
    twin(*SQL[name])


def test_names():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    every = [name for m in MODULES for name in m.QUERIES]
    assert len(every) == len(set(every))


def test_nothing_imports_the_llm_subpackage():
    root = pathlib.Path(entry.__file__).parent / "folioscope"
    for f in root.rglob("*.py"):
        if "llm" not in f.relative_to(root).parts:
            assert "folioscope.llm" not in f.read_text()
