"""Every registered query against its SQL twin, at the smallest scale."""

import ast
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tools")]

import __spark_entry__ as entry  # noqa: E402
from check_twins import compare, connect  # noqa: E402
from rowtide.plans.registry import REGISTRY  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(REGISTRY.runs))  # the optional subpackage has tests of its own
def test_twin(spark, con, name):
    assert compare(spark, con, SF, name) == ""


def test_every_twin_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_a_wrong_twin_is_seen(spark, con, monkeypatch):
    wrong = {"select_columns": "SELECT o_orderkey, 'x' AS o_orderstatus FROM orders"}
    monkeypatch.setattr(entry, "oracle_sql", lambda: wrong)
    assert "rows" in compare(spark, con, SF, "select_columns")
    wrong["select_columns"] = "SELECT CAST(o_orderkey AS INTEGER) AS o_orderkey, o_orderstatus FROM orders"
    assert "types" in compare(spark, con, SF, "select_columns")


def test_no_name_is_defined_twice():
    """A later function of the same name would take the place of the one that a query calls."""
    for path in (ROOT / "rowtide").rglob("*.py"):
        names = [n.name for n in ast.parse(path.read_text()).body if isinstance(n, ast.FunctionDef | ast.ClassDef)]
        assert len(names) == len(set(names)), path
