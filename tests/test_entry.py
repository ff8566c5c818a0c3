"""The driver contract, with and without the optional modules."""

import sys

import pytest

import __spark_entry__ as driver
from verification.oracles import ORACLES
from verification.registry import QUERIES


def test_names_with_everything_present():
    assert set(QUERIES) <= set(driver.queries())
    assert set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("missing", [("gaugeline.llm",), ("gaugeline.llm.queries", "corpus_pipeline")])
def test_optional_modules_may_be_missing(monkeypatch, missing):
    for name in [n for n in sys.modules if n.startswith("gaugeline.llm") or n == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, name)
    for name in ("gaugeline.llm", "gaugeline.llm.queries", "corpus_pipeline"):
        if name in missing or name.startswith(missing[0]):
            monkeypatch.setitem(sys.modules, name, None)
    assert driver.queries() == QUERIES
    assert driver.oracle_sql() == ORACLES
