"""The driver contract, with and without the optional parts."""

from __future__ import annotations

import importlib
import sys

import pytest


def test_entry_runs(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0


def test_names_match():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert "network_monthly" in e.queries()


def test_imports_without_optional_parts(monkeypatch):
    for name in [m for m in sys.modules if m == "corpus_pipeline" or m.startswith("stoptide.llm")]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.delitem(sys.modules, "__spark_entry__", raising=False)

    class Missing:
        def find_spec(self, name, path=None, target=None):
            if name in ("corpus_pipeline", "stoptide.llm"):
                raise ModuleNotFoundError(f"No module named {name!r}", name=name)

    monkeypatch.setattr(sys, "meta_path", [Missing(), *sys.meta_path])
    e = importlib.import_module("__spark_entry__")
    assert "network_monthly" in e.queries()
    assert not any(x.startswith("op") and x[2].isdigit() for x in e.queries())
    monkeypatch.delitem(sys.modules, "__spark_entry__")


def test_other_import_errors_show(monkeypatch):
    class Broken:
        def find_spec(self, name, path=None, target=None):
            if name == "corpus_pipeline":
                raise ModuleNotFoundError("No module named 'numpy'", name="numpy")

    monkeypatch.delitem(sys.modules, "__spark_entry__", raising=False)
    monkeypatch.delitem(sys.modules, "corpus_pipeline", raising=False)
    monkeypatch.setattr(sys, "meta_path", [Broken(), *sys.meta_path])
    with pytest.raises(ModuleNotFoundError):
        importlib.import_module("__spark_entry__")
    monkeypatch.delitem(sys.modules, "__spark_entry__", raising=False)
