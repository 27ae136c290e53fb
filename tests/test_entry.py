"""The entry module works with and without the text operators."""

import importlib

import pytest

import __spark_entry__ as entry_mod


@pytest.mark.parametrize("missing", ["plotcover.llm", "plotcover.llm.queries", "corpus_pipeline"])
def test_queries_without_the_text_operators(monkeypatch, missing):
    def gone(name):
        raise ModuleNotFoundError(f"No module named {missing!r}", name=missing)

    monkeypatch.setattr(importlib, "import_module", gone)
    assert set(entry_mod.queries()) == set(entry_mod._survey_queries())
    assert set(entry_mod.oracle_sql()) == set(entry_mod._survey_oracles())


def test_other_import_errors_are_not_hidden(monkeypatch):
    def broken(name):
        raise ModuleNotFoundError("No module named 'elsewhere'", name="elsewhere")

    monkeypatch.setattr(importlib, "import_module", broken)
    with pytest.raises(ModuleNotFoundError):
        entry_mod.queries()
