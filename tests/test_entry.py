"""The entry works without its optional part, and hides no other import error."""

import importlib
import importlib.util
import sys

import pytest

from sessionrate.plans.queries import QUERIES


class Block:
    """Import finder that lets no module of the given names be found."""

    def __init__(self, error, *names):
        self.error, self.names = error, names

    def find_spec(self, name, path=None, target=None):
        if name.startswith(self.names):
            raise self.error(f"blocked {name}", name=name)
        return None


def _reload(monkeypatch, block):
    for name in list(sys.modules):
        if name.startswith(("__spark_entry__", "corpus_pipeline", "sessionrate.llm", "xxhash")):
            monkeypatch.delitem(sys.modules, name)
    monkeypatch.setattr(sys, "meta_path", [block, *sys.meta_path])
    return importlib.import_module("__spark_entry__")


def test_without_the_corpus_part(monkeypatch):
    entry = _reload(monkeypatch, Block(ModuleNotFoundError, "corpus_pipeline", "sessionrate.llm"))
    assert set(entry.queries()) == set(QUERIES) == set(entry.oracle_sql())


def _skip_without_the_corpus_part():
    if importlib.util.find_spec("corpus_pipeline") is None or importlib.util.find_spec("sessionrate.llm") is None:
        pytest.skip("the corpus part is not here")


def test_a_library_only_the_corpus_part_needs(monkeypatch):
    _skip_without_the_corpus_part()
    with pytest.warns(ImportWarning, match="blocked xxhash"):
        entry = _reload(monkeypatch, Block(ModuleNotFoundError, "xxhash"))
    assert set(entry.queries()) == set(QUERIES) == set(entry.oracle_sql())


def test_other_import_errors_are_not_hidden(monkeypatch):
    _skip_without_the_corpus_part()
    for name in list(sys.modules):
        if name.startswith("sessionrate.session"):
            monkeypatch.delitem(sys.modules, name)
    with pytest.raises(ImportError, match="blocked sessionrate.session"):
        _reload(monkeypatch, Block(ModuleNotFoundError, "sessionrate.session"))
