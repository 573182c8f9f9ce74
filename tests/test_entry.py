import sys

import __spark_entry__ as entry
from shutterlake.plans.catalog import QUERIES
from shutterlake.plans.oracle import ORACLE


def test_a_missing_library_of_the_corpus_part_leaves_the_other_queries(monkeypatch):
    for name in [m for m in sys.modules if m.startswith("shutterlake.llm") or m == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, name)
    package = sys.modules["shutterlake"]
    monkeypatch.delattr(package, "llm", raising=False)
    monkeypatch.setitem(sys.modules, "public_tokenizers", None)
    assert entry.queries() == QUERIES
    assert entry.oracle_sql() == ORACLE


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
