"""Registered queries against their DuckDB oracle on the smallest tables."""

import importlib.util

import pytest

from conftest import SF_TINY

import __spark_entry__ as E


def own_queries() -> list[str]:
    """Queries of the warehouse; those of the optional corpus operators have tests of their own."""
    names = set(E.queries())
    if importlib.util.find_spec("tierwell.llm") and E._LLM:
        from tierwell.llm.queries import queries
        names -= {*queries(), "pipeline"}
    return sorted(names)


QUERIES = own_queries()


@pytest.fixture(scope="module")
def results(spark, wh):
    from compare import compare
    with pytest.MonkeyPatch.context() as patch:
        # every query reads one build of the warehouse instead of making its own
        patch.setattr(E, "Warehouse", lambda s, d: wh)
        yield compare(spark, SF_TINY, QUERIES, verbose=True)


@pytest.mark.parametrize("name", QUERIES)
def test_matches_oracle(results, name):
    assert results[name][0] == "OK", results[name]


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(E.oracle_sql())
