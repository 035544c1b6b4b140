"""Every registered query against its SQL twin in DuckDB (sf0.001), plus the entry point."""
import pytest

import __spark_entry__ as entry_mod
from conftest import SF_MID, SF_SMALL

#: Fits whose flag needs more than the 3 negative test rows of the smallest tables.
ON_MORE_ROWS = {"text_forest_fit"}


def test_every_query_has_oracle_or_is_model_fit():
    qs, sqls = entry_mod.queries(), entry_mod.oracle_sql()
    assert set(sqls) <= set(qs)
    missing = {n for n in qs if n != "pipeline" and not n.startswith("op")} - set(sqls)
    assert not missing


@pytest.mark.parametrize("name", sorted(entry_mod.oracle_sql()))
def test_query_matches_oracle(spark, name):
    from tools.oracle_check import compare
    res = compare(spark, SF_MID if name in ON_MORE_ROWS else SF_SMALL, [name])[name]
    assert res.startswith("OK"), res


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.count() >= 0 and len(df.columns) > 0
