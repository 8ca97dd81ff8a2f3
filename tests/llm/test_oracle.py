"""Every query of the subpackage that has a DuckDB twin equals it on the smallest test tables."""

import pytest

from railyard.llm import queries
from scripts.compare_oracle import canonical, duck
from tests.conftest import SF_SMALL


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_duckdb(spark, name):
    df = queries.QUERIES[name](spark, SF_SMALL)
    got = canonical(df.columns, df.collect())
    cur = duck(SF_SMALL).execute(queries.ORACLES[name])
    assert got == canonical([c[0] for c in cur.description], cur.fetchall())
