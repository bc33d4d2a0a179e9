"""The operators' queries against their SQL."""

import duckdb
import pytest

from kandela.llm.oracles import ORACLES
from kandela.llm.queries import QUERIES
from llm_cases import SF_SMALL, few_partitions  # noqa: F401


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_equals_its_sql(spark, key):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    res = con.execute(ORACLES[key])
    names = [d[0] for d in res.description]
    got = QUERIES[key](spark, SF_SMALL)
    assert sorted(names) == sorted(got.columns)
    assert sorted(map(repr, res.fetchall())) == sorted(repr(tuple(r)) for r in got.select(*names).collect())
