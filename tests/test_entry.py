"""Driver contract of __spark_entry__: keys, rows-only set, oracle SQL that plans."""

import re

import duckdb

import __spark_entry__ as E

ROWS_ONLY: set[str] = set()
SF = "/root/testdata/sf0.001"


def test_every_oracle_has_a_query_and_rows_only_set_is_intended():
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    optional = {n for n in qs if re.match(r"op\d+_", n)} | {"pipeline"}  # of a subpackage with tests of its own
    assert set(qs) - set(sql) - optional == ROWS_ONLY
    assert all(callable(f) for f in qs.values())


def test_every_oracle_sql_plans_in_duckdb():
    con = duckdb.connect()
    for t in ("orders lineitem events customer documents embeddings labels pages").split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    for name, sql in E.oracle_sql().items():
        con.execute("EXPLAIN " + sql)
