"""The registered queries: names, SQL, and the streams against the same rows in batch."""

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def test_every_query_has_a_callable_and_sql_names_a_query():
    queries, sql = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    assert all(callable(q) for q in queries.values()) and set(sql) <= set(queries)


def test_entry(spark):
    assert __spark_entry__.entry(spark).limit(5).count() == 5


@pytest.mark.parametrize("name", ["w3_prior_n", "j3_asof_join", "j3_asof_career", "a1_ntile_pivot", "a11_career_horse", "i2_impute_median", "m16_rank_metrics", "b4_tickets", "k6_xml_cards", "s5_stream_kinematics"])
def test_rows_match_the_sql(spark, duck, name):
    got = __spark_entry__.queries()[name](spark, SF)
    want = duck.execute(__spark_entry__.oracle_sql()[name])
    columns = [c[0] for c in want.description]
    plain = lambda row: tuple(f"{v:.6g}" if isinstance(v, float) else str(v) for v in row)
    assert sorted(map(plain, got.select(*columns).collect())) == sorted(map(plain, want.fetchall()))
