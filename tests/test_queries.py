"""Every registered query against its SQL on the smallest tables."""

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry_point
from shelfcast.oracles import ORACLES
from shelfcast.queries import QUERIES

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    yield connection
    connection.close()


def digest(frame):
    frame = frame[sorted(frame.columns)]
    hashed = pd.util.hash_pandas_object(frame, index=False)
    return len(frame), int(hashed.sum()), [(c, str(t)) for c, t in frame.dtypes.items()]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, database, name):
    mine = QUERIES[name](spark, FOLDER).toPandas()
    theirs = database.execute(ORACLES[name]).df()
    assert len(mine) > 0
    assert digest(mine) == digest(theirs)


def test_only_forests_have_no_sql():
    assert set(QUERIES) - set(ORACLES) == {"forest_forecast", "forest_scores"}
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) <= set(entry_point.queries()) and set(ORACLES) <= set(entry_point.oracle_sql())


def test_entry_is_the_feature_table(spark):
    assert entry_point.entry(spark).count() == 617_750
