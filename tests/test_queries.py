"""Every registered query on the smallest tables, against its SQL in DuckDB."""

import os

import duckdb
import numpy as np
import pytest

import __spark_entry__ as contract

SF_DIR = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{SF_DIR}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_equals_sql(spark, duck, name):
    found = contract.queries()[name](spark, SF_DIR).toPandas()
    expected = duck.execute(contract.oracle_sql()[name]).df()
    columns = sorted(found.columns)
    assert columns == sorted(expected.columns) and len(found)
    found, expected = (df[columns].sort_values(columns).reset_index(drop=True) for df in (found, expected))
    assert len(found) == len(expected)
    for column in columns:
        assert (found[column].values == expected[column].values).all(), column


def test_oracles_belong_to_queries():
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name,width", [("als_user_recs", 20), ("content_sims_hashed", 5), ("item_cf_sims", 5)])
def test_ranks_without_gaps_and_no_self(spark, name, width):
    found = contract.queries()[name](spark, SF_DIR).toPandas()
    owner = found.columns[0]
    for _, group in found.groupby(owner):
        assert sorted(group["rank"]) == list(range(1, len(group) + 1)) and len(group) <= width
        assert group.sort_values("rank")["r"].is_monotonic_decreasing
    if owner == "product_id":
        assert (found["product_id"] != found["rid"]).all()


def test_product_sims_have_every_partner(spark, monkeypatch):
    from tastegraph.operators import latent
    real, models = latent.train_als, []
    monkeypatch.setattr(latent, "train_als", lambda rows: models.append(real(rows, rank=4, iterations=2)) or models[0])
    found = contract.queries()["als_product_sims"](spark, SF_DIR).toPandas()
    items = models[0].itemFactors.toPandas().sort_values("id")
    vectors = np.array(items["features"].tolist(), dtype="float64")
    cosine = vectors @ vectors.T / np.outer(*[np.linalg.norm(vectors, axis=1)] * 2)
    ids = items["id"].to_numpy()
    expected = {(a, b) for a, b in zip(*(ids[side] for side in np.nonzero(cosine > 1e-9))) if a != b}
    pairs = set(zip(found["product_id"], found["rid"]))
    assert len(pairs) == len(found) and expected <= pairs
    assert found["product_id"].value_counts().max() > 20 and (found["r"] > 0).all() and (found["product_id"] != found["rid"]).all()
    assert all(abs(r - cosine[np.searchsorted(ids, a), np.searchsorted(ids, b)]) < 1e-9 for a, b, r in found.itertuples(index=False))


def test_entry(spark):
    assert contract.entry(spark).count() > 0
