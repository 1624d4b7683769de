import pytest

from tastegraph.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, shuffle_partitions=4, memory="8g", app="tests")
    yield session
    session.stop()


@pytest.fixture
def ratings(spark):
    """A factory of rating tables from (user, product[, score[, ts]]) tuples."""
    def make(rows):
        full = [(u, p, float(rest[0]) if rest else 3.0, rest[1] if len(rest) > 1 else 0) for u, p, *rest in rows]
        return spark.createDataFrame(full, "user_id int, product_id int, score double, ts long")
    return make


def rows(df, *columns):
    """Sorted tuples of a small result."""
    return sorted(tuple(r) for r in (df.select(*columns) if columns else df).collect())
