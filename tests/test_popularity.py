from datetime import datetime, timezone

from tests.conftest import rows
from tastegraph.operators.popularity import average_products, rate_more_products, rate_more_recently_products


def test_counts_and_order_of_means(ratings):
    table = ratings([(1, 10, 5), (2, 10, 4), (1, 20, 5), (2, 30, 4.5)])
    assert rows(rate_more_products(table)) == [(10, 2), (20, 1), (30, 1)]
    assert [tuple(r) for r in average_products(table).collect()] == [(20, 5.0), (10, 4.5), (30, 4.5)]


def test_months_are_utc_whatever_the_session_zone(spark, ratings):
    end = int(datetime(2024, 2, 29, 23, 59, 59, tzinfo=timezone.utc).timestamp())
    table = ratings([(1, 10, 5, end), (1, 10, 5, end + 1), (2, 10, 5, end + 1), (1, 10, 1, -1)])
    expected = [(10, 1, 196912), (10, 1, 202402), (10, 2, 202403)]
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for other in ("UTC", "Asia/Shanghai", "America/Los_Angeles"):
            spark.conf.set("spark.sql.session.timeZone", other)
            assert rows(rate_more_recently_products(table)) == expected
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
