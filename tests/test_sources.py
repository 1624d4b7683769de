import os

from pyspark.sql import Observation, functions as F

from tests.conftest import rows
from tastegraph.schemas import RATING
from tastegraph.functions import delimited
from tastegraph.sources import (format_messages, load_products, load_ratings, load_table, parse_rating_messages,
                                save_table)
from tastegraph.sources.messages import feed_place


def _write(path, lines):
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


def test_products_keep_five_fields_and_reject_bad_lines(spark, tmp_path):
    path = _write(tmp_path / "products.txt", [
        "7^ Kettle ^1,2^B01^http://x/k.jpg^Kitchen|Home^steel|fast",
        "8^Lamp^3^B02^http://x/l.jpg^Home^",          # no tags
        "x9^Bad id^3^B03^u^c^t",
        "10^Too few^3^B04",
    ])
    good, rejected = load_products(spark, path)
    assert rows(good) == [(7, "Kettle", "Kitchen|Home", "http://x/k.jpg", "steel|fast"),
                          (8, "Lamp", "Home", "http://x/l.jpg", "")]
    assert rows(rejected) == [("10^Too few^3^B04",), ("x9^Bad id^3^B03^u^c^t",)]


def test_ratings_reject_bad_lines(spark, tmp_path):
    path = _write(tmp_path / "ratings.txt", ["1,2,3.5,1500000000", "1,x,3.5,1500000000", "4,5", "6,7,5,10", "8,9,NaN,11"])
    good, rejected = load_ratings(spark, path)
    assert good.schema.simpleString() == RATING.simpleString()
    assert rows(good) == [(1, 2, 3.5, 1500000000), (6, 7, 5.0, 10)]
    assert rows(rejected) == [("1,x,3.5,1500000000",), ("4,5",), ("8,9,NaN,11",)]


def test_lines_are_counted_in_the_pass_that_loads_them(spark, tmp_path):
    path = _write(tmp_path / "ratings.txt", ["1,2,3.5,1500000000", "1,x,3.5,1500000000", "4,5", "6,7,5,10"])
    counts = Observation("lines")
    good, _ = load_ratings(spark, path, counts)
    assert len(good.select("user_id").collect()) == 2 and counts.get == {"read": 2, "unread": 2}


def test_messages_round_trip_and_skip_malformed(spark):
    feed = spark.createDataFrame([(1, "4867|457976|5.0|1395676800"), (2, "1|2|oops|3"), (3, " 9 |8|1|7"), (4, ""),
                                  (5, "1|2|NaN|3"), (6, None)],
                                 "seq long, value string")
    parsed, rejected = parse_rating_messages(feed)
    assert rows(parsed, "seq", "user_id", "product_id", "score", "ts") == [
        (1, 4867, 457976, 5.0, 1395676800), (3, 9, 8, 1.0, 7)]
    assert rows(rejected, "seq") == [(2,), (4,), (5,), (6,)] and rejected.columns == feed.columns
    again, none = parse_rating_messages(format_messages(parsed.withColumnRenamed("seq", "event_id")))
    assert rows(again) == rows(parsed) and none.isEmpty()


def test_places_in_the_feed_are_distinct_and_in_order_of_each_partition(spark):
    messages = [(p, o) for p in (0, 1, 65535) for o in (0, 1, 7, 1 << 40)]
    placed = (spark.createDataFrame(messages, "partition int, offset long")
              .withColumn("seq", feed_place(F.col("partition"), F.col("offset"))).sort("seq").collect())
    assert len({r.seq for r in placed}) == len(messages)
    assert [(r.partition, r.offset) for r in placed] == sorted(messages, key=lambda m: (m[1], m[0]))


def test_a_null_field_moves_no_other(spark):
    lines = spark.createDataFrame([(1, None, 3)], "a int, b string, c int").select(delimited("^", "a", "b", "c").alias("v"))
    assert rows(lines) == [("1^^3",)]


def test_saved_table_is_replaced_as_a_whole(spark, ratings, tmp_path):
    path = str(tmp_path / "table")
    save_table(ratings([(1, 1), (2, 2)]), path)
    save_table(ratings([(3, 3, 4, 9)]), path)
    assert rows(load_table(spark, path, RATING)) == [(3, 3, 4.0, 9)]
    assert os.path.isdir(path)
