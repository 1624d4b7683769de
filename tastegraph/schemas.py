"""Table layouts shared by the sources, the operators and the stream."""

from pyspark.sql import types as T

PRODUCT = T.StructType([
    T.StructField("product_id", T.IntegerType()),
    T.StructField("name", T.StringType()),
    T.StructField("categories", T.StringType()),
    T.StructField("image_url", T.StringType()),
    T.StructField("tags", T.StringType()),
])

RATING = T.StructType([
    T.StructField("user_id", T.IntegerType()),
    T.StructField("product_id", T.IntegerType()),
    T.StructField("score", T.DoubleType()),
    T.StructField("ts", T.LongType()),  # epoch seconds
])

# One message of the live rating feed: `value` holds uid|pid|score|ts, `seq`
# the position in the feed (a broker offset, an event id), which orders
# messages of the same second.
MESSAGE = T.StructType([
    T.StructField("seq", T.LongType()),
    T.StructField("value", T.StringType()),
])

# Similar products, flat: the form the operators return and the stream joins.
SIMILAR = T.StructType([
    T.StructField("product_id", T.IntegerType()),
    T.StructField("rid", T.IntegerType()),
    T.StructField("r", T.DoubleType()),
])

RECOMMENDATION = T.StructType([
    T.StructField("rid", T.IntegerType()),
    T.StructField("r", T.DoubleType()),
])

STREAM_RECOMMENDATION = T.StructType([
    T.StructField("product_id", T.IntegerType()),
    T.StructField("score", T.DoubleType()),
])

USER_RECS = T.StructType([
    T.StructField("user_id", T.IntegerType()),
    T.StructField("recs", T.ArrayType(RECOMMENDATION)),
])

PRODUCT_RECS = T.StructType([
    T.StructField("product_id", T.IntegerType()),
    T.StructField("recs", T.ArrayType(RECOMMENDATION)),
])

STREAM_RECS = T.StructType([
    T.StructField("user_id", T.IntegerType()),
    T.StructField("recs", T.ArrayType(STREAM_RECOMMENDATION)),
])
