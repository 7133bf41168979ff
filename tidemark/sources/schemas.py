"""Record schemas of the feeds."""

from pyspark.sql import types as T

RATE = T.StructType([
    T.StructField("ts_ms", T.LongType()),
    T.StructField("currency", T.StringType()),
    T.StructField("rate", T.IntegerType()),
])

ORDER = T.StructType([
    T.StructField("ts_ms", T.LongType()),
    T.StructField("category", T.StringType()),
    T.StructField("subcat", T.IntegerType()),
    T.StructField("currency", T.StringType()),
    T.StructField("amount", T.IntegerType()),
])

# "timestamp" is in epoch seconds.
BEHAVIOR = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("item_id", T.LongType()),
    T.StructField("category_id", T.IntegerType()),
    T.StructField("behavior", T.StringType()),
    T.StructField("timestamp", T.LongType()),
])

# "create_time" is in epoch milliseconds; "update_time" is never filled by the producer.
EVENT = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("rank", T.IntegerType()),
    T.StructField("group", T.StringType()),
    T.StructField("create_time", T.LongType()),
    T.StructField("update_time", T.LongType()),
])

# Domains of the feeds.
CURRENCIES = ["BEF", "CNY", "DEM", "EUR", "HKD", "USD", "ITL"]
CATEGORIES = ["A", "B", "C", "D", "E"]
