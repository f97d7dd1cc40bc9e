"""Fixed schemas of the incident model (nothing is inferred)."""

from pyspark.sql import types as T

# keyed text record: key = incident id, value = the whole CSV line
RECORD = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
])

LINE = T.StructType([T.StructField("value", T.StringType())])

INCIDENT = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("date", T.TimestampType()),
    T.StructField("iucr_code", T.StringType()),
    T.StructField("arrest", T.BooleanType()),
    T.StructField("domestic", T.BooleanType()),
    T.StructField("district", T.IntegerType()),
])

CODE = T.StructType([
    T.StructField("code", T.StringType()),
    T.StructField("primary_description", T.StringType()),
    T.StructField("secondary_description", T.StringType()),
    T.StructField("monitored_by_fbi", T.BooleanType()),
])

# serving table, key (district, month, primary_description)
SERVING = T.StructType([
    T.StructField("district", T.IntegerType()),
    T.StructField("month", T.IntegerType()),
    T.StructField("primary_description", T.StringType()),
    T.StructField("count", T.LongType()),
    T.StructField("count_arrest", T.LongType()),
    T.StructField("count_domestic", T.LongType()),
    T.StructField("count_monitored_by_fbi", T.LongType()),
])

SERVING_KEY = ["district", "month", "primary_description"]
COUNTERS = ["count", "count_arrest", "count_domestic", "count_monitored_by_fbi"]

ALERT = T.StructType([
    T.StructField("start", T.TimestampType()),
    T.StructField("end", T.TimestampType()),
    T.StructField("district", T.IntegerType()),
    T.StructField("count", T.LongType()),
    T.StructField("count_monitored_by_fbi", T.LongType()),
    T.StructField("percentage_monitored_by_fbi", T.DoubleType()),
])
