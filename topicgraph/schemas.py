"""Fixed schemas at the library boundaries."""

from pyspark.sql import types as T

PAYMENT = T.StructType([
    T.StructField("actor_id", T.StringType()),
    T.StructField("actor_name", T.StringType()),
    T.StructField("target_id", T.StringType()),
    T.StructField("target_name", T.StringType()),
    T.StructField("message", T.StringType()),
    T.StructField("time_sended", T.TimestampNTZType()),
])

# undirected, simple, weighted topic graph
NODE = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("name", T.StringType()),
])
EDGE = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("target", T.StringType()),
    T.StructField("weight", T.LongType()),
])

# directed multigraph (nodes carry optional layout attributes)
MNODE = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("label", T.StringType()),
    T.StructField("x", T.DoubleType()),
    T.StructField("y", T.DoubleType()),
    T.StructField("size", T.DoubleType()),
])
MEDGE = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("target", T.StringType()),
    T.StructField("size", T.DoubleType()),
])

PAYMENT_COLUMNS = [f.name for f in PAYMENT.fields]
