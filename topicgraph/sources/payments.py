"""The ``payments`` view: person-to-person messages derived from the tables.

Every order line is one payment from the ordering customer to a customer
picked arithmetically from the line's keys; the message is the part name with
an emoji, an emoticon or an exclamation mark depending on the return flag.
The same definition is available as SQL (``PAYMENTS_SQL``) so DuckDB oracles
read exactly the rows Spark reads.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import table

# fixed values: message suffix per return flag
FLAG_SUFFIX = {"R": " ☕", "A": " :)"}
OTHER_SUFFIX = "!"

PAYMENTS_SQL = """
SELECT CAST(o.o_custkey AS STRING) AS actor_id, ca.c_name AS actor_name,
       CAST(ct.c_custkey AS STRING) AS target_id, ct.c_name AS target_name,
       concat(p.p_name, CASE l.l_returnflag WHEN 'R' THEN ' ☕' WHEN 'A' THEN ' :)' ELSE '!' END) AS message,
       o.o_orderdate AS time_sended
FROM lineitem l
JOIN orders o    ON l.l_orderkey = o.o_orderkey
JOIN part p      ON p.p_partkey = l.l_partkey
JOIN customer ca ON ca.c_custkey = o.o_custkey
JOIN customer ct ON ct.c_custkey = (l.l_partkey*7 + l.l_suppkey*13 + l.l_linenumber)
                                   % (SELECT count(*) FROM customer)
"""


def _suffix(flag: Column) -> Column:
    expr = F.when(flag == "R", F.lit(FLAG_SUFFIX["R"]))
    expr = expr.when(flag == "A", F.lit(FLAG_SUFFIX["A"]))
    return expr.otherwise(F.lit(OTHER_SUFFIX))


def payment_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payments plus the line keys (``l_orderkey``, ``l_linenumber``) that
    identify each payment uniquely; used where a stable payment id is
    needed (multigraph edge ids, ingest lines)."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    n_cust = cust.select(F.count("*")).scalar()
    ca = cust.select(F.col("c_custkey").alias("ca_key"), F.col("c_name").alias("actor_name"))
    ct = cust.select(F.col("c_custkey").alias("ct_key"), F.col("c_name").alias("target_name"))
    target_key = (F.col("l_partkey") * 7 + F.col("l_suppkey") * 13 + F.col("l_linenumber")) % n_cust
    # orders meet their customers before the lines, which are four times as many
    o = o.join(ca, F.col("ca_key") == F.col("o_custkey"))
    # the lines move once for each join: what is narrow joins first, and the target's key is made when it is needed
    li = li.join(p, li.l_partkey == p.p_partkey).join(o, li.l_orderkey == o.o_orderkey).withColumn("target_key", target_key)
    # by the id as it leaves: what is joined with ``target_id`` next lies there already
    df = li.join(ct, F.col("ct_key").cast("string") == F.col("target_key").cast("string"))
    return df.select(
        F.col("o_custkey").cast("string").alias("actor_id"),
        "actor_name",
        F.col("ct_key").cast("string").alias("target_id"),
        "target_name",
        F.concat(F.col("p_name"), _suffix(F.col("l_returnflag"))).alias("message"),
        F.col("o_orderdate").alias("time_sended"),
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag",
    )


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The six-column PAYMENT view."""
    return payment_lines(spark, sf_dir).select(
        "actor_id", "actor_name", "target_id", "target_name", "message", "time_sended")


PAYMENT_LINES_SQL = PAYMENTS_SQL.replace(
    "o.o_orderdate AS time_sended",
    "o.o_orderdate AS time_sended, l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, "
    "l.l_returnflag")


def payment_id(prefix: str = "") -> Column:
    """Line keys joined with '-' (unique per line at sf0.01 and above)."""
    return F.concat_ws("-", *[F.col(prefix + c).cast("string") for c in
                              ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")])


PAYMENT_ID_SQL = "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey)"


def payment_json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw payment JSON lines derived from the view, one per line item.

    The record shape depends on ``l_linenumber`` (fixed rule), so every
    acceptance case of the ingest appears at every scale:
    1 valid; 2 valid with a second transaction; 3 falsy or non-object target
    (id 0 for flag R, "" for A, a plain string otherwise); 4 actor username
    missing; 5 message null; 6 message key missing; 7 truncated JSON.
    """
    p = payment_lines(spark, sf_dir)

    def js(c: Column) -> Column:  # JSON string literal of a column: strip [ ] of a 1-array
        a = F.to_json(F.array(c))
        return a.substr(F.lit(2), F.length(a) - 2)

    n, flag = F.col("l_linenumber"), F.col("l_returnflag")
    actor_id, target_id = js(F.col("actor_id")), js(F.col("target_id"))
    actor_name, target_name = js(F.col("actor_name")), js(F.col("target_name"))
    actor = F.when(n == 4, F.concat(F.lit('{"id":'), actor_id, F.lit("}"))).otherwise(
        F.concat(F.lit('{"id":'), actor_id, F.lit(',"username":'), actor_name, F.lit("}")))
    tid = F.when((n == 3) & (flag == "R"), F.lit("0")).when((n == 3) & (flag == "A"), F.lit('""')) \
        .otherwise(target_id)
    target = F.when((n == 3) & ~flag.isin("R", "A"), target_id).otherwise(
        F.concat(F.lit('{"id":'), tid, F.lit(',"username":'), target_name, F.lit("}")))
    second = F.concat(F.lit(',{"target":{"id":'), actor_id, F.lit(',"username":'), actor_name, F.lit("}}"))
    txs = F.concat(F.lit('[{"target":'), target, F.lit("}"),
                   F.when(n == 2, second).otherwise(F.lit("")), F.lit("]"))
    msg = F.when(n == 5, F.lit(',"message":null')).when(n == 6, F.lit("")).otherwise(
        F.concat(F.lit(',"message":'), js(F.col("message"))))
    when = F.date_format("time_sended", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    full = F.concat(F.lit('{"payment_id":'), js(payment_id()), F.lit(',"actor":'), actor,
                    F.lit(',"transactions":'), txs, msg, F.lit(',"updated_time":"'), when, F.lit('"}'))
    value = F.when(n >= 7, F.substring(full, 1, 40)).otherwise(full)
    return p.select(value.alias("value"), F.lit(f"{sf_dir}/payments.jsonl").alias("file_path"))
