"""Masks on customer, supplier, orders, conversations and events."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import masking
from .common import register, table


def masked(name: str, source: str, columns: str, mask: str, sql_value: str):
    """One query per stable mask: the key, the masked column, and the same in SQL."""
    key, column = [c.strip() for c in columns.split(",")]

    @register(name, f"SELECT {key}, {sql_value} AS {column} FROM {source}")
    def query(spark, sf):
        frame = table(spark, sf, source).select(key, column)
        return masking.mask_table(frame, [f"{column}:{mask}"])

    return query


def pads(key: str) -> tuple[str, str]:
    raw = key.encode().ljust(64, b"\0")
    return bytes(b ^ 0x36 for b in raw).hex(), bytes(b ^ 0x5C for b in raw).hex()


INNER, OUTER = pads("pepper")

masked("M01_mask_sha256", "customer", "c_custkey, c_name", "sha256", "sha256(c_name)")
masked("M02_mask_md5", "customer", "c_custkey, c_name", "md5", "md5(c_name)")
masked(
    "M03_mask_hmac", "customer", "c_custkey, c_name", "hmac:pepper",
    f"sha256(unhex('{OUTER}') || unhex(sha256(unhex('{INNER}') || encode(c_name))))",
)
masked("M08_mask_redact", "customer", "c_custkey, c_name", "redact", "'REDACTED'")
masked("M09_mask_stars", "conversations", "conv_id, text", "stars", "repeat('*', length(text))")
masked("M10_mask_fixed", "customer", "c_custkey, c_name", "fixed:HIDDEN", "'HIDDEN'")
masked(
    "M12_mask_partial", "documents", "doc_id, text", "partial:3",
    """CASE WHEN text = '' THEN '' WHEN length(text) <= 6 THEN repeat('*', length(text))
       ELSE left(text, 3) || repeat('*', length(text) - 6) || right(text, 3) END""",
)
masked(
    "M13_mask_first_letter", "documents", "doc_id, text", "first_letter",
    "CASE WHEN length(text) <= 1 THEN text ELSE left(text, 1) || repeat('*', length(text) - 1) END",
)
masked(
    "M14_mask_round", "orders", "o_orderkey, o_totalprice", "round:500",
    "CAST(round_even(o_totalprice / 500, 0) * 500 AS BIGINT)",
)
masked(
    "M15_mask_range", "customer", "c_custkey, c_acctbal", "range:1000",
    """CAST(CAST(floor(c_acctbal / 1000) * 1000 AS BIGINT) AS VARCHAR) || '-' ||
       CAST(CAST(floor(c_acctbal / 1000) * 1000 AS BIGINT) + 1000 AS VARCHAR)""",
)
masked("M20_mask_year_only", "orders", "o_orderkey, o_orderdate", "year_only", "CAST(year(o_orderdate) AS INTEGER)")
masked("M21_mask_month_year", "orders", "o_orderkey, o_orderdate", "month_year", "strftime(o_orderdate, '%Y-%m')")


@register(
    "M04_mask_email",
    """WITH e AS (SELECT page_id, lower(regexp_replace(split_part(url, '/', 4), '[^a-zA-Z0-9]', '', 'g')) || '@' ||
  split_part(url, '/', 3) AS email FROM pages)
SELECT page_id, CASE WHEN strpos(email, '@') - 1 <= 2 THEN repeat('*', strpos(email, '@') - 1)
   ELSE left(email, 1) || repeat('*', strpos(email, '@') - 3) || substr(email, strpos(email, '@') - 1, 1) END
  || substr(email, strpos(email, '@')) AS email FROM e""",
)
def mask_email(spark, sf):
    """Mail addresses made of the path and host of each page's address."""
    part = F.split(F.col("url"), "/")
    local = F.lower(F.regexp_replace(F.coalesce(F.get(part, F.lit(3)), F.lit("")), "[^a-zA-Z0-9]", ""))
    emails = table(spark, sf, "pages").select("page_id", F.concat(local, F.lit("@"), F.get(part, F.lit(2))).alias("email"))
    return masking.mask_table(emails, ["email:email"])


@register(
    "M05_mask_phone",
    """SELECT o_orderkey, CASE WHEN length(d) < 10 THEN repeat('*', length(d)) ELSE left(d, 3) || '-***-****' END AS phone
FROM (SELECT o_orderkey, CAST(o_custkey AS VARCHAR) || lpad(CAST(o_orderkey AS VARCHAR), 8, '0') AS d FROM orders)""",
)
def mask_phone(spark, sf):
    numbers = table(spark, sf, "orders").selectExpr(
        "o_orderkey", "concat('+', o_custkey, ' (', substr(lpad(o_orderkey, 8, '0'), 1, 4), ') ', substr(lpad(o_orderkey, 8, '0'), 5)) AS phone"
    )
    return masking.mask_table(numbers, ["phone:phone"])


@register(
    "M06_mask_credit_card",
    """SELECT l_orderkey, CASE WHEN length(d) < 12 THEN repeat('*', length(d))
  ELSE repeat('*', length(d) - 4) || right(d, 4) END AS card
FROM (SELECT l_orderkey, lpad(CAST(l_orderkey AS VARCHAR), 7, '0') || CAST(l_partkey AS VARCHAR) || CAST(l_suppkey AS VARCHAR)
  AS d FROM lineitem)""",
)
def mask_credit_card(spark, sf):
    cards = table(spark, sf, "lineitem").selectExpr(
        "l_orderkey", "concat_ws('-', lpad(l_orderkey, 7, '0'), l_partkey, l_suppkey) AS card"
    )
    return masking.mask_table(cards, ["card:credit_card"])


@register(
    "M07_mask_ssn",
    """SELECT o_orderkey, CASE WHEN length(d) <> 9 THEN repeat('*', length(d)) ELSE '***-**-' || right(d, 4) END AS ssn
FROM (SELECT o_orderkey, CAST(o_custkey AS VARCHAR) || lpad(CAST(o_orderkey AS VARCHAR), 6, '0') AS d FROM orders)""",
)
def mask_ssn(spark, sf):
    numbers = table(spark, sf, "orders").selectExpr("o_orderkey", "concat(o_custkey, '-', lpad(o_orderkey, 6, '0')) AS ssn")
    return masking.mask_table(numbers, ["ssn:ssn"])


@register(
    "M11_mask_random",
    """SELECT count(*) AS n, count(*) AS same_length, count(*) AS same_digits, count(*) AS bounded FROM customer""",
)
def mask_random(spark, sf):
    """The values are random; their length, digit count and bound are not."""
    clear = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal", F.col("c_custkey").alias("id"))
    hidden = masking.mask_table(
        clear.withColumns({"name": F.col("c_name"), "bal": F.col("c_acctbal")}), ["name:random", "bal:random", "id:random"]
    )
    return hidden.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.length("name") == F.length("c_name")).alias("same_length"),
        F.count_if(F.length(F.col("id").cast("string")) == F.length(F.col("c_custkey").cast("string"))).alias("same_digits"),
        F.count_if(F.col("bal").between(0, F.abs("c_acctbal") * 2)).alias("bounded"),
    )


@register(
    "M16_mask_uuid",
    """SELECT count(DISTINCT user_id) AS users, count(DISTINCT user_id) AS tokens, count(DISTINCT user_id) AS pairs,
  count(*) AS wellformed FROM events""",
)
def mask_uuid(spark, sf):
    """One token per user: as many pairs as users and as tokens."""
    events = table(spark, sf, "events").withColumn("token", F.col("user_id"))
    hidden = masking.mask_table(events, ["token:uuid"]).groupBy("user_id", "token").agg(F.count(F.lit(1)).alias("n"))
    shape = "^[0-9a-f]{8}-[0-9a-f]{4}-4[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$"
    return hidden.agg(
        F.count_distinct("user_id").alias("users"), F.count_distinct("token").alias("tokens"),
        F.count(F.lit(1)).alias("pairs"), F.sum(F.when(F.col("token").rlike(shape), F.col("n"))).alias("wellformed"),
    )


@register(
    "M17_mask_sequential",
    """WITH f AS (SELECT user_id, min(event_id) AS first_id FROM events GROUP BY 1),
n AS (SELECT user_id, row_number() OVER (ORDER BY first_id) AS number FROM f)
SELECT event_id, number AS user_id FROM events JOIN n USING (user_id)""",
)
def mask_sequential(spark, sf):
    events = table(spark, sf, "events").select("event_id", "user_id")
    return masking.mask_sequential(events, "user_id", ["event_id"])


@register(
    "M18_mask_noise",
    "SELECT count(*) AS n, count(*) AS bounded, count(*) AS whole FROM orders",
)
def mask_noise(spark, sf):
    orders = table(spark, sf, "orders").withColumns({"price": F.col("o_totalprice"), "cust": F.col("o_custkey")})
    hidden = masking.mask_table(orders, ["price:noise:0.2", "cust:noise"])
    return hidden.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.abs(F.col("price") - F.col("o_totalprice")) <= F.col("o_totalprice") * 0.2000001).alias("bounded"),
        F.count_if(F.abs(F.col("cust") - F.col("o_custkey")) <= F.col("o_custkey") * 0.1 + 1).alias("whole"),
    )


@register("M19_mask_date_shift", "SELECT count(*) AS n, count(*) AS bounded, count(*) AS text_bounded FROM orders")
def mask_date_shift(spark, sf):
    orders = table(spark, sf, "orders").withColumns(
        {"at": F.col("o_orderdate"), "day": F.date_format("o_orderdate", "yyyy-MM-dd")}
    )
    hidden = masking.mask_table(orders, ["at:date_shift:10", "day:date_shift"])
    return hidden.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.abs(F.datediff("at", "o_orderdate")) <= 10).alias("bounded"),
        F.count_if(F.abs(F.datediff(F.to_date("day"), "o_orderdate")) <= 30).alias("text_bounded"),
    )


@register(
    "M22_mask_table",
    """SELECT c_custkey, sha256(c_name) AS c_name, 'REDACTED' AS c_mktsegment,
  CAST(round_even(c_acctbal / 100, 0) * 100 AS BIGINT) AS c_acctbal, c_nationkey FROM customer""",
)
def mask_many(spark, sf):
    return masking.mask_table(
        table(spark, sf, "customer"),
        ["c_name:sha256", "c_mktsegment:redact", "c_acctbal:round:100", "no_such_column:md5"],
    )

