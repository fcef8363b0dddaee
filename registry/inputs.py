"""Inputs in the shapes the operators expect, derived by Spark from the given tables.

Nothing leaves out rows: gaps, unreadable text, unknown and double keys are put in by rules
on the values, and the SQL of each query states the same rules.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flightlane.operators.reshape import settled
from flightlane.session import prepare, spread

EVENTS_SCHEMA = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
HALF = "timestamp_ntz'2024-01-16 00:00:00'"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def event_messages(events: DataFrame) -> DataFrame:
    """Events as keyed messages in the order of their ids."""
    return events.select(
        F.col("event_type").alias("key"), F.col("props").alias("value"),
        F.col("event_id").alias("offset"), F.col("ts").alias("timestamp"),
    )


def order_documents(orders: DataFrame) -> DataFrame:
    """A document per order: two legs for status F, one for O, an empty array for P."""
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    customer, order = F.col("o_custkey").cast("string"), F.col("o_orderkey").cast("string")

    def leg(start, end, clock, number):
        return F.struct(
            day.alias("flight_date"),
            F.struct(F.concat(day, F.lit(clock)).alias("scheduled"), F.col("o_orderpriority").alias("airport"),
                     F.lit("UTC").alias("timezone"), start.alias("iata")).alias("departure"),
            F.struct(F.lit(None).cast("string").alias("scheduled"), F.lit("there").alias("airport"),
                     F.lit("UTC").alias("timezone"), end.alias("iata")).alias("arrival"),
            F.struct(F.col("o_orderstatus").alias("name")).alias("airline"),
            F.struct(order.alias("number"), F.concat(F.lit(number), order).alias("iata")).alias("flight"),
        )

    out, back = leg(customer, order, "T08:00:00+00:00", "A"), leg(order, customer, "T20:30:00+00:00", "B")
    legs = F.when(F.col("o_orderstatus") == "F", F.array(out, back)).when(F.col("o_orderstatus") == "O", F.array(out))
    return orders.select(F.struct(F.lit(100).alias("limit")).alias("pagination"),
                         F.coalesce(legs, F.slice(F.array(out), 1, 0)).alias("data"))


def flight_documents(events: DataFrame) -> DataFrame:
    """A document per event with one flight, for purchases with two: user_id -> props.k and back.

    Flights last ``value - 5`` minutes, so some are short or negative. Some lack a date or a
    time zone, have an unreadable time, or end at an airport nobody knows.
    """
    prepared = events.select(
        "*",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        (F.unix_timestamp("ts") + F.expr("cast(round(value * 100) as bigint) * 3 div 5 - 300")).alias("landing"),
    )
    takeoff = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'+00:00'")
    landing = F.date_format(F.timestamp_seconds("landing"), "yyyy-MM-dd'T'HH:mm:ss'+00:00'")
    home = F.col("user_id").cast("string")
    away = F.when(F.col("k") >= 95, "ZZZ").otherwise(F.col("k").cast("string"))

    def flight(start, end, prefix):
        return F.struct(
            F.when(F.col("value") <= 150, F.date_format("ts", "yyyy-MM-dd")).alias("flight_date"),
            F.struct(
                F.when((F.col("event_type") == "error") & (F.col("value") < 10), "zzz").otherwise(takeoff).alias("scheduled"),
                F.concat(F.lit("Airport "), start).alias("airport"),
                F.when(F.col("k") != 7, "Europe/Paris").alias("timezone"), start.alias("iata"),
            ).alias("departure"),
            F.struct(landing.alias("scheduled"), F.concat(F.lit("Airport "), end).alias("airport"),
                     F.lit("UTC").alias("timezone"), end.alias("iata")).alias("arrival"),
            F.struct(F.concat(F.lit("Airline "), F.col("user_id").cast("string")).alias("name")).alias("airline"),
            F.struct(F.col("event_type").alias("number"), F.concat(F.lit(prefix), F.col("event_id").cast("string")).alias("iata")).alias("flight"),
        )

    there, back = flight(home, away, "T"), flight(away, home, "B")
    return prepared.select(F.when(F.col("event_type") == "purchase", F.array(there, back)).otherwise(F.array(there)).alias("data"))


def airports(customers: DataFrame) -> DataFrame:
    """Customers as airports: no latitude below a zero balance, nation 3 listed twice."""
    copies = F.sequence(F.lit(1), F.when(F.col("c_nationkey") == 3, 2).otherwise(1))
    return customers.select(
        F.col("c_custkey").cast("string").alias("iata"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("latitude"),
        (F.col("c_nationkey") + 0.5).alias("longitude"),
        F.explode(copies).alias("copy"),
    ).drop("copy")


def vector_payloads(events: DataFrame) -> DataFrame:
    """A payload per event: a vector cut to a length by event type, then one of a lone value.

    Events are narrow and their payloads are parsed, so they are spread over tasks first."""
    events = spread(events.select("event_id", "ts", "user_id", "event_type", "value", "props"))
    k = F.get_json_object("props", "$.k")
    hour = F.unix_timestamp(F.date_trunc("hour", "ts"))
    quote = F.lit('"')
    ground = F.when(F.col("event_type") == "click", "true").when(F.col("event_type") == "error", "null").otherwise("false")
    literals = F.array(
        F.concat(quote, "event_type", quote), F.concat(quote, F.col("user_id").cast("string"), quote),
        F.concat(quote, F.lit("C"), k, quote), F.when(k == "7", "null").otherwise(hour.cast("string")),
        F.unix_timestamp("ts").cast("string"), F.col("value").cast("string"), F.concat(k, F.lit(".25")),
        F.when(F.col("value") > 150, "null").otherwise(F.col("value").cast("string")), ground, k, F.lit("90.5"), F.lit("-1.5"),
        F.lit("null"), F.concat(quote, F.col("event_id").cast("string"), quote), F.lit("false"),
    )
    length = F.when(F.col("event_type") == "view", 8).otherwise(15)
    vectors = F.concat(F.lit('[['), F.array_join(F.slice(literals, F.lit(1), length), ","), F.lit('],["x"]]'))
    payload = F.concat(F.lit('{"time":'), F.unix_timestamp("ts").cast("string"), F.lit(',"states":'), vectors, F.lit("}"))
    return events.select("event_id", "ts", payload.alias("value"))


def rating_pages(customers: DataFrame) -> DataFrame:
    """A page per customer with a ratings table: a rated row with an entity and a nested tag,
    a row without link, and for nation 0 nothing but a page without the table. Nations 1, 2 and 4 have
    pages that leave the ends of cells and rows out, that nest a table, and that end within a link.

    A customer has some twenty bytes in its file and a page some hundreds, so customers are spread over tasks first."""
    customers = spread(customers.select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"))
    key = F.col("c_custkey").cast("string")
    stars = F.floor(F.col("c_acctbal") / 2000).cast("string")
    rated = F.concat(
        F.lit('<tr class="row-2"><td class="column-1"> '), stars, F.lit(' </td>\n<td class="column-2 x"><a title="1 > 0" href="/airline?id='),
        key, F.lit('&amp;s=1"> <b>'), F.col("c_name"), F.lit("</b> &amp; "), F.col("c_mktsegment"), F.lit("</a></td></tr>"),
    )
    unlinked = F.lit('<tr><td class="column-1">3</td><td class="column-2">no link</td></tr>')
    page = F.concat(
        F.lit('<html><!-- <table id="tablepress-1"> --><table class="t" id="tablepress-1"><thead><tr><th>Stars</th></tr></thead><tbody>'),
        rated, unlinked, F.lit("</tbody></table></html>"),
    )
    nation = F.col("c_nationkey")
    unclosed = F.regexp_replace(page, "</t[dr]>", "")
    nested = F.replace(page, F.lit("<a title"), F.lit('<table><tr><td class="column-1">9</td></tr></table><a title'))
    cut = F.regexp_replace(page, "</a>|</tbody></table></html>", "")
    html = (F.when(nation == 0, "<html><p>none</p></html>").when(nation == 1, unclosed).when(nation == 2, nested).when(nation == 4, cut).otherwise(page))
    return settled(customers.select("c_custkey", html.alias("html")), ["html"])


def rating_run(customers: DataFrame, run: int) -> DataFrame:
    """Ratings as landed by a first and a second run; nations below 10 change theirs."""
    stars = F.floor(F.col("c_acctbal") / 2000).cast("int")
    if run == 2:
        stars = F.when(F.col("c_nationkey") < 10, stars + 1).otherwise(stars)
    return customers.select(F.col("c_name").alias("Airline"), F.when(stars >= 0, stars).alias("Stars"), F.lit("/").alias("URL"))


def event_state(events: DataFrame) -> DataFrame:
    """Events under field names of two kinds of records, some of neither kind."""
    rating = F.to_json(F.struct(F.col("event_id"), F.when(F.col("value") > 50, F.col("user_id")).alias("Airline"),
                                F.col("value").alias("icao24")), {"ignoreNullFields": "false"})
    state = F.to_json(F.struct(F.col("event_id"), F.when(F.col("value") > 50, F.col("user_id")).alias("icao24")),
                      {"ignoreNullFields": "false"})
    other = F.to_json(F.struct("event_id", "value"))
    value = F.when(F.col("event_type") == "click", rating).when(F.col("event_type").isin("view", "error"), state).otherwise(other)
    return events.select("event_id", value.alias("value"))
