"""One query per operator: what ``queries()`` of the driver contract returns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flightlane import fixed_values as v
from flightlane.functions import temporal as t
from flightlane.functions import text as x
from flightlane.operators import documents as d
from flightlane.operators import bulk, lookup, messages, quality, reshape
from flightlane.operators.snapshots import SnapshotTable, index_schema
from flightlane.plans import flights, ingest, jobs, ratings, states, streams
from flightlane.session import new_path, stored
from flightlane.sources import files, html_tables, vectors
from flightlane.sources.messages import stream_files
from flightlane.streaming import indexing, landing
from registry import inputs as i

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
FIRST_RUN, SECOND_RUN = "2025-01-25 10:00:00", "2025-01-26 10:00:00"


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# --- sources ------------------------------------------------------------------------------


@query
def flatten_nested_records(spark, sf):
    path = new_path(spark, "documents")
    i.order_documents(i.table(spark, sf, "orders")).write.json(path)
    return flights.flat_flights(files.read_json(spark, path, v.FLIGHT_DOCUMENT_SCHEMA))


@query
def json_array_scan(spark, sf):
    orders = i.table(spark, sf, "orders")
    record = F.struct(F.col("o_orderpriority").alias("Airline"), F.col("o_orderkey").cast("int").alias("Stars"),
                      F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("URL"))
    again = F.struct(F.lit("again").alias("Airline"), F.col("o_custkey").cast("int").alias("Stars"), F.lit("").alias("URL"))
    line = F.when(F.col("o_orderstatus") == "F", F.array(record, again)).otherwise(F.array(record))
    path = new_path(spark, "arrays")
    orders.select(F.to_json(line).alias("value")).write.text(path)
    return files.read_json(spark, path, v.RATING_FILE_SCHEMA)


@query
def csv_dimension_scan(spark, sf):
    customers = i.table(spark, sf, "customer")
    code = F.when(F.col("c_acctbal") < 0, "\\N").otherwise(F.col("c_custkey").cast("string"))
    offset = F.when(F.col("c_nationkey") < 5, "5.5").otherwise(F.col("c_nationkey").cast("string"))
    path = new_path(spark, "dimension")
    customers.select(
        "c_custkey", "c_name", F.lit("City, with comma"), F.lit("Country"), code, F.lit("ICAO"), "c_acctbal",
        F.col("c_nationkey") + 0.5, F.lit(10), offset, F.lit("E"), F.lit("\\N"), F.lit("airport"), F.lit("x"),
    ).write.option("escape", '"').csv(path)
    return files.read_dimension(
        spark, path, v.AIRPORT_SCHEMA, ["airport_id", "iata", "latitude", "longitude", "timezone_offset"])


def _payloads(spark, sf):
    """Objects, some cut short, some with text behind them, some with a name twice, some empty or no text at all."""
    props, kind, low = F.col("props"), F.col("event_type"), F.col("value") < 20
    value = (
        F.when((kind == "error") & low, F.expr("left(props, length(props) - 1)"))
        .when((kind == "click") & low, F.concat(props, F.lit(" trailing")))
        .when((kind == "view") & low, F.concat(F.lit('{"k":-1,'), F.substring(props, 2, 10_000)))
        .when((kind == "purchase") & low, F.concat(props, F.lit("],["), props))
        .when((kind == "purchase") & (F.col("value") > 60), "").when((kind == "view") & (F.col("value") > 60), None).otherwise(props))
    return i.table(spark, sf, "events").select("event_id", value.alias("value"))


@query
def json_payload_parse(spark, sf):
    received = _payloads(spark, sf)
    k = F.when(F.col("is_json"), F.col("payload.k"))
    return messages.parse_payload(received, "k BIGINT").select("event_id", "is_json", k.alias("k"))


@query
def json_payload_rejects(spark, sf):
    received = _payloads(spark, sf)
    _, rejects = messages.split_rejects(messages.parse_payload(received, "k BIGINT"))
    return rejects


@query
def positional_array_to_struct(spark, sf):
    return vectors.decode_vectors(i.vector_payloads(i.table(spark, sf, "events")), keep=["event_id"])


@query
def positional_array_api_names(spark, sf):
    payloads = i.vector_payloads(i.table(spark, sf, "events"))
    return vectors.decode_vectors(payloads, keep=["event_id"], positions=v.API_POSITIONS)


@query
def cap_array_head(spark, sf):
    documents = i.table(spark, sf, "documents")
    states = F.transform(F.split("text", " "), lambda word: F.array(word))
    payloads = documents.select("doc_id", F.to_json(F.struct(states.alias("states"))).alias("value"))
    capped = vectors.with_vectors(payloads, cap=v.STATE_FETCH_CAP, positions=[("word", "string")])
    words = reshape.explode_once(capped, F.col("vectors"), "vector", ["doc_id"], pos="pos")
    return words.select("doc_id", "pos", F.col("vector.word").alias("word"))


@query
def html_rows_extract(spark, sf):
    pages = i.table(spark, sf, "pages")
    return html_tables.extract_links(pages, [html_tables.element("nav")], html_tables.element("li"), ["page_id"])


@query
def html_table_extract(spark, sf):
    return html_tables.extract_ratings(i.rating_pages(i.table(spark, sf, "customer")), keep=["c_custkey"])


# --- scalar functions, filters, gates -----------------------------------------------------


@query
def digits_to_int(spark, sf):
    orders = i.table(spark, sf, "orders")
    parts = F.split("o_orderpriority", "-")
    mixed = F.when(F.col("o_orderstatus") == "F", F.col("o_custkey").cast("string")).otherwise(F.concat(F.col("o_custkey").cast("string"), F.lit("x")))
    return orders.select("o_orderkey", x.digits_to_int(parts[0]).alias("level"), x.digits_to_int(parts[1]).alias("name"),
                         x.digits_to_int(mixed).alias("customer"))


def _gappy_orders(spark, sf):
    return i.table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey",
        F.when(F.col("o_totalprice") <= 400000, F.col("o_totalprice")).alias("price"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("priority"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("status"),
    )


@query
def dropna_any(spark, sf):
    return quality.drop_incomplete(_gappy_orders(spark, sf))


@query
def completeness_gate(spark, sf):
    customers = i.table(spark, sf, "customer").where("c_acctbal > 0").select("c_custkey", "c_name", "c_nationkey")
    enriched = lookup.left_lookup(_gappy_orders(spark, sf), customers, "o_custkey", "c_custkey")
    return enriched.where(quality.complete(["price", "status", "c_name", "c_nationkey"], F.col("price") > 1000))


@query
def boolean_text_filter(spark, sf):
    orders = i.table(spark, sf, "orders")
    status = F.col("o_orderstatus")
    flags = orders.select(
        "o_orderkey",
        F.when(status == "F", True).when(status == "O", False).alias("flag"),
        F.when(status == "F", " False").when(F.col("o_orderpriority") == "5-LOW", "no idea").when(F.col("o_orderpriority") == "1-URGENT", "0")
        .when(F.col("o_orderpriority") == "2-HIGH", "no").when(F.col("o_orderpriority") == "3-MEDIUM", "f").when(status == "O", "true").alias("flag_text"),
    )
    by_flag = flags.where(x.is_false(F.col("flag"))).select("o_orderkey", F.lit("boolean").alias("kind"))
    by_text = flags.where(x.is_false(F.col("flag_text"))).select("o_orderkey", F.lit("text").alias("kind"))
    return by_flag.unionAll(by_text)


@query
def geopoint_text(spark, sf):
    return i.table(spark, sf, "customer").select(
        "c_custkey", F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("latitude"),
        F.when(F.col("c_nationkey") != 0, F.col("c_nationkey") + 0.5).alias("longitude"),
    ).select("c_custkey", x.geopoint("latitude", "longitude").alias("geopoint"))


@query
def parse_timestamps(spark, sf):
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    texts = i.table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("on "), day)).otherwise(day).alias("day"),
        F.when(F.col("o_orderpriority") == "5-LOW", "zzz").otherwise(F.concat(day, F.lit("T10:30:00+02:00"))).alias("moment"),
    )
    return texts.select("o_orderkey", t.iso_millis(t.parse_date("day")).alias("day"), t.iso_millis(t.parse_instant("moment")).alias("moment"))


@query
def calendar_features(spark, sf):
    return i.table(spark, sf, "events").select("event_id", F.dayofweek("ts").alias("day"), F.hour("ts").alias("hour"))


@query
def to_epoch_seconds(spark, sf):
    return i.table(spark, sf, "events").select("event_id", t.epoch_seconds("ts").alias("seconds"))


@query
def duration_hours(spark, sf):
    events = i.table(spark, sf, "events")
    lasting = events.select("event_id", t.duration_hours(F.date_trunc("day", "ts"), "ts").alias("hours"))
    return lasting.where(F.col("hours") > 0)


@query
def duration_hours_zone_aware(spark, sf):
    events = i.table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    zone = F.when(F.col("event_type") == "click", "Europe/Paris").when(F.col("event_type") == "view", "America/New_York").when(F.col("event_type") == "error", "Asia/Tokyo").otherwise("UTC")
    start = t.zoned_instant(F.date_trunc("day", "ts"), zone)
    return events.select("event_id", t.duration_hours(start, t.zoned_instant("ts", F.lit("Asia/Kolkata"))).alias("hours"))


@query
def duration_minutes(spark, sf):
    noon = F.timestamp_seconds(F.unix_timestamp(F.date_trunc("day", "ts")) + 12 * 3600)
    return i.table(spark, sf, "events").select("event_id", t.duration_minutes(noon, F.col("ts")).alias("minutes"))


@query
def leg_duration_hours(spark, sf):
    orders = i.table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    legs = lookup.left_lookup(i.table(spark, sf, "lineitem"), orders, "l_orderkey", "o_orderkey")
    return legs.select("l_orderkey", "l_linenumber", "l_partkey", t.duration_hours("o_orderdate", "l_shipdate").alias("hours")).where("hours > 0")


@query
def iso8601_format(spark, sf):
    return i.table(spark, sf, "events").select("event_id", "ts").withColumns(
        {"day": t.date_text("ts"), "ts": t.iso_millis("ts")})


@query
def epoch_to_text(spark, sf):
    seconds = i.table(spark, sf, "events").select("event_id", F.unix_timestamp("ts").alias("s"))
    return seconds.select("event_id", t.epoch_to_text("s").alias("text"), t.epoch_to_iso("s").alias("iso"))


@query
def natural_key(spark, sf):
    parts = i.table(spark, sf, "events").select("event_id", "user_id", t.date_text("ts").alias("day"), F.hour("ts").alias("hour"))
    return parts.select("event_id", x.natural_key(["user_id", "day", "hour"]).alias("id"))


@query
def uuid_tag(spark, sf):
    tagged = d.tag_rows(i.table(spark, sf, "orders").select("o_orderkey"))
    return tagged.select("o_orderkey", F.length("unique_id").alias("id_length"), F.col("unique_id").rlike(x.UUID_PATTERN).alias("id_valid"))


@query
def ingest_stamp(spark, sf):
    return i.table(spark, sf, "orders").select("o_orderkey", t.ingest_stamp(FIRST_RUN).alias("indexed_at"))


@query
def write_report(spark, sf):
    gate = quality.complete(["price", "priority", "status"], F.col("price") > 1000)
    return quality.write_report(_gappy_orders(spark, sf), gate)


@query
def write_report_by_source(spark, sf):
    gate = quality.complete(["user_id"], F.col("value") > 20)
    return quality.write_report(i.table(spark, sf, "events"), gate, ["event_type"])


# --- lookups and counts -------------------------------------------------------------------


def _legs(spark, sf):
    return i.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", F.col("l_suppkey").alias("departure_key"),
        F.col("l_linenumber").cast("bigint").alias("arrival_key"))


def _suppliers(spark, sf):
    return i.table(spark, sf, "supplier").select(
        "s_suppkey", F.col("s_acctbal").alias("latitude"), F.col("s_nationkey").cast("double").alias("longitude"))


ROLES = {"departure": "departure_key", "arrival": "arrival_key"}


@query
def role_playing_lookup(spark, sf):
    return lookup.role_lookups(_legs(spark, sf), _suppliers(spark, sf), "s_suppkey", ROLES)


@query
def role_playing_lookup_large(spark, sf):
    """The way a dimension takes that is too large to broadcast."""
    return lookup.role_lookups(_legs(spark, sf), _suppliers(spark, sf), "s_suppkey", ROLES, strategy="merge")


def _known_customers(spark, sf):
    # nation 1 is listed twice, customers without balance are not listed
    copies = F.sequence(F.lit(1), F.when(F.col("c_nationkey") == 1, 2).otherwise(1))
    known = i.table(spark, sf, "customer").where("c_acctbal > 0")
    return known.select("c_custkey", "c_name", F.explode(copies).alias("copy")).drop("copy")


@query
def left_lookup_unmatched(spark, sf):
    orders = i.table(spark, sf, "orders").select("o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("o_custkey"))
    return lookup.left_lookup(orders, _known_customers(spark, sf), "o_custkey", "c_custkey")


@query
def left_lookup_unmatched_large(spark, sf):
    orders = i.table(spark, sf, "orders").select("o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("o_custkey"))
    return lookup.left_lookup(orders, _known_customers(spark, sf), "o_custkey", "c_custkey", strategy="merge")


@query
def partition_count_airline(spark, sf):
    orders = i.table(spark, sf, "orders").select("o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("airline"))
    return lookup.with_group_count(orders, "airline", "airline_count")


@query
def partition_count_departure(spark, sf):
    legs = i.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    return lookup.with_group_count(legs, "l_suppkey", "departure_airport_count")


@query
def partition_count_arrival(spark, sf):
    legs = i.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return lookup.with_group_count(legs, "l_partkey", "arrival_airport_count")


@query
def partition_count_many_keys(spark, sf):
    """The way counts take that are too many to broadcast."""
    orders = i.table(spark, sf, "orders").select("o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("airline"))
    return lookup.with_group_count(orders, "airline", "airline_count", strategy="merge")


# --- keyed documents ----------------------------------------------------------------------


def _event_documents(rows):
    fields = ["event_id", "user_id", "event_type", "value", "at"]
    stamped = rows.withColumn("at", t.iso_millis("ts"))
    return d.documents(d.index_actions(stamped, "events", ["user_id", "event_type"], fields)), fields


@query
def index_replace_by_key(spark, sf):
    events = i.table(spark, sf, "events")
    first, fields = _event_documents(events.where(f"ts < {i.HALF}"))
    second, _ = _event_documents(events.where(f"ts >= {i.HALF}"))
    current = d.latest_by(first, ["id"], ["at", "event_id"])
    return d.replace_documents(current, second, fields, ["at", "event_id"])


@query
def upsert_merge_documents(spark, sf):
    events = i.table(spark, sf, "events").withColumn("id", x.natural_key(["user_id", "event_type"]))
    first = events.where(f"ts < {i.HALF}").select("id", "event_id", "value", "props")
    current = d.latest_by(first, ["id"], ["event_id"]).drop("event_id")
    second = events.where(f"ts >= {i.HALF}").select(
        "id", "event_id", F.when(F.col("value") <= 20, F.col("value")).alias("value"), t.iso_millis("ts").alias("seen_at"))
    return d.merge_documents(current, second, ["value", "seen_at"], ["event_id"])


@query
def snapshot_create_if_absent(spark, sf):
    """Create, leave as it is, replace while reading, read back."""
    rows = i.table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("id"), x.geopoint("c_acctbal", "c_acctbal").alias("geopoint"))
    table = SnapshotTable(spark, new_path(spark, "snapshot"), index_schema(rows.schema, {"geopoint": "geo_point"}))
    created, created_again = table.create_if_absent(), table.create_if_absent()
    table.replace(rows)
    table.replace(table.read())
    return table.read().select("id", "geopoint", F.lit(created).alias("created"), F.lit(created_again).alias("created_again"))


@query
def bulk_action_lines(spark, sf):
    rows = i.table(spark, sf, "customer").select("c_custkey", F.when(F.col("c_acctbal") >= 0, F.col("c_name")).alias("name"))
    lines = d.bulk_lines(d.upsert_actions(rows, "customers", ["c_custkey"], ["c_custkey", "name"]))
    parts = F.split("value", "\n")
    return lines.select(
        F.get_json_object(parts[0], "$.update._index").alias("index"), F.get_json_object(parts[0], "$.update._id").alias("id"),
        F.get_json_object(parts[1], "$.doc.c_custkey").cast("bigint").alias("c_custkey"),
        F.get_json_object(parts[1], "$.doc.name").alias("name"),
        x.has_field(F.get_json_object(parts[1], "$.doc"), "name").alias("has_name"),
        F.get_json_object(parts[1], "$.doc_as_upsert").alias("doc_as_upsert"))


@query
def bulk_send_actions(spark, sf):
    """Upserts sent in two runs, the first of them twice; customers in debt have no action and fail."""
    path = new_path(spark, "bulk")
    customers = i.table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal", "c_nationkey")
    actions = d.upsert_actions(customers, "customers", ["c_custkey"], ["c_custkey", "c_name"], ["c_acctbal", "c_nationkey"])
    for run, low in (("run-1", True), ("run-2", False), ("run-1", True)):
        bulk.write_bulk(d.bulk_lines(actions.where((F.col("c_nationkey") < 10) == low), F.col("c_acctbal") >= 0), path, run, 2_000)
    sent = bulk.sent_documents(bulk.read_bulk(spark, path), actions.schema["source"].dataType, ["run"])
    return sent.join(bulk.bulk_reports(spark, path), "run")


# --- messages and landing -----------------------------------------------------------------


@query
def pack_batch_messages(spark, sf):
    events = i.table(spark, sf, "events")
    columns = ["event_id", "user_id", "value", "props"]
    packed = messages.pack_batches(events, F.col("event_type"), columns, max_bytes=30_000)
    schema = "event_id BIGINT, user_id BIGINT, value DOUBLE, props STRING"
    bounded = packed.withColumn("bounded", (F.octet_length("value") <= 31_000) & (F.col("parts") >= 1))
    return messages.unpack_batches(bounded, schema, keep=["key", "bounded"]).select("key", *columns, "bounded")


def _packed(spark, sf):
    """Batches 9, 10 and 11 of many parts per source: even events, odd ones, and all without the last part of each source.

    One part of batch 10 comes twice.
    """
    events = i.table(spark, sf, "events").repartition(7, "event_id")
    source, columns = F.concat(F.lit("s"), F.col("event_type")), ["event_id", "event_type", "value"]
    ninth, tenth = (messages.pack_batches(events.where(F.col("event_id") % 2 == n), source, columns, 9 + n, 4_000) for n in (0, 1))
    last = messages.pack_batches(events, source, columns, 11, 4_000)
    ends = last.groupBy(F.col("key").alias("_key")).agg(F.max("part").alias("_end"))
    cut = last.join(ends, (F.col("key") == F.col("_key")) & (F.col("part") == F.col("_end")), "left_anti")
    return stored(ninth.unionByName(tenth).unionByName(tenth.where("part = '0-0'")).unionByName(cut), "batches")


EVENT_RECORD = "event_id BIGINT, event_type STRING, value DOUBLE"


@query
def land_packed_batches(spark, sf):
    """Batches of many parts per source: the last whole one of each lands with all its parts and is read back."""
    path = new_path(spark, "batches")
    landing.land_objects(ingest.land_latest_batches(_packed(spark, sf), route=F.col("key")), path)
    return messages.unpack_batches(spark.read.text(path), EVENT_RECORD, keep=["object"])


@query
def stream_land_batches(spark, sf):
    """The same batches as a stream that is stopped and started again, their parts spread over three micro-batches."""
    path = new_path(spark, "stream-batches")
    packed = _packed(spark, sf).withColumn("turn", F.pmod(F.xxhash64("key", "batch", "part"), F.lit(3)))
    for turn in range(3):
        packed.where(F.col("turn") == turn).drop("turn").write.mode("append").parquet(f"{path}/topic")
        topic = spark.readStream.schema(packed.drop("turn").schema).parquet(f"{path}/topic")
        landing.stream_batches(topic, path, f"{path}/checkpoint", F.col("key")).awaitTermination()
    return messages.unpack_batches(spark.read.text(f"{path}/lake"), EVENT_RECORD, keep=["object"])


@query
def pack_batch_messages_one_key(spark, sf):
    columns = ["event_type", "event_id", "value"]
    packed = messages.pack_batches(i.table(spark, sf, "events"), v.BATCH_KEY, columns)
    return messages.unpack_batches(packed, "event_type STRING, event_id BIGINT, value DOUBLE", keep=["key"])


@query
def pack_record_messages(spark, sf):
    events = i.table(spark, sf, "events").withColumn("note", F.when(F.col("value") > 20, F.col("props")))
    packed = messages.pack_records(events, F.col("event_type"), ["event_id", "user_id", "note"])
    parsed = messages.parse_payload(packed, "event_id BIGINT, user_id BIGINT, note STRING")
    return parsed.select("key", "payload.*", x.has_field(F.col("value"), "note").alias("has_note"))


@query
def route_by_key(spark, sf):
    received = i.event_messages(i.table(spark, sf, "events"))
    routes = {"click": "ratings", "view": "states"}
    return received.select("offset", messages.route_by_key("key", routes).alias("route"))


@query
def route_by_field(spark, sf):
    routed = i.event_state(i.table(spark, sf, "events")).withColumn("route", messages.route_by_field())
    return reshape.settled(routed, ["route"]).where("route is not null").select("event_id", "route")


@query
def land_latest_per_source(spark, sf):
    received = i.event_messages(i.table(spark, sf, "events"))
    latest = landing.latest_per_source(received, "key", ["timestamp", "offset"], unique=True)
    return latest.select("key", "value", "offset", t.iso_millis("timestamp").alias("at"))


@query
def land_history_by_epoch(spark, sf):
    received = i.event_messages(i.table(spark, sf, "events"))
    history = landing.history_per_second(received, "key", ["timestamp", "offset"], unique=True)
    path = new_path(spark, "history")
    landing.land_history(history, path, "key")
    landed = landing.read_history(spark, path, "key", ["timestamp", "offset"])
    name = landing.object_name(F.col("key"), F.col("epoch_second"))
    return landed.select("key", "epoch_second", "value", "offset", name.alias("object"))


def _event_stream(spark, sf):
    i.table(spark, sf, "events")
    # a pattern, because a stream takes a plain path for a folder and the table may be one file
    return stream_files(spark, f"{sf}/event[s].parquet", i.EVENTS_SCHEMA)


@query
def stream_land_latest(spark, sf):
    received = i.event_messages(_event_stream(spark, sf))
    order = ["timestamp", "offset"]
    table = SnapshotTable(spark, new_path(spark, "latest"), landing.latest_schema(received, "key", order), buckets=4, key="key")
    table.create_if_absent()
    landing.stream_latest(received, table, "key", order).awaitTermination()
    return table.read().select("key", "value", "offset", t.iso_millis("timestamp").alias("at"))


@query
def stream_route_batches(spark, sf):
    path = new_path(spark, "routes")
    records = i.event_state(_event_stream(spark, sf))
    landing.stream_routes(records, f"{path}/data", f"{path}/checkpoint").awaitTermination()
    return landing.read_routes(spark, f"{path}/data").select("event_id", "route")


@query
def stream_route_rejects(spark, sf):
    path = new_path(spark, "routes")
    records = i.event_state(_event_stream(spark, sf))
    landing.stream_routes(records, f"{path}/data", f"{path}/checkpoint", rejects=f"{path}/rejects").awaitTermination()
    return spark.read.parquet(f"{path}/rejects").select("event_id", "value", "reason")


@query
def stream_land_objects(spark, sf):
    """Fetched messages as a stream to objects of fixed names, read as the ratings and states jobs read them."""
    path = new_path(spark, "objects")
    _fetched(spark, sf).write.parquet(f"{path}/topic")
    topic = spark.readStream.schema(spark.read.parquet(f"{path}/topic").schema).parquet(f"{path}/topic")
    landing.stream_objects(topic, f"{path}/lake", ["fetch_no"], f"{path}/checkpoint", messages.route_by_key()).awaitTermination()
    rated = files.read_json(spark, landing.object_path(f"{path}/lake", "skytrax_data.json"), v.RATING_FILE_SCHEMA)
    flown = files.read_json(spark, landing.object_path(f"{path}/lake", "opensky_data.json"), v.STATE_FILE_SCHEMA)
    return rated.select(F.lit("skytrax").alias("route"), F.col("Airline").alias("name")).unionAll(flown.select(F.lit("opensky"), "icao24"))


@query
def stream_land_history(spark, sf):
    path = new_path(spark, "history")
    received = i.event_messages(_event_stream(spark, sf))
    order = ["timestamp", "offset"]
    landing.stream_history(received, f"{path}/data", "key", order, f"{path}/checkpoint").awaitTermination()
    return landing.read_history(spark, f"{path}/data", "key", order).select("key", "epoch_second", "value", "offset")


# --- whole jobs ---------------------------------------------------------------------------


def _states(spark, sf):
    payloads = i.vector_payloads(i.table(spark, sf, "events"))
    return vectors.decode_vectors(payloads, keep=["event_id"])


@query
def clean_state_records(spark, sf):
    return states.valid_states(_states(spark, sf), keep=["event_id"])


@query
def clean_rating_records(spark, sf):
    return ratings.valid_ratings(i.rating_run(i.table(spark, sf, "customer"), 1), FIRST_RUN)


def _valid_flights(spark, sf, duration):
    documents = i.flight_documents(i.table(spark, sf, "events"))
    return flights.valid_flights(documents, i.airports(i.table(spark, sf, "customer")), duration)


@query
def flights_index(spark, sf):
    actions = flights.flight_actions(_valid_flights(spark, sf, "hours"), "flights")
    return d.index_documents(actions, ["order"])


@query
def flights_index_minutes(spark, sf):
    actions = flights.flight_minutes_actions(_valid_flights(spark, sf, "minutes"), "flights")
    return d.documents(actions).drop("id")


@query
def flights_preview(spark, sf):
    shown = _valid_flights(spark, sf, "hours").select("flight_number", "flight_iata", "departure_geopoint", "arrival_geopoint")
    return reshape.preview(shown, ["flight_iata", "departure_geopoint", "arrival_geopoint"], 5)


@query
def states_index(spark, sf):
    valid = states.valid_states(_states(spark, sf), keep=["event_id"])
    return d.index_documents(states.state_actions(valid, "states", keep=["event_id"]), ["event_id"])


@query
def states_index_reduced(spark, sf):
    return d.documents(states.state_reduced_actions(states.valid_states_reduced(_states(spark, sf)), "states")).drop("id")


@query
def ratings_upsert(spark, sf):
    customers = i.table(spark, sf, "customer")
    runs = [ratings.rating_actions(ratings.valid_ratings(i.rating_run(customers, run), stamp), "ratings")
            for run, stamp in ((1, FIRST_RUN), (2, SECOND_RUN))]
    nothing = runs[0].select("id", "source.*").where(F.lit(False))
    return ratings.apply_ratings(ratings.apply_ratings(nothing, runs[0]), runs[1])


def _fetched(spark, sf):
    """The topic: messages of fetched pages and payloads, written as a topic holds them."""
    pages = i.rating_pages(i.table(spark, sf, "customer")).withColumn("fetch_no", F.col("c_custkey"))
    payloads = i.vector_payloads(i.table(spark, sf, "events")).withColumn("fetch_no", F.col("event_id"))
    return stored(ingest.rating_messages(pages.withColumn("ts", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")), "Skytrax", ["fetch_no", "ts"])
                  .unionByName(ingest.state_messages(payloads, "OpenSky", ["fetch_no", "ts"])), "topic")


def _first_record(landed):
    first = F.coalesce(F.get_json_object("value", "$[0].Airline"), F.get_json_object("value", "$[0].icao24"))
    return landed.withColumn("first", first)


@query
def ingest_land_latest(spark, sf):
    landed = ingest.land_latest(_fetched(spark, sf), ["fetch_no"], unique=True)
    return _first_record(landed).select("route", "object", "fetch_no", "records", "first")


@query
def ingest_read_landed(spark, sf):
    """The landed object of the last fetch, read as the states job reads it."""
    path = new_path(spark, "objects")
    landing.land_objects(ingest.land_latest(_fetched(spark, sf), ["fetch_no"], unique=True), path)
    return files.read_json(spark, landing.object_path(path, "opensky_data.json"), v.STATE_FILE_SCHEMA)


@query
def ingest_land_history(spark, sf):
    landed = ingest.land_history(_fetched(spark, sf), ["fetch_no"], "ts", unique=True)
    return _first_record(landed).select("route", "object", "fetch_no", "records", "first")


def _reported(table, report):
    return table.read().withColumns({name: F.lit(n).cast("bigint") for name, n in report.items()})


def _flight_files(spark, sf):
    path = new_path(spark, "job-flights")
    i.flight_documents(i.table(spark, sf, "events")).write.json(f"{path}/documents")
    airports = i.airports(i.table(spark, sf, "customer"))
    blank = F.lit("x")
    airports.select(F.lit(1), blank, blank, blank, "iata", blank, "latitude", "longitude", F.lit(0), F.lit(0), blank, blank, blank, blank).write.csv(f"{path}/airports")
    return path


def _flights_sent(spark, sf, duration):
    """From files into the bulk sink, one run twice; the documents it took over and the run's report."""
    path = _flight_files(spark, sf)
    for _ in range(2):
        report = jobs.send_flights(spark, f"{path}/documents", f"{path}/airports", f"{path}/bulk", "nightly", duration)
    name = f"flight_duration_{duration}"
    fields = T.StructType([T.StructField(n, T.IntegerType() if n.endswith("_hour") else T.DoubleType() if n == name else T.StringType())
                           for n in (name if n == "flight_duration_hours" else n for n in v.FLIGHT_INDEX_FIELDS)])
    sent = bulk.sent_documents(bulk.read_bulk(spark, f"{path}/bulk"), fields)
    return sent.withColumns({name: F.lit(n).cast("bigint") for name, n in report.items()})


@query
def job_send_flights(spark, sf):
    return _flights_sent(spark, sf, "hours")


@query
def job_append_flights_minutes(spark, sf):
    """The variant with minutes adds under random ids, once."""
    return _flights_sent(spark, sf, "minutes").drop("id")


@query
def job_index_flights(spark, sf):
    """From files to the table of flights and its report, run twice."""
    path = _flight_files(spark, sf)
    for _ in range(2):
        table, report = jobs.index_flights(spark, f"{path}/documents", f"{path}/airports", f"{path}/table")
    return _reported(table, report)


@query
def job_index_states(spark, sf):
    """From files to the table of states and its report, run twice."""
    path = new_path(spark, "job-states")
    # the key is of an hour here, so its states differ; which one stays follows from their values
    _states(spark, sf).drop("event_id").write.json(f"{path}/states")
    for _ in range(2):
        table, report = jobs.index_states(spark, f"{path}/states", f"{path}/table")
    return _reported(table, report)


@query
def job_upsert_ratings(spark, sf):
    """From the files of two runs to the table of ratings and the report of the second."""
    path = new_path(spark, "job-ratings")
    for run, stamp in ((1, FIRST_RUN), (2, SECOND_RUN), (2, SECOND_RUN)):
        i.rating_run(i.table(spark, sf, "customer"), run).write.mode("overwrite").json(f"{path}/run{run}")
        table, report = jobs.upsert_ratings(spark, f"{path}/run{run}", f"{path}/table", stamp)
    return _reported(table, report)


# --- streams into the index ---------------------------------------------------------------


def _two_turns(spark, path, rows, second, fmt, run):
    """Rows as files in two turns, the stream started anew for each."""
    for turn in (False, True):
        rows.where(second == turn).write.mode("append").format(fmt).save(f"{path}/topic")
        table, stream = run(spark.readStream.schema(rows.schema).format(fmt).load(f"{path}/topic"))
        stream.awaitTermination()
    return table


def _streamed_states(spark, sf):
    path = new_path(spark, "stream-states")
    payloads = i.vector_payloads(i.table(spark, sf, "events")).withColumn("offset", F.col("event_id"))
    sent = ingest.state_messages(payloads, "OpenSky", ["offset"])
    return path, _two_turns(spark, path, sent, F.col("offset") % 2 == 1, "parquet", lambda topic: streams.stream_states(topic, path))


@query
def stream_index_states(spark, sf):
    """From message files to the table of states: even events, then, after a restart, odd ones."""
    return _streamed_states(spark, sf)[1].read()


@query
def stream_index_report(spark, sf):
    """What each micro-batch of that stream took and rejected."""
    return indexing.read_reports(spark, _streamed_states(spark, sf)[0])


@query
def stream_index_ratings(spark, sf):
    """From messages of a record each, of two runs, to the table of ratings."""
    path = new_path(spark, "stream-ratings")
    customers = i.table(spark, sf, "customer")
    sent = [messages.pack_records(i.rating_run(customers, run).withColumn("timestamp", F.lit(stamp).cast("timestamp")), "skytrax",
                                  ["Airline", "Stars", "URL"], ["timestamp"]) for run, stamp in ((1, FIRST_RUN), (2, SECOND_RUN))]
    late = F.col("timestamp") == F.lit(SECOND_RUN).cast("timestamp")
    return _two_turns(spark, path, sent[0].unionByName(sent[1]), late, "parquet", lambda topic: streams.stream_ratings(topic, path)).read()


@query
def stream_index_flights(spark, sf):
    """From landed documents to the table of flights: those of even events, then of odd ones."""
    path = new_path(spark, "stream-flights")
    blank = F.lit("x")
    i.airports(i.table(spark, sf, "customer")).select(
        F.lit(1), blank, blank, blank, "iata", blank, "latitude", "longitude", F.lit(0), F.lit(0), blank, blank, blank, blank).write.csv(f"{path}/airports")
    landed = stored(i.flight_documents(i.table(spark, sf, "events")), "flight-documents")
    odd = F.substring(F.col("data")[0]["flight"]["iata"], 2, 20).cast("long") % 2 == 1
    return _two_turns(spark, path, landed, odd, "json", lambda files_: streams.stream_flights(files_, f"{path}/airports", path)).read()


def _records(spark, sf):
    pages = i.rating_pages(i.table(spark, sf, "customer")).select(F.col("c_custkey").alias("fetch_no"), F.lit("2023-12-31 00:00:00").cast("timestamp_ntz").alias("ts"), "html")
    payloads = i.vector_payloads(i.table(spark, sf, "events")).select(F.col("event_id").alias("fetch_no"), "ts", "value")
    sent = ingest.record_messages(pages, payloads, ["fetch_no", "ts"])
    return stored(sent.select("key", "value", "ts", (F.col("fetch_no") * 2 + F.col("place")).alias("offset")), "topic")


@query
def ingest_land_records(spark, sf):
    """Pages and payloads to a message per record, landed raw under one stamped name per second."""
    landed = ingest.land_raw(_records(spark, sf), ["offset"], "ts", unique=True)
    name = F.coalesce(F.get_json_object("value", "$.Airline"), F.get_json_object("value", "$.icao24"))
    return landed.select("object", "key", "offset", name.alias("name"))


@query
def ingest_route_records(spark, sf):
    """Pages and payloads to a message per record, routed as a stream by the fields the records have."""
    path = new_path(spark, "route-records")
    _records(spark, sf).write.parquet(f"{path}/topic")
    topic = spark.readStream.schema("key STRING, value STRING, ts TIMESTAMP_NTZ, offset BIGINT").parquet(f"{path}/topic")
    landing.stream_routes(topic, f"{path}/data", f"{path}/checkpoint").awaitTermination()
    name = F.coalesce(F.get_json_object("value", "$.Airline"), F.get_json_object("value", "$.icao24"))
    return landing.read_routes(spark, f"{path}/data").select("route", "key", "offset", name.alias("name"))
