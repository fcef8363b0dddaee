"""The registered queries' results stated in SQL, straight from the given tables.

Queries with a random id are compared without it.
"""

ISO = "'%Y-%m-%dT%H:%M:%S.%gZ'"
K = "cast(json_extract(props, '$.k') as bigint)"
EPOCH = "cast(floor(epoch(ts)) as bigint)"
RUN_1, RUN_2 = "'2025-01-25T10:00:00.000000'", "'2025-01-26T10:00:00.000000'"

GAPPY_ORDERS = """
    select o_orderkey, o_custkey,
           case when o_totalprice <= 400000 then o_totalprice end as price,
           case when o_orderpriority <> '5-LOW' then o_orderpriority end as priority,
           case when o_orderstatus <> 'P' then o_orderstatus end as status
    from orders"""

KNOWN_CUSTOMERS = """
    select c_custkey, c_name from customer where c_acctbal > 0
    union all
    select c_custkey, c_name from customer where c_acctbal > 0 and c_nationkey = 1"""

LEFT_LOOKUP = f"""
    with o as (select o_orderkey, case when o_orderstatus <> 'P' then o_custkey end as o_custkey from orders)
    select o_orderkey, o_custkey, c_name from o left join ({KNOWN_CUSTOMERS}) c on o.o_custkey = c.c_custkey"""

ROLE_LOOKUP = """
    select l_orderkey, l_partkey, l_suppkey as departure_key, cast(l_linenumber as bigint) as arrival_key,
           a.s_acctbal as departure_latitude, cast(a.s_nationkey as double) as departure_longitude,
           b.s_acctbal as arrival_latitude, cast(b.s_nationkey as double) as arrival_longitude
    from lineitem
    left join supplier a on a.s_suppkey = l_suppkey
    left join supplier b on b.s_suppkey = l_linenumber"""

COUNT_CUSTOMER = """
    with o as (select o_orderkey, case when o_orderstatus <> 'P' then o_custkey end as airline from orders)
    select o_orderkey, airline, count(airline) over (partition by airline) as airline_count from o"""

# one row per flight leg, with the coordinates of both ends
FLIGHTS = f"""
    with e as (
        select *, {K} as k, cast(user_id as varchar) as home,
               {EPOCH} + (cast(round(value * 100) as bigint) * 3) // 5 - 300 as landing
        from events
        where value <= 150 and {K} <> 7 and not (event_type = 'error' and value < 10)
    ), legs as (
        select event_id, ts, user_id, event_type, landing, home as start,
               case when k >= 95 then 'ZZZ' else cast(k as varchar) end as stop, 'T' as prefix from e
        union all
        select event_id, ts, user_id, event_type, landing,
               case when k >= 95 then 'ZZZ' else cast(k as varchar) end, home, 'B' from e where event_type = 'purchase'
    ), airport as (
        select cast(c_custkey as varchar) as iata, c_acctbal as lat, c_nationkey + 0.5::double as lon
        from customer, (values (1), (2)) copies(n)
        where c_acctbal >= 0 and (n = 1 or c_nationkey = 3)
    ), located as (
        select l.*, a.lat as alat, a.lon as alon, b.lat as blat, b.lon as blon, {EPOCH} as takeoff
        from legs l join airport a on a.iata = l.start join airport b on b.iata = l.stop
    ), valid as (
        select strftime(ts, '%Y-%m-%d') as flight_date, event_type as flight_number,
               prefix || cast(event_id as varchar) as flight_iata, 'Airline ' || cast(user_id as varchar) as airline_name,
               start as departure_iata, stop as arrival_iata,
               concat_ws(',', alat, alon) as departure_geopoint, concat_ws(',', blat, blon) as arrival_geopoint,
               strftime(make_timestamp(takeoff * 1000000), {ISO}) as departure_scheduled,
               strftime(make_timestamp(landing * 1000000), {ISO}) as arrival_scheduled,
               cast(hour(ts) as int) as departure_hour, cast(hour(make_timestamp(landing * 1000000)) as int) as arrival_hour,
               round((landing - takeoff) / 3600.0::double, 1) as flight_duration_hours,
               (landing - takeoff) / 60.0::double as flight_duration_minutes,
               'Europe/Paris' as departure_timezone, 'UTC' as arrival_timezone
        from located
    )"""

# one row per full state vector; vectors of 8 values (event type view) lack the rest
STATES = f"""
    with s as (
        select event_id, event_type as icao24, cast(user_id as varchar) as callsign, 'C' || cast({K} as varchar) as origin_country,
               case when {K} <> 7 then cast(floor(epoch(date_trunc('hour', ts))) as bigint) end as time_position,
               {EPOCH} as last_contact, value as longitude, {K} + 0.25::double as latitude,
               case when value <= 150 then value end as altitude,
               case when event_type = 'click' then true when event_type in ('error', 'view') then null else false end as on_ground,
               case when event_type <> 'view' then cast({K} as double) end as velocity,
               case when event_type <> 'view' then 90.5::double end as heading,
               case when event_type <> 'view' then -1.5::double end as vertical_rate,
               cast(null as varchar) as geo_altitude,
               case when event_type <> 'view' then cast(event_id as varchar) end as squawk,
               case when event_type <> 'view' then 'false' end as spi
        from events
    ), t as (
        select *, strftime(make_timestamp(time_position * 1000000), '%Y-%m-%d %H:%M:%S') as time_position_date,
               strftime(make_timestamp(time_position * 1000000), {ISO}) as timestamp,
               concat_ws(',', latitude, longitude) as geopoint
        from s
    )"""
STATE_COLUMNS = """icao24, origin_country, time_position_date, longitude, latitude, geopoint, altitude, on_ground,
               velocity, heading, vertical_rate, squawk, timestamp"""
STATE_GATE = "time_position is not null and altitude is not null and on_ground = false and squawk is not null"

RATED_PAGES = """
    select c_custkey, c_name || ' & ' || c_mktsegment as "Airline",
           case when c_acctbal >= 0 then cast(floor(c_acctbal / 2000) as int) end as "Stars",
           '/airline?id=' || cast(c_custkey as varchar) || '&s=1' as "URL"
    from customer where c_nationkey <> 0"""


def rating_run(run: int) -> str:
    changed = "case when c_nationkey < 10 then 1 else 0 end" if run == 2 else "0"
    stamp = RUN_2 if run == 2 else RUN_1
    return f"""
        select c_name || '_' || cast(stars as varchar) as id, c_name as airline, stars, {stamp} as indexed_at
        from (select c_name, cast(floor(c_acctbal / 2000) as int) + {changed} as stars from customer) where stars >= 0"""


MESSAGES = f"""
    select 'skytrax' as route, c_custkey as fetch_no, timestamp '2024-01-01 00:00:00' as ts, 1 as records, "Airline" as first
    from ({RATED_PAGES})
    union all
    select 'opensky', event_id, ts, 2, event_type from events"""

PAYLOADS = """
        with r as (
            select event_id, case
                when event_type = 'error' and value < 20 then left(props, length(props) - 1)
                when event_type = 'click' and value < 20 then props || ' trailing'
                when event_type = 'view' and value < 20 then '{"k":-1,' || substring(props, 2)
                when event_type = 'purchase' and value < 20 then props || '],[' || props
                when event_type = 'purchase' and value > 60 then ''
                when event_type = 'view' and value > 60 then null
                else props end as t
            from events)"""
ORACLES = {
    "flatten_nested_records": """
        with legs as (
            select *, 'A' as prefix, 'T08:00:00+00:00' as clock, cast(o_custkey as varchar) as a, cast(o_orderkey as varchar) as b
            from orders where o_orderstatus in ('F', 'O')
            union all
            select *, 'B', 'T20:30:00+00:00', cast(o_orderkey as varchar), cast(o_custkey as varchar)
            from orders where o_orderstatus = 'F'
        )
        select strftime(o_orderdate, '%Y-%m-%d') as flight_date, strftime(o_orderdate, '%Y-%m-%d') || clock as departure_scheduled,
               o_orderpriority as departure_airport, 'UTC' as departure_timezone, a as departure_iata,
               cast(null as varchar) as arrival_scheduled, 'there' as arrival_airport, 'UTC' as arrival_timezone, b as arrival_iata,
               o_orderstatus as airline_name, cast(o_orderkey as varchar) as flight_number,
               prefix || cast(o_orderkey as varchar) as flight_iata
        from legs""",
    "json_array_scan": """
        select o_orderpriority as "Airline", cast(o_orderkey as int) as "Stars",
               case when o_orderstatus <> 'P' then o_orderstatus end as "URL" from orders
        union all
        select 'again', cast(o_custkey as int), '' from orders where o_orderstatus = 'F'""",
    "csv_dimension_scan": """
        select cast(c_custkey as int) as airport_id,
               case when c_acctbal < 0 then '\\N' else cast(c_custkey as varchar) end as iata,
               c_acctbal as latitude, c_nationkey + 0.5::double as longitude,
               case when c_nationkey >= 5 then c_nationkey end as timezone_offset
        from customer""",
    "json_payload_parse": f"""{PAYLOADS}
        select event_id, coalesce(json_valid(t), false) as is_json,
               case when json_valid(t) then cast(regexp_extract(t, '"k": *([0-9]+)[^"]*$', 1) as bigint) end as k from r""",
    "json_payload_rejects": f"""{PAYLOADS}
        select event_id, t as value, case when t is null then 'no text' when trim(t) = '' then 'empty text'
                                          when ends_with(t, ' trailing') or contains(t, '],[') then 'more behind the text' else 'cut or no JSON' end as reason
        from r where not coalesce(json_valid(t), false)""",
    "positional_array_to_struct": f"""{STATES}
        select event_id, icao24, callsign, origin_country, time_position, last_contact, longitude, latitude, altitude,
               on_ground, velocity, heading, vertical_rate, geo_altitude, squawk, spi from t
        union all
        select event_id, 'x', null, null, null, null, null, null, null, null, null, null, null, null, null, null from events""",
    "cap_array_head": """
        with w as (select doc_id, string_split(text, ' ') as words from documents)
        select doc_id, cast(p as int) as pos, words[p + 1] as word
        from (select doc_id, words, unnest(range(least(len(words), 50))) as p from w)""",
    "html_rows_extract": """
        with r as (select page_id, regexp_extract_all(regexp_extract(html, '(?s)<nav>(.*?)</nav>', 1), '(?s)<li>(.*?)</li>', 1) as items from pages),
        u as (select page_id, unnest(items) as item, unnest(range(len(items))) as p from r)
        select page_id, cast(p as int) as pos, regexp_extract(item, '(?s)<a [^>]*>(.*?)</a>', 1) as text,
               regexp_extract(item, 'href="([^"]*)"', 1) as href
        from u where length(regexp_extract(item, '(?s)<a [^>]*>(.*?)</a>', 1)) > 0""",
    "html_table_extract": RATED_PAGES,
    "digits_to_int": """
        select o_orderkey, try_cast(string_split(o_orderpriority, '-')[1] as int) as level, cast(null as int) as name,
               case when o_orderstatus = 'F' then cast(o_custkey as int) end as customer
        from orders""",
    "dropna_any": f"select * from ({GAPPY_ORDERS}) where price is not null and priority is not null and status is not null",
    "completeness_gate": f"""
        select o.*, c_name, c_nationkey from ({GAPPY_ORDERS}) o join customer on c_custkey = o_custkey
        where c_acctbal > 0 and price > 1000 and status is not null""",
    "boolean_text_filter": """
        select o_orderkey, 'boolean' as kind from orders where o_orderstatus = 'O'
        union all select o_orderkey, 'text' from orders where o_orderstatus = 'F'""",
    "geopoint_text": """
        select c_custkey, concat_ws(',', case when c_acctbal >= 0 then c_acctbal end,
                                    case when c_nationkey <> 0 then c_nationkey + 0.5::double end) as geopoint
        from customer""",
    "parse_timestamps": f"""
        select o_orderkey, case when o_orderstatus <> 'P' then strftime(date_trunc('day', o_orderdate), {ISO}) end as day,
               case when o_orderpriority <> '5-LOW' then strftime(date_trunc('day', o_orderdate) + interval 510 minute, {ISO}) end as moment
        from orders""",
    "calendar_features": "select event_id, cast(dayofweek(ts) + 1 as int) as day, cast(hour(ts) as int) as hour from events",
    "to_epoch_seconds": f"select event_id, {EPOCH} as seconds from events",
    "duration_hours": f"""
        with h as (select event_id, round(({EPOCH} - cast(epoch(date_trunc('day', ts)) as bigint)) / 3600.0::double, 1) as hours from events)
        select * from h where hours > 0""",
    "duration_minutes": f"""
        select event_id, ({EPOCH} - cast(epoch(date_trunc('day', ts)) as bigint) - 43200) / 60.0::double as minutes from events""",
    "leg_duration_hours": """
        with h as (select l_orderkey, l_linenumber, l_partkey,
                          round(cast(epoch(l_shipdate) - epoch(o_orderdate) as bigint) / 3600.0::double, 1) as hours
                   from lineitem join orders on o_orderkey = l_orderkey)
        select * from h where hours > 0""",
    "iso8601_format": f"select event_id, strftime(ts, {ISO}) as ts, strftime(ts, '%Y-%m-%d') as day from events",
    "epoch_to_text": f"""
        select event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') as text, strftime(date_trunc('second', ts), {ISO}) as iso from events""",
    "natural_key": """
        select event_id, concat_ws('_', user_id, strftime(ts, '%Y-%m-%d'), hour(ts)) as id from events""",
    "uuid_tag": "select o_orderkey, 36 as id_length, true as id_valid from orders",
    "ingest_stamp": f"select o_orderkey, {RUN_1} as indexed_at from orders",
    "write_report": f"""
        select count(*) filter (ok) as succeeded, count(*) filter (not ok) as failed
        from (select coalesce(price > 1000 and priority is not null and status is not null, false) as ok from ({GAPPY_ORDERS}))""",
    "write_report_by_source": """
        select event_type, count(*) filter (value > 20) as succeeded, count(*) filter (not value > 20) as failed
        from events group by event_type""",
    "role_playing_lookup": ROLE_LOOKUP,
    "role_playing_lookup_large": ROLE_LOOKUP,
    "left_lookup_unmatched": LEFT_LOOKUP,
    "left_lookup_unmatched_large": LEFT_LOOKUP,
    "partition_count_airline": COUNT_CUSTOMER,
    "partition_count_many_keys": COUNT_CUSTOMER,
    "partition_count_departure": """
        select l_orderkey, l_linenumber, l_suppkey, count(l_suppkey) over (partition by l_suppkey) as departure_airport_count
        from lineitem""",
    "partition_count_arrival": """
        select l_orderkey, l_linenumber, l_partkey, count(l_partkey) over (partition by l_partkey) as arrival_airport_count
        from lineitem""",
    "index_replace_by_key": f"""
        with v as (select *, row_number() over (partition by user_id, event_type order by ts desc, event_id desc) as n from events)
        select concat_ws('_', user_id, event_type) as id, event_id, user_id, event_type, value, strftime(ts, {ISO}) as at
        from v where n = 1""",
    "upsert_merge_documents": f"""
        with e as (select *, concat_ws('_', user_id, event_type) as id, ts < timestamp '2024-01-16' as early from events),
        r as (select *, row_number() over (partition by id, early order by event_id desc) as n from e),
        b as (select id, value, props from r where early and n = 1),
        u as (select id, case when value <= 20 then value end as value, strftime(ts, {ISO}) as seen_at, true as hit from r where not early and n = 1)
        select coalesce(b.id, u.id) as id, case when hit then u.value else b.value end as value, b.props, u.seen_at
        from b full join u on b.id = u.id""",
    "snapshot_create_if_absent": """
        select cast(c_custkey as varchar) as id, concat_ws(',', c_acctbal, c_acctbal) as geopoint,
               true as created, false as created_again from customer""",
    "bulk_action_lines": """
        select 'customers' as index, cast(c_custkey as varchar) as id, c_custkey, case when c_acctbal >= 0 then c_name end as name,
               true as has_name, 'true' as doc_as_upsert from customer""",
    "pack_batch_messages": "select event_type as key, event_id, user_id, value, props, true as bounded from events",
    "land_packed_batches": """
        select 's' || event_type || '_data.json' as object, event_id, event_type, value from events where event_id % 2 = 1""",
    "stream_land_batches": """
        select 's' || event_type || '_data.json' as object, event_id, event_type, value from events where event_id % 2 = 1""",
    "pack_batch_messages_one_key": "select 'aviation_data' as key, event_type, event_id, value from events",
    "pack_record_messages": """
        select event_type || '_data' as key, event_id, user_id, case when value > 20 then props end as note, true as has_note
        from events""",
    "route_by_key": """
        select event_id as "offset", case event_type when 'click' then 'ratings' when 'view' then 'states' else 'unknown' end as route
        from events""",
    "route_by_field": """
        select event_id, case event_type when 'click' then 'skytrax' else 'opensky' end as route
        from events where event_type in ('click', 'view', 'error')""",
    "land_latest_per_source": f"""
        with v as (select *, row_number() over (partition by event_type order by ts desc, event_id desc) as n from events)
        select event_type as key, props as value, event_id as "offset", strftime(ts, {ISO}) as at from v where n = 1""",
    "land_history_by_epoch": f"""
        with v as (select *, {EPOCH} as s, row_number() over (partition by event_type, {EPOCH} order by ts desc, event_id desc) as n from events)
        select event_type as key, s as epoch_second, props as value, event_id as "offset",
               event_type || '_data_' || cast(s as varchar) || '.json' as object from v where n = 1""",
    "stream_land_history": f"""
        with v as (select *, {EPOCH} as s, row_number() over (partition by event_type, {EPOCH} order by ts desc, event_id desc) as n from events)
        select event_type as key, s as epoch_second, props as value, event_id as "offset" from v where n = 1""",
    "clean_state_records": f"{STATES} select {STATE_COLUMNS}, event_id from t where {STATE_GATE}",
    "clean_rating_records": f"select airline, stars, indexed_at from ({rating_run(1)})",
    "flights_index": f"""{FLIGHTS},
        k as (select *, concat_ws('_', flight_number, flight_date, departure_hour) as id from valid where flight_duration_hours > 0),
        r as (select *, row_number() over (partition by id order by departure_scheduled desc, arrival_scheduled desc, airline_name desc,
                     flight_iata desc, departure_iata desc, arrival_iata desc) as n from k)
        select * exclude (n, flight_duration_minutes) from r where n = 1""",
    "flights_index_minutes": f"{FLIGHTS} select * exclude (flight_duration_hours) from valid",
    "flights_preview": f"""{FLIGHTS}
        select flight_number, flight_iata, departure_geopoint, arrival_geopoint from valid where flight_duration_hours > 0
        order by flight_iata, departure_geopoint, arrival_geopoint limit 5""",
    "states_index": f"""{STATES},
        r as (select {STATE_COLUMNS}, icao24 || '_' || timestamp as id,
                     row_number() over (partition by icao24, timestamp order by event_id desc) as n from t where {STATE_GATE})
        select * exclude (n) from r where n = 1""",
    "states_index_reduced": f"""{STATES}
        select icao24, origin_country, time_position_date, longitude, latitude, geopoint, timestamp from t
        where time_position is not null""",
    "ratings_upsert": f"""
        with a as ({rating_run(1)}), b as ({rating_run(2)})
        select * from b union all select * from a where id not in (select id from b)""",
    "ingest_land_latest": f"""
        with m as ({MESSAGES}), r as (select *, row_number() over (partition by route order by fetch_no desc) as n from m)
        select route, route || '_data.json' as object, fetch_no, records, first from r where n = 1""",
    "ingest_read_landed": f"""{STATES}
        select * exclude (event_id, time_position_date, timestamp, geopoint) from t where event_id = (select max(event_id) from events)
        union all
        select 'x', null, null, null, null, null, null, null, null, null, null, null, null, null, null""",
    "ingest_land_history": f"""
        with m as ({MESSAGES}),
        r as (select *, {EPOCH} as s, row_number() over (partition by route, {EPOCH} order by fetch_no desc) as n from m)
        select route, route || '_data_' || cast(s as varchar) || '.json' as object, fetch_no, records, first from r where n = 1""",
}
ORACLES["stream_land_latest"] = ORACLES["land_latest_per_source"]
ORACLES["stream_route_batches"] = ORACLES["route_by_field"]

ORACLES["job_index_flights"] = f"""
    with docs as ({ORACLES["flights_index"]}),
    counts as ({FLIGHTS}, place as (
            select cast(c_custkey as varchar) as iata from customer, (values (1), (2)) copies(n) where n = 1 or c_nationkey = 3),
        found as (select count(*) as n from legs l left join place a on a.iata = l.start left join place b on b.iata = l.stop)
        select (select count(*) from valid where flight_duration_hours > 0) as ok, n from found)
    select docs.*, ok as succeeded, n - ok as failed from docs, counts"""
CANDIDATES = f"""{FLIGHTS}, place as (
            select cast(c_custkey as varchar) as iata from customer, (values (1), (2)) copies(n) where n = 1 or c_nationkey = 3),
        found as (select count(*) as n from legs l left join place a on a.iata = l.start left join place b on b.iata = l.stop)"""
ORACLES["job_send_flights"] = f"""{CANDIDATES},
    ok as (select * from valid where flight_duration_hours > 0)
    select 'index' as op_type, 'flights' as index, concat_ws('_', flight_number, flight_date, departure_hour) as id,
           ok.* exclude (flight_duration_minutes), (select count(*) from ok) as succeeded, n - (select count(*) from ok) as failed
    from ok, found"""
ORACLES["job_append_flights_minutes"] = f"""{CANDIDATES}
    select 'index' as op_type, 'flights' as index, valid.* exclude (flight_duration_hours),
           (select count(*) from valid) as succeeded, n - (select count(*) from valid) as failed
    from valid, found"""
ORACLES["bulk_send_actions"] = """
    with c as (select *, case when c_nationkey < 10 then 'run-1' else 'run-2' end as run from customer)
    select run, 'update' as op_type, 'customers' as index, cast(c_custkey as varchar) as id, c_custkey, c_name, succeeded, failed
    from c join (select run, count(*) filter (c_acctbal >= 0) as succeeded, count(*) filter (not c_acctbal >= 0) as failed
                 from c group by run) using (run)
    where c_acctbal >= 0"""
ORACLES["job_index_states"] = f"""{STATES},
    ok as (select *, icao24 || '_' || timestamp as id from t where {STATE_GATE}),
    r as (select {STATE_COLUMNS}, id, row_number() over (partition by id order by {", ".join(
        name + " desc" for name in STATE_COLUMNS.replace("\n", " ").replace(" ", "").split(","))}) as n from ok)
    select * exclude (n), (select count(*) from ok) as succeeded, 2 * (select count(*) from events) - (select count(*) from ok) as failed
    from r where n = 1"""
ORACLES["job_upsert_ratings"] = f"""
    select *, (select count(*) from ({rating_run(2)})) as succeeded,
           (select count(*) from customer) - (select count(*) from ({rating_run(2)})) as failed
    from ({ORACLES["ratings_upsert"]})"""

ORACLES["positional_array_api_names"] = f"""{STATES}
    select event_id, icao24, callsign, origin_country, time_position, last_contact, longitude, latitude, altitude as baro_altitude,
           on_ground, velocity, heading as true_track, vertical_rate, cast(null as varchar) as sensors,
           case when event_id is not null and squawk is not null then cast(event_id as double) end as geo_altitude,
           spi as squawk, cast(null as boolean) as spi, cast(null as int) as position_source from t
    union all
    select event_id, 'x', null, null, null, null, null, null, null, null, null, null, null, null, null, null, null, null from events"""
ORACLES["duration_hours_zone_aware"] = f"""
    with e as (select event_id, date_trunc('day', ts)::timestamp as day, ts::timestamp as ts, case event_type when 'click' then 'Europe/Paris'
               when 'view' then 'America/New_York' when 'error' then 'Asia/Tokyo' else 'UTC' end as zone from events)
    select event_id, round((floor(epoch(timezone('Asia/Kolkata', ts))) - floor(epoch(timezone(zone, day)))) / 3600.0::double, 1) + 0.0::double as hours from e"""
ORACLES["stream_route_rejects"] = """
    select event_id, 'no field of a route' as reason, '{"event_id":' || cast(event_id as varchar) || ',"value":' || cast(value as varchar) || '}' as value
    from events where event_type not in ('click', 'view', 'error')"""
ORACLES["stream_land_objects"] = f"""
    with last_page as (select * from ({RATED_PAGES}) order by c_custkey desc limit 1),
    last_event as (select event_type from events order by event_id desc limit 1)
    select 'skytrax' as route, "Airline" as name from last_page
    union all select 'opensky', event_type from last_event union all select 'opensky', 'x'"""

ORACLES["stream_index_states"] = f"""{STATES},
    r as (select {STATE_COLUMNS}, icao24 || '_' || timestamp as id,
                 row_number() over (partition by icao24, timestamp order by event_id % 2 desc, event_id desc) as n from t where {STATE_GATE})
    select * exclude (n) from r where n = 1"""
ORACLES["stream_index_report"] = f"""{STATES},
    ok as (select event_id % 2 as batch, count(*) as n from t where {STATE_GATE} group by 1)
    select e.batch, coalesce(ok.n, 0) as succeeded, 2 * e.n - coalesce(ok.n, 0) as failed
    from (select event_id % 2 as batch, count(*) as n from events group by 1) e left join ok on ok.batch = e.batch"""
ORACLES["stream_index_ratings"] = ORACLES["ratings_upsert"]
ORACLES["stream_index_flights"] = f"""{FLIGHTS},
    k as (select *, concat_ws('_', flight_number, flight_date, departure_hour) as id from valid where flight_duration_hours > 0),
    r as (select *, row_number() over (partition by id order by cast(substring(flight_iata, 2) as bigint) % 2 desc, departure_scheduled desc,
                 arrival_scheduled desc, airline_name desc, flight_iata desc, departure_iata desc, arrival_iata desc) as n from k)
    select * exclude (n, flight_duration_minutes) from r where n = 1"""
RECORDS = f"""
    select 'skytrax' as route, 'skytrax_data' as key, timestamp '2023-12-31 00:00:00' as ts, c_custkey * 2 as "offset", "Airline" as name
    from ({RATED_PAGES})
    union all
    select 'opensky', 'opensky_data', ts::timestamp, event_id * 2, event_type from events
    union all
    select 'opensky', 'opensky_data', ts::timestamp, event_id * 2 + 1, 'x' from events"""
ORACLES["ingest_land_records"] = f"""
    with m as ({RECORDS}), r as (select *, {EPOCH} as s, row_number() over (partition by {EPOCH} order by "offset" desc) as n from m)
    select 'aviation_data_' || cast(s as varchar) || '.json' as object, key, "offset", name from r where n = 1"""
ORACLES["ingest_route_records"] = f"""select route, key, "offset", name from ({RECORDS})"""
