import json

import pytest
from pyspark.sql import functions as F

from flightlane.fixed_values import AIRPORT_SCHEMA, FLIGHT_DOCUMENT_SCHEMA, RATING_FILE_SCHEMA, STATE_FILE_SCHEMA
from flightlane.operators import documents as d
from flightlane.plans import flights, ingest, ratings, states
from flightlane.sources.files import read_dimension, read_json
from flightlane.sources.vectors import decode_vectors
from flightlane.streaming import landing


def flight(number="1", start="2025-01-25T10:00:00+00:00", end="2025-01-25T12:05:00+00:00", **changes):
    made = {
        "flight_date": "2025-01-25", "flight_status": "scheduled",
        "departure": {"scheduled": start, "airport": "Roissy", "timezone": "Europe/Paris", "iata": "CDG"},
        "arrival": {"scheduled": end, "airport": "Heathrow", "timezone": "Europe/London", "iata": "LHR"},
        "airline": {"name": "X"}, "flight": {"number": number, "iata": f"X{number}"},
    }
    for path, value in changes.items():
        outer, _, inner = path.partition("__")
        made[outer] = {**made[outer], inner: value} if inner else value
    return made


FLIGHTS = [
    flight("1"),
    flight("2", departure__timezone=None),
    flight("3", departure__iata="ZZZ"),
    flight("4", end="2025-01-25T09:05:00+00:00"),
    flight("5", end="2025-01-25T10:02:00+00:00"),
    flight("1", airline__name="Y"),
    flight("7", start="zzz"),
    flight("8", start="2025-01-25T11:00:00+01:00"),
]
AIRPORTS = """1,Roissy,Paris,France,CDG,LFPG,49.01,2.55,392,1,E,Europe/Paris,airport,x
1,Roissy,Paris,France,CDG,LFPG,49.01,2.55,392,1,E,Europe/Paris,airport,x
2,Heathrow,London,UK,LHR,EGLL,51.47,-0.46,83,0,E,Europe/London,airport,x
3,Strip,X,Y,\\N,\\N,1.5,2.5,10,5.5,E,\\N,airport,x
"""


@pytest.fixture
def landed(spark, tmp_path):
    (tmp_path / "flights.json").write_text(json.dumps({"pagination": {"limit": 100}, "data": FLIGHTS}, indent=1))
    (tmp_path / "airports.dat").write_text(AIRPORTS)
    return (read_json(spark, str(tmp_path / "flights.json"), FLIGHT_DOCUMENT_SCHEMA, multiline=True),
            read_dimension(spark, str(tmp_path / "airports.dat"), AIRPORT_SCHEMA))


@pytest.mark.parametrize("strategy", [None, "merge"])
def test_flights(landed, rows, strategy):
    valid = flights.valid_flights(*landed, strategy=strategy)
    assert sorted(r["flight_number"] for r in rows(valid)) == ["1"] * 4 + ["8"] * 2
    actions = flights.flight_actions(valid, "flights")
    index = rows(d.index_documents(actions, ["order"]), "id")
    assert [r["id"] for r in index] == ["1_2025-01-25_10", "8_2025-01-25_10"]
    assert index[0] == {
        "id": "1_2025-01-25_10", "flight_date": "2025-01-25", "flight_number": "1", "flight_iata": "X1", "airline_name": "Y",
        "departure_iata": "CDG", "arrival_iata": "LHR", "departure_geopoint": "49.01,2.55", "arrival_geopoint": "51.47,-0.46",
        "departure_scheduled": "2025-01-25T10:00:00.000Z", "arrival_scheduled": "2025-01-25T12:05:00.000Z",
        "departure_hour": 10, "arrival_hour": 12, "flight_duration_hours": 2.1,
        "departure_timezone": "Europe/Paris", "arrival_timezone": "Europe/London"}
    assert {r["departure_day"] for r in rows(valid)} == {7}


def test_flights_in_minutes(landed, rows):
    valid = flights.valid_flights(*landed, duration="minutes")
    minutes = {(r["flight_number"], r["flight_duration_minutes"]) for r in rows(valid)}
    assert minutes == {("1", 125.0), ("4", -55.0), ("5", 2.0), ("8", 125.0)}
    actions = flights.flight_minutes_actions(valid, "flights")
    assert actions.select("id").distinct().count() == actions.count() == 10
    assert "flight_duration_minutes" in actions.select("source.*").columns


def test_unknown_airport_survives_the_lookup(landed, rows):
    located = flights.located_flights(flights.typed_flights(flights.flat_flights(landed[0])), landed[1])
    lost = [r for r in rows(located) if r["flight_number"] == "3"]
    assert [(r["departure_latitude"], r["departure_geopoint"], r["arrival_geopoint"]) for r in lost] == [(None, "", "51.47,-0.46")]


@pytest.mark.parametrize("text", ['{"data": []}', '{"data": null}', '{"pagination": {}}'])
def test_no_flights(spark, landed, tmp_path, text):
    (tmp_path / "empty.json").write_text(text)
    documents = read_json(spark, str(tmp_path / "empty.json"), FLIGHT_DOCUMENT_SCHEMA, multiline=True)
    assert flights.valid_flights(documents, landed[1]).count() == 0


def test_flight_plan(landed):
    text = flights.valid_flights(*landed)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Cartesian" not in text and "NestedLoop" not in text
    assert text.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in text
    large = flights.valid_flights(*landed, strategy="merge")._jdf.queryExecution().executedPlan().toString()
    assert large.count("SortMergeJoin") == 2


def vector(icao="a", time_position=1737799200, on_ground=False, squawk="77", **changes):
    made = [icao, "CS", "France", time_position, 1737799201, 2.55, 49.01, 1000.0, on_ground, 200.0, 90.0, 0.0, None, squawk, False]
    return made


@pytest.fixture
def vectors(spark):
    values = [vector("a"), ["x"], vector("b", on_ground=True), vector("c", on_ground=None), vector("d", time_position=None),
              vector("e", squawk=None)]
    return decode_vectors(spark.createDataFrame([(json.dumps({"time": 1, "states": values}),)], "value string"))


def test_states(vectors, rows):
    valid = states.valid_states(vectors)
    action = rows(states.state_actions(valid, "states"))
    assert [a["id"] for a in action] == ["a_2025-01-25T10:00:00.000Z"]
    assert action[0]["source"] == {
        "icao24": "a", "origin_country": "France", "time_position_date": "2025-01-25 10:00:00", "longitude": 2.55,
        "latitude": 49.01, "geopoint": "49.01,2.55", "altitude": 1000.0, "on_ground": False, "velocity": 200.0,
        "heading": 90.0, "vertical_rate": 0.0, "squawk": "77", "timestamp": "2025-01-25T10:00:00.000Z"}


def test_states_reduced(vectors, rows):
    reduced = states.valid_states_reduced(vectors)
    assert sorted(r["icao24"] for r in rows(reduced)) == ["a", "b", "c", "e"]
    assert states.state_reduced_actions(reduced, "states").select("source.*").columns == reduced.columns


def rated(spark, *pairs):
    return spark.createDataFrame([(a, s, "u") for a, s in pairs], RATING_FILE_SCHEMA)


def test_ratings(spark, rows):
    nothing = spark.createDataFrame([], "id string, airline string, stars int, indexed_at string")

    def run(current, stamp, *pairs):
        return ratings.apply_ratings(current, ratings.rating_actions(ratings.valid_ratings(rated(spark, *pairs), stamp), "r"))

    first = run(nothing, "2025-01-25 10:00:00", ("ANA", 5), ("BB", None), ("C", 4), ("ANA", 5))
    assert [r["id"] for r in rows(first, "id")] == ["ANA_5", "C_4"]
    second = run(first, "2025-01-26 10:00:00", ("ANA", 5), ("C", 5))
    assert [(r["id"], r["indexed_at"][:10]) for r in rows(second, "id")] == [
        ("ANA_5", "2025-01-26"), ("C_4", "2025-01-25"), ("C_5", "2025-01-26")]


def test_ingest_feeds_the_jobs(spark, tmp_path, rows):
    page = ('<table id="tablepress-1"><tbody><tr><td class="column-1">5</td><td class="column-2"><a href="u">{}</a></td></tr></tbody></table>')
    pages = spark.createDataFrame([(1, page.format("ANA")), (2, page.format("BB")), (3, "<p>gone</p>")], "fetch int, html string")
    payloads = spark.createDataFrame(
        [(i, json.dumps({"states": [vector(f"{i}-{n}") for n in range(60)]})) for i in (1, 2)] + [(3, '{"states":[]}'), (4, "{}")],
        "fetch int, value string")
    sent = ingest.rating_messages(pages, "Skytrax", ["fetch"]).unionByName(ingest.state_messages(payloads, "OpenSky", ["fetch"]))
    assert sorted((r["key"], r["fetch"], r["records"]) for r in rows(sent)) == [
        ("OpenSky", 1, 60), ("OpenSky", 2, 60), ("Skytrax", 1, 1), ("Skytrax", 2, 1)]
    latest = rows(ingest.land_latest(sent, ["fetch"]), "route")
    assert [(r["route"], r["object"], r["fetch"]) for r in latest] == [
        ("opensky", "opensky_data.json", 2), ("skytrax", "skytrax_data.json", 2)]

    path = str(tmp_path / "lake")
    landing.land_objects(ingest.land_latest(sent.where("fetch = 1"), ["fetch"]), path)
    landing.land_objects(ingest.land_latest(sent.where("key = 'Skytrax'"), ["fetch"]), path)
    read = read_json(spark, landing.object_path(path, "skytrax_data.json"), RATING_FILE_SCHEMA)
    assert [(r["airline"], r["stars"]) for r in rows(ratings.valid_ratings(read))] == [("BB", 5)]
    read = read_json(spark, landing.object_path(path, "opensky_data.json"), STATE_FILE_SCHEMA)
    assert {r["icao24"][:2] for r in rows(read)} == {"1-"}
    assert states.valid_states(read).count() == 60


def test_history_names(spark, rows):
    sent = spark.createDataFrame([("Skytrax", "a", 1, 100.2), ("Skytrax", "b", 2, 100.9), ("foo", "c", 3, 101.0)],
                                 "key string, value string, offset int, s double").withColumn("timestamp", F.col("s").cast("timestamp"))
    history = rows(ingest.land_history(sent, ["timestamp", "offset"]), "object")
    assert [(r["object"], r["value"]) for r in history] == [("skytrax_data_100.json", "b"), ("unknown_data_101.json", "c")]
