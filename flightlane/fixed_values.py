"""Names, schemas, positions and formats that stored data already uses.

They have to stay exactly as they are for results to match; nothing here is logic.
"""

# --- text formats -----------------------------------------------------------
DATE_FORMAT = "yyyy-MM-dd"
ISO_MILLIS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
ISO_MICROS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"

# --- flights document -------------------------------------------------------
FLIGHT_DOCUMENT_SCHEMA = """
    data ARRAY<STRUCT<
        flight_date: STRING,
        departure: STRUCT<scheduled: STRING, airport: STRING, timezone: STRING, iata: STRING>,
        arrival: STRUCT<scheduled: STRING, airport: STRING, timezone: STRING, iata: STRING>,
        airline: STRUCT<name: STRING>,
        flight: STRUCT<number: STRING, iata: STRING>>>
"""

# output column -> path inside one element of the document's array
FLIGHT_PATHS = {
    "flight_date": "flight_date",
    "departure_scheduled": "departure.scheduled",
    "departure_airport": "departure.airport",
    "departure_timezone": "departure.timezone",
    "departure_iata": "departure.iata",
    "arrival_scheduled": "arrival.scheduled",
    "arrival_airport": "arrival.airport",
    "arrival_timezone": "arrival.timezone",
    "arrival_iata": "arrival.iata",
    "airline_name": "airline.name",
    "flight_number": "flight.number",
    "flight_iata": "flight.iata",
}

FLIGHT_INDEX_FIELDS = [
    "flight_date", "flight_number", "flight_iata", "airline_name",
    "departure_iata", "arrival_iata", "departure_geopoint", "arrival_geopoint",
    "departure_scheduled", "arrival_scheduled", "departure_hour", "arrival_hour",
    "flight_duration_hours", "departure_timezone", "arrival_timezone",
]
FLIGHT_KEY = ["flight_number", "flight_date", "departure_hour"]

# --- airport dimension (headerless CSV) -------------------------------------
AIRPORT_SCHEMA = (
    "airport_id INT, name STRING, city STRING, country STRING, iata STRING, icao STRING, "
    "latitude DOUBLE, longitude DOUBLE, altitude INT, timezone_offset INT, dst STRING, "
    "tz_database STRING, type STRING, source STRING"
)

# --- state vectors ----------------------------------------------------------
VECTOR_PAYLOAD_SCHEMA = "time BIGINT, states ARRAY<ARRAY<STRING>>"

# name and type of each position; the names at 12 and 13 are the ones the landed
# files use, although the public API documents sensors/geo_altitude/squawk there
STATE_POSITIONS = [
    ("icao24", "string"), ("callsign", "string"), ("origin_country", "string"),
    ("time_position", "bigint"), ("last_contact", "bigint"),
    ("longitude", "double"), ("latitude", "double"), ("altitude", "double"),
    ("on_ground", "boolean"), ("velocity", "double"), ("heading", "double"),
    ("vertical_rate", "double"), ("geo_altitude", "string"), ("squawk", "string"),
    ("spi", "string"),
]
# the same positions under the names of the public API's documentation
API_POSITIONS = [
    ("icao24", "string"), ("callsign", "string"), ("origin_country", "string"),
    ("time_position", "bigint"), ("last_contact", "bigint"),
    ("longitude", "double"), ("latitude", "double"), ("baro_altitude", "double"),
    ("on_ground", "boolean"), ("velocity", "double"), ("true_track", "double"),
    ("vertical_rate", "double"), ("sensors", "string"), ("geo_altitude", "double"),
    ("squawk", "string"), ("spi", "boolean"), ("position_source", "int"),
]
STATE_FILE_SCHEMA = ", ".join(f"{name} {kind}" for name, kind in STATE_POSITIONS)
STATE_FETCH_CAP = 50

STATE_INDEX_FIELDS = [
    "icao24", "origin_country", "time_position_date", "longitude", "latitude", "geopoint",
    "altitude", "on_ground", "velocity", "heading", "vertical_rate", "squawk", "timestamp",
]
STATE_REDUCED_FIELDS = [
    "icao24", "origin_country", "time_position_date", "longitude", "latitude", "geopoint",
    "timestamp",
]
STATE_KEY = ["icao24", "timestamp"]

# --- ratings ----------------------------------------------------------------
RATING_FILE_SCHEMA = "Airline STRING, Stars INT, URL STRING"
RATING_FIELDS = ["airline", "stars", "indexed_at"]
RATING_KEY = ["airline", "stars"]
RATING_TABLE_ID = "tablepress-1"
RATING_STARS_CLASS = "column-1"
RATING_NAME_CLASS = "column-2"

# --- messages and landing ---------------------------------------------------
SOURCE_ROUTES = {"Skytrax": "skytrax", "OpenSky": "opensky"}
UNKNOWN_ROUTE = "unknown"
FIELD_ROUTES = {"Airline": "skytrax", "icao24": "opensky"}
RECORD_KEY_SUFFIX = "_data"
BATCH_KEY = "aviation_data"
