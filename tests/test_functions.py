
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from flightlane.functions import temporal as t
from flightlane.functions import text as x


def one(spark, expression, **values):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return row.select(expression.alias("out")).first()["out"]


def test_session_is_utc(spark):
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"


def test_bad_times_become_null(spark):
    assert one(spark, t.iso_millis(t.parse_instant("a")), a="2025-01-25T11:00:00+01:00") == "2025-01-25T10:00:00.000Z"
    assert one(spark, t.parse_instant("a"), a="zzz") is None
    assert one(spark, t.date_text(t.parse_date("a")), a="2025-01-25") == "2025-01-25"
    assert one(spark, t.parse_date("a"), a="25/01/2025") is None


@pytest.mark.parametrize("end, hours, minutes", [
    ("2025-01-25T12:05:00Z", 2.1, 125.0),
    ("2025-01-25T09:05:00Z", -0.9, -55.0),
    ("2025-01-25T10:02:00Z", 0.0, 2.0),
    ("2025-01-25T10:03:00Z", 0.1, 3.0),
])
def test_durations(spark, end, hours, minutes):
    start, stop = t.parse_instant("a"), t.parse_instant("b")
    values = dict(a="2025-01-25T10:00:00Z", b=end)
    assert one(spark, t.duration_hours(start, stop), **values) == hours
    assert one(spark, t.duration_minutes(start, stop), **values) == minutes


def test_epoch_text(spark):
    assert one(spark, t.epoch_to_text("a"), a=1737799200) == "2025-01-25 10:00:00"
    assert one(spark, t.epoch_to_iso("a"), a=1737799200) == "2025-01-25T10:00:00.000Z"
    assert one(spark, t.epoch_to_text(F.col("a").cast("bigint")), a=None) is None


def test_ingest_stamp(spark):
    assert one(spark, t.ingest_stamp("2025-01-25 10:00:00.5")) == "2025-01-25T10:00:00.500000"
    stamps = spark.range(1000).select(t.ingest_stamp().alias("s")).distinct().count()
    assert stamps == 1


@pytest.mark.parametrize("text, number", [("5", 5), ("05", 5), ("N/A", None), ("", None), ("-1", None),
                                          ("1.0", None), ("99999999999", None), (None, None)])
def test_digits_to_int(spark, text, number):
    assert one(spark, x.digits_to_int(F.col("a").cast("string")), a=text) == number


@given(st.text(alphabet=st.sampled_from("a é\t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0  　"), max_size=8))
@settings(max_examples=25, deadline=None)
def test_strip_is_pythons(spark, text):
    assert one(spark, x.strip(F.col("a")), a=text) == text.strip()


@pytest.mark.parametrize("flag, result", [(False, True), (True, False), (None, False), ("false", True),
                                          ("true", False), (" FALSE ", True), ("0", False), ("no", False), ("f", False), ("n", False)])
def test_is_false(spark, flag, result):
    kind = "boolean" if isinstance(flag, bool) or flag is None else "string"
    assert one(spark, x.is_false(F.col("a").cast(kind)), a=flag) == result


def test_geopoint_is_never_null(spark):
    rows = spark.createDataFrame([(49.01, 2.55), (None, 2.55), (None, None)], "lat double, lon double")
    assert [r[0] for r in rows.select(x.geopoint("lat", "lon")).collect()] == ["49.01,2.55", "2.55", ""]


def test_record_json_keeps_nulls(spark):
    rows = spark.createDataFrame([(1, None)], "a int, b string")
    assert rows.select(x.record_json(["a", "b"])).first()[0] == '{"a":1,"b":null}'


def test_has_field_is_presence(spark):
    texts = ['{"icao24":null}', '{"x":1}', '{"x":{"icao24":1}}', "no json", None]
    rows = spark.createDataFrame([(v,) for v in texts], "v string")
    assert [r[0] for r in rows.select(x.has_field(F.col("v"), "icao24")).collect()] == [True, False, False, False, False]


def test_unescape(spark):
    import html

    texts = [["A &amp; B", "x"], ["&#233;&nbsp;&eacute;&ampx", None], ["plain"], None, []]
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(texts)], "i int, v array<string>")
    got = [r[0] for r in rows.orderBy("i").select(x.decode_entities(F.col("v"))).collect()]
    want = [[s if s is None else html.unescape(s) for s in v] if "&" in str(v) else None for v in texts]
    assert got == want
