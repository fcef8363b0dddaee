import json

import pytest

from pyspark.sql import functions as F

from flightlane.fixed_values import AIRPORT_SCHEMA, FLIGHT_DOCUMENT_SCHEMA, RATING_FILE_SCHEMA, STATE_FILE_SCHEMA
from flightlane.session import object_store_settings
from flightlane.sources.files import read_dimension, read_json
from flightlane.sources import html_tables
from flightlane.sources.html_tables import element, extract_links, extract_ratings
from flightlane.sources.messages import decode_messages, topic_options
from flightlane.sources.vectors import decode_vectors, with_vectors
from registry import inputs


def test_multiline_document_and_array(spark, tmp_path, rows):
    document = tmp_path / "document.json"
    document.write_text(json.dumps({"pagination": {"limit": 1}, "data": [{"flight_date": "2025-01-25"}]}, indent=2))
    read = read_json(spark, str(document), FLIGHT_DOCUMENT_SCHEMA, multiline=True)
    assert read.columns == ["data"]
    assert read.select(F.inline("data")).first()["flight_date"] == "2025-01-25"

    array = tmp_path / "array.json"
    array.write_text(json.dumps([{"Airline": "ANA", "Stars": 5, "URL": "u"}, {"Airline": "BB", "Stars": None}], indent=2))
    assert rows(read_json(spark, str(array), RATING_FILE_SCHEMA, multiline=True)) == [
        {"Airline": "ANA", "Stars": 5, "URL": "u"}, {"Airline": "BB", "Stars": None, "URL": None}]


def test_lines_hold_objects_or_arrays(spark, tmp_path):
    lines = tmp_path / "lines.json"
    lines.write_text('[{"Airline":"A"},{"Airline":"B"}]\n{"Airline":"C"}\n[]\n')
    read = read_json(spark, str(lines), RATING_FILE_SCHEMA)
    assert sorted(r["Airline"] for r in read.collect()) == ["A", "B", "C"]


def test_states_of_drifting_types(spark, tmp_path, rows):
    file = tmp_path / "states.json"
    file.write_text('[{"icao24":"a","squawk":1234.5,"on_ground":false},{"icao24":"b","squawk":"77","time_position":1}]')
    read = rows(read_json(spark, str(file), STATE_FILE_SCHEMA, multiline=True), "icao24")
    assert [(r["squawk"], r["on_ground"], r["time_position"]) for r in read] == [("1234.5", False, None), ("77", None, 1)]


def test_dimension_keeps_backslash_n(spark, tmp_path, rows):
    file = tmp_path / "airports.dat"
    file.write_text('1,"Roissy, CDG","Paris","France","CDG","LFPG",49.01,2.55,392,1,"E","Europe/Paris","airport","x"\n'
                    '2,"Strip","X","Y",\\N,\\N,1.5,2.5,10,5.5,"E",\\N,"airport","x"\n')
    read = rows(read_dimension(spark, str(file), AIRPORT_SCHEMA), "airport_id")
    assert [(r["iata"], r["latitude"], r["timezone_offset"]) for r in read] == [("CDG", 49.01, 1), ("\\N", 1.5, None)]
    assert read_dimension(spark, str(file), AIRPORT_SCHEMA, ["iata"]).columns == ["iata"]


FULL = ["abc", "CS1 ", "France", 1737799200, 1737799201, 2.55, 49.01, 1000.5, False, 200, 90.0, -1.5, None, "1234", False]


def payloads(spark, *states):
    values = [json.dumps({"time": 1, "states": s}) if s != "missing" else '{"time":1}' for s in states]
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "fetch int, value string")


def test_vectors(spark, rows):
    df = payloads(spark, [FULL, ["x"]], None, [], "missing")
    full, short = rows(decode_vectors(df, keep=["fetch"]), F.desc("callsign"))
    assert full == {"fetch": 0, "icao24": "abc", "callsign": "CS1 ", "origin_country": "France", "time_position": 1737799200,
                    "last_contact": 1737799201, "longitude": 2.55, "latitude": 49.01, "altitude": 1000.5,
                    "on_ground": False, "velocity": 200.0, "heading": 90.0, "vertical_rate": -1.5,
                    "geo_altitude": None, "squawk": "1234", "spi": "false"}
    assert short["icao24"] == "x" and all(v is None for k, v in short.items() if k not in ("fetch", "icao24"))


def test_vector_cap_is_per_payload(spark):
    df = payloads(spark, [[f"a{i}"] for i in range(100)], [[f"b{i}"] for i in range(10)])
    counts = {r["fetch"]: r["n"] for r in decode_vectors(df, keep=["fetch"], cap=50).groupBy("fetch").agg(F.count("*").alias("n")).collect()}
    assert counts == {0: 50, 1: 10}
    first = with_vectors(df, cap=50).orderBy("fetch").first()["vectors"]
    assert [v["icao24"] for v in first] == [f"a{i}" for i in range(50)]
    assert decode_vectors(df).count() == 110


PAGE = """<html><!-- <table id="tablepress-1"><tbody><tr><td class="column-2"><a href="z">No</a></td></tr></tbody></table> -->
<table id="other"><tbody><tr><td class="column-1">1</td><td class="column-2"><a href="o">Other</a></td></tr></tbody></table>
<TABLE class='x' data-id="tablepress-1"><tbody><tr><td class="column-2"><a href="d">Data</a></td></tr></tbody></TABLE>
<table title="x > y" class="t" id="tablepress-1"><thead><tr><th class="column-1">S</th></tr></thead><tbody class="b">
<tr class="row-2"><td class="column-1"><b> 5 </b></td><td class="column-2"><a title="a > b" href="/ana"> ANA
 </a></td></tr>
<tr><td class="column-1">N/A</td><td class="column-2"><a href='/bb'>BB</a> tail</td></tr>
<tr><td class="column-1">3</td><td class="column-2">no link</td></tr>
<tr><td class="column-1">&nbsp;4&nbsp;</td><td class="column-2"><a>No <i>href</i></a></td></tr>
<tr><td class="column-1">2</td><td class="column-2 extra"><a href="/a?x=1&amp;y=2">A &amp; B</a><a href="/q">Q</a></td></tr>
<tr><td class="column-10">9</td><td class="wide column-2"><a href=/c>C</a></td></tr>
</tbody></table></html>"""


def test_ratings_page(spark, rows):
    pages = spark.createDataFrame([(1, PAGE), (2, "<p>tablepress-1</p>"), (3, "nothing"), (4, None)], "page int, html string")
    got = {r["Airline"]: (r["Stars"], r["URL"]) for r in rows(extract_ratings(pages, keep=["page"]))}
    assert got == {"ANA": (5, "/ana"), "BB": (None, "/bb"), "No href": (4, ""), "A & B": (2, "/a?x=1&y=2"), "C": (None, "/c")}
    assert extract_ratings(pages, with_url=False).columns == ["Airline", "Stars"]


def test_long_markup(spark, rows):
    words = "it's 1 < 2 " * 20_000
    page = f'<p>{words}</p><table id="tablepress-1"><tbody>' + "".join(
        f'<tr><td class="column-1">{i % 6}</td><td class="column-2"><a href="/{i}">N{i} <b>{words[:2000]}</b></a></td></tr>'
        for i in range(300)) + "</tbody></table>"
    got = rows(extract_ratings(spark.createDataFrame([(page,)], "html string")))
    assert [(r["Airline"].split()[0], r["Stars"], r["URL"]) for r in got] == [(f"N{i}", i % 6, f"/{i}") for i in range(300)]
    assert {r["Airline"].split(" ", 1)[1] for r in got} == {words[:2000].strip()}


def test_links(spark, rows):
    html = '<nav><ul><li><a href="/x">X</a></li><li>none</li><li class="l"><a href="/y">Y</a></li></ul></nav><li><a href="/z">Z</a></li>'
    pages = spark.createDataFrame([(1, html)], "page int, html string")
    assert rows(extract_links(pages, [element("nav")], element("li"), ["page"])) == [
        {"page": 1, "pos": 0, "text": "X", "href": "/x"}, {"page": 1, "pos": 2, "text": "Y", "href": "/y"}]


def test_message_options_and_decoding(spark, rows):
    assert topic_options("b:1", "t") == {"kafka.bootstrap.servers": "b:1", "subscribe": "t", "startingOffsets": "earliest"}
    raw = spark.range(1).selectExpr("cast('k' as binary) key", "cast('é' as binary) value", "0 partition", "1L offset",
                                    "timestamp'2025-01-25 10:00:00' timestamp", "'t' topic")
    assert rows(decode_messages(raw).select("key", "value")) == [{"key": "k", "value": "é"}]


def test_object_store_settings():
    settings = object_store_settings("http://store:1")
    assert settings["spark.hadoop.fs.s3a.endpoint"] == "http://store:1"
    assert settings["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "false"


TABLE = '<table id="tablepress-1"><thead><tr><th>H</th></tr></thead><tbody>{}</tbody></table>'
ROW = '<tr><td class="column-1">{}</td><td class="column-2"><a href="/{}">{}</a></td></tr>'


@pytest.mark.parametrize("page, expected", [
    (TABLE.format(ROW.format(5, "a", "ANA") + ROW.format(4, "b", "B")).replace("</td>", "").replace("</tr>", ""), [("ANA", 5, "/a"), ("B", 4, "/b")]),
    (TABLE.format(ROW.format(5, "a", "ANA")).replace("<a href", '<table><tbody><tr><td class="column-1">1<td></table><a href'), [("ANA", 5, "/a")]),
    (TABLE.format(ROW.format(5, "a", "ANA")).partition("</a>")[0], [("ANA", 5, "/a")]),
    ("<table><tr><td>" + TABLE.format(ROW.format(5, "a", "ANA") + "</div></b></tr></td>") + "</td></tr></table>", [("ANA", 5, "/a")]),
    ("<!-- " + TABLE.format(ROW.format(1, "x", "no")) + " -->" + TABLE.format(ROW.format(5, "a", "ANA").replace("</tr>", "")), [("ANA", 5, "/a")]),
    ("<script>'<table id=\"tablepress-1\"><tbody><tr><td>'</script>" + TABLE.format(ROW.format(5, "a", "ANA")), [("ANA", 5, "/a")]),
    (TABLE.format(ROW.format(5, "a", "A<br>N<img src=x>A").replace("</td>", "")), [("ANA", 5, "/a")]),
    (TABLE.format(ROW.format(5, "a", "ANA") + "<tr>") + TABLE.format(ROW.format(4, "b", "second table")), [("ANA", 5, "/a")]),
    ("<p>tablepress-1<table><tr><td>", []), (TABLE.format("<tr><td"), []), ("tablepress-1" + "<td>" * 5000, []),
])
def test_tables_of_broken_markup(spark, page, expected):
    found = html_tables.extract_ratings(spark.createDataFrame([(page,)], "html string"))
    assert [(r["Airline"], r["Stars"], r["URL"]) for r in found.collect()] == expected


def test_patterns_of_ratings_run_once(spark):
    plan = extract_ratings(spark.createDataFrame([("x",)], "html string"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("<tbody") <= 2  # the count of tags and the region, each once


def test_inputs_of_few_bytes_fill_the_tasks(spark, rows):
    customers = spark.range(1_000).coalesce(1).selectExpr(
        "id as c_custkey", "concat('c', id) as c_name", "cast(id % 25 as int) as c_nationkey", "id * 1.5D as c_acctbal", "'m' as c_mktsegment")
    pages = inputs.rating_pages(customers)
    assert pages.rdd.getNumPartitions() >= 8 and sorted(r.c_custkey for r in pages.collect()) == list(range(1_000))
    events = spark.range(1_000).coalesce(1).selectExpr(
        "id as event_id", "timestamp_ntz'2024-01-01 00:00:00' as ts", "id as user_id", "'view' as event_type", "1.5D as value", "'{\"k\":1}' as props")
    payloads = inputs.vector_payloads(events)
    assert payloads.rdd.getNumPartitions() >= 8 and sorted(r.event_id for r in payloads.collect()) == list(range(1_000))
