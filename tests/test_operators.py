import json
import os
from collections import Counter
from concurrent.futures import ThreadPoolExecutor

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Observation
from pyspark.sql import functions as F

from flightlane.operators import documents as d
from flightlane.operators import lookup, messages, quality, reshape
from flightlane.operators.commits import CommitLog
from flightlane.operators.snapshots import SnapshotTable, index_schema

# --- reshape, quality


def test_explode_collect_is_identity(spark, rows):
    given_rows = [(1, [1, 2, None]), (2, []), (3, None), (4, [7])]
    df = spark.createDataFrame(given_rows, "id int, data array<int>")
    exploded = rows(reshape.explode_once(df, F.col("data"), "x", ["id"], pos="p"), "id", "p")
    assert [(r["id"], r["p"], r["x"]) for r in exploded] == [(1, 0, 1), (1, 1, 2), (1, 2, None), (4, 0, 7)]


def test_explode_once_computes_once(spark):
    df = spark.createDataFrame([('{"a":[1]}',)], "v string")
    parsed = df.select(F.from_json("v", "a array<int>")["a"].alias("array"))
    assert plan(reshape.explode_once(parsed, F.col("array"), "x")).count("from_json") == 1
    assert plan(parsed.select(F.explode("array"))).count("from_json") > 1


def test_settled_computes_once(spark, rows):
    df = spark.createDataFrame([("2025-01-25", 1), ("zzz", 2)], "v string, id int").withColumn("t", F.try_to_timestamp("v"))
    kept = reshape.settled(df, ["t"]).where("t is not null")
    assert kept.columns == df.columns and [r["id"] for r in rows(kept)] == [1]
    assert plan(kept).count("gettimestamp") + plan(kept).count("cast(v") <= 1


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_role_columns_and_preview(spark):
    dim = spark.createDataFrame([("a", 1.0)], "iata string, latitude double")
    assert reshape.role_columns(dim, "arrival", "iata").columns == ["iata", "arrival_latitude"]
    shown = reshape.preview(spark.range(100), [F.desc("id")], 3)
    assert [r["id"] for r in shown.collect()] == [99, 98, 97]
    assert "TakeOrderedAndProject" in plan(shown)


def test_gate_splits_every_row_once(spark):
    df = spark.createDataFrame([(1, None), (None, 1), (5, 5), (-5, 5)], "a int, b int")
    gate = quality.complete(["a", "b"], F.col("a") > 0)
    passed, rejected = quality.split_by_gate(df, gate)
    assert [tuple(r) for r in passed.collect()] == [(5, 5)] and rejected.count() == 3
    assert tuple(quality.write_report(df, gate).first()) == (1, 3)
    observation = Observation()
    assert quality.observe_gate(df, gate, observation).count() == 1
    assert observation.get == {"succeeded": 1, "failed": 3}


def test_drop_incomplete(spark):
    df = spark.createDataFrame([(1, None), (None, 1), (5, 5)], "a int, b int")
    assert quality.drop_incomplete(df).count() == 1
    assert quality.drop_incomplete(df, ["a"]).count() == 2


# --- lookups and counts

keys = st.one_of(st.none(), st.integers(0, 5))


@pytest.mark.parametrize("strategy", [None, "merge", "broadcast", "shuffle_hash"])
def test_lookup_is_a_left_join(spark, strategy):
    # key 1 holds a third of the rows, key 2 is listed twice, key 9 is unknown
    facts = spark.range(900).select("id", F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 3 == 1, 2).otherwise(F.when(F.col("id") > 450, 9)).alias("k"))
    dim = spark.createDataFrame([(1, "one"), (2, "two"), (2, "deux"), (5, "five"), (None, "none")], "key bigint, name string")
    got = Counter(tuple(r) for r in lookup.left_lookup(facts, dim, "k", "key", strategy).collect())
    names = {1: ["one"], 2: ["two", "deux"]}
    want = Counter((r["id"], r["k"], n) for r in facts.collect() for n in names.get(r["k"], [None]))
    assert got == want


@pytest.mark.parametrize("strategy", [None, "merge"])
def test_roles_share_a_dimension(spark, rows, strategy):
    flights = spark.createDataFrame([(1, "CDG", "LHR"), (2, "ZZZ", "CDG"), (3, None, "\\N")], "id int, a string, b string")
    dim = spark.createDataFrame([("CDG", 49.01), ("LHR", 51.47)], "iata string, latitude double")
    found = lookup.role_lookups(flights, dim, "iata", {"departure": "a", "arrival": "b"}, strategy)
    assert found.columns == ["id", "a", "b", "departure_latitude", "arrival_latitude"]
    assert [(r["departure_latitude"], r["arrival_latitude"]) for r in rows(found, "id")] == [(49.01, 51.47), (None, 49.01), (None, None)]


def test_lookup_runs_no_job_and_takes_a_dimension_of_keys_alone(spark):
    facts = spark.range(20).select(F.col("id").alias("k"))
    dim = spark.range(5).select(F.raise_error(F.lit("run")).cast("bigint").alias("key"))
    for strategy in (None, "merge"):
        assert lookup.left_lookup(facts, dim, "k", "key", strategy).columns == ["k"]
        assert lookup.left_lookup(facts, spark.range(5).toDF("key"), "k", "key", strategy).count() == 20
    assert "SortMergeJoin" in plan(lookup.left_lookup(facts, spark.range(5).toDF("key"), "k", "key", "merge"))


@given(st.lists(keys, max_size=30), st.sampled_from([None, "merge"]))
@settings(max_examples=12, deadline=None)
def test_group_count_is_the_window_count(spark, values, strategy):
    df = spark.createDataFrame(list(enumerate(values)), "id int, k int")
    counted = lookup.with_group_count(df, "k", "n", strategy)
    size = Counter(values)
    assert sorted((r["id"], r["k"], r["n"]) for r in counted.collect()) == [
        (i, k, 0 if k is None else size[k]) for i, k in enumerate(values)]


def test_count_has_no_window(spark):
    df = spark.range(1000).select("id", (F.col("id") % 7).alias("k"))
    assert "Window" not in plan(lookup.with_group_count(df, "k", "n"))
    assert "SortMergeJoin" in plan(lookup.with_group_count(df, "k", "n", "merge"))


# --- keyed documents


def docs(spark, *values):
    return spark.createDataFrame(list(values), "id string, a int, b string, at int")


def test_replace_takes_whole_documents(spark, rows):
    current = spark.createDataFrame([("x", 1, "old", "only here"), ("y", 2, "old", "stays")], "id string, a int, b string, extra string")
    incoming = docs(spark, ("x", 10, "first", 1), ("x", None, "second", 2), ("z", 3, "new", 1))
    got = {r["id"]: (r["a"], r["b"], r["extra"]) for r in rows(d.replace_documents(current, incoming, ["a", "b"], ["at"]))}
    assert got == {"x": (None, "second", None), "y": (2, "old", "stays"), "z": (3, "new", None)}


def test_merge_sets_supplied_fields_only(spark, rows):
    current = spark.createDataFrame([("x", 1, "only here"), ("y", 2, "stays")], "id string, a int, extra string")
    updates = docs(spark, ("x", None, "set", 5), ("x", 9, "older", 4), ("z", 3, "new", 1))
    merged = d.merge_documents(current, updates, ["a", "b"], ["at"])
    want = {"x": (None, "set", "only here"), "y": (2, None, "stays"), "z": (3, "new", None)}
    assert {r["id"]: (r["a"], r["b"], r["extra"]) for r in rows(merged)} == want
    again = d.merge_documents(merged, updates, ["a", "b"], ["at"])
    assert {r["id"]: (r["a"], r["b"], r["extra"]) for r in rows(again)} == want


def test_latest_by_reduces_before_the_shuffle(spark):
    df = spark.range(0, 10_000, 1, 4).select(F.lit("hot").alias("id"), F.col("id").alias("at"), F.col("id").alias("v"))
    latest = d.latest_by(df, ["id"], ["at"])
    assert latest.first()["v"] == 9999
    assert "partial_max" in plan(latest) and "Window" not in plan(latest)


@pytest.mark.parametrize("order", [["at"], ["ts", "at"], ["ts"], ["text"], ["ts", "text"]])
def test_latest_by_any_order_is_the_last_row(spark, rows, order):
    made = [(k, None if n % 7 == 0 else 1_700_000_000 + (n * 37) % 50, -n if n % 2 else n, f"{(n * 31) % 97:03d}") for n in range(400) for k in (None, f"k{n % 3}")]
    df = spark.createDataFrame(made, "k string, s long, at long, text string").withColumn("ts", F.timestamp_seconds("s"))
    names = ["k", "s", "at", "text", "ts"]
    found = {r["k"]: r for r in rows(d.latest_by(df, ["k"], order))}
    value = lambda r: tuple((r[names.index(o)] is not None, r[names.index(o)] or 0) for o in ["s" if o == "ts" else o for o in order])
    for key in {r[0] for r in made}:
        best = max(value(r) for r in made if r[0] == key)
        assert value([found[key][n] for n in names]) == best
    assert len(found) == 4


def test_payloads_of_the_last_rows_are_neither_sorted_nor_aggregated(spark):
    messages_ = spark.range(1000).select((F.col("id") % 5).alias("k"), F.timestamp_seconds("id").alias("ts"), "id", F.repeat(F.lit("x"), 100).alias("value"))
    for order in (["id"], ["ts", "id"]):
        text = plan(d.latest_by(messages_, ["k"], order, unique=True))
        assert "SortAggregate" not in text and "max_by" not in text and text.count("HashAggregate") == 2
    few = plan(d.latest_by(messages_, ["k"], ["id"], unique=True, few=True))
    assert "BroadcastHashJoin" in few and "Sort" not in few


def test_orders_that_tie_leave_one_row(spark):
    df = spark.range(100).select(F.lit(None).cast("string").alias("k"), F.lit(None).cast("long").alias("at"), F.col("id").alias("v"))
    assert d.latest_by(df, ["k"], ["at"]).count() == 1
    assert d.latest_by(df.where("v < 0"), ["k"], ["at"]).count() == 0


def test_latest_by_ranks_nulls_lowest(spark, rows):
    df = docs(spark, ("x", 1, "null rank", None), ("x", 2, "ranked", 0))
    assert rows(d.latest_by(df, ["id"], ["at"]))[0]["b"] == "ranked"


def test_actions_and_bulk_lines(spark):
    df = spark.createDataFrame([("ANA", 5, None)], "airline string, stars int, note string")
    line = d.bulk_lines(d.index_actions(df, "i", ["airline", "stars"], ["airline", "note"])).first()["value"].split("\n")
    assert [json.loads(part) for part in line] == [{"index": {"_index": "i", "_id": "ANA_5"}}, {"airline": "ANA", "note": None}]
    line = d.bulk_lines(d.upsert_actions(df, "i", ["airline", "stars"], ["stars"])).first()["value"].split("\n")
    assert [json.loads(part) for part in line] == [{"update": {"_index": "i", "_id": "ANA_5"}}, {"doc": {"stars": 5}, "doc_as_upsert": True}]


def test_random_ids(spark):
    tagged = d.append_actions(spark.range(0, 5000, 1, 8), "i", ["id"])
    ids = [r["id"] for r in tagged.select("id").collect()]
    assert len(set(ids)) == 5000 and {len(i) for i in ids} == {36}
    assert "Python" not in plan(d.tag_rows(spark.range(5)))


# --- snapshot table


def test_two_writers_of_one_version_do_not_both_win(spark, tmp_path, monkeypatch):
    df = spark.createDataFrame([("a",)], "id string")
    one, two = (SnapshotTable(spark, str(tmp_path / "t"), df.schema) for _ in range(2))
    checked = one._checked

    def meanwhile(rows):
        monkeypatch.setattr(one, "_checked", checked)
        two.replace(df.unionAll(df))
        return checked(rows)

    monkeypatch.setattr(one, "_checked", meanwhile)
    with pytest.raises(RuntimeError):
        one.replace(df)
    assert two.read().count() == one.read().count() == 2 and two.version() == 0


@pytest.mark.parametrize("way", ["_link", "_rename"])
def test_a_commit_number_is_created_once(spark, tmp_path, way):
    log = CommitLog(spark, str(tmp_path / "with space" / "log"))
    log.create(0, {"n": 0})
    getattr(log, way)(f"{1:020d}.json", b'{"n": 1}')
    with pytest.raises(FileExistsError):
        getattr(log, way)(f"{1:020d}.json", b'{"n": 2}')
    assert log.numbers() == [0, 1] and log.newest() == {"n": 1}
    assert sorted(n for n in os.listdir(tmp_path / "with space" / "log") if not n.endswith(".crc")) == [f"{n:020d}.json" for n in (0, 1)]


def test_many_writers_at_once_have_one_winner(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path / "log"))

    def write(n):
        try:
            log.create(0, {"n": n})
            return n
        except FileExistsError:
            return None

    with ThreadPoolExecutor(8) as pool:
        won = [n for n in pool.map(write, range(40)) if n is not None]
    assert [log.newest()["n"]] == won


def test_a_writer_that_slept_through_retired_versions_loses(spark, tmp_path, monkeypatch):
    df = spark.createDataFrame([("a", 1)], "id string, v int")
    slow, fast = (SnapshotTable(spark, str(tmp_path / "t"), df.schema, keep=2) for _ in range(2))
    slow.create_if_absent()
    checked = slow._checked

    def meanwhile(rows):
        monkeypatch.setattr(slow, "_checked", checked)
        for _ in range(4):
            fast.replace(df.unionAll(df))
        return checked(rows)

    monkeypatch.setattr(slow, "_checked", meanwhile)
    with pytest.raises(RuntimeError):
        slow.replace(df)
    assert slow.version() == 4 and slow.read().count() == 2 and slow._log.numbers() == [3, 4]


def files_of(table):
    return {os.path.relpath(os.path.join(folder, name), table.path): os.stat(os.path.join(folder, name)).st_mtime_ns
            for folder, _, names in os.walk(f"{table.path}/data") for name in names if name.endswith(".parquet")}


def test_an_update_of_one_id_rewrites_one_bucket(spark, tmp_path, rows):
    df = spark.range(200).select(F.col("id").cast("string").alias("id"), F.col("id").alias("v"), F.lit(0).cast("long").alias("at"))
    table = SnapshotTable(spark, str(tmp_path / "t"), df.schema, buckets=8)
    table.replace(df)
    before, reader = files_of(table), table.read()
    assert len(before) == 8
    change = spark.createDataFrame([("17", -1, 5), ("17", -2, 4)], "id string, v long, at long")
    combine = lambda current, new: d.replace_documents(current, new, ["v", "at"], ["at"])
    assert table.update(change, combine) == 1
    after = files_of(table)
    assert set(before.items()) <= set(after.items()) and len(after) == 9
    assert {r["id"]: r["v"] for r in rows(table.read())} == {str(n): -1 if n == 17 else n for n in range(200)}
    assert reader.where("v < 0").count() == 0 and reader.count() == 200
    assert table.update(change.limit(0), combine) == 2 and len(files_of(table)) == 9
    # all rows of a bucket may go
    bucket = table.read().where(table.bucket() == 3)
    assert table.update(bucket, lambda current, new: current.join(new, "id", "left_anti")) == 3
    assert table.read().count() == 200 - bucket.count() > 0
    with pytest.raises(ValueError):
        SnapshotTable(spark, table.path, df.schema, buckets=4).read()


def test_updates_name_their_batch_and_old_versions_go(spark, tmp_path):
    df = spark.range(100).select(F.col("id").cast("string").alias("id"), F.col("id").alias("v"))
    table = SnapshotTable(spark, str(tmp_path / "t"), df.schema, buckets=4, keep=2)
    combine = lambda current, new: d.replace_documents(current, new, ["v"], ["v"])
    assert table.create_if_absent()
    for batch in range(5):
        new = df.where(f"id < 10 or id % 5 = {batch}").withColumn("v", F.col("v") + batch)
        assert table.update(new, combine, "stream", batch) == batch + 1
        assert table.update(new.withColumn("v", F.lit(-1).cast("long")), combine, "stream", batch) == batch + 1
    assert table.update(df, combine, "other", 0) == 6 and table.update(df.limit(1), combine, "stream", 3) == 5
    assert len(table._log.numbers()) == 2 and table.version() == 6
    named = {f for n in table._log.numbers() for f in table._log.read(n)["folders"].values()}
    assert {os.path.dirname(f).removeprefix("data/") for f in files_of(table)} == named
    assert table.read().agg(F.sum("v")).first()[0] == sum(range(100))


def test_snapshot_table(spark, tmp_path):
    df = spark.createDataFrame([("a", "1,2")], "id string, geopoint string")
    table = SnapshotTable(spark, str(tmp_path / "t"), index_schema(df.schema, {"geopoint": "geo_point"}))
    assert table.version() is None
    with pytest.raises(ValueError):
        table.read()
    assert table.create_if_absent() and table.read().count() == 0 and table.version() == 0
    assert table.replace(df) == 1 and not table.create_if_absent()
    assert table.replace(table.read().unionAll(table.read())) == 2 and table.read().count() == 2
    assert table.read().schema["geopoint"].metadata == {"index_type": "geo_point"}
    assert table.replace(df, "stream", 0) == 3 and table.read().count() == 1
    assert table.replace(df.unionAll(df), "stream", 0) == 3 and table.read().count() == 1
    with pytest.raises(ValueError):
        table.replace(df.withColumn("geopoint", F.lit(1)))
    with pytest.raises(ValueError):
        index_schema(df.schema, {"nowhere": "geo_point"})
    assert SnapshotTable(spark, table.path, table.schema).version() == 3


def test_uncommitted_version_is_not_seen(spark, tmp_path):
    df = spark.createDataFrame([("a",)], "id string")
    table = SnapshotTable(spark, str(tmp_path / "t"), df.schema)
    table.replace(df)
    df.unionAll(df).write.parquet(f"{table.path}/data/v1")
    assert table.read().count() == 1
    assert table.replace(df.limit(0)) == 1 and table.read().count() == 0


# --- messages


def test_pack_batches_is_bounded_and_whole(spark):
    df = spark.range(0, 1000, 1, 4).select("id", F.when(F.col("id") < 700, "hot").otherwise("cold").alias("source"))
    packed = messages.pack_batches(df, F.col("source"), ["id"], 7, max_bytes=600)
    got = packed.collect()
    assert max(len(r["value"]) for r in got) <= 620 and {r["key"] for r in got} == {"hot", "cold"}
    assert {r["batch"] for r in got} == {7}
    for key in ("hot", "cold"):
        parts = [r["part"] for r in got if r["key"] == key]
        assert len(set(parts)) == len(parts) == next(r["parts"] for r in got if r["key"] == key) > 4
    ids = [[v["id"] for v in json.loads(r["value"])] for r in got]
    assert all(part == sorted(part) for part in ids)
    assert sorted(i for part in ids for i in part) == list(range(1000))
    assert messages.pack_batches(df.limit(0), "s", ["id"]).count() == 0


def test_small_batch_is_one_message(spark):
    df = spark.createDataFrame([("ANA", 5), ("BB", None)], "Airline string, Stars int").coalesce(1)
    message = messages.pack_batches(df, "Skytrax", ["Airline", "Stars"]).collect()
    assert [(r["key"], json.loads(r["value"])) for r in message] == [
        ("Skytrax", [{"Airline": "ANA", "Stars": 5}, {"Airline": "BB", "Stars": None}])]


def test_pack_records(spark):
    df = spark.createDataFrame([("ANA", None)], "Airline string, Stars int")
    assert tuple(messages.pack_records(df, "skytrax", ["Airline", "Stars"]).first()) == ("skytrax_data", '{"Airline":"ANA","Stars":null}')


def test_routes(spark):
    df = spark.createDataFrame([("Skytrax",), ("OpenSky",), ("foo",), (None,)], "key string")
    assert [r[0] for r in df.select(messages.route_by_key()).collect()] == ["skytrax", "opensky", "unknown", "unknown"]
    texts = ['{"icao24":null}', '{"x":1}', '{"icao24":"b","Airline":"A"}', "not json", '[{"Airline":"A"}]']
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    assert [r[0] for r in df.select(messages.route_by_field()).collect()] == ["opensky", None, "skytrax", None, None]


def test_whole_arrays_route_after_unpacking(spark, rows):
    df = spark.createDataFrame([('[{"Airline":"A"},{"Airline":"B"}]',), ('{"Airline":"C"}',), ("[]",), ("no",)], "value string")
    assert [r["Airline"] for r in rows(messages.unpack_batches(df, "Airline STRING"), "Airline")] [-3:] == ["A", "B", "C"]


@pytest.mark.parametrize("text, valid", [
    ('{"k":1,"k":2}', True), ('{"k":1} trailing', False), ('{"k":1}{"k":2}', False), ('{"k":1},{"k":2}', False), ("[1],[2]", False),
    ("1],[2", False), ("[]", True), ("1", True), ('"a"', True), ("null", True), ("", False), (" ", False), ("]", False), ('{"k":', False)])
def test_what_is_json(spark, text, valid):
    df = spark.createDataFrame([(text,)], "value string")
    assert messages.parse_payload(df, "k BIGINT").first()["is_json"] == valid


def test_rejects(spark, rows):
    texts = ['{"k":1}', '{"k":', None, "  ", '{"k":1} x', '{"k":"x","j":2}', "[1]", "null"]
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    good, bad = messages.split_rejects(messages.parse_payload(df, "k BIGINT, j INT"))
    assert [r["payload"] for r in rows(good)] == [{"k": 1, "j": None}, {"k": None, "j": 2}, None, None]
    assert [(r["value"], r["reason"]) for r in rows(bad)] == [
        ('{"k":', "cut or no JSON"), (None, "no text"), ("  ", "empty text"), ('{"k":1} x', "more behind the text")]
    good, bad = messages.split_rejects(messages.parse_payload(df, "k BIGINT, j INT"), strict=True)
    assert [r["value"] for r in rows(good)] == ['{"k":1}', "null"]
    assert {r["value"] for r in rows(bad) if r["reason"] == "field of another type"} == {'{"k":"x","j":2}', "[1]"}


def test_a_text_is_parsed_once(spark):
    df = spark.createDataFrame([("{}",)], "value string")
    good, _ = messages.split_rejects(messages.parse_payload(df, "k BIGINT"))
    assert plan(good).count("from_json") == 1
