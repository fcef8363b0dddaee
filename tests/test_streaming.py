import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from flightlane.operators.commits import CommitLog
from flightlane.operators.messages import route_by_key
from flightlane.operators.snapshots import SnapshotTable
from flightlane.sources.messages import MESSAGE_SCHEMA, stream_files
from flightlane.plans import streams
from flightlane.streaming import indexing, landing

ORDER = ["timestamp", "offset"]
BATCHES = [
    [("Skytrax", "s1", 0, 1, 100.0), ("OpenSky", "o1", 0, 2, 100.0), ("OpenSky", "o2", 0, 3, 100.5)],
    [("OpenSky", "o3", 0, 4, 101.0), ("foo", "u1", 0, 5, 101.0)],
    [("OpenSky", "late", 0, 0, 99.0)],
]


def write(spark, path, batch):
    df = spark.createDataFrame(batch, "key string, value string, partition int, offset bigint, t double")
    df.withColumn("timestamp", F.col("t").cast("timestamp")).drop("t").coalesce(1).write.mode("append").parquet(path)


@pytest.fixture
def folder(spark, tmp_path):
    path = str(tmp_path / "messages")
    for batch in BATCHES[:2]:
        write(spark, path, batch)
    return path


def routed(spark, folder):
    return stream_files(spark, folder, MESSAGE_SCHEMA, files_per_batch=1).withColumn("route", route_by_key())


def test_latest_over_restarts_is_the_batch_result(spark, folder, tmp_path):
    stream = routed(spark, folder)
    table = SnapshotTable(spark, str(tmp_path / "latest"), landing.latest_schema(stream, "route", ORDER), buckets=4, key="route")
    table.create_if_absent()
    landing.stream_latest(stream, table, "route", ORDER).awaitTermination()
    assert table.version() == 2
    assert {r["route"]: r["value"] for r in table.read().collect()} == {"skytrax": "s1", "opensky": "o3", "unknown": "u1"}

    write(spark, folder, BATCHES[2])
    landing.stream_latest(routed(spark, folder), table, "route", ORDER).awaitTermination()
    batch = landing.latest_per_source(spark.read.parquet(folder).withColumn("route", route_by_key()), "route", ORDER)
    streamed = sorted(map(str, table.read().select(*batch.columns).collect()))
    assert table.version() == 3 and streamed == sorted(map(str, batch.collect()))

    landing.stream_latest(routed(spark, folder), table, "route", ORDER).awaitTermination()
    assert table.version() == 3


def test_a_batch_that_was_committed_already_and_other_writers_do_not_stop_the_stream(spark, folder, tmp_path, monkeypatch):
    table = SnapshotTable(spark, str(tmp_path / "latest"), landing.latest_schema(routed(spark, folder), "route", ORDER), buckets=4, key="route")
    update, killed = table.update, []
    table.create_if_absent()

    def commit_and_die(*rows, **which):
        done = update(*rows, **which)
        if not killed:
            killed.append(1)
            raise RuntimeError("killed behind the commit")
        return done

    monkeypatch.setattr(table, "update", commit_and_die)
    with pytest.raises(StreamingQueryException):
        landing.stream_latest(routed(spark, folder), table, "route", ORDER).awaitTermination()
    monkeypatch.setattr(table, "update", update)
    landing.stream_latest(routed(spark, folder), table, "route", ORDER).awaitTermination()
    table.replace(table.read())
    write(spark, folder, BATCHES[2])
    landing.stream_latest(routed(spark, folder), table, "route", ORDER).awaitTermination()
    batch = landing.latest_per_source(spark.read.parquet(folder).withColumn("route", route_by_key()), "route", ORDER)
    assert sorted(map(str, table.read().select(*batch.columns).collect())) == sorted(map(str, batch.collect()))


def test_a_micro_batch_rewrites_the_buckets_of_its_sources_only(spark, tmp_path):
    path, table_path = str(tmp_path / "in"), str(tmp_path / "t")
    write(spark, path, [(f"k{n}", f"v{n}", 0, n, 100.0 + n) for n in range(100)])
    read = lambda: stream_files(spark, path, MESSAGE_SCHEMA)
    table = SnapshotTable(spark, table_path, landing.latest_schema(read(), "key", ORDER), buckets=16, key="key")
    table.create_if_absent()
    landing.stream_latest(read(), table, "key", ORDER).awaitTermination()
    first = table._log.newest()["folders"]
    write(spark, path, [("k7", "new", 0, 200, 300.0), ("k7", "old", 0, 201, 1.0)])
    landing.stream_latest(read(), table, "key", ORDER).awaitTermination()
    second = table._log.newest()["folders"]
    assert len(first) == len(second) == 16 and sum(first[b] != second[b] for b in first) == 1
    batch = landing.latest_per_source(spark.read.parquet(path), "key", ORDER)
    assert sorted(map(str, table.read().select(*batch.columns).collect())) == sorted(map(str, batch.collect()))
    with pytest.raises(ValueError):
        landing.stream_latest(read(), SnapshotTable(spark, table_path, table.schema, 16, "value"), "key", ORDER)


def parts_of(source, batch, parts, only=None):
    return [(source, batch, f"0-{n}", parts, f'[{{"id":{batch * 100 + n}}}]') for n in range(parts) if only is None or n in only]


def send(spark, path, messages):
    spark.createDataFrame(messages, "key string, batch long, part string, parts long, value string").repartition(3).write.mode("append").parquet(path)


def ids_in(spark, path):
    return sorted(r["id"] for r in spark.read.schema("id long").json(path).collect())


def test_batches_land_when_all_their_parts_are_there(spark, tmp_path):
    topic, out = str(tmp_path / "topic"), str(tmp_path / "out")
    rounds = [
        # batch 9 whole, two parts of 10, of another source a part alone
        parts_of("a", 9, 3) + parts_of("a", 10, 4, {0, 3}) + parts_of("b", 1, 2, {0}),
        # a part of 10 again, and the first one of 11
        parts_of("a", 10, 4, {0, 1}) + parts_of("a", 11, 2, {0}),
        parts_of("a", 10, 4, {2}) + parts_of("a", 8, 1),
        parts_of("b", 1, 2, {0}), parts_of("c", 1, 1), parts_of("b", 1, 2, {1}),
    ]
    seen = []
    for messages in rounds:
        send(spark, topic, messages)
        stream = spark.readStream.schema("key string, batch long, part string, parts long, value string").parquet(topic)
        landing.stream_batches(stream, out, str(tmp_path / "cp"), F.col("key"), patience=4).awaitTermination()
        seen.append(ids_in(spark, landing.object_path(f"{out}/lake", "a_data.json")))
    assert seen[0] == seen[1] == [900, 901, 902] and all(s == [1000, 1001, 1002, 1003] for s in seen[2:])
    schema = "key string, batch long, part string, reason string"
    rejects = [tuple(r) for n in range(6) for r in spark.read.schema(schema).parquet(f"{out}/rejects/batch={n}").select("batch", "key", "part", "reason").collect()]
    # batch 1 of b came in micro-batch 0 and went in 4; the part that came in 5 starts it anew; 11 of a came in 1
    assert sorted(rejects) == [(1, "b", "0-0", "still incomplete")] * 2 + [(11, "a", "0-0", "still incomplete")]
    left = spark.read.parquet(f"{out}/waiting/5")
    assert sorted((r["key"], r["batch"], r["part"]) for r in left.collect()) == [("b", 1, "0-1")]
    assert ids_in(spark, landing.object_path(f"{out}/lake", "c_data.json")) == [100]
    with pytest.raises(ValueError):
        landing.stream_objects(stream, out, ["batch"], out, F.col("key"))


def test_incomplete_batches_go_when_a_later_one_is_whole(spark, tmp_path):
    topic, out = str(tmp_path / "topic"), str(tmp_path / "out")
    send(spark, topic, parts_of("a", 9, 2, {0}) + parts_of("a", 10, 2))
    stream = spark.readStream.schema("key string, batch long, part string, parts long, value string").parquet(topic)
    landing.stream_batches(stream, out, str(tmp_path / "cp"), F.col("key")).awaitTermination()
    assert [(r["batch"], r["reason"]) for r in spark.read.parquet(f"{out}/rejects/batch=0").collect()] == [(9, "a later batch is whole")]


def test_last_whole_batch_in_batch(spark):
    rows = parts_of("a", 9, 3) + parts_of("a", 10, 2) + parts_of("a", 10, 2, {1}) + parts_of("a", 11, 5, {0, 1, 2, 3}) + parts_of("b", 2, 2, {0}) + parts_of(None, 1, 1)
    df = spark.createDataFrame(rows, "key string, batch long, part string, parts long, value string")
    found = landing.latest_batches(df, "key").collect()
    assert sorted((str(r["key"]), r["batch"], r["part"]) for r in found) == [("None", 1, "0-0"), ("a", 10, "0-0"), ("a", 10, "0-1")]


def test_keys_of_the_history_come_back_as_they_are(spark, tmp_path):
    keys = ["001", "002", "", None, "a/b=c", "k_none"]
    rows = spark.createDataFrame([(k, "v", n) for n, k in enumerate(keys)], "key string, value string, epoch_second bigint")
    landing.land_history(rows, str(tmp_path / "h"), "key")
    assert {r["epoch_second"]: r["key"] for r in landing.read_history(spark, str(tmp_path / "h"), "key", ["value"]).collect()} == dict(enumerate(keys))


def test_routes_by_field(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    for values in (['{"icao24":null}', '{"x":1}'], ['{"Airline":"A","icao24":"b"}', "not json"], ['{"icao24":"c"}']):
        write(spark, source, [("k", v, 0, 1, 1.0) for v in values])
    landing.stream_routes(stream_files(spark, source, files_per_batch=1), out, str(tmp_path / "cp")).awaitTermination()
    landed = {(r["route"], r["value"]) for r in landing.read_routes(spark, out).collect()}
    assert landed == {("opensky", '{"icao24":null}'), ("skytrax", '{"Airline":"A","icao24":"b"}'), ("opensky", '{"icao24":"c"}')}
    last = landing.read_routes(spark, out, latest_only=True).groupBy("route").count().collect()
    assert {r["route"]: r["count"] for r in last} == {"opensky": 1, "skytrax": 1}


def test_history(spark, folder, tmp_path):
    out = str(tmp_path / "history")
    landing.stream_history(routed(spark, folder), out, "route", ORDER, str(tmp_path / "cp")).awaitTermination()
    read = landing.read_history(spark, out, "route", ORDER)
    assert sorted((r["route"], r["epoch_second"], r["value"]) for r in read.collect()) == [
        ("opensky", 100, "o2"), ("opensky", 101, "o3"), ("skytrax", 100, "s1"), ("unknown", 101, "u1")]


def test_landed_history_settles_two_runs(spark, folder, tmp_path):
    out = str(tmp_path / "history")
    history = landing.history_per_second(spark.read.parquet(folder), "key", ORDER)
    landing.land_history(history, out, "key")
    landing.land_history(history, out, "key")
    assert landing.read_history(spark, out, "key", ORDER).count() == history.count() == 4


def test_a_stream_into_an_index_that_dies_at_any_step_leaves_each_micro_batch_once(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "job")
    value = '{{"icao24":"{0}","origin_country":"F","time_position":1737799200,"longitude":{1},"latitude":1.0,"altitude":1.0,"on_ground":{2},' \
            '"velocity":1.0,"heading":1.0,"vertical_rate":1.0,"squawk":"7"}}'
    rounds = [[("a", 1, "false"), ("b", 2, "false"), ("c", 3, "true")], [("a", 4, "false"), ("d", 5, "false")]]
    for n, rows in enumerate(rounds):
        write(spark, f"{path}/topic", [("OpenSky", value.format(*r), 0, 10 * n + i, 1.0) for i, r in enumerate(rows)])
    # the second try dies before the commit, the third one behind it
    dies = {"before": True, "behind": True}
    create = CommitLog.create

    def dying(self, number, commit):
        if number == 1 and dies.pop("before", None):
            raise RuntimeError("killed before the commit")
        create(self, number, commit)
        if number == 2 and dies.pop("behind", None):
            raise RuntimeError("killed behind the commit")

    monkeypatch.setattr(CommitLog, "create", dying)
    for _ in range(3):
        table, stream = streams.stream_states(stream_files(spark, f"{path}/topic", files_per_batch=1), path)
        try:
            stream.awaitTermination()
        except StreamingQueryException:
            pass
    assert not dies and table.version() == 2
    assert sorted((r["icao24"], r["longitude"]) for r in table.read().collect()) == [("a", 4.0), ("b", 2.0), ("d", 5.0)]
    assert sorted(tuple(r) for r in indexing.read_reports(spark, path).collect()) == [(0, 2, 1), (1, 2, 0)]


def test_rejects_of_routes_say_why(spark, tmp_path):
    source, out, rejects = (str(tmp_path / name) for name in ("in", "out", "rejects"))
    write(spark, source, [("k", v, 0, 1, 1.0) for v in ['{"icao24":1}', '{"x":1}', "no", "", None]])
    landing.stream_routes(stream_files(spark, source), out, str(tmp_path / "cp"), rejects=rejects).awaitTermination()
    assert sorted((str(r["value"]), r["reason"]) for r in spark.read.parquet(rejects).collect()) == [
        ("", "empty text"), ("None", "no text"), ("no", "cut or no JSON"), ('{"x":1}', "no field of a route")]
