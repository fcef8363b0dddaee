import glob
import os

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from flightlane.operators import bulk
from flightlane.operators import documents as d
from flightlane.operators.quality import write_report

ACTION = '{"index":{"_index":"t","_id":"%s"}}\n{"id":%s}'


def lines(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def batch(*values):
    return pa.RecordBatch.from_arrays([pa.array(values, pa.string())], names=["value"])


def test_chunks_hold_bounded_bytes_and_all_actions(spark, tmp_path):
    long = '{"index":{}}\n{"text":"%s"}' % ("é" * 900)
    values = [ACTION % (n, n) for n in range(200)] + [long] * 3
    path = str(tmp_path / "bulk")
    assert bulk.write_bulk(lines(spark, values).repartition(3), path, "r", 500) == {"succeeded": 203, "failed": 0}
    chunks = glob.glob(f"{path}/chunks/attempt=r-*/*.ndjson")
    for name in chunks:
        text = open(name, encoding="utf-8").read()
        assert os.path.getsize(name) <= 500 or text == long + "\n"
    assert len(chunks) > 10
    assert sorted(r.value for r in bulk.read_bulk(spark, path).collect()) == sorted(values)


def test_a_repeated_run_adds_nothing_and_keeps_its_report(spark, tmp_path):
    path = str(tmp_path)
    first = bulk.write_bulk(lines(spark, [ACTION % (1, 1), None]), path, "r1")
    again = bulk.write_bulk(lines(spark, [ACTION % (2, 2)] * 5), path, "r1")
    other = bulk.write_bulk(lines(spark, [ACTION % (1, 1)]), path, "r2")
    assert (first, again, other) == ({"succeeded": 1, "failed": 1}, first, {"succeeded": 1, "failed": 0})
    assert sorted(tuple(r) for r in bulk.read_bulk(spark, path).collect()) == [("r1", ACTION % (1, 1)), ("r2", ACTION % (1, 1))]


def test_attempts_that_are_not_committed_are_never_read(spark, tmp_path):
    path = str(tmp_path)
    writer = bulk.BulkWriter(path, "r", 1000)
    lost, good = writer.write(iter([batch(ACTION % (1, 1))])), writer.write(iter([batch(ACTION % (1, 1)), batch()]))
    writer.commit([good, None])
    late = bulk.BulkWriter(path, "r", 1000)
    second = late.write(iter([batch(ACTION % (1, 1))]))
    late.commit([second])  # the run of another driver was there first
    assert os.path.isdir(f"{path}/chunks/attempt={lost.attempt}") and not os.path.isdir(f"{path}/chunks/attempt={second.attempt}")
    assert [r.value for r in bulk.read_bulk(spark, path).collect()] == [ACTION % (1, 1)]
    assert [tuple(r) for r in bulk.bulk_reports(spark, path).collect()] == [("r", 1, 0)]


def test_an_aborted_write_leaves_no_chunks(tmp_path):
    writer = bulk.BulkWriter(str(tmp_path), "r", 1000)
    sent = writer.write(iter([batch(ACTION % (1, 1), "no document", None)]))
    assert (sent.chunks, sent.succeeded, sent.failed) == (1, 1, 2)
    writer.abort([sent, None])
    assert not os.path.isdir(f"{tmp_path}/chunks/attempt={sent.attempt}") and not writer.committed()


def test_a_failing_job_commits_nothing(spark, tmp_path):
    bad = spark.range(20).repartition(4).select(F.when(F.col("id") < 19, F.lit(ACTION % (1, 1))).otherwise(F.raise_error(F.lit("stop"))).alias("value"))
    with pytest.raises(Exception, match="stop"):
        bulk.write_bulk(bad, str(tmp_path), "r")
    assert not os.path.exists(tmp_path / "commits")
    assert bulk.write_bulk(lines(spark, [ACTION % (1, 1)]), str(tmp_path), "r")["succeeded"] == 1
    assert bulk.read_bulk(spark, str(tmp_path)).count() == 1


def test_an_empty_table_is_a_run_without_actions(spark, tmp_path):
    assert bulk.write_bulk(lines(spark, []), str(tmp_path), "r") == {"succeeded": 0, "failed": 0}
    assert bulk.write_bulk(lines(spark, [None]), str(tmp_path), "none") == {"succeeded": 0, "failed": 1}
    assert bulk.read_bulk(spark, str(tmp_path)).count() == 0


def test_counts_equal_the_report_of_the_gate_and_documents_come_back(spark, tmp_path):
    rows = spark.createDataFrame([(n, None if n % 5 == 0 else f'a "{n}"\n', n % 7 if n % 3 else None) for n in range(300)], "n int, name string, stars int")
    gate = F.col("stars") > 2
    for run, actions in (("i", d.index_actions(rows, "t", ["n"], ["n", "name", "stars"], ["stars"])),
                         ("u", d.upsert_actions(rows, "t", ["n"], ["n", "name", "stars"], ["stars"]))):
        counts = bulk.write_bulk(d.bulk_lines(actions, gate), str(tmp_path), run)
        assert counts == write_report(rows, gate).first().asDict()
        sent = bulk.read_bulk(spark, str(tmp_path)).where(F.col("run") == run)
        back = bulk.sent_documents(sent, actions.schema["source"].dataType, ["run"])
        expected = rows.where(gate).select(F.lit(run), F.lit("index" if run == "i" else "update"), F.lit("t"), F.col("n").cast("string"), "n", "name", "stars")
        assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, expected.collect()), key=str)


def test_what_the_sink_does_not_take(spark, tmp_path):
    spark.dataSource.register(bulk.BulkSink)
    writer = lines(spark, [ACTION % (1, 1)]).write.format("bulk").option("path", str(tmp_path))
    for attempt in (writer.mode("overwrite"), writer.mode("append").option("run", "../other")):
        with pytest.raises(Exception, match="bulk sink appends|name of a run"):
            attempt.save()
    with pytest.raises(Exception, match="bulk sink appends"):
        spark.range(1).write.format("bulk").mode("append").option("path", str(tmp_path)).save()


@settings(max_examples=50, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=30)), max_size=40), st.integers(1, 80))
def test_every_value_is_sent_or_failed(tmp_path_factory, values, chunk_bytes):
    path = str(tmp_path_factory.mktemp("bulk"))
    sent = bulk.BulkWriter(path, "r", chunk_bytes).write(iter([batch(*values)]))
    good = [v for v in values if v is not None and v.count("\n") == 1]
    names = sorted(glob.glob(f"{path}/chunks/*/*"))
    assert b"".join(open(n, "rb").read() for n in names) == "".join(v + "\n" for v in good).encode()
    assert (sent.succeeded, sent.failed, sent.chunks) == (len(good), len(values) - len(good), len(names))
