"""Files that survive a retry and are found by their key."""

import datetime as dt

from callweave.sources import readers, sinks


def test_a_batch_run_twice_is_one_batch_and_keeps_microseconds(spark, tmp_path, rows):
    at = dt.datetime(2026, 5, 4, 3, 2, 1, 123456)
    batch = lambda *ids: spark.createDataFrame([(i, at, "asr") for i in ids], "event_id string, recorded_at timestamp_ntz, stage string")
    for ids, n in ((("a", "b"), 0), (("c",), 1), (("c",), 1)):
        sinks.append_batch(batch(*ids), str(tmp_path / "ledger"), n)
    held = readers.ledger(spark, str(tmp_path / "ledger"), "event_id string, recorded_at timestamp_ntz, stage string")
    assert rows(held) == [(i, at, "asr") for i in "abc"]


def test_an_entity_is_read_from_its_bucket(spark, tmp_path, rows):
    docs = spark.createDataFrame([(f"C{i}", f'{{"n": {i}, "text": "line\\n{i}"}}') for i in range(40)] + [("C99", "broken")], "call_id string, body string")
    path = str(tmp_path / "corpus")
    sinks.write_corpus(docs, path, "call_id", "body", 8)
    everything = readers.corpus(spark, path, "n bigint, text string", buckets=8)
    assert everything.count() == 41 and {r.id for r in everything.where("n is null").collect()} == {"C99"}
    one = readers.corpus(spark, path, "n bigint, text string", "C7", 8)
    assert rows(one) == [("C7", 7, "line\n7")] and "PartitionFilters: [isnotnull(bucket" in one._jdf.queryExecution().toString()
    lines = spark.createDataFrame([(str(i % 5), f"C{i % 10}", i // 10, "agent", 61.0, f"t{i}") for i in range(100)], "lead string, call_id string, segment_id int, role string, start double, text string")
    sinks.write_transcript_buckets(lines.repartition(7), str(tmp_path / "txt"), 4)
    said = [r.value for r in readers.transcript(spark, str(tmp_path / "txt"), "3", 4).collect()]
    assert said == [f"3 C{c} [01:01] COUNSELLOR: t{c + 10 * k}" for c in (3, 8) for k in range(10)]
