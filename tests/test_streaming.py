"""Messages in, events and quarantine out."""

import datetime
import json

import pytest
from pyspark.sql import functions as F

from playthrough.schemas import EVENT_COLUMNS
from playthrough.sources import messages
from playthrough.sources.commits import CommittedTable
from playthrough.streaming import ingest as stream

GOOD = {
    "event_id": "e1", "event_ts": 1704067200000, "user_id": "u1", "content_id": "c1",
    "event_type": "play", "playback_position": 0, "device": "tv",
}


def line(**changes):
    found = {**GOOD, **changes}
    return json.dumps({k: v for k, v in found.items() if v != "absent"})


def parsed(spark, *lines):
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    return [r.asDict() for r in messages.parse_messages(df).collect()]


def test_good_message(spark):
    (row,) = parsed(spark, line(extra="ignored"))
    assert {c: row[c] for c in EVENT_COLUMNS} == GOOD and row["problem"] is None


@pytest.mark.parametrize(
    "text, problem",
    [
        ("not json", messages.NOT_JSON),
        (line()[:-4], messages.NOT_JSON),
        ("[1, 2]", messages.NOT_JSON),
        ("", messages.NOT_JSON),
        (line(device="absent"), messages.MISSING_KEY),
        (line(event_id=None), messages.NO_ID),
        (line(event_ts="yesterday"), messages.NOT_NUMERIC),
        (line(playback_position=10**12), messages.NOT_NUMERIC),
        (line(device=None), None),
        (line(event_ts=None), None),
    ],
)
def test_problems(spark, text, problem):
    assert parsed(spark, text)[0]["problem"] == problem


@pytest.mark.parametrize("position, stored", [(-0.5, 0), (12.9, 12), ("7", 7), (1e3, 1000)])
def test_numbers_are_truncated(spark, position, stored):
    assert parsed(spark, line(playback_position=position))[0]["playback_position"] == stored


class Folders:
    def __init__(self, root):
        self.source = root / "in"
        self.source.mkdir()
        self.table, self.quarantine, self.checkpoint = (str(root / n) for n in ("table", "bad", "ck"))

    def add(self, name, *lines):
        (self.source / name).write_text("\n".join(lines) + "\n")

    def run(self, spark, **options):
        query = stream.ingest(
            messages.file_messages(spark, str(self.source), max_files=1),
            table=self.table, quarantine=self.quarantine, checkpoint=self.checkpoint,
            trigger=stream.BACKLOG, **options,
        )
        query.awaitTermination()

    def stored(self, spark):
        return sorted((r["event_id"], r["event_ts"]) for r in spark.read.parquet(self.table).collect())


def test_ingest_skips_stored_ids_and_quarantines(spark, tmp_path):
    f = Folders(tmp_path)
    f.add("a", line(event_id="a", event_ts=2), line(event_id="a", event_ts=1), "broken", line(event_id="b"))
    f.run(spark)
    assert f.stored(spark) == [("a", 1), ("b", GOOD["event_ts"])]
    f.run(spark)  # nothing new
    f.add("b", line(event_id="a", event_ts=5), line(event_id="c", event_ts=6), line(device="absent"))
    f.run(spark)
    assert f.stored(spark) == [("a", 1), ("b", GOOD["event_ts"]), ("c", 6)]
    bad = spark.read.parquet(f.quarantine).groupBy("problem").count().collect()
    assert {r["problem"]: r["count"] for r in bad} == {messages.NOT_JSON: 1, messages.MISSING_KEY: 1}


def test_a_replayed_batch_replaces_itself(spark, tmp_path):
    f = Folders(tmp_path)
    batch = spark.createDataFrame([(line(event_id="a"),), (line(event_id="b"),)], "value string")
    for _ in range(2):
        stream.write_batch(stream.sort_messages(batch), 7, f.table, f.quarantine)
    assert [i for i, _ in f.stored(spark)] == ["a", "b"]


def test_large_batches_are_joined_by_shuffle(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(stream, "BROADCAST_IDS", 0)
    f = Folders(tmp_path)
    f.add("a", line(event_id="a", event_ts=1))
    f.run(spark)
    f.add("b", line(event_id="a", event_ts=2), line(event_id="b", event_ts=3))
    f.run(spark)
    assert f.stored(spark) == [("a", 1), ("b", 3)]


def test_ingest_of_clean_rows(spark, tmp_path):
    f = Folders(tmp_path)
    f.add("a", line(event_id="a", event_ts=1), line(event_id="b", event_type="PLAY"), line(event_id="c", device=""))
    f.run(spark, clean=True)
    assert f.stored(spark) == [("a", 1)]
    assert {r["problem"] for r in spark.read.parquet(f.quarantine).collect()} == {
        "invalid_event_type",
        "missing_field",
    }


def test_only_remembered_days_are_looked_up(spark, tmp_path):
    f = Folders(tmp_path)
    days = [datetime.date(2024, 3, d) for d in (1, 2, 9)]
    for k, day in enumerate(days):
        batch = spark.createDataFrame([(line(event_id="a", event_ts=k),), (line(event_id=f"x{k}", event_ts=k),)], "value string")
        stream.write_batch(stream.sort_messages(batch), k, f.table, f.quarantine, remember_days=3, today=day)
    assert f.stored(spark) == [("a", 0), ("a", 2), ("x0", 0), ("x1", 1), ("x2", 2)]


def test_a_batch_replayed_a_day_later_replaces_itself(spark, tmp_path):
    f = Folders(tmp_path)
    batch = spark.createDataFrame([(line(event_id="a"),), (line(event_id="b"),)], "value string")
    for day in (1, 2):
        stream.write_batch(stream.sort_messages(batch), 7, f.table, f.quarantine, 3, datetime.date(2024, 3, day))
    assert [i for i, _ in f.stored(spark)] == ["a", "b"]


def test_ingest_with_remembered_days(spark, tmp_path):
    f = Folders(tmp_path)
    f.add("a", line(event_id="a", event_ts=2), line(event_id="a", event_ts=1), line(event_id="b", event_ts=2), "broken")
    f.run(spark, remember_days=1)
    f.add("b", line(event_id="a", event_ts=3), line(event_id="c", event_ts=-5), "broken")
    f.run(spark, remember_days=1)
    assert f.stored(spark) == [("a", 1), ("b", 2), ("c", -5)]
    assert spark.read.parquet(f.quarantine).count() == 2


def test_many_batches_read_nothing_that_is_stored(spark, tmp_path, monkeypatch):
    """Twenty batches, each with an old id again: the ids are in the state, and the folders stay few."""
    read = []
    whole = CommittedTable.read

    def counting(self, folders=None):
        found = whole(self, folders)
        read.append(0 if found is None else found.count())
        return found

    monkeypatch.setattr(CommittedTable, "read", counting)
    f = Folders(tmp_path)
    for k in range(20):
        f.add(f"{k:02d}", line(event_id=f"e{k}", event_ts=k), line(event_id=f"e{k // 2}", event_ts=100), "broken")
    f.run(spark)
    # A batch without a new id, if its file came late, does not even ask.
    assert 15 <= len(read) <= 20 and sum(read) == 0
    monkeypatch.undo()
    table = CommittedTable(spark, f.table)
    assert sorted(r["event_id"] for r in stream.stored_events(spark, f.table).collect()) == sorted(f"e{k}" for k in range(20))
    assert len(table.folders()) <= 8 + 20 // 8 and CommittedTable(spark, f.quarantine).read().count() == 20


def test_what_other_streams_have_stored_is_looked_up(spark, tmp_path):
    f, g = Folders(tmp_path), None
    f.add("a", line(event_id="a", event_ts=1), line(event_id="b", event_ts=1))
    f.run(spark)
    g = Folders.__new__(Folders)
    g.source, g.table, g.quarantine, g.checkpoint = tmp_path / "in2", f.table, f.quarantine, str(tmp_path / "ck2")
    g.source.mkdir()
    g.add("a", line(event_id="a", event_ts=2), line(event_id="c", event_ts=2))
    g.run(spark, stream="second")
    assert f.stored(spark) == [("a", 1), ("b", 1), ("c", 2)]


def test_of_an_id_in_one_batch_the_oldest_event_stays(spark, tmp_path):
    f = Folders(tmp_path)
    f.add("a", *[line(event_id="x", event_ts=t, device=f"d{t}") for t in (5, 3, 9)], line(event_id="y", event_ts=None))
    f.run(spark)
    f.add("b", line(event_id="x", event_ts=1), line(event_id="y", event_ts=1))
    f.run(spark)
    rows = {r["event_id"]: (r["event_ts"], r["device"]) for r in stream.stored_events(spark, f.table).collect()}
    assert rows == {"x": (3, "d3"), "y": (None, "tv")}


def test_state_on_disk(spark, tmp_path):
    for key, value in stream.STATE_STORE.items():
        spark.conf.set(key, value)
    try:
        f = Folders(tmp_path)
        f.add("a", line(event_id="a", event_ts=1))
        f.run(spark)
        f.add("b", line(event_id="a", event_ts=2), line(event_id="b", event_ts=2))
        f.run(spark)
        assert f.stored(spark) == [("a", 1), ("b", 2)]
    finally:
        for key in stream.STATE_STORE:
            spark.conf.unset(key)


def test_publish_keeps_lines(spark, tmp_path):
    source, sink = tmp_path / "lines.json", str(tmp_path / "topic")
    source.write_text(line(event_id="a") + "\n" + line(event_id="b") + "\n")
    messages.publish(spark, str(source), "parquet", path=sink)
    sent = spark.read.parquet(sink).select(F.get_json_object("value", "$.event_id").alias("i")).collect()
    assert sorted(r["i"] for r in sent) == ["a", "b"]


def test_kafka_options(tmp_path):
    tls = messages.tls_options("ca", "crt", "k")
    options = messages.kafka_options("host:1", "t", tls=tls, group="g")
    assert options["startingOffsets"] == "latest" and "maxOffsetsPerTrigger" not in options
    assert options["kafka.security.protocol"] == "SSL"
    assert options["kafka.group.id"] == "g"
    assert messages.kafka_options("host:1", "t", max_per_trigger=5)["maxOffsetsPerTrigger"] == "5"


def test_tls_from_the_command_line(tmp_path):
    from playthrough.__main__ import parser, tls

    for name in ("ca", "certificate", "key"):
        (tmp_path / name).write_text(f"pem of {name}")
    files = [x for name in ("ca", "certificate", "key") for x in (f"--{name}", str(tmp_path / name))]
    a = parser().parse_args(["publish", "lines", "host:1", "topic", *files])
    assert tls(a)["kafka.ssl.keystore.key"] == "pem of key"
    a = parser().parse_args(["ingest", "topic", "t", "q", "c", "--servers", "host:1"])
    assert a.servers == "host:1" and tls(a) == {}
