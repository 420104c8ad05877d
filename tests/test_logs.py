"""Concatenated JSON and sharded logs against plain Python, at every split and after failures."""

import json
import random
from types import SimpleNamespace

import pyarrow as pa
import pytest

from moodgauge.sources import concatenated, readers, shards, writers


def plain(text):
    return concatenated.split_text(text)


@pytest.mark.parametrize(
    ("text", "records"),
    [
        ('{"a":1}{"a":2}\n{"b":\n {"c":"}{"}}\n', ['{"a":1}', '{"a":2}', '{"b":\n {"c":"}{"}}']),
        ('{"a":1,"x":"abc\n{"b":2} junk {"c":3', ['{"a":1,"x":"abc', '{"b":2}', "junk", '{"c":3']),
        ('{"a":{"id":3{"b":1}', ['{"a":{"id":3', '{"b":1}']),
        ('{"a":[1,2}{"b":[{"c":1},{"d":2}]}', ['{"a":[1,2}', '{"b":[{"c":1},{"d":2}]}']),
        ('{"a":1},\n{"b":1}', ['{"a":1}', '{"b":1}']),
        ('{"a":"\\"}{"}{"b":"x\\\\"}', ['{"a":"\\"}{"}', '{"b":"x\\\\"}']),
        ('{"a":1,{"b":2}', ['{"a":1,', '{"b":2}']),
        ('{"a":"x\\', ['{"a":"x\\']),
        ('nonsense\n{"a":1}}{"b":1}\n\n  ', ["nonsense", '{"a":1}', "}", '{"b":1}']),
        ("", []),
    ],
)
def test_split_text(text, records):
    assert plain(text) == records


def some_text(rng, n):
    out = []
    for k in range(n):
        event = {"id": k, "data": {"text": rng.choice(["x", 'q"{', "}{", "\\", "a\nb", "[1,{"]) * rng.randint(0, 3), "l": [{"a": 1}, {"b": []}][: rng.randint(0, 2)]}}
        text = json.dumps(event, indent=rng.choice([None, None, 1]))
        if rng.random() < 0.2:
            text = text[: rng.randint(1, len(text))] + "\n"
        out.append(text + rng.choice(["", "\n", " ", "\n\n", " junk\n"]))
    return "".join(out)


@pytest.mark.parametrize("size", ["40", "97", "500", "1m"])
def test_splits_give_the_records_of_the_whole_file(spark, tmp_path, size):
    rng, texts = random.Random(int(size.strip("m"))), []
    for k in range(6):
        texts.append(some_text(rng, 25))
        (tmp_path / f"{k}.json").write_text(texts[-1])
    (tmp_path / "empty.json").write_text("")
    keys = {"spark.sql.files.maxPartitionBytes": size, "spark.sql.files.openCostInBytes": "1", "spark.sql.files.minPartitionNum": "1"}
    before = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        got = [r.value for r in concatenated.read_records(spark, str(tmp_path)).collect()]
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert sorted(got) == sorted(x for text in texts for x in plain(text))


def test_records_are_sent_on_in_small_batches():
    line = "".join(f'{{"msgType":"{"x" * 500}","data":{{"id":{k}}}}}' for k in range(8))
    given = pa.RecordBatch.from_pydict({"value": [line] * 3000, "file": ["f"] * 3000, "block": [0] * 3000, "whole": [False] * 3000})
    frame = SimpleNamespace(mapInArrow=lambda work, schema: work)
    batches = list(concatenated._pieces(frame)(iter([given])))
    assert sum(b.num_rows for b in batches if b.column("kind")[0].as_py() == "record") == 8 * 3000
    assert max(b.nbytes for b in batches) < 2 << 20


def test_events_of_concatenated_files_and_of_one_text(spark, tmp_path):
    texts = ['{"msgType":"a","data":{"id":1}} {"msgType":"b","data":{"id":2}}', '{"msgType":"c","data":{"id":3,"text":"no end', '{"msgType":"d",', ' "data":', '{"id":4}}', '[{"msgType":"e"}]']
    (tmp_path / "e.json").write_text("\n".join(texts))
    events = readers.read_events(spark, str(tmp_path)).select("msgType", "data.id", readers.BAD_RECORD).collect()
    assert sorted(map(tuple, events), key=str) == sorted([("a", 1, None), ("b", 2, None), ("d", 4, None), (None, None, texts[1]), (None, None, texts[5])], key=str)
    raw = spark.createDataFrame([(7, texts[0], "k"), (8, "\n".join(texts[2:5]), None), (9, " ", "k"), (10, None, "k"), (11, '{"data":{"id":5 {"msgType":"f"}', "k")], "n int, value string, `msg.x` string")
    rows = readers.parse_records(raw).select("n", "`msg.x`", "msgType", readers.BAD_RECORD).collect()
    assert sorted(map(tuple, rows), key=str) == sorted([(7, "k", "a", None), (7, "k", "b", None), (8, None, "d", None), (11, "k", None, '{"data":{"id":5'), (11, "k", "f", None)], key=str)


# sharded logs


def log_of(spark, path, rows, files=2):
    shards.write_shards(spark.createDataFrame(rows, "shard long, seq long, ts long, value string").repartition(files, "seq"), str(path))


def read_on(stream, out, checkpoint):
    stream.writeStream.format("parquet").option("path", str(out)).option("checkpointLocation", str(checkpoint)).trigger(availableNow=True).start().awaitTermination()
    return sorted(map(tuple, stream.sparkSession.read.schema(shards.SCHEMA).parquet(str(out)).select("shard", "seq").collect()))


ROWS = [(s, q, 1000 + 10 * q + s, f"{s}:{q}") for s in (0, 3) for q in range(20)]
MORE = [(s, q, 1000 + 10 * q + s, f"{s}:{q}") for s in (0, 3, 11) for q in range(20, 30)]


@pytest.mark.parametrize(
    ("start", "at", "keep"),
    [
        ("TRIM_HORIZON", None, lambda s, q, ts: True),
        ("LATEST", None, lambda s, q, ts: q >= 20),
        ("AT_SEQUENCE_NUMBER", 7, lambda s, q, ts: q >= 7),
        ("AFTER_SEQUENCE_NUMBER", 7, lambda s, q, ts: q > 7),
        ("AT_TIMESTAMP", 1101, lambda s, q, ts: ts >= 1101),
        ("AT_TIMESTAMP", 9999, lambda s, q, ts: q >= 20),
    ],
)
def test_start_positions_and_restart(spark, tmp_path, start, at, keep):
    log, out, state = tmp_path / "log", tmp_path / "out", tmp_path / "state"
    log_of(spark, log, ROWS)
    wanted = lambda rows: sorted((s, q) for s, q, ts, _ in rows if keep(s, q, ts) or s == 11)
    assert read_on(shards.stream_shards(spark, str(log), start, at), out, state) == wanted(ROWS)
    log_of(spark, log, MORE)
    for _ in range(2):
        assert read_on(shards.stream_shards(spark, str(log), start, at), out, state) == wanted(ROWS + MORE)


def test_batches_by_record_count_go_on_after_a_restart(spark, tmp_path):
    log, sizes, seen = str(tmp_path / "log"), [], []
    log_of(spark, log, ROWS + MORE + [(3, 4, 5, "same seq")])
    for stop_after in (3, 100):

        def handle(batch, batch_id):
            rows = [(r.shard, r.seq, r.value) for r in batch.collect()]
            if len(sizes) == batch_id:
                if batch_id == stop_after:
                    raise RuntimeError("stopped")
                sizes.append(len(rows))
                seen.extend(rows)

        stream = shards.stream_shards(spark, log, records_per_batch=16, positions=str(tmp_path / "positions"))
        run = stream.writeStream.foreachBatch(handle).option("checkpointLocation", str(tmp_path / "state")).start()
        try:
            run.processAllAvailable()
        except Exception as stopped:
            assert "stopped" in str(stopped)
        finally:
            run.stop()
    assert sorted(seen) == sorted((s, q, v) for s, q, _, v in ROWS + MORE + [(3, 4, 5, "same seq")])
    assert sum(sizes) == 71 and all(16 <= n <= 17 for n in sizes[:-1]) and sizes[-1] <= 16


def test_wrong_options(spark, tmp_path):
    log_of(spark, tmp_path / "log", ROWS)
    for options in ({"start": "SOON"}, {"start": "AT_TIMESTAMP"}, {"records_per_batch": 5}):
        with pytest.raises(Exception, match="position|needs"):
            read_on(shards.stream_shards(spark, str(tmp_path / "log"), **options), tmp_path / "o", tmp_path / f"s{len(str(options))}")


def test_a_task_that_fails_after_writing_puts_no_record_twice(spark, tmp_path):
    raw, log, state = str(tmp_path / "raw"), str(tmp_path / "log"), str(tmp_path / "state")
    texts = [f"{k:03d} " + "x" * 80 + str(k) for k in range(50)]
    spark.createDataFrame([(x, 7) for x in texts] + [(" ", 7), (None, 7)], "value string, ts long").repartition(3).write.parquet(raw)
    flag = tmp_path / "failed"

    def put(fail):
        def once(batches):
            for batch in batches:
                yield batch
            if fail and not flag.exists():
                flag.touch()
                raise RuntimeError("lost")

        stream = spark.readStream.schema("value string, ts long").parquet(raw)
        keyed = writers.keyed_records(stream, keep=["ts"]).mapInArrow(once, "key string, value string, ts long")
        shards.put_records(keyed, log, state, shards=3).trigger(availableNow=True).start().awaitTermination()

    with pytest.raises(Exception, match="lost"):
        put(True)
    for _ in range(2):
        put(False)
    # the batch is committed anew, as after a stop between its manifest and the checkpoint
    writer = shards.ShardWriter({"path": log})
    held = pa.table({"seq": [1], "ts": [1], "value": ["again"]})
    pa.parquet.write_table(held, f"{log}/shard=0/again.parquet")
    writer.commit([shards.Put(["shard=0/again.parquet"]), None], 0)
    rows = shards.stream_shards(spark, log)
    assert len(read_on(rows, tmp_path / "out", tmp_path / "read")) == 50
    found = spark.read.schema(shards.SCHEMA).parquet(str(tmp_path / "out"))
    assert sorted(r.value for r in found.collect()) == sorted(texts)
    assert found.groupBy("shard", "seq").count().filter("count > 1").isEmpty()
    assert {r.shard for r in found.collect()} <= {0, 1, 2}
