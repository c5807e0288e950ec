"""The message log as a source: positions, the bound of a batch, restarts, segments that grow."""

import json
import time

import pytest
from pyspark.sql import functions as F

from editscope.operators import normalize
from editscope.sources import messages
from editscope.sources.messages import MessageReader


def write(folder, partition, segment, lines, end="\n"):
    place = folder / partition
    place.mkdir(parents=True, exist_ok=True)
    with open(place / segment, "ab") as out:
        out.write(b"".join(line.encode() + b"\n" for line in lines[:-1]) + lines[-1].encode() + end.encode())


@pytest.fixture
def log(tmp_path):
    """Partition b holds most of the messages."""
    folder = tmp_path / "log"
    write(folder, "a", "0001", [f"a{k}" for k in range(20)])
    write(folder, "b", "0001", [f"b{k:05d}" for k in range(3000)])
    write(folder, "b", "0002", [f"b{k:05d}" for k in range(3000, 4000)])
    return folder


def reader(log, tmp_path, max_bytes=5000, split=700):
    return MessageReader(str(log), str(tmp_path / "cursor"), max_bytes, split)


def values(reader, start, end):
    return [v for p in reader.partitions(start, end) for b in reader.read(p) for v in b.column(0).to_pylist()]


def everything(reader, start):
    batches = []
    while (end := reader.latestOffset()) != start:
        batches.append(values(reader, start, end))
        start = end
    return batches, start


def all_lines(log):
    return sorted(line for f in log.glob("*/*") for line in f.read_text().splitlines())


@pytest.mark.parametrize("max_bytes,split", [(5000, 700), (1, 3), (7, 1), (10**9, 64), (10**9, 10**9)])
def test_each_message_once_and_within_the_bound(log, tmp_path, max_bytes, split):
    if max_bytes < 100:
        log = tmp_path / "small"
        write(log, "a", "0001", ["", "x", "yy", "", "long message"])
        write(log, "b", "0001", [f"{k}" for k in range(40)])
    source = reader(log, tmp_path, max_bytes, split)
    batches, _ = everything(source, source.initialOffset())
    assert sorted(v for b in batches for v in b) == all_lines(log)
    sizes = [sum(len(v) + 1 for v in b) for b in batches]
    longest = max(len(v) + 1 for v in all_lines(log))
    assert all(s <= max(max_bytes, longest) for s in sizes)
    assert all(batches)


def test_order_within_a_partition(log, tmp_path):
    source = reader(log, tmp_path)
    batches, _ = everything(source, source.initialOffset())
    seen = [v for b in batches for v in b if v.startswith("b")]
    assert seen == sorted(seen)


def test_what_follows_the_last_line_end_waits(log, tmp_path):
    source = reader(log, tmp_path, 10**9)
    _, start = everything(source, source.initialOffset())
    write(log, "a", "0001", ["half"], end="")
    assert source.latestOffset() == start
    write(log, "a", "0001", [" of it"])
    batches, start = everything(source, start)
    assert batches == [["half of it"]]
    write(log, "a", "0002", ["end without a line end"], end="")
    write(log, "a", "0003", ["x"])
    batches, _ = everything(source, start)
    assert batches == [["end without a line end", "x"]]


def test_hidden_files_blank_lines_and_bad_bytes(tmp_path):
    log = tmp_path / "log"
    write(log, "a", "0001", ["", "one\r", "schön", ""])
    write(log, "a", "_0002", ["no"])
    write(log, "_temporary", "0001", ["no"])
    with open(log / "a" / "0003", "wb") as out:
        out.write(b"\xff\xfe\n")
    source = reader(log, tmp_path)
    batches, _ = everything(source, source.initialOffset())
    assert [v for b in batches for v in b] == ["", "one", "schön", "", "��"]


def test_no_folder_yet_and_empty_segments(tmp_path):
    log = tmp_path / "log"
    source = reader(log, tmp_path)
    assert source.initialOffset() == source.latestOffset() == {}
    (log / "a").mkdir(parents=True)
    (log / "a" / "0001").write_bytes(b"")
    assert source.latestOffset() == {}
    write(log, "a", "0001", ["now"])
    assert everything(source, {})[0] == [["now"]]


def test_a_new_reader_goes_on_where_the_last_one_was(log, tmp_path):
    first = reader(log, tmp_path)
    end = first.latestOffset() if first.initialOffset() == {} else None
    taken = values(first, {}, end)
    second = reader(log, tmp_path)
    assert values(second, {}, end) == taken  # a repeated batch
    after = second.latestOffset()
    third = reader(log, tmp_path)
    assert third.latestOffset() == after  # handed out, not planned: not joined with the next one
    batches, _ = everything(third, end)
    assert sorted(taken + [v for b in batches for v in b]) == all_lines(log)


def test_a_lost_segment_is_an_error_until_it_is_behind(log, tmp_path):
    source = reader(log, tmp_path, 10**9)
    _, start = everything(source, source.initialOffset())
    (log / "b" / "0001").unlink()  # behind: the position is in 0002
    assert source.latestOffset() == start
    (log / "b" / "0002").unlink()
    with pytest.raises(FileNotFoundError, match="0002"):
        source.latestOffset()


def run(spark, log, tmp_path, until, max_bytes=5000):
    """Write what arrives, batch by batch, until there are ``until`` rows; gives the rows."""

    def sink(batch, batch_id):
        batch.write.mode("overwrite").parquet(str(tmp_path / "out" / f"batch={batch_id}"))

    stream = messages.stream_messages(spark, str(log), str(tmp_path / "cursor"), max_bytes, 700)
    query = (
        stream.writeStream.foreachBatch(sink).option("checkpointLocation", str(tmp_path / "check"))
        .trigger(processingTime="0 seconds").start()
    )
    try:
        limit = time.time() + 60
        while time.time() < limit and query.exception() is None:
            if list((tmp_path / "out").glob("*/_SUCCESS")) and table(spark, tmp_path).count() >= until:
                break
            time.sleep(0.2)
        assert query.exception() is None, query.exception()
    finally:
        query.stop()
    return table(spark, tmp_path)


def table(spark, tmp_path):
    return spark.read.schema(messages.COLUMNS + ", batch long").parquet(str(tmp_path / "out"))


def test_stop_and_restart_reads_each_message_once(spark, log, tmp_path):
    run(spark, log, tmp_path, 1000)  # stopped somewhere on the way
    write(log, "c", "0001", [f"c{k}" for k in range(50)])
    write(log, "b", "0003", ["b04000"])
    rows = run(spark, log, tmp_path, len(all_lines(log)))
    assert sorted(r.value for r in rows.collect()) == all_lines(log)
    sizes = rows.groupBy("batch").agg(F.sum(F.octet_length("value") + 1).alias("n")).collect()
    assert len(sizes) > 4 and all(r.n <= 5000 for r in sizes)
    assert rows.select("partition", "segment", "offset").distinct().count() == rows.count()


def test_messages_are_decoded_as_those_of_files(spark, tmp_path):
    log = tmp_path / "log"
    lines = [
        json.dumps({"time": "2024-01-01 00:00:00", "user": "u", "title": f"T{k}", "is_bot": False, "length_diff": k}) for k in range(30)
    ]
    write(log, "a", "0001", [*lines, "no json"])
    rows = run(spark, log, tmp_path, 31)
    plain = spark.read.text(str(log / "a"))
    assert sorted(normalize.decode_edits(rows).collect()) == sorted(normalize.decode_edits(plain).collect())
    assert [r.value for r in normalize.dead_letters(rows).collect()] == ["no json"]
