"""The source that follows growing files."""

import json
import os

import pytest
from pyspark.sql import functions as F

from gatetally import schemas as S
from gatetally.sources import files, tail


def append(path, *lines, end="\n"):
    with open(path, "ab") as file:
        file.write(("\n".join(lines) + end).encode())


def event(n):
    return json.dumps({"student_id": "t1", "session_id": f"s{n}", "page": f"/é{n}"})


class Tail:
    """Runs a stream over a folder until it has caught up, as often as asked."""

    def __init__(self, spark, tmp_path, split=None):
        self.spark, self.out, self.checkpoint = spark, str(tmp_path / "out"), str(tmp_path / "checkpoint")
        self.split = split

    def run(self, pattern):
        stream = files.tail_clickstream(self.spark, pattern, self.split)
        writer = stream.writeStream.format("parquet").option("checkpointLocation", self.checkpoint)
        query = writer.trigger(availableNow=True).start(self.out)
        query.awaitTermination()
        return self.sessions()

    def sessions(self):
        rows = self.spark.read.schema(S.CLICK_RAW).parquet(self.out).select("session_id").collect()
        return sorted((r[0] or "" for r in rows), key=lambda s: (len(s), s))


def names(*ns):
    return [f"s{n}" for n in ns]


def test_a_file_that_grows_between_batches(spark, tmp_path):
    log, follow = tmp_path / "in" / "a.jsonl", Tail(spark, tmp_path)
    log.parent.mkdir()
    append(log, event(1), event(2))
    pattern = str(tmp_path / "in" / "*.jsonl")
    assert follow.run(pattern) == names(1, 2)
    append(log, event(3), event(4)[:20], end="")
    assert follow.run(pattern) == names(1, 2, 3)
    append(log, event(4)[20:], "", event(5))
    append(tmp_path / "in" / "b.jsonl", event(6))
    assert follow.run(pattern) == names(1, 2, 3, 4, 5, 6)
    assert follow.run(pattern) == names(1, 2, 3, 4, 5, 6)


def test_a_rotated_file_is_read_to_its_end(spark, tmp_path):
    log, follow = tmp_path / "app.jsonl", Tail(spark, tmp_path)
    pattern = str(tmp_path / "app.jsonl*")
    append(log, event(1), event(2))
    assert follow.run(pattern) == names(1, 2)
    append(log, event(3))
    os.rename(log, tmp_path / "app.jsonl.1")
    append(log, event(4))
    assert follow.run(pattern) == names(1, 2, 3, 4)
    os.remove(tmp_path / "app.jsonl.1")
    append(log, event(5))
    assert follow.run(pattern) == names(1, 2, 3, 4, 5)


def test_a_file_that_was_emptied_starts_again(spark, tmp_path):
    log, follow = tmp_path / "app.jsonl", Tail(spark, tmp_path)
    append(log, event(1), event(2))
    assert follow.run(str(log)) == names(1, 2)
    log.write_text("")
    append(log, event(3))
    assert follow.run(str(log)) == names(1, 2, 3)


def test_several_tasks_read_one_file_line_for_line(spark, tmp_path):
    log = tmp_path / "a.jsonl"
    append(log, *[event(n) for n in range(3000)])
    follow = Tail(spark, tmp_path, split=10_007)
    assert follow.run(str(log)) == names(*range(3000))
    parts = tail.cut_ranges(str(log), 0, log.stat().st_size, 10_007)
    assert len(parts) > 10
    system, _ = tail.open_folder(str(log))
    for split in (1, 7, 50, 10_007):
        cut = tail.cut_ranges(str(log), 0, 2000, split)
        lines = [line for part in cut for line in tail.lines_of(system, part)]
        whole = log.read_bytes()[:2000].count(b"\n") + (log.read_bytes()[1999:2000] != b"\n")
        assert lines == log.read_bytes().split(b"\n")[:whole]


def test_ranges_between_two_snapshots():
    start = {"a": ["A", 10], "b": ["B", 20], "gone": ["G", 5]}
    end = {"a": ["N", 4], "a.1": ["A", 30], "b": ["B", 25], "c": ["C", 7]}
    assert tail.new_ranges(start, end) == [("a", "N", 0, 4), ("a.1", "A", 10, 30), ("b", "B", 20, 25), ("c", "C", 0, 7)]
    assert tail.new_ranges(end, end) == []
    assert tail.new_ranges({"a": ["A", 10]}, {"a": ["A", 6]}) == [("a", "A", 0, 6)]


def test_a_large_batch_is_not_a_task_for_every_few_lines(tmp_path):
    log = tmp_path / "app.jsonl"
    append(log, *[event(n) for n in range(4000)])
    reader = tail.TailReader({"path": str(log), "splitBytes": "64"})
    parts = reader.partitions({}, reader.latestOffset())
    assert 100 < len(parts) <= 260
    assert parts[0].low == 0 and parts[-1].high == log.stat().st_size
    assert all(a.high == b.low for a, b in zip(parts, parts[1:]))


def test_a_repeated_batch_finds_its_file_under_the_new_name(tmp_path):
    log = tmp_path / "app.jsonl"
    append(log, event(1))
    reader = tail.TailReader({"path": str(tmp_path / "app*")})
    end = reader.latestOffset()
    os.rename(log, tmp_path / "app.jsonl.1")
    append(log, event(2), event(3))
    (part,) = reader.partitions({}, end)
    batches = list(reader.read(part))
    assert [v for b in batches for v in b.column("value").to_pylist()] == [event(1)]
    os.remove(tmp_path / "app.jsonl.1")
    with pytest.raises(FileNotFoundError):
        reader.partitions({}, end)


def test_long_and_odd_lines(spark, tmp_path):
    log = tmp_path / "a.jsonl"
    long = json.dumps({"student_id": "t1", "session_id": "s1", "query": "x" * 3_000_000})
    log.write_bytes(b"\n \n" + long.encode() + b"\r\n\xff\xfe broken\n[1]\n")
    rows = Tail(spark, tmp_path, split=100_000)
    rows.run(str(log))
    found = spark.read.schema(S.CLICK_RAW).parquet(rows.out)
    assert found.filter(F.length("query") == 3_000_000).count() == 1
    assert found.filter("session_id IS NULL").count() == spark.read.schema(S.CLICK_RAW).json(str(log)).filter("session_id IS NULL").count()
