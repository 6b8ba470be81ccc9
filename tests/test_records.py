"""Reading CSV in pieces against Spark's own whole-file reader."""

import os
import random
import subprocess
import sys

import pytest
from pyspark import cloudpickle

import stopclock as sc
from stopclock.sources import records as rc
from stopclock.sources.timetable import header_lines

HEADER = "Train No,Station Name,Arrival time,Departure Time,Note\n"
#: Quoted line breaks, quotes inside fields, escapes, blank lines, short and long rows, an open end.
ROWS = (
    '1,"A\nB",10:00:00,10:05:00,x\n'
    '2,12" gauge,10:00:00,10:05:00,"a ""quoted"" word"\n'
    '\n'
    '3,"line one\nline two\n\nline four, with a comma",10:00:00,10:05:00,\n'
    '4,"an escaped \\" quote\nand on",10:00:00,10:05:00,"tail"\n'
    '5,"closed"junk,10:00:00\n'
    '6,plain,10:00:00,10:05:00,x,extra,"more\nof it"\n'
    '"7","ü\n日本","10:00:00","10:05:00",""\n'
    '8,"never closed,10:00:00,10:05:00,x\nand so on'
)


@pytest.fixture
def cut(spark):
    """Cut files into ranges of so many bytes."""

    def to(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", 1)

    yield to
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def _write(path, text):
    path.write_bytes(text.encode())
    return str(path)


def test_same_rows_wherever_the_file_is_cut(spark, cut, tmp_path):
    path = _write(tmp_path / "t.csv", HEADER + ROWS)
    expected = _rows(sc.read_csv(spark, path, multi_line=True))
    assert len(expected) == 8
    size = len((HEADER + ROWS).encode())
    for step in (size, 1, 2, 7, 23, 97):
        cut(step)
        got = sc.read_csv(spark, path, multi_line="split")
        assert _rows(got) == expected, step


def test_random_files(spark, cut, tmp_path):
    rng = random.Random(4)
    field = lambda: rng.choice(["a", "", '"q"', '"x\ny"', '"\n"', 'in"ner', '"a ""b"" c"', '"e \\" f\n,g"', '"h" i', "10:00:00"])
    for k in range(30):
        rows = "".join(",".join(field() for _ in range(rng.randrange(1, 7))) + rng.choice(["\n", "\n", "\n\n"]) for _ in range(12))
        _write(tmp_path / f"{k:02}.csv", HEADER + rows)
    expected = _rows(sc.read_csv(spark, str(tmp_path), multi_line=True))
    for step in (11, 64):
        cut(step)
        assert _rows(sc.read_csv(spark, str(tmp_path), multi_line="split")) == expected


def test_two_character_line_ends(spark, cut, tmp_path):
    text = (HEADER + '1,"A\nB",10:00:00,10:05:00,x\n2,C,10:00:00,10:05:00,"y"\n\n').replace("\n", "\r\n")
    path = _write(tmp_path / "t.csv", text)
    expected = _rows(sc.read_csv(spark, path, multi_line=True))
    for step in (7, 1 << 20):
        cut(step)
        assert _rows(sc.read_csv(spark, path, multi_line="split")) == expected


def test_one_file_many_tasks(spark, cut, tmp_path):
    rows = "".join(f'{k},"station\n{k}",10:00:00,10:{k % 60:02}:00,{"x" * 40}\n' for k in range(2_000))
    path = _write(tmp_path / "t.csv", HEADER + rows)
    cut(8_000)
    whole, split = sc.read_csv(spark, path, True), sc.read_csv(spark, path, "split")
    assert rc.lines(spark, path).rdd.getNumPartitions() > 10 > 1 == whole.rdd.getNumPartitions()
    assert _rows(split) == _rows(whole)
    assert sc.run(spark, path, multi_line="split").valid_durations == sc.run(spark, path, multi_line=True).valid_durations
    # Other ranges than those of the first pass would be read from wrong states.
    late = sc.read_csv(spark, path, "split")
    cut(7_000)
    with pytest.raises(Exception, match="cut otherwise"):
        late.collect()


def test_different_headers(spark, cut, tmp_path):
    _write(tmp_path / "a.csv", HEADER + '1,"A\nB",10:00:00,10:05:00,x\n')
    _write(tmp_path / "b.csv", "﻿Station Name,Note,Train No,Departure Time,Arrival time\n" + '"B\nC",n,2,11:05:00,11:00:00\n')
    _write(tmp_path / "c.csv", "")
    cut(16)
    expected = [("1", "A\nB", "10:00:00", "10:05:00"), ("2", "B\nC", "11:00:00", "11:05:00")]
    assert _rows(sc.read_csv(spark, str(tmp_path), multi_line="split")) == expected
    _write(tmp_path / "d.csv", 'Train No,Station Name,Arrival time,"Departure\n Time"\n')
    with pytest.raises(sc.SchemaError):
        sc.read_csv(spark, str(tmp_path), multi_line="split")
    with pytest.raises(ValueError, match="multi_line"):
        sc.read_csv(spark, str(tmp_path), multi_line="whole")


def test_states_of_ranges(spark, cut, tmp_path):
    path = _write(tmp_path / "t.csv", HEADER + ROWS)
    data = (HEADER + ROWS).encode()
    cut(5)
    for r in rc.range_states(rc.lines(spark, path)).collect():
        # The lines of a range are those that begin in it, the first byte of the file apart.
        begins = [0] + [i + 1 for i, b in enumerate(data) if b == 10 and i + 1 < len(data)]
        state = rc.OUTSIDE
        for at, end in zip(begins, [*begins[1:], len(data) + 1], strict=True):
            if (at > r.start) or r.start == 0:
                break
            state = rc.state_after(state, data[at : end - 1])
        assert state == r.state, r


def test_headers_are_read_in_tasks(spark, tmp_path):
    for k in range(300):
        _write(tmp_path / f"{k:03}.csv", f"h{k % 3}\n" + "row\n" * (k % 7))
    _write(tmp_path / "empty.csv", "")
    found = header_lines(spark, str(tmp_path))
    assert {h: len(files) for h, files in found.items()} == {"h0": 100, "h1": 100, "h2": 100}
    assert spark.conf.get("spark.sql.files.openCostInBytes") != str(1 << 62)


def test_tasks_need_no_copy_of_the_package(tmp_path):
    """What tasks call is unpickled where the package can't be imported."""
    (tmp_path / "f").write_bytes(cloudpickle.dumps((rc.state_after, rc._ranges, rc._quoting)))
    code = "import sys, pickle; sys.path = [p for p in sys.path if p]; f = pickle.load(open('f', 'rb'))[0]; print(f(0, b'a,\"b'), 'stopclock' in sys.modules)"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=60)
    assert done.stdout == "1 False\n", done.stderr
