"""Files read as ranges of a few bytes, against plain loops over their bytes."""

import json
import random
import re

import pytest

from lexiflow.sources import ranges, scans


@pytest.fixture(params=[7, 1 << 20])
def small_ranges(spark, request):
    spark.conf.set("spark.sql.files.maxPartitionBytes", request.param)
    spark.conf.set("spark.sql.files.openCostInBytes", 0)
    yield request.param
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def plain_forensics(data):
    kinds = {"bom"} if data.startswith(b"\xef\xbb\xbf") else set()
    kinds |= {"crlf"} if b"\r" in data else set()
    kinds |= {"no-final-newline"} if not data.endswith(b"\n") else set()
    try:
        data.decode()
    except UnicodeDecodeError:
        kinds.add("invalid-utf8")
    text = data.removeprefix(b"\xef\xbb\xbf").decode("utf-8", "replace")
    if text.endswith("\n"):
        text = text[:-1].removesuffix("\r")
    lines, found = re.split("\r?\n|[  \x85\x0b\x0c]", text), []
    for n, line in enumerate(lines, 1):
        try:
            json.loads(line)
            kind = None if line.lstrip().startswith("{") else "not-object"
        except ValueError:
            kind = "broken-json" if line.strip(" ") else "blank-line"
        if kind is None and "�" in line:
            kind = "replacement-char"
        found.append((n, kind, line))
    return kinds, found


def bytes_of(rng):
    pieces = [b'{"word": "a"}', b'{"w": "\xe4\xb8\x80\xf0\x90\x80\x80"}', b"[1]", b"{broken", b"", b" ", b'{"w": "\xff"}', '{"w": "  x"}'.encode(), b'"s"', b'{"a": 1}\x0c{"b": 2}']
    data = b"\xef\xbb\xbf" * rng.randint(0, 1)
    for _ in range(rng.randint(1, 40)):
        data += rng.choice(pieces) + rng.choice([b"\n", b"\n", b"\r\n"])
    return data if rng.random() < 0.5 else data + rng.choice([b"{}", b"{}\r", b"x"])


def test_faults_by_ranges_equal_those_of_the_whole(spark, tmp_path, small_ranges):
    rng = random.Random(5)
    for n in range(12):
        (tmp_path / f"{n}.jsonl").write_bytes(bytes_of(rng))
    rows, found = scans.forensic_lines(spark, str(tmp_path), "raw")
    rows, found = rows.collect(), found.collect()
    for n in range(12):
        own = f"/{n}.jsonl"
        kinds, lines = plain_forensics((tmp_path / own[1:]).read_bytes())
        assert {r["kind"] for r in found if r["file"].endswith(own) and r["line"] is None} == kinds
        assert sorted((r["line"], r["kind"]) for r in found if r["file"].endswith(own) and r["line"]) == [(k, kind) for k, kind, _ in lines if kind]
        assert sorted((r["line"], r["value"]) for r in rows if r["file"].endswith(own)) == [(k, line) for k, kind, line in lines if kind in (None, "replacement-char")]


def test_lines_are_numbered_over_ranges(spark, tmp_path, small_ranges):
    text = "".join(f"{'行' * (n % 9)}{n}\n" for n in range(200))
    (tmp_path / "lines.txt").write_text(text + "end", encoding="utf-8")
    lines = scans.text_lines(spark, str(tmp_path / "lines.txt"))
    assert [tuple(r) for r in lines.orderBy("ord").collect()] == list(enumerate([*text.split("\n")[:-1], "end"], 1))
    if small_ranges == 7:
        assert ranges.records(spark, str(tmp_path / "lines.txt")).select("range").distinct().count() > 20


def test_no_files_and_empty_ones(spark, tmp_path, small_ranges):
    (tmp_path / "empty.jsonl").write_bytes(b"")
    rows, found = scans.forensic_lines(spark, str(tmp_path / "empty.jsonl"), "raw")
    assert (rows.count(), found.count(), scans.text_lines(spark, str(tmp_path / "empty.jsonl")).count()) == (0, 0, 0)
    rows, broken = scans.log_rows(spark, [str(tmp_path / "absent")])
    assert (rows.count(), broken.count()) == (0, 0)


def test_rows_of_logs_stand_in_the_order_of_their_lines(spark, tmp_path, small_ranges):
    for name, values in (("b", range(40)), ("a", range(40, 43))):
        (tmp_path / name).write_text("".join(f'{{"id": "x", "sense": {v}, "ja": "{v}"}}\n' for v in values) + '{"id": ')
    rows, broken = scans.log_rows(spark, [str(tmp_path / "b"), str(tmp_path / "none"), str(tmp_path / "a")])
    assert [r["sense"] for r in rows.orderBy("written").collect()] == list(range(43)) and broken.count() == 2
