"""One JSON array read by ranges, against the parser of the whole document."""

import json
import random

import pytest

from lexiflow.plans import assemble
from lexiflow.sources import json_array as J
from lexiflow.sources import scans


@pytest.fixture
def ranges_of(spark, monkeypatch):
    """Ranges of so many bytes, for the documents alone: what steps write is kept as rows."""

    def kept(df):
        found = spark.createDataFrame(df.collect(), df.schema)
        found._written_to = None
        return found

    def ask(size):
        monkeypatch.setattr(J, "materialise", kept)
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", 1)

    yield ask
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.fixture
def small_ranges(ranges_of):
    ranges_of(110)


@pytest.fixture
def bytes_apart(ranges_of):
    ranges_of(3)


def value(rng, depth=0):
    kind = rng.randrange(7 if depth < 3 else 4)
    if kind < 2:
        return rng.choice(["", "a,b", 'q"[{', "\\", '\\",', "]}", "日本,\n", " ", ",,,"]) * rng.randint(1, 2)
    if kind < 4:
        return rng.choice([None, True, -1.5, 12])
    if kind == 4:
        return {rng.choice(["k", "entries", 'x"y', "a,b"]): value(rng, depth + 1) for _ in range(rng.randint(0, 3))}
    return [value(rng, depth + 1) for _ in range(rng.randint(0, 4))]


def elements(spark, path, field=None):
    found, faults = J.json_array(spark, str(path), field)
    return sorted((r["ord"], r["offset"], r["value"]) for r in found.collect()), [tuple(r) for r in faults.orderBy("offset").collect()]


@pytest.mark.parametrize("seed", range(4))
def test_elements_equal_those_of_the_parser(spark, tmp_path, small_ranges, seed):
    rng = random.Random(seed)
    style = [{"indent": 1}, {}, {"ensure_ascii": False}, {"separators": (",", ":"), "ensure_ascii": False}][seed]
    own = [value(rng) for _ in range([0, 1, 18, 25][seed])]
    mark = b"\xef\xbb\xbf" * (seed % 2)
    (tmp_path / "array.json").write_bytes(mark + f" \n{json.dumps(own, **style)}\n".encode())
    data = (tmp_path / "array.json").read_bytes()
    rows, faults = elements(spark, tmp_path / "array.json")
    assert [json.loads(v) for _, _, v in rows] == own and not faults and [o for o, _, _ in rows] == list(range(1, len(own) + 1))
    assert all(data[at:].lstrip().startswith(v.encode()) for _, at, v in rows)
    document = {"metadata": {"entries": [9], "list": [[1, 2], 3]}, "entries": own, "more": {"x": [1]}}
    (tmp_path / "document.json").write_bytes(mark + json.dumps(document, **style).encode())
    rows, faults = elements(spark, tmp_path / "document.json", "entries")
    assert [json.loads(v) for _, _, v in rows] == own and not faults


BROKEN = [
    (b'[1, {"a": 2}, "x', "cut off within a string", 16), (b'[1, {"a": [2]', "cut off", 13), (b"[1, 2]]", "closed too often", 7), (b'{"a": [1]}', "no such array", 10), (b"7", "no such array", 1),
    (b'[1, {"a" 2}, 3]', 'no JSON: {"a" 2}', 3), (b"[1,,2]", "no JSON: ", 3), (b"[1,2,]", "no JSON: ", 5), (b"[1, 2}", "closed as an object", 6),
]


@pytest.mark.parametrize(("data", "detail", "offset"), BROKEN)
def test_faults_have_their_place(spark, tmp_path, bytes_apart, data, detail, offset):
    (tmp_path / "x.json").write_bytes(data)
    assert (offset, detail) in elements(spark, tmp_path / "x.json")[1]


def test_a_fault_stops_strict_readers(spark, tmp_path):
    (tmp_path / "x.json").write_text("[1, 2")
    with pytest.raises(ValueError, match="byte 5: cut off"):
        J.strict_elements(spark, str(tmp_path / "x.json"), "a int")


def test_a_document_of_several_files(spark, tmp_path, bytes_apart):
    for n, text in enumerate(['[{"a": 1},\n', '{"a"\n', ':2}\n,{"a": ', '3}, {"a": 4}\n]\n']):
        (tmp_path / f"part-{n}.txt").write_text(text)
    rows, faults = elements(spark, tmp_path)
    assert [json.loads(v) for _, _, v in rows] == [{"a": n} for n in (1, 2, 3, 4)] and not faults


def test_definitions_reach_the_verdict(spark, tmp_path, small_ranges):
    entries = [{"title": "邮局", "heteronyms": [{"definitions": [{"type": "n", "def": "x,]"}] * 2}, {}]}, {"title": "邮局", "heteronyms": [{"definitions": []}]}, {"title": "a"}]
    (tmp_path / "moe.json").write_text(json.dumps(entries), encoding="utf-8")
    counts = scans.reference_counts(spark, str(tmp_path / "moe.json"))
    assert {tuple(r) for r in counts.collect()} == {("邮局", 2), ("a", 0)}
    assert "counts" in assemble.assemble.__annotations__
