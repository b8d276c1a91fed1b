"""An array is read by its lines, or by its commas where a line is long (F4 of round 3)."""

import json

import pytest

from lexiflow.sources import json_array as J

ENTRIES = [{"title": f"p{n}", "heteronyms": [{"definitions": [{"type": "v,]", "def": '[{,"\\'}] * (n % 4)}]} for n in range(60)]


@pytest.fixture
def read_by(monkeypatch):
    """The records of each reading of a document."""
    found, records = [], J.records
    monkeypatch.setattr(J, "records", lambda *args: found.append(records(*args)) or found[-1])
    return found


def check(spark, path):
    elements, faults = J.json_array(spark, str(path))
    rows = elements.orderBy("ord").collect()
    assert [json.loads(r["value"]) for r in rows] == ENTRIES and [r["ord"] for r in rows] == list(range(1, 61)) and not faults.count()
    return rows


def test_a_record_is_a_line_not_what_stands_between_commas(spark, tmp_path, read_by):
    (tmp_path / "a.json").write_text("[" + "\n,".join(map(json.dumps, ENTRIES)) + "\n]\n")
    check(spark, tmp_path / "a.json")
    assert [rows.count() for rows in read_by] == [61]


def test_no_record_is_sorted_or_sent(spark, tmp_path, read_by):
    (tmp_path / "a.json").write_text("[" + "\n,".join(map(json.dumps, ENTRIES)) + "\n]\n")
    plans, write = [], J.materialise
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(J, "materialise", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or write(df))
        J.json_array(spark, str(tmp_path / "a.json"))
    scans = [p for p in plans if "FileScan text" in p]
    assert scans and not any(word in p for p in scans for word in ("Sort", "hashpartitioning"))


@pytest.mark.parametrize("mark", [b"", b"\xef\xbb\xbf"])
@pytest.mark.parametrize("end", ["", "\n"])
def test_long_lines_are_read_whole(spark, tmp_path, monkeypatch, read_by, mark, end):
    texts = [json.dumps(e) for e in ENTRIES]
    monkeypatch.setattr(J, "LONGEST", max(map(len, texts[:20])) + 3)
    (tmp_path / "a.json").write_bytes(mark + ("[" + "\n,".join(texts[:20]) + "\n").encode())
    (tmp_path / "b.json").write_text("," + ",".join(texts[20:]) + "]" + end)  # one line, from which nothing is left out
    rows = check(spark, tmp_path)
    data = b"".join((tmp_path / name).read_bytes() for name in ("a.json", "b.json"))
    assert len(read_by) == 2 and all(data[r["offset"] :].lstrip().startswith(r["value"].encode()) for r in rows)
