"""Containers in segments: one valid stream, read by a task a segment."""

import random
import zlib

import pytest

from lexiflow.sources import raw_deflate as D


@pytest.fixture
def written(spark, tmp_path):
    rng = random.Random(2)
    lines = [rng.choice(["", "日本 𠀀", "x" * rng.randint(0, 300), "{}"]) for _ in range(3000)]
    df = spark.createDataFrame(list(enumerate(lines)), "ord int, value string").repartition(5)
    D.write_segments(df, str(tmp_path / "table"), "ord", segment_bytes=20_000)
    path = str(tmp_path / "c.deflate")
    return lines, str(tmp_path / "table"), path, D.join_segments(spark, str(tmp_path / "table"), path)


def rows(df):
    return [(r["ord"], r["value"]) for r in df.orderBy("ord").collect()]


def test_segments_joined_are_one_stream(spark, written):
    lines, place, path, sizes = written
    data = open(path, "rb").read()
    stream = zlib.decompressobj(-15)
    text = stream.decompress(data) + stream.flush()
    assert stream.eof and not stream.unused_data and text.decode() == "".join(f"{line}\n" for line in lines)
    assert sizes == D.segment_sizes(spark, place) == D.container_sizes(path) == D.Sizes(len(data), len(text))
    assert list(D.lines_of(D.file_chunks(path))) == lines


def test_as_many_tasks_read_as_there_are_segments(spark, written):
    lines, place, path, _ = written
    numbered = list(enumerate(lines, 1))
    assert rows(D.read_segments(spark, place)) == rows(D.read_container(spark, path)) == numbered
    count = D.segments(spark, place).count()
    assert count > 5 and D.read_container(spark, path).rdd.getNumPartitions() == count + 1


def test_damage_has_its_place_and_the_rest_is_read(spark, written):
    lines, place, path, _ = written
    hurt = D.segments(spark, place).orderBy("offset").collect()[3]
    data = bytearray(open(path, "rb").read())
    data[hurt["offset"] + hurt["bytes"] // 2] ^= 0x55
    open(path, "wb").write(data)
    found = D.read_container(spark, path, permissive=True)
    bad = found.where("error is not null").collect()
    assert len(bad) == 1 and bad[0]["error"].startswith(f"damaged segment at byte {hurt['offset']}, lines {hurt['first_line']} to {hurt['first_line'] + hurt['lines'] - 1}:")
    lost = range(hurt["first_line"], hurt["first_line"] + hurt["lines"])
    assert rows(found.where("error is null")) == [(n, line) for n, line in enumerate(lines, 1) if n not in lost]
    with pytest.raises(Exception, match="damaged segment"):
        D.read_container(spark, path).collect()


@pytest.mark.parametrize(("change", "error"), [(lambda d: d[:-1], "cut off"), (lambda d: d + b"x", "after the end")])
def test_a_stream_has_to_end_where_its_file_does(spark, written, change, error):
    _, _, path, _ = written
    data = open(path, "rb").read()
    open(path, "wb").write(change(data))
    assert error in D.read_container(spark, path, permissive=True).where("error is not null").first()["error"]


def test_foreign_streams_and_none(spark, tmp_path):
    D.write_container(str(tmp_path / "f.deflate"), ["a", "", "b"])
    D.resegment(spark, str(tmp_path / "f.deflate"), str(tmp_path / "f"))
    assert rows(D.read_segments(spark, str(tmp_path / "f"))) == [(1, "a"), (2, ""), (3, "b")]
    D.write_segments(spark.createDataFrame([], "ord int, value string"), str(tmp_path / "none"), "ord")
    D.join_segments(spark, str(tmp_path / "none"), str(tmp_path / "none.deflate"))
    assert list(D.lines_of(D.file_chunks(str(tmp_path / "none.deflate")))) == [] and D.read_container(spark, str(tmp_path / "none.deflate")).count() == 0
