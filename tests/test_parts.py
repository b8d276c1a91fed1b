"""Dumps in parts: order, replacement in one step, faults by part, runs that stop."""

import hashlib
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lexiflow.sinks import parts
from lexiflow.sinks.artifacts import PublishError


def lines(spark, n, text="line {} é"):
    return spark.createDataFrame([((i * 7919) % 100_003, text.format((i * 7919) % 100_003)) for i in range(n)], "ord bigint, value string").repartition(5)


def expected(n, text="line {} é"):
    return [text.format(o) for o in sorted((i * 7919) % 100_003 for i in range(n))]


def own_files(place):
    return sorted((Path(place) / "lines").glob("part-*"))


def test_parts_in_order_are_the_lines(spark, tmp_path):
    target = str(tmp_path / "dump")
    place = parts.publish(lines(spark, 900), target, part_bytes=2000)
    files = own_files(place)
    assert len(files) > 4 and b"".join(f.read_bytes() for f in files).decode() == "".join(f"{v}\n" for v in expected(900))
    assert [r["value"] for r in parts.lines_of(spark, target).orderBy("ord").collect()] == expected(900)
    held = {r["part"]: r for r in parts.manifest(spark, place).collect()}
    for f in files:
        body = f.read_bytes()
        assert (held[f.name]["bytes"], held[f.name]["lines"], held[f.name]["sha256"]) == (len(body), body.count(b"\n"), hashlib.sha256(body).hexdigest())
    joined = "".join(held[f.name]["sha256"] for f in files)
    assert parts.digest_of(parts.manifest(spark, place)) == hashlib.sha256(joined.encode()).hexdigest()


def test_a_new_generation_replaces_the_old_at_once(spark, tmp_path):
    target = str(tmp_path / "dump")
    first = parts.publish(lines(spark, 50), target)
    second = parts.publish(lines(spark, 70), target)
    assert parts.current(spark, target) == second and parts.lines_of(spark, target).count() == 70 and Path(first).exists()
    with pytest.raises(PublishError):
        parts.publish(lines(spark, 5, "a\nb{}"), target)

    def refuse(place):
        raise ValueError("no")

    with pytest.raises(ValueError, match="no"):
        parts.publish(lines(spark, 9), target, check=refuse)
    assert parts.current(spark, target) == second and parts.prune(spark, target) == 2 and not Path(first).exists()
    parts.publish(lines(spark, 5).where("false"), target)
    assert parts.lines_of(spark, target).count() == 0 and parts.faults(spark, target).count() == 0
    with pytest.raises(PublishError):
        parts.publish(lines(spark, 5).withColumn("value", F.lit(None).cast("string")), target)


def test_faults_name_their_part(spark, tmp_path):
    target = str(tmp_path / "dump")
    place = parts.publish(lines(spark, 900), target, part_bytes=2000)
    assert parts.faults(spark, target).count() == 0
    gone, longer, other, *_ = files = own_files(place)
    for f in files:
        f.with_name(f".{f.name}.crc").unlink()
    gone.unlink()
    longer.write_bytes(longer.read_bytes() + b"more\n")
    other.write_bytes(other.read_bytes().replace(b"line", b"lime"))
    (longer.parent / "part-99998-x.txt").write_text("new\n")
    assert {r["part"]: r["fault"] for r in parts.faults(spark, target).collect()} == {gone.name: "missing", longer.name: "bytes", other.name: "sha256", "part-99998-x.txt": "unlisted"}
