"""First answers of streams: order within a batch, batches that are repeated, state that expires."""

from pathlib import Path

from pyspark.sql import functions as F

from lexiflow.streaming import resume

SCHEMA = "k string, n int, at bigint"


def go(spark, tmp_path, name=None, rows=(), **options):
    log = tmp_path / "log"
    log.mkdir(exist_ok=True)
    if name:
        (log / name).write_text("".join(line + "\n" for line in rows))
    stream = resume.follow_log(spark, str(log), SCHEMA).withColumn("time", F.timestamp_seconds("at"))
    query = resume.append_once(stream, ["k"], ["n"], str(tmp_path / "out"), str(tmp_path / "checkpoint"), **options)
    query.awaitTermination()
    return query


def found(spark, tmp_path):
    return sorted((r["k"], r["n"]) for r in resume.held(spark, str(tmp_path / "out")).collect())


def line(k, n, at=0):
    return f'{{"k":{"null" if k is None else chr(34) + k + chr(34)},"n":{n},"at":{at}}}'


def test_first_in_order_of_a_batch_and_first_batch_win(spark, tmp_path):
    go(spark, tmp_path, "a.json", [line("x", 5), line("x", 3), line("y", 9), line(None, 1), "broken", ""])
    assert found(spark, tmp_path) == [("x", 3), ("y", 9)]
    go(spark, tmp_path, "b.json", [line("x", 1), line("z", 7), line("z", 7), line("y", 9)])
    go(spark, tmp_path)
    assert found(spark, tmp_path) == [("x", 3), ("y", 9), ("z", 7)]


def test_a_batch_that_is_repeated_counts_once(spark, tmp_path):
    go(spark, tmp_path, "a.json", [line("x", 5), line("y", 9)])
    go(spark, tmp_path, "b.json", [line("z", 7), line("x", 1)])
    commits = tmp_path / "checkpoint" / "commits"
    last = max((p for p in commits.iterdir() if p.name.isdigit()), key=lambda p: int(p.name))
    for file in (last, commits / f".{last.name}.crc"):
        Path(file).unlink(missing_ok=True)  # as if the driver was lost before it could say that the batch is complete
    go(spark, tmp_path)
    assert found(spark, tmp_path) == [("x", 5), ("y", 9), ("z", 7)]


def test_periods_are_forgotten_and_late_rows_dropped(spark, tmp_path):
    day = 86400
    options = {"at": "time", "period": "1 day", "late": "1 hour"}
    go(spark, tmp_path, "a.json", [line(f"k{i}", i, 10) for i in range(50)] + [line("k0", 70, day + 5)], **options)
    assert len(found(spark, tmp_path)) == 51
    query = go(spark, tmp_path, "b.json", [line("k0", 1, 3 * day), line("k1", 2, day + 7), line("k0", 71, day + 9)], **options)
    assert found(spark, tmp_path)[:3] == [("k0", 0), ("k0", 1), ("k0", 70)] and ("k1", 2) in found(spark, tmp_path)
    query = go(spark, tmp_path, "c.json", [line("k9", 99, 20), line("k8", 98, 3 * day + 1)], **options)
    assert ("k9", 99) not in found(spark, tmp_path) and ("k8", 98) in found(spark, tmp_path)
    assert [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]][-1] == 2
