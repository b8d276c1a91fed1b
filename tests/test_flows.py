"""Inference with the fake backend, resumed streams, artifacts and the store."""

import json
import sqlite3

import pytest
from pyspark.sql import functions as F

from lexiflow.operators import common_format
from lexiflow.plans import build
from lexiflow.plans import inference as I
from lexiflow.sinks import artifacts, store
from lexiflow.sources import bundle
from lexiflow.streaming import resume
from tests.test_lexical import base, native, sources  # noqa: F401


def test_requests_hold_pending_senses_within_the_budget(base):  # noqa: F811
    calls = I.requests(base, batch=2, senses_per_call=2).collect()
    asked = [item for c in sorted(calls, key=lambda c: c["chunk"]) for item in json.loads(c["payload"])]
    assert [a["id"] for a in asked] == ["c1", "c2", "c3", "c5", "c6", "x6"]
    assert asked[0] == {"id": "c1", "w": "邮局", "py": "yóu jú", "s": {"1": "post office", "2": "mail depot"}, "h": "郵便局"}
    assert all(sum(len(i["s"]) for i in json.loads(c["payload"])) <= 2 for c in calls)


NONE = {"missing": 0, "unknown": 0, "repeated": 0, "violation": 0}


def read_log(spark, log):
    return spark.read.schema("id string, sense int, ja string").json(log)


def test_a_run_is_continued(spark, base, tmp_path):  # noqa: F811
    log = str(tmp_path / "log")
    assert I.run(base, I.FakeBackend(broken="c2"), log, batch=1) == {"accepted": 6, "bad reply": 1}
    counts, problems = I.verify(base, read_log(spark, log), ["Z"])
    assert counts == {"entries": 6, "senses": 7, "translated": 6, **NONE, "missing": 1}
    assert [(r["kind"], r["id"], r["sense"]) for r in problems.collect()] == [("missing", "c2", 1)]
    assert I.run(base, I.FakeBackend(), log, batch=1) == {"accepted": 1}
    assert I.verify(base, read_log(spark, log), ["Z"])[0] == {"entries": 6, "senses": 7, "translated": 7, **NONE}
    merged = I.merge_glosses(base, read_log(spark, log))
    assert merged.where(F.size(I.pending_numbers(F.col("senses"))) > 0).count() == 0


def test_limits_of_a_run(base, tmp_path):  # noqa: F811
    assert I.run(base, I.FakeBackend(), str(tmp_path / "a"), batch=1, limit=2) == {"accepted": 3}
    assert I.run(base, I.FakeBackend(), str(tmp_path / "b"), batch=1, shards=1, max_calls=3) == {"accepted": 4}
    spends = lambda prompt, system: I.Reply(I.FakeBackend()(prompt, system).text, {"input_tokens": 6, "output_tokens": 4, "calls": 1})
    # looked at before each call: the third call begins at 20 of 25
    assert I.run(base, spends, str(tmp_path / "c"), batch=1, shards=1, token_budget=25) == {"accepted": 4, "no reply": 3}


def test_a_limited_backend_is_asked_again_and_then_left(base, tmp_path):  # noqa: F811
    class Limited:
        def __call__(self, prompt, system):
            raise I.RateLimited("later")

    place = str(tmp_path / "waits")

    def noted(seconds):
        with open(place, "a") as file:
            file.write(f"{seconds}\n")

    assert I.run(base, Limited(), str(tmp_path / "log"), batch=1, shards=1, sleep=noted) == {"no reply": 6}
    assert [int(s) for s in open(place)] == [30, 60, 120, 240, 480, 600, 600, 600]


def test_passes_go_on_until_all_is_there_or_nothing_comes(base, tmp_path):  # noqa: F811
    place = tmp_path / "calls"
    place.mkdir()

    class Flaky(I.FakeBackend):
        """Answers each request the second time only."""

        def __call__(self, prompt, system):
            mark = place / format(abs(hash(prompt)), "x")
            if not mark.exists():
                mark.write_text("")
                return I.Reply("later")
            return super().__call__(prompt, system)

    slept = []
    assert I.supervise(base, Flaky(), str(tmp_path / "a"), (1, 2), slept.append, batch=10, shards=1) == 2 and slept == [1]
    slept.clear()
    with pytest.raises(I.Stalled):
        I.supervise(base, I.FakeBackend(broken="c"), str(tmp_path / "b"), (1, 2), slept.append, batch=1, shards=1)
    assert slept == [1, 2]


def test_bundles(tmp_path, monkeypatch):
    (tmp_path / "common").mkdir()
    for name in ("manifest.json", "common/manifest.json"):
        (tmp_path / name).write_text("{}")
    assert bundle.locate("common_manifest", tmp_path) == tmp_path / "common/manifest.json" and set(bundle.located(tmp_path)) == {"manifest", "common_manifest"}
    with pytest.raises(FileNotFoundError, match="store"):
        bundle.locate("store", tmp_path)
    monkeypatch.setenv(bundle.VARIABLE, str(tmp_path))
    assert bundle.locate("manifest") == tmp_path / "manifest.json"


def test_texts_that_break_a_rule_are_asked_again(spark, base, tmp_path):  # noqa: F811
    log = str(tmp_path / "log")
    spark.createDataFrame([("c1", 1, "郵便局"), ("c1", 2, "mail depot"), ("c2", 1, "長" * 25), ("elsewhere", 1, "plain")], "id string, sense int, ja string").write.json(log)
    kept, dropped = I.drop_invalid(read_log(spark, log), own=base)
    assert sorted(r["id"] for r in kept.collect()) == ["c1", "elsewhere"] and sorted((r["id"], r["sense"]) for r in dropped.collect()) == [("c1", 2), ("c2", 1)]
    assert {r["detail"] for r in I.verify(base, read_log(spark, log))[1].where("kind = 'violation'").collect()} == {"english-left", "latin", "too-long"}
    asked = []

    class Noting(I.FakeBackend):
        def __call__(self, prompt, system):
            assert prompt.startswith(I.REPAIR_RULES + "\n[")
            return super().__call__(prompt, system)

    assert I.repair(base, Noting(), log, batch=10)["repaired"] == 2
    from lexiflow.sources import scans

    assert sorted(tuple(r) for r in scans.repaired(spark, [f"{log}.repaired", str(tmp_path / "absent")]).collect()) == [("c1", 2), ("c2", 1)]
    now = {(r["id"], r["sense"]): r["ja"] for r in I.log_texts(spark, [log]).collect()}
    assert now["c1", 2] == "訳邮局2" and now["elsewhere", 1] == "plain" and not asked
    assert I.prompt_of("", "[]") == "[]"


def test_answers_nobody_asked_for_are_rejected(spark):
    ask = json.dumps([{"id": "c1", "w": "x", "s": {"1": "a"}}])
    reply = json.dumps({"glosses": [{"id": "c1", "sense": 1, "ja": "甲,乙"}, {"id": "c1", "sense": 1, "ja": "丙"}, {"id": "c1", "sense": 2, "ja": "丁"}, {"id": "c9", "sense": 1, "ja": "戊"}, {"id": "c1", "sense": "one", "ja": "己"}]})
    half = json.dumps({"glosses": [{"id": "c1", "sense": 1, "ja": "庚"}, {"id": "c1", "ja": "辛"}]})
    df = spark.createDataFrame([(0, 0, ask, f"text {reply} text", None), (0, 1, ask, "nothing", None), (0, 2, ask, half, None), (0, 3, ask, '{"glosses": 3}', None)], "shard bigint, chunk int, payload string, reply string, error string")
    taken, counts = I.accept_replies(df)
    assert [tuple(r) for r in taken.collect()] == [("c1", 1, "甲、乙", 0, 0, 0)]
    assert {r["status"]: r["n"] for r in counts.collect()} == {"accepted": 1, "rejected": 4, "bad reply": 3}


def test_merging_takes_the_last_text_and_stops_on_numbers_out_of_range(spark, base):  # noqa: F811
    rows = spark.createDataFrame([("c1", 1, "一", 1), ("c1", 1, "二", 2), ("none", 1, "三", 3)], "id string, sense int, ja string, ord int").coalesce(1)
    for order in ("ord", None):
        assert I.merge_glosses(base, rows, order).where("id = 'c1'").first()["senses"][0]["ja"] == "二"
    for number in (0, 9):
        with pytest.raises(Exception, match="does not have"):
            I.merge_glosses(base, rows.withColumn("sense", F.lit(number))).collect()


def test_the_last_text_is_the_one_written_last(spark, base, tmp_path):  # noqa: F811
    """Spark reads large files first; what was written later is in the smaller one, or the larger."""
    for later in ("small", "large"):
        folder, n = tmp_path / later, {"small": 1, "large": 200}
        folder.mkdir()
        for number, size in ((1, "large" if later == "small" else "small"), (2, later)):
            filler = "".join(f'{{"id": "f{number}-{k}", "sense": 1, "ja": "詰"}}\n' for k in range(n[size]))
            (folder / f"{'ab'[number % 2]}.json").write_text(f'{{"id": "c1", "sense": 1, "ja": "{number}", "pass": {number}}}\n{filler}', encoding="utf-8")
        assert I.merge_glosses(base, I.log_texts(spark, [str(folder)])).where("id = 'c1'").first()["senses"][0]["ja"] == "2"
    for n, ja in (("1.json", "一"), ("2.json", "二")):  # without passes: the order of the logs given, then of the lines
        (tmp_path / n).write_text(f'{{"id": "c1", "sense": 1, "ja": "{ja}"}}\n{{"id": "c1", "sense": 1, "ja": "{ja}々"}}\n', encoding="utf-8")
    for logs, ja in ((["1.json", "2.json"], "二々"), (["2.json", "1.json"], "一々")):
        assert I.log_texts(spark, [str(tmp_path / n) for n in logs]).first()["ja"] == ja
    unordered = spark.createDataFrame([("c1", 1, "一"), ("c1", 1, "二")], "id string, sense int, ja string")
    with pytest.raises(Exception, match="without an order"):
        I.last_texts(unordered).collect()


def test_a_repair_that_stops_loses_no_text(spark, base, tmp_path):  # noqa: F811
    log = str(tmp_path / "log")
    spark.createDataFrame([("c1", 1, "郵便局", 1), ("c1", 2, "mail", 1)], "id string, sense int, ja string, pass int").write.json(log)

    def stopped(*_, **__):
        raise RuntimeError("stopped")

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(I, "run", stopped)
        with pytest.raises(RuntimeError):
            I.repair(base, I.FakeBackend(), log)
    texts = lambda: {(r["id"], r["sense"]): r["ja"] for r in I.log_texts(spark, [log]).where("id = 'c1'").collect()}
    assert texts() == {("c1", 1): "郵便局"}
    I.run(base, I.FakeBackend(), log)
    assert texts() == {("c1", 1): "郵便局", ("c1", 2): "訳邮局2"}


def test_usage_counts_whole_numbers(spark):
    calls = spark.createDataFrame([('{"calls": 1, "cached": true, "seconds": 1.5}',), ('{"calls": 2, "extra": 4}',), (None,)], "usage string")
    assert sorted(tuple(r) for r in I.usage_totals(calls).collect()) == [("calls", 3, 3, 1.0), ("extra", 3, 4, 4 / 3)]


def test_retries():
    waits, tries = [], []

    def limited(prompt, system):
        tries.append(prompt)
        if len(tries) < 3:
            raise I.RateLimited
        return I.Reply("done")

    assert I.retrying(limited, (1, 2, 3), waits.append)("p", "").text == "done" and waits == [1, 2]


def test_choices(spark, native):  # noqa: F811
    rows = native.where("word = '邮局'").unionByName(native.where("word = '邮局'").withColumn("ord", F.lit(50)).withColumn("pinyin", F.lit("other")))
    rows = rows.withColumn("senses", F.concat("senses", "senses"))
    assert json.loads(I.choose_groups(rows).first()["payload"])["rows"][1]["pinyin"] == "other"
    assert I.choose_groups(rows, spark.createDataFrame([("無",)], "word string")).count() == 0
    choices = spark.createDataFrame([(1, "邮局", 1, 2, True), (2, "邮局", 1, 1, True), (3, "邮局", 2, 9, False), (4, "無", 1, 1, True)], "ord int, word string, row int, sense int, default boolean")
    primary, default = I.accept_choices(choices, rows)
    assert [(r["pinyin"], r["sense"]) for r in primary.collect()] == [("yóu jú", 2)] and default.count() == 1
    # the second row has no choice yet; with one for each nothing is left, until a text changes
    left = lambda p, of=rows: [r["word"] for r in I.pending_choices(of, p, default).collect()]
    both = primary.unionByName(primary.withColumn("pinyin", F.lit("other")))
    assert left(primary) == ["邮局"] and left(both) == []
    assert [r["word"] for r in I.pending_choices(rows, both, default.limit(0)).collect()] == ["邮局"]
    assert left(both, rows.withColumn("senses", F.transform("senses", lambda s: s.withField("ja", F.lit("別"))))) == ["邮局"]
    assert left(both.withColumn("sense", F.lit(99))) == ["邮局"]


def test_streams_go_on_and_first_answers_win(spark, tmp_path):
    folder, target, at = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "checkpoint")
    folder.mkdir()
    schema = "id string, sense int, ja string"
    go = lambda: resume.run_available(lambda: resume.append_once(resume.follow_log(spark, str(folder), schema), ["id", "sense"], ["source", "ja"], target, at))
    (folder / "a.json").write_text('{"id":"c1","sense":1,"ja":"a"}\n{"id":"c1","sense":1,"ja":"b"}\nbroken\n')
    go()
    (folder / "b.json").write_text('{"id":"c1","sense":1,"ja":"late"}\n{"id":"c2","sense":1,"ja":"c"}\n')
    go()
    go()
    assert sorted(tuple(r)[:3] for r in resume.held(spark, target).collect()) == [("c1", 1, "a"), ("c2", 1, "c")]


def test_artifacts(native, tmp_path):  # noqa: F811
    keys = [c for c in native.columns if c != "ord"]
    artifact, manifest = tmp_path / "entries.deflate", tmp_path / "manifest.json"
    held = artifacts.publish(native, keys, artifact, manifest, {"version": 3})
    first = artifact.read_bytes()
    assert held["counts"]["entries"] == 10 and held["counts"]["supplement"] == 3 and artifacts.check_artifact(artifact, manifest, rows=native) == []
    assert artifacts.check_artifact(artifact, manifest, expected={"version": 3}) == [] and artifacts.check_artifact(artifact, manifest, expected={"version": 4}) == ["version"]
    assert artifacts.check_artifact(artifact, manifest, rows=native.limit(3)) == ["entries", "senses"]
    artifacts.publish(native.repartition(3), keys, artifact, manifest)
    assert artifact.read_bytes() == first
    artifacts.update_manifest(manifest, {"bytes": 1})
    assert artifacts.check_artifact(artifact, manifest) == ["bytes"]
    with pytest.raises(artifacts.PublishError):
        artifacts.publish(native, keys, artifact, artifact)
    with pytest.raises(artifacts.PublishError):
        artifacts.publish(native, keys, artifact, manifest, inputs=[tmp_path / "." / "entries.deflate"])
    with pytest.raises(artifacts.PublishError):
        artifacts.publish(native, keys, artifact, manifest, source=manifest)
    with pytest.raises(artifacts.PublishError), artifacts.published(artifact, manifest) as (a, _):
        a.write_bytes(b"half")
    assert artifact.read_bytes() == first and len(list(tmp_path.iterdir())) == 2


def test_dumps_and_lists(base, native, tmp_path):  # noqa: F811
    path = tmp_path / "base.jsonl"
    assert artifacts.dump(base, [c for c in base.columns if c != "ord"], path) == 10
    assert [json.loads(line)["id"] for line in path.read_text().splitlines()][:2] == ["c1", "c2"]
    plan = build.generation_plan(base, base.select("word", F.lit(1).alias("freq")))
    n = plan.count()
    assert artifacts.write_order(plan, tmp_path / "order.tsv") == artifacts.write_ids(plan, tmp_path / "ids.txt") == n
    table = [line.split("\t") for line in (tmp_path / "order.tsv").read_text().splitlines()]
    assert table[0] == ["id", "word", "senses"] and [t[0] for t in table[1:]] == (tmp_path / "ids.txt").read_text().splitlines()
    with pytest.raises(artifacts.PublishError):
        artifacts.write_ids(plan, tmp_path / "ids.txt", inputs=[tmp_path / "ids.txt"])


def test_files_and_pairs(native, tmp_path):  # noqa: F811
    names = {n: tmp_path / n for n in ("store", "sidecar", "entries", "manifest.json")}
    assert artifacts.check_pair(*names.values()) == []
    for n in ("store", "entries", "manifest.json"):
        names[n].write_text(n)
    assert artifacts.check_pair(*names.values()) == ["pair"]
    artifacts.write_sidecar(*names.values())
    assert artifacts.check_pair(*names.values()) == []
    names["store"].write_text("other")
    assert artifacts.check_pair(*names.values()) == ["sha256"]
    names["entries"].write_text("entries!")
    assert artifacts.check_pair(*names.values()) == ["entries_sha256", "sha256"]
    names["manifest.json"].write_text(json.dumps({"files": {"store": {}, "lost": {}, "entries": {}}}))
    assert artifacts.check_files(names["manifest.json"], tmp_path) == [("missing-file", "lost"), ("unlisted-file", "sidecar")]


def test_store(spark, native, tmp_path):  # noqa: F811
    common, path, meta = common_format.to_common(native).cache(), tmp_path / "d.sqlite3", {"format": "common", "version": "2"}
    store.write_store(common, path, meta)
    assert store.check_store(path, common, meta) == []
    assert store.store_frame(spark, path).count() == 10
    db = sqlite3.connect(path)
    db.execute("UPDATE entries SET payload = (SELECT payload FROM entries WHERE ordinal = 1) WHERE ordinal = 2")
    db.execute("UPDATE dictionary_meta SET value = '3' WHERE key = 'version'")
    db.commit()
    assert store.check_store(path, common, meta) == ["meta", "entries"]
    db.execute("UPDATE entries SET payload = x'00' WHERE ordinal = 0")
    db.execute("INSERT INTO lookup_keys VALUES ('nowhere', 999)")
    db.commit()
    assert store.check_store(path, common, meta) == ["meta", "keys", "payload"]
