"""The key-value store: common entries in SQLite, with look-up keys and shared values."""

from __future__ import annotations

import json
import sqlite3
import tempfile
import zlib
from collections.abc import Iterable, Iterator
from itertools import islice
from pathlib import Path

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

VERSION = 2
TABLES = ("dictionary_meta", "entries", "lookup_keys", "shared_values")
SHARED = ("provenance", "verification")
#: A table of stores: the task that wrote one and its place there, the ids of its entries and
#: the store itself; about so many bytes of JSON go into one.
PARTS, PART_BYTES = "part int, seq int, entries bigint, ids array<string>, content binary", 8 << 20


def squeezed(text: str) -> bytes:
    stream = zlib.compressobj(9, zlib.DEFLATED, -zlib.MAX_WBITS)
    return stream.compress(text.encode()) + stream.flush()


def expanded(blob: bytes) -> str:
    return zlib.decompress(blob, -zlib.MAX_WBITS).decode()


def canonical(value: object) -> str:
    return json.dumps(value, ensure_ascii=False, sort_keys=True, separators=(",", ":"))


def texts_of(common: DataFrame) -> DataFrame:
    """(v): each entry as JSON."""
    return common.select(F.to_json(F.struct(*(c for c in common.columns if c != "ord"))).alias("v"))


def filled(path: Path, values: Iterable[str], meta: dict[str, str]) -> list[str]:
    """A new store of entries in order; values that recur stand once. Returns their ids."""
    path.unlink(missing_ok=True)
    db = sqlite3.connect(path)
    try:
        db.executescript(
            f"PRAGMA user_version = {VERSION};"
            "CREATE TABLE dictionary_meta(key TEXT PRIMARY KEY, value TEXT NOT NULL);"
            "CREATE TABLE shared_values(id INTEGER PRIMARY KEY, kind TEXT NOT NULL, json TEXT NOT NULL UNIQUE);"
            "CREATE TABLE entries(ordinal INTEGER PRIMARY KEY, id_source TEXT NOT NULL, id_value TEXT NOT NULL UNIQUE, sense_count INTEGER NOT NULL, payload BLOB NOT NULL);"
            "CREATE TABLE lookup_keys(key TEXT NOT NULL, ordinal INTEGER NOT NULL REFERENCES entries(ordinal), PRIMARY KEY(key, ordinal)) WITHOUT ROWID;"
        )
        known: dict[str, int] = {}

        def shared(value: object, kind: str) -> dict:
            text = canonical(value)
            if text not in known:
                known[text] = len(known) + 1
                db.execute("INSERT INTO shared_values VALUES (?, ?, ?)", (known[text], kind, text))
            return {"$shared": known[text]}

        ids = []
        for ordinal, value in enumerate(values):
            entry = json.loads(value)
            for t in (t for s in entry["senses"] for t in s["translations"]):
                for kind in SHARED:
                    t[kind] = shared(t[kind], kind)
            db.execute("INSERT INTO entries VALUES (?, ?, ?, ?, ?)", (ordinal, entry["id"]["source"], entry["id"]["value"], len(entry["senses"]), squeezed(canonical(entry))))
            db.executemany("INSERT OR IGNORE INTO lookup_keys VALUES (?, ?)", ((h["text"], ordinal) for h in entry["headwords"]))
            ids.append(entry["id"]["value"])
        db.executemany("INSERT INTO dictionary_meta VALUES (?, ?)", meta.items())
        db.commit()
    finally:
        db.close()
    return ids


def write_store(common: DataFrame, path: Path, meta: dict[str, str]) -> None:
    """Streams ordered entries into a new store, which is one file and so is written by the
    driver; write_parts() writes stores of any size."""
    filled(path, (row[0] for row in texts_of(common.orderBy("ord")).toLocalIterator(prefetchPartitions=True)), meta)


def write_parts(common: DataFrame, place: str, meta: dict[str, str], part_bytes: int = PART_BYTES) -> None:
    """Writes ordered entries as a table of stores in the folder `place`, by many tasks. Each row
    holds a store of its own, of about so many bytes of JSON: entries numbered from 0,
    their look-up keys and what they share. Stops if an id stands twice."""
    schema = _parse_datatype_string(PARTS)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, held, size = TaskContext.get().partitionId(), 0, [], 0

        def closed() -> pa.RecordBatch:
            with tempfile.TemporaryDirectory() as folder:
                ids = filled(path := Path(folder) / "part.sqlite3", held, meta)
                row = (part, seq, len(held), ids, path.read_bytes())
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, arrow)], schema=arrow)

        for batch in batches:
            for value in batch.column(0).to_pylist():
                held.append(value)
                size += len(value)
                if size >= part_bytes:
                    yield closed()
                    seq, held, size = seq + 1, [], 0
        if held:
            yield closed()

    texts_of(common.repartitionByRange("ord").sortWithinPartitions("ord")).mapInArrow(run, schema).write.parquet(place)
    ids = common.sparkSession.read.schema(PARTS).parquet(place).select(F.explode("ids").alias("id"))
    if (twice := ids.groupBy("id").count().where("count > 1").select("id").first()) is not None:
        raise ValueError(f"an id stands twice: {twice[0]}")


def parts_frame(spark: SparkSession, place: str) -> DataFrame:
    """(ordinal, value) of a table of stores, read by as many tasks as it is split into."""
    stores = spark.read.schema(PARTS).parquet(place)
    before = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    firsts = stores.select("part", "seq", F.coalesce(F.sum("entries").over(before), F.lit(0)).alias("first"))  # a row a store
    arrow = pa.schema([("ordinal", pa.int64()), ("value", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for first, content in ((f.as_py(), c.as_py()) for b in batches for f, c in zip(b.column(0), b.column(1))):
            with tempfile.TemporaryDirectory() as folder:
                (path := Path(folder) / "part.sqlite3").write_bytes(content)
                db = opened(path)
                try:
                    rows = entries(db)
                    while some := list(islice(rows, 10_000)):
                        yield pa.RecordBatch.from_arrays([pa.array([first + n for n, _ in some], pa.int64()), pa.array([v for _, v in some], pa.string())], schema=arrow)
                finally:
                    db.close()

    return stores.join(F.broadcast(firsts), ["part", "seq"]).select("first", "content").mapInArrow(run, "ordinal bigint, value string")


def opened(path: Path) -> sqlite3.Connection:
    """Read-only, as a file that nothing changes."""
    return sqlite3.connect(f"{path.resolve().as_uri()}?mode=ro&immutable=1", uri=True)


def entries(db: sqlite3.Connection) -> Iterator[tuple[int, str]]:
    """(ordinal, canonical JSON) in order, shared values put back and their kinds checked."""
    values = {i: (kind, json.loads(text)) for i, kind, text in db.execute("SELECT id, kind, json FROM shared_values")}
    for ordinal, blob in db.execute("SELECT ordinal, payload FROM entries ORDER BY ordinal"):
        entry = json.loads(expanded(blob))
        for t in (t for s in entry["senses"] for t in s["translations"]):
            for kind in SHARED:
                found = values.get(t[kind].get("$shared")) if isinstance(t[kind], dict) else None
                if found is None or found[0] != kind:
                    raise ValueError(f"entry {ordinal}: no shared {kind}")
                t[kind] = found[1]
        yield ordinal, canonical(entry)


def store_frame(spark: SparkSession, path: Path) -> DataFrame:
    """(ordinal, value) of a store, read by one task that streams it."""

    def read(batches: Iterable) -> Iterator:
        import pandas as pd

        for _ in batches:
            db, held = opened(path), []
            for row in entries(db):
                held.append(row)
                if len(held) == 10_000:
                    yield pd.DataFrame(held, columns=["ordinal", "value"])
                    held = []
            yield pd.DataFrame(held, columns=["ordinal", "value"])

    return spark.range(1, numPartitions=1).mapInPandas(read, "ordinal bigint, value string")


def check_store(path: Path, common: DataFrame, meta: dict[str, str]) -> list[str]:
    """What of a store is not as it should be: integrity, version, tables, meta, keys,
    counts, or an entry that is not the one at its place."""
    db = opened(path)
    one = lambda sql: db.execute(sql).fetchone()[0]
    found = []
    if one("PRAGMA integrity_check") != "ok":
        found.append("integrity")
    if one("PRAGMA user_version") != VERSION:
        found.append("version")
    if not set(TABLES) <= {r[0] for r in db.execute("SELECT name FROM sqlite_master WHERE type = 'table'")}:
        return [*found, "tables"]
    if dict(db.execute("SELECT key, value FROM dictionary_meta")) != meta:
        found.append("meta")
    if db.execute("PRAGMA foreign_key_check").fetchone() is not None:
        found.append("keys")
    for (blob,) in db.execute("SELECT payload FROM entries WHERE ordinal IN (0, (SELECT max(ordinal) FROM entries)) ORDER BY ordinal"):
        try:
            sound = isinstance(json.loads(expanded(blob)).get("senses"), list)
        except (ValueError, AttributeError, zlib.error):
            sound = False
        if not sound and "payload" not in found:
            found.append("payload")
    total = common.agg(F.count("*"), F.coalesce(F.sum(F.size("senses")), F.lit(0))).first()
    if tuple(db.execute("SELECT count(*), coalesce(sum(sense_count), 0) FROM entries").fetchone()) != tuple(total):
        found.append("counts")
    ours = (canonical(json.loads(r[0])) for r in common.orderBy("ord").select(F.to_json(F.struct(*(c for c in common.columns if c != "ord")))).toLocalIterator())
    try:
        if any(a != b[1] for a, b in zip(ours, entries(db))):
            found.append("entries")
    except (ValueError, zlib.error):
        found += [] if "payload" in found else ["payload"]
    return found
