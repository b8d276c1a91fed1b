"""Single-file artifacts with their manifests, published whole or not at all."""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiflow.operators.rules import native_counts
from lexiflow.session import discard_folder, working_folder
from lexiflow.sources.raw_deflate import COMPRESSION, Sizes, container_sizes, file_chunks, write_ordered


class PublishError(ValueError):
    """Files that may not be written, or do not fit their manifest."""


def json_line(df: DataFrame, keys: list[str]) -> DataFrame:
    """(ord, value): each row as compact JSON with its keys in order, nulls left out. A
    column that is none of the keys stops the job."""
    unknown = [c for c in df.columns if c not in (*keys, "ord")]
    if unknown:
        raise PublishError(f"unknown keys: {unknown}")
    return df.select("ord", F.to_json(F.struct(*keys)).alias("value"))


def digest(path: str | Path) -> str:
    """SHA-256 of a file, read in chunks."""
    total = hashlib.sha256()
    for chunk in file_chunks(str(path)):
        total.update(chunk)
    return total.hexdigest()


def refuse_collisions(inputs: list[Path], outputs: list[Path]) -> None:
    """Stops if an output is an input, or another output, under whatever name."""
    seen: list[Path] = list(inputs)
    for out in outputs:
        for other in seen:
            if out.resolve() == other.resolve() or (out.exists() and other.exists() and os.path.samefile(out, other)):
                raise PublishError(f"{out} is {other}")
        seen.append(out)


@contextmanager
def published(*targets: Path) -> Iterator[list[Path]]:
    """Temporary paths that replace the targets together once all is written; on an
    error the targets stay as they were and nothing is left behind."""
    temporary = [t.with_name(f".{t.name}.{os.getpid()}.tmp") for t in targets]
    try:
        yield temporary
        for t in temporary:
            if not t.exists():
                raise PublishError(f"{t.name} was not written")
        for t, target in zip(temporary, targets):
            os.replace(t, target)
    finally:
        for t in temporary:
            t.unlink(missing_ok=True)


def write_lines(path: Path, lines: Iterable[str], inputs: Iterable[Path] = ()) -> int:
    """Writes lines to a text file that appears whole or not at all; their number."""
    refuse_collisions(list(inputs), [path])
    n = 0
    with published(path) as (fresh,), fresh.open("w", encoding="utf-8", newline="\n") as file:
        for n, line in enumerate(lines, 1):
            file.write(line + "\n")
    return n


def write_rows(path: Path, rows: DataFrame, order: str, value: Column, head: Iterable[str] = (), inputs: Iterable[Path] = ()) -> int:
    """Writes the lines of `head`, then one a row, in order, to a text file that appears whole or
    not at all; the number of rows. Tasks write the lines of ranges of rows to the shared
    folder, and these files are copied one behind the other, as one file is written in one place:
    no row is sent to the driver."""
    refuse_collisions(list(inputs), [path])
    spark, place = rows.sparkSession, working_folder(rows.sparkSession, "lines")
    line = F.coalesce(value, F.raise_error(F.lit("a row without a line")).cast("string"))
    rows.repartitionByRange(order).sortWithinPartitions(order).select(line.alias("value")).write.text(place, lineSep="\n")
    hadoop, folder = spark._jvm.org.apache.hadoop, spark._jvm.org.apache.hadoop.fs.Path(place)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    parts = sorted((s.getPath() for s in files.listStatus(folder) if s.getPath().getName().startswith("part-")), key=lambda p: int(p.getName().split("-")[1]))
    with published(path) as (fresh,):
        fresh.write_text("".join(f"{h}\n" for h in head), encoding="utf-8", newline="\n")
        out = spark._jvm.java.io.FileOutputStream(str(fresh), True)
        try:
            for part in parts:
                source = files.open(part)
                try:
                    hadoop.io.IOUtils.copyBytes(source, out, 1 << 20, False)
                finally:
                    source.close()
        finally:
            out.close()
    discard_folder(place)
    return rows.count()


def dump(rows: DataFrame, keys: list[str], path: Path, inputs: Iterable[Path] = ()) -> int:
    """Rows as JSON lines with their keys in order, by `ord`."""
    return write_rows(path, json_line(rows, keys), "ord", F.col("value"), inputs=inputs)


def write_order(plan: DataFrame, path: Path, columns: tuple[str, ...] = ("id", "word", "senses"), position: str = "position", inputs: Iterable[Path] = ()) -> int:
    """The order to ask for texts in, as tab-separated columns under a header; rows."""
    line = F.concat_ws("\t", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns))
    return write_rows(path, plan, position, line, ["\t".join(columns)], inputs)


def write_ids(plan: DataFrame, path: Path, column: str = "id", position: str = "position", inputs: Iterable[Path] = ()) -> int:
    """A list of ids in order, one a line."""
    return write_rows(path, plan, position, F.col(column), inputs=inputs)


def publish(rows: DataFrame, keys: list[str], artifact: Path, manifest: Path, extra: dict | None = None, inputs: Iterable[Path] = (), source: Path | None = None) -> dict:
    """Writes the container of the rows and a manifest of counts, sizes and digest. None of
    `inputs` may be written over. `source` is the artifact that the rows were made from;
    its digest is stated too."""
    refuse_collisions([*inputs, *([source] if source else [])], [artifact, manifest])
    counts = native_counts(rows) if {"src", "senses"} <= set(rows.columns) else whole_counts(rows)
    with published(artifact, manifest) as (data, info):
        sizes: Sizes = write_ordered(json_line(rows, keys), str(data), "ord")
        held = {**(extra or {}), "counts": counts, "compression": COMPRESSION, "bytes": sizes.compressed, "expanded_bytes": sizes.expanded, "sha256": digest(data)}
        if source:
            held["source_sha256"] = digest(source)
        info.write_text(json.dumps(held, ensure_ascii=False, indent=2) + "\n", encoding="utf-8")
    return held


def whole_counts(rows: DataFrame) -> dict[str, int]:
    """Numbers of rows and, if they have any, of senses."""
    senses = [F.coalesce(F.sum(F.size("senses")), F.lit(0)).alias("senses")] if "senses" in rows.columns else []
    return rows.agg(F.count("*").alias("entries"), *senses).first().asDict()


def update_manifest(manifest: Path, changed: dict) -> dict:
    """The manifest with some keys changed and all others kept."""
    held = manifest_of(manifest)
    with published(manifest) as (fresh,):
        fresh.write_text(json.dumps({**held, **changed}, ensure_ascii=False, indent=2) + "\n", encoding="utf-8")
    return {**held, **changed}


def manifest_of(path: Path) -> dict:
    held = json.loads(path.read_text(encoding="utf-8"))
    if not isinstance(held, dict):
        raise PublishError(f"{path.name} is no object")
    return held


def check_artifact(artifact: Path, manifest: Path, source: Path | None = None, expected: dict | None = None, rows: DataFrame | None = None) -> list[str]:
    """What of a manifest does not fit: its container's compression, sizes and digest, the
    digest of the artifact it was made from, values that must stand in it (`expected`, a
    schema version for instance, of the same type too), and the counts of all `rows`."""
    held, sizes = manifest_of(manifest), container_sizes(str(artifact))
    found = {"compression": COMPRESSION, "bytes": sizes.compressed, "expanded_bytes": sizes.expanded, "sha256": digest(artifact), **(expected or {})}
    if source:
        found["source_sha256"] = digest(source)
    wrong = [k for k, v in found.items() if type(held.get(k)) is not type(v) or held[k] != v]
    if rows is not None:
        stated = held.get("counts") if isinstance(held.get("counts"), dict) else {}
        wrong += [k for k, v in whole_counts(rows).items() if stated.get(k) != v]
    return wrong


def check_files(manifest: Path, folder: Path, listed: str = "files") -> list[tuple[str, str]]:
    """(what, name) of files that a manifest names and the folder lacks, or the other way
    round; the manifest itself does not count."""
    held = manifest_of(manifest).get(listed)
    named = set(held) if isinstance(held, dict) else set()
    there = {str(p.relative_to(folder)) for p in folder.rglob("*") if p.is_file() and p.resolve() != manifest.resolve()}
    return sorted([("missing-file", n) for n in named - there] + [("unlisted-file", n) for n in there - named])


def check_pair(store: Path, sidecar: Path, entries: Path, manifest: Path) -> list[str]:
    """What of a store's sidecar does not fit: one is there without the other, or the
    digests and size it states are not those of the store, the container and the manifest
    it was made from. Neither is no fault."""
    if store.exists() != sidecar.exists():
        return ["pair"]
    if not store.exists():
        return []
    held = manifest_of(sidecar)
    found = {"entries_sha256": digest(entries), "manifest_sha256": digest(manifest), "sha256": digest(store), "bytes": store.stat().st_size}
    return [k for k, v in found.items() if held.get(k) != v]


def write_sidecar(store: Path, sidecar: Path, entries: Path, manifest: Path, extra: dict | None = None) -> dict:
    """States what a store was made from."""
    held = {**(extra or {}), "entries_sha256": digest(entries), "manifest_sha256": digest(manifest), "sha256": digest(store), "bytes": store.stat().st_size}
    with published(sidecar) as (fresh,):
        fresh.write_text(json.dumps(held, ensure_ascii=False, indent=2) + "\n", encoding="utf-8")
    return held
