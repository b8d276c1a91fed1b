"""Where the files of a published dataset are, in the bundle that is given or the default one."""

from __future__ import annotations

import os
from pathlib import Path

#: Files of a dataset by what they hold.
FILES = {"entries": "entries.jsonl.deflate", "manifest": "manifest.json", "common_entries": "common/entries.jsonl.deflate", "common_manifest": "common/manifest.json", "store": "common/dictionary.sqlite3", "store_manifest": "common/dictionary-db-manifest.json"}
#: Names the folder of the default bundle; without it that is `data` beside the package.
VARIABLE = "LEXIFLOW_BUNDLE"


def default_bundle() -> Path:
    return Path(os.environ.get(VARIABLE) or Path(__file__).resolve().parents[2] / "data")


def locate(what: str, bundle: str | Path | None = None) -> Path:
    """The path of one of FILES; a file that is not there stops with its place."""
    path = Path(bundle if bundle is not None else default_bundle()) / FILES[what]
    if not path.is_file():
        raise FileNotFoundError(f"the bundle has no {what}: {path}")
    return path


def located(bundle: str | Path | None = None) -> dict[str, Path]:
    """Those of the files that the bundle has."""
    root = Path(bundle if bundle is not None else default_bundle())
    return {what: root / name for what, name in FILES.items() if (root / name).is_file()}
