"""Publishing a run's files: everything is made in a draft folder and renamed into place at the end."""

from __future__ import annotations

import json
import os
import shutil
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from tessera.sources import store

MANIFEST = "manifest.json"


@contextmanager
def draft_of(folder: str) -> Iterator[Path]:
    """A new folder inside ``folder`` for a run's files; it goes whether the run ends well or not."""
    draft = Path(folder) / f".run-{uuid.uuid4().hex}"
    draft.mkdir(parents=True)
    try:
        yield draft
    finally:
        shutil.rmtree(draft, ignore_errors=True)


def _size(path: Path) -> int:
    return path.stat().st_size if path.is_file() else sum(p.stat().st_size for p in path.rglob("*") if p.is_file())


def publish(draft: Path, folder: str, parts: tuple[str, ...], about: dict) -> list[str]:
    """Move the draft's files and groups to the same places under ``folder``; returns their paths.

    Each takes its place whole, by a rename; what stood there stays valid until then, and other
    files of an earlier run stay. The manifest (``about``, and the size of every published item) comes last: a
    run without it, or with an older one, didn't end.
    """
    out, sizes = [], {}
    for part in parts:
        found = draft / part
        for item in sorted(found.iterdir()) if found.is_dir() else [found]:
            name = item.relative_to(draft)
            target = Path(folder) / name
            target.parent.mkdir(parents=True, exist_ok=True)
            sizes[name.as_posix()] = _size(item)
            store.replace(str(item), str(target)) if item.is_dir() else os.replace(item, target)
            out.append(str(target))
    (draft / MANIFEST).write_text(json.dumps({**about, "items": sizes}, indent=2, sort_keys=True) + "\n")
    os.replace(draft / MANIFEST, Path(folder) / MANIFEST)
    return out
