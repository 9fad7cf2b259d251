"""Archives of Zarr groups: one stored zip per group, members sorted under the group's name.

Members are stored, so their sizes give every member's place. Tasks copy the members there
and return their checksums; the driver writes the list of members and sees no content.
"""

from __future__ import annotations

import json
import os
import struct
import uuid
import zlib
from collections.abc import Iterator
from pathlib import Path

import pandas as pd
from pyspark.sql import SparkSession

from tessera.operators.compare import json_safe
from tessera.session import ship

#: Fixed values of the format: the largest 32-bit size, the versions, the flag of UTF-8 names, and the first day that it knows.
_BIG, _PLAIN, _ZIP64, _UTF8, _DAY = 0xFFFFFFFF, 20, 45, 0x800, 0x21
#: Bytes of members that one task copies.
TASK_BYTES = 64 << 20


def _header(name: bytes, size: int, checksum: int) -> bytes:
    """What stands before a member's content."""
    wide = size >= _BIG
    extra = struct.pack("<HHQQ", 1, 16, size, size) if wide else b""
    shown = _BIG if wide else size
    return struct.pack("<4s5H3I2H", b"PK\3\4", _ZIP64 if wide else _PLAIN, _UTF8, 0, 0, _DAY, checksum, shown, shown, len(name), len(extra)) + name + extra


def _entry(name: bytes, size: int, checksum: int, at: int) -> bytes:
    """A member's line in the list at the end."""
    wide = size >= _BIG or at >= _BIG
    extra = struct.pack("<HHQQQ", 1, 24, size, size, at) if wide else b""
    shown = _BIG if wide else size
    fixed = struct.pack("<4s6H3I5H2I", b"PK\1\2", _ZIP64, _ZIP64 if wide else _PLAIN, _UTF8, 0, 0, _DAY, checksum, shown, shown, len(name), len(extra), 0, 0, 0, 0o644 << 16, _BIG if wide else at)
    return fixed + name + extra


def _end(count: int, at: int, size: int) -> bytes:
    wide = count >= 0xFFFF or at >= _BIG or size >= _BIG
    long = struct.pack("<4sQ2H2I4Q", b"PK\6\6", 44, _ZIP64, _ZIP64, 0, 0, count, count, size, at) + struct.pack("<4sIQI", b"PK\6\7", 0, at + size, 1) if wide else b""
    return long + struct.pack("<4s4H2IH", b"PK\5\6", 0, 0, min(count, 0xFFFF), min(count, 0xFFFF), min(size, _BIG), min(at, _BIG), 0)


def write_archive(group: str, target: str, spark: SparkSession | None = None) -> None:
    """Pack a group by the session's tasks; an existing archive is replaced once the new one is whole. Both paths are on mounted folders."""
    spark = ship(spark or SparkSession.active())
    root = Path(group)
    files = sorted((f"{root.name}/{p.relative_to(root).as_posix()}", p.stat().st_size) for p in root.rglob("*") if p.is_file())
    places, at = [], 0
    for name, size in files:
        places.append(at)
        at += len(_header(name.encode(), size, 0)) + size
    draft = f"{target}.writing-{uuid.uuid4().hex}"
    with open(draft, "wb") as out:
        out.truncate(at)

    def copy(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            with open(draft, "r+b") as out:
                sums = []
                for name, size, place in zip(batch.name, batch["size"], batch.place, strict=True):
                    data = Path(root.parent, name).read_bytes()
                    if len(data) != size:
                        raise RuntimeError(f"{name} changed while it was packed")
                    sums.append(zlib.crc32(data))
                    out.seek(int(place))
                    out.write(_header(name.encode(), len(data), sums[-1]) + data)
            yield pd.DataFrame({"name": batch.name, "checksum": sums})

    tasks = max(1, min(at // TASK_BYTES + 1, len(files)))
    members = spark.createDataFrame([(n, s, p) for (n, s), p in zip(files, places, strict=True)], "name string, size long, place long")
    sums = dict(members.repartition(tasks).mapInPandas(copy, "name string, checksum long").collect())
    entries = b"".join(_entry(n.encode(), s, sums[n], p) for (n, s), p in zip(files, places, strict=True))
    with open(draft, "r+b") as out:
        out.seek(at)
        out.write(entries + _end(len(files), at, len(entries)))
    os.replace(draft, target)


def export_archives(groups: list[str], folder: str) -> list[str]:
    """One archive per Zarr group; anything else is refused by name."""
    if bad := [g for g in groups if not g.lower().endswith(".ome.zarr")]:
        raise ValueError(f"only Zarr groups can be archived, not {bad}")
    Path(folder).mkdir(parents=True, exist_ok=True)
    targets = [str(Path(folder) / (Path(g).name[: -len(".ome.zarr")] + ".ozx")) for g in groups]
    for group, target in zip(groups, targets, strict=True):
        write_archive(group, target)
    return targets


def write_report(report: dict, path: str) -> None:
    """Compact JSON with numbers that are not finite as null."""
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    Path(path).write_text(json.dumps(json_safe(report), separators=(",", ":")) + "\n")
