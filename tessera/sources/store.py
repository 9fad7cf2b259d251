"""Files of any store by path: mounted folders, and what Arrow's file systems reach by URI (S3, GCS, HDFS).

For the tasks of Python data sources, which have no Hadoop file system at hand.
"""

from __future__ import annotations

import os
import posixpath
import uuid
from urllib.parse import unquote, urlparse

from pyarrow import fs


def locate(path: str) -> tuple[fs.FileSystem, str]:
    parts = urlparse(path)
    if parts.scheme in ("", "file") or len(parts.scheme) == 1:
        return fs.LocalFileSystem(), os.path.abspath(unquote(parts.path) if parts.scheme == "file" else path)
    return fs.FileSystem.from_uri(path)


def exists(path: str) -> bool:
    store, at = locate(path)
    return store.get_file_info(at).type != fs.FileType.NotFound


def read_bytes(path: str) -> bytes | None:
    """A file's bytes; None where there is none."""
    store, at = locate(path)
    if store.get_file_info(at).type != fs.FileType.File:
        return None
    with store.open_input_stream(at, compression=None) as stream:
        return stream.read()


def write_bytes(path: str, data: bytes, parts: str | None = None) -> None:
    """A whole file or none: local files are written in the folder ``parts`` and renamed; object stores show a file once it is closed."""
    store, at = locate(path)
    local = isinstance(store, fs.LocalFileSystem)
    store.create_dir(posixpath.dirname(at), recursive=True)
    if local and parts:
        store.create_dir(to := locate(parts)[1], recursive=True)
        at, final = posixpath.join(to, uuid.uuid4().hex), at
    with store.open_output_stream(at, compression=None) as stream:
        stream.write(data)
    if local and parts:
        store.move(at, final)


def delete(path: str) -> None:
    """A folder and all in it, or nothing."""
    store, at = locate(path)
    if store.get_file_info(at).type == fs.FileType.Directory:
        store.delete_dir(at)


def replace(source: str, target: str) -> None:
    """Put the folder ``source`` in the place of ``target``, which stays whole until then.

    Mounted folders and HDFS are renamed. In stores without folders the files are moved one by one.
    """
    store, new = locate(source)
    _, old = locate(target)
    aside = f"{old}.replaced-{uuid.uuid4().hex}"
    had = store.get_file_info(old).type != fs.FileType.NotFound
    if had:
        _move(store, old, aside)
    try:
        _move(store, new, old)
    except OSError:
        if had:
            _move(store, aside, old)
        raise
    if had:
        store.delete_dir(aside)


def _move(store: fs.FileSystem, source: str, target: str) -> None:
    if isinstance(store, fs.LocalFileSystem) or store.type_name == "hdfs":
        store.move(source, target)
        return
    for info in store.get_file_info(fs.FileSelector(source, recursive=True)):
        if info.type == fs.FileType.File:
            to = target + info.path[len(source) :]
            store.create_dir(posixpath.dirname(to), recursive=True)
            store.move(info.path, to)
    store.delete_dir(source)
