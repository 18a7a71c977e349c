"""Single objects, read and written by tasks: files, web addresses, and what Arrow's file systems open (s3, gs, hdfs)."""

from __future__ import annotations

import os
import shutil
import time
import urllib.error
import urllib.request
from collections.abc import Iterable

#: Schemes that tasks can open by themselves; others are Spark's alone.
OPENED = ("http", "https", "file", "s3", "s3a", "gs", "hdfs")
#: Answers that mean that an object doesn't exist.
ABSENT = (404,)
TRIES, WAIT = 3, 0.2


def scheme(location: str) -> str:
    return location.split(":", 1)[0].lower() if ":" in location.split("/", 1)[0] else "file"


def can_open(location: str) -> bool:
    return scheme(location) in OPENED


def is_web(location: str) -> bool:
    return scheme(location) in ("http", "https")


def local_path(location: str) -> str | None:
    """The path of a file on this machine or a folder that all share."""
    if scheme(location) != "file":
        return None
    path = location.removeprefix("file:")
    return "/" + path.lstrip("/") if path != location else path


def _arrow(location: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(location.replace("s3a://", "s3://", 1))


def _fetch(url: str, absent: Iterable[int]) -> bytes | None:
    for left in range(TRIES - 1, -1, -1):
        try:
            with urllib.request.urlopen(url, timeout=60) as got:
                return got.read()
        except urllib.error.HTTPError as e:
            if e.code in absent:
                return None
            if not left or e.code < 500 and e.code not in (403, 408, 425, 429):
                raise PermissionError(f"{url}: refused ({e.code})") if e.code in (401, 403) else e from e
        except (urllib.error.URLError, TimeoutError, ConnectionError):
            if not left:
                raise
        time.sleep(WAIT * (TRIES - left))
    raise AssertionError("the last try returns or raises")


def read(location: str, absent: Iterable[int] = ABSENT) -> bytes | None:
    """An object's bytes, none if it doesn't exist. absent: the web answers that count as that; a refusal is none of them unless asked for, since
    it would turn a whole volume into empty chunks."""
    if is_web(location):
        return _fetch(location, absent)
    try:
        if (path := local_path(location)) is not None:
            with open(path, "rb") as f:
                return f.read()
        store, path = _arrow(location)
        with store.open_input_stream(path) as f:
            return f.read()
    except FileNotFoundError:
        return None


def write(location: str, content: bytes) -> None:
    if (path := local_path(location)) is not None:
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "wb") as f:
            f.write(content)
        return
    store, path = _arrow(location)
    store.create_dir(os.path.dirname(path), recursive=True)
    with store.open_output_stream(path) as f:
        f.write(content)


def move(source: str, target: str) -> None:
    """Put an object in another's place."""
    if (path := local_path(source)) is not None:
        os.makedirs(os.path.dirname(local_path(target)), exist_ok=True)
        os.replace(path, local_path(target))
        return
    store, path = _arrow(source)
    store.move(path, _arrow(target)[1])


def listed(location: str) -> list[str]:
    """The names in a folder, none if it doesn't exist."""
    if (path := local_path(location)) is not None:
        return sorted(os.listdir(path)) if os.path.isdir(path) else []
    from pyarrow import fs

    store, path = _arrow(location)
    return sorted(x.base_name for x in store.get_file_info(fs.FileSelector(path, allow_not_found=True)))


def remove(location: str) -> None:
    """Remove a file, or a folder with all that is in it, if it exists."""
    if (path := local_path(location)) is not None:
        if os.path.isdir(path):
            shutil.rmtree(path, ignore_errors=True)
        elif os.path.exists(path):
            os.remove(path)
        return
    from pyarrow import fs

    store, path = _arrow(location)
    kind = store.get_file_info(path).type
    if kind == fs.FileType.Directory:
        store.delete_dir(path)
    elif kind != fs.FileType.NotFound:
        store.delete_file(path)
