"""Small files beside tables: read, and put in place in one step.

Paths are plain, `file:` or URIs of a store that Arrow knows. Only pointers and descriptions go this way;
rows are read and written by Spark.
"""

from __future__ import annotations

import uuid

from pyarrow import fs as pafs


def store_of(path: str) -> tuple[pafs.FileSystem, str]:
    """The store of a path and the path within it."""
    if path.startswith("file:"):
        path = "/" + path[len("file:") :].lstrip("/")
    if "://" in path:
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path.rstrip("/")


def read_text(path: str) -> str | None:
    """The whole of a small file; null if there is none."""
    store, at = store_of(path)
    if store.get_file_info(at).type != pafs.FileType.File:
        return None
    with store.open_input_stream(at) as f:
        return f.read().decode()


def put_text(path: str, text: str) -> None:
    """Write a small file aside and move it in place, so readers see the old text or the new one."""
    store, at = store_of(path)
    folder, _, name = at.rpartition("/")
    store.create_dir(folder, recursive=True)
    own = f"{folder}/.{name}-{uuid.uuid4().hex}"
    with store.open_output_stream(own) as f:
        f.write(text.encode())
    store.move(own, at)


def folders_in(path: str) -> list[str]:
    """Names of the folders right below a path; none if it does not exist."""
    store, at = store_of(path)
    found = store.get_file_info(pafs.FileSelector(at, allow_not_found=True))
    return sorted(f.base_name for f in found if f.type == pafs.FileType.Directory)


def drop_folder(path: str) -> None:
    store, at = store_of(path)
    store.delete_dir(at)
