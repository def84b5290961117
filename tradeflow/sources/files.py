"""Listing and opening files of a folder on the shared file system.

Spark's own file listing hides names that begin with ``_`` or ``.`` and reads
paths as patterns; a folder of user-named files needs neither.
"""

from __future__ import annotations

import fnmatch
import re

import pyarrow as pa
import pyarrow.fs as pafs


#: Spark's names of file systems that pyarrow knows by another name.
SCHEMES = {"s3a": "s3", "s3n": "s3", "gcs": "gs"}


def locate(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a URI, as Spark writes it, or of an absolute path."""
    uri = re.sub(r"^file:/+", "/", uri)
    if uri.startswith("/"):
        return pafs.LocalFileSystem(), uri
    scheme, _, rest = uri.partition("://")
    return pafs.FileSystem.from_uri(f"{SCHEMES.get(scheme, scheme)}://{rest}")


def folder_files(folder: str, pattern: str) -> list[tuple[str, str, int, object]]:
    """(URI, name, bytes, modification time) of the files right in ``folder``
    whose name has the pattern; FileNotFoundError if there is no such folder."""
    fs, path = locate(folder)
    root = folder.rstrip("/") if "://" in folder else "file:" + path.rstrip("/")
    found = fs.get_file_info(pafs.FileSelector(path))
    return [(f"{root}/{f.base_name}", f.base_name, f.size, f.mtime) for f in sorted(found, key=lambda f: f.base_name)
            if f.type == pafs.FileType.File and fnmatch.fnmatchcase(f.base_name, pattern)]


def open_file(uri: str) -> pa.NativeFile:
    """A file for reading at any place."""
    fs, path = locate(uri)
    return fs.open_input_file(path)
