"""Byte files on the shared file system, opened from executors."""

from __future__ import annotations

import re
import uuid

import pyarrow.fs as pafs
from pyspark import TaskContext


def locate(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a URI or an absolute path."""
    uri = re.sub(r"^file:/+", "/", uri)
    return (pafs.LocalFileSystem(), uri) if uri.startswith("/") else pafs.FileSystem.from_uri(uri)


def own_name(folder: str, suffix: str) -> str:
    """A name no other task attempt uses: a retried or duplicate attempt never
    writes into another's file, and only the names that a finished task
    returned count."""
    task = TaskContext.get()
    return f"{folder}/part-{task.partitionId():05d}-{uuid.uuid4().hex}{suffix}"
