"""Files that tasks write and read in the shared folder, whatever file system it is on."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow.fs as pafs


def opened(uri: str) -> tuple[pafs.FileSystem, str]:
    """(file system, path) of a path or URI: local and mounted folders, HDFS, S3, GCS."""
    return pafs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (pafs.LocalFileSystem(), uri)


@contextmanager
def written(uri: str) -> Iterator:
    """A stream for a new file that takes its name only when complete, so a lost or doubled task attempt leaves no half file."""
    fs, path = opened(uri)
    own = f"{path}.{uuid.uuid4().hex}.tmp"
    fs.create_dir(path.rpartition("/")[0], recursive=True)
    with fs.open_output_stream(own, compression=None) as out:
        yield out
    if fs.get_file_info(path).type != pafs.FileType.NotFound and not isinstance(fs, (pafs.LocalFileSystem, pafs.SubTreeFileSystem)):
        fs.delete_file(path)  # an earlier attempt's, with the same rows
    fs.move(own, path)
