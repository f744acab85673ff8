"""Files that tasks open themselves, with pyarrow's file systems."""

from __future__ import annotations

import re

import pyarrow as pa
from pyarrow import fs

# Schemes of the file systems that pyarrow opens.
SCHEMES = ("file", "s3", "gs", "gcs", "hdfs", "abfs", "abfss")


def can_open(path: str) -> bool:
    """Whether the scheme of a path is one that :func:`opened` knows; none is local."""
    scheme = re.match("([a-z][a-z0-9+.-]*):", path)
    return scheme is None or scheme[1] in SCHEMES


def opened(path: str) -> pa.NativeFile:
    """A file, for reading from any place in it, as it is stored."""
    uri = re.sub("^(file:)?/+", "file:///", path)
    system, name = fs.FileSystem.from_uri(uri)
    return system.open_input_file(name)
