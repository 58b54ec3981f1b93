"""File systems and plain paths of the locations that Spark names."""

from __future__ import annotations

import re

import pyarrow.fs as pafs

#: Schemes of Hadoop's clients, and the name that the same store has in Arrow.
SCHEMES = {"s3a": "s3", "s3n": "s3", "gs": "gs", "wasbs": "abfss"}


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path as Spark's readers give it, and the path within it.

    Such paths aren't URIs: a hash sign, a blank or a percent sign in a name stands for
    itself. Local paths (with file: or without a scheme) and the stores that Arrow knows
    (hdfs, viewfs by libhdfs, s3, s3a, gs, abfss) are read.
    """
    found = re.match(r"([A-Za-z][A-Za-z0-9+.-]*):(?://([^/]*))?(/.*)?$", path, re.S)
    if found is None or found[1] == "file":
        return pafs.LocalFileSystem(), found[3] or "/" if found else path
    fs, base = pafs.FileSystem.from_uri(f"{SCHEMES.get(found[1], found[1])}://{found[2] or ''}/")
    return fs, base.rstrip("/") + (found[3] or "/")
