"""Paths as the session sees them, for code that opens files itself.

Spark resolves a path without a scheme on its default file system; a task that opens it
would look on its own machine.  ``qualified`` gives the path its scheme on the driver, and
``system_of`` opens such a path wherever it is needed.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

# Schemes under which Spark and Arrow know the same store by different names.
_ARROW_SCHEMES = {"s3a": "s3", "s3n": "s3"}


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with scheme and authority, by the session's file systems."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(at).toString()


def system_of(uri: str):
    """(Arrow file system, path on it) of a qualified path."""
    from pyarrow import fs

    scheme, colon, rest = uri.partition(":")
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    if not colon or "/" in scheme:
        raise ValueError(f"{uri!r} has no scheme; see paths.qualified")
    return fs.FileSystem.from_uri(f"{_ARROW_SCHEMES.get(scheme, scheme)}:{rest}")


def list_below(uri: str, extension: str) -> list[tuple[str, int]]:
    """(path, size) of the files right below a folder, sorted; a folder that is not there has none."""
    from pyarrow import fs

    system, root = system_of(uri)
    found = system.get_file_info(fs.FileSelector(root, allow_not_found=True))
    return sorted((f.path, f.size) for f in found if f.type == fs.FileType.File and f.path.endswith(extension))
