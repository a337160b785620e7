"""Files that tasks open by themselves, on the stores where they can."""

from __future__ import annotations

import io
import re
from collections.abc import Iterator
from urllib.parse import quote

from pyspark.sql import SparkSession

# Stores that a task can open by itself; the second name is the one it uses.
STREAMED = {"file": "file", "hdfs": "hdfs", "s3": "s3", "s3a": "s3", "gs": "gs"}

_TRIMMED = "".join(map(chr, range(33)))


def can_open(spark: SparkSession, path: str) -> bool:
    """Whether tasks can open files of the store of a path; one without scheme is on the session's default store."""
    named = re.match(r"([a-zA-Z][a-zA-Z0-9+.-]*):", path)
    return (named[1] if named else spark.conf.get("spark.hadoop.fs.defaultFS", "file:///").partition(":")[0]).lower() in STREAMED


def open_storage(path: str):
    """A file that can be read from any position, on whatever store the path names."""
    from pyarrow import fs

    if path.startswith("file:"):
        return fs.LocalFileSystem().open_input_file("/" + path.removeprefix("file:").lstrip("/"))
    scheme, rest = path.split(":", 1)
    store, inner = fs.FileSystem.from_uri(quote(f"{STREAMED[scheme.lower()]}:{rest}", safe=":/@"))
    return store.open_input_file(inner)


def lines_of(stream) -> Iterator[str]:
    """Lines without their ends, and without those of blanks only, which Spark's CSV source passes over too."""
    lines = io.TextIOWrapper(stream, encoding="utf-8-sig", errors="replace")
    return (line.removesuffix("\n") for line in lines if line.strip(_TRIMMED))
