"""Small files on the shared file system: names of a folder, whole texts, and
a file that only one writer can create."""

from __future__ import annotations

import os
import uuid
from urllib.parse import unquote, urlsplit

from pyspark.sql import SparkSession


def local_path(path: str) -> str | None:
    """The path on this machine, or None where another file system holds it."""
    parts = urlsplit(path)
    if parts.scheme == "file":
        return unquote(parts.path)
    return path if not parts.scheme and path.startswith("/") else None


def _hadoop(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _local(spark: SparkSession, path: str) -> str | None:
    """As :func:`local_path`; a path without a scheme is local only where the default file system is."""
    if path.startswith("/") and not spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///").startswith("file:"):
        return None
    return local_path(path)


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """The names in a folder, sorted; none where there is no such folder."""
    here = _local(spark, folder)
    if here is not None:
        return sorted(os.listdir(here)) if os.path.isdir(here) else []
    _, where, fs = _hadoop(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(where)) if fs.exists(where) else []


def read_text(spark: SparkSession, path: str) -> str:
    here = _local(spark, path)
    if here is not None:
        with open(here, encoding="utf-8") as f:
            return f.read()
    jvm, where, fs = _hadoop(spark, path)
    stream = fs.open(where)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Create the file with its whole text, unless it is there already: of
    several writers at once, one gets True.

    The text is written under a name of its own first, so no reader ever sees
    half of it.  Locally a hard link gives it its name, which fails where the
    name is taken; elsewhere a rename that may not overwrite, which file
    systems with atomic renames (HDFS and its like) decide in one place.
    """
    here = _local(spark, path)
    own = f"{uuid.uuid4().hex}.tmp"
    if here is not None:
        folder = os.path.dirname(here)
        os.makedirs(folder, exist_ok=True)
        draft = os.path.join(folder, f".{own}")
        with open(draft, "w", encoding="utf-8") as f:
            f.write(text)
            f.flush()
            os.fsync(f.fileno())
        try:
            os.link(draft, here)
            return True
        except FileExistsError:
            return False
        finally:
            os.unlink(draft)
    from py4j.protocol import Py4JJavaError

    jvm, where, fs = _hadoop(spark, path)
    draft = jvm.org.apache.hadoop.fs.Path(where.getParent(), f".{own}")
    out = fs.create(draft, False)
    out.write(bytearray(text.encode()))
    out.close()
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            where.toUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(draft, where, options)
        return True
    except Py4JJavaError as e:
        if "FileAlreadyExists" not in str(e.java_exception):
            raise
        fs.delete(draft, False)
        return False
