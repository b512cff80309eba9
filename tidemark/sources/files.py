"""Small files and folders of a hub through Hadoop's file systems: manifests that only one
writer can create, and folders that are no longer needed. Data is never read or written here."""

from __future__ import annotations

import os
import uuid
from urllib.parse import unquote, urlparse

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    """Hadoop's file system and the full path."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs, fs.makeQualified(p)


def create_exclusive(spark: SparkSession, path: str, text: str) -> bool:
    """Creates ``path`` with ``text`` if there is no such file yet, else returns False. Of several
    writers one wins, and readers see the whole text or no file.

    The text goes to a hidden file beside it first, which then gets the name: by a link on a
    local file system, elsewhere by Hadoop's rename that fails where the name is taken. HDFS
    does that in one step. On an object store without such a rename let one writer commit
    at a time.
    """
    fs, target = _path(spark, path)
    hidden = f".{target.getName()}-{uuid.uuid4().hex}"
    if fs.getUri().getScheme() == "file":
        local = target.toUri().getPath()
        os.makedirs(os.path.dirname(local), exist_ok=True)
        draft = os.path.join(os.path.dirname(local), hidden)
        with open(draft, "w", encoding="utf-8") as f:
            f.write(text)
        try:
            os.link(draft, local)
        except FileExistsError:
            return False
        finally:
            os.unlink(draft)
        return True
    jvm = spark._jvm
    fs.mkdirs(target.getParent())
    draft = jvm.org.apache.hadoop.fs.Path(target.getParent(), hidden)
    out = fs.create(draft, False)
    out.write(bytearray(text.encode()))
    out.close()
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark._sc._gateway.new_array(rename, 1)
    options[0] = rename.NONE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(draft, target, options)
    except Exception:
        fs.delete(draft, False)
        if fs.exists(target):
            return False
        raise
    return True


def _listed(spark: SparkSession, path: str, kind: bool) -> list[tuple[str, str, int]]:
    fs, p = _path(spark, path)
    if not fs.exists(p):
        return []
    return [(s.getPath().getName(), s.getPath().toString(), s.getModificationTime()) for s in fs.listStatus(p) if s.isDirectory() == kind]


def folders(spark: SparkSession, path: str) -> list[tuple[str, str, int]]:
    """(name, full path, time of the last change in ms) of the folders in ``path``."""
    return _listed(spark, path, True)


def files(spark: SparkSession, path: str) -> list[tuple[str, str, int]]:
    """The same of the files in ``path``."""
    return _listed(spark, path, False)


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a file or folder; one that is gone already is no error."""
    fs, p = _path(spark, path)
    fs.delete(p, True)


def plain(path: str) -> str:
    """``path`` without scheme and host, for comparing paths of one store."""
    return unquote(urlparse(path).path).rstrip("/")
