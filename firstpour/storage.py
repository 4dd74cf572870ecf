"""Folder operations through Spark's own Hadoop file systems, and the shared scratch folder."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _open(spark, path)
    return fs.exists(target)


def make_dirs(spark: SparkSession, path: str) -> None:
    fs, target = _open(spark, path)
    fs.mkdirs(target)


def delete(spark: SparkSession, path: str) -> None:
    fs, target = _open(spark, path)
    fs.delete(target, True)


def delete_file(spark: SparkSession, uri: str) -> None:
    """Delete a file named as a scan's metadata names it: as an encoded URI."""
    target = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(uri))
    fs = target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    fs.delete(target, False)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names directly under a folder, hidden ones left out; none when it does not exist."""
    fs, target = _open(spark, path)
    if not fs.exists(target):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(target)]
    return sorted(name for name in names if not name.startswith(("_", ".")))


def hidden(spark: SparkSession, path: str, prefix: str) -> list[str]:
    """Names under a folder that begin with ``prefix``, which Spark's scans pass over where it is an
    underscore or a dot."""
    fs, target = _open(spark, path)
    if not fs.exists(target):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(target)]
    return sorted(name for name in names if name.startswith(prefix))


def files(spark: SparkSession, path: str, prefix: str = "") -> list[tuple[str, int]]:
    """Name and bytes of the files directly under a folder, hidden ones left out."""
    fs, target = _open(spark, path)
    if not fs.exists(target):
        return []
    found = [(s.getPath().getName(), s.getLen()) for s in fs.listStatus(target) if s.isFile()]
    return sorted((n, size) for n, size in found if n.startswith(prefix) and not n.startswith(("_", ".")))


def rename(spark: SparkSession, source: str, target: str) -> bool:
    """Give a file another name in one step; false where that name is taken."""
    jvm = spark._jvm
    fs, old = _open(spark, source)
    new = fs.makeQualified(jvm.org.apache.hadoop.fs.Path(target))
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    keep = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf)
        context.rename(fs.makeQualified(old), new, keep)
    except Py4JJavaError as error:
        name = error.java_exception.getClass().getSimpleName()
        if name == "FileAlreadyExistsException":
            return False
        if name != "UnsupportedFileSystemException":
            raise
        # a store without that interface: its own rename, after a look
        return not fs.exists(new) and fs.rename(old, new)
    return True


def write_text(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file that shows whole or not at all; false, and nothing changed, where there is
    one of that name, so of several writers one succeeds."""
    folder, _, name = path.rpartition("/")
    make_dirs(spark, folder)
    temporary = f"{folder}/.{name}-{uuid.uuid4().hex}"
    fs, target = _open(spark, temporary)
    out = fs.create(target, False)
    out.write(bytearray(text.encode()))
    out.close()
    done = rename(spark, temporary, path)
    if not done:
        delete(spark, temporary)
    return done


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text; nothing where it does not exist (any more)."""
    fs, target = _open(spark, path)
    try:
        stream = fs.open(target)
    except Py4JJavaError as error:
        if error.java_exception.getClass().getSimpleName() not in ("FileNotFoundException", "NoSuchFileException"):
            raise
        return None
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh folder name every executor can reach.

    The cluster names its shared folder in ``spark.checkpoint.dir``. Only a local session, where
    driver and executors are one process, may fall back to a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder shared by all executors")
        base = tempfile.mkdtemp(prefix="firstpour-")
        atexit.register(shutil.rmtree, base, ignore_errors=True)
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
