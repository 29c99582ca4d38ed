"""Single small files in the folders of a run, in the store where Spark reads and writes them."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyarrow import fs
from pyspark.sql import SparkSession


def _store(path: str):
    """(file system, path) as Spark takes the path: a path without a scheme is one of its default store. None in a task, which has no session."""
    session = SparkSession.getActiveSession()
    if session is None:
        return None
    at = session._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(session._jsc.hadoopConfiguration()), at


def qualified(path: str) -> str:
    """The path with its scheme, so that tasks take it for what the driver takes it for."""
    store = _store(path)
    return path if store is None else store[0].makeQualified(store[1]).toString()


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """In a task: the file system of a path or URI, and the path in it."""
    if path.startswith("file:") or ":/" not in path:
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/") if path.startswith("file:") else path
    return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


def exists(path: str) -> bool:
    store = _store(path)
    if store is not None:
        return store[0].exists(store[1])
    system, at = opened(path)
    return system.get_file_info(at).type != fs.FileType.NotFound


def read(path: str) -> bytes:
    store = _store(path)
    if store is not None:
        stream = store[0].open(store[1])
        try:
            return bytes(SparkSession.getActiveSession()._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
        finally:
            stream.close()
    system, at = opened(path)
    with system.open_input_stream(at) as stream:
        return stream.read()


def write(path: str, content: bytes) -> None:
    """Write a file whole or not at all; one that is there is replaced."""
    folder, _, name = path.rpartition("/")
    part = f"{folder}/.{name}.{uuid.uuid4().hex}"
    store = _store(path)
    if store is not None:
        system, at = store
        beside = SparkSession.getActiveSession()._jvm.org.apache.hadoop.fs.Path(part)
        stream = system.create(beside, True)
        try:
            stream.write(bytearray(content))
        finally:
            stream.close()
        if system.exists(at):
            system.delete(at, False)
        system.rename(beside, at)
        return
    system, at = opened(path)
    beside = opened(part)[1]
    system.create_dir(at.rpartition("/")[0], recursive=True)
    with system.open_output_stream(beside) as stream:
        stream.write(content)
    system.move(beside, at)


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, which need not have it installed; once for each application."""
    context = spark.sparkContext
    if _SHIPPED.get("app") == context.applicationId:
        return
    root = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="spark-")) / f"{root.name}.zip"  # the driver's own copy, which Spark then serves
    with zipfile.ZipFile(target, "w") as archive:
        for path in sorted(root.rglob("*.py")):
            archive.write(path, path.relative_to(root.parent).as_posix())
    context.addPyFile(str(target))
    _SHIPPED["app"] = context.applicationId


_SHIPPED: dict[str, str] = {}
