"""Small files that decide who goes first and that readers switch to all at once.

A marker is created exclusively: of several jobs that try, one succeeds. HDFS and local folders do
this; an object store needs conditional writes for it. Contents are short texts.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


class _Folder:
    """The file system calls of this module; local files go through the JVM's own, which is exclusive."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm = spark._jvm
        self.path = self.jvm.org.apache.hadoop.fs.Path(path)
        self.store = self.path.getFileSystem(spark._jsc.hadoopConfiguration())
        self.local = self.store.getUri().getScheme() == "file"
        if self.local:
            uri = self.store.makeQualified(self.path).toUri()
            self.file = self.jvm.java.nio.file.Paths.get(uri.getPath(), spark._sc._gateway.new_array(self.jvm.String, 0))
        self.gateway = spark._sc._gateway

    def options(self, kind, *values):
        made = self.gateway.new_array(kind, len(values))
        for k, value in enumerate(values):
            made[k] = value
        return made


def _exclusive(folder: _Folder) -> bool:
    from py4j.protocol import Py4JJavaError

    folder.store.mkdirs(folder.path.getParent())
    try:
        if folder.local:
            files = folder.jvm.java.nio.file.Files
            files.createFile(folder.file, folder.options(folder.jvm.java.nio.file.attribute.FileAttribute))
        else:
            folder.store.create(folder.path, False).close()
    except Py4JJavaError as problem:
        if "AlreadyExist" in problem.java_exception.getClass().getSimpleName():
            return False
        raise
    return True


def create_once(spark: SparkSession, path: str, text: str = "") -> bool:
    """Create the marker and say whether this call did it; an existing one stays as it is."""
    made = _exclusive(_Folder(spark, path))
    if made and text:
        swap_text(spark, path, text)
    return made


def swap_text(spark: SparkSession, path: str, text: str) -> None:
    """Replace the file by one rename: readers see the old text or the new one, never a part."""
    beside = f"{path}.{uuid.uuid4().hex}"
    new, old = _Folder(spark, beside), _Folder(spark, path)
    new.store.mkdirs(new.path.getParent())
    data = bytearray(text.encode("utf-8"))
    if old.local:
        files, copy = old.jvm.java.nio.file.Files, old.jvm.java.nio.file.StandardCopyOption
        files.write(new.file, data, old.options(old.jvm.java.nio.file.OpenOption))
        files.move(new.file, old.file, old.options(old.jvm.java.nio.file.CopyOption, copy.ATOMIC_MOVE, copy.REPLACE_EXISTING))
        return
    out = new.store.create(new.path, False)
    out.write(data)
    out.close()
    hadoop = old.jvm.org.apache.hadoop.fs
    context = hadoop.FileContext.getFileContext(old.store.getUri(), spark._jsc.hadoopConfiguration())
    context.rename(new.path, old.path, old.options(hadoop.Options.Rename, hadoop.Options.Rename.OVERWRITE))


def text_of(spark: SparkSession, path: str) -> str | None:
    """The file's text; None without one."""
    folder = _Folder(spark, path)
    if not folder.store.exists(folder.path):
        return None
    if folder.local:
        return bytes(folder.jvm.java.nio.file.Files.readAllBytes(folder.file)).decode("utf-8")
    stream = folder.store.open(folder.path)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def remove(spark: SparkSession, path: str) -> bool:
    folder = _Folder(spark, path)
    return folder.store.delete(folder.path, True)


def numbers(spark: SparkSession, folder: str, name: str) -> list[int]:
    """Numbers n for which `folder/name=n` exists, ascending."""
    found = _Folder(spark, f"{folder}/{name}=*")
    statuses = found.store.globStatus(found.path) or []
    tails = [status.getPath().getName().split("=", 1)[1] for status in statuses]
    return sorted(int(tail) for tail in tails if tail.isdigit())


def claim_number(spark: SparkSession, folder: str, name: str, least: int = 0, text: str = "") -> int:
    """The lowest number from `least` on that nobody has claimed yet, now claimed."""
    taken = numbers(spark, folder, name)
    number = max([least, *[n + 1 for n in taken]])
    while not create_once(spark, f"{folder}/{name}={number}", text):
        number += 1
    return number
