"""Small files and first bytes, on any file system that Spark can reach."""

from __future__ import annotations

import io
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def file_system(spark: SparkSession, path: str):
    """The file system of a path, and the path as it takes it."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def read_bytes(spark: SparkSession, path: str, start: int, length: int) -> bytes:
    """At most ``length`` bytes from ``start`` on; only these are read."""
    fs, jvm_path = file_system(spark, path)
    stream = fs.open(jvm_path)
    try:
        stream.seek(start)
        left = min(length, fs.getFileStatus(jvm_path).getLen() - start)
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream, int(left))) if left > 0 else b""
    finally:
        stream.close()


def read_text(spark: SparkSession, path: str) -> str:
    fs, jvm_path = file_system(spark, path)
    return read_bytes(spark, path, 0, fs.getFileStatus(jvm_path).getLen()).decode()


def publish_text(spark: SparkSession, path: str, text: str) -> bool:
    """Make a small file appear whole in one step; False when the name is taken."""
    fs, target = file_system(spark, path)
    hidden = spark._jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{target.getName()}.{spark._jvm.java.util.UUID.randomUUID()}")
    stream = fs.create(hidden, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
    never_replace = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(fs.makeQualified(hidden), fs.makeQualified(target), never_replace)
    except Py4JJavaError as error:
        fs.delete(hidden, False)
        if error.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
            return False
        raise
    return True


def join_files(spark: SparkSession, parts: Iterable[str], path: str, buffer: int = 1 << 20) -> None:
    """The bytes of the parts, one after another, as a new file that appears whole; one buffer is held at a time."""
    fs, target = file_system(spark, path)
    hidden = spark._jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{target.getName()}.{spark._jvm.java.util.UUID.randomUUID()}")
    out = fs.create(hidden, False)
    try:
        for part in parts:
            part_fs, part_path = file_system(spark, part)
            stream = part_fs.open(part_path)
            try:
                spark._jvm.org.apache.hadoop.io.IOUtils.copyBytes(stream, out, buffer, False)
            finally:
                stream.close()
    finally:
        out.close()
    if not fs.rename(hidden, target):
        raise OSError(f"could not put {path} in its place")


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """Names directly in a folder, hidden ones left out; none when the folder is missing."""
    fs, jvm_path = file_system(spark, folder)
    if not fs.exists(jvm_path):
        return []
    names = (status.getPath().getName() for status in fs.listStatus(jvm_path))
    return sorted(n for n in names if not n.startswith((".", "_")))


def delete(spark: SparkSession, path: str) -> None:
    fs, jvm_path = file_system(spark, path)
    fs.delete(jvm_path, True)


class RemoteFile(io.RawIOBase):
    """Random access to a file for readers that want a Python file; reads only what is asked for."""

    def __init__(self, spark: SparkSession, path: str, size: int):
        self.spark, self.path, self.size, self.at = spark, path, size, 0

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def tell(self) -> int:
        return self.at

    def seek(self, offset: int, whence: int = io.SEEK_SET) -> int:
        self.at = offset + {io.SEEK_SET: 0, io.SEEK_CUR: self.at, io.SEEK_END: self.size}[whence]
        return self.at

    def readinto(self, buffer) -> int:
        data = read_bytes(self.spark, self.path, self.at, len(buffer))
        buffer[: len(data)] = data
        self.at += len(data)
        return len(data)


def each_file(paths: Iterable[str], read: Callable[[str], object], at_once: int = 16) -> Iterator[tuple[str, object]]:
    """``read`` of every path, some at a time, for facts a file's first bytes or its index hold."""
    with ThreadPoolExecutor(at_once) as pool:
        paths = list(paths)
        yield from zip(paths, pool.map(read, paths))
