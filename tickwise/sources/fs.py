"""File-system checks through the session's Hadoop configuration (works for any Hadoop URI scheme)."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _fs_and_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, hpath


def _raw(spark: SparkSession, fs):
    """The file system below Hadoop's checksum layer, which hides its own side files."""
    layer = spark.sparkContext._jvm.java.lang.Class.forName("org.apache.hadoop.fs.ChecksumFileSystem")
    return fs.getRawFileSystem() if layer.isInstance(fs) else fs


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hpath = _fs_and_path(spark, path)
    return bool(fs.exists(hpath))


def make_folder(spark: SparkSession, path: str) -> None:
    fs, hpath = _fs_and_path(spark, path)
    fs.mkdirs(hpath)


def qualified(spark: SparkSession, path: str) -> str:
    """Fully qualified form of ``path`` (scheme and authority), as Spark reports file paths."""
    fs, hpath = _fs_and_path(spark, path)
    return str(fs.makeQualified(hpath).toString()).rstrip("/")


def delete_path(spark: SparkSession, path: str) -> bool:
    """Delete a file or folder tree; False when it did not exist. Destructive, explicit calls only."""
    fs, hpath = _fs_and_path(spark, path)
    return bool(fs.exists(hpath)) and bool(fs.delete(hpath, True))


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of everything directly in a folder, hidden entries included."""
    fs, folder = _fs_and_path(spark, path)
    return [s.getPath().getName() for s in _raw(spark, fs).listStatus(folder)] if fs.exists(folder) else []


def delete_children(spark: SparkSession, path: str, hidden_only: bool = False) -> int:
    """Empty a folder, keeping (or making) the folder itself; returns how many entries went.

    ``hidden_only`` removes just side files whose names begin with a dot. Destructive, explicit calls only.
    """
    fs, folder = _fs_and_path(spark, path)
    fs.mkdirs(folder)
    if hidden_only:
        raw = _raw(spark, fs)
        return sum(bool(raw.delete(s.getPath(), False)) for s in raw.listStatus(folder)
                   if s.getPath().getName().startswith(".") and s.isFile())
    return sum(bool(fs.delete(s.getPath(), True)) for s in fs.listStatus(folder))


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small text file whole; None when there is none."""
    fs, hpath = _fs_and_path(spark, path)
    if not fs.exists(hpath):
        return None
    stream = fs.open(hpath)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def publish_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small text file so that readers see it whole or not at all; False if it is there already."""
    fs, hpath = _fs_and_path(spark, path)
    raw = _raw(spark, fs)
    temporary = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.tmp")
    stream = raw.create(temporary, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    if not raw.exists(hpath) and raw.rename(temporary, hpath):
        return True
    raw.delete(temporary, False)
    return False


def move(spark: SparkSession, source: str, target: str) -> bool:
    """Rename a file or folder, without checksum side files; missing parent folders are made.

    False when the target is there already, which then stays as it is.
    """
    fs, hpath = _fs_and_path(spark, source)
    _, to = _fs_and_path(spark, target)
    raw = _raw(spark, fs)
    if raw.exists(to):
        return False
    raw.mkdirs(to.getParent())
    if not raw.rename(hpath, to):
        raise OSError(f"{source} could not be moved to {target}")
    return True


def files_below(spark: SparkSession, path: str) -> list[str]:
    """Relative paths of the visible files (no name on the way begins with a dot or underscore) below a folder."""
    fs, folder = _fs_and_path(spark, path)
    if not fs.exists(folder):
        return []
    top, found, listing = qualified(spark, path), [], fs.listFiles(folder, True)
    while listing.hasNext():
        name = str(fs.makeQualified(listing.next().getPath()).toString())[len(top) + 1:]
        if not any(part[:1] in "._" for part in name.split("/")):
            found.append(name)
    return sorted(found)
