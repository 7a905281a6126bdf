"""Path tests through the file system Spark itself would use for the address."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _hadoop(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    files, target = _hadoop(spark, path)
    return files.exists(target)


def qualified(spark: SparkSession, path: str) -> str:
    """The path with scheme and authority, as Spark spells it in file listings."""
    files, target = _hadoop(spark, path)
    return files.makeQualified(target).toString()


def write_committed(spark: SparkSession, path: str) -> bool:
    """True once a Spark write to ``path`` has been committed."""
    return path_exists(spark, f"{path.rstrip('/')}/_SUCCESS")


def child_files(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """Name, bytes and time (milliseconds) of the files directly below ``path``; nothing deeper is listed."""
    files, target = _hadoop(spark, path)
    listed = files.listStatus(target) if files.exists(target) else []
    return [(s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in listed if s.isFile()]


def child_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below ``path`` (version and date folders: a handful)."""
    files, target = _hadoop(spark, path)
    if not files.exists(target):
        return []
    return sorted(s.getPath().getName() for s in files.listStatus(target) if s.isDirectory())


def create_new(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file with ``text``; False if there is one already.  Of several callers one gets True."""
    files, target = _hadoop(spark, path)
    try:
        out = files.create(target, False)
    except Py4JJavaError as error:
        if files.exists(target):
            return False
        raise error
    out.write(bytearray(text.encode()))
    out.close()
    return True


def move_folder(spark: SparkSession, source: str, path: str) -> bool:
    """Move a folder to ``path`` in one step; False, and the folder is removed, if another one is there."""
    files, target = _hadoop(spark, path)
    origin = _hadoop(spark, source)[1]
    files.mkdirs(target.getParent())
    inside = f"{path.rstrip('/')}/{origin.getName()}"
    moved = not files.exists(target) and files.rename(origin, target)
    # Where another writer came first, the move may have ended inside of its folder.
    if moved and not path_exists(spark, inside):
        return True
    remove(spark, inside if path_exists(spark, inside) else source)
    return False


def remove(spark: SparkSession, path: str) -> None:
    files, target = _hadoop(spark, path)
    files.delete(target, True)
