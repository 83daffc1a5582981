"""Directory operations on whatever file system a table path names."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import SparkSession

# Directory value Spark gives to rows whose partition column is NULL.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def _open(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _open(spark, path)
    return fs.exists(where)


def content_mark(spark: SparkSession, path: str) -> str:
    """Names, sizes and times of what lies in a folder: another mark means other content."""
    fs, where = _open(spark, path)
    found = []
    for status in fs.listStatus(where):
        inside = fs.listStatus(status.getPath()) if status.isDirectory() else [status]
        found += [f"{s.getPath()} {s.getLen()} {s.getModificationTime()}" for s in inside]
    return " ".join(sorted(found))


def partition_dirs(spark: SparkSession, path: str, column: str) -> dict[str, str]:
    """Partition value -> directory for the top-level partition column of a table."""
    fs, where = _open(spark, path)
    if not fs.exists(where):
        return {}
    prefix = f"{column}="
    dirs = (s.getPath() for s in fs.listStatus(where) if s.isDirectory())
    return {
        unquote(d.getName()[len(prefix):]): d.toString() for d in dirs if d.getName().startswith(prefix)
    }


def delete_dir(spark: SparkSession, path: str) -> None:
    fs, where = _open(spark, path)
    fs.delete(where, True)


def plain_path(spark: SparkSession, uri: str) -> str:
    """Path of a file that ``_metadata.file_path`` names; that is a URI, with its special characters escaped."""
    return spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(uri)).toString()


def data_files(spark: SparkSession, path: str) -> list[str]:
    """Names of the data files below a folder, relative to it; what readers pass over is left out."""
    fs, where = _open(spark, path)
    if not fs.exists(where):
        return []
    root = fs.resolvePath(where).toString() + "/"
    found, listed = [], fs.listFiles(where, True)
    while listed.hasNext():
        found.append(listed.next().getPath().toString()[len(root):])
    hidden = lambda part: part.startswith(("_", ".")) and "=" not in part
    return sorted(name for name in found if not any(map(hidden, name.split("/"))))


def move(spark: SparkSession, path: str, target: str) -> None:
    fs, where = _open(spark, path)
    to = spark._jvm.org.apache.hadoop.fs.Path(target)
    fs.mkdirs(to.getParent())
    if not fs.rename(where, to):
        raise OSError(f"cannot move {path} to {target}")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, complete or not there at all."""
    fs, where = _open(spark, path)
    part = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.part")
    out = fs.create(part, True)
    out.write(bytearray(text.encode()))
    out.close()
    fs.delete(where, False)
    move(spark, f"{path}.part", path)


def read_text(spark: SparkSession, path: str) -> str:
    fs, where = _open(spark, path)
    stream = fs.open(where)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
