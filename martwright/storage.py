"""Where intermediate tables go, and small files that say what a folder holds."""

import uuid

from pyspark.sql import SparkSession


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder named by ``spark.checkpoint.dir``.

    Every call returns a new path, so concurrent jobs and retries never overwrite each
    other. There is no fallback: a folder of one machine would work until the executors run
    on others.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return f"{base.rstrip('/')}/martwright/{label}-{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders below ``path``, the one changed last first."""
    system, target = _file_system(spark, path)
    if not system.exists(target):
        return []
    found = [entry for entry in system.listStatus(target) if entry.isDirectory()]
    found.sort(key=lambda entry: (-entry.getModificationTime(), entry.getPath().getName()))
    return [entry.getPath().getName() for entry in found]


def discard(spark: SparkSession, path: str) -> None:
    """Delete a folder with everything in it."""
    system, target = _file_system(spark, path)
    system.delete(target, True)


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text; None if there is no such file."""
    system, target = _file_system(spark, path)
    if not system.exists(target):
        return None
    stream = system.open(target)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file, replacing what was there in one step: a reader sees the old text or the
    new one, whenever the writer dies."""
    system, draft = _file_system(spark, f"{path}.{uuid.uuid4().hex}.tmp")
    _write(system.create(draft, False), text)
    files = spark._jvm.org.apache.hadoop.fs
    overwrite = spark.sparkContext._gateway.new_array(files.Options.Rename, 1)
    overwrite[0] = files.Options.Rename.OVERWRITE
    context = files.FileContext.getFileContext(draft.toUri(), spark._jsc.hadoopConfiguration())
    context.rename(draft, files.Path(path), overwrite)


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file unless there is one already; of several writers one succeeds."""
    system, target = _file_system(spark, path)
    system.mkdirs(target.getParent())
    try:
        stream = system.create(target, False)
    except Exception:
        if system.exists(target):
            return False
        raise
    _write(stream, text)
    return True


def _write(stream, text: str) -> None:
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of everything in a folder, in order; none if there is no such folder."""
    system, target = _file_system(spark, path)
    if not system.exists(target):
        return []
    return sorted(entry.getPath().getName() for entry in system.listStatus(target))


def listed(spark: SparkSession, paths: list[str]) -> list[tuple[str, int, int]]:
    """Path, length and time of change of every file that the paths (files, folders or patterns) name,
    in order. Hidden files do not count."""
    found = []
    for path in paths:
        system, target = _file_system(spark, path)
        todo = list(system.globStatus(target) or [])
        while todo:
            entry = todo.pop()
            if entry.isDirectory():
                todo += [e for e in system.listStatus(entry.getPath()) if e.getPath().getName()[0] not in "._"]
            else:
                found.append((entry.getPath().toString(), entry.getLen(), entry.getModificationTime()))
    return sorted(found)
