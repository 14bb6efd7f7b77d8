"""A session with the settings that results depend on: UTC, ANSI, adaptive plans."""

from __future__ import annotations

import tempfile
from urllib.parse import urlparse

from pyspark.sql import SparkSession


def session(master: str = "local[*]", partitions: int = 8, **conf: str) -> SparkSession:
    settings = {"spark.sql.session.timeZone": "UTC", "spark.sql.ansi.enabled": "true", "spark.sql.adaptive.enabled": "true", "spark.sql.shuffle.partitions": str(partitions), "spark.ui.enabled": "false", "spark.cleaner.referenceTracking.cleanCheckpoints": "true"}
    return SparkSession.builder.master(master).config(map=settings | conf).getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir, which driver and executors share. Unset, local mode gets a folder of its own; a cluster raises."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None and not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="ledgerlark-"))
    return sc.getCheckpointDir()


def _files(path: str):
    from pyarrow import fs

    if not urlparse(path).scheme:
        return fs.LocalFileSystem(), path
    if path.startswith("file:/"):
        return fs.LocalFileSystem(), urlparse(path).path
    return fs.FileSystem.from_uri(path)


def exists(path: str) -> bool:
    from pyarrow import fs

    files, at = _files(path)
    return files.get_file_info(at).type != fs.FileType.NotFound


def remove(path: str) -> None:
    """Delete a folder, if it is there."""
    files, at = _files(path)
    if exists(path):
        files.delete_dir(at)


def move(old: str, new: str) -> None:
    files, at = _files(old)
    files.move(at, _files(new)[1])
