"""Intermediate tables on shared storage.

A table that several later passes read is written once, so those passes agree on
it and a lost executor costs a read instead of a recomputation.
"""

from __future__ import annotations

import atexit
import contextlib
import re
import shutil
import tempfile
import uuid

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

_local_root: str | None = None
_open: list[Scratch] = []


def scratch_root(spark: SparkSession) -> str:
    """The shared folder of the session; a fresh temporary one if the session runs in this process and names none."""
    global _local_root
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "")):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="run-")
        atexit.register(shutil.rmtree, _local_root, ignore_errors=True)
    return _local_root


class Scratch:
    """One run's own folder below the shared one, deleted when the driver ends at the latest.

    The folder is the place of a database of its own, because dropping a database
    deletes its folder on any file system Spark can write to.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.name = f"weftgraph_{uuid.uuid4().hex}"
        self.path = f"{scratch_root(spark).rstrip('/')}/{self.name}"
        spark.sql(f"CREATE DATABASE {self.name} LOCATION {_literal(self.path)}")
        _open.append(self)

    def folder(self, name: str) -> str:
        return f"{self.path}/{name}-{uuid.uuid4().hex[:8]}"

    def keep(self, frame: DataFrame, name: str) -> DataFrame:
        """Write the frame and return it as read back."""
        path = self.folder(name)
        frame.write.parquet(path)
        return self.spark.read.schema(frame.schema).parquet(path)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *failure: object) -> None:
        self.discard()

    def discard(self) -> None:
        """Delete this run's folder."""
        _open.remove(self)
        self.spark.sql(f"DROP DATABASE {self.name} CASCADE")


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder on any file system, as that of a database made for it."""
    name = f"weftgraph_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION {_literal(path)}")
    spark.sql(f"DROP DATABASE {name} CASCADE")


def _literal(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


@atexit.register
def _discard_all() -> None:
    for scratch in list(_open):
        # Once its session has stopped, a folder can only be deleted from outside.
        with contextlib.suppress(PySparkException, AttributeError, ConnectionError, OSError):
            scratch.discard()
