"""Shared folder for what a job writes for itself."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

from auditlake.sources.files import remove

_FALLBACK: dict[str, str] = {}
_RUN: ContextVar[str | None] = ContextVar("run folder", default=None)


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; a temporary folder of a local session that
    sets none. On a cluster other machines could not see that one, so it is refused."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if base:
        return base.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
    if "dir" not in _FALLBACK:
        _FALLBACK["dir"] = tempfile.mkdtemp(prefix="auditlake-")
    return _FALLBACK["dir"]


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A folder nobody has written to yet."""
    return f"{_RUN.get() or shared_folder(spark) + '/auditlake'}/{name}-{uuid.uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """What operators write for themselves inside the block is removed when it ends.

    Their results read it, so a result has to be stored within the block.
    """
    folder = fresh_folder(spark, "run")
    before = _RUN.set(folder)
    try:
        yield folder
    finally:
        _RUN.reset(before)
        remove(spark, folder)
