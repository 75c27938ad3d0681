"""The shared folder and what is left in it."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from auditlake.sources.discovery import discover_paths
from auditlake.sources.workspace import fresh_folder, scratch


def test_scratch_goes_and_results_stay(spark, tmp_path):
    events = spark.range(5).select(F.lit("c").alias("class_name"), F.parse_json(F.lit('{"a": [1]}')).alias("body"))
    with scratch(spark) as folder:
        discover_paths(events).write.parquet(str(tmp_path / "found"))
        assert any(Path(folder.removeprefix("file:")).iterdir())
    assert not Path(folder.removeprefix("file:")).exists()
    assert spark.read.parquet(str(tmp_path / "found")).count() == 3
    assert not fresh_folder(spark, "x").startswith(folder)


def test_scratch_goes_after_a_failure(spark):
    with pytest.raises(RuntimeError), scratch(spark) as folder:
        spark.range(1).write.parquet(fresh_folder(spark, "part"))
        raise RuntimeError
    assert not Path(folder.removeprefix("file:")).exists()
