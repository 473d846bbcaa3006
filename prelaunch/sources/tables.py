"""Parquet scans of the input tables (SRC2), column guards (SRC3, SRC4)."""

from __future__ import annotations

import os
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession


def require_path(path: str) -> str:
    """Fail early with a clear message when an input path is absent (SRC4).

    Only local paths are probed here; remote URIs are left to the reader,
    whose analysis error already names the missing path.
    """
    u = urlparse(path)
    local = u.path if u.scheme == "file" else (path if u.scheme == "" else None)
    if local is not None and not any(ch in local for ch in "*?[") and not os.path.exists(local):
        raise FileNotFoundError(f"input not found: {path}")
    return path


def read_table(spark: SparkSession, sf_dir: str, name: str,
               columns: list[str] | None = None) -> DataFrame:
    """Scan ``<sf_dir>/<name>.parquet``; selecting columns prunes the scan."""
    df = spark.read.parquet(require_path(os.path.join(sf_dir, f"{name}.parquet")))
    return df.select(*columns) if columns else df


def present(df: DataFrame, cols: list[str]) -> list[str]:
    """The subset of ``cols`` that exists in ``df``, in the given order (SRC3)."""
    have = set(df.columns)
    return [c for c in cols if c in have]
