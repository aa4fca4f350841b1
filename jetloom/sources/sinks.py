"""Writers: Parquet by sample and split, weighted copies, histogram and tensor tables."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_table(df: DataFrame, path: str, mode: str = "errorifexists", partition_by: tuple[str, ...] = ()) -> str:
    """Parquet at ``path``; the committer's _SUCCESS file marks a whole result."""
    writer = df.write.mode(mode)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return path


def write_split(df: DataFrame, path: str, mode: str = "errorifexists") -> str:
    """One folder per sample and split, so that reading one prunes the others."""
    return write_table(df, path, mode, ("sample", "split"))


def write_weighted(df: DataFrame, source_path: str, path: str, mode: str = "errorifexists") -> str:
    """A weighted copy; never onto the files that are being read."""
    if path.rstrip("/") == source_path.rstrip("/"):
        raise ValueError("the weighted copy needs a path of its own")
    return write_table(df, path, mode)
