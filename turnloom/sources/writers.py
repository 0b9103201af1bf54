"""Write datasets and JSONL."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def write_splits(
    df: DataFrame,
    root: str,
    split: str = "split",
    mode: str = "errorifexists",
    max_records_per_file: int = 1_000_000,
) -> None:
    """Parquet with one directory per split below ``root``.

    Tasks write their own files, so the large split is not gathered into one task.
    """
    (
        df.write.mode(mode)
        .option("maxRecordsPerFile", max_records_per_file)
        .partitionBy(split)
        .parquet(root)
    )


def write_jsonl(
    df: DataFrame, path: str, mode: str = "errorifexists", drop: Sequence[str] = ()
) -> None:
    """A directory of JSONL part files, one object per row; ``drop`` leaves out keys."""
    df.drop(*drop).write.mode(mode).json(path)
