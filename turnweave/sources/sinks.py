"""Writers: JSON lines, text by key, datasets, manifests, append-only progress."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .keyed_files import write_named_texts, write_wavs

#: Columns of progress lines and of synthesis manifests.  Fixed values.
PROGRESS_COLUMNS = ["ts", "rank", "world", "gpu", "topic", "txt", "dialogue_id", "status", "returncode", "done", "total", "generated", "skipped", "failed", "elapsed_sec", "log_or_err"]
MANIFEST_COLUMNS = ["speaker_prompt_audio_filename", "speaker_prompt_text_transcription", "content_to_synthesize", "output_audio_filename"]


def write_json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_texts(df: DataFrame, path: str) -> None:
    """Each row's text as a file of its own, ``topic/stage/name.txt``; ``read_texts`` gives the rows back."""
    write_named_texts(df.select(F.concat_ws("/", "topic", "stage", F.concat("name", F.lit(".txt"))).alias("name"), "text"), path)


def write_mixes(tiles: DataFrame, path: str, name: Column, rate: int = 24_000) -> None:
    """Mixes or slices (``tile`` or ``part``, ``left, right``) as one WAV file for each ``name``."""
    part = F.col("part") if "part" in tiles.columns else F.col("tile")
    write_wavs(tiles.select(name.alias("name"), part.alias("part"), "left", "right"), path, rate)


def write_dataset(df: DataFrame, path: str) -> None:
    """The table as Parquet, and as JSON beside it."""
    df.write.mode("overwrite").parquet(f"{path}/parquet")
    df.write.mode("overwrite").json(f"{path}/json")


def write_manifest(df: DataFrame, path: str) -> None:
    df.select(*MANIFEST_COLUMNS).write.mode("overwrite").csv(path, header=True)


def append_progress(df: DataFrame, path: str) -> None:
    """Progress lines; each task adds a file of its own, so no lock is needed."""
    df.select(*PROGRESS_COLUMNS).write.mode("append").csv(path, sep="\t", header=False)


def write_quarantine(df: DataFrame, error: str, path: str) -> DataFrame:
    """Writes the rows with an error and returns the others."""
    df.where(F.col(error).isNotNull()).write.mode("append").json(path)
    return df.where(F.col(error).isNull()).drop(error)
