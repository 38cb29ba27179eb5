"""Writers. All of them write from the tasks, one file per partition; none collects."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callsift.functions.text import truncate
from callsift.operators.ranking import first_rows
from callsift.session import written

# --- fixed values: sizes of the preview sink ----------------------------------------------------

PREVIEW_ROWS = 200
RAW_SAMPLES = 50
RAW_SAMPLE_CHARS = 100_000
STEM_CHARS = 60


def write_parquet(df: DataFrame, path: str, mode: str = "error") -> None:
    df.write.mode(mode).parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "error") -> None:
    """Headered, fully quoted CSV. White space is kept and null is told from ''."""
    df.write.mode(mode).csv(
        path,
        header=True,
        quoteAll=True,
        escape='"',
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )


def write_jsonl(df: DataFrame, path: str, mode: str = "error") -> None:
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def write_pack(packs: DataFrame, path: str, mode: str = "error") -> None:
    """One JSON object per intent with its ``samples``."""
    write_jsonl(packs, path, mode)


def write_pack_parts(parts: DataFrame, path: str, mode: str = "error") -> None:
    """``packs/`` holds one JSON object per part, ``manifest/`` the parts and samples of each intent."""
    write_jsonl(parts, f"{path}/packs", mode)
    sizes = parts.sparkSession.read.schema(parts.schema).json(f"{path}/packs")
    manifest = sizes.groupBy("intent_id").agg(
        F.count("*").alias("parts"), F.sum(F.size("samples")).alias("samples")
    )
    write_jsonl(manifest, f"{path}/manifest", mode)


def preview(df: DataFrame, order: Sequence[str], n: int = PREVIEW_ROWS) -> DataFrame:
    return first_rows(df, order, n)


def raw_samples(
    df: DataFrame, order: Sequence[str], text: str = "text", name: str = "file_name"
) -> DataFrame:
    """``(sample, text)`` of the first rows: a numbered name with a short stem, the text cut."""
    stem = F.regexp_replace(
        F.regexp_extract(F.col(name), r"([^/]*)$", 1), r"(?<=.)\.[^.]*$", ""
    )
    top = df.orderBy(*order).limit(RAW_SAMPLES)
    from pyspark.sql.window import Window

    place = F.row_number().over(Window.orderBy(*order))  # at most RAW_SAMPLES rows
    return top.select(
        F.concat(
            F.lit("sample_"), F.lpad(place.cast("string"), 4, "0"), F.lit("__"),
            F.substring(stem, 1, STEM_CHARS),
        ).alias("sample"),
        truncate(text, RAW_SAMPLE_CHARS).alias("text"),
    )


def write_preview(df: DataFrame, order: Sequence[str], path: str, mode: str = "error") -> None:
    """``preview/`` holds the first rows as CSV, ``samples/`` one text file per raw sample. The first
    rows are found once, in one evaluation of ``df``."""
    top = written(preview(df, order), "preview")  # PREVIEW_ROWS rows, more than there are samples
    write_csv(top, f"{path}/preview", mode)
    raw_samples(top, order).repartition("sample").write.mode(mode).partitionBy("sample").text(
        f"{path}/samples"
    )
