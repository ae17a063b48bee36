"""Column guards, coercion and model-matrix projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.payload import parse_wall_time


def require_columns(df: DataFrame, cols) -> DataFrame:
    """B1: raise ``ValueError`` listing required columns that are absent."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"Missing required columns: {missing}")
    return df


def parse_utc_strict(df: DataFrame, col: str = "ts") -> DataFrame:
    """B2: parse ``col`` as UTC; any missing or unparseable value fails the job.

    The check is a filter, which no later projection or count prunes; it runs
    on the executors as part of the same scan (no extra pass, no collect).
    """
    raw = F.col(col)
    parsed = raw.cast("timestamp") if dict(df.dtypes)[col].startswith("timestamp") else parse_wall_time(raw)
    failure = F.raise_error(F.concat(F.lit("Unable to parse timestamp: "), F.coalesce(raw.cast("string"), F.lit("NULL"))))
    return df.filter(F.when(parsed.isNull(), failure.cast("boolean")).otherwise(True)).withColumn(col, parsed)


def coerce_numeric(df: DataFrame, cols) -> DataFrame:
    """Tolerant numeric coercion (bad text -> NULL, NaN -> NULL)."""
    out = df
    for c in cols:
        if c in out.columns:
            v = F.col(c).try_cast("double") if dict(out.dtypes)[c] == "string" else F.col(c).cast("double")
            out = out.withColumn(c, F.when(~F.isnan(v), v))
    return out


def model_matrix(df: DataFrame, categories: list[str], numeric: list[str], key: str = "city", ts: str = "ts", labels: tuple[str, ...] = ()) -> DataFrame:
    """Epoch seconds, one-hot city over sorted categories (all kept),
    numeric features with NULL -> 0; ``labels`` stay as they are."""
    cats = sorted(categories)
    onehot = [F.when(F.col(key) == c, F.lit(1)).otherwise(F.lit(0)).cast("int").alias(f"{key}_{c}") for c in cats]
    return df.select(
        key,
        ts,
        F.unix_seconds(F.col(ts)).alias("epoch_seconds"),
        *onehot,
        *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in numeric],
        *labels,
    )


def categories_of(df: DataFrame, key: str = "city", most: int = 1000) -> list[str]:
    """Distinct category labels. Each becomes a column of the model matrix, so
    more than ``most`` of them is an error, not a wider matrix."""
    found = df.select(key).distinct().limit(most + 1).collect()
    if len(found) > most:
        raise ValueError(f"{key} has more than {most} categories")
    return sorted(r[0] for r in found)


def zero_fill(df: DataFrame, targets: list[str]) -> DataFrame:
    """Drop rows without targets, then fill remaining feature NULLs with 0."""
    return df.dropna(subset=targets).fillna(0.0)


def select_for_target(df: DataFrame, mode: str, target_cols: dict[str, str], exclude=("ts", "timestamp")) -> tuple[list[str], str]:
    """Feature columns and the target column for a target mode."""
    if mode not in target_cols:
        raise ValueError(f"unknown target mode {mode!r}")
    excluded = set(exclude) | set(target_cols.values())
    feats = [c for c, t in df.dtypes if c not in excluded and t in ("double", "float", "int", "bigint")]
    return feats, target_cols[mode]


def selections(df: DataFrame, mode: str, target_cols: dict[str, str], exclude=("ts", "timestamp")) -> dict[str, tuple[list[str], str]]:
    """B28 by target: one mode, or every target for ``both``."""
    return {m: select_for_target(df, m, target_cols, exclude) for m in (target_cols if mode == "both" else [mode])}
