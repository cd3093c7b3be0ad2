"""Calendar position of a bucket as points on a circle."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def on_circle(position: Column, period: float) -> tuple[Column, Column]:
    angle = F.lit(2.0) * F.pi() * position / F.lit(float(period))
    return F.sin(angle), F.cos(angle)


def calendar_columns(ds: Column) -> dict[str, Column]:
    """Hour of day and day of week (Monday = 0) as sine and cosine, and a weekend flag."""
    hour_sin, hour_cos = on_circle(F.hour(ds), 24)
    day_sin, day_cos = on_circle(F.weekday(ds), 7)
    return {
        "hour_sin": hour_sin,
        "hour_cos": hour_cos,
        "day_sin": day_sin,
        "day_cos": day_cos,
        "is_weekend": (F.weekday(ds) >= 5).cast("int"),
    }
