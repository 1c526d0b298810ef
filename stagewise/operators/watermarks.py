"""High watermarks of sources and destinations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stagewise.functions.names import column, columns
from stagewise.functions.timestamps import watermark_text


def newest_at_destination(effective_date: str) -> Column:
    """Aggregate: newest effective date."""
    return F.max(column(effective_date)).alias("DestinationMaxEffectiveDate")


def newest_at_source(effective_text: str) -> Column:
    """Aggregate: newest effective date of text in AM/PM or ISO form, to the minute."""
    return F.max(watermark_text(column(effective_text))).alias("SourceMaxEffectiveDate")


def destination_watermark(df: DataFrame, effective_date: str, by: Sequence[str] = ()) -> DataFrame:
    """The destination's watermark, over all rows or per source."""
    return df.groupBy(*columns(by)).agg(newest_at_destination(effective_date))


def source_watermark(df: DataFrame, effective_text: str, by: Sequence[str] = ()) -> DataFrame:
    """The source's watermark, over all rows or per source."""
    return df.groupBy(*columns(by)).agg(newest_at_source(effective_text))
