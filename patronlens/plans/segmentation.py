"""From raw transactions to the segment report."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame

from patronlens.operators.cleaning import clean_transactions
from patronlens.operators.rfm import assign_segments, compute_rfm, score_rfm
from patronlens.operators.segments import summarize_segments


def segmented_customers(raw: DataFrame, snapshot: datetime | None = None, duplicates: str = "raise") -> DataFrame:
    """Clean, aggregate, score and label: one row per customer."""
    rfm = compute_rfm(clean_transactions(raw), snapshot)
    return assign_segments(score_rfm(rfm, duplicates=duplicates))


def segment_report(raw: DataFrame, snapshot: datetime | None = None, duplicates: str = "raise") -> DataFrame:
    return summarize_segments(segmented_customers(raw, snapshot, duplicates))
