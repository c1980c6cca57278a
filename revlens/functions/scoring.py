"""Quantile scores and segment rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Segment labels of the RFM report, in rule order.
SEG_VIP = "VIP"
SEG_LOYAL = "Khach trung thanh"
SEG_NEW = "Khach moi"
SEG_AT_RISK = "Co nguy co roi bo"
SEG_REACTIVATE = "Can kich hoat lai"
SEG_LOW = "Khach tieu thu thap"


def score_le(c: Column, q25: Column, q50: Column, q75: Column) -> Column:
    """Inverted score (recency): 4 when c <= q25 ... 1 above q75."""
    return (F.when(c <= q25, 4).when(c <= q50, 3).when(c <= q75, 2).otherwise(1))


def score_ge(c: Column, q25: Column, q50: Column, q75: Column) -> Column:
    """Score 4 when c >= q75 ... 1 below q25 (ties get the higher score)."""
    return (F.when(c >= q75, 4).when(c >= q50, 3).when(c >= q25, 2).otherwise(1))


def segment_rule(r: Column, f: Column, m: Column) -> Column:
    """F8: ordered segment rules on the R, F, M scores."""
    return (F.when((r >= 3) & (f >= 3) & (m >= 3), SEG_VIP)
            .when((r >= 3) & (f >= 2), SEG_LOYAL)
            .when((r >= 3) & (f == 1), SEG_NEW)
            .when((r == 2) & (f >= 2), SEG_AT_RISK)
            .when((r <= 1) & (f >= 2), SEG_REACTIVATE)
            .otherwise(SEG_LOW))
