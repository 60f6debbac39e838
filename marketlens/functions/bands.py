"""Band ladders (searched CASE as an ordered list of rules, first match wins).

Labels and thresholds are fixed values: they are part of the published
results and must be reproduced exactly.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _ladder(rules: list[tuple[Column, str]], otherwise: str) -> Column:
    expr = None
    for cond, label in rules:
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(otherwise))


# --- fixed values: band labels --------------------------------------------
DELIVERY_BUCKETS = ("1 early", "2 on time", "3 1-5 late", "4 6-15 late", "5 15+ late")
LATE_BUCKETS = ("1 on-time/early", "2 1-5 late", "3 6+ late")
WEIGHT_BANDS_3 = ("1 <500g", "2 0.5-2kg", "3 2kg+")
WEIGHT_BANDS_4 = ("1 <500g", "2 0.5-2kg", "3 2-10kg", "4 10kg+")
DISTANCE_BANDS = ("1 <100km", "2 100-500km", "3 500-1000km", "4 1000km+")
SELLER_LATE_BANDS = ("1 never late", "2 <5%", "3 5-10%", "4 10-25%", "5 25%+")
VOLUME_BANDS = ("1 <10 items", "2 10-50", "3 50-200", "4 200+")
PARETO_BANDS = ("1 top 1%", "2 top 5%", "3 top 10%", "4 top 20%", "5 rest")
# Pareto cut points in percent of sellers, matching PARETO_BANDS order.
PARETO_CUTS_PCT = (1, 5, 10, 20)
# ---------------------------------------------------------------------------


def delivery_bucket(d: Column | str) -> Column:
    d = _col(d)
    b = DELIVERY_BUCKETS
    return _ladder([(d < 0, b[0]), (d == 0, b[1]), (d <= 5, b[2]), (d <= 15, b[3])], b[4])


def late_bucket(d: Column | str) -> Column:
    d = _col(d)
    b = LATE_BUCKETS
    return _ladder([(d <= 0, b[0]), (d <= 5, b[1])], b[2])


def weight_band_3(grams: Column | str) -> Column:
    g = _col(grams)
    b = WEIGHT_BANDS_3
    return _ladder([(g < 500, b[0]), (g < 2000, b[1])], b[2])


def weight_band_4(grams: Column | str) -> Column:
    g = _col(grams)
    b = WEIGHT_BANDS_4
    return _ladder([(g < 500, b[0]), (g < 2000, b[1]), (g < 10000, b[2])], b[3])


def distance_band(km: Column | str) -> Column:
    k = _col(km)
    b = DISTANCE_BANDS
    return _ladder([(k < 100, b[0]), (k < 500, b[1]), (k < 1000, b[2])], b[3])


def seller_late_band(rate: Column | str) -> Column:
    r = _col(rate)
    b = SELLER_LATE_BANDS
    return _ladder([(r == 0, b[0]), (r < 0.05, b[1]), (r < 0.10, b[2]), (r < 0.25, b[3])], b[4])


def volume_band(items: Column | str) -> Column:
    n = _col(items)
    b = VOLUME_BANDS
    return _ladder([(n < 10, b[0]), (n < 50, b[1]), (n < 200, b[2])], b[3])


def pareto_band(rank: Column | str, n: Column | str) -> Column:
    """Band by rank share: ``rank <= k% of n`` compared exactly in integers."""
    r, total = _col(rank), _col(n)
    rules = [(r * 100 <= total * k, label) for k, label in zip(PARETO_CUTS_PCT, PARETO_BANDS)]
    return _ladder(rules, PARETO_BANDS[-1])


def frequency_score(frequency: Column | str) -> Column:
    f = _col(frequency)
    return F.when(f == 1, F.lit(1)).when(f == 2, F.lit(3)).otherwise(F.lit(5))


# --- fixed values: RFM segment labels ---------------------------------------
SEG_LOYAL = "Loyal (3+ orders)"
SEG_CHAMPIONS = "Champions"
SEG_AT_RISK = "At Risk"
SEG_NEW_LOW = "New / Low-Value"
SEG_LOST = "Lost"
SEG_REGULAR = "Regular"
SEGMENTS = (SEG_CHAMPIONS, SEG_AT_RISK, SEG_NEW_LOW, SEG_LOST, SEG_LOYAL, SEG_REGULAR)
# ---------------------------------------------------------------------------


def rfm_segment(r: Column | str, m: Column | str, f: Column | str) -> Column:
    r, m, f = _col(r), _col(m), _col(f)
    return _ladder(
        [
            (f == 5, SEG_LOYAL),
            ((r >= 4) & (m >= 4), SEG_CHAMPIONS),
            ((m >= 4) & (r <= 2), SEG_AT_RISK),
            ((r >= 4) & (m <= 2), SEG_NEW_LOW),
            ((r <= 2) & (m <= 2), SEG_LOST),
        ],
        SEG_REGULAR,
    )
