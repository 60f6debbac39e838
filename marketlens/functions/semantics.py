"""Column-expression helpers shared by every layer.

All of these are built-in Spark expressions (JVM side, whole-stage codegen);
nothing here is a Python UDF.  Each helper pins one semantic rule of the
original SQL so the DataFrame jobs give the same answers:

* ``round_scaled``  — ``round(x, n)`` on doubles scales by 10^n, rounds half
  away from zero and unscales.  Spark's own ``round(double, n)`` rounds the
  decimal text instead (1.005 -> 1.01 rather than 1.0), so for n > 0 we
  round ``x * 10^n`` to a whole number and divide back.
* ``day_diff``      — calendar-day boundaries crossed (23:59 -> 00:01 is 1),
  mixed date/timestamp allowed; that is ``datediff(end, start)``, not
  ``timestampdiff(DAY, ...)``.
* ``surrogate_key`` — md5 over the text casts joined by ``-`` with nulls
  replaced by a fixed token (``concat_ws`` alone would skip nulls).
* ``haversine_km``  — great-circle distance on a 6371 km sphere; a missing
  endpoint gives null.
* ``pct``           — ``100.0 * a / b`` as double with a null (not an error)
  for a zero denominator under ANSI mode.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values that must equal the original definitions -----------------
# Null placeholder used inside surrogate keys (public surrogate-key macro).
SURROGATE_KEY_NULL = "_dbt_utils_surrogate_key_null_"
# Separator between the parts of a composite surrogate key.
SURROGATE_KEY_SEPARATOR = "-"
# Earth radius in kilometres used by the distance measure.
EARTH_RADIUS_KM = 6371
# Label of products without any category.
UNCATEGORISED = "(uncategorised)"
# ---------------------------------------------------------------------------


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_scaled(c: Column | str, n: int = 0) -> Column:
    """``round(x, n)`` with scale-round-unscale semantics on doubles."""
    x = _col(c).cast("double")
    if n == 0:
        return F.round(x, 0)
    factor = float(10**n)
    return F.round(x * F.lit(factor), 0) / F.lit(factor)


def day_diff(start: Column | str, end: Column | str) -> Column:
    """Number of midnights between ``start`` and ``end`` (bigint)."""
    return F.datediff(_col(end), _col(start)).cast("bigint")


def surrogate_key(*cols: Column | str) -> Column:
    parts = [F.coalesce(_col(c).cast("string"), F.lit(SURROGATE_KEY_NULL)) for c in cols]
    if len(parts) == 1:
        return F.md5(parts[0])
    return F.md5(F.concat_ws(SURROGATE_KEY_SEPARATOR, *parts))


def packed_key(c: Column | str) -> Column:
    """A key as binary for an exchange, half as long where it is an md5 digest in
    hexadecimal; the first byte tells the two kinds apart, so different keys stay
    different.  ``unpacked_key`` gives the key back."""
    key = _col(c)
    digest = F.concat(F.lit(bytearray(b"\0")), F.unhex(key))
    return F.when(key.rlike("^[0-9a-f]{32}\\z"), digest).otherwise(F.encode(F.concat(F.lit("="), key), "UTF-8"))


def unpacked_key(c: Column | str) -> Column:
    packed = _col(c)
    rest = F.substr(packed, F.lit(2))
    return F.when(F.substr(packed, F.lit(1), F.lit(1)) == F.lit(bytearray(b"\0")), F.lower(F.hex(rest))).otherwise(F.decode(rest, "UTF-8"))


def haversine_km(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    """Great-circle distance between (lat1, lng1) and (lat2, lng2) in km.

    Left unclamped: an argument of ``asin`` a hair above 1 yields NaN, as in
    the original expression.
    """
    dlat = F.sin(F.radians(lat2 - lat1) / 2)
    dlng = F.sin(F.radians(lng2 - lng1) / 2)
    a = F.pow(dlat, 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(dlng, 2)
    return F.lit(2 * EARTH_RADIUS_KM).cast("double") * F.asin(F.sqrt(a))


def pct(numerator: Column, denominator: Column) -> Column:
    """``100.0 * numerator / denominator`` in double, null when the denominator is 0."""
    return F.try_divide(F.lit(100.0) * numerator.cast("double"), denominator.cast("double"))


def late_flag(delivery_vs_estimate_days: Column | str) -> Column:
    """0 when delivered on or before the estimate, else 1 (callers filter nulls)."""
    d = _col(delivery_vs_estimate_days)
    return F.when(d <= 0, F.lit(0)).otherwise(F.lit(1))


def category_with_fallback(english: Column | str, portuguese: Column | str) -> Column:
    """English name, else the untranslated name, else the uncategorised label."""
    return F.coalesce(_col(english), _col(portuguese), F.lit(UNCATEGORISED))


def category_english_or_label(english: Column | str) -> Column:
    """English name, else the uncategorised label (untranslated names collapse)."""
    return F.coalesce(_col(english), F.lit(UNCATEGORISED))
