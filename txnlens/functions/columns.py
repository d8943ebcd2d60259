"""Scalar column expressions (all JVM-side, inside whole-stage codegen)."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SECONDS_PER_HOUR = 3600.0


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c) -> Column:
    """NaN → NULL, so aggregates skip it as pandas does."""
    c = col_(c)
    return F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(c)


def hour_of_day(time_col="Time") -> Column:
    """Fractional hour ``(Time/3600) mod 24``; pmod keeps the result >= 0."""
    return F.pmod(col_(time_col) / F.lit(SECONDS_PER_HOUR), F.lit(24.0))


def hour_bucket(time_col="Time") -> Column:
    """Whole hour 0..23 for grouping."""
    return F.floor(hour_of_day(time_col)).cast("int")


def amount_log(amount_col="Amount") -> Column:
    return F.log1p(col_(amount_col))


def binarize(score, threshold) -> Column:
    """Strict ``score > threshold`` as 0/1."""
    t = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return (col_(score) > t).cast("int")


def outlier_flag(sign_col) -> Column:
    """Outlier sign map: -1 → 1, anything else → 0."""
    return F.when(col_(sign_col) == -1, 1).otherwise(0).cast("int")


def defaulted_id(df: DataFrame, id_col: str = "id") -> Column:
    """Transaction key as string, ``'unknown'`` when absent or NULL."""
    if id_col not in df.columns:
        return F.lit("unknown")
    return F.coalesce(F.col(id_col).cast("string"), F.lit("unknown"))


def money(c) -> Column:
    return F.format_string("$%.2f", col_(c))


def fixed3(c) -> Column:
    return F.format_string("%.3f", col_(c))


def iso_timestamp(c) -> Column:
    """Timestamp → ISO-8601 text with microseconds."""
    return F.date_format(col_(c), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def parse_iso(c) -> Column:
    return F.to_timestamp(col_(c))


def epoch_seconds(c) -> Column:
    return F.unix_micros(col_(c)) / F.lit(1e6)


def sigmoid(c) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-col_(c)))


def safe_ratio(num, den, zero=None) -> Column:
    """num/den, ``zero`` (default NULL) when den is 0 (ANSI-safe)."""
    r = F.try_divide(col_(num), col_(den))
    return r if zero is None else F.coalesce(r, F.lit(zero))


def mean_squared_error(a, b) -> Column:
    """Row-wise mean of squared differences of two equal-length arrays."""
    diff = F.zip_with(col_(a), col_(b), lambda x, y: (x - y) * (x - y))
    total = F.aggregate(diff, F.lit(0.0), lambda acc, x: acc + x)
    return total / F.size(diff)


def prefixed_columns(df: DataFrame, prefix: str = "V") -> list[str]:
    """Columns named ``<prefix><number>`` in numeric order (V1, V2, …, V10)."""
    pat = re.compile(rf"^{re.escape(prefix)}(\d+)$")
    found = [(int(m.group(1)), c) for c in df.columns if (m := pat.match(c))]
    return [c for _, c in sorted(found)]


def rounded(c, digits: int = 6) -> Column:
    """Round half away from zero to ``digits`` decimals and fold -0.0 into
    0.0 (stable value hashes across engines). Plain double arithmetic —
    round(x·10^d)/10^d, the definition SQL engines use for doubles — so it
    stays in generated code (``F.round`` goes through BigDecimal per value)."""
    x = col_(c).cast("double")
    m = F.lit(float(10 ** digits))
    a = F.abs(x) * m + F.lit(0.5)
    whole = a - F.pmod(a, F.lit(1.0))
    return F.when(x < 0, -whole).otherwise(whole) / m + F.lit(0.0)
