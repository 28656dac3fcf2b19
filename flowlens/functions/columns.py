"""Scalar column helpers.

All helpers build JVM-side expressions; none of them is a Python UDF.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

__all__ = [
    "col_", "safe_div", "safe_div0", "money", "money_sum", "r6", "canonicalise", "canonicalise_all",
    "clean_category_name", "first_token_lower", "prefix_ellipsis", "usd_label", "millions_label",
    "thousands_label", "pct_label", "signed_growth_label", "clip01", "relative_width", "lenient_date",
    "strict_date",
]


def col_(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(num: Column | str, den: Column | str) -> Column:
    """NULL instead of an ANSI error when the denominator is 0 or NULL."""
    return F.try_divide(col_(num), col_(den))


def safe_div0(num: Column | str, den: Column | str) -> Column:
    """D6 with the reference's ``else 0``."""
    return F.coalesce(safe_div(num, den), F.lit(0.0))


def money(c: Column | str) -> Column:
    """Money as an exact decimal (inputs carry at most cents)."""
    return col_(c).cast("decimal(18,2)")


def money_sum(c: Column | str) -> Column:
    """Exact, order-independent sum of a money column, returned as DOUBLE."""
    return F.sum(money(c)).cast("double")


def r6(c: Column | str) -> Column:
    return F.round(col_(c), 6)


def canonicalise(df: DataFrame, mapping: Mapping[str, str], columns: Iterable[str]) -> DataFrame:
    """Replace alias values by their canonical value in the given columns."""
    return df.replace(dict(mapping), subset=list(columns))


def canonicalise_all(df: DataFrame, mapping: Mapping[str, str], exclude: Iterable[str] = ()) -> DataFrame:
    """P5: the same over every string column."""
    skip = set(exclude)
    cols = [f.name for f in df.schema.fields if f.dataType.simpleString() == "string" and f.name not in skip]
    return canonicalise(df, mapping, cols)


def clean_category_name(c: Column | str, prefixes: Iterable[str]) -> Column:
    """Drop the given prefixes, '_' → ' ', title case."""
    out = col_(c)
    for p in prefixes:
        out = F.replace(out, F.lit(p), F.lit(""))
    return F.initcap(F.replace(out, F.lit("_"), F.lit(" ")))


def first_token_lower(c: Column | str) -> Column:
    """P10: ``s.split()[0].lower()``."""
    return F.lower(F.split_part(F.trim(col_(c)), F.lit(" "), F.lit(1)))


def prefix_ellipsis(c: Column | str, n: int = 15) -> Column:
    """First n characters followed by '...'."""
    return F.concat(F.left(col_(c), F.lit(n)), F.lit("..."))


def _or_na(c: Column | str, label: Column) -> Column:
    """The label, or 'N/A' for NULL (``format_string`` gives text for NULL, too)."""
    return F.when(col_(c).isNull(), F.lit("N/A")).otherwise(label)


def usd_label(c: Column | str) -> Column:
    """``${:,.0f}``; NULL → 'N/A', as in the labels below."""
    return _or_na(c, F.concat(F.lit("$"), F.format_number(col_(c), 0)))


def millions_label(c: Column | str) -> Column:
    return _or_na(c, F.concat(F.lit("$"), F.format_string("%.1fM", col_(c) / 1e6)))


def thousands_label(c: Column | str) -> Column:
    return _or_na(c, F.concat(F.lit("$"), F.format_string("%.1fK", col_(c) / 1e3)))


def pct_label(c: Column | str) -> Column:
    """``{:.1%}``."""
    return _or_na(c, F.format_string("%.1f%%", col_(c) * 100))


def signed_growth_label(c: Column | str, suffix: str = "% MoM") -> Column:
    """P12: '+x.x% MoM' for positive, 'x.x% MoM' otherwise; NULL or 0 → 'N/A'."""
    g = col_(c)
    body = F.format_string("%.1f" + suffix.replace("%", "%%"), g * 100)
    return F.when(g.isNull() | (g == 0), F.lit("N/A")).when(g > 0, F.concat(F.lit("+"), body)).otherwise(body)


def clip01(c: Column | str, hi: float = 0.5) -> Column:
    """Scale 0…hi onto 0…1 and clip."""
    return F.least(F.greatest(col_(c) / F.lit(hi), F.lit(0.0)), F.lit(1.0))


def relative_width(value: Column | str, group_max: Column | str, base: float, span: float) -> Column:
    """Base + value / max-in-group × span."""
    return F.lit(base) + safe_div(value, group_max) * F.lit(span)


def lenient_date(c: Column | str, fmt: str | None = None) -> Column:
    """Unparsable → NULL (``errors='coerce'``)."""
    return F.try_to_date(col_(c), fmt) if fmt else F.try_to_date(col_(c))


def strict_date(c: Column | str, fmt: str = "M/d/yyyy") -> Column:
    return F.to_date(col_(c), fmt)
