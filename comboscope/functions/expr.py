"""Column expressions whose null, zero and rounding behaviour follows the retail scripts."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from comboscope.constants import CATEGORY_ALIASES, ENGAGEMENT_BINS


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def named(name: str) -> Column:
    """The column of exactly this name, dots and spaces included."""
    return F.col("`" + name.replace("`", "``") + "`")


def half_even(c: Column | str, digits: int = 2) -> Column:
    """Round by scaling and rounding half to even, as array libraries do (0.125 -> 0.12)."""
    scale = F.lit(float(10**digits))
    return F.rint(col(c) * scale) / scale


def unit_price(sales: Column | str, qty: Column | str, zero_qty: str = "null") -> Column:
    """Sales over quantity to two decimals. A zero quantity gives null, or +-inf with 'inf'."""
    s, q = col(sales).cast("double"), col(qty).cast("double")
    price = half_even(F.try_divide(s, q))
    if zero_qty == "null":
        return price
    if zero_qty != "inf":
        raise ValueError("zero_qty must be 'null' or 'inf'")
    return (F.when(q != 0, price)
            .when(s > 0, F.lit(float("inf")))
            .when(s < 0, F.lit(float("-inf"))))


def finite(c: Column | str) -> Column:
    """The value, or null where it is infinite or not a number."""
    x = col(c)
    return F.when(~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))), x)


def not_in(c: Column | str, values: list) -> Column:
    """Exclusion that keeps null rows."""
    return col(c).isNull() | ~col(c).isin(list(values))


def monday_week(d: Column | str) -> Column:
    """Week number 00-53 with weeks starting on Monday (strftime %W)."""
    return F.floor((F.dayofyear(col(d)) + 6 - F.weekday(col(d))) / 7).cast("int")


def week_start(d: Column | str) -> Column:
    return F.date_trunc("week", col(d)).cast("date")


def safe_date(c: Column | str) -> Column:
    return F.try_to_timestamp(col(c).cast("string")).cast("date")


def pearson(n, sa, sb, saa, sbb, sab) -> Column:
    """Correlation from moments; null when a side is constant or fewer than two rows match."""
    n, sa, sb, saa, sbb, sab = map(col, (n, sa, sb, saa, sbb, sab))
    va, vb = n * saa - sa * sa, n * sbb - sb * sb
    return F.when((n >= 2) & (va > 0) & (vb > 0), (n * sab - sa * sb) / F.sqrt(va * vb))


def category_key(c: Column | str, aliases: dict[str, str] = CATEGORY_ALIASES) -> Column:
    """Category name with separators turned to '_', outer '_' stripped and aliases merged."""
    key = F.btrim(F.regexp_replace(col(c), r"-C|-|/| |\*", "_"), F.lit("_"))
    out = key
    for old, new in aliases.items():
        out = F.when(key == old, F.lit(new)).otherwise(out)
    return out


def brand_label(brand: Column | str, private_brands: list[str]) -> Column:
    return F.when(col(brand).isin(list(private_brands)), "private").otherwise("national")


def item_id(product_id: Column | str) -> Column:
    return F.substring_index(col(product_id), "|", 1)


def engagement_level(percent: Column | str, bins=ENGAGEMENT_BINS) -> Column:
    """Right-closed bins over (-1, last edge]; values outside stay null."""
    p, out = col(percent), None
    for edge, name in bins:
        hit = p <= F.lit(edge)
        out = F.when((p > -1) & hit, name) if out is None else out.when(hit, name)
    return out


def month_name(d: Column | str) -> Column:
    return F.date_format(col(d), "MMMM")


def seeded_draw(seed: int, *keys: Column | str) -> Column:
    """A number of 60 bits drawn by MD5 from the seed and the keys: the same on every engine."""
    text = F.concat_ws("|", F.lit(str(seed)), *[col(k).cast("string") for k in keys])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")
