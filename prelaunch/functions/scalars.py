"""Scalar feature expressions (SCA5-SCA21).

All functions return Columns built from native Spark expressions; none
calls back into Python per row.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's ``str.split()`` and ``str.strip()``
# treat as whitespace, as a regex class body (Java and RE2 syntax).
PY_WHITESPACE = (r"\t\n\x{0b}\x{0c}\r\x{1c}-\x{1f} \x{85}\x{a0}\x{1680}"
                 r"\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}")
WORD_RUN = f"[^{PY_WHITESPACE}]+"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_py(c: Column | str) -> Column:
    """Strip leading and trailing whitespace as Python's ``str.strip()``."""
    return F.regexp_replace(_c(c), f"^[{PY_WHITESPACE}]+|[{PY_WHITESPACE}]+$", "")


# Date forms of catalogue exports, tried in order.
DATE_FORMATS = ("yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", "yyyy/MM/dd", "MMM d, yyyy", "d MMM, yyyy", "MMMM d, yyyy",
                "MM/dd/yyyy", "MMM yyyy")


def parse_date(c: Column | str, formats: tuple[str, ...] = DATE_FORMATS) -> Column:
    """Text -> timestamp, invalid or impossible dates -> null (SCA5).

    Timestamp columns pass through. Each format is tried in order;
    ``try_to_timestamp`` never raises under ANSI mode. A failed try costs far more than a good one, so where ISO dates come
    first, text of their shape is cast as a date, and text without a digit, which no format with a year fits, is not tried.
    """
    text = _c(c).cast("string")
    tries = [F.try_to_timestamp(text, F.lit(f)) for f in formats]
    tried = F.coalesce(*tries) if len(tries) > 1 else tries[0]
    if formats[0] != "yyyy-MM-dd" or not all("y" in f for f in formats):
        return tried
    return (F.when(text.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z") & ~text.startswith("0000"), text.try_cast("date").cast("timestamp"))
            .when(text.rlike("[0-9]"), tried))


def calendar_parts(ts: Column | str) -> dict[str, Column]:
    """Year, month and quarter of a timestamp (SCA6)."""
    t = _c(ts)
    return {"release_year": F.year(t), "release_month": F.month(t),
            "release_quarter": F.quarter(t)}


def q4_flag(quarter: Column | str) -> Column:
    """1 for the fourth quarter, else 0; a null date gives 0 (SCA7)."""
    return F.coalesce((_c(quarter) == 4).cast("int"), F.lit(0))


def fill_zero(c: Column | str) -> Column:
    """Null -> 0 for numeric defaults (SCA8)."""
    return F.coalesce(_c(c).cast("double"), F.lit(0.0))


def log1p_filled(c: Column | str) -> Column:
    """``log(1 + x)`` after null -> 0 (SCA8 + SCA9)."""
    return F.log1p(fill_zero(c))


def flag01(c: Column | str) -> Column:
    """Boolean -> 0/1 with null read as false (SCA10)."""
    return F.coalesce(_c(c).cast("boolean"), F.lit(False)).cast("int")


def row_sum_flags(cols: list[str]) -> Column:
    """Count of true flags per row, nulls as false (SCA11)."""
    if not cols:
        return F.lit(0)
    return reduce(lambda a, b: a + b, [flag01(c) for c in cols])


def char_length(c: Column | str) -> Column:
    """Characters (code points) of the text, 0 for null (SCA12)."""
    return F.length(F.coalesce(_c(c), F.lit("")))


def word_count(c: Column | str) -> Column:
    """Whitespace-separated words as Python's ``len(s.split())`` (SCA13)."""
    return F.size(F.regexp_extract_all(F.coalesce(_c(c), F.lit("")), F.lit(WORD_RUN), F.lit(0)))


def text_concat(a: Column | str, b: Column | str) -> Column:
    """``a + ' ' + b`` with nulls read as empty text (SCA14)."""
    return F.concat(F.coalesce(_c(a), F.lit("")), F.lit(" "), F.coalesce(_c(b), F.lit("")))


def is_free(price: Column | str) -> Column:
    """1 when the price, after null -> 0, is zero (SCA15)."""
    return (F.coalesce(_c(price).cast("double"), F.lit(0.0)) == 0).cast("int")


def combo_code(flags: list[str]) -> Column:
    """Three flags as a code such as ``'101'``; null flags read 0 (SCA16)."""
    return F.concat(*[flag01(c).cast("string") for c in flags])


# Platform combination code -> label.
PLATFORM_COMBOS = {
    "100": "Windows Only",
    "110": "Windows + Mac",
    "101": "Windows + Linux",
    "111": "All 3 Platforms",
    "010": "Mac Only",
    "001": "Linux Only",
    "011": "Mac + Linux",
    "000": "None",
}


def lookup(code: Column | str, table: dict[str, str]) -> Column:
    """Literal map lookup; unmapped keys give null (SCA17, JOI3)."""
    m = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    return F.try_element_at(m, _c(code))


def sanitize_name(name: str, prefix: str = "") -> str:
    """Column alias for a tag or term: blanks become underscores (SCA19).

    Dots and backticks, which column references give a meaning, too.
    """
    return prefix + re.sub(r"[ .`]", "_", name)


def unique_names(names: list[str], prefix: str = "", taken: list[str] | None = None) -> dict[str, str]:
    """Name -> column alias, distinct even without regard to case.

    An alias that an earlier name or ``taken`` column has gets ``_2``, ``_3``...
    """
    used = {t.lower() for t in taken or []}
    out: dict[str, str] = {}
    for name in names:
        base = alias = sanitize_name(name, prefix)
        n = 1
        while alias.lower() in used:
            n += 1
            alias = f"{base}_{n}"
        used.add(alias.lower())
        out[name] = alias
    return out


def quoted(name: str) -> str:
    """A column name as a reference that dots and blanks cannot break."""
    return "`" + name.replace("`", "``") + "`"


def hash_uniform(key, seed: str) -> F.Column:
    """Deterministic uniform in [0, 1) from md5(key || '#' || seed).

    Identical in every engine and for any partitioning, unlike ``rand``.
    """
    h = F.md5(F.concat(F.col(key).cast("string"), F.lit("#" + seed)))
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint") / 4294967296.0


def pct_difference(a: Column | str, b: Column | str, is_count: bool = False) -> Column:
    """Difference of group ``b`` over group ``a`` (SCA20).

    Counts give ``b - a``. Otherwise ``(b - a) / |a| * 100``; 0 when ``a``
    is 0, and null (shown as N/A) when ``b`` is 0.
    """
    x, y = _c(a).cast("double"), _c(b).cast("double")
    if is_count:
        return y - x
    return (F.when(y.isNull() | (y == 0), F.lit(None).cast("double"))
            .when(x == 0, F.lit(0.0))
            .otherwise((y - x) / F.abs(x) * 100))


def effect_label(d: Column | str) -> Column:
    """Cohen's d magnitude label (SCA21)."""
    a = F.abs(_c(d))
    return (F.when(a.isNull(), F.lit(None).cast("string"))
            .when(a < 0.2, "negligible").when(a < 0.5, "small")
            .when(a < 0.8, "medium").otherwise("LARGE"))
