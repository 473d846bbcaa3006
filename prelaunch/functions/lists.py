"""List-literal columns: decode, length, comma pieces, keyword tests, cleaning.

Catalogue exports store multi-valued fields as Python list text, for example
``['Action', 'Indie']``. Decoding recognises the literals of a flat list with
regular expressions and rewrites only what lies outside of quotes, so it is
a native expression with no Python per row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from prelaunch.functions.scalars import PY_WHITESPACE, strip_py

# One quoted string; a list item (neighbouring strings are one item).
_STRING = r"""(?:'[^'\\\n]*+(?:\\.[^'\\\n]*+)*+'|"[^"\\\n]*+(?:\\.[^"\\\n]*+)*+")"""
_ITEM = rf"(?s){_STRING}(?:\s*{_STRING})*+|[+-]?\d+(?:\.\d*)?(?:[eE][+-]?\d+)?\b|\b(?:None|True|False)\b"
_ESCAPE = r"(?s)\\(?:x[0-9a-fA-F]{2}|u[0-9a-fA-F]{4}|[0-7]{1,3}|.)|[^\\]+"
_MARK = "\u0001"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_list_literal(c: Column | str) -> Column:
    """True where the whole text is a flat list literal; null for null.

    Every item is replaced by a mark; what is left must be brackets, marks
    and single commas (a trailing one is allowed), without anything else.
    """
    col = _c(c)
    bare = F.regexp_replace(F.regexp_replace(col, _ITEM, _MARK), r"\s", "")
    return (~F.contains(F.regexp_replace(col, f"(?s){_STRING}", ""), F.lit(_MARK)) & bare.rlike(rf"^\[[{_MARK},]*\]$")
            & ~F.contains(bare, F.lit(",,")) & ~F.contains(bare, F.lit("[,")) & ~F.contains(bare, F.lit(_MARK * 2)))


def _unescape(body: Column) -> Column:
    """Backslash escapes of a string literal's inside."""
    def one(x: Column) -> Column:
        code = F.when(x.rlike(r"^\\[xu]"), F.substr(x, F.lit(3))).when(x.rlike(r"^\\[0-7]"), F.conv(F.substr(x, F.lit(2)), 8, 16))
        char = F.decode(F.unhex(F.lpad(code, 4, "0")), "UTF-16BE")
        named = F.substr(x, F.lit(2), F.lit(1))
        plain = (F.when(named == "n", "\n").when(named == "t", "\t").when(named == "r", "\r").when(named == "b", "\b")
                 .when(named == "f", "\f").when(named == "a", "\u0007").when(named == "v", "\u000b").when(named == "\n", "")
                 .when(named.isin("\\", "'", '"'), named).otherwise(x))
        return F.when(~x.startswith("\\"), x).when(code.isNotNull(), char).otherwise(plain)
    return F.when(F.contains(body, F.lit("\\")), F.array_join(F.transform(F.regexp_extract_all(body, F.lit(_ESCAPE), F.lit(0)), one), "")).otherwise(body)


def decode_list(c: Column | str) -> Column:
    """Python list text -> ``array<string>`` (SCA1).

    Null, unparsable text and non-list literals (dict, tuple, scalar, nested
    list) give an empty array, never null. Numbers and ``True``/``False``
    inside a list come back as text, ``None`` as a null element.
    """
    col = _c(c)

    def value(item: Column) -> Column:
        strings = F.regexp_extract_all(item, F.lit(f"(?s){_STRING}"), F.lit(0))
        joined = F.array_join(F.transform(strings, lambda x: _unescape(F.substr(x, F.lit(2), F.length(x) - 2))), "")
        return F.when(item == "None", F.lit(None).cast("string")).when(item.rlike(r"^['\"]"), joined).otherwise(item)

    items = F.transform(F.regexp_extract_all(col, F.lit(_ITEM), F.lit(0)), value)
    return F.when(F.coalesce(is_list_literal(col), F.lit(False)), items).otherwise(F.array().cast("array<string>"))


def undecodable(c: Column | str) -> Column:
    """True for a non-null text that is no list literal: the rows to count before trusting a column."""
    col = _c(c)
    return F.coalesce(~is_list_literal(col), F.lit(False))


def list_length(c: Column | str) -> Column:
    """Number of decoded elements, 0 when decoding fails (SCA2)."""
    return F.size(decode_list(c))


def comma_pieces(c: Column | str) -> Column:
    """Pieces of the raw text split on commas, 0 for null (SCA3).

    ``'[]'`` counts 1 and ``"['a', 'b']"`` counts 2; equals commas + 1.
    """
    col = F.col(c) if isinstance(c, str) else c
    n = F.length(col) - F.length(F.replace(col, F.lit(","), F.lit(""))) + 1
    return F.when(col.isNull(), F.lit(0)).otherwise(n)


# Keywords that mark a multiplayer category.
MULTIPLAYER_KEYWORDS = ["multiplayer", "multi-player", "co-op", "pvp", "online"]


def any_keyword(c: Column | str, keywords: list[str] = MULTIPLAYER_KEYWORDS) -> Column:
    """1 when any decoded element, lowercased, contains any keyword (SCA4)."""
    arr = decode_list(c)

    def hit(x: Column) -> Column:
        low = F.lower(F.coalesce(x, F.lit("none")))
        return reduce(lambda a, b: a | b, [low.contains(k) for k in keywords])

    return F.coalesce(F.exists(arr, hit), F.lit(False)).cast("int")


# Store tags that are not genres.
NON_GENRE_TAGS = ["Indie", "Early Access", "Free To Play"]


def clean_tags(c: Column | str, exclude: list[str] = NON_GENRE_TAGS) -> Column:
    """Decoded elements, whitespace-stripped, minus empty and excluded tags (SCA18).

    An element is kept when it is non-empty before stripping and its
    stripped text is not excluded; the stripped text is returned. Duplicates
    stay (this is a filter, not a set difference).
    """
    arr = decode_list(c)
    excluded = F.array(*[F.lit(t) for t in exclude]) if exclude else F.array().cast("array<string>")
    kept = F.filter(arr, lambda x: x.isNotNull() & (F.length(x) > 0)
                    & ~F.array_contains(excluded, strip_py(x)))
    return F.transform(kept, strip_py)


__all__ = ["decode_list", "is_list_literal", "undecodable", "list_length", "comma_pieces", "any_keyword", "clean_tags",
           "MULTIPLAYER_KEYWORDS", "NON_GENRE_TAGS", "PY_WHITESPACE"]
