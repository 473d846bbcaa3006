"""Text token expressions (TXT1-TXT3) used by the TF-IDF operator."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Word runs of two or more letters, digits or underscores: the usual
# default token pattern of bag-of-words vectorisers.
TOKEN_PATTERN = r"[\p{L}\p{N}_]{2,}"


def tokens(text: Column | str) -> Column:
    """Lowercase, then all word runs of length >= 2, in order (TXT1)."""
    t = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract_all(F.lower(F.coalesce(t, F.lit(""))), F.lit(TOKEN_PATTERN), F.lit(0))


def remove_stop_words(toks: Column, stop_words: list[str]) -> Column:
    """Drop stop words, keeping order (TXT2)."""
    if not stop_words:
        return toks
    return F.filter(toks, lambda x: ~x.isin(stop_words))


def with_ngrams(toks: Column, max_n: int = 2) -> Column:
    """Unigrams followed by adjacent pairs of the (filtered) tokens (TXT3)."""
    if max_n < 2:
        return toks

    def with_pairs(t: Column) -> Column:
        n = F.greatest(F.size(t) - 1, F.lit(0))
        pairs = F.zip_with(F.slice(t, 1, n), F.slice(t, 2, n), lambda a, b: F.concat(a, F.lit(" "), b))
        return F.concat(t, pairs)

    # as a lambda's argument the tokens are computed once, however often it names them
    return F.element_at(F.transform(F.array(toks), with_pairs), 1)
