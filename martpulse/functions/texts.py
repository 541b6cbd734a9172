"""Masking, tokens and keyword match."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from martpulse.constants import TEL_KEEP, TEL_STARS

# Fixed value: words as a default full-text analyser cuts them. Each Han or Hiragana sign is a word of its own;
# other letters and digits run together, also across one inner dot or apostrophe.
WORD = (
    r"[\p{IsHan}\p{IsHiragana}]"
    r"|[\p{L}\p{N}_&&[^\p{IsHan}\p{IsHiragana}]]+(?:[.'’][\p{L}\p{N}_&&[^\p{IsHan}\p{IsHiragana}]]+)*"
)


def mask_tel(tel: Column) -> Column:
    return F.concat(F.substring(tel, 1, TEL_KEEP), F.repeat(F.lit("*"), F.lit(TEL_STARS)))


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def has_all_words(text: Column, keyword: str) -> Column:
    """Every word of the keyword occurs in the text; a keyword without words matches nothing."""
    wanted, present = words(F.lit(keyword)), words(text)
    # A word of the text is also a part of it: the cheap test goes first and spares most rows the cutting.
    near = [F.contains(F.lower(text), F.lit(part)) for part in keyword.lower().split() if part.isalnum()
            and part.isascii()]
    exact = (F.size(wanted) > 0) & F.forall(wanted, lambda w: F.array_contains(present, w))
    return reduce(lambda a, b: a & b, [*near, exact])


def relevance(text: Column, keyword: str) -> Column:
    """Share of the text's words that the keyword names, once per keyword word."""
    wanted, present = words(F.lit(keyword)), words(text)
    hits = F.aggregate(
        F.array_distinct(wanted), F.lit(0), lambda acc, w: acc + F.size(F.filter(present, lambda p: p == w))
    )
    return F.coalesce(F.try_divide(hits.cast("double"), F.size(present)), F.lit(0.0))
