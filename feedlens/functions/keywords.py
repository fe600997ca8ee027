"""Many keywords in one pass over the text.

``filters.contains_any`` asks for every word by itself, which is right for a handful. For a
long list the words are put into one automaton (Aho-Corasick), which reads a text once
whatever the number of words. A word matches anywhere in the text, in any case."""

from __future__ import annotations

from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf


@lru_cache(maxsize=4)
def _automaton(words: tuple[str, ...]):
    import ahocorasick

    a = ahocorasick.Automaton()
    for w in words:
        a.add_word(w, w)
    a.make_automaton()
    return a


def keyword_matches(col, words: list[str]) -> Column:
    """The distinct ``words`` (in lower case) that a text contains, sorted; null for a null
    text. The empty word is in every text. The list is a parameter and goes to every worker."""
    lower = tuple(sorted({w.lower() for w in words}))
    some, empty = tuple(w for w in lower if w), [""] if "" in lower else []

    @pandas_udf("array<string>")
    def find(texts: pd.Series) -> pd.Series:
        if not some:
            return texts.map(lambda t: None if t is None else empty)
        a = _automaton(some)
        return texts.map(lambda t: None if t is None else empty + sorted({w for _, w in a.iter(t)}))
    return find(F.lower(F.col(col) if isinstance(col, str) else col))


def contains_any_of(df: DataFrame, col: str, words: list[str]) -> DataFrame:
    """F2 for a long list: rows whose text contains any of the words, as
    ``filters.contains_any``."""
    return df.where(F.size(F.coalesce(keyword_matches(col, words), F.array().cast("array<string>"))) > 0)
