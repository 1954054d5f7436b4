"""String repairs, matching, fingerprints."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: White space that counts as blank, tabs and line breaks included.
_WHITE = " \t\n\x0b\f\r\u00a0"


def blank_to_null(text: Column) -> Column:
    """A string of white space counts as missing."""
    return F.when(F.btrim(text, F.lit(_WHITE)) != "", text)


def is_blank(text: Column) -> Column:
    return text.isNull() | (F.btrim(text, F.lit(_WHITE)) == "")


def matches_from_start(text: Column, pattern: str) -> Column:
    """Regex match anchored at the start only; null gives null."""
    return text.rlike(f"^(?:{pattern})")


def first_present(df: DataFrame, names: Iterable[str]) -> Column:
    """Value of the first of ``names`` that the frame has and that is not null."""
    present = [F.col(n) for n in names if n in df.columns]
    return F.coalesce(*present) if present else F.lit(None).cast("string")


def trim_strings(df: DataFrame) -> DataFrame:
    """Trim every string column, in one projection."""
    kinds = dict(df.dtypes)
    return df.select(*[F.trim(c).alias(c) if kinds[c] == "string" else F.col(c) for c in df.columns])


def fingerprint(text: Column, length: int = 12) -> Column:
    return F.substring(F.md5(text), 1, length)


def occurrences(text: Column, word: str) -> Column:
    """How often ``word`` occurs in ``text``, without overlaps."""
    return ((F.length(text) - F.length(F.replace(text, F.lit(word), F.lit("")))) / len(word)).cast("int")


def search_words(query: str, min_length: int = 5) -> list[str]:
    """Lower-cased words of a query that are long enough to search for."""
    return [w.lower() for w in query.split() if len(w) >= min_length]


def keyword_score(text: Column, words: list[str]) -> Column:
    """Number of ``words`` that occur anywhere in the whole text."""
    low = F.lower(text)
    score = F.lit(0)
    for word in words:
        score = score + F.when(F.contains(low, F.lit(word)), 1).otherwise(0)
    return score


def error_fingerprint(log: Column) -> Column:
    """Hash of the exception line and the code line before it.

    File paths, line numbers and caret markers change from run to run and are left out.
    """
    lines = F.filter(F.transform(F.split(log, "\n"), lambda x: F.trim(x)), lambda x: x != "")
    last = F.coalesce(F.try_element_at(lines, F.lit(-1)), log)
    noise = ["File ", "~", "^", "Traceback"]

    def is_code(line: Column) -> Column:
        keep = F.lit(True)
        for start in noise:
            keep = keep & ~F.startswith(line, F.lit(start))
        return keep

    before = F.coalesce(F.try_element_at(F.filter(lines, is_code), F.lit(-2)), F.lit(""))
    return fingerprint(F.concat(last, F.lit(" | "), before))
