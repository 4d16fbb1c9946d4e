"""Text keys as the statement tables compare them: without case and accents, blanks equal to nulls where asked."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable
from functools import cache

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.functions.sizing import told_apart

# A text counts as a number other than zero when its leading number has a non-zero digit.
NONZERO_PREFIX = r"^\s*[+-]?0*\.?0*[1-9]"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


@cache
def accents() -> tuple[str, str]:
    """Lower-case letters that decompose into one letter and marks, with that letter; then the marks, which have none."""
    from_, to = [], []
    for code in range(0xC0, 0x2000):
        letter = chr(code).lower()
        first, *marks = unicodedata.normalize("NFD", letter)
        if len(letter) == 1 and marks and not unicodedata.combining(first) and all(unicodedata.category(m) == "Mn" for m in marks) and letter not in from_:
            from_.append(letter)
            to.append(first)
    return "".join(from_) + "".join(map(chr, range(0x300, 0x370))), "".join(to)


def folded(text: str) -> str:
    """The comparison form of a text, as ``fold`` makes it of a column."""
    from_, to = accents()
    return text.lower().translate({ord(a): to[i] if i < len(to) else None for i, a in enumerate(from_)})


def fold(value: Column | str) -> Column:
    """Comparison form of a text key, without case and accents; null stays null."""
    text = _col(value)
    # Most keys are plain ASCII, as many bytes as characters, and skip the table.
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(F.lower(text), *accents()))


def fold_blank(value: Column | str) -> Column:
    """Comparison form in which null and the empty text are the same key."""
    return F.coalesce(fold(value), F.lit(""))


def grouped(
    df: DataFrame, plain: list[str], text: list[str], sums: dict[str, Column] | None = None, least: dict[str, Column] | None = None,
    with_keys: bool = False,
) -> DataFrame:
    """Sums and minima per key, text keys compared without case and accents; each text key shows its smallest spelling.

    ``with_keys`` keeps the folded texts as ``_key_*``: whoever joins by these needs no spelling, and where no other column does
    either, Spark adds up by hash and does not sort for it.

    One aggregation and one shuffle. Adding up by exact spelling first, to keep texts out of the buffers, was measured
    too: a second shuffle for a quarter more CPU time, as a key has few lines.
    """
    sums, least = sums or {}, least or {}
    keys = {f"_key_{c}": fold(c) for c in text}
    values = [F.sum(e).alias(n) for n, e in sums.items()] + [F.min(e).alias(n) for n, e in least.items()]
    return df.groupBy(*plain, *[e.alias(k) for k, e in keys.items()]).agg(*[F.min(c).alias(c) for c in text], *values).drop(*[] if with_keys else keys)


def grouped_apart(df: DataFrame, plain: list[str], text: list[str], sums: dict[str, Column] | None = None) -> DataFrame:
    """``grouped`` for keys that most rows have alone: such rows are their own sums where they lie, and only the others travel."""
    sums = sums or {}
    alone, others, _ = told_apart(df, [*plain, *[fold(c) for c in text]])
    summed = grouped(others, plain, text, sums)
    return alone.select(*plain, *text, *[e.cast(summed.schema[n].dataType).alias(n) for n, e in sums.items()]).unionByName(summed)


def same(value: Column | str, text: str) -> Column:
    return fold(value) == folded(text)


def one_of(value: Column | str, texts: Iterable[str]) -> Column:
    return fold(value).isin([folded(t) for t in texts])


def contains_tax(value: Column | str) -> Column:
    return fold(value).contains("tax")


def starts_with_b(value: Column | str) -> Column:
    return fold(value).startswith("b")


def nonzero_number(value: Column | str) -> Column:
    """True when the leading number of the text is not zero; letters count as zero, null as false."""
    return F.coalesce(_col(value).cast("string").rlike(NONZERO_PREFIX), F.lit(False))


def digit_run(value: Column | str) -> Column:
    """First run of digits, null when there is none."""
    return F.regexp_substr(_col(value), F.lit("[0-9]+"))


def drop_first(value: Column | str) -> Column:
    """The text without its first character."""
    return F.substring(_col(value), 2, 2147483647)


def is_blank(value: Column | str) -> Column:
    return F.coalesce(_col(value), F.lit("")) == ""
