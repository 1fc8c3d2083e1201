"""Text clean-up and canonical forms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from orefold import fixed_values as fixed

WHITE_SPACE = r"(?U)[\s\x{FEFF}]+"
EDGE_SPACE = r"(?U)^[\s\x{FEFF}]+|[\s\x{FEFF}]+$"
TICKER_SHAPE = r"^[A-Z][A-Z.\-]{0,5}$"


def strip(c: Column) -> Column:
    """Remove any Unicode whitespace at both ends (Spark's trim removes blanks only)."""
    return F.regexp_replace(c, EDGE_SPACE, "")


def blank_to_null(c: Column) -> Column:
    """Stripped text; empty becomes null."""
    return F.nullif(strip(c), F.lit(""))


def lower_or_empty(c: Column) -> Column:
    """Lower-case stripped text; missing becomes the empty string."""
    return F.lower(F.coalesce(strip(c), F.lit("")))


def share_class_symbol(c: Column) -> Column:
    """``BRK.B`` -> ``BRK-B``."""
    return F.replace(c, F.lit("."), F.lit("-"))


def drop_exchange(c: Column) -> Column:
    """``NVDA:US`` -> ``NVDA``."""
    return F.substring_index(c, ":", 1)


def first_integer(c: Column) -> Column:
    """First run of digits as int, null when there is none."""
    return F.nullif(F.regexp_extract(c, r"([0-9]+)", 1), F.lit("")).try_cast("int")


def two_line_date(c: Column) -> Column:
    """First two non-blank lines joined by a space, null when there is none."""
    lines = F.filter(F.transform(F.split(c, "\n"), strip), lambda s: s != "")
    return F.nullif(F.array_join(F.slice(lines, 1, 2), " "), F.lit(""))


def clean_ticker(c: Column) -> Column:
    return F.upper(strip(c))


def commas_to_spaces(c: Column) -> Column:
    return F.replace(c, F.lit(","), F.lit(" "))


def has_ticker_shape(c: Column) -> Column:
    """One to six characters, a capital first, no digits."""
    return c.rlike(TICKER_SHAPE)


def has_ticker(c: Column) -> Column:
    """Neither null nor one of the placeholders for "no ticker"."""
    return c.isNotNull() & ~c.isin(*fixed.NO_TICKER)


def first_non_empty(*cs: Column) -> Column:
    """First value that is neither null nor ``''``, else null."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in cs])


def lookup(c: Column, table: dict[str, object]) -> Column:
    """Value of a small constant table; null when the key is absent."""
    (first, *rest) = table.items()
    out = F.when(c == first[0], F.lit(first[1]))
    for key, value in rest:
        out = out.when(c == key, F.lit(value))
    return out


def sector_label(c: Column) -> Column:
    """Short sector name; unknown names pass through."""
    return F.coalesce(lookup(c, fixed.SECTOR_LABELS), c)


def sector_or_other(c: Column) -> Column:
    return F.coalesce(c, F.lit(fixed.OTHER_SECTOR))


def band_midpoint(c: Column) -> Column:
    """Estimated USD value of a published size band; other labels give null."""
    return lookup(c, fixed.BAND_MIDPOINTS)


def quote_url(symbol: Column) -> Column:
    """Link to the symbol's quote page, null for a null symbol."""
    return F.concat(F.lit(fixed.QUOTE_URL), share_class_symbol(symbol))


def quote_url_or_null(ticker: Column) -> Column:
    """As ``quote_url``; placeholders for "no ticker" give null too."""
    return F.when(has_ticker(ticker), quote_url(ticker))
