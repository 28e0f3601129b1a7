"""Place names, official codes and hashes."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column, functions as F


@lru_cache(maxsize=1)
def _accent_table() -> tuple[str, str]:
    """Characters of the basic plane that decompose to one base letter plus marks.

    Built from the Unicode rule at first use, so nothing is transcribed.
    """
    composed, base = [], []
    for point in range(0x80, 0x10000):
        if 0xD800 <= point <= 0xDFFF:
            continue
        char = chr(point)
        bare = [c for c in unicodedata.normalize("NFD", char)
                if not unicodedata.category(c).startswith("M")]
        if len(bare) == 1 and bare[0] != char:
            composed.append(char)
            base.append(bare[0])
    return "".join(composed), "".join(base)


def strip_accents(text: Column) -> Column:
    """Drop diacritics. Spark has no NFD, hence translate() plus a mark filter.

    A text of one-byte characters has none and skips both.
    """
    composed, base = _accent_table()
    bare = F.regexp_replace(F.translate(text, composed, base), r"\p{M}", "")
    return F.when(F.octet_length(text) == F.char_length(text), text).otherwise(bare)


def region_key(name: Column) -> Column:
    """Upper-case name without diacritics; spaces and punctuation stay."""
    return strip_accents(F.upper(name))


def fold_name(name: Column) -> Column:
    """Join key of a place name: upper-case ASCII letters and digits only."""
    return F.regexp_replace(region_key(name), "[^A-Z0-9]", "")


def trim_space(text: Column) -> Column:
    """Strip any Unicode white space; Spark's trim() strips blanks only."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def is_digits(text: Column) -> Column:
    # \z, because $ also matches before a final line break in Java
    return text.rlike(r"^[0-9]+\z")


def staging_code(code: Column) -> Column:
    """Five-character official code; codes starting 2A/2B are taken as they are."""
    text = code.cast("string")
    return F.when(text.rlike("^2[AB]"), text).otherwise(F.lpad(text, 5, "0"))


def lookup_code(point: Column) -> Column:
    """Official code carried by a point name, or NULL when it holds a town name."""
    text = point.cast("string")
    return (F.when(is_digits(text), F.lpad(text, 5, "0"))
            .when(text.rlike(r"^2[AB][0-9]{3}\z"), text))


def lookup_name(point: Column) -> Column:
    """Folded point name, or NULL when it starts with a digit."""
    text = point.cast("string")
    return F.when(~text.rlike("^[0-9]"), fold_name(text))


def stored_code(point: Column) -> Column:
    """Code under which an already stored reading is known (names stay names)."""
    text = point.cast("string")
    return F.when(is_digits(text), F.lpad(text, 5, "0")).otherwise(text)


def zero_fill(text: Column, width: int) -> Column:
    """Left-pad with zeros without ever cutting (lpad cuts longer input)."""
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)


def collector_code(code: Column) -> Column:
    """Official code as the collector writes it: blank is NULL, 2a/2b go upper."""
    text = trim_space(code.cast("string"))
    island = (F.length(text) == 5) & F.upper(F.left(text, F.lit(2))).isin("2A", "2B")
    return (F.when(text == "", None)
            .when(island, F.upper(text))
            .when(is_digits(text), zero_fill(text, 5))
            .otherwise(text))


def pad_department(code: Column) -> Column:
    return zero_fill(code.cast("string"), 2)


def display_name(town: Column, point: Column) -> Column:
    """Town name, else point name, trimmed."""
    return trim_space(F.coalesce(town, point))


def midnight_text(time: Column) -> Column:
    return F.concat(F.date_format(F.to_date(time), "yyyy-MM-dd"), F.lit(" 00:00:00"))


def reading_hash(time: Column, name: Column) -> Column:
    """SHA-256 of the business key: a place has one reading per day."""
    return F.sha2(F.concat(midnight_text(time), F.lit("_"), name.cast("string")), 256)


def record_hash(columns: list[str]) -> Column:
    """MD5 of a whole record, independent of column order."""
    return F.md5(F.to_json(F.struct(*[F.col(f"`{c}`") for c in sorted(columns)])))
