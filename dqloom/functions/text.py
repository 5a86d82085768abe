"""Text expressions: format predicates, shape masks and the named formats."""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

# Named formats, in the regex subset shared by Java and RE2.
NAMED_FORMATS = {
    "email": r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}\z",
    "phone": r"^(\+?[0-9]{1,3}[ .-]?)?\(?[0-9]{2,4}\)?([ .-]?[0-9]{2,4}){2,4}\z",
    "first_last_name": r"^\p{Lu}[\p{L}'-]+ \p{Lu}[\p{L}'-]+\z",
    "no_special_characters": r"^[\p{L}\p{M}' -]+\z",
    "street_address": r"^[0-9]+[A-Za-z]? [\p{L}0-9.' -]+(, [\p{L}0-9.' -]+)*\z",
}

# Letters, marks, numbers, punctuation, symbols and spaces are expected anywhere.
ODD_CHARACTER = r"[^\p{L}\p{M}\p{N}\p{P}\p{S}\p{Z}\s]"

SPACES = r"[ \t\n\x0B\f\r]+"

# (run of characters, letter standing for it in a shape). Letters without case and
# combining marks share one class, so scripts other than Latin have shapes too.
SHAPE_CLASSES = (
    (r"\p{Nd}+", "9"),
    (r"\p{Lu}+", "A"),
    (r"\p{Ll}+", "a"),
    (r"[\p{Lo}\p{Lm}\p{Lt}\p{M}]+", "o"),
    (SPACES, " "),
)
# The same classes for ASCII: every character to its letter, then runs to one letter.
ASCII_FROM = string.ascii_lowercase + string.ascii_uppercase + string.digits + "\t\n\x0b\f\r"
ASCII_TO = "a" * 26 + "A" * 26 + "9" * 10 + " " * 5
LETTER_RUN = r"([aA9 ])\1+"


def violates(value: Column, regex: str) -> Column:
    """True where a value does not contain a match; NULL values are left out."""
    return ~value.rlike(regex)


def is_empty(value: Column) -> Column:
    return value.isNotNull() & (F.length(value) == 0)


def has_odd_character(value: Column) -> Column:
    return value.rlike(ODD_CHARACTER)


def spelling_key(value: Column) -> Column:
    """What is left of a value when case and outer blanks are ignored."""
    return F.lower(F.trim(value))


def shape_mask(value: Column) -> Column:
    """Shape of the whole value: each run of one character class becomes one letter.

    Plain ASCII values, as codes and names mostly are, take a cheaper way to the same shape.
    """
    letters = F.translate(value, ASCII_FROM, ASCII_TO)
    ascii_shape = F.regexp_replace(letters, LETTER_RUN, "$1")
    shape = value
    for run, letter in SHAPE_CLASSES:
        shape = F.regexp_replace(shape, run, letter)
    return F.when(F.octet_length(value) == F.length(value), ascii_shape).otherwise(shape)


def shape_regex(shape: Column) -> Column:
    """Unanchored regex matching exactly the values of one shape."""
    regex = F.regexp_replace(shape, r"([\\.\[\]{}()*+?^$|])", r"\\$1")
    # the class for caseless letters holds an 'o' itself, so it goes first
    for run, letter in sorted(SHAPE_CLASSES, key=lambda c: c[1] != "o"):
        regex = F.replace(regex, F.lit(letter), F.lit(run))
    return regex


def anchored(alternatives: Column) -> Column:
    """Array of regexes -> one regex that must cover the whole value."""
    return F.concat(F.lit("^(?:"), F.array_join(alternatives, "|"), F.lit(r")\z"))
