"""String helpers shared by the parsers."""

from __future__ import annotations

import string
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Unicode counts as blank.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# The same set as a regular-expression class that Java and RE2 read alike.
BLANK_CLASS = r"[\t-\r\x1c-\x20\x85\p{Z}]"


# Decimal digits of the other scripts, and the ASCII digit of each, from Unicode's own table.
OTHER_DIGITS = "".join(
    chr(code) for code in range(0x80, 0x20000) if unicodedata.category(chr(code)) == "Nd"
)
OTHER_DIGITS_AS_ASCII = "".join(str(unicodedata.decimal(digit)) for digit in OTHER_DIGITS)


def to_number(digits: Column, kind: str = "double") -> Column:
    """Digits of any script as a number, null for none. The translation only runs where there
    are digits a plain cast does not know."""
    latin = F.translate(digits, OTHER_DIGITS, OTHER_DIGITS_AS_ASCII)
    return F.coalesce(digits.try_cast(kind), F.when(digits != "", latin.try_cast(kind)))


def strip(text: Column) -> Column:
    """Drop blanks of any kind from both ends (``trim`` alone only knows the space)."""
    return F.btrim(text, F.lit(BLANKS))


def fold_ascii(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def contains_like(text: Column, wanted: str) -> Column:
    """``text LIKE '%wanted%'``, folding ASCII case only, with no escape character.

    ``%`` and ``_`` inside ``wanted`` stay wildcards. Spark reads a backslash as an
    escape, so a literal one is doubled.
    """
    folded = wanted.translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase))
    pattern = "%" + folded.replace("\\", "\\\\") + "%"
    exact = fold_ascii(text).like(pattern)
    if wanted.isascii() and "_" not in wanted:
        # ILIKE folds every script, so it keeps at least the same rows, and it is several
        # times faster: let it go first.
        return text.ilike(pattern) & exact
    return exact
