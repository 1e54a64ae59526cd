"""Text extraction as JVM-side column expressions.

Flags: ``(?U)`` gives Unicode character classes, ``(?d)`` makes ``.`` stop at a line
feed only; together they match the usual scripting-language regex semantics.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

from forecourt import vocabulary as V

# The characters Unicode and its bidirectional classes count as white space.
_BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def stripped(c: Column) -> Column:
    """Without leading and trailing white space of any kind; looks at the ends only."""
    return F.btrim(c, F.lit(_BLANKS))


def number_or_null(c: Column) -> Column:
    """The number a string spells, or NULL; never raises under ANSI mode."""
    text = c.cast("string")
    return F.when(text.rlike(_NUMBER), F.trim(text).try_cast("double"))


def titled(c: Column) -> Column:
    """``-`` becomes a space and every run of letters starts with a capital.

    ``initcap`` capitalises after blanks only. Where a letter follows a digit or another
    mark, the text is split into letter and other runs, which costs far more.
    """
    spaced = F.replace(c, F.lit("-"), F.lit(" "))
    runs = F.regexp_extract_all(F.lower(spaced), F.lit(r"(\p{L}+|\P{L}+)"))
    return F.when(
        spaced.rlike(r"[^\p{L} ]\p{L}"), F.array_join(F.transform(runs, F.initcap), "")
    ).otherwise(F.initcap(spaced))


def _captured(c: Column, pattern: str) -> Column:
    """First group of the first match, ``''`` without a match.

    The patterns capture at least one character, so an empty result means no match, and
    the regex need not run a second time to tell.
    """
    return F.regexp_extract(c, "(?Ud)" + pattern, 1)


def condition_of(description: Column) -> Column:
    """First stated condition, or ``Unknown`` where there is none."""
    found = _captured(description, V.CONDITION_PATTERN)
    return F.when(found != "", stripped(found)).otherwise(F.lit(V.UNKNOWN_CONDITION))


def amenities_of(description: Column) -> Column:
    """Listed amenities in order, or an empty array."""
    found = _captured(description, V.AMENITIES_PATTERN)
    return F.when(found != "", F.transform(F.split(found, ","), stripped)).otherwise(
        F.array().cast("array<string>")
    )
