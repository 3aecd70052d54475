"""String expressions with Python's semantics, all on the JVM side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The no-break blank, and characters that show nothing.
NBSP = "\u00a0"
#: All characters of Unicode's property White_Space.
WHITE_SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
UNSEEN = "\u00ad\u200b\u200c\u200d\u200e\u200f\u202a\u202b\u202c\u202d\u202e\u2060\u2061\u2062\u2063\u2064\ufeff"
INVISIBLE = "[\\u00ad\\u200b-\\u200f\\u202a-\\u202e\\u2060-\\u2064\\ufeff]"


def py_strip(c: Column) -> Column:
    """Unicode strip: also no-break blanks, tabs and line ends."""
    return F.btrim(c, F.lit(WHITE_SPACE))


def bare(c: Column) -> Column:
    """Without blanks of any kind and invisible characters."""
    return F.translate(c, WHITE_SPACE + UNSEEN, "")


def squeeze(c: Column) -> Column:
    """Without invisible characters, outer blanks and runs of blanks of any kind."""
    return F.trim(F.regexp_replace(F.regexp_replace(c, INVISIBLE, ""), r"(?U)\s+", " "))


def name_key(c: Column) -> Column:
    """A key under which spellings of one name meet: whatever its case, blanks, invisible characters, ``AND`` for ``&``."""
    bare = F.regexp_replace(F.upper(squeeze(c)), r"(?<= )AND(?= )", "&")
    return F.regexp_replace(bare, " ", "")


def blank_to(c: Column, default: str = "N/A") -> Column:
    """``default`` for null or an empty string."""
    return F.coalesce(F.when(c != "", c), F.lit(default))


def drop_nbsp(c: Column) -> Column:
    return F.replace(c, F.lit(NBSP), F.lit(""))


def strip_mailto(c: Column) -> Column:
    """Rewrites only what starts with ``mailto:``: every ``mailto:`` goes, then outer blanks."""
    return F.when(c.startswith("mailto:"), py_strip(F.replace(c, F.lit("mailto:"), F.lit("")))).otherwise(c)


def cut_mailto(c: Column) -> Column:
    """Drops a leading ``mailto:`` and nothing else."""
    return F.when(c.startswith("mailto:"), F.substr(c, F.lit(8))).otherwise(c)


def after_marker(c: Column, marker: str, width: int, until: str | None = None) -> Column:
    """The stripped text ``width`` places after the first ``marker``, up to the next ``until`` or the end; null without marker."""
    rest = F.substr(c, F.locate(marker, c) + F.lit(width))
    if until is not None:
        rest = F.substring_index(rest, until, 1)
    return F.when(F.contains(c, F.lit(marker)), py_strip(rest))


def flag(c: Column) -> Column:
    """True for ``true``, ``1`` and ``yes`` in any case."""
    return F.lower(c).isin("true", "1", "yes")


def base_name(c: Column) -> Column:
    return F.element_at(F.split(c, "/"), -1)


def strip_extension(c: Column) -> Column:
    return F.regexp_replace(c, r"\.[^.]*$", "")


def join_lines(lines: Column) -> Column:
    """Stripped lines that aren't blank, joined by ``', '``."""
    return F.array_join(F.filter(F.transform(lines, py_strip), lambda x: x != ""), ", ")
