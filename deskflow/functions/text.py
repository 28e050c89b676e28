"""Cleaning, filtering and measuring text, as column expressions.

White space and word characters follow Unicode.  The classes are spelled out,
so that every regex engine that knows ``\\p{..}`` gives the same result.
"""

from pyspark.sql import Column, functions as F

from deskflow import fixed

_SPACE_RANGES = [(0x09, 0x0D), (0x1C, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680), (0x2000, 0x200A),
                 (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000)]
SPACES = "".join(chr(c) for lo, hi in _SPACE_RANGES for c in range(lo, hi + 1))
SPACE_CLASS = "".join(rf"\x{{{lo:X}}}-\x{{{hi:X}}}" for lo, hi in _SPACE_RANGES)
WORD_CLASS = r"\p{L}\p{N}_"

URL = rf"https?://[^{SPACE_CLASS}]+|www\.[^{SPACE_CLASS}]+"
HANDLE = rf"@[{WORD_CLASS}]+"
# Order matters: "&amp;lt;" ends as "<".
ENTITIES = [("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"')]


def strip(c: Column) -> Column:
    """Remove Unicode white space at both ends; null becomes ''."""
    return F.coalesce(F.btrim(c, F.lit(SPACES)), F.lit(""))


def embed_input(c: Column) -> Column:
    """Text as given to an encoder: null or blank becomes one space."""
    return F.when(strip(c) == "", F.lit(" ")).otherwise(c)


def remove_urls(c: Column) -> Column:
    return F.regexp_replace(c, URL, "")


def remove_handles(c: Column) -> Column:
    return F.regexp_replace(c, HANDLE, "")


def unescape(c: Column) -> Column:
    for entity, char in ENTITIES:
        c = F.replace(c, F.lit(entity), F.lit(char))
    return c


def printable_ascii(c: Column) -> Column:
    """Every character outside space..tilde becomes one space."""
    return F.regexp_replace(c, r"[^\x20-\x7E]", " ")


def clean_text(c: Column) -> Column:
    """Drop URLs and handles, unescape entities, keep printable ASCII, squeeze spaces."""
    c = unescape(remove_handles(remove_urls(F.coalesce(c, F.lit("")))))
    return F.trim(F.regexp_replace(printable_ascii(c), " {2,}", " "))


def mostly_ascii(c: Column, share: float = fixed.ASCII_SHARE) -> Column:
    """True when the text has 5 characters or more and its ASCII share is above ``share``."""
    ascii_chars = F.length(F.regexp_replace(c, r"[^\x00-\x7F]+", ""))
    return F.coalesce(
        F.when(F.length(strip(c)) >= 5, F.try_divide(ascii_chars, F.length(c)) > F.lit(share)), F.lit(False)
    )


def parse_flag(c: Column) -> Column:
    """'true', '1', 't' in any case are true, all else (null too) is false."""
    return F.coalesce(F.lower(c).isin("true", "1", "t"), F.lit(False))


def text_key(c: Column) -> Column:
    """32-byte digest that stands for a text in joins and groupings, so that shuffles need not carry the text."""
    return F.unhex(F.sha2(c, 256))


def words(c: Column) -> Column:
    return F.split(strip(c), f"[{SPACE_CLASS}]+")


def word_count(c: Column) -> Column:
    return F.when(strip(c) == "", F.lit(0)).otherwise(F.size(words(c)))


def tokens(c: Column) -> Column:
    """Lower-case words of two or more word characters."""
    return F.regexp_extract_all(F.lower(c), F.lit(rf"[{WORD_CLASS}]{{2,}}"), F.lit(0))


def fixed_point(c: Column, digits: int) -> Column:
    """Number as text with ``digits`` decimals, rounding the binary value half to even."""
    return F.replace(F.format_number(c.cast("double"), digits), F.lit(","), F.lit(""))


def round_binary(c: Column, digits: int) -> Column:
    """Round the binary value half to even (``F.round`` rounds the printed decimal half up)."""
    return fixed_point(c, digits).cast("double")
