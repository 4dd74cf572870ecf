"""Charset repair of text columns.

Spark encodes to a few charsets itself. Any other charset of one byte a character, such as a Windows or
DOS code page, is described by the character each byte stands for; a text is turned back into its
bytes by one translation of characters, in the JVM like the rest.
"""

from __future__ import annotations

import codecs

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from firstpour.functions.text import quoted

# The charsets Spark encodes to, each with the characters it can hold
# (None: any character).
CHARSETS = {
    "US-ASCII": r"\x00-\x7F",
    "ISO-8859-1": r"\x00-\xFF",
    "UTF-8": None,
    "UTF-16": None,
    "UTF-16BE": None,
    "UTF-16LE": None,
    "UTF-32": None,
}


# Charsets in which plain ASCII text has the same bytes as in UTF-8.
ASCII_BASED = ("US-ASCII", "ISO-8859-1", "UTF-8")


def code_page(charset: str) -> str | None:
    """The 256 characters that a one-byte charset's bytes stand for, or nothing if it is none that Python
    knows. A byte without a character stands for the control character of its own number, as in
    browsers and databases."""
    try:
        name = codecs.lookup(charset).name
        made = "".join(bytes([b]).decode(name, "replace") for b in range(256))
        if bytes(range(256)).decode(name, "replace") != made:
            return None  # some bytes belong together
    except (LookupError, UnicodeError, TypeError):
        return None
    if len(made) != 256:
        return None
    page = "".join(chr(b) if c == "\ufffd" else c for b, c in enumerate(made))
    return page if len(set(page)) == 256 else None


def _class(letters: str) -> str:
    """Characters inside a regular expression's brackets."""
    return "".join(f"\\x{{{ord(c):x}}}" for c in letters)


def _reread(column: Column, charset: str) -> tuple[Column, bool]:
    """A text turned back into bytes of the charset and read as UTF-8, null where that cannot be; and
    whether plain ASCII text has the same bytes in it."""
    if charset in CHARSETS:
        reread = F.try_validate_utf8(F.encode(column, charset).cast("string"))
        held = CHARSETS[charset]
        if held is not None:
            # A value with other characters cannot have come from this charset.
            reread = F.when(column.rlike(rf"\A[{held}]*\z"), reread)
        return reread, charset in ASCII_BASED
    page = code_page(charset)
    moved = [(c, chr(b)) for b, c in enumerate(page) if c != chr(b)]
    bytes_of = F.translate(column, "".join(c for c, _ in moved), "".join(b for _, b in moved)) if moved else column
    reread = F.try_validate_utf8(F.encode(bytes_of, "ISO-8859-1").cast("string"))
    return F.when(column.rlike(rf"\A[{_class(page)}]*\z"), reread), page[:128] == bytes(range(128)).decode()


def _plain(column: Column) -> Column:
    """Whether a value is plain ASCII, one byte a character, and needs no conversion at all."""
    return (F.octet_length(column) == F.char_length(column)) & F.is_valid_utf8(column)


def _repaired(column: Column, charset: str, errors: str) -> Column:
    if errors == "raise" and charset in CHARSETS:
        return F.decode(F.encode(column, charset), "UTF-8")
    reread, ascii_based = _reread(column, charset)
    if errors == "raise":
        told = F.concat(F.lit(f"not text in {charset}: "), column)
        return F.when(column.isNull(), column).otherwise(F.coalesce(reread, F.raise_error(told).cast("string")))
    reread = F.coalesce(reread, F.make_valid_utf8(column))
    return F.when(_plain(column), column).otherwise(reread) if ascii_based else reread


def unrepaired(df: DataFrame, charset: str) -> Column:
    """Names of a row's text columns whose value ``force_encode`` has to leave as it is: other than plain
    ASCII, and not text that was read under the charset. Values that are UTF-8 already are among them."""
    names = []
    for f in df.schema.fields:
        if isinstance(f.dataType, StringType):
            column = F.col(quoted(f.name))
            reread, ascii_based = _reread(column, _known(charset))
            bad = column.isNotNull() & reread.isNull()
            names.append(F.when(bad & ~_plain(column) if ascii_based else bad, F.lit(f.name)))
    return F.filter(F.array(*names), lambda n: n.isNotNull()) if names else F.array().cast("array<string>")


def _known(charset: str) -> str:
    name = charset.upper()
    if name not in CHARSETS and code_page(charset) is None:
        raise ValueError(f"unsupported charset {charset}; supported: {', '.join(CHARSETS)} and charsets of one byte a character")
    return name


def force_encode(df: DataFrame, charset: str | None, errors: str = "keep") -> DataFrame:
    """Convert every text column through ``charset``; other columns pass through.

    Text whose bytes were read under the wrong charset is turned back into those bytes and read as
    UTF-8. With ``errors="keep"`` a value this cannot be done for stays as it is, so one odd row
    neither fails a load nor loses data; only bytes that are no UTF-8 at all become replacement
    characters. With ``errors="raise"`` such a value fails the query.
    """
    if not charset:
        return df
    name = _known(charset)
    if errors not in ("keep", "raise"):
        raise ValueError("errors must be 'keep' or 'raise'")
    return df.select(
        [
            _repaired(F.col(quoted(f.name)), name, errors).alias(f.name)
            if isinstance(f.dataType, StringType)
            else F.col(quoted(f.name))
            for f in df.schema.fields
        ]
    )
