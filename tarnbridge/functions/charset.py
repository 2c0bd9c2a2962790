"""Decoding of text whose column declares no charset, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The code points of windows-1252 at 0x80-0x9F; five undefined bytes keep their own code point.
WIN1252 = "€\x81‚ƒ„…†‡ˆ‰Š‹Œ\x8dŽ\x8f\x90‘’“”•–—˜™š›œ\x9džŸ"
_C1 = "".join(chr(c) for c in range(0x80, 0xA0))


def win1252(data: Column) -> Column:
    return F.translate(F.decode(data, "ISO-8859-1"), _C1, WIN1252)


def latin1(data: Column) -> Column:
    return F.decode(data, "ISO-8859-1")


def strict(data: Column, column: str) -> Column:
    """Valid UTF-8 as text; any other bytes fail with the column's name."""
    text = data.cast("string")
    return F.when(data.isNull() | F.is_valid_utf8(text), text).otherwise(F.raise_error(F.lit(f"column {column} holds bytes that are not valid UTF-8; use none_encoding win1252, iso8859_1 or blob")))


def decoded(data: Column, mode: str, column: str) -> Column:
    """Raw bytes under one of the modes; ``blob`` leaves them."""
    return {"win1252": win1252, "iso8859_1": latin1, "strict": lambda d: strict(d, column), "blob": lambda d: d}[mode](data)
