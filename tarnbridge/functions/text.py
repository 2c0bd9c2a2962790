"""Quoting, pattern matching and redaction."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def quote_ident(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def quote_literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def quote_yaml(text: str) -> str:
    """A double-quoted YAML scalar."""
    named = {"\\": "\\\\", '"': '\\"', "\n": "\\n", "\r": "\\r", "\t": "\\t"}
    return '"' + "".join(named.get(c, f"\\x{ord(c):02X}" if ord(c) < 0x20 else c) for c in text) + '"'


def like(column: Column, pattern: str) -> Column:
    """LIKE in which a backslash is an ordinary character."""
    return column.like(pattern.replace("\\", "\\\\"))


def decfloat_text(column: Column) -> Column:
    """Decimal floats as text: filters on it compare text, so ``123.450`` is not ``123.45``."""
    return column.cast("string")


def char_text(column: Column) -> Column:
    """A fixed-width column without its trailing spaces; other white space stays."""
    return F.rtrim(column)


_SECRET = re.compile(r"(?i)(password|pwd)\s*=\s*[^;&\s]+|(://[^:/@\s]*):[^@\s]*@")


def sanitized(message: str, secrets: tuple[str, ...] = ()) -> str:
    """A message without passwords."""
    for secret in filter(None, secrets):
        message = message.replace(secret, "<redacted>")
    return _SECRET.sub(lambda m: f"{m[1]}=<redacted>" if m[1] else f"{m[2]}:<redacted>@", message)
