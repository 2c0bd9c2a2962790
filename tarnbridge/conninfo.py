"""Connection descriptors: three string forms, validation, and redaction."""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from urllib.parse import unquote_plus

#: Charsets that a client may ask for.
CLIENT_CHARSETS = ("UTF8", "UTF-8", "NONE", "OCTETS")

#: Names of the ways to read text without a declared charset, without case, "-" and "_".
NONE_MODES = {"win1252": "win1252", "windows1252": "win1252", "cp1252": "win1252", "iso88591": "iso8859_1", "latin1": "iso8859_1", "strict": "strict", "utf8": "strict", "utf8strict": "strict", "blob": "blob", "octets": "blob"}


class BridgeError(ValueError):
    """A request that the bridge refuses; the message names the function or option."""


@dataclass(frozen=True)
class ConnectionInfo:
    """Where a source is and who reads it. The password never appears in ``repr``."""

    database: str
    user: str = ""
    password: str = field(default="", repr=False)
    role: str = ""
    charset: str = "UTF8"
    dialect: int = 3
    host: str = ""
    port: int = 0

    def with_options(self, **options) -> ConnectionInfo:
        given = {k: v for k, v in options.items() if v not in (None, "")}
        out = replace(self, **{k: v for k, v in given.items() if k in self.__dataclass_fields__})
        return replace(out, dialect=int(out.dialect)).validated()

    def validated(self) -> ConnectionInfo:
        if self.charset.upper() not in CLIENT_CHARSETS:
            raise BridgeError(f"charset {self.charset!r} is not supported; use UTF8 or NONE")
        return self

    def redacted(self) -> str:
        """The descriptor as text without a secret."""
        parts = [("database", self.database), ("user", self.user), ("role", self.role), ("charset", self.charset), ("dialect", str(self.dialect))]
        return ";".join(f"{k}={v}" for k, v in parts if v)


def parse_connection(text: str, **options) -> ConnectionInfo:
    """A descriptor from ``scheme://user:password@host:port/path?k=v``, ``k=v;k=v`` or a bare path.

    Unknown keys are ignored. In a URL ``+`` is a space and ``%xx`` a byte; options given by
    name win over the text. An empty database is refused.
    """
    if "://" in text:
        info = _from_url(text)
    elif ";" in text and "=" in text:
        info = _from_pairs(pair for pair in text.split(";"))
    else:
        info = ConnectionInfo(text.strip())
    if not info.database:
        raise BridgeError("the connection string names no database")
    return info.with_options(**options)


def _from_pairs(pairs, **start) -> ConnectionInfo:
    names = {"database": "database", "db": "database", "path": "database", "host": "host", "port": "port", "user": "user", "username": "user", "uid": "user", "password": "password", "pwd": "password", "role": "role", "charset": "charset", "dialect": "dialect"}
    found = dict(start)
    for pair in pairs:
        key, sep, value = pair.partition("=")
        if sep and (name := names.get(key.strip().lower())):
            found[name] = int(value) if name in ("port", "dialect") else value.strip()
    return ConnectionInfo(found.pop("database", ""), **found)


def _from_url(text: str) -> ConnectionInfo:
    scheme, _, rest = text.partition("://")
    rest, _, query = rest.partition("?")
    login, at, place = rest.rpartition("@")
    host, _, path = place.partition("/")
    if scheme in ("file", "parquet", "hdfs", "s3a", "gs", "viewfs"):
        found = {"database": f"{scheme}://{place}" if scheme != "parquet" else f"{'/' if not host else ''}{host}/{path}".rstrip("/")}
    else:
        name, _, port = host.partition(":")
        found = {"database": unquote_plus(path), "host": unquote_plus(name), "port": int(port or 0)}
    if at:
        user, _, password = login.partition(":")
        found |= {"user": unquote_plus(user), "password": unquote_plus(password)}
    pairs = [f"{k}={unquote_plus(v)}" for k, _, v in (p.partition("=") for p in query.split("&"))] if query else []
    return _from_pairs(pairs, **found)


def none_mode(name: str) -> str:
    """The canonical way to read text without a declared charset."""
    key = (name or "win1252").lower().replace("-", "").replace("_", "")
    if key not in NONE_MODES:
        raise BridgeError(f"none_encoding {name!r} is unknown; use win1252, iso8859_1, strict or blob")
    return NONE_MODES[key]


@dataclass(frozen=True)
class ScanOptions:
    """Options of a scan, with the rules that hold between them."""

    partitions: int = 0
    row_limit: int | None = None
    row_offset: int | None = None
    none_encoding: str = "win1252"
    int128: str = "string"

    def validated(self) -> ScanOptions:
        if self.partitions < 0:
            raise BridgeError("partitions must be 0 or more")
        if self.row_limit is not None and self.row_limit <= 0:
            raise BridgeError("row_limit must be more than 0")
        if self.row_offset is not None and self.row_offset < 0:
            raise BridgeError("row_offset must be 0 or more")
        if self.row_offset is not None and self.row_limit is None:
            raise BridgeError("row_offset needs row_limit")
        if self.row_limit is not None and self.partitions > 1:
            raise BridgeError("row_limit and partitions > 1 do not go together: pages are read serially")
        if (self.row_limit or 0) + (self.row_offset or 0) > 2**31 - 1:
            raise BridgeError("row_offset + row_limit is too large")
        if self.int128 not in ("string", "decimal38"):
            raise BridgeError("int128 must be string or decimal38")
        return replace(self, none_encoding=none_mode(self.none_encoding))
