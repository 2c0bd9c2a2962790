"""Range partitions over a single-column integer key. Pure functions."""

from __future__ import annotations

from dataclasses import dataclass

#: Key values for each partition, and the range below which a scan stays serial.
ROWS_PER_PARTITION, SERIAL_BELOW = 2_000_000, 4_000_000


@dataclass(frozen=True)
class KeyClass:
    eligible: bool
    column: str | None
    reason: str


def classify_key(columns: list[str], kinds: list[str]) -> KeyClass:
    """Whether a primary key can be split into ranges. kinds: the columns' Spark types."""
    if not columns:
        return KeyClass(False, None, "no primary key")
    if len(columns) > 1:
        return KeyClass(False, columns[0], "composite PK")
    if kinds[0] not in ("smallint", "int", "bigint"):
        return KeyClass(False, columns[0], "non-numeric PK")
    return KeyClass(True, columns[0], "single numeric PK")


def pick_partition_count(low: int | None, high: int | None, cores: int) -> int:
    if low is None or high is None or high <= low or high - low + 1 < SERIAL_BELOW:
        return 1
    return max(1, min((high - low + 1) // ROWS_PER_PARTITION, cores))


def ranges(low: int, high: int, n: int) -> list[tuple[int | None, int | None]]:
    """n ranges of equal width. The first has no lower and the last no upper bound, so rows outside low..high are never lost."""
    n = max(1, min(n, high - low + 1))
    width = high - low + 1
    starts = [low + width * i // n for i in range(n)]
    return [(None if i == 0 else starts[i], None if i == n - 1 else starts[i + 1] - 1) for i in range(n)]


def predicate(column: str, low: int | None, high: int | None) -> str:
    parts = ([f"{column} >= {low}"] if low is not None else []) + ([f"{column} <= {high}"] if high is not None else [])
    return " AND ".join(parts) or "1 = 1"
