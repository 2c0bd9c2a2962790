"""The shape of a view's definition: joins, aggregation, filters."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import SparkSession

_LITERAL = re.compile(r"'(?:[^']|'')*'|--[^\n]*|/\*.*?\*/", re.S)
_AGGREGATE = re.compile(r"\b(?:COUNT|SUM|AVG|MIN|MAX|LIST)\s*\(")


@dataclass(frozen=True)
class ViewShape:
    inspected: bool
    join: bool = False
    aggregate: bool = False
    where: bool = False

    @property
    def heavy(self) -> bool:
        return not self.inspected or self.join or self.aggregate

    def reasons(self) -> list[str]:
        if not self.inspected:
            return ["view_definition_not_inspected"]
        return [n for n, on in (("view_contains_join", self.join), ("view_contains_aggregation", self.aggregate), ("view_no_filter", not self.where)) if on]


def scan_tokens(text: str | None) -> ViewShape:
    """The shape from key words, with literals and comments blanked."""
    if not text:
        return ViewShape(False)
    flat = " " + re.sub(r"\s+", " ", _LITERAL.sub(" ", text).upper()) + " "
    return ViewShape(True, " JOIN " in flat, " GROUP BY " in flat or bool(_AGGREGATE.search(flat)), " WHERE " in flat)


def analyse(spark: SparkSession, text: str | None) -> ViewShape:
    """The shape from Spark's parser, which also sees comma joins and DISTINCT; from key words where the text does not parse."""
    if not text:
        return ViewShape(False)
    try:
        plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(text).treeString()
    except Exception:
        return scan_tokens(text)
    has = lambda p: bool(re.search(rf"(?m)^[\s:+\-]*'?(?:{p})\b", plan))
    return ViewShape(True, has("Join|LateralJoin"), has("Aggregate|Distinct") or bool(_AGGREGATE.search(_LITERAL.sub(" ", text).upper())), has("Filter|UnresolvedHaving"))
