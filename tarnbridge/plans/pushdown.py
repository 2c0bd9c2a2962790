"""What of a query reaches its scans, from Spark's own plan; nothing runs."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

#: Spark's own translation of predicates into source filters (a Scala object).
_STRATEGY = "org.apache.spark.sql.execution.datasources.DataSourceStrategy$"


def mentioned(name: str, text: str | None) -> bool:
    """Whether a name stands in a text as a word of its own, without case."""
    return bool(text) and bool(re.search(rf"(?i)(?<!\w){re.escape(name)}(?!\w)", text))


def _terms(condition):
    """The parts that AND joins."""
    todo = [condition]
    while todo:
        c = todo.pop()
        if _kind(c) == "And":
            todo += [c.right(), c.left()]
        else:
            yield c


def _kind(node) -> str:
    return node.getClass().getSimpleName()


def _all_names(node) -> list[str]:
    found = node.references().toSeq()
    return [found.apply(i).name() for i in range(found.size())]


def _names(expression) -> list[str]:
    found = expression.references().toSeq()
    return [found.apply(i).name() for i in range(found.size())]


def redacted(text: str) -> str:
    """A source filter without its values: ``EqualTo(a,5)`` as ``EqualTo(a,?)``."""
    return re.sub(r"^(\w+)\((\w+),.*\)$", r"\1(\2,?)", text, flags=re.S)


@dataclass
class FileScan:
    """A scan of files: its path, the columns read, and the filters right above it (Catalyst expressions)."""

    path: str
    columns: list[str]
    terms: list
    translate: Callable

    def classified(self, none_charset: tuple[str, ...] = ()) -> tuple[list[str], list[str], list[str]]:
        """The filters that the scan can take, the columns of those that stay above it, and why each of these does.

        Spark decides: a filter is pushed if there is a source filter for it. No value of a literal is kept.
        """
        pushed, residual, reasons = [], [], []
        compared = {n for t in self.terms if _kind(t) != "IsNotNull" for n in _names(t)}
        for term in self.terms:
            if _kind(term) == "IsNotNull" and set(_names(term)) <= compared:
                continue  # Spark adds it to the comparison
            source = self.translate(term, True)
            if source.isDefined():
                pushed.append(redacted(source.get().toString()))
            else:
                residual.append(",".join(_names(term)))
                reasons.append("NONE_CHARSET" if set(_names(term)) & set(none_charset) else "UNSUPPORTED_OP")
        return pushed, residual, reasons


def file_scans(df: DataFrame) -> list[FileScan]:
    """The scans of a query's optimized plan, from left to right, subqueries not among them."""
    translate = df.sparkSession._jvm.java.lang.Class.forName(_STRATEGY).getField("MODULE$").get(None).translateFilter
    out = []

    def visit(node, terms: list, needed: set | None) -> None:
        kind, children = _kind(node), node.children()
        if kind == "LogicalRelation":
            source, own = node.relation(), node.output()
            names = [own.apply(i).name() for i in range(own.size())]
            path = source.location().rootPaths().apply(0).toString() if _kind(source) == "HadoopFsRelation" else ""
            out.append(FileScan(path, [n for n in names if needed is None or n in needed], terms, translate))
        if kind == "Filter":
            terms = terms + list(_terms(node.condition()))
            needed = None if needed is None else needed | set(_names(node.condition()))
        elif kind == "Project":
            listed = node.projectList()
            needed = {n for i in range(listed.size()) for n in _names(listed.apply(i))}
        elif children.size():
            terms, needed = [], set(_all_names(node)) if needed is None or kind == "Aggregate" else needed | set(_all_names(node))
        for i in range(children.size()):
            visit(children.apply(i), terms, needed)

    visit(df._jdf.queryExecution().optimizedPlan(), [], None)
    return out


def classified(df: DataFrame, none_charset: tuple[str, ...] = ()) -> tuple[list[str], list[str], list[str]]:
    """``FileScan.classified`` over all scans of a query; filters of other sources are not seen."""
    found = [s.classified(none_charset) for s in file_scans(df)[:1]]
    return tuple([x for f in found for x in f[i]] for i in range(3))
