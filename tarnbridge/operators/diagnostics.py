"""Diagnostics of an attached source: relation and index profiles, health, and a plan-only pushdown report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ..plans.partition import pick_partition_count
from ..plans.pushdown import file_scans
from .bridge import Bridge

_ALERTS = "alerts array<struct<code:string,severity:string,message:string>>"
_WATERMARKS = (T.ShortType, T.IntegerType, T.LongType, T.DateType, T.TimestampType, T.TimestampNTZType)
_FILTERS = (*_WATERMARKS, T.DecimalType, T.StringType)

#: Alert codes with severity and message.
ALERTS = {
    "view_no_scan_lever": ("HIGH", "a view is read serially"), "view_definition_not_inspected": ("MEDIUM", "the view's definition could not be read"),
    "view_contains_join": ("HIGH", "the view joins relations"), "view_contains_aggregation": ("HIGH", "the view aggregates"), "view_no_filter": ("MEDIUM", "the view has no filter"),
    "partition_advisory": ("LOW", "the key's range allows parallel partitions"), "server_parallelism_caveat": ("LOW", "parallel partitions need a server that scales with connections"),
    "pk_range_small_serial": ("LOW", "the key's range is small, so one partition serves"), "no_primary_key": ("HIGH", "there is no primary key to split by"),
    "composite_pk_serial": ("LOW", "a composite primary key is not split"), "numeric_pk_no_range_serial": ("LOW", "the key has no usable range"), "non_numeric_pk_serial": ("LOW", "a key that is not an integer is not split"),
    "no_indexed_filter_columns": ("MEDIUM", "no indexed column suits a filter"), "none_charset_text_columns": ("MEDIUM", "text columns without a charset are not pushed"),
    "no_indexes_on_table": ("HIGH", "the relation has no index"), "index_inactive": ("MEDIUM", "the index is inactive"), "missing_statistics": ("LOW", "the index has no statistics"),
}


def _alert(code: str) -> tuple:
    return (code, *ALERTS[code])


def indexes_of(relation) -> list[tuple]:
    """(name, columns, unique, active, expression, is_pk, is_fk)."""
    out = [(f"PK_{relation.name}", relation.primary_key, True, True, None, True, False)] if relation.primary_key else []
    return out + [(n, c, False, True, None, False, True) for n, c, *_ in relation.foreign_keys] + [(*x[:5], False, False) for x in relation.indexes]


def profile_table(bridge: Bridge, name: str, cores: int | None = None) -> DataFrame:
    """One row on how a relation can be scanned: keys, indexes, candidates, risk, partitions, alerts."""
    alias, _, rest = name.partition(".")
    source = bridge.alias(alias, "profile_table")
    r = source.relation(rest)
    schema, view, codes = source.schema(r), r.kind == "view", []
    covered = {c for x in indexes_of(r) for c in x[1]}
    candidates = [] if view else [f.name for f in schema.fields if f.name in covered and isinstance(f.dataType, _FILTERS) and f.name not in r.none_charset]
    risk, parts = "HIGH", 1
    if view:
        codes = ["view_no_scan_lever", *bridge.view_shape(r).reasons()]
    else:
        key = source.key(r)
        bounds = source.key_range(r)
        if key.eligible and bounds:
            parts = pick_partition_count(*bounds, cores or bridge.spark.sparkContext.defaultParallelism)
            risk, codes = ("MEDIUM", ["partition_advisory", "server_parallelism_caveat"]) if parts > 1 else ("LOW", ["pk_range_small_serial"])
        else:
            codes = [{"no primary key": "no_primary_key", "composite PK": "composite_pk_serial", "non-numeric PK": "non_numeric_pk_serial"}.get(key.reason, "numeric_pk_no_range_serial")]
        codes += [] if candidates else ["no_indexed_filter_columns"]
    codes += ["none_charset_text_columns"] if r.none_charset else []
    text = [f"{n} ({', '.join(c) if c else '(expression)'})" + " UNIQUE" * bool(u) + " PK" * pk for n, c, u, _, _, pk, _ in indexes_of(r)]
    row = (r.name, r.kind, bool(r.primary_key), list(r.primary_key), text, [f.name for f in schema.fields if isinstance(f.dataType, _WATERMARKS)], candidates, risk, parts, [ALERTS[c][1] for c in codes], [_alert(c) for c in codes])
    return bridge.spark.createDataFrame([row], f"table_name string, object_type string, has_primary_key boolean, primary_key_columns array<string>, indexes array<string>, watermark_candidates array<string>, filter_candidates array<string>, full_scan_risk string, recommended_partitions int, warnings array<string>, {_ALERTS}")


def index_profile(bridge: Bridge, name: str) -> DataFrame:
    """A row for each index, or one row that says there is none. The selectivity is 1 / the different keys in the data now."""
    alias, _, rest = name.partition(".")
    source = bridge.alias(alias, "index_profile")
    r = source.relation(rest)
    found = indexes_of(r)
    covered = {c for x in found for c in x[1]}
    bare = [f.name for f in source.schema(r).fields if f.name not in covered and isinstance(f.dataType, _FILTERS)]
    rows = []
    for index, columns, unique, active, _, pk, fk in found:
        keys = source.raw(r).select(*columns).distinct().count() if columns else 0
        alerts = ([] if active else [_alert("index_inactive")]) + ([] if keys else [_alert("missing_statistics")])
        rows.append((index, list(columns), unique, active, pk, fk, 1 / keys if keys else None, alerts, bare))
    rows = rows or [(None, None, None, None, None, None, None, [_alert("no_indexes_on_table")], bare)]
    return bridge.spark.createDataFrame(rows, f"index_name string, columns array<string>, is_unique boolean, is_active boolean, is_primary_key boolean, is_foreign_key boolean, selectivity double, {_ALERTS}, unindexed_filter_candidates array<string>").orderBy("index_name")


#: A gap between transactions that is worth a warning.
GAP = 1_000_000


def health(bridge: Bridge, alias: str, facts: dict | None = None) -> DataFrame:
    """One row on the source's state; facts it does not give are null."""
    bridge.alias(alias, "health")
    f = facts or {}
    oit = f["next_transaction"] - f["oldest_transaction"] if {"next_transaction", "oldest_transaction"} <= f.keys() else None
    oat = f["next_transaction"] - f["oldest_active"] if {"next_transaction", "oldest_active"} <= f.keys() else None
    warnings = [n for n, on in (("oit_gap_high", (oit or 0) > GAP), ("oat_gap_high", (oat or 0) > GAP), ("sweep_disabled", f.get("sweep_interval") == 0), ("forced_writes_off", f.get("forced_writes") is False), ("charset_none", f.get("default_charset") == "NONE"), ("mon_unavailable", not f)) if on]
    names = "engine_version string, ods_version string, sql_dialect int, default_charset string, page_size int, forced_writes boolean, sweep_interval int, oldest_transaction long, oldest_active long, oldest_snapshot long, next_transaction long"
    row = tuple(f.get(n.split()[0]) for n in names.split(", "))
    return bridge.spark.createDataFrame([(*row, oit, oat, f.get("attachments"), warnings)], f"{names}, oit_gap long, oat_gap long, attachments int, warnings array<string>")


_EXPLAIN = "scan_ordinal int, table_name string, projected_columns string, pushed_filters string, residual_columns string, not_pushed_reasons string, pk_range_eligible boolean, pk_range_column string, pk_range_reason string, charset_pushdown_blocked boolean"


def explain_pushdown(bridge: Bridge, alias: str, query: str) -> DataFrame:
    """A row for each file scan of a query, from its plan alone: what is projected, pushed, and could be split."""
    source = bridge.alias(alias, "explain_pushdown")
    df, rows = bridge.sql(query), []
    known = {r.path.rstrip("/").split("/")[-1]: r for r in source.relations.values() if r.path and not r.codes}
    for i, scan in enumerate(file_scans(df), 1):
        r = known.get(scan.path.rstrip("/").split("/")[-1])
        if r is not None:
            pushed, residual, reasons = scan.classified(r.none_charset)
            key = source.key(r)
            rows.append((i, r.name, ",".join(scan.columns), " AND ".join(pushed), ";".join(residual), ",".join(reasons), key.eligible, key.column, key.reason, "NONE_CHARSET" in reasons))
    return bridge.spark.createDataFrame(rows, _EXPLAIN)
