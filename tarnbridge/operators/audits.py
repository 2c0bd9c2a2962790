"""What the data say about the declared dictionary: counts, nulls, keys, references. Spark aggregations over whole tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.partition import ROWS_PER_PARTITION, SERIAL_BELOW
from .bridge import Attached, Bridge
from .diagnostics import indexes_of


def _tables(bridge: Bridge, alias: str, function: str):
    source = bridge.alias(alias, function)
    return source, [r for _, r in sorted(source.relations.items()) if r.kind == "table"]


def _all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def row_counts(bridge: Bridge, alias: str) -> DataFrame:
    """table_name, column_count, has_pk, n_rows: one scan of no columns for each table."""
    source, tables = _tables(bridge, alias, "row_counts")
    return _all([source.raw(r).agg(F.count("*").alias("n_rows")).select(F.lit(r.name).alias("table_name"), F.lit(len(source.schema(r))).alias("column_count"), F.lit(bool(r.primary_key)).alias("has_pk"), "n_rows") for r in tables])


def _unpivoted(df: DataFrame, name: str, values: dict[str, dict]) -> DataFrame:
    """One row for each column from one aggregation: values has the aggregates of each column by their names."""
    each = [F.struct(F.lit(c).alias("column_name"), F.lit(i).alias("ordinal_position"), *[e.alias(k) for k, e in found.items()]) for i, (c, found) in enumerate(values.items(), 1)]
    return df.agg(F.array(*each).alias("all")).select(F.lit(name).alias("table_name"), F.inline("all"))


def null_counts(bridge: Bridge, alias: str) -> DataFrame:
    """table_name, column_name, ordinal_position, n_nulls: one aggregation for each table."""
    source, tables = _tables(bridge, alias, "null_counts")
    return _all([_unpivoted(source.raw(r), r.name, {c: {"n_nulls": F.count_if(F.col(f"`{c}`").isNull())} for c in source.schema(r).names}) for r in tables])


def text_widths(bridge: Bridge, alias: str) -> DataFrame:
    """table_name, column_name, ordinal_position, max_chars, n_padded for text columns: what a fixed width would need, and values that end in a space."""
    source, tables = _tables(bridge, alias, "text_widths")
    out = []
    for r in tables:
        names = [f.name for f in source.schema(r).fields if isinstance(f.dataType, T.StringType)]
        if names:
            out.append(_unpivoted(source.raw(r), r.name, {c: {"max_chars": F.max(F.length(F.col(f"`{c}`"))).cast("long"), "n_padded": F.count_if(F.col(f"`{c}`").endswith(" "))} for c in names}))
    return _all(out)


def key_checks(bridge: Bridge, alias: str) -> DataFrame:
    """table_name, constraint_name, n_rows, n_keys, n_null_keys of each declared primary key: a key holds if all rows have one of their own."""
    source, tables = _tables(bridge, alias, "key_checks")
    return _all([_key_check(source, r) for r in tables if r.primary_key])


def _key_check(source: Attached, r) -> DataFrame:
    keys = [F.col(f"`{c}`") for c in r.primary_key]
    missing = reduce(lambda a, b: a | b, [k.isNull() for k in keys])
    # Copies are counted in each task first, so a key that many rows share is one row in the shuffle.
    each = source.raw(r).groupBy(*keys).agg(F.count("*").alias("n"))
    return each.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.count_if(~missing).alias("n_keys"), F.coalesce(F.sum(F.when(missing, F.col("n")).otherwise(0)), F.lit(0)).alias("n_null_keys")).select(F.lit(r.name).alias("table_name"), F.lit(f"PK_{r.name}").alias("constraint_name"), "*")


def reference_checks(bridge: Bridge, alias: str) -> DataFrame:
    """fk_constraint, fk_table, pk_table, n_rows, n_orphans: rows whose reference is not null and not found."""
    source, tables = _tables(bridge, alias, "reference_checks")
    out = []
    for r in tables:
        for name, own, target, other, *_ in r.foreign_keys:
            # Rows of one reference are counted before the join, so a frequent one is a single row there.
            child = source.raw(r).groupBy(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(own)]).agg(F.count("*").alias("n"))
            parent = source.raw(source.relation(target)).select(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(other)]).distinct().withColumn("found", F.lit(True))
            joined = child.join(parent, [f"k{i}" for i in range(len(own))], "left")
            known = reduce(lambda a, b: a & b, [F.col(f"k{i}").isNotNull() for i in range(len(own))])
            orphans = F.sum(F.when(known & F.col("found").isNull(), F.col("n")).otherwise(0))
            out.append(joined.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.coalesce(orphans, F.lit(0)).alias("n_orphans")).select(F.lit(name).alias("fk_constraint"), F.lit(r.name).alias("fk_table"), F.lit(target).alias("pk_table"), "*"))
    return _all(out)


def index_selectivity(bridge: Bridge, alias: str) -> DataFrame:
    """table_name, index_name, n_distinct, selectivity (1 / n_distinct; null for an empty table) of each declared index with columns."""
    source, tables = _tables(bridge, alias, "index_selectivity")
    out = []
    for r in tables:
        for name, cols, *_ in indexes_of(r):
            if cols:
                n = source.raw(r).select(*[F.col(f"`{c}`") for c in cols]).distinct().agg(F.count("*").alias("n_distinct"))
                out.append(n.select(F.lit(r.name).alias("table_name"), F.lit(name).alias("index_name"), "n_distinct", F.try_divide(F.lit(1.0), F.col("n_distinct")).alias("selectivity")))
    return _all(out)


def scan_profile(bridge: Bridge, name: str) -> DataFrame:
    """table_name, key_column, n_rows, key_low, key_high, key_span, recommended_partitions of a relation, from one aggregation.

    ``recommended_partitions`` is what a scan by key ranges would use on this session's cores.
    """
    alias, _, rest = name.partition(".")
    source = bridge.alias(alias, "scan_profile")
    r = source.relation(rest)
    key = source.key(r) if r.kind == "table" else None
    df = source.raw(r)
    if key is None or not key.eligible:
        none = F.lit(None).cast("long")
        return df.agg(F.count("*").alias("n_rows")).select(F.lit(r.name).alias("table_name"), F.lit(None).cast("string").alias("key_column"), "n_rows", none.alias("key_low"), none.alias("key_high"), none.alias("key_span"), F.lit(1).alias("recommended_partitions"))
    low, high = F.min(key.column).cast("long"), F.max(key.column).cast("long")
    found = df.agg(F.count("*").alias("n_rows"), low.alias("key_low"), high.alias("key_high")).withColumn("key_span", F.col("key_high") - F.col("key_low") + 1)
    cores = bridge.spark.sparkContext.defaultParallelism
    return found.select(F.lit(r.name).alias("table_name"), F.lit(key.column).alias("key_column"), "*", partitions_for("key_span", cores).alias("recommended_partitions"))


def partitions_for(span: str, cores: int) -> Column:
    """``pick_partition_count`` as an expression over the key's span."""
    n = F.least(F.floor(F.col(span) / ROWS_PER_PARTITION), F.lit(cores))
    return F.when(F.col(span) >= SERIAL_BELOW, F.greatest(n, F.lit(1))).otherwise(F.lit(1)).cast("int")
