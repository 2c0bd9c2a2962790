"""Questions about an attached source, each a DataFrame built from its dictionary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import quote_yaml
from ..functions.types import FINDING_DETAIL, audit_finding, type_text
from .bridge import Bridge

#: Labels of object types by code.
OBJECT_TYPES = {0: "TABLE", 1: "VIEW", 2: "TRIGGER", 3: "COMPUTED_FIELD", 4: "VALIDATION", 5: "PROCEDURE", 6: "EXPRESSION_INDEX", 7: "EXCEPTION", 8: "USER", 9: "FIELD", 10: "INDEX", 14: "GENERATOR", 15: "UDF", 17: "COLLATION", 18: "PACKAGE", 19: "PACKAGE_BODY"}


def _of(bridge: Bridge, alias: str, function: str) -> dict[str, DataFrame]:
    return bridge.alias(alias, function).dictionary


def tables(bridge: Bridge, alias: str) -> DataFrame:
    d = _of(bridge, alias, "tables")
    counts = d["sys_relation_fields"].groupBy(F.col("relation").alias("name")).agg(F.count("*").cast("int").alias("column_count"))
    keys = d["sys_relation_constraints"].filter("type = 'PRIMARY KEY'").join(d["sys_index_segments"], "index_name").filter("position = 0").select(F.col("relation").alias("name"), F.col("field").alias("pk_column"))
    return d["sys_relations"].join(counts, "name", "left").join(keys, "name", "left").select(F.col("name").alias("table_name"), "kind", "column_count", F.col("pk_column").isNotNull().alias("has_pk"), "pk_column").orderBy("table_name")


def attach_sql(bridge: Bridge, alias: str, schema: str = "main", overwrite: bool = False) -> DataFrame:
    """DDL for a view of each relation; it names the alias, never a secret."""
    source = bridge.alias(alias, "attach_sql")
    verb = "CREATE OR REPLACE TEMPORARY VIEW" if overwrite else "CREATE TEMPORARY VIEW"
    rows = [(f"{verb} `{schema}_{r.name}` AS SELECT * FROM `{source.view_name(r.name)}`;",) for _, r in sorted(source.relations.items())]
    return bridge.spark.createDataFrame(rows, "sql string")


def indexes(bridge: Bridge, alias: str) -> DataFrame:
    d = _of(bridge, alias, "indexes")
    joined = d["sys_indices"].join(d["sys_index_segments"], F.col("name") == F.col("index_name"), "left")
    return joined.select(F.lit("main").alias("table_schema"), F.col("relation").alias("table_name"), F.col("name").alias("index_name"), "is_unique", F.coalesce("is_active", F.lit(True)).alias("is_active"), F.col("position").alias("segment_position"), F.col("field").alias("column_name"), "expression_source").orderBy("table_name", "index_name", "segment_position")


def foreign_keys(bridge: Bridge, alias: str) -> DataFrame:
    d = _of(bridge, alias, "foreign_keys")
    own = d["sys_relation_constraints"].filter("type = 'FOREIGN KEY'").join(d["sys_index_segments"], "index_name").select(F.col("name").alias("fk_constraint"), F.col("relation").alias("fk_table"), F.col("field").alias("fk_column"), "position")
    target = d["sys_ref_constraints"].select(F.col("name").alias("fk_constraint"), F.col("target").alias("pk_constraint"), "update_rule", "delete_rule")
    tables_ = d["sys_relation_constraints"].select(F.col("name").alias("pk_constraint"), F.col("relation").alias("pk_table"))
    return own.join(target, "fk_constraint").join(tables_, "pk_constraint", "left").select(F.lit("main").alias("fk_schema"), "fk_table", "fk_constraint", F.col("position").alias("ordinal_position"), "fk_column", "pk_table", "pk_constraint", "update_rule", "delete_rule").orderBy("fk_table", "fk_constraint", "ordinal_position")


def generators(bridge: Bridge, alias: str) -> DataFrame:
    return _of(bridge, alias, "generators")["sys_generators"].select(F.col("name").alias("generator_name"), "initial_value", "current_value").orderBy("generator_name")


def domains(bridge: Bridge, alias: str) -> DataFrame:
    d = _of(bridge, alias, "domains")["sys_domains"]
    return d.select(F.col("name").alias("domain_name"), type_text(F.col("code"), F.col("subtype"), F.col("scale")).alias("base_type"), "length", F.abs("scale").alias("scale"), F.col("nullable").alias("is_nullable"), "charset_name", "check_source", "default_source").orderBy("domain_name")


def computed_columns(bridge: Bridge, alias: str) -> DataFrame:
    d = _of(bridge, alias, "computed_columns")["sys_relation_fields"].filter("computed_source is not null")
    return d.select(F.lit("main").alias("table_schema"), F.col("relation").alias("table_name"), F.col("field").alias("column_name"), F.col("computed_source").alias("expression_source")).orderBy("table_name", "column_name")


def dependencies(bridge: Bridge, alias: str) -> DataFrame:
    d = _of(bridge, alias, "dependencies")["sys_dependencies"]
    labels = F.create_map(*[F.lit(x) for pair in OBJECT_TYPES.items() for x in pair])
    label = lambda c: F.coalesce(F.try_element_at(labels, F.col(c)), F.lit("UNKNOWN"))
    return d.select("object_name", label("type_code").alias("object_type"), F.col("type_code").alias("object_type_code"), "depends_on_name", label("depends_on_code").alias("depends_on_type"), F.col("depends_on_code").alias("depends_on_type_code"), "field_name").orderBy("object_name", "depends_on_name", "field_name")


def comments(bridge: Bridge, alias: str) -> DataFrame:
    d = _of(bridge, alias, "comments")
    own = d["sys_relations"].filter("description is not null").select(F.lit("main").alias("object_schema"), F.col("name").alias("object_name"), F.upper("kind").alias("object_type"), F.lit(None).cast("string").alias("column_name"), F.col("description").alias("comment"))
    columns = d["sys_relation_fields"].filter("description is not null").select(F.lit("main"), "relation", F.lit("COLUMN"), "field", "description")
    return own.union(columns).orderBy("object_schema", "object_name", "object_type")


def type_audit(bridge: Bridge, alias: str) -> DataFrame:
    d = _of(bridge, alias, "type_audit")["sys_relation_fields"]
    detail = F.create_map(*[F.lit(x) for pair in FINDING_DETAIL.items() for x in pair])
    found = d.withColumn("finding", audit_finding(F.col("code"), F.col("subtype"), F.col("scale"), F.col("charset_id"))).filter("finding is not null")
    return found.select(F.lit("main").alias("table_schema"), F.col("relation").alias("table_name"), F.col("field").alias("column_name"), type_text(F.col("code"), F.col("subtype"), F.col("scale")).alias("source_type"), F.col("data_type").alias("spark_type"), "finding", F.try_element_at(detail, F.col("finding")).alias("detail")).orderBy("table_name", "column_name")


def columns(bridge: Bridge, alias: str) -> DataFrame:
    """``information_schema.columns``; ordinal positions start at 1."""
    d = _of(bridge, alias, "columns")["sys_relation_fields"]
    return d.select(F.lit(alias).alias("table_catalog"), F.lit("main").alias("table_schema"), F.col("relation").alias("table_name"), F.col("field").alias("column_name"), (F.col("position") + 1).alias("ordinal_position"), F.col("data_type"), F.when(F.col("nullable"), "YES").otherwise("NO").alias("is_nullable")).orderBy("table_name", "ordinal_position")


def constraints(bridge: Bridge, alias: str) -> DataFrame:
    """``information_schema.key_column_usage``, with each constraint's type."""
    d = _of(bridge, alias, "constraints")
    return d["sys_relation_constraints"].join(d["sys_index_segments"], "index_name").select(F.col("relation").alias("table_name"), F.col("name").alias("constraint_name"), F.col("type").alias("constraint_type"), F.col("field").alias("column_name"), (F.col("position") + 1).alias("ordinal_position")).orderBy("table_name", "constraint_name", "ordinal_position")


def referential_constraints(bridge: Bridge, alias: str) -> DataFrame:
    d = _of(bridge, alias, "referential_constraints")
    return d["sys_ref_constraints"].select(F.col("name").alias("constraint_name"), F.col("target").alias("unique_constraint_name"), "update_rule", "delete_rule").orderBy("constraint_name")


def publish_information_schema(bridge: Bridge, alias: str) -> None:
    """Views ``<alias>_information_schema_<name>`` over the dictionary."""
    base = tables(bridge, alias).select(F.lit(alias).alias("table_catalog"), F.lit("main").alias("table_schema"), "table_name", F.lit("BASE TABLE").alias("table_type"))
    usage = constraints(bridge, alias)
    views = {"tables": base, "columns": columns(bridge, alias), "table_constraints": usage.select("table_name", "constraint_name", "constraint_type").distinct(), "key_column_usage": usage.drop("constraint_type"), "referential_constraints": referential_constraints(bridge, alias)}
    for name, df in views.items():
        df.createOrReplaceTempView(f"{alias}_information_schema_{name}")


def show_tables(bridge: Bridge, alias: str) -> DataFrame:
    """The names of an alias's relations, views among them, in order."""
    return tables(bridge, alias).select(F.col("table_name").alias("name")).orderBy("name")


def describe(bridge: Bridge, name: str) -> DataFrame:
    """column_name and column_type of a relation as a scan gives it."""
    fields = bridge.table(name).schema.fields
    return bridge.spark.createDataFrame([(f.name, f.dataType.simpleString()) for f in fields], "column_name string, column_type string")


def dbt_sources(bridge: Bridge, alias: str) -> DataFrame:
    """One row with the YAML of a dbt sources file; the text has a line for each column of the source."""
    source = bridge.alias(alias, "dbt_sources")
    lines = ["version: 2", "sources:", f"  - name: {quote_yaml(alias)}", '    schema: "main"', "    tables:"]
    for _, r in sorted(source.relations.items()):
        lines.append(f"      - name: {quote_yaml(r.name)}")
        if r.comment:
            lines.append(f"        description: {quote_yaml(r.comment)}")
        lines.append("        columns:")
        for c in source.schema(r).names:
            lines.append(f"          - name: {quote_yaml(c)}")
            if (c,) == r.primary_key:
                lines.append('            tests: ["not_null", "unique"]')
    return bridge.spark.createDataFrame([("\n".join(lines) + "\n",)], "yaml string")


def range_profile(df: DataFrame, column: str, parts: list[tuple]) -> DataFrame:
    """Rows and key sum of each key range, in one aggregation."""
    index = F.lit(len(parts) - 1)
    for i, (_, high) in reversed(list(enumerate(parts[:-1]))):
        index = F.when(F.col(column) <= high, i).otherwise(index)
    return df.groupBy(index.cast("int").alias("part")).agg(F.count("*").alias("n"), F.sum(column).cast("long").alias("key_sum"))


def latest(df: DataFrame, key: str, order: str) -> DataFrame:
    """The last row of each key, for incremental refreshes: an aggregation, so nothing is sorted. Ties go to the greatest other columns."""
    rest = [c for c in df.columns if c not in (key, order)]
    return df.groupBy(key).agg(F.max(F.struct(order, *rest)).alias("last")).select(key, "last.*").select(*df.columns)
