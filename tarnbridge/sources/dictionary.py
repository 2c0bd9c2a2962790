"""The dictionary of a source: what it declares about relations, columns, keys and other objects.

A declaration is a plain dict (see ``catalog_tables``) next to the data's own schema;
``frames`` turns it into DataFrames, one for each system table. Their size follows the
number of columns in the source, not its rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..functions.types import BIGINT, CHAR, DECFLOAT34, INT128, SMALLINT, code_of


@dataclass
class Relation:
    name: str
    path: str = ""
    kind: str = "table"
    primary_key: tuple[str, ...] = ()
    foreign_keys: tuple[tuple, ...] = ()  # (name, columns, table, columns, update rule, delete rule)
    indexes: tuple[tuple, ...] = ()  # (name, columns, unique, active, expression)
    view_source: str | None = None
    comment: str | None = None
    column_comments: dict[str, str] = field(default_factory=dict)
    none_charset: tuple[str, ...] = ()
    computed: dict[str, str] = field(default_factory=dict)
    codes: dict[str, tuple] = field(default_factory=dict)  # column: (code, subtype, scale)


SCHEMAS = {
    "sys_relations": "name string, kind string, view_source string, description string",
    "sys_relation_fields": "relation string, field string, position int, nullable boolean, data_type string, code int, subtype int, scale int, charset_id int, computed_source string, description string",
    "sys_indices": "name string, relation string, is_unique boolean, is_active boolean, expression_source string, selectivity double, is_primary_key boolean, is_foreign_key boolean",
    "sys_index_segments": "index_name string, field string, position int",
    "sys_relation_constraints": "name string, relation string, type string, index_name string",
    "sys_ref_constraints": "name string, target string, update_rule string, delete_rule string",
    "sys_generators": "name string, initial_value long, current_value long",
    "sys_domains": "name string, code int, subtype int, scale int, length int, nullable boolean, charset_name string, check_source string, default_source string",
    "sys_dependencies": "object_name string, type_code int, depends_on_name string, depends_on_code int, field_name string",
}


def frames(spark: SparkSession, relations: list[Relation], schema_of, generators=(), domains=(), dependencies=()) -> dict[str, DataFrame]:
    """The system tables. schema_of: the StructType of a relation."""
    rows: dict[str, list] = {n: [] for n in SCHEMAS}
    for r in relations:
        rows["sys_relations"].append((r.name, r.kind, r.view_source, r.comment))
        for i, f in enumerate(schema_of(r).fields):
            scale = -f.dataType.scale if isinstance(f.dataType, T.DecimalType) else 0
            code, subtype, scale = r.codes.get(f.name, (code_of(f.dataType), 0, scale))
            rows["sys_relation_fields"].append((r.name, f.name, i, f.nullable and f.name not in r.primary_key, f.dataType.simpleString(), code, subtype, scale, 0 if f.name in r.none_charset else -1, r.computed.get(f.name), r.column_comments.get(f.name)))
        indexes = [(f"PK_{r.name}", r.primary_key, True, True, None, True, False)] if r.primary_key else []
        indexes += [(n, cols, False, True, None, False, True) for n, cols, *_ in r.foreign_keys]
        indexes += [(*x[:5], False, False) for x in r.indexes]
        for name, cols, unique, active, expression, pk, fk in indexes:
            rows["sys_indices"].append((name, r.name, unique, active, expression, None, pk, fk))
            rows["sys_index_segments"] += [(name, c, i) for i, c in enumerate(cols)]
        if r.primary_key:
            rows["sys_relation_constraints"].append((f"PK_{r.name}", r.name, "PRIMARY KEY", f"PK_{r.name}"))
        for name, _, target, _, update, delete in r.foreign_keys:
            rows["sys_relation_constraints"].append((name, r.name, "FOREIGN KEY", name))
            rows["sys_ref_constraints"].append((name, f"PK_{target}", update, delete))
    rows["sys_generators"] += list(generators)
    rows["sys_domains"] += list(domains)
    rows["sys_dependencies"] += list(dependencies)
    return {n: spark.createDataFrame(rows[n], SCHEMAS[n]) for n in SCHEMAS}


def discovered(spark: SparkSession, folder: str) -> list[Relation]:
    """A relation for each ``*.parquet`` of a folder, on any file system that Spark reads."""
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    found = place.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(place)
    names = sorted(x.getPath().getName() for x in found)
    return [Relation(n.removesuffix(".parquet"), f"{folder.rstrip('/')}/{n}") for n in names if n.endswith(".parquet")]


def tpch(folder: str) -> list[Relation]:
    """The declared metadata of the sample tables; the files' own schemas give the columns."""
    key = {"region": "r_regionkey", "nation": "n_nationkey", "customer": "c_custkey", "supplier": "s_suppkey", "part": "p_partkey", "orders": "o_orderkey", "documents": "doc_id", "labels": "doc_id", "pages": "page_id", "benchmark": "item_id", "embeddings": "vec_id", "events": "event_id"}
    refs = {"customer": (("FK_CUSTOMER_NATION", ("c_nationkey",), "nation", ("n_nationkey",), "NO ACTION", "NO ACTION"),), "orders": (("FK_ORDERS_CUSTOMER", ("o_custkey",), "customer", ("c_custkey",), "CASCADE", "SET NULL"),), "lineitem": (("FK_LINEITEM_ORDERS", ("l_orderkey",), "orders", ("o_orderkey",), "NO ACTION", "CASCADE"),)}
    names = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]
    out = [Relation(n, f"{folder}/{n}.parquet", primary_key=(("conv_id", "turn") if n == "conversations" else (key[n],) if n in key else ()), foreign_keys=refs.get(n, ()), comment="Customers" if n == "customer" else None) for n in names]
    out.append(Relation("v_open_orders", kind="view", view_source="SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'O'"))
    out.append(Relation("v_customer_totals", kind="view", view_source="SELECT c.c_custkey, count(*) AS n FROM customer c JOIN orders o ON o.o_custkey = c.c_custkey GROUP BY c.c_custkey"))
    # The same files under declared types: scaled and 128-bit integers, decimal floats, fixed width, no charset.
    out.append(Relation("typed_orders", f"{folder}/orders.parquet", primary_key=("o_orderkey",), codes={"o_totalprice": (BIGINT, 1, -2), "o_orderstatus": (CHAR, 0, 0), "o_custkey": (INT128, 0, 0)}))
    out.append(Relation("typed_lineitem", f"{folder}/lineitem.parquet", codes={"l_partkey": (BIGINT, 1, -2), "l_suppkey": (DECFLOAT34, 0, 0), "l_linenumber": (SMALLINT, 0, 0)}))
    return out
