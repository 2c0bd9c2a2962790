"""The bridge: attached sources, read-only, as DataFrames and views."""

from __future__ import annotations

import threading
from functools import reduce

from py4j.java_gateway import is_instance_of
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..conninfo import BridgeError, ConnectionInfo, ScanOptions, parse_connection
from ..functions.text import sanitized
from ..functions.types import surfaced
from ..plans.partition import classify_key, pick_partition_count, predicate, ranges
from ..plans.pushdown import classified, mentioned
from ..plans.view_shape import analyse
from ..sources.backend import ParquetBackend
from ..sources.dictionary import SCHEMAS, Relation, discovered, frames
from .telemetry import Telemetry, Timer

#: Nodes of a parsed statement that are not part of a query.
_NOT_QUERIES = tuple(f"org.apache.spark.sql.catalyst.plans.logical.{n}" for n in ("Command", "ParsedStatement", "CompoundPlanStatement"))


class Attached:
    """One alias: a backend, its relations, and a dictionary. Each is loaded at first use."""

    def __init__(self, bridge: Bridge, alias: str, backend, relations: list[Relation], options: dict, **objects):
        self.bridge, self.alias, self.backend, self.objects = bridge, alias, backend, objects
        self.scan_options = options
        self.relations = {r.name.upper(): r for r in relations}
        self._lock, self._frames, self._schemas = threading.Lock(), None, {}

    def relation(self, name: str) -> Relation:
        parts = name.split(".")
        if len(parts) > 1 and parts[-2].lower() != "main":
            raise BridgeError(f"schema {parts[-2]!r} does not exist; the only schema is main")
        found = self.relations.get(parts[-1].strip('"`').upper())
        if found is None and parts[-1].lower() in SCHEMAS:
            return Relation(parts[-1].lower(), kind="system")
        if found is None:
            raise BridgeError(f"relation {parts[-1]!r} does not exist in {self.alias}")
        return found

    def raw(self, relation: Relation, bounds=None, partitions: int = 1) -> DataFrame:
        """The relation's rows as they are stored. A view's text sees the alias's relations by their names."""
        if relation.kind == "system":
            return self.dictionary[relation.name]
        if relation.kind == "view":
            used = [r for r in self.relations.values() if r is not relation and mentioned(r.name, relation.view_source)]
            self.publish(used)
            names = ", ".join(f"`{r.name}` AS (SELECT * FROM `{self.view_name(r.name)}`)" for r in used)
            return self.bridge.spark.sql(f"WITH {names} SELECT * FROM ({relation.view_source})" if names else relation.view_source)
        return self.backend.read(relation, bounds, partitions)

    def rows(self, relation: Relation, opts: ScanOptions, bounds=None, partitions: int = 1) -> DataFrame:
        """The relation's rows with the declared types: text decoded, numbers scaled, fixed width trimmed."""
        df = self.raw(relation, bounds, partitions)
        changed = {f.name: c for f in df.schema.fields if (c := surfaced(f, relation, opts)) is not None}
        return df.withColumns(changed) if changed else df

    def publish(self, relations) -> None:
        """Registers the views of some relations; a view's own relations come first."""
        for r in sorted(relations, key=lambda r: r.kind == "view"):
            self.rows(r, ScanOptions(**self.scan_options).validated()).createOrReplaceTempView(self.view_name(r.name))

    def view_name(self, name: str) -> str:
        return f"{self.alias}_main_{name}".lower()

    def schema(self, relation: Relation) -> T.StructType:
        if relation.name not in self._schemas:
            self._schemas[relation.name] = self.raw(relation).schema
        return self._schemas[relation.name]

    @property
    def dictionary(self) -> dict[str, DataFrame]:
        with self._lock:
            if self._frames is None:
                self._frames = frames(self.bridge.spark, list(self.relations.values()), self.schema, **self.objects)
            return self._frames

    def key(self, relation: Relation):
        kinds = {f.name: f.dataType.simpleString() for f in self.schema(relation).fields}
        return classify_key(list(relation.primary_key), [kinds[c] for c in relation.primary_key])

    def key_range(self, relation: Relation) -> tuple[int, int] | None:
        """The key's least and greatest value now; never kept, so new rows are never clipped."""
        key = self.key(relation)
        if not key.eligible:
            return None
        low, high = self.raw(relation).agg(F.min(key.column), F.max(key.column)).first()
        return None if low is None or low == high else (low, high)


class Bridge:
    """Attach sources, scan relations, and ask about both. ``query_log_size`` 0 keeps no log."""

    def __init__(self, spark: SparkSession, query_log_size: int = 0):
        self.spark = spark
        self.telemetry = Telemetry(query_log_size)
        self.attached: dict[str, Attached] = {}

    def attach(self, connection: str | ConnectionInfo, alias: str, relations: list[Relation] | None = None, backend=None, none_encoding: str = "win1252", generators=(), domains=(), dependencies=(), **options) -> Attached:
        """Registers an alias. Without ``relations`` the Parquet tables of the folder are found.

        No table is opened yet: a relation is read when it is first used, and ``sql`` registers
        the view ``<alias>_main_<relation>`` of those that a query names. Unknown options are ignored.
        """
        info = parse_connection(connection, **options) if isinstance(connection, str) else connection
        if alias in self.attached:
            raise BridgeError(f"alias {alias!r} is attached already")
        if relations is None:
            relations = discovered(self.spark, info.database)
        options = {"none_encoding": ScanOptions(none_encoding=none_encoding).validated().none_encoding}
        source = Attached(self, alias, backend or ParquetBackend(self.spark, info), relations, options, generators=generators, domains=domains, dependencies=dependencies)
        self.attached[alias] = source
        return source

    def detach(self, alias: str) -> None:
        source = self.alias(alias, "detach")
        for r in source.relations.values():
            self.spark.catalog.dropTempView(source.view_name(r.name))
        del self.attached[alias]

    def alias(self, alias: str, function: str) -> Attached:
        if alias not in self.attached:
            raise BridgeError(f"{function}: {alias!r} is not an attached source")
        return self.attached[alias]

    def sql(self, query: str) -> DataFrame:
        """A query over the views. Spark's parser decides what a query is: anything else is refused."""
        self._refuse_commands(query)
        for source in self.attached.values():
            source.publish(r for r in source.relations.values() if mentioned(source.view_name(r.name), query))
        return self.spark.sql(query)

    def _refuse_commands(self, query: str) -> None:
        gateway = self.spark.sparkContext._gateway
        nodes = [self.spark._jsparkSession.sessionState().sqlParser().parsePlan(query)]
        while nodes:
            node = nodes.pop()
            if any(is_instance_of(gateway, node, kind) for kind in _NOT_QUERIES):
                raise BridgeError("attached sources are read-only: only queries are allowed")
            children = node.children()
            nodes += [children.apply(i) for i in range(children.size())]

    def table(self, name: str) -> DataFrame:
        """``alias.main.relation`` or ``alias.relation``, without case."""
        alias, _, rest = name.partition(".")
        return self.scan(alias, rest)

    def scan(self, alias: str, table: str, columns: list[str] | None = None, where: Column | str | None = None, **options) -> DataFrame:
        """A relation's rows: filter, then order, then offset and limit.

        ``where`` is applied before a page is cut; a later ``filter`` applies to the page. A page
        is ordered by the primary key, or by all orderable columns where there is none, so it
        is the same each time. Text columns of no declared charset are decoded above the scan,
        so a filter on them compares decoded text and is not pushed. ``partitions`` of 2 or more
        reads that many ranges of a single integer key; a relation without such a key is refused.
        """
        source = self.alias(alias, "scan")
        relation = source.relation(table)
        opts = ScanOptions(**(source.scan_options | options)).validated()
        record = {"catalog": alias, "table_name": relation.name, "limit": opts.row_limit, "offset": opts.row_offset}
        with Timer() as timer:
            try:
                df, n = self._ranged(source, relation, opts)
                if where is not None:
                    df = df.filter(where)
                if opts.row_limit is not None:
                    df = page(df, page_order(df.schema, relation), opts.row_limit, opts.row_offset or 0)
                if columns:
                    df = df.select(*[F.col(f"`{c}`") for c in columns])
            except Exception as e:
                self.telemetry.record(**record, error=sanitized(str(e).split("\n")[0]))
                raise
        self.telemetry.record(**record, projected_columns=",".join(df.columns), partitions=n, bridge_time_us=timer.us, filters=lambda: classified(df, relation.none_charset))
        return df

    def _ranged(self, source: Attached, relation: Relation, opts: ScanOptions) -> tuple[DataFrame, int]:
        """The rows, and the number of key ranges they are read in. Files are split by Spark, so only a request makes ranges of them."""
        files = isinstance(source.backend, ParquetBackend)
        if opts.partitions == 1 or relation.kind != "table" or opts.row_limit is not None or files and not opts.partitions:
            return source.rows(relation, opts), 1
        key, bounds = source.key(relation), source.key_range(relation)
        if opts.partitions > 1 and not key.eligible:
            raise BridgeError(f"partitions needs a single integer key: {relation.name} has {key.reason}")
        if not bounds:
            return source.rows(relation, opts), 1
        n = opts.partitions or pick_partition_count(*bounds, self.spark.sparkContext.defaultParallelism)
        if not files:
            return source.rows(relation, opts, (key.column, *bounds), n), n
        parts = [source.rows(relation, opts).filter(predicate(f"`{key.column}`", *r)) for r in ranges(*bounds, n)]
        return reduce(DataFrame.unionByName, parts), len(parts)

    def last_query(self) -> DataFrame:
        return self.telemetry.frame(self.spark, [self.telemetry.last] if self.telemetry.last else [])

    def query_log(self) -> DataFrame:
        return self.telemetry.frame(self.spark, self.telemetry.log)

    def view_shape(self, relation: Relation):
        return analyse(self.spark, relation.view_source)


#: The last row of a page up to which each task may hold all rows before it.
HELD_ROWS = 100_000


def page(df: DataFrame, order: list[str], limit: int, offset: int) -> DataFrame:
    """Rows offset + 1 to offset + limit in an order, nulls first.

    For a near page every task keeps the rows up to its end in a heap, which Spark makes at full
    size. A far page is cut from a sort, which spills: what is observed between them keeps the
    planner from the heap.
    """
    rows = df.orderBy(*[F.col(f"`{c}`").asc_nulls_first() for c in order])
    if limit + offset > HELD_ROWS:
        rows = rows.observe("page", F.count(F.lit(1)).alias("rows"))
    return rows.offset(offset).limit(limit)


def page_order(schema: T.StructType, relation: Relation) -> list[str]:
    """The columns that order a page: the key, or all that can be ordered."""
    if relation.primary_key:
        return list(relation.primary_key)
    return [f.name for f in schema.fields if not isinstance(f.dataType, (T.MapType, T.ArrayType, T.StructType, T.VariantType))]


