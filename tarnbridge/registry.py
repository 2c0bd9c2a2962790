"""The registered queries over the sample tables, each with SQL for the same result where SQL has one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .functions.charset import decoded
from .functions.text import char_text, decfloat_text, like
from .operators import audits, joins, metadata
from .operators.bridge import Bridge
from .operators.diagnostics import indexes_of
from .plans.partition import ranges
from .sources import sinks
from .sources.dictionary import tpch

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_ORACLES: dict[str, str] = {}


_BRIDGES: dict[tuple, Bridge] = {}


def attached(spark: SparkSession, folder: str) -> Bridge:
    """The bridge to a folder's tables: one for each session and folder, so schemas are read once."""
    key = (spark.sparkContext.applicationId, id(spark), folder)
    if key not in _BRIDGES:
        bridge = Bridge(spark, query_log_size=20)
        bridge.attach(folder, "src", tpch(folder))
        _BRIDGES[key] = bridge
    return _BRIDGES[key]


def query(oracle: str | None = None):
    """Registers a function of (bridge, folder) under its name."""

    def add(f):
        _QUERIES[f.__name__] = lambda spark, folder: f(attached(spark, folder), folder)
        if oracle:
            _ORACLES[f.__name__] = oracle
        return f

    return add


def _simple(name: str, table: str, columns: list[str], where, sql: str) -> None:
    _QUERIES[name] = lambda spark, folder: attached(spark, folder).scan("src", table, columns, where() if callable(where) else where)
    _ORACLES[name] = f"SELECT {', '.join(columns)} FROM {table}" + (f" WHERE {sql}" if sql else "")


def flagship(spark: SparkSession, folder: str) -> DataFrame:
    return attached(spark, folder).scan("src", "customer", ["c_custkey", "c_mktsegment"]).groupBy("c_mktsegment").agg(F.count("*").alias("n"))


_O = ["o_orderkey", "o_custkey", "o_totalprice"]
_simple("scan_project", "orders", _O, None, "")
_simple("f_eq_text", "orders", _O, "o_orderstatus = 'O'", "o_orderstatus = 'O'")
_simple("f_eq_int", "orders", _O, "o_custkey = 7", "o_custkey = 7")
_simple("f_range_double", "orders", _O, "o_totalprice >= 1000 AND o_totalprice < 50000", "o_totalprice >= 1000 AND o_totalprice < 50000")
_simple("f_and_or", "orders", _O, "o_custkey < 50 AND (o_orderstatus = 'F' OR o_orderstatus = 'O')", "o_custkey < 50 AND o_orderstatus IN ('F', 'O')")
_simple("f_date_ge", "orders", _O, "o_orderdate >= timestamp_ntz'1996-01-01 00:00:00'", "o_orderdate >= TIMESTAMP '1996-01-01'")
_simple("f_in", "orders", _O, lambda: F.col("o_custkey").isin(1, 2, 3), "o_custkey IN (1, 2, 3)")
_simple("f_in_empty", "orders", _O, lambda: F.col("o_custkey").isin([]), "false")
_simple("f_not_in", "orders", _O, lambda: ~F.col("o_custkey").isin(1, 2, 3), "o_custkey NOT IN (1, 2, 3)")
_simple("f_not_bool", "orders", _O, lambda: ~(F.col("o_orderstatus") == "O"), "NOT (o_orderstatus = 'O')")
_simple("f_bool", "orders", _O, lambda: F.col("o_orderstatus") == "O", "o_orderstatus = 'O'")
_simple("f_between", "orders", _O, lambda: F.col("o_orderkey").between(10, 500), "o_orderkey BETWEEN 10 AND 500")
_simple("f_is_null", "orders", _O, "o_custkey IS NULL OR o_custkey < 20", "o_custkey IS NULL OR o_custkey < 20")
_simple("f_like_prefix", "documents", ["doc_id", "lang"], lambda: like(F.col("text"), "The%"), "text LIKE 'The%'")
_simple("f_like_inner", "documents", ["doc_id", "lang"], lambda: like(F.col("text"), "T%e_r%"), "text LIKE 'T%e_r%'")
_simple("f_cast_residual", "orders", _O, "CAST(o_custkey AS string) = '3'", "CAST(o_custkey AS VARCHAR) = '3'")
_simple("f_mod_residual", "orders", _O, "o_orderkey % 2 = 0", "o_orderkey % 2 = 0")


@query("SELECT count(*) AS n FROM lineitem")
def scan_count_star(b, _):
    return b.scan("src", "lineitem").agg(F.count("*").alias("n"))


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'O'")
def scan_view_active(b, _):
    return b.scan("src", "v_open_orders")


@query("SELECT c.c_custkey, count(*) AS n FROM customer c JOIN orders o ON o.o_custkey = c.c_custkey GROUP BY c.c_custkey")
def scan_view_heavy(b, _):
    return b.scan("src", "v_customer_totals")


@query("SELECT doc_id, text FROM documents")
def cs_documents_roundtrip(b, _):
    return b.scan("src", "documents").select("doc_id", decoded(F.encode("text", "UTF-8"), "strict", "text").alias("text"))


@query("SELECT lang, count(*) AS n, sum(octet_length(encode(text)))::BIGINT AS n_chars FROM documents GROUP BY lang")
def cs_win1252_lengths(b, _):
    raw = decoded(F.encode("text", "UTF-8"), "win1252", "text")
    return b.scan("src", "documents").groupBy("lang").agg(F.count("*").alias("n"), F.sum(F.length(raw)).alias("n_chars"))


@query("SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS price FROM orders")
def t_decimal_width(b, _):
    return b.scan("src", "orders").select("o_orderkey", F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("price"))


@query("SELECT o_orderkey FROM orders WHERE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) LIKE '1%'")
def t_decfloat_text(b, _):
    return b.scan("src", "orders", where=decfloat_text(F.col("o_totalprice").cast("decimal(18,2)")).startswith("1")).select("o_orderkey")


@query("SELECT c_custkey, rtrim(c_mktsegment || '   ') AS segment FROM customer")
def t_char_rtrim(b, _):
    return b.scan("src", "customer").select("c_custkey", char_text(F.concat("c_mktsegment", F.lit("   "))).alias("segment"))


@query("SELECT o_orderkey, CAST(o_orderkey::HUGEINT * 100000000000000000000::HUGEINT AS VARCHAR) AS big FROM orders")
def t_int128_text(b, _):
    return b.scan("src", "orders").select("o_orderkey", (F.col("o_orderkey").cast("decimal(18,0)") * F.lit("100000000000000000000").cast("decimal(21,0)")).cast("decimal(38,0)").cast("string").alias("big"))


def _ranges_sql(table: str, key: str, n: int) -> str:
    bounds = f"(SELECT min({key}) AS lo, max({key}) AS hi FROM {table})"
    return f"SELECT least(CASE " + " ".join(f"WHEN {key} < lo + (hi - lo + 1) * {i + 1} // {n} THEN {i}" for i in range(n)) + f" ELSE {n - 1} END, {n - 1})::INTEGER AS part, count(*) AS n, sum({key})::BIGINT AS key_sum FROM {table}, {bounds} GROUP BY 1"


@query(_ranges_sql("orders", "o_orderkey", 4))
def p_ranges_orders_4(b, _):
    source = b.attached["src"]
    return metadata.range_profile(b.scan("src", "orders"), "o_orderkey", ranges(*source.key_range(source.relation("orders")), 4))


@query(_ranges_sql("labels", "doc_id", 4))
def p_sparse_labels_4(b, _):
    source = b.attached["src"]
    return metadata.range_profile(b.scan("src", "labels"), "doc_id", ranges(*source.key_range(source.relation("labels")), 4))


@query("SELECT count(*) AS n, sum(o_orderkey)::BIGINT AS key_sum FROM orders")
def p_invariance(b, _):
    """Sums over a scan in four key ranges."""
    return b.scan("src", "orders", ["o_orderkey"], partitions=4).agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("key_sum"))


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'F'")
def p_range_scan(b, _):
    return b.scan("src", "orders", ["o_orderkey", "o_custkey"], "o_orderstatus = 'F'", partitions=7)


@query("SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT 50")
def pg_pk_limit(b, _):
    return b.scan("src", "orders", ["o_orderkey", "o_custkey"], row_limit=50)


@query("SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT 20 OFFSET 100")
def pg_pk_offset(b, _):
    return b.scan("src", "orders", ["o_orderkey", "o_custkey"], row_limit=20, row_offset=100)


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'F' ORDER BY o_orderkey LIMIT 10 OFFSET 5")
def pg_filter_then_slice(b, _):
    return b.scan("src", "orders", ["o_orderkey", "o_custkey"], where="o_orderstatus = 'F'", row_limit=10, row_offset=5)


@query("SELECT l_orderkey, l_linenumber FROM (SELECT * FROM lineitem ORDER BY ALL NULLS FIRST LIMIT 30 OFFSET 10)")
def pg_no_pk_total_order(b, _):
    return b.scan("src", "lineitem", ["l_orderkey", "l_linenumber"], row_limit=30, row_offset=10)


@query("SELECT o_orderkey FROM orders LIMIT 0")
def pg_past_end(b, _):
    return b.scan("src", "orders", ["o_orderkey"], row_limit=5, row_offset=1_000_000_000)


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'O' ORDER BY ALL LIMIT 25 OFFSET 10")
def pg_simple_view(b, _):
    return b.scan("src", "v_open_orders", row_limit=25, row_offset=10)


@query("SELECT o_custkey AS c_custkey, count(*) AS n FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer) GROUP BY o_custkey ORDER BY ALL LIMIT 25 OFFSET 10")
def pg_heavy_view(b, _):
    return b.scan("src", "v_customer_totals", row_limit=25, row_offset=10)


@query("SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS price, o_orderstatus, CAST(o_custkey AS VARCHAR) AS o_custkey FROM orders")
def t_declared_types(b, _):
    """A scaled integer, a fixed width and a 128-bit integer as the dictionary declares them."""
    return b.scan("src", "typed_orders").select("o_orderkey", F.col("o_totalprice").cast("string").alias("price"), "o_orderstatus", "o_custkey")


@query("SELECT o_orderkey, CAST(o_custkey AS DOUBLE) AS custkey FROM orders WHERE o_custkey > 100")
def t_int128_decimal(b, _):
    return b.scan("src", "typed_orders", where="o_custkey > 100", int128="decimal38").select("o_orderkey", F.col("o_custkey").cast("double").alias("custkey"))


@query("SELECT l_orderkey, l_linenumber::SMALLINT AS l_linenumber, CAST(CAST(l_partkey AS DECIMAL(18,2)) / 100 AS DECIMAL(18,2))::VARCHAR AS part FROM lineitem WHERE CAST(l_suppkey AS VARCHAR) LIKE '1%'")
def t_scaled_integer(b, _):
    """Unscaled integers get their decimal point; a decimal float is filtered as text."""
    return b.scan("src", "typed_lineitem", where="l_suppkey LIKE '1%'").select("l_orderkey", "l_linenumber", F.col("l_partkey").cast("string").alias("part"))


# What the data say about the dictionary. Questions whose answer does not follow the tables (domains, generators, DDL and YAML
# text, health, plans, the query log) are tested, not registered.
_COLUMNS = {
    "benchmark": "item_id text", "conversations": "conv_id turn role text", "customer": "c_custkey c_name c_nationkey c_acctbal c_mktsegment", "documents": "doc_id text lang source n_chars", "embeddings": "vec_id embedding label",
    "events": "event_id ts user_id event_type value props", "labels": "doc_id quality toxic", "lineitem": "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax l_returnflag l_linestatus l_shipdate",
    "nation": "n_nationkey n_name n_regionkey", "orders": "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority", "pages": "page_id url html", "part": "p_partkey p_name p_brand p_type p_size p_retailprice",
    "region": "r_regionkey r_name", "supplier": "s_suppkey s_name s_nationkey s_acctbal",
}
_TEXT = {"benchmark": "text", "conversations": "role text", "customer": "c_name c_mktsegment", "documents": "text lang source", "events": "event_type props", "lineitem": "l_returnflag l_linestatus", "nation": "n_name", "orders": "o_orderstatus o_orderpriority", "pages": "url html", "part": "p_name p_brand p_type", "region": "r_name", "supplier": "s_name"}
_DECLARED = [r for r in tpch("") if r.kind == "table" and not r.codes]


def _union(parts) -> str:
    return " UNION ALL ".join(parts)


def _key_sql(table: str, keys: tuple[str, ...]) -> str:
    missing = " OR ".join(f"{k} IS NULL" for k in keys)
    return f"SELECT '{table}' AS table_name, 'PK_{table}' AS constraint_name, (SELECT count(*) FROM {table}) AS n_rows, (SELECT count(*) FROM (SELECT DISTINCT {', '.join(keys)} FROM {table} WHERE NOT ({missing}))) AS n_keys, (SELECT count(*) FROM {table} WHERE {missing}) AS n_null_keys"


def _audit(name: str, f, sql: str) -> None:
    _QUERIES[name] = lambda spark, folder: f(attached(spark, folder))
    _ORACLES[name] = sql


def _plain(f):
    """Only the relations of the folder's own files: declared types are another reading of the same."""
    return lambda b: f(b, "src").filter(~F.col("table_name").startswith("typed_"))


_audit("m_tables", _plain(audits.row_counts), _union(f"SELECT '{r.name}' AS table_name, {len(_COLUMNS[r.name].split())} AS column_count, {str(bool(r.primary_key)).lower()} AS has_pk, count(*) AS n_rows FROM {r.name}" for r in _DECLARED))
_audit("m_columns", _plain(audits.null_counts), _union(f"SELECT '{t}' AS table_name, '{c}' AS column_name, {i} AS ordinal_position, count(*) FILTER ({c} IS NULL) AS n_nulls FROM {t}" for t, cs in _COLUMNS.items() for i, c in enumerate(cs.split(), 1)))
_audit("m_type_audit", _plain(audits.text_widths), _union(f"SELECT '{t}' AS table_name, '{c}' AS column_name, {i} AS ordinal_position, max(length({c})) AS max_chars, count(*) FILTER ({c} LIKE '% ') AS n_padded FROM {t}" for t, cs in _TEXT.items() for i, c in enumerate(cs.split(), 1)))
_audit("m_constraints", _plain(audits.key_checks), _union(_key_sql(r.name, r.primary_key) for r in _DECLARED if r.primary_key))
_audit("m_foreign_keys", lambda b: audits.reference_checks(b, "src"), _union(f"SELECT '{n}' AS fk_constraint, '{r.name}' AS fk_table, '{t}' AS pk_table, count(*) AS n_rows, count(*) FILTER ({own[0]} NOT IN (SELECT {other[0]} FROM {t} WHERE {other[0]} IS NOT NULL)) AS n_orphans FROM {r.name}" for r in _DECLARED for n, own, t, other, *_ in r.foreign_keys))
_INDEXES = [(r.name, n, c) for r in _DECLARED for n, c, *_ in indexes_of(r)]
_audit("m_indexes", _plain(audits.index_selectivity), _union(f"SELECT '{t}' AS table_name, '{n}' AS index_name, count(*) AS n_distinct, 1.0::DOUBLE / count(*) AS selectivity FROM (SELECT DISTINCT {', '.join(c)} FROM {t})" for t, n, c in _INDEXES))
_audit("d_index_profile", lambda b: audits.index_selectivity(b, "src").filter("table_name = 'orders'"), _union(f"SELECT '{t}' AS table_name, '{n}' AS index_name, count(*) AS n_distinct, 1.0::DOUBLE / count(*) AS selectivity FROM (SELECT DISTINCT {', '.join(c)} FROM {t})" for t, n, c in _INDEXES if t == "orders"))


def _profile_sql(table: str, key: str | None, rows: str | None = None) -> str:
    if not key:
        return f"SELECT '{table}' AS table_name, NULL::VARCHAR AS key_column, count(*) AS n_rows, NULL::BIGINT AS key_low, NULL::BIGINT AS key_high, NULL::BIGINT AS key_span FROM {rows or table}"
    return f"SELECT '{table}' AS table_name, '{key}' AS key_column, count(*) AS n_rows, min({key})::BIGINT AS key_low, max({key})::BIGINT AS key_high, (max({key}) - min({key}) + 1)::BIGINT AS key_span FROM {table}"


for _name, _key, _rows in (("customer", "c_custkey", None), ("orders", "o_orderkey", None), ("lineitem", None, None), ("conversations", None, None), ("v_customer_totals", None, "(SELECT DISTINCT o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer))")):
    _audit(f"d_profile_{_name}", lambda b, t=_name: audits.scan_profile(b, f"src.main.{t}").drop("recommended_partitions"), _profile_sql(_name, _key, _rows))


def _sql(name: str, spark_sql: str, oracle: str | None = None) -> None:
    """A query in SQL over the alias's views; ``{t}`` stands for a table's prefix."""
    _QUERIES[name] = lambda spark, folder: attached(spark, folder).sql(spark_sql.replace("{t}", "src_main_"))
    _ORACLES[name] = (oracle or spark_sql).replace("{t}", "")


_sql("j_inner", "SELECT o.o_orderkey, c.c_mktsegment FROM {t}orders o JOIN {t}customer c ON o.o_custkey = c.c_custkey")
_sql("j_left_multi", "SELECT p.conv_id, p.turn, n.role AS next_role FROM {t}conversations p LEFT JOIN {t}conversations n ON n.conv_id = p.conv_id AND n.turn = p.turn + 1")
_sql("j_self", "SELECT a.o_orderkey AS first_key, b.o_orderkey AS second_key FROM {t}orders a JOIN {t}orders b ON a.o_custkey = b.o_custkey AND a.o_orderkey + 1 = b.o_orderkey")
_sql("j_right_full", "SELECT d.doc_id AS doc_id, l.quality AS quality FROM {t}labels l FULL JOIN {t}documents d ON l.doc_id = d.doc_id")
_sql("j_semi", "SELECT c_custkey FROM {t}customer c WHERE EXISTS (SELECT 1 FROM {t}orders o WHERE o.o_custkey = c.c_custkey)")
_sql("j_anti", "SELECT c_custkey FROM {t}customer c WHERE NOT EXISTS (SELECT 1 FROM {t}orders o WHERE o.o_custkey = c.c_custkey)")
_sql("a_group", "SELECT o_orderstatus, count(*) AS n, cast(round(sum(cast(o_totalprice AS decimal(18,2))), 2) AS double) AS total FROM {t}orders GROUP BY o_orderstatus")
_sql("a_min_max", "SELECT min(o_orderkey) AS lo, max(o_orderkey) AS hi FROM {t}orders")
_sql("a_bool", "SELECT o_custkey, bool_and(o_totalprice > 1000) AS every_big, bool_or(o_totalprice > 100000) AS any_big FROM {t}orders GROUP BY o_custkey")
_sql("a_distinct", "SELECT DISTINCT o_orderstatus, o_custkey FROM {t}orders")
_sql("a_list", "SELECT o_custkey, array_join(sort_array(collect_list(o_orderstatus)), ',') AS statuses FROM {t}orders GROUP BY o_custkey", "SELECT o_custkey, string_agg(o_orderstatus, ',' ORDER BY o_orderstatus) AS statuses FROM orders GROUP BY o_custkey")
_sql("a_month_rollup", "SELECT year(o_orderdate) AS y, month(o_orderdate) AS m, count(*) AS n FROM {t}orders GROUP BY year(o_orderdate), month(o_orderdate)", "SELECT year(o_orderdate)::INTEGER AS y, month(o_orderdate)::INTEGER AS m, count(*) AS n FROM orders GROUP BY 1, 2")
_sql("a_having_distinct", "SELECT o_custkey, count(DISTINCT o_orderstatus) AS n FROM {t}orders GROUP BY o_custkey HAVING count(DISTINCT o_orderstatus) > 1")
_sql("w_row_number", "SELECT o_orderkey, cast(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS bigint) AS rn FROM {t}orders")
_sql("w_lag_sum", "SELECT o_orderkey, lag(o_orderkey) OVER w AS prev, cast(sum(o_orderkey) OVER w AS bigint) AS running FROM {t}orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey)")
_sql("s_union_all", "SELECT c_custkey AS k FROM {t}customer UNION ALL SELECT o_custkey AS k FROM {t}orders")
_sql("s_intersect", "SELECT c_custkey AS k FROM {t}customer INTERSECT SELECT o_custkey AS k FROM {t}orders")
_sql("s_except", "SELECT c_custkey AS k FROM {t}customer EXCEPT SELECT o_custkey AS k FROM {t}orders")
_sql("q_cte", "WITH big AS (SELECT o_custkey, count(*) AS n FROM {t}orders GROUP BY o_custkey) SELECT c.c_mktsegment, count(*) AS n FROM big JOIN {t}customer c ON c.c_custkey = big.o_custkey WHERE big.n > 2 GROUP BY c.c_mktsegment")
_sql("q_scalar_subquery", "SELECT o_orderkey FROM {t}orders WHERE o_totalprice > (SELECT max(o_totalprice) * 0.9 FROM {t}orders)")
_sql("q_case_alias", "SELECT o_orderkey, CASE WHEN o_totalprice > 100000 THEN 'big' ELSE 'small' END AS size_class FROM {t}orders")


_sql("j_right", "SELECT o.o_orderkey, c.c_custkey FROM {t}orders o RIGHT JOIN {t}customer c ON o.o_custkey = c.c_custkey AND o.o_totalprice > 200000")
_sql("j_anti_status", "SELECT c_custkey FROM {t}customer c WHERE NOT EXISTS (SELECT 1 FROM {t}orders o WHERE o.o_custkey = c.c_custkey AND o.o_totalprice > 200000)")
_sql("j_semi_status", "SELECT c_custkey FROM {t}customer c WHERE EXISTS (SELECT 1 FROM {t}orders o WHERE o.o_custkey = c.c_custkey AND o.o_totalprice > 200000)")
_sql("j_int128_key", "SELECT o.o_orderkey, c.c_mktsegment FROM {t}typed_orders o JOIN {t}customer c ON o.o_custkey = CAST(c.c_custkey AS STRING)", "SELECT o.o_orderkey, c.c_mktsegment FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey")
_sql("j_null_safe", "SELECT a.doc_id, l.quality FROM {t}documents a JOIN {t}labels l ON a.doc_id <=> l.doc_id", "SELECT a.doc_id, l.quality FROM documents a JOIN labels l ON a.doc_id IS NOT DISTINCT FROM l.doc_id")
_sql("a_avg", "SELECT o_orderstatus, avg(o_custkey) AS mean_key, count(*) AS n, sum(o_custkey) AS total FROM {t}orders GROUP BY o_orderstatus", "SELECT o_orderstatus, avg(o_custkey) AS mean_key, count(*) AS n, sum(o_custkey)::BIGINT AS total FROM orders GROUP BY o_orderstatus")
_sql("a_group_ordinal", "SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM {t}orders GROUP BY 1, 2")
_sql("a_rollup", "SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM {t}orders GROUP BY ROLLUP (o_orderstatus, o_orderpriority)")
_sql("a_cube", "SELECT o_orderstatus, o_orderpriority, cast(grouping(o_orderstatus) AS int) AS all_statuses, count(*) AS n FROM {t}orders GROUP BY CUBE (o_orderstatus, o_orderpriority)")
_sql("a_grouping_sets", "SELECT l_returnflag, l_linestatus, count(*) AS n FROM {t}lineitem GROUP BY GROUPING SETS ((l_returnflag), (l_linestatus), ())")
_sql("a_percentile", "SELECT o_orderstatus, percentile_disc(0.5) WITHIN GROUP (ORDER BY o_totalprice) AS middle, percentile_disc(0.9) WITHIN GROUP (ORDER BY o_totalprice) AS high FROM {t}orders GROUP BY o_orderstatus")
_sql("a_filter", "SELECT o_custkey, count(*) FILTER (WHERE o_totalprice > 100000) AS big, count(*) AS n FROM {t}orders GROUP BY o_custkey")
_sql("w_ranks", "SELECT l_orderkey, l_linenumber, l_partkey, cast(rank() OVER w AS int) AS r, cast(dense_rank() OVER w AS int) AS d FROM {t}lineitem WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_quantity)", "SELECT l_orderkey, l_linenumber, l_partkey, (rank() OVER w)::INTEGER AS r, (dense_rank() OVER w)::INTEGER AS d FROM lineitem WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_quantity)")
_sql("w_lead_ntile", "SELECT o_orderkey, lead(o_orderkey, 2) OVER w AS later, cast(ntile(3) OVER w AS int) AS third, first_value(o_orderkey) OVER w AS earliest FROM {t}orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey)")
_sql("w_rows_frame", "SELECT o_orderkey, sum(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS near_sum FROM {t}orders", "SELECT o_orderkey, (sum(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING))::BIGINT AS near_sum FROM orders")
_sql("w_range_frame", "SELECT o_orderkey, count(*) OVER (PARTITION BY o_custkey ORDER BY o_orderkey RANGE BETWEEN 100 PRECEDING AND CURRENT ROW) AS recent FROM {t}orders")
_sql("l_limit", "SELECT l_orderkey, l_partkey, l_suppkey FROM {t}lineitem ORDER BY l_orderkey, l_partkey, l_suppkey LIMIT 10")
_sql("l_order_nulls", "SELECT doc_id, lang FROM {t}documents ORDER BY lang NULLS LAST, doc_id DESC LIMIT 40")
_sql("s_except_status", "SELECT c_custkey AS k FROM {t}customer EXCEPT SELECT o_custkey AS k FROM {t}orders WHERE o_totalprice > 200000")
_sql("s_except_all", "SELECT o_custkey AS k FROM {t}orders EXCEPT ALL SELECT c_custkey AS k FROM {t}customer")
_sql("f_null_lang", "SELECT doc_id FROM {t}documents WHERE lang IS NULL OR n_chars > 5000")
_sql("f_not_null_lang", "SELECT doc_id, lang FROM {t}documents WHERE lang IS NOT NULL")
_sql("f_not_in_null", "SELECT doc_id, lang FROM {t}documents WHERE lang NOT IN ('en', 'fr')")
_sql("f_not_bool_column", "SELECT o_orderkey FROM (SELECT o_orderkey, o_totalprice > 100000 AS big FROM {t}orders) AS x WHERE NOT big")
_sql("fn_binary", "SELECT doc_id, octet_length(text) AS bytes, md5(text) AS digest, hex(encode(substring(text, 1, 8), 'UTF-8')) AS head FROM {t}documents", "SELECT doc_id, octet_length(encode(text))::INTEGER AS bytes, md5(text) AS digest, hex(encode(substring(text, 1, 8))) AS head FROM documents")
_sql("fn_regex", "SELECT page_id, url RLIKE '^https?://[a-z0-9.]+/' AS plain, regexp_replace(url, '[0-9]+', '#') AS shape FROM {t}pages", "SELECT page_id, regexp_matches(url, '^https?://[a-z0-9.]+/') AS plain, regexp_replace(url, '[0-9]+', '#', 'g') AS shape FROM pages")
_sql("fn_date", "SELECT o_orderkey, cast(date_trunc('month', o_orderdate) AS date) AS month, cast(o_orderdate + INTERVAL 10 DAY AS date) AS later, year(o_orderdate) AS y FROM {t}orders", "SELECT o_orderkey, date_trunc('month', o_orderdate)::DATE AS month, (o_orderdate + INTERVAL 10 DAY)::DATE AS later, year(o_orderdate)::INTEGER AS y FROM orders")
_sql("fn_math", "SELECT o_orderkey, o_totalprice / nullif(o_orderkey % 3, 0) AS share, abs(o_orderkey - 500) AS off, o_orderkey % 7 AS rest FROM {t}orders")
_sql("fn_array", "SELECT doc_id, size(ws) AS n, array_contains(ws, 'the') AS has_the, ws[0] AS head, array_join(slice(transform(ws, w -> concat('<', w, '>')), 1, 3), '|') AS marked FROM (SELECT doc_id, split(text, ' ') AS ws FROM {t}documents WHERE text IS NOT NULL) AS x", "SELECT doc_id, len(ws)::INTEGER AS n, list_contains(ws, 'the') AS has_the, ws[1] AS head, array_to_string(list_transform(ws[1:3], lambda w: '<' || w || '>'), '|') AS marked FROM (SELECT doc_id, string_split(text, ' ') AS ws FROM documents WHERE text IS NOT NULL)")
_sql("fn_unnest", "SELECT word, count(*) AS n FROM (SELECT explode(split(text, ' ')) AS word FROM {t}documents) AS x GROUP BY word", "SELECT word, count(*) AS n FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents) GROUP BY word")
_sql("fn_struct", "SELECT o_orderkey, s.state AS state, s.price > 100000 AS big FROM (SELECT o_orderkey, named_struct('state', o_orderstatus, 'price', o_totalprice) AS s FROM {t}orders) AS x", "SELECT o_orderkey, s.state AS state, s.price > 100000 AS big FROM (SELECT o_orderkey, {'state': o_orderstatus, 'price': o_totalprice} AS s FROM orders)")
_sql("fn_typeof", "SELECT upper(typeof(o_orderkey)) AS key_type, upper(typeof(o_totalprice)) AS price_type, count(*) AS n FROM {t}orders GROUP BY ALL", "SELECT typeof(o_orderkey) AS key_type, typeof(o_totalprice) AS price_type, count(*) AS n FROM orders GROUP BY ALL")


_P = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate FROM orders"
_KEPT = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"]


@query(_P)
def k_snapshot(b, _):
    path = sinks.shared_path(b.spark, "snapshot")
    return sinks.snapshot(b.scan("src", "orders", _KEPT), f"snapshot_{path.rsplit('-', 1)[1]}", path)


@query(_P)
def k_parquet_zstd(b, _):
    return sinks.to_parquet(b.scan("src", "orders", _KEPT), sinks.shared_path(b.spark, "parquet"))


@query(_P)
def k_partitioned(b, _):
    return sinks.to_parquet(b.scan("src", "orders", _KEPT), sinks.shared_path(b.spark, "partitioned"), ("o_orderstatus",)).select(*_KEPT)


@query(_P)
def k_sorted(b, _):
    return sinks.sorted_parquet(b.scan("src", "orders", _KEPT), sinks.shared_path(b.spark, "sorted"), "o_custkey", "o_orderkey")


@query("SELECT doc_id, text, lang FROM documents")
def k_csv(b, _):
    """Text with separators, quotes and line ends, written and read back."""
    return sinks.to_csv(b.scan("src", "documents", ["doc_id", "text", "lang"]), sinks.shared_path(b.spark, "csv"))


@query("SELECT c_custkey, s_suppkey FROM customer JOIN supplier ON abs(c_acctbal - s_acctbal) <= 5")
def j_band(b, _):
    return joins.band_join(b.scan("src", "customer", ["c_custkey", "c_acctbal"]), b.scan("src", "supplier", ["s_suppkey", "s_acctbal"]), "c_acctbal", "s_acctbal", 5.0).select("c_custkey", "s_suppkey")


@query("SELECT e.event_id, (SELECT max(p.event_id) FROM events p WHERE p.user_id = e.user_id AND p.event_type = 'purchase' AND (p.ts < e.ts OR p.ts = e.ts) AND p.ts = (SELECT max(q.ts) FROM events q WHERE q.user_id = e.user_id AND q.event_type = 'purchase' AND q.ts <= e.ts)) AS last_event_id FROM events e")
def j_asof(b, _):
    """For each event the user's last purchase up to its time."""
    events = b.scan("src", "events", ["event_id", "user_id", "ts", "event_type"])
    return joins.as_of_join(events, events.filter("event_type = 'purchase'"), "user_id", "ts", "ts", "event_id").select("event_id", "last_event_id")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey < 1000 UNION ALL SELECT o_orderkey, o_custkey + 1 FROM orders WHERE o_orderkey >= 1000")
def k_incremental_refresh(b, _):
    """A snapshot on disk, refreshed for the rows of a recent window: old rows outside it, new rows inside."""
    rows = b.scan("src", "orders", ["o_orderkey", "o_custkey"])
    old, new = sinks.shared_path(b.spark, "snapshot"), sinks.shared_path(b.spark, "snapshot")
    sinks.to_parquet(rows, old)
    return sinks.refresh_window(b.spark, old, rows.withColumn("o_custkey", F.col("o_custkey") + 1), "o_orderkey", 1000, new)


@query("SELECT o_custkey, max(o_orderkey) AS o_orderkey FROM orders GROUP BY o_custkey")
def w_latest_order(b, _):
    return metadata.latest(b.scan("src", "orders", ["o_custkey", "o_orderkey"]), "o_custkey", "o_orderkey")


@query("SELECT e.event_id, (SELECT max(p.event_id) FROM events p WHERE p.user_id = e.user_id AND p.event_id < e.event_id) AS prev_event FROM events e")
def j_asof_previous(b, _):
    """The event before each one of the same user: an as-of join of a table with itself by a window."""
    events = b.scan("src", "events")
    return events.select("event_id", F.lag("event_id").over(Window.partitionBy("user_id").orderBy("event_id")).alias("prev_event"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLES)
