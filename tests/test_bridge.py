"""The bridge: connection strings, charsets, ranges, paging, catalog, diagnostics, redaction."""

import pytest
from pyspark.sql import functions as F

from tarnbridge.conninfo import BridgeError, ScanOptions, parse_connection
from tarnbridge.functions import charset, text, types
from tarnbridge.operators import audits, diagnostics, joins, metadata
from tarnbridge.operators.bridge import Bridge
from tarnbridge.plans.partition import classify_key, pick_partition_count, predicate, ranges
from tarnbridge.plans.view_shape import analyse, scan_tokens
from tarnbridge.sources import sinks
from tarnbridge.sources.backend import CsvBackend, JdbcBackend
from tarnbridge.sources.dictionary import Relation, tpch

SF = "/root/testdata/sf0.001"


def attached(spark, folder):
    b = Bridge(spark, query_log_size=20)
    b.attach(folder, "src", tpch(folder))
    return b


def test_connection_forms():
    url = parse_connection("db://me:p%2Bw+d@host:3050/data/x.fdb?charset=NONE&dialect=1&other=1")
    assert (url.host, url.port, url.database, url.user, url.password, url.charset, url.dialect) == ("host", 3050, "data/x.fdb", "me", "p+w d", "NONE", 1)
    pairs = parse_connection("database=/x.fdb;user=me;password=s3cret;nonsense=1")
    assert pairs.database == "/x.fdb" and "s3cret" not in repr(pairs) and "s3cret" not in pairs.redacted()
    assert parse_connection("/plain/path", user="u").user == "u"
    with pytest.raises(BridgeError):
        parse_connection("/x", charset="LATIN9")
    with pytest.raises(BridgeError):
        parse_connection("")


@pytest.mark.parametrize("bad", [{"partitions": -1}, {"row_limit": 0}, {"row_offset": -1}, {"row_offset": 1}, {"row_limit": 1, "partitions": 2}, {"row_limit": 2**31, "row_offset": 1}, {"none_encoding": "ebcdic"}, {"int128": "double"}])
def test_option_guards(bad):
    with pytest.raises(BridgeError):
        ScanOptions(**bad).validated()


def test_charsets(spark):
    df = spark.createDataFrame([(bytes.fromhex("53E36F205061756C6F"),), (bytes.fromhex("93686994"),), (b"\x80",), (b"\x81",), (None,)], "b binary")
    assert [r[0] for r in df.select(charset.win1252(F.col("b"))).collect()] == ["São Paulo", "“hi”", "€", "\x81", None]
    assert df.select(charset.latin1(F.col("b"))).first()[0] == "São Paulo"
    with pytest.raises(Exception, match="LABEL"):
        df.select(charset.strict(F.col("b"), "LABEL")).collect()


def test_ranges_cover_everything():
    assert ranges(1, 100, 4) == [(None, 25), (26, 50), (51, 75), (76, None)]
    assert ranges(5, 6, 9) == [(None, 5), (6, None)]
    assert predicate("id", None, 5) == "id <= 5" and predicate("id", None, None) == "1 = 1"
    assert [pick_partition_count(1, n, 8) for n in (3_999_999, 4_000_000, 100_000_000)] == [1, 2, 8]
    assert pick_partition_count(None, None, 8) == 1
    assert [classify_key(*x).reason for x in (([], []), (["a", "b"], ["int", "int"]), (["a"], ["string"]), (["a"], ["int"]))] == ["no primary key", "composite PK", "non-numeric PK", "single numeric PK"]


def test_types(spark):
    assert types.spark_type(types.BIGINT, 1, -2).simpleString() == "decimal(18,2)"
    assert types.spark_type(types.SMALLINT, 1, -2).simpleString() == "decimal(4,2)"
    assert types.spark_type(types.VARCHAR, charset_id=0, none_encoding="blob").simpleString() == "binary"
    with pytest.raises(BridgeError):
        types.spark_type(999)
    df = spark.createDataFrame([(24, 0, 0, -1), (26, 0, 0, -1), (31, 0, 0, -1), (30, 0, 0, -1), (261, 1, 0, 0), (261, 1, 0, 4), (8, 0, 0, -1)], "c int, s int, k int, x int")
    found = df.select(types.audit_finding(*[F.col(c) for c in "cskx"])).collect()
    assert [r[0] for r in found] == ["decfloat_as_varchar", "int128", "timestamp_tz", "time_tz", "none_charset", "blob_text", None]
    assert df.select(types.type_text(F.lit(99), F.lit(0), F.lit(0))).first()[0] == "TYPE_99"


def test_text_helpers(spark):
    df = spark.createDataFrame([("a%b",), ("a\\xb",)], "t string")
    assert [r.t for r in df.filter(text.like(F.col("t"), "a\\%b")).collect()] == ["a\\xb"]
    assert text.quote_ident('a"b') == '"a""b"' and text.quote_literal("O'Brien") == "'O''Brien'"
    assert text.quote_yaml('a"\\\n\x01') == '"a\\"\\\\\\n\\x01"'
    assert "secret" not in text.sanitized("password=secret; db://u:secret@h")


def test_pages_filter_before_slice(spark):
    b = attached(spark, SF)
    everything = [r.o_orderkey for r in b.scan("src", "orders").filter("o_orderstatus = 'F'").orderBy("o_orderkey").collect()]
    page = [r.o_orderkey for r in b.scan("src", "ORDERS", ["o_orderkey"], "o_orderstatus = 'F'", row_limit=5, row_offset=3).collect()]
    assert page == everything[3:8]
    assert b.scan("src", "orders", row_limit=5, row_offset=10**8).count() == 0
    last = b.last_query().first()
    assert (last.limit_rows, last.offset_rows) == (5, 10**8) and b.query_log().count() >= 2
    far = b.scan("src", "lineitem", row_limit=2 * 10**9)
    assert "TakeOrdered" not in far._jdf.queryExecution().executedPlan().toString() and far.count() == b.scan("src", "lineitem").count()
    heavy = [tuple(r) for r in b.scan("src", "v_customer_totals", row_limit=10**6).collect()]
    assert [tuple(r) for r in b.scan("src", "v_customer_totals", row_limit=7, row_offset=5).collect()] == heavy[5:12]


def test_catalog(spark):
    b = attached(spark, SF)
    names = [r.table_name for r in metadata.tables(b, "src").collect()]
    assert names == sorted(names) and "v_open_orders" in names
    assert b.table("src.main.Customer").count() == spark.read.parquet(f"{SF}/customer.parquet").count()
    for bad in ("src.other.customer", "src.nothing"):
        with pytest.raises(BridgeError):
            b.table(bad)
    metadata.publish_information_schema(b, "src")
    rules = spark.sql("SELECT * FROM src_information_schema_referential_constraints WHERE delete_rule = 'SET NULL'")
    assert rules.columns == ["constraint_name", "unique_constraint_name", "update_rule", "delete_rule"] and rules.first().unique_constraint_name == "PK_customer"
    assert spark.table("src_information_schema_table_constraints").filter("constraint_type = 'PRIMARY KEY'").count() == 14
    assert [r.name for r in metadata.show_tables(b, "src").collect()] == names
    assert [tuple(r) for r in metadata.describe(b, "src.labels").collect()] == [("doc_id", "bigint"), ("quality", "int"), ("toxic", "int")]
    assert b.scan("src", "sys_relations", ["name"], "kind = 'view'").count() == 2
    assert all("password" not in r.sql for r in metadata.attach_sql(b, "src").collect())
    b.detach("src")
    with pytest.raises(BridgeError, match="tables"):
        metadata.tables(b, "src")


def _fresh(spark) -> Bridge:
    b = Bridge(spark, query_log_size=5)
    b.attach(SF, "own", tpch(SF))
    return b


@pytest.mark.parametrize(
    "statement",
    ["DROP TABLE x", "insert into x values (1)", "CREATE VIEW v AS SELECT 1", "MERGE INTO x USING y ON x.a = y.a WHEN MATCHED THEN DELETE", "/* x */ CREATE TABLE probe AS SELECT 1 AS a", "FROM own_main_labels INSERT INTO probe SELECT doc_id", "WITH q AS (SELECT 1 AS a) INSERT INTO probe SELECT a FROM q", "-- c\nTRUNCATE TABLE x", "SET spark.sql.ansi.enabled = false", "CACHE TABLE own_main_labels", "BEGIN SELECT 1; END"],
)
def test_only_queries_are_allowed(spark, statement):
    with pytest.raises(BridgeError, match="read-only"):
        _fresh(spark).sql(statement)


def test_queries_that_look_like_writes(spark):
    b = _fresh(spark)
    assert b.sql("/* DROP */ SELECT 'insert into x' AS t FROM own_main_labels LIMIT 1").first().t == "insert into x"
    assert b.sql("FROM own_main_labels SELECT doc_id").count() == b.sql("WITH labels AS (SELECT * FROM own_main_labels) SELECT * FROM labels").count()


def test_views_see_relations_by_name(spark):
    b = Bridge(spark)
    views = {"v_comma": "SELECT c.c_custkey, o.o_orderkey FROM customer c, `orders` o WHERE o.o_custkey = c.c_custkey", "v_noise": "SELECT 'from orders' AS t, count(*) AS n FROM Customer", "v_cte": "WITH orders AS (SELECT 1 AS one) SELECT * FROM orders", "v_on_view": "SELECT count(*) AS n FROM v_comma"}
    b.attach(SF, "vw", [*tpch(SF), *[Relation(n, kind="view", view_source=t) for n, t in views.items()]])
    assert b.scan("vw", "v_comma").count() == b.scan("vw", "orders").count() == b.scan("vw", "v_on_view").first().n
    assert b.scan("vw", "v_noise").first().t == "from orders" and [tuple(r) for r in b.scan("vw", "v_cte").collect()] == [(1,)]


def test_key_ranges_over_files(spark):
    b = _fresh(spark)
    df = b.scan("own", "orders", where="o_orderstatus = 'F'", partitions=4)
    assert df.rdd.getNumPartitions() == 4 and b.last_query().first().partitions == 4
    assert sorted(df.collect()) == sorted(b.scan("own", "orders", where="o_orderstatus = 'F'").collect()) and b.last_query().first().partitions == 1
    assert df._jdf.queryExecution().executedPlan().toString().count("GreaterThanOrEqual(o_orderkey") == 3
    for relation in ("lineitem", "conversations"):
        with pytest.raises(BridgeError, match="single integer key"):
            b.scan("own", relation, partitions=4)


def test_pushdown_follows_the_plan(spark):
    b = _fresh(spark)
    b.scan("own", "orders", where="length(o_orderstatus) = 1 AND (o_custkey < 5) AND o_orderkey IN (3, 4, 5)")
    last = b.last_query().first()
    assert last.pushed_filters == "LessThan(o_custkey,?) AND In(o_orderkey,?)" and (last.residual_columns, last.not_pushed_reasons) == ("o_orderstatus", "UNSUPPORTED_OP")
    rows = diagnostics.explain_pushdown(b, "own", "SELECT o.o_orderkey FROM own_main_orders o JOIN own_main_customer c ON o.o_custkey = c.c_custkey WHERE o.o_totalprice > 5 AND c.c_mktsegment LIKE '%x' AND c.c_custkey % 2 = 0").collect()
    assert [(r.table_name, r.pushed_filters) for r in rows] == [("orders", "GreaterThan(o_totalprice,?)"), ("customer", "StringEndsWith(c_mktsegment,?)")]
    assert rows[1].residual_columns == "c_custkey" and rows[0].projected_columns == "o_orderkey,o_custkey,o_totalprice"


def test_declared_types(spark, tmp_path):
    rows = [(12345, "ab  ", 7, "1.50", 3_600_000_000_000, 2**62)]
    spark.createDataFrame(rows, "price long, code string, big long, dec string, t long, wide long").write.parquet(str(tmp_path / "t.parquet"))
    r = Relation("t", str(tmp_path / "t.parquet"), codes={"price": (types.BIGINT, 1, -2), "code": (types.CHAR, 0, 0), "big": (types.INT128, 0, 0), "dec": (types.DECFLOAT16, 0, 0), "wide": (types.INT128, 1, -3)})
    b = Bridge(spark)
    b.attach("x", "ty", [r])
    got = b.scan("ty", "t")
    assert [got.schema[c].dataType.simpleString() for c in ("price", "code", "big", "dec", "wide")] == ["decimal(18,2)", "string", "string", "string", "decimal(38,3)"]
    assert str(got.first().price) == "123.45" and got.first().code == "ab" and got.first().big == "7" and str(got.first().wide) == "4611686018427387.904"
    assert b.scan("ty", "t", int128="decimal38").schema["big"].dataType.simpleString() == "decimal(38,0)"
    assert b.scan("ty", "t", where="dec = '1.5'").count() == 0 and b.scan("ty", "t", where="dec = '1.50'").count() == 1
    assert b.sql("SELECT price FROM ty_main_t").first() == got.select("price").first()


def test_discovery_and_new_files(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "grow.parquet"))
    b = Bridge(spark)
    b.attach(str(tmp_path), "disc")
    assert [r.name for r in metadata.show_tables(b, "disc").collect()] == ["grow"] and b.scan("disc", "GROW").count() == 3
    spark.range(5).write.mode("append").parquet(str(tmp_path / "grow.parquet"))
    assert b.scan("disc", "grow").count() == 8 and b.sql("SELECT count(*) AS n FROM disc_main_grow").first().n == 8


def test_csv_source_and_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a;"b"\nc', None), (2, "", "x"), (3, None, "y")], "id int, t string, u string")
    assert sorted(sinks.to_csv(df, str(tmp_path / "c")).collect()) == sorted(df.collect())
    b = Bridge(spark)
    df.select("id", "u").write.option("header", True).csv(str(tmp_path / "plain.csv"))
    b.attach(str(tmp_path), "csvs", [Relation("plain", str(tmp_path / "plain.csv"))], CsvBackend(spark, parse_connection(str(tmp_path)), {"plain": "id int, u string"}))
    assert b.scan("csvs", "plain", where="id > 1").agg(F.sum("id")).first()[0] == 5
    kept = sinks.to_parquet(df, str(tmp_path / "p"), ("id",))
    assert kept.count() == 3 and (tmp_path / "p" / "id=2").is_dir() and sinks.to_parquet(df.limit(0), str(tmp_path / "e")).count() == 0
    many = spark.range(2000).select((F.col("id") * 37 % 2000).alias("k"))
    files = [sorted(r.k for r in spark.read.parquet(str(f)).collect()) for f in sorted(__import__("pathlib").Path(sinks.sorted_parquet(many, str(tmp_path / "s"), "k").inputFiles()[0].removeprefix("file://")).parent.glob("*.parquet"))]
    assert sum(files, []) == list(range(2000))
    with pytest.raises(Exception, match="exist"):
        for _ in range(2):
            sinks.snapshot(df, "snap_once", str(tmp_path / "snap"), replace=False)
    assert spark.table("snap_once").count() == 3
    fresh = sinks.refresh_window(spark, str(tmp_path / "s"), many.withColumn("k", F.col("k") + 0).filter("k % 2 = 0"), "k", 1000, str(tmp_path / "n"))
    assert fresh.count() == 1500


def test_joins_against_loops(spark):
    left = [(i, float(i * 7 % 50) / 3 if i % 9 else None) for i in range(60)]
    right = [(i, float(i * 11 % 50) / 3) for i in range(40)]
    got = joins.band_join(spark.createDataFrame(left, "a int, x double"), spark.createDataFrame(right, "b int, y double"), "x", "y", 0.7).select("a", "b").collect()
    assert sorted(map(tuple, got)) == sorted((a, b) for a, x in left for b, y in right if x is not None and abs(x - y) <= 0.7)
    marks = [(i % 3, i * 5 % 23, i) for i in range(30)]
    asked = [(i % 4, i) for i in range(25)]
    got = joins.as_of_join(spark.createDataFrame(asked, "k int, t int"), spark.createDataFrame(marks, "k int, s int, v int"), "k", "t", "s", "v").collect()
    want = [(k, t, max(((s, v) for j, s, v in marks if j == k and s <= t), default=(None, None))[1]) for k, t in asked]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_audits_find_faults(spark, tmp_path):
    spark.createDataFrame([(1,), (2,), (2,), (None,)], "id long").write.parquet(str(tmp_path / "p.parquet"))
    spark.createDataFrame([(1, "a "), (9, None), (None, "bcd")], "ref long, t string").write.parquet(str(tmp_path / "c.parquet"))
    b = Bridge(spark)
    b.attach(str(tmp_path), "au", [Relation("p", str(tmp_path / "p.parquet"), primary_key=("id",)), Relation("c", str(tmp_path / "c.parquet"), foreign_keys=(("FK", ("ref",), "p", ("id",), "NO ACTION", "NO ACTION"),))])
    assert audits.key_checks(b, "au").first()[2:] == (4, 2, 1) and audits.reference_checks(b, "au").first()[3:] == (3, 1)
    assert [tuple(r) for r in audits.null_counts(b, "au").filter("table_name = 'c'").collect()] == [("c", "ref", 1, 1), ("c", "t", 2, 1)]
    assert audits.text_widths(b, "au").first()[3:] == (3, 1) and audits.index_selectivity(b, "au").filter("index_name = 'FK'").first().n_distinct == 3
    assert audits.scan_profile(b, "au.p").first()[2:] == (4, 1, 2, 2, 1)
    spans = spark.createDataFrame([(n,) for n in (None, 1, 3_999_999, 4_000_000, 9_999_999, 10**9)], "span long")
    assert [r[0] for r in spans.select(audits.partitions_for("span", 8)).collect()] == [1, *[pick_partition_count(1, n, 8) for n in (1, 3_999_999, 4_000_000, 9_999_999, 10**9)]]


def test_metadata_of_fixture(spark, tmp_path):
    spark.createDataFrame([(1, "Alice", b"\x80", "2020")], "emp_id int, emp_name string, note binary, name_len string").write.parquet(str(tmp_path / "employee.parquet"))
    r = Relation("EMPLOYEE", str(tmp_path / "employee.parquet"), primary_key=("emp_id",), indexes=(("IDX_OFF", ("emp_name",), False, False, None), ("IDX_EXPR", (), False, True, "UPPER(emp_name)")), comment="Staff", column_comments={"emp_name": "x" * 4100}, none_charset=("note",), computed={"name_len": "CHAR_LENGTH(emp_name)"}, codes={"note": (261, 1, 0)})
    b = Bridge(spark, query_log_size=1)
    b.attach(str(tmp_path), "fb", [r], generators=[("G", 100, None)], domains=[("D", 16, 1, -2, 8, True, None, "CHECK (VALUE > 0)", None), ("E", 23, 0, 0, 1, True, None, None, None)], dependencies=[("V", 1, "T", 77, None)])
    assert b.scan("fb", "employee").first().note == "€"
    assert b.scan("fb", "employee", none_encoding="blob").first().note == b"\x80"
    assert b.scan("fb", "employee", where="note = '€'").count() == 1 and b.last_query().first().not_pushed_reasons == "NONE_CHARSET"
    assert len(metadata.comments(b, "fb").collect()[0].comment) == 4100
    assert [(x.index_name, x.is_active, x.column_name) for x in metadata.indexes(b, "fb").collect()] == [("IDX_EXPR", True, None), ("IDX_OFF", False, "emp_name"), ("PK_EMPLOYEE", True, "emp_id")]
    assert [x.base_type for x in metadata.domains(b, "fb").collect()] == ["NUMERIC", "BOOLEAN"]
    assert metadata.dependencies(b, "fb").first().depends_on_type == "UNKNOWN" and metadata.OBJECT_TYPES[18] == "PACKAGE" and 11 not in metadata.OBJECT_TYPES and metadata.generators(b, "fb").first().initial_value == 100
    assert metadata.computed_columns(b, "fb").first().expression_source == "CHAR_LENGTH(emp_name)"
    assert metadata.type_audit(b, "fb").first().finding == "none_charset"
    assert '"not_null", "unique"' in metadata.dbt_sources(b, "fb").first().yaml
    codes = [a.code for a in diagnostics.profile_table(b, "fb.main.employee").first().alerts]
    assert codes == ["numeric_pk_no_range_serial", "none_charset_text_columns"]
    found = {x.index_name: ([a.code for a in x.alerts], x.selectivity) for x in diagnostics.index_profile(b, "fb.employee").collect()}
    assert found == {"PK_EMPLOYEE": ([], 1.0), "IDX_OFF": (["index_inactive"], 1.0), "IDX_EXPR": (["missing_statistics"], None)}
    assert b.sql("SELECT note FROM fb_main_employee").first().note == "€"


def test_profiles_and_health(spark):
    b = attached(spark, SF)
    row = diagnostics.profile_table(b, "src.main.v_customer_totals").first()
    assert [a.code for a in row.alerts] == ["view_no_scan_lever", "view_contains_join", "view_contains_aggregation", "view_no_filter"] and row.warnings == [a.message for a in row.alerts]
    assert diagnostics.profile_table(b, "src.lineitem").first().alerts[0].code == "no_primary_key"
    h = diagnostics.health(b, "src", {"next_transaction": 2_000_002, "oldest_transaction": 1, "oldest_active": 1_000_002, "sweep_interval": 0, "forced_writes": False, "default_charset": "NONE"}).first()
    assert h.oit_gap == 2_000_001 and h.warnings == ["oit_gap_high", "sweep_disabled", "forced_writes_off", "charset_none"]
    assert diagnostics.health(b, "src").first().warnings == ["mon_unavailable"]
    e = diagnostics.explain_pushdown(b, "src", "SELECT o_custkey FROM src_main_orders WHERE o_orderstatus = 'O'").first()
    assert e.table_name == "orders" and "EqualTo(o_orderstatus,?)" in e.pushed_filters and "'O'" not in str(e)
    with pytest.raises(BridgeError):
        diagnostics.explain_pushdown(b, "src", "DELETE FROM x")


def test_view_shapes(spark):
    noise = "SELECT 'JOIN it''s GROUP BY' AS t FROM e -- WHERE\n"
    assert not scan_tokens(noise).join and not scan_tokens(noise).aggregate and not scan_tokens(noise).where
    assert analyse(spark, "SELECT a.x FROM a, b WHERE a.x = b.x").join
    assert analyse(spark, "SELECT DISTINCT x FROM a").aggregate and not analyse(spark, "SELECT MYCOUNT(x) FROM a").aggregate
    assert not analyse(spark, None).inspected


def test_jdbc_ranges_lose_no_row(spark, tmp_path):
    url, driver = f"jdbc:derby:{tmp_path}/db;create=true", "org.apache.derby.jdbc.EmbeddedDriver"
    try:
        spark.range(1, 101).selectExpr("cast(id as int) AS ID", "cast(id % 3 as int) AS G").write.jdbc(url, "T", properties={"driver": driver})
    except Exception as e:
        pytest.skip(f"no embedded database: {str(e)[:80]}")
    b = Bridge(spark)
    b.attach("ignored", "j", [Relation("T", primary_key=("ID",))], JdbcBackend(spark, parse_connection("x"), url, driver))
    df = b.scan("j", "t", where="G = 1", partitions=4)
    assert df.rdd.getNumPartitions() == 4 and df.count() == 34
    assert "PushedFilters: [*IsNotNull(G), *EqualTo(G,1)]" in df._jdf.queryExecution().toString()


def test_registry_matches_oracle(spark):
    import duckdb

    from tarnbridge import registry

    con = duckdb.connect()
    for t in ("orders", "customer", "lineitem", "labels", "documents", "conversations", "events", "nation"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    queries, oracles = registry.queries(), registry.oracle_sql()
    for name in ("f_not_in", "f_like_inner", "pg_no_pk_total_order", "p_sparse_labels_4", "a_bool", "s_except_status", "k_incremental_refresh", "j_asof", "m_foreign_keys", "t_scaled_integer", "k_csv"):
        df = queries[name](spark, SF)
        want = con.execute(oracles[name])
        at = [[d[0] for d in want.description].index(c) for c in df.columns]
        assert sorted(map(str, (tuple(r) for r in df.collect()))) == sorted(str(tuple(r[i] for i in at)) for r in want.fetchall()), name


def test_stream(spark, tmp_path):
    from tarnbridge.streaming import stream_relation

    spark.range(10).write.parquet(str(tmp_path / "in"))
    q = stream_relation(spark, str(tmp_path / "in")).writeStream.format("memory").queryName("streamed").option("checkpointLocation", str(tmp_path / "c")).start()
    q.processAllAvailable()
    q.stop()
    assert spark.table("streamed").count() == 10
