"""S1-S6, P1-P7, T1-T5, C10, D7."""

import pytest
from pyspark.sql import functions as F

from rowtide.functions import types as T
from rowtide.operators import shape
from rowtide.sources import catalog

CATALOG_DDL = (
    "keyspace string, table string, ordinal int, column string, column_type string, column_key string"
)


def names(spark, *values):
    return spark.createDataFrame([(x,) for x in values], "name string")


def column(frame, name):
    return sorted(r[name] for r in frame.collect())


def test_shards(spark):
    listed = names(spark, "shop/-", "shop_big/-80", "shop_big/80-", "shop", "", "shop_big/a/b")
    assert column(catalog.list_shards(listed, "shop_big"), "shard") == ["-80", "80-", "a/b"]
    assert column(catalog.list_shards(listed, "shop"), "shard") == ["-"]
    assert column(catalog.list_shards(listed, "other"), "shard") == []


def test_keyspaces(spark):
    listed = names(spark, "shop/eu", "my_shop", "store", "x/shop/eu")
    assert column(catalog.list_keyspaces(listed, "shop"), "keyspace") == ["eu", "my_shop", "x/shop/eu"]
    # No wildcards in the name.
    assert column(catalog.list_keyspaces(names(spark, "a_b", "axb"), "a_b"), "keyspace") == ["a_b"]


def test_internal_tables(spark):
    internal = [
        f"_vt_{k}_0123456789abcdef0123456789abcdef_20250101000000" + end
        for k, end in [(k, "_") for k in ("hld", "prg", "evc", "del")] + [("DROP", ""), ("HOLD", "")]
    ] + ["_0a1b2c3d_4e5f_6071_8293_a4b5c6d7e8f9_20250101000000_vrepl"]
    tables = spark.createDataFrame([(t,) for t in internal + ["staff", "a_vt"]], "table string")
    assert column(catalog.drop_internal_tables(tables), "table") == ["a_vt", "staff"]


MAPPED = [
    ("int(32)", "INT"), ("int unsigned", "LONG"), ("tinyint(1)", "BOOLEAN"), ("TINYINT(1)", "BOOLEAN"),
    ("tinyint", "INT"), ("tinyint unsigned", "INT"), ("timestamp", "UTC_DATETIME"), ("time", "STRING"),
    ("bigint(16)", "LONG"), ("bigint zerofill", "LONG"), ("varbinary", "BINARY"), ("binary(16)", "BINARY"),
    ("datetime(3)", "NAIVE_DATETIME"), ("date", "NAIVE_DATE"), ("text", "STRING"), ("varchar(256)", "STRING"),
    ("enum('a')", "STRING"), ("decimal(12,5)", "DECIMAL"), ("double", "DOUBLE"), ("float", "DOUBLE"),
    ("mediumint", "INT"), ("mediumint unsigned", "STRING"), ("mediumint(9)", "STRING"),
    ("unsigned int", "STRING"), ("bit(1)", "LONG"), ("bit(16)", "LONG"), ("geomcollection", "JSON"),
    ("set('a')", "JSON"), ("json", "JSON"), ("year", "INT"), ("longblob", "BINARY"), ("numeric", "STRING"),
    ("smallint unsigned", "INT"), ("point", "JSON"), ("multipolygon", "JSON"), ("longtext", "STRING"),
]


def test_map_type(spark):
    frame = spark.createDataFrame(MAPPED, "t string, want string")
    for r in frame.withColumn("got", T.map_type(F.col("t"))).collect():
        assert r.got == r.want, r.t


def test_map_type_options(spark):
    frame = spark.createDataFrame([("tinyint(1)", "bigint unsigned")], "a string, b string")
    r = frame.select(
        T.map_type(F.col("a"), tinyint1_as_bool=False).alias("a"),
        T.map_type(F.col("b")).alias("b"),
        T.map_type(F.col("b"), compat=True).alias("c"),
    ).first()
    assert (r.a, r.b, r.c) == ("INT", "DECIMAL", "LONG")


def test_decimal_params(spark):
    frame = spark.createDataFrame(
        [("Decimal", 10, 0), ("DECIMAL(27)", 27, 0), ("decimal(19,7)", 19, 7), ("bigint unsigned", 20, 0),
         ("int(5)", None, None)],
        "t string, p int, s int",
    )
    p, s = T.decimal_params(F.col("t"))
    for r in frame.select("*", p.alias("gp"), s.alias("gs")).collect():
        assert (r.gp, r.gs) == (r.p, r.s), r.t


def test_labels(spark):
    """Labels made of every pair of signs that matter to the quoting, one alone and several together."""
    signs = ["", "k", "'", "''", ",", "(", ")", " "]
    made = [a + b for a in signs for b in signs]
    quoted = lambda labels: ",".join("'" + v.replace("'", "''") + "'" for v in labels)
    cases = [(f"{kind}({quoted(labels)})", labels) for kind in ("enum", "SET") for labels in [[v] for v in made] + [made, made[::-1]]]
    cases += [("enum(a,b)", ["a", "b"]), ("varchar(3)", None)]
    frame = spark.createDataFrame(cases, "t string, want array<string>")
    for r in frame.withColumn("got", T.parse_labels(F.col("t"))).collect():
        assert r.got == r.want, r.t


@pytest.fixture(scope="module")
def staff(spark):
    rows = [
        ("hr", "staff", 1, "id", "varchar(40)", "PRI"),
        ("hr", "staff", 2, "title", "varchar(400)", ""),
        ("hr", "staff", 3, "team", "enum('it','sales')", ""),
        ("hr", "staff", 4, "towns", "set('new york','oslo')", ""),
        ("hr", "staff", 5, "pay", "decimal(50,2)", ""),
        ("hr", "_vt_hld_x", 1, "id", "int", "pri"),
        ("ops", "jobs", 1, "id", "bigint", "pri"),
    ]
    return spark.createDataFrame(rows, CATALOG_DDL)


def test_build_schema(staff):
    tables = {(r["keyspace"], r["table"]): r["columns"] for r in catalog.build_schema(staff).collect()}
    assert set(tables) == {("hr", "staff"), ("ops", "jobs")}
    assert [(c["column"], c["logical_type"], c["is_pk"]) for c in tables["hr", "staff"]] == [
        ("id", "STRING", True), ("title", "STRING", False), ("team", "STRING", False),
        ("towns", "JSON", False), ("pay", "DECIMAL", False)]
    assert tables["ops", "jobs"][0]["is_pk"]
    pay = tables["hr", "staff"][4]
    assert (pay["precision"], pay["scale"], pay["spark_type"]) == (50, 2, "string")


def test_build_update_schema(staff):
    tables = catalog.build_schema(staff, with_labels=True).filter("table = 'staff'").first()["columns"]
    assert [(c["label_kind"], c["labels"]) for c in tables[2:4]] == [
        ("enum", ["it", "sales"]), ("set", ["new york", "oslo"])]


def test_selection(spark, staff):
    chosen = spark.createDataFrame([("hr", True), ("ops", False)], "keyspace string, included boolean")
    assert column(shape.select_objects(staff, chosen, ["keyspace"]).distinct(), "keyspace") == ["hr"] * 6
    frame = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert shape.select_columns(frame, {"c": True, "a": True, "b": False}).columns == ["a", "c"]
    assert shape.existing_columns(["z", "c", "a"], ["a", "b", "c"]) == ["c", "a"]
    assert shape.existing_columns(["z"], None) == ["z"]
    assert shape.star_fallback(["", "  "], ["a", "b"]) == ["a", "b"]
    assert shape.star_fallback([" b ", ""], ["a", "b"]) == ["b"]


def test_check_shards(spark):
    shards = spark.createDataFrame([("-80",), ("80-",)], "shard string")
    assert column(catalog.check_shards(" 80- ,", shards), "shard") == ["80-"]
    assert column(catalog.check_shards("", shards), "shard") == ["-80", "80-"]
    with pytest.raises(ValueError, match="no such shard: 40-"):
        catalog.check_shards("-80,40-", shards)


def test_plan_writers(spark, staff):
    rows = [r.asDict() for r in catalog.describe_columns(staff.filter("table = 'staff'")).collect()]
    writers, pk = shape.plan_writers(rows, ["id", "team", "towns"])
    assert pk == ["id"]
    raw = spark.createDataFrame(
        [({"id": b"7", "team": b"2", "towns": b"3"},), ({"id": b"8", "team": None, "towns": b"oslo"},), (None,)],
        "image map<string,binary>",
    )
    got = raw.select(shape.write_row(F.col("image"), writers).alias("r")).collect()
    assert [tuple(r.r) if r.r else None for r in got] == [
        ("7", "sales", "new york,oslo"), ("8", None, "oslo"), None]
    with pytest.raises(ValueError, match="no converter"):
        shape.plan_writers(rows, ["id", "ghost"])
    with pytest.raises(ValueError, match="not in the schema"):
        shape.plan_writers([], ["id"])


def test_schema_diff(spark, staff):
    def later(*rows):
        return spark.createDataFrame([("hr", "staff", *r) for r in rows], CATALOG_DDL)

    base = [(1, "id", "int", "PRI"), (2, "a", "int", ""), (3, "e", "enum('x')", "")]
    verdict = lambda rows: catalog.schema_diff(later(*base), later(*rows)).first()["verdict"]
    assert verdict(base) == "NONE"
    assert verdict(base + [(4, "new", "int", "")]) == "MIGRATE"
    assert verdict(base[:1] + base[2:]) == "MIGRATE"
    assert verdict([base[0], (2, "mid", "int", ""), (3, "a", "int", ""), (4, "e", "enum('x')", "")]) == "MIGRATE"
    assert verdict([base[0], (3, "a", "int", ""), (2, "e", "enum('x')", "")]) == "RECOPY"
    assert verdict([base[0], (2, "a", "int", "PRI"), base[2]]) == "RECOPY"
    assert verdict(base[:2] + [(3, "e", "enum('x','y')", "")]) == "RECOPY"
