"""Source type text -> logical type, labels and decimal parameters."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BOOLEAN, SHORT, INT, LONG = "BOOLEAN", "SHORT", "INT", "LONG"
FLOAT, DOUBLE, DECIMAL = "FLOAT", "DOUBLE", "DECIMAL"
NAIVE_DATE, NAIVE_DATETIME, UTC_DATETIME = "NAIVE_DATE", "NAIVE_DATETIME", "UTC_DATETIME"
BINARY, JSON, STRING = "BINARY", "JSON", "STRING"

# The widest decimal the source can declare, the widest Spark holds,
# and the source's defaults for a bare DECIMAL.
SPARK_MAX_PRECISION = 38
DEFAULT_PRECISION, DEFAULT_SCALE = 10, 0

# Shape types of the source, all delivered as GeoJSON text.
GEOMETRY_PREFIXES = (
    "geometry",
    "geomcollection",
    "geometrycollection",
    "multipoint",
    "multipolygon",
    "polygon",
    "point",
    "linestring",
    "multilinestring",
)

# Type names that count only when nothing follows them.
EXACT_TYPES = {
    "date": NAIVE_DATE,
    "json": JSON,
    "tinytext": STRING,
    "mediumtext": STRING,
    "longtext": STRING,
    "mediumint": INT,
    "blob": BINARY,
    "tinyblob": BINARY,
    "mediumblob": BINARY,
    "longblob": BINARY,
}


def _starts(text: Column, *prefixes: str) -> Column:
    hit = text.startswith(prefixes[0])
    for prefix in prefixes[1:]:
        hit = hit | text.startswith(prefix)
    return hit


def map_type(column_type: Column, tinyint1_as_bool: bool = True, compat: bool = False) -> Column:
    """The logical type of a source type, first matching rule wins.

    ``bigint unsigned`` does not fit a long, so it becomes DECIMAL(20,0);
    ``compat=True`` gives LONG instead (A8).
    """
    t = F.lower(column_type)
    unsigned = t.contains("unsigned")
    rules: list[tuple[Column, str]] = []
    if tinyint1_as_bool:
        rules.append((t == "tinyint(1)", BOOLEAN))
    rules += [
        (_starts(t, "tinyint"), INT),
        (_starts(t, "bit"), LONG),
        (_starts(t, "varbinary", "binary"), BINARY),
        (_starts(t, "int") & unsigned, LONG),
        (_starts(t, "int", "smallint"), INT),
    ]
    if not compat:
        rules.append((_starts(t, "bigint") & unsigned, DECIMAL))
    rules += [
        (_starts(t, "bigint"), LONG),
        (_starts(t, "decimal"), DECIMAL),
        (_starts(t, "double", "float"), DOUBLE),
        (_starts(t, "timestamp"), UTC_DATETIME),
        # "timestamp" is taken above, so this is TIME of day.
        (_starts(t, "time"), STRING),
        (_starts(t, "datetime"), NAIVE_DATETIME),
        (_starts(t, "year"), INT),
        (_starts(t, "varchar", "text", "enum", "char"), STRING),
        (_starts(t, "set", *GEOMETRY_PREFIXES), JSON),
    ]
    rules += [(t == name, logical) for name, logical in EXACT_TYPES.items()]
    chain = F.when(rules[0][0], F.lit(rules[0][1]))
    for test, logical in rules[1:]:
        chain = chain.when(test, F.lit(logical))
    return chain.when(t.isNotNull(), F.lit(STRING))


def label_kind(column_type: Column) -> Column:
    """``enum``, ``set`` or null."""
    t = F.lower(F.trim(column_type))
    return F.when(t.startswith("enum"), F.lit("enum")).when(t.startswith("set"), F.lit("set"))


def parse_labels(column_type: Column) -> Column:
    """The label list of an enum or set; null for other types.

    Quoted labels may hold commas, parentheses and doubled quotes. Text that is
    not a proper quoted list falls back to a plain split at commas.
    """
    begin = F.locate("(", column_type)
    length = F.length(column_type) - F.locate(")", F.reverse(column_type)) - begin
    inside = F.when(
        (begin > 0) & (length > 0), column_type.substr(begin + 1, length)
    )
    quoted = F.transform(
        F.regexp_extract_all(inside, F.lit(r"'((?:[^']|'')*)'"), F.lit(1)),
        lambda label: F.replace(label, F.lit("''"), F.lit("'")),
    )
    well_formed = inside.rlike(r"^\s*'(?:[^']|'')*'\s*(,\s*'(?:[^']|'')*'\s*)*$")
    split = F.transform(
        F.split(F.coalesce(inside, F.lit("")), ","),
        lambda label: F.regexp_replace(label, r"^'+|'+$", ""),
    )
    return F.when(
        label_kind(column_type).isNotNull(),
        F.when(F.coalesce(well_formed, F.lit(False)), quoted).otherwise(split),
    )


def decimal_params(column_type: Column) -> tuple[Column, Column]:
    """T4: (precision, scale) of a decimal text; (10, 0) when it names none.

    ``bigint unsigned`` needs 20 digits. Other types give nulls.
    """
    t = F.lower(column_type)
    first = F.nullif(F.regexp_extract(t, r"(\d+)", 1), F.lit("")).cast("int")
    second = F.nullif(F.regexp_extract(t, r"\d+,(\d+)", 1), F.lit("")).cast("int")
    is_decimal = t.startswith("decimal")
    wide_int = t.startswith("bigint") & t.contains("unsigned")
    precision = F.when(is_decimal, F.coalesce(first, F.lit(DEFAULT_PRECISION))).when(
        wide_int, F.lit(20)
    )
    scale = F.when(is_decimal, F.coalesce(second, F.lit(DEFAULT_SCALE))).when(wide_int, F.lit(0))
    return precision, scale


def spark_ddl(logical: Column, precision: Column, scale: Column) -> Column:
    """T5: the Spark type text of a logical type.

    A decimal wider than Spark's 38 digits keeps its text.
    """
    plain = {
        BOOLEAN: "boolean",
        SHORT: "smallint",
        INT: "int",
        LONG: "bigint",
        FLOAT: "float",
        DOUBLE: "double",
        NAIVE_DATE: "date",
        NAIVE_DATETIME: "timestamp_ntz",
        UTC_DATETIME: "timestamp",
        BINARY: "binary",
    }
    chain = F.when(
        (logical == DECIMAL) & (precision <= SPARK_MAX_PRECISION),
        F.concat(F.lit("decimal("), precision, F.lit(","), scale, F.lit(")")),
    )
    for name, ddl in plain.items():
        chain = chain.when(logical == name, F.lit(ddl))
    return chain.otherwise(F.lit("string"))
