"""Value conversion on single values."""

import datetime as dt
import random
import struct

import pyarrow as pa
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from rowtide.functions import convert as v
from rowtide.functions.geometry import SHAPES as SHAPE_NAMES
from rowtide.functions.geometry import geojson_array, geojson_text, geometry_to_geojson, number_text


def one(spark, value, build, ddl="string"):
    """``build`` over a one-row column, so that Spark runs it, not the optimizer."""
    frame = spark.createDataFrame([(value,)], f"v {ddl}")
    return frame.select(build(F.col("v")).alias("out")).collect()[0].out


def fails(spark, value, build, ddl="string", match=None):
    with pytest.raises(PySparkException, match=match):
        one(spark, value, build, ddl)


@pytest.mark.parametrize(
    "build", [v.to_string, v.to_boolean, v.to_short, v.to_int, v.to_long, v.to_float, v.to_double,
              v.to_decimal, v.to_date, v.to_timestamp_ntz, v.to_timestamp_utc, v.to_json, v.bits_to_long,
              lambda c: v.to_date(c, is_pk=True), lambda c: v.to_timestamp_utc(c, strict=True),
              lambda c: v.enum_label(c, F.array(F.lit("a"))), lambda c: v.set_labels(c, F.array(F.lit("a"))), lambda c: v.set_labels(c, ["a"])],
)
def test_null_stays_null(spark, build):
    assert one(spark, None, build, "binary") is None


def test_boolean(spark):
    assert one(spark, "1", v.to_boolean) is True
    assert one(spark, "0", v.to_boolean) is False
    fails(spark, "2", v.to_boolean, match="cannot read BOOLEAN: 2")
    fails(spark, "true", v.to_boolean)


def test_integers(spark):
    assert one(spark, "-2147483648", v.to_int) == -(2**31)
    fails(spark, "2147483648", v.to_int, match="out of range")
    assert one(spark, "2147483648", lambda c: v.to_int(c, on_overflow="null")) is None
    fails(spark, "abc", lambda c: v.to_int(c, on_overflow="null"))
    fails(spark, "1.5", v.to_long)
    fails(spark, " 1", v.to_long)
    assert one(spark, "9223372036854775807", v.to_long) == 2**63 - 1
    fails(spark, "9223372036854775808", v.to_long)
    assert one(spark, "32767", v.to_short) == 32767
    fails(spark, "40000", v.to_short)


@pytest.mark.parametrize(
    "raw, out",
    [("", 0), ("00", 0), ("7f", 127), ("80", 128), ("ff", 255), ("0100", 256), ("7fffffffffffffff", 2**63 - 1)],
)
def test_bits(spark, raw, out):
    assert one(spark, bytearray.fromhex(raw), v.bits_to_long, "binary") == out


@pytest.mark.parametrize("raw", ["8000000000000000", "ffffffffffffffff", "000000000000000001"])
def test_bits_too_wide(spark, raw):
    fails(spark, bytearray.fromhex(raw), v.bits_to_long, "binary", match="cannot read BIT")


def test_floating(spark):
    assert one(spark, "1.7976931348623157e308", v.to_double) == 1.7976931348623157e308
    assert one(spark, "123.456", v.to_float) == pytest.approx(123.456, rel=1e-6)
    fails(spark, "1e39", v.to_float, match="out of range")
    assert one(spark, "1e39", lambda c: v.to_float(c, on_overflow="null")) is None
    fails(spark, "x", v.to_double)


def test_decimal(spark):
    assert str(one(spark, "1234567890.1234", lambda c: v.to_decimal(c, 20, 4))) == "1234567890.1234"
    wide = "1" * 50
    assert one(spark, wide, lambda c: v.to_decimal(c, 65, 0)) == wide
    fails(spark, "12345678901", v.to_decimal)


def test_dates(spark):
    assert one(spark, "2024-02-29", v.to_date) == dt.date(2024, 2, 29)
    for bad in ("0000-00-00", "2023-02-29", "2004-12", "20041212"):
        assert one(spark, bad, v.to_date) is None
        assert one(spark, bad, lambda c: v.to_date(c, is_pk=True)) == dt.date(1970, 1, 1)
        fails(spark, bad, lambda c: v.to_date(c, strict=True))


def test_times(spark):
    text = "2021-01-19 03:14:07.999999"
    exact = dt.datetime(2021, 1, 19, 3, 14, 7, 999999)
    assert one(spark, text, v.to_timestamp_ntz) == exact
    micros = lambda c: F.unix_micros(v.to_timestamp_utc(c))
    utc = int(exact.replace(tzinfo=dt.timezone.utc).timestamp()) * 10**6 + 999999
    assert one(spark, text, micros) == utc
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert one(spark, text, micros) == utc
        assert one(spark, "x", lambda c: F.unix_micros(v.to_timestamp_utc(c, is_pk=True))) == 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_zero_timestamp(spark):
    zero = "0000-00-00 00:00:00"
    assert one(spark, zero, v.to_timestamp_utc) is None
    assert one(spark, zero, lambda c: F.unix_micros(v.to_timestamp_utc(c, strict=True))) == 0
    fails(spark, "nonsense", lambda c: v.to_timestamp_utc(c, strict=True))
    fails(spark, zero, lambda c: v.to_timestamp_ntz(c, strict=True))


def test_json(spark):
    assert one(spark, "", v.to_json) is None
    assert one(spark, '{"key": "value"}', v.to_json) == '{"key": "value"}'
    assert one(spark, "{'not': 'json'}", v.to_json) == "{'not': 'json'}"


def test_clean_utf8(spark):
    assert one(spark, bytearray("naïve ✓".encode()), v.clean_utf8, "binary") == "naïve ✓"
    assert one(spark, bytearray("naïve".encode("latin-1")), v.clean_utf8, "binary") == "naïve"
    # A cut multi-byte character is read byte by byte too.
    assert one(spark, bytearray("ab✓".encode()[:-1]), v.clean_utf8, "binary") == "abâ\x9c"


@pytest.mark.parametrize(
    "value, out",
    [("0", ""), ("1", "staff"), ("2", "guest"), ("3", "3"), ("-1", "-1"), ("guest", "guest"), ("+2", "guest"),
     ("99999999999999999999", "99999999999999999999"), ("4294967297", "4294967297")],
)
def test_enum(spark, value, out):
    labels = F.array(F.lit("staff"), F.lit("guest"))
    assert one(spark, value, lambda c: v.enum_label(c, labels)) == out


@pytest.mark.parametrize(
    "value, out",
    [("0", ""), ("1", "read"), ("3", "read,write"), ("8", "admin"), ("read,write", "read,write"),
     ("-1", "-1"), ("99999999999999999999", "99999999999999999999")],
)
def test_set(spark, value, out):
    labels = ["read", "write", "delete", "admin"]
    for known in (labels, F.array(*[F.lit(x) for x in labels])):
        assert one(spark, value, lambda c: v.set_labels(c, known)) == out


def test_set_wide_and_unknown(spark):
    labels = [f"slot{i}" for i in range(1, 65)]
    for known in (labels, F.array(*[F.lit(x) for x in labels])):
        assert one(spark, "9223372036854775808", lambda c: v.set_labels(c, known)) == "slot64"
        assert one(spark, "18446744073709551615", lambda c: v.set_labels(c, known)).count(",") == 63
    for known in (labels[:2], F.array(*[F.lit(x) for x in labels[:2]])):
        fails(spark, "4", lambda c: v.set_labels(c, known), match="bit without label")
        assert one(spark, "3", lambda c: v.set_labels(c, known, as_json=True)) == '["slot1","slot2"]'


def test_unknown_type():
    with pytest.raises(ValueError, match="no converter"):
        v.converter("INTERVAL")


# --- geometry ----------------------------------------------------------------------------

def wkb(code, *parts, order="<"):
    return (b"\x01" if order == "<" else b"\x00") + struct.pack(order + "I", code) + b"".join(parts)


def pts(*xy, order="<"):
    return b"".join(struct.pack(order + "2d", *p) for p in xy)


def n(k, order="<"):
    return struct.pack(order + "I", k)


RING = [(0, 0), (4, 0), (4, 4), (0, 0)]
SHAPES = [
    (wkb(1, pts((-71.0625, 42.358056))), '{"type":"Point","coordinates":[-71.0625,42.358056]}'),
    (wkb(1, pts((1.5, -2), order=">"), order=">"), '{"type":"Point","coordinates":[1.5,-2]}'),
    (wkb(2, n(2), pts((0, 0), (10, 25))), '{"type":"LineString","coordinates":[[0,0],[10,25]]}'),
    (wkb(3, n(1), n(4), pts(*RING)), '{"type":"Polygon","coordinates":[[[0,0],[4,0],[4,4],[0,0]]]}'),
    (wkb(4, n(2), wkb(1, pts((0, 0))), wkb(1, pts((20, 20)))),
     '{"type":"MultiPoint","coordinates":[[0,0],[20,20]]}'),
    (wkb(5, n(1), wkb(2, n(2), pts((1, 1), (2, 2)))),
     '{"type":"MultiLineString","coordinates":[[[1,1],[2,2]]]}'),
    (wkb(6, n(1), wkb(3, n(1), n(4), pts(*RING))),
     '{"type":"MultiPolygon","coordinates":[[[[0,0],[4,0],[4,4],[0,0]]]]}'),
    (wkb(7, n(2), wkb(1, pts((10, 10))), wkb(2, n(2), pts((5, 5), (6, 6)))),
     '{"type":"GeometryCollection","geometries":[{"type":"Point","coordinates":[10,10]},'
     '{"type":"LineString","coordinates":[[5,5],[6,6]]}]}'),
]


def test_geometry(spark):
    rows = [(bytearray(b"\0\0\0\0" + raw), want) for raw, want in SHAPES] + [(None, None)]
    frame = spark.createDataFrame(rows, "raw binary, want string")
    got = frame.select("want", geometry_to_geojson(F.col("raw")).alias("got")).collect()
    assert all(r.got == r.want for r in got) and len(got) == len(SHAPES) + 1


def drawn_shape(draw, code, depth=0):
    """A shape of the format and its coordinates or members as plain values."""
    order = draw.choice("<>")
    point = lambda: (draw.choice([0.0, -0.0, 1e10, 1e-7, 3.0, draw.uniform(-180, 180)]), draw.uniform(-1e12, 1e12))
    some = [point() for _ in range(draw.randint(0, 4))]
    if code == 1:
        p = point()
        return wkb(1, pts(p, order=order), order=order), list(p)
    if code == 2:
        return wkb(2, n(len(some), order), pts(*some, order=order), order=order), [list(p) for p in some]
    k = draw.randint(0, 3)
    if code == 3:
        rings = [[point() for _ in range(draw.randint(0, 4))] for _ in range(k)]
        body = b"".join(n(len(r), order) + pts(*r, order=order) for r in rings)
        return wkb(3, n(k, order), body, order=order), [[list(p) for p in r] for r in rings]
    inner = [draw.randint(1, 7 if depth < 2 else 3) if code == 7 else code - 3 for _ in range(k)]
    parts = [drawn_shape(draw, c, depth + 1) for c in inner]
    values = [as_object(c, v) if code == 7 else v for c, (_, v) in zip(inner, parts)]
    return wkb(code, n(k, order), *[raw for raw, _ in parts], order=order), values


def as_object(code, values):
    return {"type": SHAPE_NAMES[code], "geometries" if code == 7 else "coordinates": values}


def json_of(value):
    if isinstance(value, dict):
        return "{" + ",".join(f'"{k}":{json_of(v) if k != "type" else chr(34) + v + chr(34)}' for k, v in value.items()) + "}"
    return "[" + ",".join(map(json_of, value)) + "]" if isinstance(value, list) else number_text(value)


def test_drawn_shapes_in_one_batch():
    draw = random.Random(11)
    codes = [draw.randint(1, 7) for _ in range(600)]
    drawn = [drawn_shape(draw, c) for c in codes]
    values = [x for raw, _ in drawn for x in (b"srid" + raw, None)][1:]
    want = [x for c, (_, v) in zip(codes, drawn) for x in (json_of(as_object(c, v)), None)][1:]
    assert geojson_array(pa.array(values, pa.binary())).to_pylist() == want
    assert geojson_array(pa.array(values, pa.binary())[7:]).to_pylist() == want[7:]
    assert geojson_array(pa.array([None, None], pa.binary())).to_pylist() == [None, None]
    # A value that ends too early is an error, whatever stands behind it in the batch.
    for raw, _ in drawn[:60]:
        for cut in range(5, len(raw)):
            with pytest.raises(ValueError):
                geojson_array(pa.array([b"srid" + raw[:cut], b"srid" + raw], pa.binary()))


@pytest.mark.parametrize("raw", [b"", b"\0\0\0\0", b"\0\0\0\0" + wkb(9)])
def test_bad_geometry(raw):
    with pytest.raises(Exception):
        geojson_text(raw)


@pytest.mark.parametrize(
    "x, text", [(0.0, "0"), (-0.0, "-0"), (1e20, "100000000000000000000"), (1e21, "1e+21"), (1e-7, "1e-7"),
                (0.000001, "0.000001"), (1.25e-9, "1.25e-9"), (123456789.125, "123456789.125")],
)
def test_number_text(x, text):
    assert number_text(x) == text
