"""Geometry bytes -> GeoJSON text.

Spark reads WKB but writes no GeoJSON, so this is the one conversion that runs
in Python: an Arrow function over the binary column. A batch is read as one buffer, all
shapes of a kind at once: first their heads, then the members of each, first ones first.
Numbers become texts as one array, and texts are joined level by level along offsets.
"""

from __future__ import annotations

from decimal import Decimal
from math import isfinite

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# The shape codes of the WKB format and their GeoJSON names.
SHAPES = {
    1: "Point",
    2: "LineString",
    3: "Polygon",
    4: "MultiPoint",
    5: "MultiLineString",
    6: "MultiPolygon",
    7: "GeometryCollection",
}
SRID_BYTES = 4


def number_text(x: float) -> str:
    """JSON text of a coordinate: shortest digits, no trailing ``.0``."""
    text = repr(x)
    if text.endswith(".0"):
        return text[:-2]
    if "e" not in text:
        if not isfinite(x):
            raise ValueError(f"not a coordinate: {x}")
        return text
    if 1e-6 <= abs(x) < 1e21:
        return format(Decimal(text), "f")
    digits, exponent = text.split("e")
    return f"{digits}e{exponent[0]}{exponent[1:].lstrip('0')}"


def _number_texts(x: np.ndarray) -> pa.Array:
    """``number_text`` of an array; Arrow writes numbers of middling size by the same rule."""
    texts, size = pa.array(x).cast(pa.string()), np.abs(x)
    odd = np.flatnonzero(~(((size >= 1e-4) & (size < 1e10)) | (size == 0)))
    if not len(odd):
        return texts
    own = pa.array([number_text(v) for v in x[odd].tolist()], pa.string())
    place = np.arange(len(x))
    place[odd] = len(x) + np.arange(len(odd))
    return pa.concat_arrays([texts, own]).take(pa.array(place))


def _glue(*parts: pa.Array | str) -> pa.Array:
    return pc.binary_join_element_wise(*[pa.scalar(p) if isinstance(p, str) else p for p in parts], "")


def _listed(texts: pa.Array, counts: np.ndarray) -> pa.Array:
    """Texts that stand one behind another, so many to a list, as JSON lists."""
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return _glue("[", pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), texts), ","), "]")


def _runs(counts: np.ndarray) -> np.ndarray:
    """0, 1, ... for each count."""
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)


class _Buffer:
    """The bytes of a batch; every read is held against the end of its own value."""

    def __init__(self, data: np.ndarray):
        self.data = data

    def check(self, ends: np.ndarray, limit: np.ndarray) -> None:
        if (ends > limit).any():
            raise ValueError("a geometry value ends too early")

    def counts(self, at: np.ndarray, big: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """The unsigned numbers of four bytes at these places."""
        self.check(at + 4, limit)
        raw = sliding_window_view(self.data, 4)[at].view("<u4")[:, 0]
        return np.where(big, raw.byteswap(), raw).astype(np.int64)

    def points(self, at: np.ndarray, big: np.ndarray, n: np.ndarray, limit: np.ndarray) -> pa.Array:
        """``n`` points from each place on, one text for each point."""
        self.check(at + 16 * n, limit)
        starts = np.repeat(at, n) + 16 * _runs(n)
        if not len(starts):
            return pa.array([], pa.string())
        raw = sliding_window_view(self.data, 16)[starts].view("<f8")
        xy = np.where(np.repeat(big, n)[:, None], raw.byteswap(), raw)
        return _glue("[", _number_texts(xy[:, 0].copy()), ",", _number_texts(xy[:, 1].copy()), "]")

    def lines(self, at: np.ndarray, big: np.ndarray, limit: np.ndarray) -> tuple[pa.Array, np.ndarray]:
        """Lists of points behind their number: texts and next places."""
        n = self.counts(at, big, limit)
        return _listed(self.points(at + 4, big, n, limit), n), at + 4 + 16 * n

    def shapes(self, at: np.ndarray, limit: np.ndarray) -> tuple[np.ndarray, pa.Array, np.ndarray]:
        """Shape codes, coordinates or members as JSON texts, and next places of the shapes that begin here."""
        self.check(at + 5, limit)
        big = self.data[at] != 1
        code = self.counts(at + 1, big, limit)
        ends, order, texts = at.copy(), [], []
        for c in np.unique(code).tolist():
            if c not in SHAPES:
                raise ValueError(f"unknown shape code {c}")
            own = np.flatnonzero(code == c)
            text, ends[own] = self.of_code(c, at[own] + 5, big[own], limit[own])
            order.append(own)
            texts.append(text)
        if not texts:
            return code, pa.array([], pa.string()), ends
        return code, pa.concat_arrays(texts).take(pa.array(np.argsort(np.concatenate(order)))), ends

    def of_code(self, code: int, at: np.ndarray, big: np.ndarray, limit: np.ndarray) -> tuple[pa.Array, np.ndarray]:
        if code == 1:
            return self.points(at, big, np.ones(len(at), np.int64), limit), at + 16
        if code == 2:
            return self.lines(at, big, limit)
        members = self.counts(at, big, limit)
        at = at + 4
        # A ring takes four bytes at least, a point of many 21, any other member nine.
        self.check(at + members * (4 if code == 3 else 21 if code == 4 else 9), limit)
        if code == 4:  # members of one size: all at once
            inner, texts, _ = self.shapes(np.repeat(at, members) + 21 * _runs(members), np.repeat(limit, members))
            if (inner != 1).any():
                raise ValueError("a MultiPoint of other shapes than points")
            return _listed(texts, members), at + 21 * members
        owners, texts = [np.zeros(0, np.int64)], [pa.array([], pa.string())]
        for k in range(int(members.max(initial=0))):
            on = np.flatnonzero(members > k)
            if code == 3:
                text, at[on] = self.lines(at[on], big[on], limit[on])
            else:
                inner, text, at[on] = self.shapes(at[on], limit[on])
                text = _objects(inner, text) if code == 7 else text
            owners.append(on)
            texts.append(text)
        by_owner = np.argsort(np.concatenate(owners), kind="stable")
        return _listed(pa.concat_arrays(texts).take(pa.array(by_owner)), members), at


def _objects(codes: np.ndarray, texts: pa.Array) -> pa.Array:
    heads = [f'{{"type":"{name}","{"geometries" if c == 7 else "coordinates"}":' for c, name in sorted(SHAPES.items())]
    return _glue(pa.array(heads).take(pa.array(codes - 1)), texts, "}")


def geojson_array(values: pa.Array) -> pa.Array:
    """GeoJSON of a batch: the SRID prefix of each value is dropped, the rest is WKB."""
    some = values.drop_null().cast(pa.large_binary())
    if not len(some):
        return pa.nulls(len(values), pa.string())
    _, offsets, data = some.buffers()
    places = np.frombuffer(offsets, np.int64)[some.offset : some.offset + len(some) + 1]
    begin, limit = places[:-1], places[1:]
    if (limit - begin <= SRID_BYTES).any():
        raise ValueError("invalid geometry value: nothing behind its prefix")
    codes, texts, _ = _Buffer(np.frombuffer(data, np.uint8)).shapes(begin + SRID_BYTES, limit)
    valid = np.asarray(values.is_valid())
    return _objects(codes, texts).take(pa.array(np.cumsum(valid) - 1, mask=~valid))


def geojson_text(raw: bytes | None) -> str | None:
    """GeoJSON of one value."""
    return geojson_array(pa.array([raw], pa.binary()))[0].as_py()


@F.arrow_udf(StringType())
def _geojson(raw: pa.Array) -> pa.Array:
    return geojson_array(raw)


def geometry_to_geojson(raw: Column) -> Column:
    """Null stays null, a value that is no shape is an error."""
    return _geojson(raw.cast("binary"))
