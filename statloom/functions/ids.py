"""Fingerprints and the identifiers made from them."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import LongType, StringType

_K0, _K1, _K2 = np.uint64(0xC3A5C85C97CB3127), np.uint64(0xB492B66FBE98F273), np.uint64(0x9AE16A3B2F90404F)
ALPHABET = "0123456789bcdfghjklmnpqrstvwxyze"


def _u(x: int) -> np.uint64:
    return np.uint64(x & 0xFFFFFFFFFFFFFFFF)


def _rot(x: np.ndarray, n: int) -> np.ndarray:
    return (x >> _u(n)) | (x << _u(64 - n))


def _shift_mix(x: np.ndarray) -> np.ndarray:
    return x ^ (x >> _u(47))


def _pair(u, v, mul):
    a = _shift_mix((u ^ v) * mul)
    return _shift_mix((v ^ a) * mul) * mul


class _Rows:
    """Equally long byte strings as a matrix; reads little-endian words at an offset from either end."""

    def __init__(self, raw: np.ndarray) -> None:
        self.raw, self.n = raw, raw.shape[1]

    def at(self, i: int, width: int = 8) -> np.ndarray:
        i = i + self.n if i < 0 else i
        part = np.ascontiguousarray(self.raw[:, i : i + width])
        return part.view(f"<u{width}")[:, 0].astype(np.uint64)


def _weak(r: _Rows, i: int, a, b):
    w, x, y, z = (r.at(i + k) for k in (0, 8, 16, 24))
    a = a + w
    b = _rot(b + a + z, 21)
    c = a
    a = a + x + y
    return a + z, b + _rot(a, 44) + c


def _long(r: _Rows) -> np.ndarray:
    n = r.n
    x = np.full(len(r.raw), 81, np.uint64)
    y = x * _K1 + _u(113)
    z = _shift_mix(y * _K2 + _u(113)) * _K2
    zero = np.zeros(len(x), np.uint64)
    v, w = (zero, zero), (zero, zero)
    x = x * _K2 + r.at(0)

    def turn(i, x, y, z, v, w, mul, by):
        x = _rot(x + y + v[0] + r.at(i + 8), 37) * mul
        y = _rot(y + v[1] + r.at(i + 48), 42) * mul
        x = x ^ (w[1] * _u(by))
        y = y + v[0] * _u(by) + r.at(i + 40)
        z = _rot(z + w[0], 33) * mul
        v = _weak(r, i, v[1] * mul, x + w[0])
        w = _weak(r, i + 32, z + w[1], y + r.at(i + 16))
        return z, y, x, v, w

    for i in range(0, (n - 1) // 64 * 64, 64):
        x, y, z, v, w = turn(i, x, y, z, v, w, _K1, 1)
    mul = _K1 + ((z & _u(0xFF)) << _u(1))
    w = (w[0] + _u((n - 1) & 63), w[1])
    v = (v[0] + w[0], v[1])
    w = (w[0] + v[0], w[1])
    x, y, z, v, w = turn(n - 64, x, y, z, v, w, mul, 9)
    return _pair(_pair(v[0], w[0], mul) + _shift_mix(y) * _K0 + z, _pair(v[1], w[1], mul) + x, mul)


def _of_length(raw: np.ndarray) -> np.ndarray:
    r, n = _Rows(raw), raw.shape[1]
    mul = _K2 + _u(2 * n)
    if n == 0:
        return np.full(len(raw), _K2)
    if n < 4:
        a, b, c = (raw[:, i].astype(np.uint64) for i in (0, n >> 1, n - 1))
        return _shift_mix((a + (b << _u(8))) * _K2 ^ (_u(n) + (c << _u(2))) * _K0) * _K2
    if n < 8:
        return _pair(_u(n) + (r.at(0, 4) << _u(3)), r.at(-4, 4), mul)
    if n <= 16:
        a, b = r.at(0) + _K2, r.at(-8)
        return _pair(_rot(b, 37) * mul + a, (_rot(a, 25) + b) * mul, mul)
    if n <= 32:
        a, b, c, d = r.at(0) * _K1, r.at(8), r.at(-8) * mul, r.at(-16) * _K2
        return _pair(_rot(a + b, 43) + _rot(c, 30) + d, a + _rot(b + _K2, 18) + c, mul)
    if n <= 64:
        a, b, c, d = r.at(0) * _K2, r.at(8), r.at(-8) * mul, r.at(-16) * _K2
        y = _rot(a + b, 43) + _rot(c, 30) + d
        z = _pair(y, a + _rot(b + _K2, 18) + c, mul)
        e, f = r.at(16) * mul, r.at(24)
        g, h = (y + r.at(-32)) * mul, (z + r.at(-24)) * mul
        return _pair(_rot(e + f, 43) + _rot(g, 30) + h, e + _rot(f + a, 18) + g, mul)
    return _long(r)


def farm_fingerprints(texts: list[str | None]) -> list[int | None]:
    """Signed 64-bit FarmHash fingerprints (the portable variant), vectorised over texts of equal length."""
    out: list[int | None] = [None] * len(texts)
    by: dict[int, list[tuple[int, bytes]]] = {}
    for i, t in enumerate(texts):
        if t is not None:
            b = t.encode()
            by.setdefault(len(b), []).append((i, b))
    with np.errstate(over="ignore"):
        for n, items in by.items():
            raw = np.frombuffer(b"".join(b for _, b in items), np.uint8).reshape(len(items), n)
            for (i, _), h in zip(items, _of_length(raw).view(np.int64).tolist()):
                out[i] = h
    return out


def base32(fingerprint: int) -> str:
    """Least significant five bits first, until nothing is left."""
    x, out = fingerprint & 0xFFFFFFFFFFFFFFFF, ""
    while x:
        out += ALPHABET[x & 31]
        x >>= 5
    return out or ALPHABET[0]


@pandas_udf(LongType())
def fingerprint(s: pd.Series) -> pd.Series:
    return pd.Series(farm_fingerprints([None if pd.isna(x) else x for x in s]), dtype="Int64")


@pandas_udf(StringType())
def generated_id(s: pd.Series) -> pd.Series:
    return pd.Series([None if h is None else "dc/" + base32(h) for h in farm_fingerprints([None if pd.isna(x) else x for x in s])], dtype="object")


def _joined(*columns: str) -> Column:
    return F.concat_ws("^", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])


def with_facet_id(points: DataFrame) -> DataFrame:
    """Facet id of derived series: the signed fingerprint of provenance, method, period, scaling, unit and flag.

    Facets are few, so they are hashed once each and joined back instead of once for every point."""
    names = ["provenance", "method", "period", "scaling", "unit", "is_aggregate"]
    distinct = points.select(*names).distinct()
    known = distinct.select(*names, fingerprint(_joined(*names)).cast("string").alias("facet_id"))
    on = None
    right = known.select(*[F.col(n).alias(f"__{n}") for n in names], "facet_id")
    for n in names:
        c = F.col(n).eqNullSafe(F.col(f"__{n}"))
        on = c if on is None else on & c
    return points.join(right, on).drop(*[f"__{n}" for n in names])


def ingested_facet_text(import_name: str, method: str, period: str, scaling: str, unit: str, plain: str = "PlainAggregate") -> Column:
    """What the facet id of read series is hashed from: the import's bare name, the method without its aggregate mark."""
    m = F.coalesce(F.col(method), F.lit(""))
    aggregate = m.startswith("dcAggregate/") | (m == plain)
    bare = F.when(m == plain, "").otherwise(F.regexp_replace(m, "^dcAggregate/", ""))
    rest = [F.coalesce(F.col(c), F.lit("")) for c in (period, scaling, unit)]
    return F.concat_ws("^", F.coalesce(F.col(import_name), F.lit("")), bare, *rest, F.when(aggregate, "true").otherwise("false"))


@pandas_udf(StringType())
def unsigned_fingerprint(s: pd.Series) -> pd.Series:
    return pd.Series([None if h is None else str(h & 0xFFFFFFFFFFFFFFFF) for h in farm_fingerprints([None if pd.isna(x) else x for x in s])], dtype="object")


def literal_key(value, trim: bool = True, as_hex: bool = False) -> Column:
    """Key of a literal's node: its first 16 characters, a colon and the SHA-256 of it (nothing for an empty text)."""
    v = F.col(value) if isinstance(value, str) else value
    v = F.trim(v) if trim else v
    digest = F.sha2(v.cast("binary"), 256)
    digest = digest if as_hex else F.base64(F.unhex(digest))
    return F.concat(F.substring(v, 1, 16), F.lit(":"), F.when(v == "", "").otherwise(digest))


FIXED = ["populationType", "measuredProperty", "statType", "measurementQualifier", "measurementDenominator"]


def variable_key(pairs) -> Column:
    """Sorted ``p=v`` text of a map of properties."""
    m = F.col(pairs) if isinstance(pairs, str) else pairs
    return F.array_join(F.array_sort(F.transform(F.map_entries(m), lambda e: F.concat(e["key"], F.lit("="), e["value"]))), ",")


def place_id(columns: dict[str, str]) -> Column:
    """First available external id as ``prop/value``; columns in order of priority."""
    renamed = {"isoCode": "iso", "nutsCode": "nuts"}
    return F.coalesce(*[F.when(F.col(c) != "", F.concat(F.lit(renamed.get(p, p) + "/"), F.col(c))) for p, c in columns.items()])
