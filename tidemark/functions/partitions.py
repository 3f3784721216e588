"""Partition values as folder names, and partition transforms."""

from __future__ import annotations

import struct

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

NULL, EMPTY = "__null__", "__empty__"
#: Device names that some file systems reserve (fixed values).
RESERVED = {"con", "prn", "aux", "nul", *(f"com{i}" for i in range(1, 10)), *(f"lpt{i}" for i in range(1, 10))}


def encode_value(value: str | None) -> str:
    """A partition value as a folder name; no two values share one. Letters, digits and - stand for themselves, _ and .
    too unless they come first; any other byte becomes %XX. Reserved names have their first character escaped."""
    if value is None:
        return NULL
    if value == "":
        return EMPTY
    plain = lambda i, b: chr(b).isascii() and (chr(b).isalnum() or b == 0x2D or (i and b in b"_."))
    out = "".join(chr(b) if plain(i, b) else f"%{b:02X}" for i, b in enumerate(value.encode()))
    if out.split(".")[0].lower() in RESERVED:
        out = f"%{ord(out[0]):02X}{out[1:]}"
    return out


def encode_partition(column: Column) -> Column:
    """encode_value() of a column, in the JVM: the UTF-8 bytes as hexadecimal pairs, those of plain characters turned back."""
    text = column.cast("string")
    pairs = F.regexp_extract_all(F.hex(F.encode(text, "UTF-8")), F.lit("(..)"), F.lit(1))
    plain = r"^(2D|3[0-9]|4[1-9A-F]|5[0-9A]|6[1-9A-F]|7[0-9A])$"
    one = lambda x, i: F.when(x.rlike(plain) | ((i > 0) & x.isin("5F", "2E")), F.decode(F.unhex(x), "UTF-8")).otherwise(F.concat(F.lit("%"), x))
    out = F.array_join(F.transform(pairs, one), "")
    reserved = F.lower(F.substring_index(out, ".", 1)).isin(*sorted(RESERVED))
    out = F.when(reserved, F.concat(F.lit("%"), F.hex(F.encode(F.substring(out, 1, 1), "UTF-8")), F.substring(out, 2, 1 << 30))).otherwise(out)
    return F.when(text.isNull(), NULL).when(text == "", EMPTY).otherwise(out)


def murmur3(data: bytes) -> int:
    """MurmurHash3, 32 bits for x86, seed 0 (a public algorithm; its constants are fixed values)."""
    h, n = 0, len(data)
    mask = 0xFFFFFFFF
    rot = lambda x, r: ((x << r) | (x >> (32 - r))) & mask
    mix = lambda k: rot(k * 0xCC9E2D51 & mask, 15) * 0x1B873593 & mask
    for i in range(0, n - n % 4, 4):
        h = (rot(h ^ mix(struct.unpack_from("<I", data, i)[0]), 13) * 5 + 0xE6546B64) & mask
    if tail := data[n - n % 4 :]:
        h ^= mix(int.from_bytes(tail, "little"))
    h ^= n
    h = (h ^ h >> 16) * 0x85EBCA6B & mask
    h = (h ^ h >> 13) * 0xC2B2AE35 & mask
    return h ^ h >> 16


def murmur3_columns(words: list[np.ndarray], length: int) -> np.ndarray:
    """murmur3() of many values of the same length at once: words are their 4-byte blocks, the last one with the bytes left."""
    rot = lambda x, r: (x << np.uint32(r)) | (x >> np.uint32(32 - r))
    h = np.zeros(len(words[0]) if words else 0, dtype=np.uint32)
    for i, k in enumerate(words):
        k = rot(k * np.uint32(0xCC9E2D51), 15) * np.uint32(0x1B873593)
        h = rot(h ^ k, 13) * np.uint32(5) + np.uint32(0xE6546B64) if 4 * i + 4 <= length else h ^ k
    h ^= np.uint32(length)
    h = (h ^ h >> np.uint32(16)) * np.uint32(0x85EBCA6B)
    h = (h ^ h >> np.uint32(13)) * np.uint32(0xC2B2AE35)
    return h ^ h >> np.uint32(16)


def hashes(values: list[bytes]) -> np.ndarray:
    """murmur3() of each value, those of a length together."""
    sizes, out = np.array([len(v) for v in values]), np.zeros(len(values), dtype=np.uint32)
    for n in np.unique(sizes).tolist():
        at = np.flatnonzero(sizes == n)
        wide = -(-n // 4) * 4
        block = np.frombuffer(b"".join(values[k].ljust(wide, b"\0") for k in at.tolist()), dtype="<u4").reshape(len(at), wide // 4)
        out[at] = murmur3_columns([np.ascontiguousarray(block[:, i]) for i in range(wide // 4)], n) if n else murmur3(b"")
    return out


def bucket(column: Column, n: int) -> Column:
    """The hash bucket of integers (as 8 little-endian bytes) or strings (UTF-8); null stays null."""
    if n < 1:
        raise ValueError("a bucket transform needs n of at least 1")

    @F.pandas_udf("int")
    def run(values: pd.Series) -> pd.Series:
        out = pd.Series(pd.NA, index=values.index, dtype="Int32")
        there = values.notna()
        real = values[there]
        if len(real):
            if isinstance(real.iloc[0], str):
                found = hashes([v.encode() for v in real])
            else:
                whole = real.to_numpy().astype("<i8").view("<u4").reshape(-1, 2)
                found = murmur3_columns([np.ascontiguousarray(whole[:, i]) for i in (0, 1)], 8)
            out[there] = ((found & np.uint32(0x7FFFFFFF)) % np.uint32(n)).astype(np.int32)
        return out

    return run(column)


def truncate(column: Column, width: int, text: bool) -> Column:
    """The first width characters of a string, or a number less its remainder."""
    if width < 1:
        raise ValueError("a truncate transform needs a width of at least 1")
    return F.substring(column, 1, width) if text else column - F.pmod(column, F.lit(width))


def transform(name: str, column: str, parameter: int | None = None, text: bool = False) -> Column:
    """A named transform: identity, year, month, day, hour, bucket or truncate."""
    c = F.col(column)
    if name == "identity":
        return c
    if name in ("year", "month", "day", "hour"):
        return F.date_trunc(name, c).alias(f"{column}_{name}")
    if name == "bucket":
        return bucket(c, parameter).alias(f"{column}_bucket")
    if name == "truncate":
        return truncate(c, parameter, text).alias(f"{column}_trunc")
    raise ValueError(f"no transform {name}")
