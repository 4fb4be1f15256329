"""Canonical, length-prefixed encodings and their SHA-256 digests as Catalyst expressions.

An encoding is built as hexadecimal text and turned into bytes once, inside the
hash, so the whole digest stays in generated code.  Doubles and vectors have no
native byte form in Spark; ``vector_hex`` packs them in an Arrow UDF.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Tags of encoded values: null, bool, long, double, string, bytes, timestamp, map, list.
TAGS = {"null": "6e", "bool": "62", "long": "69", "double": "66", "string": "73", "bytes": "79", "timestamp": "74", "map": "6d", "list": "6c"}
EVENT_HEADER = "tidemark-event-1"
SOURCE_HEADER = "tidemark-source-1"
EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def micros(ts: str) -> Column:
    """Epoch microseconds of a zoneless timestamp taken as UTC."""
    return F.expr(f"timestampdiff(MICROSECOND, {EPOCH}, cast({ts} as timestamp_ntz))")


def long_hex(x: Column) -> Column:
    """Eight big-endian bytes, two's complement."""
    return F.lpad(F.hex(x.cast("long")), 16, "0")


def text_hex(x: Column) -> Column:
    """UTF-8 bytes after their length."""
    return F.concat(long_hex(F.octet_length(x)), F.hex(F.encode(x, "utf-8")))


def value_hex(x: Column, kind: str) -> Column:
    """A tagged value; null has a tag of its own."""
    body = {
        "string": lambda: text_hex(x),
        "long": lambda: long_hex(x),
        "bool": lambda: F.when(x, "01").otherwise("00"),
        "bytes": lambda: F.concat(long_hex(F.octet_length(x)), F.hex(x)),
        "timestamp": lambda: long_hex(x),
        "list": lambda: vector_hex(x),
    }[kind]()
    return F.when(x.isNull(), F.lit(TAGS["null"])).otherwise(F.concat(F.lit(TAGS[kind]), body))


def mapping_hex(fields: dict[str, tuple[Column, str]]) -> Column:
    """A map with keys known in advance, in the order of their UTF-8 bytes."""
    keys = sorted(fields, key=lambda k: k.encode())
    parts = [F.lit(TAGS["map"] + f"{len(keys):016X}")]
    for k in keys:
        raw = k.encode()
        parts += [F.lit(f"{len(raw):016X}" + raw.hex().upper()), value_hex(*fields[k])]
    return F.concat(*parts)


def vector_hex(v: Column) -> Column:
    """The body of a list of doubles: its length, then each as a tagged big-endian double."""
    tag = TAGS["double"]

    def encode(column: pd.Series) -> pd.Series:  # self-contained, so that executors need not have this package
        def one(x) -> str | None:
            if x is None:
                return None
            a = np.asarray(x, np.float64)
            if not np.isfinite(a).all():
                raise ValueError("a vector with a value that is not finite has no digest")
            raw = a.astype(">f8").tobytes().hex().upper()
            return f"{len(a):016X}" + "".join([tag + raw[i : i + 16] for i in range(0, len(raw), 16)])

        return column.map(one)

    return F.pandas_udf(encode, T.StringType())(v)


def event_digest(route: tuple[str, ...], key: str, op: Column, ts: str, fields: dict[str, tuple[Column, str]]) -> Column:
    """SHA-256 (hex) of route, key, operation, time and payload; how a row was delivered has no part in it."""
    parts = [F.lit(EVENT_HEADER.encode().hex().upper()), *(text_hex(F.col(c)) for c in (*route, key)), text_hex(op), long_hex(micros(ts)), mapping_hex(fields)]
    return F.sha2(F.unhex(F.concat(*parts)), 256)


def source_digest(key: str, sequence: str, digest: str) -> Column:
    """An aggregate: SHA-256 (hex) of all (key, sequence, digest) of a route in the order of the keys' bytes."""
    entry = F.struct(F.encode(F.col(key), "utf-8").alias("k"), F.concat(text_hex(F.col(key)), long_hex(F.col(sequence)), F.upper(F.col(digest))).alias("e"))
    ordered = F.sort_array(F.collect_list(entry))
    return F.sha2(F.unhex(F.concat(F.lit(SOURCE_HEADER.encode().hex().upper()), F.array_join(F.transform(ordered, lambda x: x["e"]), ""))), 256)
