"""Schemas of the game-event data model and its default profiles.

The event is a nested record (session, frame counter, type, frame time, actor, optional
target).  Times inside the record are session-relative milliseconds; event time for
windows is the record (Kafka) timestamp of the envelope, not ``frame.millis``.
"""

from __future__ import annotations

from pyspark.sql import types as T

POSITION = T.StructType([
    T.StructField("x", T.LongType()),
    T.StructField("y", T.LongType()),
    T.StructField("z", T.LongType()),
    T.StructField("angle", T.LongType()),
    T.StructField("subsector", T.LongType()),
])

ACTOR = T.StructType([
    T.StructField("position", POSITION),
    T.StructField("type", T.StringType()),
    T.StructField("health", T.IntegerType()),
    T.StructField("armor", T.IntegerType()),
    T.StructField("id", T.LongType()),
])

FRAME = T.StructType([
    T.StructField("millis", T.LongType()),
    T.StructField("tic", T.IntegerType()),
])

EVENT = T.StructType([
    T.StructField("session", T.StringType()),
    T.StructField("counter", T.LongType()),
    T.StructField("type", T.StringType()),
    T.StructField("damage", T.LongType()),
    T.StructField("frame", FRAME),
    T.StructField("actor", ACTOR),
    T.StructField("target", ACTOR),
])

METRIC = T.StructType([
    T.StructField("session", T.StringType()),
    T.StructField("metric", T.StringType()),
    T.StructField("value", T.DoubleType()),
])

# ---------------------------------------------------------------------------
# These must equal the reference's defaults for equal results.
# ---------------------------------------------------------------------------
# "sentinel" profile: what the Java model holds for a member absent from the JSON.
LONG_MAX = 9223372036854775807
INT_MAX = 2147483647
UNKNOWN_SESSION = "UNKNOWN_SESSION"
UNKNOWN_TYPE = "UNKNOWN_TYPE"
# Scale of frame time: 35 tics per second (11829 ms <-> tic 414 in the schema example).
TICS_PER_SECOND = 35
# "schema" profile: the JSON Schema's `default` keywords -- "" for strings, 0 for
# numbers, {} for objects (whose members then take their own defaults).
# Members the JSON Schema lists as required, per object path.
REQUIRED_MEMBERS = {
    "": ("counter", "session", "type", "frame", "actor"),
    "frame": ("millis", "tic"),
    "actor": ("type", "id"),
    "actor.position": ("x", "y", "z", "angle", "subsector"),
    "target": ("type", "id"),
    "target.position": ("x", "y", "z", "angle", "subsector"),
}
# ---------------------------------------------------------------------------


def leaf_paths(schema: T.StructType = EVENT, prefix: str = ""):
    """Yield (dotted path, data type) for every leaf of a nested struct."""
    for f in schema.fields:
        path = f"{prefix}{f.name}"
        if isinstance(f.dataType, T.StructType):
            yield from leaf_paths(f.dataType, path + ".")
        else:
            yield path, f.dataType


def object_paths(schema: T.StructType = EVENT, prefix: str = ""):
    """Yield the dotted path of every nested object (struct) member."""
    for f in schema.fields:
        if isinstance(f.dataType, T.StructType):
            path = f"{prefix}{f.name}"
            yield path
            yield from object_paths(f.dataType, path + ".")


def sentinel_value(path: str, dtype: T.DataType):
    """Value of the sentinel profile for a leaf."""
    if isinstance(dtype, T.StringType):
        return UNKNOWN_SESSION if path == "session" else UNKNOWN_TYPE
    if isinstance(dtype, T.IntegerType):
        return INT_MAX
    return LONG_MAX


def schema_default_value(path: str, dtype: T.DataType):
    """Value of the JSON Schema profile for a leaf."""
    if isinstance(dtype, T.StringType):
        return ""
    return 0
