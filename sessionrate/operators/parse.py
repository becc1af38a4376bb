"""JSON text -> typed game events, plus the record-level checks around it.

One rule for all default profiles.  A record is a *reject* when its text is not one JSON
object -- malformed, cut, or followed by more text; an array or a scalar -- or when a member
of the schema has the wrong type: a number member that is not a whole JSON number in range
(``"12"``, ``1.5``, ``true`` and 99999999999 for an INT are wrong), an object member that is
not an object.  A string member takes any other JSON value as its text.  Of a repeated
member name the last one counts.  JSON ``null``, blank and missing text is a NULL event, not
a reject; a JSON null member is a NULL (``sentinel``: see below).

The text is parsed once by ``from_json`` into the nested struct.  It is wrapped first,
``{"e": <text>, "end": 1}``, so text after the object breaks the parse or hides ``end``.
``try_parse_json`` (VARIANT) is used besides only where *absent* and *JSON null* must be
told apart: the ``sentinel`` profile and the schema checks.

Output of :func:`parse_events`: the input columns except the raw text, the event's
members as top-level columns (``session, counter, type, damage, frame, actor,
target``) and ``_corrupt_record`` (the raw text of a rejected row, else NULL; the
members of a rejected row are NULL).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sessionrate import schema as S
from sessionrate.functions.json import EVENT_ROOT, is_object, with_variant, wrapped

CORRUPT = "_corrupt_record"
EVENT_FIELDS = [f.name for f in S.EVENT.fields]


# ---------------------------------------------------------------------------
# parsing
# ---------------------------------------------------------------------------

_WRAPPED = T.StructType([T.StructField("e", S.EVENT), T.StructField("end", T.IntegerType()),
                         T.StructField(CORRUPT, T.StringType())])
_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "allowSingleQuotes": "false"}


def _with_event(df: DataFrame, value_col: str) -> DataFrame:
    """``df`` plus ``__ev`` (typed event, NULL for rejects) and ``__bad`` (rejected).

    One-element explode: the text is parsed once per row and no later filter (e.g. on
    actor.type) is pushed below the parse, which would re-parse it.
    """
    parsed = F.from_json(wrapped(F.col(value_col)), _WRAPPED, _OPTIONS)
    df = df.select("*", F.explode(F.array(parsed)).alias("__p"))
    p = F.col("__p")
    blank = F.coalesce(F.trim(F.col(value_col)) == "", F.lit(True))
    bad = ~blank & (p[CORRUPT].isNotNull() | ~F.coalesce(p["end"] == 1, F.lit(False)))
    return df.select("*", bad.alias("__bad"), F.when(~bad, p["e"]).alias("__ev")).drop("__p")


def _literal_struct(dtype: T.StructType, leaf_value, prefix: str = "") -> Column:
    """A struct literal of ``dtype`` with ``leaf_value(path, type)`` at every leaf."""
    parts = []
    for f in dtype.fields:
        path = f"{prefix}{f.name}"
        if isinstance(f.dataType, T.StructType):
            parts.append(_literal_struct(f.dataType, leaf_value, path + ".").alias(f.name))
        else:
            parts.append(F.lit(leaf_value(path, f.dataType)).cast(f.dataType).alias(f.name))
    return F.struct(*parts)


def _fill_schema_defaults(col: Column, dtype: T.StructType, prefix: str = "") -> Column:
    """``coalesce`` every member with the JSON Schema default ("" / 0 / {})."""
    parts = []
    for f in dtype.fields:
        path = f"{prefix}{f.name}"
        child = col.getField(f.name)
        if isinstance(f.dataType, T.StructType):
            filled = _fill_schema_defaults(child, f.dataType, path + ".")
            empty = _literal_struct(f.dataType, S.schema_default_value, path + ".")
            parts.append(F.when(child.isNull(), empty).otherwise(filled).alias(f.name))
        else:
            dflt = F.lit(S.schema_default_value(path, f.dataType)).cast(f.dataType)
            parts.append(F.coalesce(child, dflt).alias(f.name))
    return F.struct(*parts)


def _vpath(path: str) -> str:
    return f"{EVENT_ROOT}.{path}"


def _is_absent(v: Column, path: str) -> Column:
    return F.try_variant_get(v, _vpath(path), "variant").isNull()


def _fill_sentinels(ev: Column, v: Column, dtype: T.StructType, prefix: str = "") -> Column:
    """The typed members with the Java model's fill rules.

    absent member -> sentinel; JSON null -> NULL for objects and strings, sentinel
    for numbers (a primitive field cannot hold null); else the typed value.  (Where the
    variant is NULL, a NULL member counts as absent.)
    """
    parts = []
    for f in dtype.fields:
        path, child = f"{prefix}{f.name}", ev.getField(f.name)
        if isinstance(f.dataType, T.StructType):
            val = (F.when(child.isNotNull(), _fill_sentinels(child, v, f.dataType, path + "."))
                   .when(_is_absent(v, path), _literal_struct(f.dataType, S.sentinel_value, path + ".")))
        elif isinstance(f.dataType, T.StringType):
            val = F.when(child.isNull() & _is_absent(v, path),
                         F.lit(S.sentinel_value(path, f.dataType))).otherwise(child)
        elif path == "damage":
            val = child          # not a member of the Java model: no sentinel, kept as parsed
        else:
            val = F.coalesce(child, F.lit(S.sentinel_value(path, f.dataType)).cast(f.dataType))
        parts.append(val.alias(f.name))
    return F.struct(*parts)


# ---------------------------------------------------------------------------
# public operators
# ---------------------------------------------------------------------------

def parse_events(df: DataFrame, value_col: str = "value", defaults: str = "none",
                 on_error: str = "reject", keep_value: bool = False) -> DataFrame:
    """Parse the JSON text column into the game-event members (P1, P2).

    defaults: ``none`` (absent member -> NULL), ``sentinel`` (the Java model's
    sentinels, absent and JSON null told apart), ``schema`` (JSON Schema defaults).
    on_error, for rejects: ``reject`` (raw text kept in ``_corrupt_record``), ``null``
    (a row of NULLs), ``fail`` (raise on the first one).
    """
    if defaults not in ("none", "sentinel", "schema"):
        raise ValueError("defaults must be 'none', 'sentinel' or 'schema'")
    if on_error not in ("reject", "null", "fail"):
        raise ValueError("on_error must be 'reject', 'null' or 'fail'")
    keep = [c for c in df.columns if c != value_col or keep_value]
    rows = with_variant(df, value_col) if defaults == "sentinel" else df
    rows = _with_event(rows, value_col)
    event, corrupt = F.col("__ev"), F.when(F.col("__bad"), F.col(value_col))
    if defaults == "sentinel":
        event = F.when(event.isNotNull(), _fill_sentinels(event, F.col("__v"), S.EVENT))
    elif defaults == "schema":
        event = F.when(event.isNotNull(), _fill_schema_defaults(event, S.EVENT))
    if on_error == "fail":
        corrupt = F.when(corrupt.isNotNull(),
                         F.raise_error(F.concat(F.lit("malformed event: "), corrupt)))
    elif on_error == "null":
        corrupt = F.lit(None).cast("string")
    tmp = rows.select(*keep, event.alias("__ev"), corrupt.alias(CORRUPT))
    return tmp.select(*keep, *[F.col("__ev").getField(n).alias(n) for n in EVENT_FIELDS],
                      F.col(CORRUPT))


def split_rejects(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejected rows) of a ``parse_events(on_error='reject')`` result."""
    bad = F.col(CORRUPT).isNotNull()
    return parsed.where(~bad), parsed.where(bad)


def event_struct() -> Column:
    """Re-pack the top-level event members into one struct column."""
    return F.struct(*[F.col(n) for n in EVENT_FIELDS])


# ---------------------------------------------------------------------------
# empty-record test (P10) and sentinel clean-up
# ---------------------------------------------------------------------------

def _equals_literal(col: Column, dtype: T.StructType, prefix: str) -> Column:
    return col.eqNullSafe(_literal_struct(dtype, S.sentinel_value, prefix))


def empty_record_flags(parsed: DataFrame) -> DataFrame:
    """Flags telling which members of a sentinel-profile row are the EMPTY record.

    ``event_empty`` is the whole event equal to the all-sentinel event.
    """
    empty_event = F.struct(*[F.col(n) for n in EVENT_FIELDS if n != "damage"]).eqNullSafe(
        _literal_struct(T.StructType([f for f in S.EVENT.fields if f.name != "damage"]),
                        S.sentinel_value))
    return parsed.select(
        "*",
        empty_event.alias("event_empty"),
        _equals_literal(F.col("frame"), S.FRAME, "frame.").alias("frame_empty"),
        _equals_literal(F.col("actor"), S.ACTOR, "actor.").alias("actor_empty"),
        _equals_literal(F.col("actor.position"), S.POSITION, "actor.position.").alias("actor_position_empty"),
        _equals_literal(F.col("target"), S.ACTOR, "target.").alias("target_empty"),
    )


def _nullif_sentinels(col: Column, dtype: T.StructType, prefix: str) -> Column:
    """Members equal to their sentinel -> NULL; an object left without members -> NULL."""
    parts = []
    for f in dtype.fields:
        path, child = f"{prefix}{f.name}", col.getField(f.name)
        if isinstance(f.dataType, T.StructType):
            parts.append(_nullif_sentinels(child, f.dataType, path + ".").alias(f.name))
        else:
            gone = F.lit(S.sentinel_value(path, f.dataType)).cast(f.dataType)
            parts.append(F.nullif(child, gone).alias(f.name))
    cleaned = F.struct(*parts)
    some = F.coalesce(*[F.when(cleaned.getField(f.name).isNotNull(), F.lit(True)) for f in dtype.fields])
    return F.when(some, cleaned)


def sentinels_to_null(parsed: DataFrame) -> DataFrame:
    """Undo the sentinel fill: every member that holds its sentinel becomes NULL (strings and
    numbers too), and an object of which nothing is left becomes NULL."""
    out = {}
    for f in S.EVENT.fields:
        if isinstance(f.dataType, T.StructType):
            out[f.name] = _nullif_sentinels(F.col(f.name), f.dataType, f.name + ".")
        elif f.name != "damage":          # has no sentinel
            out[f.name] = F.nullif(F.col(f.name), F.lit(S.sentinel_value(f.name, f.dataType)))
    return parsed.withColumns(out)


# ---------------------------------------------------------------------------
# schema conformance (P11)
# ---------------------------------------------------------------------------

def _type_check(v: Column, path: str, dtype) -> Column:
    """'<path>: expected <type>' when the member is present but of another JSON type."""
    if isinstance(dtype, T.StructType):
        # the (copying) presence test runs only when the cheap object probe fails
        return F.when(~is_object(v, _vpath(path)) & ~_is_absent(v, path),
                      F.lit(f"/{path.replace('.', '/')}: expected object"))
    got = F.schema_of_variant(F.try_variant_get(v, _vpath(path), "variant"))
    if isinstance(dtype, T.StringType):
        ok, want = got == "STRING", "string"
    else:
        # JSON Schema "integer": a whole number (decimal with zero scale included)
        ok, want = (got == "BIGINT") | got.rlike(r"^DECIMAL\(\d+,0\)$"), "integer"
    return F.when(got.isNotNull() & ~ok, F.lit(f"/{path.replace('.', '/')}: expected {want}"))


_OBJECT_PATHS = frozenset(S.object_paths(S.EVENT))


def _violations(v: Column) -> Column:
    checks = []
    for obj, members in S.REQUIRED_MEMBERS.items():
        for m in members:
            path = f"{obj}.{m}" if obj else m
            present_parent = F.lit(True) if not obj else is_object(v, _vpath(obj))
            absent = _is_absent(v, path)
            if path in _OBJECT_PATHS:     # an object member: probe before copying it
                absent = ~is_object(v, _vpath(path)) & absent
            checks.append(F.when(present_parent & absent,
                                 F.lit(f"/{path.replace('.', '/')}: required")))
    for path, dtype in S.leaf_paths(S.EVENT):
        checks.append(_type_check(v, path, dtype))
    for path in S.object_paths(S.EVENT):
        checks.append(_type_check(v, path, T.StructType()))
    return F.filter(F.array(*checks), lambda x: x.isNotNull())


def schema_violations(df: DataFrame, value_col: str = "value") -> DataFrame:
    """Per record: the list of JSON Schema violations (empty list = conforming).

    Checks the required members of every object (an absent optional object is not
    looked into) and the JSON type (integer / string / object) of every member.
    Text that is not one JSON object (see the module's rule) gives the single violation
    ``/: expected object``.
    """
    cols = df.columns
    parsed = with_variant(df, value_col)
    v = F.col("__v")
    root_ok = is_object(v, EVENT_ROOT)
    viol = F.when(root_ok, _violations(v)).otherwise(F.array(F.lit("/: expected object")))
    return parsed.select(*cols, viol.alias("violations"))


def schema_violation_counts(checked: DataFrame) -> DataFrame:
    """Number of records per violation message (map-side partial count per message)."""
    return (checked.select(F.explode("violations").alias("violation"))
            .groupBy("violation").agg(F.count(F.lit(1)).alias("n_records")))
