"""A JSON Schema document compiled to Spark columns (P11).

``compile_schema(text)`` reads the document on the driver and gives a :class:`JsonSchema`,
whose methods build Catalyst expressions; no record is looked at in Python.

* ``violations``: per record the list of what does not conform, ``/path: required``,
  ``/path: expected <type>`` and so on, in the order of the document (required members
  first, then the values).  Members of an absent optional object are not looked into.
* ``read``: the document's members as typed columns, absent ones filled with the document's
  ``default`` (an object whose default is ``{}`` with the defaults of its own members); JSON null,
  and a value of another type, gives NULL.

Keywords: ``type`` (one or several of object, array, string, integer, number, boolean, null),
``properties``, ``required``, ``items``, ``enum``, ``const``, ``minimum``, ``maximum``,
``minLength``, ``maxLength``, ``pattern`` (a Java expression, found anywhere in the text),
``default``; ``additionalProperties`` may be true.  Annotations (title, description, examples,
``$id`` and so on) are passed over; any other keyword is an error, so no rule of a document is
silently left out.  As in the standard, a rule for numbers or texts says nothing about values
of another type.

Types: ``integer`` takes any whole JSON number a BIGINT or DECIMAL holds; columns are BIGINT,
DOUBLE, STRING, BOOLEAN, structs and arrays; without ``type``, or with several
(null aside), a value is kept as its JSON text.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sessionrate import schema as S
from sessionrate.functions.json import EVENT_ROOT, is_object, with_variant

_ANNOTATIONS = {"$schema", "$id", "$comment", "title", "description", "examples", "default", "deprecated",
                "readOnly", "writeOnly"}
_RULES = {"type", "properties", "required", "items", "enum", "const", "minimum", "maximum", "minLength", "maxLength",
          "pattern", "additionalProperties"}
_COLUMN = {"string": T.StringType(), "integer": T.LongType(), "number": T.DoubleType(), "boolean": T.BooleanType()}
_NONE = object()


@dataclass
class Node:
    """One member of the document."""
    path: tuple
    types: list[str]
    rules: dict
    default: object = _NONE
    required: list[str] = field(default_factory=list)
    members: dict[str, "Node"] = field(default_factory=dict)
    items: "Node | None" = None

    @property
    def name(self) -> str:
        return "/" + "/".join(self.path)

    @property
    def kind(self) -> str | None:
        own = [t for t in self.types if t != "null"]
        return own[0] if len(own) == 1 else None


def _node(doc: object, path: tuple) -> Node:
    at = "/" + "/".join(path)
    if not isinstance(doc, dict):
        raise ValueError(f"{at}: a schema must be an object")
    if path and "'" in path[-1] and '"' in path[-1]:
        raise ValueError(f"{at}: a name with both kinds of quotes cannot be addressed")
    unknown = set(doc) - _ANNOTATIONS - _RULES
    if unknown or doc.get("additionalProperties", True) is not True:
        raise ValueError(f"{at}: unsupported keywords {sorted(unknown) or ['additionalProperties']}")
    types = doc.get("type", [])
    types = [types] if isinstance(types, str) else list(types)
    wrong = set(types) - {*_COLUMN, "object", "array", "null"}
    if wrong:
        raise ValueError(f"{at}: unknown types {sorted(wrong)}")
    if ("properties" in doc or "required" in doc) and "type" not in doc:
        types = ["object"]
    members = {k: _node(v, (*path, k)) for k, v in doc.get("properties", {}).items()}
    rules = {k: doc[k] for k in ("enum", "const", "minimum", "maximum", "minLength", "maxLength", "pattern") if k in doc}
    if "const" in rules:
        rules["enum"] = [rules.pop("const")]
    items = _node(doc["items"], (*path, "*")) if "items" in doc else None
    return Node(path, types, rules, doc.get("default", _NONE), list(doc.get("required", [])), members, items)


# --------------------------------------------------------------- expressions
def _json_path(path: tuple) -> str:
    """The member's place in the wrapped record, its names quoted."""
    return EVENT_ROOT + "".join(f'["{p}"]' if "'" in p else f"['{p}']" for p in path)


def _get(v: Column, path: tuple) -> Column:
    return F.try_variant_get(v, _json_path(path), "variant")


def _type_of(value: Column) -> Column:
    return F.schema_of_variant(value)


def _is(got: Column, kind: str) -> Column:
    """Whether a variant's type name is of the JSON type."""
    whole = (got == "BIGINT") | got.rlike(r"^DECIMAL\(\d+,0\)$")
    return {"string": got == "STRING", "integer": whole, "number": whole | got.rlike("^(DECIMAL|DOUBLE|FLOAT)"),
            "boolean": got == "BOOLEAN", "null": got == "VOID", "object": got.startswith("OBJECT"),
            "array": got.startswith("ARRAY")}[kind]


def _any(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out | c
    return out


def _value_checks(node: Node, value: Column, name: str) -> list[Column]:
    """Violations of one present value (NULL where it conforms)."""
    got, out = _type_of(value), []
    if node.types:
        out.append(F.when(~_any([_is(got, t) for t in node.types]), F.lit(f"{name}: expected {' or '.join(node.types)}")))
    text = F.when(got == "STRING", F.try_variant_get(value, "$", "string"))
    number = F.when(_is(got, "number"), F.try_variant_get(value, "$", "double"))
    r = node.rules
    if "enum" in r:
        wanted = [json.dumps(x, separators=(",", ":"), ensure_ascii=False) for x in r["enum"]]
        out.append(F.when(~F.to_json(value).isin(*wanted), F.lit(f"{name}: not one of {', '.join(wanted)}")))
    for key, bad in (("minimum", lambda x: number < x), ("maximum", lambda x: number > x),
                     ("minLength", lambda x: F.length(text) < x), ("maxLength", lambda x: F.length(text) > x),
                     ("pattern", lambda x: ~text.rlike(x))):
        if key in r:
            out.append(F.when(bad(r[key]), F.lit(f"{name}: {key} {r[key]}")))
    return out


def _required(node: Node, v: Column) -> list[Column]:
    if not node.members and not node.required:
        return []
    here = is_object(v, _json_path(node.path)) if node.path else F.lit(True)
    out = [F.when(here & _get(v, (*node.path, m)).isNull(), F.lit(f"{node.name.rstrip('/')}/{m}: required"))
           for m in node.required]
    return out + [c for m in node.members.values() for c in _required(m, v)]


def _item_check(node: Node, k: int):
    """The k-th check of an array's items, for each of which it gives the violation or NULL."""
    return lambda item: _value_checks(node.items, item, f"{node.name}/*")[k]


def _values(node: Node, v: Column) -> list[Column]:
    """Checks of all members below ``node``, leaves before the objects that hold them."""
    out, objects = [], []
    for m in node.members.values():
        value = _get(v, m.path)
        if m.members:
            out += _values(m, v)
        checks = [F.when(value.isNotNull(), c) for c in _value_checks(m, value, m.name)]
        if m.items is not None:
            each = F.try_variant_get(v, _json_path(m.path), "array<variant>")
            bad = [_item_check(m, k) for k in range(len(_value_checks(m.items, value, "")))]
            checks += [F.get(F.filter(F.transform(each, b), lambda x: x.isNotNull()), F.lit(0)) for b in bad]
        (objects if m.kind == "object" else out).extend(checks)
    return out + objects


def _column_type(node: Node) -> T.DataType:
    if node.kind == "object" and node.members:
        return T.StructType([T.StructField(k, _column_type(m)) for k, m in node.members.items()])
    if node.kind == "array" and node.items is not None and node.items.kind in _COLUMN:
        return T.ArrayType(_COLUMN[node.items.kind])
    return _COLUMN.get(node.kind, T.StringType())


def _default(node: Node, kind: T.DataType) -> Column:
    """The value of an absent member."""
    if isinstance(kind, T.StructType):
        if node.default is _NONE or node.default is None:
            return F.lit(None).cast(kind)
        given = dict(node.default)
        return F.struct(*[(F.lit(given[k]).cast(f.dataType) if k in given and not m.members else _default(m, f.dataType)).alias(k)
                          for (k, m), f in zip(node.members.items(), kind.fields)])
    if node.default is _NONE or node.default is None:
        return F.lit(None).cast(kind)
    if isinstance(kind, T.ArrayType):
        return F.array(*[F.lit(x) for x in node.default]).cast(kind)
    plain = node.default if not isinstance(node.default, (dict, list)) and node.kind in _COLUMN else json.dumps(node.default)
    return F.lit(plain).cast(kind)


def _read(node: Node, v: Column, kind: T.DataType) -> Column:
    value = _get(v, node.path)
    absent = value.isNull()
    if isinstance(kind, T.StructType):
        own = F.struct(*[_read(m, v, f.dataType).alias(k) for (k, m), f in zip(node.members.items(), kind.fields)])
        return F.when(absent, _default(node, kind)).when(is_object(v, _json_path(node.path)), own)
    got = _type_of(value)
    if isinstance(kind, T.ArrayType):
        each = F.try_variant_get(v, _json_path(node.path), "array<variant>")
        one = lambda x: F.when(_is(_type_of(x), node.items.kind), F.try_variant_get(x, "$", kind.elementType.simpleString()))
        return F.when(absent, _default(node, kind)).otherwise(F.transform(each, one))
    if node.kind in _COLUMN:
        typed = F.when(_is(got, node.kind), F.try_variant_get(value, "$", kind.simpleString()))
    else:
        typed = F.when(got != "VOID", F.to_json(value))
    return F.when(absent, _default(node, kind)).otherwise(typed)


class JsonSchema:
    """A compiled document."""

    def __init__(self, root: Node):
        self.root = root

    @property
    def struct(self) -> T.StructType:
        """The columns of the document."""
        kind = _column_type(self.root)
        return kind if isinstance(kind, T.StructType) else T.StructType([])

    def violations(self, df: DataFrame, value_col: str = "value") -> DataFrame:
        """``df`` plus ``violations``; text that is not one JSON object: ``/: expected object``."""
        v = F.col("__v")
        checks = _required(self.root, v) + _values(self.root, v)
        found = F.filter(F.array(*checks), lambda x: x.isNotNull()) if checks else F.array().cast("array<string>")
        return with_variant(df, value_col).select(*df.columns, F.when(is_object(v, EVENT_ROOT), found).otherwise(
            F.array(F.lit("/: expected object"))).alias("violations"))

    def read(self, df: DataFrame, value_col: str = "value", keep_value: bool = False) -> DataFrame:
        """``df`` without its text, plus the document's members; all NULL where the text is not one
        JSON object."""
        v = F.col("__v")
        kept = [c for c in df.columns if (c != value_col or keep_value) and c not in self.struct.names]
        cols = [F.when(is_object(v, EVENT_ROOT), _read(m, v, f.dataType)).alias(k)
                for (k, m), f in zip(self.root.members.items(), self.struct.fields)]
        return with_variant(df, value_col).select(*kept, *cols)


def compile_schema(text: str) -> JsonSchema:
    """Compile a JSON Schema document; its root must describe an object."""
    root = _node(json.loads(text), ())
    if root.kind != "object":
        raise ValueError("/: the root must be an object")
    return JsonSchema(root)


# ------------------------------------------------------- the events' own document
def event_document() -> str:
    """The game event's schema as a document, from the library's fixed values."""
    def of(kind: T.DataType, path: str) -> dict:
        if not isinstance(kind, T.StructType):
            name = "string" if isinstance(kind, T.StringType) else "integer"
            return {"type": name, "default": S.schema_default_value(path, kind)}
        inner = {f.name: of(f.dataType, f"{path}.{f.name}" if path else f.name) for f in kind.fields}
        out = {"type": "object", "default": {}, "properties": inner}
        return {**out, "required": list(S.REQUIRED_MEMBERS[path])} if path in S.REQUIRED_MEMBERS else out

    return json.dumps(of(S.EVENT, ""))
