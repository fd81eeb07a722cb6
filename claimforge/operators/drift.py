"""Drift of documents from their schema, found by one walk over each of them.

A schema is a list of :class:`Field`. The walk is written out from it before any document is read: a column
for the value at each place outside arrays, by its name or an old one, and one function over the elements of
each array on the way. All findings of a document are one array of its row, taken apart once: a scan and a
generator, no shuffle and no join.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Field:
    """What a document should hold at ``path``; ``[*]`` stands for every element of an array.

    ``kind`` is ``object``, ``array``, ``string``, ``number`` or ``boolean``. ``drifted`` are other kinds that are
    understood, and logged. ``legacy`` are old names of the last key. ``required`` is the severity of an absent key; a
    key whose value is null is there. A key is missing only where what should hold it is there.
    """

    path: str
    kind: str | None = None
    drifted: tuple[str, ...] = ()
    legacy: tuple[str, ...] = ()
    required: str | None = None

    @property
    def parent(self) -> str:
        return self.path.rpartition(".")[0]

    @property
    def key(self) -> str:
        return self.path.rpartition(".")[2]


FINDING = "rule_id string, field_name string, severity string, action string, original_value string, clean_value string, details string"


def finding(rule: str, field: Column, severity: str, action: str, original: Column | str | None, clean: str | None, **details: str | bool) -> Column:
    given = {"rule_id": rule, "field_name": field, "severity": severity, "action": action, "original_value": original, "clean_value": clean}
    parts = given | {"details": json.dumps(details, separators=(",", ":"), ensure_ascii=False)}
    return F.struct(*((x if isinstance(x, Column) else F.lit(x)).cast("string").alias(name) for name, x in parts.items()))


def child(value: Column, name: str) -> Column:
    """The value of a key of an object; a key whose value is null gives a VARIANT that is null, an absent one gives no VARIANT."""
    quote = '"' if "'" in name else "'"
    return F.try_variant_get(value, f"$[{quote}{name}{quote}]", "variant")


def is_kind(name: Column, kind: str) -> Column:
    """Whether a value, by the name of its type, is of a kind of :class:`Field`."""
    exact = {"string": "STRING", "boolean": "BOOLEAN", "null": "VOID"}
    if kind in exact:
        return name == exact[kind]
    if kind in ("object", "array"):
        return name.startswith(kind.upper())
    return ~(name.isin(*exact.values()) | name.startswith("OBJECT") | name.startswith("ARRAY"))


def prefixes(schema: list[Field]) -> set[str]:
    """The patterns of fields and those above them, the document itself (``""``) too."""
    found = {""}
    for f in schema:
        steps = f.path.replace("[*]", ".[*]").lstrip(".").split(".")
        found |= {".".join(steps[:n]).replace(".[*]", "[*]") for n in range(1, len(steps) + 1)}
    return found


#: Makes a column of an expression that stands some levels below the document, where that can be done.
Keep = Callable[[Column, int], Column]


def walked(schema: list[Field], pattern: str, path: Column, value: Column, depth: int, keep: Keep) -> Column:
    """The findings at and below a node that is there, as an array that may hold nulls."""
    visited = prefixes(schema)
    lists = {f.path for f in schema if f.kind == "array" and "object" in f.drifted}
    renamed = {old if not f.parent else f"{f.parent}.{old}": f.key for f in schema for old in f.legacy}
    below = lambda key: f"{pattern}.{key}" if pattern else key
    found, parts = [F.lit(None).cast(f"struct<{FINDING}>")], []

    drifted = {kind: f.kind for f in schema if f.path == pattern for kind in f.drifted}
    name = keep(F.schema_of_variant(value), depth + 1) if drifted else None
    for kind, wanted in drifted.items():
        if wanted in ("array", "object"):
            shape = finding("JSON_SHAPE_DRIFT", path, "warning", "normalized", kind, wanted, source_shape=kind, target_shape=wanted)
        else:
            shape = finding("JSON_TYPE_DRIFT", path, "warning", "normalized", F.try_variant_get(value, "$", "string"), None, source_type=kind, target_type=wanted)
        found.append(F.when(is_kind(name, kind), shape))

    keys = dict.fromkeys(p.rpartition(".")[2] for p in sorted(visited) if p and not p.endswith("[*]") and p.rpartition(".")[0] == pattern)
    for key in keys:
        at = F.concat(path, F.lit(f".{key}")) if pattern else F.lit(key)
        names = [] if below(key) in renamed else [key]
        names += [old.rpartition(".")[2] for old, new in renamed.items() if old.rpartition(".")[0] == pattern and new == key]
        held = {} if pattern in lists else {x: keep(child(value, x), depth + 1) for x in names}
        first = held[key].isNotNull() if key in held else F.lit(False)
        for x, v in held.items():
            there = v.isNotNull()
            if x != key:
                found.append(F.when(there, finding("JSON_KEY_DRIFT", at, "warning", "normalized", x, key, legacy_key=x)))
                there = there & ~first  # an old value beside the new one is looked at no further
            parts.append(F.when(there, walked(schema, below(key), at, v, depth + 1, keep)))
        absent = F.lit(True)
        for v in held.values():
            absent = absent & v.isNull()
        found += [F.when(absent, finding("JSON_MISSING_KEY", at, f.required, "flagged", None, None, key_absent=True)) for f in schema if f.path == below(key) and f.required]

    if f"{pattern}[*]" in visited:
        elements = F.try_variant_get(value, "$", "array<variant>")
        if pattern in lists:  # an object in the place of an array is its one element
            elements = F.when(is_kind(name, "object"), F.array(value)).otherwise(elements)

        def element(v: Column, i: Column) -> Column:
            place = F.concat(path, F.lit("["), i.cast("string"), F.lit("]"))
            return walked(schema, f"{pattern}[*]", place, v, depth + 1, lambda x, _: x)

        parts.append(F.flatten(F.transform(elements, element)))
    none = F.array().cast(f"array<struct<{FINDING}>>")
    return F.concat(F.array(*found), *(F.coalesce(p, none) for p in parts))


def audit(docs: DataFrame, payload: str, schema: list[Field]) -> DataFrame:
    """The columns of ``docs`` but ``payload`` with ``rule_id``, ``field_name``, ``severity``, ``action``, ``original_value``, ``clean_value``, ``details``.

    A row for each finding: ``JSON_KEY_DRIFT`` (an old name; if the new one is there too, the old value is looked at no
    further), ``JSON_SHAPE_DRIFT`` and ``JSON_TYPE_DRIFT`` (an understood other kind in the place of a container or a
    scalar), ``JSON_MISSING_KEY``. ``field_name`` is a path such as ``line_items[2].amount``. Documents that
    are null have no findings.
    """
    mark = uuid.uuid4().hex
    levels: dict[int, list[Column]] = {}

    def keep(x: Column, depth: int) -> Column:
        made = levels.setdefault(depth, [])
        made.append(x.alias(f"{mark}_{depth}_{len(made)}"))
        return F.col(f"{mark}_{depth}_{len(made) - 1}")

    found = walked(schema, "", F.lit(""), F.col(payload), 0, keep)
    rows = docs.filter(F.col(payload).isNotNull())
    for depth in sorted(levels):  # level by level, so that no value is looked up twice
        rows = rows.select("*", *levels[depth])
    # not a column first: Spark would filter by its size below all else, and compute it twice
    return rows.select(*(c for c in docs.columns if c != payload), F.inline(F.array_compact(found)))
