"""Tables that change by parts: versioned manifests, exclusive commits, merges that rewrite only what they touch.

A table is a set of parts (buckets of a key, values of a column, or one part for all), each a folder of Parquet
files. A version of a layer is one small file that names the folder of every part of every table. A change writes
new folders beside the old ones and then tries to create the next version's file, which only one writer can. A writer that
loses looks at what the winner changed: parts of its own are merged anew, and other parts just go along. Readers
see one version whole.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from claimforge.operators.constraints import orphans, repeated_keys, row_counts
from claimforge.operators.upsert import replace_children, upsert
from claimforge.sources.export import observed

PART = "part"
#: Parts of a table that is dealt by a key; at a terabyte a table, thousands are right.
BUCKETS = 16
#: Versions whose files stay: readers of older ones must look again.
KEPT = 2


class InvalidTables(ValueError):
    """A change breaks constraints; nothing of it is published."""


class Conflict(RuntimeError):
    """Other writers have won again and again."""


@dataclass(frozen=True)
class Split:
    """How rows are dealt to parts: by a hash of ``keys`` to ``buckets``, by the value of ``column``, or not at all."""

    keys: tuple[str, ...] = ()
    buckets: int = 0
    column: str | None = None

    def label(self) -> Column:
        if self.buckets:
            return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("string")
        return F.col(self.column).cast("string") if self.column else F.lit("all")

    def to_json(self) -> dict:
        return {"keys": list(self.keys), "buckets": self.buckets, "column": self.column}

    @staticmethod
    def of(value: dict) -> Split:
        return Split(tuple(value["keys"]), value["buckets"], value["column"])


@dataclass
class Change:
    """New rows of a table and what becomes of the old rows of the parts that they touch.

    ``touched`` are further rows whose parts count as touched, ``labels`` further parts. Without ``merge`` the new rows
    are all that a touched part holds. ``whole`` replaces every part.
    """

    new: DataFrame
    split: Split = Split()
    merge: Callable[[DataFrame, DataFrame], DataFrame] | None = None
    touched: DataFrame | None = None
    labels: tuple[str, ...] = ()
    whole: bool = False


def upserted(new: DataFrame, *keys: str, buckets: int = BUCKETS) -> Change:
    """Rows of ``new`` replace those of equal keys."""
    return Change(new, Split(keys, buckets), lambda old, rows: upsert(old, rows, list(keys)))


def children(new: DataFrame, parents: DataFrame, key: str, buckets: int = BUCKETS) -> Change:
    """Rows of ``new`` replace all rows of the ``parents`` in the batch, also of those without new ones."""
    return Change(new, Split((key,), buckets), lambda old, rows: replace_children(old, rows, parents, key), touched=parents.select(key))


def rebuilt(new: DataFrame, column: str, *values: object) -> Change:
    """The parts of the given values of ``column`` hold ``new`` from now on."""
    return Change(new, Split(column=column), labels=tuple(map(str, values)))


def replaced(new: DataFrame) -> Change:
    return Change(new, whole=True)


@dataclass
class Constraints:
    """What must hold of published rows: ``rows`` by table and name (SQL), ``unique`` keys by table, and references (child, parent, key)."""

    rows: dict[str, dict[str, str]] = field(default_factory=dict)
    unique: dict[str, list[tuple[str, ...]]] = field(default_factory=dict)
    references: list[tuple[str, str, str]] = field(default_factory=list)


class Snapshot:
    """One version of a layer."""

    def __init__(self, layers: Layers, layer: str, version: int, tables: dict):
        self.layers, self.layer, self.version, self.tables = layers, layer, version, tables

    def has(self, name: str) -> bool:
        return name in self.tables

    def read(self, name: str, labels: list[str] | None = None) -> DataFrame:
        """A table, or some of its parts."""
        table = self.tables[name]
        schema = StructType.fromJson(table["schema"])
        paths = [path for label, path in sorted(table["parts"].items()) if labels is None or label in labels]
        spark = self.layers.spark
        return spark.read.schema(schema).parquet(*(f"{self.layers.root}/{p}" for p in paths)) if paths else spark.createDataFrame([], schema)


@dataclass
class Written:
    split: Split
    schema: StructType
    parts: dict[str, str]  # new folders
    touched: list[str] | None  # labels; None is all
    folder: str
    metrics: dict[str, int]


class Layers:
    """Layers under one root on any file system that Spark writes to."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.path = spark._jvm.org.apache.hadoop.fs.Path
        self.conf = spark._jsc.hadoopConfiguration()
        self.fs = self.path(self.root).getFileSystem(self.conf)

    # -- versions -----------------------------------------------------------

    def versions(self, layer: str) -> list[int]:
        folder = self.path(f"{self.root}/{layer}/_versions")
        names = [x.getPath().getName() for x in self.fs.listStatus(folder)] if self.fs.exists(folder) else []
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def state(self, layer: str, version: int | None = None) -> tuple[int, dict]:
        """The newest version's number, 0 if there is none, and what it says."""
        version = max(self.versions(layer), default=0) if version is None else version
        if not version:
            return 0, {}
        stream = self.fs.open(self.path(f"{self.root}/{layer}/_versions/{version:012d}.json"))
        try:
            return version, json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def advance(self, layer: str, version: int, state: dict) -> bool:
        """Create version ``version + 1``; false if another writer has.

        The text is written to a file of its own, which then gets the version's name: by a link on a local file system,
        by a rename that never overwrites elsewhere. Either is one step that fails if the name is taken. Version
        files are never deleted, so a slow writer cannot take a number that has been used.
        """
        folder = f"{self.root}/{layer}/_versions"
        self.fs.mkdirs(self.path(folder))
        ready, name = self.path(f"{folder}/.{uuid.uuid4().hex}.tmp"), self.path(f"{folder}/{version + 1:012d}.json")
        out = self.fs.create(ready, True)
        try:
            out.write(bytearray(json.dumps(state).encode()))
        finally:
            out.close()
        jvm = self.spark._jvm
        try:
            if self.fs.getUri().getScheme() == "file":
                at = lambda p: jvm.java.io.File(p.toUri().getPath()).toPath()
                jvm.java.nio.file.Files.createLink(at(name), at(ready))
            else:
                none = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
                jvm.org.apache.hadoop.fs.FileContext.getFileContext(ready.toUri(), self.conf).rename(ready, name, none)
        except Py4JJavaError as e:
            if "AlreadyExists" in e.java_exception.getClass().getName():
                return False
            raise
        finally:
            self.fs.delete(ready, False)
        return True

    # -- tables -------------------------------------------------------------

    def snapshot(self, layer: str) -> Snapshot:
        version, state = self.state(layer)
        return Snapshot(self, layer, version, state.get("tables", {}))

    def read(self, layer: str, name: str) -> DataFrame:
        return self.snapshot(layer).read(name)

    def has(self, layer: str) -> bool:
        return bool(self.versions(layer))

    def _write(self, base: Snapshot, name: str, change: Change, checks: dict[str, str]) -> Written:
        new = change.new.drop(*(f.name for f in change.new.schema if f.dataType.typeName() == "variant"))
        known = base.tables.get(name)
        split = Split.of(known["split"]) if known and not change.whole else change.split
        touched = None
        out = new
        if not change.whole:
            rows = [df.select(split.label().alias(PART)) for df in (new, change.touched) if df is not None]
            touched = sorted({r[PART] for r in reduce(DataFrame.unionByName, rows).distinct().collect()} | set(change.labels))  # parts, not rows
            if known and change.merge:
                out = change.merge(base.read(name, touched), new)
        folder = f"{base.layer}/{name}/{uuid.uuid4().hex}"
        metrics = {}
        schema = out.schema
        if checks:
            seen = Observation()
            out = out.observe(seen, *row_counts(checks))
        path = f"{self.root}/{folder}"
        try:
            if split == Split():
                out.write.parquet(path)
                parts = {"all": folder}
            else:
                out.withColumn(PART, split.label()).hint("rebalance", F.col(PART)).write.partitionBy(PART).parquet(path)
                made = [x.getPath().getName() for x in self.fs.listStatus(self.path(path)) if x.isDirectory()]
                parts = {n.split("=", 1)[1]: f"{folder}/{n}" for n in made if n.startswith(f"{PART}=")}
        except BaseException:
            self.fs.delete(self.path(path), True)
            raise
        if checks:
            metrics = {check: n for check, n in observed(seen, self.spark.read.schema(schema).parquet(path)).items() if n}
        return Written(split, schema, parts, touched, folder, metrics)

    @staticmethod
    def _merged(base: Snapshot, written: dict[str, Written]) -> dict:
        tables = dict(base.tables)
        for name, w in written.items():
            kept = {} if w.touched is None else {k: v for k, v in base.tables.get(name, {"parts": {}})["parts"].items() if k not in w.touched}
            tables[name] = {"schema": w.schema.jsonValue(), "split": w.split.to_json(), "parts": kept | w.parts}
        return tables

    def _broken(self, pending: Snapshot, written: dict[str, Written], limits: Constraints) -> dict[str, int]:
        """Broken constraints with their numbers of rows: row checks as the writes have counted them, and two jobs for all keys and references."""
        out = {f"{name}: {check}": n for name, w in written.items() for check, n in w.metrics.items()}
        fresh = lambda name: pending.read(name, None if written[name].touched is None else list(written[name].parts))
        keys = []
        for name, columns in ((n, k) for n, ks in limits.unique.items() if n in written for k in ks):
            # keys that deal a table to its parts cannot repeat across parts; others are looked for in all of it
            keys.append((name, columns, fresh(name) if set(written[name].split.keys) <= set(columns) else pending.read(name)))
        found = [repeated_keys(keys)] if keys else []
        references = [(c, p, k, fresh(c), pending.read(p)) for c, p, k in limits.references if c in written]
        found += [orphans(references)] if references else []
        for df in found:
            out |= {r["what"]: r["rows"] for r in df.collect()}
        return out

    def publish(self, layer: str, changes: Callable[[Snapshot], dict[str, Change]], limits: Constraints | None = None, attempts: int = 20) -> int:
        """Commit the changes that ``changes`` makes of the newest version; the new version's number.

        A task rewrites only touched parts, and all other files stay as they are. If a commit is lost and the winner has
        changed none of the touched parts, the same files are tried on top of its version; else the changes are
        made anew. A parent that a version has stays in every later one, so references need no second look.
        """
        limits = limits or Constraints()
        for _ in range(attempts):
            base = self.snapshot(layer)
            written: dict[str, Written] = {}
            done = False
            try:
                for name, change in changes(base).items():
                    written[name] = self._write(base, name, change, limits.rows.get(name, {}))
                broken = self._broken(Snapshot(self, layer, 0, self._merged(base, written)), written, limits)
                if broken:
                    raise InvalidTables(str(broken))
                latest = base
                for _ in range(attempts):
                    if self.advance(layer, latest.version, {"tables": self._merged(latest, written)}):
                        done = True
                        self._clean(layer)
                        return latest.version + 1
                    latest = self.snapshot(layer)
                    if any(self._touched(base, n, w) != self._touched(latest, n, w) for n, w in written.items()):
                        break
            except InvalidTables:
                raise
            except Exception:
                if max(self.versions(layer), default=0) - base.version < KEPT:
                    raise
                # others have committed meanwhile, and the files that this attempt was reading may be gone
            finally:
                if not done:
                    for w in written.values():
                        self.fs.delete(self.path(f"{self.root}/{w.folder}"), True)
        raise Conflict(f"{layer}: {attempts} attempts were overtaken")

    @staticmethod
    def _touched(at: Snapshot, name: str, w: Written) -> dict[str, str]:
        parts = at.tables.get(name, {"parts": {}})["parts"]
        return {k: v for k, v in parts.items() if w.touched is None or k in w.touched}

    def _clean(self, layer: str, keep: int = KEPT) -> None:
        """Delete the folders that the version before the kept ones names and they do not."""
        recent = self.versions(layer)[-keep - 1 :]
        if len(recent) <= keep:
            return
        named = [{p for t in self.state(layer, v)[1]["tables"].values() for p in t["parts"].values()} for v in recent]
        for path in named[0] - set().union(*named[1:]):
            self.fs.delete(self.path(f"{self.root}/{path}"), True)
