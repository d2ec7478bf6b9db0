"""Deeply nested semi-structured records as related flat tables.

Bodies are parsed once in Python, which sees to what one JVM schema can't follow: keys with name-space prefixes, JSON within strings, lone
objects where others have arrays, values with and without attributes. The pass writes every body in one regular form (every object in an
array under its plain key, scalars apart from objects) and the paths and types it has met. Those are merged into one schema; the JVM
parses the regular form by it and explodes array after array. All levels of a body lie in its row, so that a child table, with
its parent's surrogate key and its ordinal, takes no join.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from almoneda.plans.runtime import materialize

#: Levels that become tables and columns; what lies deeper stays in a column as its JSON text.
DEPTH = 32
#: Where a value stands that is written beside attributes.
VALUE = ("#text", "_VALUE", "value")


def _no(_: str) -> None:
    raise ValueError("not JSON")


def parse(body: str | None) -> object:
    """The JSON value, or ValueError. NaN and infinities are no JSON; nesting beyond the parser's depth counts as damage."""
    if body is None:
        raise ValueError("null")
    try:
        return json.loads(body, parse_constant=_no)
    except RecursionError as e:
        raise ValueError("too deep") from e


def opened(value: object) -> object:
    """A string that itself holds a JSON object or array, parsed; anything else as it is."""
    if isinstance(value, str) and value.lstrip()[:1] in ("{", "["):
        try:
            return parse(value)
        except ValueError:
            return value
    return value


def escaped(key: str) -> str:
    """A key without its name-space prefix, in lower case with capitals marked: names that differ in case only stay apart."""
    return "".join(f"^{c.lower()}" if c != c.lower() or c == "^" else c for c in key.rpartition(":")[2])


def unescaped(key: str) -> str:
    out, up = [], False
    for c in key:
        if c == "^" and not up:
            up = True
        else:
            out.append(c.upper() if up else c)
            up = False
    return "".join(out)


class Regular:
    """Writes values in the regular form: objects as arrays under o:key, scalars under s:key, lists of scalars under l:key; and keeps in
    ``shape`` what was met: key -> [kinds, children]."""

    def __init__(self) -> None:
        self.names: dict[str, tuple[str, str, str]] = {}
        self.shape: dict = {}

    def of(self, key: str) -> tuple[str, str, str]:
        got = self.names.get(key)
        if got is None:
            e = escaped(key)
            got = self.names[key] = (f"o:{e}", f"s:{e}", f"l:{e}")
        return got

    def root(self, value: object) -> list:
        found: list = []
        self._list(opened(value), found, [], self.shape.setdefault("", [set(), {}]), 0)
        return found

    def _scalar(self, v: object, kinds: set) -> object:
        if isinstance(v, bool):
            kinds.add("boolean")
        elif isinstance(v, int):
            kinds.add("long" if -(2**53) <= v <= 2**53 else "wide" if -(2**63) <= v < 2**63 else "string")
        elif isinstance(v, float):
            if math.isinf(v):
                kinds.add("string")
                return "Infinity" if v > 0 else "-Infinity"
            kinds.add("double")
        else:
            kinds.add("string")
        return v

    def _list(self, v: object, objects: list, scalars: list, node: list, depth: int) -> None:
        """Objects of a value, of a list, and of lists in it, in their order; nulls keep their place among objects."""
        if isinstance(v, dict):
            objects.append(self._object(v, node, depth))
        elif isinstance(v, list):
            for x in v:
                x = opened(x)
                if isinstance(x, dict):
                    objects.append(self._object(x, node, depth))
                    node[0].add("array")
                elif isinstance(x, list):
                    self._list(x, objects, scalars, node, depth)
                elif x is None:
                    objects.append(None)
                    node[0].add("array")
                else:
                    scalars.append(json.dumps(x) if isinstance(x, bool) else str(x))

    def _object(self, value: dict, node: list, depth: int) -> dict:
        node[0].add("object")
        out: dict = {}
        children = node[1]
        for key, v in value.items():
            if v is None:
                continue
            v = opened(v)
            o, s, li = self.of(key)
            name = o[2:]
            child = children.get(name)
            if child is None:
                child = children[name] = [set(), {}]
            if isinstance(v, (dict, list)):
                if depth >= DEPTH:
                    child[0].add("string")
                    out.setdefault(s, json.dumps(v, ensure_ascii=False))
                    continue
                objects, scalars = out.get(o, []), out.get(li, [])
                self._list(v, objects, scalars, child, depth + 1)
                if any(x is not None for x in objects):
                    out[o] = objects
                    if len(objects) > 1:
                        child[0].add("array")
                if scalars:
                    child[0].add("list")
                    out[li] = scalars
            elif s not in out:
                out[s] = self._scalar(v, child[0])
        return out

    def paths(self) -> Iterator[tuple[str, str]]:
        """(path, kind) of all met; a path is a JSON list of its escaped keys."""
        todo: list[tuple[tuple, list]] = [((), self.shape.get("", [set(), {}]))]
        while todo:
            path, (kinds, children) = todo.pop()
            for k in kinds:
                yield json.dumps(path), k
            todo += [((*path, name), child) for name, child in children.items()]


@dataclass
class Node:
    """What occurs at a path, in any body."""

    name: str
    kinds: set[str] = field(default_factory=set)
    children: dict[str, Node] = field(default_factory=dict)

    @property
    def repeated(self) -> bool:
        return "array" in self.kinds

    @property
    def scalar(self) -> T.DataType | None:
        """The type that holds all scalars met: numbers stay numbers, a mixture is text."""
        k = self.kinds & {"boolean", "long", "wide", "double", "string"}
        if not k:
            return None
        if k == {"boolean"}:
            return T.BooleanType()
        if k <= {"long", "wide"}:
            return T.LongType()
        return T.DoubleType() if k <= {"long", "double"} else T.StringType()

    def struct(self) -> T.StructType:
        fields = []
        for name, c in sorted(self.children.items()):
            if c.scalar is not None:
                fields.append(T.StructField(f"s:{name}", c.scalar))
            if "list" in c.kinds:
                fields.append(T.StructField(f"l:{name}", T.ArrayType(T.StringType())))
            if "object" in c.kinds:
                fields.append(T.StructField(f"o:{name}", T.ArrayType(c.struct())))
        return T.StructType(fields or [T.StructField("s:", T.StringType())])

    def child(self, name: str) -> Node | None:
        return self.children.get(escaped(name))

    def pruned(self, names: set[str] | None, skip: set[str] = frozenset()) -> Node:
        """Without children whose escaped names aren't wanted, at any level, or, at this one, are to be skipped."""
        keep = {k: c.pruned(names) for k, c in self.children.items() if (names is None or k in names) and k not in skip}
        return Node(self.name, self.kinds, keep)

    def towards(self, path: tuple[str, ...], skip: set[str]) -> Node:
        """What has to be parsed for the objects at a path: above them nothing but the way."""
        if not path:
            return self.pruned(None, skip)
        e = escaped(path[0])
        return Node(self.name, self.kinds, {e: Node(e, self.children[e].kinds & {"object", "array"}, self.children[e].towards(path[1:], skip).children)})


def scalar(at: Column, node: Node | None, *path: str) -> Column:
    """The text at a path below an object (a struct in the regular form): bare, or beside attributes; null where there is none."""
    none = F.lit(None).cast("string")
    for name in path[:-1]:
        node = node.child(name) if node else None
        if node is None or "object" not in node.kinds:
            return none
        at = F.get(at[f"o:{escaped(name)}"], 0)
    node = node.child(path[-1]) if node else None
    if node is None:
        return none
    e = escaped(path[-1])
    found = [at[f"s:{e}"].cast("string")] if node.scalar is not None else []
    if "object" in node.kinds:
        found += [F.get(at[f"o:{e}"], 0)[f"s:{escaped(v)}"].cast("string") for v in VALUE if (c := node.child(v)) is not None and c.scalar is not None]
    return F.coalesce(*found) if found else none


def objects(at: Column, node: Node | None, name: str) -> tuple[Column, Node] | None:
    """The array of objects under a key, without nulls, and what they may hold; None if no body has any."""
    child = node.child(name) if node else None
    if child is None or "object" not in child.kinds:
        return None
    return F.filter(F.coalesce(at[f"o:{escaped(name)}"], F.array().cast(T.ArrayType(child.struct()))), lambda x: x.isNotNull()), child


def everywhere(at: Column, node: Node, name: str) -> Column:
    """All texts under that key at an object and at whatever lies below it: an array."""
    e, found = escaped(name), []
    for k, c in sorted(node.children.items()):
        if k == e:
            if c.scalar is not None:
                found.append(F.array(at[f"s:{k}"].cast("string")))
            if "list" in c.kinds:
                found.append(F.coalesce(at[f"l:{k}"], F.array().cast("array<string>")))
            found += [F.transform(F.coalesce(at[f"o:{k}"], F.array().cast(T.ArrayType(c.struct()))), _field(v)) for v in VALUE if "object" in c.kinds and (x := c.child(v)) is not None and x.scalar is not None]
        elif "object" in c.kinds and _has(c, e):
            inner = F.coalesce(at[f"o:{k}"], F.array().cast(T.ArrayType(c.struct())))
            found.append(F.flatten(F.transform(F.filter(inner, lambda x: x.isNotNull()), _within(c, name))))
    return F.filter(F.concat(*found), lambda x: x.isNotNull() & (x != "")) if found else F.array().cast("array<string>")


def _within(node: Node, name: str):
    return lambda x: everywhere(x, node, name)


def _field(name: str):
    return lambda x: x[f"s:{escaped(name)}"].cast("string")


def _has(node: Node, e: str) -> bool:
    return e in node.children or any(_has(c, e) for c in node.children.values())


@dataclass
class Bodies:
    """Parsed bodies: ``rows`` (doc, cuerpo in the regular form) as a written table, ``root`` the merged schema."""

    rows: DataFrame
    root: Node

    def only(self, names: Iterable[str]) -> Bodies:
        """The same bodies, of which nothing under other keys will be parsed."""
        return Bodies(self.rows, self.root.pruned({escaped(n) for n in names}))

    def parsed(self, path: tuple[str, ...] = (), skip: Iterable[str] = ()) -> DataFrame:
        """(doc, raiz): every body as an array of its root objects, with what lies on the way to a path and below it."""
        root = self.root.towards(path, {escaped(s) for s in skip})
        shape = T.StructType([T.StructField("r", T.ArrayType(root.struct()))])
        return self.rows.select("doc", F.from_json("cuerpo", shape)["r"].alias("raiz"))

    def node(self, path: tuple[str, ...]) -> Node:
        n = self.root
        for p in path:
            n = n.children[escaped(p)]
        return n

    def tables(self, repeating: Iterable[str] = ()) -> list[tuple[str, ...]]:
        """Paths of the tables: the root and every path that holds arrays, or whose last name is in ``repeating``."""
        also = {escaped(r) for r in repeating}
        out, todo = [], [((), self.root)]
        while todo:
            path, n = todo.pop()
            if not path or (("object" in n.kinds) and (n.repeated or escaped(path[-1]) in also)):
                out.append(path)
            todo += [((*path, unescaped(k)), c) for k, c in sorted(n.children.items(), reverse=True) if "object" in c.kinds]
        return out

    def at(self, path: tuple[str, ...], repeating: Iterable[str] = (), skip: Iterable[str] = ()) -> DataFrame:
        """(doc, nodo, padre, ordinal, x): the objects at a path, x in the regular form; nodo is the surrogate key, padre that of the row in
        the next table above, ordinal the place in the array. The root's padre is null. Children in ``skip`` aren't parsed."""
        also = {escaped(r) for r in repeating}
        df = self.parsed(path, skip).select("doc", F.posexplode("raiz").alias("ordinal", "x")).where("x is not null")
        df = df.select("doc", F.concat(F.lit("r"), F.col("ordinal")).alias("nodo"), F.lit(None).cast("string").alias("padre"), "ordinal", "x")
        n = self.root
        for name in path:
            e = escaped(name)
            n = n.children[e]
            column = F.col("x")[f"o:{e}"]
            if n.repeated or e in also:
                df = df.select("doc", F.col("nodo").alias("padre"), F.posexplode(column).alias("ordinal", "x")).where("x is not null")
                df = df.select("doc", F.concat("padre", F.lit(f"/{name}"), "ordinal").alias("nodo"), "padre", "ordinal", "x")
            else:
                df = df.withColumn("x", F.get(column, 0)).where("x is not null")
        return df

    def columns(self, path: tuple[str, ...], repeating: Iterable[str] = ()) -> list[Column]:
        """The typed columns of a table: its objects' scalars and those of objects below that don't repeat, named by their paths."""
        also = {escaped(r) for r in repeating}
        out: list[Column] = []
        seen: set[str] = {"doc", "nodo", "padre", "ordinal"}

        def name(full: str) -> str:
            while full.lower() in seen:
                full += "_"
            seen.add(full.lower())
            return full

        todo = [(F.col("x"), self.node(path), "")]
        while todo:
            at, n, before = todo.pop(0)
            for k, c in sorted(n.children.items()):
                full = f"{before}{unescaped(k)}"
                if c.scalar is not None:
                    out.append(at[f"s:{k}"].alias(name(full)))
                if "list" in c.kinds:
                    out.append(at[f"l:{k}"].alias(name(f"{full}[]")))
                if "object" in c.kinds and not c.repeated and k not in also:
                    todo.append((F.get(at[f"o:{k}"], 0), c, f"{full}."))
        return out

    def table(self, path: tuple[str, ...], repeating: Iterable[str] = ()) -> DataFrame:
        """A child table: doc, nodo, padre, ordinal and its typed columns."""
        return self.at(path, repeating).select("doc", "nodo", "padre", "ordinal", *self.columns(path, repeating))


def read_bodies(df: DataFrame, key: str, body: str) -> Bodies:
    """Parses all bodies of ``df``, once, and merges what they hold into one schema.

    Null, empty and damaged bodies give no rows; a body that is null or a bare value has no objects and gives none either. Repeated bodies
    give rows of each. Keys that differ only in their name-space prefix fall together; of two such scalars in one object the first
    non-null counts, objects stand in one array. A lone object counts as an array of one; lists in lists are one list. Levels beyond DEPTH
    stay text. The schema, as large as the distinct paths, is all that reaches the driver. Other columns of ``df`` aren't read.
    """
    read = df.select(F.col(key).alias("doc"), F.col(body).cast("string").alias("body"))

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        regular = Regular()
        for b in batches:
            docs, out = [], []
            for doc, text in zip(b["doc"], b["body"], strict=True):
                try:
                    value = parse(text)
                except ValueError:
                    continue
                roots = regular.root(value)
                if roots:
                    written = json.dumps({"r": roots}, ensure_ascii=False, separators=(",", ":"))
                    try:
                        written.encode()
                    except UnicodeEncodeError:  # halves of characters
                        written = json.dumps({"r": roots}, separators=(",", ":"))
                    docs.append(doc)
                    out.append(written)
            yield pd.DataFrame({"doc": pd.Series(docs, dtype=b["doc"].dtype), "cuerpo": pd.Series(out, dtype=object), "ruta": None, "clase": None})
        met = list(regular.paths())
        yield pd.DataFrame({"doc": None, "cuerpo": None, "ruta": pd.Series([p for p, _ in met], dtype=object), "clase": pd.Series([k for _, k in met], dtype=object)})

    shape = T.StructType([T.StructField("doc", read.schema["doc"].dataType), *[T.StructField(n, T.StringType()) for n in ("cuerpo", "ruta", "clase")]])
    written = materialize(read.mapInPandas(run, shape), "bodies")
    root = Node("")
    for path, kind in written.where("ruta is not null").select("ruta", "clase").distinct().collect():
        n = root
        for name in json.loads(path):
            n = n.children.setdefault(name, Node(name))
        n.kinds.add(kind)
    return Bodies(written.where("cuerpo is not null").select("doc", "cuerpo"), root)
