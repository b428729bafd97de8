"""The target graph and the profiles that bind raw tables to it. Driver side."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace

# Property types of bulk headers and the Spark type of each.
SPARK_TYPES = {
    "string": "string", "int": "int", "long": "bigint", "float": "double", "double": "double", "boolean": "boolean",
    "byte": "tinyint", "short": "smallint", "char": "string", "point": "string", "date": "date", "localtime": "string",
    "time": "string", "localdatetime": "timestamp_ntz", "datetime": "timestamp", "duration": "string",
}


@dataclass(frozen=True)
class Node:
    label: str
    key: str
    properties: dict[str, str] = field(default_factory=dict)
    subtypes: tuple[str, ...] = ()
    subtype_from: str | None = None

    @property
    def columns(self) -> list[str]:
        return [self.key, *self.properties, *([self.subtype_from] if self.subtype_from else [])]


@dataclass(frozen=True)
class Edge:
    name: str
    pairs: tuple[tuple[str, str], ...]
    properties: dict[str, str] = field(default_factory=dict)

    @property
    def columns(self) -> list[str]:
        return ["startId", "endId", "startLabel", "endLabel", *self.properties]


def _typed(properties) -> dict[str, str]:
    out: dict[str, str] = {}
    for p in properties or ():
        out.update({p: "string"} if isinstance(p, str) else p)
    return out


@dataclass(frozen=True)
class Graph:
    nodes: dict[str, Node]
    edges: dict[str, Edge]

    @classmethod
    def of(cls, nodes: dict, edges: dict) -> Graph:
        """From parsed catalogues: label -> {id, properties, subtypeLabels, subtypeFrom}
        and type -> {pairs, properties}. Raises ValueError with every inconsistency."""
        graph = cls(
            {n: Node(n, s.get("id") or "", _typed(s.get("properties")), tuple(s.get("subtypeLabels") or ()), s.get("subtypeFrom")) for n, s in nodes.items()},
            {e: Edge(e, tuple(tuple(p) for p in s.get("pairs") or ()), _typed(s.get("properties"))) for e, s in edges.items()},
        )
        if problems := graph.problems():
            raise ValueError("; ".join(problems))
        return graph

    def problems(self) -> list[str]:
        out = []
        for n in self.nodes.values():
            if not n.key:
                out.append(f"{n.label}: no id property")
            if n.subtype_from and not n.subtypes:
                out.append(f"{n.label}: subtypes are read from {n.subtype_from} but none is declared")
        for t in (*self.nodes.values(), *self.edges.values()):
            out += [f"{getattr(t, 'label', None) or t.name}.{p}: unknown type {kind}" for p, kind in t.properties.items() if kind not in SPARK_TYPES]
        for e in self.edges.values():
            if not e.pairs:
                out.append(f"{e.name}: no endpoint pairs")
            out += [f"{e.name}: {end} is not a node" for p in e.pairs for end in p if end not in self.nodes]
        return out


def read_yaml(path: str) -> dict:
    import yaml

    with open(path, encoding="utf-8") as f:
        return yaml.safe_load(f) or {}


@dataclass(frozen=True)
class Binding:
    """How one node label or edge type is read: its sources in order, key columns,
    prefixes to strip from keys, and column choices."""

    name: str
    sources: tuple[str, ...]
    keys: tuple[str | None, ...]
    pair: tuple[str, str] | None = None
    strip: tuple[str | None, ...] = (None, None)
    dedup: bool = True
    overrides: dict[str, str] = field(default_factory=dict)
    aliases: dict[str, str] = field(default_factory=dict)
    header_prefixes: tuple[str, ...] = ()


def _many(x) -> tuple:
    return () if not x else (x,) if isinstance(x, str) else tuple(x)


@dataclass(frozen=True)
class Profile:
    name: str
    nodes: dict[str, Binding]
    edges: dict[str, Binding]
    aliases: dict[str, str] = field(default_factory=dict)
    shared_aliases: dict[str, str] = field(default_factory=dict)
    header_prefixes: tuple[str, ...] = ()
    reshape: tuple[dict, ...] = ()

    @classmethod
    def of(cls, name: str, load: Callable[[str], dict], shared_aliases: dict | None = None, _open: frozenset = frozenset()) -> Profile:
        """Reads a profile and those it includes; own entries win, a circle is left out and
        reshape steps aren't inherited. ``load`` gives the parsed profile of a name."""
        data = load(name)
        common = lambda s: {"sources": _many(s["file"]), "dedup": s.get("dedup", True), "overrides": dict(s.get("props") or {}), "aliases": dict(s.get("aliases") or {}), "header_prefixes": _many(s.get("strip_header_prefix"))}
        out = cls(
            data.get("profile", name),
            {n: Binding(n, keys=(s.get("key"),), strip=(s.get("strip_prefix"),), **common(s)) for n, s in (data.get("nodes") or {}).items()},
            {
                e: Binding(e, keys=(s.get("start_key"), s.get("end_key")), pair=tuple(s["pair"]) if s.get("pair") else None,
                           strip=(s.get("strip_start_prefix"), s.get("strip_end_prefix")), **common(s))
                for e, s in (data.get("edges") or {}).items()
            },
            dict(data.get("aliases") or {}),
            dict(shared_aliases or {}),
            _many(data.get("strip_header_prefix")),
            tuple(data.get("reshape") or ()),
        )
        nodes, edges, aliases = {}, {}, {}
        for other in data.get("include") or ():
            if other == name or other in _open:
                continue
            base = cls.of(other, load, shared_aliases, _open | {name})
            nodes, edges, aliases = nodes | base.nodes, edges | base.edges, aliases | base.aliases
        return replace(out, nodes=nodes | out.nodes, edges=edges | out.edges, aliases=aliases | out.aliases)
