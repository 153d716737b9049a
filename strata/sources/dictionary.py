"""Data dictionary loading (S12, V7) and the node-link graph input of T5.

The dictionary is one JSON document, or several that refer to each other
(metadata-sized):

    {"_version": "1.0.0",
     "_definitions": {"<name>": {<property schema>}, ...},
     "<node>": {"required": [...],
                "properties": {"<prop>": {"type", "enum", "minimum", "maximum",
                                          "pattern", "format", "minItems",
                                          "$ref": "#/_definitions/<name>"}},
                "links": [{"name", "target_type", "required"},
                          {"required", "subgroup": [<links>]}]}}

It becomes DataFrames: ``rules`` (node, property, validator, value,
schema_path), ``links`` (child, parent, name, required, subgroup, where a
subgroup names links of which one is enough), ``nodes`` and ``ref_errors``
(V7: whatever could not be read or resolved, naming the place). A ``$ref`` may
lead through further refs and into other files (``file.json#/path``); keywords
beside a ref win over those it leads to.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The property validators, in the order their findings are listed.
VALIDATORS = ("type", "enum", "minimum", "maximum", "pattern", "format", "minItems")
# An object with one of these keys is a node's schema.
NODE_KEYWORDS = frozenset({"properties", "links", "required", "additionalProperties", "type", "id", "title"})


@dataclass
class Dictionary:
    rules: DataFrame
    links: DataFrame
    nodes: DataFrame
    ref_errors: DataFrame
    version: DataFrame
    properties: DataFrame
    #: Each node's schema with its refs resolved at every depth (plain values).
    schemas: dict[str, dict] = field(default_factory=dict)


class _Unresolved(Exception):
    pass


class _Documents:
    """The parsed files by name; ``#/...`` within a file stays in that file."""

    def __init__(self, texts: dict[str, str]):
        self.docs: dict[str, dict] = {}
        self.broken: list[str] = []
        for name, text in sorted(texts.items()):
            try:
                doc = json.loads(text, parse_int=_Number, parse_float=_Number)  # numbers keep their spelling
                if not isinstance(doc, dict):
                    raise ValueError("not a JSON object")
                self.docs[name] = doc
            except ValueError as exc:
                self.broken.append(f"unreadable dictionary file '{name}': {exc}")

    def follow(self, file: str, ref: str) -> tuple[str, dict]:
        name, hash_, path = ref.partition("#")
        target = name or file
        # A bundle may hold another file under its name in the same document.
        at = self.docs.get(target, self.docs[file].get(target) if target != file else None)
        if not hash_ or at is None:
            raise _Unresolved
        for part in (p for p in path.split("/") if p):
            if not isinstance(at, dict) or part not in at:
                raise _Unresolved
            at = at[part]
        if not isinstance(at, dict):
            raise _Unresolved
        return target if target in self.docs else file, at

    def merged(self, file: str, schema: dict, seen: tuple = ()) -> dict:
        """The schema with its chain of refs laid under its own keywords."""
        ref = schema.get("$ref")
        if ref is None:
            return schema
        if (file, ref) in seen:
            raise _Unresolved(f"circular $ref '{ref}'")
        try:
            where, target = self.follow(file, str(ref))
        except _Unresolved:
            raise _Unresolved(f"unresolved $ref '{ref}'") from None
        under = self.merged(where, target, (*seen, (file, ref)))
        return {**under, **{k: v for k, v in schema.items() if k != "$ref"}}


    def resolved(self, file: str, schema, seen: tuple = ()):
        """The schema with refs resolved inside its properties and items too,
        numbers as numbers. A schema that holds itself cannot be written out."""
        if not isinstance(schema, dict):
            return schema
        ref = schema.get("$ref")
        if (file, ref) in seen:
            raise _Unresolved(f"circular $ref '{ref}'")
        deeper = (*seen, (file, ref)) if ref is not None else seen
        full = {k: v if k in ("properties", "items") else _plain(v) for k, v in self.merged(file, schema).items()}
        if isinstance(full.get("properties"), dict):
            full["properties"] = {n: self.resolved(file, x, deeper) for n, x in full["properties"].items()}
        if isinstance(full.get("items"), dict):
            full["items"] = self.resolved(file, full["items"], deeper)
        return full


class _Number(str):
    """A number as the document spells it."""


def _plain(value):
    """A keyword's value with its numbers as numbers."""
    if isinstance(value, _Number):
        return int(value) if value.lstrip("-").isdigit() else float(value)
    if isinstance(value, list):
        return [_plain(v) for v in value]
    return {k: _plain(v) for k, v in value.items()} if isinstance(value, dict) else value


def _value_text(validator: str, value) -> str:
    if validator == "enum" and isinstance(value, list):
        value = [v if v is None or isinstance(v, str) else json.dumps(v) for v in value]
    return value if isinstance(value, str) else json.dumps(value, separators=(",", ":"), ensure_ascii=False)


def _link_rows(node: str, links, group: str | None = None) -> Iterator[tuple]:
    for i, link in enumerate(links or []):
        if isinstance(link, dict) and "subgroup" in link:
            name = f"{group or node + '/links'}/{i}"
            yield from _link_rows(node, link["subgroup"], name if _truthy(link.get("required")) else None)
        else:
            yield node, link, group


def _truthy(value) -> bool:
    return value is True or str(value).lower() == "true"


def _build(spark: SparkSession, texts: dict[str, str]) -> Dictionary:
    docs = _Documents(texts)
    rules, links, nodes, named, errors, version = [], [], [], [], [], None
    schemas: dict[str, dict] = {}
    errors += [(None, None, None, message) for message in docs.broken]
    for file, doc in docs.docs.items():
        version = doc.get("_version", version)
        for node, spec in doc.items():
            if node.startswith("_") or node in docs.docs or node.endswith((".json", ".yaml")):
                continue
            if isinstance(spec, dict) and spec and not NODE_KEYWORDS & spec.keys():
                continue  # a group of definitions
            nodes.append(node)
            if not isinstance(spec, dict):
                errors.append((node, None, None, f"node '{node}' in {file} is not an object"))
                continue
            rules += [(node, p, "required", None, f"{node}/required") for p in spec.get("required") or []]
            for prop, schema in (spec.get("properties") or {}).items():
                named.append((node, prop))
                at = f"{file} (node '{node}', property '{prop}')"
                if not isinstance(schema, dict):
                    errors.append((node, prop, None, f"schema in {at} is not an object"))
                    continue
                try:
                    full = docs.merged(file, schema)
                except _Unresolved as exc:
                    errors.append((node, prop, str(schema.get("$ref")), f"{exc} in {at}"))
                    continue
                rules += [(node, prop, v, _value_text(v, full[v]), f"{node}/properties/{prop}/{v}")
                          for v in VALIDATORS if full.get(v) is not None]
            schemas[node] = {k: spec[k] for k in ("type", "required", "additionalProperties") if k in spec}
            schemas[node]["properties"] = {}
            for prop, schema in (spec.get("properties") or {}).items():
                try:
                    schemas[node]["properties"][prop] = docs.resolved(file, schema)
                except _Unresolved as exc:
                    message = f"{exc} in {file} (node '{node}', property '{prop}')"
                    if not any(e[3] == message for e in errors):
                        errors.append((node, prop, None, message))
            for child, link, group in _link_rows(node, spec.get("links")):
                if not isinstance(link, dict) or not link.get("name") or not link.get("target_type"):
                    errors.append((node, None, None, f"link without name or target_type in {file} (node '{node}')"))
                else:
                    links.append((child, link["target_type"], link["name"], _truthy(link.get("required")), group))
    known = set(nodes)
    errors += [(c, n, None, f"link '{n}' of node '{c}' targets unknown node '{p}'") for c, p, n, *_ in links if p not in known]
    return Dictionary(
        rules=spark.createDataFrame(rules, "node string, property string, validator string, value string, schema_path string"),
        links=spark.createDataFrame(links, "child string, parent string, name string, required boolean, subgroup string"),
        nodes=spark.createDataFrame([(n,) for n in dict.fromkeys(nodes)], "node string"),
        ref_errors=spark.createDataFrame(errors, "node string, property string, ref string, error string"),
        version=spark.createDataFrame([(version,)], "schema_version string"),
        properties=spark.createDataFrame(named, "node string, property string"), schemas=schemas)


def read_dictionary(spark: SparkSession, path: str) -> Dictionary:
    """The dictionary file at ``path``, or all files of a folder or glob
    (read with Spark, so any store it knows will do)."""
    rows = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("f"), "value").collect()
    return _build(spark, {r.f: r.value for r in rows})


def dictionary_from_obj(spark: SparkSession, obj: dict, source: str = "<inline>") -> Dictionary:
    """Same as :func:`read_dictionary` for an in-memory document (tests,
    dictionaries shipped with the library)."""
    return _build(spark, {source: json.dumps(obj)})


def links_frame(spark: SparkSession, links: list[tuple[str, str]]) -> DataFrame:
    """(child, parent) edges as a DataFrame."""
    return spark.createDataFrame(links, "child string, parent string")
