"""Deeply nested records to flat tables by shared inlining (problem 7).

Pass 1 reads the schema graph from all bodies: label paths, and whether they hold objects, arrays or scalars.
Elements of the same structure become one type. A type that is repeated, recursive or reached under several labels
gets a table; the others are inlined into the table above them. Pass 2 writes the rows with foreign keys.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROOT = ""
EDGE_SCHEMA = "path array<string>, label string, kind string"
ROW_SCHEMA = "type string, row_id string, parent_type string, parent_id string, label string, pos int, parent_label string, parent_pos int, fields map<string,string>"


def open_body(text: str | None) -> tuple[dict | None, str | None]:
    """The object in a body, or why there is none: ``null``, ``not_json``, ``too_deep`` or ``no_object``. A body that was
    encoded as a JSON string, however often, counts as its content."""
    if text is None:
        return None, "null"
    while isinstance(text, str):
        try:
            text = json.loads(text)
        except ValueError:
            return None, "not_json"
        except RecursionError:
            return None, "too_deep"
    return (text, None) if isinstance(text, dict) else (None, "no_object")


def read_body(text: str | None) -> dict | None:
    return open_body(text)[0]


def _kind(v: object) -> str:
    return "object" if isinstance(v, dict) else "array" if isinstance(v, list) else "null" if v is None else "scalar"


def _edges(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    seen: set[tuple[tuple[str, ...], str, str]] = set()
    for b in batches:
        for text in b.iloc[:, 0]:
            todo = [((), read_body(text))]
            while todo:
                path, node = todo.pop()
                for label, v in (node or {}).items():
                    seen.add((path, label, _kind(v)))
                    for x in v if isinstance(v, list) else [v]:
                        if isinstance(x, dict):
                            seen.add((path, label, "object"))
                            todo.append(((*path, label), x))
                        elif isinstance(v, list) and x is not None:
                            seen.add((path, label, "items"))
    if seen:
        yield pd.DataFrame([(list(p), label, k) for p, label, k in seen], columns=["path", "label", "kind"])


@dataclass
class Plan:
    """Shared-inlining plan: the type of every label path, and which types have a table."""

    type_of: dict[tuple[str, ...], str]
    tables: set[str]
    parents: dict[str, set[tuple[str, str]]] = field(default_factory=dict)
    children: dict[str, set[str]] = field(default_factory=dict)


def plan_tables(edges: list[tuple[tuple[str, ...], str, str]], alike: float = 0.5) -> Plan:
    """Analyse the schema graph. A label within one type is one type; so are siblings, or an element and one
    around it, whose child labels agree (Jaccard at least ``alike``). A path without known children joins the type
    that most of its siblings have."""
    kinds: dict[tuple[str, ...], set[str]] = {(): {"object"}}
    kids: dict[tuple[str, ...], set[str]] = {(): set()}
    for path, label, kind in edges:
        kinds.setdefault((*path, label), set()).add(kind)
        kids.setdefault(tuple(path), set()).add(label)
    nodes = sorted((p for p, k in kinds.items() if k & {"object", "array"} and "items" not in k or "object" in k), key=lambda p: (len(p), p))
    group: dict[tuple[str, ...], int] = {}
    content: list[set[str]] = []
    by_place: dict[tuple[int, str], int] = {}  # an element's name within one type is one type

    def likeness(own: set[str], g: int) -> float:
        return len(own & content[g]) / len(own | content[g])

    for p in nodes:  # outer elements first, so that a wrapper joins the type it wraps
        own = kids.get(p, set())
        if not own:
            continue
        place = (group.get(p[:-1], -1), p[-1]) if p else (-1, "")
        g = by_place.get(place)
        if g is None and p:
            near = {group[p[:k]] for k in range(len(p)) if p[:k] in group} | {x for (up, _), x in by_place.items() if up == place[0]}
            g = max((x for x in near if likeness(own, x) >= alike), key=lambda x: (likeness(own, x), -x), default=None)
        if g is None:
            g = len(content)
            content.append(set())
        group[p] = by_place[place] = g
        content[g] |= own
    for p in nodes:  # containers that were only seen empty
        if p not in group and p:
            place = (group.get(p[:-1], -1), p[-1])
            near = [x for (up, _), x in by_place.items() if up == place[0] and x != place[0]]
            if place in by_place:
                group[p] = by_place[place]
            elif near and near.count(top := max(sorted(set(near)), key=near.count)) > 1:
                group[p] = top
    names = {}
    for p in sorted(group, key=lambda p: (len(p), p)):
        names.setdefault(group[p], "record" if p == () else p[-1])
    type_of = {p: names[g] for p, g in group.items()}
    tables, parents, children, labels = {"record"}, {}, {}, {}
    for p, t in type_of.items():
        if p == ():
            continue
        up = type_of.get(p[:-1])
        parents.setdefault(t, set()).add((up or "", p[-1]))
        children.setdefault(up or "", set()).add(t)
        labels.setdefault(t, set()).add(p[-1])
        if "array" in kinds[p] or up == t:
            tables.add(t)
    tables |= {t for t, x in labels.items() if len(x) > 1}
    return Plan(type_of, tables, parents, children)


def schema_graph(df: DataFrame, body: str, most_edges: int = 100_000) -> Plan:
    """The plan for a column of JSON bodies, read from all rows. Only the distinct edges of the schema reach the
    driver; a column whose labels are data rather than schema (over ``most_edges``) is refused."""
    edges = df.select(F.col(body)).where(F.col(body).isNotNull()).mapInPandas(_edges, EDGE_SCHEMA).distinct().limit(most_edges + 1).collect()
    if len(edges) > most_edges:
        raise ValueError(f"the bodies have over {most_edges} distinct label paths: these are data, not a schema")
    return plan_tables([(tuple(e.path), e.label, e.kind) for e in edges])


def _text(v: object) -> str | None:
    return v if v is None or isinstance(v, str) else json.dumps(v, ensure_ascii=False)


def shred_body(body: dict, plan: Plan) -> list[tuple]:
    """All rows of one body: (type, row_id, parent_type, parent_id, label, pos, parent_label, parent_pos, fields)."""
    rows: list[tuple] = []
    root = ("record", "", None, None, None, None, None, None, {})
    rows.append(root)
    todo: list[tuple] = [((), body, root, "")]  # path, object, row that holds it, prefix of its inlined fields
    while todo:
        path, node, row, prefix = todo.pop()
        for label, v in node.items():
            p = (*path, label)
            t = plan.type_of.get(p)
            if t is None:
                row[8][prefix + label] = _text(v)
            elif t not in plan.tables:
                if isinstance(v, dict):
                    todo.append((p, v, row, f"{prefix}{label}."))
                else:
                    row[8][prefix + label] = _text(v)
            elif t == row[0] and isinstance(v, dict) and plan.type_of.get(path) == t and row[0] == "record":
                todo.append((p, v, row, ""))  # a wrapper around the record itself
            else:
                for pos, x in enumerate(v) if isinstance(v, list) else [(0, v)]:
                    if isinstance(x, dict):
                        new = (t, f"{row[1]}/{prefix}{label}[{pos}]", row[0], row[1], label, pos, row[4], row[5], {})
                        rows.append(new)
                        todo.append((p, x, new, ""))
                    elif x is not None and isinstance(v, list):
                        rows.append((t, f"{row[1]}/{prefix}{label}[{pos}]", row[0], row[1], label, pos, row[4], row[5], {"": _text(x)}))
    return rows


def shred(df: DataFrame, keys: list[str], body: str, plan: Plan, types: list[str] | None = None, fields: bool = True) -> DataFrame:
    """Every object of every body as one row: its type, its own id, the id of its parent within the body, label and
    position, and the scalar fields inlined into it. Nulls in arrays keep their place and give no row; a null or
    broken body gives none (``rejects`` lists these). ``keys`` are carried along and link the rows to their record. Only
    rows of ``types`` come out where these are given, and without ``fields`` where they aren't needed."""
    kinds = dict(df.dtypes)
    schema = ", ".join(f"`{k}` {kinds[k]}" for k in keys) + ", " + ROW_SCHEMA
    names = ["type", "row_id", "parent_type", "parent_id", "label", "pos", "parent_label", "parent_pos", "fields"]
    if not fields:
        names, schema = names[:-1], schema[: schema.rindex(", fields")]
    width = len(names)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out, of, ids = [], [], list(b[keys].itertuples(index=False, name=None))
            for i, text in enumerate(b[body]):
                if (obj := read_body(text)) is not None:
                    rows = [r[:width] for r in shred_body(obj, plan) if types is None or r[0] in types]
                    out += rows
                    of += [ids[i]] * len(rows)
            if not out:  # an empty column of maps can't be sent
                continue
            got = pd.DataFrame(out, columns=names).astype({"pos": "Int32", "parent_pos": "Int32"})
            for j, k in enumerate(keys):
                got[k] = [x[j] for x in of]
            yield got[[*keys, *names]]

    return df.select(*keys, body).where(F.col(body).isNotNull()).mapInPandas(run, schema)


def rejects(df: DataFrame, key: str, body: str) -> DataFrame:
    """(key, reason) of every row whose body gives nothing: null, not_json, too_deep or no_object. One row a body."""
    kind = dict(df.dtypes)[key]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            got = pd.DataFrame({key: b[key], "reason": [open_body(t)[1] for t in b[body]]})
            yield got[got["reason"].notna()]

    return df.select(key, body).mapInPandas(run, f"{key} {kind}, reason string").distinct()


def _reference_types(plan: Plan) -> tuple[list[str], list[str]]:
    """Types of references, and of the texts of their acts."""
    texts = sorted({t for p, t in plan.type_of.items() if p and p[-1] == "texts"})
    labels: dict[tuple[str, ...], set[str]] = {}
    for p in plan.type_of:
        labels.setdefault(p[:-1], set()).update(p[-1:])
    holders = {t for p, t in plan.type_of.items() if p and labels.get(p, set()) & {"act", "date", "art"}}
    return sorted(holders - {"record"}), texts


def _with_record(refs: DataFrame) -> DataFrame:
    return refs.select("record_id", "eli", "call_result").where(F.col("record_id").isNotNull() & F.col("call_result").isNotNull())


def reference_positions(refs: DataFrame) -> DataFrame:
    """(record_id, relation, ref_pos, text_pos): one row per reference object, text_pos -1, and per object in the texts of
    its act. The bodies are read twice, for the schema and for the rows, and never shuffled: rows of records that were
    fetched again fall together at the end."""
    whole = _with_record(refs)
    plan = schema_graph(whole, "call_result")
    ref_types, text_types = _reference_types(plan)
    rows = shred(whole, ["record_id"], "call_result", plan, [*ref_types, *text_types], fields=False)
    is_text = F.col("type").isin(text_types)
    relation, ref_pos = F.when(is_text, F.col("parent_label")).otherwise(F.col("label")), F.when(is_text, F.col("parent_pos")).otherwise(F.col("pos"))
    return rows.select("record_id", relation.alias("relation"), ref_pos.alias("ref_pos"), F.when(is_text, F.col("pos")).otherwise(F.lit(-1)).alias("text_pos")).distinct()


def reference_tables(refs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The flat tables of act_references: references (record_id, relation, ref_pos, ...) and their acts' texts
    (record_id, relation, ref_pos, text_pos, ...). Records fetched twice with the same body give their rows once."""
    whole = _with_record(refs)
    plan = schema_graph(whole, "call_result")
    ref_types, text_types = _reference_types(plan)
    get = lambda k: F.col("fields")[k]
    references = shred(whole, ["record_id", "eli"], "call_result", plan, ref_types).select(
        "record_id", "eli", F.col("label").alias("relation"), F.col("pos").alias("ref_pos"), get("date").alias("date"), get("art").alias("art"), get("act.ELI").alias("act_eli"), get("act.type").alias("act_type"), get("act.title").alias("act_title"), get("act.promulgation").alias("promulgation"), get("act.announcementDate").alias("announcement_date")
    )
    texts = shred(whole, ["record_id", "eli"], "call_result", plan, text_types).select("record_id", "eli", F.col("parent_label").alias("relation"), F.col("parent_pos").alias("ref_pos"), F.col("pos").alias("text_pos"), get("type").alias("text_type"), get("fileName").alias("file_name"))
    return references.distinct(), texts.distinct()
