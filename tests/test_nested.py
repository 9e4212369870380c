import json

from kodeks.operators.nested import plan_tables, read_body, reference_positions, reference_tables, rejects, schema_graph, shred

RELATIONS = ["Inf. o tekście jednolitym", "Podstawa prawna", "Uchylenia wynikające z", "Akty wykonawcze", "Akty zmieniające", "Akty uchylające"]


def found(df):
    a, b = reference_tables(df)
    out = [(r.record_id, r.relation, r.ref_pos, -1) for r in a.collect()] + [(r.record_id, r.relation, r.ref_pos, r.text_pos) for r in b.collect()]
    return sorted(set(out))


def brute(rows):
    out = set()
    for rid, body in rows:
        o = read_body(body)
        o = o.get("references", o) if isinstance(o, dict) and isinstance(o.get("references", {}), dict) else o
        for k in RELATIONS:
            v = (o or {}).get(k)
            for i, x in enumerate(v if isinstance(v, list) else [v]):
                if isinstance(x, dict):
                    out.add((rid, k, i, -1))
                    t = (x.get("act") or {}).get("texts")
                    out |= {(rid, k, i, j) for j, y in enumerate(t if isinstance(t, list) else [t]) if isinstance(y, dict)}
    return sorted(out)


def test_whole_table(spark, data):
    df = spark.read.parquet(data + "/act_references.parquet")
    assert found(df) == brute([(r.record_id, r.call_result) for r in df.collect()])


def test_edge_bodies(spark):
    ref = {"date": "2020-01-01", "act": {"ELI": "DU/1/1", "type": "Ustawa", "texts": [None, {"type": "U"}, {"fileName": "x"}]}}
    body = {"Akty zmieniające": [ref, None, {"art": ["1"], "act": {"ELI": None, "texts": {"type": "T"}}}], "Podstawa prawna": {"date": "x", "act": {"type": "y"}}, "count": 3, "Akty uchylające": []}
    rows = [(1, json.dumps(body)), (1, json.dumps(body)), (2, json.dumps(json.dumps(body))), (3, json.dumps({"ELI": "e", "references": body})), (4, "{broken"), (5, None), (6, ""), (7, "[]"), (8, "null"), (9, '"text"'), (10, "[" * 100_000), (11, json.dumps({"Akty zmieniające": [ref] * 3000}))]
    df = spark.createDataFrame([(i, "e", b, "clash", 1) for i, b in rows], "record_id long, eli string, call_result string, type string, pos int")
    got = found(df)
    assert got == brute(rows)
    assert sorted(map(tuple, reference_positions(df).collect())) == got
    assert {r.record_id: r.reason for r in rejects(df, "record_id", "call_result").collect()} == {4: "not_json", 5: "null", 6: "not_json", 7: "no_object", 8: "no_object", 9: "not_json", 10: "too_deep"}
    text = json.dumps(body)
    for _ in range(12):
        text = json.dumps(text)
    assert read_body(text) == body
    assert (1, "Akty zmieniające", 2, 0) in got and (3, "Podstawa prawna", 0, -1) in got
    assert found(df.limit(0)) == []


def test_links_and_shared_types(spark):
    body = {"a": [{"id": 1, "inner": {"x": 1, "deep": [{"n": 1}, {"n": 2}]}}], "b": {"id": 2, "inner": {"x": None}}}
    df = spark.createDataFrame([(1, json.dumps(body))], "k long, body string")
    plan = schema_graph(df, "body")
    assert plan.type_of[("a",)] == plan.type_of[("b",)] and plan.type_of[("a",)] in plan.tables
    assert plan.type_of[("a", "inner")] not in plan.tables and plan.type_of[("a", "inner", "deep")] in plan.tables
    rows = {r.row_id: r for r in shred(df, ["k"], "body", plan).collect()}
    deep = [r for r in rows.values() if r.type == "deep"]
    assert sorted(r.fields["n"] for r in deep) == ["1", "2"] and all(rows[r.parent_id].fields["inner.x"] == "1" for r in deep)


def test_recursive_elements():
    edges = [((), "items", "object"), (("items",), "name", "scalar"), (("items",), "items", "object"), (("items", "items"), "name", "scalar"), ((), "name", "scalar")]
    plan = plan_tables(edges)
    assert plan.type_of[("items",)] == plan.type_of[()] == "record"


def test_reference_dates(spark, data):
    import __spark_entry__ as entry

    want = set()
    for r in spark.read.parquet(data + "/act_references.parquet").collect():
        o = read_body(r.call_result) or {}
        o = o["references"] if isinstance(o.get("references"), dict) else o
        for k in set(RELATIONS) - {"Podstawa prawna", "Akty wykonawcze"}:
            v = o.get(k)
            for i, x in enumerate(v if isinstance(v, list) else [v]):
                if isinstance(x, dict):
                    act = x.get("act") or {}
                    own = None if k.startswith("Inf.") else x.get("date")
                    want.add((r.record_id, k, i, own or act.get("promulgation") or (act.get("announcementDate") if act.get("type") == "Obwieszczenie" else None)))
    got = {(r.record_id, r.relation, r.ref_pos, r.ref_date) for r in entry.queries()["ref_dates"](spark, data).collect()}
    assert got == want
