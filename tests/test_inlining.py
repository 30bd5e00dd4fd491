"""Nested records as flat tables."""

from pyspark.sql import functions as F

from lexframe.operators import inlining as I

SCHEMA = "id bigint, _key string, one struct<a:string,two:struct<b:int>>, many array<struct<x:string,sub:array<struct<y:int>>>>, names array<string>, props map<string,int>, other array<struct<x:string,sub:array<struct<y:int>>>>"


def test_plan_inlines_singletons_and_marks_shared_shapes(spark):
    plan = I.inline_schema(spark.createDataFrame([], SCHEMA).schema)
    assert set(plan) == {"record", "record.many", "record.many.sub", "record.names", "record.props", "record.other", "record.other.sub"}
    assert plan["record"].columns["one__two__b"] == ("one", "two", "b")
    assert plan["record.many"].shared and plan["record.many.sub"].shared and not plan["record.names"].shared


def test_children_keep_key_and_place(spark):
    rows = [
        (1, "k", (None, (7,)), [("a", [(1,), None, (3,)]), None, ("c", None)], ["n", None], {"p": 1}, None),
        (2, None, None, [], None, None, [("z", [])]),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    flat = I.flatten_records(df, "id", carry={"record.many.sub": ["x"]})
    get = lambda n, *c: sorted(map(tuple, flat[n].select(*c).collect()), key=str)
    assert get("record", "_key", "_key_", "one__two__b") == [(1, "k", 7), (2, None, None)]
    assert get("record.many", "_key", "_parent_place", "_place", "x") == [(1, "", 1, "a"), (1, "", 3, "c")]
    assert get("record.many.sub", "_key", "_parent_place", "_place", "_x", "y") == [(1, "1", 1, "a", 1), (1, "1", 3, "a", 3)]
    assert get("record.names", "_key", "_place", "value") == [(1, 1, "n")]
    assert get("record.props", "_key", "_map_key", "value") == [(1, "p", 1)]
    assert get("record.other", "_key", "x") == [(2, "z")]
    assert all(t.count() == 0 for t in I.flatten_records(df.limit(0), "id").values())


def test_diagrams(spark):
    texts = [
        '{"data": {"documentNamesByType": {"3": [{"id": "a"}, null, {"docId": 12}, "x", {"id": "", "docId": "b"}, {"name": "?"}]}}, "success": true}',
        '{"documentNamesBySource": {"15": [{"id": 20004811}], "16": [{"id": "z"}], "x": []}, "documentNamesByType": null}',
        '{"documentNamesByType": {"1": {"id": "a"}}}', "{", "", None, "[]", "3",
    ]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [[tuple(x) for x in r[0]] if r[0] else [] for r in df.orderBy("i").select(I.diagram_relations(F.col("t"))).collect()]
    assert got[0] == [("3", "outgoing", ["a", None, "12", None, "b", None])]
    assert got[1] == [("15", "incoming", ["20004811"])]
    assert got[2:] == [[]] * 6


def test_elements_reached_by_several_ways_share_a_table(spark):
    leaf = "struct<id:string,name:string>"
    node = f"struct<id:string,name:string,parts:array<{leaf}>>"
    df = spark.createDataFrame(
        [(1, [("a", "x", [("b", None), None])], {"k": ("c", "y")}, [5]), (2, None, {}, None)],
        f"record_id int, tree array<{node}>, named map<string,{leaf}>, numbers array<int>",
    )
    assert {n for n, t in I.inline_schema(df.drop("record_id").schema).items() if t.shared} == {"record.tree", "record.tree.parts", "record.named"}
    flat = I.flatten_records(df, "record_id", shared=True)
    assert set(flat) == {"record", "record.tree", "record.numbers"}
    got = sorted((r["_path"], r["_key"], r["_parent_place"], r["_place"], r["_map_key"], r["id"], r["name"]) for r in flat["record.tree"].collect())
    assert got == [("record.named", 1, "", "k", "k", "c", "y"), ("record.tree", 1, "", "1", None, "a", "x"), ("record.tree.parts", 1, "1", "1", None, "b", None)]
