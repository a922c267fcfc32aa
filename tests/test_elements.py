"""Element trees against a plain walk."""

from __future__ import annotations

import json
import os
import random

from silkgrain.sources import elements

TREE = {
    "metadata": 1,
    "pages": [
        {"elements": [{"type": "Heading", "text": " A  title ", "level": "2", "bbox": [0, 0, 50, 10]}, {"type": "paragraph", "content": "x", "page number": 7}]},
        {"page_index": 0, "kids": {"type": "list-item", "text": "", "children": [{"text": "deep"}, [{"text": "deeper", "page": "4"}]]}},
        {"page": 3, "blocks": [
            {"type": "table", "rows": [["a", "b  c"], {"cells": ["d", {"text": "e"}, ""]}, {"k": "v"}], "box": {"left": 1, "top": 2, "right": 101, "bottom": 62}},
            {"type": "table", "text": "small", "bbox": [0, 0, 10, 10]}, {"type": "image", "caption": "cap", "bounding box": {"x0": 1, "top": 2, "x1": 101, "bottom": 62}}, {"type": "picture", "bbox": [1, 2, 3]},
        ]},
        "no page", {"type": "", "text": " "},
    ],
}


def plain(node, page=1, inherit=True):
    """(type, page) of each element in order; own page, else what the nodes above say."""
    if isinstance(node, list):
        return [e for n in node for e in plain(n, page, inherit)]
    if not isinstance(node, dict):
        return []
    own = next((max(1, int(node[k])) if k in elements.INDEX else int(node[k]) for k in elements.PAGE if str(node.get(k, "")).isdigit()), None)
    here = own if own is not None else page if inherit else 1
    if isinstance(node.get("pages"), list):
        return [e for k, n in enumerate(node["pages"], 1) for e in plain(n, k, inherit)]
    kind = next((str(node[k]).strip().lower().replace("-", "_") for k in elements.TYPE if node.get(k)), "")
    out = [(kind, here)] if kind or node.get("text", "").strip() or node.get("content", "").strip() else []
    return out + [e for k in elements.CHILDREN if k in node for e in plain(node[k], here, inherit)]


def test_tree(spark):
    df = spark.createDataFrame([("a", json.dumps(TREE)), ("b", "no json"), ("c", None), ("d", "[]"), ("e", '{"text": "only"}'), ("f", "3")], "document_id string, json string")
    found = elements.elements(df)
    rows = {d: [r for r in found.orderBy("way").collect() if r["document_id"] == d] for d in "abcdef"}
    assert [(r["type"], r["page"]) for r in rows["a"]] == plain(TREE) and len(rows["a"]) == 9
    assert [(r["type"], r["text"], r["page"]) for r in rows["e"]] == [("", "only", 1)] and not rows["b"] + rows["c"] + rows["d"] + rows["f"]
    table = next(r for r in rows["a"] if r["type"] == "table")
    assert table["text"] == "a | b c\nd | e\nv" and table["box"] == [1.0, 2.0, 101.0, 62.0]
    objects = elements.element_objects(found)
    assert [(r["object_id"], r["caption"], r["ocr_status"]) for r in objects.orderBy("object_id").collect()] == [("F_p003_tree_001", "cap", "pending"), ("T_p003_tree_001", table["text"], "not_required")]
    assert json.loads(objects.where("object_type = 'table'").collect()[0]["body"])[0] == ["a", "b  c"]
    pages = {(r["document_id"], r["page"]): r for r in elements.element_pages(found, clean=False).collect()}
    assert pages["a", 1]["lines"][0]["text"] == "## A title" and pages["a", 1]["lines"][0]["level"] == 2 and pages["a", 3]["n_tables"] == 2 and pages["a", 3]["has_images"]
    assert all("\n".join(x["text"] for x in p["lines"])[x["start"] : x["end"]] == x["text"] for p in pages.values() for x in p["lines"])
    report = {r["document_id"]: (r["elements"], r["pages"], r["objects"]) for r in elements.element_report(found, objects).collect()}
    assert report == {"a": (9, len({p for _, p in plain(TREE)}), 2), "e": (1, 1, 0)}
    assert {r["page"] for r in elements.elements(df, inherit=False).where("document_id = 'a' AND text LIKE 'deep'").collect()} == {1}


def test_random_trees(spark):
    rng = random.Random(4)

    def tree(depth):
        if rng.random() < 0.2:
            return [tree(depth + 1) for _ in range(rng.randrange(3))] if depth < 6 else 5
        node = {}
        if rng.random() < 0.6:
            node["text"] = rng.choice(("t", "", "two words"))
        if rng.random() < 0.5:
            node[rng.choice(elements.TYPE)] = rng.choice(("Heading", "table", "", "list-item"))
        if rng.random() < 0.4:
            node[rng.choice(elements.PAGE)] = rng.choice((2, "3", 0, "x"))
        if depth < 6:
            for k in rng.sample(elements.CHILDREN, rng.randrange(3)):
                node[k] = rng.choice(([tree(depth + 1) for _ in range(rng.randrange(3))], tree(depth + 1)))
            if rng.random() < 0.1:
                node["pages"] = [tree(depth + 1) for _ in range(2)]
        return node

    trees = {k: tree(0) for k in range(30)}
    found = elements.elements(spark.createDataFrame([(k, json.dumps(v)) for k, v in trees.items()], "document_id int, json string")).orderBy("way").collect()
    for k, v in trees.items():
        assert [(r["type"], r["page"]) for r in found if r["document_id"] == k] == plain(v)


def test_a_tree_is_stored_once(spark):
    """Lists, pages and nodes above the elements aren't stored; a tree deeper than one walk gives all its elements."""
    folder = spark.conf.get("spark.checkpoint.dir").removeprefix("file:")
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    flat = {"pages": [{"elements": [{"type": "paragraph", "text": f"t{k}", "kids": [{"text": "u"}]} for k in range(4)]}]}
    assert elements.elements(spark.createDataFrame([(1, json.dumps(flat))], "document_id int, json string")).count() == 8
    assert len(set(os.listdir(folder)) - before) == 1
    node = {"text": "0"}
    for k in range(1, 3 * elements.WALK):
        node = {"text": str(k), "kids": node}
    got = elements.elements(spark.createDataFrame([(1, json.dumps(node))], "document_id int, json string")).orderBy("way").collect()
    assert [int(r.text) for r in got] == list(range(3 * elements.WALK))[::-1]
