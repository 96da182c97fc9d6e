"""Nested trees read in splits of any size against json, and written trees read back."""

import json
import random
from collections import Counter

import pytest

from quern.sources import trees


def random_tree(rng, depth=0):
    node = {"name": rng.choice(["a", 'say "children": [{', "ü}{", "b\\", "c\nd", "", "x" * 50])}
    if rng.random() < 0.2:
        node = {"category": node["name"]}
    extra = {"meta": {"name": "no node", "children_of": [1, {"name": "nor this"}]}, "tags": ["children", "name"], "is_leaf": rng.random() < 0.3, "count": 1.5e3, "none": None}
    node |= {k: extra[k] for k in rng.sample(sorted(extra), rng.randint(0, 5))}
    if rng.random() < 0.9:
        node["depth"] = depth
    if depth < 5 and rng.random() < 0.9:
        node["children"] = [random_tree(rng, depth + 1) for _ in range(rng.randint(0, 3))]
    return dict(rng.sample(sorted(node.items()), len(node)))


def model(node, parent=None):
    """(name, parent's name, depth, is_leaf) in the order of the text, for nodes given in it."""
    name = node.get("name") or node.get("category") or None
    yield name, parent, node.get("depth", 0), bool(node.get("is_leaf")) or not node.get("children")
    for child in node.get("children") or []:
        yield from model(child, name)


def read(spark, path, **options):
    rows = trees.read_tree(spark, str(path), **options).orderBy("node_id").collect()
    names = {r["node_id"]: r["name"] for r in rows}
    return [(r["name"], names.get(r["parent_id"]), r["depth"], r["is_leaf"]) for r in rows]


@pytest.mark.parametrize("split", ["64m", "150"])
def test_trees_in_splits_of_any_size(spark, tmp_path, split):
    rng, docs = random.Random(5), []
    (tmp_path / "in").mkdir()
    for i in range(3):
        docs.append(random_tree(rng))
        while not 400 < len(json.dumps(docs[-1])) < 1500:
            docs[-1] = random_tree(rng)
        (tmp_path / "in" / f"{i}.json").write_text(json.dumps(docs[-1], ensure_ascii=i % 2 == 0, indent=2 if i > 1 else None))
    (tmp_path / "in" / "4.json").write_text("")
    (tmp_path / "in" / "5.json").write_text(json.dumps(docs[:2]))
    kept = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        got = read(spark, tmp_path / "in")
        n = trees.pieces(spark, str(tmp_path / "in")).rdd.getNumPartitions()
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    assert got == [row for d in docs + docs[:2] for row in model(d)]
    assert n > 10 or split == "64m"


def test_written_trees_are_read_back(spark, tmp_path):
    rng, paths = random.Random(3), [("r",), ("s",)]
    for _ in range(200):
        paths.append((*rng.choice([p for p in paths if len(p) < 6]), f'n{len(paths)} "x"'))
    leaves = set(paths) - {p[:-1] for p in paths}
    rows = [(list(p), len(p) - 1, p in leaves) for p in paths]
    trees.write_tree(spark.createDataFrame(rows, "path array<string>, depth int, is_leaf boolean").repartition(5), str(tmp_path / "out"))
    text = "".join(p.read_text() for p in sorted((tmp_path / "out").glob("part-*")))
    roots = json.loads(f"[{text}]")
    assert [r["name"] for r in roots] == ["r", "s"]
    want = Counter((p[-1], p[-2] if len(p) > 1 else None, len(p) - 1, p in leaves) for p in paths)
    assert Counter(row for r in roots for row in model(r)) == want
    assert Counter(read(spark, tmp_path / "out", parts=True)) == want
