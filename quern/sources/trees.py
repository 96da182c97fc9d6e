"""Nested JSON trees, of any size and in any number of files, read and written by Spark's own text source.

Every object under the key `children` is a node of the object around it. The text is cut at the token "children", which
can't stand inside a JSON string, where quotes are escaped; so a split begins outside strings and right behind that key,
even in a file of one line. A first pass gives for each split how many objects it closes that it didn't open, and which
it leaves open. These few numbers, at most a tree's depth for each split, are chained on the driver; then every split
knows the objects around its beginning, and a second pass gives the nodes and their scalar fields, a row each.

Written trees are lines sorted by path, an opening and a closing one for each node, so no task holds a tree.

Defined cases: fields may come in any order and before or behind the children; other nested objects and arrays are
skipped; a top-level array is a list of roots; text behind the last closing brace is ignored; empty files give no rows;
a name or depth of another type is read as text or null; files are independent trees, unless they are one text in parts.
"""

import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.scratch import stored
from quern.sources.files import trial

CHILDREN = '"children"'
TOKEN = re.compile(r'"(?:[^"\\]|\\.)*"|[{}\[\]:,]|[^\s{}\[\]:,"]+', re.DOTALL)
OPENED = "array<struct<place: long, key: string>>"


class Walk:
    """Goes through a split's tokens from the objects open around its beginning: pairs [id, key at hand].

    Without these (None), ids are places in the split, and `closed` counts the objects that were opened before it.
    """

    def __init__(self, number: int, around: list[list] | None):
        self.number, self.stack, self.closed, self.key_outside = number, [list(x) for x in around or []], 0, None
        self.last, self.value, self.blind = ("children" if around is None or around else None), False, around is None

    def tokens(self, text: str, place: int) -> Iterator[tuple]:
        """(node, parent, key, value) rows: key None for a node itself (value: the key it stands under), else a field."""
        for found in TOKEN.finditer(text):
            token = found[0]
            if token == "{":
                parent = self.stack[-1] if self.stack else None
                self.stack.append([self.number << 40 | place + found.start(), None])
                yield self.stack[-1][0], parent and parent[0], None, parent[1] if parent else None
            elif token == "}":
                if self.stack:
                    self.stack.pop()
                else:
                    self.closed, self.key_outside = self.closed + 1, None
            elif token == ":" and self.last is not None:
                if self.stack:
                    self.stack[-1][1] = self.last
                else:
                    self.key_outside = self.last
                self.value, self.last = True, None
                continue
            elif token[0] == '"' or token not in "[],:":
                text_of = json.loads(token) if token[0] == '"' else token
                if self.value and self.stack:
                    yield self.stack[-1][0], None, self.stack[-1][1], None if token == "null" else str(text_of)
                self.last, self.value = text_of if token[0] == '"' and not self.value else None, False
                continue
            self.last, self.value = None, False


def pieces(spark: SparkSession, path: str) -> DataFrame:
    """(file, start, value): the text between the tokens "children", in order within each split."""
    rows = spark.read.option("lineSep", CHILDREN).text(path)
    return rows.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")


def walked(batches: Iterator[pa.RecordBatch], begin) -> Iterator[tuple[tuple, Walk, Iterator[tuple]]]:
    """(split, its walk, rows of one more piece); begin makes the walk of a split."""
    split, walk, place = None, None, 0
    for batch in batches:
        for file, start, value in zip(*(batch.column(c).to_pylist() for c in ("file", "start", "value"))):
            if (file, start) != split:
                split, place = (file, start), 0
                walk = begin(split)
            text = value + CHILDREN
            yield split, walk, walk.tokens(text, place)
            place += len(text)


def read_tree(spark: SparkSession, path: str, parts: bool = False, first: int | None = None) -> DataFrame:
    """(node_id, parent_id, name, depth, is_leaf) of nested JSON; a child may be named by `category`.

    Ids grow in the order of the text. parts: the files are one text, cut between objects or fields, in order of their names.
    """

    def outline(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, Walk] = {}
        for split, walk, rows in walked(batches, lambda split: Walk(0, None)):
            for _ in rows:
                pass
            held[split] = walk
        for (file, start), walk in held.items():
            opened = [{"place": i, "key": k} for i, k in walk.stack]
            kind = pa.list_(pa.struct([("place", pa.int64()), ("key", pa.string())]))
            yield pa.RecordBatch.from_arrays([pa.array([file]), pa.array([start]), pa.array([walk.closed]), pa.array([walk.key_outside], pa.string()), pa.array([opened], kind)], ["file", "start", "closed", "key", "opened"])

    text = pieces(spark, path)
    found = text.mapInArrow(outline, f"file string, start long, closed long, key string, opened {OPENED}").collect()
    around: dict[tuple, tuple[int, list]] = {}
    open_now: list[list] = []
    for number, r in enumerate(sorted(found, key=lambda r: (r["file"], r["start"]))):
        if r["start"] == 0 and not parts:
            open_now = []
        around[r["file"], r["start"]] = number, [list(x) for x in open_now]
        open_now = open_now[: max(0, len(open_now) - r["closed"])]
        if r["key"] is not None and open_now:
            open_now[-1][1] = r["key"]
        open_now += [[number << 40 | o["place"], o["key"]] for o in r["opened"]]
    known = spark.sparkContext.broadcast(around)

    def nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, kinds = ["node", "parent", "key", "value"], [pa.int64(), pa.int64(), pa.string(), pa.string()]
        held: list[tuple] = []
        for _, _, rows in walked(batches, lambda split: Walk(*known.value[split])):
            held += [r for r in rows if r[2] in (None, "name", "category", "depth", "is_leaf")]
            if len(held) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names)
                held = []
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names)

    rows = stored(text.mapInArrow(nodes, "node long, parent long, key string, value string"))
    own = F.col("key").isNull()
    field = lambda name: F.max(F.when(F.col("key") == name, F.nullif(F.col("value"), F.lit("")))).alias(name)
    made = rows.groupBy("node").agg(F.max("parent").alias("parent"), F.max(F.when(own, F.coalesce("value", F.lit("")))).alias("under"), *map(field, ("name", "category", "depth", "is_leaf")))
    made = made.where("under = 'children' OR parent IS NULL")
    inner = rows.where(own & (F.col("value") == "children")).groupBy(F.col("parent").alias("node")).agg(F.lit(True).alias("inner"))
    leaf = F.coalesce(F.lower("is_leaf") == "true", F.lit(False)) | F.col("inner").isNull()
    found = made.join(inner, "node", "left").select(
        F.col("node").alias("node_id"), F.col("parent").alias("parent_id"), F.coalesce("name", "category").alias("name"), F.coalesce(F.expr("try_cast(depth AS INT)"), F.lit(0)).alias("depth"), leaf.alias("is_leaf")
    )
    return trial(found, first)


def write_tree(nodes: DataFrame, path: str, key: str = "path") -> None:
    """Write nodes (path, an array of names from the root down, depth, is_leaf) as nested JSON, in parts that are one text.

    Paths are distinct, and every node's parent is there. Nodes are in order of their paths; each opens behind a comma, unless it is its parent's first child.
    """
    parent = F.slice(key, 1, F.size(key) - 1)
    firsts = nodes.groupBy(parent.alias("above")).agg(F.min(key).alias("path"), F.lit(True).alias("first"))
    marked = nodes.select(F.col(key).alias("path"), "depth", "is_leaf").join(firsts.select("path", "first"), "path", "left")
    head = F.to_json(F.struct(F.element_at("path", -1).alias("name"), "depth", "is_leaf"))
    opening = F.concat(F.when(F.col("first"), "").otherwise(","), F.regexp_replace(head, r"\}$", f", {CHILDREN}: ["))
    # A closing line comes behind all longer paths that begin with its own.
    lines = marked.select(F.explode(F.array(F.struct(F.col("path").alias("at"), opening.alias("line")), F.struct(F.concat("path", F.array(F.lit("\U0010ffff"))).alias("at"), F.lit("]}").alias("line")))).alias("x"))
    lines.select("x.*").orderBy("at").select("line").write.text(path)
