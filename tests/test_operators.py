"""Operators against small models and properties."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from quern.operators import convert, expand, external, minhash, select, similarity
from quern.sources import files, trees
from quern.streaming.resume import resumable


def near_copies(seed=1, groups=8):
    rng = random.Random(seed)
    rows = []
    for g in range(groups):
        base = "".join(rng.choice("abcdefgh ") for _ in range(200))
        for c in range(rng.randint(1, 5)):
            chars = list(base)
            for _ in range(rng.randint(0, 6)):
                chars[rng.randrange(len(chars))] = rng.choice("xyz")
            rows.append((len(rows), "".join(chars) + "!" * rng.randint(0, 3)))
    return [*rows, (len(rows), ""), (len(rows) + 1, None), (len(rows) + 2, rows[0][1])]


def model_greedy(rows, threshold):
    grams = lambda t: {t[i : i + 5] for i in range(len(t) - 4)} if len(t) >= 5 else {t}
    norm = {i: (t or "").lower().strip() for i, t in rows}
    order = sorted(rows, key=lambda r: (-len(r[1] or ""), r[0]))
    kept, once = [], []
    for n, (i, _) in enumerate(order):
        x = grams(norm[i])
        alike = lambda j, x=x: len(x & grams(norm[j])) / len(x | grams(norm[j])) >= threshold
        if not any(alike(j) for j in kept):
            kept.append(i)
        if not any(alike(j) for j, _ in order[:n]):
            once.append(i)
    return sorted(kept), sorted(once)


@pytest.mark.parametrize("threshold", [0.7, 0.85])
def test_dedup_matches_the_model(spark, threshold):
    rows = near_copies()
    df = spark.createDataFrame(rows, "id long, text string").repartition(3)
    greedy, once = model_greedy(rows, threshold)
    # 64 bands of 2 samples find every pair of such similarity.
    got = minhash.deduplicate(df, "id", "text", threshold, n_bands=64)
    assert sorted(r["id"] for r in got.collect()) == greedy
    assert sorted(r["id"] for r in minhash.deduplicate(df, "id", "text", threshold, n_bands=64, greedy=False).collect()) == once
    assert minhash.deduplicate(got, "id", "text", threshold, n_bands=64).count() == len(greedy)


@pytest.mark.parametrize("few", [1_000_000, 0])
def test_links_are_walked_in_order_of_rank(spark, few):
    rng = random.Random(5)
    links = sorted({tuple(sorted(rng.sample(range(40), 2))) for _ in range(50)})
    stay = []
    for i in range(40):
        if not any((j, i) in links for j in stay):
            stay.append(i)
    rank = minhash.with_rank(spark.createDataFrame([(i, 100 - i) for i in range(40)], "id long, size long"))
    gone = minhash.survivors_of_links(spark.createDataFrame(links, "better long, worse long"), rank, few)
    assert sorted(r["id"] for r in gone.collect()) == sorted(set(range(40)) - set(stay))


def test_rounds_of_unlike_rows_of_one_bucket_stay_few(spark, monkeypatch):
    rng = random.Random(6)
    rows = [(i, "".join(rng.choice("abcdefgh") for _ in range(60))) for i in range(120)]
    calls, led = [], minhash.led
    monkeypatch.setattr(minhash, "led", lambda *a: calls.append(1) or led(*a))
    # Bands of one sample out of 2000 possible shingle minima put most rows into common buckets.
    df = spark.createDataFrame(rows, "id long, text string")
    assert minhash.deduplicate(df, "id", "text", 0.7, n_bands=64, k=2).count() == len(rows) and len(calls) <= 6


def test_large_buckets_meet_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(minhash.compared, "__defaults__", (7,))
    rows = near_copies(seed=4, groups=6)
    df = spark.createDataFrame(rows, "id long, text string")
    greedy, once = model_greedy(rows, 0.8)
    assert sorted(r["id"] for r in minhash.deduplicate(df, "id", "text", 0.8, n_bands=64).collect()) == greedy
    assert sorted(r["id"] for r in minhash.deduplicate(df, "id", "text", 0.8, n_bands=64, greedy=False).collect()) == once


def test_dedup_needs_its_column_and_takes_empty_tables(spark):
    df = spark.createDataFrame([], "id long, text string")
    with pytest.raises(ValueError, match="no column"):
        minhash.deduplicate(df, "id", "response")
    assert minhash.deduplicate(df, "id", "text").count() == 0
    assert minhash.dedup_report(df, df).first()["kept_percent"] is None


def test_known_counts_on_the_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    assert minhash.deduplicate(docs, "doc_id", "text", 0.8).count() == 873
    assert minhash.deduplicate(docs, "doc_id", "text", 0.8, greedy=False).count() == 872


def test_quotas_and_synthesis(spark):
    assert expand.quotas(spark, 2000).agg(F.sum("n")).first()[0] == 1876
    assert expand.quotas(spark, 500).agg(F.sum("n")).first()[0] == 481
    assert expand.quotas(spark, 2000, exact=True).agg(F.sum("n")).first()[0] == 2000


def test_tree(spark):
    nodes = spark.createDataFrame([(0, None, "ROOT", 0, False), (1, 0, "a", 1, False), (2, 0, "b", 1, True), (3, 1, "c", 2, False)], "node_id long, parent_id long, name string, depth int, is_leaf boolean")
    paths = {r["node_id"]: (r["root"], r["path"]) for r in expand.leaf_paths(nodes).collect()}
    assert paths == {2: ("b", ["b"]), 3: ("a", ["a", "c"])}
    assert tuple(expand.tree_stats(nodes).first()) == (4, 2, 2, 0.75)
    fetch = lambda p: p.crossJoin(spark.range(2)).select((F.col("node_id") * 10 + F.col("id") + 1).alias("node_id"), F.col("node_id").alias("parent_id"), F.lit("x").alias("name"))
    grown = expand.grow(nodes, fetch, 3)
    assert grown.count() == 6 and grown.agg(F.max("depth")).first()[0] == 3


def test_splits(spark):
    df = spark.range(101).withColumnRenamed("id", "k")
    split = convert.train_val_split(df, "k")
    assert split.where("is_train").count() == 90 and split.select("k").distinct().count() == 101
    again = convert.train_val_split(df.repartition(7), "k")
    assert split.where("is_train").join(again.where("is_train"), "k").count() == 90
    assert sorted(r["position"] for r in convert.shuffled(df, "k").collect()) == list(range(101))
    assert 60 < convert.hash_split(df, "k").where("is_train").count() <= 101


def test_grpo_conversion(spark):
    kind = "array<struct<id: int, title: string, maxScore: int, description: string>>"
    rows = spark.createDataFrame([("p", "q", "r", "h"), (None, "q", "r", None), (None, None, None, None)], "prompt string, question string, reference string, reference_html string")
    got = convert.to_grpo(rows, "web", kind).select("prompt", "extra_info.question", "extra_info.reference", F.size("extra_info.checklist")).collect()
    assert [tuple(r) for r in got] == [("p", "p", "h", 0), ("q", "q", "r", 0), ("", "", None, 0)]


def test_similarity():
    import difflib

    rng = random.Random(2)
    for _ in range(50):
        a, b = ([rng.choice("abc") for _ in range(rng.randint(0, 12))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        assert similarity.common_subsequence(a, b) == table[-1][-1]
    page = "<html><body><header>x</header><div class='nav-bar' id=z><p>y</p><br></div></body></html>"
    assert similarity.structural_similarity(page, page) == 1 and similarity.semantic_similarity(page, page) == 1
    assert similarity.structural_similarity(page, "") == 0 and similarity.structural_similarity("", "") == 1
    assert [similarity.role_elements(page)[r] for r in ("header", "nav", "ad")] == [["header"], ["div"], ["header"]]
    assert difflib.SequenceMatcher(None, ["a"], ["a"]).ratio() == 1


def test_repetition():
    rng = random.Random(3)
    clean = "".join(rng.choice("abcdefghijklmnop") for _ in range(20000))
    assert not similarity.is_repetitive("ab" * 40) and similarity.is_repetitive("ab" * 60)
    assert not similarity.is_repetitive(clean) and similarity.is_repetitive(clean[:4000] * 4)


def echo():
    """A stand-in for a service: answers in capitals, fails for prompts that hold `bad`, is busy at first for `busy`."""

    class Echo:  # made here, so that it travels to the workers by value
        def __init__(self):
            self.asked = {}

        def complete(self, prompt):
            self.asked[prompt] = n = self.asked.get(prompt, 0) + 1
            if "bad" in prompt or ("busy" in prompt and n < 3):
                raise RuntimeError("429 too many" if "busy" in prompt else "refused")
            return "draft" if "slow" in prompt and n < 2 else prompt.upper()

    return Echo


def test_external_stage_retries_and_resumes(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "bad"), (3, None), (4, "busy"), (5, "slow")], "id long, prompt string")
    got = external.external_stage(rows, echo(), "id", "prompt", sleep=lambda s: None, accepts=str.isupper)
    found = {r["id"]: (r["response"], r["ok"]) for r in got.collect()}
    assert found == {1: ("A", True), 2: (None, False), 3: (None, False), 4: ("BUSY", True), 5: ("SLOW", True)}
    assert [r["id"] for r in select.not_done(rows, got.where("ok"), "id").orderBy("id").collect()] == [2, 3]


def test_waits_grow_and_are_longer_when_busy():
    waits = []
    how = dict(wait=(1, 1), busy_wait=(10, 10), is_busy=lambda e: "429" in str(e), sleep=waits.append)
    assert external.ask(echo()(), "busy", **how) == ("BUSY", None) and waits == [10, 20]
    waits.clear()
    answer, error = external.ask(echo()(), "x", accepts=lambda a: False, **how)
    assert answer is None and "not accepted" in error and waits == [1, 2]


def test_resumable_stream(spark, tmp_path):
    source, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    spark.range(3).write.parquet(f"{source}/a")
    stage = lambda df: df.withColumn("double", F.col("id") * 2)
    resumable(spark, f"{source}/*", "id long", stage, out, state).awaitTermination()
    spark.range(3, 5).write.parquet(f"{source}/b")
    resumable(spark, f"{source}/*", "id long", stage, out, state).awaitTermination()
    assert sorted(r["double"] for r in spark.read.parquet(out).collect()) == [0, 2, 4, 6, 8]


def test_files(spark, tmp_path):
    path = tmp_path / "r.jsonl"
    path.write_text('{"a": 1}\n\nnot json\n{"a": 2, "b": "x"}\n')
    assert files.read_records(spark, str(path), "a int, b string").count() == 2
    assert files.read_records(spark, str(path), "a int, b string", bad="keep").where("_bad IS NOT NULL").count() == 1
    with pytest.raises(Exception):
        files.read_records(spark, str(path), "a int, b string", bad="fail").collect()
    tree = tmp_path / "t.json"
    tree.write_text('{"name": "ROOT", "depth": 0, "children": [{"category": "a", "depth": 1, "children": []}]}')
    assert [(r["name"], r["is_leaf"]) for r in trees.read_tree(spark, str(tree)).orderBy("node_id").collect()] == [("ROOT", False), ("a", True)]
    assert files.read_records(spark, str(path), "a int, b string", first=1).count() == files.read_table(spark, str(path), "a int", first=1).count() == trees.read_tree(spark, str(tree), first=1).count() == 1
    names = tmp_path / "c.txt"
    names.write_text("L1: Games\n\n2:Tools\n  Plain \n")
    assert sorted(r["name"] for r in files.read_categories(spark, str(names)).collect()) == ["Games", "Plain", "Tools"]
    assert files.read_categories(spark, str(names), first=2).count() == 2
    split = convert.hash_split(spark.range(50), "id")
    files.write_split(split, str(tmp_path / "x.parquet"))
    assert spark.read.parquet(str(tmp_path / "x_train.parquet")).count() + spark.read.parquet(str(tmp_path / "x_val.parquet")).count() == 50
    files.write_by_root(spark.createDataFrame([(1, "A & B/C")], "i int, root string"), str(tmp_path / "roots"), F.col("root"))
    assert (tmp_path / "roots" / "root_safe=A_and_B_C").exists()


def test_filter_chain_and_stats(spark):
    good = "<html><head></head><body>" + 20 * "<p>x</p>" + "</body></html>"
    rows = spark.createDataFrame([(1, good, 90.0), (2, good, 95.0), (3, "bad", 99.0), (4, good, float("nan")), (5, good, None)], "id long, response string, quality_score double")
    assert [r["id"] for r in select.filter_chain(rows, "id", target=1).collect()] == [2]
    assert sorted(r["id"] for r in select.filter_chain(rows.drop("quality_score"), "id").collect()) == [1, 2, 4, 5]
    assert tuple(select.score_stats(rows, "quality_score").first()) == (pd.Series([90, 95, 99]).mean(), 95.0, 90.0, 99.0)


def test_a_cluster_needs_a_shared_folder():
    from unittest.mock import MagicMock

    from quern import scratch

    session = MagicMock()
    session.conf.get.return_value = session.sparkContext.getCheckpointDir.return_value = None
    session.sparkContext.master = "spark://somewhere:7077"
    with pytest.raises(RuntimeError, match="checkpoint"):
        scratch.shared_folder(session)


def test_scratch_tables(spark):
    from quern import scratch

    kept = scratch.stored(spark.range(5))
    assert scratch.without(kept, spark.range(3), ["id"]).count() == 2 and scratch.without(kept, spark.range(3), ["id"], most=0).count() == 2
    rows = spark.range(100).selectExpr("IF(id < 80, 0, id) AS k", "id")
    names = scratch.stored(rows.groupBy("k").agg(F.count("*").alias("n"), F.min("id").alias("first")))
    got = sorted((r["id"], r["k"], r["first"]) for r in scratch.joined(rows, names, ["k"], crowd=10).collect())
    assert got == [(i, 0 if i < 80 else i, 0 if i < 80 else i) for i in range(100)]
    scratch.clear(spark)
    with pytest.raises(Exception):
        kept.count()


def test_records_in_and_out(spark, tmp_path):
    rows = spark.createDataFrame([(1, "x"), (2, None)], "a int, b string")
    files.write_records(rows, str(tmp_path / "out.jsonl"))
    assert '"b":null' in "".join(p.read_text() for p in (tmp_path / "out.jsonl").glob("part-*"))
    assert files.read_table(spark, str(tmp_path / "out.jsonl"), "a int, b string").count() == 2
    rows.write.parquet(str(tmp_path / "p.parquet"))
    assert files.read_table(spark, str(tmp_path / "p.parquet")).count() == 2
    folder = tmp_path / "folder"
    folder.mkdir()
    for name in ("a", "b", "c"):
        rows.withColumn("name", F.lit(name)).toPandas().to_parquet(folder / f"{name}.parquet")
    (folder / "broken.parquet").write_text("no parquet")
    assert files.read_parquet_folder(spark, str(folder), ["b"]).count() == 3
    (folder / "broken.parquet").unlink()
    assert sorted(r["name"] for r in files.read_parquet_folder(spark, str(folder), ["b"], max_files=2).collect()) == ["a", "b"]
    (tmp_path / "t.jsonl").write_text('{"prompt_template": "{a}", "variables": ["a"]}\n{"prompt_template": "x"}\n')
    assert files.read_templates(spark, str(tmp_path / "t.jsonl")).count() == 1
    many = tmp_path / "many"
    many.mkdir()
    (many / "one.jsonl").write_text('{"a": 1}\n{"a": 2}\n')
    (many / "two.jsonl").write_text('{"a": 3}\n')
    found = files.read_folder_of_records(spark, str(many), "a int")
    assert sorted((r["a"], r["stem"]) for r in found.collect()) == [(1, "one"), (2, "one"), (3, "two")]
    files.write_by_stem(found, str(tmp_path / "stems"))
    assert sorted(p.name for p in (tmp_path / "stems").glob("file=*")) == ["file=one_output.jsonl", "file=two_output.jsonl"]
    files.write_object(rows.limit(1), str(tmp_path / "object"))
    assert '"a" : 1' in "".join(p.read_text() for p in (tmp_path / "object").glob("part-*"))


def test_prompts_checklists_and_chats(spark):
    from quern.functions import replies

    row = spark.createDataFrame([("Maps", "a, b", None)], "name string, parts string, none string")
    assert row.select(expand.render_prompt("Make {name}:\n- {parts}{none}", ["name", "parts", "none"], ["parts"])).first()[0] == "Make Maps:\n- a\n- b"
    lists = spark.createDataFrame([([1, 2], [3])], "own array<int>, every array<int>")
    assert lists.select(expand.full_checklist(F.col("own"), F.col("every"))).first()[0] == [1, 2, 3]
    chats = spark.createDataFrame([([("hello",), ("there",)],), ([],), (None,)], "m array<struct<content: string>>")
    assert [r[0] for r in chats.select(replies.conversation_text(F.col("m"))).collect()] == ["hello", "", ""]
    asked = spark.createDataFrame([('[{"role": "user", "content": "q"}]',), ('["plain"]',), ("text",), ("[not json",), (None,), ("[]",)], "q string")
    assert [r[0] for r in asked.select(replies.question_text(F.col("q"))).collect()] == ["q", "plain", "text", "[not json", "", "[]"]


def test_best_per_group_and_numbering(spark):
    rows = spark.createDataFrame([("x", 3, 1), ("x", 5, 2), ("y", 1, 3), ("x", 5, 4)], "g string, s int, id int")
    best = minhash.best_per_group(rows, ["g"], F.desc("s"), F.asc("id"))
    assert sorted((r["g"], r["id"]) for r in best.collect()) == [("x", 2), ("y", 3)]
    assert [r["id"] for r in convert.numbered(rows, "s", "id").orderBy("position").collect()] == [3, 1, 2, 4]
    assert [r["position"] for r in convert.numbered(rows, "s", "id").orderBy("position").collect()] == [0, 1, 2, 3]
    assert convert.numbered(rows.limit(0), "s").count() == 0


def test_tree_nodes(spark):
    made = expand.make_nodes(spark.createDataFrame([("b",), ("a",), (None,), ("b",)], "name string"))
    assert sorted(tuple(r) for r in made.collect() if r["node_id"]) == [(1, 0, "a", 1, False), (2, 0, "b", 1, False)]
    assert made.where("node_id = 0 AND parent_id IS NULL AND depth = 0").count() == 1


def test_record_projection_and_counters(spark):
    page = "<html><head></head><body>" + 21 * "<p>x</p>" + "</body></html>"
    fenced = "```html\n" + page + "\n```"
    rows = spark.createDataFrame([(1, fenced, True, None), (2, fenced, False, None), (3, "none", True, None), (4, "```html\n<p>\n```", True, None), (5, fenced, None, None), (None, None, None, "{bad")], "index int, response string, generation_success boolean, _bad string")
    kept = select.valid_records(rows).collect()
    assert [(r["index"], r["response"], r["source"], r["extraction_method"], r["html_length"]) for r in kept] == [(1, page, None, "html_block", len(page))] and len(kept[0]) == 12
    counts = {r["counter"]: r["n"] for r in select.record_counters(rows, bad_col="_bad").collect()}
    assert counts == {"json_error": 1, "total": 5, "generation_failed": 2, "extract_html_block": 2, "extract_no_html_block": 1, "valid_valid": 1, "valid_too_short": 1, "valid_total": 1}


def test_similarity_of_golden_shingles(spark):
    sets = spark.createDataFrame([("abcdefgh", "abcdefgi")], "a string, b string").select(minhash.shingles(F.col("a")).alias("x"), minhash.shingles(F.col("b")).alias("y"))
    assert sets.select(minhash.jaccard(F.col("x"), F.col("y"))).first()[0] == 0.6


def test_approximate_statistics(spark):
    rows = spark.range(1, 1001).select(F.col("id").cast("double").alias("s"))
    assert abs(select.score_stats(rows, "s", accuracy=1000).first()["median"] - 500) <= 2
    assert tuple(select.batch_summary(rows, "s").first()) == (500.5, 1.0, 1000.0)


def test_prompts_are_drawn_once_a_row_in_many_tasks(spark):
    leaves = spark.createDataFrame([(i, ["a", f"b{i}"]) for i in range(40)], "node_id long, path array<string>").coalesce(1)
    templates = spark.createDataFrame([("{web_category} {color_scheme} {web_category} {x}", ["color_scheme", "web_category", "x"])], "prompt_template string, variables array<string>")
    made = expand.fill_prompts(leaves, templates, per_leaf=5)
    assert made.rdd.getNumPartitions() >= 4
    # Values are hashed below the join with the templates; above it they'd be hashed for each variable.
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert "md5" not in plan[: plan.index("Join")] and "md5" in plan
    rows = made.collect()
    assert len(rows) == 200 and all(r["prompt"].startswith(f"{r['web_category']} ") and r["prompt"].endswith(f" {r['web_category']} {{x}}") and r["prompt"].split(" > ")[0] == "a" for r in rows)


@pytest.mark.parametrize("find", ["pairs", "oneshot", "greedy"])
def test_near_copies_of_long_texts_travel_a_few_times(spark, find):
    """Copies share all 16 bands; sets of 64-bit hashes, sent once a bucket, would be a hundred times the texts."""
    rng = random.Random(8)
    rows = []
    for _ in range(30):
        text = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(2000))
        rows += [(len(rows) + i, text + " copy" * i) for i in range(3)]
    df = spark.createDataFrame(rows, "id long, text string").repartition(3).localCheckpoint()
    sc = spark.sparkContext

    def moved():
        sc._jsc.sc().listenerBus().waitUntilEmpty()
        stages = sc._jsc.sc().statusStore().stageList(None, False, False, sc._gateway.new_array(sc._jvm.double, 0), None)
        return sum(stages.apply(i).shuffleWriteBytes() for i in range(stages.size()))

    before = moved()
    if find == "pairs":
        got = minhash.similar_pairs(minhash.prepared(df, "id", "text")).collect()
        assert sorted((r["a"], r["b"]) for r in got) == [(i + a, i + b) for i in range(0, 90, 3) for a, b in ((0, 1), (0, 2), (1, 2))]
    else:
        got = minhash.deduplicate(df, "id", "text", greedy=find == "greedy").collect()
        assert sorted(r["id"] for r in got) == list(range(2, 90, 3))
    assert moved() - before < 10 * sum(len(t) for _, t in rows)


def test_hash_ranges_equal_the_expressions_and_hash_a_shingle_once_a_task(spark):
    from quern.plans.catalogue import QUERIES

    rows = [(0, None), (1, ""), (2, " Ab "), (3, "abcde"), (4, "aaaaaaaaaa"), (5, "Ä€\U0001f600 x y" * 40), (6, "the quick brown fox " * 30)]
    df = spark.createDataFrame(rows, "id long, text string")
    hashes = df.select("id", F.transform(minhash.shingles(F.col("text")), minhash.base_hash).alias("h"))
    want = hashes.select("id", F.array_min("h"), F.array_max("h"), F.size("h")).collect()
    got = minhash.hash_ranges(df.select("id", minhash.normalised(F.col("text")).alias("text_norm"))).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))
    assert minhash.hash_ranges(df.selectExpr("id", "text AS text_norm").limit(0)).count() == 0
    # An md5 expression is worked out for every shingle of every text.
    plan = QUERIES["shingle_base_hash"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "md5" not in plan


@pytest.mark.parametrize("greedy", [True, False])
def test_near_copies_are_written_as_texts_not_as_sets(spark, monkeypatch, greedy):
    kinds, stored = [], minhash.stored
    monkeypatch.setattr(minhash, "stored", lambda df: kinds.extend(kind for _, kind in df.dtypes) or stored(df))
    df = spark.createDataFrame([(0, "one two three four five"), (1, "one two three four five!"), (2, "other")], "id long, text string")
    assert sorted(r["id"] for r in minhash.deduplicate(df, "id", "text", greedy=greedy).collect()) == [1, 2]
    assert kinds and "array<bigint>" not in kinds
