"""Centroid clusters, importance resampling and SentencePiece encoding against brute force, on odd rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
import public_tokenizers as P
import sentencepiece
from pyspark.sql import functions as F

from quern.llm import piecebpe, pivots, queries, resample
from quern.llm.piecebpe import Pieces

UPPER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
DOCS = "doc_id long, text string, low long, weight double, rank string, fit string"


# 11: clusters


def model_clusters(rows, k=16, rounds=3):
    """Whole k-means in Python integers, all distances computed."""
    x = [(i, [math.floor(64 * c) for c in v]) for i, v in rows]
    key = lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1])
    centroids = [v for _, v in sorted(x, key=key)[:k]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centroids))
    for _ in range(rounds):
        own = [near(v)[1] for _, v in x]
        for j in range(len(centroids)):
            some = [v for (_, v), o in zip(x, own) if o == j]
            if some:
                centroids[j] = [sum(c) // len(some) for c in zip(*some)]
    found = [(i, *near(v)) for i, v in x]
    inertia = Counter()
    for _, d, j in found:
        inertia[j] += d
    return Counter((i, j, d, inertia[j], sum(inertia.values()), hashlib.sha256(",".join(map(str, centroids[j])).encode()).hexdigest()) for i, d, j in found)


def clusters(df):
    return Counter(tuple(r)[:6] for r in df.collect())


def test_clusters_equal_brute_force(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(20, 64))
    rows = [(i, (centres[i % 20] * (1 + i % 3) + rng.normal(size=64) * 0.1).astype(np.float32).tolist()) for i in range(400)]
    rows += [(900 + i, rows[7][1]) for i in range(60)] + [rows[5], rows[5], (None, rows[9][1]), (-4, [-3.0e4] * 64), (-5, [3.0e4] * 64)]
    bad = [(2000, None), (2001, [1.0] * 63), (2002, [1.0] * 65), (2003, [None] + [1.0] * 63), (2004, [float("nan")] + [1.0] * 63), (2005, [float("inf")] + [1.0] * 63), (2006, [1e30] * 64), (2007, [])]
    df = spark.createDataFrame([(i, v, 3, "x") for i, v in rows + bad], "vec_id long, embedding array<float>, cluster int, x string").repartition(5)
    done = pivots.cluster_vectors(df)
    assert clusters(done) == model_clusters(rows)
    assert done.agg(F.avg("n_checked")).first()[0] < 6  # the bounds leave most of the 16 centroids out
    assert clusters(pivots.cluster_vectors(df.coalesce(1))) == model_clusters(rows)


@pytest.mark.parametrize("rows", [[], [(3, [0.5] * 64)], [(i, [0.25] * 64) for i in range(30)], [(i, [float(i % 2)] * 64) for i in range(5)]])
def test_few_or_equal_vectors(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert clusters(pivots.cluster_vectors(df)) == (model_clusters(rows) if rows else Counter())


def test_bounds_hold_for_ties_and_large_integers():
    rng = np.random.default_rng(2)
    for scale in (3, 1000, (1 << 27) - 1):
        x = rng.integers(-scale, scale + 1, (300, 8))
        x[100:200] = x[:100]
        centroids, fixed = x[rng.integers(0, 300, 12)], pivots.far_apart(x[:40], 5)
        cluster, best, _ = pivots.assign(x, pivots.roots(x, fixed), centroids, fixed)
        exact = ((x[:, None] - centroids) ** 2).sum(2)
        assert (cluster == exact.argmin(1)).all() and (best == exact.min(1)).all()
        assert (pivots.lower_bounds(pivots.roots(x, fixed), pivots.roots(centroids, fixed), fixed) <= np.sqrt(exact.astype(float)) * (1 + 1e-15)).all()


# 12: importance resampling


def features(text):
    words = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").encode().translate(UPPER))
    return len(words), [zlib.crc32(f) % 10_000 for f in words + [b" ".join(p) for p in zip(words, words[1:])]]


def model_resample(docs, target):
    rows = [(i, *features(t)) for i, t in docs]
    s, t = Counter(f for *_, own in rows for f in own), Counter(f for text in target for f in features(text)[1])
    n_s, n_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (n_s + 10_000) / ((s[b] + 1) * (n_t + 10_000))))
    out = []
    for i, n, own in rows:
        weight = sum(map(gain, own)) // len(own) if own else 0
        h = None if i is None else int(hashlib.sha256(f"7:{i}".encode()).hexdigest()[:8], 16)
        out.append((i, len(own), weight, None if i is None else weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n))
    fit = sorted((-r[3], r[0]) for r in out if r[0] is not None and r[4] >= 20)
    return out, fit[: 25 * len(fit) // 100]


def sampled(spark, docs, target):
    df = spark.createDataFrame([(i, t, 1, 2.0, "r", "f") for i, t in docs], DOCS).repartition(6)
    return resample.resample(df, spark.createDataFrame([(t, 5) for t in target], "text string, doc_id int")).collect()


def check_sample(spark, docs, target):
    got, (want, drawn) = sampled(spark, docs, target), model_resample(docs, target)
    assert Counter(tuple(r)[:4] for r in got) == Counter(r[:4] for r in want)
    assert [(-r["score"], r["doc_id"]) for r in sorted((r for r in got if r["rank"] is not None), key=lambda r: r["rank"])] == drawn
    assert sorted(r["rank"] for r in got if r["rank"] is not None) == list(range(1, len(drawn) + 1))


def test_resampling_equals_brute_force(spark):
    rng = random.Random(8)
    vocabulary = ["".join(rng.choice("abcdéñ") for _ in range(rng.randint(1, 6))) for _ in range(60)] + ["x" * 300, "日本語"]
    say = lambda n: rng.choice(" -_\n").join(rng.choice(vocabulary) for _ in range(n))
    docs = [(i, say(rng.randint(0, 60))) for i in range(300)]
    docs += [(400, None), (401, ""), (402, "!!"), (403, "one"), (404, "A b"), (405, say(20_000)), (None, say(40)), (None, None), docs[3], docs[3], docs[5]]
    docs += [(7, say(30)), (500, "y" * 100_000 + " " + say(30))] + [(600 + i, docs[9][1]) for i in range(80)]
    check_sample(spark, docs, [say(30), None, "", say(5)])
    check_sample(spark, docs, [])


def test_resampling_of_few_rows(spark):
    long = "a b c d e " * 5
    for docs in ([], [(1, None)], [(i, long) for i in range(3)], [(i, long) for i in range(4)], [(9, long)] * 9):
        check_sample(spark, docs, ["a b"])


@pytest.mark.parametrize("n, size", [(1, 5), (50, 7), (5000, 100), (5000, 1 << 20)])
def test_selection_finds_the_exact_cutoff(spark, n, size):
    rng = np.random.default_rng(n)
    keys = [tuple(map(int, k)) for k in rng.integers(-6, 6, (n, 3)) * [1, 1, 1 << 40]]
    df = spark.createDataFrame(keys, "low long, doc_id long, text_hash long").repartitionByRange(7, "low")
    for share in (1, 30, 50, 100):
        key, number, rounds = resample.cutoff(df, lambda m: -(-m * share // 100), size)
        assert number == -(-n * share // 100) and key == sorted(keys)[number - 1]
        assert rounds <= 1 + math.log(n, 4 / 3)


# 13: pieces


@pytest.fixture(scope="module")
def model():
    return P.path("piece_bpe_32k.model")


def odd_texts():
    rng = random.Random(3)
    odd = ["", " ", "  ", "a", " a", "a ", "▁", "a▁b ▁", "\x00a", "a" * 500, " " * 100, "日本語" * 50, "\U0001F600x\U0001F469‍\U0001F4BB", "<s> </s><unk><0x0A>", "\n \n  \n", "a" * 16 + "b", "  　x"]
    odd += ["".join(rng.choice("ab  \n\t'sé<|>1 \x85\x1fÀßΣ▁日本\U0001F600ther") for _ in range(rng.randint(1, 60))) for _ in range(1500)]
    return odd + ["".join(rng.choice(["th", "e ", "in", "g", "  ", "ion", "a", "t", "er", "▁", " "]) for _ in range(rng.randint(1, 40))) for _ in range(1500)]


def test_pieces_equal_the_library(model):
    pieces, library, rng = Pieces(model), sentencepiece.SentencePieceProcessor(model_file=model), random.Random(5)
    encoded = lambda p, texts: (lambda ids, ends, decoded: [(x.tolist(), t) for x, t in zip(np.split(ids, ends[:-1]), decoded)])(*p.encode(texts))
    want = [(ids, library.decode(ids)) for ids in library.encode(odd_texts())]
    whole, forgetful = Pieces(model), Pieces(model, 3)
    whole.split = False
    for p in (pieces, whole):
        assert encoded(p, odd_texts()) == want
    assert [encoded(forgetful, [t])[0] for t in odd_texts()[:300]] == want[:300]
    assert all(pieces.decode(ids) == text for ids, text in want) and pieces.encode([])[2] == []
    for _ in range(2000):
        ids = [rng.choice([rng.randrange(3, 259), rng.randrange(259, 32_000), rng.randrange(3)]) for _ in range(rng.randint(1, 8))]
        assert pieces.decode(ids) == library.decode(ids)


def test_every_prefix_has_its_last_token(model):
    pieces = Pieces(model)
    for text in ("▁interpretations", "▁▁▁▁▁▁▁▁▁▁▁▁▁▁▁▁▁▁▁▁▁x", "aaaaabaaaaaab", "▁th日ere"):
        assert [pieces.number.text[t] for t in pieces.prefixes(text)[1:]] == [pieces.merged(text[:n])[-1] for n in range(1, len(text) + 1)]


def test_encoded_rows(spark, model):
    library = sentencepiece.SentencePieceProcessor(model_file=model)
    rows = [(i, t) for i, t in enumerate(odd_texts()[:60])] + [(70, None), (None, "a b"), (3, "b"), (3, "b"), (71, "long text " * 100_000), (72, "字" * 200_000)]
    df = spark.createDataFrame([(i, t, 1, 2.0, "r", "f") for i, t in rows], DOCS.replace("low", "ids").replace("fit", "decoded"))
    want = Counter((i, tuple(library.encode(t or "")), library.decode(library.encode(t or ""))) for i, t in rows)
    assert Counter((r["doc_id"], tuple(r["ids"]), r["decoded"]) for r in piecebpe.encode_texts(df, model).collect()) == want
    assert piecebpe.encode_texts(df.limit(0), model).count() == 0


# The queries


SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name, tables", [("op11_ptolemaic_clusters", ["embeddings"]), ("op12_importance_resampling", ["documents", "benchmark"]), ("op7_positional_decontamination", ["documents", "benchmark"]), ("op8_odd_sketch_near_duplicates", ["documents"])])
def test_queries_equal_their_sql(spark, name, tables):
    con = duckdb.connect()
    for t in tables:
        con.sql(f"CREATE VIEW {t} AS FROM '{SF}/{t}.parquet'")
    got, want = queries.queries()[name](spark, SF), con.sql(queries.oracle_sql()[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    assert Counter(tuple(r[c] for c in columns) for r in got.collect()) == Counter(want.select(", ".join(columns)).fetchall())


def test_piece_query_equals_the_library(spark, model):
    library = sentencepiece.SentencePieceProcessor(model_file=model)
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    texts = {r["doc_id"]: library.encode(r["text"] or "") for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    want = {i: (len(ids), digest(",".join(map(str, ids))), digest(library.decode(ids))) for i, ids in texts.items()}
    got = queries.queries()["op13_prefix_table_pieces"](spark, SF).collect()
    assert {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in got} == want and len(got) == len(want)
