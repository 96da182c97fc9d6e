"""Every operator against a brute-force version, on odd rows: nulls, empty and long texts, ties, copies, extra columns."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from quern.llm import ann, bpe, components, decontam, gru, langid, licenses, linededup, lm, neardup, packing, suffixdedup, suffixes, tokencount

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, node long, key string, label string"


def words(text, pattern="[^\x20\x09-\x0D]+"):
    return re.findall(pattern, (text or "").translate(UPPER))


ALNUM = "[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def corpus(seed=5, groups=12):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdeéñ") for _ in range(rng.randint(1, 7))) for _ in range(150)]
    sentence = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    texts = []
    for _ in range(groups):
        base = [sentence(rng.randint(3, 9)) for _ in range(rng.randint(2, 12))]
        for _ in range(rng.randint(1, 5)):
            copy = list(base)
            for _ in range(rng.randint(0, 2)):
                copy[rng.randrange(len(copy))] = sentence(rng.randint(1, 9))
            texts.append("\n".join(copy))
    texts += [texts[0], texts[0], "", None, " ", "\n\n", "one", "one", "ONE", "One two", "!!! ... ###", "x" * 300, "Ω≈ç 日本語 \U0001F600", sentence(4000), "a b " * 400]
    rows = [(i, t, ["en", "fr", None][i % 3], "s", 1, 7, "k", "l") for i, t in enumerate(texts)]
    return [*rows, rows[0], (None, "one two three", None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["doc_id"], []).append(r)
    return out


TEXTS = {r[0]: r[1] for r in corpus()}


# 1 and 4: tokens


def test_array_merging_equals_the_tokenizers():
    rng = random.Random(1)
    odd = ["", " ", "  a", "a  b \n c", "\n\n x", "a\x1cb \x1c c", "<|endoftext|>", "a <|endoftext|> b<|endoftext|>c", "a" * 50, "it's  'S don't'll", "　 x y  ", "Σας ΌΣ İ ÀÉß×÷ª", "日本語 \U0001F600\U0001F600"]
    odd += ["".join(rng.choice("ab \n\t'sé<|>1 \x85\x1fÀßΣ×'llre") for _ in range(rng.randint(1, 40))) for _ in range(2000)]
    byte, word = Tokenizer.from_file(P.path("byte_bpe_50k.json")), Tokenizer.from_file(P.path("word_bpe_49k.json"))
    counter, encoder = tokencount.Counter(P.path("byte_bpe_50k.json"), P.PATTERN), packing.WordEncoder(P.path("word_bpe_49k.json"), 2)
    assert counter.count(odd) == [len(x.ids) for x in byte.encode_batch(odd, add_special_tokens=False)]
    assert [x.tolist() for x in encoder.encode(odd)] == [[*x.ids, 2] for x in word.encode_batch(odd, add_special_tokens=False)]
    assert bpe.Merges(P.path("byte_bpe_50k.json")).merge([], symbols=False)[1].tolist() == []


def test_token_counts(docs, empty):
    byte = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    count = lambda d: tokencount.count_tokens(d, P.path("byte_bpe_50k.json"), P.PATTERN)
    for i, rows in by_id(count(docs)).items():
        text = TEXTS[i] or ""
        n = len(byte.encode(text, add_special_tokens=False).ids)
        assert all((r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(text.encode()), n, n > 1024) for r in rows)
    assert count(empty).count() == 0


@pytest.mark.parametrize("block", [200, 2_000_000])
def test_packing_covers_every_token_once(docs, empty, block):
    word = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    pieces = packing.pack_documents(docs, P.path("word_bpe_49k.json"), capacity=64, block_tokens=block).collect()
    rows = Counter(r[0] for r in corpus())
    for i, n in rows.items():
        ids = np.array([*word.encode(TEXTS[i] or "", add_special_tokens=False).ids, 2], "<u4")
        own = [p for p in pieces if p["doc_id"] == i]
        assert sorted(x for p in own for x in range(p["start"], p["start"] + p["length"])) == sorted(n * list(range(len(ids))))
        assert all(p["doc_tokens"] == len(ids) and p["ids_crc32"] == zlib.crc32(ids[p["start"] : p["start"] + p["length"]].tobytes()) for p in own)
    for s in {p["sequence_id"] for p in pieces}:
        own, at = sorted((p["offset"], p["length"]) for p in pieces if p["sequence_id"] == s), 0
        for offset, length in own:
            assert offset == at
            at += length
        assert at & (at - 1) == 0 and at <= 64
    assert packing.pack_documents(empty, P.path("word_bpe_49k.json")).count() == 0


def test_packing_assigns_to_the_cheapest_sequence():
    doc, start, length, sequence, offset = packing.pack(np.array([9, 7, 6, 5, 3, 2]), capacity=16)
    assert np.bincount(sequence, length).tolist() == [16, 16] and [(d, s) for d, s in zip(doc, sequence)][:3] == [(0, 0), (1, 1), (2, 1)]


def model_pack(lengths, capacity, linear, quadratic):
    """Pieces (document, start, length, sequence, offset), by the rule as it is stated, one token count at a time."""
    pieces, sequences, rest = [], 0, []
    for d, n in enumerate(lengths):
        for k in range(n // capacity):
            pieces.append((d, k * capacity, capacity, sequences, 0))
            sequences += 1
        rest.append(n % capacity)
    total = sum(rest)
    sizes = [capacity] * (total // capacity) + [1 << k for k in range(capacity.bit_length() - 1, -1, -1) if total % capacity >> k & 1]
    room, cost = list(sizes), [0.0] * len(sizes)
    for d in sorted(range(len(rest)), key=lambda d: (-rest[d], d)):
        left = rest[d]
        while left:
            whole = [j for j in range(len(sizes)) if room[j] >= left]
            j = min(whole or [j for j in range(len(sizes)) if room[j]], key=lambda j: (cost[j], j))
            put = min(left, room[j])
            pieces.append((d, lengths[d] - left, put, sequences + j, sizes[j] - room[j]))
            room[j] -= put
            cost[j] += linear * put + quadratic * put * put
            left -= put
    return pieces


@pytest.mark.parametrize("seed", range(6))
def test_packing_follows_the_rule(seed):
    rng = random.Random(seed)
    lengths = [rng.choice([1, 1, 5, 5, 17, 63, 64, 65, 200, rng.randint(1, 40)]) for _ in range(rng.choice([0, 1, 3, 60, 200]))]
    got = packing.pack(np.array(lengths, int), 64, 1.0, 1 / 16)
    assert [tuple(p) for p in zip(*(x.tolist() for x in got))] == model_pack(lengths, 64, 1.0, 1 / 16)


# 2: neighbours


@pytest.mark.parametrize("scale", [False, True])
def test_neighbours(spark, scale):
    rng = np.random.default_rng(4)
    centres = rng.standard_normal((12, 24))
    x = (centres[rng.integers(0, 12, 900)] + 0.6 * rng.standard_normal((900, 24))) * (rng.uniform(0.5, 2, (900, 1)) if scale else 1)
    x[40:60] = x[40]
    rows = [(i, [float(v) for v in np.float32(r)]) for i, r in enumerate(x)]
    odd = [(1000, None), (1020, [0.0] * 24), (1040, [float("nan")] * 24), (1060, [1.0, None] * 12), (None, rows[0][1]), (1080, [1.0]), rows[3]]
    got = ann.nearest(spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>").withColumn("v", F.lit(1)), every=20, k=20).collect()
    vectors, hit = np.float32(x).astype(float), 0
    assert {r["query_id"] for r in got} == set(range(0, 900, 20))
    for q in range(0, 900, 20):
        own = sorted((r for r in got if r["query_id"] == q), key=lambda r: r["rank"])
        score = vectors @ vectors[q]
        assert [r["rank"] for r in own] == list(range(1, 21)) and q not in {r["vec_id"] for r in own}
        assert np.allclose([r["score"] for r in own], score[[r["vec_id"] for r in own]])
        assert [(-r["score"], r["vec_id"]) for r in own] == sorted((-r["score"], r["vec_id"]) for r in own)
        score[q] = -np.inf
        hit += len({r["vec_id"] for r in own} & set(np.lexsort((np.arange(900), -score))[:20].tolist()))
    assert hit / (45 * 20) >= 0.9
    assert ann.nearest(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


@pytest.mark.parametrize("n", [1, 2, 15, 21])
def test_all_candidates_of_few_vectors(spark, n):
    x = np.random.default_rng(n).standard_normal((n, 8)).astype(np.float32)
    x[n // 2 :] = x[n // 2]  # ties
    got = ann.nearest(spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "vec_id long, embedding array<float>")).collect()
    want = []
    for q in range(0, n, 20):
        score = [sum(float(a) * float(b) for a, b in zip(x[q], v)) for v in x]
        order = sorted((i for i in range(n) if i != q), key=lambda i: (-round(score[i], 9), i))[:20]
        want += [(q, r, i) for r, i in enumerate(order, 1)]
    assert sorted((r["query_id"], r["rank"], r["vec_id"]) for r in got) == want


@pytest.mark.parametrize("kind", ["array<float>", "array<double>"])
def test_neighbours_by_hashed_codes(spark, kind):
    rng = np.random.default_rng(14)
    n, dims = 3000, 24
    x = rng.standard_normal((n, dims)) + 2 * rng.standard_normal((10, dims))[rng.integers(0, 10, n)]
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x[1000:1400] = x[1000] + 1e-4 * rng.standard_normal((400, dims))  # a crowded code
    x = np.float32(x).astype(float) if "float" in kind else x
    got = ann.nearest(spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], f"vec_id long, embedding {kind}"), block=100).collect()
    hit = 0
    for q in range(0, n, 20):
        own = sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == q)
        score = x @ x[q]
        score[q] = -np.inf
        assert [r for r, _, _ in own] == list(range(1, 21)) and np.allclose([s for _, _, s in own], score[[i for _, i, _ in own]], rtol=1e-12)
        hit += len({i for _, i, _ in own} & set(np.argsort(-score, kind="stable")[:20].tolist()))
    assert hit / (n // 20 * 20) >= 0.9


def test_probed_codes_are_the_best():
    rng = np.random.default_rng(3)
    x, signs, sizes = rng.standard_normal((6, 8)), ann.rotations(8, 1, 3)[0], [8, 8, 2]
    sums = [ann.signed(ann.rotated(x, s), w) for s, w in zip(signs, sizes)]
    total = (sums[0][:, :, None, None] + sums[1][:, None, :, None] + sums[2][:, None, None, :]).reshape(6, -1)
    for probes in (1, 7, 100, 5000):
        want = np.sort(np.argsort(-total, axis=1)[:, :probes], axis=1)
        codes, best = ann.probed_codes(x, signs, sizes, probes)
        assert (codes == want).all() and (best == total.argmax(1)).all()
    assert (ann.codes_of(x, signs, sizes) == total.argmax(1)).all()


def test_codes_follow_the_rows():
    for padded in (2, 32, 128, 1024):
        for n in (1, 9, 50, 2000, 10**4, 10**6, 10**9, 10**12):
            sizes = ann.widths(n, padded)
            codes = int(np.prod([2 * w for w in sizes]))
            assert all(w == padded for w in sizes[:-1]) and (n < 16 or n / 40 <= codes <= n)


@pytest.mark.parametrize("sizes", [[8], [8, 4], [8, 8, 2], [4, 8, 8, 2]])
def test_ranks_of_codes(sizes):
    rng = np.random.default_rng(5)
    q, x, signs = rng.standard_normal((30, 8)), rng.standard_normal((30, 8)), ann.rotations(8, 1, 4)[0]
    total = np.zeros((30, 1))
    for s, w in zip(signs, sizes):
        total = (total[:, :, None] + ann.signed(ann.rotated(q, s), w)[:, None, :]).reshape(30, -1)
    own = total[np.arange(30), ann.codes_of(x, signs, sizes)]
    assert ann.code_ranks(q, x, signs, sizes).tolist() == (total > own[:, None] + 1e-12).sum(1).tolist()


def recall(spark, x, tmp_path):
    table = pa.table({"vec_id": np.arange(len(x)), "embedding": pa.array(list(np.float32(x)))})
    pq.write_table(table, tmp_path / "x.parquet")
    got = ann.nearest(spark.read.parquet(str(tmp_path / "x.parquet"))).collect()
    x, hit = np.float32(x).astype(float), 0
    for q in range(0, len(x), 20):
        score = x @ x[q]
        score[q] = -np.inf
        hit += len({r["vec_id"] for r in got if r["query_id"] == q} & set(np.argsort(-score)[:20].tolist()))
    return hit / (len(range(0, len(x), 20)) * 20)


@pytest.mark.parametrize("dims", [64, 384])
@pytest.mark.parametrize("clusters", [0, 40])
def test_recall_of_wide_and_random_vectors(spark, tmp_path, monkeypatch, dims, clusters):
    """At defaults, with 2000 rows: codes decide what is scored, and enough of them are probed."""
    rng = np.random.default_rng(dims + clusters)
    x = rng.standard_normal((2000, dims)) * (0.5 if clusters else 1)
    x += rng.standard_normal((clusters, dims))[rng.integers(0, clusters, 2000)] if clusters else 0
    taken, needed = {}, ann.probes_needed

    def spy(pairs, signs, sizes):
        taken.update(needed(pairs, signs, sizes))
        assert all(n < np.prod([2 * w for w in sizes[band]]) for band, n in taken.items() if sum(p[0] == band for p in pairs) > 100)
        return taken

    monkeypatch.setattr(ann, "probes_needed", spy)
    assert recall(spark, x, tmp_path) >= 0.9
    if not clusters:
        monkeypatch.setattr(ann, "probes_needed", lambda pairs, signs, sizes: {band: max(1, n // 8) for band, n in taken.items()})
        assert recall(spark, x, tmp_path) < 0.8


@pytest.mark.parametrize("kind", ["one long", "log-normal", "few"])
def test_neighbours_of_unequal_lengths_and_few_rows(spark, kind):
    rng = np.random.default_rng(6)
    n = 10 if kind == "few" else 2000
    x = rng.standard_normal((n, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    if kind == "one long":
        x[7] *= 50
    if kind == "log-normal":
        x *= np.exp(rng.standard_normal((n, 1)))
    got = ann.nearest(spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "vec_id long, embedding array<double>"), every=20, k=20).collect()
    asked, k, hit = range(0, n, 20), min(20, n - 1), 0
    for q in asked:
        own = sorted((r["rank"], r["vec_id"]) for r in got if r["query_id"] == q)
        assert [r for r, _ in own] == list(range(1, k + 1))
        score = x @ x[q]
        score[q] = -np.inf
        hit += len({i for _, i in own} & set(np.argsort(-score)[:k].tolist()))
    assert hit / (len(asked) * k) >= 0.9


def test_rotations_keep_lengths():
    x = np.random.default_rng(1).standard_normal((5, 24))
    assert np.allclose(np.linalg.norm(ann.rotated(x, ann.rotations(24, 1, 1)[0, 0]), axis=1), np.linalg.norm(x, axis=1))


# 3: languages


def test_language_identification(spark, empty):
    rng = random.Random(3)
    sound = {"aa": ["ka", "ta", "na", "ra"], "bb": ["lo", "mi", "sü", "pe"], "cc": ["gru", "bro", "dze", "fle"]}
    say = lambda lang, n: " ".join("".join(rng.choice(sound[lang]) for _ in range(3)) for _ in range(n))
    rows = [(i, say(lang := "abc"[i % 3] * 2, rng.randint(5, 80)), lang) for i in range(240)]
    mixed = [(1000, say("aa", 60) + " " + say("bb", 30), None), (1001, None, "aa"), (1002, "123 !?", "bb"), (1003, "", None), (None, say("cc", 20), None), (1004, say("bb", 9000), None), (1005, "\u00bd \u00b2 \u2460 \u2167", "aa")]
    got = by_id(langid.identify(spark.createDataFrame(rows + mixed, "doc_id long, text string, lang string")))
    held = [i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 3 == 1]
    assert [i for i in got if got[i][0]["held_out"] and i is not None and i < 1000] and all(got[i][0]["held_out"] for i in held)
    assert all(got[i][0]["lang_pred"] == lang for i, _, lang in rows)
    assert got[1000][0]["langs"] == "aa,bb" and 0.5 < got[1000][0]["score"] < 0.8
    assert [got[i][0]["lang_pred"] for i in (1001, 1002, 1003, None, 1004, 1005)] == ["und", "und", "und", "cc", "bb", "und"]
    assert got[None][0]["held_out"] is False
    assert langid.identify(empty).count() == 0
    unlearned = spark.createDataFrame([(1, "text", None)], "doc_id long, text string, lang string")
    assert [tuple(r)[2:4] for r in langid.identify(unlearned).collect()] == [("und", 0.0)]


def best_shares(likely, times, steps=40):
    """The best log likelihood of any shares on a grid, and the shares."""
    k = likely.shape[1]
    grids = [g for g in np.ndindex(*[steps + 1] * (k - 1)) if sum(g) <= steps]
    options = [np.array([*g, steps - sum(g)]) / steps for g in grids]
    return max(((float(times @ np.log(np.maximum(likely @ s, 1e-300))), s.tolist()) for s in options), key=lambda x: x[0])


@pytest.mark.parametrize("seed", range(8))
def test_mixture_inference_against_a_grid(seed):
    rng = np.random.default_rng(seed)
    k, n = 3, 60
    table = rng.dirichlet(np.full(n, 0.3), k).T + 1e-4
    logs = np.log(table / table.sum(0)).astype(np.float32)
    true = rng.dirichlet(np.ones(k))
    grams = np.concatenate([rng.choice(n, int(400 * t) + 1, p=np.exp(logs[:, i]) / np.exp(logs[:, i]).sum()) for i, t in enumerate(true)])
    penalty = rng.choice([0.5, 4.0, 40.0])
    share = langid.infer(grams, logs, penalty)
    times = np.bincount(grams, minlength=n)
    seen = np.flatnonzero(times)
    likely, times = np.exp(logs[seen].astype(float)), times[seen].astype(float)
    chosen = [i for i in range(k) if share[i] > 0]
    fit = float(times @ np.log(likely @ share))
    cost = penalty * np.log(1 + times.sum())
    assert abs(share.sum() - 1) < 1e-4
    # The shares are the best of the chosen set, and no nested set of the order of shares is better after the penalty.
    assert fit >= best_shares(likely[:, chosen], times)[0] - 0.01 * times.sum() ** 0.5
    order = np.argsort(-np.array(best_shares(likely, times)[1]), kind="stable")
    fits = [best_shares(likely[:, order[:m]], times)[0] - cost * m for m in (1, 2, 3)]
    assert fit - cost * len(chosen) >= max(fits) - 1.0


def test_language_of_repeated_rows_ties_and_clashing_columns(spark):
    rows = [(i, t, lang, True, 0.5, "r", "x") for i, (t, lang) in enumerate([("kata nara", "aa"), ("lomi pesu", "bb")] * 30)]
    rows += [(100, "kata nara lomi pesu", None, True, 0.5, "r", "x"), rows[0], rows[0]]
    got = by_id(langid.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string, held_out boolean, score double, row string, lang_pred string")))
    assert len(got[0]) == 3 and len({tuple(r) for r in got[0]}) == 1 and got[0][0]["lang_pred"] == "aa"
    assert got[100][0]["lang_pred"] in ("aa", "bb") and 0.4 < got[100][0]["score"] <= 1
    learned = [i for i in range(90) if zlib.crc32(str(i).encode()) % 3 != 1][:40]
    tie = spark.createDataFrame([(i, "same words", ["bb", "aa"][n % 2]) for n, i in enumerate(learned)], "doc_id long, text string, lang string")
    assert {r["lang_pred"] for r in langid.identify(tie).collect()} == {"aa"}


# 5: lines


def model_lines(texts, divisor=3):
    """(lines, chunks, removed, text left) of each document; texts by doc_id."""
    number = lambda line: int(hashlib.md5(line.encode()).hexdigest()[:8], 16)
    split, chunks, first = {i: (t or "").split("\n") for i, t in texts.items()}, {}, {}
    for i in sorted(texts):
        lines, own = split[i], set()
        for r in range(divisor):
            for s in range(divisor):
                cut = lambda n: (number(lines[n]) * 17 + 5) // 16 % divisor == r or (n > 1 and (number(lines[n - 2]) * 31 + number(lines[n - 1])) % divisor == s)  # noqa: E731, B023
                ends = [0, *(n for n in range(1, len(lines)) if cut(n)), len(lines)]
                own |= {(a, b) for a, b in zip(ends, ends[1:]) if b - a > 1}
        chunks[i] = sorted(own)
        for a, b in chunks[i]:
            first.setdefault("\n".join(lines[a:b]), (i, a))
    out = {}
    for i, lines in split.items():
        gone = {n for a, b in chunks[i] if first["\n".join(lines[a:b])] < (i, a) for n in range(a, b)}
        out[i] = (len(lines), len(chunks[i]), len(gone), "\n".join(x for n, x in enumerate(lines) if n not in gone))
    return out


def test_line_dedup(docs, empty):
    want = model_lines({i: t for i, t in TEXTS.items() if i is not None})
    got = by_id(linededup.dedup_lines(docs))
    for i, w in want.items():
        assert all((*r["lines_report"], r["text"]) == w for r in got[i]), i
    assert got[None][0]["text"] == "one two three" and set(docs.columns) < set(linededup.dedup_lines(docs).columns)
    assert linededup.dedup_lines(empty).count() == 0
    assert any(w[2] for w in want.values())


def test_line_dedup_of_many_lines_and_frequent_passages(spark, monkeypatch):
    from quern import scratch

    rng = random.Random(15)
    line = lambda: " ".join(rng.choice(["red", "green", "blue", "grey"]) + str(rng.randrange(50)) for _ in range(4))
    passage = [line() for _ in range(12)]
    texts = {i: "\n".join([line(), *passage[: 2 + i % 11], line()]) for i in range(60)}
    texts[60] = "\n".join(line() for _ in range(4000)) + "\n" + "\n".join(passage)
    monkeypatch.setattr(scratch.joined, "__defaults__", (5,))
    got = by_id(linededup.dedup_lines(spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)))
    for i, w in model_lines(texts).items():
        assert (*got[i][0]["lines_report"], got[i][0]["text"]) == w, i


def test_line_chunks_with_equal_hashes_are_compared_by_bytes(spark, monkeypatch):
    # With one hash for every chunk, only the bytes tell chunks apart.
    plain = linededup.lined
    monkeypatch.setattr(linededup, "lined", lambda *a: plain(*a).withColumn("chunks", F.expr("transform(chunks, c -> struct(c.start AS start, c.stop AS stop, 7L AS hash))")))
    texts = {i: t for i, t in TEXTS.items() if i is not None}
    got = by_id(linededup.dedup_lines(spark.createDataFrame(list(texts.items()), "doc_id long, text string")))
    for i, w in model_lines(texts).items():
        assert (*got[i][0]["lines_report"], got[i][0]["text"]) == w, i


def shuffled_bytes(spark):
    """Bytes that this session's stages have written for shuffles so far."""
    sc = spark.sparkContext
    sc._jsc.sc().listenerBus().waitUntilEmpty()
    stages = sc._jsc.sc().statusStore().stageList(None, False, False, sc._gateway.new_array(sc._jvm.double, 0), None)
    return sum(stages.apply(i).shuffleWriteBytes() for i in range(stages.size()))


@pytest.mark.parametrize("stage", [False, True])
def test_line_dedup_shuffles_texts_once_at_any_size(spark, monkeypatch, stage):
    # As with more repeated chunks than may be broadcast: chunks of all chunkings hold several times the texts.
    from quern import scratch

    rng = random.Random(16)
    texts = {i: "\n".join(rng.randbytes(600).hex() for _ in range(24)) for i in range(60)}
    texts |= {i: texts[i - 60] for i in range(60, 64)}
    monkeypatch.setattr(scratch.small, "__defaults__", (0,))
    limits = {f"spark.sql.{name}": spark.conf.get(f"spark.sql.{name}", None) for name in ("autoBroadcastJoinThreshold", "adaptive.autoBroadcastJoinThreshold")}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3).localCheckpoint()
    try:
        for name in limits:
            spark.conf.set(name, "-1")
        before = shuffled_bytes(spark)
        got = by_id(corpus_pipeline.lines(spark, docs, "") if stage else linededup.dedup_lines(docs))
        moved = shuffled_bytes(spark) - before
    finally:
        for name, value in limits.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    for i, w in model_lines(texts).items():
        assert got[i][0]["text"] == w[3] and (stage or (*got[i][0]["lines_report"],) == w[:3]), i
    assert moved < 1.5 * sum(map(len, texts.values()))


# 6: licenses


def test_license_scan(spark, empty):
    rng = random.Random(6)
    bits = ["gnu", "general", "public", "license", "apache", "cc", "by", "mit", "x", "GNU General Public License", "MIT-License", "cc by cc by"]
    texts = [" ".join(rng.choice(bits) for _ in range(rng.randint(0, 30))) for _ in range(60)] + [None, "", "by", licenses.NOTICES["mit-notice"].upper() + " etc", "pad " * 5000 + "apache license"]
    rows = [(i, t) for i, t in enumerate(texts)]
    got = by_id(licenses.scan(spark.createDataFrame([*rows, rows[0], (None, "mit license")], "doc_id long, text string").withColumn("hash", F.lit(1))))
    for i, t in rows:
        w = words(t, ALNUM)
        found = [(s, label) for phrase, label in licenses.PHRASES.items() for s in range(len(w)) if w[s : s + len(phrase.split())] == phrase.split()]
        places = [s for s, _ in found]
        want = (len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted({x for _, x in found})))
        assert all((r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == want for r in got[i])
        assert all(set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1 for r in got[i])
    assert "mit-notice" in got[63][0]["labels"] and (got[None][0]["n_base"], got[None][0]["labels"]) == (1, "mit")
    assert licenses.scan(empty).count() == 0


def common_words(template, window):
    table = [[0] * (len(window) + 1) for _ in range(len(template) + 1)]
    for i, x in enumerate(template):
        for j, y in enumerate(window):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


def test_license_notices_with_changed_words(spark):
    rng = random.Random(16)
    pad = lambda n: [f"q{rng.randrange(300)}" for _ in range(n)]
    rows, want = [], {}
    for label, text in licenses.NOTICES.items():
        for kind in range(6):
            w = text.split()
            if kind:  # replaced words, at most 30 % of them; then added and dropped ones
                for at in rng.sample(range(len(w)), int(len(w) * 0.06 * kind)):
                    w[at] = rng.choice(text.split()) if kind % 2 else "other"
            if kind in (2, 3):
                at = rng.randrange(1, len(w))
                w[at:at] = pad(5)
            if kind == 4:
                del w[len(w) // 2 :]
            doc = pad(30) + w + pad(30)
            rows.append((len(rows), " ".join(doc)))
            span = len(text.split()) + 12
            best = {other: max(common_words(t.split(), doc[d : d + len(t.split()) + 12]) / len(t.split()) for d in range(18, 32, 2)) if other == label else 0 for other, t in licenses.NOTICES.items()}
            want[rows[-1][0]] = (label, best[label] >= 0.7, span)
    got = by_id(licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")))
    for i, (label, found, span) in want.items():
        r = got[i][0]
        assert (label in r["labels"].split(",")) == found, (label, i)
        for s in r["spans"]:
            t = licenses.NOTICES.get(s["label"])
            if t:
                w = rows[i][1].split()[s["first"] : s["last"] + 1]
                assert len(w) <= len(t.split()) + 12 and common_words(t.split(), w) == round(s["coverage"] * len(t.split()))
    assert sum(f for _, f, _ in want.values()) > 40 and not all(f for _, f, _ in want.values())


# 7: benchmark


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row = row, [i]
        for j, y in enumerate(b):
            row.append(min(before[j] + (x != y), before[j + 1] + 1, row[j] + 1))
    return row[-1]


@pytest.mark.parametrize("small", [5_000_000, 0])
def test_decontamination(spark, empty, small):
    rng = random.Random(7)
    vocabulary = ["".join(rng.choice("abcd") for _ in range(3)) for _ in range(30)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(n))) for i, n in enumerate([25, 12, 10, 7, 3, 2, 40, 0])] + [(8, None), (9, "Dup-word dup WORD dup word"), (10, None)]
    items.append(items[0])
    texts = []
    for _ in range(50):
        w = [rng.choice(vocabulary) for _ in range(rng.randint(0, 60))]
        if rng.random() < 0.5:
            other = (rng.choice(items)[1] or "").split()
            a = rng.randint(0, max(0, len(other) - 9))
            w[5:5] = other[a : a + rng.randint(5, 20)]
        texts.append(" ".join(w).title())
    for n in range(30):  # one word added, dropped or replaced in a passage
        w = items[6][1].split()[n % 20 : n % 20 + 14]
        at = rng.randrange(len(w))
        w[at : at + (n % 3 > 0)] = ["new"] * (n % 3 < 2)
        texts.append(" ".join([rng.choice(vocabulary), *w, rng.choice(vocabulary)]))
    texts += [None, "", "dup word dup word dup word dup word", items[0][1] + " " + items[6][1]]
    rows = [(i, t) for i, t in enumerate(texts)]
    table = spark.createDataFrame([*rows, rows[1], (None, items[0][1])], "doc_id long, text string").withColumn("term", F.lit("x"))
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(1))
    got = by_id(decontam.digest(decontam.decontaminate(table, bench, size=10, small=small)))
    windows, places = {}, {}
    for i, t in items:
        w = words(t, ALNUM)
        n = min(10, len(w))
        for a in range(len(w) - n + 1) if w else ():
            windows.setdefault(tuple(w[a : a + n]), set()).add(str(i))
            places.setdefault(tuple(w[a : a + n]), set()).add((i, a))
    for i, t in rows:
        w, hit, names = words(t, ALNUM), set(), set()
        for window, who in windows.items():
            for a in range(len(w) - len(window) + 1):
                if tuple(w[a : a + len(window)]) == window:
                    hit |= set(range(a, a + len(window)))
                    names |= who
        near = 0
        for window, who in places.items():
            if len(window) == 10 and not any(w[a : a + 10] == list(window) for a in range(len(w))):
                near += len(who) * any(edits(window, w[a : a + n]) <= 1 for n in (9, 10, 11) for a in range(len(w) - n + 1))
        want = (len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit), near)
        assert all(tuple(r)[1:7] == want for r in got[i]), i
    assert any(r[0]["contaminated"] for r in got.values()) and sum(r[0]["n_near"] > 0 for r in got.values()) > 10
    n = len(items[0][1].split())
    assert (got[None][0]["n_words"], got[None][0]["n_hit"]) == (n, n)
    assert decontam.decontaminate(empty, bench).count() == 0
    assert not decontam.digest(decontam.decontaminate(table, bench.limit(0))).where("contaminated").count()


def test_decontamination_of_a_long_text_that_repeats_a_passage(spark):
    rng = random.Random(17)
    item = " ".join(f"term{rng.randrange(40)}" for _ in range(25))
    filler = [f"word{rng.randrange(3000)}" for _ in range(40_000)]
    text = " ".join([*filler, *(500 * (item + " between").split())])
    docs = spark.createDataFrame([(1, text), (2, " ".join(filler))], "doc_id long, text string")
    got = by_id(decontam.decontaminate(docs, spark.createDataFrame([(7, item)], "item_id long, text string")))
    assert (got[1][0]["n_words"], got[1][0]["n_hit"], got[1][0]["items"]) == (40_000 + 500 * 26, 500 * 25, ["7"])
    assert (got[2][0]["n_hit"], got[2][0]["n_near"]) == (0, 0)


def test_only_postings_that_meet_leave_their_task(spark, monkeypatch):
    """Key terms that stand alone, far from where an item has its others, are dropped; passages and one-word items stay."""
    rng = random.Random(27)
    item = [f"term{i}" for i in range(14)]
    apart = [" ".join(w for k in rng.sample(item, 14) for w in (k, *["filler"] * rng.randint(20, 40))) for _ in range(200)]
    texts = [*apart, " ".join(["x", *item]), " ".join(item[2:12]), " ".join([*item[:5], "y", *item[5:11]]), "x solo y"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame([(1, " ".join(item)), (2, "solo")], "item_id long, text string")
    left, found = [], decontam.postings
    monkeypatch.setattr(decontam, "postings", lambda *a: left.append(found(*a)) or left[-1])
    got = {r["doc_id"]: (r["n_hit"], r["n_near"]) for r in decontam.decontaminate(docs, bench).collect()}
    assert got == {i: (0, 0) for i in range(200)} | {200: (14, 0), 201: (10, 2), 202: (0, 2), 203: (1, 0)}
    rows = left[0].groupBy("key").count().collect()
    assert {200, 201, 202, 203} <= {r["key"] for r in rows} and sum(r["count"] for r in rows if r["key"] < 200) < 100
    assert found(docs, None, 1).count() == sum(len(t.split()) for t in texts)


def test_postings_that_meet():
    rng = np.random.default_rng(5)
    lists = decontam.Lists(pa.table({"term": [b"a", b"b", b"b", b"c", b"a"], "item_id": ["x", "x", "y", "y", "y"], "place": [0, 3, 1, 4, 6], "alone": [False] * 5}))
    row, position, of = np.repeat(np.arange(40), 12), np.tile(np.arange(0, 36, 3), 40), {b"a": [("x", 0), ("y", 6)], b"b": [("x", 3), ("y", 1)], b"c": [("y", 4)]}
    names = rng.choice(list(of), len(row))
    term = np.array([lists.number[w] for w in names])
    for misses in (0, 1, 2):
        diagonals = [{(r, item, p - place) for item, place in of[w]} for w, r, p in zip(names, row, position)]
        want = [any(i != j and a[:2] == b[:2] and abs(a[2] - b[2]) <= misses for a in own for j, other in enumerate(diagonals) for b in other) for i, own in enumerate(diagonals)]
        assert lists.meeting(term, row, position, misses).tolist() == want and 0 < sum(want) < len(want)
    assert lists.meeting(term, row, position, 1, most=100).all() and not len(lists.meeting(term[:0], row[:0], position[:0], 1))


def test_every_single_edit_is_a_near_match(spark):
    """Each word dropped, replaced or preceded by another, wherever the window's rare words stand."""
    item = "the rar of and osc the zyl in to qub".split()
    common = " ".join(["the of and in to"] * 40)
    edited = [item[:i] + item[i + 1 :] for i in range(10)] + [[*item[:i], "x", *item[i + 1 :]] for i in range(10)] + [[*item[:i], "x", *item[i:]] for i in range(1, 10)]
    twice = [item[:2] + item[3:7] + item[8:], item[::-1]]
    rows = [(i, f"{common} {' '.join(w)} {common}") for i, w in enumerate(edited + twice)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame([("a", " ".join(item)), ("b", "q w e r t y")], "item_id string, text string")
    for small in (500_000, 0):
        got = {r["doc_id"]: (r["n_hit"], r["n_near"]) for r in decontam.decontaminate(docs, bench, small=small).collect()}
        assert got == {i: (0, int(i < len(edited))) for i in range(len(rows))}


# 8: near copies


def model_components(texts, size, percent):
    def shingles(t):
        w = words(t)
        return frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1)) or (frozenset([tuple(w)]) if w else frozenset())

    sets, root = {i: shingles(t) for i, t in texts.items()}, {i: i for i in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in texts:
        for j in texts:
            if i < j and sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: (len(sets[i]), find(i)) for i in texts}


def edited_copies(n=120, seed=8):
    """A group in which few copies are alike to any one of them."""
    rng = random.Random(seed)
    base = [f"w{i}" for i in range(80)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randint(1, 8)):
            w[rng.randrange(len(w))] = f"v{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("size", [2, 5])
def test_near_duplicates(spark, docs, empty, size):
    texts = {i: t for i, t in TEXTS.items() if i is not None} | {1000 + i: t for i, t in enumerate(edited_copies())}
    more = spark.createDataFrame([(i, t) for i, t in texts.items() if i >= 1000], "doc_id long, text string")
    got = by_id(neardup.near_duplicates(docs.unionByName(more, allowMissingColumns=True), words=size))
    want = model_components(texts, size, 80)
    for i, (n, c) in want.items():
        assert all((r["n_shingles"], r["component_id"], r["kept"]) == (n, c, c == i) for r in got[i]), i
    assert got[None][0]["kept"] is False
    assert neardup.near_duplicates(empty).count() == 0


@pytest.mark.parametrize("main", [0, 25])
def test_links_across_components_in_chunks(spark, main):
    texts = edited_copies(60, 9)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    signed = neardup.signatures(docs, 2)
    members = signed.select(F.lit(1).cast("long").alias("hub"), "node", F.when(F.col("doc_id") < main, 5).otherwise(F.col("node")).alias("component"), (F.col("doc_id") < main).alias("main"))
    links = neardup.across(members, signed, docs, 2, 80, chunk_rows=7).collect()
    node = {r["node"]: r["doc_id"] for r in signed.collect()}
    found = {r["node"]: r["component"] for r in components.components(spark.createDataFrame([(r["a"], r["b"]) for r in links], "a long, b long")).collect()}
    groups = lambda pairs: sorted(sorted(g) for g in pairs.values())
    got, want = {}, {}
    first = next((found.get(n, n) for n, i in node.items() if i < main), None)
    joined = {found.get(n, n) for n, i in node.items() if i < main}
    for n, i in node.items():
        got.setdefault(first if found.get(n, n) in joined else found.get(n, n), []).append(i)
    model = model_components(dict(enumerate(texts)), 2, 80)
    same = {model[i][1] for i in range(main)}
    for i, (_, c) in model.items():
        want.setdefault(min(same) if c in same else c, []).append(i)
    assert groups(got) == groups(want)


def test_texts_meet_only_where_sketches_call_for_it(spark, monkeypatch):
    """A bucket of 10,000 unlike rows, two pairs of which are alike: sketches go to all pairs of chunks, few texts do."""
    rng = random.Random(31)
    texts = {i: " ".join(rng.choice("abcdefghij") + str(rng.randrange(900)) for _ in range(30)) for i in range(10_000)}
    texts[9000], texts[9001] = texts[3] + " new", texts[4] + " new"
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    nodes = neardup.stored(neardup.signatures(docs, 2))
    members = nodes.selectExpr("1L AS hub", "node", "node AS component", "false AS main")
    plain, seen = neardup.with_texts, []

    def counted(wanted, *rest):
        seen.append(wanted.count())
        return plain(wanted, *rest)

    monkeypatch.setattr(neardup, "with_texts", counted)
    links = neardup.across(members, nodes, docs, 2, 80).collect()
    named = {r["node"]: r["doc_id"] for r in nodes.collect()}
    assert {frozenset((named[r["a"]], named[r["b"]])) for r in links} == {frozenset((3, 9000)), frozenset((4, 9001))}
    assert seen[0] < 1000


def test_near_duplicates_of_very_long_texts(spark):
    rng = random.Random(18)
    words_ = [f"w{rng.randrange(5000)}" for _ in range(60_000)]
    other = list(words_)
    for at in rng.sample(range(len(other)), 3000):
        other[at] = "changed"
    texts = {1: " ".join(words_), 2: " ".join(other), 3: " ".join(words_[:30_000]), 4: "short text"}
    got = by_id(neardup.near_duplicates(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), words=2))
    for i, (n, c) in model_components(texts, 2, 80).items():
        assert (got[i][0]["n_shingles"], got[i][0]["component_id"]) == (n, c)
    assert got[2][0]["component_id"] == 1 and got[3][0]["component_id"] == 3


def test_equal_hashes_of_unlike_sets_are_told_apart(spark, monkeypatch):
    from quern import scratch

    plain = neardup.signatures
    # All sets of one length get one node.
    monkeypatch.setattr(neardup, "signatures", lambda docs, words: plain(docs, words).withColumn("node", F.when(F.col("node").isNotNull(), F.col("n_shingles"))))
    monkeypatch.setattr(scratch.joined, "__defaults__", (3,))
    monkeypatch.setattr(neardup.compared, "__defaults__", (4,))
    texts = {i: t for i, t in TEXTS.items() if i is not None} | {1000 + i: t for i, t in enumerate(edited_copies(40))}
    got = by_id(neardup.near_duplicates(spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3), words=2))
    for i, (n, c) in model_components(texts, 2, 80).items():
        assert [(r["n_shingles"], r["component_id"], r["kept"]) for r in got[i]] == [(n, c, c == i)], i


def test_odd_sketches_estimate_similarity():
    rng = np.random.default_rng(2)
    shared, own = rng.integers(0, 2**63, 900, np.uint64), rng.integers(0, 2**63, 200, np.uint64)
    sets = [np.unique(np.r_[shared, own[:100]]), np.unique(np.r_[shared, own[100:]]), np.unique(own)]
    sketch = neardup.odd_sketches(neardup.minhashes(sets, 175)).view(np.uint64)
    differ = lambda i, j: int(np.bitwise_count(sketch[i] ^ sketch[j]).sum())
    assert differ(0, 0) == 0 and differ(0, 1) <= neardup.most_differing_bits(0.8) < differ(0, 2)


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(10**9), rng.randrange(10**9)) for _ in range(5)]
    chain = [rng.randrange(10**9) for _ in range(60)]
    edges += list(zip(chain, chain[1:])) + [(7, 7)]
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert len({got[c] for c in chain}) == 1 and len(set(got.values())) == 6 and 7 not in got
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# 9: suffixes


def test_prefix_groups():
    rng = random.Random(4)
    for trial in range(150):
        strings = ["".join(rng.choice("ab\0") for _ in range(rng.choice([0, 3, 9, 12, 30, 60]))).encode() for _ in range(rng.choice([1, 2, 5, 12]))]
        strings += [s[2:] for s in strings] if trial % 2 else []
        least, sizes = rng.choice([8, 9, 10, 14, 20]), np.array([len(s) for s in strings])
        place, group = suffixes.prefix_groups(np.frombuffer(b"".join(strings), np.uint8), sizes, least)
        want, got = {}, {}
        for base, s in zip(np.cumsum(sizes) - sizes, strings):
            for a in range(len(s) - least + 1):
                want.setdefault(s[a : a + least], []).append(base + a)
        for p, g in zip(place.tolist(), group.tolist()):
            got.setdefault(g, []).append(p)
        assert sorted(map(sorted, want.values())) == sorted(map(sorted, got.values()))


def model_repeats(texts):
    """(bytes, removed, spans, bytes left) of each document; texts by doc_id."""
    first, want = {}, {}
    for i in sorted(texts):
        b = (texts[i] or "").encode()
        gone = np.zeros(len(b), bool)
        for a in range(len(b) - 49):
            if first.setdefault(b[a : a + 50], i) < i:
                gone[a : a + 50] = True
        spans = int((gone & ~np.r_[False, gone[:-1]]).sum()) if len(b) else 0
        want[i] = (len(b), int(gone.sum()), spans, bytes(np.frombuffer(b, np.uint8)[~gone]) if len(b) else b"")
    return want


def test_language_sends_each_text_once(spark, capsys):
    """With the rows asked for, Python gets the text in the row alone; the results are those without the rows."""
    rows = [(i, ["the cat and the dog ", "der hund und die katze ", None, "123"][i % 4], ["en", "de", None, None][i % 4], i) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, n long")
    whole = langid.identify(docs, rows=True)
    whole.explain()
    assert "coalesce(text" not in capsys.readouterr().out
    plain = {r["doc_id"]: tuple(r) for r in langid.identify(docs).collect()}
    got = whole.collect()
    assert sorted(tuple(r["row"]) for r in got) == sorted(rows) and {p[2] for p in plain.values()} == {"en", "de", "und"}
    assert all((r["doc_id"], r["held_out"], r["lang_pred"], r["score"], r["langs"]) == plain[r["doc_id"]] for r in got)


def test_repeated_strings(spark, docs, empty):
    want = model_repeats({i: t for i, t in TEXTS.items() if i is not None})
    for bucket in (4 << 20, 1000):
        got = by_id(suffixdedup.cut_repeats(docs, bucket_bytes=bucket, fragment_bytes=bucket))
        for i, w in want.items():
            assert all((r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["text"])) == w for r in got[i]), i
        assert bytes(got[None][0]["text"]) == b"one two three"
    assert any(w[1] for w in want.values()) and suffixdedup.cut_repeats(empty).count() == 0


def test_unlike_texts_of_one_document(spark):
    """Each loses what its own bytes repeat of smaller doc_ids, and nothing to the others of its doc_id."""
    rng = random.Random(23)
    line = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    common, other = line(80), line(70)
    rows = [(1, line(20) + common + line(20) + other), (2, line(300)), (2, line(110) + common + line(40)), (2, other + line(60)), (2, None), (3, line(10) + common)]
    shared = line(90)
    rows += [(4, shared + line(9)), (4, line(30) + shared), (4, line(30) + shared + line(5) + other), rows[2]]
    table = spark.createDataFrame([(i, t, i, "x") for i, t in rows], "doc_id long, text string, base long, hash string").repartition(3)
    got, first = suffixdedup.cut_repeats(table).collect(), {}
    for i, t in rows:
        for a in range(len(t or "") - 49):
            first[t[a : a + 50]] = min(i, first.get(t[a : a + 50], i))
    want = []
    for i, t in rows:
        gone = np.zeros(len(t or ""), bool)
        for a in range(len(t or "") - 49):
            gone[a : a + 50] |= first[t[a : a + 50]] < i
        want.append((i, int(gone.sum()), "".join(c for c, g in zip(t or "", gone) if not g).encode()))
    assert sorted((r["doc_id"], r["n_removed"], bytes(r["text"])) for r in got) == sorted(want)
    assert any(w[1] for w in want) and (2, 0, rows[1][1].encode()) in want


@pytest.mark.parametrize("partitions", [1, 7])
def test_strings_that_all_documents_share(spark, partitions):
    rng = random.Random(19)
    line = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    common, second = line(90), line(64)
    texts = {i: line(rng.randint(0, 60)) + common[rng.choice([0, 0, 7]) :] + line(rng.randint(0, 60)) + second * rng.randint(0, 3) for i in range(80)}
    texts |= {100 + i: common for i in range(30)} | {200 + i: "ab" * rng.randint(20, 60) for i in range(20)}
    table = spark.createDataFrame([*texts.items(), (None, common), (None, common)], "doc_id long, text string").repartition(partitions)
    got = by_id(suffixdedup.cut_repeats(table, bucket_bytes=2000, fragment_bytes=2000))
    for i, w in model_repeats(texts).items():
        r = got[i][0]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["text"])) == w, i
    assert [bytes(r["text"]).decode() for r in got[None]] == [common, common]


def test_marks_and_ranges_return_in_one_row_a_document(spark):
    """However many buckets a document's marks and fragments meet in."""
    rng = random.Random(29)
    line = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    common = [line(70) for _ in range(40)]
    texts = {i: "".join(line(30) + c for c in rng.sample(common, 12)) for i in range(50)}
    table = spark.createDataFrame(list(texts.items()), "key long, text string").repartition(3)
    marks = [suffixdedup.shared_marks(table, 50, 14, 30, *shards).collect() for shards in ((), (7,))]
    assert all(len(m) == len({r["key"] for r in m}) == 50 for m in marks)
    assert len({str(sorted((r["key"], sorted(np.frombuffer(r["tags"], np.uint64).tolist())) for r in m)) for m in marks}) == 1
    tagged = table.withColumn("base", F.lit(0).cast("long")).join(suffixdedup.shared_marks(table, 50, 14, 30), "key")
    spans = [suffixdedup.repeated_ranges(tagged, 50, 14, 30, 30, *shards).collect() for shards in ((), (7,))]
    assert all(len(s) == len({r["key"] for r in s}) > 40 and any(len(r["spans"]) > 8 for r in s) for s in spans)
    got = by_id(suffixdedup.cut_repeats(table.withColumnRenamed("key", "doc_id"), bucket_bytes=1000, fragment_bytes=1000, shard_bytes=9000))
    for i, w in model_repeats(texts).items():
        assert (got[i][0]["n_bytes"], got[i][0]["n_removed"], got[i][0]["n_spans"], bytes(got[i][0]["text"])) == w, i


def test_segments_of_long_texts(monkeypatch):
    monkeypatch.setattr(suffixdedup, "SEGMENT", 100)
    text = bytes(random.Random(1).choices(b"abcdef", k=1234))
    found = np.zeros(len(text) - 49, int)
    for _, place, windows, _, data, at in suffixdedup.runs([text, b"short"], 50, 20):
        for p, n, a in zip(place, windows, at):
            found[p : p + n] += 1
            assert data[a : a + n + 49].tobytes() == text[p : p + n + 49]
    assert (found == 1).all()


# 10: language model


def test_gradients():
    rng = np.random.default_rng(0)
    p = {k: v.astype(np.float64) for k, v in gru.initial(np.arange(1, 10.0), 3, 4, 5).items()}
    p |= {k: rng.standard_normal(p[k].shape) * 0.5 for k in ("E", "Wc", "Wo", "b")}
    own = gru.Lanes([rng.integers(0, 9, n) for n in (7, 3, 5, 1)], 2, np.zeros(4, int))
    rows = own.rows(0, own.steps)
    slots = own.targets[np.concatenate(rows)]
    run = lambda keep=False: gru.forward(p, p["E"] @ p["W"] + p["b"], own, rows, np.zeros((2, 4)), keep)
    loss = lambda: -gru.log_probabilities(p, run()[0], slots)[0].sum()
    grads = {k: np.zeros_like(v) for k, v in p.items()}
    states, _, saved = run(True)
    gru.backward(p, grads, own, rows, saved, gru.log_probabilities(p, states, slots, grads)[1])
    for k in p:
        for _ in range(6):
            at, e = tuple(rng.integers(0, s) for s in p[k].shape), 1e-5
            held = p[k][at]
            p[k][at] = held + e
            up = loss()
            p[k][at] = held - e
            down = loss()
            p[k][at] = held
            assert abs((up - down) / (2 * e) - grads[k][at]) < 1e-4 * (1 + abs(grads[k][at]))


def forward_score(p, doc, end):
    """Natural log probability of a document, one token at a time, with plain formulas."""
    h, total, before = np.zeros(len(p["U"])), 0.0, end
    logistic, softmax = lambda x: 1 / (1 + np.exp(-x)), lambda x: np.exp(x) / np.exp(x).sum()
    n, words = len(h), p["bo"].shape[1]
    for token in np.asarray(doc, int):
        x, u = p["E"][before] @ p["W"] + p["b"], h @ p["U"]
        z, r = logistic(x[:n] + u[:n]), logistic(x[n : 2 * n] + u[n : 2 * n])
        h = z * h + (1 - z) * np.tanh(x[2 * n :] + r * u[2 * n :])
        c, w = divmod(int(token), words)
        total += np.log(softmax(h @ p["Wc"] + p["bc"])[c]) + np.log(softmax(h @ p["Wo"][c] + p["bo"][c])[w])
        before = token
    return total


def test_scores_do_not_depend_on_windows_and_lanes():
    rng = np.random.default_rng(1)
    p = gru.initial(np.arange(1, 10.0), 3, 4, 5)
    docs, gates = [rng.integers(0, 9, n) for n in (70, 3, 5, 1)], p["E"] @ p["W"] + p["b"]
    want = [forward_score(p, d, 0) for d in docs]
    assert np.allclose(gru.score(p, gates, docs, 0), want, atol=1e-3)
    assert np.allclose([gru.score(p, gates, [d], 0, window=3, most=1)[0] for d in docs], want, atol=1e-3)


def test_a_very_long_document_needs_memory_for_its_tokens_only():
    import tracemalloc

    p = gru.initial(np.arange(1, 10.0), 3, 4, 5)
    rng = np.random.default_rng(2)
    docs = [rng.integers(0, 9, n).astype(np.uint16) for n in [60_000, *[50] * 255]]
    tracemalloc.start()
    gru.score(p, p["E"] @ p["W"] + p["b"], docs, 0)
    gru.train(p, docs, 0)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 12 << 20  # lanes padded to the longest would take 200 MB


def test_training_and_scoring_reuse_their_memory():
    import os
    import subprocess
    import sys

    code = """import resource, numpy as np
from quern.llm import gru
rng = np.random.default_rng(4)
p, docs = gru.initial(rng.integers(1, 99, 2304).astype(float), 48, 16, 16), [rng.integers(0, 2304, n).astype(np.uint16) for n in rng.integers(50, 900, 400)]
for _ in range(2):
    before = resource.getrusage(resource.RUSAGE_SELF).ru_minflt
    p = gru.train(p, docs, 0)
    gru.score(p, p["E"] @ p["W"] + p["b"], docs, 0)
print(resource.getrusage(resource.RUSAGE_SELF).ru_minflt - before)"""
    faults = int(subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True, env={**os.environ, "PYTHONPATH": os.pathsep.join(sys.path)}).stdout)
    assert faults < 2000  # 8,500 with arrays given back and asked for again at every window


def test_training_pieces_cover_every_token():
    docs = [np.arange(10), np.arange(3), np.arange(8)]
    parts, first = gru.pieces(docs, 99, 4)
    assert np.concatenate(parts).tolist() == np.concatenate(docs).tolist() and max(map(len, parts)) == 4
    assert first.tolist() == [99, 3, 7, 99, 99, 3]


def test_language_model(spark, docs, empty, monkeypatch):
    lists = {i: [*words(t), None] for i, t in TEXTS.items()}
    learned = Counter(w for i, *_ in corpus() if i is not None and zlib.crc32(str(i).encode()) % 5 != 1 for w in lists[i])
    total, kinds = sum(learned.values()), len(learned)
    order = [None, *sorted((w for w in learned if w is not None), key=lambda w: (-learned[w], w.encode()))[: 6 * 6 - 2]]
    fixed = gru.initial(np.arange(1, 37.0), 6, 5, 4, seed=9)
    monkeypatch.setattr(lm, "learned_weights", lambda *a: fixed)
    rest, rest_kinds = total - sum(learned[w] for w in order), kinds - len(order)
    for table in (200_000, 60):
        got = by_id(lm.score_texts(docs, table=table, classes=6))
        assert set(got) == set(TEXTS)
        for i, rows in got.items():
            base = sum(math.log10((learned[w] + 0.5) / (total + 0.5 * (kinds + 1))) for w in lists[i])
            slots = [order.index(w) if w in order else len(order) for w in lists[i]]
            score = forward_score(fixed, slots, 0) / math.log(10) + sum(math.log10((learned[w] + 0.5) / (rest + 0.5 * (rest_kinds + 1))) for w in lists[i] if w not in order)
            for r in rows:
                assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(lists[i]), sum(learned[w] > 0 for w in lists[i]), total)
                assert abs(r["base_score"] - base) < 1e-6 * abs(base) and abs(r["score"] - score) < 1e-3 + 1e-5 * abs(score)
                assert r["held_out"] == (i is not None and zlib.crc32(str(i).encode()) % 5 == 1)
    assert lm.score_texts(empty).count() == 0
    assert [tuple(r)[2:5] for r in lm.score_texts(docs.where("doc_id IS NULL")).collect()] == [(4, 0, 0)]


def test_language_model_learns_from_every_training_document(spark, docs, monkeypatch):
    seen = []

    def averaged(part, weights, end):
        seen.extend(part.collect())
        return weights

    monkeypatch.setattr(lm, "averaged", averaged)
    lm.score_texts(docs, table=10, shard=300)
    ids = [i for i, *_ in corpus() if i is not None and zlib.crc32(str(i).encode()) % 5 != 1]
    assert sorted(r["doc_id"] for r in seen) == sorted(ids) and len({r["shard"] for r in seen}) > 3
    learned = Counter(w for i in ids for w in words(TEXTS[i]))
    most = sorted(learned, key=lambda w: (-learned[w], w.encode()))[: 48 * 48 - 2]
    slot = {w: n for n, w in enumerate(most, 1)}
    for r in seen:
        assert np.frombuffer(r["slots"], np.uint16).tolist() == [*(slot.get(w, len(most) + 1) for w in words(TEXTS[r["doc_id"]])), 0]


def test_language_model_scores_do_not_depend_on_partitions_and_beat_the_base(spark):
    rng = random.Random(10)
    kinds = ["alpha beta gamma delta", "one two three four five", "red green blue", "sun moon star sky"]
    rows = [(i, " ".join(rng.choice(kinds) for _ in range(rng.randint(1, 40)))) for i in range(1500)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    one, other = ({r["doc_id"]: r for r in lm.score_texts(table.repartition(n, "text"), shard=20_000).collect()} for n in (1, 5))
    assert all(abs(one[i]["score"] - other[i]["score"]) < 1e-4 * abs(one[i]["score"]) for i in one)
    held = [r for r in one.values() if r["held_out"]]
    assert sum(r["score"] for r in held) > 0.8 * sum(r["base_score"] for r in held)  # both are negative


# The pipeline


def pipeline_corpus():
    rng = random.Random(12)
    syllable = {"en": ["ka", "ta", "na", "ra", "so"], "fr": ["lo", "mi", "sü", "pe", "dré"]}
    say = lambda lang, n: " ".join("".join(rng.choice(syllable[lang]) for _ in range(rng.randint(1, 4))) for _ in range(n))
    texts = [say("en" if i % 2 else "fr", 120) for i in range(30)]
    return texts, say


def test_pipeline(spark, tmp_path):
    texts, say = pipeline_corpus()
    item = say("en", 20)
    near = texts[4].rsplit(" ", 2)[0] + " ka ta"
    odd = ["123", None, "", near, texts[6], texts[7] + " " + item]
    rows = [(i, t, "en" if i % 2 else "fr", "s", len(t or "")) for i, t in enumerate(texts + odd)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    kept = {r["doc_id"] for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert kept == set(range(30))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, str(tmp_path)).columns == docs.columns, name
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0, name


def test_pipeline_of_odd_rows(spark, tmp_path):
    """Null and repeated ids, clashing columns, one very long text; every stage against a model of it."""
    texts, say = pipeline_corpus()
    item, long = say("en", 20), "\n".join(say("fr", 40) for _ in range(1500))
    passage = "\n".join(say("en", 12) for _ in range(12))
    rows = [(i, t) for i, t in enumerate(texts)]
    rows += [(3, texts[2]), (3, texts[3]), (5, "9 9"), (6, texts[6] + " " + item), (None, texts[1]), (None, say("fr", 90)), (None, item), (40, long), (41, long + " x"), (42, say("en", 60) + "\n" + passage), (43, say("fr", 60) + "\n" + passage)]
    extra = [(i, t, "en", "s", len(t), 1, "key", True, 7, "r") for i, t in rows]
    schema = "doc_id long, text string, lang string, source string, n_chars int, row int, key string, kept boolean, text_hash long, row0 string"
    spark.createDataFrame(extra, schema).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs, sf = spark.read.parquet(str(tmp_path / "documents.parquet")), str(tmp_path)
    held = Counter(rows)

    def after(stage):
        nonlocal docs
        docs = corpus_pipeline.stored(stage(spark, docs, sf))
        assert docs.dtypes == [tuple(d) for d in spark.read.parquet(str(tmp_path / "documents.parquet")).dtypes]
        return Counter((r["doc_id"], r["text"]) for r in docs.collect())

    left = after(corpus_pipeline.language)
    assert held - left == Counter([(5, "9 9")])
    before, left = left, after(corpus_pipeline.lines)
    want = model_lines({i: t for i, t in before if i is not None and list(k for k, _ in before).count(i) == 1})
    assert all((i, w[3]) in left for i, w in want.items() if w[2] == 0) and sum(left.values()) == sum(before.values())
    assert len(dict(left.keys())[43].split("\n")) < 13 and dict(left.keys())[42].endswith(passage)
    before, left = left, after(corpus_pipeline.near_copies)
    gone = before - left
    assert (3, texts[2]) in gone and (3, texts[3]) not in gone and (None, texts[1]) in gone and (None, item) not in gone
    assert (40, long) in left and len(dict(left.keys())[41]) < len(long) / 10  # its lines went before
    before, left = left, after(corpus_pipeline.benchmark)
    assert {t for _, t in before - left} <= {texts[6] + " " + item, item} and (None, item) not in left
    assert all(item not in t for _, t in left) and (6, texts[6]) in left
    pieces = corpus_pipeline.packing(spark, docs, sf).collect()
    assert sum(p["length"] for p in pieces if p["start"] + p["length"] == p["doc_tokens"]) and {p["doc_id"] for p in pieces} == {i for i, _ in left}
