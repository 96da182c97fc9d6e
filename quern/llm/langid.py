"""Language identification by multilingual mixture inference.

Training counts hashed character trigrams per language over a bounded, deterministic sample of labelled rows (at most
about `bound` rows of a language, chosen by a hash of doc_id). Prediction reads every whole text: expectation-
maximisation estimates which share of the text's trigrams each language explains, and the set of languages is the
nested one (languages added by share) with the best likelihood less a penalty for each language. lang_pred is the
language with the largest share of that set, score its share.

Defined cases: a null text, or one without any letter (Unicode category L), is `und` with score 0; so is every text if nothing can be
learned from. Null langs are not learned from. A null doc_id has no remainder: it is not held out, nor learned from.
Ties go to the alphabetically first language. Repeated rows count each. Empty tables give no rows; other columns of
the table are ignored.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from quern.llm.common import remainder, slices, texts_of, tidy
from quern.scratch import spread

UNKNOWN = "und"
BUCKETS = 1 << 15
#: Bytes that are no part of a letter count as one space.
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))


def has_letter(text: str) -> bool:
    """Whether any character is a letter by its Unicode category (number signs such as one half are none)."""
    return any(map(str.isalpha, text))


def trigrams(text: str) -> np.ndarray:
    """Bucket of every byte trigram of the lower-cased text."""
    b = np.frombuffer(b" " + text.lower().encode().translate(LETTERS) + b"  ", np.uint8).astype(np.uint32)
    h = (b[:-2] << np.uint32(16) | b[1:-1] << np.uint32(8) | b[2:]) * np.uint32(0x9E3779B1)
    return (h[b[1:-1] != 32] if (b[1:-1] != 32).any() else h) >> np.uint32(17)


def train(labelled: DataFrame, bound: int = 10_000, smoothing: float = 0.5) -> tuple[list[str], np.ndarray]:
    """Languages in order, and the log probability of each trigram bucket in each (bucket x language)."""
    sizes = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}
    if not sizes:
        return [], np.zeros((BUCKETS, 0), np.float32)
    step = F.create_map(*[F.lit(v) for lang, n in sizes.items() for v in (lang, min(1 << 20, -(-bound * (1 << 20) // n)))])
    sample = labelled.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < step[F.col("lang")])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                total.setdefault(lang, np.zeros(BUCKETS, np.int64))
                total[lang] += np.bincount(trigrams(text), minlength=BUCKETS)
        for lang, n in total.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at), pa.array(n[at])], ["lang", "bucket", "n"])

    counts = sample.mapInArrow(count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    langs = sorted(sizes)
    table = np.full((BUCKETS, len(langs)), smoothing)
    place = {lang: i for i, lang in enumerate(langs)}
    np.add.at(table, (counts.column("bucket").to_numpy(), np.array([place[x] for x in counts.column("lang").to_pylist()], int)), counts.column("n").to_numpy())
    return langs, np.log(table / table.sum(0)).astype(np.float32)


def mixture(likely: np.ndarray, times: np.ndarray, share: np.ndarray, rounds: int = 12) -> tuple[np.ndarray, float]:
    """Shares after EM from `share`, and the log likelihood of the n-grams (row: n-gram, column: language)."""
    total = times.sum()
    for _ in range(rounds):
        weight = times / (likely @ share)
        new = share * (weight @ likely) / total
        done = np.abs(new - share).max() < 1e-3
        share = new
        if done:
            break
    return share, float(times @ np.log(likely @ share))


def infer(grams: np.ndarray, logs: np.ndarray, penalty: float) -> np.ndarray:
    """Share of each language in the text; 0 for the languages outside the chosen set."""
    times = np.bincount(grams, minlength=BUCKETS)
    seen = np.flatnonzero(times)
    times, own = times[seen].astype(np.float32), logs[seen]
    top = own.max(1, keepdims=True)
    likely, base = np.exp(own - top), float(times @ top[:, 0])
    k = logs.shape[1]
    full, _ = mixture(likely, times, np.full(k, 1 / k, np.float32))
    order = np.argsort(-full, kind="stable")
    cost = penalty * np.log(1 + times.sum())
    best, chosen = -np.inf, None
    for n in range(1, k + 1):
        some = order[:n]
        share, fit = mixture(likely[:, some], times, np.maximum(full[some], 1e-6) / np.maximum(full[some], 1e-6).sum()) if n > 1 else (np.ones(1), float(times @ np.log(np.maximum(likely[:, order[0]], 1e-30))))
        if fit + base - cost * n <= best:
            break
        best, chosen = fit + base - cost * n, (some, share)
    out = np.zeros(k)
    out[chosen[0]] = chosen[1]
    return out


def identify(docs: DataFrame, folds: int = 3, fold: int = 1, bound: int = 10_000, penalty: float = 4.0, rows: bool = False) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, langs) of every row; langs lists the chosen set, largest share first.

    Rows whose crc32(doc_id) modulo `folds` is `fold` are held out; the model learns from the others' text and lang.
    rows: add the table's own columns as a struct `row`.
    """
    held = F.coalesce(remainder("doc_id", folds) == fold, F.lit(False))
    labelled = docs.where(remainder("doc_id", folds) != fold).where("lang IS NOT NULL AND text IS NOT NULL").select("doc_id", "text", "lang")
    langs, logs = train(spread(labelled), bound)
    model = docs.sparkSession.sparkContext.broadcast((langs, logs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, logs = model.value
        for batch in batches:
            if inside:
                batch = batch.append_column("text", pa.compute.fill_null(pa.compute.struct_field(batch.column("row"), "text"), ""))
            for some in slices(batch, "text"):
                names, scores, sets = [], [], []
                for text in some.column("text").to_pylist():
                    if not langs or not has_letter(text):
                        names.append(UNKNOWN)
                        scores.append(0.0)
                        sets.append("")
                        continue
                    share = infer(trigrams(text), logs, penalty)
                    order = np.argsort(-share, kind="stable")
                    names.append(langs[order[0]])
                    scores.append(min(1.0, max(0.0, float(share[order[0]]))))
                    sets.append(",".join(langs[i] for i in order if share[i] > 0))
                found = [pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(sets, pa.string())]
                kept = {c: some.column(c) for c in some.schema.names if c != "text"}
                yield pa.RecordBatch.from_arrays([*kept.values(), *found], [*kept, "lang_pred", "score", "langs"])

    whole = [F.struct("*").alias("row")] if rows else []
    texts = texts_of(docs, held.alias("held_out"), *whole)
    schema = texts.drop("text").schema
    # A row's struct has its text; no task sends it to Python a second time.
    inside = rows and any(f.name == "text" and f.dataType == StringType() for f in docs.schema)
    texts = texts.drop("text") if inside else texts
    for name, kind in (("lang_pred", "string"), ("score", "double"), ("langs", "string")):
        schema = schema.add(name, kind)
    return spread(texts).mapInArrow(tidy(run), schema)
