"""License scans by diagonal voting.

1. All rolling word k-grams of every text are hashed (positions numbered by words) and joined to the positions of the
   same hashes in the templates: four fixed phrases, license notices and whole short licenses.
2. A match votes for the diagonal (document position - template position). Votes are counted per document, template
   and diagonal. Words added or dropped move the rest to a neighbouring diagonal, so the votes of all diagonals up to
   `reach` further on are added, and every diagonal from which they suffice begins a candidate.
3. Candidates are verified on the text: a phrase must stand there word by word; of a notice, the longest common
   subsequence with the words within `reach` must hold at least `least` of its words.

Votes suffice if they are what is left when 1 - `least` of a template's words are replaced, each in two k-grams. The
template table is a constant of the code, so it is broadcast. Only matches are shuffled; votes are pre-aggregated.

Defined cases: null and empty texts have no words and no labels; texts of any length are scanned whole; positions of
rows that repeat a doc_id are collected as sets and verified on each row's own text; rows with a null doc_id are scanned
like others; of overlapping places of one notice the first counts; empty tables give no rows; other columns are ignored.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quern.llm.common import ALNUM, ROW, Hashes, gram_hashes, named_rows, raw, slices
from quern.scratch import spread

#: Phrase and label.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

#: Label and words of common license notices and short licenses.
NOTICES = {
    "apache-notice": "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0 unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied see the license for the specific language governing permissions and limitations under the license",
    "bsd-disclaimer": "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed in no event shall the copyright holder or contributors be liable for any direct indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute goods or services loss of use data or profits or business interruption however caused and on any theory of liability whether in contract strict liability or tort including negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage",
    "bsd-notice": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "cc-notice": "this work is licensed under a creative commons attribution 4 0 international license",
    "gpl-notice": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation",
    "gpl-warranty": "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general public license for more details",
    "isc-disclaimer": "the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness in no event shall the author be liable for any special direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits whether in an action of contract negligence or other tortious action arising out of or in connection with the use or performance of this software",
    "isc-notice": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "mit-disclaimer": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software",
    "mit-notice": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "mpl-notice": "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0",
    "unlicense": "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means",
}

TEMPLATES = [(text.encode().split(), label, True) for text, label in PHRASES.items()] + [(text.encode().split(), label, False) for label, text in NOTICES.items()]


def template_positions(spark: SparkSession, size: int) -> DataFrame:
    """(hash, template, at): every k-gram of the templates."""
    hashes = Hashes()
    rows = [(int(h), t, at) for t, (words, _, _) in enumerate(TEMPLATES) for at, h in enumerate(gram_hashes(hashes.of(words), size).view(np.int64))]
    return spark.createDataFrame(rows, "hash long, template int, at int")


def rolling_hashes(docs: DataFrame, size: int) -> DataFrame:
    """(key, unnamed, hashes): the hashes of all k-grams of each text, by position."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes()
        for batch in batches:
            for some in slices(batch, "text", 2 << 20):
                grams = [gram_hashes(hashes.of(t.translate(ALNUM).split()), size).view(np.int64) for t in raw(some.column("text"))]
                ends = np.cumsum([0, *map(len, grams)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([some.column("key"), some.column("unnamed"), pa.ListArray.from_arrays(ends, pa.array(np.concatenate(grams)))], [*ROW, "hashes"])

    return spread(named_rows(docs).select(*ROW, "text")).mapInArrow(run, "key long, unnamed boolean, hashes array<long>")


def starts(docs: DataFrame, size: int, reach: int, needed: list[int]) -> DataFrame:
    """(key, unnamed, template, diagonal): where a template's votes, with those of a notice's next diagonals, suffice."""
    grams = rolling_hashes(docs, size).select(*ROW, F.posexplode("hashes").alias("place", "hash"))
    matches = grams.join(F.broadcast(template_positions(docs.sparkSession, size)), "hash")
    votes = matches.groupBy(*ROW, "template", (F.col("place") - F.col("at")).alias("diagonal")).agg(F.countDistinct("at").alias("votes"))
    onward = Window.partitionBy(*ROW, "template").orderBy("diagonal").rangeBetween(0, reach)
    many = F.when(F.col("template") < len(PHRASES), F.col("votes")).otherwise(F.sum("votes").over(onward))
    return votes.withColumn("many", many).where(F.col("many") >= F.element_at(F.array(*map(F.lit, needed)), F.col("template") + 1)).drop("votes", "many")


def aligned(template: list[bytes], window: list[bytes]) -> tuple[int, int, int]:
    """Length of the longest common subsequence, and its first and last place in the window."""
    names = {w: i for i, w in enumerate(set(template))}
    right = np.array([names.get(w, -1) for w in window])
    table = np.zeros((len(template) + 1, len(window) + 1), np.int32)
    for i, word in enumerate(template):
        table[i + 1, 1:] = np.maximum.accumulate(np.maximum(table[i, 1:], np.where(right == names[word], table[i, :-1] + 1, 0)))
    i, j, places = len(template), len(window), []
    while i and j and table[i, j]:
        if table[i - 1, j] == table[i, j]:
            i -= 1
        elif table[i, j - 1] == table[i, j]:
            j -= 1
        else:
            i, j = i - 1, j - 1
            places.append(j)
    return len(places), *((places[-1], places[0]) if places else (-1, -1))


def scan(docs: DataFrame, size: int = 2, reach: int = 12, least: float = 0.7) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans) of every document row.

    spans: the verified places (label, first word, last word, coverage); score: their best coverage.
    """
    n_grams = [len(w) - size + 1 for w, _, _ in TEMPLATES]
    needed = [n if phrase else max(2, int(n * (1 - size * (1 - least)))) for n, (_, _, phrase) in zip(n_grams, TEMPLATES)]
    likely = starts(docs, size, reach, needed).groupBy(*ROW).agg(F.collect_set(F.struct("template", "diagonal")).alias("places"))
    rows = named_rows(docs).join(likely, ROW, "left").select("doc_id", "text", "places")
    schema = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans array<struct<label: string, first: long, last: long, coverage: double>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, text, places in zip(batch.column("doc_id").to_pylist(), raw(batch.column("text")), batch.column("places").to_pylist()):
                words, begin, base, found = text.translate(ALNUM).split(), [], set(), []
                taken = [-1] * len(TEMPLATES)  # the last word of each template's last place
                for number, d in sorted((p["template"], p["diagonal"]) for p in places or []):
                    template, label, phrase = TEMPLATES[number]
                    low, high = max(0, d, taken[number] + 1), d + len(template)
                    if phrase:
                        if d >= 0 and words[d:high] == template:
                            begin.append(d)
                            base.add(label)
                            found.append({"label": label, "first": d, "last": high - 1, "coverage": 1.0})
                    elif high + reach - low >= least * len(template):
                        n, first, last = aligned(template, words[low : high + reach])
                        if n >= least * len(template):
                            taken[number] = low + last
                            found.append({"label": label, "first": low + first, "last": low + last, "coverage": n / len(template)})
                labels = sorted({f["label"] for f in found})
                out.append({"doc_id": doc, "n_words": len(words), "n_base": len(begin), "first_word": min(begin, default=None), "last_word": max(begin, default=None), "base_labels": ",".join(sorted(base)), "labels": ",".join(labels), "score": max((f["coverage"] for f in found), default=0.0), "spans": found})
            yield pa.RecordBatch.from_pylist(out, arrow)

    place = pa.struct([("label", pa.string()), ("first", pa.int64()), ("last", pa.int64()), ("coverage", pa.float64())])
    arrow = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()), ("spans", pa.list_(place))])
    return rows.mapInArrow(run, schema)
