"""Line deduplication by content-defined chunks, in DataFrame operations only.

A text's lines are hashed; a rolling hash over one line hash (the next line's) or two (the last two lines') puts lines
into residue classes modulo `divisor`. In the chunking (r, s) a chunk begins before every line of class r and ends after
every pair of lines of class s, so boundaries depend on nearby lines alone and an inserted line shifts none further on.
Every pair of classes gives a chunking of its own; a passage that one of them doesn't isolate is isolated by another.
Chunks of two lines or more are equal if their SHA-256 is; of equal chunks the first one (by doc_id, then place) stays,
and the lines of the others go. A removed line has an equal one at an earlier place, so
the first copy of every line stays whatever the chunkings remove.

No text of a chunk ever moves: chunkings overlap, so their chunks hold several times the table. Each is made in the scan
and leaves it as a digest of 32 bytes; digests are written once, counted, and met by the first place of those that occur
again, frequent ones apart from the others, in the same way at any size. Texts are shuffled once, to lose their lines.

Defined cases: null and empty texts are one empty line; a single line is no chunk and always stays; rows that repeat
both doc_id and text count as one row and lose nothing to each other; a row with a null doc_id can't be ordered, so it
stays whole and repeats nothing; empty tables give no rows; other columns of the table are passed through.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quern.scratch import joined, stored


def pinned(df: DataFrame, **expressions: str) -> DataFrame:
    """df with more columns that are computed once a row: a generator keeps them from being inlined into lambdas."""
    fields = ", ".join(f"{e} AS {name}" for name, e in expressions.items())
    return df.select("*", F.expr(f"inline(array(struct({fields})))"))


def lined(docs: DataFrame, divisor: int) -> DataFrame:
    """docs as (own0, own1, ...: its columns by place, doc_id, text_hash, lines, chunks): chunks are (start, stop), stop excluded."""
    key, text = (f"own{docs.columns.index(c)}" for c in ("doc_id", "text"))
    rows = docs.toDF(*[f"own{i}" for i in range(len(docs.columns))])
    rows = rows.select("*", F.col(key).cast("long").alias("doc_id"), F.expr(f"xxhash64(coalesce({text}, ''))").alias("text_hash"))
    rows = pinned(rows, lines=f"split(coalesce({text}, ''), '\n')")
    rows = pinned(rows, hashes="transform(lines, l -> CAST(conv(substr(md5(CAST(l AS BINARY)), 1, 8), 16, 10) AS BIGINT))")
    places = "filter(sequence(1, size(hashes) - 1), i -> i > 0 AND i < size(hashes) AND ({}))"
    opens = f"(get(hashes, i) * 17 + 5) div 16 % {divisor}"
    shuts = f"(i > 1 AND (get(hashes, i - 2) * 31 + get(hashes, i - 1)) % {divisor} = {{s}})"
    stops = {f"stops{r}{s}": f"array_append({places.format(f'{opens} = {r} OR ' + shuts.format(s=s))}, size(hashes))" for r in range(divisor) for s in range(divisor)}
    rows = pinned(rows, **stops)
    # A range as one number, since distinct numbers are found by hashing and distinct structs by comparing all.
    chunk = "transform(filter(transform({0}, (e, i) -> struct(IF(i = 0, 0, get({0}, i - 1)) AS start, e AS stop)), c -> c.stop - c.start > 1), c -> c.start * 4294967296 + c.stop)"
    rows = pinned(rows, ranges=f"array_distinct(concat({', '.join(chunk.format(name) for name in stops)}))").drop(*stops)
    return pinned(rows, chunks="transform(ranges, c -> struct(CAST(c div 4294967296 AS INT) AS start, CAST(c % 4294967296 AS INT) AS stop))").drop("ranges", "hashes")


def repeated_chunks(rows: DataFrame) -> DataFrame:
    """(doc_id, text_hash, gone): the line ranges that each document loses, sorted, disjoint."""
    digests = "inline(transform(chunks, c -> struct(c.start AS start, c.stop AS stop, unhex(sha2(array_join(slice(lines, c.start + 1, c.stop - c.start), '\n'), 256)) AS digest)))"
    found = stored(rows.where("doc_id IS NOT NULL").select("doc_id", "text_hash", F.expr(digests)))
    firsts = stored(found.groupBy("digest").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "start")).alias("first")).where("n > 1"))
    met = joined(found, firsts, ["digest"])
    gone = met.where("struct(doc_id, start) > first").select("doc_id", "text_hash", "start", "stop")
    # Ranges of several chunkings overlap, those of repeated rows are equal: each goes on where those before it have ended.
    before = Window.partitionBy("doc_id", "text_hash").orderBy("start", "stop").rowsBetween(Window.unboundedPreceding, -1)
    gone = gone.withColumn("start", F.greatest("start", F.coalesce(F.max("stop").over(before), F.lit(0)))).where("start < stop")
    return gone.groupBy("doc_id", "text_hash").agg(F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("gone"))


def dedup_lines(docs: DataFrame, divisor: int = 3) -> DataFrame:
    """docs with their remaining text, plus n_lines, n_chunks, n_removed (lines) as columns of a struct `lines_report`."""
    rows = lined(docs, divisor)
    # Lines are cut again after the shuffle, and only of texts that lose some: as an array they are larger than the text.
    own, text = [f"own{i}" for i in range(len(docs.columns))], f"own{docs.columns.index('text')}"
    sizes = rows.select(*own, "doc_id", "text_hash", F.expr("CAST(size(lines) AS BIGINT)").alias("n_lines"), F.expr("CAST(size(chunks) AS BIGINT)").alias("n_chunks"))
    met = pinned(sizes.join(repeated_chunks(rows), ["doc_id", "text_hash"], "left"), lines=f"IF(gone IS NULL, array(), split({text}, '\n'))")
    stays = "transform(sequence(0, size(gone)), i -> struct(IF(i = 0, 0, get(gone, i - 1).stop) AS start, IF(i = size(gone), size(lines), get(gone, i).start) AS stop))"
    kept = F.expr(f"IF(gone IS NULL, coalesce({text}, ''), array_join(flatten(transform({stays}, s -> slice(lines, s.start + 1, s.stop - s.start))), '\n'))")
    removed = F.expr("CAST(IF(gone IS NULL, 0, aggregate(gone, 0, (n, c) -> n + c.stop - c.start)) AS BIGINT)")
    report = F.struct("n_lines", "n_chunks", removed.alias("n_removed"))
    columns = [(kept if c == "text" else F.col(f"own{i}")).alias(c) for i, c in enumerate(docs.columns)]
    return met.select(*columns, report.alias("lines_report"))


def sql(divisor: int = 3) -> str:
    """The op5 query in DuckDB SQL."""
    return f"""
WITH e AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents),
h AS (SELECT *, ('0x' || substr(md5(line), 1, 8))::BIGINT AS v FROM e),
m AS (SELECT doc_id, i, line, i > 1 AS inner_line, (v * 17 + 5) // 16 % {divisor} AS opens,
    CASE WHEN i > 2 THEN (lag(v, 2) OVER (PARTITION BY doc_id ORDER BY i) * 31 + lag(v) OVER (PARTITION BY doc_id ORDER BY i)) % {divisor} ELSE -1 END AS shuts FROM h),
b AS (SELECT m.*, r.r * {divisor} + s.s AS chunking, CASE WHEN inner_line AND (opens = r.r OR shuts = s.s) THEN 1 ELSE 0 END AS cut FROM m, range({divisor}) r(r), range({divisor}) s(s)),
c AS (SELECT *, sum(cut) OVER (PARTITION BY doc_id, chunking ORDER BY i) AS chunk FROM b),
k AS (SELECT DISTINCT doc_id, min(i) AS start, max(i) AS stop, string_agg(line, chr(10) ORDER BY i) AS body FROM c GROUP BY doc_id, chunking, chunk HAVING count(*) > 1),
f AS (SELECT *, row_number() OVER (PARTITION BY body ORDER BY doc_id, start) > 1 AS gone FROM k),
g AS (SELECT DISTINCT doc_id, unnest(range(start, stop + 1)) AS i FROM f WHERE gone),
n AS (SELECT doc_id, count(*) AS n_chunks FROM k GROUP BY doc_id),
t AS (SELECT e.doc_id, count(*) AS n_lines, count(g.i) AS n_removed, coalesce(string_agg(line, chr(10) ORDER BY e.i) FILTER (g.i IS NULL), '') AS kept FROM e LEFT JOIN g USING (doc_id, i) GROUP BY e.doc_id)
SELECT t.doc_id, n_lines, coalesce(n_chunks, 0) AS n_chunks, n_removed, sha256(kept) AS kept_sha256 FROM t LEFT JOIN n USING (doc_id)
"""
