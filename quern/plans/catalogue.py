"""The query catalogue: each operator over its whole table, and DuckDB SQL where SQL can express it.

The tables barely hold the negative cases of the filters, so queries derive them from the key with one expression that
both engines understand.
"""

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions import html as H
from quern.functions import replies as R
from quern.functions import scores as S
from quern.functions import tables
from quern.functions import text as T
from quern.operators import convert, expand, minhash, select, similarity, sketches
from quern.operators.asof import asof_join
from quern.operators.intervals import interval_join
from quern.scratch import shared_folder, small, spread, stored
from quern.sources.trees import read_tree, write_tree
from quern.streaming.arrivals import feed
from quern.streaming.resume import stream_dedup
from quern.streaming.windows import range_join, sessions, windowed

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(sql: str | None = None):
    """Register a query by its function's name."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


REPLY = """CASE page_id % 8 WHEN 0 THEN html WHEN 1 THEN '```html' || chr(10) || html || chr(10) || '```'
 WHEN 2 THEN replace(html, '</body>', '') WHEN 3 THEN html || ' TODO later' WHEN 4 THEN substr(html, 1, 120)
 WHEN 5 THEN '```' || chr(10) || html || chr(10) || '```' WHEN 6 THEN html || '<input placeholder="n">' ELSE 'plain words without tags' END"""
SCORE = "CASE WHEN quality IS NULL THEN NULL ELSE CAST(doc_id * 7919 % 1000 AS DOUBLE) / 10 END"
REPLIES = f"WITH r AS (SELECT page_id, {REPLY} AS response FROM pages)"


def count_sql(pattern: str, column: str = "response") -> str:
    return f"len(regexp_extract_all({column}, '{pattern}'))"


def any_sql(column: str, parts: list[str]) -> str:
    return "(" + " OR ".join(f"contains({column}, '{p}')" for p in parts) + ")"


def times_sql(part: str) -> str:
    return f"(length(low) - length(replace(low, '{part}', ''))) // {len(part)}"


STRIP_SQL = r"regexp_replace({}, '^\s+|\s+$', '', 'g')"
RULES_SQL = f"""CASE WHEN length({STRIP_SQL.format('response')}) < 100 THEN 'too_short'
 WHEN NOT {any_sql('lower(response)', [*H.HTML_MARKERS, '<svg'])} THEN 'no_markup'
 WHEN {any_sql('response', H.UNFINISHED)} THEN 'unfinished'
 WHEN abs({count_sql(H.OPEN_TAG)} - {count_sql(H.CLOSE_TAG)} - {count_sql(H.SELF_CLOSED)}) > 0.3 * {count_sql(H.OPEN_TAG)} THEN 'unbalanced'
 WHEN {count_sql(H.ELEMENT)} < 3 THEN 'few_elements' ELSE 'pass' END"""
STATUS_SQL = f"""CASE WHEN length(response) < 50 THEN 'too_short' WHEN NOT contains(low, '<html') THEN 'no_html_tag' WHEN NOT contains(low, '<body') THEN 'no_body_tag'
 WHEN {times_sql('<html')} <> {times_sql('</html')} THEN 'unbalanced_html' WHEN {times_sql('<body')} <> {times_sql('</body')} THEN 'unbalanced_body'
 WHEN {any_sql('low', H.PLACEHOLDERS)} THEN 'has_placeholder' WHEN length(response) < 200 THEN 'too_minimal' ELSE 'valid' END"""


def replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "pages").selectExpr("page_id", f"{REPLY} AS response"))


@query("SELECT lang, count(DISTINCT text) AS n FROM documents GROUP BY lang")
def exact_dedup_by_lang(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").where("text IS NOT NULL")
    # Copies are told apart within their language, as the counts are by language.
    first = docs.groupBy("lang", F.sha2("text", 256).alias("digest")).agg(F.min("doc_id").alias("doc_id"))
    return first.groupBy("lang").agg(F.count("*").alias("n"))


@query("SELECT doc_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS nth FROM documents) WHERE nth = 1")
def exact_dedup(spark, sf_dir):
    return minhash.exact_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", "text").select("doc_id")


@query("SELECT doc_id, CAST(length(text) AS BIGINT) AS n_chars FROM documents WHERE length(text) * 0.75 <= 2048")
def length_filter(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").where(H.fits_length(F.col("text"), 2048))
    return docs.select("doc_id", F.length("text").cast("long").alias("n_chars"))


@query(f"SELECT doc_id FROM documents WHERE length({STRIP_SQL.format('text')}) >= 100")
def min_text_filter(spark, sf_dir):
    return table(spark, sf_dir, "documents").where(F.length(T.strip(F.col("text"))) >= 100).select("doc_id")


@query(f"{REPLIES} SELECT page_id, {RULES_SQL} AS reason FROM r")
def rule_reasons(spark, sf_dir):
    return replies(spark, sf_dir).select("page_id", H.rule_reason(F.col("response")).alias("reason"))


@query(f"{REPLIES} SELECT page_id FROM r WHERE {RULES_SQL} = 'pass' AND length(response) * 0.75 <= 16384")
def rule_filter(spark, sf_dir):
    return replies(spark, sf_dir).where(H.passes_rules(F.col("response")) & H.fits_length(F.col("response"))).select("page_id")


@query(f"SELECT page_id, {', '.join(f'{count_sql(p, chr(104) + chr(116) + chr(109) + chr(108))} AS {n}' for n, p in (('open_tags', H.OPEN_TAG), ('close_tags', H.CLOSE_TAG), ('self_closed', H.SELF_CLOSED), ('elements', H.ELEMENT)))} FROM pages")
def tag_counts(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", *[c.alias(n) for n, c in H.tag_counts(F.col("html")).items()])


@query(f"{REPLIES} SELECT page_id, {STATUS_SQL} AS status FROM (SELECT *, lower(response) AS low FROM r)")
def validate_html_status(spark, sf_dir):
    return replies(spark, sf_dir).select("page_id", H.validation_status(F.col("response")).alias("status"))


@query(f"{REPLIES}, s AS (SELECT {STATUS_SQL} AS status FROM (SELECT *, lower(response) AS low FROM r)) SELECT status, count(*) AS n FROM s GROUP BY status UNION ALL SELECT 'total', count(*) FROM s")
def validate_status_counts(spark, sf_dir):
    return select.status_counts(validate_html_status(spark, sf_dir), "status")


def longest_sql(pattern: str) -> str:
    longest = f"list_reduce(list_prepend('', regexp_extract_all(response, '{pattern}', 1)), lambda a, b: CASE WHEN length(b) > length(a) THEN b ELSE a END)"
    return STRIP_SQL.format(longest)


FENCES = {"one": r"(?i)```html\s*((?s:.)*?)```", "three": r"(?i)```\s*(<!DOCTYPE(?s:.)*?)```", "four": r"(?i)```\s*(<html(?s:.)*?</html>)(?s:.)*?```"}


@query(f"""{REPLIES}, b AS (SELECT page_id, response, {', '.join(f'{longest_sql(p)} AS {n}' for n, p in FENCES.items())} FROM r)
 SELECT page_id, CASE WHEN response = '' THEN 'empty_response' WHEN one <> '' THEN 'html_block' WHEN three <> '' THEN 'doctype_block' WHEN four <> '' THEN 'html_tag_block' ELSE 'no_html_block' END AS status,
 md5(CASE WHEN one <> '' THEN one WHEN three <> '' THEN three WHEN four <> '' THEN four END) AS digest FROM b""")
def extract_html_block(spark, sf_dir):
    found = replies(spark, sf_dir).select("page_id", H.html_block(F.col("response")).alias("b"))
    return found.select("page_id", "b.status", F.md5("b.html").alias("digest"))


PAGE_SQL = rf"""CASE WHEN {STRIP_SQL.format('response')} = '' THEN ''
 WHEN regexp_matches(response, '{H.CODE_BLOCK}') THEN {STRIP_SQL.format(f"regexp_extract(response, '{H.CODE_BLOCK}', 1)")}
 WHEN regexp_matches(response, '{H.DOCTYPE_PAGE}') THEN {STRIP_SQL.format(f"regexp_extract(response, '{H.DOCTYPE_PAGE}', 1)")}
 WHEN regexp_matches(response, '{H.HTML_PAGE}') THEN {STRIP_SQL.format(f"regexp_extract(response, '{H.HTML_PAGE}', 1)")}
 WHEN regexp_matches(response, '{H.SVG_IMAGE}') THEN '{H.PAGE_HEAD + H.SVG_BODY}' || chr(10) || regexp_extract(response, '{H.SVG_IMAGE}', 1) || chr(10) || '</body>' || chr(10) || '</html>'
 WHEN regexp_matches(response, '{H.BODY}') THEN '{H.PAGE_HEAD}<body>' || {STRIP_SQL.format(f"regexp_extract(response, '{H.BODY}', 1)")} || '</body>' || chr(10) || '</html>' ELSE '' END"""
PARTS = "CASE page_id % 3 WHEN 0 THEN replace(replace(html, '<html', '<hxml'), '</html', '</hxml') WHEN 1 THEN 'see <svg width=\"2\"><g></g></svg> there' ELSE html END"


@query(f"WITH r AS (SELECT page_id, {REPLY} AS response FROM pages UNION ALL SELECT page_id + 1000000, {PARTS} FROM pages) SELECT page_id, md5({PAGE_SQL}) AS digest FROM r")
def extract_code_block(spark, sf_dir):
    parts = table(spark, sf_dir, "pages").selectExpr("page_id + 1000000 AS page_id", f"{PARTS} AS response")
    return replies(spark, sf_dir).union(spread(parts)).select("page_id", F.md5(H.page(F.col("response"))).alias("digest"))


GRAMS_SQL = "CASE WHEN length(t) < 5 THEN [t] ELSE list_distinct(list_transform(range(1, length(t) - 3), lambda i: substr(t, i, 5))) END"
NORMAL_SQL = f"SELECT doc_id, {STRIP_SQL.format('lower(text)')} AS t FROM documents"


@query(f"SELECT doc_id, CAST(len({GRAMS_SQL}) AS BIGINT) AS n FROM ({NORMAL_SQL})")
def shingle_counts(spark, sf_dir):
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return docs.select("doc_id", F.size(minhash.shingles(F.col("text"))).cast("long").alias("n"))


HASHES_SQL = f"SELECT doc_id, ({' + '.join(f"('0x' || substr(d, {1 + 8 * i}, 8))::BIGINT" for i in range(4))}) % {minhash.LARGEST} AS hash FROM (SELECT doc_id, md5(g) AS d FROM (SELECT doc_id, unnest({GRAMS_SQL}) AS g FROM ({{}})))"


@query(f"SELECT doc_id, min(hash) AS least, max(hash) AS greatest, count(*) AS n FROM ({HASHES_SQL.format(NORMAL_SQL)}) GROUP BY doc_id")
def shingle_base_hash(spark, sf_dir):
    return minhash.hash_ranges(normal_docs(spark, sf_dir)).withColumnRenamed("id", "doc_id")


def normal_docs(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), minhash.normalised(F.col("text")).alias("text_norm"))


# The hash family in SQL: a * h + b fits 64 bits without a sign; the library's signed arithmetic wraps at 2^63.
FAMILY = minhash.family(128)
WRAPPED = (minhash.PRIME - 2**64 % minhash.PRIME) % minhash.PRIME
FAMILY_SQL = f"SELECT unnest(range(128)) AS i, unnest({FAMILY[0].tolist()}::UBIGINT[]) AS a, unnest({FAMILY[1].tolist()}::UBIGINT[]) AS b"
SIGNED_SQL = """hashes AS ({hashes}), sig AS (SELECT doc_id, i, min(least({largest}, CASE WHEN x >= 9223372036854775808 THEN (x % {prime} + {wrapped}) % {prime} ELSE x % {prime} END)) AS v
 FROM (SELECT doc_id, i, a * hash::UBIGINT + b AS x FROM hashes, ({family})) GROUP BY doc_id, i)"""


def signed_sql(texts: str) -> str:
    return SIGNED_SQL.format(hashes=HASHES_SQL.format(texts), largest=minhash.LARGEST, prime=minhash.PRIME, wrapped=WRAPPED, family=FAMILY_SQL)


# The best row of each normalised text, and its candidates and links.
BEST_SQL = f"SELECT doc_id, t, size FROM (SELECT *, row_number() OVER (PARTITION BY t ORDER BY size DESC, doc_id) AS nth FROM (SELECT doc_id, coalesce({STRIP_SQL.format('lower(text)')}, '') AS t, coalesce(length(text), 0) AS size FROM documents)) WHERE nth = 1"
LINKS_SQL = f"""best AS MATERIALIZED ({BEST_SQL}), {signed_sql('SELECT doc_id, t FROM best')},
 bands AS MATERIALIZED (SELECT doc_id, i // 8 AS band, string_agg(v::VARCHAR, ',' ORDER BY i) AS key FROM sig GROUP BY ALL),
 cand AS MATERIALIZED (SELECT DISTINCT x.doc_id AS a, y.doc_id AS b FROM bands x JOIN bands y USING (band, key) WHERE x.doc_id < y.doc_id),
 sets AS MATERIALIZED (SELECT doc_id, size, {GRAMS_SQL} AS g FROM best WHERE doc_id IN (SELECT a FROM cand UNION SELECT b FROM cand)),
 pairs AS (SELECT a, b, x.size AS size_a, y.size AS size_b, len(list_intersect(x.g, y.g)) AS met, len(x.g) AS n_a, len(y.g) AS n_b FROM cand JOIN sets x ON x.doc_id = a JOIN sets y ON y.doc_id = b),
 links AS MATERIALIZED (SELECT *, met / (n_a + n_b - met) AS jaccard FROM pairs WHERE met / (n_a + n_b - met) >= 0.7),
 ranked AS (SELECT CASE WHEN size_a >= size_b THEN a ELSE b END AS better, CASE WHEN size_a >= size_b THEN b ELSE a END AS worse FROM links)"""


@query(f"WITH {signed_sql(NORMAL_SQL)} SELECT doc_id, string_agg(v::VARCHAR, ',' ORDER BY i) AS signature FROM sig GROUP BY doc_id")
def minhash_signature(spark, sf_dir):
    signed = minhash.signatures(normal_docs(spark, sf_dir))
    return signed.select(F.col("id").alias("doc_id"), F.array_join(F.transform("signature", lambda x: x.cast("string")), ",").alias("signature"))


@query(f"WITH {LINKS_SQL} SELECT a, b FROM cand")
def lsh_candidates(spark, sf_dir):
    return minhash.candidates(minhash.bands(minhash.signatures(minhash.prepared(table(spark, sf_dir, "documents"), "doc_id", "text"))))


@query(f"WITH {LINKS_SQL} SELECT a, b, round(jaccard, 9) AS jaccard FROM links")
def jaccard_pairs(spark, sf_dir):
    rows = minhash.prepared(table(spark, sf_dir, "documents"), "doc_id", "text")
    return minhash.similar_pairs(rows).withColumn("jaccard", F.round("jaccard", 9))


@query(f"WITH {LINKS_SQL} SELECT doc_id FROM best WHERE doc_id NOT IN (SELECT worse FROM ranked)")
def neardup_oneshot(spark, sf_dir):
    return minhash.deduplicate(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", "text", greedy=False).select("doc_id")


# The linked rows one after another, by rank, with the list of those that stay.
@query(f"""WITH RECURSIVE {LINKS_SQL}, node AS (SELECT worse AS id, size, list(better) AS betters, row_number() OVER (ORDER BY size DESC, worse) AS n FROM ranked JOIN best ON doc_id = worse GROUP BY worse, size),
 walk AS (SELECT 0::BIGINT AS n, []::BIGINT[] AS gone UNION ALL SELECT node.n, CASE WHEN len(list_filter(betters, lambda b: NOT list_contains(gone, b))) > 0 THEN list_append(gone, id) ELSE gone END FROM walk JOIN node ON node.n = walk.n + 1)
 SELECT doc_id FROM best WHERE doc_id NOT IN (SELECT unnest(gone) FROM (SELECT gone FROM walk ORDER BY n DESC LIMIT 1))""")
def neardup_greedy(spark, sf_dir):
    return minhash.deduplicate(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", "text").select("doc_id")


@query(f"WITH d AS (SELECT doc_id, unnest({GRAMS_SQL}) AS g FROM ({NORMAL_SQL})), b AS (SELECT DISTINCT unnest({GRAMS_SQL}) AS g FROM ({NORMAL_SQL.replace('doc_id,', '').replace('documents', 'benchmark')})) SELECT doc_id, count(*) AS n, count(b.g) AS n_shared FROM d LEFT JOIN b USING (g) GROUP BY doc_id")
def benchmark_overlap(spark, sf_dir):
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", F.explode(minhash.shingles(F.col("text"))).alias("g"))
    known = table(spark, sf_dir, "benchmark").select(F.explode(minhash.shingles(F.col("text"))).alias("g")).distinct().withColumn("known", F.lit(1))
    return docs.join(small(stored(known)), "g", "left").groupBy("doc_id").agg(F.count("*").alias("n"), F.count("known").alias("n_shared"))


def scored(spark, sf_dir) -> DataFrame:
    labels = table(spark, sf_dir, "labels").selectExpr("doc_id", f"{SCORE} AS quality_score").where("quality_score IS NOT NULL")
    return select.merge_scores(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), labels, "doc_id")


SCORED_SQL = f"WITH s AS (SELECT d.doc_id, text, lang, coalesce({SCORE.replace('doc_id', 'd.doc_id')}, 0.0) AS quality_score FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"


@query(f"{SCORED_SQL} SELECT doc_id, quality_score FROM s")
def score_merge(spark, sf_dir):
    return scored(spark, sf_dir).select("doc_id", "quality_score")


@query(f"{SCORED_SQL} SELECT doc_id, quality_score FROM s WHERE quality_score >= 60 ORDER BY quality_score DESC, doc_id LIMIT 200")
def score_filter_topk(spark, sf_dir):
    return select.top_k(scored(spark, sf_dir).where(S.passes_score(F.col("quality_score"), 60)), 200, "doc_id").select("doc_id", "quality_score")


@query(f"{SCORED_SQL} SELECT round(avg(quality_score), 6) AS mean, round(median(quality_score), 6) AS median, min(quality_score) AS min, max(quality_score) AS max FROM s WHERE quality_score > 0")
def score_stats(spark, sf_dir):
    stats = select.score_stats(scored(spark, sf_dir).where("quality_score > 0"), "quality_score")
    return stats.select(F.round("mean", 6).alias("mean"), F.round("median", 6).alias("median"), "min", "max")


@query(f"{SCORED_SQL} SELECT count(*) AS n_before, count(*) FILTER (quality_score >= 80) AS n_after, round(count(*) FILTER (quality_score >= 80) * 100.0 / count(*), 6) AS percent FROM s")
def retention(spark, sf_dir):
    rows = scored(spark, sf_dir)
    return select.retention(rows, rows.where(S.passes_score(F.col("quality_score")))).withColumn("percent", F.round("percent", 6))


WEIGHTS_SQL = "[" + ", ".join(map(str, S.CRITERION_WEIGHTS)) + "]::DOUBLE[]"


@query(f"SELECT doc_id, round(list_sum(list_transform(range(1, 26), lambda i: (doc_id * 31 + i * 17) % 11 * ({WEIGHTS_SQL})[i])), 6) AS weighted FROM documents")
def weighted_criteria(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", F.explode(F.sequence(F.lit(1), F.lit(25))).alias("criterion_id"))
    rows = rows.withColumn("score", ((F.col("doc_id") * 31 + F.col("criterion_id") * 17) % 11).cast("double"))
    return select.weighted_scores(rows, "doc_id").select("doc_id", F.round("weighted", 6).alias("weighted"))


REPORT = """CASE WHEN doc_id % 4 = 3 THEN 'no report' ELSE CASE WHEN doc_id % 4 = 1 THEN '```json' || chr(10) ELSE 'Result: ' END || '{"scores": [{"criterion_id": 1, "score": ' || CAST(doc_id % 10 AS STRING) || '}, {"criterion_id": 2, "score": 7}], "percentage": ' || CAST(doc_id % 101 AS STRING) || '}' || CASE WHEN doc_id % 4 = 1 THEN chr(10) || '```' ELSE '' END END"""


@query("SELECT doc_id, CASE WHEN doc_id % 4 = 3 THEN NULL ELSE CAST(doc_id % 101 AS DOUBLE) END AS percentage, CASE WHEN doc_id % 4 = 3 THEN NULL ELSE CAST(doc_id % 10 + 7 AS DOUBLE) END AS total FROM documents")
def score_json_parse(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", R.score_report(F.expr(REPORT)).alias("r"))
    return rows.select("doc_id", "r.percentage", F.aggregate("r.scores", F.lit(0.0), lambda t, s: t + s.score).alias("total"))


NUMBERS = "array_join(transform(sequence(0, 19), i -> CAST((doc_id + i) % 8 AS STRING)), ', ')"
JUDGED = f"""CASE doc_id % 4 WHEN 0 THEN '{{"scores": [' || {NUMBERS} || ']}}' WHEN 1 THEN 'ratings ' || {NUMBERS} || ' and 1, 2, 3, 4, 5' WHEN 2 THEN '{{"scores": [1, x]}} ' || {NUMBERS} ELSE '' END"""


@query("""WITH l AS (SELECT doc_id, list_transform(range(20), lambda i: (doc_id + i) % 8) AS n FROM documents),
 s AS (SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN list_transform(n, lambda v: least(5, v))
  WHEN doc_id % 4 = 1 AND len(list_filter(n, lambda v: v <= 5)) + 5 >= 20 THEN list_slice(list_concat(list_filter(n, lambda v: v <= 5), [1, 2, 3, 4, 5]), 1, 20) ELSE list_transform(n, lambda v: 0) END AS scores FROM l)
 SELECT doc_id, array_to_string(scores, ',') AS scores, CAST(list_sum(scores) AS DOUBLE) / 100 AS s_chk FROM s""")
def checklist_scores(spark, sf_dir):
    scores = table(spark, sf_dir, "documents").select("doc_id", R.checklist_scores(F.expr(JUDGED)).alias("scores"))
    return scores.select("doc_id", F.array_join(F.transform("scores", lambda x: x.cast("int").cast("string")), ",").alias("scores"), S.checklist_score(F.col("scores")).alias("s_chk"))


TASKS = "transform(sequence(0, CAST(p_partkey % 5 + 8 AS INT)), i -> p_name || ' ' || CAST(i AS STRING))"


@query("SELECT p_partkey * 10 + i AS task_id, p_name || ' ' || CAST(i AS VARCHAR) AS specific_task FROM part, range(10) t(i) WHERE p_partkey % 5 + 9 >= 10")
def task_expand(spark, sf_dir):
    subs = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("subcat_id"), F.expr(TASKS).alias("tasks"))
    return expand.expand_tasks(subs).select("task_id", "specific_task")


@query(f"SELECT p_partkey * 12 + v - 1 AS variant_id, v AS variant_type_id, ({expand.VARIANT_TYPES})[v] AS variant_type, p_partkey AS task_id FROM part, range(1, 13) t(v)")
def variant_expand(spark, sf_dir):
    return expand.expand_variants(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("task_id"))).select("variant_id", "variant_type_id", "variant_type", "task_id")


TEMPLATE = "'Build a {design_style} page about {web_category} in {color_scheme}; {unknown}; ' || CASE WHEN p_partkey % 2 = 0 THEN '{web_category} again' ELSE '{x}' END"


@query(f"SELECT p_partkey, replace(replace(replace({TEMPLATE}, '{{web_category}}', p_name), '{{color_scheme}}', ({expand.COLOURS})[p_partkey % 18 + 1]), '{{design_style}}', ({expand.STYLES})[p_partkey % 44 + 1]) AS prompt FROM part")
def template_fill(spark, sf_dir):
    rows = table(spark, sf_dir, "part").withColumn("template", F.expr(TEMPLATE))
    cyclic = lambda pool: F.element_at(F.array(*map(F.lit, pool)), (F.col("p_partkey") % len(pool) + 1).cast("int"))
    values = {"web_category": F.col("p_name"), "color_scheme": cyclic(expand.COLOURS), "design_style": cyclic(expand.STYLES)}
    return rows.select("p_partkey", T.fill_template(F.col("template"), T.template_variables(F.col("template")), values).alias("prompt"))


@query(f"SELECT p_partkey, array_to_string(v, ',') AS variables, len(v) >= 2 AND list_contains(v, 'web_category') AND length(t) >= 20 AS valid FROM (SELECT p_partkey, t, list_sort(list_distinct(regexp_extract_all(t, '\\{{([^}}]+)\\}}', 1))) AS v FROM (SELECT p_partkey, {TEMPLATE} AS t FROM part))")
def template_vars(spark, sf_dir):
    rows = table(spark, sf_dir, "part").withColumn("t", F.expr(TEMPLATE)).withColumn("v", T.template_variables(F.col("t")))
    return rows.select("p_partkey", F.array_join("v", ",").alias("variables"), T.template_is_valid(F.col("t"), F.col("v")).alias("valid"))


def nodes(spark, sf_dir) -> DataFrame:
    """World, regions, nations and customers as a tree."""
    region, nation, customer = (table(spark, sf_dir, n) for n in ("region", "nation", "customer"))
    root = region.agg(F.lit(0).cast("long").alias("node_id")).selectExpr("node_id", "CAST(NULL AS BIGINT) AS parent_id", "'ROOT' AS name", "0 AS depth", "false AS is_leaf")
    levels = [region.selectExpr("CAST(1 + r_regionkey AS BIGINT)", "CAST(0 AS BIGINT)", "r_name", "1", "false"), nation.selectExpr("CAST(100 + n_nationkey AS BIGINT)", "CAST(1 + n_regionkey AS BIGINT)", "n_name", "2", "false"), customer.selectExpr("1000 + c_custkey", "CAST(100 + c_nationkey AS BIGINT)", "c_name", "3", "false")]
    for level in levels:
        root = root.union(level)
    return root


NODES_SQL = """WITH RECURSIVE nodes AS (SELECT 0::BIGINT AS node_id, NULL::BIGINT AS parent_id, 'ROOT' AS name, 0 AS depth UNION ALL SELECT 1 + r_regionkey, 0, r_name, 1 FROM region
 UNION ALL SELECT 100 + n_nationkey, 1 + n_regionkey, n_name, 2 FROM nation UNION ALL SELECT 1000 + c_custkey, 100 + c_nationkey, c_name, 3 FROM customer)"""


@query(f"{NODES_SQL}, walk AS (SELECT node_id, '' AS path FROM nodes WHERE parent_id IS NULL UNION ALL SELECT n.node_id, CASE WHEN path = '' THEN name ELSE path || ' > ' || name END FROM walk JOIN nodes n ON n.parent_id = walk.node_id) SELECT node_id, path FROM walk WHERE node_id NOT IN (SELECT parent_id FROM nodes WHERE parent_id IS NOT NULL)")
def tree_leaf_paths(spark, sf_dir):
    return expand.leaf_paths(nodes(spark, sf_dir)).select("node_id", F.array_join("path", " > ").alias("path"))


@query(f"{NODES_SQL}, c AS (SELECT n.node_id, n.depth, count(k.node_id) AS k FROM nodes n LEFT JOIN nodes k ON k.parent_id = n.node_id GROUP BY ALL) SELECT count(*) AS total_nodes, count(*) FILTER (k = 0) AS leaf_count, CAST(max(depth) AS BIGINT) AS max_depth, round(avg(k), 3) AS avg_branching_factor FROM c")
def tree_stats(spark, sf_dir):
    return expand.tree_stats(nodes(spark, sf_dir))


@query(f"{NODES_SQL} SELECT CAST(depth AS BIGINT) AS depth, count(*) AS n FROM nodes GROUP BY depth")
def tree_depth_counts(spark, sf_dir):
    return expand.depth_counts(nodes(spark, sf_dir))


def drawn_sql(*parts: str) -> str:
    return f"('0x' || substr(md5(concat_ws('|', {', '.join(parts)})), 1, 8))::BIGINT"


POOLS_SQL = ", ".join(f"({pool})[{drawn_sql(chr(39) + '42 ' + name + chr(39), 'node_id', 'k')} % {len(pool)} + 1] AS {name}" for name, pool in expand.POOLS.items())
LEAF_TEMPLATE = "'Build a {design_style} page about {web_category} in {color_scheme} of ' || p_type || '; {unknown}; ' || CASE WHEN p_partkey % 2 = 0 THEN '{web_category} again' ELSE '{features}' END"


@query(f"""{NODES_SQL}, walk AS (SELECT node_id, '' AS path FROM nodes WHERE parent_id IS NULL UNION ALL SELECT n.node_id, CASE WHEN path = '' THEN name ELSE path || ' > ' || name END FROM walk JOIN nodes n ON n.parent_id = walk.node_id),
 leaf AS (SELECT node_id, path FROM walk WHERE node_id NOT IN (SELECT parent_id FROM nodes WHERE parent_id IS NOT NULL)),
 templates AS (SELECT t, row_number() OVER (ORDER BY t) - 1 AS choice, count(*) OVER () AS n FROM (SELECT DISTINCT {LEAF_TEMPLATE} AS t FROM part)),
 draw AS (SELECT node_id, path, k, {drawn_sql("'42'", 'node_id', 'k')} % (SELECT max(n) FROM templates) AS choice, {POOLS_SQL} FROM leaf, range(100) r(k))
 SELECT node_id, CAST(k AS INTEGER) AS k, md5(replace(replace(replace(replace(t, '{{web_category}}', path), '{{color_scheme}}', color_scheme), '{{design_style}}', design_style), '{{features}}', features)) AS prompt, path AS web_category FROM draw JOIN templates USING (choice)""")
def leaf_prompts(spark, sf_dir):
    templates = table(spark, sf_dir, "part").select(F.expr(LEAF_TEMPLATE).alias("prompt_template")).withColumn("variables", T.template_variables(F.col("prompt_template")))
    filled = expand.fill_prompts(expand.leaf_paths(nodes(spark, sf_dir)), templates)
    return filled.select("node_id", "k", F.md5("prompt").alias("prompt"), "web_category")


@query("SELECT CASE WHEN p_type IS NULL THEN 0 ELSE row_number() OVER (ORDER BY p_type) END AS node_id, 0 AS parent_id, p_type AS name, 1 AS depth, false AS is_leaf FROM (SELECT DISTINCT p_type FROM part) UNION ALL SELECT 0, NULL, 'ROOT', 0, false")
def tree_scaffold(spark, sf_dir):
    return expand.make_nodes(table(spark, sf_dir, "part").select(F.col("p_type").alias("name")))


@query("SELECT r_name AS root, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY r_name UNION ALL SELECT 'all', count(*) FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey")
def root_counts(spark, sf_dir):
    joined = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return joined.rollup("r_name").agg(F.when(F.grouping("r_name") == 1, "all").otherwise(F.col("r_name")).alias("root"), F.count("*").alias("n")).select("root", "n")


QUOTA_SQL = "WITH w AS (SELECT unnest([{}]::DOUBLE[]) AS w, unnest(range(16)) AS position), t AS (SELECT count(*) AS target FROM part), q AS (SELECT position, CAST(floor(target * w) AS BIGINT) AS n, target FROM w, t), f AS (SELECT position, n + CASE WHEN position < target - sum(n) OVER () THEN 1 ELSE 0 END AS n FROM q)".format(", ".join(str(w) for _, w in expand.CATEGORY_WEIGHTS))


@query(f"{QUOTA_SQL}, k AS (SELECT p_partkey % 16 AS position, list(p_name ORDER BY p_partkey) AS tasks FROM part GROUP BY 1) SELECT f.position, i, tasks[i % len(tasks) + 1] AS base_task, ({expand.TECHNOLOGIES})[i % 6 + 1] AS tech_stack FROM f JOIN k USING (position), range(f.n) r(i)")
def quota_synthesis(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    names = spark.createDataFrame([(i, n) for i, (n, _) in enumerate(expand.CATEGORY_WEIGHTS)], "position int, category_name string")
    rows = part.select((F.col("p_partkey") % 16).cast("int").alias("position"), "p_partkey", F.col("p_name").alias("base_task")).join(F.broadcast(names), "position").drop("position")
    made = expand.synthesise(expand.quotas(spark, part.count()), expand.number_tasks(rows, "category_name", "p_partkey"))
    return made.select(F.col("position").cast("long").alias("position"), "i", "base_task", "tech_stack")


@query(f"{QUOTA_SQL} SELECT position, n FROM f ORDER BY n DESC")
def quota_counts(spark, sf_dir):
    made = quota_synthesis(spark, sf_dir)
    return made.groupBy("position").agg(F.count("*").alias("n")).orderBy(F.desc("n"))


@query("SELECT u.conv_id, u.turn, u.text AS prompt, 'web' AS data_source, a.text AS reference FROM conversations u LEFT JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 WHERE u.role = 'user'")
def grpo_convert(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations")
    answers = turns.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("reference"))
    asked = turns.where("role = 'user'").withColumnRenamed("text", "question").join(answers, ["conv_id", "turn"], "left")
    made = convert.to_grpo(asked, "web", R.CHECKLIST, keep=["conv_id", "turn"])
    return made.select("conv_id", "turn", "prompt", "data_source", "extra_info.reference")


@query("SELECT doc_id, row_number() OVER (ORDER BY ('0x' || substr(md5('42|' || CAST(doc_id AS VARCHAR)), 1, 8))::BIGINT, doc_id) <= CAST(floor(count(*) OVER () * 0.9) AS BIGINT) AS is_train FROM documents")
def train_val_split(spark, sf_dir):
    return convert.train_val_split(table(spark, sf_dir, "documents").select("doc_id"), "doc_id")


LONG_PAGE = "'```html' || chr(10) || repeat(html, CAST(1 + page_id % 12 AS INT)) || chr(10) || '```'"


@query(f"SELECT page_id, round(CASE WHEN t <= 12000 THEN 1.0 WHEN t >= 16000 THEN 0.0 ELSE (16000 - t) / 4000 END, 9) AS s_len FROM (SELECT page_id, 0.75::DOUBLE * length({STRIP_SQL.format('repeat(html, CAST(1 + page_id % 12 AS INT))')}) AS t FROM pages)")
def length_score(spark, sf_dir):
    pages = spread(table(spark, sf_dir, "pages").selectExpr("page_id", f"{LONG_PAGE} AS reply"))
    return pages.select("page_id", F.round(H.length_score(H.page(F.col("reply"))), 9).alias("s_len"))


@query(f"""{REPLIES}, p AS (SELECT page_id, page, 0.75::DOUBLE * length(page) AS t FROM (SELECT page_id, {PAGE_SQL} AS page FROM r))
 SELECT page_id, round(CASE WHEN page_id % 5 = 0 THEN 0 ELSE 0.6::DOUBLE * (page_id % 101) / 100 + CASE WHEN page_id % 3 > 0 AND page <> '' THEN 0.3::DOUBLE * (page_id % 7) / 6 ELSE 0 END
 + 0.1::DOUBLE * CASE WHEN t <= 12000 THEN 1 WHEN t >= 16000 THEN 0 ELSE (16000 - t) / 4000 END END, 9) AS reward FROM p""")
def composite_reward(spark, sf_dir):
    rows = replies(spark, sf_dir).select("page_id", H.page(F.col("response")).alias("page"))
    key = F.col("page_id")
    reward = S.composite_reward(key % 5 > 0, F.col("page") != "", key % 3 > 0, (key % 101) / 100, (key % 7) / 6, H.length_score(F.col("page")))
    return rows.select("page_id", F.round(reward, 9).alias("reward"))


REPEATED = "CASE WHEN page_id % 4 = 0 THEN '<html>' || repeat(substr(html, 1, 90), 200) || '</html>' ELSE html END"


@query(f"""WITH r AS (SELECT page_id, {REPEATED} AS response FROM pages), p AS (SELECT page_id, {PAGE_SQL} AS page FROM r),
 w AS (SELECT page_id, w AS nth, substr(page, 1 + w * 4000, 8000) AS part FROM p, range(1000) t(w) WHERE length(page) >= 100 AND w * 4000 < length(page)),
 g AS (SELECT page_id, nth, list_distinct(list_transform(range(1, length(part) - 6), lambda i: substr(part, i, 8))) AS grams, length(part) - 7 AS total, row_number() OVER (PARTITION BY page_id ORDER BY nth) AS i FROM w WHERE length(part) >= 100),
 bad AS (SELECT page_id FROM g WHERE 1 - len(grams) / total >= 0.65 UNION SELECT x.page_id FROM g x JOIN g y ON x.page_id = y.page_id AND y.i IN (x.i + 1, x.i + 2)
  WHERE len(list_intersect(x.grams, y.grams)) / (len(x.grams) + len(y.grams) - len(list_intersect(x.grams, y.grams))) >= 0.85)
 SELECT page_id, CASE WHEN page_id IN (SELECT page_id FROM bad) THEN 0 ELSE 1 END AS clean FROM p""")
def repetition_flag(spark, sf_dir):
    pages = spread(table(spark, sf_dir, "pages").selectExpr("page_id", f"{REPEATED} AS reply"))
    return pages.select("page_id", similarity.repetition_flag(H.page(F.col("reply"))).alias("clean"))


@query()
def html_similarity(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", H.page(F.col("html")).alias("page"))
    nexts = pages.select((F.col("page_id") - 1).alias("page_id"), F.col("page").alias("reference"))
    return spread(pages.join(nexts, "page_id")).select("page_id", F.round(similarity.page_similarity(F.col("page"), F.col("reference")), 9).alias("s_sim"))


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def resume_antijoin(spark, sf_dir):
    return select.not_done(table(spark, sf_dir, "documents").select("doc_id"), table(spark, sf_dir, "labels"), "doc_id")


@query("SELECT DISTINCT user_id, event_type FROM events")
def stream_exact_dedup(spark, sf_dir):
    schema = table(spark, sf_dir, "events").schema
    path = f"{shared_folder(spark)}/quern-stream-{uuid.uuid4().hex}"
    # A pattern, as the table may be one file: a plain path would have to be a folder.
    stream = spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parque[t]")
    seen = stream_dedup(stream.select("user_id", "event_type"), ["user_id", "event_type"])
    seen.writeStream.format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{path}/out")


@query("SELECT event_type, count(*) AS n FROM events GROUP BY event_type ORDER BY n DESC, event_type")
def category_breakdown(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy("event_type").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "event_type")


@query(f"{REPLIES} SELECT count(*) FILTER (ok) AS n_ok, count(*) FILTER (NOT ok) AS n_failed, CAST(sum(length(response)) FILTER (ok) AS BIGINT) AS chars, round(avg(length(response)) FILTER (ok), 6) AS mean_chars FROM (SELECT *, {RULES_SQL} = 'pass' AS ok FROM r)")
def success_counts(spark, sf_dir):
    rows = replies(spark, sf_dir).select(F.length("response").alias("n"), H.passes_rules(F.col("response")).alias("ok"))
    good = F.when(F.col("ok"), F.col("n"))
    return rows.agg(F.count_if("ok").alias("n_ok"), F.count_if(~F.col("ok")).alias("n_failed"), F.sum(good).alias("chars"), F.round(F.avg(good), 6).alias("mean_chars"))


@query("SELECT p_partkey, replace(replace(replace(p_type || ' & /' || p_brand, '/', '_'), ' ', '_'), '&', 'and') AS safe, replace(p_name, '/', '-') || '/' || replace('a/' || p_brand, '/', '-') AS path FROM part")
def safe_names(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    return part.select("p_partkey", T.safe_name(F.expr("p_type || ' & /' || p_brand")).alias("safe"), T.path_key(F.array(F.col("p_name"), F.expr("'a/' || p_brand"))).alias("path"))


@query("SELECT c_custkey, c_name AS name FROM customer")
def root_labels(spark, sf_dir):
    line = "CASE c_custkey % 3 WHEN 0 THEN 'L' || CAST(c_custkey AS STRING) || ': ' || c_name WHEN 1 THEN CAST(c_custkey AS STRING) || ':' || c_name ELSE '  ' || c_name || ' ' END"
    return table(spark, sf_dir, "customer").select("c_custkey", T.without_line_label(F.expr(line)).alias("name"))


@query(f"SELECT conv_id, turn, md5({STRIP_SQL.format('text')}) AS one, md5({STRIP_SQL.format('text')}) AS two FROM conversations")
def fence_strip(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations")
    fenced = F.concat(F.lit("```text\n"), T.strip(F.col("text")), F.lit("\n```"))
    return turns.select("conv_id", "turn", F.md5(T.without_fence_lines(fenced)).alias("one"), F.md5(T.without_whole_fence(fenced)).alias("two"))


@query("SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN p_brand || '|' || p_type WHEN 1 THEN p_type WHEN 2 THEN p_brand || '|' || p_name ELSE '' END AS names FROM part")
def subcategory_parse(spark, sf_dir):
    reply = """CASE p_partkey % 4 WHEN 0 THEN '```json' || chr(10) || '{"subcategories": ["' || p_brand || '", " ' || p_type || '", "third"]}' || chr(10) || '```' WHEN 1 THEN '["' || p_type || '"]' WHEN 2 THEN '- ' || p_brand || chr(10) || chr(10) || '10. ' || p_name || chr(10) || '* third' ELSE '' END"""
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(R.subcategories(F.expr(reply), 2), "|").alias("names"))


@query("SELECT p_partkey, CASE WHEN p_partkey % 4 = 3 THEN NULL ELSE p_name || '|' || p_brand END AS tasks FROM part")
def task_parse(spark, sf_dir):
    body = """'{"tasks": ["' || p_name || '", "' || p_brand || '"]}'"""
    reply = f"CASE p_partkey % 4 WHEN 0 THEN {body} WHEN 1 THEN 'Here:' || chr(10) || '```json' || chr(10) || {body} || chr(10) || '```' WHEN 2 THEN 'I think ' || {body} || ' is it' ELSE 'none' END"
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(R.task_list(F.expr(reply)), "|").alias("tasks"))


@query("SELECT p_partkey, '1. ' || p_name || ' (max ' || CAST(p_size AS VARCHAR) || ')' || chr(10) || '   ' || p_type || chr(10) || chr(10) || '2. Item 2 (max 5)' || chr(10) || '   ' || chr(10) || chr(10) AS text FROM part")
def checklist_texts(spark, sf_dir):
    items = """'[{"id": 0, "title": "' || p_name || '", "maxScore": ' || CAST(p_size AS STRING) || ', "description": "' || p_type || '"}, {"id": 1}]'"""
    return table(spark, sf_dir, "part").select("p_partkey", R.checklist_text(R.checklist(F.expr(items))).alias("text"))


GENERATED = "CASE WHEN page_id % 7 = 0 THEN NULL ELSE page_id % 7 <> 1 END"
JUDGED_SQL = f"""WITH r AS (SELECT page_id, {REPLY} AS response FROM pages), b AS (SELECT page_id, response, {', '.join(f'{longest_sql(p)} AS {n}' for n, p in FENCES.items())} FROM r),
 x AS (SELECT page_id, {GENERATED} AS ok, CASE WHEN response = '' THEN 'empty_response' WHEN one <> '' THEN 'html_block' WHEN three <> '' THEN 'doctype_block' WHEN four <> '' THEN 'html_tag_block' ELSE 'no_html_block' END AS extracted,
  CASE WHEN one <> '' THEN one WHEN three <> '' THEN three WHEN four <> '' THEN four END AS response FROM b),
 v AS (SELECT *, CASE WHEN response IS NOT NULL THEN {STATUS_SQL} END AS status FROM (SELECT *, lower(response) AS low FROM x))"""


def generated(spark, sf_dir) -> DataFrame:
    return replies(spark, sf_dir).selectExpr("page_id AS index", "page_id", "response", f"{GENERATED} AS generation_success", "'task ' || CAST(page_id AS STRING) AS base_task_title")


@query(f"{JUDGED_SQL} SELECT page_id AS index, CAST(NULL AS VARCHAR) AS question, CAST(NULL AS VARCHAR) AS checklist, CAST(NULL AS VARCHAR) AS source, CAST(NULL AS VARCHAR) AS base_task_id, 'task ' || CAST(page_id AS VARCHAR) AS base_task_title, CAST(NULL AS VARCHAR) AS tech_stack, CAST(NULL AS VARCHAR) AS design_style, CAST(NULL AS VARCHAR) AS feature_modifier, md5(response) AS response, extracted AS extraction_method, CAST(length(response) AS BIGINT) AS html_length FROM v WHERE coalesce(ok, false) AND status = 'valid'")
def valid_records(spark, sf_dir):
    return select.valid_records(generated(spark, sf_dir)).withColumn("response", F.md5("response"))


@query(f"{JUDGED_SQL}, c AS (SELECT 'total' AS counter FROM v UNION ALL SELECT 'generation_failed' FROM v WHERE NOT coalesce(ok, false) UNION ALL SELECT 'extract_' || extracted FROM v WHERE coalesce(ok, false) UNION ALL SELECT 'valid_' || status FROM v WHERE coalesce(ok, false) AND status IS NOT NULL UNION ALL SELECT 'valid_total' FROM v WHERE coalesce(ok, false) AND status = 'valid') SELECT counter, count(*) AS n FROM c GROUP BY counter ORDER BY counter")
def record_counters(spark, sf_dir):
    return select.record_counters(generated(spark, sf_dir)).orderBy("counter")


@query("SELECT doc_id, md5(substr(text, 1, 8000)) AS digest FROM documents")
def truncated_texts(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(select.truncated("text")).alias("digest"))


@query("SELECT conv_id, turn, text AS question FROM conversations")
def question_texts(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations")
    # Every third question is a chat, every third the text in a list.
    asked = F.when(F.col("turn") % 3 == 0, F.to_json(F.array(F.struct(F.lit("user").alias("role"), F.col("text").alias("content"))))).when(F.col("turn") % 3 == 1, F.to_json(F.array("text"))).otherwise(F.col("text"))
    return turns.select("conv_id", "turn", R.question_text(asked).alias("question"))


@query("SELECT p_partkey, CAST(p_size + 5 AS BIGINT) AS most FROM part")
def checklist_top_scores(spark, sf_dir):
    items = """'[{"id": 0, "title": "a", "maxScore": ' || CAST(p_size AS STRING) || '}, {"id": 1}]'"""
    return table(spark, sf_dir, "part").select("p_partkey", select.top_score(R.checklist(F.expr(items))).alias("most"))


@query(f"WITH r AS ({SQL['composite_reward']}) SELECT round(avg(reward), 6) AS mean, min(reward) AS min, max(reward) AS max FROM r")
def reward_summary(spark, sf_dir):
    return select.batch_summary(composite_reward(spark, sf_dir), "reward").withColumn("mean", F.round("mean", 6))


@query("SELECT page_id, 'data:image/png;base64,' || to_base64(encode(html)) AS image FROM pages")
def image_urls(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", T.data_url(F.col("html").cast("binary")).alias("image"))


@query("SELECT event_id, strftime(make_timestamp(CAST(floor(epoch(ts)) AS BIGINT) * 1000000), '%Y-%m-%dT%H:%M:%SZ') AS at FROM events")
def event_times(spark, sf_dir):
    seconds = F.floor(F.col("ts").cast("timestamp").cast("double")).cast("long")
    return table(spark, sf_dir, "events").select("event_id", T.stamped(seconds).alias("at"))


@query("""SELECT e.event_id, arg_max(p.event_id, (p.ts, p.event_id)) AS prev_event_id, arg_max(p.event_type, (p.ts, p.event_id)) AS prev_type,
 CAST(date_diff('microsecond', max(p.ts), any_value(e.ts)) AS BIGINT) AS gap_us FROM events e LEFT JOIN events p ON e.user_id = p.user_id AND p.ts < e.ts AND p.event_type <> e.event_type GROUP BY e.event_id""")
def asof_other_kind(spark, sf_dir):
    """Each event with its user's last earlier event of another kind."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    found = asof_join(events, events, ["user_id"], "ts", "ts", exact=False, differs="event_type", tie="event_id")
    gap = F.unix_micros("ts") - F.unix_micros("match.ts")
    return found.select("event_id", F.col("match.event_id").alias("prev_event_id"), F.col("match.event_type").alias("prev_type"), gap.alias("gap_us"))


@query("""SELECT p.event_id, CASE WHEN p.ts - c.ts <= INTERVAL 2 DAY THEN c.event_id END AS click_id, CASE WHEN p.ts - c.ts <= INTERVAL 2 DAY THEN c.value END AS click_value
 FROM (FROM events WHERE event_type = 'purchase') p ASOF LEFT JOIN (FROM events WHERE event_type = 'click') c ON p.user_id = c.user_id AND p.ts >= c.ts""")
def asof_purchase_click(spark, sf_dir):
    """Each purchase with the same user's last click, two days before it at most."""
    events = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    buys, clicks = events.where("event_type = 'purchase'"), events.where("event_type = 'click'").select("event_id", "user_id", "ts", "value")
    found = asof_join(buys, clicks, ["user_id"], "ts", "ts", tie="event_id", within=2 * 86_400)
    return found.select("event_id", F.col("match.event_id").alias("click_id"), F.col("match.value").alias("click_value"))


@query("""SELECT o.o_orderkey, arg_max(p.o_orderkey, (p.o_orderdate, p.o_orderkey)) AS prev_orderkey, arg_max(p.o_totalprice, (p.o_orderdate, p.o_orderkey)) AS prev_price
 FROM orders o LEFT JOIN orders p ON o.o_custkey = p.o_custkey AND p.o_orderdate < o.o_orderdate GROUP BY o.o_orderkey""")
def asof_previous_order(spark, sf_dir):
    """Each order with its customer's order of an earlier date, the last one by date and key."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    found = asof_join(orders, orders, ["o_custkey"], "o_orderdate", "o_orderdate", exact=False, tie="o_orderkey")
    return found.select("o_orderkey", F.col("match.o_orderkey").alias("prev_orderkey"), F.col("match.o_totalprice").alias("prev_price"))


OPEN_SQL = "SELECT o_orderkey, any_value(o_custkey) AS o_custkey, any_value(o_orderdate) AS opened, max(l_shipdate) AS closed FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey"


@query(f"WITH o AS ({OPEN_SQL}) SELECT a.o_orderkey, b.o_orderkey AS other_orderkey FROM o a JOIN o b ON a.o_custkey = b.o_custkey AND a.o_orderkey < b.o_orderkey AND a.opened < b.closed AND b.opened < a.closed AND a.opened < a.closed AND b.opened < b.closed")
def interval_open_orders(spark, sf_dir):
    """Pairs of a customer's orders that are open (ordered, not wholly shipped) at the same time."""
    shipped = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.max("l_shipdate").alias("closed"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.col("o_orderdate").alias("opened")).join(shipped, "o_orderkey")
    pairs = interval_join(orders, orders, ("opened", "closed"), ("opened", "closed"), ["o_custkey"])
    return pairs.where("left.o_orderkey < right.o_orderkey").select(F.col("left.o_orderkey").alias("o_orderkey"), F.col("right.o_orderkey").alias("other_orderkey"))


PROMO_SQL = """SELECT p_partkey, 0 AS long, TIMESTAMP '1992-01-02' + to_days(CAST(p_partkey * 37 % 2400 AS INT)) AS a, 1 + p_size * 3 AS days FROM part
 UNION ALL SELECT p_partkey, 1, TIMESTAMP '1993-01-01', 1500 FROM part WHERE p_partkey % 10 = 0"""


@query(f"""WITH p AS ({PROMO_SQL}), l AS (SELECT l_partkey, l_quantity, l_shipdate AS a, l_shipdate + to_days(CAST(l_quantity AS INT)) AS b FROM lineitem)
 SELECT p_partkey, long, count(*) AS n, sum(l_quantity) AS quantity FROM p JOIN l ON l_partkey = p_partkey AND l.a < p.a + to_days(CAST(days AS INT)) AND p.a < l.b AND l.a < l.b GROUP BY p_partkey, long""")
def interval_promoted_lines(spark, sf_dir):
    """Lines in store (a day for each unit from their shipping on) during their part's promotions, days or years long."""
    days = lambda start, n: F.expr(f"{start} + make_dt_interval(CAST({n} AS INT))")
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("p_partkey"), "l_quantity", F.col("l_shipdate").alias("a"), days("l_shipdate", "l_quantity").alias("b"))
    parts = table(spark, sf_dir, "part")
    promos = parts.select("p_partkey", F.lit(0).alias("long"), days("TIMESTAMP_NTZ '1992-01-02'", "p_partkey * 37 % 2400").alias("a"), (1 + F.col("p_size") * 3).alias("days"))
    promos = promos.unionByName(parts.where("p_partkey % 10 = 0").select("p_partkey", F.lit(1).alias("long"), F.expr("TIMESTAMP_NTZ '1993-01-01'").alias("a"), F.lit(1500).alias("days")))
    pairs = interval_join(promos.withColumn("b", days("a", "days")), lines, ("a", "b"), ("a", "b"), ["p_partkey"])
    return pairs.groupBy(F.col("left.p_partkey").alias("p_partkey"), F.col("left.long").alias("long")).agg(F.count("*").alias("n"), F.sum("right.l_quantity").alias("quantity"))


@query("SELECT conv_id, turn, (SELECT max(p.turn) FROM conversations p WHERE p.conv_id = c.conv_id AND p.turn < c.turn AND p.role <> c.role) AS prev_turn FROM conversations c")
def asof_other_role(spark, sf_dir):
    """Each turn with the last earlier turn of another role in its conversation."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role")
    return asof_join(turns, turns, ["conv_id"], "turn", "turn", exact=False, differs="role").select("conv_id", "turn", F.col("match.turn").alias("prev_turn"))


# Events arrive in four portions by id, some of them one or two portions after their time; the watermark is two days back.
PORTION = "least(3, event_id * 4 {div} n + CASE WHEN event_id % 17 = 3 THEN 1 WHEN event_id % 53 = 7 THEN 2 ELSE 0 END)"
PORTIONS_SQL = f"n AS (SELECT max(event_id) + 1 AS n FROM events), a AS (SELECT events.*, epoch_us(ts) AS us, {PORTION.format(div='//')} AS portion FROM events, n)"
HOUR, DELAY = 3_600_000_000, "2 days"


def marks_sql(time: str, rows: str = "a", name: str = "marks") -> str:
    """The watermark before each portion, and after the last one as that of portion 4; in microseconds."""
    top = f"SELECT max({time}) // 1000 - 48 * 3600000 FROM {rows} b WHERE b.portion < t.p"
    return f"{name} AS (SELECT p AS portion, coalesce(greatest(0, ({top}) * 1000), 0) AS mark FROM range(5) AS t(p))"


def portions(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    events = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    n = (events.agg(F.max("event_id")).first()[0] or 0) + 1
    placed = events.withColumn("portion", F.expr(PORTION.replace("n +", f"{n}L +").format(div="div")))
    return [placed.where(F.col("portion") == i).drop("portion") for i in range(4)]


def streamed(spark: SparkSession, sf_dir: str, build: Callable[[DataFrame], DataFrame]) -> DataFrame:
    return feed(portions(spark, sf_dir), build, f"{shared_folder(spark)}/quern-stream-{uuid.uuid4().hex}")


def windows_sql(size: int, slide: int) -> str:
    """Windows of `size` hours, one every `slide` hours, over the rows that weren't late."""
    start = f"(us // ({slide} * {HOUR}) - k) * {slide} * {HOUR}"
    kept = f"SELECT {start} AS window_start, event_type, value FROM a, range({size // slide}) AS t(k), marks WHERE marks.portion = a.portion AND {start} + {size} * {HOUR} > mark"
    closed = f"window_start + {size} * {HOUR} <= (SELECT mark FROM marks WHERE portion = 4)"
    return f"WITH {PORTIONS_SQL}, {marks_sql('us')} SELECT window_start, event_type, count(*) AS n, round(sum(value), 2) AS total FROM ({kept}) WHERE {closed} GROUP BY window_start, event_type"


def event_windows(spark: SparkSession, sf_dir: str, size: int, slide: int) -> DataFrame:
    sums = [F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total")]
    found = streamed(spark, sf_dir, lambda s: windowed(s, "ts", f"{size} hours", ["event_type"], sums, DELAY, f"{slide} hours"))
    return found.select(F.unix_micros("window_start").alias("window_start"), "event_type", "n", "total")


@query(windows_sql(6, 6))
def stream_tumbling_windows(spark, sf_dir):
    """Events and values by kind and six hours, with late rows."""
    return event_windows(spark, sf_dir, 6, 6)


@query(windows_sql(24, 6))
def stream_sliding_windows(spark, sf_dir):
    """Events and values by kind and day, one every six hours, with late rows."""
    return event_windows(spark, sf_dir, 24, 6)


PANE_SQL = f"(us // (6 * {HOUR}) + 1) * 6 * {HOUR}"


@query(f"""WITH {PORTIONS_SQL}, p AS (SELECT *, {PANE_SQL} AS pane_end FROM a), {marks_sql('pane_end', 'p')},
 k AS (SELECT user_id, us, value, CASE WHEN us - lag(us) OVER u < 6 * {HOUR} THEN 0 ELSE 1 END AS opens FROM p JOIN marks USING (portion) WHERE pane_end > mark WINDOW u AS (PARTITION BY user_id ORDER BY us)),
 s AS (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY us) AS nth FROM k)
 SELECT user_id, min(us) AS first_us, max(us) AS last_us, count(*) AS n, round(sum(value), 2) AS total FROM s GROUP BY user_id, nth HAVING (max(us) // (6 * {HOUR}) + 2) * 6 * {HOUR} <= (SELECT mark FROM marks WHERE portion = 4)""")
def stream_sessions(spark, sf_dir):
    """Users' sessions of events less than six hours apart, with late rows."""
    found = streamed(spark, sf_dir, lambda s: sessions(s, "ts", "user_id", "value", 6 * 3_600_000, DELAY))
    return found.select("user_id", F.unix_micros("first").alias("first_us"), F.unix_micros("last").alias("last_us"), "n", F.round("total", 2).alias("total"))


@query(f"""WITH {PORTIONS_SQL}, v AS (FROM a WHERE event_type = 'view'), b AS (FROM a WHERE event_type = 'purchase'), {marks_sql('us', 'v', 'vm')}, {marks_sql('us', 'b', 'bm')},
 marks AS (SELECT portion, least(vm.mark, bm.mark) AS mark FROM vm JOIN bm USING (portion)), x AS (FROM v JOIN marks USING (portion) WHERE us > mark), y AS (FROM b JOIN marks USING (portion) WHERE us > mark)
 SELECT x.event_id AS view_id, y.event_id AS purchase_id, y.us - x.us AS gap_us FROM x JOIN y ON x.user_id = y.user_id AND y.us BETWEEN x.us AND x.us + 12 * {HOUR}""")
def stream_range_join(spark, sf_dir):
    """Views and the same user's purchases in the twelve hours after, two streams with late rows."""
    of = lambda s, kind: s.where(F.col("event_type") == kind).select("event_id", "user_id", "ts")
    found = streamed(spark, sf_dir, lambda s: range_join(of(s, "view"), of(s, "purchase"), ["user_id"], "ts", "ts", 12 * 3600, DELAY))
    return found.select(F.col("left.event_id").alias("view_id"), F.col("right.event_id").alias("purchase_id"), (F.unix_micros("right.ts") - F.unix_micros("left.ts")).alias("gap_us"))


@query("""SELECT CAST(grouping(event_type, CAST(ts AS DATE)) AS BIGINT) AS set_id, event_type, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, count(DISTINCT user_id) AS n, true AS within
 FROM events GROUP BY GROUPING SETS ((event_type, CAST(ts AS DATE)), (event_type), (CAST(ts AS DATE)), ())""")
def distinct_grouping_sets(spark, sf_dir):
    """Distinct users by kind and day, exactly, and whether merged sketches of the finest groups estimate them within their bound."""
    events = table(spark, sf_dir, "events").select("user_id", "event_type", F.col("ts").cast("date").alias("day"))
    by, sets = ["event_type", "day"], [["event_type", "day"], ["event_type"], ["day"], []]
    exact = sketches.distinct_counts(events, by, "user_id", sets)
    guess = sketches.distinct_estimates(sketches.distinct_sketches(events, by, "user_id"), by, sets)
    same = [exact[c].eqNullSafe(guess[c]) for c in ("set_id", *by)]
    within = F.abs(F.col("estimate") - F.col("n")) <= F.col("n") * sketches.distinct_bound(12)
    return exact.join(guess, same, "left").select(exact.set_id, exact.event_type, exact.day.cast("string").alias("day"), "n", F.coalesce(within, F.lit(False)).alias("within"))


RANKS = {"p10": "(n + 9) {div} 10", "median": "(n + 1) {div} 2", "p99": "(n * 99 + 99) {div} 100"}


@query(f"""WITH r AS (SELECT l_returnflag, l_linestatus, l_extendedprice, row_number() OVER (PARTITION BY l_returnflag, l_linestatus ORDER BY l_extendedprice) AS nth, count(*) OVER (PARTITION BY l_returnflag, l_linestatus) AS n FROM lineitem),
 k AS ({" UNION ALL ".join(f"SELECT '{name}' AS name, l_returnflag, l_linestatus, n, l_extendedprice FROM r WHERE nth = {rank.format(div='//')}" for name, rank in RANKS.items())})
 SELECT l_returnflag, l_linestatus, name, n, l_extendedprice AS value, true AS within FROM k""")
def price_quantiles(spark, sf_dir):
    """Exact price quantiles by flag and status, and whether merged sketches, made by supplier, name ranks within their bound."""
    lines, by = table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus"]
    exact = stored(sketches.order_statistics(lines, "l_extendedprice", {k: r.format(div="div") for k, r in RANKS.items()}, by, most=1000))
    fine = sketches.quantile_sketches(lines, "l_extendedprice", [*by, "l_suppkey"])
    share, shares = F.col("share"), {"p10": 0.1, "median": 0.5, "p99": 0.99}
    guess = sketches.quantile_estimates(sketches.merged_quantile_sketches(fine, by), by, list(shares.values()))
    guess = stored(guess.withColumn("name", F.element_at(F.create_map(*[F.lit(x) for k, v in shares.items() for x in (v, k)]), share)))
    # Ranks of the estimates: one estimate a group and name, groups being few here.
    met = lines.join(small(guess), by).groupBy(*by, "name", "share").agg(F.count("*").alias("m"), F.count_if(F.col("l_extendedprice") < F.col("estimate")).alias("least"), F.count_if(F.col("l_extendedprice") <= F.col("estimate")).alias("upto"))
    off = 2 * sketches.rank_bound(400) * F.col("m")
    within = (F.col("least") - off <= share * F.col("m")) & (share * F.col("m") <= F.col("upto") + off)
    return exact.join(met.select(*by, "name", within.alias("within")), [*by, "name"], "left").select(*by, "name", "n", "value", "within")


def lateral(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """SQL over the pages, under a name of their own, and the table functions."""
    name = f"pages_{uuid.uuid4().hex}"
    spread(table(spark, sf_dir, "pages")).createOrReplaceTempView(name)
    tables.register(spark)
    return spark.sql(sql.format(pages=name))


@query("SELECT page_id, CAST(s AS INT) AS start, md5(substr(html, s + 1, 8000)) AS digest FROM (SELECT page_id, html, unnest(range(0, length(html), 4000)) AS s FROM pages)")
def lateral_text_windows(spark, sf_dir):
    """Windows of 8000 characters, one every 4000, of every page."""
    return lateral(spark, sf_dir, "SELECT page_id, w.start, md5(w.piece) AS digest FROM {pages}, LATERAL text_windows(html, 8000, 4000) AS w")


@query("SELECT page_id, tag, count(*) AS n FROM (SELECT page_id, lower(unnest(regexp_extract_all(html, '<([a-zA-Z][^\\s/>]*)', 1))) AS tag FROM pages) GROUP BY page_id, tag")
def lateral_page_elements(spark, sf_dir):
    """How many elements of each tag every page has."""
    return lateral(spark, sf_dir, "SELECT page_id, e.tag, count(*) AS n FROM {pages}, LATERAL page_elements(html) AS e GROUP BY page_id, e.tag")


@query("""SELECT 'world' AS name, NULL AS parent, 0 AS depth, false AS is_leaf UNION ALL SELECT r_name, 'world', 1, r_regionkey NOT IN (SELECT n_regionkey FROM nation) FROM region
 UNION ALL SELECT n_name, r_name, 2, n_nationkey NOT IN (SELECT c_nationkey FROM customer) FROM nation JOIN region ON r_regionkey = n_regionkey
 UNION ALL SELECT c_name, n_name, 3, true FROM customer JOIN nation ON n_nationkey = c_nationkey""")
def nested_tree_round_trip(spark, sf_dir):
    """Regions, nations and customers written as one nested JSON text, in parts, and read back."""
    region, nation, customer = (table(spark, sf_dir, t) for t in ("region", "nation", "customer"))
    nations = nation.join(F.broadcast(region), F.col("r_regionkey") == F.col("n_regionkey"))
    paths = [["'world'"], ["'world'", "r_name"], ["'world'", "r_name", "n_name"], ["'world'", "r_name", "n_name", "c_name"]]
    rows = [spark.range(1), region, nations, customer.join(F.broadcast(nations), F.col("c_nationkey") == F.col("n_nationkey"))]
    nodes = [df.select(F.expr(f"array({', '.join(p)})").alias("path"), F.lit(i).alias("depth"), F.lit(i == 3).alias("is_leaf")) for i, (df, p) in enumerate(zip(rows, paths))]
    path = f"{shared_folder(spark)}/quern-{spark.sparkContext.applicationId}-{uuid.uuid4().hex}"
    write_tree(nodes[0].union(nodes[1]).union(nodes[2]).union(nodes[3]), path)
    tree = read_tree(spark, path, parts=True)
    parents = tree.select(F.col("node_id").alias("parent_id"), F.col("name").alias("parent"))
    return tree.join(parents, "parent_id", "left").select("name", "parent", "depth", "is_leaf")
