"""Golden cases of the column functions."""

import pytest
from pyspark.sql import functions as F

from quern.functions import html as H
from quern.functions import replies as R
from quern.functions import scores as S
from quern.functions import text as T
from quern.operators import minhash

FENCE = "```"
WHOLE = "<html><head></head><body>" + 20 * "<p>x</p>" + "</body></html>"


def values(spark, column, *texts):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, x string").select("i", column(F.col("x")).alias("y")).orderBy("i").collect()
    return [r["y"] for r in rows]


def test_strip_takes_all_white_space(spark):
    assert values(spark, T.strip, "\t a \n", "  b\x1c", "", None) == ["a", "b", "", None]


def test_shingles(spark):
    assert [sorted(x) for x in values(spark, minhash.shingles, "", "abc", "  HeLLo ", "abcabcabc")] == [[""], ["abc"], ["hello"], ["abcab", "bcabc", "cabca"]]


def test_base_hash_and_family(spark):
    assert values(spark, minhash.base_hash, "hello") == [3809856964]
    a, b = minhash.family(128)
    assert a[:3].tolist() == [1608637543, 3421126068, 4083286877] and b[:3].tolist() == [1206604539, 2607192251, 2330861947]
    import numpy as np

    with np.errstate(over="ignore"):
        assert ((a * np.int64(3809856964) + b) % minhash.PRIME)[:3].tolist() == [4227853753, 1621876692, 1977980631]


@pytest.mark.parametrize(
    ("text", "status"),
    [
        ("", "empty_response"),
        (f"{FENCE}html\n<p>a</p>\n{FENCE}", "html_block"),
        (f"{FENCE}HTML\n<p>a</p>{FENCE} {FENCE}html\n<p>abc</p>{FENCE}", "html_block"),
        (f"{FENCE}\n<!DOCTYPE html><p>{FENCE}", "doctype_block"),
        (f"{FENCE}\n<html>a</html> tail\n{FENCE}", "html_tag_block"),
        ("<html>a</html>", "no_html_block"),
        (f"{FENCE}html\n{FENCE}", "no_html_block"),
    ],
)
def test_html_block(spark, text, status):
    block = values(spark, H.html_block, text)[0]
    assert block["status"] == status
    assert block["html"] == {"html_block": "<p>abc</p>" if "abc" in text else "<p>a</p>", "doctype_block": "<!DOCTYPE html><p>", "html_tag_block": "<html>a</html>"}.get(status)


@pytest.mark.parametrize(
    ("html", "status"),
    [
        (None, "too_short"), ("<html></html>", "too_short"), ("<div>" + 60 * "a", "no_html_tag"), ("<html>" + 60 * "a" + "</html>", "no_body_tag"),
        ("<html><body>" + 60 * "a" + "</body>", "unbalanced_html"), ("<html><body>" + 60 * "a" + "</html>", "unbalanced_body"),
        ("<html><body>" + 60 * "a" + '<input placeholder="n"></body></html>', "has_placeholder"), ("<html><body>" + 60 * "a" + "</body></html>", "too_minimal"), (WHOLE + " " * 10, "valid"),
    ],
)
def test_validation(spark, html, status):
    assert values(spark, H.validation_status, html) == [status]


def test_tag_counts(spark):
    rows = spark.createDataFrame([("<div><h1>a</h1><p>b</p></div>",), ('<a href="/x">l</a>',), ('<br/><img src="a.png"/><p>t</p>',)], "x string")
    got = rows.select(*[c.alias(n) for n, c in H.tag_counts(F.col("x")).items()]).collect()
    assert [tuple(r) for r in got] == [(3, 2, 0, 3), (0, 1, 0, 1), (1, 1, 2, 3)]


def test_rule_filter(spark):
    texts = [WHOLE, WHOLE + "[...a]", WHOLE + "TODO", WHOLE + "todo", "<svg>" + 20 * "<g></g>" + "</svg>", "<div>" + 12 * "<h1>a</h1>" + "</div>", 40 * "hello ", None]
    assert values(spark, H.passes_rules, *texts) == [True, False, False, True, True, False, False, False]


def test_lengths(spark):
    assert values(spark, H.fits_length, "a" * 21845, "a" * 21846) == [True, False]
    assert values(spark, lambda x: F.round(H.length_score(x), 3), "a" * 16000, "a" * 18000, "a" * 21334, "") == [1.0, 0.625, 0.0, 1.0]


def test_page_extraction(spark):
    blank, svg, body = f"{FENCE}html\n   \n{FENCE}<html>x</html>", "x <svg><g/></svg>", "<body a> hi </body>"
    got = values(spark, H.page, blank, svg, body, "none", None, "<!doctype html><html>a</html>")
    assert got[0] == "" and "<svg><g/></svg>" in got[1] and got[2].endswith("<body>hi</body>\n</html>") and got[3:] == ["", "", "<!doctype html><html>a</html>"]


def test_replies(spark):
    assert values(spark, lambda x: R.score_report(x).percentage, '```json\n{"scores": [], "percentage": 5}\n```', '{"percentage": 5}', "no", None) == [5.0, None, None, None]
    twenty = ", ".join(str(i % 7 - 1) for i in range(20))
    good = [float(min(5, max(0, i % 7 - 1))) for i in range(20)]
    digits = " ".join("3" for _ in range(21))
    assert values(spark, R.checklist_scores, f'{{"scores": [{twenty}]}}', digits, f'{{"scores": [x]}} {digits}', None) == [good, 20 * [3.0], 20 * [0.0], 20 * [0.0]]
    assert values(spark, lambda x: R.subcategories(x, 2), '["a", " b ", "c"]', "1. x\n10. y", "", '```\n{"subcategories": ["q", ""]}\n```') == [["a", "b"], ["1. x", "y"], [], ["q"]]
    assert values(spark, R.task_list, '{"tasks": ["a"]}', 'so ```json\n{"tasks": ["b"]}\n``` ok', 'so {"tasks": ["c"]} ok', "none", None) == [["a"], ["b"], ["c"], None, None]


def test_scores(spark):
    rows = spark.createDataFrame([(80.0,), (79.9,), (float("nan"),), (None,)], "s double")
    assert [r[0] for r in rows.select(S.passes_score(F.col("s"))).collect()] == [True, False, False, False]
    assert round(sum(S.CRITERION_WEIGHTS), 6) == 25.4 and len(S.CRITERION_WEIGHTS) == 25


def test_templates(spark):
    template = F.lit("{a} {b} {a} {c}")
    filled = T.fill_template(template, T.template_variables(template), {"a": F.lit("x"), "b": F.lit("y")})
    assert spark.range(1).select(filled).first()[0] == "x y x {c}"
    assert values(spark, T.without_whole_fence, f"{FENCE}x\nbody\n{FENCE}", f"{FENCE}x", "plain ") == ["body", f"{FENCE}x", "plain"]


# The patterns and formats as literals, so that a changed constant of the library doesn't pass unseen.


@pytest.mark.parametrize(
    ("text", "found"),
    [
        ("<div>" + "x" * 100 + "</div>", "few_elements"), ("<div>" * 10 + "x" * 60, "unbalanced"), ("plain words " * 20, "no_markup"),
        ("<html>" + "x" * 100 + "... rest of the code ...</html>", "unfinished"), ("<p>x</p>", "too_short"),
    ],
)
def test_rule_reasons(spark, text, found):
    assert values(spark, H.rule_reason, text) == [found]


def test_pages_as_literals(spark):
    got = values(spark, H.page, f"so:\n{FENCE}html\n<b>1</b>\n{FENCE}", "<!DOCTYPE html><html><b>2</b></html> tail", "a <html><b>3</b></html> z")
    assert got == ["<b>1</b>", "<!DOCTYPE html><html><b>2</b></html>", "<html><b>3</b></html>"]


def test_data_urls_and_times(spark):
    rows = spark.createDataFrame([(bytearray(range(100)),), (None,)], "image binary")
    import base64

    assert [r[0] for r in rows.select(T.data_url(F.col("image"))).collect()] == ["data:image/png;base64," + base64.b64encode(bytes(range(100))).decode(), None]
    assert spark.range(1).select(T.stamped(F.lit(1_700_000_000))).first()[0] == "2023-11-14T22:13:20Z"


def test_hash_numbers(spark):
    import hashlib

    want = int(hashlib.md5(b"42|7|x").hexdigest()[:8], 16)
    assert spark.range(1).select(T.hash_number(F.lit("42"), F.lit(7), F.lit("x"))).first()[0] == want
