"""Table functions in lateral joins against brute force."""

from collections import Counter

import pytest

from quern.functions import tables
from quern.operators.similarity import Elements

TEXTS = [(1, "abcdefghij"), (2, ""), (3, None), (4, "a"), (5, "日本語 text  with\nwords"), (6, " "), (7, "x" * 25)]


@pytest.fixture(scope="module")
def texts(spark):
    tables.register(spark)
    spark.createDataFrame(TEXTS, "id long, text string").createOrReplaceTempView("texts")


@pytest.mark.parametrize("size, step", [(4, 2), (3, 5), (100, 100), (1, 1)])
def test_text_windows(spark, texts, size, step):
    got = spark.sql(f"SELECT id, w.* FROM texts, LATERAL text_windows(text, {size}, {step}) AS w").collect()
    assert Counter(map(tuple, got)) == Counter((i, k, a, t[a : a + size]) for i, t in TEXTS if t for k, a in enumerate(range(0, len(t), step)))


@pytest.mark.parametrize("size", [1, 2, 9])
def test_word_runs(spark, texts, size):
    got = spark.sql(f"SELECT id, w.* FROM texts, LATERAL word_runs(text, {size}) AS w").collect()
    assert Counter(map(tuple, got)) == Counter((i, k, " ".join(t.split()[k : k + size])) for i, t in TEXTS if t and t.split() for k in range(max(1, len(t.split()) - size + 1)))


def test_page_elements_and_errors(spark, texts):
    html = '<html><body class="a"><img src=x><p>b</p></body></html>'
    got = spark.sql(f"SELECT * FROM page_elements('{html}')").collect()
    assert [(r["tag"], list(r["attributes"].items())) for r in got] == Elements(html).found and [r["place"] for r in got] == list(range(4))
    joined = spark.sql("SELECT id, e.tag FROM (SELECT id, concat('<b>', text, '</b><i>') AS html FROM texts), LATERAL page_elements(html) AS e")
    assert Counter(map(tuple, joined.collect())) == Counter((i, tag) for i, t in TEXTS if t is not None for tag in "bi")
    with pytest.raises(Exception, match="1 or more"):
        spark.sql("SELECT * FROM texts, LATERAL text_windows(text, 0, 1)").collect()
