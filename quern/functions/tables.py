"""Table functions for SQL, to be met by lateral joins: windows of characters, runs of words, and the elements of a page.

The first two are SQL functions, which Catalyst inlines: no text leaves the JVM. Elements need a parser, so they come from
a Python table function.

Defined cases: null and empty texts give no rows; windows and runs at a text's end may be shorter than `size`, a text of
fewer words than `size` is one run; sizes and steps below 1 raise an error.
"""

from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf

from quern.operators.similarity import Elements

WORDS = r"filter(split(word_runs.text, '\\s+'), x -> x <> '')"
#: Arguments of the function may stand in its generator only, not in a filter or a subquery's own columns.
SQL_FUNCTIONS = {
    "text_windows": """(text STRING, size INT, step INT) RETURNS TABLE (place INT, start INT, piece STRING)
 RETURN SELECT w.place, w.start, w.piece FROM (SELECT inline(IF(length(text_windows.text) > 0,
 transform(sequence(0, length(text_windows.text) - 1, IF(text_windows.size < 1 OR text_windows.step < 1, raise_error('size and step are 1 or more'), text_windows.step)),
 (at, i) -> named_struct('place', i, 'start', at, 'piece', substr(text_windows.text, at + 1, text_windows.size))), array())) AS (place, start, piece)) AS w""",
    "word_runs": f"""(text STRING, size INT) RETURNS TABLE (place INT, words STRING)
 RETURN SELECT w.place, w.words FROM (SELECT inline(IF(size({WORDS}) > 0,
 transform(sequence(0, greatest(0, size({WORDS}) - IF(word_runs.size < 1, raise_error('size is 1 or more'), word_runs.size))),
 at -> named_struct('place', at, 'words', array_join(slice({WORDS}, at + 1, word_runs.size), ' '))), array())) AS (place, words)) AS w""",
}


class PageElements:
    """(place, tag, attributes) of every element of a page, in document order."""

    def eval(self, html: str) -> Iterator[tuple[int, str, dict[str, str]]]:
        for place, (tag, attributes) in enumerate(Elements(html or "").found):
            yield place, tag, dict(attributes)


page_elements = udtf(PageElements, returnType="place int, tag string, attributes map<string, string>")


def register(spark: SparkSession) -> None:
    """Make text_windows, word_runs and page_elements known to the session's SQL."""
    for name, body in SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{body}")
    spark.udtf.register("page_elements", page_elements)
