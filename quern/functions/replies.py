"""Parsing of model replies that hold JSON."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from quern.functions.text import strip, without_json_fence

REPORT = "struct<scores: array<struct<criterion_id: int, score: double, reason: string>>, total_score: double, weighted_score: double, max_score: double, percentage: double, overall_comment: string, strengths: array<string>, weaknesses: array<string>, suggestions: array<string>>"
CHECKLIST = "array<struct<id: int, title: string, maxScore: int, description: string>>"


def score_report(reply: Column) -> Column:
    """The report object in a reply, from its first brace to its last; null if there is none or it has no scores."""
    report = F.from_json(F.regexp_extract(without_json_fence(F.coalesce(reply, F.lit(""))), r"\{[\s\S]*\}", 0), REPORT)
    return F.when(report.scores.isNotNull(), report)


def checklist_scores(reply: Column, n: int = 20, most: float = 5) -> Column:
    """n scores between 0 and `most`: those of a scores object, else standalone digits 0-5 of the reply, else zeros.

    A scores object that isn't JSON gives zeros at once.
    """
    text = F.coalesce(reply, F.lit(""))
    block = F.regexp_extract(without_json_fence(text), r'\{[^{}]*"scores"\s*:\s*\[[^\]]+\][^{}]*\}', 0)
    parsed = F.from_json(block, "struct<scores: array<double>>").scores
    digits = F.transform(F.regexp_extract_all(text, F.lit(r"\b([0-5])\b"), F.lit(1)), lambda d: d.cast("double"))
    zeros = F.array_repeat(F.lit(0.0), n)
    clamped = F.transform(F.slice(parsed, 1, n), lambda s: F.least(F.lit(most), F.greatest(F.lit(0.0), s)))
    return (
        F.when((block != "") & parsed.isNull(), zeros)
        .when(F.coalesce(F.size(parsed), F.lit(-1)) >= n, clamped)
        .when(F.size(digits) >= n, F.slice(digits, 1, n))
        .otherwise(zeros)
    )


def task_list(reply: Column) -> Column:
    """The tasks array of a reply: the reply itself, its json fence, or the first flat object with tasks; else null."""
    text = F.coalesce(reply, F.lit(""))
    candidates = [text, F.regexp_extract(text, r"(?s)```json\s*(\{.*?\})\s*```", 1), F.regexp_extract(text, r'(?s)\{[^{}]*"tasks"[^{}]*\[[^\]]*\][^{}]*\}', 0)]
    return F.coalesce(*[F.from_json(c, "struct<tasks: array<string>>").tasks for c in candidates])


def subcategories(reply: Column, most: int) -> Column:
    """At most `most` names: of a JSON object's `subcategories`, of a JSON array, or of lines without bullets."""
    text = strip(F.coalesce(reply, F.lit("")))
    text = F.when(text.startswith("```"), F.regexp_replace(text, r"^[^\n]*\n", "")).otherwise(text)
    text = strip(F.when(text.endswith("```"), F.regexp_replace(text, r"\n[^\n]*$", "")).otherwise(text))
    names = F.coalesce(F.from_json(text, "struct<subcategories: array<string>>").subcategories, F.from_json(text, "array<string>"))
    clean = lambda xs: F.filter(F.transform(xs, strip), lambda x: x != "")
    unmarked = F.transform(clean(F.split(text, r"\R")), lambda x: F.regexp_replace(x, r"^[-* ]+", ""))
    lines = F.filter(F.transform(unmarked, lambda x: F.when(x.rlike(r"^\d\d"), F.regexp_replace(x, r"^.*?\. ", "")).otherwise(x)), lambda x: x != "")
    return F.slice(F.when(names.isNotNull(), clean(names)).otherwise(lines), 1, most)


def checklist(text: Column) -> Column:
    """A checklist column from its JSON text; anything else gives an empty one."""
    return F.coalesce(F.from_json(text, CHECKLIST), F.array().cast(CHECKLIST))


def checklist_text(items: Column, most: int = 20) -> Column:
    """A checklist as numbered lines."""
    line = lambda x, i: F.concat(
        (i + 1).cast("string"), F.lit(". "), F.coalesce(x.title, F.concat(F.lit("Item "), (i + 1).cast("string"))),
        F.lit(" (max "), F.coalesce(x.maxScore, F.lit(5)).cast("string"), F.lit(")\n   "), F.coalesce(x.description, F.lit("")), F.lit("\n\n"),
    )
    return F.array_join(F.transform(F.slice(items, 1, most), line), "")


def conversation_text(messages: Column) -> Column:
    """The content of a chat's first message (array of structs with `content`)."""
    return F.coalesce(F.get(messages, 0).content, F.lit(""))


def question_text(question: Column) -> Column:
    """A question given as plain text, or as the JSON of a chat: then the content of its first message, or that message."""
    text = F.coalesce(question, F.lit(""))
    first = F.get(F.from_json(text, "array<string>"), 0)
    content = F.get_json_object(first, "$.content")
    return F.when(strip(text).startswith("[") & first.isNotNull(), F.coalesce(content, first)).otherwise(text)
