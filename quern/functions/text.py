"""Text functions as column expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space of Unicode, and the four separators below the space.
SPACE = r"(?U)[\s\x1c-\x1f]"


def strip(text: Column) -> Column:
    """text without white space of any kind at its ends (Spark's trim takes spaces only)."""
    return F.regexp_replace(text, rf"^{SPACE}+|{SPACE}+$".replace("|(?U)", "|"), "")


def count_of(text: Column, part: str) -> Column:
    """How often part stands in text, without overlaps."""
    return ((F.length(text) - F.length(F.replace(text, F.lit(part), F.lit("")))) / len(part)).cast("long")


def contains_any(text: Column, parts: list[str]) -> Column:
    found = F.lit(False)
    for part in parts:
        found = found | F.contains(text, F.lit(part))
    return found


def estimated_tokens(text: Column, per_char: float = 0.75) -> Column:
    return F.length(text) * F.lit(per_char)


def template_variables(template: Column) -> Column:
    """Sorted distinct names in braces."""
    return F.array_sort(F.array_distinct(F.regexp_extract_all(template, F.lit(r"\{([^}]+)\}"), F.lit(1))))


def template_is_valid(template: Column, variables: Column, required: str = "web_category") -> Column:
    """At least two variables, the required one among them, and 20 characters of text."""
    return F.coalesce((F.size(variables) >= 2) & F.array_contains(variables, required) & (F.length(strip(template)) >= 20), F.lit(False))


def fill_template(template: Column, variables: Column, values: dict[str, Column] | Column) -> Column:
    """Every occurrence of each listed variable replaced, in list order; names without a value stay.

    values may be a map column: one made before a join or a generator is made once a row, not once a variable.
    """
    names = F.create_map(*[x for name, value in values.items() for x in (F.lit(name), value)]) if isinstance(values, dict) else values
    return F.aggregate(variables, template, lambda text, name: F.coalesce(F.replace(text, F.concat(F.lit("{"), name, F.lit("}")), F.try_element_at(names, name)), text))


def hash_number(*parts: Column | str) -> Column:
    """A reproducible number below 2^32 from the parts' texts: the first word of the md5 of the parts joined by bars."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts).cast("binary")), 1, 8), 16, 10).cast("long")


def pick(options: list[str], *key: Column | str) -> Column:
    """A reproducible choice: the option whose number is the key's hash modulo their count."""
    return F.element_at(F.array(*map(F.lit, options)), (hash_number(*key) % len(options) + 1).cast("int"))


def safe_name(name: Column) -> Column:
    """A file name: slash and space as underscore, ampersand as `and`."""
    return F.replace(F.translate(name, "/ ", "__"), F.lit("&"), F.lit("and"))


def path_key(path: Column) -> Column:
    """Path parts joined by slashes, with slashes inside parts as dashes."""
    return F.array_join(F.transform(path, lambda p: F.replace(p, F.lit("/"), F.lit("-"))), "/")


def without_line_label(line: Column) -> Column:
    """line without a leading `12:` or `L12:`."""
    return strip(F.regexp_replace(strip(line), r"^L?\d+:", ""))


def without_fence_lines(text: Column) -> Column:
    """A leading fence line and a trailing fence line removed, each if there."""
    return strip(F.regexp_replace(F.regexp_replace(text, r"^```.*?\n", ""), r"\n```$", ""))


def without_whole_fence(text: Column) -> Column:
    """Text that both begins and ends with a fence loses its first and last line."""
    stripped = strip(text)
    lines = F.split(stripped, "\n")
    inner = strip(F.array_join(F.slice(lines, F.lit(2), F.greatest(F.size(lines) - 2, F.lit(0))), "\n"))
    return F.when(stripped.startswith("```") & stripped.endswith("```"), inner).otherwise(stripped)


def without_json_fence(text: Column) -> Column:
    """A leading fence (marked json or not) and a trailing one removed, with the white space beside them."""
    stripped = strip(text)
    bare = F.regexp_replace(F.regexp_replace(stripped, r"^```(?:json)?\s*", ""), r"\s*```$", "")
    return F.when(stripped.startswith("```"), bare).otherwise(stripped)


def bullet_list(items: Column) -> Column:
    """`a, b, c` as lines that begin with a dash (but the first)."""
    return F.replace(items, F.lit(", "), F.lit("\n- "))


def data_url(image: Column, kind: str = "image/png") -> Column:
    """Image bytes as a data URL in base64, on one line; null stays null."""
    return F.concat(F.lit(f"data:{kind};base64,"), F.translate(F.base64(image), "\r\n", ""))


def stamped(seconds: Column) -> Column:
    """Seconds since 1970 as an ISO 8601 time in UTC."""
    time = F.to_utc_timestamp(F.timestamp_seconds(seconds), F.current_timezone())
    return F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss'Z'")
