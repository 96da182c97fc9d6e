"""Repetition and structural similarity of pages, in Arrow batches."""

import difflib
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Landmark roles, and elements that have no end tag.
ROLES = ["header", "footer", "nav", "main", "sidebar", "ad"]
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}


class Elements(HTMLParser):
    """The elements of a page in document order, which is the pre-order of its tree."""

    def __init__(self, html: str):
        super().__init__()
        self.found: list[tuple[str, list[tuple[str, str]]]] = []
        self.feed(html)
        self.close()

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.found.append((tag.lower(), sorted((k, v or "") for k, v in dict(attrs).items())))

    handle_startendtag = handle_starttag


def common_subsequence(a: list, b: list) -> int:
    """Length of the longest common subsequence; one numpy row for each element of the shorter list."""
    if len(a) > len(b):
        a, b = b, a
    names = {x: i for i, x in enumerate(dict.fromkeys([*a, *b]))}
    right = np.array([names[x] for x in b])
    row = np.zeros(len(b) + 1, np.int64)
    for x in a:
        same = np.where(right == names[x], row[:-1] + 1, 0)
        row[1:] = np.maximum.accumulate(np.maximum(row[1:], same))
    return int(row[-1])


def structural_similarity(a: str, b: str) -> float:
    x, y = ([f"{tag}_{attrs}" for tag, attrs in Elements(h).found] for h in (a, b))
    if not x or not y:
        return float(not x and not y)
    return common_subsequence(x, y) / max(len(x), len(y))


def role_elements(html: str) -> dict[str, list[str]]:
    """Tags of the elements that name a role in their tag and, once more, in an attribute's value."""
    out: dict[str, list[str]] = {r: [] for r in ROLES}
    for tag, attrs in Elements(html).found:
        for role in ROLES:
            out[role] += [tag] * (role in tag) + [tag] * any(role in v.lower() for _, v in attrs)
    return out


def semantic_similarity(a: str, b: str) -> float:
    x, y = role_elements(a), role_elements(b)
    ratio = lambda s, t: difflib.SequenceMatcher(None, s, t).ratio() if s and t else float(not s and not t)
    return sum(ratio(x[r], y[r]) for r in ROLES) / len(ROLES)


def page_similarity(a: Column, b: Column) -> Column:
    """Half structural, half semantic similarity of two extracted pages; 0 if either is empty or null."""

    @F.pandas_udf("double")
    def run(left: pd.Series, right: pd.Series) -> pd.Series:
        return pd.Series([(structural_similarity(x, y) + semantic_similarity(x, y)) / 2 if x and y else 0.0 for x, y in zip(left, right)], dtype="float64")

    return run(a, b)


def is_repetitive(text: str, window: int = 8000, step: int = 4000, inside: float = 0.65, between: float = 0.85, n: int = 8) -> bool:
    """Whether a window repeats its own n-grams, or those of one of the next two windows."""
    if len(text) < 100:
        return False
    sets: list[set[str]] = []
    for at in range(0, len(text), step):
        part = text[at : at + window]
        if len(part) >= 100:
            total = len(part) - n + 1
            grams = {part[i : i + n] for i in range(total)}
            if 1 - len(grams) / total >= inside:
                return True
            sets.append(grams)
    return any(len(x & y) / len(x | y) >= between for i, x in enumerate(sets) for y in sets[i + 1 : i + 3])


def repetition_flag(page: Column) -> Column:
    """1 for a page without degenerate repetition (or too short to tell), else 0."""

    @F.pandas_udf("long")
    def run(pages: pd.Series) -> pd.Series:
        return pd.Series([0 if is_repetitive(p or "") else 1 for p in pages], dtype="int64")

    return run(page)
