"""Names, keys, labels and titles as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def compact_key(name: Column) -> Column:
    """Lower case, letters and digits only."""
    return F.regexp_replace(F.lower(name), "[^a-z0-9]+", "")


def name_key(name: Column) -> Column:
    """Lower-case letters, other runs as one space (for ASCII names; people.person_key folds accents)."""
    return F.trim(F.regexp_replace(F.lower(name), "[^a-z]+", " "))


def body_key(name: Column) -> Column:
    """A committee-like name without its leading kind, as a compact key."""
    return compact_key(F.regexp_replace(F.lower(F.trim(name)), r"^(?:the\s+)?(?:standing\s+|select\s+|special\s+)?(?:sub)?committee\s+(?:on|for)\s+(?:the\s+)?", ""))


def split_members(text: Column) -> Column:
    """Names of a list with commas, semicolons and 'and', trimmed, empty ones left out."""
    parts = F.split(text, r"\s*(?:;|,|\band\b)\s*", -1)
    return F.filter(F.transform(parts, lambda x: F.trim(x)), lambda x: F.length(x) > 0)


def label_name_state(label: Column) -> tuple[Column, Column]:
    """'Name, of State' or 'Name (ST-13) ROLE' to (name, state); nulls for others."""
    of_state, in_brackets = r"^(.*?),?\s+of\s+([A-Za-z ]+?)\.?$", r"^(.*?)\s*\(([A-Z]{2})(?:-\d+)?\).*$"
    name = F.when(label.rlike(in_brackets), F.regexp_extract(label, in_brackets, 1)).when(label.rlike(of_state), F.regexp_extract(label, of_state, 1))
    state = F.when(label.rlike(in_brackets), F.regexp_extract(label, in_brackets, 2)).when(label.rlike(of_state), F.regexp_extract(label, of_state, 2))
    return F.trim(name), F.trim(state)


def first_match(text: Column, rules: list[tuple[str, str]], other: str = "other") -> Column:
    """The label of the first pattern that matches; ``rules``: (pattern, label)."""
    out = F
    for pattern, label in rules:
        out = out.when(text.rlike(pattern), F.lit(label))
    return out.otherwise(F.lit(other)) if rules else F.lit(other)


def long_date(text: Column) -> Column:
    """The first 'Month d, yyyy' of a text as a date, ordinal suffixes allowed."""
    pattern = r"((?:January|February|March|April|May|June|July|August|September|October|November|December)\s+\d{1,2})(?:st|nd|rd|th)?,\s+(\d{4})"
    found = F.concat_ws(", ", F.regexp_extract(text, pattern, 1), F.regexp_extract(text, pattern, 2))
    return F.when(text.rlike(pattern), F.try_to_date(found, "MMMM d, yyyy"))
