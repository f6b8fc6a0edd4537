"""Reading names and bodies out of running text by the fixed words beside them.

A text is flattened to single blanks. A cue is plain wording; what stands behind or
before its first occurrence is looked at by position, never by a pattern of the whole
sentence. Names and bodies are told by their form alone: words with a capital.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_WORD = r"\p{Lu}[\p{L}\p{N}#.'’-]*"
_NAME = rf"{_WORD}(?:,? {_WORD})*"
#: Titles that stand before names.
TITLES = ["Mr.", "Mrs.", "Ms.", "Miss", "Dr.", "Senator", "Representative", "Congressman", "Congresswoman", "Honorable"]
_TITLE = "(?:(?:" + "|".join(t.replace(".", r"\.") for t in TITLES) + ") )*"


#: A name's further words: joined by commas and small words, but no title and no other body.
_NEXT = r"(?:,? (?:(?:and|of|the|on|for) )*(?!Committee\b|Subcommittee\b|(?:" + "|".join(t.replace(".", r"\.") for t in TITLES) + r")(?: |$))" + _WORD + ")"


#: A whole name by its form.
CAPITALS = f"{_WORD}{_NEXT}*"


def flat(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"\s+", " "))


def behind(text: Column, *cues: str) -> Column:
    """What follows the first cue of the list that the text has, in any case; null without any."""
    low = F.lower(text)
    found = [F.when(F.instr(low, c.lower()) > 0, F.substring(text, F.instr(low, c.lower()) + len(c), F.length(text))) for c in cues]
    return F.coalesce(*found)


def before(text: Column, *cues: str) -> Column:
    """What stands before the first cue of the list that the text has; null without any."""
    low = F.lower(text)
    return F.coalesce(*(F.when(F.instr(low, c.lower()) > 1, F.substring(text, F.lit(1), F.instr(low, c.lower()) - 1)) for c in cues))


def _bare(name: Column) -> Column:
    name = F.rtrim(F.regexp_replace(name, rf"^{_TITLE}", ""), F.lit(" ,;"))
    # a full stop belongs to an initial or an abbreviation, else it ends the sentence
    name = F.regexp_replace(name, r"([\p{L}\p{N}]{4,})\.$", "$1")
    return F.when(F.length(name) > 1, name)


def leading_name(text: Column) -> Column:
    """The capitalised words that a text begins with, titles left out."""
    return _bare(F.regexp_extract(F.ltrim(text, F.lit(" (")), rf"^(?:the )?{_TITLE}{_NAME}", 0))


def trailing_name(text: Column) -> Column:
    return _bare(F.regexp_extract(F.rtrim(text, F.lit(" ,")), rf"{_NAME}$", 0))


def leading_body(text: Column) -> Column:
    """'Committee on X' at the beginning of a text, to a stop or to an 'and' before a small letter."""
    rest = F.regexp_replace(F.ltrim(text, F.lit(" ")), r"^(?i:the )", "")
    name = F.regexp_extract(rest, r"^Committee on ([^,.;:(]+)", 1)
    name = F.trim(F.regexp_replace(name, r" (?:(?:and|be) (?=\p{Ll})|effective\b|of the (?:House|Senate)\b).*$", ""))
    return F.when(F.length(name) > 0, F.concat(F.lit("Committee on "), name))


def bodies_behind(text: Column) -> Column:
    """The name behind every 'Committee on' and 'Committee of' of a text, without 'the' and closing stops.

    A name with a capital ends with its form, one in small letters at the next stop or dash.
    """
    parts = F.split(flat(text), r"(?i)\bcommittees? (?:on|of) (?:the )?", -1)

    def name(part):
        formed = F.regexp_extract(part, rf"^{CAPITALS}", 0)
        return F.rtrim(F.when(formed != "", formed).otherwise(F.substring_index(F.regexp_replace(part, r" -|[.;:\u2014]", "\n"), "\n", 1)), F.lit(" .,;"))

    return F.filter(F.transform(F.slice(parts, F.lit(2), F.size(parts)), name), lambda x: x != "")


def signature(text: Column) -> Column:
    """The name on the first line behind a closing ('Sincerely,' and the like)."""
    lines = F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.trim(x))
    closing = F.transform(lines, lambda x: F.lower(x).rlike(r"^(?:yours )?(?:sincerely|respectfully|regards|very truly)"))
    at = F.array_position(closing, True).cast("int")
    return F.when(at > 0, leading_name(F.get(F.filter(F.slice(lines, at + 1, F.size(lines)), lambda x: x != ""), F.lit(0))))
