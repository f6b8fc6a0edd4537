"""Member lists of assignment resolutions as arrays of ranked slots, all in column expressions.

A list is cut into pieces at its stops. A fold over the pieces makes the slots: a piece
is a name, or says something of the slot before it (whom it ranks after, a suffix).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import cues as cu

#: What stands behind a name and belongs to it.
SUFFIXES = ["jr", "sr", "ii", "iii", "iv"]

SLOTS = "array<struct<name:string,rank_after:string>>"


def header_body(header: Column) -> Column:
    """A heading without its colon; a first word that is nearly 'Committee' is spelt so."""
    bare = F.trim(F.rtrim(F.trim(header), F.lit(": ")))
    first = F.substring_index(bare, " ", 1)
    near = (F.levenshtein(F.lower(first), F.lit("committee")) <= 2) & (F.length(first) >= 7)
    return F.when(near, F.concat(F.lit("Committee"), F.substring(bare, F.length(first) + 1, F.length(bare)))).otherwise(bare)


def pieces(text: Column) -> Column:
    """Parts between commas, semicolons, brackets and 'and', without blanks and closing stops."""
    cut = F.split(cu.flat(text), r"[,;()]| and (?=[A-Z(])|^and ", -1)
    tidy = F.transform(cut, lambda x: F.trim(F.regexp_replace(F.trim(x), r"^and ", "")))
    # the stop at the end of the list is none of the last name's, unless that is an initial or a suffix
    tidy = F.transform(tidy, lambda x: F.when(x.rlike(r"\p{L}{3,}\.$"), F.substring(x, F.lit(1), F.length(x) - 1)).otherwise(x))
    return F.filter(tidy, lambda x: x != "")


def _suffix(piece: Column) -> Column:
    return F.lower(F.rtrim(piece, F.lit("."))).isin(SUFFIXES)


def _is_name(piece: Column) -> Column:
    return (F.length(piece) > 2) & piece.rlike(r"^\p{Lu}") & (piece.contains(" ") | piece.contains("."))


def _put(slots: Column, piece: Column) -> Column:
    low = F.lower(piece)
    last = F.try_element_at(slots, F.lit(-1))
    kept = F.slice(slots, F.lit(1), F.greatest(F.size(slots) - 1, F.lit(0)))
    ranked = low.startswith("to rank") | low.startswith("after ")
    anchor = F.trim(cu.behind(F.concat(F.lit(" "), piece), " after "))
    slot = lambda name, after: F.array(F.struct(name.alias("name"), after.alias("rank_after"))).cast(SLOTS)
    whole, anchored = slot(piece, F.lit(None).cast("string")), slot(last["name"], F.coalesce(anchor, last["rank_after"]))
    # a suffix goes to the name it follows: the anchor if there is one already
    longer = F.concat_ws(", ", F.coalesce(last["rank_after"], last["name"]), piece)
    named = slot(F.when(last["rank_after"].isNull(), longer).otherwise(last["name"]), F.when(last["rank_after"].isNotNull(), longer))
    has = F.size(slots) > 0
    return (
        F.when(has & ranked, F.concat(kept, anchored)).when(has & _suffix(piece), F.concat(kept, named))
        .when(~ranked & _is_name(piece), F.concat(slots, whole)).otherwise(slots)
    )


def member_slots(text: Column) -> Column:
    """A list of names to an array of slots (name, rank_after) in source order.

    ``rank_after`` names the member that an entry is said to rank after; remarks such as
    'when sworn' are left out. A null or empty text has no slots.
    """
    none = F.array().cast(SLOTS)
    return F.aggregate(pieces(text), none, _put)


_REMOVAL = " be, and is hereby, removed from "


def removed_member(text: Column) -> Column:
    """The member of a sentence of removal ('be, and is hereby, removed from'), else null."""
    member = F.btrim(cu.before(cu.flat(text), _REMOVAL), F.lit(" ,.;"))
    return F.when(cu.behind(cu.flat(text), _REMOVAL).rlike("(?i)^(?:the )?committee on "), F.nullif(member, F.lit("")))


def removed_bodies(text: Column) -> Column:
    """The committees of such a sentence, an array of 'Committee on Y'; empty for others."""
    told = F.coalesce(cu.behind(cu.flat(text), _REMOVAL), F.lit(""))
    parts = F.split(told, "(?i)committee on ", -1)
    bare = F.transform(F.slice(parts, F.lit(2), F.size(parts)), lambda x: F.btrim(F.regexp_replace(F.rtrim(x), r" and(?: the)?$", ""), F.lit(" ,.;")))
    return F.transform(F.filter(bare, lambda x: x != ""), lambda x: F.concat(F.lit("Committee on "), x))
