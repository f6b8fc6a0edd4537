"""Entity resolution of member names by keys: equi-joins only, narrowed in a fixed order.

Every member brings the keys it can be found by, each with a level; every mention looks
its keys up. The best level with a candidate counts; State, party and gender narrow what
is left, each only if it leaves someone. No two members or mentions are ever compared
outside a shared key, so the work grows with the rows, not with their product.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import people as pp
from ..scratch import settled

#: Levels: whole surname, last word of a compound surname, full or given name with surname, last word with given name.
SURNAME, COMPOUND, FULL, LAST_WORD = 1, 2, 3, 4


def member_keys(members: DataFrame, scope: list[str]) -> DataFrame:
    """``members`` (scope, member, first_name, nickname, last_name, full_name, state, party, gender, valid_from, valid_to) with (level, key)."""
    last = pp.person_key(F.col("last_name"))
    key = lambda level, k: F.struct(F.lit(level).alias("level"), k.alias("key"))
    given = [F.concat(pp.given_key(F.col(c)), F.lit("|"), last) for c in ("first_name", "nickname")]
    keys = F.array(
        key(SURNAME, last), key(COMPOUND, F.when(last.contains(" "), F.substring_index(last, " ", -1))), key(FULL, pp.person_key(F.col("full_name"))),
        *(key(FULL, g) for g in given), key(LAST_WORD, last),
    )
    return members.withColumn("k", F.explode(F.array_distinct(keys))).select("*", "k.level", "k.key").drop("k").filter("key IS NOT NULL AND key <> ''")


def mention_keys(mentions: DataFrame) -> DataFrame:
    """``mentions`` (…, raw, state, party, gender) with name, wanted_state and (level, key)."""
    bare = pp.without_suffix(pp.without_title(F.col("raw")))
    name, stated = pp.name_and_state(bare)
    out = mentions.withColumns({"name": pp.person_key(name), "wanted_state": F.coalesce(pp.state_code(F.col("state")), stated)})
    key = lambda level, k: F.struct(F.lit(level).alias("level"), k.alias("key"))
    words = F.split("name", " ")
    several = F.size(words) > 1
    # the surname may be any number of words at the end
    tails = F.transform(F.sequence(F.lit(2), F.size(words)), lambda i: key(FULL, F.concat(pp.given_key(F.col("name")), F.lit("|"), F.array_join(F.slice(words, i, F.size(words)), " "))))
    keys = F.concat(
        F.array(key(SURNAME, F.col("name")), key(COMPOUND, F.when(~several, F.col("name"))), key(FULL, F.when(several, F.col("name"))), key(LAST_WORD, F.when(several, F.element_at(words, -1)))),
        F.when(several, tails).otherwise(F.array().cast("array<struct<level:int,key:string>>")),
    )
    return out.withColumn("k", F.explode(F.array_distinct(keys))).select("*", "k.level", "k.key").drop("k").filter("key IS NOT NULL AND key <> ''")


def member_classes(members: DataFrame, scope: list[str]) -> DataFrame:
    """scope, level, key, rows, lo, hi: members under one key whose rows are alike, as the smallest and greatest of them.

    ``rows``: all that a mention asks of a member (first names only where the level does), a struct for each of its ranges.
    """
    said = lambda c: F.when(F.col("level") == LAST_WORD, pp.first_forms(F.col(c))).alias(c)
    row = F.struct(said("first_name"), said("nickname"), "state", "party", "gender", "valid_from", "valid_to")
    held = member_keys(members, scope).groupBy(*scope, "level", "key", "member").agg(F.array_sort(F.collect_set(row)).alias("rows"))
    return held.groupBy(*scope, "level", "key", "rows").agg(F.min("member").alias("lo"), F.max("member").alias("hi"))


def resolve_members(mentions: DataFrame, members: DataFrame, scope: list[str]) -> DataFrame:
    """``mentions`` (id, scope, raw, day, state, party, gender) to (id, member, status).

    status: resolved, ambiguous or unknown. A member counts on the days of its range
    (``valid_to`` exclusive, null open; a null day takes all). Ids are unique.
    Mentions alike in all but their id are one question, and a question meets the classes of members under its keys.
    """
    asks = list(dict.fromkeys([*scope, "raw", "day", "state", "party", "gender"]))
    asked = mention_keys(mentions.select(*asks).distinct()).withColumn("forms", pp.first_forms(F.col("name")))
    met = asked.join(member_classes(members, scope), [*scope, "level", "key"])
    names_fit = lambda r: F.coalesce(pp.forms_meet(r["first_name"], F.col("forms")), F.lit(False)) | F.coalesce(pp.forms_meet(r["nickname"], F.col("forms")), F.lit(False))
    in_range = lambda r: F.col("day").isNull() | ((r["valid_from"] <= F.col("day")) & (r["valid_to"].isNull() | (F.col("day") < r["valid_to"])))
    met = met.withColumn("rows", F.filter("rows", lambda r: in_range(r) & ((F.col("level") != LAST_WORD) | names_fit(r)))).filter(F.size("rows") > 0)
    # narrowing by one test after another, each only if it leaves someone, leaves those of the highest score
    least = lambda c: F.array_min(F.transform("rows", lambda r: r[c]))
    holds = lambda c, wanted, worth: F.when(least(c) == F.col(wanted), worth).otherwise(0)
    score = holds("state", "wanted_state", 4) + holds("party", "party", 2) + holds("gender", "gender", 1)
    ends = [F.min("lo").alias("lo"), F.max("hi").alias("hi")]
    scored = met.withColumn("score", score).groupBy(*asks, "level", "score").agg(*ends)
    levels = scored.groupBy(*asks, "level").agg(*ends, F.max_by(F.struct("lo", "hi"), "score").alias("left"))
    levels = levels.filter((F.col("lo") == F.col("hi")) | (F.col("level") != COMPOUND))
    found = levels.groupBy(*(F.col(c).alias(f"_{c}") for c in asks)).agg(F.min_by("left", "level").alias("left")).select(*(f"_{c}" for c in asks), "left.lo", "left.hi")
    alike = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in asks]
    out = mentions.select("id", *asks).join(found, alike, "left")
    status = F.when(F.col("lo").isNull(), "unknown").when(F.col("lo") == F.col("hi"), "resolved").otherwise("ambiguous")
    return out.select("id", F.when(F.col("lo") == F.col("hi"), F.col("lo")).alias("member"), status.alias("status"))


def resolve_with_retry(mentions: DataFrame, members: DataFrame, scope: list[str], block: list[str]) -> DataFrame:
    """As resolve_members, with a second attempt for mentions that stay open and state no party.

    Where the members found in a ``block`` (a roster) are all of one party, that party is asked
    for there; blocks of several parties or none get no second attempt. A member whose rows
    name several parties tells nothing.
    """
    first = settled(resolve_members(mentions, members, scope), "resolved")  # read three times
    party = members.groupBy(*scope, "member").agg(F.min("party").alias("lo"), F.max("party").alias("hi")).filter("lo = hi")
    placed = mentions.select("id", *dict.fromkeys([*scope, *block])).join(first.filter("status = 'resolved'").select("id", "member"), "id").join(party, [*scope, "member"])
    told = placed.groupBy(*block).agg(F.min("lo").alias("told"), F.max("lo").alias("most")).filter("told = most").select(*block, "told")
    again = mentions.filter("party IS NULL").join(first.filter("status <> 'resolved'").select("id"), "id", "left_semi")
    again = again.join(told, block).withColumn("party", F.col("told")).select(mentions.columns)
    second = resolve_members(again, members, scope).filter("status = 'resolved'")
    return first.join(second.select("id"), "id", "left_anti").unionByName(second)


def agreeing(attempts: DataFrame, query: list[str], found: str) -> DataFrame:
    """Of several attempts (both chambers of a joint body) the one answer, if all answers agree."""
    answers = attempts.filter(F.col(found).isNotNull()).groupBy(*query).agg(F.min(found).alias("lo"), F.max(found).alias("hi"))
    return answers.filter("lo = hi").select(*query, F.col("lo").alias(found))


def caucus_party(queries: DataFrame, services: DataFrame, keys: list[str]) -> DataFrame:
    """Of the services that cover ``day`` the latest one's caucus, else its party.

    Of several that begin on one day the greatest party counts, and of those alike in it too one that states a caucus (the greatest).
    """
    met = queries.join(services, keys).filter((F.col("valid_from") <= F.col("day")) & (F.col("valid_to").isNull() | (F.col("day") < F.col("valid_to"))))
    latest = F.max_by(F.coalesce("caucus_code", "party_code"), F.struct("valid_from", "party_code", "caucus_code"))
    return met.groupBy(*keys, "day").agg(latest.alias("caucus"))


def resolve_bodies(asked: DataFrame, index: DataFrame, aliases: DataFrame) -> DataFrame:
    """``asked`` (id, congress, chamber H or S, key) to (id, code): one active body of the chamber or a joint one.

    ``index``: key, code, congresses (array, null: by years), start_year, end_year; ``aliases``:
    congress, key, stands_for, used only where the index lacks the key. Several codes are no answer.
    """
    known = index.select("key").distinct().withColumn("known", F.lit(True))
    keyed = asked.join(known, "key", "left").join(aliases, ["congress", "key"], "left")
    keyed = keyed.select("id", "congress", "chamber", F.when(F.col("known"), F.col("key")).otherwise(F.coalesce("stands_for", "key")).alias("key"))
    met = keyed.join(index, "key").filter((F.substring("code", 1, 1) == F.col("chamber")) | F.col("code").startswith("J"))
    met = met.filter(active_in(F.col("congress"), F.col("congresses"), F.col("start_year"), F.col("end_year")))
    return agreeing(met, ["id"], "code")


def active_in(congress, congresses, start_year, end_year):
    """Listed congresses decide; else the years meet those of the congress, open ends included."""
    first = 1787 + 2 * congress
    years = (F.coalesce(start_year, first) <= first + 1) & (F.coalesce(end_year, first) >= first)
    return F.when(congresses.isNotNull(), F.array_contains(congresses, congress)).otherwise(years)
