"""Resolution by ordered attempts: each row brings its keys in order, all are looked up in one join, and the first that answers counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import people as pp
from ..functions.clauses import once
from .resolve import active_in

#: What a body's name may begin with, the first that fits being cut.
PREFIXES = [
    "joint committee of congress on ",
    "joint committee on the ",
    "joint committee on ",
    "select committee on ",
    "special committee on ",
    "committee of the ",
    "committee of ",
    "committee on the ",
    "committee on ",
    "standing committee on the ",
    "standing committee on ",
]


def _blanks(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def index_key(name: Column) -> Column:
    """A body's name without 'Committee on', 'Committee of' and 'the' in this order, in small letters and digits only."""
    low = F.lower(_blanks(F.regexp_replace(name, r":\s*$", "")))
    for word in ("committee on ", "committee of ", "the "):
        low = F.when(low.startswith(word), F.ltrim(F.substring(low, F.lit(len(word) + 1), F.length(low)))).otherwise(low)
    return F.regexp_replace(low, "[^a-z0-9]", "")


def matcher_key(name: Column) -> Column:
    """Small letters, straight apostrophes, single blanks, and no prefix of PREFIXES; null if nothing is left."""
    low = F.lower(_blanks(F.translate(name, "’‘", "''")))
    cut = F.coalesce(*(F.when(low.startswith(p), F.substring(low, F.lit(len(p) + 1), F.length(low))) for p in PREFIXES), low)
    return F.nullif(F.btrim(F.trim(cut), F.lit(".:")), F.lit(""))


def compressed(key: Column) -> Column:
    """A matcher's key without blanks, commas and apostrophes, as scanned pages lose them."""
    return F.regexp_replace(key, r"[\s',]+", "")


def body_index(records: DataFrame) -> DataFrame:
    """key, code, congresses, start_year, end_year: a record under the key of each of its names.

    ``records``: code, name, other_names (array), congresses, start_year, end_year. Records without a code or
    name are left out, and so are names without a letter or digit.
    """
    names = F.concat(F.array("name"), F.coalesce("other_names", F.array().cast("array<string>")))
    keys = F.array_distinct(F.filter(F.transform(names, index_key), lambda k: k.isNotNull() & (k != "")))
    held = records.filter("code IS NOT NULL AND name IS NOT NULL AND name <> ''")
    return held.select(F.explode(keys).alias("key"), "code", "congresses", "start_year", "end_year")


def _lookups(index: DataFrame, aliases: DataFrame, named: DataFrame) -> DataFrame:
    """space, key, code, place, and what limits an answer: one table for all attempts.

    Spaces: index, and of each scope H, S or J the named bodies' exact keys (H) and compressed ones (H~).
    """
    limits = ["congresses", "start_year", "end_year"]
    none = {"congresses": F.lit(None).cast("array<int>"), "start_year": F.lit(None).cast("int"), "end_year": F.lit(None).cast("int"), "only": F.lit(None).cast("int")}
    plain = index.select(F.lit("index").alias("space"), "key", "code", F.lit(0).alias("place"), *limits, none["only"].alias("only"))
    # an alias holds in its congress, and only where the index lacks its key
    lacking = aliases.join(index.select("key").distinct(), "key", "left_anti").select(F.col("congress").alias("only"), "key", "stands_for")
    by_alias = lacking.join(index.withColumnRenamed("key", "stands_for"), "stands_for").select(F.lit("index").alias("space"), "key", "code", F.lit(0).alias("place"), *limits, "only")
    rows = named.select("scope", F.col("key"), "code", "place").withColumns(none)
    exact = rows.select(F.col("scope").alias("space"), "key", "code", "place", *limits, "only")
    close = rows.select(F.concat("scope", F.lit("~")).alias("space"), compressed(F.col("key")).alias("key"), "code", "place", *limits, "only")
    return plain.unionByName(by_alias).unionByName(exact).unionByName(close)


def resolve_bodies_fallback(asked: DataFrame, index: DataFrame, aliases: DataFrame, named: DataFrame) -> DataFrame:
    """``asked`` (id, congress, chamber H or S, text) to (id, code, attempt): the first attempt that has an answer.

    Attempts 1 and 2 ask the index (one active body of the chamber or a joint one, several being no answer) for the
    text as it is and without a leading 'House' or 'Senate'; then both forms, each through the chamber's named bodies,
    the joint ones, and both again by compressed keys, where the smallest ``place`` wins. ``index``: see body_index;
    ``aliases``: congress, key, stands_for; ``named``: scope, key (as matcher_key), code, place. Ids without an answer are left out.
    """
    bare = F.regexp_replace("text", r"^(?i:house|senate)\s+", "")
    attempt = lambda n, space, key: F.struct(F.lit(n).alias("attempt"), space.alias("space"), key.alias("key"))
    lit = F.lit
    tries = [attempt(1 + i, lit("index"), index_key(form)) for i, form in enumerate((F.col("text"), bare))]
    for i, form in enumerate((F.col("text"), bare)):
        key = matcher_key(form)
        spaces = ((F.col("chamber"), key), (lit("J"), key), (F.concat("chamber", lit("~")), compressed(key)), (lit("J~"), compressed(key)))
        tries += [attempt(3 + 4 * i + n, space, k) for n, (space, k) in enumerate(spaces)]
    # the second form is tried only where it differs
    tries = [F.when((bare != F.col("text")) if n in (1, 6, 7, 8, 9) else lit(True), t) for n, t in enumerate(tries)]
    rows = asked.select("id", "congress", "chamber", F.explode(F.array_compact(F.array(*tries))).alias("t")).select("id", "congress", "chamber", "t.*").filter("key <> ''")
    met = rows.join(_lookups(index, aliases, named), ["space", "key"])
    fits = (F.substring("code", 1, 1) == F.col("chamber")) | F.col("code").startswith("J")
    active = active_in(F.col("congress"), F.col("congresses"), F.col("start_year"), F.col("end_year"))
    in_index = F.col("space") == "index"
    met = met.filter(~in_index | (fits & active & (F.col("only").isNull() | (F.col("only") == F.col("congress")))))
    answers = met.groupBy("id", "attempt").agg(F.min("code").alias("lo"), F.max("code").alias("hi"), F.min_by("code", F.struct("place", "code")).alias("first"))
    answers = answers.filter((F.col("attempt") > 2) | (F.col("lo") == F.col("hi")))
    return answers.groupBy("id").agg(F.min_by("first", "attempt").alias("code"), F.min("attempt").alias("attempt"))


def peeled(raw: Column) -> tuple[Column, Column]:
    """(name, State's code) of 'Mr. X (Y) (SD)' or 'X of State'.

    The brackets at the end are taken off from right to left; the first of two letters is the State. A State behind
    'of' counts where no bracket has one, and is cut in any case, known or not. One leading title goes.
    """
    def parts(text: Column) -> Column:
        tail = F.regexp_extract(text, r"((?:\s*\([^()]*\))+)$", 1)
        inside = F.transform(F.regexp_extract_all(tail, F.lit(r"\(([^()]*)\)"), F.lit(1)), lambda g: F.trim(g))
        code = F.aggregate(F.reverse(inside), F.lit(None).cast("string"), lambda held, g: F.coalesce(held, F.when(g.rlike("^[A-Za-z]{2}$"), F.upper(g))))
        core = pp.without_title(F.rtrim(F.substring(text, F.lit(1), F.length(text) - F.length(tail))))
        return once(F.struct(code.alias("code"), core.alias("core"), F.regexp_extract(core, r"\b(?i:of)\s+([A-Za-z][A-Za-z\s]+)$", 1).alias("of")), named)

    def named(p: Column) -> Column:
        cut = F.when(p["of"] != "", F.regexp_replace(p["core"], r"\s*\b(?i:of)\s+[A-Za-z][A-Za-z\s]+$", "")).otherwise(p["core"])
        return F.struct(F.btrim(cut, F.lit(" ,.;:")).alias("name"), F.coalesce(p["code"], F.when(p["of"] != "", pp.state_code(p["of"]))).alias("state"))

    whole = once(F.btrim(_blanks(raw), F.lit(" ,.;:")), parts)
    return whole["name"], whole["state"]


def name_forms(core: Column) -> Column:
    """The forms by which a name is looked up, in their order: the whole of it, then its last word."""
    return F.filter(F.array_distinct(F.array(core, F.element_at(F.split(core, " "), -1))), lambda c: c != "")


def resolve_senators(asked: DataFrame, members: DataFrame) -> DataFrame:
    """``asked`` (id, congress, raw, parties) to (id, member, form, candidates, by).

    ``members``: congress, member, last_name, state, gender, party. The first form that meets a surname
    exactly (letters' case and accents count) gives the candidates, in the State if one is told. A single one is the member;
    of several the title's gender and then ``parties`` (an array; null asks for none) narrow what is left, each only
    where it leaves someone, and the member is told where one of them leaves one (by: name, gender, party; null: open).
    Ids that meet nobody have 0 candidates and no member.

    Rows alike in all but their id are one question, and members alike in all but their name are one class with its number.
    """
    asks = ["congress", "raw", "parties"]
    name, state = peeled(F.col("raw"))
    rows = asked.select(*asks).distinct().select(*asks, pp.gender_of_title(F.col("raw")).alias("title_gender"), state.alias("state"), name.alias("name"))
    rows = rows.select(*asks, "title_gender", "state", F.posexplode(name_forms(F.col("name"))).alias("nth", "form"))
    # a member who sits for several States is one candidate
    held = members.groupBy("congress", F.col("last_name").alias("form"), "member", "gender", "party").agg(F.array_sort(F.collect_set("state")).alias("states"))
    held = held.groupBy("congress", "form", "gender", "party", "states").agg(F.count("*").alias("n"), F.min("member").alias("one"))
    met = rows.join(held, ["congress", "form"]).filter(F.col("state").isNull() | F.array_contains("states", F.col("state")))
    alike, sided = (F.coalesce(c, F.lit(False)) for c in (F.col("gender") == F.col("title_gender"), F.array_contains("parties", F.col("party"))))
    met = met.select(*asks, "nth", "form", "n", "one", alike.alias("alike"), sided.alias("sided"))
    # of all candidates, those alike in gender, the party's, and the party's of those alike: how many they are, and one of them
    parts = {"all": F.lit(True), "alike": F.col("alike"), "sided": F.col("sided"), "both": F.col("alike") & F.col("sided")}
    sums = [f for p, when in parts.items() for f in (F.sum(F.when(when, F.col("n")).otherwise(0)).cast("int").alias(f"n_{p}"), F.min(F.when(when, F.col("one"))).alias(f"one_{p}"))]
    of_form = met.groupBy(*asks, "nth", "form").agg(*sums)
    n_left, one_left = (F.when(F.col("n_alike") > 0, F.col(f"{c}_both")).otherwise(F.col(f"{c}_sided")) for c in ("n", "one"))
    by = F.when(F.col("n_all") == 1, "name").when(F.col("n_alike") == 1, "gender").when(n_left == 1, "party")
    member = F.when(by == "name", F.col("one_all")).when(by == "gender", F.col("one_alike")).when(by == "party", one_left)
    answer = F.struct(member.alias("member"), "form", F.col("n_all").alias("candidates"), by.alias("by"))
    best = of_form.groupBy(*(F.col(c).alias(f"_{c}") for c in asks)).agg(F.min_by(answer, "nth").alias("b"))
    out = asked.select("id", *asks).join(best, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in asks], "left")
    return out.select("id", "b.member", "b.form", F.coalesce("b.candidates", F.lit(0)).alias("candidates"), "b.by")
