"""Appointments and departures in running text: one fold over a text's words.

Each word gets a kind by its form alone (a cue, a title, a word with a capital, 'committee',
'vice' ...). The fold carries the people and bodies that the sentence has named so far, and what
is being read: people, bodies, or people who are replaced. A group is complete when the sentence ends, or when it
goes on to other people ('... to the Committee on A and Mr. Y to the Committee on B') or other
bodies ('Committee on A: Mr. X; Committee on B: Mr. Y'). Nothing counts before a cue was read.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import cues as cu
from .people import STATES

#: Forms of the words that announce an appointment, or that someone leaves a body.
APPOINTS = ["appoint", "appoints", "appointed", "appointing", "appointment", "appointments", "reappoint", "reappoints", "reappointed", "reappointing", "reappointment"]
LEAVES = ["resign", "resigns", "resigned", "resigning", "resignation", "resignations", "withdraw", "withdraws", "withdrew", "withdrawing", "withdrawal", "relinquish", "relinquishes", "relinquished", "relinquishing", "step", "steps", "stepped", "stepping"]
#: Titles that stand before a name, with and without their stop.
TITLES = ["mr.", "mrs.", "ms.", "miss", "dr.", "messrs.", "senator", "senators", "representative", "representatives", "congressman", "congresswoman", "honorable", "hon."]
#: What stands between a name's words, behind it, or before a body's 'committee'.
PARTICLES = ["de", "del", "la", "van", "von", "der", "di", "da"]
SUFFIXES = ["jr", "sr", "ii", "iii", "iv"]
OPENERS = ["permanent", "select", "special", "joint", "standing", "house", "senate"]
BODIES = ["committee", "commission", "caucus", "subcommittee", "board", "council"]
#: Short forms whose stop ends no sentence.
SHORT = ["st.", "mt.", "ft.", "no.", "jr.", "sr.", "hon."]

WORDS = "array<struct<word:string,kind:string,stop:boolean>>"
GROUPS = "array<struct<names:array<string>,bodies:array<string>,replaced:array<string>>>"
STATE = f"struct<live:boolean,reads:string,open:boolean,roster:boolean,plural:boolean,aux:boolean,buf:array<string>,names:array<string>,bodies:array<string>,replaced:array<string>,groups:{GROUPS}>"
_FIELDS = ["live", "reads", "open", "roster", "plural", "aux", "buf", "names", "bodies", "replaced", "groups"]


def _none() -> Column:
    return F.array().cast("array<string>")


def once(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def words(text: Column, cues: list[str]) -> Column:
    """The words of a text with the kind of each, and whether a sentence ends with it."""
    flat = F.regexp_replace(cu.flat(text), r"(?i)\bvice (?=president|chair)", "vice-")
    tokens = F.filter(F.split(F.regexp_replace(flat, r"([,;:()])", " $1 "), " +", -1), lambda w: w != "")

    def kinds(w):
        low = F.lower(w)
        initial = w.rlike(r"^(?:\p{L}\.)+$")
        stop = w.rlike(r"[.!?]$") & ~low.isin(TITLES) & ~low.isin(SHORT) & ~initial
        return once(F.struct(low.alias("low"), F.rtrim(low, F.lit(".!?")).alias("bare"), stop.alias("stop")), lambda f: kind(w, f["low"], f["bare"], f["stop"]))

    def kind(w, low, bare, stop):
        of_form = (
            F.when(bare.isin(cues), "cue").when(low.isin(TITLES), "title").when(bare.isin(SUFFIXES), "suffix")
            .when(bare.isin(["committees", "commissions", "subcommittees"]), "bodies").when(bare.isin(BODIES), "body").when(bare.isin(OPENERS) & w.rlike(r"^\p{Lu}"), "opener")
            .when(low == "vice", "vice").when(bare.isin("resignation", "death", "retirement"), "gone").when(low == "and", "and").when(w == ",", "comma").when(w.isin(";", ")"), "semi").when(w.isin(":"), "colon")
            .when(low.isin("is", "are", "was", "were", "be", "been", "being", "hereby"), "aux").when(low == "of", "of").when(low.isin("on", "the", "for"), "small").when(low.isin(PARTICLES), "particle")
            .when(w.rlike(r"^[\p{Lu}\p{N}#]"), "cap").otherwise("other")
        )
        return F.struct(F.when(stop, F.substring(w, F.lit(1), F.length(w) - 1)).otherwise(w).alias("word"), of_form.alias("kind"), stop.alias("stop"))

    return F.transform(tokens, kinds)


def _holds(buf: Column) -> Column:
    """Whether the body being read has its word 'Committee' yet."""
    return F.exists(buf, lambda x: F.lower(x).isin(BODIES))


def _body(buf: Column) -> Column:
    """A body's words as one label: without open ends and the chamber's own name."""
    whole = F.array_join(buf, " ")
    tail = r"(?i)(?: (?:of the (?:house|senate)(?: of representatives)?|(?:on )?the part of.*|and|on|of|the|for|,))+$"
    whole = F.regexp_replace(F.regexp_replace(whole, " ,", ","), tail, "")
    whole = F.regexp_replace(F.rtrim(whole, F.lit(" ,")), r"^(?:House|Senate) (?=.*(?i:committee|commission|board|council|caucus))", "")
    # 'Rules Committee' and 'Committee on Rules' are one form
    return F.regexp_replace(whole, r"^(?!.*(?i:committee) on )(?!(?:Permanent|Select|Special|Joint|Standing)\b)(.+) Committee$", "Committee on $1")


def _closed(s: Column) -> dict[str, Column]:
    """The state's fields once what is being read is put where it belongs."""
    person = F.array_join(s["buf"], " ")
    state = F.lower(F.regexp_replace(person, r"[^\p{L} ]", "")).isin(sorted(STATES))
    person_ok = s["open"] & (F.length(person) > 2) & person.rlike(r"[ .]") & ~state
    body = _body(s["buf"])
    body_ok = s["open"] & (s["reads"] == "bodies") & _holds(s["buf"]) & body.rlike(r"(?i)\bcommittee on .|. (?:committee|commission|board|council|caucus|subcommittee)\b|\b(?:commission|board|council|caucus) (?:on|for|of) .")
    put = lambda name, ok, value: F.when(ok, F.concat(s[name], F.array(value))).otherwise(s[name])
    name = F.rtrim(F.regexp_replace(person, r" of$", ""), F.lit(" ,"))
    return {
        **{f: s[f] for f in _FIELDS}, "names": put("names", person_ok & (s["reads"] == "names"), name), "replaced": put("replaced", person_ok & (s["reads"] == "replaced"), name),
        "bodies": put("bodies", body_ok, body), "buf": _none(), "open": F.lit(False),
    }


def _struct(fields: dict[str, Column]) -> Column:
    return F.struct(*(fields[f].alias(f) for f in _FIELDS)).cast(STATE)


def _grouped(s: Column, names: Column, replaced: Column, **more: Column) -> Column:
    """The group so far is complete; ``names`` begin the next one."""
    group = F.struct(s["names"].alias("names"), F.array_distinct(s["bodies"]).alias("bodies"), replaced.alias("replaced"))
    groups = F.when(F.size(s["bodies"]) > 0, F.concat(s["groups"], F.array(group))).otherwise(s["groups"])
    return _struct({f: s[f] for f in _FIELDS} | {"groups": groups, "names": names, "bodies": _none(), "replaced": _none(), "roster": F.lit(False), "plural": F.lit(False)} | more)


def _act(s: Column, w: Column) -> Column:
    """What a word does, by its kind and what is being read."""
    kind, body = w["kind"], s["open"] & (s["reads"] == "bodies")
    person = s["open"] & (s["reads"] != "bodies")
    return (
        F.when(kind == "cue", "cue").when(kind == "title", "title").when(kind == "suffix", "suffix")
        .when(~s["live"] & (s["reads"] != "names"), "skip")
        .when(kind.isin("body", "bodies", "opener") & ~s["live"], "close")
        .when(kind == "bodies", "plural").when(kind == "body", F.when(body & ~_holds(s["buf"]), "push").otherwise("begin"))
        .when(kind == "opener", F.when(body & ~_holds(s["buf"]), "push").when(body & (F.lower(F.array_join(F.slice(s["buf"], F.greatest(F.size(s["buf"]) - 1, F.lit(1)), F.lit(2)), " ")) == "of the"), "push").otherwise("begin"))
        .when(kind == "vice", "vice").when(kind == "gone", "gone").when(kind == "colon", "colon").when(kind == "semi", "close")
        .when(kind.isin("and", "comma"), F.when(body & s["plural"], "another").when(body, "push").otherwise("close"))
        .when(kind == "of", F.when(body, "push").when(person & (F.size(s["buf"]) > 0), "push").when(s["reads"] == "replaced", "vice").otherwise("close"))
        .when(kind == "small", F.when(body, "push").otherwise("close"))
        .when(kind == "particle", F.when(person, "push").otherwise("close"))
        .when(kind == "cap", F.when(s["open"], "push").when((s["reads"] == "names") & s["roster"], "name").when(s["live"] & (s["reads"] != "replaced"), "begin").otherwise("skip"))
        .otherwise("close")
    )


def _step(s: Column, w: Column) -> Column:
    """One word: its act, then the end of the sentence if it stands there."""
    return once(_act(s, w), lambda act: once(_moved(s, w, act), lambda n: F.when(w["stop"], _ended(n)).otherwise(n)))


def _moved(s: Column, w: Column, act: Column) -> Column:
    one = F.array(w["word"])
    aux = {"aux": w["kind"] == "aux"}
    same = {f: s[f] for f in _FIELDS}
    lit = F.lit

    def after(c: Column) -> Column:
        """``c`` is the state with what was read put away."""
        now = {f: c[f] for f in _FIELDS} | aux
        told, people = F.size(c["bodies"]) > 0, F.size(c["names"]) > 0
        title = F.when(told & ~c["roster"] & (c["reads"] != "replaced"), _grouped(c, _none(), c["replaced"], reads=lit("names"), open=lit(True), buf=one, **aux)).otherwise(
            _struct(now | {"reads": F.when(c["reads"] == "replaced", "replaced").otherwise("names"), "open": lit(True), "buf": one}))
        reading = {"reads": lit("bodies"), "open": lit(True), "buf": one, "plural": lit(False)}
        # behind 'vice X and Mr. Y to the Committee ...' the last one is appointed himself
        swapped = told & ~c["roster"] & (c["reads"] == "replaced") & (F.size(c["replaced"]) > 1)
        begin = (
            F.when(c["roster"] & people & told, _grouped(c, _none(), c["replaced"], **aux, **reading))
            .when(swapped, _grouped(c, F.slice(c["replaced"], F.size(c["replaced"]), lit(1)), F.slice(c["replaced"], lit(1), F.size(c["replaced"]) - 1), **aux, **reading))
            .otherwise(_struct(now | reading))
        )
        # an active cue makes its subject no appointee; a passive one follows the names
        cue = F.when(c["live"] & told, _grouped(c, _none(), c["replaced"], reads=lit("names"), **aux)).when(c["live"], _struct(now | {"reads": lit("names")})).otherwise(
            _struct(now | {"live": lit(True), "reads": lit("names"), "names": F.when(s["aux"], c["names"]).otherwise(_none()), "roster": lit(False)}))
        return (
            F.when(act == "title", title).when(act == "begin", begin).when(act == "cue", cue)
            .when(act == "plural", once(begin, lambda b: _struct({f: b[f] for f in _FIELDS} | {"plural": lit(True), "buf": F.array(lit("Committee"))})))
            .when(act == "another", _struct(now | {"reads": lit("bodies"), "open": lit(True), "buf": F.array(lit("Committee"), lit("on")), "plural": lit(True)}))
            .when(act == "vice", _struct(now | {"reads": lit("replaced"), "open": lit(True)})).when(act == "gone", _struct(now | {"reads": F.when(told, "replaced").otherwise(c["reads"])}))
            .when(act == "colon", _struct(now | {"reads": lit("names"), "roster": told})).when(act == "name", _struct(now | {"open": lit(True), "buf": one}))
            .otherwise(_struct(now | {"reads": F.when(c["reads"] == "bodies", "names").otherwise(c["reads"])}))
        )

    people = F.when(s["reads"] == "replaced", s["replaced"]).otherwise(s["names"])
    joined = F.when(s["open"] & (F.size(s["buf"]) > 0), _struct(same | {"buf": F.concat(s["buf"], one)}))
    longer = F.concat(F.slice(people, lit(1), F.size(people) - 1), F.array(F.concat(F.element_at(people, -1), lit(", "), F.concat(w["word"], F.when(F.lower(w["word"]).isin("jr", "sr"), ".").otherwise("")))))
    suffix = joined.when(F.size(people) > 0, _struct(same | {"names": F.when(s["reads"] == "replaced", s["names"]).otherwise(longer), "replaced": F.when(s["reads"] == "replaced", longer).otherwise(s["replaced"])})).otherwise(s)
    return (
        F.when(act == "skip", _struct(same | aux)).when(act == "push", _struct(same | aux | {"buf": F.concat(s["buf"], one)})).when(act == "suffix", suffix)
        .otherwise(once(_struct(_closed(s)), after))
    )


def _ended(s: Column) -> Column:
    return once(_struct(_closed(s)), lambda c: _grouped(c, _none(), c["replaced"], live=F.lit(False), reads=F.lit("names"), aux=F.lit(False)))


def groups(text: Column, cues: list[str]) -> Column:
    """GROUPS of a text: names, bodies and replaced people that belong together, in their order.

    A group without a body is none; one without names is kept (a letter of resignation names the bodies only).
    A null, empty or cueless text has none, and is not folded.
    """
    no = F.lit(False)
    start = _struct({"live": no, "reads": F.lit("names"), "open": no, "roster": no, "plural": no, "aux": no, "buf": _none(), "names": _none(), "bodies": _none(), "replaced": _none(), "groups": F.array().cast(GROUPS)})
    said = F.coalesce(F.lower(text).rlike(r"\b(?:" + "|".join(cues) + r")\b"), no)
    return F.when(said, F.aggregate(words(text, cues), start, _step, lambda s: _ended(s)["groups"])).otherwise(F.array().cast(GROUPS))


def appointments(text: Column) -> Column:
    """Groups of at least one name and one body behind a word of appointment."""
    return F.filter(groups(text, APPOINTS), lambda g: F.size(g["names"]) > 0)


def bare_name(name: Column) -> Column:
    """A name without its titles; the State behind 'of' stays."""
    return F.array_join(F.filter(F.split(name, " "), lambda w: ~F.lower(w).isin(TITLES)), " ")


def left_bodies(text: Column) -> Column:
    """All bodies that a text says somebody leaves, each once, in their order."""
    bodies = F.flatten(F.transform(groups(text, LEAVES), lambda g: g["bodies"]))
    key = lambda b: F.regexp_replace(F.lower(b), r"\b(?:committee on|the)\b|[^\p{L}\p{N}]", "")
    # an unnamed expression would be folded anew for each body
    first = lambda found, keys: F.filter(found, lambda b, i: F.array_position(keys, F.get(keys, i)) == i + 1)
    return once(bodies, lambda found: once(F.transform(found, key), lambda keys: first(found, keys)))


#: What a State stands behind when a member's text names it.
_STATE_NAMES = "|".join(sorted((n.replace(" ", r"\s+") for n in STATES), key=len, reverse=True))


def state_beside(text: Column, member: Column) -> Column:
    """The State a text names with a member: 'X of S', 'X, a Representative from S', or 'from S (X'; its name in small letters, null if none."""
    low = F.lower(cu.flat(text))
    # the surname is enough: titles and given names differ between a heading and a text
    last = F.lower(F.element_at(F.split(F.trim(F.regexp_replace(F.substring_index(cu.flat(member), ",", 1), r" of .*$", "")), " "), -1))
    at = F.instr(low, last)
    ahead = F.substring(low, at + F.length(last), F.length(low))
    back = F.substring(low, F.lit(1), at - 1)
    follows = F.regexp_extract(ahead, rf"^,?\s*(?:jr\.|sr\.|ii|iii)?,?\s*(?:of|(?:a\s+)?(?:representative|senator|member|delegate)\s+from|from)\s+(?:the\s+)?(?:state\s+of\s+)?({_STATE_NAMES})\b", 1)
    stands = F.regexp_extract(back, rf"\bfrom\s+(?:the\s+state\s+of\s+)?({_STATE_NAMES})\s*\((?:[\p{{L}}.]+\s+)*$", 1)
    found = F.coalesce(F.nullif(follows, F.lit("")), F.nullif(stands, F.lit("")))
    return F.when((F.length(last) > 0) & (at > 0), F.regexp_replace(found, r"\s+", " "))
