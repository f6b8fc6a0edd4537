"""Events announced in proceedings, as column expressions.

``kind`` says which branch an item belongs to by its cues; the other functions read
that branch's fields by the words beside them, null where a text doesn't state them.
All of it runs inside the JVM, so one pass over the items serves every branch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import clauses as cl
from . import cues as cu
from . import text as tx

#: Wordings that announce each kind, tried in this order; % stands for anything between.
KINDS = [
    ("death", ["%death of the honorable%", "%death of the late%", "%death of representative%", "%death of senator%", "%passing of the honorable%", "%passing of representative%", "%passing of senator%"]),
    ("house resignation", ["%resignation from the house of representatives%"]),
    ("senate exit", ["%resignation from former senator%", "%vacancy%caused by the resignation of%", "%vacancy%created by the resignation of%", "%vacancy%caused by the death of%", "%vacancy%created by the death of%"]),
    ("speaker", ["%is duly elected speaker of the house%", "%has been elected speaker of the house%"]),
    ("transfer", ["%relieved from%appointed to%", "%relieved from%transferred to%", "%transferred to the committee on%", "%transferred to committee on%"]),
    ("committee departure", ["%resign%committee on%", "%withdr_w%committee on%", "%step% down%committee on%", "%relinquish%committee on%"]),
    ("appointment", ["%appoint%committee%", "%committee%appoint%"]),
]

#: Vacancies are no news of a death itself.
VACANCY = ["%vacancy%by the death of%", "%vacancy%by the passing of%"]


def kind(text: Column) -> Column:
    """The branch of an item, 'other' if none; a null text is 'other' too."""
    low = F.lower(cu.flat(text))
    out = F.when(F.lit(False), "")
    for name, wordings in KINDS:
        said = _any(low, wordings)
        out = out.when(said & ~_any(low, VACANCY) if name == "death" else said, name)
    return out.otherwise("other")


def _any(low: Column, wordings: list[str]) -> Column:
    found = low.like(wordings[0])
    for w in wordings[1:]:
        found = found | low.like(w)
    return found


def effective_day(text: Column, printed: Column) -> Column:
    """The date behind 'effective' in its sentence, however long, else the first date, else the day of printing."""
    stated = cu.behind(cu.flat(text), "effective")
    near = F.regexp_extract(stated, r"^[^.;]*", 0)
    return F.coalesce(tx.long_date(near), tx.long_date(cu.flat(text)), printed)


def house_member(text: Column) -> Column:
    """Who resigns from the House: the signature, else the name behind 'I,'."""
    return F.coalesce(cu.signature(text), cu.leading_name(cu.behind(cu.flat(text), " I, ")))


def senate_member(text: Column) -> Column:
    """The Senator whose resignation or death left a vacancy, without titles and state."""
    return cu.leading_name(cu.behind(cu.flat(text), "resignation from former", "by the resignation of", "by the death of"))


def speaker_member(text: Column) -> Column:
    """Who is elected Speaker: named as Honorable, or before 'a Representative from'."""
    flat = cu.flat(text)
    return F.coalesce(cu.leading_name(cu.behind(flat, "the Honorable ")), cu.trailing_name(cu.before(flat, ", a Representative from")))


def dead_member(text: Column) -> Column:
    return cu.leading_name(cu.behind(cu.flat(text), "death of the late", "death of the", "death of", "passing of the", "passing of"))


def transfer_member(text: Column) -> Column:
    """Who asks for a transfer, or for whom one is asked (the name in brackets behind a State)."""
    flat = F.concat(F.lit(" "), cu.flat(text))
    return F.coalesce(cu.signature(text), cu.leading_name(cu.behind(flat, " I, ")), cu.leading_name(cu.behind(flat, "(Mr. ", "(Mrs. ", "(Ms. ")))


def transfer_from(text: Column) -> Column:
    return cu.leading_body(cu.behind(cu.flat(text), "relieved from"))


def transfer_to(text: Column) -> Column:
    return cu.leading_body(cu.behind(cu.flat(text), "appointed to", "transferred to"))


def departure_columns(text: Column, printed: Column) -> dict[str, Column]:
    """kind, member, from_body, to_body and effective of each item.

    ``effective`` is null where no member is found, as such an item gives no event.
    A transfer without a new committee has no member either.
    """
    k = kind(text)
    moved = F.when(transfer_to(text).isNotNull(), transfer_member(text))
    member = F.when(k == "house resignation", house_member(text)).when(k == "senate exit", senate_member(text)).when(k == "speaker", speaker_member(text)).when(k == "transfer", moved)
    return {
        "kind": k, "member": member,
        "from_body": F.when((k == "transfer") & member.isNotNull(), transfer_from(text)), "to_body": F.when((k == "transfer") & member.isNotNull(), transfer_to(text)),
        "effective": F.when(member.isNotNull(), effective_day(text, printed)),
    }


EVENTS = "array<struct<action:string,member:string,body:string,effective:date,scope:string>>"


def with_events(df: DataFrame, text: str, printed: Column, to: str = "events") -> DataFrame:
    """``df`` and all events of each item: array of (action, member, body, effective, scope).

    A death, an exit and an election of the Speaker end every seat (scope 'chamber'); a
    transfer ends one seat (or, without a committee named, all but the new one) and begins
    another; a departure ends those of all bodies it names; an appointment begins one for each of its
    names and bodies, and ends those of the people it replaces. Items without a member give no event; a transfer counts only with its new committee.
    What several branches read is computed once, in columns that are dropped again.
    """
    raw, flat, k = F.col(text), F.col("ev_flat"), F.col("ev_kind")
    # a field is read only of the kinds that use it
    of = lambda name, value: F.when(k == name, value)
    fields = {
        "day": F.when(k != "other", effective_day(flat, printed)), "signed": of("committee departure", F.coalesce(house_member(raw), transfer_member(raw))), "house": of("house resignation", house_member(raw)), "senate": of("senate exit", senate_member(flat)),
        "speaker": of("speaker", speaker_member(flat)), "dead": of("death", dead_member(flat)), "moved": of("transfer", transfer_member(raw)), "start": of("transfer", transfer_to(flat)), "end": of("transfer", transfer_from(flat)),
        "left": of("committee departure", cl.left_bodies(flat)), "groups": of("appointment", cl.appointments(flat)),
    }
    staged = df.withColumn("ev_flat", cu.flat(raw)).withColumn("ev_kind", kind(flat)).withColumns({f"ev_{name}": c for name, c in fields.items()})
    fields["kind"] = k
    ev = {name: F.col(f"ev_{name}") for name in fields}
    none, chamber, committee = F.lit(None).cast("string"), F.lit("chamber"), F.lit("committee")
    one = lambda action, member, body, scope: F.struct(F.lit(action).alias("action"), member.alias("member"), body.alias("body"), ev["day"].alias("effective"), scope.alias("scope"))
    seats = lambda action, people, g: F.flatten(F.transform(people, lambda p: F.transform(g["bodies"], lambda b: one(action, cl.bare_name(p), b, committee))))
    found = (
        F.when(ev["kind"] == "death", F.array(one("REMOVED", ev["dead"], none, chamber)))
        .when(ev["kind"] == "house resignation", F.array(one("REMOVED", ev["house"], none, chamber)))
        .when(ev["kind"] == "senate exit", F.array(one("REMOVED", ev["senate"], none, chamber)))
        .when(ev["kind"] == "speaker", F.array(one("REMOVED", ev["speaker"], none, chamber)))
        .when((ev["kind"] == "transfer") & ev["start"].isNotNull(), F.array(one("REMOVED", ev["moved"], ev["end"], F.when(ev["end"].isNull(), "all but new").otherwise("committee")), one("APPOINTED", ev["moved"], ev["start"], committee)))
        .when(ev["kind"] == "committee departure", F.transform(ev["left"], lambda b: one("REMOVED", ev["signed"], b, committee)))
        .when(ev["kind"] == "appointment", F.flatten(F.transform(ev["groups"], lambda g: F.concat(seats("APPOINTED", g["names"], g), seats("REMOVED", g["replaced"], g)))))
    )
    whole = F.filter(found, lambda e: e["member"].isNotNull() & ((e["scope"] != "committee") | e["body"].isNotNull()))
    out = staged.withColumn(to, F.coalesce(whole, F.array().cast(EVENTS)))
    return out.drop("ev_flat", *(f"ev_{name}" for name in fields))
