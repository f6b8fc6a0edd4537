"""Member slots, assignment blocks and events of proceedings on made-up texts."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.functions import clauses as cl
from tidemark.functions import departures as dp
from tidemark.functions import slots as sl
from tidemark.sources import assignments

#: A resolution of two sections of one kind, a list by paragraphs and a sentence of removal.
BODY = """<section><committee-appointment-paragraph><header>Committe on Harbours:</header><text>Mr. Vane and Ms. Oakes.</text></committee-appointment-paragraph></section>
<section><text>These members are removed:</text><subsection><header>Committee on the Tides</header><paragraph><text>Mr. Ash, Jr.</text></paragraph><paragraph><text>Mrs. Elm</text></paragraph></subsection></section>
<section><paragraph><text>Ms. Fern be, and is hereby, removed from the Committee on Harbours and the Committee on the Tides.</text></paragraph></section>"""


def written(folder, name, body, date):
    (folder / name).write_text(f"<resolution><form><legis-num>H. RES. 7</legis-num>{date}</form><resolution-body>{body}</resolution-body></resolution>")


@pytest.mark.parametrize(
    ("text", "slots"),
    [
        ("Mr. Vane", [("Mr. Vane", None)]),
        ("Mr. Vane, Ms. Oakes and Mrs. Elm.", [("Mr. Vane", None), ("Ms. Oakes", None), ("Mrs. Elm", None)]),
        ("Ms. Oakes of West Moor; Mr. Ash, Jr.; and Mr. B. Reed", [("Ms. Oakes of West Moor", None), ("Mr. Ash, Jr.", None), ("Mr. B. Reed", None)]),
        ("Mr. Vane, after Ms. Oakes, and Mr. Ash (to rank at once after Mr. Pine, Sr.)", [("Mr. Vane", "Ms. Oakes"), ("Mr. Ash", "Mr. Pine, Sr.")]),
        ("Mrs. Elm (when sworn in), Mr. Vane", [("Mrs. Elm", None), ("Mr. Vane", None)]),
        ("after Mr. Vane, to rank anywhere", []),
        (" ,; ", []),
        ("", []),
        (None, []),
    ],
)
def test_slots(spark, text, slots):
    row = spark.createDataFrame([(text,)], "t string").select(sl.member_slots(F.col("t")).alias("s")).first()
    assert [(s["name"], s["rank_after"]) for s in row.s] == slots


def test_headers(spark):
    df = spark.createDataFrame([("Comitee on Oars : ",), ("Committee on Sails",), ("Commission on Oars",), ("",)], "h string")
    assert [r[0] for r in df.select(sl.header_body(F.col("h"))).collect()] == ["Committee on Oars", "Committee on Sails", "Commission on Oars", ""]


def test_layouts_actions_and_visible_date(spark, tmp_path):
    written(tmp_path, "a-eh.xml", BODY, '<action-date date="20210101">March 4, 2021</action-date>')
    written(tmp_path, "b-eh.xml", BODY, "")
    blocks = assignments.assignment_blocks(spark, str(tmp_path))
    assert {r.day for r in blocks.collect()} == {dt.date(2021, 3, 4)}
    got = [(r.body, r.ordinal, r.name, r.action) for r in assignments.assignment_slots(blocks).orderBy("block", "body", "ordinal").collect()]
    assert got == [
        ("Committee on Harbours", 1, "Mr. Vane", "APPOINTED"), ("Committee on Harbours", 2, "Ms. Oakes", "APPOINTED"),
        ("Committee on the Tides", 1, "Mr. Ash, Jr.", "REMOVED"), ("Committee on the Tides", 2, "Mrs. Elm", "REMOVED"),
        ("Committee on Harbours", 1, "Ms. Fern", "REMOVED"), ("Committee on the Tides", 1, "Ms. Fern", "REMOVED"),
    ]
    tracked = spark.createDataFrame([("tides",)], "key string")
    assert {r.body for r in assignments.assignment_slots(blocks, tracked).collect()} == {"Committee on the Tides"}


EVENTS = [
    ("A letter of resignation from the House of Representatives was read:\nI leave my seat, effective at noon\non May 9, 2022.\nYours sincerely,\n\nAnn B. Vane,\nMember.", [("REMOVED", "Ann B. Vane", None, dt.date(2022, 5, 9), "chamber")]),
    ("The vacancy in the commission created by the resignation of Senator Oakes of West Moor stays open.", [("REMOVED", "Oakes", None, dt.date(2020, 1, 1), "chamber")]),
    ("We learnt of the passing of the Honorable Tom Reed on June 2, 2019.", [("REMOVED", "Tom Reed", None, dt.date(2019, 6, 2), "chamber")]),
    ("Lee Pine, a Representative from Fenland, has been elected Speaker of the House.", [("REMOVED", "Lee Pine", None, dt.date(2020, 1, 1), "chamber")]),
    ("Sir, I, Cy Ash, ask to be relieved from the Committee on Oars and transferred to the Committee on Sails, please.", [("REMOVED", "Cy Ash", "Committee on Oars", dt.date(2020, 1, 1), "committee"), ("APPOINTED", "Cy Ash", "Committee on Sails", dt.date(2020, 1, 1), "committee")]),
    ("Moved that the gentleman from Fenland (Mr. Reed) be transferred to the Committee on Sails.", [("REMOVED", "Reed", None, dt.date(2020, 1, 1), "all but new"), ("APPOINTED", "Reed", "Committee on Sails", dt.date(2020, 1, 1), "committee")]),
    ("I resign from the Committee on Oars and Tides effective July 1, 2021.\nRespectfully,\nMay Elm", [("REMOVED", "May Elm", "Committee on Oars and Tides", dt.date(2021, 7, 1), "committee")]),
    ("The Chair appoints Ms. Fern to the Committee on Sails, vice Mr. Vane.", [("APPOINTED", "Fern", "Committee on Sails", dt.date(2020, 1, 1), "committee"), ("REMOVED", "Vane", "Committee on Sails", dt.date(2020, 1, 1), "committee")]),
    ("The Chair appoints Ms. Fern of West Moor and Mr. Ash to the Committee on Sails and the Committee on Oars.", [("APPOINTED", n, b, dt.date(2020, 1, 1), "committee") for n in ("Fern of West Moor", "Ash") for b in ("Committee on Sails", "Committee on Oars")]),
    ("I resign from the Committee on Oars and the Committee on Sails.\nRespectfully,\nMay Elm", [("REMOVED", "May Elm", b, dt.date(2020, 1, 1), "committee") for b in ("Committee on Oars", "Committee on Sails")]),
    ("I withdraw from the Committee on Oars, effective, as my doctors and all of my staff and my dear family have urged me for so many years to do without any further delay or doubt, on June 3, 2021.\nSincerely,\nMay Elm", [("REMOVED", "May Elm", "Committee on Oars", dt.date(2021, 6, 3), "committee")]),
    ("It was referred to the Committee on Rules, vice President Gale presiding, and an appointment was made.", []),
    ("I, Cy Ash, ask to be relieved from the Committee on Oars and appointed elsewhere.", []),
    ("The harbour was calm.", []),
    ("", []),
    (None, []),
]


def test_events(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(EVENTS)], "i int, t string")
    rows = dp.with_events(df, "t", F.lit("2020-01-01").cast("date"), "e").orderBy("i").collect()
    assert [[(e.action, e.member, e.body, e.effective, e.scope) for e in r.e] for r in rows] == [want for _, want in EVENTS]


CLAUSES = [
    ("The Speaker appoints Mr. Low and Mrs. Ash to the Committee on Sails, vice Mrs. Gone.", [(["Mr. Low", "Mrs. Ash"], ["Committee on Sails"], ["Mrs. Gone"])]),
    ("Mr. Reed spoke. The Chair appointed Mr. TARN, Mr. HECK, and Ms. B. PINE to the Permanent Select Committee on Signals.", [(["Mr. TARN", "Mr. HECK", "Ms. B. PINE"], ["Permanent Select Committee on Signals"], [])]),
    ("The Chair appoints these Members to the Committee on Oars: Mr. COLE, Mr. BURR of New York, and Jane Z. Roe, Ohio. The Committee on Nets met.", [(["Mr. COLE", "Mr. BURR of New York", "Jane Z. Roe"], ["Committee on Oars"], [])]),
    ("The Chair appointed Mr. Vane of Ohio Mr. Ash of Texas Ms. Elm of New York to the Committee on Oars.", [(["Mr. Vane of Ohio", "Mr. Ash of Texas", "Ms. Elm of New York"], ["Committee on Oars"], [])]),
    ("The Chair appoints Mr. A. Low, Jr., to the Committee on Oars and the Committee on Sails and Ms. Fern to the Committees on Tides and Winds, vice Mr. Old and Mr. Ash to the Committee on Nets during the session.",
     [(["Mr. A. Low, Jr."], ["Committee on Oars", "Committee on Sails"], []), (["Ms. Fern"], ["Committee on Tides", "Committee on Winds"], ["Mr. Old"]), (["Mr. Ash"], ["Committee on Nets"], [])]),
    ("Mr. Low and Ms. de la Fern were appointed to the Committee on Banking, Housing, and Urban Affairs of the House.", [(["Mr. Low", "Ms. de la Fern"], ["Committee on Banking, Housing, and Urban Affairs"], [])]),
    ("The Chair, Mr. Host, appoints Ms. Fern a member of the Committee on the Tides to fill the vacancy caused by the resignation of Mr. Gone of Ohio.", [(["Ms. Fern"], ["Committee on the Tides"], ["Mr. Gone of Ohio"])]),
    ("The Chair appoints to the Committee on Oars: Mr. Low; to the Committee on Sails: Mr. Ash and Ms. Elm.", [(["Mr. Low"], ["Committee on Oars"], []), (["Mr. Ash", "Ms. Elm"], ["Committee on Sails"], [])]),
    ("The Chair appoints Ms. Fern to the Rules Committee.", [(["Ms. Fern"], ["Committee on Rules"], [])]),
    ("Mr. Low was disappointed by the Committee on Rules.", []),
    ("The appointment of Mr. Low pleased us. The Committee on Rules met with Ms. Fern.", []),
    ("appointed", []), ("", []), (None, []),
]


def test_clauses(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(CLAUSES)], "i int, t string")
    rows = df.select("i", cl.appointments(F.col("t")).alias("g")).orderBy("i").collect()
    assert [[(g.names, g.bodies, g.replaced) for g in r.g] for r in rows] == [want for _, want in CLAUSES]


def test_a_long_text_is_read_whole(spark):
    text = "Word and more, of the Kind. " * 3000 + "The Chair appoints Mr. Low to the Committee on Oars." + " Then others spoke." * 3000
    row = spark.createDataFrame([(text,)], "t string").select(cl.appointments(F.col("t")).alias("g")).first()
    assert [(g.names, g.bodies) for g in row.g] == [(["Mr. Low"], ["Committee on Oars"])]


def test_left_bodies_and_states(spark):
    texts = [
        ("the following resignations as a member of the Committee on the Tides and the Committee on Oars and Nets: I hereby resign my seats on the House Tides Committee and the House Committee on Oars and Nets.", ["Committee on the Tides", "Committee on Oars and Nets"]),
        ("I am stepping down from the Rules Committee. I thank the Committee on Nets.", ["Committee on Rules"]),
        ("The Committee on Nets met.", []), (None, []),
    ]
    rows = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(texts)], "i int, t string").select("i", cl.left_bodies(F.col("t")).alias("b")).orderBy("i").collect()
    assert [r.b for r in rows] == [want for _, want in texts]
    states = [("The gentleman from New York (Mr. Low) rose", "Mr. Low", "new york"), ("Mr. LOW of Ohio rose", "John Low", "ohio"), ("Pat Low, a Representative from West Virginia, rose", "Low", "west virginia"), ("Low of the hills", "Low", None), ("x", "Low", None), (None, "Low", None), ("Low of Ohio", None, None)]
    rows = spark.createDataFrame([(i, *s[:2]) for i, s in enumerate(states)], "i int, t string, m string").select("i", cl.state_beside(F.col("t"), F.col("m")).alias("s")).orderBy("i").collect()
    assert [r.s for r in rows] == [s[2] for s in states]
