"""Bundles, workbooks and REST listings."""

import json
import zipfile

import pytest

from tidemark.sources import archives, rest


def test_bundle_has_fixed_bytes_and_comes_back(tmp_path):
    (tmp_path / "x").write_text("one")
    (tmp_path / "y").write_text("two")
    files = {"b/y.txt": str(tmp_path / "y"), "a.txt": str(tmp_path / "x")}
    for name in ("1.zip", "2.zip"):
        archives.write_bundle(files, str(tmp_path / name))
    assert (tmp_path / "1.zip").read_bytes() == (tmp_path / "2.zip").read_bytes()
    assert archives.extract_bundle(str(tmp_path / "1.zip"), str(tmp_path / "out")) == ["a.txt", "b/y.txt"]
    assert (tmp_path / "out/b/y.txt").read_text() == "two"


@pytest.mark.parametrize("name", ["../up", "/root", "a/../../b", "c:\\x"])
def test_unsafe_names_write_nothing(tmp_path, name):
    with zipfile.ZipFile(tmp_path / "z.zip", "w") as out:
        out.writestr("good", "x")
        out.writestr(name, "x")
    with pytest.raises(ValueError):
        archives.extract_bundle(str(tmp_path / "z.zip"), str(tmp_path / "out"))
    assert not (tmp_path / "out").exists()


def test_links_and_sizes_are_refused(tmp_path):
    with zipfile.ZipFile(tmp_path / "z.zip", "w") as out:
        link = zipfile.ZipInfo("link")
        link.external_attr = 0o120777 << 16
        out.writestr(link, "/etc")
    with pytest.raises(ValueError):
        archives.extract_bundle(str(tmp_path / "z.zip"), str(tmp_path))
    with pytest.raises(ValueError):
        archives.extract_bundle(str(tmp_path / "z.zip"), str(tmp_path), most_bytes=1)


def test_workbook_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(2, "a & <b>", 1.5), (1, None, None)], "id int, name string, pct double")
    empty = df.filter("id > 9")
    for name in ("1.xlsx", "2.xlsx"):
        archives.write_workbook({"rows": (df, ["id"]), "none": (empty, ["id"])}, str(tmp_path / name))
    assert (tmp_path / "1.xlsx").read_bytes() == (tmp_path / "2.xlsx").read_bytes()
    assert archives.read_workbook(str(tmp_path / "1.xlsx")) == {"rows": [["id", "name", "pct"], ["1", "", ""], ["2", "a & <b>", "1.500"]], "none": [["id", "name", "pct"]]}


def test_pages_retry_and_cycles():
    waits, answers = [], {"a": [(429, {"Retry-After": "3"}, b""), (503, {}, b""), (200, {}, b'{"rows": [1], "nextPage": "b"}')], "b": [(200, {}, b'{"rows": [2], "nextPage": "a"}')]}
    fetch = lambda u: answers[u].pop(0)
    found = rest.pages("a", fetch, "rows", sleep=waits.append)
    assert [next(found), next(found)] == [1, 2]
    with pytest.raises(RuntimeError):
        next(found)
    assert waits == [3.0, 2.0]


def test_listing_rows(spark):
    def fetch(url):
        page = {"rows": [{"id": url + "1"}], "nextPage": None} if url.endswith("!") else {"rows": [{"id": url}], "nextPage": url + "!"}
        return 200, {}, json.dumps(page).encode()

    rows = rest.listing(spark, ["p", "q"], "id string", "rows", fetch).collect()
    assert sorted((r.url, r.id) for r in rows) == [("p", "p"), ("p", "p!1"), ("q", "q"), ("q", "q!1")]
