"""ZIP bundles with fixed bytes, guarded extraction, and XLSX workbooks."""

from __future__ import annotations

import os
import stat
import zipfile
from collections.abc import Iterable, Iterator
from itertools import chain
from pathlib import Path, PurePosixPath
from xml.etree import ElementTree
from xml.sax.saxutils import escape, quoteattr

from pyspark.sql import DataFrame

from .sinks import cell

#: The earliest time a ZIP can name, and a sheet's last row.
EPOCH = (1980, 1, 1, 0, 0, 0)
SHEET_ROWS = 1_048_576


def _put(out: zipfile.ZipFile, name: str, *content: bytes, more: Iterable[bytes] = ()) -> None:
    """An entry of these blocks, written one after the other."""
    info = zipfile.ZipInfo(name, EPOCH)
    info.compress_type, info.external_attr, info.create_system = zipfile.ZIP_DEFLATED, 0o644 << 16, 3
    with out.open(info, "w", force_zip64=True) as entry:
        for block in chain(content, more):
            entry.write(block)


def write_bundle(files: dict[str, str], path: str) -> None:
    """``files`` (name in the bundle: file on disk), sorted by name; equal inputs give equal bytes."""
    part = f"{path}.part"
    with zipfile.ZipFile(part, "w") as out:
        for name in sorted(files):
            with open(files[name], "rb") as file:
                _put(out, name, more=iter(lambda: file.read(1 << 20), b""))  # noqa: B023
    os.replace(part, path)


def extract_bundle(path: str, folder: str, most_bytes: int = 10 << 30, most_files: int = 200_000) -> list[str]:
    """Extract a bundle's files after all names and sizes are checked; returns the names.

    Absolute names, names with '..', links, repeated names and bundles beyond the
    bounds raise ValueError before anything is written.
    """
    with zipfile.ZipFile(path) as source:
        members = [m for m in source.infolist() if not m.is_dir()]
        names = [m.filename for m in members]
        if len(members) > most_files or sum(m.file_size for m in members) > most_bytes:
            raise ValueError("the bundle is larger than allowed")
        if len({n.lower() for n in names}) < len(names):
            raise ValueError("a name stands twice in the bundle")
        for m in members:
            parts = PurePosixPath(m.filename).parts
            if m.filename.startswith("/") or "\\" in m.filename or ":" in m.filename or ".." in parts:
                raise ValueError(f"unsafe name in the bundle: {m.filename}")
            if stat.S_ISLNK(m.external_attr >> 16):
                raise ValueError(f"a link in the bundle: {m.filename}")
        for m in members:
            target = Path(folder) / m.filename
            target.parent.mkdir(parents=True, exist_ok=True)
            part = target.with_name(target.name + ".part")
            with source.open(m) as inner, part.open("wb") as out:
                while block := inner.read(1 << 20):
                    out.write(block)
            os.replace(part, target)
    return sorted(names)


_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_LINKS = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_PACKAGE = "http://schemas.openxmlformats.org/package/2006"
_HEAD = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>\n'


def _sheet(rows) -> Iterator[bytes]:
    text = lambda v: f'<c t="inlineStr"><is><t xml:space="preserve">{escape(v)}</t></is></c>'
    yield f'{_HEAD}<worksheet xmlns="{_MAIN}"><sheetData>'.encode()
    for i, row in enumerate(rows, 1):
        yield f'<row r="{i}">{"".join(map(text, row))}</row>'.encode()
    yield b"</sheetData></worksheet>"


def write_workbook(sheets: dict[str, tuple[DataFrame, list[str]]], path: str) -> None:
    """One XLSX sheet for each (frame, sort columns), cells as in the release CSV; equal rows give equal bytes.

    A sheet holds at most SHEET_ROWS rows with its header, which is checked by a
    count before any row comes to the driver.
    """
    for name, (df, _) in sheets.items():
        if df.count() >= SHEET_ROWS:
            raise ValueError(f"sheet {name} has too many rows; write it as CSV")
    part, listed = f"{path}.part", list(enumerate(sheets, 1))
    kind = "application/vnd.openxmlformats-officedocument.spreadsheetml"
    with zipfile.ZipFile(part, "w") as out:
        parts = "".join(f'<Override PartName="/xl/worksheets/sheet{i}.xml" ContentType="{kind}.worksheet+xml"/>' for i, _ in listed)
        types = '<Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
        _put(out, "[Content_Types].xml", f'{_HEAD}<Types xmlns="{_PACKAGE}/content-types">{types}<Override PartName="/xl/workbook.xml" ContentType="{kind}.sheet.main+xml"/>{parts}</Types>'.encode())
        _put(out, "_rels/.rels", f'{_HEAD}<Relationships xmlns="{_PACKAGE}/relationships"><Relationship Id="rId1" Type="{_LINKS}/officeDocument" Target="xl/workbook.xml"/></Relationships>'.encode())
        names = "".join(f'<sheet name={quoteattr(n)} sheetId="{i}" r:id="rId{i}"/>' for i, n in listed)
        _put(out, "xl/workbook.xml", f'{_HEAD}<workbook xmlns="{_MAIN}" xmlns:r="{_LINKS}"><sheets>{names}</sheets></workbook>'.encode())
        links = "".join(f'<Relationship Id="rId{i}" Type="{_LINKS}/worksheet" Target="worksheets/sheet{i}.xml"/>' for i, _ in listed)
        _put(out, "xl/_rels/workbook.xml.rels", f'{_HEAD}<Relationships xmlns="{_PACKAGE}/relationships">{links}</Relationships>'.encode())
        for i, name in listed:
            df, order = sheets[name]
            rows = df.orderBy(*order).select(*(cell(df, c) for c in df.columns))
            _put(out, f"xl/worksheets/sheet{i}.xml", more=_sheet(chain([df.columns], rows.toLocalIterator())))
    os.replace(part, path)


def read_workbook(path: str) -> dict[str, list[list[str]]]:
    """Rows of every sheet of a workbook written by ``write_workbook``, header first."""
    space = {"m": _MAIN}
    with zipfile.ZipFile(path) as source:
        book = ElementTree.fromstring(source.read("xl/workbook.xml"))
        out = {}
        for i, sheet in enumerate(book.findall("m:sheets/m:sheet", space), 1):
            rows = ElementTree.fromstring(source.read(f"xl/worksheets/sheet{i}.xml")).findall("m:sheetData/m:row", space)
            out[sheet.get("name")] = [["".join(c.itertext()) for c in r.findall("m:c", space)] for r in rows]
    return out
