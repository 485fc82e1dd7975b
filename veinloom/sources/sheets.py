"""A data source for spreadsheets (.xlsx), read on executors straight from the sheet's XML, row by row.

Each sheet of each file is a partition. Rows are streamed, whatever their number; the table of shared strings, which a
file's cells refer to, is read first. The first row names the columns.
"""

from __future__ import annotations

import re
import uuid
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import date, datetime, timedelta
from itertools import chain
from xml.etree import ElementTree
from xml.sax.saxutils import escape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from veinloom.sources.files import listed, opened

_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_LINK = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
_PACKED = "{http://schemas.openxmlformats.org/package/2006/relationships}Relationship"


@dataclass
class Sheet(InputPartition):
    uri: str
    member: str


def sheets_of(z: zipfile.ZipFile, name: str | None) -> list[str]:
    """The archive's members with the sheets, in the workbook's order, or with that of the name."""
    book = ElementTree.fromstring(z.read("xl/workbook.xml"))
    links = {r.get("Id"): r.get("Target").lstrip("/") for r in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels")).iter(_PACKED)}
    found = [(s.get("name"), links[s.get(_LINK)]) for s in book.iter(f"{_MAIN}sheet")]
    return [t if t.startswith("xl/") else f"xl/{t}" for n, t in found if name is None or n == name]


def _texts(z: zipfile.ZipFile) -> list[str]:
    out: list[str] = []
    if "xl/sharedStrings.xml" in z.namelist():
        with z.open("xl/sharedStrings.xml") as f:
            for _, e in ElementTree.iterparse(f):
                if e.tag == f"{_MAIN}si":
                    out.append("".join(t.text or "" for t in e.iter(f"{_MAIN}t")))
                    e.clear()
    return out


def column_of(cell: str) -> int:
    """A is 0, Z is 25, AA is 26."""
    n = 0
    for c in re.match("[A-Z]+", cell)[0]:
        n = 26 * n + ord(c) - 64
    return n - 1


def cell_rows(z: zipfile.ZipFile, member: str) -> Iterator[dict[int, str | bool]]:
    """Each row's cells that are not empty, by column; numbers as their text."""
    shared = _texts(z)
    with z.open(member) as f:
        events = ElementTree.iterparse(f, events=("start", "end"))
        _, root = next(events)
        for event, e in events:
            if event == "end" and e.tag == f"{_MAIN}row":
                row: dict[int, str | bool] = {}
                for place, c in enumerate(e.iter(f"{_MAIN}c")):
                    kind, value = c.get("t", "n"), c.findtext(f"{_MAIN}v")
                    if kind == "inlineStr":
                        value = "".join(t.text or "" for t in c.iter(f"{_MAIN}t"))
                    elif value is not None and kind == "s":
                        value = shared[int(value)]
                    elif value is not None and kind == "b":
                        value = value == "1"
                    if value is not None and kind != "e":  # an error in a cell is no value
                        row[column_of(c.get("r")) if c.get("r") else place] = value
                yield row
                for data in root.iter(f"{_MAIN}sheetData"):
                    data.clear()  # rows that have been read go


def converted(value, kind: T.DataType):
    """A cell's value as the column's type; null where it is none."""
    try:
        if value is None or isinstance(kind, T.StringType):
            return value if value is None or isinstance(value, str) else str(value).lower()
        if isinstance(kind, T.BooleanType):
            return value if isinstance(value, bool) else {"true": True, "1": True, "false": False, "0": False}.get(str(value).strip().lower())
        if isinstance(kind, (T.LongType, T.IntegerType, T.ShortType)):
            number = float(value)
            return int(str(value)) if re.fullmatch(r"-?[0-9]+", str(value)) else int(number) if number.is_integer() else None
        if isinstance(kind, (T.DoubleType, T.FloatType)):
            return float(value)
        if isinstance(kind, T.DateType):  # days since the end of 1899, or a printed date
            return date(1899, 12, 30) + timedelta(days=int(float(value))) if re.fullmatch(r"[0-9.]+", value) else datetime.fromisoformat(value).date()
    except (ValueError, TypeError, OverflowError):
        return None
    raise ValueError(f"sheets have no values of type {kind.simpleString()}")


class _SheetReader(DataSourceReader):
    def __init__(self, options: dict, schema: T.StructType):
        self.path, self.sheet, self.fields = options["path"], options.get("sheet"), schema

    def partitions(self) -> list[Sheet]:
        out = []
        for uri, _ in listed(self.path, ".xlsx"):
            with opened(uri) as f, zipfile.ZipFile(f) as z:
                out += [Sheet(uri, m) for m in sheets_of(z, self.sheet)]
        return out

    def read(self, partition: Sheet | None) -> Iterator[tuple]:
        if partition is None:  # no sheets at all
            return
        with opened(partition.uri) as f, zipfile.ZipFile(f) as z:
            rows = cell_rows(z, partition.member)
            names = {str(v).strip(): i for i, v in next(rows, {}).items()}
            at = [names.get(f.name) for f in self.fields.fields]
            for row in rows:
                if row:
                    yield tuple(converted(row.get(i), f.dataType) if i is not None else None for i, f in zip(at, self.fields.fields))


class SheetSource(DataSource):
    """spark.read.format("xlsx").schema(...).option("sheet", name).load(folder or file)."""

    @classmethod
    def name(cls) -> str:
        return "xlsx"

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _SheetReader(dict(self.options), schema)


def read_sheets(spark: SparkSession, path: str, schema: str, sheet: str | None = None) -> DataFrame:
    """All rows of all sheets (or of those of a name) of a file or folder; columns by their names in the first row. Names
    that a sheet has not, and values that are not of the type, give nulls; empty rows are left out."""
    spark.dataSource.register(SheetSource)
    reader = spark.read.format("xlsx").schema(schema)
    return (reader.option("sheet", sheet) if sheet else reader).load(path)


_PARTS = {
    "[Content_Types].xml": '<?xml version="1.0" encoding="UTF-8"?><Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/><Override PartName="/xl/worksheets/sheet1.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/><Override PartName="/xl/sharedStrings.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sharedStrings+xml"/></Types>',
    "_rels/.rels": '<?xml version="1.0" encoding="UTF-8"?><Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/officeDocument" Target="xl/workbook.xml"/></Relationships>',
    "xl/_rels/workbook.xml.rels": '<?xml version="1.0" encoding="UTF-8"?><Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/worksheet" Target="worksheets/sheet1.xml"/><Relationship Id="rId2" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/sharedStrings" Target="sharedStrings.xml"/></Relationships>',
}


def write_sheets(df: DataFrame, path: str, sheet: str = "data") -> None:
    """A file with one sheet for each partition that has rows. Texts are shared strings; nulls are empty cells."""
    names = df.columns

    def name_of(i: int) -> str:
        return (name_of(i // 26 - 1) if i >= 26 else "") + chr(65 + i % 26)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(path)
        store.create_dir(base, recursive=True)
        shared: dict[str, int] = {}
        n = 0

        def cell(i: int, at: int, v) -> str:
            if v is None:
                return ""
            place = f'r="{name_of(i)}{at}"'
            if isinstance(v, bool):
                return f'<c {place} t="b"><v>{int(v)}</v></c>'
            if isinstance(v, (int, float)):
                return f"<c {place}><v>{v!r}</v></c>"
            return f'<c {place} t="s"><v>{shared.setdefault(str(v), len(shared))}</v></c>'

        first = next((b for b in batches if b.num_rows), None)
        if first is None:
            return
        target = f"{base}/{uuid.uuid4().hex}.xlsx"
        with store.open_output_stream(target, compression=None) as out, zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
            for member, text in _PARTS.items():
                z.writestr(member, text)
            z.writestr("xl/workbook.xml", f'<?xml version="1.0" encoding="UTF-8"?><workbook xmlns="{_MAIN[1:-1]}" xmlns:r="{_LINK[1:-3]}"><sheets><sheet name="{escape(sheet)}" sheetId="1" r:id="rId1"/></sheets></workbook>')
            with z.open("xl/worksheets/sheet1.xml", "w") as f:
                f.write(f'<?xml version="1.0" encoding="UTF-8"?><worksheet xmlns="{_MAIN[1:-1]}"><sheetData>'.encode())
                f.write(f'<row r="1">{"".join(cell(i, 1, c) for i, c in enumerate(names))}</row>'.encode())
                for batch in chain([first], batches):
                    for row in zip(*[c.to_pylist() for c in batch.columns]):
                        n += 1
                        f.write(f'<row r="{n + 1}">{"".join(cell(i, n + 1, v) for i, v in enumerate(row))}</row>'.encode())
                f.write(b"</sheetData></worksheet>")
            strings = "".join(f'<si><t xml:space="preserve">{escape(s)}</t></si>' for s in shared)
            z.writestr("xl/sharedStrings.xml", f'<?xml version="1.0" encoding="UTF-8"?><sst xmlns="{_MAIN[1:-1]}">{strings}</sst>')
        yield pa.RecordBatch.from_arrays([pa.array([n])], names=["n"])

    df.mapInArrow(run, "n long").agg(F.sum("n")).first()
