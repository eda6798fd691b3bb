"""A Spark data source for .xlsx workbooks, and a plain writer; the format is zip and XML."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree
from xml.sax.saxutils import escape

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main"}
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
SCHEMA = "sheet string, row_no int, cells array<string>"


def _column(ref: str) -> int:
    n = 0
    for c in re.match(r"[A-Z]+", ref)[0]:
        n = n * 26 + ord(c) - 64
    return n - 1


def sheet_paths(book: zipfile.ZipFile) -> list[tuple[str, str]]:
    rels = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))}
    root = ElementTree.fromstring(book.read("xl/workbook.xml"))
    return [(s.get("name"), "xl/" + rels[s.get(_REL)].lstrip("/").removeprefix("xl/")) for s in root.find("m:sheets", _NS)]


def _shared(book: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in book.namelist():
        return []
    return ["".join(t.text or "" for t in si.iter(f"{{{_NS['m']}}}t")) for si in ElementTree.fromstring(book.read("xl/sharedStrings.xml"))]


def parse(data: bytes, only: str | None = None) -> Iterator[tuple[str, int, list[str | None]]]:
    """(sheet, row number, cells) of every row that the file has; missing cells are null."""
    with zipfile.ZipFile(io.BytesIO(data)) as book:
        shared = _shared(book)
        for name, path in sheet_paths(book):
            if only is not None and name != only:
                continue
            for n, row in enumerate(ElementTree.fromstring(book.read(path)).iter(f"{{{_NS['m']}}}row"), 1):
                cells: list[str | None] = []
                for k, c in enumerate(row.findall("m:c", _NS)):
                    at = _column(c.get("r")) if c.get("r") else k
                    cells += [None] * (at + 1 - len(cells))
                    v, kind = c.find("m:v", _NS), c.get("t")
                    if kind == "inlineStr":
                        cells[at] = "".join(t.text or "" for t in c.iter(f"{{{_NS['m']}}}t"))
                    elif v is not None and v.text is not None:
                        cells[at] = shared[int(v.text)] if kind == "s" else {"1": "True", "0": "False"}.get(v.text, v.text) if kind == "b" else v.text
                yield name, int(row.get("r") or n), cells


class WorkbookSource(DataSource):
    """format `workbook`: option `path`, and `sheet` for one sheet only."""

    @classmethod
    def name(cls) -> str:
        return "workbook"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)


class _Reader(DataSourceReader):
    def __init__(self, options):
        self.path, self.sheet = options["path"], options.get("sheet")

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(0)]

    def read(self, partition) -> Iterator[tuple]:
        from pyarrow import fs

        store, name = fs.FileSystem.from_uri(self.path) if "://" in self.path else (fs.LocalFileSystem(), self.path)
        with store.open_input_file(name) as f:
            yield from parse(f.read(), self.sheet)


def read_workbook(spark: SparkSession, path: str, sheet: str | None = None) -> DataFrame:
    spark.dataSource.register(WorkbookSource)
    reader = spark.read.format("workbook").option("path", path)
    return (reader.option("sheet", sheet) if sheet else reader).load()


def paper_rows(rows: DataFrame, sheet: str | None = None) -> DataFrame:
    """The paper list of a workbook: idx (row ordinal), num, processo, nome, livro, etiquetado; the header
    and rows without a name go."""
    from pyspark.sql import functions as F

    kept = rows.filter("row_no > 1" + (f" AND sheet = '{sheet}'" if sheet else ""))
    cell = lambda k: F.get("cells", F.lit(k))
    kept = kept.filter(F.coalesce(cell(2), F.lit("")) != "")
    text = lambda k: F.trim(F.coalesce(cell(k), F.lit("")))
    return kept.select((F.col("row_no") - 1).cast("long").alias("idx"), cell(0).alias("num"), F.coalesce(cell(1), F.lit("")).alias("processo"), text(2).alias("nome"), text(3).alias("livro"), text(4).alias("etiquetado"))


def write_workbook(sheets: dict[str, tuple[list[str], list[list]]]) -> bytes:
    """A workbook of small tables: name to (header, rows). Numbers stay numbers, the rest is text."""

    def cell(v, ref: str, bold: bool = False) -> str:
        style = ' s="1"' if bold else ""
        if v is None:
            return ""
        if isinstance(v, (int, float)) and not isinstance(v, bool):
            return f'<c r="{ref}"{style}><v>{v}</v></c>'
        return f'<c r="{ref}" t="inlineStr"{style}><is><t xml:space="preserve">{escape(str(v))}</t></is></c>'

    def letters(k: int) -> str:
        out, k = "", k + 1
        while k:
            k, r = divmod(k - 1, 26)
            out = chr(65 + r) + out
        return out

    head = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>\n'
    main, office, package = _NS["m"], "http://schemas.openxmlformats.org/officeDocument/2006/relationships", "http://schemas.openxmlformats.org/package/2006"
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        kinds = "".join(f'<Override PartName="/xl/worksheets/sheet{i}.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>' for i in range(1, len(sheets) + 1))
        z.writestr("[Content_Types].xml", f'{head}<Types xmlns="{package}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/><Override PartName="/xl/styles.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.styles+xml"/>{kinds}</Types>')
        z.writestr("_rels/.rels", f'{head}<Relationships xmlns="{package}/relationships"><Relationship Id="rId1" Type="{office}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        rels = "".join(f'<Relationship Id="rId{i}" Type="{office}/worksheet" Target="worksheets/sheet{i}.xml"/>' for i in range(1, len(sheets) + 1))
        z.writestr("xl/_rels/workbook.xml.rels", f'{head}<Relationships xmlns="{package}/relationships">{rels}<Relationship Id="rId0" Type="{office}/styles" Target="styles.xml"/></Relationships>')
        names = "".join(f'<sheet name="{escape(n, {chr(34): "&quot;"})}" sheetId="{i}" r:id="rId{i}"/>' for i, n in enumerate(sheets, 1))
        z.writestr("xl/workbook.xml", f'{head}<workbook xmlns="{main}" xmlns:r="{office}"><sheets>{names}</sheets></workbook>')
        z.writestr("xl/styles.xml", f'{head}<styleSheet xmlns="{main}"><fonts count="2"><font/><font><b/></font></fonts><fills count="1"><fill/></fills><borders count="1"><border/></borders><cellStyleXfs count="1"><xf/></cellStyleXfs><cellXfs count="2"><xf/><xf fontId="1" applyFont="1"/></cellXfs></styleSheet>')
        for i, (header, rows) in enumerate(sheets.values(), 1):
            lines = [f'<row r="{r}">{"".join(cell(v, f"{letters(k)}{r}", r == 1) for k, v in enumerate(row))}</row>' for r, row in enumerate([header, *rows], 1)]
            z.writestr(f"xl/worksheets/sheet{i}.xml", f'{head}<worksheet xmlns="{main}"><sheetData>{"".join(lines)}</sheetData></worksheet>')
    return out.getvalue()
