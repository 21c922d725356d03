"""Workbook (.xlsx) feeds read as a distributed job.

Spark's ``binaryFile`` source lists and reads the workbooks (any Hadoop
file system); ``mapInPandas`` parses each file's first sheet inside the
task that holds it.  A workbook is a zip archive and cannot be split, so one
file is the unit of parallelism; many files spread over many tasks.  Cell
values come out as text under the header names and are typed afterwards by
the same lenient rule as delimited feeds.

Only reading is supported (first sheet, shared/inline strings, numbers,
booleans, date-formatted serial numbers).  Formulas are read as their cached
values; styles other than date formats are ignored.
"""

from __future__ import annotations

import datetime as _dt
import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree as ET

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from daybook.functions.coerce import coerce_by_name
from daybook.sources.delimited import conform

_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main"}
_R = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
# Built-in number formats that display dates/times (ECMA-376 part 1, 18.8.30).
_DATE_FMT_IDS = set(range(14, 23)) | {45, 46, 47}
_EPOCH = _dt.datetime(1899, 12, 30)


def _col_index(ref: str) -> int:
    letters = re.match(r"[A-Z]+", ref).group(0)
    n = 0
    for ch in letters:
        n = n * 26 + (ord(ch) - 64)
    return n - 1


def _text(el) -> str:
    return "".join(t.text or "" for t in el.iter(f"{{{_NS['m']}}}t"))


def _first_sheet_path(z: zipfile.ZipFile) -> str:
    wb = ET.fromstring(z.read("xl/workbook.xml"))
    sheet = wb.find("m:sheets/m:sheet", _NS)
    rid = sheet.get(_R)
    rels = ET.fromstring(z.read("xl/_rels/workbook.xml.rels"))
    for rel in rels:
        if rel.get("Id") == rid:
            target = rel.get("Target").lstrip("/")
            return target if target.startswith("xl/") else f"xl/{target}"
    return "xl/worksheets/sheet1.xml"


def _date_styles(z: zipfile.ZipFile) -> set[int]:
    """Indexes of cell styles that format numbers as dates."""
    try:
        st = ET.fromstring(z.read("xl/styles.xml"))
    except KeyError:
        return set()
    custom = {}
    for nf in st.findall("m:numFmts/m:numFmt", _NS):
        code = re.sub(r'"[^"]*"|\[[^\]]*\]', "", nf.get("formatCode", "")).lower()
        custom[int(nf.get("numFmtId"))] = any(ch in code for ch in "ymdhs")
    out = set()
    for i, xf in enumerate(st.findall("m:cellXfs/m:xf", _NS)):
        fid = int(xf.get("numFmtId", "0"))
        if fid in _DATE_FMT_IDS or custom.get(fid, False):
            out.add(i)
    return out


def _number_text(v: str, is_date: bool) -> str:
    if is_date:
        ts = _EPOCH + _dt.timedelta(days=float(v))
        return ts.isoformat(sep=" ")
    f = float(v)
    return str(int(f)) if f.is_integer() and "e" not in v.lower() else v


def parse_first_sheet(content: bytes) -> tuple[list[str], list[list[str | None]]]:
    """Header and rows (as text) of the first sheet of one workbook."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        try:
            shared = [_text(si) for si in ET.fromstring(z.read("xl/sharedStrings.xml")).findall("m:si", _NS)]
        except KeyError:
            shared = []
        dates = _date_styles(z)
        rows: list[list[str | None]] = []
        with z.open(_first_sheet_path(z)) as fh:
            for _, el in ET.iterparse(fh):
                if el.tag != f"{{{_NS['m']}}}row":
                    continue
                cells: dict[int, str | None] = {}
                for c in el.findall("m:c", _NS):
                    t = c.get("t", "n")
                    v = c.find("m:v", _NS)
                    if t == "inlineStr":
                        val = _text(c)
                    elif v is None or v.text is None:
                        val = None
                    elif t == "s":
                        val = shared[int(v.text)]
                    elif t == "b":
                        val = "true" if v.text == "1" else "false"
                    elif t in ("str", "e"):
                        val = v.text
                    else:
                        val = _number_text(v.text, int(c.get("s", "0")) in dates)
                    cells[_col_index(c.get("r"))] = val
                el.clear()
                width = max(cells) + 1 if cells else 0
                rows.append([cells.get(i) for i in range(width)])
    if not rows:
        return [], []
    header = [h if h is not None else f"_c{i}" for i, h in enumerate(rows[0])]
    body = [r + [None] * (len(header) - len(r)) for r in rows[1:]]
    return header, [r[: len(header)] for r in body]


def read_workbooks(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    glob: str = "*.xlsx",
) -> DataFrame:
    """First sheets of all workbooks under ``path`` matching ``glob``, typed to ``schema``."""
    names = [f.name for f in schema.fields]
    text_schema = T.StructType(
        [T.StructField(n, T.StringType()) for n in names] + [T.StructField("_file", T.StringType())]
    )

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path_, content in zip(pdf["path"], pdf["content"]):
                header, rows = parse_first_sheet(bytes(content))
                frame = pd.DataFrame(rows, columns=header, dtype=object)
                lower = {h.lower(): h for h in header if isinstance(h, str)}
                out = pd.DataFrame(
                    {n: frame[lower[n.lower()]] if n.lower() in lower else None for n in names}, dtype=object
                )
                out["_file"] = path_.rsplit("/", 1)[-1]
                yield out

    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).select("path", "content")
    text = files.mapInPandas(parse, text_schema)
    typed = conform(coerce_by_name(text.drop("_file")), schema)
    return typed


def write_minimal_xlsx(target: str, header: list[str], rows: list[list]) -> None:
    """Write a one-sheet workbook with inline strings (for tests and small drops)."""

    def cell_ref(i: int, r: int) -> str:
        s = ""
        i += 1
        while i:
            i, rem = divmod(i - 1, 26)
            s = chr(65 + rem) + s
        return f"{s}{r}"

    def esc(v) -> str:
        return str(v).replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;")

    lines = []
    for r_i, row in enumerate([header, *rows], start=1):
        cells = []
        for c_i, v in enumerate(row):
            if v is None:
                continue
            if isinstance(v, (int, float)) and not isinstance(v, bool):
                cells.append(f'<c r="{cell_ref(c_i, r_i)}"><v>{v}</v></c>')
            else:
                cells.append(f'<c r="{cell_ref(c_i, r_i)}" t="inlineStr"><is><t>{esc(v)}</t></is></c>')
        lines.append(f'<row r="{r_i}">{"".join(cells)}</row>')
    sheet = (
        '<?xml version="1.0" encoding="UTF-8"?>'
        f'<worksheet xmlns="{_NS["m"]}"><sheetData>{"".join(lines)}</sheetData></worksheet>'
    )
    workbook = (
        '<?xml version="1.0" encoding="UTF-8"?>'
        f'<workbook xmlns="{_NS["m"]}" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships">'
        '<sheets><sheet name="Sheet1" sheetId="1" r:id="rId1"/></sheets></workbook>'
    )
    rels = (
        '<?xml version="1.0" encoding="UTF-8"?>'
        '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
        '<Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/worksheet" '
        'Target="worksheets/sheet1.xml"/></Relationships>'
    )
    content_types = (
        '<?xml version="1.0" encoding="UTF-8"?>'
        '<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types">'
        '<Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
        '<Default Extension="xml" ContentType="application/xml"/>'
        '<Override PartName="/xl/workbook.xml" '
        'ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>'
        '<Override PartName="/xl/worksheets/sheet1.xml" '
        'ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>'
        "</Types>"
    )
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("[Content_Types].xml", content_types)
        z.writestr("xl/workbook.xml", workbook)
        z.writestr("xl/_rels/workbook.xml.rels", rels)
        z.writestr("xl/worksheets/sheet1.xml", sheet)


def write_workbooks(df: DataFrame, folder: str, prefix: str = "part") -> int:
    """Write each partition of ``df`` as one workbook in ``folder`` (a shared path).

    Runs inside the tasks (no rows pass through the driver); returns the
    number of files written.
    """
    import os
    import uuid

    header = df.columns

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = []
        for pdf in batches:
            rows.extend(pdf.astype(object).where(pdf.notna(), None).values.tolist())
        if rows:
            os.makedirs(folder, exist_ok=True)
            write_minimal_xlsx(os.path.join(folder, f"{prefix}-{uuid.uuid4().hex}.xlsx"), header, rows)
        yield pd.DataFrame({"files": [1 if rows else 0]})

    text = df.select(*[df[c].cast("string").alias(c) for c in header])
    n = text.mapInPandas(write, "files int").agg({"files": "sum"}).first()[0]
    return int(n or 0)
