"""Spreadsheet workbooks (.xlsx) without an Excel library.

Read: ``binaryFile`` lists and loads the files (any Hadoop file system,
one task per workbook), ``mapInPandas`` parses the OOXML parts with the
standard library.  Write: a Python Data Source whose tasks each write
their own workbook(s) of at most ``row_cap`` data rows.
"""

from __future__ import annotations

import io
import os
import re
import uuid
import zipfile
from collections.abc import Iterator
from datetime import date, datetime, timedelta
from xml.etree import ElementTree as ET
from xml.sax.saxutils import escape, quoteattr

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.functions.format import text_to_date

NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main",
      "r": "http://schemas.openxmlformats.org/officeDocument/2006/relationships",
      "pr": "http://schemas.openxmlformats.org/package/2006/relationships"}
DEFAULT_SHEET = "Sheet1"
MAX_SHEET_ROWS = 1_048_576


# ---- reading ---------------------------------------------------------------

def _col_index(ref: str) -> int:
    letters = re.match(r"[A-Z]+", ref).group(0)
    n = 0
    for ch in letters:
        n = n * 26 + (ord(ch) - 64)
    return n - 1


def _sheet_path(z: zipfile.ZipFile, sheet: str) -> str:
    wb = ET.fromstring(z.read("xl/workbook.xml"))
    rid = None
    for s in wb.iterfind("m:sheets/m:sheet", NS):
        if s.get("name") == sheet:
            rid = s.get(f"{{{NS['r']}}}id")
    if rid is None:
        raise ValueError(f"sheet {sheet!r} not found")
    rels = ET.fromstring(z.read("xl/_rels/workbook.xml.rels"))
    for r in rels.iterfind("pr:Relationship", NS):
        if r.get("Id") == rid:
            t = r.get("Target").lstrip("/")
            return t if t.startswith("xl/") else f"xl/{t}"
    raise ValueError(f"sheet {sheet!r} has no part")


# Fixed numbers of the built-in date and time cell formats
BUILTIN_DATE_FORMATS = {*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)}


def _is_date_format(code: str) -> bool:
    """A custom format code that shows a date or time (text in quotes,
    brackets and escapes aside)."""
    bare = re.sub(r'"[^"]*"|\[[^\]]*\]|\\\\.|_.|\*.', "", code)
    return bool(re.search(r"[ymdhs]", bare, re.IGNORECASE)) and "General" not in code


def _date_styles(z: zipfile.ZipFile) -> set[int]:
    """Numbers of the cell styles whose cells are dates."""
    if "xl/styles.xml" not in z.namelist():
        return set()
    root = ET.fromstring(z.read("xl/styles.xml"))
    custom = {int(f.get("numFmtId")) for f in root.iterfind("m:numFmts/m:numFmt", NS) if _is_date_format(f.get("formatCode", ""))}
    return {i for i, x in enumerate(root.iterfind("m:cellXfs/m:xf", NS))
            if int(x.get("numFmtId", 0)) in custom | BUILTIN_DATE_FORMATS}


def _serial_text(serial: str, date1904: bool) -> str:
    """A date cell's day number as yyyy/MM/dd HH:mm:ss."""
    days = float(serial)
    if not date1904 and days < 60:
        days += 1  # the 1900 system counts a 29 February 1900
    start = datetime(1904, 1, 1) if date1904 else datetime(1899, 12, 30)
    return (start + timedelta(seconds=round(days * 86400))).strftime("%Y/%m/%d %H:%M:%S")


def _unescape(text: str) -> str:
    """_xHHHH_ stands for a character that XML cannot hold."""
    return re.sub(r"_x([0-9A-Fa-f]{4})_", lambda m: chr(int(m[1], 16)), text)


def _escape(text: str) -> str:
    text = re.sub(r"_(?=x[0-9A-Fa-f]{4}_)", "_x005F_", text)
    text = re.sub("[\x00-\x08\x0b-\x1f\ufffe\uffff]|\r", lambda m: f"_x{ord(m[0]):04X}_", text)
    return escape(text)


def read_sheet(data: bytes, sheet: str = DEFAULT_SHEET) -> list[list[str | None]]:
    """All rows of one sheet as text cells (shared, inline, formula
    strings and numbers as written; dates as yyyy/MM/dd HH:mm:ss)."""
    z = zipfile.ZipFile(io.BytesIO(data))
    dates = _date_styles(z)
    props = ET.fromstring(z.read("xl/workbook.xml")).find("m:workbookPr", NS)
    date1904 = props is not None and props.get("date1904", "0") in ("1", "true")
    shared: list[str] = []
    if "xl/sharedStrings.xml" in z.namelist():
        sst = ET.fromstring(z.read("xl/sharedStrings.xml"))
        for si in sst.iterfind("m:si", NS):
            shared.append(_unescape("".join(t.text or "" for t in si.iter(f"{{{NS['m']}}}t"))))
    rows: list[list[str | None]] = []
    root = ET.fromstring(z.read(_sheet_path(z, sheet)))
    for row in root.iterfind("m:sheetData/m:row", NS):
        cells: dict[int, str | None] = {}
        for i, c in enumerate(row.iterfind("m:c", NS)):
            ref = c.get("r")
            j = _col_index(ref) if ref else i
            t = c.get("t")
            if t == "inlineStr":
                val = _unescape("".join(x.text or "" for x in c.iter(f"{{{NS['m']}}}t")))
            else:
                v = c.find("m:v", NS)
                val = None if v is None else v.text
                if t == "s" and val is not None:
                    val = shared[int(val)]
                elif t == "b" and val is not None:
                    val = "TRUE" if val == "1" else "FALSE"
                elif t in (None, "n") and val is not None and int(c.get("s", 0)) in dates:
                    val = _serial_text(val, date1904)
                elif t == "str" and val is not None:
                    val = _unescape(val)
            cells[j] = val
        width = max(cells) + 1 if cells else 0
        rows.append([cells.get(k) for k in range(width)])
    return rows


def workbook_scan(spark: SparkSession, path: str, schema: T.StructType, sheet: str = DEFAULT_SHEET,
                  glob: str = "*.xlsx") -> DataFrame:
    """Rows of sheet ``sheet`` (header row = column names) of every
    workbook under ``path``, cast to ``schema`` (columns matched by name;
    a missing sheet or column fails the task)."""
    from kestrel.session import ensure_shipped
    ensure_shipped(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).select("path", "content")
    names = [f.name for f in schema.fields]
    text_schema = T.StructType([T.StructField(n, T.StringType()) for n in names])

    def parse(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in it:
            for content in b["content"]:
                rows = read_sheet(bytes(content), sheet)
                if not rows:
                    continue
                head = [h if h is not None else "" for h in rows[0]]
                missing = [n for n in names if n not in head]
                if missing:
                    raise ValueError(f"columns not in sheet {sheet!r}: {missing}")
                pos = [head.index(n) for n in names]
                recs = [[(r[p] if p < len(r) else None) for p in pos] for r in rows[1:]]
                yield pd.DataFrame(recs, columns=names, dtype=object)

    raw = files.mapInPandas(parse, text_schema)

    def typed(f: T.StructField):
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            return text_to_date(F.col(f.name)).cast(f.dataType).alias(f.name)
        return F.col(f.name).cast(f.dataType).alias(f.name)

    return raw.select(*map(typed, schema.fields))


# ---- writing ---------------------------------------------------------------

def _col_letters(i: int) -> str:
    s = ""
    i += 1
    while i:
        i, r = divmod(i - 1, 26)
        s = chr(65 + r) + s
    return s


def _cell(ref: str, v) -> str:
    if v is None:
        return ""
    if isinstance(v, bool):
        return f'<c r="{ref}" t="b"><v>{int(v)}</v></c>'
    if isinstance(v, (int, float)):
        if isinstance(v, float) and (v != v or v in (float("inf"), float("-inf"))):
            return f'<c r="{ref}" t="inlineStr"><is><t>{v}</t></is></c>'
        return f'<c r="{ref}"><v>{repr(v) if isinstance(v, float) else v}</v></c>'
    if isinstance(v, date):
        at = v.replace(tzinfo=None) if isinstance(v, datetime) else datetime(v.year, v.month, v.day)
        if at >= datetime(1900, 3, 1):
            gap = at - datetime(1899, 12, 30)
            return f'<c r="{ref}" s="1"><v>{gap.days + (gap.seconds + gap.microseconds / 1e6) / 86400!r}</v></c>'
        v = at.strftime("%Y/%m/%d %H:%M:%S")  # before the file format's first safe day
    return f'<c r="{ref}" t="inlineStr"><is><t xml:space="preserve">{_escape(str(v))}</t></is></c>'


def _sheet_xml(rows: list[tuple], row_base: int, col_base: int) -> str:
    lines = ['<?xml version="1.0" encoding="UTF-8" standalone="yes"?>', f'<worksheet xmlns="{NS["m"]}"><sheetData>']
    for r, vals in enumerate(rows, start=row_base + 1):
        cells = "".join(_cell(f"{_col_letters(col_base + i)}{r}", v) for i, v in enumerate(vals))
        lines.append(f'<row r="{r}">{cells}</row>')
    return "".join([*lines, "</sheetData></worksheet>"])


def workbook_sheets(sheets: list[tuple[str, list[str], list[tuple], int, int]]) -> bytes:
    """An .xlsx of several sheets: (name, header, rows, first row, first
    column), header row on top, dates as date cells, other text inline."""
    head = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
    kind = "application/vnd.openxmlformats-officedocument.spreadsheetml"
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    n = range(1, len(sheets) + 1)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("[Content_Types].xml", head + '<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types">'
                   '<Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
                   '<Default Extension="xml" ContentType="application/xml"/>'
                   f'<Override PartName="/xl/workbook.xml" ContentType="{kind}.sheet.main+xml"/>'
                   f'<Override PartName="/xl/styles.xml" ContentType="{kind}.styles+xml"/>'
                   + "".join(f'<Override PartName="/xl/worksheets/sheet{i}.xml" ContentType="{kind}.worksheet+xml"/>' for i in n) + "</Types>")
        z.writestr("_rels/.rels", head + f'<Relationships xmlns="{NS["pr"]}"><Relationship Id="rId1" Type="{rel}/officeDocument" '
                   'Target="xl/workbook.xml"/></Relationships>')
        z.writestr("xl/workbook.xml", head + f'<workbook xmlns="{NS["m"]}" xmlns:r="{NS["r"]}"><sheets>' + "".join(
            f'<sheet name={quoteattr(s[0])} sheetId="{i}" r:id="rId{i}"/>' for i, s in zip(n, sheets)) + "</sheets></workbook>")
        z.writestr("xl/_rels/workbook.xml.rels", head + f'<Relationships xmlns="{NS["pr"]}">' + "".join(
            f'<Relationship Id="rId{i}" Type="{rel}/worksheet" Target="worksheets/sheet{i}.xml"/>' for i in n)
            + f'<Relationship Id="rId{len(sheets) + 1}" Type="{rel}/styles" Target="styles.xml"/></Relationships>')
        z.writestr("xl/styles.xml", head + f'<styleSheet xmlns="{NS["m"]}"><numFmts count="1"><numFmt numFmtId="164" '
                   'formatCode="yyyy/mm/dd hh:mm:ss"/></numFmts><fonts count="1"><font/></fonts><fills count="1"><fill/></fills>'
                   '<borders count="1"><border/></borders><cellStyleXfs count="1"><xf/></cellStyleXfs><cellXfs count="2"><xf/>'
                   '<xf numFmtId="164" applyNumberFormat="1"/></cellXfs></styleSheet>')
        for i, (_, header, rows, row_base, col_base) in zip(n, sheets):
            z.writestr(f"xl/worksheets/sheet{i}.xml", _sheet_xml([tuple(header), *rows], row_base, col_base))
    return out.getvalue()


def workbook_bytes(header: list[str], rows: list[tuple], sheet: str = DEFAULT_SHEET) -> bytes:
    """A one-sheet .xlsx with a header row."""
    return workbook_sheets([(sheet, header, rows, 0, 0)])


def _filesystem(path: str):
    """(file system, path in it) of a shared folder: any URI that Arrow's
    file systems reach (file, s3, gs, abfs, hdfs), or a mounted path."""
    from pyarrow import fs
    if re.match(r"[A-Za-z][A-Za-z0-9+.-]+:", path):
        return fs.FileSystem.from_uri(re.sub(r"^file:/*", "file:///", path))
    return fs.LocalFileSystem(), os.path.abspath(path)


def _put(path: str, name: str, data: bytes) -> None:
    """The file appears whole or not at all."""
    where, folder = _filesystem(path)
    where.create_dir(folder, recursive=True)
    tmp = f"{folder}/.{name}.{uuid.uuid4().hex[:8]}.tmp"
    with where.open_output_stream(tmp) as out:
        out.write(data)
    where.move(tmp, f"{folder}/{name}")


try:
    from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

    class _Written(WriterCommitMessage):
        def __init__(self, files):
            self.files = files

    class WorkbookWriter(DataSourceWriter):
        def __init__(self, options, schema, overwrite):
            self.path = options["path"]
            self.sheet = options.get("sheet", DEFAULT_SHEET)
            self.cap = min(int(options.get("row_cap", MAX_SHEET_ROWS - 1)), MAX_SHEET_ROWS - 1)
            self.header = [f.name for f in schema.fields]
            self.overwrite = overwrite
            # one id per job, the same in every task attempt: a retried task
            # rewrites the same file names instead of adding copies
            self.job = uuid.uuid4().hex[:12]

        def write(self, iterator):
            from pyspark import TaskContext
            ctx = TaskContext.get()
            pid = ctx.partitionId() if ctx else 0
            files, buf = [], []

            def flush():
                name = f"part-{pid:05d}-{len(files):03d}-{self.job}.xlsx"
                _put(self.path, name, workbook_bytes(self.header, buf, self.sheet))
                files.append(name)

            for row in iterator:
                buf.append(tuple(row))
                if len(buf) >= self.cap:
                    flush()
                    buf = []
            if buf or not files:
                flush()
            return _Written(files)

        def _listed(self):
            from pyarrow import fs
            where, folder = _filesystem(self.path)
            return where, [f for f in where.get_file_info(fs.FileSelector(folder, allow_not_found=True)) if f.is_file]

        def commit(self, messages):
            keep = {f for m in messages if m is not None for f in m.files}
            where, files = self._listed()
            for f in files:
                stale = f.base_name.endswith(".xlsx") and f.base_name not in keep and (self.overwrite or self.job in f.base_name)
                if stale or f.base_name.endswith(".tmp"):
                    where.delete_file(f.path)

        def abort(self, messages):
            where, files = self._listed()
            for f in files:
                if self.job in f.base_name:
                    where.delete_file(f.path)

    class WorkbookDataSource(DataSource):
        """``df.write.format("kestrel_workbook").option("sheet", …).save(dir)``"""

        @classmethod
        def name(cls):
            return "kestrel_workbook"

        def writer(self, schema, overwrite):
            return WorkbookWriter(self.options, schema, overwrite)

    HAVE_DATASOURCE = True
except ImportError:  # pragma: no cover
    HAVE_DATASOURCE = False


def workbook_write(df: DataFrame, path: str, sheet: str = DEFAULT_SHEET, row_cap: int | None = None,
                   mode: str = "overwrite") -> None:
    """One workbook per task (more when a task exceeds ``row_cap`` rows)
    under the folder ``path`` (a shared folder, see ``_filesystem``)."""
    from kestrel.session import ensure_shipped
    spark = df.sparkSession
    ensure_shipped(spark)
    spark.dataSource.register(WorkbookDataSource)
    w = df.write.format("kestrel_workbook").mode(mode).option("sheet", sheet)
    if row_cap:
        w = w.option("row_cap", str(row_cap))
    w.save(path)


def report_workbook(sheets: dict[str, DataFrame | tuple[DataFrame, int, int]], path: str,
                    name: str = "report.xlsx") -> str:
    """One workbook with a named sheet per table, each at its own first row
    and column ((table, row, column); default 0, 0), rows in the tables'
    order.  Reports: a sheet holds at most the file format's
    MAX_SHEET_ROWS rows, and more than that raises."""
    parts = []
    for title, what in sheets.items():
        df, row, col = what if isinstance(what, tuple) else (what, 0, 0)
        rows = [tuple(r) for r in df.limit(MAX_SHEET_ROWS - row).collect()]  # bounded by the file format
        if len(rows) > MAX_SHEET_ROWS - row - 1:
            raise ValueError(f"sheet {title!r} has more rows than a sheet can hold")
        parts.append((title, df.columns, rows, row, col))
    _put(path, name, workbook_sheets(parts))
    return f"{path.rstrip('/')}/{name}"
