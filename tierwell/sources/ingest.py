"""Multi-file tabular ingest (S1), header normalisation (S2), stacking by name (S3).

All files matching a glob are read and stacked by column name; columns a file
lacks are NULL. Headers are normalised (lower case, ``/`` and space -> ``_``;
names that become equal are numbered). ``usecols`` chooses columns by name,
by position, or by a string of sheet letters (``"A:C,E"``); a name that no
file has is an error.

* parquet / json: one Spark read (schema merge / inference across files);
* csv: files are grouped by their header line, of which only the first line
  is read; each group is one Spark CSV read, and the groups are stacked with
  ``unionByName(allowMissingColumns=True)``;
* xlsx: workbooks are read as binary files and parsed one workbook per task
  with the standard library (zip + XML; no spreadsheet package is needed). A
  sheet is chosen by its place in the workbook or by its name. A column whose
  cells are all numbers, truth values or dates gets that type; others are
  text.
"""

from __future__ import annotations

import csv
import datetime as dt
import io
import re
import zipfile
from xml.etree import ElementTree
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions.names import normalize_header


def unique_names(names) -> list[str]:
    """Normalised headers; the second and later of equal ones get ``_2``, ``_3``, ..."""
    out: list[str] = []
    for name in map(normalize_header, names):
        k, full = 1, name
        while full in out:
            k += 1
            full = f"{name}_{k}"
        out.append(full)
    return out


def normalize_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*unique_names(df.columns))


def stack(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def _col_index(letters: str) -> int:
    n = 0
    for ch in letters.upper():
        n = n * 26 + (ord(ch) - 64)
    return n - 1


def chosen(names: list[str], usecols) -> list[str]:
    """The columns of one header that ``usecols`` asks for, in the header's order.

    A string holds letters and ranges of letters; a list holds positions or
    names. Letters and positions past the header choose nothing there; names
    are checked against all files by the caller.
    """
    if usecols is None:
        return names
    if isinstance(usecols, str):
        places: set[int] = set()
        for part in usecols.split(","):
            m = re.fullmatch(r"\s*([A-Za-z]+)\s*(?::\s*([A-Za-z]+)\s*)?", part)
            if not m:
                raise ValueError(f"usecols: {part!r} is neither a column letter nor a range of them")
            places |= set(range(_col_index(m[1]), _col_index(m[2] or m[1]) + 1))
        return [n for k, n in enumerate(names) if k in places]
    if all(isinstance(c, int) for c in usecols):
        return [n for k, n in enumerate(names) if k in set(usecols)]
    wanted = {normalize_header(c) for c in usecols}
    return [n for n in names if n in wanted]


def _check(found: list[str], usecols) -> None:
    if usecols is not None and not isinstance(usecols, str) and not all(isinstance(c, int) for c in usecols):
        missing = [c for c in usecols if normalize_header(c) not in found]
        if missing:
            raise ValueError(f"usecols: no file has {missing}")
    if not found:
        raise ValueError("usecols chooses no column")


def _select(df: DataFrame, usecols) -> DataFrame:
    names = chosen(df.columns, usecols)
    _check(names, usecols)
    return df.select(*names)


def _csv_headers(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """Files by header line: the driver lists them and opens each for its first line only."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    glob = jvm.org.apache.hadoop.fs.Path(path)
    fs = glob.getFileSystem(conf)
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)
    files = []
    for status in fs.globStatus(glob) or []:
        inside = fs.listStatus(status.getPath()) if status.isDirectory() else [status]
        files += [f.getPath() for f in inside
                  if f.isFile() and not f.getPath().getName().startswith(("_", "."))]
    if not files:
        raise FileNotFoundError(f"no file matches {path}")
    groups: dict[str, list[str]] = {}
    for f in files:
        stream, codec = fs.open(f), codecs.getCodec(f)
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(
            codec.createInputStream(stream) if codec is not None else stream, "UTF-8"))
        head = reader.readLine()
        reader.close()
        if head is not None:                   # an empty file has no rows
            groups.setdefault(head.removeprefix("\ufeff"), []).append(f.toString())
    return groups


def read_files(spark: SparkSession, path: str, fmt: str = "csv", usecols=None, sheet: int | str = 0,
               **options) -> DataFrame:
    """Read every file matching ``path`` and stack them by normalised column name."""
    if fmt == "parquet":
        df = spark.read.option("mergeSchema", "true").options(**options).parquet(path)
        return _select(normalize_columns(df), usecols)
    if fmt == "json":
        return _select(normalize_columns(spark.read.options(**options).json(path)), usecols)
    if fmt == "csv":
        frames = []
        sep = options.get("sep", options.get("delimiter", ","))
        for head, paths in _csv_headers(spark, path).items():
            df = spark.read.options(header="true", **options).csv(paths)
            # the header as written: Spark renames names that differ in case only
            names = next(csv.reader([head], delimiter=sep))
            df = df.toDF(*unique_names(names if len(names) == len(df.columns) else df.columns))
            frames.append(df.select(*chosen(df.columns, usecols)))
        out = stack(frames)
        _check(out.columns, usecols)
        return out
    if fmt == "xlsx":
        return read_xlsx(spark, path, sheet, usecols)
    raise ValueError(f"unsupported format {fmt}")


# ---- xlsx (Office Open XML spreadsheet) -----------------------------------
_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main"}
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
_REF = re.compile(r"([A-Z]+)(\d+)")
# Built-in number formats that show dates and times.
_DATE_FORMATS = {*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)}
_TYPES = {"number": T.DoubleType(), "integer": T.LongType(), "boolean": T.BooleanType(),
          "date": T.TimestampNTZType()}


def _sheet_file(z: zipfile.ZipFile, sheet: int | str) -> str:
    """Part name of a sheet by its place in the workbook or by its name."""
    names = set(z.namelist())
    if "xl/workbook.xml" not in names:           # a bare part list: by number
        parts = sorted((n for n in names if re.fullmatch(r"xl/worksheets/sheet\d+\.xml", n)),
                       key=lambda n: int(re.findall(r"\d+", n)[-1]))
        return parts[int(sheet)]
    rels = {r.get("Id"): r.get("Target") for r in
            ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
    listed = [(s.get("name"), rels[s.get(_REL)]) for s in
              ElementTree.fromstring(z.read("xl/workbook.xml")).iter(f"{{{_NS['m']}}}sheet")]
    if isinstance(sheet, str):
        found = [t for n, t in listed if n == sheet]
        if not found:
            raise ValueError(f"no sheet is named {sheet!r}")
        target = found[0]
    else:
        target = listed[sheet][1]
    return target.lstrip("/") if target.startswith("/") else f"xl/{target}"


def _date_styles(z: zipfile.ZipFile) -> set[int]:
    """Numbers of the cell styles that show dates."""
    if "xl/styles.xml" not in z.namelist():
        return set()
    root = ElementTree.fromstring(z.read("xl/styles.xml"))
    own = {int(f.get("numFmtId")) for f in root.iter(f"{{{_NS['m']}}}numFmt")
           if re.search(r"[ymdhs]", re.sub(r'"[^"]*"|\[[^]]*\]', "", f.get("formatCode") or ""), re.I)}
    xfs = root.find("m:cellXfs", _NS)
    return {k for k, xf in enumerate(xfs if xfs is not None else [])
            if int(xf.get("numFmtId") or 0) in _DATE_FORMATS | own}


def xlsx_cells(data: bytes, sheet: int | str = 0) -> list[list[tuple[str, str] | None]]:
    """Rows of one worksheet as lists of (kind, text); None for empty cells."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        shared = []
        if "xl/sharedStrings.xml" in z.namelist():
            root = ElementTree.fromstring(z.read("xl/sharedStrings.xml"))
            for si in root.findall("m:si", _NS):
                shared.append("".join(t.text or "" for t in si.iter(f"{{{_NS['m']}}}t")))
        dates = _date_styles(z)
        root = ElementTree.fromstring(z.read(_sheet_file(z, sheet)))
    out = []
    for row in root.iter(f"{{{_NS['m']}}}row"):
        cells: dict[int, tuple[str, str] | None] = {}
        for c in row.findall("m:c", _NS):
            ref = c.get("r")
            at = _col_index(_REF.match(ref).group(1)) if ref else max(cells, default=-1) + 1
            kind, v = c.get("t") or "n", c.find("m:v", _NS)
            if kind == "inlineStr":
                cells[at] = ("text", "".join(t.text or "" for t in c.iter(f"{{{_NS['m']}}}t")))
            elif v is None or v.text is None:
                cells[at] = None
            elif kind == "s":
                cells[at] = ("text", shared[int(v.text)])
            elif kind == "b":
                cells[at] = ("boolean", "true" if v.text == "1" else "false")
            elif kind == "n" and int(c.get("s") or 0) in dates:
                day = dt.datetime(1899, 12, 30) + dt.timedelta(days=float(v.text))
                cells[at] = ("date", day.isoformat(sep=" ", timespec="seconds"))
            elif kind == "n":
                number = float(v.text)
                whole = number.is_integer() and abs(number) < 2 ** 53
                cells[at] = ("integer", str(int(number))) if whole else ("number", v.text)
            elif kind != "e":                    # error values are empty cells
                cells[at] = ("text", v.text)
        out.append([cells.get(i) for i in range(max(cells) + 1 if cells else 0)])
    return out


def xlsx_rows(data: bytes, sheet: int | str = 0) -> list[list[str | None]]:
    """Rows of one worksheet as lists of cell texts (None for empty cells)."""
    return [[c and c[1] for c in row] for row in xlsx_cells(data, sheet)]


def _columns(rows, usecols) -> dict[str, int]:
    """Chosen column names of a sheet and their places."""
    head = rows[0] if rows else []
    names = unique_names([(c and c[1]) or f"unnamed:_{k}" for k, c in enumerate(head)])
    return {n: names.index(n) for n in chosen(names, usecols)}


def read_xlsx(spark: SparkSession, path: str, sheet: int | str = 0, usecols=None) -> DataFrame:
    """One sheet of all workbooks matching ``path``, stacked by header."""
    files = spark.read.format("binaryFile").load(path).select("content")

    def kinds(batches):
        for pdf in batches:
            for content in pdf["content"]:
                rows = xlsx_cells(bytes(content), sheet)
                found = [(at, n, sorted({r[at][0] for r in rows[1:] if at < len(r) and r[at]}))
                         for n, at in _columns(rows, usecols).items()]
                yield pd.DataFrame([(n, at, k) for at, n, ks in found for k in ks or [None]],
                                   columns=["name", "at", "kind"])
    # one small row per distinct column and kind of value
    seen = (files.mapInPandas(kinds, "name string, at int, kind string")
            .groupBy("name").agg(F.min("at").alias("at"), F.collect_set("kind").alias("kinds")).collect())
    seen.sort(key=lambda r: (r["at"], r["name"]))
    _check([r["name"] for r in seen], usecols)
    fields = []
    for r in seen:
        kind = set(r["kinds"])
        kind = kind.pop() if len(kind) == 1 else "number" if kind == {"integer", "number"} else "text"
        fields.append((r["name"], _TYPES.get(kind, T.StringType())))
    names = [n for n, _ in fields]

    def parse(batches):
        for pdf in batches:
            for content in pdf["content"]:
                rows = xlsx_cells(bytes(content), sheet)
                at = _columns(rows, usecols)
                yield pd.DataFrame({n: pd.Series(
                    [r[at[n]][1] if n in at and at[n] < len(r) and r[at[n]] else None for r in rows[1:]],
                    dtype="object") for n in names})
    text = files.mapInPandas(parse, T.StructType([T.StructField(n, T.StringType()) for n in names]))
    return text.select(*[F.col(f"`{n}`").cast(t).alias(n) for n, t in fields])


def _part(name: str, body: str) -> str:
    return f'<?xml version="1.0"?><{name}>{body}</{name.split()[0]}>'


def write_xlsx_bytes(header: list | None, rows: list[list] | None,
                     sheets: dict[str, list[list]] | None = None) -> bytes:
    """A minimal workbook (for tests and fixtures): one sheet, or several by name."""
    sheets = sheets or {"Sheet1": [header, *rows]}

    def cell(ci, ri, v):
        ref = f"{chr(65 + ci)}{ri}"
        if v is None:
            return ""
        if isinstance(v, bool):
            return f'<c r="{ref}" t="b"><v>{int(v)}</v></c>'
        if isinstance(v, (int, float)):
            return f'<c r="{ref}"><v>{v}</v></c>'
        return f'<c r="{ref}" t="inlineStr"><is><t>{escape(v)}</t></is></c>'

    main = f'xmlns="{_NS["m"]}"'
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    package = "http://schemas.openxmlformats.org/package/2006"
    parts = {
        "[Content_Types].xml": _part(f'Types xmlns="{package}/content-types"', ""),
        "xl/workbook.xml": _part(f'workbook {main} xmlns:r="{rel}"', "<sheets>" + "".join(
            f'<sheet name="{escape(n)}" sheetId="{k}" r:id="r{k}"/>' for k, n in enumerate(sheets, 1)) + "</sheets>"),
        # parts are numbered against the order of the workbook on purpose
        "xl/_rels/workbook.xml.rels": _part(f'Relationships xmlns="{package}/relationships"', "".join(
            f'<Relationship Id="r{k}" Target="worksheets/sheet{len(sheets) + 1 - k}.xml"/>'
            for k in range(1, len(sheets) + 1))),
    }
    for k, body in enumerate(sheets.values(), 1):
        parts[f"xl/worksheets/sheet{len(sheets) + 1 - k}.xml"] = _part(f"worksheet {main}", "<sheetData>" + "".join(
            f'<row r="{ri}">' + "".join(cell(ci, ri, v) for ci, v in enumerate(r)) + "</row>"
            for ri, r in enumerate(body, 1)) + "</sheetData>")
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        for name, text in parts.items():
            z.writestr(name, text)
    return buf.getvalue()


__all__ = ["read_files", "read_xlsx", "xlsx_rows", "normalize_columns", "stack"]
