"""Flat tabs: row shapes, CSV, JSON lines, workbooks and pluggable sheets."""

from __future__ import annotations

import zipfile
from collections.abc import Iterable
from typing import Protocol
from xml.sax.saxutils import escape

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ISO = "yyyy-MM-dd'T'HH:mm:ss"


def iso(c: Column) -> Column:
    """A timestamp of the session's zone, UTC here, in one ISO form without a zone."""
    return F.date_format(c, ISO)


def cell(c: Column, kind: T.DataType) -> Column:
    """A value as text: arrays joined by a comma and a blank, null as the empty text."""
    if isinstance(kind, T.ArrayType):
        return F.coalesce(F.array_join(c.cast("array<string>"), ", "), F.lit(""))
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.coalesce(iso(c), F.lit(""))
    return F.coalesce(c.cast("string"), F.lit(""))


def stringify(df: DataFrame, headers: list[str]) -> DataFrame:
    """The headers' columns as text, in their order; missing ones are empty, others are left out."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    return df.select(*[cell(F.col(f"`{h}`"), kinds[h]).alias(h) if h in kinds else F.lit("").alias(h) for h in headers])


def flatten(df: DataFrame, paths: dict[str, str]) -> DataFrame:
    """Columns named by dotted headers out of nested records: header to path; nulls of text become empty, timestamps ISO."""
    out = []
    for header, path in paths.items():
        kind = df.select(F.col(path)).schema[0].dataType
        c = F.col(path)
        if isinstance(kind, T.ArrayType):
            c = F.coalesce(F.array_join(c, ", "), F.lit(""))
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            c = iso(c)
        elif isinstance(kind, T.StringType):
            c = F.coalesce(c, F.lit(""))
        out.append(c.alias(header))
    return df.select(*out)


def write_csv(df: DataFrame, headers: list[str], path: str, files: int | None = 1) -> bool:
    """A header line and the rows; an empty tab is not written. files: None leaves as many files as there are tasks."""
    rows = stringify(df, headers)
    if rows.isEmpty():
        return False
    (rows.coalesce(files) if files else rows).write.mode("overwrite").option("header", True).option("escape", '"').option("emptyValue", "").csv(path)
    return True


def append_json(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def column_widths(df: DataFrame, headers: list[str], order: list[str], sampled: int = 200, least: int = 12, most: int = 60) -> DataFrame:
    """(header, width): the longest of the header and the first sampled values, and two, within bounds."""
    first = stringify(df.orderBy(*order).limit(sampled), headers)
    longest = first.agg(*[F.coalesce(F.max(F.length(f"`{h}`")), F.lit(0)).alias(h) for h in headers])
    pairs = F.array(*[F.struct(F.lit(h).alias("header"), F.greatest(F.lit(len(h)), F.col(f"`{h}`")).alias("n")) for h in headers])
    return longest.select(F.explode(pairs).alias("x")).select("x.header", F.greatest(F.lit(least), F.least(F.lit(most), F.col("x.n") + 2)).cast("int").alias("width"))


def _letters(k: int) -> str:
    out = ""
    while k >= 0:
        out, k = chr(65 + k % 26) + out, k // 26 - 1
    return out


def write_workbook(tabs: dict[str, tuple[list[str], Iterable[list[str]]]], path: str, widths: dict[str, list[int]] | None = None) -> None:
    """A workbook of inline texts: every tab is there, its header is frozen; rows stream from an iterator into the file."""
    kinds = "".join(f'<Override PartName="/xl/worksheets/sheet{k}.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>' for k in range(1, len(tabs) + 1))
    head = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
    main, rel = "http://schemas.openxmlformats.org/spreadsheetml/2006/main", "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    package = "http://schemas.openxmlformats.org/package/2006"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("[Content_Types].xml", f'{head}<Types xmlns="{package}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>{kinds}</Types>')
        z.writestr("_rels/.rels", f'{head}<Relationships xmlns="{package}/relationships"><Relationship Id="rId1" Type="{rel}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        sheets = "".join(f'<sheet name="{escape(name[:31], {chr(34): "&quot;"})}" sheetId="{k}" r:id="rId{k}"/>' for k, name in enumerate(tabs, 1))
        z.writestr("xl/workbook.xml", f'{head}<workbook xmlns="{main}" xmlns:r="{rel}"><sheets>{sheets}</sheets></workbook>')
        links = "".join(f'<Relationship Id="rId{k}" Type="{rel}/worksheet" Target="worksheets/sheet{k}.xml"/>' for k in range(1, len(tabs) + 1))
        z.writestr("xl/_rels/workbook.xml.rels", f'{head}<Relationships xmlns="{package}/relationships">{links}</Relationships>')
        for k, (name, (headers, rows)) in enumerate(tabs.items(), 1):
            with z.open(f"xl/worksheets/sheet{k}.xml", "w") as f:
                columns = "".join(f'<col min="{i}" max="{i}" width="{w}" customWidth="1"/>' for i, w in enumerate((widths or {}).get(name, []), 1))
                f.write(f'{head}<worksheet xmlns="{main}"><sheetViews><sheetView workbookViewId="0"><pane ySplit="1" topLeftCell="A2" state="frozen"/></sheetView></sheetViews>{f"<cols>{columns}</cols>" if columns else ""}<sheetData>'.encode())
                for r, values in enumerate(_chain(headers, rows), 1):
                    cells = "".join(f'<c r="{_letters(i)}{r}" t="inlineStr"><is><t xml:space="preserve">{escape(_legal(v))}</t></is></c>' for i, v in enumerate(values))
                    f.write(f'<row r="{r}">{cells}</row>'.encode())
                f.write(b"</sheetData></worksheet>")


def _chain(headers, rows):
    yield headers
    yield from rows


def _legal(v: str) -> str:
    return "".join(c for c in v if c in "\t\n\r" or c >= " ")


class TabSink(Protocol):
    """Where tabs are pushed: a sheet service, or a double of one."""

    def replace(self, name: str, headers: list[str], rows: Iterable[list[str]]) -> None: ...


class SinkNotConfigured(RuntimeError):
    pass


class MemorySink:
    """A double of a sheet service: tabs by name, replaced whole."""

    def __init__(self):
        self.tabs: dict[str, list[list[str]]] = {}

    def replace(self, name: str, headers: list[str], rows: Iterable[list[str]]) -> None:
        self.tabs[name] = [headers, *rows]


def push(tabs: dict[str, tuple[list[str], DataFrame]], sink: TabSink | None) -> None:
    """Clears and replaces each tab; rows stream through the driver, a partition at a time."""
    if sink is None:
        raise SinkNotConfigured("no sink for tabs")
    for name, (headers, df) in tabs.items():
        sink.replace(name, headers, (list(r) for r in stringify(df, headers).toLocalIterator()))
