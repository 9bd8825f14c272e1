"""Writers."""

from __future__ import annotations

import re
import zipfile
from xml.sax.saxutils import escape

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.nested import side_tables


def output_text(df: DataFrame) -> DataFrame:
    """The first of content, markdown and text that a row has."""
    have = [c for c in ("content", "markdown", "text") if c in df.columns]
    return df.withColumn("output", F.coalesce(*have) if have else F.lit(None).cast("string"))


def write_formats(df: DataFrame, path: str, formats: tuple[str, ...] = ("text", "markdown", "json")) -> None:
    """A folder for each format, with the output as text or the whole row as JSON."""
    out = output_text(df)
    for f in formats:
        if f == "json":
            out.drop("output").write.mode("overwrite").json(f"{path}/json")
        else:
            out.select("output").where("output is not null").write.mode("overwrite").option("lineSep", "\n").text(f"{path}/{f}")


def write_csv_split(df: DataFrame, path: str, key: str) -> None:
    """Scalar columns as one CSV, each nested column as its own."""
    flat, sides = side_tables(df, key)
    flat.write.mode("overwrite").csv(f"{path}/main", header=True)
    for name, t in sides.items():
        simple = t.select(
            key, "place",
            F.to_json("value").alias("value") if t.schema["value"].dataType.typeName() in ("struct", "array", "map") else F.col("value").cast("string"),
        )
        simple.write.mode("overwrite").csv(f"{path}/{name}", header=True)


def merged(*named: tuple[str, DataFrame]) -> DataFrame:
    """All rows with the columns of any, and ``source``, the name of where a row is from."""
    out = None
    for name, df in named:
        one = df.withColumn("source", F.lit(name))
        out = one if out is None else out.unionByName(one, allowMissingColumns=True)
    return out


def column_widths(df: DataFrame, most: int = 50) -> DataFrame:
    """(column, width) for a sheet: the longest value or the name, and 2; at most ``most``."""
    cols = df.columns
    w = df.agg(
        *(F.least(F.greatest(F.coalesce(F.max(F.length(F.col(c).cast("string"))), F.lit(0)), F.lit(len(c))) + 2, F.lit(most)).alias(c) for c in cols)
    )
    return w.unpivot([], cols, "column", "width")


#: Rows that a sheet can hold below its header.
SHEET_ROWS = 1_048_575
#: Characters that a cell can hold.
CELL_CHARS = 32_767


def write_workbook(path: str, sheets: dict[str, DataFrame]) -> None:
    """A workbook with a sheet for each DataFrame: bold header, columns as wide as their longest value.

    A workbook is one file on the driver's side; rows come to it in a stream, and a frame of more rows than a sheet holds, or with a
    longer value than a cell holds, is an error before anything is written.
    """
    for name, df in sheets.items():
        if df.limit(SHEET_ROWS + 1).count() > SHEET_ROWS:
            raise ValueError(f"{name} has more rows than a sheet holds")
        longest = df.select(F.coalesce(F.greatest(F.lit(0), *(F.max(F.length(F.col(f"`{c}`").cast("string"))) for c in df.columns)), F.lit(0)).alias("n")).first().n
        if longest > CELL_CHARS:
            raise ValueError(f"{name} has a value of {longest} characters; a cell holds {CELL_CHARS}")
    names = [re.sub(r"[:\\/?*\[\]]", "_", n)[:31] for n in sheets]
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    package = "http://schemas.openxmlformats.org/package/2006"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        n = range(1, len(names) + 1)
        z.writestr(
            "[Content_Types].xml",
            f'<Types xmlns="{package}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/><Override PartName="/xl/styles.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.styles+xml"/>' + "".join(f'<Override PartName="/xl/worksheets/sheet{i}.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>' for i in n) + "</Types>",
        )
        z.writestr(
            "_rels/.rels",
            f'<Relationships xmlns="{package}/relationships"><Relationship Id="r1" Type="{rel}/officeDocument" Target="xl/workbook.xml"/></Relationships>',
        )
        z.writestr(
            "xl/workbook.xml",
            f'<workbook xmlns="{main}" xmlns:r="{rel}"><sheets>' + "".join(f'<sheet name="{escape(x, {chr(34): "&quot;"})}" sheetId="{i}" r:id="s{i}"/>' for i, x in zip(n, names)) + "</sheets></workbook>",
        )
        z.writestr(
            "xl/_rels/workbook.xml.rels",
            f'<Relationships xmlns="{package}/relationships">' + "".join(f'<Relationship Id="s{i}" Type="{rel}/worksheet" Target="worksheets/sheet{i}.xml"/>' for i in n) + f'<Relationship Id="st" Type="{rel}/styles" Target="styles.xml"/></Relationships>',
        )
        z.writestr(
            "xl/styles.xml",
            f'<styleSheet xmlns="{main}"><fonts count="2"><font/><font><b/></font></fonts><fills count="1"><fill/></fills><borders count="1"><border/></borders><cellStyleXfs count="1"><xf/></cellStyleXfs><cellXfs count="2"><xf/><xf fontId="1" applyFont="1"/></cellXfs></styleSheet>',
        )
        for i, df in zip(n, sheets.values()):
            widths = {r.column: r.width for r in column_widths(df).collect()}
            with z.open(f"xl/worksheets/sheet{i}.xml", "w") as f:
                put = lambda s: f.write(s.encode())  # noqa: B023, E731
                put(
                    f'<worksheet xmlns="{main}"><cols>' + "".join(f'<col min="{k}" max="{k}" width="{widths[c]}" customWidth="1"/>' for k, c in enumerate(df.columns, 1)) + "</cols><sheetData>"
                )
                put("<row>" + "".join(_cell(c, ' s="1"') for c in df.columns) + "</row>")
                for row in df.toLocalIterator(prefetchPartitions=True):
                    put("<row>" + "".join(_cell(v) for v in row) + "</row>")
                put("</sheetData></worksheet>")


def _cell(v, style: str = "") -> str:
    if v is None:
        return "<c/>"
    if isinstance(v, (int, float)) and not isinstance(v, bool) and v == v and abs(v) != float("inf"):
        return f"<c{style}><v>{v}</v></c>"
    text = re.sub(r"[\x00-\x08\x0b\x0c\x0e-\x1f]", "", str(v))
    return f'<c{style} t="inlineStr"><is><t xml:space="preserve">{escape(text)}</t></is></c>'
