"""Writers: tables as CSV, JSON lines, GraphML, Markdown and HTML, and table rewrites."""

from __future__ import annotations

import io
import os
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from xml.sax.saxutils import escape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def flat(df: DataFrame) -> DataFrame:
    """df with arrays joined by a bar."""
    return df.select(*(F.array_join(F.col(f.name).cast("array<string>"), "|").alias(f.name) if f.dataType.typeName() == "array" else F.col(f.name) for f in df.schema))


def csv(df: DataFrame, path: str) -> None:
    """Arrays joined by a bar; partitioned output, header in each part."""
    flat(df).write.mode("overwrite").option("header", True).option("quoteAll", False).csv(path)


def sorted_csv(df: DataFrame, path: str, *order: str) -> None:
    """The same in the order of some columns: parts are ranges of it, and sorted."""
    flat(df.repartitionByRange(*order).sortWithinPartitions(*order)).write.mode("overwrite").option("header", True).csv(path)


#: Columns of an edge list, in order.
EDGE_COLUMNS = ["origen", "destino", "peso", "tipo_vinculo", "direccionalidad", "frecuencia", "canal", "etapa_ciclo", "evidencia_doc_id"]


def edge_list(links: DataFrame, path: str) -> None:
    """The nine columns of the edges by origin and destination; columns that are missing are blank."""
    sorted_csv(links.select(*(F.col(c) if c in links.columns else F.lit(None).cast("string").alias(c) for c in EDGE_COLUMNS)), path, "origen", "destino")


def json_document(one: DataFrame, path: str) -> None:
    """The first row as one JSON document, nulls included."""
    one.limit(1).select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value")).coalesce(1).write.mode("overwrite").text(path)


def save_bytes(spark: SparkSession, path: str, data: bytes) -> None:
    """A file with these bytes, in any store that Spark writes."""
    jvm = spark._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    out = place.getFileSystem(spark._jsc.hadoopConfiguration()).create(place, True)
    out.write(bytearray(data))
    out.close()


def save_texts(rows: DataFrame, folder: str, parts: int = 256) -> int:
    """A file `folder/<part>/<name>.<number>.txt` of each row (name, text), whose name has no slash; their number.

    The tasks write the files, dealt to `parts` by their names, each under a name
    of its own first, so that tasks that run again or twice do no harm. The
    folder is one that all executors share, by a path or a file: URI; in other
    stores Spark's writer makes a folder of one file for each name, which ends
    in a line feed that its text does not have.
    """
    # the number tells rows of the same name apart, and is the same if a task runs again
    rows = rows.select(F.concat(F.coalesce("name", F.lit("")), F.lit("."), F.monotonically_increasing_id().cast("string")).alias("name"), "text")
    if "://" in folder.removeprefix("file://"):
        rows.write.partitionBy("name").option("mapreduce.fileoutputcommitter.algorithm.version", "2").text(folder)
        return rows.count()
    root = "/" + folder.removeprefix("file:").lstrip("/")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = 0
        for batch in batches:
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()), strict=True):
                place = f"{root}/{zlib.crc32(name.encode()) % parts:03x}"
                os.makedirs(place, exist_ok=True)
                own = f"{place}/.{uuid.uuid4().hex}"
                with open(own, "wb") as out:
                    out.write(text.as_buffer())
                os.replace(own, f"{place}/{name}.txt")
                n += 1
        yield pa.RecordBatch.from_arrays([pa.array([n])], ["n"])

    return rows.mapInArrow(run, "n long").agg(F.sum("n")).first()[0] or 0


def _zipped(parts: dict[str, str]) -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name, text in parts.items():
            z.writestr(name, '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>' + text)
    return out.getvalue()


_KINDS = "http://schemas.openxmlformats.org/package/2006/content-types"
_LINKS = "http://schemas.openxmlformats.org/package/2006/relationships"
_OFFICE = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"


def docx(paragraphs: list[tuple[str, int]], rows: list[list[str]] = ()) -> bytes:
    """A document of (text, heading level or 0) paragraphs and one table."""
    size = {1: 36, 2: 28, 3: 24}
    body = "".join(f'<w:p><w:r><w:rPr>{"<w:b/>" if level else ""}<w:sz w:val="{size.get(level, 22)}"/></w:rPr><w:t xml:space="preserve">{escape(text)}</w:t></w:r></w:p>' for text, level in paragraphs)
    if rows:
        body += "<w:tbl>" + "".join("<w:tr>" + "".join(f"<w:tc><w:p><w:r><w:t>{escape(c)}</w:t></w:r></w:p></w:tc>" for c in row) + "</w:tr>" for row in rows) + "</w:tbl>"
    return _zipped(
        {
            "[Content_Types].xml": f'<Types xmlns="{_KINDS}"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Override PartName="/word/document.xml" ContentType="application/vnd.openxmlformats-officedocument.wordprocessingml.document.main+xml"/></Types>',
            "_rels/.rels": f'<Relationships xmlns="{_LINKS}"><Relationship Id="r1" Type="{_OFFICE}/officeDocument" Target="word/document.xml"/></Relationships>',
            "word/document.xml": f'<w:document xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"><w:body>{body}</w:body></w:document>',
        }
    )


def xlsx(rows: list[list[str]]) -> bytes:
    """A workbook of one sheet of text cells."""
    data = "".join(f'<row r="{i}">' + "".join(f'<c t="inlineStr"><is><t xml:space="preserve">{escape(c)}</t></is></c>' for c in row) + "</row>" for i, row in enumerate(rows, 1))
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    return _zipped(
        {
            "[Content_Types].xml": f'<Types xmlns="{_KINDS}"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/><Override PartName="/xl/worksheets/sheet1.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/></Types>',
            "_rels/.rels": f'<Relationships xmlns="{_LINKS}"><Relationship Id="r1" Type="{_OFFICE}/officeDocument" Target="xl/workbook.xml"/></Relationships>',
            "xl/workbook.xml": f'<workbook xmlns="{main}" xmlns:r="{_OFFICE}"><sheets><sheet name="1" sheetId="1" r:id="r1"/></sheets></workbook>',
            "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="{_LINKS}"><Relationship Id="r1" Type="{_OFFICE}/worksheet" Target="worksheets/sheet1.xml"/></Relationships>',
            "xl/worksheets/sheet1.xml": f'<worksheet xmlns="{main}"><sheetData>{data}</sheetData></worksheet>',
        }
    )


#: Rows of a report that office files take at most.
OFFICE_ROWS = 10_000


def report(df: DataFrame, path: str, title: str) -> int:
    """df as a DOCX or XLSX report, by the path's ending, with a header; more than OFFICE_ROWS rows are an error. The number of rows."""
    got = df.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in flat(df).columns)).limit(OFFICE_ROWS + 1).collect()
    if len(got) > OFFICE_ROWS:
        raise ValueError(f"a report takes {OFFICE_ROWS} rows at most")
    rows = [df.columns, *(list(r) for r in got)]
    save_bytes(df.sparkSession, path, xlsx(rows) if path.endswith(".xlsx") else docx([(title, 1)], rows))
    return len(got)


def json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def _escape(c):
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def graphml_lines(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(line): one XML element per vertex and edge, to be written as text between a header and a footer."""
    value = lambda f: F.array_join(F.col(f.name).cast("array<string>"), "|") if f.dataType.typeName() == "array" else F.col(f.name).cast("string")
    data = lambda df, skip: F.concat_ws("", *(F.concat(F.lit(f'<data key="{f.name}">'), _escape(value(f)), F.lit("</data>")) for f in df.schema if f.name not in skip))
    n = nodes.select(F.concat(F.lit('<node id="'), _escape(F.col("nid")), F.lit('">'), data(nodes, {"nid"}), F.lit("</node>")).alias("line"))
    e = edges.select(F.concat(F.lit('<edge source="'), _escape(F.col("src")), F.lit('" target="'), _escape(F.col("dst")), F.lit('">'), data(edges, {"src", "dst"}), F.lit("</edge>")).alias("line"))
    return n.unionByName(e)


def graphml(nodes: DataFrame, edges: DataFrame, path: str) -> None:
    """A folder of text parts; head and foot are parts of their own, first and last by name."""
    spark = nodes.sparkSession
    body = graphml_lines(nodes, edges).withColumn("_o", F.lit(1))
    ends = spark.createDataFrame([('<?xml version="1.0" encoding="UTF-8"?><graphml><graph edgedefault="undirected">', 0), ("</graph></graphml>", 2)], "line string, _o int")
    ends.unionByName(body).repartitionByRange("_o").sortWithinPartitions("_o").select("line").write.mode("overwrite").text(path)


def markdown_table(df: DataFrame) -> DataFrame:
    """(line): header, rule and a row per record."""
    spark = df.sparkSession
    head = spark.createDataFrame([("| " + " | ".join(df.columns) + " |",), ("|" + "---|" * len(df.columns),)], "line string")
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns]
    return head.union(df.select(F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |")).alias("line")))


def html_table(df: DataFrame, title: str, most: int = 30) -> DataFrame:
    """(html), one row: a page with the first rows as a table (a report, so it is limited)."""
    cells = F.concat_ws("", *(F.concat(F.lit("<td>"), _escape(F.coalesce(F.col(c).cast("string"), F.lit(""))), F.lit("</td>")) for c in df.columns))
    rows = df.limit(most).select(F.concat(F.lit("<tr>"), cells, F.lit("</tr>")).alias("r"))
    head = "".join(f"<th>{c}</th>" for c in df.columns)
    return rows.agg(F.concat(F.lit(f"<html><head><title>{title}</title></head><body><table><tr>{head}</tr>"), F.coalesce(F.listagg("r"), F.lit("")), F.lit("</table></body></html>")).alias("html"))


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """old with new's rows in place of those with the same keys."""
    return old.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new, allowMissingColumns=True)


def export_all(tables: dict[str, DataFrame], folder: str) -> list[str]:
    """CSV folders of the tables that have rows; their names."""
    done = []
    for name, df in tables.items():
        if df.limit(1).count():
            csv(df, f"{folder}/{name}")
            done.append(name)
    return done


def pdf(pages: list[list[tuple[str, float]]]) -> bytes:
    """A plain PDF: pages of (line, font size), for characters of the Windows code page."""
    objects = ["<</Type /Catalog /Pages 2 0 R>>", f"<</Type /Pages /Count {len(pages)} /Kids [{' '.join(f'{4 + 2 * i} 0 R' for i in range(len(pages)))}]>>", "<</Type /Font /Subtype /Type1 /BaseFont /Helvetica /Encoding /WinAnsiEncoding>>"]
    parts = [o.encode() for o in objects]
    for i, lines in enumerate(pages):
        shown, y = b"", 780.0
        for text, size in lines:
            raw = text.encode("cp1252", "replace").replace(b"\\", rb"\\").replace(b"(", rb"\(").replace(b")", rb"\)")
            shown += b"BT /F1 %.1f Tf 50 %.1f Td (%s) Tj ET\n" % (size, y, raw)
            y -= 1.3 * size
        packed = zlib.compress(shown)
        parts.append(b"<</Type /Page /Parent 2 0 R /MediaBox [0 0 595 842] /Resources <</Font <</F1 3 0 R>>>> /Contents %d 0 R>>" % (5 + 2 * i))
        parts.append(b"<</Length %d /Filter /FlateDecode>>\nstream\n%s\nendstream" % (len(packed), packed))
    out, at = b"%PDF-1.4\n", []
    for n, part in enumerate(parts, 1):
        at.append(len(out))
        out += b"%d 0 obj\n%s\nendobj\n" % (n, part)
    table = b"".join(b"%010d 00000 n \n" % x for x in at)
    return out + b"xref\n0 %d\n0000000000 65535 f \n%strailer <</Size %d /Root 1 0 R>>\nstartxref\n%d\n%%%%EOF\n" % (len(parts) + 1, table, len(parts) + 1, len(out))
