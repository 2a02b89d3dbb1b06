"""Documents as rows: files are read by Spark as bytes and parsed in Arrow functions.

A parser takes a file's bytes and yields (page, text, font size, box) blocks. The
parsers here need no library: JSON lines, DOCX and XLSX (zipped XML), and plain
PDF text (uncompressed or deflated streams with simple fonts). Others, such as
character recognition, plug in the same way, as a fallback where the first finds
no text.
"""

from __future__ import annotations

import io
import json
import re
import zipfile
import zlib
from collections.abc import Callable, Iterable, Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

Block = tuple[int, str, float, list[float]]
Parser = Callable[[bytes], Iterable[Block]]

_W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
_S = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"


def json_blocks(data: bytes) -> Iterator[Block]:
    """Lines of JSON with page, text, and perhaps max_font_size and bbox."""
    for line in data.decode("utf-8").splitlines():
        if line.strip():
            x = json.loads(line)
            yield x["page"], x["text"], float(x.get("max_font_size", 0.0)), [float(v) for v in x.get("bbox", [])]


def _body(data: bytes) -> ElementTree.Element:
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        return ElementTree.fromstring(z.read("word/document.xml")).find(f"{_W}body")


def docx_blocks(data: bytes) -> Iterator[Block]:
    """Paragraphs outside tables, with the largest font size that they set."""
    for p in _body(data).findall(f"{_W}p"):
        sizes = [int(s.get(f"{_W}val")) / 2 for s in p.iter(f"{_W}sz")]
        yield 0, "".join(t.text or "" for t in p.iter(f"{_W}t")), max(sizes, default=0.0), []


def docx_rows(data: bytes) -> Iterator[tuple[str, list[str]]]:
    """(table, cells) of every row of every table."""
    for n, table in enumerate(_body(data).findall(f"{_W}tbl")):
        for row in table.findall(f"{_W}tr"):
            yield str(n), ["\n".join("".join(t.text or "" for t in p.iter(f"{_W}t")) for p in c.findall(f"{_W}p")) for c in row.findall(f"{_W}tc")]


def xlsx_rows(data: bytes) -> Iterator[tuple[str, list[str]]]:
    """(sheet, cells) of every row of every sheet; blank cells keep their place."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        names = z.namelist()
        shared = []
        if "xl/sharedStrings.xml" in names:
            shared = ["".join(t.text or "" for t in s.iter(f"{_S}t")) for s in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).findall(f"{_S}si")]
        for name in sorted(n for n in names if re.fullmatch(r"xl/worksheets/sheet\d+\.xml", n)):
            sheet = name.removeprefix("xl/worksheets/").removesuffix(".xml")
            for row in ElementTree.fromstring(z.read(name)).iter(f"{_S}row"):
                cells: list[str] = []
                for c in row.findall(f"{_S}c"):
                    at = 0
                    for letter in re.match("[A-Z]*", c.get("r", ""))[0]:
                        at = at * 26 + ord(letter) - 64
                    cells += [""] * (at - 1 - len(cells))
                    value = c.findtext(f"{_S}v", "")
                    if c.get("t") == "s":
                        value = shared[int(value)]
                    elif c.get("t") == "inlineStr":
                        value = "".join(t.text or "" for t in c.iter(f"{_S}t"))
                    cells.append(value)
                yield sheet, cells


_TOKEN = re.compile(rb"\((?:\\.|[^\\()])*\)|<[0-9A-Fa-f\s]*>|\[|\]|/[^\s/\[\]()<>]+|[-+]?\d*\.?\d+|[A-Za-z'\"*]+")
_ESCAPES = {b"n": b"\n", b"r": b"\r", b"t": b"\t", b"b": b"\b", b"f": b"\f"}


def _literal(token: bytes) -> str:
    if token.startswith(b"<"):
        raw = re.sub(rb"\s", b"", token[1:-1])
        return bytes.fromhex((raw + b"0" * (len(raw) % 2)).decode()).decode("cp1252", "replace")
    inner = re.sub(rb"\\([0-7]{1,3}|.)", lambda m: bytes([int(m[1], 8) & 255]) if m[1].isdigit() else _ESCAPES.get(m[1], m[1]), token[1:-1], flags=re.S)
    return inner.decode("cp1252", "replace")


def pdf_blocks(data: bytes) -> Iterator[Block]:
    """One block per text object (BT ... ET) of the content streams, with its font size and start.

    Fonts with their own encodings and encrypted files give no text here.
    """
    page = 0
    for m in re.finditer(rb"<<((?:[^<>]|<[^<]|<<.*?>>)*?)>>\s*stream\r?\n(.*?)\r?\nendstream", data, re.S):
        head, raw = m[1], m[2]
        if b"/FlateDecode" in head:
            try:
                raw = zlib.decompressobj().decompress(raw)
            except zlib.error:
                continue
        elif b"/Filter" in head:
            continue
        blocks = []
        for part in re.findall(rb"\bBT\b(.*?)\bET\b", raw, re.S):
            stack: list[bytes] = []
            text, size, spot = [], 0.0, [0.0, 0.0]
            for token in _TOKEN.findall(part):
                if not re.fullmatch(rb"[A-Za-z'\"*]+", token):
                    stack.append(token)
                    continue
                numbers = [float(x) for x in stack if re.fullmatch(rb"[-+]?\d*\.?\d+", x)]
                if token == b"Tf" and numbers:
                    size = max(size, numbers[-1])
                elif token in (b"Td", b"TD", b"Tm") and len(numbers) >= 2:
                    if text:
                        text.append("\n")
                    else:
                        spot = numbers[-2:]
                elif token in (b"T*", b"'", b'"') and text:
                    text.append("\n")
                if token in (b"Tj", b"TJ", b"'", b'"'):
                    text += [_literal(x) for x in stack if x[:1] in (b"(", b"<")]
                stack.clear()
            if text:
                blocks.append(("".join(text), size, spot))
        if blocks:
            page += 1
            for text_, size, spot in blocks:
                yield page, text_, size, spot


def files(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """(path, content) of the files below a folder, from any store that Spark reads."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(folder).select("path", "content")


def blocks(spark: SparkSession, folder: str, pattern: str = "*.pdf", parse: Parser = pdf_blocks, fallback: Parser | None = None, force: bool = False) -> DataFrame:
    """(path, pos, page, text, max_font_size, bbox): the blocks of each file.

    The fallback is asked where the parser finds no text, or always if forced.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows = [] if force and fallback else list(parse(content))
                if fallback and not any(r[1].strip() for r in rows):
                    rows = list(fallback(content))
                page, text, size, box = zip(*rows, strict=True) if rows else ((), (), (), ())
                yield pa.RecordBatch.from_arrays([pa.array([path] * len(rows), pa.string()), pa.array(range(len(rows)), pa.int32()), pa.array(page, pa.int32()), pa.array(text, pa.string()), pa.array(size, pa.float64()), pa.array(box, pa.list_(pa.float64()))], ["path", "pos", "page", "text", "max_font_size", "bbox"])

    return files(spark, folder, pattern).mapInArrow(run, "path string, pos int, page int, text string, max_font_size double, bbox array<double>")


def cells(spark: SparkSession, folder: str, pattern: str = "*.xlsx", parse: Callable[[bytes], Iterable[tuple[str, list[str]]]] = xlsx_rows) -> DataFrame:
    """(path, sheet, row, cells) of the tables in each file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows = list(parse(content))
                yield pa.RecordBatch.from_arrays([pa.array([path] * len(rows), pa.string()), pa.array([r[0] for r in rows], pa.string()), pa.array(range(len(rows)), pa.int32()), pa.array([r[1] for r in rows], pa.list_(pa.string()))], ["path", "sheet", "row", "cells"])

    return files(spark, folder, pattern).mapInArrow(run, "path string, sheet string, row int, cells array<string>")


class _Folder(InputPartition):
    def __init__(self, folder: str) -> None:
        self.folder = folder


class _PageReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.options = options

    def partitions(self) -> list[_Folder]:
        return [_Folder(f) for f in self.options["folders"].split(",")]

    def read(self, partition: _Folder) -> Iterator[tuple]:
        import importlib

        module, _, name = self.options["client"].partition(":")
        client = getattr(importlib.import_module(module), name)
        waiting = [partition.folder]
        while waiting:
            folder, token = waiting.pop(), None
            while True:
                entries, token = client(folder, token)
                for e in entries:
                    if e.get("folder"):
                        waiting.append(e["id"])
                    else:
                        yield folder, e["id"], e["name"], e.get("mime"), e.get("modified"), e.get("size")
                if not token:
                    break


class PagedListing(DataSource):
    """Files of remote folders, listed page by page, subfolders as well.

        spark.dataSource.register(PagedListing)
        spark.read.format("paged_listing").option("client", "package.module:function").option("folders", "a,b").load()

    The function takes (folder, token) and gives (entries, next token or None); an
    entry has id and name, and perhaps folder, mime, modified and size. Each folder is a task.
    """

    @classmethod
    def name(cls) -> str:
        return "paged_listing"

    def schema(self) -> str:
        return "folder string, id string, name string, mime string, modified string, size long"

    def reader(self, schema) -> _PageReader:
        return _PageReader(self.options)
