"""PDF files as a source: discovery, content hashes and text by a cascade of extractors.

An extractor is a function from a file's bytes to (text, pages). The first one that does not raise and gives enough text
wins; later ones only see the files on which those before them failed. Two libraries come first, where they are installed. The
next needs none: it reads uncompressed and Flate-compressed content streams and their text operators, but no font maps, so it
only stands in for them. Character recognition costs most and comes last.
"""

from __future__ import annotations

import re
import traceback
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Extractor = Callable[[bytes], tuple[str, int]]
LEAST_CHARACTERS = 200
RAW = "file_path string, file_name string, raw_text string, page_count int, extraction_method string, file_hash string, extraction_error string, success boolean"

_STREAM = re.compile(rb"<<(.*?)>>\s*stream\r?\n(.*?)\r?\nendstream", re.DOTALL)
_SHOWN = re.compile(rb"\((?:\\.|[^()\\])*\)|<[0-9A-Fa-f\s]*>|T\*|'|\"|\bT[dDmJj]\b|\bET\b|\[|\]", re.DOTALL)
_ESCAPE = re.compile(rb"\\([0-7]{1,3}|.)", re.DOTALL)
_ESCAPED = {b"n": b"\n", b"r": b"\r", b"t": b"\t", b"b": b"\b", b"f": b"\f"}


def _literal(token: bytes) -> str:
    if token[:1] == b"<":
        digits = re.sub(rb"\s", b"", token[1:-1])
        return bytes.fromhex((digits + b"0" * (len(digits) % 2)).decode()).decode("latin-1")
    plain = _ESCAPE.sub(lambda m: bytes([int(m[1], 8) & 255]) if m[1].isdigit() and m[1][:1] in b"01234567" else _ESCAPED.get(m[1], m[1]), token[1:-1])
    return plain.decode("cp1252", "replace")


def content_text(stream: bytes) -> str:
    """Text that a content stream shows; moves to another line become line ends."""
    out: list[str] = []
    held: list[str] = []
    for m in _SHOWN.finditer(stream):
        t = m[0]
        if t[:1] in b"(<" and t != b"<":
            held.append(_literal(t))
        elif t in (b"Tj", b"TJ", b"'", b'"'):
            if t in (b"'", b'"') and out:
                out.append("\n")
            out += held
            held = []
        elif t in (b"Td", b"TD", b"T*", b"Tm", b"ET"):
            held = []
            if out and out[-1] != "\n":
                out.append("\n")
    return "".join(out)


def builtin_text(content: bytes) -> tuple[str, int]:
    if not content.startswith(b"%PDF-"):
        raise ValueError("not a PDF file")
    pages = len(re.findall(rb"/Type\s*/Page(?![s\w])", content))
    texts = []
    for head, body in _STREAM.findall(content):
        if b"/FlateDecode" in head:
            body = zlib.decompressobj().decompress(body)
        elif b"/Filter" in head:
            continue
        if b"BT" in body:
            texts.append(content_text(body).strip("\n"))
    return "\n".join(texts), max(pages, len(texts))


def pymupdf_text(content: bytes) -> tuple[str, int]:
    import fitz

    with fitz.open(stream=content, filetype="pdf") as doc:
        return "\n".join(page.get_text() for page in doc), len(doc)


def pdfplumber_text(content: bytes) -> tuple[str, int]:
    import io

    import pdfplumber

    with pdfplumber.open(io.BytesIO(content)) as doc:
        texts = [page.extract_text() for page in doc.pages]
    return "\n".join(t for t in texts if t), len(texts)


def tesseract_text(content: bytes) -> tuple[str, int]:
    import io

    import fitz
    import pytesseract
    from PIL import Image

    with fitz.open(stream=content, filetype="pdf") as doc:
        shots = [Image.open(io.BytesIO(page.get_pixmap(dpi=300).tobytes("png"))) for page in doc]
        return "\n".join(pytesseract.image_to_string(s, lang="eng") for s in shots), len(shots)


CASCADE: tuple[tuple[str, Extractor], ...] = (("pymupdf", pymupdf_text), ("pdfplumber", pdfplumber_text), ("builtin", builtin_text), ("tesseract", tesseract_text))


def sufficient(text: str) -> bool:
    return sum(len(part) for part in text.split()) >= LEAST_CHARACTERS


def sufficient_text(c):
    """The same test as a column: at least 200 characters that are not white space."""
    from lexmill.functions.text import rx

    return F.length(F.regexp_replace(F.coalesce(c, F.lit("")), rx(r"\s+"), "")) >= LEAST_CHARACTERS


def first_sufficient(content: bytes, cascade: tuple[tuple[str, Extractor], ...]) -> tuple[str, int, str, str | None]:
    """Text, pages, method and error of the first extractor that succeeds; method "failed" if none does."""
    errors = []
    for name, extractor in cascade:
        try:
            text, pages = extractor(content)
        except ImportError:
            errors.append(f"{name}: not installed")
        except Exception:
            errors.append(f"{name}: {traceback.format_exc(limit=1).splitlines()[-1]}")
        else:
            if sufficient(text):
                return text, pages, name, None
            errors.append(f"{name}: too little text")
    return "", 0, "failed", "; ".join(errors)


def discover(spark: SparkSession, folder: str, limit: int | None = None) -> DataFrame:
    """Paths of all ``*.pdf`` (lower case) below a folder, with their lengths; contents are not read. ``limit``: the first so many by path."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.pdf").option("recursiveFileLookup", "true").load(folder)
    paths = files.select(F.col("path").alias("file_path"), "length")
    return paths.orderBy("file_path").limit(limit) if limit else paths


def load(spark: SparkSession, folder: str, paths: DataFrame) -> DataFrame:
    """Contents of the given files: file_path, content."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.pdf").option("recursiveFileLookup", "true").load(folder)
    return files.select(F.col("path").alias("file_path"), "content").join(paths.select("file_path"), "file_path", "left_semi")


def extract(files: DataFrame, cascade: tuple[tuple[str, Extractor], ...] = CASCADE) -> DataFrame:
    """Raw documents of files (file_path, content): a file that no extractor reads is a row with success false."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [first_sufficient(c.as_py() or b"", cascade) for c in batch.column(2)]
            text, pages, method, error = ([f[k] for f in found] for k in range(4))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(text, pa.string()), pa.array(pages, pa.int32()), pa.array(method, pa.string()), pa.array(error, pa.string())],
                ["file_path", "file_hash", "raw_text", "page_count", "extraction_method", "extraction_error"],
            )

    hashed = files.select("file_path", F.sha2("content", 256).alias("file_hash"), "content")
    read = hashed.mapInArrow(run, "file_path string, file_hash string, raw_text string, page_count int, extraction_method string, extraction_error string")
    return read.select(
        "file_path", F.substring_index("file_path", "/", -1).alias("file_name"), "raw_text", "page_count", "extraction_method", "file_hash", "extraction_error", (F.col("extraction_method") != "failed").alias("success")
    )
