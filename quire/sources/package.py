"""Package directories of talking books: their files, and the elements of their XML files."""

from __future__ import annotations

import re
import xml.etree.ElementTree as ET
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.schemas import ELEMENTS

XML = (".xml", ".smil", ".ncx", ".opf")
XML_NAMESPACE = "{http://www.w3.org/XML/1998/namespace}"
ROW = f"{ELEMENTS}, ext string, error string"
DOCTYPE = re.compile(rb"<!DOCTYPE[^>\[]*(\[.*?\]\s*)?>", re.S)


def parse(data: bytes) -> list[dict]:
    """Elements in document order: ord, parent's ord, local tag, attributes (xml:id and xml:lang with prefix), own text.

    Document types are taken off first: entities that they may define are not read.
    """
    root, out = ET.fromstring(DOCTYPE.sub(b"", data, count=1)), []
    todo: list[tuple[ET.Element, int | None]] = [(root, None)]
    while todo:
        e, parent = todo.pop()
        attrs = {("xml:" + k.removeprefix(XML_NAMESPACE) if k.startswith(XML_NAMESPACE) else k.rpartition("}")[2]): v for k, v in e.attrib.items()}
        out.append({"ord": len(out), "parent": parent, "tag": e.tag.rpartition("}")[2], "attrs": attrs, "text": e.text})
        todo += [(c, out[-1]["ord"]) for c in reversed(list(e))]
    return out


def package(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """files (path, ext, error) and elements (path, ord, parent, tag, attrs, text) of a directory that Spark can read."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    # paths relative to the directory, as the files name each other
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    root = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(hadoop).toString().rstrip("/") + "/"
    relative = F.substring("path", F.instr("path", F.lit(root.split(":", 1)[-1].lstrip("/"))) + len(root.split(":", 1)[-1].lstrip("/")), F.length("path"))
    raw = raw.select(relative.alias("path"), F.lower(F.regexp_extract("path", r"(\.[^./]*)$", 1)).alias("ext"), "content")
    # audio is never read: only its path counts
    rows = raw.withColumn("content", F.when(F.col("ext").isin(*XML), F.col("content")))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = [c.split()[0] for c in re.split(r", (?=\w+ )", ROW)]
        for b in batches:
            out = []
            for path, ext, data in zip(b["path"], b["ext"], b["content"], strict=True):
                error = None
                if data is not None:
                    try:
                        out += [{"path": path, **e} for e in parse(bytes(data))]
                    except ET.ParseError as e:
                        error = str(e)
                out.append({"path": path, "ext": ext, "error": error})
            table = pd.DataFrame(out, columns=columns)
            for c in ("ord", "parent"):
                table[c] = table[c].astype("Int64")
            yield table.astype(object).where(table.notna(), None)

    found = rows.mapInPandas(run, ROW)
    return found.filter("ord IS NULL").select("path", "ext", "error"), found.filter("ord IS NOT NULL").select("path", "ord", "parent", "tag", "attrs", "text")
