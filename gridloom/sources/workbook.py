"""Workbooks (OOXML packages) as tables, read with the standard library.

A package is one file that a task parses as a whole: a folder of workbooks is read in parallel, a
file per row of Spark's ``binaryFile`` source, so any store that Spark reads will do.
"""

from __future__ import annotations

import io
import posixpath
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import formula

CELLS = "path string, sheet string, row int, col int, address string, kind string, num double, str string, bool boolean, err string, formula string"
NAMES = "path string, name string, target string, external boolean, broken boolean"
SHEETS = "path string, sheet string, state string, sheet_type string"
PARTS = "path string, part string, kind string"

_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main"}
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
_KINDS = (("vba", r"vbaProject\.bin$"), ("connections", r"connections\.xml$"), ("external_link", r"externalLinks/externalLink\d+\.xml$"), ("chart", r"charts/chart[^/]*\.xml$"), ("drawing", r"drawings/drawing[^/]*\.xml$"), ("form_control", r"ctrlProps/"), ("calc_chain", r"calcChain\.xml$"))


def _column(letters: str) -> int:
    n = 0
    for c in letters:
        n = n * 26 + ord(c) - 64
    return n


def rendered(sheet: str, row: int, col: int) -> str:
    """The spelling that ``functions.address.rendered`` gives."""
    return formula.address((sheet, row, col))


class Package:
    """The parts of one workbook."""

    def __init__(self, content: bytes) -> None:
        self.zip = zipfile.ZipFile(io.BytesIO(content))
        self.names = self.zip.namelist()
        self.book = self._xml("xl/workbook.xml")
        rels = self._xml("xl/_rels/workbook.xml.rels")
        self.targets = {r.get("Id"): (posixpath.normpath(posixpath.join("xl", r.get("Target", "").removeprefix("/xl/"))), r.get("Type", "").rpartition("/")[2]) for r in (rels if rels is not None else ())}
        shared = self._xml("xl/sharedStrings.xml")
        self.strings = ["".join(t.text or "" for t in s.iter(f"{{{_NS['m']}}}t")) for s in (shared if shared is not None else ())]

    def _xml(self, part: str):
        return ElementTree.fromstring(self.zip.read(part)) if part in self.names else None

    def sheets(self) -> list[tuple[str, str, str, str]]:
        """Name, visibility, type and part of each sheet."""
        found = []
        for s in self.book.iterfind("m:sheets/m:sheet", _NS):
            part, kind = self.targets.get(s.get(_REL), ("", "worksheet"))
            found.append((s.get("name"), s.get("state", "visible"), {"dialogsheet": "dialog", "xlMacrosheet": "macro"}.get(kind, kind), part))
        return found

    def defined_names(self) -> list[tuple[str, str, bool, bool]]:
        found = [(n.get("name"), n.text or "") for n in self.book.iterfind("m:definedNames/m:definedName", _NS)]
        return [(name, target, "[" in target, "#REF!" in target) for name, target in found]

    def parts(self) -> list[tuple[str, str]]:
        return [(n, kind) for n in self.names for kind, pattern in _KINDS if re.search(pattern, n)]

    def cells(self) -> Iterator[tuple]:
        for sheet, _, kind, part in self.sheets():
            if kind != "worksheet" or part not in self.names:
                continue
            shared: dict[str, tuple[str, int, int]] = {}
            for c in self._xml(part).iterfind("m:sheetData/m:row/m:c", _NS):
                place = re.fullmatch(r"([A-Z]+)([0-9]+)", c.get("r", ""))
                if place:
                    yield self._cell(sheet, int(place[2]), _column(place[1]), place[0], c, shared)

    def _cell(self, sheet, row, col, address, c, shared) -> tuple:
        kind, v, f = c.get("t", "n"), c.find("m:v", _NS), c.find("m:f", _NS)
        raw = v.text if v is not None else None
        formula = f.text if f is not None else None
        if f is not None and f.get("t") == "shared":
            if formula is not None:
                shared[f.get("si")] = (formula, row, col)
            elif f.get("si") in shared:
                first, r0, c0 = shared[f.get("si")]
                formula = moved(first, row - r0, col - c0)
        num = text = flag = err = None
        if kind == "s" and raw is not None:
            text = self.strings[int(raw)]
        elif kind == "inlineStr":
            text = "".join(t.text or "" for t in c.iter(f"{{{_NS['m']}}}t"))
        elif kind == "str":
            text = raw
        elif kind == "b" and raw is not None:
            flag = raw == "1"
        elif kind == "e":
            err = raw
        elif raw is not None:
            num = float(raw)
        what = "formula" if formula is not None else "error" if err else "blank" if num is None and not text and flag is None else "value"
        return sheet, row, col, rendered(sheet, row, col), what, num, text, flag, err, f"={formula}" if formula is not None else None


def moved(formula: str, rows: int, cols: int) -> str:
    """A formula as it reads that many rows and columns away: references without a dollar sign move."""

    def letters(n: int) -> str:
        out = ""
        while n > 0:
            n, k = divmod(n - 1, 26)
            out = chr(65 + k) + out
        return out

    def shift(m: re.Match) -> str:
        if m[0].startswith('"') or m[0].startswith("'"):
            return m[0]
        col = m[2] if m[1] else letters(_column(m[2]) + cols)
        row = m[4] if m[3] else str(int(m[4]) + rows)
        return f"{m[1]}{col}{m[3]}{row}"

    return re.sub(r"\"[^\"]*\"|'[^']*'|(?<![A-Za-z0-9_.])(\$?)([A-Z]{1,3})(\$?)([0-9]+)(?![A-Za-z0-9_(.])", shift, formula)


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", "content")


def _read(spark: SparkSession, path: str, schema: str, rows) -> DataFrame:
    def run(batches: Iterator) -> Iterator:
        import pandas as pd

        names = [x.split()[0] for x in schema.split(", ")]
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"], strict=True):
                yield pd.DataFrame([(path, *r) for r in rows(Package(content))], columns=names).astype(object).where(lambda d: d.notna(), None)

    return _files(spark, path).mapInPandas(run, schema)


def cells(spark: SparkSession, path: str) -> DataFrame:
    """A row for each cell that the files at ``path`` hold."""
    return _read(spark, path, CELLS, lambda p: p.cells())


def named_ranges(spark: SparkSession, path: str) -> DataFrame:
    """``(path, name, target, external, broken)`` with the corners of targets that are ranges of a sheet."""
    from ..functions import address

    found = _read(spark, path, NAMES, lambda p: p.defined_names())
    sheet = F.regexp_replace(F.regexp_extract("target", r"^'?((?:[^'!]|'')+)'?!", 1), "''", "'")
    inside = ~F.col("external") & ~F.col("broken") & F.col("target").rlike(r"![$]?[A-Z]{1,3}[$]?[0-9]+(:[$]?[A-Z]{1,3}[$]?[0-9]+)?$")
    return found.select("*", F.when(inside, sheet).alias("sheet"), F.when(inside, address.corners(F.col("target"))).alias("k")).select("path", "name", "target", "external", "broken", "sheet", "k.*")


def sheets(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, SHEETS, lambda p: [s[:3] for s in p.sheets()])


def parts(spark: SparkSession, path: str) -> DataFrame:
    """Parts of note: macros, connections, external links, charts, drawings, controls, the calculation chain."""
    return _read(spark, path, PARTS, lambda p: p.parts())


def references(text: str, sheet: str, of: formula.Book | None = None) -> list[tuple[str, int, int]]:
    """Cells that a formula depends on, in order: names, whole rows and columns and dynamic references are followed.

    A formula that cannot be read depends on nothing.
    """
    of = of or formula.Book({}, {}, {}, {})
    try:
        return sorted(formula.reads(formula.parse(text, sheet), of))
    except ValueError:
        return []


def books(cells_: DataFrame, names: DataFrame | None = None, domains: dict[str, list[float]] | None = None) -> dict[str, formula.Book]:
    """The workbooks of ``cells_`` by path, for the driver: a workbook's cells are a plan and must fit there."""
    found: dict[str, dict] = {}
    for r in cells_.toLocalIterator():
        what = r["formula"] or (r["num"] if r["num"] is not None else r["bool"] if r["bool"] is not None else r["err"] or r["str"])
        found.setdefault(r["path"], {})[r["address"]] = what
    named: dict[str, dict] = {}
    for r in names.where("NOT external AND NOT broken").collect() if names is not None else ():
        named.setdefault(r["path"], {})[r["name"]] = r["target"]
    return {path: formula.book(some, named.get(path), domains) for path, some in found.items()}


def edges(cells_: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """``(parent, child)`` of the formulas of ``cells_``: one edge for each cell that a formula depends on.

    Formulas are parsed by the tasks that hold them; a workbook's used cells and ``names`` (as of
    :func:`named_ranges`) are sent along by path, so whole columns and named ranges give edges, too.
    """
    places = cells_.groupBy("path").agg(F.collect_list(F.struct("sheet", "row", "col")).alias("used"))
    formulas = cells_.where("formula IS NOT NULL").groupBy("path").agg(F.collect_list(F.struct("address", "sheet", "formula")).alias("formulas"))
    both = formulas.join(places, "path")
    if names is not None:
        both = both.join(names.where("NOT external AND NOT broken").groupBy("path").agg(F.collect_list(F.struct("name", "target")).alias("names")), "path", "left")
    else:
        both = both.withColumn("names", F.lit(None).cast("array<struct<name:string,target:string>>"))

    def run(batches: Iterator) -> Iterator:
        import pandas as pd

        for batch in batches:
            for used, some, named in zip(batch["used"], batch["formulas"], batch["names"], strict=True):
                of = formula.book({}, {n["name"]: n["target"] for n in named} if named is not None else {})
                of.literals.update(dict.fromkeys((u["sheet"], u["row"], u["col"]) for u in used))
                rows = [(f["address"], formula.address(c)) for f in some for c in references(f["formula"], f["sheet"], of)]
                yield pd.DataFrame(rows, columns=["parent", "child"])

    return both.select("used", "formulas", "names").mapInPandas(run, "parent string, child string").distinct()
