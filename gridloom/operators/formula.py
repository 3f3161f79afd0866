"""Formulas as text: a parser, the cells they depend on, and their evaluation for many scenarios at once.

A workbook's formulas are its plan, not its data: they are parsed on the driver, as a query's text is.
Each formula becomes an expression over the columns of the cells it reads; scenarios are rows, so
one projection per layer of cells evaluates all of them.  Parts of an expression are bound to names
(``_let``), so that its size grows with the formula's text and not with its depth.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Callable, Collection, Mapping
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import values

Cell = tuple[str, int, int]
#: Combinations of control values that a dynamic reference is followed for.
COMBINATIONS = 10_000
LAST_ROW, LAST_COL = 1_048_576, 16_384

_SHEET = r"(?:(?:'((?:[^']|'')+)'|([A-Za-z_][A-Za-z0-9_.]*))!)?"
_TOKEN = re.compile(
    rf"\s*(?:(?P<str>\"(?:[^\"]|\"\")*\")|(?P<ref>{_SHEET}(?:\$?[A-Za-z]{{1,3}}\$?[0-9]+(?::\$?[A-Za-z]{{1,3}}\$?[0-9]+)?|\$?[A-Za-z]{{1,3}}:\$?[A-Za-z]{{1,3}}|\$?[0-9]+:\$?[0-9]+)(?![A-Za-z0-9_(.!]))"
    r"|(?P<num>[0-9]+(?:\.[0-9]*)?(?:[eE][+-]?[0-9]+)?|\.[0-9]+)|(?P<call>[A-Za-z_][A-Za-z0-9_.]*)\(|(?P<err>#(?:DIV/0!|N/A|NAME\?|NULL!|NUM!|REF!|VALUE!))|(?P<name>[A-Za-z_\\][A-Za-z0-9_.\\]*)|(?P<op><=|>=|<>|[-+*/^&=<>(),%]))"
)
_LEVELS = (("=", "<>", "<", ">", "<=", ">="), ("&",), ("+", "-"), ("*", "/"), ("^",))


class Ref(NamedTuple):
    """A rectangle of cells, corners included."""

    sheet: str
    r1: int
    c1: int
    r2: int
    c2: int

    def cells(self) -> list[Cell]:
        return [(self.sheet, r, c) for r in range(self.r1, self.r2 + 1) for c in range(self.c1, self.c2 + 1)]


def column_number(letters: str) -> int:
    n = 0
    for c in letters.upper():
        n = n * 26 + ord(c) - 64
    return n


def column_letters(n: int) -> str:
    out = ""
    while n:
        n, k = divmod(n - 1, 26)
        out = chr(65 + k) + out
    return out


def cell(address: str, sheet: str = "") -> Cell:
    """The place that an address names; ValueError if it is none."""
    m = re.fullmatch(_SHEET + r"\$?([A-Za-z]{1,3})\$?([0-9]+)", address)
    if not m:
        raise ValueError(f"no address: {address}")
    return (m[1] or "").replace("''", "'") or m[2] or sheet, int(m[4]), column_number(m[3])


def address(at: Cell) -> str:
    sheet = at[0] if re.fullmatch("[A-Za-z_][A-Za-z0-9_]*", at[0]) else "'" + at[0].replace("'", "''") + "'"
    return f"{sheet}!{column_letters(at[2])}{at[1]}"


def _reference(text: str, sheet: str) -> Ref:
    m = re.match(_SHEET, text)
    place = (m[1] or "").replace("''", "'") or m[2] or sheet
    first, _, last = text[m.end() :].replace("$", "").partition(":")
    part = lambda x, low: (int(d) if (d := re.sub("[^0-9]", "", x)) else (1 if low else LAST_ROW), column_number(a) if (a := re.sub("[^A-Za-z]", "", x)) else (1 if low else LAST_COL))
    (r1, c1), (r2, c2) = part(first, True), part(last or first, False)
    return Ref(place, min(r1, r2), min(c1, c2), max(r1, r2), max(c1, c2))


def parse(formula: str, sheet: str = "") -> tuple:
    """Syntax tree of a formula: tuples of a kind and its parts; ValueError if it cannot be read.

    Kinds: ``num str bool err ref name call op neg pct blank``.  References without a sheet are of ``sheet``.
    """
    text = formula[1:] if formula.startswith("=") else formula
    tokens, at = [], 0
    while text[at:].strip():
        m = _TOKEN.match(text, at)
        if not m:
            raise ValueError(f"cannot read {text[at:]!r} of {formula!r}")
        tokens.append((m.lastgroup, m[m.lastgroup]) if m.lastgroup else ("ref", m["ref"]))
        kind = next(k for k in ("str", "ref", "num", "call", "err", "name", "op") if m[k] is not None)
        tokens[-1] = (kind, m[kind])
        at = m.end()
    tokens.append(("end", ""))
    place = 0

    def take(want: str | None = None) -> tuple[str, str]:
        nonlocal place
        token = tokens[place]
        if want is not None and token != ("op", want):
            raise ValueError(f"{want} is missing in {formula!r}")
        place += 1
        return token

    def level(k: int) -> tuple:
        if k == len(_LEVELS):
            return signed()
        left = level(k + 1)
        while tokens[place][0] == "op" and tokens[place][1] in _LEVELS[k]:
            left = ("op", take()[1], left, level(k + 1))
        return left

    def signed() -> tuple:
        if tokens[place] in (("op", "-"), ("op", "+")):
            sign, found = take()[1], signed()
            return ("neg", found) if sign == "-" else found
        found = atom()
        while tokens[place] == ("op", "%"):
            take()
            found = ("pct", found)
        return found

    def atom() -> tuple:
        kind, word = take()
        if kind == "num":
            return ("num", float(word))
        if kind == "str":
            return ("str", word[1:-1].replace('""', '"'))
        if kind == "err":
            return ("err", word)
        if kind == "ref":
            return ("ref", _reference(word, sheet))
        if kind == "name":
            return ("bool", word.upper() == "TRUE") if word.upper() in ("TRUE", "FALSE") else ("name", word.lower())
        if kind == "call":
            args: list[tuple] = []
            while tokens[place] != ("op", ")"):
                if args:
                    take(",")
                args.append(("blank",) if tokens[place] in (("op", ","), ("op", ")")) else level(0))
            take(")")
            return ("call", word.upper().removeprefix("_XLFN."), args)
        if (kind, word) == ("op", "("):
            found = level(0)
            take(")")
            return found
        raise ValueError(f"{word!r} is not expected in {formula!r}")

    found = level(0)
    if tokens[place][0] != "end":
        raise ValueError(f"cannot read {tokens[place][1]!r} of {formula!r}")
    return found


class Book(NamedTuple):
    """Cells of one workbook: formulas as trees, other cells as literal values, names, and domains of cells that steer dynamic references."""

    formulas: dict[Cell, tuple]
    literals: dict[Cell, object]
    names: dict[str, Ref]
    domains: dict[Cell, list[float]]

    def used(self, ref: Ref) -> Ref:
        """A whole row or column cut to the cells that are there."""
        if ref.r2 < LAST_ROW and ref.c2 < LAST_COL:
            return ref
        some = [c for c in itertools.chain(self.formulas, self.literals) if c[0] == ref.sheet]
        rows, cols = max((c[1] for c in some), default=1), max((c[2] for c in some), default=1)
        return Ref(ref.sheet, ref.r1, ref.c1, max(ref.r1, min(ref.r2, rows)), max(ref.c1, min(ref.c2, cols)))


def book(cells: Mapping[str, object], names: Mapping[str, str] | None = None, domains: Mapping[str, Collection[float]] | None = None) -> Book:
    """A :class:`Book` of ``address -> text or value``; texts that begin with ``=`` are formulas, None is blank."""
    formulas, literals = {}, {}
    for where, what in cells.items():
        at = cell(where)
        if isinstance(what, str) and what.startswith("="):
            formulas[at] = parse(what, at[0])
        else:
            literals[at] = what
    found = Book(formulas, literals, {n.lower(): _reference(t, "") for n, t in (names or {}).items()}, {cell(a): list(v) for a, v in (domains or {}).items()})
    return found


def _static(tree: tuple, known: Mapping[Cell, float], of: Book) -> float | None:
    """Number of a tree whose references are all ``known`` or literal numbers; None if it has others."""
    kind = tree[0]
    if kind == "num":
        return tree[1]
    if kind == "name" and tree[1] in of.names:
        return _static(("ref", of.names[tree[1]]), known, of)
    if kind == "ref":
        cells = of.used(tree[1]).cells()
        if len(cells) != 1:
            return None
        return known.get(cells[0])
    if kind in ("neg", "pct"):
        x = _static(tree[1], known, of)
        return None if x is None else -x if kind == "neg" else x / 100
    if kind == "op" and tree[1] in "+-*/":
        a, b = _static(tree[2], known, of), _static(tree[3], known, of)
        if a is None or b is None or (tree[1] == "/" and b == 0):
            return None
        return {"+": a + b, "-": a - b, "*": a * b}.get(tree[1]) if tree[1] != "/" else a / b
    return None


def _read(tree: tuple, of: Book) -> set[Cell]:
    """Cells that a tree names outright."""
    if tree[0] == "ref":
        return set(of.used(tree[1]).cells())
    if tree[0] == "name":
        return set(of.used(of.names[tree[1]]).cells()) if tree[1] in of.names else set()
    parts = tree[2] if tree[0] == "call" else tree[2:] if tree[0] == "op" else tree[1:] if tree[0] in ("neg", "pct") else ()
    return set().union(*(_read(p, of) for p in parts)) if parts else set()


def _settings(trees: list[tuple], of: Book) -> list[dict[Cell, float]] | None:
    """Every combination of values of the controls that ``trees`` read; None if one has no domain."""
    controls = sorted(set().union(*(_read(t, of) for t in trees)))
    if any(c not in of.domains for c in controls):
        return None
    choices = [of.domains[c] for c in controls]
    count = 1
    for some in choices:
        count *= len(some)
    if count > COMBINATIONS:
        raise ValueError(f"{count} combinations of controls, over {COMBINATIONS}")
    return [dict(zip(controls, x, strict=True)) for x in itertools.product(*choices)]


def _single(tree: tuple, of: Book) -> Ref | None:
    if tree[0] == "name":
        return of.used(of.names[tree[1]]) if tree[1] in of.names else None
    return of.used(tree[1]) if tree[0] == "ref" else None


def candidates(tree: tuple, of: Book) -> list[tuple[int, int, Cell]]:
    """``(rows, cols, cell)`` that an OFFSET can lead to: by the domains of its controls, else in the used part of the sheet."""
    base = _single(tree[2][0], of)
    steps = [*tree[2][1:3], ("num", 0.0)][:2]
    settings = _settings(steps, of)
    if base is None:
        raise ValueError("OFFSET needs a reference")
    if settings is not None:
        moves = {tuple(int(_static(s, known, of) // 1) for s in steps) for known in settings if all(_static(s, known, of) is not None for s in steps)}
    else:
        some = [c for c in itertools.chain(of.formulas, of.literals) if c[0] == base.sheet]
        fixed = [_static(s, {}, of) for s in steps]
        moves = {(c[1] - base.r1, c[2] - base.c1) for c in some}
        moves = {m for m in moves if all(f is None or m[k] == int(f // 1) for k, f in enumerate(fixed))}
    return [(r, c, (base.sheet, base.r1 + r, base.c1 + c)) for r, c in sorted(moves) if base.r1 + r > 0 and base.c1 + c > 0]


def reads(tree: tuple, of: Book) -> dict[Cell, set[str]]:
    """Cells that a formula depends on, with the causes of dynamic references; empty causes: read outright.

    INDEX with a literal row or column reads that row or column only; MATCH reads what it looks in.
    """
    found: dict[Cell, set[str]] = {}

    def add(cells, cause: str | None = None) -> None:
        for c in cells:
            found.setdefault(c, set()).update([cause] if cause else [])

    def walk(t: tuple) -> None:
        kind = t[0]
        if kind in ("ref", "name"):
            add(_read(t, of))
        elif kind == "call" and t[1] == "OFFSET":
            for s in t[2][1:]:
                walk(s)
            add((c for _, _, c in candidates(t, of)), "dynamic_offset")
        elif kind == "call" and t[1] == "INDEX" and _single(t[2][0], of) is not None:
            ref = _single(t[2][0], of)
            for s in t[2][1:]:
                walk(s)
            row, col = (_static(s, {}, of) for s in [*t[2][1:3], ("num", 0.0)][:2])
            cells = [c for c in ref.cells() if (not row or c[1] == ref.r1 + row - 1) and (not col or c[2] == ref.c1 + col - 1)]
            add(cells, None if row is not None and col is not None else "dynamic_index")
        elif kind == "call":
            for s in t[2]:
                walk(s)
        elif kind == "op":
            walk(t[2])
            walk(t[3])
        elif kind in ("neg", "pct"):
            walk(t[1])

    walk(tree)
    return found


def graph(of: Book, targets: Collection[str]) -> tuple[list[Cell], list[tuple[Cell, Cell, list[str]]]]:
    """Nodes and ``(parent, child, causes)`` edges that the targets reach; every node comes after what it depends on.

    ValueError for a cycle.
    """
    order: list[Cell] = []
    edges, state = [], {}
    for target in targets:
        stack = [(cell(target), None)]
        while stack:
            at, rest = stack.pop()
            if rest is None:
                if state.get(at) == "done":
                    continue
                if state.get(at) == "open":
                    raise ValueError(f"{address(at)} depends on itself")
                state[at] = "open"
                children = reads(of.formulas[at], of) if at in of.formulas else {}
                edges += [(at, c, sorted(causes)) for c, causes in sorted(children.items())]
                rest = iter(sorted(children))
            for child in rest:
                if state.get(child) == "open":
                    raise ValueError(f"{address(child)} depends on itself")
                if state.get(child) != "done":
                    stack += [(at, rest), (child, None)]
                    break
            else:
                state[at] = "done"
                order.append(at)
    return order, edges


def _let(parts: list[Column], then: Callable[..., Column]) -> Column:
    """``then`` of the parts, each computed once."""
    one = F.array(F.struct(*(p.alias(f"x{k}") for k, p in enumerate(parts))))
    return F.get(F.transform(one, lambda z: then(*(z[f"x{k}"] for k in range(len(parts))))), F.lit(0))


def _text(v: Column) -> Column:
    return F.coalesce(v["str"], F.when(v["bool"].isNotNull(), F.upper(v["bool"].cast("string"))), values.coerced(v["num"]), F.lit(""))


def _flag(test: Column, error: Column) -> Column:
    return values.value(flag=F.when(error.isNull(), test), err=error)


_BINARY: dict[str, Callable[[Column, Column], Column]] = {
    "+": values.add,
    "-": values.sub,
    "*": values.mul,
    "/": values.div,
    "=": values.equal,
    "<>": lambda a, b: (lambda e: values.value(flag=~e["bool"], err=e["err"]))(values.equal(a, b)),
    ">=": values.at_least,
    "<=": lambda a, b: values.at_least(b, a),
    ">": lambda a, b: _flag(values.number(a) > values.number(b), F.coalesce(a["err"], b["err"])),
    "<": lambda a, b: _flag(values.number(a) < values.number(b), F.coalesce(a["err"], b["err"])),
    "&": lambda a, b: (lambda e: values.value(text=F.when(e.isNull(), F.concat(_text(a), _text(b))), err=e))(F.coalesce(a["err"], b["err"])),
    "^": lambda a, b: (lambda e: values.value(F.when(e.isNull(), F.pow(values.number(a), values.number(b))), err=e))(F.coalesce(a["err"], b["err"])),
}


def _folded(name: str, cells: Column) -> Column:
    """SUM, MIN or MAX of the numbers of an array; its first error passes through."""
    numbers = F.filter(F.transform(cells, lambda v: v["num"]), lambda x: x.isNotNull())
    error = F.get(F.filter(F.transform(cells, lambda v: v["err"]), lambda e: e.isNotNull()), F.lit(0))
    total = {"SUM": F.aggregate(numbers, F.lit(0.0), lambda s, x: s + x), "MIN": F.coalesce(F.array_min(numbers), F.lit(0.0)), "MAX": F.coalesce(F.array_max(numbers), F.lit(0.0))}[name]
    return values.value(F.when(error.isNull(), total), err=error)


def compiled(tree: tuple, of: Book, column: Callable[[Cell], Column]) -> Column:
    """The value of a formula as an expression; ``column`` gives that of a cell.

    ``#NAME?`` for a name or function that is not known.
    """

    def each(t: tuple) -> Column:
        ref = _single(t, of) if t[0] in ("ref", "name") else None
        return F.array(*map(column, ref.cells())) if ref is not None else F.array(go(t))

    def picked(cells: Column, at: Column, inside: Column, error: Column, wrong: str) -> Column:
        return F.when(error.isNotNull(), values.value(err=error)).when(~inside, values.value(err=F.lit(wrong))).otherwise(F.coalesce(F.get(cells, at.cast("int")), values.value()))

    def call(name: str, args: list[tuple]) -> Column:
        if name == "IF":
            return _let([go(args[0])], lambda t: values.if_(t, go(args[1]), go(args[2]) if len(args) > 2 else values.value(flag=F.lit(False))))
        if name == "IFERROR":
            return _let([go(args[0])], lambda v: F.when(v["err"].isNotNull(), go(args[1])).otherwise(v))
        if name == "CHOOSE":
            return _let([go(args[0])], lambda i: values.choose(i, *map(go, args[1:])))
        if name == "MATCH":
            return _let([go(args[0]), each(args[1])], lambda v, cells: _matched(v, cells))
        if name == "INDEX":
            ref = _single(args[0], of)
            if ref is None:
                return values.value(err=F.lit("#REF!"))
            high, wide = ref.r2 - ref.r1 + 1, ref.c2 - ref.c1 + 1
            row, col = ([go(args[1]), go(args[2])] if len(args) > 2 else [values.value(F.lit(1.0)), go(args[1])] if high == 1 else [go(args[1]), values.value(F.lit(1.0))])

            def at(r: Column, c: Column) -> Column:
                i, j = F.floor(values.number(r)), F.floor(values.number(c))
                return picked(each(args[0]), (i - 1) * wide + j - 1, i.between(1, high) & j.between(1, wide), F.coalesce(r["err"], c["err"]), "#REF!")

            return _let([row, col], at)
        if name == "OFFSET":
            some = candidates(("call", name, args), of)
            steps = [*map(go, args[1:3]), values.value(F.lit(0.0))][:2]
            cells = F.array(*(F.struct(F.lit(r).alias("r"), F.lit(c).alias("c"), column(where).alias("v")) for r, c, where in some))

            def moved(r: Column, c: Column) -> Column:
                hit = F.filter(cells, lambda z: (z["r"] == F.floor(values.number(r))) & (z["c"] == F.floor(values.number(c)))) if some else F.array()
                return picked(F.transform(hit, lambda z: z["v"]), F.lit(0), F.lit(True), F.coalesce(r["err"], c["err"]), "#REF!")

            return _let(steps, moved) if some else values.value()
        if name in ("SUM", "MIN", "MAX"):
            return _let([F.concat(*map(each, args))], lambda cells: _folded(name, cells))
        if name in ("ABS", "EXP"):
            return _let([go(args[0])], lambda v: (lambda e: values.value(F.when(e.isNull(), {"ABS": F.abs, "EXP": F.exp}[name](values.number(v))), err=e))(F.coalesce(v["err"], F.when(v["str"].isNotNull(), "#VALUE!"))))
        if name == "ROUND":
            digits = int(_static(args[1], {}, of) or 0) if len(args) > 1 else 0
            return _let([go(args[0])], lambda v: values.value(F.when(v["err"].isNull(), F.round(values.number(v), digits)), err=v["err"]))
        if name in ("AND", "OR"):
            joined = F.forall if name == "AND" else F.exists
            return _let([F.concat(*map(each, args))], lambda cells: _flag(joined(cells, lambda v: F.coalesce(v["bool"], values.number(v) != 0, F.lit(False))), F.get(F.filter(F.transform(cells, lambda v: v["err"]), lambda e: e.isNotNull()), F.lit(0))))
        if name == "NOT":
            return _let([go(args[0])], lambda v: _flag(~F.coalesce(v["bool"], values.number(v) != 0), v["err"]))
        if name == "ISBLANK":
            return _let([go(args[0])], lambda v: values.value(flag=values.is_blank(v)))
        return values.value(err=F.lit("#NAME?"))

    def go(t: tuple) -> Column:
        kind = t[0]
        if kind in ("num", "str", "bool", "err", "blank"):
            return literal(t[1] if kind != "blank" else None, kind == "err")
        if kind in ("ref", "name"):
            ref = _single(t, of)
            if ref is None:
                return values.value(err=F.lit("#NAME?"))
            return column(ref.cells()[0]) if len(ref.cells()) == 1 else values.value(err=F.lit("#VALUE!"))
        if kind == "op":
            return _let([go(t[2]), go(t[3])], _BINARY[t[1]])
        if kind == "neg":
            return _let([go(t[1])], lambda v: values.sub(values.value(F.lit(0.0)), v))
        if kind == "pct":
            return _let([go(t[1])], lambda v: values.div(v, values.value(F.lit(100.0))))
        return call(t[1], t[2])

    return go(tree)


def _matched(v: Column, cells: Column) -> Column:
    hits = F.transform(cells, lambda c: F.coalesce(values.equal(v, c)["bool"] & ~values.is_blank(c), F.lit(False)))
    at = F.nullif(F.array_position(hits, F.lit(True)), F.lit(0).cast("long"))
    return F.when(v["err"].isNotNull(), values.value(err=v["err"])).otherwise(values.value(at, err=F.when(at.isNull(), "#N/A")))


def literal(x: object, error: bool = False) -> Column:
    """A cell's own value; texts that are error classes are errors."""
    if x is None:
        return values.value()
    if isinstance(x, bool):
        return values.value(flag=F.lit(x))
    if isinstance(x, int | float):
        return values.value(F.lit(float(x)))
    return values.value(err=F.lit(x)) if error or x in values.ERRORS else values.value(text=F.lit(str(x)))


def evaluate(of: Book, writes: DataFrame, targets: Collection[str]) -> DataFrame:
    """``(scenario_id, address, value)`` of the targets for every scenario.

    ``writes(scenario_id, address, value)`` sets cells for a scenario, texts read as a sheet reads
    them; a null value blanks a cell.  Cells that no row sets keep the book's value, and cells the
    book has not are blank.  A write to a formula cell takes its place.  Rows do not change each
    other, so nothing is to be reset between scenarios.
    """
    order, _ = graph(of, targets)
    name = {at: f"cell_{k}" for k, at in enumerate(order)}
    column = lambda at: F.col(name[at]) if at in name else values.value()
    spelled = lambda text: F.upper(F.replace(text, F.lit("$"), F.lit("")))
    entry = F.struct(spelled(F.col("address")).alias("a"), F.col("value").cast("string").alias("v"))
    rows = writes.groupBy("scenario_id").agg(F.map_from_entries(F.array_distinct(F.collect_list(entry))).alias("set"))
    rows = rows.withColumn("set", F.transform_values("set", lambda k, v: values.typed(v)))
    level: dict[Cell, int] = {}
    for at in order:
        level[at] = 1 + max((level[c] for c in reads(of.formulas[at], of)), default=0) if at in of.formulas else 0
    for depth in range(max(level.values(), default=-1) + 1):
        made = {}
        for at in (a for a in order if level[a] == depth):
            own = compiled(of.formulas[at], of, column) if at in of.formulas else literal(of.literals.get(at))
            key = F.lit(address(at).upper())
            made[name[at]] = F.when(F.map_contains_key("set", key), F.element_at("set", key)).otherwise(own)
        rows = rows.withColumns(made)
    wanted = F.array(*(F.struct(F.lit(address(cell(t))).alias("address"), column(cell(t)).alias("value")) for t in targets))
    return rows.select("scenario_id", F.explode(wanted).alias("x")).select("scenario_id", "x.*")
