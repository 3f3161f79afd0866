"""Spreadsheet values as columns: ``struct<num double, str string, bool boolean, err string>``.

A blank has four nulls.  An error is a value of its own, never a null.  Blanks count as zero in
arithmetic, errors pass through, the left one first; text in arithmetic is ``#VALUE!``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Whole numbers that no double holds.
HUGE = "^-?[1-9][0-9]{308,}$"
VALUE = "struct<num:double,str:string,bool:boolean,err:string>"

# The error classes of cells, and the functions whose references depend on values.
ERRORS = ("#DIV/0!", "#N/A", "#NAME?", "#NULL!", "#NUM!", "#REF!", "#VALUE!")
DYNAMIC = ("OFFSET", "INDEX", "MATCH", "CHOOSE", "INDIRECT", "XLOOKUP", "HLOOKUP", "VLOOKUP", "LOOKUP")


def value(num=None, text=None, flag=None, err=None) -> Column:
    """A value from one column or literal; no argument is a blank."""
    part = lambda x, kind: (x if isinstance(x, Column) else F.lit(x)).cast(kind)
    return F.struct(part(num, "double").alias("num"), part(text, "string").alias("str"), part(flag, "boolean").alias("bool"), part(err, "string").alias("err"))


def typed(text: Column) -> Column:
    """The value that a text stands for: error class, number, TRUE or FALSE, text; null is blank."""
    bare = F.trim(text)
    number = bare.try_cast("double")
    flag = F.when(F.upper(bare) == "TRUE", True).when(F.upper(bare) == "FALSE", False)
    error = F.when(bare.isin(*ERRORS), bare)
    plain = error.isNull() & flag.isNull()
    huge = bare.rlike(HUGE)  # beyond a double's range: kept as digits
    return value(F.when(plain & ~huge, number), F.when(plain & (number.isNull() | huge), F.when(huge, bare).otherwise(text)), F.when(error.isNull(), flag), error)


def is_blank(v: Column) -> Column:
    return v["num"].isNull() & v["str"].isNull() & v["bool"].isNull() & v["err"].isNull()


def number(v: Column) -> Column:
    """What arithmetic sees: a blank is zero, a flag one or zero, text null."""
    return F.coalesce(v["num"], v["bool"].cast("double"), F.when(v["str"].isNull(), F.lit(0.0)))


def _arith(a: Column, b: Column, result: Column, own: Column | None = None) -> Column:
    text = F.when(a["str"].isNotNull() | b["str"].isNotNull(), "#VALUE!")
    error = F.coalesce(a["err"], b["err"], text, *([own] if own is not None else []))
    return value(F.when(error.isNull(), result), err=error)


def add(a: Column, b: Column) -> Column:
    return _arith(a, b, number(a) + number(b))


def sub(a: Column, b: Column) -> Column:
    return _arith(a, b, number(a) - number(b))


def mul(a: Column, b: Column) -> Column:
    return _arith(a, b, number(a) * number(b))


def div(a: Column, b: Column) -> Column:
    """``#DIV/0!`` for a zero or blank denominator."""
    return _arith(a, b, F.try_divide(number(a), number(b)), F.when(number(b) == 0, "#DIV/0!"))


def equal(a: Column, b: Column) -> Column:
    """The formula ``=``: texts without regard to case, blanks equal zero and the empty text."""
    both = a["str"].isNotNull() | b["str"].isNotNull()
    same = F.when(both, F.lower(F.coalesce(a["str"], F.when(is_blank(a), ""))).eqNullSafe(F.lower(F.coalesce(b["str"], F.when(is_blank(b), ""))))).otherwise(number(a) == number(b))
    error = F.coalesce(a["err"], b["err"])
    return value(flag=F.when(error.isNull(), same), err=error)


def at_least(a: Column, b: Column) -> Column:
    """The formula ``>=`` of numbers."""
    error = F.coalesce(a["err"], b["err"])
    return value(flag=F.when(error.isNull(), number(a) >= number(b)), err=error)


def if_(test: Column, yes: Column, no: Column) -> Column:
    """The branch not taken does not matter, whatever errors it holds."""
    truth = F.coalesce(test["bool"], number(test) != 0)
    return F.when(test["err"].isNotNull(), value(err=test["err"])).when(test["str"].isNotNull(), value(err=F.lit("#VALUE!"))).when(truth, yes).otherwise(no)


def choose(i: Column, *options: Column) -> Column:
    """The i-th option, from one; fractions are cut off; out of range is ``#VALUE!``."""
    at = F.floor(number(i))
    found = F.when(i["err"].isNotNull(), value(err=i["err"]))
    for k, option in enumerate(options, 1):
        found = found.when(at == k, option)
    return found.otherwise(value(err=F.lit("#VALUE!")))


def match(v: Column, keys: Column) -> Column:
    """Place, from one, of the first equal key of an array; ``#N/A`` without one."""
    at = F.nullif(F.array_position(keys, v), F.lit(0).cast("long"))
    return value(at, err=F.when(at.isNull(), "#N/A"))


def index(values: Column, i: Column) -> Column:
    """The i-th number of an array, from one; out of range is ``#REF!``; a null element is blank."""
    at = F.floor(number(i))
    error = F.coalesce(i["err"], F.when((at < 1) | (at > F.size(values)), "#REF!"))
    return value(F.when(error.isNull(), F.get(values, (at - 1).cast("int"))), err=error)


def offset(values: Column, steps: Column) -> Column:
    """The number ``steps`` to the right of the first of an array; outside it the sheet is blank."""
    at = F.floor(number(steps)).cast("int")
    return value(F.when(steps["err"].isNull(), F.get(values, at)), err=steps["err"])


def rounded(x: Column, digits: int = 6) -> Column:
    return F.round(x, digits)


def snowball(rate: Column, growth: Column) -> Column:
    """Factor by which a ratio grows in a period, of percentages."""
    return F.try_divide(1 + rate / 100, 1 + growth / 100)


def stabilising_balance(ratio: Column, rate: Column, growth: Column) -> Column:
    """The balance that keeps a ratio as it is, of percentages."""
    return F.try_divide(ratio * (rate - growth) / 100, 1 + growth / 100)


def net_present_value(rate: Column, flows: Column) -> Column:
    """NPV: the first flow is discounted once."""
    return F.aggregate(F.reverse(flows), F.lit(0.0), lambda acc, x: (acc + x) / (1 + rate))


def relative_diff(golden: Column, sut: Column) -> Column:
    """Distance over the golden size; infinite if the golden number is zero and the other is not."""
    gap = F.abs(golden - sut)
    return F.when(golden == 0, F.when(gap == 0, 0.0).otherwise(float("inf"))).otherwise(gap / F.when(golden != 0, F.abs(golden)))


def coerced(x: Column) -> Column:
    """Text of a number, without a fraction if it is whole."""
    return F.when((x == F.floor(x)) & (F.abs(x) < 1e15), x.cast("long").cast("string")).otherwise(x.cast("string"))


def dtype(kinds: Column) -> Column:
    """dtype of a list of kinds ``bool int float string``: all bool, all int, numbers, else string."""
    every = lambda *some: F.forall(kinds, lambda k: k.isin(*some))
    return F.when(F.size(kinds) == 0, "string").when(every("bool"), "bool").when(every("int"), "int").when(every("int", "float"), "float").otherwise("string")
