"""License scans: ordered signature rules over a text's words.

A text is lower-cased (A-Z) and cut into words of digits, a-z and non-ASCII characters; rules are
regular expressions over the words joined by single spaces, so punctuation and line breaks never
matter.  Every rule names its keywords: any match must hold one of them as a whole word; only rules with a keyword that occurs in the text are run.
The rules themselves are in ``license_rules``.

A detection is a span of words with a rule, a label and a rank.  Where one lies inside another of
the same or a higher rank it is suppressed: the notice "licensed under the MIT license" swallows
the mere name in it.  Detections of base rules always stay.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import license_rules


class Rule(NamedTuple):
    name: str
    label: str
    keywords: str
    pattern: str
    rank: int
    confidence: float
    base: bool = False


# The base phrases and their labels.
BASE = (("cc by", "cc-by", "cc"), ("general public license", "gpl", "public"), ("all rights reserved", "reserved", "reserved"))

def rules() -> list[Rule]:
    """All rules in order: base phrases, the written signatures, and a tag for each public identifier."""
    found = [Rule(f"base:{label}", label, word, phrase, 1, 0.6, True) for phrase, label, word in BASE]
    for number, line in enumerate(license_rules.RULES.strip().splitlines(), 1):
        label, rank, sure, keywords, pattern = line.split("; ", 4)
        for name, wording in license_rules.SHARED.items():
            pattern = pattern.replace(name, wording)
        found.append(Rule(f"rule:{number}:{label}", label, keywords, pattern, int(rank), float(sure)))
    for identifier in license_rules.IDENTIFIERS.split():
        words = identifier.lower().replace("-", " ").replace(".", " ")
        found.append(Rule(f"tag:{identifier}", _plain(identifier), "spdx", f"spdx licen[cs]e identifier {words}", 3, 0.99))
    return found


def _plain(identifier: str) -> str:
    """Label of an identifier: GPL-2.0-only and GPL-2.0-or-later are gpl-2.0, CC-BY-4.0 is cc-by."""
    name = identifier.lower().removesuffix("-only").removesuffix("-or-later")
    return re.sub(r"-[0-9.]+$", "", name) if name.startswith("cc") else name


_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if c > 0x7F or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


class Scanner:
    """Compiled rules by keyword."""

    def __init__(self, table: list[Rule]) -> None:
        self.table = table
        self.patterns = [re.compile(f" (?:{r.pattern})(?= )".encode()) for r in table]
        self.by_word: dict[bytes, list[int]] = {}
        for k, r in enumerate(table):
            for word in r.keywords.encode().split():
                self.by_word.setdefault(word, []).append(k)
        self.words = frozenset(self.by_word)

    def scan(self, text: bytes | None) -> tuple[int, list[tuple[int, int, int]]]:
        """Number of words, and the detections that stay: first word, word past the end, rule's place."""
        import numpy as np

        words = (text or b"").translate(_WORDS).split()
        if self.words.isdisjoint(words):
            return len(words), []
        line = b" " + b" ".join(words) + b" "
        gaps, found = None, []
        for k in {k for word in self.words.intersection(words) for k in self.by_word[word]}:  # a rule once, whatever keywords occur
            spans = [m.span() for m in self.patterns[k].finditer(line)]
            if spans:
                gaps = np.flatnonzero(np.frombuffer(line, np.uint8) == 32) if gaps is None else gaps
                at = np.searchsorted(gaps, np.array(spans))
                found += [(a, b, k) for a, b in at.tolist()]
        return len(words), self.settle(found)

    def settle(self, found: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
        """Detections without those inside another of the same or a higher rank; of equal spans the first rule stays."""
        ends = [-1] * (1 + max((r.rank for r in self.table), default=0))
        kept = []
        for a, b, k in sorted(found, key=lambda d: (d[0], -d[1], -self.table[d[2]].rank, d[2])):
            rule = self.table[k]
            if rule.base or max(ends[rule.rank :]) < b:
                kept.append((a, b, k))
            ends[rule.rank] = max(ends[rule.rank], b)
        return kept


def _scan(batches: Iterator) -> Iterator:
    import pyarrow as pa

    scanner = Scanner(rules())
    spans = pa.list_(pa.struct([("first", pa.int64()), ("past", pa.int64()), ("rule", pa.string()), ("label", pa.string()), ("confidence", pa.float64()), ("base", pa.bool_())]))
    names = [dict(rule=r.name, label=r.label, confidence=r.confidence, base=r.base) for r in scanner.table]
    for batch in batches:
        found = [scanner.scan(t.as_py()) for t in batch.column(1)]
        detections = [[{"first": a, "past": b} | names[k] for a, b, k in kept] for _, kept in found]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([n for n, _ in found], pa.int64()), pa.array(detections, spans)], ["doc_id", "n_words", "detections"])


DETECTIONS = "array<struct<first:long,past:long,rule:string,label:string,confidence:double,base:boolean>>"


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_words, detections)`` of every row; a detection has first word, word past the end, rule, label.

    A null text is empty: no words, no detections.  Rows that repeat an id, or have none, keep a
    row each.  Other columns are ignored.  No rows: an empty result.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("t"))
    return rows.mapInArrow(_scan, f"doc_id long, n_words long, detections {DETECTIONS}")


def _names(found: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(F.transform(found, lambda d: d["label"]))), ",")


def summary(scanned: DataFrame) -> DataFrame:
    """A row per document with its labels and the places of base phrases; the score is the probability
    that some label is right if the best detection of each label errs on its own."""
    base = F.filter("detections", lambda d: d["base"])
    labels = F.array_distinct(F.transform("detections", lambda d: d["label"]))
    best = F.transform(labels, lambda name: F.array_max(F.transform(F.filter("detections", lambda d: d["label"] == name), lambda d: d["confidence"])))
    return scanned.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"),
        F.array_min(F.transform(base, lambda d: d["first"])).alias("first_word"), F.array_max(F.transform(base, lambda d: d["first"])).alias("last_word"),
        _names(base).alias("base_labels"), _names(F.col("detections")).alias("labels"),
        (1 - F.aggregate(best, F.lit(1.0), lambda acc, c: acc * (1 - c))).alias("score"),
    )
