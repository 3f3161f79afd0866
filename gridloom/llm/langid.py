"""Language identification: multinomial naive Bayes over hashed character n-grams.

A text is lower-cased, each run of characters that are no letters becomes one space, and all
n-grams of one to three characters are hashed into a fixed number of buckets.  Training sums the
buckets of each language over a bounded, hash-drawn sample of the labelled rows; the matrix of
smoothed log-probabilities (languages x buckets) is broadcast, its size set by the parameters and
the number of languages.  Scoring takes many texts at once: their n-grams are hashed in one pass
and are a sparse matrix in row order, a row for each text and an entry for each n-gram, whose
product with the log-probability matrix gives every text's sums.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices

BUCKETS, ORDERS = 1 << 15, (1, 2, 3)
#: Labelled rows of each language that the model is fitted on, about; all, where there are fewer.
TRAIN_ROWS = 4000
#: Added to every bucket's count.
SMOOTHING = 0.5
#: N-grams that count in full for the score; beyond, evidence is that of so many average ones.
EVIDENCE = 80
UNKNOWN = "und"
#: Characters scored at once.
CHUNK = 1 << 19

_GAP = re.compile(r"[\W\d_]+")


def letters(text: str | None) -> str:
    """The text's words in lower case between single spaces; empty without a letter."""
    text, some = text or "", [""]
    for at in range(0, len(text), CHUNK):  # a part at a time, as the words of a very long text take many times its room
        part = _GAP.sub(" ", text[at : at + CHUNK])
        if some[-1].endswith(" "):
            part = part.removeprefix(" ")
        some += [part] if part else []
    kept = "".join(some).lower()
    return f" {kept.strip()} " if any(c.isalpha() for c in kept) else ""


def _grams(text: str, buckets: int = BUCKETS) -> Iterator:
    """Each order with the buckets of the n-grams that begin at every character, in order."""
    import numpy as np

    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint32)
    mixed = np.zeros(len(codes), np.uint32)
    for n in range(1, max(ORDERS) + 1):
        if n > len(codes):
            return
        mixed = mixed[: len(codes) - n + 1] * np.uint32(0x01000193) + codes[n - 1 :] * np.uint32(0x9E3779B1)
        if n in ORDERS:
            h = mixed ^ (mixed >> np.uint32(15)) ^ np.uint32(n * 0x51ED)
            yield n, (h * np.uint32(0x85EBCA6B)) >> np.uint32(32 - (buckets - 1).bit_length())


def _parts(texts: list[str]) -> Iterator:
    """Lists of ``(row, part, later)`` of ``CHUNK`` characters about; longer texts come in parts.

    A later part begins with the last characters of the one before, so that each n-gram is in one
    part whole; what it shares with the part before is not to be counted again.
    """
    some, held, step = [], 0, CHUNK - max(ORDERS) + 1
    for row, text in enumerate(texts):
        for at in range(0, max(1, len(text) - max(ORDERS) + 1), step):
            part = text[at : at + CHUNK]
            if some and held + len(part) > CHUNK:
                yield some
                some, held = [], 0
            some.append((row, part, at > 0))
            held += len(part)
    if some:
        yield some


def _rows(some: list) -> Iterator:
    """For each order the sparse matrix of the parts: where each part's entries begin, how many it has, and all buckets."""
    import numpy as np

    sizes = np.array([len(part) for _, part, _ in some], np.int64)
    begins, later = np.cumsum(sizes) - sizes, np.array([late for _, _, late in some])
    of = np.repeat(np.arange(len(some), dtype=np.int32), sizes)
    for n, buckets in _grams("".join(part for _, part, _ in some)):
        whole = of[: len(buckets)] == of[n - 1 :]  # an n-gram across a border is in neither text
        for k in np.flatnonzero(later):
            whole[begins[k] : begins[k] + max(ORDERS) - n] = False
        counts = np.bincount(of[: len(buckets)][whole], minlength=len(some))
        yield np.cumsum(counts) - counts, counts, buckets[whole]


def sums(texts: list[str], weights):
    """Sums of the weights of every text's n-grams, and how many there are; texts as :func:`letters` makes them."""
    import numpy as np

    total, many = np.zeros((len(texts), weights.shape[1])), np.zeros(len(texts), np.int64)
    for some in _parts(texts):
        row = np.array([r for r, _, _ in some])
        for begins, counts, buckets in _rows(some):
            has = counts > 0
            if has.any():
                np.add.at(total, row[has], np.add.reduceat(weights[buckets], begins[has], axis=0, dtype=np.float64))
                np.add.at(many, row[has], counts[has])
    return total, many


def _sums(batches: Iterator) -> Iterator:
    """Rows (lang, bucket, n) of a task: languages x buckets at most."""
    import numpy as np
    import pyarrow as pa

    totals: dict = {}
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            if kept := letters(text.as_py()):
                total = totals.setdefault(lang, np.zeros(BUCKETS, np.int64))
                for some in _parts([kept]):
                    for _, _, buckets in _rows(some):
                        total += np.bincount(buckets, minlength=BUCKETS)
    for lang, total in totals.items():
        at = np.nonzero(total)[0]
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int64()), pa.array(total[at])], ["lang", "bucket", "n"])


def train(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", rows: int = TRAIN_ROWS):
    """``(languages, log-probabilities)`` from the rows with a language; None without any.

    Of each language about ``rows`` rows are taken by a hash of id and text length, so the sample
    is spread over all data and the same each time.  Languages are sorted; priors are equal.
    """
    import numpy as np

    known = labelled.where(F.col(lang_col).isNotNull())
    sizes = {r["lang"]: r["n"] for r in known.groupBy(F.col(lang_col).alias("lang")).agg(F.count("*").alias("n")).collect()}  # a row for each language
    if not sizes:
        return None
    share = F.create_map(*(F.lit(x) for lang, n in sizes.items() for x in (lang, min(1.0, rows / n))))
    drawn = F.pmod(F.xxhash64(F.col(id_col), F.length(text_col)), F.lit(1 << 30)) < share[F.col(lang_col)] * (1 << 30)
    sums = known.where(drawn).select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("t")).mapInArrow(_sums, "lang string, bucket long, n long")
    langs = sorted(sizes)
    counts = np.full((BUCKETS, len(langs)), SMOOTHING)
    for r in sums.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toLocalIterator():
        counts[r["bucket"], langs.index(r["lang"])] += r["n"]
    return langs, np.log(counts / counts.sum(0)).astype(np.float32)


def scores(texts: list[str | None], langs: list[str], weights) -> tuple[list[str], list[float]]:
    """The likeliest language of every text and its tempered posterior."""
    import numpy as np

    kept = [letters(t) for t in texts]
    total, many = sums(kept, weights)
    total *= np.minimum(1.0, EVIDENCE / np.maximum(many, 1))[:, None]
    best = total.argmax(1)
    odds = np.exp(total - total.max(1, keepdims=True))
    sure = odds.max(1) / odds.sum(1)
    return [langs[b] if k else UNKNOWN for b, k in zip(best.tolist(), kept, strict=True)], [s if k else 0.0 for s, k in zip(sure.tolist(), kept, strict=True)]


def _scores(model):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        langs, weights = model.value
        for batch in (part for batch in batches for part in slices(batch, 1)):
            found, sure = scores(batch.column(1).to_pylist(), langs, weights)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string()), pa.array(sure, pa.float64())], ["id", "lang_pred", "score"])

    return run


def held_out(id_col: str = "doc_id"):
    """Rows that no model is fitted on: the CRC-32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def predict(docs: DataFrame, model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, lang_pred, score)`` of every row; ``und`` with score 0 for a null text, one without a letter, or no model."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("t"))
    if model is None:
        return rows.select("id", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    return rows.mapInArrow(_scores(docs.sparkSession.sparkContext.broadcast(model)), "id long, lang_pred string, score double")


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)`` of every row.

    The model is fitted on rows with a language that are not held out, and predicts from the text
    alone.  A row without an id is not held out.  Ties go to the language first in order.  Rows
    that repeat an id keep a row each; other columns are ignored; no rows give no rows.
    """
    model = train(docs.where(~held_out(id_col)), id_col, text_col, lang_col)
    found = predict(docs, model, id_col, text_col)
    return found.select(F.col("id").alias("doc_id"), held_out("id").alias("held_out"), "lang_pred", "score")


#: A prediction below this score rejects a document in :func:`keep_identified`.
LEAST_SCORE = 0.5


def keep_identified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", least: float = LEAST_SCORE) -> DataFrame:
    """The rows whose language is told with a score of ``least`` or more, all columns as they are.

    Texts without a letter and texts that no language fits better than the others together go.
    """
    import pyarrow as pa

    model = train(docs.where(~held_out(id_col)), id_col, text_col, lang_col)
    if model is None:
        return docs.limit(0)
    sent, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index(text_col)

    def run(batches: Iterator) -> Iterator:
        langs, weights = sent.value
        for batch in (part for batch in batches for part in slices(batch, at)):
            found, sure = scores(batch.column(at).to_pylist(), langs, weights)
            yield batch.filter(pa.array([lang != UNKNOWN and s >= least for lang, s in zip(found, sure, strict=True)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
