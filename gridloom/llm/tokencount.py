"""Token counts through a digest cache.

The cache is a table ``(content binary, version binary, n_tokens long)`` in the shared folder: the
SHA-256 of a content, the SHA-256 of the tokenizer's library, release and file, and the count.
Contents are joined to it by both digests; only contents that it lacks are encoded, each once, and
appended.  A second run over the same texts encodes nothing.

The content is the text itself, null taken as empty.  Nothing else is normalised away, as the
tokenizers tell case, forms and white space apart.

Copies that one task reads are dropped before the shuffle, so a text that a third of all rows
share is sent once by each task; what arrives for a digest meets in one task and is encoded there
once.  The counts of the version are a written table when rows are joined to them, so adaptive
execution can split the rows of one content over several tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import new_path, written

CACHE = "content binary, version binary, n_tokens long"
LIMIT = 4096


def version_digest(tokenizer: str) -> bytes:
    """Digest of what decides a count: the library, its release and the vocabulary file."""
    import importlib.metadata

    library = "tokenizers" if tokenizer.endswith(".json") else "sentencepiece"
    with open(tokenizer, "rb") as f:
        return hashlib.sha256(f"{library} {importlib.metadata.version(library)}\n".encode() + f.read()).digest()


def _first(batches: Iterator) -> Iterator:
    """Each content of a task once."""
    import pyarrow as pa

    seen = set()
    for batch in batches:
        keep = []
        for digest in batch.column(0).to_pylist():
            keep.append(digest not in seen)
            seen.add(digest)
        yield batch.filter(pa.array(keep))


def _counts(tokenizer: str):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        from .wordcodec import counter

        count, seen = counter(tokenizer), set()
        for batch in batches:
            digests, counts = [], []
            for row, digest in enumerate(batch.column(0).to_pylist()):
                if digest not in seen:
                    seen.add(digest)
                    digests.append(digest)
                    counts.append(count(batch.column(1)[row].as_py()))
            yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), pa.array(counts, pa.int64())], ["content", "n_tokens"])

    return run


def _digested(docs: DataFrame, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.unhex(F.sha2(text.cast("binary"), 256)).alias("content"), text.alias("text"))


def fill(docs: DataFrame, cache: str, tokenizer: str, text_col: str = "text") -> None:
    """Append to the cache at ``cache`` the counts of the contents of ``docs`` that it lacks."""
    spark, version = docs.sparkSession, version_digest(tokenizer)
    spark.createDataFrame([], CACHE).write.mode("append").parquet(cache)
    known = spark.read.schema(CACHE).parquet(cache).where(F.col("version") == F.lit(bytearray(version))).select("content")
    first = _digested(docs, text_col).mapInArrow(_first, "content binary, text string")
    missing = first.join(known, "content", "left_anti").repartition("content")
    found = missing.mapInArrow(_counts(tokenizer), "content binary, n_tokens long")
    found.select("content", F.lit(bytearray(version)).alias("version"), "n_tokens").write.mode("append").parquet(cache)


def token_counts(docs: DataFrame, tokenizer: str, cache: str | None = None, limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)`` of every row.

    ``cache``: folder of the cache; None: a new one in the shared folder, so every distinct
    content is encoded.  A null text counts as empty.  Rows that repeat an id, and rows without
    one, keep a row each.  Other columns are ignored.  No rows: an empty result.
    """
    spark = docs.sparkSession
    cache = cache or new_path(spark, "token-counts")
    fill(docs, cache, tokenizer, text_col)
    version = version_digest(tokenizer)
    # Two runs that filled the cache at once may both have put a content; its counts are equal.
    stored = spark.read.schema(CACHE).parquet(cache).where(F.col("version") == F.lit(bytearray(version)))
    known = written(stored.groupBy("content").agg(F.min("n_tokens").alias("n_tokens")), "token-counts-known")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"), F.unhex(F.sha2(text, 256)).alias("content"))
    return rows.join(known, "content").select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
