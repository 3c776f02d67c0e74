"""Token counts: exact counts at every prefix by dynamic programming."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from auditflow.llm.bpe import encoder
from auditflow.llm.common import table

TOKENIZER = "byte_bpe_50k.json"
LIMIT = 1024


def token_counts(text: Column, tokenizer: str = TOKENIZER, limit: int = LIMIT) -> Column:
    """``struct<n_tokens, fit_chars>``: tokens of the text, and code points that fit the limit.

    ``tokenizer`` is a byte-level BPE file of the package of public tokenizers, or a path that every
    executor can open. A null text counts as empty: no tokens. Each text stands for itself, so hot
    keys, ties and repeated rows have no bearing; a worker keeps a bounded number of pieces.
    """

    @F.pandas_udf("n_tokens long, fit_chars long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        counter = encoder(tokenizer if "/" in tokenizer else public_tokenizers.path(tokenizer))
        for batch in batches:
            rows = []
            for value in batch:
                value = value if isinstance(value, str) else ""
                found = counter.prefixes(value)
                fits = len(value) if found.total <= limit else found.fit(limit)
                rows.append((found.total, fits))
            yield pd.DataFrame(rows, columns=["n_tokens", "fit_chars"])

    return count(text)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: bytes, tokens, whether the limit is passed, and how much of it fits."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = docs.select(
        "doc_id",
        F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"),
        token_counts(F.col("text")).alias("c"),
    )
    return counted.select(
        "doc_id", "n_bytes", "c.n_tokens", (F.col("c.n_tokens") > LIMIT).alias("over_limit"), "c.fit_chars"
    )
