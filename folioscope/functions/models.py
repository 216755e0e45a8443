"""Models as plug-ins: functions on columns, with offline defaults that always give the same result.

A model is a function of a list of texts to a list of results. It is called on Arrow batches; time limits
and retries belong into the function. Where it fails for a batch, the batch's results are null.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

Embed = Callable[[Sequence[str]], list[list[float]]]
Answer = Callable[[Sequence[str]], list[str]]


def hashed_embedding(dims: int = 1024, gram: int = 3) -> Embed:
    """The offline embedding: hashed character n-grams, length 1."""

    import numpy as np

    mix = np.uint64(0xBF58476D1CE4E5B9)

    def embed(texts: Sequence[str]) -> list[list[float]]:
        out = []
        for text in texts:
            codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
            n = max(1, len(codes) - gram + 1)
            h = np.zeros(n, np.uint64)
            for i in range(min(gram, len(codes))):
                h = h * np.uint64(0x100000001B3) + codes[i : i + n] + np.uint64(1)
            h = (h ^ (h >> np.uint64(29))) * mix
            h ^= h >> np.uint64(32)
            v = np.bincount((h % np.uint64(dims)).astype(np.int64), np.where(h >> np.uint64(63), 1.0, -1.0), dims)
            out.append((v / (np.linalg.norm(v) or 1.0)).astype(np.float32).tolist())
        return out

    return embed


def with_retry(model: Callable, tries: int = 3, wait: float = 5.0) -> Callable:
    """Calls again after growing waits; the last error is raised."""

    def call(texts):
        for n in range(tries):
            try:
                return model(texts)
            except Exception:
                if n == tries - 1:
                    raise
                time.sleep(wait * 2**n)

    return call


def _column(model: Callable, text: Column, kind: str) -> Column:
    @F.pandas_udf(kind)
    def apply(texts):
        import pandas as pd

        given = [t if isinstance(t, str) else "" for t in texts]
        try:
            return pd.Series(model(given))
        except Exception:
            return pd.Series([None] * len(given))

    return apply(text)


def embedded(text: Column, model: Embed | None = None) -> Column:
    return _column(model or hashed_embedding(), text, "array<float>")


def answered(prompt: Column, model: Answer) -> Column:
    return _column(model, prompt, "string")


def extractive_answer(context: Column, sentences: int = 3) -> Column:
    """The offline answer: the first sentences of the best context."""
    parts = F.filter(F.split(context, r"(?<=[。.!?！？])\s*"), lambda x: F.length(x) > 0)
    return F.array_join(F.slice(parts, 1, sentences), " ")
