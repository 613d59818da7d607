"""Small tables with the odd rows every operator must bear."""

from __future__ import annotations

import random

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def words(seed: int, n: int) -> str:
    draw = random.Random(seed)
    return " ".join("".join(draw.choice("abcdefghij") for _ in range(5)) for _ in range(n))


def odd_documents(spark):
    """Nulls in any column, empty, wordless, short and very long texts, ties, repeated rows, clashing extra columns."""
    long_text = words(1, 30_000)
    base = words(2, 200)
    near = base.replace(base.split()[100], "changed")
    accents = "Öl élan größe — 中文 “x” 🙂\n" * 8
    texts = [None, "", " \n\t ", "one", "one two three", base, near, base, base.upper(), long_text, long_text + " tail", accents, "x" * 5000, "a\nb\n" + base, base + "\n" + base, "<|endoftext|> it's"]
    rows = [(i, t, "en" if i % 2 else None, None if i % 3 else "s", None if t is None else len(t)) for i, t in enumerate(texts)]
    rows += [rows[5], rows[5], (None, base, "en", "s", 1), (7, "another text of the same id", "en", "s", 1)]
    docs = spark.createDataFrame(rows, DOCUMENTS)
    extra = [lit.alias(name) for name, lit in _clashing()]
    return docs.select("*", *extra)


def _clashing():
    from pyspark.sql import functions as F

    return [(c, F.lit(1)) for c in ("text_key", "key", "token", "row", "unit", "n", "ids", "block", "asks", "spans", "drop", "component_id", "letters")]


def no_documents(spark):
    return odd_documents(spark).limit(0)


def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
