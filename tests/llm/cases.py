"""Small tables with the awkward cases, and plain versions of what operators must give."""

from __future__ import annotations

import random
import uuid

from pyspark.sql import DataFrame, SparkSession

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed: int, words: int) -> str:
    """Invented text; `seed` decides it."""
    rng = random.Random(seed)
    syllables = ["an", "re", "th", "on", "ing", "ble", "é", "ñ", "ß", "ou"]
    return " ".join("".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(words))


def changed(text: str, seed: int, words: int) -> str:
    """The text with some words replaced."""
    rng, out = random.Random(seed), text.split(" ")
    for i in rng.sample(range(len(out)), words):
        out[i] = f"neu{seed}x{i}"
    return " ".join(out)


def awkward_texts() -> list[str | None]:
    """Nulls, empty and one-word texts, odd white space, copies, near copies, shared passages and a long text."""
    base, passage = prose(1, 300), prose(2, 60)
    texts: list[str | None] = [None, "", "   \n", "one", "two words", "a\u00a0b c", "tab\tand\x0bmore\r\nlines", None, ""]
    texts += [base, base, changed(base, 3, 4), changed(base, 4, 5), base.upper(), changed(base, 5, 90)]
    texts += [f"{prose(10 + i, 40)} {passage} {prose(30 + i, 25 + i)}" for i in range(6)]
    texts += [" ".join(passage.split()[:13]), " ".join(passage.split()[1:13]), prose(50, 20_000), f"{prose(51, 30)} {prose(50, 20_000)}"]
    return texts + ["same " * 40, "same " * 41, base]


def documents(spark: SparkSession, texts: list[str | None] | None = None) -> DataFrame:
    texts = awkward_texts() if texts is None else texts
    rows = [(i * 7 % 1000, t, "en", f"src{i % 3}", None if t is None else len(t)) for i, t in enumerate(texts)]
    return saved(spark.createDataFrame(rows, DOCS))


def saved(df: DataFrame) -> DataFrame:
    """As a stored table in several part files."""
    from riskweave.session import shared_dir

    path = f"{shared_dir(df.sparkSession)}/case-{uuid.uuid4().hex}"
    df.repartition(3).write.parquet(path)
    return df.sparkSession.read.parquet(path)


def no_rows(spark: SparkSession, schema: str = DOCS) -> DataFrame:
    return saved(spark.createDataFrame([], schema))


def by_id(df: DataFrame, key: str = "doc_id") -> dict:
    rows = [r.asDict() for r in df.collect()]
    out = {r[key]: r for r in rows}
    assert len(out) == len(rows), "a row was given twice"
    return out
