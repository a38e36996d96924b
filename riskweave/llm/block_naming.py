"""Exact duplicates by deterministic block naming.

Every text is cut into blocks of a fixed number of bytes. The distinct blocks are sorted and numbered,
so a block becomes an integer name and equal names mean equal bytes. Then adjacent names are paired
and the distinct pairs numbered in the same way, again and again, until one name is left per text.
Two texts are equal if and only if they end at the same level with the same name; no fingerprint is
trusted anywhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from riskweave.llm.common import row_number, stored, whole_text

BLOCK_BYTES = 4096


def _numbered(distinct: DataFrame, by: list[str]) -> DataFrame:
    """An integer per row. Sorting first makes a task that is run again give the same numbers."""
    return distinct.sortWithinPartitions(*by).withColumn("_name", F.monotonically_increasing_id())


def identities(rows: DataFrame, key: str, text: Column, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(key, level, name): rows have equal level and name exactly when their texts are equal.

    `key` must be unique and stable. Null texts count as empty; an empty text is one empty block. Each
    level is written in the shared folder, so the plan stays short and a lost executor costs a
    re-read. There are log2(blocks of the longest text) levels above the first.
    """
    blocks = rows.select(F.col(key).alias("_row"), text.cast("binary").alias("_bytes")).select(
        "_row",
        F.greatest(F.ceil(F.octet_length("_bytes") / block_bytes) - 1, F.lit(0)).cast("int").alias("_last"),
        "_bytes",
    )
    cut = f"transform(sequence(0, _last), i -> substring(_bytes, i * {block_bytes} + 1, {block_bytes}))"
    blocks = blocks.select("_row", "_last", F.posexplode(F.expr(cut)).alias("_place", "_block"))
    names = _numbered(blocks.select("_block").distinct(), ["_block"])
    level = stored(blocks.join(names, "_block").select("_row", "_last", "_place", "_name"), "block-names")

    rounds = int(level.agg(F.coalesce(F.max("_last"), F.lit(0))).first()[0]).bit_length()
    done = [_finished(level, key, 0)]
    for depth in range(1, rounds + 1):
        level = stored(_paired(level), "pair-names")
        done.append(_finished(level, key, depth))
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out


def _finished(level: DataFrame, key: str, depth: int) -> DataFrame:
    return level.where("_last = 0").select(
        F.col("_row").alias(key), F.lit(depth).alias("level"), F.col("_name").alias("name")
    )


def _paired(level: DataFrame) -> DataFrame:
    """The next level of the texts that still have several names; a name without a neighbour pairs with -1."""
    even = F.col("_place") % 2 == 0
    pairs = (
        level.where("_last > 0")
        .groupBy("_row", F.floor(F.col("_place") / 2).cast("int").alias("_place"))
        .agg(
            F.floor(F.max("_last") / 2).cast("int").alias("_last"),
            F.max(F.when(even, F.col("_name"))).alias("_left"),
            F.coalesce(F.max(F.when(~even, F.col("_name"))), F.lit(-1)).alias("_right"),
        )
    )
    names = _numbered(pairs.select("_left", "_right").distinct(), ["_left", "_right"])
    return pairs.join(names, ["_left", "_right"]).select("_row", "_last", "_place", "_name")


def exact_duplicates(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the largest doc_id stays; a null doc_id is smaller than any other, and
    of repeated rows with the same doc_id one stays. Null texts equal empty ones. An empty table gives
    no rows; other columns of `docs` are not looked at. `docs` must be a stored table: rows are
    numbered by their place in the scan (see `row_number`).
    """
    rows = docs.select(row_number(docs).alias("_id"), F.col("doc_id"), whole_text().alias("text"))
    named = identities(rows, "_id", F.col("text"), block_bytes)
    facts = rows.select("_id", "doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))
    members = stored(facts.join(named, "_id"), "exact-members")
    groups = members.groupBy("level", "name").agg(
        F.count("*").alias("group_size"), F.max(F.struct("doc_id", "_id")).alias("_stays")
    )
    return members.join(groups, ["level", "name"]).select(
        "doc_id",
        F.col("_stays.doc_id").alias("keep_id"),
        "group_size",
        (F.col("_id") == F.col("_stays._id")).alias("kept"),
        "text_sha256",
    )
