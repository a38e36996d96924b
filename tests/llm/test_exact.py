import hashlib
from collections import defaultdict

import pytest
from cases import awkward_texts, by_id, documents, no_rows, saved

from riskweave.llm.block_naming import exact_duplicates
from riskweave.llm.histogram_shards import shard_table, sharded
from riskweave.llm.histogram_shards import splitters


@pytest.mark.parametrize("block_bytes", [3, 64, 4096])
def test_equal_texts_share_a_name(spark, block_bytes):
    texts = awkward_texts()[:22] + ["abcdef", "abcdeg", "abc", "abcabc", "abcabcabc", "abcabc"]
    docs = documents(spark, texts)
    plain = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    groups = defaultdict(list)
    for i, t in plain.items():
        groups[t].append(i)
    got = by_id(exact_duplicates(docs, block_bytes))
    for i, t in plain.items():
        assert got[i] == {
            "doc_id": i, "keep_id": max(groups[t]), "group_size": len(groups[t]), "kept": i == max(groups[t]),
            "text_sha256": hashlib.sha256(t.encode()).hexdigest(),
        }


def test_repeated_rows_and_null_ids_keep_one_row(spark):
    docs = saved(spark.createDataFrame([(1, "x"), (1, "x"), (None, "x"), (None, "y"), (None, "y"), (2, None)], "doc_id long, text string"))
    rows = exact_duplicates(docs).collect()
    assert sorted((r["keep_id"] or -1, r["group_size"]) for r in rows if r["kept"]) == [(-1, 2), (1, 3), (2, 1)]


def test_no_documents(spark):
    assert exact_duplicates(no_rows(spark)).count() == 0
    assert shard_table(no_rows(spark)).count() == 0


def test_other_columns_may_have_any_name(spark):
    docs = documents(spark).selectExpr("doc_id", "text", "lang AS level", "source AS name", "n_chars AS _row", "1 AS slot", "2 AS SHARD", "doc_id AS _slice", "doc_id AS _rank")
    assert exact_duplicates(docs).count() == docs.count()
    out = sharded(docs)
    assert out.columns == ["doc_id", "text", "level", "name", "_row", "_slice", "_rank", "size", "text_crc32", "shard", "slot"]
    assert out.count() == docs.count() and out.where("_slice <> doc_id OR _rank <> doc_id").isEmpty()


def test_shards_have_near_equal_bytes_and_gapless_slots(spark):
    docs = documents(spark, [f"{i % 1900} " * (i % 13 + 1) for i in range(900)])
    rows = shard_table(docs.withColumnRenamed("lang", "size")).collect()
    size, slots, groups = defaultdict(int), defaultdict(list), defaultdict(set)
    for r in rows:
        size[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
        groups[r["text_crc32"]].add(r["shard"])
    assert len(rows) == 900 and set(size) == set(range(8))
    mean = sum(size.values()) / 8
    assert max(abs(b - mean) for b in size.values()) <= max(r["size"] for r in rows)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(g) == 1 for g in groups.values())


def test_a_large_group_of_equal_texts_is_not_torn(spark):
    docs = documents(spark, ["same text"] * 300 + [f"text {i}" for i in range(300)])
    rows = shard_table(docs).collect()
    assert len({r["shard"] for r in rows if r["size"] == len("same text") + 1 and r["text_crc32"] == rows[0]["text_crc32"]}) <= 1
    assert len(rows) == 600


@pytest.mark.parametrize("probes", [2, 7, 256])
def test_splitters_are_exact_for_any_number_of_probes(spark, probes):
    keys = [(i * 2654435761 % 2**32, i % 50 + 1) for i in range(500)]
    rows = spark.createDataFrame(keys, "k long, n long")
    total = sum(n for _, n in keys)
    for i, bound in enumerate(splitters(rows, "k", "n", 4, tolerance=0.0, probes=probes), start=1):
        below = sum(n for k, n in keys if k < bound)
        assert abs(below - total * i / 4) <= 25
