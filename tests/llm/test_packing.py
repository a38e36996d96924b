import zlib
from collections import defaultdict
from itertools import product

import numpy as np
import public_tokenizers
import pytest
from cases import awkward_texts, documents, no_rows, prose, saved
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from riskweave.llm import cutting_stock as stock, packing

PATH = public_tokenizers.path("word_bpe_49k.json")
TOKENIZER = Tokenizer.from_file(PATH)
WORDS = packing.WordIds(TOKENIZER)


def plain_ids(text):
    return np.array(TOKENIZER.encode(text or "", add_special_tokens=False).ids + [2], "<u4")


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("abZ'sétİIıſßÀΣσς1²½.,!<|>\n\t \r\x0b\x1c\x1f\x85\xa0 　​́日ा😀ęŁµªº_-K") | st.characters(exclude_categories=["Cs"]), max_size=40))
def test_any_text_has_the_ids_the_library_gives(text):
    for t in (text, text + "<|endoftext|>" + text, "DON'T we'Ll " + text):
        assert [int(i) for part in WORDS.parts(t) for i in part] == TOKENIZER.encode(t, add_special_tokens=False).ids


def test_a_forgetful_cache_and_short_slices_change_nothing(monkeypatch):
    monkeypatch.setattr(packing, "CACHE_CHARS", 50)
    monkeypatch.setattr(packing, "SLICE_CHARS", 7)
    words, text = packing.WordIds(TOKENIZER), prose(3, 500) + " x  " + "y" * 400
    assert [int(i) for part in words.parts(text) for i in part] == TOKENIZER.encode(text, add_special_tokens=False).ids


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        packing.word_tokenizer(Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")))


def check(rows, ids_of, capacity):
    """Every id in exactly one piece, offsets gapless; returns the padding and how many documents are cut beyond need."""
    documents_, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        documents_[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
    assert documents_.keys() == ids_of.keys()
    for i, pieces in documents_.items():
        at = 0
        for r in sorted(pieces, key=lambda r: r["start"]):
            part = ids_of[i][r["start"] : r["start"] + r["length"]]
            assert (r["start"], r["doc_tokens"], len(part)) == (at, len(ids_of[i]), r["length"])
            assert r["ids_crc32"] == zlib.crc32(part.tobytes()) and bytes(r["ids"]) == part.tobytes()
            at += r["length"]
        assert at == len(ids_of[i])
    padding = 0
    for pieces in sequences.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert 0 < at <= capacity
        padding += capacity - at if at & (at - 1) else 0
    assert sorted(sequences) == list(range(len(sequences)))
    return padding, sum(len(p) > -(-len(ids_of[i]) // capacity) for i, p in documents_.items())


@pytest.mark.parametrize("capacity,rank_rows", [(4096, 50_000), (256, 7), (64, 20)])
def test_every_id_is_packed_once_with_little_padding(spark, capacity, rank_rows):
    texts = awkward_texts() + [prose(100 + i, 5 + i * 7 % 90) for i in range(250)]
    docs = documents(spark, texts).withColumnRenamed("lang", "piece").withColumnRenamed("source", "length")
    ids_of = {r["doc_id"]: plain_ids(r["text"]) for r in docs.collect()}
    rows = packing.packed(docs, PATH, capacity=capacity, rank_rows=rank_rows).collect()
    padding, _ = check(rows, ids_of, capacity)
    assert padding <= 0.02 * sum(map(len, ids_of.values()))


def test_lengths_that_do_not_fit_together_are_streamed(spark):
    docs = documents(spark, ["the " * 39] * 60)  # 40 ids each, so a sequence of 64 takes one and a part
    ids_of = {r["doc_id"]: plain_ids(r["text"]) for r in docs.collect()}
    assert {len(i) for i in ids_of.values()} == {40}
    assert check(packing.packed(docs, PATH, capacity=64, rank_rows=7).collect(), ids_of, 64)[0] == 0


def test_no_documents_and_repeated_rows(spark):
    assert packing.packed(no_rows(spark), PATH).collect() == []
    docs = saved(spark.createDataFrame([(1, "a b"), (1, "a b"), (None, None)], "doc_id long, text string"))
    rows = packing.packed(docs, PATH).collect()
    assert sorted((r["doc_id"] or 0, r["length"]) for r in rows if r["start"] == 0)[0][0] == 0
    assert sum(r["length"] for r in rows) == 3 + 3 + 1


def test_sequences_hold_the_ids_in_order(spark):
    docs = documents(spark, [prose(i, 30) for i in range(40)])
    pieces = packing.packed(docs, PATH, capacity=256)
    made = {r["sequence_id"]: r for r in packing.sequences(pieces).collect()}
    for r in pieces.collect():
        whole = np.frombuffer(bytes(made[r["sequence_id"]]["ids"]), "<u4")
        assert len(whole) == made[r["sequence_id"]]["size"]
        assert whole[r["offset"] : r["offset"] + r["length"]].tobytes() == bytes(r["ids"])


def test_the_knapsack_finds_the_best_pattern():
    rng = np.random.default_rng(5)
    lengths, prices = np.array([3, 5, 7, 11]), rng.random(4)
    best, _ = stock.knapsack(prices, lengths, 24)
    plain = max(
        (np.array(c) * prices).sum() for c in product(range(9), range(5), range(4), range(3)) if (np.array(c) * lengths).sum() <= 24
    )
    assert abs(best[24] - plain) < 1e-12


@pytest.mark.parametrize("seed", range(6))
def test_patterns_fit_and_ask_for_no_more_than_there_is(seed):
    rng = np.random.default_rng(seed)
    lengths = np.unique(rng.integers(1, 513, 60))
    demand = rng.integers(1, 10 ** (1 + seed), len(lengths))
    _, _, cost, bound = stock.relaxed(lengths, demand, 512)
    assert (lengths * demand).sum() / 512 <= bound + 1e-9 <= cost + 1e-6 and cost <= 1.01 * (lengths * demand).sum() / 512 + 1e-6
    taken = np.zeros(len(lengths), int)
    for pattern in stock.patterns(lengths, demand, 512):
        size = sum(lengths[k] * n for k, n in pattern.pieces.items())
        assert 512 / 1.0101 <= size <= 512
        for k, n in pattern.pieces.items():
            taken[k] += n * pattern.copies
    assert (taken <= demand).all()


def test_classes_are_as_long_as_their_longest_piece():
    lengths = np.arange(1, 4097)
    tops = stock.length_classes(lengths, 300)
    assert len(tops) <= 300 and tops[-1] == 4096 and (tops[np.searchsorted(tops, lengths)] >= lengths).all()
    assert stock.length_classes(np.array([5, 9])).tolist() == [5, 9]
