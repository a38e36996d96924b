import hashlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from cases import awkward_texts, by_id, changed, documents, no_rows, prose, saved

from riskweave.llm import difference_cover as cover
from riskweave.llm import hyperminhash as hmh
from riskweave.llm.components import components
from riskweave.llm.difference_cover import without_repeats
from riskweave.llm.hyperminhash import near_duplicate_table, near_duplicates, without_near_duplicates


def shingles(text, k):
    words = (text or "").encode().lower().split()
    k = min(k, len(words))
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if words else set()


def plain_components(docs, k, percent):
    """{doc_id: (set size, smallest doc_id reachable)} by comparing all pairs."""
    sets, root = {i: shingles(t, k) for i, t in docs.items()}, {i: i for i in docs}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in docs:
        for j in docs:
            if i < j and sets[i] and sets[j]:
                both = len(sets[i] & sets[j])
                if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                    a, b = find(i), find(j)
                    root[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in docs}


def near_copies():
    """A chain whose ends are unlike, a crowd of copies around one text, and pairs just above and below the limit."""
    chain, crowd = [prose(100, 200)], prose(200, 150)
    for i in range(12):
        chain.append(changed(chain[-1], 300 + i, 5))
    pairs = [t for i in range(8) for t in (prose(400 + i, 120), changed(prose(400 + i, 120), 500 + i, 1 + i))]
    tiny = ["a b c d e f g h i", "a b c d e f g h j", "A B C", "a b c", "a b", "x"]
    return chain + [changed(crowd, 600 + i, 1 + i % 6) for i in range(60)] + pairs + tiny


@pytest.mark.parametrize("k, percent", [(3, 85), (5, 80)])
def test_components_equal_all_pairs(spark, k, percent, monkeypatch):
    docs = documents(spark, awkward_texts() + near_copies())
    plain = plain_components({r["doc_id"]: r["text"] for r in docs.collect()}, k, percent)
    for block in (512, 7):  # small blocks put the crowd into many
        monkeypatch.setattr(hmh, "BLOCK_ROWS", block)
        got = by_id(near_duplicate_table(docs.withColumnRenamed("lang", "node"), k, percent))
        assert {i: (r["n_shingles"], r["component_id"]) for i, r in got.items()} == plain
        assert all(r["kept"] == (i == r["component_id"]) for i, r in got.items())


@pytest.mark.parametrize("bucket, rounds", [(4096, 8), (20, 3), (4, 1)])
def test_no_centre_hides_a_pair_of_its_bucket(spark, monkeypatch, bucket, rounds):
    """One bucket of unlike texts, of pages of one template, and of pairs and a crowd among them."""

    def one_bucket(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([1] * batch.num_rows, pa.int64()), batch["_row"]], names=["key", "node"])

    template = prose(50, 60)
    pages = [f"{template} {prose(60 + i, 20 + 3 * (i % 20))}" for i in range(60)]
    pairs = [t for i in range(0, 60, 5) for t in (pages[i], changed(pages[i], 700 + i, 1 + i % 3))]
    crowd = [changed(prose(200, 150), 600 + i, 1 + i % 6) for i in range(30)]
    docs = documents(spark, [prose(1, 90), prose(2, 90), *pages, *pairs, prose(3, 90), *crowd])
    plain = plain_components({r["doc_id"]: r["text"] for r in docs.collect()}, 3, 85)
    monkeypatch.setattr(hmh, "_banding", one_bucket)
    monkeypatch.setattr(hmh, "BUCKET_ROWS", bucket, raising=False)
    monkeypatch.setattr(hmh, "ROUNDS", rounds, raising=False)
    got = by_id(near_duplicate_table(docs))
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in got.items()} == plain


def test_one_row_of_each_group_stays(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (None, "only here"), (3, None), (4, "")]
    docs = saved(spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS kept", "7 AS _row"))
    out = without_near_duplicates(docs)
    assert out.columns == docs.columns and {r["_row"] for r in out.collect()} == {7}
    assert sorted((r["doc_id"] or 0, r["text"]) for r in out.collect() if r["text"]) == [(0, "only here"), (1, "a b c d e f")]
    assert out.count() == 4
    assert near_duplicates(no_rows(spark)).count() == 0 and without_near_duplicates(no_rows(spark)).count() == 0


def test_estimates_follow_the_similarity():
    rng = np.random.default_rng(3)
    for share in (0.3, 0.5, 0.8, 0.9):
        n, wrong = 3000, []
        for _ in range(30):
            common = rng.integers(0, 2**64, int(n * share), np.uint64)
            own = [np.unique(np.r_[common, rng.integers(0, 2**64, (n - len(common)) // 2, np.uint64)]) for _ in range(2)]
            both = len(np.intersect1d(*own))
            true = both / (len(own[0]) + len(own[1]) - both)
            got = hmh.estimate(*(hmh.registers(s)[None] for s in own), *(np.array([len(s)]) for s in own))[0]
            wrong.append(got - true)
        assert abs(np.mean(wrong)) < 0.02 and np.abs(wrong).max() < hmh.MARGIN + 0.03


def test_registers_hold_zeros_and_mantissa():
    value = (5 << 56) | (1 << 50) | (0b1010101010 << 40)
    regs = hmh.registers(np.array([value], np.uint64))
    assert np.flatnonzero(regs).tolist() == [5]
    assert (int(regs[5]) >> 10, int(regs[5]) & 1023) == (56 - 51 + 1, 0b1010101010)
    assert (hmh.densified(regs) == regs[5]).all()


@pytest.mark.parametrize("few, many", [(4, 5), (5, 6), (6, 7), (8, 10), (1, 1)])
def test_small_sets_share_a_band(few, many):
    rng, apart = np.random.default_rng(few), 0
    for _ in range(4000):
        hashes = rng.integers(0, 2**64, many, np.uint64)
        a, b = (hmh.densified(hmh.registers(np.sort(h))).reshape(-1) for h in (hashes, hashes[:few]))
        bands = [x[: hmh.BANDS * hmh.BAND_ROWS].reshape(hmh.BANDS, hmh.BAND_ROWS) for x in (a, b)]
        apart += not (bands[0] == bands[1]).all(1).any()
    assert apart <= 1


def test_few_registers_do_not_hide_a_small_pair():
    """Of five shingles two times two fall into one register: the estimate is 2 / 3, the similarity 4 / 5."""
    hashes = np.array([(1 << 56) + 5, (1 << 56) + 9, (2 << 56) + 5, (2 << 56) + 9, (3 << 56) + 5], np.uint64)
    sets = [hashes.tobytes(), hashes[:4].tobytes()]
    block = pa.table({"node": [1, 2], "visitor": [False, False], "label": [1, 2], "hashes": sets})
    assert hmh._comparing(80, True)(block).to_pylist() == [{"a": 1, "b": 2}]


def test_components_of_chains_stars_and_rings(spark):
    edges = [(i, i + 1) for i in range(40)] + [(1000, 1000 + i) for i in range(1, 50)] + [(2000 + i, 2000 + (i + 1) % 9) for i in range(9)] + [(5, 5)]
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: 0 if n < 100 else n // 1000 * 1000 for n in {x for e in edges for x in e}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# -- passages -----------------------------------------------------------------------------------


def plain_passages(docs, window=13):
    words = {i: (t or "").encode().split() for i, t in docs.items()}
    first = {}
    for i in sorted(words):
        for p in range(len(words[i]) - window + 1):
            first.setdefault(tuple(words[i][p : p + window]), i)
    out = {}
    for i, w in words.items():
        gone = set()
        for p in range(len(w) - window + 1):
            if first[tuple(w[p : p + window])] < i:
                gone.update(range(p, p + window))
        kept = b" ".join(x for j, x in enumerate(w) if j not in gone)
        out[i] = (len(w), len(gone), hashlib.sha256(kept).hexdigest(), kept.decode())
    return out


def passages():
    """One passage at every offset and of every length around the window, and repeats within a document."""
    passage = prose(7, 40).split()
    texts = [" ".join([prose(800 + i, i % 15), *passage[i % 5 : i % 5 + 8 + i], prose(900 + i, 20)]) for i in range(28)]
    return texts + [" ".join(passage[:20] * 3), " ".join(["z"] * 60), " ".join(["z"] * 13), " ".join(["z"] * 12)]


def test_the_cover_brings_any_two_positions_to_a_shared_anchor():
    for i in range(cover.PERIOD):
        for j in range(cover.PERIOD):
            assert any((i + k) % cover.PERIOD in cover.COVER and (j + k) % cover.PERIOD in cover.COVER for k in range(cover.PERIOD))


@pytest.mark.parametrize("window, chunk_bytes, entries", [(13, 1, 100), (13, 32 << 20, 2 << 20), (7, 4000, 50), (50, 1, 1000)])
def test_removed_words_equal_the_plain_version(spark, window, chunk_bytes, entries):
    docs = documents(spark, awkward_texts() + passages())
    plain = plain_passages({r["doc_id"]: r["text"] for r in docs.collect()}, window)
    got = by_id(without_repeats(docs.withColumnRenamed("lang", "n_words"), window, chunk_bytes=chunk_bytes, bucket_entries=entries))
    assert {i: (r["n_words"], r["n_removed"], r["kept_sha256"], r["kept_text"]) for i, r in got.items()} == plain


def test_equal_and_null_ids_and_no_rows(spark):
    text = prose(5, 30)
    docs = saved(spark.createDataFrame([(1, text), (1, text), (None, text), (None, text), (0, "short")], "doc_id long, text string"))
    rows = without_repeats(docs).collect()
    assert Counter((r["doc_id"], r["n_removed"]) for r in rows) == {(1, 0): 2, (None, 30): 2, (0, 0): 1}
    assert without_repeats(no_rows(spark)).count() == 0
    with pytest.raises(ValueError):
        without_repeats(docs, window=6)


def test_groups_of_a_bucket_are_as_many_as_chunks():
    chunk = cover.Chunk([1, 2, 3], ["a b c d e f g h i j k l m n"] * 3)
    anchors = cover.ChunkAnchors(chunk)
    assert len(anchors.distinct) == len(anchors.at) / 3 and anchors.repeated.all()
    windows = cover.ChunkWindows(chunk, anchors.shared(np.zeros(len(anchors.distinct), bool)))
    assert len(windows.distinct) == 2 and windows.least.tolist() == [1, 1]
    groups = defaultdict(int)
    for i in chunk.ids[windows.repeated(np.zeros(2, bool))]:
        groups[int(i)] += 1
    assert groups == {2: 2, 3: 2}
