import math
import random
import re
from collections import Counter
from hashlib import md5

import numpy as np
import pytest
from cases import awkward_texts, by_id, documents, no_rows, prose, saved

from riskweave.llm import toxicity as tox
from riskweave.llm.decontamination import contaminated, decontaminated
from riskweave.llm.mixing import draws, mixed, temperature, weights_at

BAD = ["grumblefex", "snortwick", "mudplonk", "zirkelbo"]
LABELS = "doc_id long, quality int, toxic int"


def _hide(word, how):
    leet = str.maketrans({"o": "0", "e": "3", "i": "1", "s": "$", "b": "8"})
    return {0: word, 1: word.translate(leet), 2: " ".join(word), 3: "".join(c * 3 for c in word), 4: ".".join(word), 5: word.upper() + "!!"}[how]


@pytest.fixture(scope="module")
def corpus(spark):
    """600 texts, a quarter with one or two marked words; what is held out is hidden in all ways."""
    rng, rows, labels = random.Random(11), [], []
    for i in range(600):
        words, toxic = prose(5000 + i, 60).split(), i % 4 == 0
        held = __import__("zlib").crc32(str(i).encode()) % 3 == 1
        for _ in range(2 * toxic):
            how = rng.randrange(6) if held else rng.choice([0, 0, 0, 5])
            words.insert(rng.randrange(len(words)), _hide(rng.choice(BAD), how))
        rows.append((i, " ".join(words), "en", "src", 0))
        labels.append((i, 1, int(toxic)))
    docs = saved(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, score long"))
    return docs, saved(spark.createDataFrame(labels, LABELS))


def test_held_out_texts_are_recognised_behind_their_disguise(corpus):
    docs, labels = corpus
    got = by_id(tox.toxicity(docs, labels))
    truth = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    hits = Counter((truth[i], r["predicted"]) for i, r in got.items() if r["held_out"])
    assert len(got) == 600 and hits[0, 1] == 0
    assert hits[1, 1] >= 0.95 * (hits[1, 1] + hits[1, 0])
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in got.values())


def test_rejected_documents_go_and_columns_stay(corpus):
    docs, labels = corpus
    kept = tox.without_toxic(docs, labels)
    assert kept.columns == docs.columns
    rejected = {i for i, r in by_id(tox.toxicity(docs, labels)).items() if r["predicted"]}
    assert {r["doc_id"] for r in kept.collect()} == set(range(600)) - rejected


def test_copies_are_one_piece_of_evidence(spark):
    copies = [prose(1, 50)] * 60 + [prose(9000 + i, 50) for i in range(200)]
    docs = documents(spark, copies)
    bad = {r["doc_id"] for r in docs.where("text = '{}'".format(copies[0])).collect()}
    labels = saved(docs.selectExpr("doc_id", "1 AS quality").join(spark.createDataFrame([(i,) for i in bad], "doc_id long").selectExpr("doc_id", "1 AS toxic"), "doc_id", "left").selectExpr("doc_id", "quality", "coalesce(toxic, 0) AS toxic"))
    assert tox.fit(docs, labels).weights == {}


def test_awkward_rows_have_a_score(spark):
    docs = documents(spark)
    none = no_rows(spark, LABELS)
    rows = tox.toxicity(docs, none).collect()
    assert len(rows) == docs.count() and {r["score"] for r in rows} == {0.0}
    odd = saved(spark.createDataFrame([(0, 1, None), (7, 1, 1), (7, 1, 0), (None, 0, 1), (14, 0, 0)], LABELS))
    assert tox.toxicity(docs, odd).count() == docs.count()
    assert tox.toxicity(no_rows(spark), odd).count() == 0


def test_viterbi_finds_the_likeliest_path():
    """Against every path of the lattice."""
    counts = tox.trigram_counts([" ".join(["idiot this that rations", "loser tools is"] * 9)], tox._symbol_table())
    costs = tox.character_costs(counts, counts)
    decoder = tox.Decoder(costs)

    def every(observed):
        paths, before = [(0.0, (0, 0), "")], None
        for c in observed:
            arcs = decoder._arcs(c, before)
            paths = [
                (cost + extra + (costs[state][s] if s is not None else 0), state if s is None else (state[1], s), word + x)
                for cost, state, word in paths for s, x, extra in arcs
            ]
            before = before if c in tox.GAPS else c
        return min((cost + costs[state][0], word) for cost, state, word in paths)[1]

    for observed in ["1d10t", "i.d.i.o.t", "iidd1ot", "l0$3r", "t00ls", "i d i o t", "is", "7h1s"]:
        assert decoder.decode(observed) == every(observed)
    assert [decoder.decode(x) for x in ("1d10t", "i d i o t", "l0$3r")] == ["idiot", "idiot", "loser"]


def test_trigram_counts_are_whole_and_do_not_depend_on_pieces():
    table, text = tox._symbol_table(), prose(3, 400)
    whole = tox.trigram_counts([text], table)
    assert (tox.trigram_counts([text], table, piece=7) == whole).all()
    assert whole.sum() == len(text) + 2
    assert (tox.trigram_counts(tox._joined(["ab", None, "", "cd"]), table) == tox.trigram_counts(["ab      cd"], table)).all()


# -- benchmark items ----------------------------------------------------------------------------


def _shingles(text):
    words = re.findall(r"\w+", (text or "").lower())
    k = min(5, len(words))
    return k, {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if words else set()


def plain_pairs(docs, items):
    out = {}
    for d, text in docs.items():
        words = re.findall(r"\w+", (text or "").lower())
        for i, item in items.items():
            k, wanted = _shingles(item)
            have = {tuple(words[j : j + k]) for j in range(len(words) - k + 1)}
            if wanted and len(wanted & have) >= 0.8 * len(wanted):
                out[d, i] = (len(wanted), len(wanted & have))
    return out


def test_contained_items_equal_all_pairs(spark):
    items = [prose(70 + i, n) for i, n in enumerate([3, 5, 9, 20, 21, 60, 300])] + [None, "", "!!", "Two, words", prose(72, 9)]
    texts = awkward_texts()
    for i, item in enumerate(items):
        words = (item or "").split()
        for cut in (0, 1, len(words) // 12, len(words) // 5, len(words) // 3):
            texts.append(f"{prose(80 + i, 200)} {' , '.join(words[: len(words) - cut]).upper()} {prose(90 + i, 3000)}")
    docs = documents(spark, texts)
    benchmark = saved(spark.createDataFrame([(i, t, "x") for i, t in enumerate(items)], "item_id long, text string, doc_id string"))
    plain = plain_pairs({r["doc_id"]: r["text"] for r in docs.collect()}, dict(enumerate(items)))
    for block in (1, 32 << 20):
        rows = contaminated(docs.withColumnRenamed("lang", "item_id"), benchmark, block_bytes=block).collect()
        assert {(r["doc_id"], r["item_id"]): (r["item_shingles"], r["shared"]) for r in rows} == plain and len(rows) == len(plain)
        kept = decontaminated(docs, benchmark, block_bytes=block)
        assert kept.columns == docs.columns
        assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in docs.collect()} - {d for d, _ in plain}
    assert 10 < len(plain) < len(texts)


def test_no_items_and_no_documents(spark):
    docs, none = documents(spark), no_rows(spark, "item_id long, text string")
    assert contaminated(docs, none).count() == 0 and decontaminated(docs, none).count() == docs.count()
    assert contaminated(no_rows(spark), saved(spark.createDataFrame([(1, "a b c")], "item_id long, text string"))).count() == 0


# -- mixing -------------------------------------------------------------------------------------


def test_temperature_meets_its_targets():
    tokens = {"big": 10_000, "mid": 1_000, "small": 100, "none": 0}
    free = temperature(tokens, 5_000, entropy_share=0.8, most_passes=1e9)
    assert math.isclose(free.entropy, 0.8 * math.log(3), rel_tol=1e-9) and 0 < free.exponent < 1
    tight = temperature(tokens, 5_000, entropy_share=0.8, most_passes=2)
    assert math.isclose(tight.passes, 2, rel_tol=1e-9) and tight.exponent > free.exponent
    assert temperature(tokens, 50_000, 0.8, 2).exponent == 1.0
    assert math.isclose(sum(free.weights.values()), 1) and "none" not in free.weights
    assert temperature({}, 0).weights == {} and temperature({"a": 5}, 5).weights == {"a": 1.0}


def test_draws_realise_the_weights(spark):
    rng = random.Random(5)
    rows = [(i, prose(i, rng.randint(1, 9)), rng.choice(["big"] * 20 + ["mid"] * 5 + ["small", None])) for i in range(1500)]
    docs = saved(spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("*", "'x' AS mix_pass", "7 AS _row"))
    tokens = Counter()
    for _, text, source in rows:
        tokens[source] += len(text.split())
    budget = sum(tokens.values())
    want = temperature(dict(tokens), budget)
    for block_rows in (1, 50, 4096):
        got = draws(docs, block_rows=block_rows).collect()
        spent = Counter()
        for r in got:
            spent[r["source"]] += r["mix_tokens"]
        for source, weight in want.weights.items():
            assert weight * budget - 10 <= spent[source] <= weight * budget
        times = Counter(r["doc_id"] for r in got)
        for source in tokens:
            passes = {times[i] for i, _, s in rows if s == source}
            assert max(passes) - min(passes) <= 1 and max(passes) <= 5
        assert all({r["mix_pass"] for r in got if r["doc_id"] == i} == set(range(n)) for i, n in list(times.items())[:50])
    assert Counter(r["doc_id"] for r in mixed(docs).collect()) == Counter(r["doc_id"] for r in draws(docs).collect())
    assert mixed(docs).columns == docs.columns and {r["_row"] for r in mixed(docs).collect()} == {7}


def plain_draws(rows, seed=1):
    """The rows of the mixture in order, by one loop over each source and pass."""
    words = {i: len((text or "").split()) for i, text, _ in rows}
    tokens = Counter()
    for i, _, source in rows:
        tokens[source] += words[i]
    budget, out = sum(tokens.values()), set()
    mixture = temperature(dict(tokens), budget)
    for source, weight in mixture.weights.items():
        share = weight * budget
        whole = int(share // tokens[source])
        for k in range(whole + 1):
            def place(row):
                key = md5(f"{row[0]}:{md5((row[1] or '').encode()).hexdigest()}".encode()).hexdigest()
                return int(md5(f"{seed}:{k}:{key}".encode()).hexdigest()[:15], 16)

            left = share - whole * tokens[source] if k == whole else math.inf
            for position, row in enumerate(sorted((r for r in rows if r[2] == source), key=place)):
                left -= words[row[0]]
                if left < 0:
                    break
                out.add((row[0], source, k, position, words[row[0]]))
    return out


@pytest.mark.parametrize("block_rows", [3, 4096])
def test_draws_equal_a_plain_version(spark, block_rows):
    rng = random.Random(15)
    rows = [(i, None if i % 41 == 0 else prose(i, rng.randint(0, 30)), rng.choice(["big"] * 9 + ["small", None])) for i in range(400)]
    rows += [(400, prose(400, 5_000), "long"), (401, "one", "long"), (402, None, "wordless")]
    got = draws(saved(spark.createDataFrame(rows, "doc_id long, text string, source string")), block_rows=block_rows).collect()
    want = plain_draws(rows)
    assert {(r["doc_id"], r["source"], r["mix_pass"], r["mix_position"], r["mix_tokens"]) for r in got} == want and len(got) == len(want)
    passes = {}
    for r in got:
        passes.setdefault((r["source"], r["mix_pass"]), []).append((r["mix_position"], r["doc_id"]))
    assert all([p for p, _ in sorted(x)] == list(range(len(x))) for x in passes.values())
    first, second = ([i for _, i in sorted(passes["small", k])] for k in (0, 1))
    assert set(second) <= set(first) and first[: len(second)] != second


def test_block_size_and_row_order_do_not_change_the_draw(spark):
    docs = documents(spark, [prose(i, 5) for i in range(300)])
    one = Counter(r["doc_id"] for r in draws(docs, budget=700).collect())
    assert one == Counter(r["doc_id"] for r in draws(saved(docs), budget=700, block_rows=7).collect())
    assert one != Counter(r["doc_id"] for r in draws(docs, budget=700, seed=2).collect())


def test_awkward_rows_are_mixed(spark):
    docs = documents(spark, awkward_texts() * 3)
    got = draws(docs).collect()
    assert all(r["mix_tokens"] >= 0 for r in got)
    assert draws(no_rows(spark)).count() == 0 and mixed(no_rows(spark)).count() == 0
    assert draws(documents(spark, [None, "", " "])).count() == 0
    assert np.isclose(sum(weights_at({"a": 1, "b": 3}, 1.0).values()), 1)
