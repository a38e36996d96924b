from collections import Counter

from cases import changed, documents, prose, saved
from test_scoring import plain_pairs
from test_similar import plain_components

import corpus_pipeline
from riskweave.llm import toxicity
from riskweave.llm.mixing import draws

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_each_stage_decides_as_its_plain_version(spark, tmp_path):
    items = [prose(60 + i, 30) for i in range(4)]
    texts = [prose(1000 + i, 80) for i in range(150)]
    texts += [changed(texts[i], i, 2) for i in range(30)] + [f"{prose(2000 + i, 50)} {items[i % 4]}" for i in range(12)]
    texts += [f"{prose(3000 + i, 40)} mudplonk {prose(4000 + i, 20)}" for i in range(40)] + [None, "", "x", texts[0]]
    docs = documents(spark, texts)
    toxic = {r["doc_id"] for r in docs.collect() if "mudplonk" in (r["text"] or "")}
    labels = spark.createDataFrame([(r["doc_id"], 1, int(r["doc_id"] in toxic)) for r in docs.collect()], "doc_id long, quality int, toxic int")
    folder = str(tmp_path)
    docs.write.parquet(f"{folder}/documents.parquet")
    labels.write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")

    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "decontamination", "mixing", "sharding"]
    now = spark.read.parquet(f"{folder}/documents.parquet")
    texts_of = lambda df: {r["doc_id"]: r["text"] for r in df.collect()}
    seen = [texts_of(now)]
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, now, folder)
        assert out.columns[:5] == COLUMNS
        now = saved(out)
        seen.append(texts_of(now))
    assert seen[0].keys() - seen[1].keys() == toxic
    parts = plain_components(seen[1], 5, 80)
    assert seen[2].keys() == {i for i, (_, c) in parts.items() if c == i}
    assert seen[2].keys() - seen[3].keys() == {d for d, _ in plain_pairs(seen[2], dict(enumerate(items)))}
    assert seen[3].keys() >= seen[4].keys() and all(seen[4][i] == seen[0][i] for i in seen[4])
    rows = now.collect()
    assert sorted(now.columns) == sorted([*COLUMNS, "size", "text_crc32", "shard", "slot"])
    for shard, n in Counter(r["shard"] for r in rows).items():
        assert sorted(r["slot"] for r in rows if r["shard"] == shard) == list(range(n))
    whole = corpus_pipeline.run(spark, folder)
    assert Counter(r["doc_id"] for r in whole.collect()) == Counter(r["doc_id"] for r in rows)
    assert toxicity.THRESHOLD == 0.7 and draws(now.select(*COLUMNS)).count() > 0
