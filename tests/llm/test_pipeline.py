from __future__ import annotations

import random

import corpus_pipeline
from fixtures import documents, mixed_rows, sentence

from windgrid.llm import queries


def test_stages_keep_columns_and_clean_rows(spark, tmp_path):
    rng = random.Random(8)
    base = [(k, " ".join(f"w{rng.randint(0, 3000)}" for _ in range(60))) for k in range(200)]
    toxic = [(1000 + k, t + " grumbelish words") for k, (_, t) in enumerate(base[:40])]
    poor = [(2000 + k, " ".join(w + "%%%" for w in sentence(rng, 40).split())) for k in range(40)]
    copies = [(3000, base[5][1]), (3001, base[6][1] + " tail"), (5, base[5][1])]
    secret = [(4000, " ".join(f"v{rng.randint(0, 3000)}" for _ in range(40)) + " password=abcdefgh12")]
    rows = base + toxic + poor + copies + secret + [(5000, None), (5001, "")]
    spark.createDataFrame([(d, int(d < 2000 or d >= 3000), int(1000 <= d < 2000)) for d, _ in rows], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = documents(spark, rows)
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path)).cache()
        seen[name] = out.collect()
        if name != "packing":
            assert out.columns == docs.columns
        docs = out
    ids = {name: {r.doc_id for r in got} for name, got in seen.items()}
    assert ids["toxicity"] == {d for d, _ in rows} - {d for d, _ in toxic}
    assert ids["quality"] == ids["toxicity"] - {d for d, _ in poor} - {5000, 5001}
    assert ids["near_dedup"] == ids["quality"] - {3000, 3001} and len(seen["near_dedup"]) == len(ids["near_dedup"])
    masked = next(r for r in seen["secrets"] if r.doc_id == 4000)
    assert masked.text.endswith(" [SECRET]") and masked.n_chars == len(masked.text)
    assert {r.doc_id for r in seen["packing"]} == ids["secrets"] == ids["near_dedup"]


def test_empty_documents_pass_through(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    documents(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_odd_rows_pass_through(spark, tmp_path):
    spark.createDataFrame([(None, None, None)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    documents(spark, mixed_rows()).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0


def test_every_operator_is_registered_once():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
    assert set(queries.ORACLES) <= set(queries.QUERIES)
