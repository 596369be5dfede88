"""The pipeline: each stage on what its predecessor kept, and the whole run."""

import corpus_pipeline as P
from strata.llm import decontaminate, quality_rules, simhash, token_shards
from strata.llm.common import staged, table
from tests.conftest import SF_CHECK


def test_stages(spark):
    assert [n for n, _ in P.STAGES] == ["quality_rules", "simhash_dedup", "decontamination", "mixing", "token_shards"]
    docs = table(spark, SF_CHECK, "documents")
    columns, before = docs.columns, docs
    kept = []
    for name, stage in P.STAGES[:-1]:
        docs = staged(stage(spark, before, SF_CHECK), "stage")
        assert docs.columns == columns, name
        kept.append(docs)
        before = docs
    ids = [{r["doc_id"] for r in k.select("doc_id").collect()} for k in kept]
    verdicts = quality_rules.quality_verdicts(table(spark, SF_CHECK, "documents"), ["doc_id"])
    assert ids[0] == {r["doc_id"] for r in verdicts.where("kept").collect()}
    near = simhash.near_copies(kept[0]).collect()
    assert ids[1] == {r["component_id"] for r in near} and kept[1].count() == len(ids[1])
    hits = {r["doc_id"] for r in decontaminate.contaminated(kept[1], table(spark, SF_CHECK, "benchmark")).collect()}
    assert hits and ids[2] == ids[1] - hits
    assert ids[3] == ids[2] and kept[3].count() > len(ids[2])
    index = P.STAGES[-1][1](spark, kept[3], SF_CHECK).collect()
    assert {d for r in index for d in r["doc_ids"]} == ids[3]
    run = P.run(spark, SF_CHECK).collect()  # files are split alike, so shards are the same
    assert sum(r["n_tokens"] for r in run) == sum(r["n_tokens"] for r in index)
    assert len(list(token_shards.read_sequences(run[0]["path"]))) == len(run)


def test_empty_corpus(spark, no_docs, tmp_path):
    for name in ("benchmark",):
        table(spark, SF_CHECK, name).write.parquet(f"{tmp_path}/{name}.parquet")
    no_docs.write.parquet(f"{tmp_path}/documents.parquet")
    assert P.run(spark, str(tmp_path)).count() == 0
