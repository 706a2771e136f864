"""The pipeline against the same steps by plain Python over its stages' inputs."""

import collections

import corpus_pipeline
from quillmark.llm import quality, secret_scan, toxicity
from quillmark.llm.common import read
from tests.llm import edges
from tests.llm.test_minhash import brute as components
from tests.llm.test_secret_scan import base

SF = "/root/testdata/sf0.01"


def test_stages_follow_one_another(spark):
    docs = read(spark, SF, "documents")
    columns = docs.columns
    seen = {r.doc_id: r for r in docs.collect()}
    for name, function in corpus_pipeline.STAGES:
        before = seen
        out = corpus_pipeline.stage(function(spark, docs, SF), name)
        if name != "packing":
            assert out.columns == columns
            seen = {r.doc_id: r for r in out.collect()}
            assert out.count() == len(seen)
        if name == "quality":
            model = quality.train(docs, read(spark, SF, "labels"))
            kept = {i for i, r in before.items() if model.scores([r.text or ""])[0] >= 0.7}
            assert set(seen) == kept and all(seen[i] == before[i] for i in seen)
        if name == "toxicity":
            model = toxicity.train(docs, read(spark, SF, "labels"))
            kept = {r.doc_id for r in toxicity.scores(docs, model).collect() if r.score < 0.7}
            assert set(seen) == kept and all(seen[i] == before[i] for i in seen)
        if name == "near_duplicates":
            groups = components(before.values())
            assert set(seen) == {i for i, (_, c) in groups.items() if i == c} and all(seen[i] == before[i] for i in seen)
        if name == "secrets":
            assert set(seen) == set(before)
            for i, r in seen.items():
                assert not base(r.text) and r.n_chars == len(r.text)
                assert r.text == before[i].text or secret_scan.KINDS and "[SECRET]" in r.text
        if name == "packing":
            rows = out.collect()
            assert {r.doc_id for r in rows} == set(before)
            filled = collections.Counter()
            for r in rows:
                filled[r.sequence_id] += r.length
            assert max(filled.values()) <= 2048
        docs = out


def test_edges_pass_through(spark, tmp_path):
    edges.labels(spark).write.parquet(f"{tmp_path}/labels.parquet")
    for docs in (edges.documents(spark), edges.no_documents(spark)):
        for name, function in corpus_pipeline.STAGES:
            before = docs.count()
            docs = corpus_pipeline.stage(function(spark, docs, str(tmp_path)), name)
            assert docs.count() <= before or name == "packing"
