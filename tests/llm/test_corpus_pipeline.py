import hashlib
import weakref

import pytest

import corpus_pipeline
from recsmith.llm import bpe, mixing, quality, secret_scan, simhash

BIGGER = "/root/testdata/sf0.01"


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{BIGGER}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "simhash near-dedup", "secret scans", "source mix", "bpe"]
    seen = [docs]
    for _, stage in corpus_pipeline.STAGES:
        seen.append(simhash.materialize(stage(spark, seen[-1], BIGGER)))
    tables = [{r["doc_id"]: r for r in t.collect()} for t in seen[:4]]
    assert all(t.columns == docs.columns for t in seen[1:5])

    score = {r["doc_id"]: r["predicted"] for r in quality.op5_quality(spark, BIGGER).collect()}
    assert set(tables[1]) == {i for i in tables[0] if score[i]}

    fps = {i: simhash.simhash(r["text"]) for i, r in tables[1].items()}
    root = {}
    for i in sorted(fps):  # smallest ids first: breadth-first over links
        if i not in root:
            todo = [i]
            while todo:
                a = todo.pop()
                root[a] = i
                todo += [b for b in fps if b not in root and (fps[a] ^ fps[b]).bit_count() <= 3]
    assert set(tables[2]) == set(root.values())

    assert set(tables[3]) == set(tables[2])
    for i, r in tables[3].items():
        before = tables[2][i]["text"]
        base, _ = secret_scan.scan(before)
        assert all(before[s:e] not in r["text"] for s, _, e in base)
        assert (r["text"] == before) or base or "[SECRET]" in r["text"]
        assert r["n_chars"] == len(r["text"]) or r["text"] == before

    copies = {r["doc_id"]: r["copies"] for r in mixing.mix(seen[3]).collect()}
    mixed = [r["doc_id"] for r in seen[4].collect()]
    assert sorted(mixed) == sorted(i for i, n in copies.items() for _ in range(n))

    codec = bpe.codec(bpe.read_tokenizer())
    out = seen[5].collect()
    assert sorted(r["doc_id"] for r in out) == sorted(mixed)
    for r in out[:200]:
        ids = codec.encode(tables[3][r["doc_id"]]["text"])
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())


def test_odd_and_empty_documents(spark, odd_docs, no_docs, small):
    for docs in (odd_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES:
            out = simhash.materialize(stage(spark, docs, small))
            if name != "bpe":
                assert out.columns == docs.columns, name
            docs = out


class _Captured:
    """Stands for documents: keeps the function that a stage runs in the workers."""

    columns, schema = ["doc_id", "text"], {}

    def select(self, *_):
        return self

    def mapInArrow(self, f, _):
        self.run = f
        return self


@pytest.mark.parametrize("stage", [quality.statistics, simhash.fingerprints, secret_scan.scans])
def test_a_worker_of_another_stage_lets_the_bpe_tables_go(spark, stage):
    spec = bpe.read_tokenizer()
    kept = weakref.ref(bpe.codec(spec))
    assert bpe.codec(spec) is kept()
    docs = _Captured()
    stage(docs)
    assert not list(docs.run(iter([])))
    assert kept() is None
