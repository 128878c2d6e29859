import random

import numpy as np

from recsmith.llm import simhash


def slow_simhash(text, shingle=3):
    import xxhash
    words = [w for w in __import__("re").findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))]
    if not words:
        return 0
    grams = [" ".join(words[i:i + shingle]) for i in range(len(words) - shingle + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(fps, bits=3):
    ids = list(fps)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            if (fps[a] ^ fps[b]).bit_count() <= bits:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_fingerprints_of_single_texts():
    for text in (None, "", " \n", "A", "a b", "a b c", "The the THE the", "É é Ä ä x y z", "x " * 5000, "a\x0bb\x0cc\x1cd e f"):
        assert simhash.simhash(text) == slow_simhash(text), text


def test_equal_to_brute_force(spark, small):
    got = simhash.op3_simhash(spark, small).collect()
    docs = spark.read.parquet(f"{small}/documents.parquet").collect()
    fps = {r["doc_id"]: slow_simhash(r["text"]) for r in docs}
    comp = components(fps)
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in got} == {i: (f"{fps[i]:016x}", comp[i]) for i in fps}
    kept = simhash.drop_near_copies(spark.read.parquet(f"{small}/documents.parquet"))
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(comp.values()))


def test_near_pairs_at_every_distance(spark):
    rng = np.random.default_rng(3)
    fps = {0, 2 ** 64 - 1}
    for b in rng.integers(0, 2 ** 63, 60).tolist():
        for k in range(6):
            x = b
            for i in rng.choice(64, k, replace=False):
                x ^= 1 << int(i)
            fps.add(x)
    signed = {x - 2 ** 64 if x >= 2 ** 63 else x for x in fps}
    got = [tuple(sorted(r)) for r in simhash.near_pairs(spark.createDataFrame([(x,) for x in signed], "fp long")).collect()]
    order = sorted(signed)
    want = {(a, b) for i, a in enumerate(order) for b in order[i + 1:] if ((a ^ b) & (2 ** 64 - 1)).bit_count() <= 3}
    assert len(got) == len(set(got)) and set(got) == want


def test_pairs_are_joined_without_a_broadcast(spark):
    near = simhash.near_pairs(spark.createDataFrame([(0,), (1,), (3,), (-1,)], "fp long"))
    assert "Broadcast" not in near._jdf.queryExecution().executedPlan().toString()
    assert sorted(tuple(sorted(r)) for r in near.collect()) == [(0, 1), (0, 3), (1, 3)]


def test_manhattan_is_a_lower_bound():
    random.seed(0)

    def counts(x):
        return [(x >> 2 * i & 3).bit_count() for i in range(32)]

    for _ in range(500):
        a, b = random.getrandbits(64), random.getrandbits(64)
        assert sum(abs(p - q) for p, q in zip(counts(a), counts(b))) <= (a ^ b).bit_count()


def test_hot_group_of_copies(spark):
    from pyspark.sql import functions as F
    docs = spark.range(900).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "one copied text of many words")
                                   .otherwise(F.concat_ws(" ", *[F.md5((F.col("id") * 31 + k).cast("string")) for k in range(12)])).alias("text"))
    marked = simhash.materialize(simhash.fingerprints(docs))
    got = marked.join(simhash.fingerprint_groups(marked), "fp")
    assert got.where("doc_id % 3 = 0 and component_id <> 0").count() == 0
    assert got.where("component_id = 0").count() >= 300 and got.count() == 900


def test_odd_rows(spark, odd_docs, no_docs):
    marked = simhash.materialize(simhash.fingerprints(odd_docs))
    got = marked.join(simhash.fingerprint_groups(marked), "fp").collect()
    assert len(got) == odd_docs.count()
    blank = {r["component_id"] for r in got if r["fp"] == 0}
    assert blank == {1}  # empty, blank and NULL texts, with and without an id
    kept = simhash.drop_near_copies(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == [1, 4, 6, 6, 7] and ids.count(None) == 1  # id 6 has two unrelated texts
    assert simhash.drop_near_copies(no_docs).count() == 0


def test_one_row_of_each_group_where_ids_repeat(spark):
    texts = {n: " ".join(f"{n}{i}" for i in range(12)) for n in "abcd"}
    docs = spark.createDataFrame([(3, texts["a"]), (5, texts["a"]), (5, texts["b"]), (6, texts["c"]), (6, texts["d"]), (7, texts["d"]), (6, texts["d"])],
                                 "doc_id long, text string")
    kept = sorted(tuple(r) for r in simhash.drop_near_copies(docs).collect())
    assert kept == [(3, texts["a"]), (5, texts["b"]), (6, texts["c"]), (6, texts["d"])]
