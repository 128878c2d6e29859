import hashlib
import json
import random

import pytest
from tokenizers import Tokenizer

from recsmith.llm import bpe, token_counts


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(bpe.default_tokenizer_path())


@pytest.fixture(scope="module")
def codec():
    return bpe.codec(bpe.read_tokenizer())


PIECES = ["a", "b", " ", "  ", "\n", "\t", "aa", "the", "é", "中", "1", "23", "'s", "'ll", ".", "...", "<|endoftext|>", "՘",
          "\x1c", "\x85", " ", "😀", "ñ", "ing", "-", "--", "=", "A", "꟎", "\r\n", "\x00"]


def test_every_word_as_the_library(codec, library):
    random.seed(4)
    texts = ["".join(random.choices(PIECES, k=random.randint(0, 14))) for _ in range(6000)]
    texts += ["".join(chr(random.choice([random.randint(0, 127), random.randint(0, 0x2FF), random.randint(0, 0xD7FF)]))
                      for _ in range(random.randint(0, 12))) for _ in range(3000)]
    texts += ["a" * 20000 + "ab" * 3000 + "-" * 4000, " " * 500, "\n" * 70]
    for text in texts:
        ids = library.encode(text, add_special_tokens=False).ids
        assert codec.encode(text) == ids, text
        assert codec.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_automaton_accepts_only_what_bpe_makes(codec, library):
    """Arcs between tokens against the library: u is followed by v just when uv encodes to u, v."""
    auto = codec.automaton
    random.seed(5)
    plain = [i for i, b in auto.label.items() if b.isalpha() and b.isascii()]
    for _ in range(4000):
        u, v = random.choice(plain), random.choice(plain)
        ids = library.encode((auto.label[u] + auto.label[v]).decode(), add_special_tokens=False).ids
        assert auto.follows(u, v) == (ids == [u, v])


def test_gadgets_on_a_small_alphabet():
    chars = {b: c for c, b in bpe.byte_characters().items()}
    vocab = {c: b for b, c in chars.items()}
    for t in ("aa", "aab", "ab", "ba"):
        vocab[t] = len(vocab)
    auto = bpe.Automaton(vocab, ["a a", "aa b", "a b", "b a"])
    name = {i: t for t, i in vocab.items()}
    assert [name[i] for i in auto.encode(b"aaab")] == ["aa", "ab"]
    assert [name[i] for i in auto.encode(b"aaaab")] == ["aa", "aab"]
    assert [name[i] for i in auto.encode(b"bab")] == ["b", "ab"]
    assert not auto.follows(vocab["a"], vocab["aa"]) and auto.follows(vocab["aa"], vocab["aa"])
    with pytest.raises(ValueError):
        bpe.Automaton(vocab, ["a a", "a a"])


def test_documents(spark, small, library):
    got = {r["doc_id"]: r for r in bpe.op8_bpe(spark, small).collect()}
    docs = spark.read.parquet(f"{small}/documents.parquet").collect()
    assert len(got) == len(docs)
    for r in docs:
        ids = library.encode(r["text"], add_special_tokens=False).ids
        g = got[r["doc_id"]]
        assert g["n_tokens"] == len(ids)
        assert g["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert g["decoded_sha256"] == hashlib.sha256(r["text"].encode()).hexdigest()


def test_odd_rows(spark, odd_docs, no_docs):
    got = bpe.encode_documents(odd_docs, with_ids=True).collect()
    empty = hashlib.sha256(b"").hexdigest()
    assert len(got) == odd_docs.count()
    assert all((r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (0, empty, empty) for r in got if not r["ids"])
    assert bpe.encode_documents(no_docs).count() == 0


def test_other_files_are_refused():
    conf = json.loads(bpe.read_tokenizer())
    conf["pre_tokenizer"]["add_prefix_space"] = True
    with pytest.raises(ValueError):
        bpe.Codec(json.dumps(conf))


def test_small_table_of_runs(monkeypatch, codec, library):
    monkeypatch.setattr(bpe, "CACHE_BYTES", 6 * bpe.ENTRY_BYTES)
    monkeypatch.setattr(codec, "runs", {})
    monkeypatch.setattr(codec, "older", {})
    monkeypatch.setattr(codec, "taken", 0)
    text = "the cat, the dog and the bird; the cat again and again."
    assert codec.encode(text) == library.encode(text, add_special_tokens=False).ids
    assert len(codec.runs) <= 3 and len(codec.older) <= 3


# ---- token counts ----------------------------------------------------------

def test_counts(spark, small, library):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    want = {r["doc_id"]: len(library.encode(r["text"], add_special_tokens=False).ids) for r in docs.collect()}
    got = token_counts.op2_token_counts(spark, small).collect()
    assert {r["doc_id"]: r["n_tokens"] for r in got} == want
    assert all(r["over_limit"] == (r["n_tokens"] > 512) for r in got)
    cut = token_counts.count_tokens(docs, chunk=700, overlap=60)
    assert {r["doc_id"]: r["n_tokens"] for r in cut.collect()} == want


def test_resynchronisation_and_widening(spark, library):
    random.seed(2)
    texts = ["a" * 5000, "x " * 4000, " " * 6000, ("ab" * 300 + " ") * 20, None, "", "<|endoftext|>" * 400, "q <|endoftext|> " * 300,
             ("w" * 37 + "<|endoftext|>") * 100, "中文字" * 1500, " \n\t" * 2000 + "z", "a\x00b" * 3000]
    texts += ["".join(random.choices(["a", " ", "  ", "\n", "bcd", "<|endoftext|>", "é", "12", "..."], k=2500)) for _ in range(8)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: (r["n_tokens"], r["n_bytes"]) for r in token_counts.count_tokens(df, chunk=256, overlap=40).collect()}
    assert got == {i: (len(library.encode(t or "", add_special_tokens=False).ids), len((t or "").encode())) for i, t in enumerate(texts)}


def test_small_table_of_counts(monkeypatch, library):
    monkeypatch.setattr(token_counts, "CACHE_RUNS", 8)
    c = token_counts.Counter(bpe.read_tokenizer())
    texts = ["the cat, the dog and the bird; the cat again and again.", "a bird", "the cat and a bird and one more dog", ""] * 3
    assert c.count(texts) == [len(library.encode(t, add_special_tokens=False).ids) for t in texts]


def test_counts_of_odd_rows(spark, odd_docs, no_docs):
    got = token_counts.count_tokens(odd_docs).collect()
    assert len(got) == odd_docs.count() and all(r["n_tokens"] is not None for r in got)
    assert token_counts.count_tokens(no_docs).count() == 0


def test_runs_met_once_leave_the_table_to_the_others():
    c = bpe.Codec(bpe.read_tokenizer())
    once = [f"q{i}x" for i in range(500)]
    first = c.parts(" ".join(once))
    assert len(c.runs) < 25  # hash marks may meet
    assert c.parts(" ".join(once)) == first and len(c.runs) > 400
    assert [i for p in first for i in p[0].split(",")] == list(map(str, c.encode(" ".join(once))))
