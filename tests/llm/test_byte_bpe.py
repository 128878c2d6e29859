import base64
import hashlib
import random

import numpy as np
import pytest
import tiktoken

from recsmith.llm import byte_bpe


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in byte_bpe.read_ranks().splitlines())}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def codec():
    return byte_bpe.codec(byte_bpe.read_ranks())


PIECES = ["a", "b", " ", "  ", "\n", "\t", "s", "the", "é", "中", "1", "23", "'s", "'ll", "'", "''", "'r", "'re", "'v", "'t", "'S", ".", "...",
          "<|endoftext|>", "\x1c", "\x85", "　", "😀", "ñ", "ing", "-", "=", "\r\n", "\x00", "²", "٣", "́"]


def _encoded(codec, texts):
    got = [[] for _ in texts]
    where = [[] for _ in texts]
    size = [0] * len(texts)
    lasts = [0] * len(texts)
    for d, last, decimal, ids, position, part in codec.encode(texts):
        assert ",".join(decimal) == ",".join(map(str, ids))
        got[d] += ids.tolist()
        where[d] += (position + size[d]).tolist()
        size[d] += part
        lasts[d] += last
    assert lasts == [1] * len(texts)
    return got, where, size


def _texts(seed, n):
    rng = random.Random(seed)
    out = ["".join(rng.choices(PIECES, k=rng.randint(0, 14))) for _ in range(n)]
    return out + ["".join(chr(rng.choice([rng.randint(0, 127), rng.randint(0, 0x2FF), rng.randint(0, 0xD7FF), rng.randint(0xE000, 0x1FFFF)]))
                          for _ in range(rng.randint(0, 12))) for _ in range(n // 2)]


def test_as_the_library(codec, library):
    texts = _texts(3, 8000) + [None, "", "a" * 3000 + "ab" * 700 + "-" * 900, " " * 500, "\n" * 70 + "x", "don't we'll 'tis 's's''s x'rex"]
    got, where, size = _encoded(codec, texts)
    for text, ids, at, n in zip(texts, got, where, size):
        text = text or ""
        assert ids == library.encode_ordinary(text), text
        assert codec.decode(np.array(ids, np.int64)) == text.encode() and n == len(text.encode())
        lengths = [len(library.decode_single_token_bytes(i)) for i in ids]
        assert at == [sum(lengths[:k]) for k in range(len(ids))]


@pytest.mark.parametrize("window", [1, 2, 3, 7, 64])
def test_windows_carry_the_state(monkeypatch, codec, library, window):
    monkeypatch.setattr(byte_bpe, "WINDOW", window)
    texts = _texts(window, 300) + [None, "", "we'll" * 40, " " * 90, ("x" * 30 + "  ") * 9, "'re" * 20, " 're '"]
    got, _, _ = _encoded(codec, texts)
    assert got == [library.encode_ordinary(t or "") for t in texts]


def test_scan_equals_stepping():
    rng = np.random.default_rng(4)
    _, function, values, product = byte_bpe.automaton()
    assert len(product) == len(values) < 1 << 16
    for n in (0, 1, 2, 5, 63, 64, 1000):
        fs = function[rng.integers(0, len(function), n)]
        state, want = 2, []
        for f in fs:
            want.append(state)
            state = values[f][state]
        got, after = byte_bpe.states_before(fs, 2)
        assert got.tolist() == want and after == state
    # composition is associative
    a, b, c = (rng.integers(0, len(values), 500) for _ in range(3))
    assert (product[product[a, b], c] == product[a, product[b, c]]).all()


def test_word_boundaries_are_the_patterns():
    import public_tokenizers
    import regex
    pattern = regex.compile(public_tokenizers.PATTERN)
    for text in _texts(9, 3000):
        if all(ord(c) < 0x250 for c in text):  # where the regex module's Unicode tables agree with the library's
            starts, _ = byte_bpe.word_starts(byte_bpe._codes(text), len(text), np.zeros(min(1, len(text)), int))
            assert starts.tolist() == [m.start() for m in pattern.finditer(text)], text


def test_long_words_as_short_ones(codec):
    rng = random.Random(6)
    words = ["".join(rng.choices("abeinrst", k=rng.randint(2, 60))).encode() for _ in range(400)]
    words = [w for w in words if w not in codec.ranks]
    assert codec.merge(words) == [codec._merge_long(w) for w in words]
    assert codec.merge([]) == [] and codec.merge([b"a"]) == [[codec.ranks[b"a"]]]


def test_small_table_of_words(monkeypatch, codec, library):
    monkeypatch.setattr(byte_bpe, "CACHE_BYTES", 8 * byte_bpe.ENTRY_BYTES)
    for name, empty in (("words", {}), ("older", {}), ("taken", 0)):
        monkeypatch.setattr(codec, name, empty)
    text = "the cat, the dog and the bird; the cat again and again."
    assert _encoded(codec, [text])[0] == [library.encode_ordinary(text)]
    assert len(codec.words) <= 4 and len(codec.older) <= 4


def test_documents(spark, small, library):
    got = {r["doc_id"]: r for r in byte_bpe.op11_byte_bpe(spark, small).collect()}
    docs = spark.read.parquet(f"{small}/documents.parquet").collect()
    assert len(got) == len(docs)
    for r in docs:
        ids = library.encode_ordinary(r["text"])
        g = got[r["doc_id"]]
        assert g["n_tokens"] == len(ids)
        assert g["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert g["decoded_sha256"] == hashlib.sha256(r["text"].encode()).hexdigest()


def test_very_long_text(spark, library):
    rng = random.Random(1)
    text = "".join(rng.choices([*PIECES, "word ", " and", "\n\n"], k=400_000))
    df = spark.createDataFrame([(1, text), (2, "short"), (3, "x" * 300_000)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in byte_bpe.encode_documents(df, with_ids=True).collect()}
    assert got[1]["ids"] == library.encode_ordinary(text) and got[1]["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    assert got[3]["decoded_sha256"] == hashlib.sha256(b"x" * 300_000).hexdigest() and sum(b - a for a, b in zip(got[3]["offsets"], got[3]["offsets"][1:])) < 300_000
    back = {r["doc_id"]: r["text"] for r in byte_bpe.decode_documents(byte_bpe.encode_documents(df, with_ids=True)).collect()}
    assert back == {1: text, 2: "short", 3: "x" * 300_000}


def test_odd_rows(spark, odd_docs, no_docs):
    got = byte_bpe.encode_documents(odd_docs, with_ids=True).collect()
    empty = hashlib.sha256(b"").hexdigest()
    assert len(got) == odd_docs.count() and sum(not r["ids"] for r in got) == 3
    assert all((r["n_tokens"], r["ids_sha256"], r["decoded_sha256"], r["offsets"]) == (0, empty, empty, []) for r in got if not r["ids"])
    assert byte_bpe.encode_documents(no_docs).count() == 0 and byte_bpe.decode_documents(byte_bpe.encode_documents(no_docs, with_ids=True)).count() == 0


def test_what_is_refused(codec):
    with pytest.raises(ValueError):
        byte_bpe.Codec("YQ== 0\n")
    with pytest.raises(KeyError):
        codec.decode(np.array([10 ** 6]))


def test_words_met_once_leave_the_table_to_the_others():
    c = byte_bpe.Codec(byte_bpe.read_ranks())
    once = [f"q{i}x".encode() for i in range(500)]
    first = c._found(once)
    assert len(c.words) < 25  # hash marks may meet
    assert c._found(once) == first and len(c.words) > 400
