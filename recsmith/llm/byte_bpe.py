"""Byte-level BPE from a rank file: vectorised pre-tokenisation, cached pair merging, decoding by retained offsets.

Words are found without a regular expression.  Every character becomes a sign (letter, digit, other, apostrophe before a
contraction, white space that joins, ends or goes on), each sign is a function on the eight states of a small
automaton, and functions compose: the functions that signs can make in sequence (15) are numbered once and their products
are kept in a table.  Composition is associative, so the state before every character comes from a scan over blocks
(all blocks step together, block results are scanned by doubling), whatever the text; a text's first character is a
constant function, so texts lie one after another in one array.  A sign and the state before it say whether a word begins there.

Word slices go to pair merging (always the pair of lowest rank, leftmost first; the new words of a window step
together), each distinct word once per worker while it is in a bounded table of two generations.  The offset of every slice is kept, so that each token has its byte position;
decoding places the bytes of all tokens at their positions at once, and any range of tokens can be decoded alone.

Texts are read in windows of ``WINDOW`` characters.  The state and the bytes of the open word carry over, so a text of any
length needs the memory of one window and of its longest word.

Defined cases: NULL is the empty text (no token; SHA-256 of nothing); there are no special tokens; ids and repeated rows pass
through; an empty table gives an empty result; further columns of the input are ignored.  A rank file without all single
bytes raises ValueError, an id without a token KeyError.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq
from array import array
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recsmith.llm.common import in_slices, read_table

WINDOW = 1 << 18  # characters read at a time
#: Bytes a worker's table of words may take; a generation that is full becomes the old one, whose entries return when met again.
CACHE_BYTES = 128 << 20
ENTRY_BYTES = 300  # of a word beside its characters and tokens
#: Hash marks of words met once: a word enters the table when another window has it too, so the many that come once do not push others out.
MARKS = 1 << 22
LONGEST_CACHED, LONGEST_SIMPLE = 64, 64

# What the pre-splitting pattern takes from an apostrophe as a word of its own.
ONE_LETTER, TWO_LETTERS = "stmd", ("re", "ve", "ll")


# ---- characters as signs ---------------------------------------------------

OTHER, LETTER, DIGIT, SPACE = range(4)


@functools.cache
def character_classes() -> np.ndarray:
    """The class of every code point, as the installed tokenizer library's own Unicode tables have it."""
    import tiktoken
    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    out = np.zeros(0x110000, np.uint8)
    bytes_only = {bytes([i]): i for i in range(256)}
    for pattern, kind in ((r"\p{L}", LETTER), (r"\p{N}", DIGIT), (r"\s", SPACE)):
        enc = tiktoken.Encoding("class", pat_str=pattern, mergeable_ranks=bytes_only, special_tokens={})
        matched = enc.decode_bytes(enc.encode_ordinary(every)).decode("utf-8")  # what does not match is left out
        out[np.frombuffer(matched.encode("utf-32-le"), "<u4")] = kind
    return out


# Signs.  An apostrophe that a contraction's one or two letters follow; a space right before a word, which joins it;
# other white space right before a word, a word of its own; white space with more of it (or the end) behind.
N_SIGNS = 8
S_LETTER, S_DIGIT, S_OTHER, S_ONE, S_TWO, S_JOIN, S_LAST, S_SPACE = range(N_SIGNS)
# States: nothing open; in a run of letters, digits, others; behind a joining space; in white space; one or two letters of
# a contraction to come.
FRESH, LETTERS, DIGITS, OTHERS, JOINED, SPACES, ONE, TWO = range(8)


def signs(codes: np.ndarray, n: int, first: np.ndarray) -> np.ndarray:
    """Signs of the first n codes; ``first`` are the positions where texts begin, codes behind n only show what follows."""
    kind = character_classes()[codes]
    begins = np.zeros(len(codes) + 2, bool)
    begins[first] = True
    begins[len(codes):] = True
    follows = np.concatenate([kind != SPACE, [False]])[1:] & ~begins[1:len(codes) + 1]  # a word of the same text is next
    out = np.array([S_OTHER, S_LETTER, S_DIGIT, S_SPACE], np.uint8)[kind]
    last = (kind == SPACE) & follows
    out[last] = np.where(codes[last] == 32, S_JOIN, S_LAST)
    quote = np.flatnonzero(codes[:n] == 39)
    if len(quote):
        padded = np.concatenate([codes, [0, 0]])
        one = np.where(begins[quote + 1], 0, padded[quote + 1])
        two = np.where(begins[quote + 1] | begins[np.minimum(quote + 2, len(begins) - 1)], 0, padded[quote + 2])
        out[quote[np.isin(one, [ord(c) for c in ONE_LETTER])]] = S_ONE
        pair = one.astype(np.int64) << 32 | two
        out[quote[np.isin(pair, [ord(a) << 32 | ord(b) for a, b in TWO_LETTERS])]] = S_TWO
    return out[:n]


# ---- the automaton and the scan --------------------------------------------

@functools.cache
def automaton() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(begins[sign, state], function of each sign, values[function, state], product[f, g] = f then g).

    Signs from N_SIGNS on are those of a text's first character, which any state reads as FRESH does."""
    goes = np.zeros((2 * N_SIGNS, 8), np.uint8)
    begins = np.ones((2 * N_SIGNS, 8), bool)
    runs = {S_LETTER: (LETTERS, (LETTERS, JOINED)), S_DIGIT: (DIGITS, (DIGITS, JOINED)), S_OTHER: (OTHERS, (OTHERS, JOINED)),
            S_ONE: (ONE, ()), S_TWO: (TWO, ()), S_JOIN: (JOINED, ()), S_LAST: (FRESH, ()), S_SPACE: (SPACES, (SPACES,))}
    for sign, (to, goes_on) in runs.items():
        goes[sign] = to
        begins[sign, list(goes_on)] = False
    for sign in (S_ONE, S_TWO):  # inside a run of others an apostrophe is one of them
        goes[sign, [OTHERS, JOINED]] = OTHERS
        begins[sign, [OTHERS, JOINED]] = False
    goes[S_LETTER, ONE], goes[S_LETTER, TWO] = FRESH, ONE
    begins[S_LETTER, [ONE, TWO]] = False
    goes[N_SIGNS:] = goes[:N_SIGNS, FRESH:FRESH + 1]
    identity = tuple(range(8))
    made = {identity: 0}
    todo = [identity]
    while todo:  # every function that a sequence of signs makes
        f = todo.pop()
        for g in goes:
            h = tuple(int(g[s]) for s in f)
            if h not in made:
                made[h] = len(made)
                todo.append(h)
    values = np.array(sorted(made, key=made.get), np.uint8)
    product = np.array([[made[tuple(int(g[s]) for s in f)] for g in values] for f in values], np.uint16)
    return begins, np.array([made[tuple(map(int, g))] for g in goes], np.uint16), values, product


def states_before(functions: np.ndarray, state: int) -> tuple[np.ndarray, int]:
    """The state before each function is applied, from ``state`` on, and the state after all: an associative scan."""
    _, _, values, product = automaton()
    n = len(functions)
    if not n:
        return np.zeros(0, np.uint8), state
    steps = max(1, int(np.sqrt(n)))
    blocks = -(-n // steps)
    lanes = np.zeros((blocks, steps), np.uint16)  # 0 is the identity
    lanes.ravel()[:n] = functions
    lanes = np.ascontiguousarray(lanes.T)
    for t in range(1, steps):
        lanes[t] = product[lanes[t - 1], lanes[t]]
    whole, gap = lanes[-1].copy(), 1
    while gap < blocks:
        whole[gap:] = product[whole[:-gap], whole[gap:]]
        gap *= 2
    after = values[whole, state]
    entry = np.concatenate([[state], after[:-1]]).astype(np.uint8)
    inside = values[lanes[:-1], entry[None, :]] if steps > 1 else np.zeros((0, blocks), np.uint8)
    return np.concatenate([entry[None, :], inside]).T.reshape(-1)[:n], int(after[-1])


def word_starts(codes: np.ndarray, n: int, first: np.ndarray, state: int = FRESH) -> tuple[np.ndarray, int]:
    """Positions among the first n codes where words begin, and the state behind them."""
    begins, function, _, _ = automaton()
    sign = signs(codes, n, first)
    sign[first] += N_SIGNS
    before, state = states_before(function[sign], state)
    return np.flatnonzero(begins[sign, before]), state


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), "<u4")


# ---- pair merging and decoding ---------------------------------------------

def read_ranks(path: str | None = None) -> str:
    if path is None:
        import public_tokenizers
        path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    with open(path, encoding="ascii") as f:
        return f.read()


_NEVER = 1 << 60


class Codec:
    """A rank file with the table of words met before."""

    def __init__(self, spec: str):
        self.ranks = {base64.b64decode(t): int(r) for t, r in (line.split() for line in spec.splitlines() if line.strip())}
        if any(bytes([b]) not in self.ranks for b in range(256)):
            raise ValueError("every byte needs a token")
        size = max(self.ranks.values()) + 1
        self.length = np.zeros(size, np.int64)  # 0 where an id has no token
        self.begin = np.zeros(size, np.int64)
        labels = []
        at = 0
        for token, rank in self.ranks.items():
            self.length[rank], self.begin[rank] = len(token), at
            labels.append(token)
            at += len(token)
        self.labels = np.frombuffer(b"".join(labels), np.uint8)
        self.of_byte = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        # every pair of tokens whose bytes together are a token
        ranks = self.ranks
        pairs = {(ranks[t[:i]] * size + ranks[t[i:]]): r for t, r in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks}
        self.pair_keys = np.array(sorted(pairs), np.int64)
        self.pair_values = np.array([pairs[k] for k in self.pair_keys.tolist()], np.int64)
        self.words: dict[bytes, tuple[str, bytes]] = {}
        self.older: dict[bytes, tuple[str, bytes]] = {}
        self.taken = 0
        self.met = bytearray(MARKS)

    def _pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * len(self.length) + right
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_values[at], _NEVER)

    def merge(self, words: list[bytes]) -> list[list[int]]:
        """The tokens of many words: in each the adjacent pair of lowest rank is joined, leftmost first, until no pair is a token.

        All words take a step at a time, in one array of tokens; finished words leave it."""
        out: list[list[int]] = [[self.ranks[w]] if w in self.ranks else self._merge_long(w) if len(w) > LONGEST_SIMPLE else [] for w in words]
        todo = [i for i, ids in enumerate(out) if not ids]
        if not todo:
            return out
        ids = self.of_byte[np.frombuffer(b"".join([words[i] for i in todo]), np.uint8)]
        word = np.repeat(np.array(todo), [len(words[i]) for i in todo])
        rank = np.full(len(ids), _NEVER)  # of the pair that begins at a token
        rank[:-1] = np.where(word[1:] == word[:-1], self._pair_ranks(ids[:-1], ids[1:]), _NEVER)
        done = []
        while len(ids):
            begin = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            low = np.repeat(np.minimum.reduceat(rank, begin), np.diff(np.append(begin, len(ids))))
            is_open = low < _NEVER
            if not is_open.all():
                done.append((word[~is_open], ids[~is_open]))
                word, ids, rank, low = word[is_open], ids[is_open], rank[is_open], low[is_open]
            at = np.flatnonzero(rank == low)
            at = at[np.concatenate([[True], word[at[1:]] != word[at[:-1]]])[:len(at)]]  # the leftmost in each word
            ids[at] = rank[at]
            keep = np.ones(len(ids), bool)
            keep[at + 1] = False
            word, ids, rank = word[keep], ids[keep], rank[keep]
            at = at - np.arange(len(at))
            touched = np.concatenate([at, at[at > 0] - 1])
            rank[touched] = _NEVER
            touched = touched[touched + 1 < len(ids)]
            touched = touched[word[touched] == word[touched + 1]]
            rank[touched] = self._pair_ranks(ids[touched], ids[touched + 1])
        word, ids = (np.concatenate(x) for x in zip(*done))
        order = np.argsort(word, kind="stable")
        word, ids = word[order], ids[order]
        ends = np.searchsorted(word, todo, "right").tolist()
        flat, at = ids.tolist(), 0
        for i, end in zip(todo, ends):
            out[i] = flat[at:end]
            at = end
        return out

    def _merge_long(self, word: bytes) -> list[int]:
        """The same for one word by a heap of (rank, position), about n log n steps."""
        ranks, n = self.ranks, len(word)
        after, before = array("q", range(1, n + 1)), array("q", range(-1, n - 1))  # neighbours of the token that begins at i
        rank = array("q", [ranks.get(word[i:i + 2], _NEVER) for i in range(n - 1)] + [_NEVER])  # of the pair that begins at i
        heap = [(r << 40) + i for i, r in enumerate(rank) if r != _NEVER]
        heapq.heapify(heap)
        low = (1 << 40) - 1

        def again(i: int) -> None:
            j = after[i]
            rank[i] = ranks.get(word[i:after[j]], _NEVER) if j < n else _NEVER
            if rank[i] != _NEVER:
                heapq.heappush(heap, (rank[i] << 40) + i)

        while heap:
            top = heapq.heappop(heap)
            i = top & low
            if rank[i] != top >> 40:
                continue  # the pair has changed since
            j = after[i]
            after[i], rank[j] = after[j], _NEVER
            if after[i] < n:
                before[after[i]] = i
            again(i)
            if before[i] >= 0:
                again(before[i])
        out, i = [], 0
        while i < n:
            out.append(ranks[word[i:after[i]]])
            i = after[i]
        return out

    def _found(self, words: list[bytes]) -> list[tuple[str, bytes]]:
        """The ids of each word, in decimal and packed."""
        found = list(map(self.words.get, words))
        gaps = [i for i, f in enumerate(found) if f is None]
        if gaps:
            missing = list({words[i] for i in gaps})
            known = {w: self.older[w] for w in missing if w in self.older}
            new = [w for w in missing if w not in known]
            known.update((w, (",".join(map(str, ids)), array("i", ids).tobytes())) for w, ids in zip(new, self.merge(new)))
            for i in gaps:
                found[i] = known[words[i]]
            for w, f in known.items():
                mark = hash(w) & (MARKS - 1)
                if len(w) <= LONGEST_CACHED and (self.met[mark] or w in self.older):
                    size = ENTRY_BYTES + 2 * len(w) + 2 * len(f[1])
                    if self.taken + size > CACHE_BYTES // 2:
                        self.older, self.words, self.taken, self.met = self.words, {}, 0, bytearray(MARKS)
                    self.words[w] = f
                    self.taken += size
                else:
                    self.met[mark] = 1
        return found

    def encode(self, texts: list[str | None]) -> Iterator[tuple[int, bool, Sequence[str], np.ndarray, np.ndarray, int]]:
        """(text, is its last part, ids in decimal by word, ids, byte position of each in the part, bytes of the part)."""
        state, pending = FRESH, b""
        for window in _windows(texts):
            flat = "".join([texts[d][a:b] for d, a, b in window if b > a])
            d, _, end = window[-1]
            open_text = end < len(texts[d] or "")
            codes = _codes(flat + texts[d][end:end + 2] if open_text else flat)
            sizes = np.array([b - a for _, a, b in window])
            at = np.cumsum(sizes) - sizes  # of each part, in characters
            first = at[[a == 0 and b > a for _, a, b in window]]
            starts, state = word_starts(codes, len(flat), first, state)
            own = codes[:len(flat)]
            offset = np.zeros(len(flat) + 1, np.int64)
            np.cumsum(1 + (own >= 0x80) + (own >= 0x800) + (own >= 0x10000), out=offset[1:])
            stream = pending + flat.encode("utf-8")
            cuts = offset[starts] + len(pending)
            if pending:
                cuts = np.concatenate([[0], cuts])
            parts = np.concatenate([offset[at] + len(pending), [len(stream)]])
            parts[0] = 0
            if open_text:  # the last word may go on
                parts[-1] = cuts[-1]
                pending = stream[cuts[-1]:]
                cuts = cuts[:-1]
            else:
                pending, state = b"", FRESH
            ends = [*cuts[1:].tolist(), int(parts[-1])]
            words = [stream[a:b] for a, b in zip(cuts.tolist(), ends)]
            found = self._found(words)
            decimal, packed = zip(*found) if found else ((), ())
            ids = np.frombuffer(b"".join(packed), np.int32)
            tokens = np.fromiter(map(len, packed), np.int64, len(packed)) >> 2
            before = np.concatenate([[0], np.cumsum(tokens)])  # tokens before each word
            length = self.length[ids]
            run = np.cumsum(length) - length
            # each token's byte position: that of its word's slice and of the tokens before it in the word
            position = run + np.repeat(cuts - run[before[:-1]], tokens) if len(ids) else run
            of = np.searchsorted(cuts, parts, "left")
            for k, (d, _, b) in enumerate(window):
                lo, hi = of[k], of[k + 1]
                t0, t1 = before[lo], before[hi]
                yield (d, b == len(texts[d] or ""), decimal[lo:hi], ids[t0:t1], position[t0:t1] - parts[k],
                       int(parts[k + 1] - parts[k]))

    def decode(self, ids: np.ndarray, position: np.ndarray | None = None, size: int | None = None) -> bytes:
        """The bytes of tokens, each at its position (without positions, one after another)."""
        ids = np.asarray(ids, np.int64)
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.length) or not self.length[ids].all()):
            raise KeyError("an id without a token")
        length = self.length[ids]
        run = np.cumsum(length) - length
        if position is None:
            position = run
        total = int(length.sum())
        within = np.arange(total) - np.repeat(run, length)
        out = np.zeros(total if size is None else size, np.uint8)
        out[np.repeat(position, length) + within] = self.labels[np.repeat(self.begin[ids], length) + within]
        return out.tobytes()


def _windows(texts: list[str | None]) -> Iterator[list[tuple[int, int, int]]]:
    """Parts (text, from, to) of all texts in order, in lists of at most WINDOW characters (or empty texts) in sum."""
    window: list[tuple[int, int, int]] = []
    room = WINDOW
    for d, text in enumerate(texts):
        n, a = len(text or ""), 0
        while True:
            b = min(n, a + room)
            window.append((d, a, b))
            room -= b - a
            if room == 0:
                yield window
                window, room = [], WINDOW
            a = b
            if a == n:
                break
    if window:
        yield window


_codecs: dict[str, Codec] = {}  # of this worker process; one rank file at a time


def codec(spec: str) -> Codec:
    key = hashlib.sha1(spec.encode("ascii")).hexdigest()
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(spec)
    return _codecs[key]


# ---- on tables -------------------------------------------------------------

def encode_documents(docs: DataFrame, path: str | None = None, with_ids: bool = False) -> DataFrame:
    """docs (doc_id, text, ..) -> doc_id, n_tokens, ids_sha256, decoded_sha256 (and ids array<int>, offsets array<long>: the
    tokens and the byte of the text where each begins)."""
    spec = read_ranks(path)
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
                       + [("ids", pa.list_(pa.int32())), ("offsets", pa.list_(pa.int64()))] * with_ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(spec)
        for b in in_slices(batches):
            rows: list[tuple] = []
            n, size, of_ids, of_text, kept = 0, 0, hashlib.sha256(), hashlib.sha256(), []
            for _, last, words, ids, position, part in c.encode(b.column(1).to_pylist()):
                if len(ids):
                    of_ids.update(((b"," if n else b"") + ",".join(words).encode("ascii")))
                    of_text.update(c.decode(ids, position, part))
                if with_ids:
                    kept.append((ids, position + size))
                n, size = n + len(ids), size + part
                if last:
                    lists = tuple(np.concatenate(x) for x in zip(*kept)) if with_ids else ()
                    rows.append((n, of_ids.hexdigest(), of_text.hexdigest(), *lists))
                    n, size, of_ids, of_text, kept = 0, 0, hashlib.sha256(), hashlib.sha256(), []
            cols = list(zip(*rows)) or [()] * (len(schema) - 1)
            yield pa.RecordBatch.from_arrays([b.column(0), *map(lambda v, f: pa.array(v, f.type), cols, list(schema)[1:])], schema=schema)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text")).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>, offsets array<long>" * with_ids)


def decode_documents(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """encoded (doc_id, ids, ..) -> doc_id, text; NULL ids give a NULL text, bytes that are not UTF-8 U+FFFD."""
    spec = read_ranks(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(spec)
        for b in in_slices(batches):
            texts = [None if x is None else c.decode(np.array(x, np.int64)).decode("utf-8", errors="replace") for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(run, "doc_id long, text string")


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 for every document."""
    return encode_documents(read_table(spark, sf_dir, "documents"))
