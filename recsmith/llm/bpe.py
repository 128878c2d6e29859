"""Byte-level BPE encoding and decoding by a tokenization automaton.

The automaton reads token labels: it accepts exactly the token sequences that BPE produces.  It starts with one state per
byte, where any byte may follow any other, and is built by one gadget per merge (a, b) -> c, in merge order:

1. a new state for c gets the outgoing arcs that b's state has now;
2. the arc from a's state to b is cut (BPE never leaves a before b any more);
3. every state with an arc labelled a gets an arc labelled c.

It is deterministic: a state and a label determine the next state.  Copying 50,000 rows and columns of arcs would
take gigabits, so a new state keeps a reference to the state and label it copies, with the merge's rank as the time of the
copy; an arc is read through these references and then kept in a table.

A word is encoded by walking its bytes through the table of labels (a trie) and taking the longest label that has an arc
from the current state.  The accepting path is unique, so a position from which the walk once failed is never tried again.
Decoding emits the labels' bytes.

Words are pre-split as the tokenizer file says (byte-level pattern): text is cut into runs of one optional space and
non-space characters, whose tokens do not depend on their neighbours, and each distinct run is encoded once per
worker and kept in a bounded table.

Defined cases: NULL is the empty text (no token; SHA-256 of the empty string); special strings inside a text are
special tokens, as the library does by default; ids and repeated rows pass through; an empty table gives an empty
result; further columns of the input are ignored.  A tokenizer file of another kind raises ValueError.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recsmith.llm.common import in_slices, read_table, worker_tables

# The byte-level pre-splitting pattern, and Unicode white space.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_WS = "\t-\r \x85\xa0  -     　"
#: Cuts where the pattern always cuts: a run of white space keeps its last character for what follows.
RUNS = re.compile(f"[{_WS}]+(?![^{_WS}])| ?[^{_WS}]+|[{_WS}]")
#: Below this character the regex module and the tokenizers library classify letters and numbers alike.
_AGREED = "ɐ"
#: Bytes a worker's table of runs may take; a generation that is full becomes the old one, whose entries return when met again.
CACHE_BYTES = 128 << 20
ENTRY_BYTES = 300  # of a run beside its characters: the dictionary's slot, a pair and three strings
#: Hash marks of runs met once: a run enters the table when it is met again, so the many that come once do not push others out.
MARKS = 1 << 22


def default_tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def read_tokenizer(path: str | None = None) -> str:
    with open(path or default_tokenizer_path(), encoding="utf-8") as f:
        return f.read()


def byte_characters() -> dict[str, int]:
    """The character that stands for each byte in byte-level files: itself if printable, else the next from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {chr(b): b for b in plain}
    rest = (b for b in range(256) if b not in set(plain))
    table.update((chr(256 + i), b) for i, b in enumerate(rest))
    return table


class Automaton:
    """Compiled merges: ``follows`` is the transition relation, ``encode`` and ``decode`` walk it."""

    def __init__(self, vocab: dict[str, int], merges: list):
        to_byte = byte_characters()
        raw = {t: bytes(to_byte[c] for c in t) for t in vocab}
        self.label: dict[int, bytes] = {i: raw[t] for t, i in vocab.items()}
        self.born: dict[int, int] = {vocab[t]: -1 for t, b in raw.items() if len(b) == 1}
        if len(self.born) != 256:
            raise ValueError("every byte needs a token")
        self.left: dict[int, int] = {}
        self.right: dict[int, int] = {}
        self.cut: dict[tuple[int, int], int] = {}
        for rank, m in enumerate(merges):
            a, b = m.split(" ") if isinstance(m, str) else m
            self._gadget(vocab[a], vocab[b], vocab[a + b], rank)
        self.arcs: dict[int, dict[int, bool]] = {i: {} for i in self.born}
        self.trie: dict = {}  # byte -> [the label's token or None, next node]
        for i in self.born:
            node = self.trie
            for byte in self.label[i]:
                step = node.setdefault(byte, [None, {}])
                node = step[1]
            step[0] = i
        self.longest = max(map(len, self.label.values()))
        self.size = {i: len(b) for i, b in self.label.items()}

    def _gadget(self, a: int, b: int, c: int, rank: int) -> None:
        if c in self.born or a not in self.born or b not in self.born:
            raise ValueError("each merge must make one new token of two that exist")
        self.born[c], self.left[c], self.right[c] = rank, a, b
        self.cut[a, b] = rank

    def follows(self, u: int, v: int) -> bool:
        """Has the state after u an arc labelled v?"""
        known = self.arcs[u].get(v)
        if known is None:
            known = self.arcs[u][v] = self._read_arc(u, v)
        return known

    def _read_arc(self, u: int, v: int) -> bool:
        born, now = self.born, len(self.cut)  # cuts of a rank below ``now`` have been made
        while True:
            if self.cut.get((u, v), now) < now:
                return False
            if born[v] >= born[u]:
                if born[v] < 0:
                    return True
                now, v = born[v] + 1, self.left[v]  # the arc was copied after the cut of its own merge
            else:
                now, u = born[u], self.right[u]  # the arcs out of u were copied before it

    def encode(self, word: bytes) -> list[int]:
        trie, arcs, n, longest, size = self.trie, self.arcs, len(word), self.longest, self.size
        out: list[int] = []
        ends = [0]
        untried: list[list[int]] = []  # by position of the path: labels not tried yet, longest last
        dead: set[int] = set()
        pos, fresh = 0, True
        while pos < n:
            if fresh:
                node, options = trie, []
                for byte in word[pos:pos + longest]:
                    if byte not in node:
                        break
                    token, node = node[byte]
                    if token is not None:
                        options.append(token)
                untried.append(options)
            else:
                options = untried[-1]
            state = arcs[out[-1]] if out else None
            while options:
                token = options.pop()
                end = pos + size[token]
                if end in dead:
                    continue
                if state is not None:
                    arc = state.get(token)
                    if arc is None:
                        arc = self.follows(out[-1], token)
                    if not arc:
                        continue
                out.append(token)
                ends.append(end)
                pos, fresh = end, True
                break
            else:
                if not out:
                    raise ValueError("no accepting path")
                dead.add(pos)
                out.pop(), ends.pop(), untried.pop()
                pos, fresh = ends[-1], False
        return out

    def decode(self, ids) -> bytes:
        return b"".join(map(self.label.__getitem__, ids))


class Codec:
    """A tokenizer file as an automaton with its pre-splitting and special strings."""

    def __init__(self, spec: str):
        conf = json.loads(spec)
        model, pre = conf["model"], conf.get("pre_tokenizer") or {}
        plain = {k: pre.get(k) for k in ("type", "add_prefix_space", "use_regex")}
        if (model["type"] != "BPE" or conf.get("normalizer") or model.get("ignore_merges")
                or plain != {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}):
            raise ValueError("only plain byte-level BPE files are read")
        self.special = {}
        for t in conf.get("added_tokens", []):
            if t["single_word"] or t["lstrip"] or t["rstrip"]:
                raise ValueError("special strings that take their surroundings along are not read")
            self.special[t["content"]] = t["id"]
        self.automaton = Automaton({t: i for t, i in model["vocab"].items() if t not in self.special}, model["merges"])
        self.automaton.label.update((i, s.encode("utf-8")) for s, i in self.special.items())
        self.cut_special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.words = regex.compile(PATTERN)
        self.spec, self.library = spec, None
        self.decimal = {i: str(i) for i in self.automaton.label}
        self.runs: dict[str, tuple[str, bytes]] = {}
        self.older: dict[str, tuple[str, bytes]] = {}
        self.taken = 0  # bytes of ``runs``
        self.met = bytearray(MARKS)

    def split(self, run: str) -> list[str]:
        """The words of one run."""
        if max(run) < _AGREED:
            body = run[1:] if run[0] == " " else run
            if body.isalpha():
                return [run]
            if body[-1:] in (".", ",") and body[:-1].isalpha():
                return [run[:-1], run[-1]]
            return self.words.findall(run)
        if self.library is None:
            from tokenizers import Tokenizer
            self.library = Tokenizer.from_str(self.spec).pre_tokenizer
        return [run[a:b] for _, (a, b) in self.library.pre_tokenize_str(run)]

    def _run(self, run: str) -> tuple[str, bytes]:
        """Of one run: its ids in decimal, joined by commas, and the labels its arcs emit."""
        known = self.older.get(run)
        enters = known is not None
        if known is None:
            words = self.split(run)
            if len(words) == 1:
                ids = self.automaton.encode(run.encode("utf-8"))
                known = ",".join(map(self.decimal.__getitem__, ids)), self.automaton.decode(ids)
            else:  # most runs of several words are a known word and its punctuation: a word alone is a run of one word
                parts = [self.runs.get(w) or self._run(w) for w in words]
                known = ",".join([p[0] for p in parts]), b"".join([p[1] for p in parts])
            mark = hash(run) & (MARKS - 1)
            enters = self.met[mark]
            self.met[mark] = 1
        if enters and len(run) <= 64:  # a longer run is rare and would only fill the table
            size = ENTRY_BYTES + 4 * len(known[1])
            if self.taken + size > CACHE_BYTES // 2:
                self.older, self.runs, self.taken, self.met = self.runs, {}, 0, bytearray(MARKS)
            self.runs[run] = known
            self.taken += size
        return known

    def parts(self, text: str) -> list[tuple[str, bytes]]:
        """The runs and special strings of a text in order, each as its ids in decimal and its labels."""
        known, run = self.runs.get, self._run
        if self.cut_special is None or not any(s in text for s in self.special):
            out = []
            for r in RUNS.findall(text):
                got = known(r)
                if got is None:
                    got = run(r)
                    known = self.runs.get  # the table may have been begun anew
                out.append(got)
            return out
        out = []
        for part in self.cut_special.split(text):
            if part in self.special:
                i = self.special[part]
                out.append((str(i), self.automaton.label[i]))
            elif part:
                out.extend(self.parts(part))
        return out

    def encode(self, text: str) -> list[int]:
        return [int(i) for p in self.parts(text) for i in p[0].split(",")]

    def decode(self, ids) -> str:
        return self.automaton.decode(ids).decode("utf-8", errors="replace")


def codec(spec: str) -> Codec:
    """The codec that this worker process keeps; one tokenizer file at a time."""
    kept = worker_tables("bpe")
    key = hashlib.sha1(spec.encode("utf-8")).hexdigest()
    if key not in kept:
        kept.clear()
        kept[key] = Codec(spec)
    return kept[key]


def _sha256(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def encode_documents(docs: DataFrame, path: str | None = None, with_ids: bool = False) -> DataFrame:
    """docs (doc_id, text, ..) -> doc_id, n_tokens, ids_sha256, decoded_sha256 (and the ids themselves, array<int>)."""
    spec = read_tokenizer(path)
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()),
                        ("decoded_sha256", pa.string())] + [("ids", pa.list_(pa.int32()))] * with_ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(spec)
        for b in in_slices(batches):
            rows: list[tuple] = []
            for text in b.column(1).to_pylist():
                parts = c.parts(text or "")
                ids = ",".join([p[0] for p in parts])
                labels = b"".join([p[1] for p in parts])  # labels cut inside a character decode as the whole does
                rows.append((ids.count(",") + 1 if ids else 0, _sha256(ids.encode()),
                             _sha256(labels.decode("utf-8", errors="replace").encode("utf-8")),
                             *[[int(i) for i in ids.split(",") if i]] * with_ids))
            cols = list(zip(*rows)) or [()] * (len(schema) - 1)
            yield pa.RecordBatch.from_arrays([b.column(0), *map(lambda v, f: pa.array(v, f.type), cols, list(schema)[1:])],
                                             schema=schema)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text")).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids)


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 for every document."""
    return encode_documents(read_table(spark, sf_dir, "documents"))
