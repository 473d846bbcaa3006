"""Token counts by a compiled finite-state transducer.

The tokenizer of a BPE file with an end-of-word mark is compiled into two deterministic transducers whose transitions
carry the number of tokens they emit; no token list is ever made.

* The *splitter* reads character classes and cuts the text into words (letter runs, single digits, other runs and the
  seven English contractions). Texts are cut into chunks of equal length; for every chunk the map from each possible
  state at its start to the state at its end is computed (all chunks in step), the maps are composed by a parallel
  prefix scan, and the states inside the chunks follow.
* The *merger* reads the bytes of a word. After a prefix its state is what later bytes can depend on: the longest
  suffix that begins some vocabulary token, and for every position in it the last token of the prefix that ends there,
  with its token count relative to the state's. A byte moves to the next state and emits the change of the count,
  which may be negative when a longer token swallows earlier ones; the last byte of a word has transitions of its own.
  Two adjacent tokens are possible only if merging their bytes alone gives back just these two, which is all a state
  needs to know. Transitions are compiled when first read and kept in tables; words of a batch walk in step.

Scale: texts are only scanned (``mapInArrow``, no shuffle), the vocabulary (bounded by the tokenizer file) is
broadcast, tables are dropped and compiled anew above ``MAX_STATES`` states, so memory is bounded.

Edge cases: a null text is empty (0 bytes, 0 tokens). Special strings inside a text count one token each, as the library
counts them by default. Every row is counted by itself, repeated rows alike. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import json
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prelaunch.llm.words import small_batches, span_hash

LIMIT = 2048
CHUNK = 256
SLICE_CHARS = 2 << 20
MAX_STATES = 120_000
MAX_WORDS = 1 << 20           # counted words that are kept from slice to slice

# Character classes. T: s t m d, which end a contraction at once; E, R, V, LL: the letters of 're 've 'll.
SPACE, NUMBER, OTHER, APOS, T, E, R, V, LL, LETTER = range(10)
# States of the splitter: between words, in letters, in other characters, after an apostrophe that begins a word,
# and after 'r, 'v, 'l that may become a contraction.
FREE, IN_LETTERS, IN_OTHER, AT_APOS, APOS_R, APOS_V, APOS_L = range(7)


def splitter() -> tuple[np.ndarray, np.ndarray]:
    """next[state, class] and begins[state, class] (a word begins at this character, unless a pending contraction is
    completed by the next one)."""
    step = np.zeros((7, 10), np.uint8)
    begins = np.zeros((7, 10), bool)
    letters = (T, E, R, V, LL, LETTER)
    for s in range(7):
        step[s, SPACE] = FREE
        step[s, NUMBER], begins[s, NUMBER] = FREE, True
        step[s, OTHER], begins[s, OTHER] = IN_OTHER, s not in (IN_OTHER, AT_APOS)
        in_run = s in (IN_OTHER, AT_APOS)
        step[s, APOS], begins[s, APOS] = (IN_OTHER if in_run else AT_APOS), not in_run
        for c in letters:
            step[s, c], begins[s, c] = IN_LETTERS, s not in (IN_LETTERS, APOS_R, APOS_V, APOS_L)
    step[AT_APOS, T], begins[AT_APOS, T] = FREE, False
    step[AT_APOS, R], step[AT_APOS, V], step[AT_APOS, LL] = APOS_R, APOS_V, APOS_L
    step[APOS_R, E] = step[APOS_V, E] = step[APOS_L, LL] = FREE
    return step, begins


@lru_cache(1)
def char_classes() -> np.ndarray:
    """Class of every code point, from Unicode's general categories."""
    import regex
    space = regex.compile(r"\s")
    kind = np.full(0x110000, OTHER, np.uint8)
    for i in range(0x110000):
        c = unicodedata.category(chr(i))
        if c[0] == "L":
            kind[i] = LETTER
        elif c[0] == "N":
            kind[i] = NUMBER
        elif c[0] in "ZC" and space.match(chr(i)):
            kind[i] = SPACE
    kind[ord("'")] = APOS
    for chars, k in (("stmd", T), ("e", E), ("r", R), ("v", V), ("l", LL)):
        for c in chars:
            kind[ord(c)] = k
    return kind


def chunk_states(kind: np.ndarray, chunk: int = CHUNK) -> np.ndarray:
    """State before each character: chunk state maps, their composition by a prefix scan, then the inner states."""
    step, _ = splitter()
    n = len(kind)
    rows = max(1, -(-n // chunk))
    grid = np.zeros(rows * chunk, np.uint8)
    grid[:n] = kind
    grid = np.ascontiguousarray(grid.reshape(rows, chunk).T)          # position in the chunk x chunk
    flat, width = step.ravel(), step.shape[1]
    maps = np.broadcast_to(np.arange(7, dtype=np.uint8)[:, None], (7, rows)).copy()
    for c in grid:
        maps = flat[maps * np.uint8(width) + c]
    maps = maps.T
    d = 1
    while d < rows:                                                   # maps[i] becomes the map of chunks 0..i
        later = np.take_along_axis(maps[d:], maps[:-d].astype(np.intp), 1)
        maps = np.concatenate([maps[:d], later])
        d *= 2
    state = np.zeros(rows, np.uint8)
    state[1:] = maps[:-1, FREE]
    before = np.empty((chunk, rows), np.uint8)
    for i, c in enumerate(grid):
        before[i] = state
        state = flat[state * np.uint8(width) + c]
    return before.T.ravel()[:n]


def word_spans(kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last-plus-one characters of the words of one normalised text (or texts joined by spaces)."""
    n = len(kind)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    _, begins = splitter()
    before = chunk_states(kind)
    begin = begins[before, kind]
    # r, v, l after an apostrophe begin a word unless the next character completes the contraction
    nxt = np.append(kind[1:], SPACE)
    pending = (before == AT_APOS) & (((kind == R) | (kind == V)) & (nxt == E) | (kind == LL) & (nxt == LL))
    begin &= ~pending
    # a character after a completed contraction begins a word by the FREE state's own rule
    starts = np.flatnonzero(begin)
    stop = np.flatnonzero(begin | (kind == SPACE))
    stop = np.append(stop, n)
    return starts, stop[np.searchsorted(stop, starts, "right")]


class Merger:
    """The lazily compiled transducer of a BPE vocabulary with an end-of-word mark."""

    def __init__(self, spec: dict):
        model = spec["model"]
        mark = model["end_of_word_suffix"]
        chars = byte_chars()
        vocab = model["vocab"]
        back = {c: b for b, c in enumerate(chars)}
        self.inner = [vocab[c] for c in chars]
        self.final = [vocab[c + mark] for c in chars]
        self.merges = {}
        made = {}
        for rank, m in enumerate(model["merges"]):
            a, b = m if isinstance(m, list) else m.split(" ")
            ab = a + b
            if a in vocab and b in vocab and ab in vocab:
                self.merges.setdefault((vocab[a], vocab[b]), (rank, vocab[ab]))
                made[ab] = vocab[ab]
        # token -> its initial symbols; the last symbol of a token with the mark is a final one
        self.symbols: dict[int, tuple[int, ...]] = {}
        for token, i in vocab.items():
            ends = token.endswith(mark) and len(token) > len(mark)
            body = token[: -len(mark)] if ends else token
            if body and all(c in back for c in body):
                s = [self.inner[back[c]] for c in body]
                if ends:
                    s[-1] = self.final[back[body[-1]]]
                self.symbols[i] = tuple(s)
        self.tokens = {}
        for i, s in self.symbols.items():
            if self.merge(s) == [i]:                                  # others can never be the result of merging
                self.tokens[s] = i
        self.prefixes = {s[:k] for s in self.tokens for k in range(1, len(s))}
        self.compatible_cache: dict[tuple[int, int], bool] = {}
        self.reset()

    def reset(self) -> None:
        self.states: list[tuple] = []
        self.number: dict[tuple, int] = {}
        self._tables(1024, 32)
        self.column = np.full(256, -1, np.int32)                      # bytes get columns as they are first read
        self.bytes: list[int] = []
        self.state_of(((), (-1,), (0,)))

    def _tables(self, states: int, width: int) -> None:
        """Empty transition tables; what is already there moves into them."""
        old = (self.next, self.out, self.last) if getattr(self, "states", None) else ()
        self.next = np.full((states, width), -1, np.int32)
        self.out = np.zeros((states, width), np.int8)
        self.last = np.full((states, width), -128, np.int8)
        for a, b in zip(old, (self.next, self.out, self.last)):
            b[: a.shape[0], : a.shape[1]] = a

    def columns(self, raw: np.ndarray) -> np.ndarray:
        """The table column of each byte."""
        for b in np.flatnonzero(np.bincount(raw, minlength=256)).tolist():
            if self.column[b] < 0:
                self.column[b] = len(self.bytes)
                self.bytes.append(b)
        if len(self.bytes) > self.next.shape[1]:
            self._tables(len(self.next), min(256, len(self.bytes) + 32))
        return self.column[raw]

    def merge(self, symbols) -> list[int]:
        """Plain merging by rank of a few symbols."""
        s = list(symbols)
        while len(s) > 1:
            best, rank = -1, None
            for i in range(len(s) - 1):
                m = self.merges.get((s[i], s[i + 1]))
                if m and (rank is None or m[0] < rank):
                    best, rank = i, m[0]
            if best < 0:
                break
            s[best: best + 2] = [self.merges[s[best], s[best + 1]][1]]
        return s

    def compatible(self, a: int, b: int) -> bool:
        if a < 0:
            return True
        known = self.compatible_cache.get((a, b))
        if known is None:
            if len(self.compatible_cache) > 500_000:
                self.compatible_cache.clear()
            known = self.compatible_cache[a, b] = self.merge(self.symbols[a] + self.symbols[b]) == [a, b]
        return known

    def state_of(self, key: tuple) -> int:
        i = self.number.get(key)
        if i is None:
            i = self.number[key] = len(self.states)
            self.states.append(key)
            if i == len(self.next):
                self._tables(2 * i, self.next.shape[1])
        return i

    def _read(self, key: tuple, symbol: int) -> tuple[int, int, tuple[int, ...]]:
        """Last token and token count (relative to the state's) after one more symbol."""
        suffix, lasts, counts = key
        for k in range(len(suffix) + 1):                              # longest candidate first
            s = suffix[k:] + (symbol,)
            t = self.tokens.get(s) if lasts[k] is not None else None
            if t is not None and self.compatible(lasts[k], t):
                return t, counts[k] + 1, suffix + (symbol,)
        raise AssertionError("a single symbol is always a token")

    def compile_inner(self, state: int, column: int) -> None:
        key = self.states[state]
        token, count, suffix = self._read(key, self.inner[self.bytes[column]])
        lasts, counts = (*key[1], token), (*key[2], count)
        k = 0
        while k < len(suffix) and suffix[k:] not in self.prefixes:
            k += 1
        suffix, lasts, counts = suffix[k:], list(lasts[k:]), [c - count for c in counts[k:]]
        for j in range(1, len(suffix)):
            if suffix[j:] not in self.prefixes:                       # no token can begin here any more
                lasts[j], counts[j] = None, 0
        new = (suffix, tuple(lasts), tuple(counts))
        to = self.state_of(new)
        self.next[state, column] = to
        self.out[state, column] = count

    def compile_last(self, state: int, column: int) -> None:
        self.last[state, column] = self._read(self.states[state], self.final[self.bytes[column]])[1]

    def count(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Tokens of the byte spans; all spans take their i-th byte together."""
        if len(self.states) > MAX_STATES:
            self.reset()
        raw = self.columns(raw)
        length = ends - starts
        order = np.argsort(-length, kind="stable")
        at, size = starts[order], length[order]
        state = np.zeros(len(at), np.int32)
        total = np.zeros(len(at), np.int64)
        alive = len(at)
        i = 0
        while alive:
            alive = int(np.searchsorted(-size, -i, "left"))           # words with more than i bytes
            if not alive:
                break
            byte = raw[at[:alive] + i]
            cut = int(np.searchsorted(-size[:alive], -(i + 1), "left"))  # these go on after this byte
            s = state[cut:alive]
            got = self.last[s, byte[cut:]]
            if (got == -128).any():
                self._compile(s, byte[cut:], got == -128, self.compile_last)
                got = self.last[s, byte[cut:]]
            total[cut:alive] += got
            s, b = state[:cut], byte[:cut]
            new = self.next[s, b]
            if (new < 0).any():
                self._compile(s, b, new < 0, self.compile_inner)
                new = self.next[s, b]
            total[:cut] += self.out[s, b]
            state[:cut] = new
            i += 1
        out = np.empty(len(at), np.int64)
        out[order] = total
        return out

    def _compile(self, state, byte, missing, how) -> None:
        for x in np.unique(state[missing].astype(np.int64) * 256 + byte[missing]).tolist():
            how(x >> 8, x & 255)


def byte_chars() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies: printable Latin-1 stands for
    itself, the rest take the code points from 256 on, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


def check_spec(spec: dict) -> None:
    """Only files whose steps this compiler covers are accepted."""
    steps = [n["type"] for n in spec["normalizer"]["normalizers"]]
    cuts = [p["type"] for p in spec["pre_tokenizer"]["pretokenizers"]]
    if steps != ["NFC", "Replace", "Lowercase"] or cuts != ["Split", "ByteLevel"] or not spec["model"].get("end_of_word_suffix"):
        raise ValueError("unsupported tokenizer file: NFC, white space and lower case, then word splitting and byte-level BPE with word ends is compiled")


def normalise(text: str) -> str:
    """NFC, then lower case letter by letter (no final-sigma rule)."""
    if text.isascii():
        return text.lower()
    return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()


class Counter:
    """Counts the tokens of texts."""

    def __init__(self, spec: dict):
        check_spec(spec)
        self.merger = Merger(spec)
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.words = np.zeros(0, np.uint64)                           # sorted hashes of counted words
        self.tokens = np.zeros(0, np.int32)

    def counts(self, texts: list[str]) -> np.ndarray:
        out = np.zeros(len(texts), np.int64)
        parts, sizes, first, room = [], [], 0, 0
        for i, t in enumerate(texts):
            for s in self.special:
                if s in t:
                    out[i] += t.count(s)
                    t = t.replace(s, "\n")
            t = normalise(t)
            parts.append(t)
            sizes.append(len(t) + 1)
            room += len(t) + 1
            if room >= SLICE_CHARS or i + 1 == len(texts):
                out[first: i + 1] += self._slice(parts, sizes)
                parts, sizes, first, room = [], [], i + 1, 0
        return out

    def _slice(self, parts: list[str], sizes: list[int]) -> np.ndarray:
        joined = "\n".join(parts) + "\n"
        code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        starts, ends = word_spans(char_classes()[code])
        raw = np.frombuffer(joined.encode("utf-8", "surrogatepass"), np.uint8)
        if len(raw) != len(code):
            at = np.zeros(len(code) + 1, np.int64)
            np.cumsum(1 + (code > 0x7F).astype(np.int8) + (code > 0x7FF) + (code > 0xFFFF), out=at[1:])
        else:
            at = np.arange(len(code) + 1)
        if not len(starts):
            return np.zeros(len(parts), np.int64)
        row = np.searchsorted(np.cumsum(sizes), starts, "right")
        s, e = at[starts], at[ends]
        words, some, back = np.unique(span_hash(raw, s, e), return_index=True, return_inverse=True)
        tokens = self._walk(words, raw, s[some], e[some])[back]
        return np.bincount(row, tokens, minlength=len(parts)).astype(np.int64)

    def _walk(self, words: np.ndarray, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Token counts of distinct words (sorted hashes); each new word walks through the merger once."""
        out = np.zeros(len(words), np.int64)
        at = np.searchsorted(self.words, words)
        known = np.zeros(len(words), bool)
        inside = at < len(self.words)
        known[inside] = self.words[at[inside]] == words[inside]
        out[known] = self.tokens[at[known]]
        new = ~known
        if new.any():
            out[new] = self.merger.count(raw, starts[new], ends[new])
            if len(self.words) + int(new.sum()) > MAX_WORDS:
                self.words, self.tokens = words, out.astype(np.int32)
            else:
                self.words = np.insert(self.words, at[new], words[new])
                self.tokens = np.insert(self.tokens, at[new], out[new].astype(np.int32))
        return out


def count_tokens(docs: DataFrame, tokenizer_file: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens, over_limit of every row of ``docs`` (doc_id, text)."""
    with open(tokenizer_file, encoding="utf-8") as f:
        spec = json.load(f)
    check_spec(spec)
    shared = docs.sparkSession.sparkContext.broadcast(spec)

    def run(batches):
        counter = Counter(shared.value)
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), pa.array(counter.counts(texts))],
                                             ["doc_id", "n_bytes", "n_tokens"])

    read = docs.select("doc_id", "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    counted = small_batches(read).mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`count_tokens` over all documents with the word-end BPE file."""
    import public_tokenizers
    return count_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("word_bpe_49k.json"))
