"""Byte-level BPE encoding and decoding by dynamic programming over prefixes.

The encoding of every prefix of a word has one last token, and a row of tokens is the
encoding of its text if and only if each neighbouring pair is (the pair encodes to
itself). So the last token of a prefix is the one vocabulary entry ending there that is
compatible with the last token of the prefix before it: a suffix automaton over the
vocabulary lists the entries ending at each place, longest first, and the chain of last
tokens, read from the end, gives the ids. No merge is ever replayed. Texts are split into
words, and at the strings of special tokens, as the tokenizer file says; a word's ids depend
on nothing outside it. The words of a batch go through the prefixes side by side, one byte
of all of them at a time.

On Spark it is one pass over the rows without a shuffle: a task holds one Arrow batch, the
automaton of the (fixed) vocabulary and a bounded table of recent words.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmart.llm.common import hand_back, worker_cache

CACHE_WORDS = 200_000
CACHE_PAIRS = 1 << 20              # places of remembered pairs; a new pair takes the place of an old one
LONG_WORD = 64                     # longer words (in bytes) are encoded one by one and not remembered
SLICE_CHARS = 1 << 20
NONE = 1 << 40                     # rank of a merge that is not in the file

#: The split pattern of byte-level tokenizer files, a fixed value of the format.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The same classes for texts of the characters below, where ``re`` is quicker than ``regex``.
PLAIN_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+"
NOT_PLAIN = r"[^\x00-\x1b\x20-\x7f\xc0-\xd6\xd8-\xf6\xf8-ɏ]"


def byte_alphabet() -> list[str]:
    """The character that stands for each byte in the file: printable Latin-1 characters for
    themselves, the others numbered from U+0100."""
    own = {b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255}
    spare = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


class Codec:
    """Encoder and decoder of one tokenizer file (byte-level BPE without a normalizer)."""

    def __init__(self, tokenizer_json: str):
        import regex
        spec = json.loads(tokenizer_json)
        model, pre = spec["model"], spec["pre_tokenizer"]
        if (model["type"] != "BPE" or spec["normalizer"] or pre["type"] != "ByteLevel" or not pre["use_regex"]
                or pre["add_prefix_space"] or model.get("ignore_merges") or model.get("dropout")):
            raise ValueError("only plain byte-level BPE files are read")
        vocab: dict[str, int] = model["vocab"]
        self.rank: dict[tuple[int, int], int] = {}
        self.halves: dict[int, tuple[int, int]] = {}
        for n, merge in enumerate(model["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            pair = vocab[a], vocab[b]
            if vocab[a + b] in self.halves:
                raise ValueError(f"two merges make the token {a + b!r}")
            self.rank[pair], self.halves[vocab[a + b]] = n, pair
        self.spines: dict[tuple[int, int], list[tuple[int, int]]] = {}
        alphabet = byte_alphabet()
        if any(c not in vocab for c in alphabet):
            raise ValueError("a byte has no token")
        back = {c: b for b, c in enumerate(alphabet)}
        self.tokens = {i: bytes(map(back.__getitem__, t)) for t, i in vocab.items()}
        self.whole: dict[bytes, int] = {}                 # filled with the automaton, which decoding does not need
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"]):
            raise ValueError("special tokens that take neighbouring text are not read")
        self.special = {s: i for s, i in added.items() if s}
        self.split = (re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")").split
                      if self.special else lambda text: [text])
        self.bytes = self.tokens | {i: s.encode() for s, i in self.special.items()}
        self.words, self.plain = regex.compile(WORDS).findall, re.compile(PLAIN_WORDS).findall
        self.not_plain = re.compile(NOT_PLAIN).search
        self.known: dict[str, bytes] = {}

    # ---- suffix automaton of the vocabulary -------------------------------------------------

    def _build_automaton(self) -> None:
        """States are the prefixes of entries; a state stands for the longest one that ends at a
        place. ``step[state, byte]`` is the next state, ``longest[state]`` the longest entry that
        ends there, ``shorter[token]`` the next longest entry that ends where a token does (-1:
        none) and ``size[token]`` its bytes."""
        # an entry that merging its own bytes never reaches is the last token of no prefix
        self.whole = {b: i for i, b in self.tokens.items()
                      if len(b) == 1 or (i in self.halves and self._compatible(*self.halves[i], joined=True))}
        self.pair_keys, self.pair_ok = np.full(CACHE_PAIRS, -1, np.int64), np.zeros(CACHE_PAIRS, bool)
        ends, children = [-1], [{}]                       # the token that a state is, and its longer states
        for text, token in self.whole.items():
            state = 0
            for byte in text:
                if byte not in children[state]:
                    children[state][byte] = len(ends)
                    ends.append(-1)
                    children.append({})
                state = children[state][byte]
            ends[state] = token
        self.step = np.zeros((len(ends), 256), np.int32)
        self.longest = np.full(len(ends), -1, np.int32)
        self.size, self.shorter = (np.full(1 + max(self.tokens), fill, np.int32) for fill in (0, -1))
        for text, token in self.whole.items():
            self.size[token] = len(text)
        suffix = [0] * len(ends)                          # the state of a state's longest proper suffix
        order = [0]
        for state in order:                               # breadth first: suffixes are done
            if state:
                self.step[state] = self.step[suffix[state]]
                self.longest[state] = below = self.longest[suffix[state]]
                if ends[state] >= 0:
                    self.longest[state], self.shorter[ends[state]] = ends[state], below
            for byte, child in children[state].items():
                suffix[child] = int(self.step[suffix[state], byte]) if state else 0
                order.append(child)
            for byte, child in children[state].items():
                self.step[state, byte] = child

    # ---- pair compatibility --------------------------------------------------------------

    def _spine(self, token: int, side: int) -> list[tuple[int, int]]:
        """(part, rank of the merge that takes it up) along the border on one side of a token,
        from its last byte (side 1) or its first (side 0) up to the whole token."""
        found = self.spines.get((token, side))
        if found is None:
            at, found = token, [(token, NONE)]
            while at in self.halves:
                pair = self.halves[at]
                at = pair[side]
                found.append((at, self.rank[pair]))
            found.reverse()
            self.spines[token, side] = found
        return found

    def _compatible(self, left: int, right: int, joined: bool = False) -> bool:
        """No merge crosses the border between two tokens while each is built from its bytes.
        Of equal ranks the merge further left goes first. ``joined``: the two whole tokens
        may merge with each other."""
        a, b = self._spine(left, 1), self._spine(right, 0)
        i = j = 0
        while True:
            (x, up_x), (y, up_y) = a[i], b[j]
            if up_x == NONE and up_y == NONE and joined:
                return True
            cross = self.rank.get((x, y), NONE)
            if cross < up_x and cross <= up_y and cross != NONE:
                return False
            if up_x == NONE and up_y == NONE:
                return True
            if up_x <= up_y:
                i += 1
            else:
                j += 1

    def compatible(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """``_compatible`` of pairs of tokens. Pairs recur, so they are remembered, each at one place."""
        key = left.astype(np.int64) << 32 | right
        mixed = (key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)
        place = mixed.astype(np.int64) % len(self.pair_keys)
        ok, new = self.pair_ok[place], np.flatnonzero(self.pair_keys[place] != key)
        if len(new):
            kinds, which = np.unique(key[new], return_inverse=True)
            found = np.array([self._compatible(k >> 32, k & 0xFFFFFFFF) for k in kinds.tolist()], bool)
            ok[new] = found[which]
            self.pair_keys[place[new]], self.pair_ok[place[new]] = key[new], ok[new]
        return ok

    # ---- encoding ----------------------------------------------------------------------------

    def encode_words(self, words: list[str]) -> list[bytes]:
        """The ids of each word as little-endian int32 bytes."""
        if not self.whole:
            self._build_automaton()
        texts = [w.encode("utf-8", "replace") for w in words]
        out: list[bytes] = [b""] * len(texts)
        short = []
        for k, t in enumerate(texts):
            token = self.whole.get(t)
            if token is not None:
                out[k] = token.to_bytes(4, "little")
            elif len(t) <= LONG_WORD:
                short.append(k)
            else:
                out[k] = self._encode_long(t)
        short.sort(key=lambda k: -len(texts[k]))
        for k, ids in zip(short, self._encode_short([texts[k] for k in short])):
            out[k] = ids
        return out

    def _encode_short(self, texts: list[bytes]) -> list[bytes]:
        """Words side by side, longest first: after byte n, ``last`` holds the last token of the
        prefix of n + 1 bytes of every word that is so long."""
        if not texts:
            return []
        lengths = np.array([len(t) for t in texts], np.int64)
        width = int(lengths[0])
        data = np.frombuffer(b"".join([t.ljust(width, b"\0") for t in texts]), np.uint8).reshape(len(texts), width)
        last, state = np.zeros((len(texts), width + 1), np.int32), np.zeros(len(texts), np.int32)
        for n in range(width):
            active = int(np.searchsorted(-lengths, -n, "left"))       # words longer than n
            state = self.step[state[:active], data[:active, n]]
            token = self.longest[state]
            open_ = np.arange(active)
            while len(open_):
                t = token[open_]
                at = n + 1 - self.size[t]
                inside = np.flatnonzero(at > 0)           # a token from the start on needs no partner
                ok = self.compatible(last[open_[inside], at[inside]], t[inside])
                open_ = open_[inside[~ok]]
                token[open_] = self.shorter[token[open_]]
            last[:active, n + 1] = token
        steps, who, at = [], np.arange(len(texts)), lengths.copy()
        while len(who):                                   # back from the end
            token = last[who, at[who]]
            steps.append((who, token))
            at[who] -= self.size[token]
            who = who[at[who] > 0]
        who, token = (np.concatenate(c) for c in zip(*steps))
        ids = token[np.lexsort((-np.arange(len(who)), who))].astype("<i4").tobytes()
        ends = (4 * np.cumsum(np.bincount(who, minlength=len(texts)))).tolist()
        return [ids[s:e] for s, e in zip([0, *ends], ends)]

    def _encode_long(self, text: bytes) -> bytes:
        """One word, byte by byte."""
        last, start, state, known = [-1], [0], 0, {}
        size, shorter, longest = self.size.tolist(), self.shorter.tolist(), self.longest
        for n, byte in enumerate(text):
            state = self.step[state, byte]
            token = int(longest[state])
            while True:
                at = n + 1 - size[token]
                if not at:
                    break
                pair = last[at], token
                if pair not in known:
                    known[pair] = self._compatible(*pair)
                if known[pair]:
                    break
                token = shorter[token]
            last.append(token)
            start.append(at)
        ids, at = [], len(text)
        while at:
            ids.append(last[at])
            at = start[at]
        return np.array(ids[::-1], "<i4").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian int32 bytes."""
        parts = [[(self.special.get(p), p) for p in self.split(t)] if self.special else [(None, t)] for t in texts]
        split = [[(i, None) if i is not None else (None, (self.words if self.not_plain(p) else self.plain)(p))
                  for i, p in row] for row in parts]
        if len(self.known) > CACHE_WORDS:
            self.known.clear()
        missing: set[str] = set()
        for row in split:
            for i, words in row:
                if i is None:
                    missing.update(words)
        new = list(missing.difference(self.known))
        if new:
            self.known.update(zip(new, self.encode_words(new)))
        get = self.known.__getitem__
        out = [b"".join([i.to_bytes(4, "little") if i is not None else b"".join(map(get, words))
                         for i, words in row]) for row in split]
        for w in new:
            if len(w) > LONG_WORD:
                del self.known[w]
        return out

    def decode(self, ids: list[int]) -> str:
        """The text of the ids; bytes that are no UTF-8 become replacement characters, ids
        that are not in the file nothing."""
        get = self.bytes.get
        return b"".join([get(i, b"") for i in ids]).decode("utf-8", "replace")


def _codec(tokenizer_json: str) -> Codec:
    return worker_cache(f"bpe {hash(tokenizer_json)}", lambda: Codec(tokenizer_json))


def _slices(weights: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``limit`` weight each, whole rows only."""
    at, held = 0, 0
    for k, w in enumerate(weights.tolist()):
        held += w
        if held >= limit:
            yield at, k + 1
            at, held = k + 1, 0
    if at < len(weights):
        yield at, len(weights)


def _read(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def encode(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids array<int>): the tokens of every whole text, as the tokenizer file gives them
    without template tokens, truncation or padding.

    A null or empty text has no ids; null and repeated ids and rows stay as they are; strings
    of special tokens in a text get their ids. An empty table gives none. Other columns are
    not read, whatever their names.
    """
    shared = docs.sparkSession.sparkContext.broadcast(_read(tokenizer_path))   # a vocabulary file: fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared.value)
        for b in batches:
            for s, e in _slices(_lengths(b.column(1)), SLICE_CHARS):
                texts = [t or "" for t in b.column(1).slice(s, e - s).to_pylist()]
                found = codec.encode(texts)
                offsets = np.zeros(len(found) + 1, np.int32)
                np.cumsum([len(x) // 4 for x in found], out=offsets[1:])
                ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(found), "<i4")))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(s, e - s), ids], names=["doc_id", "ids"])
        hand_back()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, tokenizer_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, ids, text): the text of every row of ids, special tokens included.

    Null or no ids give the empty text; ids that are null or not in the file give nothing;
    bytes that are no UTF-8 (rows cut inside a character) become replacement characters.
    """
    shared = encoded.sparkSession.sparkContext.broadcast(_read(tokenizer_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared.value)
        for b in batches:
            for s, e in _slices(_lengths(b.column(1)), SLICE_CHARS):
                part = b.slice(s, e - s)
                texts = [codec.decode(x or []) for x in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())],
                                                 names=["doc_id", "ids", "text"])
        hand_back()

    rows = encoded.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).cast("array<int>").alias("ids"))
    return rows.mapInArrow(run, "doc_id long, ids array<int>, text string")


def _lengths(column: pa.Array) -> np.ndarray:
    """Length of each text (in bytes) or list of a column, 1 at least; null counts as 1."""
    size = pc.list_value_length if pa.types.is_list(column.type) else pc.binary_length
    return np.maximum(pc.fill_null(size(column), 0).to_numpy(zero_copy_only=False).astype(np.int64), 1)


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def digest(decoded: DataFrame) -> DataFrame:
    """Token count and SHA-256 of ids (decimal, joined by commas) and of the decoded text."""
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return decoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"),
                          F.sha2(F.col("text"), 256).alias("decoded_sha256"))
