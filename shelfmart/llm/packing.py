"""Packing tokenised documents into training sequences: best-fit decreasing.

Documents are tokenised where they are read and cut into pieces of at most one window: full
windows first, the rest of the document last. The pieces of consecutive rows make a group
of bounded size, and a task packs its groups one after the other, so no text and no token is
shuffled. Inside a group the pieces are placed longest first into the tightest open window,
which a segment tree indexed by remaining capacity finds in logarithmic time.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmart.llm.bpe_codec import byte_alphabet
from shelfmart.llm.common import hand_back, worker_cache
from shelfmart.operators.keys import PARTITION_SHIFT
from shelfmart.session import ensure_checkpoint_dir

END_ID = 1
GROUP_CHARS = 8 << 20
CACHE_WORDS = 200_000
GROUP_BITS = 40                    # a sequence id holds its group's number above so many bits
LEAST_GROUPS = 1 << 22             # and group numbers stay below twice this
PACKED_SCHEMA = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


class WordIds(dict):
    """White-space separated word -> its token ids as little-endian uint32 bytes.

    The tokenizer drops white space and never joins text across it, so a text's ids are the
    ids of its words in order. Words are remembered because most recur; the memory is
    bounded by CACHE_WORDS and forgotten as a whole. Words of printable ASCII and composed
    Latin letters are lower-cased and split here, as the normalizer and the pre-tokenizer
    would do, and go to the model part by part; all others, and all if the file turns out to
    treat a trial otherwise, go through the whole tokenizer.
    """

    SIMPLE = "[!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]+"
    #: The split pattern of the file over these characters.
    PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\w]|_)+").findall
    TRIAL = "Ab. don't (x12) ***é_ÀÉ'S 'll, <a|b> it's3,4 Œuvre"

    def __init__(self, tokenizer_json: str, special_tokens: bool = False):
        super().__init__()
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        if not special_tokens:                            # their strings in a text are ordinary text
            self.tokenizer.encode_special_tokens = True
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()] if special_tokens else []
        without = "".join(f"(?!.*{re.escape(t)})" for t in special)
        self.simple = re.compile(without + self.SIMPLE).fullmatch
        self.model, self.alphabet = self.tokenizer.model, dict(enumerate(byte_alphabet()))
        self.direct = True
        self.direct = all(self._split(w) == self._whole(w) for w in self.TRIAL.split(" "))

    def _whole(self, word: str) -> bytes:
        ids = self.tokenizer.encode(word, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def _part(self, part: str) -> bytes:
        plain = part if part.isascii() else part.encode().decode("latin-1").translate(self.alphabet)
        ids = [t.id for t in self.model.tokenize(plain)]
        found = self[part] = struct.pack(f"<{len(ids)}I", *ids)
        return found

    def _split(self, word: str) -> bytes:
        parts, known = self.PARTS(word.lower()), self.get
        return b"".join([known(p) or self._part(p) for p in parts])

    def __missing__(self, word: str) -> bytes:
        if len(self) >= CACHE_WORDS:
            self.clear()
        if self.direct and self.simple(word):
            found = self._split(word)
        else:
            found = self._whole(word)
        self[word] = found
        return found

    def ids(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, text.replace("\n", " ").split(" ")))


def _word_ids(tokenizer_json: str, special_tokens: bool) -> WordIds:
    return worker_cache(f"packing {hash(tokenizer_json)} {special_tokens}",
                        lambda: WordIds(tokenizer_json, special_tokens))


class CapacityTree:
    """Open windows by remaining capacity; finds the smallest capacity that holds a length."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.windows: list[list[int]] = [[] for _ in range(capacity + 1)]

    def add(self, remaining: int, window: int) -> None:
        self.windows[remaining].append(window)
        i = self.leaves + remaining
        while i:
            self.count[i] += 1
            i >>= 1

    def take(self, length: int) -> tuple[int, int] | None:
        """(remaining, window) of a tightest window with room for ``length``, removed from the tree."""
        count, i = self.count, self.leaves + length
        if not count[i]:
            while i > 1 and (i & 1 or not count[i + 1]):     # up until a right neighbour holds windows
                i >>= 1
            if i <= 1:
                return None
            i += 1
            while i < self.leaves:
                i = 2 * i if count[2 * i] else 2 * i + 1
        remaining = i - self.leaves
        while i:
            count[i] -= 1
            i >>= 1
        return remaining, self.windows[remaining].pop()


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(window, offset) of each piece; windows are numbered from 0. Equal lengths keep their order."""
    window, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    tree, opened = CapacityTree(capacity), 0
    for k in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[k])
        found = tree.take(size)
        if found is None:
            found, opened = (capacity, opened), opened + 1
        remaining, w = found
        window[k], offset[k] = w, capacity - remaining
        if remaining > size:
            tree.add(remaining - size, w)
    return window, offset


def even_out(lengths: np.ndarray, window: np.ndarray, capacity: int) -> list[tuple[int, int, int, int, int]]:
    """(piece, from, length, window, offset) rows that leave next to no padding.

    The emptiest windows are dissolved and their pieces cut to fill the gaps of the others;
    what is left at the end goes into sequences whose lengths are powers of two, which need
    no padding. Only pieces of dissolved windows are cut.
    """
    used = np.bincount(window, lengths, minlength=window.max() + 1).astype(np.int64)
    order = np.argsort(used, kind="stable")                  # emptiest first
    gaps = capacity - used[order]
    behind = gaps[::-1].cumsum()[::-1]                       # gaps from here on
    moved = used[order].cumsum()
    # the first k windows go if their tokens fill every gap behind them
    k = int(np.searchsorted(np.append(moved, np.inf) - np.append(behind[1:], [0, 0]), 0))
    k = min(k + 1, len(order))
    gone = np.zeros(len(used), bool)
    gone[order[:k]] = True
    rows, fill = [], np.zeros(len(used), np.int64)
    for p in np.flatnonzero(~gone[window]).tolist():
        w, n = int(window[p]), int(lengths[p])
        rows.append((p, 0, n, w, int(fill[w])))
        fill[w] += n
    loose = [[p, 0, int(lengths[p])] for p in np.flatnonzero(gone[window]).tolist()]
    targets = [(w, capacity) for w in order[k:].tolist() if fill[w] < capacity]
    left = int(sum(x[2] for x in loose) - sum(capacity - fill[w] for w, _ in targets))
    fresh = iter(order[:k].tolist() + list(range(len(used), len(used) + capacity.bit_length() + 1)))
    while left > 0:                                          # whole windows, then powers of two
        size = capacity if left >= capacity else 1 << (left.bit_length() - 1)
        targets.append((next(fresh), size))
        left -= size
    at = 0
    for w, until in targets:
        held = int(fill[w]) if w < len(used) and not gone[w] else 0
        while held < until and at < len(loose):
            p, s, n = loose[at]
            take = min(n, until - held)
            rows.append((p, s, take, w, held))
            held += take
            loose[at] = [p, s + take, n - take]
            at += take == n
    return rows


def _row_places(docs: DataFrame) -> tuple[DataFrame, Column, Column, list[Column]]:
    """(docs, unit, row, order): the file or partition that a row is read from, the row's number
    in it, and what orders the units.

    Files come in the order in which a writer numbers them; a name without a part number has
    no place in it. Rows that are not read from files are in the order of their partitions."""
    try:
        meta = docs.metadataColumn("_metadata")
        name = meta["file_name"]
        number = lambda mark: F.regexp_extract(name, mark, 1).try_cast("long")
        return docs, meta["file_path"], meta["row_index"], [number(r"part-(\d+)"), F.coalesce(number(r"-c(\d+)"), F.lit(-1))]
    except AnalysisException:
        ensure_checkpoint_dir(docs.sparkSession)
        kept = docs.checkpoint()
        place = F.monotonically_increasing_id()
        unit = F.shiftright(place, PARTITION_SHIFT)
        return (kept, unit.cast("string"), place.bitwiseAND(F.lit((1 << PARTITION_SHIFT) - 1)), [unit, F.lit(0).cast("long")])


def in_row_order(docs: DataFrame, id_col: str, text_col: str, group_chars: int) -> tuple[DataFrame, int]:
    """((doc_id, text, at, step), positions per group): ``at`` rises with the order of the rows,
    from one row to the next of a file by ``step``, which no row has as many tokens as.

    Only one row per file (rows and longest text) is gathered, to give each file its range
    of positions; the texts stay where they are read."""
    spark = docs.sparkSession
    placed, unit, row, order = _row_places(docs)
    text = F.col(text_col).cast("string")
    i = F.col(id_col).cast("long")
    rows = placed.select(i, text, unit, row, *order).toDF("doc_id", "text", "unit", "row", "part", "chunk")
    found = rows.groupBy("unit", "part", "chunk").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.coalesce(F.octet_length("text"), F.lit(0))).alias("longest"),
        F.max("row").alias("last"), F.sum(F.coalesce(F.length("text"), F.lit(0)) + 1).alias("chars")).collect()
    if any(f["part"] is None for f in found):
        raise ValueError("the order of the rows is not known: a file's name holds no part number")
    at, files = 0, []
    for f in sorted(found, key=lambda f: (f["part"], f["chunk"], f["unit"])):
        step = 4 * f["longest"] + 2                       # lower-casing and composing lengthen a text by less
        files.append((f["unit"], at, step))
        at += step * (f["last"] + 1)
    chars = sum(f["chars"] for f in found)
    span = max(group_chars * at // max(chars, 1), at // LEAST_GROUPS, 1)
    starts = spark.createDataFrame(files, "unit string, first long, step long")
    return rows.join(F.broadcast(starts), "unit").select("doc_id", "text", (F.col("first") + F.col("row") * F.col("step")).alias("at"), "step"), span


def pack(docs: DataFrame, tokenizer_path: str, window: int = 2048, id_col: str = "doc_id",
         text_col: str = "text", group_chars: int = GROUP_CHARS, in_order: bool = False,
         special_tokens: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, sequence_id, offset, ids.

    Every row of ``docs`` is a document: the ids of its whole text (null: none) and END_ID.
    ``start`` counts the document's ids before the piece, ``offset`` the ids before it in
    its sequence (gapless from 0), ``ids`` holds little-endian uint32 ids. Sequences hold at
    most ``window`` ids. Documents are cut at full windows; whatever best-fit decreasing
    leaves open is filled by cutting pieces of the emptiest windows. Repeated rows and null
    ids are documents like any other. An empty table gives no rows.

    A group holds the pieces of consecutive rows of a task, of about ``group_chars``
    characters. With ``in_order`` the order of the rows counts (``in_row_order``): groups do
    not reach over a break in it, and sequences are numbered in it, by group and then by
    their earliest piece.
    With ``special_tokens`` the strings of special tokens in a text get their own ids, as the
    tokenizer does when loaded; otherwise they are ordinary text.
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        tokenizer_json = f.read()
    if in_order:
        rows, span = in_row_order(docs, id_col, text_col, group_chars)
    else:
        none = F.lit(None).cast("long")
        rows, span = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                                 none.alias("at"), none.alias("step")), 0
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer_json)     # the vocabulary file: fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, end = _word_ids(shared.value, special_tokens), struct.pack("<I", END_ID)
        group: list[tuple] = []                           # (doc_id, start, length, doc_tokens, ids) in row order
        held, number, expected, counted = 0, None, None, TaskContext.get().partitionId() << GROUP_BITS
        for b in batches:
            for doc_id, text, at, step in zip(b.column(0).to_pylist(), b.column(1), b.column(2).to_pylist(),
                                              b.column(3).to_pylist()):
                text = text.as_py() or ""
                if group and in_order and (at != expected or at // span != number):
                    yield from _packed(group, first, window, in_order)
                    group, held = [], 0
                ids = words.ids(text) + end
                n = len(ids) // 4
                for s in range(0, n, window):
                    if not group:
                        number = at // span if in_order else None
                        first = (number << GROUP_BITS) + at - number * span + s if in_order else counted
                    piece = ids[4 * s:4 * (s + window)]
                    group.append((doc_id, s, len(piece) // 4, n, piece))
                    held += 1 + len(text) * len(piece) // len(ids)
                    if held >= group_chars:
                        counted += len(group) + window
                        yield from _packed(group, first, window, in_order)
                        group, held = [], 0
                expected = at + step if in_order else None
        if group:
            yield from _packed(group, first, window, in_order)
        del group
        hand_back()

    return rows.mapInArrow(run, PACKED_SCHEMA)


def _packed(group: list[tuple], first: int, window: int, in_order: bool = False) -> Iterator[pa.RecordBatch]:
    """Place one group; its sequences are numbered from ``first``, fewer of them than its tokens."""
    doc_id, start, length, doc_tokens, ids = zip(*group)
    lengths = np.array(length, np.int64)
    which, _ = best_fit_decreasing(lengths, window)
    at = np.array(even_out(lengths, which, window), np.int64)
    used, at[:, 3] = np.unique(at[:, 3], return_inverse=True)
    if in_order:
        earliest = np.full(len(used), len(group))
        np.minimum.at(earliest, at[:, 3], at[:, 0])
        nth = np.empty_like(earliest)
        nth[np.argsort(earliest, kind="stable")] = np.arange(len(nth))
        at[:, 3] = nth[at[:, 3]]
    start, tokens = np.array(start, np.int64), np.array(doc_tokens, np.int64)
    for s in range(0, len(at), 4096):
        p, cut, n, w, offset = at[s:s + 4096].T
        rows = p.tolist()
        yield pa.RecordBatch.from_arrays([
            pa.array([doc_id[i] for i in rows], pa.int64()), pa.array(start[p] + cut), pa.array(n), pa.array(tokens[p]),
            pa.array(first + w), pa.array(offset),
            pa.array([ids[i][4 * a:4 * (a + m)] for i, a, m in zip(rows, cut.tolist(), n.tolist())], pa.binary())],
            names=["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def digest(packed: DataFrame) -> DataFrame:
    """The pieces with a checksum of their ids instead of the ids."""
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")
