"""How quality filters interact: what each removes, repeats or alone catches, in every order.

Four filters look at one text, the fifth at all of them: it fails a text that a smaller id
holds too. For that one, texts are inserted whole into radix (compressed) tries that hold
the smallest id at a text's end, and a row fails if its end holds a smaller id. A map task
does so for its own rows first, so a text copied any number of times leaves it as one row
for each batch at most; what is undecided is range-partitioned by text prefixes, deepened
wherever one prefix holds too much, and decided by the tries of the partitions.

What remains of a document is a row of (id, part, mask of failed filters); labels are joined
to these, and the counts per part and mask give all orders.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from itertools import permutations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmart.llm.common import Stored, hand_back

LETTERS = "ABCDE"
MIN_WORDS = 100                    # A: fewer words
MIN_DISTINCT_PERCENT = 80          # B: a smaller share of distinct words
MAX_CAPITAL_PERCENT = 10           # C: a greater share of A-Z among the characters
MARKS = "#$%&*|"                   # D: any of these
DUPLICATE = 1 << LETTERS.index("E")

TRIE_BYTES = 32 << 20              # texts of one map-side trie
CARRY_BYTES = 4 << 20              # its most copied texts, which go on into the next
PARTITION_BYTES = 32 << 20         # texts of one partition
FIRST_DEPTH, DEEPER, ROUNDS = 16, 4, 4
MAX_HEAVY = 4096                   # prefixes of one depth that can be broadcast: each holds this share of all text at least

WORDS = re.compile(rb"[^\x20\x09-\x0D]+").findall
CAPITALS, MARK_BYTES = bytes(range(65, 91)), MARKS.encode()
ROWS = "doc_id long, part string, mask int, n long, text binary"


def text_mask(text: bytes) -> int:
    """Filters A to D that a UTF-8 text fails, as bits."""
    words = WORDS(text)
    characters = len(text) if text.isascii() else len(text.decode("utf-8", "replace"))
    return ((len(words) < MIN_WORDS)
            | (100 * len(set(words)) < MIN_DISTINCT_PERCENT * len(words)) << 1
            | (100 * (len(text) - len(text.translate(None, CAPITALS))) > MAX_CAPITAL_PERCENT * characters) << 2
            | (len(text.translate(None, MARK_BYTES)) < len(text)) << 3)


class Node:
    """A trie node: the edge to it is ``source[start:stop]``; ``least`` is the smallest id of the
    texts that end here, ``copies`` how many do."""
    __slots__ = ("source", "start", "stop", "children", "least", "copies")

    def __init__(self, source: bytes, start: int, stop: int):
        self.source, self.start, self.stop = source, start, stop
        self.children: dict[int, Node] = {}
        self.least: int | None = None
        self.copies = 0


def _agree(a: bytes, s: int, b: bytes, t: int, limit: int) -> int:
    """How many bytes of ``a`` from s and ``b`` from t agree, ``limit`` at most."""
    low, size = 0, 16
    while low < limit:
        size = min(size, limit - low)
        if a[s + low:s + low + size] == b[t + low:t + low + size]:
            low += size
            size *= 4
        elif size == 1:
            return low
        else:
            size = size + 1 >> 1
            if a[s + low:s + low + size] == b[t + low:t + low + size]:
                low += size
    return limit


class RadixTrie:
    """Whole texts, each ending in a node of its own."""

    def __init__(self):
        self.root = Node(b"", 0, 0)
        self.held = 0

    def insert(self, text: bytes, i: int) -> Node:
        node, at, n = self.root, 0, len(text)
        while at < n:
            child = node.children.get(text[at])
            if child is None:
                child = node.children[text[at]] = Node(text, at, n)
                self.held += n
                node, at = child, n
                break
            edge = child.stop - child.start
            same = _agree(child.source, child.start, text, at, min(edge, n - at))
            if same < edge:                               # split the edge where the texts part
                upper = Node(child.source, child.start, child.start + same)
                child.start += same
                upper.children[child.source[child.start]] = child
                node.children[text[at]] = upper
                child = upper
            node, at = child, at + same
        node.copies += 1
        if node.least is None or i < node.least:
            node.least = i
        return node


def _filter_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """ROWS of a task: rows that are decided without a text, the others with theirs."""
    trie, repeated = RadixTrie(), {}
    for b in batches:
        ids, parts = b.column(0).to_pylist(), b.column(1).to_pylist()
        ends: dict[tuple, list] = {}
        decided: dict[tuple, int] = {}
        for k, value in enumerate(b.column(2)):
            text = value.as_py() or b""
            mask = text_mask(text)
            if ids[k] is None:                            # compared with no id
                key = None, parts[k], mask
                decided[key] = decided.get(key, 0) + 1
                continue
            node = trie.insert(text, ids[k])
            if node.copies > 1:
                repeated[id(node)] = node, text
            row = ends.setdefault((id(node), ids[k], parts[k]), [node, mask, 0, text])
            row[2] += 1
        out = [(None, p, m, n, None) for (_, p, m), n in decided.items()]
        for (_, i, p), (node, mask, n, text) in ends.items():
            out.append((i, p, mask | DUPLICATE, n, None) if i > node.least else (i, p, mask, n, text))
        yield _batch(out)
        if trie.held > TRIE_BYTES:                        # a new trie, with the most copied texts and their least ids
            carried, size = RadixTrie(), 0
            for node, text in sorted(repeated.values(), key=lambda r: -r[0].copies):
                size += len(text)
                if size > CARRY_BYTES:
                    break
                carried.insert(text, node.least).copies = 2
            trie, repeated = carried, {}
    hand_back()


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[]] * 5
    types = [pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)],
                                      names=["doc_id", "part", "mask", "n", "text"])


def _decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a partition, which holds all rows of each of its texts, without their texts."""
    trie, rows = RadixTrie(), []
    for b in batches:
        for i, part, mask, n, text in zip(*(c.to_pylist() for c in b.columns)):
            rows.append((trie.insert(text, i), i, part, mask, n))
    for s in range(0, len(rows), 1 << 16):
        yield _batch([(i, part, mask | DUPLICATE if i > node.least else mask, n, None)
                      for node, i, part, mask, n in rows[s:s + (1 << 16)]])
    del trie, rows
    hand_back()


def prefix_key(rows: DataFrame, text: str, limit: int) -> Column:
    """The shortest prefix of a row's text, of FIRST_DEPTH bytes or DEEPER times as many and so
    on, that ``limit`` bytes of text at most begin with; after ROUNDS the longest tried.

    Equal texts have equal prefixes. Each round counts bytes per prefix under the prefixes
    found too heavy by the one before; at most (all bytes / limit) are."""
    key, depth = F.substring(text, 1, FIRST_DEPTH), FIRST_DEPTH
    under = F.lit(True)
    for _ in range(ROUNDS - 1):
        prefix = F.substring(text, 1, depth)
        heavy = [bytes(r[0]) for r in rows.filter(under).groupBy(prefix.alias("p"))
                 .agg(F.sum(F.length(text)).alias("b")).filter(F.col("b") > limit).select("p").collect()]
        if not heavy:
            break
        under = prefix.isin(heavy)
        depth *= DEEPER
        key = F.when(under, F.substring(text, 1, depth)).otherwise(key)
    return key


def filter_masks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang",
                 partition_bytes: int = PARTITION_BYTES) -> DataFrame:
    """(doc_id, part, mask, n): the filters that documents fail, as bits in the order of LETTERS,
    and how many rows are alike in it.

    A null text is empty, a null part the empty string. A row fails the last filter if another
    row has the same text and a smaller id; null ids are neither smaller nor greater. Repeated
    rows count each. An empty table gives none. Other columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"))
    first = Stored(rows.mapInArrow(_filter_rows, ROWS)).df
    open_rows = first.filter(F.col("text").isNotNull())
    total = open_rows.agg(F.sum(F.length("text") + 64)).first()[0] or 0
    parts = max(1, -(-total // partition_bytes))
    key = prefix_key(open_rows, "text", max(partition_bytes // 2, total // MAX_HEAVY))
    # a prefix that is still too heavy is cut by a hash of its texts
    dealt = open_rows.withColumn("key", key).withColumn("h", F.xxhash64("text")).repartitionByRange(parts, "key", "h")
    later = dealt.drop("key", "h").mapInArrow(_decide, ROWS)
    return first.filter(F.col("text").isNull()).unionByName(later).drop("text")


def interactions(masks: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row per part, order of the filters and step; counts of documents of the part.

    kept and removed after and by the step's filter, redundant: failing it but removed before,
    unique_fails: failing nothing else, good_lost and toxic_lost: removed here with a label row
    of quality 1 or toxic 1, shapley: removed by the filter at any step, over all orders.
    """
    known = labels.groupBy(F.col(id_col).cast("long").alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("bad"))
    counts = (masks.join(known, "doc_id", "left")
                   .groupBy("part", "mask", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("bad", F.lit(0)).alias("bad"))
                   .agg(F.sum("n").alias("n")))
    orders = ["".join(p) for p in permutations(LETTERS)]
    steps = (counts.withColumn("filter_order", F.explode(F.array(*map(F.lit, orders))))
                   .withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(LETTERS))))))
    place = [F.instr("filter_order", c) for c in LETTERS]
    bits = lambda when: sum(F.when(when(p), F.lit(1 << k)).otherwise(0) for k, p in enumerate(place))
    steps = steps.withColumn("here", bits(lambda p: p == F.col("step"))).withColumn("before", bits(lambda p: p < F.col("step")))
    mask, here, before = F.col("mask"), F.col("here"), F.col("before")
    fails, gone = mask.bitwiseAND(here) != 0, mask.bitwiseAND(before) != 0
    count = lambda cond, n=F.col("n"): F.coalesce(F.sum(F.when(cond, n)), F.lit(0)).cast("long")
    share = F.col("n") * (F.lit(math.factorial(len(LETTERS))) / F.nullif(F.bit_count(mask), F.lit(0))).cast("long")
    return steps.groupBy("part", "filter_order", "step").agg(
        count(mask.bitwiseAND(before.bitwiseOR(here)) == 0).alias("kept"), count(fails & ~gone).alias("removed"),
        count(fails & gone).alias("redundant"), count(mask == here).alias("unique_fails"),
        count(fails & ~gone & (F.col("good") == 1)).alias("good_lost"),
        count(fails & ~gone & (F.col("bad") == 1)).alias("toxic_lost"), count(fails, share).alias("shapley"))
