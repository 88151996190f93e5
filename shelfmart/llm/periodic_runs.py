"""Runs: stretches of words that repeat with a period, found by recompression.

The words of a batch of texts become one sequence of numbers with a mark of its own
behind every text. The sequence is compressed level by level, blocks of one symbol and
pairs of a left and a right symbol in turn, into a run-length grammar. Where a level puts a
border depends on the two symbols beside it alone, so equal stretches are parsed alike but
for their ends, and the extension of two places (how far they agree, forwards or backwards)
is found by going up the levels while symbols agree and down again after the first that
do not.

A run of period q and length 3q or more holds two places i, i + q of the grid of all
multiples of q, with q words of it behind the second. The grids of all periods together
have n log n places; the extensions at a grid place are the exact ends of its run, and of
the periods that give one stretch the smallest is its period.

On Spark it is one pass over the rows without a shuffle. A task holds the grammar of one
batch of texts (of one text, if that is longer).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmart.llm.common import hand_back, unused

MIN_WORDS = 24
MIN_EXPONENT = 3
BATCH_WORDS = 1 << 18
FLUSH = 1 << 16                       # grid places whose extensions are found together
WORDS = re.compile(r"[^\x20\x09-\x0D]+").findall
SPACE_CLASS = r"[\x20\x09-\x0D]+"
RUNS_SCHEMA = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def _hash(x: np.ndarray, level: int) -> np.ndarray:
    """A fixed mixing of symbols, another one on each level."""
    z = (x.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15 * (2 * level + 1) % 2**64))
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


class Grammar:
    """Run-length grammar of a sequence by recompression.

    ``sequence`` holds symbols below ``marks`` and, at the end of every text, a symbol at or
    above it that occurs once. ``symbols[k]`` are the symbols of level k, level 0 being the
    sequence. Border b of level k + 1 (before its symbol b) is border ``down[k][b]`` of level
    k; border b of level k is border ``up[k][b]`` of level k + 1, or none (-1).
    """

    def __init__(self, sequence: np.ndarray, marks: int):
        self.symbols, self.up, self.down = [sequence.astype(np.int64)], [], []
        self.blocks: list[bool] = []                      # whether level k + 1 is made of blocks of level k
        fixed = sequence >= marks                         # marks are never joined with anything
        texts, fresh, turn = int(fixed.sum()), int(sequence.max(initial=0)) + 1, 0
        while len(self.symbols[-1]) > 2 * texts:          # until every text is one symbol
            s = self.symbols[-1]
            first = np.ones(len(s), bool)
            if turn % 2 == 0:                             # blocks of one symbol
                first[1:] = s[1:] != s[:-1]
                starts = np.flatnonzero(first)
                sizes = np.diff(starts, append=len(s))
                new, at = s[starts], np.flatnonzero(sizes > 1)
                key = new[at] * np.int64(len(s) + 1) + sizes[at]
            else:                                         # pairs of a left and a right symbol
                side = (_hash(s, turn) & np.uint64(1)).astype(bool)
                joined = ~side[:-1] & side[1:] & ~fixed[:-1] & ~fixed[1:]
                first[1:] = ~joined
                starts = np.flatnonzero(first)
                pairs = np.flatnonzero(joined)
                new, at = s[starts], (np.cumsum(first) - 1)[pairs]
                key = s[pairs] * np.int64(fresh) + s[pairs + 1]
            turn += 1
            if not len(at):
                continue
            code, kinds = pd.factorize(key)
            new[at] = fresh + code
            fresh += len(kinds)
            up = np.full(len(s) + 1, -1, np.int32)
            up[starts] = np.arange(len(starts), dtype=np.int32)
            up[len(s)] = len(starts)
            self.up.append(up)
            self.down.append(np.append(starts, len(s)).astype(np.int32))
            self.blocks.append(turn % 2 == 1)
            self.symbols.append(new)
            fixed = fixed[starts]

    def extend(self, a: np.ndarray, b: np.ndarray, backwards: bool = False) -> np.ndarray:
        """How many symbols of the sequence agree from the borders ``a`` and ``b`` on (before
        them, if ``backwards``), for arrays of pairs of different borders."""
        who, x, y = np.arange(len(a)), a.astype(np.int64), b.astype(np.int64)
        stopped: list[list[tuple[np.ndarray, ...]]] = [[] for _ in self.symbols]
        for level in range(len(self.symbols)):            # up while the symbols agree
            risen = []
            while len(who):
                if level < len(self.up):
                    ux, uy = self.up[level][x], self.up[level][y]
                    rise = (ux >= 0) & (uy >= 0)
                    if rise.any():
                        risen.append((who[rise], ux[rise].astype(np.int64), uy[rise].astype(np.int64)))
                        who, x, y = who[~rise], x[~rise], y[~rise]
                        if not len(who):
                            break
                same, nx, ny = self._step(level, x, y, backwards)
                if not same.all():
                    stopped[level].append((who[~same], x[~same], y[~same]))
                who, x, y = who[same], nx[same], ny[same]
            if not risen:
                break
            who, x, y = (np.concatenate(c) for c in zip(*risen))
        end = a.astype(np.int64)
        for level in range(len(self.symbols) - 1, -1, -1):    # down to the first words that differ
            if not stopped[level]:
                continue
            who, x, y = (np.concatenate(c) for c in zip(*stopped[level]))
            active = np.arange(len(who))
            while len(active):
                same, nx, ny = self._step(level, x[active], y[active], backwards)
                active = active[same]
                x[active], y[active] = nx[same], ny[same]
            if level == 0:
                end[who] = x
            else:
                below = self.down[level - 1]
                stopped[level - 1].append((who, below[x].astype(np.int64), below[y].astype(np.int64)))
        return np.abs(end - a)

    def _step(self, level: int, x: np.ndarray, y: np.ndarray,
              backwards: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Whether the next symbols of a level agree, and the borders behind them. Inside
        blocks, all that the two blocks have in common is taken at once."""
        s = self.symbols[level]
        if backwards:
            same = (x > 0) & (y > 0) & (s[x - 1] == s[y - 1])
        else:
            last = len(s) - 1
            same = (x <= last) & (y <= last) & (s[np.minimum(x, last)] == s[np.minimum(y, last)])
        size = 1
        if level < len(self.up) and self.blocks[level]:
            starts = self.down[level]
            if backwards:
                rest = [z - starts[np.maximum(np.searchsorted(starts, z, "left") - 1, 0)] for z in (x, y)]
            else:
                rest = [starts[np.minimum(np.searchsorted(starts, z, "right"), len(starts) - 1)] - z for z in (x, y)]
            size = np.maximum(np.minimum(*rest), 1)
        return (same, x - size, y - size) if backwards else (same, x + size, y + size)


def find_runs(sequence: np.ndarray, lengths: np.ndarray, marks: int, min_words: int,
              min_exponent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of all runs in texts laid out one behind the other, longest text
    first, each followed by its mark; sorted by start, then period."""
    grammar = Grammar(sequence, marks)
    ends = np.cumsum(lengths + 1)                         # behind each text's mark
    period_of, end_of = np.zeros(len(sequence), np.int32), np.zeros(len(sequence), np.int32)
    found: list[np.ndarray] = []
    held: list[tuple[np.ndarray, int]] = []
    waiting = 0

    def settle() -> None:
        i = np.concatenate([h[0] for h in held])
        q = np.concatenate([np.full(len(h[0]), h[1], np.int64) for h in held])
        behind = grammar.extend(i, i + q)
        far = behind >= np.maximum(min_words, min_exponent * q) - 2 * q + 1
        i, q, behind = i[far], q[far], behind[far]
        if not len(i):
            return
        start, end = i - grammar.extend(i, i + q, backwards=True), i + q + behind
        good = end - start >= np.maximum(min_words, min_exponent * q)
        runs = np.unique(np.stack([start[good], end[good], q[good]], axis=1), axis=0)
        found.append(runs)
        for s, e, p in runs[np.argsort(runs[:, 2], kind="stable")].tolist():
            free = period_of[s:e] == 0
            period_of[s:e][free], end_of[s:e][free] = p, e

    longest = int(lengths[0]) if len(lengths) else 0
    for q in range(1, longest // min_exponent + 1):
        need = max(min_words, min_exponent * q)
        if need > longest:
            break
        stop = int(ends[np.searchsorted(-lengths, -need, "right") - 1])      # texts of ``need`` words or more
        i = np.flatnonzero(sequence[0:stop - q:q] == sequence[q:stop:q]) * q
        # a run's grid place has so many words of it behind it; the last of them is compared first
        ahead = need - 2 * q
        i = i[i + q + ahead < stop]
        i = i[sequence[i + ahead] == sequence[i + q + ahead]]
        if len(i) and found:                              # inside a run whose period divides q: its multiple
            p = period_of[i]
            i = i[(p == 0) | (q % np.maximum(p, 1) != 0) | (end_of[i] <= i + q)]
        if len(i):
            held.append((i, q))
            waiting += len(i)
        if waiting >= FLUSH:
            settle()
            held, waiting = [], 0
    if held:
        settle()
    if not found:
        none = np.zeros(0, np.int64)
        return none, none, none
    runs = np.unique(np.concatenate(found), axis=0)       # by start, end, period
    smallest = np.ones(len(runs), bool)
    smallest[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
    runs = runs[smallest]
    runs = runs[np.lexsort((runs[:, 2], runs[:, 0]))]
    return runs[:, 0], runs[:, 1], runs[:, 2]


def analyse(words: list[list[str]], min_words: int, min_exponent: int) -> list[tuple[list[dict], str]]:
    """(runs, collapsed text) of each text of a batch."""
    number: dict[str, int] = {}
    order = sorted((k for k, w in enumerate(words) if w), key=lambda k: -len(words[k]))
    coded = [[number.setdefault(x, len(number)) for x in words[k]] for k in order]
    lengths = np.array([len(c) for c in coded], np.int64)
    marks = len(number)
    out: list[tuple[list[dict], str]] = [([], " ".join(w)) for w in words]
    if not len(lengths) or lengths[0] < min_words:
        return out
    for k, c in enumerate(coded):
        c.append(marks + k)
    begins = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]])
    start, end, period = find_runs(np.concatenate([np.array(c, np.int64) for c in coded]), lengths, marks,
                                   min_words, min_exponent)
    text = np.searchsorted(begins, start, "right") - 1
    cuts = np.flatnonzero(np.diff(text)) + 1
    for rows in np.split(np.arange(len(start)), cuts) if len(start) else []:
        k = int(text[rows[0]])
        s = start[rows] - begins[k]
        depth = np.zeros(int(lengths[k]) + 1, np.int64)
        np.add.at(depth, s + period[rows], 1)
        np.add.at(depth, end[rows] - begins[k], -1)
        gone = np.cumsum(depth[:-1]) > 0
        kept = " ".join([w for w, g in zip(words[order[k]], gone.tolist()) if not g])
        runs = [{"start": a, "length": n, "period": p} for a, n, p in
                zip(s.tolist(), (end[rows] - start[rows]).tolist(), period[rows].tolist())]
        out[order[k]] = runs, kept
    return out


def runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS,
         min_exponent: int = MIN_EXPONENT) -> DataFrame:
    """(doc_id, n_words, runs, collapsed): the runs of every whole text.

    A run is a stretch of consecutive words (maximal strings free of white space) whose
    smallest period is ``period``, of ``min_words`` words and ``min_exponent`` periods (2 at
    least) or more, that no neighbouring word extends. ``runs`` holds start (word number from
    0), length and period, by start, then period. ``collapsed`` is the text's words joined by
    one space, without those that some run holds behind its first period.

    A null or empty text has no words, no runs and an empty collapsed text; null and repeated
    ids and rows stay as they are; an empty table gives none. Other columns are not read,
    whatever their names.
    """
    if min_exponent < 2:
        raise ValueError("a run has two periods at least")

    def flush(ids: list, words: list[list[str]]) -> pa.RecordBatch:
        done = analyse(words, min_words, min_exponent)
        return pa.RecordBatch.from_arrays([
            pa.array(ids, pa.int64()), pa.array([len(w) for w in words], pa.int64()),
            pa.array([r for r, _ in done], pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))),
            pa.array([c for _, c in done], pa.string())], names=["doc_id", "n_words", "runs", "collapsed"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, words, held = [], [], 0
            for i, text in zip(b.column(0).to_pylist(), b.column(1)):
                ids.append(i)
                words.append(WORDS(text.as_py() or ""))
                held += len(words[-1]) + 1
                if held >= BATCH_WORDS:
                    yield flush(ids, words)
                    ids, words, held = [], [], 0
            if ids:
                yield flush(ids, words)
        hand_back()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, RUNS_SCHEMA)


def plant(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` in which the text of every tenth document (by CRC-32 of its id) ends in a run.

    With h the CRC-32 of the decimal id, g = floor(h / 10), n words: if h is a multiple of 10
    and n > 0, the words from a = g mod n on repeat the p = 1 + floor((n - a) / (3 + g mod 8))
    words that start there. Other texts, and those with a null id, stay as they are.
    """
    w, a, p = unused(docs, "words", "a", "p")
    h = F.crc32(F.col(id_col).cast("long").cast("string"))
    g, n = F.floor(h / 10), F.nullif(F.size(w), F.lit(0))
    body = docs.withColumn(w, F.when(h % 10 == 0, F.filter(F.split(F.col(text_col), SPACE_CLASS), lambda x: x != "")))
    body = body.withColumn(a, (g % n).cast("int"))
    body = body.withColumn(p, (1 + F.floor((n - F.col(a)) / (3 + g % 8))).cast("int"))
    again = F.ceil((n - F.col(a)) / F.col(p)).cast("int")
    tail = F.flatten(F.array_repeat(F.slice(w, F.col(a) + 1, F.col(p)), again))
    planted = F.array_join(F.slice(F.concat(F.slice(w, F.lit(1), F.col(a)), tail), F.lit(1), n), " ")
    return body.withColumn(text_col, F.when(F.col(p).isNotNull(), planted).otherwise(F.col(text_col))).drop(w, a, p)


def digest(found: DataFrame) -> DataFrame:
    """Number of runs, the run with the most periods (exactly; ties: smallest start, then
    period), and SHA-256 of the list of runs and of the collapsed text."""
    run_type = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")
    best = F.aggregate("runs", run_type, lambda b, r: F.when(
        b.isNull() | (r["length"] * b["period"] > b["length"] * r["period"]), r).otherwise(b))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return (found.withColumn("best", best)
                 .select("doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"),
                         F.col("best.length").alias("length"), F.col("best.period").alias("period"),
                         F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
                         F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
                         F.sha2("collapsed", 256).alias("collapsed_sha256")))
