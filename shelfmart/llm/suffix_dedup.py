"""Repeated passages by a sparse suffix array over words.

Only suffixes that start at content-selected positions are kept: in every stretch of
``window`` word k-mers the one with the smallest hash (the minimiser). A passage of at
least ``min_words`` words has such a position among its first ``window`` words, the same
one in every occurrence, so its suffix there agrees with the others in ``reach`` =
min_words - window + 1 words or more.

1. The kept suffixes are sorted by (hash of their first ``reach`` words, document,
   position) over range partitions, and neighbours are compared. Suffixes without an equal
   neighbour are done; that is most of them.
2. The matches are extended to both sides: every stretch of ``min_words`` words around a
   matched position (up to window - 1 words to its left, the rest to its right) is hashed,
   sorted and compared with its neighbours in the same way. Overlapping repeated stretches
   join to the whole repeated passage.

The sort order includes document and position, so one very frequent passage spreads over
many partitions; the runs that meet at partition bounds, two per partition, are settled
afterwards. Exact copies of whole texts are found first, by digest, and only their first
document takes part in step 2.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmart.llm.common import Stored, hand_back, shuffle_partitions, unused, worker_cache
from shelfmart.operators.keys import dense_key
from shelfmart.session import ensure_checkpoint_dir

MIN_WORDS, WINDOW, KMER = 50, 25, 5
#: Odd multipliers of the two rolling hashes (suffixes, whole stretches).
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
CACHE_WORDS = 100_000
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word, 7)
        return h


def words_of(text: str | None) -> list[bytes]:
    """Runs of bytes other than space and \\x09-\\x0D."""
    return (text or "").encode("utf-8", "surrogatepass").split()


def word_hashes(words: list[bytes]) -> np.ndarray:
    known = worker_cache("suffix", _WordHashes)
    return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    have = _POWERS.get(base)
    if have is None or len(have[0]) < n:
        size = max(1024, 1 << n.bit_length())
        both = []
        for b in (base, pow(base, -1, 1 << 64)):
            steps = np.full(size, b, np.uint64)
            steps[0] = 1
            both.append(np.cumprod(steps, dtype=np.uint64))
        have = _POWERS[base] = (both[0], both[1])
    return have[0][:n], have[1][:n]


def rolling(hashes: np.ndarray, length: int, base: int) -> np.ndarray:
    """64-bit hash of every run of ``length`` words (arithmetic modulo 2^64)."""
    n = len(hashes)
    if n < length:
        return np.empty(0, np.uint64)
    up, down = _powers(base, n)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * up, dtype=np.uint64)])
    x = (total[length:] - total[:n - length + 1]) * down[:n - length + 1]
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def anchors(hashes: np.ndarray, min_words: int, window: int, kmer: int) -> np.ndarray:
    """For every start of ``min_words`` words: the position of its minimiser (leftmost if tied)."""
    starts = len(hashes) - min_words + 1
    if starts <= 0:
        return np.empty(0, np.int64)
    h = rolling(hashes, kmer, BASES[0])
    seen = np.lib.stride_tricks.sliding_window_view(h, window)[:starts]
    out = np.empty(starts, np.int64)
    for s in range(0, starts, 1 << 16):
        out[s:s + (1 << 16)] = seen[s:s + (1 << 16)].argmin(axis=1)
    return out + np.arange(starts)


def _suffixes(docs: DataFrame, min_words: int, window: int, kmer: int) -> DataFrame:
    """(key, doc_id, pos): the kept suffixes, keyed by their first words."""
    reach = min_words - window + 1

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            key, doc, pos = [], [], []
            for doc_id, text in zip(b["doc_id"].tolist(), b["text"]):
                h = word_hashes(words_of(text))
                at = np.unique(anchors(h, min_words, window, kmer))
                if len(at):
                    key.append(rolling(h, reach, BASES[0])[at])
                    doc.append(np.full(len(at), doc_id, np.int64))
                    pos.append(at.astype(np.int32))
            if key:
                yield pd.DataFrame({"key": np.concatenate(key).view(np.int64), "doc_id": np.concatenate(doc),
                                    "pos": np.concatenate(pos)})
        hand_back()

    return docs.mapInPandas(run, "key long, doc_id long, pos int")


def _stretches(docs: DataFrame, min_words: int, window: int, kmer: int) -> DataFrame:
    """(key, doc_id, pos): every start of ``min_words`` words whose minimiser is in ``hits``."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            key, doc, pos = [], [], []
            for doc_id, text, hits in zip(b["doc_id"].tolist(), b["text"], b["hits"]):
                h = word_hashes(words_of(text))
                at = np.flatnonzero(np.isin(anchors(h, min_words, window, kmer), hits))
                if len(at):
                    key.append(rolling(h, min_words, BASES[1])[at])
                    doc.append(np.full(len(at), doc_id, np.int64))
                    pos.append(at.astype(np.int32))
            if key:
                yield pd.DataFrame({"key": np.concatenate(key).view(np.int64), "doc_id": np.concatenate(doc),
                                    "pos": np.concatenate(pos)})
        hand_back()

    return docs.mapInPandas(run, "key long, doc_id long, pos int")


#: Rows of ``_compare_sorted``: settled; of a run that may have begun in an earlier partition;
#: alone at the end of a partition; no row but the last run of a partition.
SETTLED, OPENING, ALONE, SUMMARY = range(4)


def _compare_sorted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Members of runs of equal keys in one sorted partition, each with its run's first row.

    Runs of one row are left out, except at the ends of the partition: they may go on in a
    neighbouring one, as may the first and last run, which are marked."""
    run_on = None       # the open run: key, first doc, first pos, rows, opens the partition, last doc, last pos

    def frame(key, doc, pos, first_doc, first_pos, kind) -> pd.DataFrame:
        return pd.DataFrame({"key": key, "doc_id": doc, "pos": pos, "first_doc": first_doc, "first_pos": first_pos,
                             "kind": kind})

    def held(kind: int) -> pd.DataFrame:
        k, fd, fp, _, _, d, p = run_on
        return frame([k], [d], [p], [fd], [fp], [kind])

    for b in batches:
        k, d, p = b["key"].to_numpy(), b["doc_id"].to_numpy(), b["pos"].to_numpy()
        if not len(k):
            continue
        heads = np.flatnonzero(np.append(True, k[1:] != k[:-1]))
        rows = np.diff(np.append(heads, len(k)))
        run = np.repeat(np.arange(len(heads)), rows)
        fd, fp, opens = d[heads], p[heads], np.zeros(len(heads), bool)
        if run_on is None:
            opens[0] = True
        elif run_on[0] == k[0]:
            if run_on[3] == 1:
                yield held(OPENING if run_on[4] else SETTLED)
            fd[0], fp[0], opens[0] = run_on[1], run_on[2], run_on[4]
            rows = rows.copy()
            rows[0] += run_on[3]
        elif run_on[3] == 1 and run_on[4]:
            yield held(OPENING)
        out = (rows > 1) | opens
        if rows[-1] == 1:
            out[-1] = False                    # alone so far: decided with the next row
        at = np.flatnonzero(out[run])
        if len(at):
            r = run[at]
            yield frame(k[at], d[at], p[at], fd[r], fp[r], np.where(opens[r], OPENING, SETTLED))
        run_on = (k[-1], fd[-1], fp[-1], int(rows[-1]), bool(opens[-1]), d[-1], p[-1])
    if run_on is not None:
        if run_on[3] == 1:
            yield held(OPENING if run_on[4] else ALONE)
        elif not run_on[4]:
            yield held(SUMMARY)


def repeated(rows: DataFrame, partitions: int) -> DataFrame:
    """(doc_id, pos, first_doc, first_pos): the members of every class of equal keys with two
    or more members, with the first (document, position) of the class."""
    order = ["key", "doc_id", "pos"]
    near = (rows.repartitionByRange(partitions, *order).sortWithinPartitions(*order)
                .mapInPandas(_compare_sorted, "key long, doc_id long, pos int, first_doc long, first_pos int, kind int")
                .checkpoint())
    # runs at partition bounds: two keys of every partition at most, however many rows a run has
    met = near.filter(F.col("kind") != SETTLED).groupBy("key").agg(
        F.min(F.struct("first_doc", "first_pos")).alias("f"),
        F.sum(F.when(F.col("kind") == SUMMARY, 2).otherwise(1)).alias("n")).filter("n > 1").orderBy("key").collect()
    bounds = rows.sparkSession.sparkContext.broadcast((
        np.array([r["key"] for r in met], np.int64), np.array([r["f"]["first_doc"] for r in met], np.int64),
        np.array([r["f"]["first_pos"] for r in met], np.int32)))

    def settle(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys, docs, places = bounds.value
        for b in batches:
            b = b[b["kind"] != SUMMARY]
            fd, fp = b["first_doc"].to_numpy().copy(), b["first_pos"].to_numpy().copy()
            open_run = (b["kind"] != SETTLED).to_numpy()
            at = np.searchsorted(keys, b["key"].to_numpy())
            met_again = open_run & (at < len(keys))
            met_again[met_again] = keys[at[met_again]] == b["key"].to_numpy()[met_again]
            fd[met_again], fp[met_again] = docs[at[met_again]], places[at[met_again]]
            keep = ~open_run | met_again
            yield pd.DataFrame({"doc_id": b["doc_id"].to_numpy()[keep], "pos": b["pos"].to_numpy()[keep],
                                "first_doc": fd[keep], "first_pos": fp[keep]})

    return near.mapInPandas(settle, "doc_id long, pos int, first_doc long, first_pos int")


def _join_stretches(min_words: int):
    """Sorted (doc_id, pos, first_doc, first_pos) rows -> spans; a document may cross batches."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        open_span = None              # [doc, start, end, set of documents]
        for b in batches:
            out = []
            for d, s, fd, fp in zip(b["doc_id"].tolist(), b["pos"].tolist(), b["first_doc"].tolist(),
                                    b["first_pos"].tolist()):
                # a stretch that overlaps its own first occurrence repeats only what lies behind it
                start = max(s, fp + min_words) if fd == d else s
                if open_span and open_span[0] == d and start <= open_span[2]:
                    open_span[2] = max(open_span[2], s + min_words)
                    open_span[3].add(fd)
                else:
                    if open_span:
                        out.append((*open_span[:3], sorted(open_span[3])))
                    open_span = [d, start, s + min_words, {fd}]
            yield pd.DataFrame(out, columns=["doc_id", "start_word", "end_word", "first_doc_ids"])
        if open_span:
            yield pd.DataFrame([(*open_span[:3], sorted(open_span[3]))],
                               columns=["doc_id", "start_word", "end_word", "first_doc_ids"])
    return run


def repeated_spans(docs: DataFrame, min_words: int = MIN_WORDS, window: int = WINDOW, kmer: int = KMER,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, start_word, end_word, first_doc_ids): the repeated passages, first ones excepted.

    Every stretch of at least ``min_words`` consecutive words (split at spaces and
    \\x09-\\x0D) that occurred before, in a smaller doc_id or earlier in the same document,
    lies in a returned span, and every word of a span lies in such a stretch.
    ``first_doc_ids`` lists the documents of the first occurrences. Spans of one document
    do not overlap. Shorter, empty and null texts have no span; rows with a null id take no
    part; of rows that repeat one id, each distinct text takes part under that id. An empty
    table gives none.
    """
    if not kmer <= min_words - window + 1 <= min_words:
        raise ValueError("window must leave room for a k-mer inside min_words")
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    parts = shuffle_partitions(spark)
    named = docs.filter(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    # whole copies: digest -> first document
    digest = named.select("doc_id", F.sha2("text", 256).alias("digest"),
                          F.length("text").alias("chars")).filter(F.col("chars") >= 2 * min_words - 1)
    classes = digest.groupBy("digest").agg(F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("top"))
    copies = digest.join(classes.filter("top > first_doc"), "digest").filter("doc_id > first_doc").select(
        "doc_id", "first_doc").distinct().checkpoint()

    kept = Stored(_suffixes(named, min_words, window, kmer))
    hits = repeated(kept.df, parts).select("doc_id", "pos")
    by_doc = (hits.join(copies.select("doc_id"), "doc_id", "left_anti").distinct()
                  .groupBy("doc_id").agg(F.collect_list("pos").alias("hits")))      # bounded by one text
    around = Stored(_stretches(named.join(by_doc, "doc_id").select("doc_id", "text", "hits"),
                               min_words, window, kmer))
    kept.drop()
    again = repeated(around.df, parts).filter("doc_id <> first_doc or pos <> first_pos")
    spans = (again.distinct().repartition("doc_id").sortWithinPartitions("doc_id", "pos")
                  .mapInPandas(_join_stretches(min_words),
                               "doc_id long, start_word long, end_word long, first_doc_ids array<long>")
                  .checkpoint())
    around.drop()

    def lengths(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            n = np.fromiter((len(words_of(t)) for t in b["text"]), np.int64, len(b))
            yield pd.DataFrame({"doc_id": b["doc_id"], "start_word": 0, "end_word": n, "first_doc": b["first_doc"]})

    whole = (named.join(copies, "doc_id").mapInPandas(
        lengths, "doc_id long, start_word long, end_word long, first_doc long").filter(F.col("end_word") >= min_words)
        .select("doc_id", "start_word", "end_word", F.array("first_doc").alias("first_doc_ids")))
    return spans.unionByName(whole)


def cut_repeats(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the words of repeated passages but their first occurrences.

    As ``remove_spans(docs, repeated_spans(docs))``, but by row: spans found in one text are
    cut from that text alone, also when other texts share its id. If ids repeat, the texts are
    numbered by id and digest for the search. Rows with a null id pass unchanged.
    """
    i, d, key = unused(docs, "own_id", "digest", "text_key")
    ids = docs.select(F.col(id_col).cast("long").alias(i)).filter(F.col(i).isNotNull())
    if ids.groupBy(i).count().filter("count > 1").isEmpty():
        return remove_spans(docs, repeated_spans(docs, min_words, id_col=id_col, text_col=text_col), id_col, text_col)
    named = docs.select(F.col(id_col).cast("long").alias(i), F.sha2(F.col(text_col).cast("string"), 256).alias(d)).filter(
        F.col(i).isNotNull() & F.col(d).isNotNull())
    numbered = Stored(dense_key(named.distinct(), [i, d], key)).df
    own = docs.withColumn(d, F.sha2(F.col(text_col).cast("string"), 256)).withColumn(i, F.col(id_col).cast("long"))
    keyed = own.join(numbered, [i, d], "left").select(*[F.col(f"`{c}`") for c in docs.columns], key)
    cut = remove_spans(keyed, repeated_spans(keyed, min_words, id_col=key, text_col=text_col), key, text_col)
    return cut.select(*docs.columns)


def remove_spans(docs: DataFrame, spans: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the words of its spans; a document left without a word goes.

    The characters from a span's first word up to the next kept word (or the end of the
    text) are cut; everything else stays as it is. Rows with a null id or without spans pass
    unchanged.
    """
    whose, begins, ends = unused(docs, "_span_doc", "_from", "_to")
    cuts = (spans.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("start_word", "end_word"))).alias("c"))
                 .select(F.col("doc_id").alias(whose), F.col("c.start_word").alias(begins),
                         F.col("c.end_word").alias(ends)))

    def cut(texts: pd.Series, froms: pd.Series, tos: pd.Series) -> pd.Series:
        word = re.compile(rb"[^\x20\x09-\x0D]+")
        out = []
        for text, begin, end in zip(texts, froms, tos):
            if begin is None or text is None:
                out.append(text)
                continue
            raw = text.encode("utf-8", "surrogatepass")
            starts = [m.start() for m in word.finditer(raw)] + [len(raw)]
            kept, at = [], 0
            for s, e in zip(begin, end):
                s, e = min(s, len(starts) - 1), min(e, len(starts) - 1)
                kept.append(raw[at:max(at, starts[s])])
                at = max(at, starts[e])
            kept.append(raw[at:])
            out.append(b"".join(kept).decode("utf-8", "surrogatepass"))
        return pd.Series(out, dtype=object)

    cutter = F.pandas_udf(cut, "string")
    joined = docs.join(cuts, F.col(id_col) == F.col(whose), "left")
    done = joined.withColumn(text_col, F.when(
        F.col(begins).isNotNull(), cutter(F.col(text_col).cast("string"), begins, ends)).otherwise(F.col(text_col)))
    kept = F.col(begins).isNull() | F.col(text_col).rlike(r"[^\x20\x09-\x0D]")
    return done.filter(kept).select(*docs.columns)
