"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts are sums per (language, bucket), made in Arrow batches and added up by a
shuffle. The log-probability matrix is languages x buckets (its size does not depend on
the corpus) and is broadcast; scoring gathers its rows for the n-grams of a whole batch of
texts at once and adds them up per text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmart.llm.common import hand_back, id_and_text, null_ids, worker_cache

UNKNOWN = "und"
BATCH_CHARS = 1 << 18


def _folding() -> np.ndarray:
    """Code point -> lower-case code point of a letter, 0 for everything else."""
    fold = np.zeros(0x110000, np.uint32)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            low = c.lower()
            fold[i] = ord(low) if len(low) == 1 else i
    return fold


def _grams(texts: list[str], orders: tuple[int, ...], buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket of every n-gram, index of its text, letters per text).

    Runs of other characters than letters count as one blank; n-grams do not cross texts."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    codes = worker_cache("letters", _folding)[np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)]
    owner = np.repeat(np.arange(len(texts)), sizes)
    letter = codes != 0
    letters = np.bincount(owner[letter], minlength=len(texts))
    keep = letter.copy()
    keep[1:] |= letter[:-1]                      # of a run of blanks, the first one
    codes, owner = codes[keep], owner[keep]
    out, who = [], []
    mixed = np.uint64(0x9E3779B97F4A7C15)
    for n in orders:
        if len(codes) < n:
            continue
        m = len(codes) - n + 1
        h = np.full(m, n, np.uint64)
        for j in range(n):
            h = (h ^ codes[j:j + m]) * mixed
            h ^= h >> np.uint64(29)
        whole = owner[:m] == owner[n - 1:]
        if n == 1:
            whole &= codes != 0
        out.append((h[whole] % np.uint64(buckets)).astype(np.int64))
        who.append(owner[:m][whole])
    if not out:
        return np.empty(0, np.int64), np.empty(0, np.int64), letters
    return np.concatenate(out), np.concatenate(who), letters


def _pieces(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Consecutive runs of texts of about BATCH_CHARS (a longer text is a run of its own)."""
    at, held = 0, 0
    for i, t in enumerate(texts):
        if held and held + len(t) > BATCH_CHARS:
            yield at, i
            at, held = i, 0
        held += len(t)
    if at < len(texts):
        yield at, len(texts)


@dataclass(frozen=True)
class LanguageModel:
    """Languages in sorted order and a (buckets, languages) matrix of log probabilities."""
    languages: tuple[str, ...]
    prior: np.ndarray
    logp: np.ndarray
    orders: tuple[int, ...]

    def scores(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(joint log probabilities, letters) of each text."""
        total = np.tile(self.prior, (len(texts), 1))
        letters = np.zeros(len(texts), np.int64)
        for s, e in _pieces(texts):
            h, who, letters[s:e] = _grams(texts[s:e], self.orders, len(self.logp))
            for k in range(len(self.languages)):
                total[s:e, k] += np.bincount(who, self.logp[h, k], minlength=e - s)
        return total, letters


def fit(docs: DataFrame, train: Column, text_col: str = "text", lang_col: str = "lang",
        orders: tuple[int, ...] = (1, 2, 3), buckets: int = 1 << 15, alpha: float = 0.5,
        max_languages: int = 512) -> LanguageModel:
    """Fit on every row that satisfies ``train`` and has a text and a language.

    The model has one column per distinct language; a label set of more than
    ``max_languages`` is refused with a ValueError, so that the matrix stays bounded.
    No such row: a model without languages, which answers ``und``.
    """
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}
        rows: dict[str, int] = {}
        for b in batches:
            for lang, part in b.groupby("lang", sort=False)["text"]:
                texts = part.tolist()
                into = sums.setdefault(lang, np.zeros(buckets, np.int64))
                rows[lang] = rows.get(lang, 0) + len(texts)
                for s, e in _pieces(texts):
                    into += np.bincount(_grams(texts[s:e], orders, buckets)[0], minlength=buckets)
        hand_back()
        for lang, into in sums.items():
            at = np.flatnonzero(into)
            yield pd.DataFrame({"lang": lang, "bucket": np.append(at, -1), "n": np.append(into[at], rows[lang])})

    labelled = docs.filter(train & F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()).select(
        F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    per_task = labelled.mapInPandas(count, "lang string, bucket int, n long")
    summed = per_task.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    found = (summed.groupBy("lang").agg(F.collect_list(F.struct("bucket", "n")).alias("counts"))
                   .orderBy("lang").limit(max_languages + 1).collect())      # buckets + 1 pairs a language
    if len(found) > max_languages:
        raise ValueError(f"more than {max_languages} languages")
    k = len(found)
    counts, priors = np.zeros((buckets, k)), np.zeros(k)
    for i, r in enumerate(found):
        pairs = np.array([(c["bucket"], c["n"]) for c in r["counts"]], np.int64)
        own = pairs[:, 0] >= 0
        counts[pairs[own, 0], i] = pairs[own, 1]
        priors[i] = pairs[~own, 1].sum()
    logp = np.log(counts + alpha) - np.log(counts.sum(axis=0) + alpha * buckets)
    prior = np.log(priors / priors.sum()) if k else priors
    return LanguageModel(tuple(r["lang"] for r in found), prior, logp, orders)


def predict(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score), one row per row of ``docs``.

    ``score`` is the posterior probability of the predicted language over the whole text. A
    null text, a text without a letter and a model without languages give ``und`` with score
    0. Equal posteriors go to the language that sorts first. Repeated rows are scored alike,
    null ids are kept, other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for b in batches:
            texts = [t if t is not None else "" for t in b["text"]]
            total, letters = m.scores(texts)
            out = b.drop(columns="text")
            if m.languages:
                best = total.argmax(axis=1)
                top = total[np.arange(len(b)), best]
                prob = 1.0 / np.exp(total - top[:, None]).sum(axis=1)
                named = np.array(m.languages, object)[best]
            else:
                prob, named = np.zeros(len(b)), np.full(len(b), UNKNOWN, object)
            out["lang_pred"] = np.where(letters > 0, named, UNKNOWN)
            out["score"] = np.where(letters > 0, prob, 0.0)
            yield out

    return null_ids(id_and_text(docs, id_col, text_col).mapInPandas(
        score, "doc_id long, no_id boolean, lang_pred string, score double"))


def id_remainder(id_col: str = "doc_id", modulus: int = 4) -> Column:
    """crc32 of the id's text, modulo ``modulus``; null for a null id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % modulus


def keep_known(docs: DataFrame, model: LanguageModel, min_score: float, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose language is known with at least ``min_score``.

    Rejected are null texts, texts without a letter and texts whose best posterior is lower.
    The decision is made row by row, so repeated rows and null ids need no join."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def known(texts: pd.Series) -> pd.Series:
        m = shared.value
        total, letters = m.scores([t if t is not None else "" for t in texts])
        if not m.languages:
            return pd.Series(np.zeros(len(texts), bool))
        prob = 1.0 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
        return pd.Series((letters > 0) & (prob >= min_score))

    return docs.filter(F.pandas_udf(known, "boolean")(F.col(text_col).cast("string")))
