"""Toxicity by a chain of linear classifiers.

The categories are predicted in order; each model sees the words and the shape of a text
and the probabilities of the categories before it. In training those probabilities come
from models that did not see the row (out-of-fold), so a later model learns how far an
earlier one can be trusted on new text.

A model is a ridge logistic regression on the features that tell its classes apart best.
The models of a category (one per fold, and the one that is kept) are fitted side by side,
each on a bounded sample of labelled rows; scoring is one pass over all documents where
they are read.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmart.llm.common import Stored, id_and_text, null_ids

BUCKETS = 1 << 20
STEM_LENGTHS = (4, 5)
FOLDS = 3
MAX_TRAIN_ROWS = 12_000
KEPT_FEATURES = 1024
RIDGE = 1.0
STEPS = 12
CACHE_WORDS = 100_000
SHAPES = 6
_WORD, _UPPER, _DIGIT = re.compile(r"[^\W\d_]+"), re.compile(r"[A-ZÀ-ÖØ-Þ]"), re.compile(r"\d")


class WordFeatures(dict):
    """Word -> hashed ids of the word and of its first letters, which stand for its stem.

    With ``kept``, only ids among these: most words then have none."""

    def __init__(self, kept: frozenset[int] | None = None):
        super().__init__()
        self.kept = kept

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= CACHE_WORDS:
            self.clear()
        names = [word] + [f"{n}^{word[:n]}" for n in STEM_LENGTHS if len(word) > n]
        ids = tuple(xxhash.xxh64_intdigest(n.encode("utf-8", "surrogatepass"), 5) % BUCKETS for n in names)
        if self.kept is not None:
            ids = tuple(i for i in ids if i in self.kept)
        self[word] = ids
        return ids


def features(text: str | None, known: WordFeatures) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct feature ids, shape of the text)."""
    text = text or ""
    words = _WORD.findall(text.lower())
    distinct = set(words)
    ids = set().union(*filter(None, map(known.__getitem__, distinct)))
    n = max(len(text), 1)
    letters = sum(map(len, words))
    shape = np.array([np.log1p(len(words)), letters / n, len(_UPPER.findall(text)) / n, len(_DIGIT.findall(text)) / n,
                      len(distinct) / max(len(words), 1), letters / max(len(words), 1) / 10.0])
    return np.array(sorted(ids), np.int32), shape


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))


@dataclass(frozen=True)
class Link:
    """One category: weights of kept features, shapes and earlier probabilities, or a constant."""
    category: str
    constant: float | None
    ids: np.ndarray
    weights: np.ndarray           # of ids, then shapes, then earlier categories, then 1

    def probability(self, ids: np.ndarray, shape: np.ndarray, before: list[float]) -> float | None:
        if not len(self.weights):
            return self.constant
        place = np.searchsorted(self.ids, ids)
        inside = place < len(self.ids)
        place = place[inside][self.ids[place[inside]] == ids[inside]]
        dense = np.concatenate([shape, before, [1.0]])
        x = self.weights[place].sum() + float(dense @ self.weights[len(self.ids):])
        return float(_sigmoid(np.array(x)))


def _fit(category: str, rows: list[np.ndarray], dense: np.ndarray, y: np.ndarray) -> Link:
    """Newton steps on the KEPT_FEATURES ids with the largest difference between the classes."""
    none = np.empty(0)
    if len(y) == 0 or y.min() == y.max():
        return Link(category, float(y[0]) if len(y) else None, none.astype(np.int32), none)
    ids = np.concatenate(rows) if len(rows) else none.astype(np.int32)
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    n1, n0 = y.sum(), len(y) - y.sum()
    seen1 = np.bincount(ids, weights=y[owner], minlength=BUCKETS)
    seen = np.bincount(ids, minlength=BUCKETS)
    p1, p0, p = seen1 / n1, (seen - seen1) / n0, seen / len(y)
    z = np.abs(p1 - p0) / np.sqrt(np.maximum(p * (1 - p), 1e-12) * (1 / n1 + 1 / n0))
    z[seen < 3] = 0
    kept = np.sort(np.argsort(-z, kind="stable")[:KEPT_FEATURES])
    kept = kept[z[kept] > 0].astype(np.int32)
    x = np.zeros((len(y), len(kept) + dense.shape[1]), np.float32)
    place = np.searchsorted(kept, ids)
    ours = (place < len(kept)) & (kept[np.minimum(place, max(len(kept) - 1, 0))] == ids) if len(kept) else place < 0
    x[owner[ours], place[ours]] = 1.0
    x[:, len(kept):] = dense
    weight = np.where(y == 1, len(y) / (2 * n1), len(y) / (2 * n0)).astype(np.float32)   # classes count the same
    penalty = np.full(x.shape[1], RIDGE)
    penalty[-1] = 1e-6                                                                   # the constant
    w = np.zeros(x.shape[1])
    for _ in range(STEPS):
        q = _sigmoid(x @ w.astype(np.float32)).astype(np.float64)
        slope = x.T @ (weight * (q - y)).astype(np.float32) + penalty * w
        curve = np.maximum(weight * q * (1 - q), 1e-6).astype(np.float32)
        hess = (x * curve[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(hess.astype(np.float64), slope.astype(np.float64))
        w -= step
        if np.abs(step).max() < 1e-4:
            break
    return Link(category, None, kept, w)


def _trainer(category: str) -> Callable[[tuple, pd.DataFrame], pd.DataFrame]:
    return lambda key, g: _train(category, key, g)


def _train(category: str, key: tuple, g: pd.DataFrame) -> pd.DataFrame:
    """Model ``key`` of a category: -1 is fitted on all rows and kept, fold f leaves f out and predicts it."""
    model = int(key[0])
    g = g.sort_values("doc_id")
    rows = [np.frombuffer(b, np.int32) for b in g["ids"]]
    dense = np.stack([np.append(np.frombuffer(s, np.float64), 1.0) for s in g["dense"]])
    y, fold = g["y"].to_numpy(np.float64), g["fold"].to_numpy()
    train = np.flatnonzero(fold != model)
    link = _fit(category, [rows[i] for i in train], dense[train], y[train])
    if model < 0:
        return pd.DataFrame({"doc_id": [0], "p": [0.0], "model": [pickle.dumps(link)]})
    test = np.flatnonzero(fold == model)
    p = [link.probability(rows[i], dense[i][:SHAPES], dense[i][SHAPES:-1].tolist()) for i in test]
    return pd.DataFrame({"doc_id": g["doc_id"].to_numpy()[test], "p": [0.0 if v is None else v for v in p],
                         "model": None})


def _with_value(values: str, value: str) -> Column:
    """The float64 bytes of one more value behind those of ``values``."""
    def add(v: pd.Series, x: pd.Series) -> pd.Series:
        return pd.Series([a + np.float64(b).tobytes() for a, b in zip(v, x)], dtype=object)

    return F.pandas_udf(add, "binary")(values, value)


def fit_chain(docs: DataFrame, labels: DataFrame, categories: list[str], id_col: str = "doc_id",
              text_col: str = "text", label_id: str = "doc_id", max_rows: int = MAX_TRAIN_ROWS) -> list[Link]:
    """Fit the chain on a sample of about ``max_rows`` labelled rows at most, drawn by a hash of the id.

    Rows with a null id or a null category are left out; of several labels for one id the
    largest counts. A category with one value only is that constant; without labelled rows
    every category is unknown.
    """
    known = labels.dropna(subset=[label_id, *categories]).groupBy(F.col(label_id).cast("long").alias("doc_id")).agg(
        *[F.max(F.col(c).cast("int")).alias(f"y{k}") for k, c in enumerate(categories)])
    n = known.count()
    if not n:
        return [Link(c, None, np.empty(0, np.int32), np.empty(0)) for c in categories]
    buckets = 1 << 20
    drawn = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(buckets)) < int(min(1.0, max_rows / n) * buckets)
    sample = known.filter(drawn)                                          # bounded by max_rows

    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = WordFeatures()
        for b in batches:
            both = [features(t, known) for t in b["text"]]
            yield pd.DataFrame({**{c: b[c] for c in b.columns if c != "text"}, "ids": [i.tobytes() for i, _ in both],
                                "dense": [s.tobytes() for _, s in both]})

    ys = [f"y{k}" for k in range(len(categories))]
    texts = id_and_text(docs, id_col, text_col).filter("not no_id").select("doc_id", "text").join(
        F.broadcast(sample), "doc_id")
    stored = Stored(texts.mapInPandas(extract, "doc_id long, " + "".join(f"{y} int, " for y in ys)
                                      + "ids binary, dense binary"))
    rows = stored.df.withColumn("fold", F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(FOLDS)).cast("int"))
    chain = []
    for k, category in enumerate(categories):
        last = k + 1 == len(categories)
        models = F.array(*[F.lit(m) for m in ([-1] if last else [-1, *range(FOLDS)])])
        out = (rows.select("doc_id", "fold", "ids", "dense", F.col(ys[k]).alias("y"), F.explode(models).alias("m"))
               .groupBy("m").applyInPandas(_trainer(category), "doc_id long, p double, model binary").checkpoint())
        chain.append(pickle.loads(out.filter("model is not null").first()["model"]))
        if not last:
            oof = out.filter("model is null").groupBy("doc_id").agg(F.max("p").alias("p"))
            rows = rows.join(oof, "doc_id").withColumn("dense", _with_value("dense", "p")).drop("p")
    return chain


def score(docs: DataFrame, chain: list[Link], threshold: float = 0.5, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """(doc_id, one probability per category, flags), one row per row of ``docs``.

    ``flags`` lists the categories with a probability of at least ``threshold``, in chain
    order. A text without a letter (null, empty) has probability 0 everywhere; an unknown
    category has null and no flag. Null ids and repeated rows are scored like any other,
    other columns are ignored. An empty table gives none.
    """
    shared = docs.sparkSession.sparkContext.broadcast(chain)      # KEPT_FEATURES weights a category

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        links = shared.value
        known = WordFeatures(frozenset(i for link in links for i in link.ids.tolist()))
        for b in batches:
            out = np.full((len(b), len(links)), np.nan)
            for r, text in enumerate(b["text"]):
                ids, shape = features(text, known)
                before: list[float] = []
                for k, link in enumerate(links):
                    p = link.probability(ids, shape, before)
                    if p is not None:
                        before.append(p)
                        out[r, k] = p if shape[1] else 0.0
            yield pd.DataFrame({"doc_id": b["doc_id"], "no_id": b["no_id"],
                                **{f"p{k}": out[:, k] for k in range(len(links))}})

    schema = "doc_id long, no_id boolean" + "".join(f", p{k} double" for k in range(len(chain)))
    scored = null_ids(id_and_text(docs, id_col, text_col).mapInPandas(run, schema))
    probs = [(c.category, F.nanvl(f"p{k}", F.lit(None).cast("double"))) for k, c in enumerate(chain)]
    flags = F.filter(F.array(*[F.when(p >= threshold, F.lit(c)) for c, p in probs]), lambda x: x.isNotNull())
    return scored.select("doc_id", *[p.alias(c) for c, p in probs], flags.alias("flags"))
