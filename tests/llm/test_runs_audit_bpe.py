"""Periodic runs, the filter audit and the BPE codec against brute force."""

import hashlib
import itertools
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest

from shelfmart.llm import bpe_codec, filter_audit, periodic_runs, queries

SF = "/root/testdata/sf0.001"
WORDS = re.compile(r"[^\x20\x09-\x0D]+").findall
CLASHING = "doc_id long, text string, lang string, start int, runs string, ids string, mask int, n string, part string"


def _sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def _frame(spark, rows):
    """Rows of (doc_id, text, lang) beside columns that share names with inner ones."""
    return spark.createDataFrame([(i, t, lang, 1, "x", "y", 2, "z", "p") for i, t, lang in rows], CLASHING)


# ---- periodic runs ------------------------------------------------------------------------------

def plain_runs(w, min_words, exponent):
    """Every maximal stretch of every period, by direct comparison."""
    found = {}
    for q in range(1, len(w) // exponent + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(min_words, exponent * q):
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def plain_collapse(w, runs):
    gone = {k for s, n, q in runs for k in range(s + q, s + n)}
    return " ".join(x for k, x in enumerate(w) if k not in gone)


def random_words(r):
    kind, n = r.randrange(5), r.randrange(120)
    if kind == 0:
        return [r.choice("abcdefghijklmnopqrstuvwxyz"[:r.choice([1, 2, 3, 26])]) for _ in range(n)]
    if kind == 1:
        return ([r.choice("abc") for _ in range(r.randrange(9))] + [r.choice("abc") for _ in range(r.randint(1, 12))]
                * r.randint(1, 14) + [r.choice("abc") for _ in range(r.randrange(9))])
    if kind == 2:                                        # Fibonacci words
        a, b = ["a"], ["a", "b"]
        for _ in range(r.randrange(9)):
            a, b = b, b + a
        return b
    if kind == 3:                                        # runs inside runs
        p = [r.choice("ab") for _ in range(r.randint(1, 4))]
        return (p * r.randint(1, 4) + ["c"]) * r.randint(1, 10) + p * r.randint(1, 10)
    return ["a"] * n


def test_runs_equal_direct_comparison():
    r = random.Random(5)
    for _ in range(150):
        docs = [random_words(r) for _ in range(r.randint(1, 10))]
        least, exponent = r.choice([(24, 3), (2, 2), (6, 3), (1, 2), (10, 4)])
        for w, (runs, kept) in zip(docs, periodic_runs.analyse(docs, least, exponent)):
            want = plain_runs(w, least, exponent)
            assert [(x["start"], x["length"], x["period"]) for x in runs] == want, (least, exponent, w)
            assert kept == plain_collapse(w, want)


def test_grammar_extensions():
    r = np.random.default_rng(2)
    for size, kinds in ((1, 1), (50, 1), (400, 2), (3000, 3)):
        w = np.append(r.integers(0, kinds, size), kinds)
        g = periodic_runs.Grammar(w, kinds)
        a, b = r.integers(0, size + 1, 200), r.integers(0, size + 1, 200)
        a, b = a[a != b], b[a != b]
        for back in (False, True):
            got = g.extend(a, b, backwards=back).tolist()
            for x, y, n in zip(a.tolist(), b.tolist(), got):
                k = 0
                while (min(x, y) - k > 0 and w[x - k - 1] == w[y - k - 1]) if back else (
                        max(x, y) + k < len(w) and w[x + k] == w[y + k]):
                    k += 1
                assert k == n


def plain_digest(i, text):
    w = WORDS(text or "")
    n, h = len(w), None if i is None else zlib.crc32(str(i).encode())
    if h is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = w[:a] + [w[a + (k - a) % p] for k in range(a, n)]
    runs = plain_runs(w, 24, 3)
    best = min(runs, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]), default=(None, None, None))
    return (i, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            _sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), _sha(plain_collapse(w, runs)))


ODD_TEXTS = [(None, "x y " * 40), (5, None), (6, ""), (7, " \t\n"), (8, "a b c " * 30), (8, "a b c " * 30),
             (2**60 + 1, "ä b c\x0b" * 60), (9, "w " * 200_000 + "end"), (10, "a " * 23), (11, "a " * 24)]


def test_runs_query_equals_brute_force(spark):
    key = lambda t: tuple((x is None, str(x)) for x in t)
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = sorted(map(tuple, queries.op11_periodic_runs(spark, SF).collect()), key=key)
    assert got == sorted((plain_digest(*d) for d in docs), key=key)
    df = _frame(spark, [(i, t, "en") for i, t in ODD_TEXTS])
    out = periodic_runs.digest(periodic_runs.runs(periodic_runs.plant(df)))
    assert out.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256",
                           "collapsed_sha256"]
    want = [plain_digest(i, t) for i, t in ODD_TEXTS if i != 9]
    got = [tuple(r) for r in out.collect()]
    assert sorted((g for g in got if g[0] != 9), key=key) == sorted(want, key=key)
    assert [g[1:6] for g in got if g[0] == 9] == [(1, 0, 200_000, 1, 200_000_000)]
    assert out.filter("n_runs = 0 and (start is not null or runs_sha256 is null)").isEmpty()
    assert periodic_runs.digest(periodic_runs.runs(periodic_runs.plant(df.limit(0)))).isEmpty()
    with pytest.raises(ValueError):
        periodic_runs.runs(df, min_exponent=1)


# ---- filter audit --------------------------------------------------------------------------------

def plain_mask(text):
    w = WORDS(text)
    return [len(w) < 100, 100 * len(set(w)) < 80 * len(w), 100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
            re.search(r"[#$%&*|]", text) is not None]


def plain_audit(rows, labels):
    least, out = {}, {}
    for i, t, _ in rows:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    bad = {i for i, _, t in labels if t == 1 and i is not None}
    for i, t, lang in rows:
        fails = plain_mask(t or "") + [i is not None and i > least[t or ""]]
        letters = [c for c, f in zip("ABCDE", fails) if f]
        for p in itertools.permutations("ABCDE"):
            first = min((p.index(c) for c in letters), default=9)
            for k, c in enumerate(p):
                row = out.setdefault((lang or "", "".join(p), k + 1), [0] * 7)
                here = k == first
                for n, add in enumerate((first > k, here, c in letters and first < k, letters == [c],
                                         here and i in good, here and i in bad)):
                    row[n] += add
    for (part, order, step), row in out.items():
        row[6] = sum(out[part, "".join(p), p.index(order[step - 1]) + 1][1] for p in itertools.permutations("ABCDE"))
    return sorted((*k, *v) for k, v in out.items())


def test_audit_equals_brute_force(spark):
    r = random.Random(3)
    words = lambda n, m: " ".join(r.choice("abcdefghijkl") * r.randint(1, m) for _ in range(n))
    long = "shared start of many texts " * 40
    rows = [(None, "same", "en"), (None, "same", "en"), (3, "same", "en"), (1, "same", "de"), (1, "same", None), (1, "same", "de"),
            (2, None, "en"), (4, "", ""), (5, "A" * 10, "en"), (6, "A" + "b" * 9, "en"), (2**60 + 1, "ÄÖ é 漢" * 50, "fr")]
    rows += [(100 + k, long + words(4, 9), "en") for k in range(40)] + [(200 + k, long, "fr") for k in range(30)]
    rows += [(300 + k, words(r.choice([99, 100, 101, 130]), 40) + r.choice(["", " $", " X"]), "de") for k in range(40)]
    rows += [(400, "word " * 100_000, "en"), (401, "word " * 100_000, "en")]
    labels = [(k, r.choice([0, 1, None]), r.choice([0, 1, None])) for k in list(range(1, 7)) + list(range(100, 340))] + [
        (1, 1, 0), (3, 1, 1), (3, 1, 1), (None, 1, 1)]
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    df = _frame(spark, rows).repartition(3)
    want = plain_audit(rows, labels)
    for size in (filter_audit.PARTITION_BYTES, 500):
        masks = filter_audit.filter_masks(df, partition_bytes=size)
        got = filter_audit.interactions(masks, table)
        assert got.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails",
                               "good_lost", "toxic_lost", "shapley"]
        assert sorted(map(tuple, got.collect())) == want
    assert filter_audit.interactions(filter_audit.filter_masks(df.limit(0)), table).isEmpty()
    none = filter_audit.interactions(filter_audit.filter_masks(df), table.limit(0))
    assert none.filter("good_lost + toxic_lost > 0").isEmpty() and none.count() == len(want)


def test_trie_holds_least_ids():
    r = random.Random(1)
    texts = [bytes(r.choice(b"ab") for _ in range(r.randrange(12))) * r.choice([1, 1, 9]) for _ in range(600)]
    trie, least = filter_audit.RadixTrie(), {}
    ends = [trie.insert(t, -k) for k, t in enumerate(texts)]
    for k, t in enumerate(texts):
        least[t] = -k
    assert [n.least for n in ends] == [least[t] for t in texts]


def test_map_side_tries_decide_copies_across_batches(monkeypatch):
    """A task forwards one row of a text that recurs in every batch, also when its trie is renewed."""
    monkeypatch.setattr(filter_audit, "TRIE_BYTES", 100)
    batch = lambda at: pa.RecordBatch.from_arrays(
        [pa.array(range(at, at + 6)), pa.array(["en"] * 6), pa.array([b"hot text"] * 3 + [b"own %d" % k * 9 for k in range(at, at + 3)])],
        names=["doc_id", "part", "text"])
    out = [r for b in filter_audit._filter_rows(iter([batch(10 * k) for k in range(20)])) for r in b.to_pylist()]
    assert sum(r["n"] for r in out) == 120
    assert [r["doc_id"] for r in out if r["text"] == b"hot text"] == [0]


def test_prefix_keys_deepen_where_heavy(spark):
    texts = ["p" * 40 + str(k) * 9 for k in range(9)] + ["q" + str(k) * 30 for k in range(9)]
    df = spark.createDataFrame([(t.encode(),) for t in texts], "text binary")
    out = df.select("text", filter_audit.prefix_key(df, "text", 200).alias("k")).collect()
    assert {len(r["k"]) for r in out if bytes(r["text"])[:1] == b"q"} == {16}
    assert {len(r["k"]) for r in out if bytes(r["text"])[:1] == b"p"} == {49}
    assert all(bytes(r["text"]).startswith(bytes(r["k"])) for r in out)


# ---- BPE -------------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(bpe_codec.default_tokenizer())
    t.no_padding()
    t.no_truncation()
    return t


@pytest.fixture(scope="module")
def codec():
    with open(bpe_codec.default_tokenizer(), encoding="utf-8") as f:
        return bpe_codec.Codec(f.read())


def _ids(codec, texts):
    return [np.frombuffer(x, "<i4").tolist() for x in codec.encode(texts)]


def test_bpe_equals_the_library(codec, library):
    r = random.Random(4)
    bits = ["a", "b", "aa", " ", "  ", "\n", "'s", "'", "é", "the", "er", "in", "1", "22", "<|endoftext|>", "<|end", "\t", "-",
            "===", "ing", "ß", "漢", "🙂", "\x1c", "\x85", "　", "_", "²", "\x00", "İ", "ا"]
    texts = ["".join(r.choice(bits) for _ in range(r.randrange(25))) for _ in range(4000)]
    texts += [library.decode([r.randrange(50257) for _ in range(5)], skip_special_tokens=False) for _ in range(4000)]
    texts += ["a" * 5000, "-" * 999, " " * 5000 + "x", "\n" * 3000, "ab" * 4000, "xyz" * 100_000, "the" * 2000, ""]
    texts += [f"a{chr(c)}1 {chr(c)}{chr(c)} b" for c in range(1, 0x3100)]
    assert _ids(codec, texts) == [library.encode(t, add_special_tokens=False).ids for t in texts]
    some = r.sample(texts, 1500)
    assert [codec.decode(x) for x in _ids(codec, some)] == some


def test_bpe_caches_only_forget(library, monkeypatch):
    texts = ["the cat sat on another mat, unbelievably", "tokenisation of unseen strings", "the cat"] * 3
    for name in ("CACHE_WORDS", "CACHE_PAIRS", "LONG_WORD"):
        monkeypatch.setattr(bpe_codec, name, 3)
        with open(bpe_codec.default_tokenizer(), encoding="utf-8") as f:
            codec = bpe_codec.Codec(f.read())
        codec.known.update(dict.fromkeys(map(str, range(9)), b""))
        assert [x for t in texts for x in _ids(codec, [t])] == [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert _ids(codec, texts) == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_bpe_query_and_odd_rows(spark, library):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in queries.op13_bpe_codec(spark, SF).collect():
        ids = library.encode(docs[r["doc_id"]], add_special_tokens=False).ids
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), _sha(",".join(map(str, ids))))
        assert r["decoded_sha256"] == _sha(library.decode(ids, skip_special_tokens=False))
    path = bpe_codec.default_tokenizer()
    df = _frame(spark, [(i, t, "en") for i, t in ODD_TEXTS])
    out = bpe_codec.decode(bpe_codec.encode(df, path), path)
    assert out.columns == ["doc_id", "ids", "text"]
    got = sorted(((r["doc_id"], list(r["ids"]), r["text"]) for r in out.collect()), key=str)
    want = sorted(((i, library.encode(t or "", add_special_tokens=False).ids, t or "") for i, t in ODD_TEXTS), key=str)
    assert got == want
    assert bpe_codec.digest(bpe_codec.decode(bpe_codec.encode(df.limit(0), path), path)).isEmpty()
    rows = spark.createDataFrame([(1, [0, None, 99999999]), (None, None), (2, [188, 50256])], "doc_id long, ids array<int>")
    assert [(r["doc_id"], r["text"]) for r in bpe_codec.decode(rows, path).collect()] == [
        (1, "!"), (None, ""), (2, library.decode([188, 50256], skip_special_tokens=False))]


def test_bpe_refuses_other_files():
    with pytest.raises(ValueError):
        bpe_codec.Codec('{"model": {"type": "Unigram"}, "pre_tokenizer": {"type": "ByteLevel"}, "normalizer": null}')
