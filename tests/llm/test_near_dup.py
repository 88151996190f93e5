"""SimHash, suffix-array and embedding near-duplicates against brute force."""

import re
from collections import defaultdict

import numpy as np
import xxhash

from shelfmart.llm import components, embedding_lsh, simhash, suffix_dedup

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, fp long, node string, _from int"


def _labels(ids, linked):
    """Smallest id reachable, by repeated relabelling."""
    label = {i: i for i in ids}
    while True:
        new = {i: min([label[i]] + [label[j] for j in linked[i]]) for i in ids}
        if new == label:
            return label
        label = new


def test_components_chain_star_and_noise(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(7, 7), (None, 3), (200, 201),
                                                                                       (201, 200), (100, 101)]
    got = dict(tuple(r) for r in components.connected_components(
        spark.createDataFrame(pairs, "a long, b long")).select("node", "component").collect())
    want = {i: 0 for i in range(41)} | {100 + i: 100 for i in range(60)} | {200: 200, 201: 200}
    assert got == want
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).isEmpty()


def _slow_fingerprint(text, k):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    shingles = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes)) if hashes else 0


def test_simhash_equals_brute_force(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    rows += [(9001, None), (9002, ""), (9003, " \t\n"), (9004, "Ünï cöde WORDS"), (9004, "Ünï cöde WORDS"),
             (None, "lone text without an id"), (9005, "word " * 30000)]
    df = spark.createDataFrame([(i, t, 1, "x", 2) for i, t in rows], DOCS)
    got = simhash.near_duplicates(df, 4, 4, tile_rows=64).collect()
    assert len(got) == len(rows)
    fps = {i: _slow_fingerprint(t, 4) for i, t in rows if i is not None and i != 9005}
    for r in got:
        if r["doc_id"] in fps:
            assert r["fingerprint"] == format(fps[r["doc_id"]], "016x")
    fps[9005] = int(next(r["fingerprint"] for r in got if r["doc_id"] == 9005), 16)
    linked = {i: [j for j in fps if (fps[i] ^ fps[j]).bit_count() <= 4] for i in fps}
    want = _labels(list(fps), linked)
    assert {r["doc_id"]: r["component_id"] for r in got if r["doc_id"] is not None} == want
    alone = [r for r in got if r["doc_id"] is None]
    assert len(alone) == 1 and alone[0]["component_id"] is None
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted(set(want.values())) and ids.count(None) == 1


def test_simhash_signed_hash_matches_sql_function(spark):
    row = spark.sql("SELECT xxhash64('a b c d') AS h").first()
    assert simhash.fingerprint("A b\tc d", 4) == row["h"] % (1 << 64)


def test_tile_forest_connects_exactly_the_near_pairs():
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    flips = [np.uint64(sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 4), replace=False))) for _ in range(900)]
    x = np.unique(np.array([base[i % 40] ^ f for i, f in enumerate(flips)], np.uint64))
    cut = len(x) // 3
    for a, b in ((x, None), (x[:cut], x[cut:])):
        p, q = simhash.tile_forest(a, b, 4)
        assert (np.bitwise_count(p ^ q) <= 4).all()
        left = a if b is None else a
        right = a if b is None else b
        near = [(s, t) for s in left.tolist() for t in right.tolist() if s != t and (s ^ t).bit_count() <= 4]
        linked, ours = defaultdict(list), defaultdict(list)
        for pairs, into in ((near, linked), (zip(p.tolist(), q.tolist()), ours)):
            for s, t in pairs:
                into[s].append(t)
                into[t].append(s)
        assert _labels(x.tolist(), linked) == _labels(x.tolist(), ours)


def test_simhash_empty_table(spark):
    df = spark.createDataFrame([], DOCS)
    assert simhash.near_duplicates(df).isEmpty() and simhash.keep_one(df).isEmpty()


def _covered(rows, size):
    """doc -> word positions that lie in a repeat of an earlier stretch of ``size`` words."""
    seen, cover = {}, defaultdict(set)
    for doc, text in sorted(rows):
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        for i in range(len(words) - size + 1):
            key = tuple(words[i:i + size])
            if key in seen:
                d, at = seen[key]
                cover[doc].update(range(max(i, at + size) if d == doc else i, i + size))
            else:
                seen[key] = (doc, i)
    return {d: c for d, c in cover.items() if c}


def _texts(rng):
    words = [f"w{i}" for i in range(400)]
    text = lambda n: " ".join(rng.choice(words, n))
    passages = [text(n) for n in (49, 50, 51, 70, 120)]
    rows = []
    for i in range(60):
        parts = [text(rng.integers(0, 80))]
        for _ in range(rng.integers(0, 3)):
            parts += [passages[rng.integers(0, len(passages))], text(rng.integers(0, 60))]
        rows.append((i, "\n".join(parts)))
    rows += [(100, "a b " * 200), (101, rows[3][1]), (102, rows[3][1]), (103, "a b " * 60 + text(30)), (104, ""),
             (105, text(49)), (106, text(3000) + " " + passages[1] + " " + text(3000))]
    # neighbours in the sort that share less than enough on either side, and a far one that does
    left, mid, right = text(12).split(), text(38).split(), text(10).split()
    rows += [(110, " ".join(left + mid)), (111, " ".join(left[-5:] + mid + right[:6])),
             (112, " ".join(["z"] + left + mid + ["y"])), (113, " ".join(left[-4:] + mid + right[:7]))]
    return rows


def test_suffix_dedup_covers_exactly_the_repeats(spark):
    rows = _texts(np.random.default_rng(2))
    df = spark.createDataFrame([(i, t, 1, "x", 2) for i, t in rows] + [(None, rows[0][1], 1, "x", 2), (120, None, 1, "x", 2)],
                               DOCS).repartition(5)
    spans = suffix_dedup.repeated_spans(df).collect()
    got = defaultdict(set)
    for r in spans:
        here = set(range(r["start_word"], r["end_word"]))
        assert here and not got[r["doc_id"]] & here and r["first_doc_ids"]
        got[r["doc_id"]] |= here
    assert dict(got) == _covered(rows, 50)


def test_remove_spans_keeps_the_other_words(spark):
    rows = _texts(np.random.default_rng(4))
    df = spark.createDataFrame([(i, t, 1, "x", 2) for i, t in rows] + [(None, "no id", 1, "x", 2)], DOCS)
    out = suffix_dedup.remove_spans(df, suffix_dedup.repeated_spans(df))
    assert out.columns == df.columns
    texts = {r["doc_id"]: r["text"] for r in out.collect()}
    cover = _covered(rows, 50)
    for i, t in rows:
        words = t.split()
        rest = [w for k, w in enumerate(words) if k not in cover.get(i, ())]
        assert (i not in texts and not rest) if i in cover and not rest else texts[i].split() == rest
    assert texts[None] == "no id"


def test_keep_one_decides_by_row(spark):
    long = "one two three four five six seven eight nine ten " * 8
    other = "entirely different words stand in this second text of the very same document id " * 6
    rows = [(1, "alpha beta gamma delta"), (1, other), (1, other), (2, long), (3, long), (None, "lost text"), (None, "lost text"),
            (None, long), (4, None), (5, "")]
    df = spark.createDataFrame([(i, t, 1, "x", 2) for i, t in rows], DOCS)
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str) == sorted(
        [(1, "alpha beta gamma delta"), (1, other), (2, long), (None, "lost text"), (4, None)], key=str)


def test_spans_are_cut_from_their_own_text(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    own = " ".join(f"q{i}" for i in range(90))
    rows = [(1, passage + " first"), (2, "before " + passage), (2, own), (3, None), (None, passage)]
    df = spark.createDataFrame([(i, t, 1, "x", 2) for i, t in rows], DOCS)
    out = sorted(((r["doc_id"], r["text"]) for r in suffix_dedup.cut_repeats(df).collect()), key=str)
    assert out == sorted([(1, passage + " first"), (2, "before "), (2, own), (3, None), (None, passage)], key=str)
    single = df.filter("doc_id <> 2 or text like 'before%'")
    out = sorted(((r["doc_id"], r["text"]) for r in suffix_dedup.cut_repeats(single).collect()), key=str)
    assert out == [(1, passage + " first"), (2, "before "), (3, None)]
    assert suffix_dedup.cut_repeats(df.limit(0)).isEmpty()


def test_suffix_dedup_repeated_rows_and_empty_table(spark):
    text = " ".join(f"u{i}" for i in range(80))
    df = spark.createDataFrame([(1, text), (1, text), (2, text)], "doc_id long, text string")
    got = [tuple(r) for r in suffix_dedup.repeated_spans(df).collect()]
    assert got == [(2, 0, 80, [1])]
    assert suffix_dedup.repeated_spans(df.limit(0)).isEmpty()


def _vectors(rng, n, dim=16):
    x = rng.standard_normal((n, dim))
    for i in range(n // 3, n):                          # clusters of copies, exact and noisy
        c = x[i % 20]
        x[i] = c if i % 7 == 0 else c + rng.standard_normal(dim) * rng.uniform(0, 0.09)
    return x


def test_embedding_links_equal_brute_force(spark):
    x = _vectors(np.random.default_rng(8), 400).astype(np.float32)
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    odd = [(1000, None), (1001, [0.0] * 16), (1002, [float("nan")] + [1.0] * 15), (1003, [float("inf")] * 16),
           (1004, []), (1005, [1.0, 2.0]), (1006, [2.0, 4.0]), (None, rows[0][1]), (5, rows[5][1]), (1007, [None] * 16)]
    df = spark.createDataFrame([(i, v, "k", 0) for i, v in rows + odd],
                               "vec_id long, embedding array<float>, key string, rep int")
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"])
           for r in embedding_lsh.near_duplicates(df, 0.95, miss=1e-4, tile_rows=8).collect()}
    y = x.astype(np.float64)
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    near = y @ y.T >= 0.95
    linked = {i: [j for j in range(400) if near[i, j] and i != j] for i in range(400)}
    label = _labels(list(range(400)), linked)
    want = {i: (len(linked[i]), label[i], label[i] == i) for i in range(400)}
    want |= {i: (0, i, True) for i in (1000, 1001, 1002, 1003, 1004, 1007)} | {1005: (1, 1005, True), 1006: (1, 1005, False)}
    assert got == want
    assert embedding_lsh.near_duplicates(df.limit(0)).isEmpty()


def test_table_plan_reaches_the_recall_it_states():
    for n in (100, 10**6, 10**10):
        per_key, tables = embedding_lsh.table_plan(n, 0.95, 0.01)
        near = embedding_lsh.agreement((2 - 1.9) ** 0.5)
        assert 1 - (1 - near ** per_key) ** tables >= 0.99
        assert n * embedding_lsh.agreement(2 ** 0.5) ** per_key <= 0.126
