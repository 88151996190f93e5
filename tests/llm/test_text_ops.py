"""Packing, mixing, preference formatting and license scans."""

import json
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfmart.llm import chat_preference, license_scan, packing, pfair_mix, queries

SF = "/root/testdata/sf0.001"


# ---- packing --------------------------------------------------------------------------------

def _round_trip(rows, out, tokenizer, window):
    whole = {}
    for i, t in rows:
        whole.setdefault(i, []).append(tokenizer.encode(t or "", add_special_tokens=False).ids + [packing.END_ID])
    sequences = {}
    for r in out:
        ids = np.frombuffer(r["ids"], "<u4").tolist()
        assert len(ids) == r["length"] > 0
        assert any(w[r["start"]:r["start"] + r["length"]] == ids and len(w) == r["doc_tokens"] for w in whole[r["doc_id"]])
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for i, docs in whole.items():
        assert sum(r["length"] for r in out if r["doc_id"] == i) == sum(map(len, docs))
    padding = total = 0
    for pieces in sequences.values():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at
            at += n
        assert at <= window
        total += at
        padding += 0 if at & (at - 1) == 0 else window - at
    return padding / max(total, 1)


def test_packing_round_trip(spark):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(packing.default_tokenizer())
    tokenizer.encode_special_tokens = True
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    rows += [(9001, None), (9002, ""), (9003, "word. " * 9000), (None, "no id here"), (2**60 + 1, "İstanbul ΑΣ don't!! 12 ﬁ"),
             (9004, "<|endoftext|> ab<|startoftext|>"), (9005, "same"), (9005, "same")]
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, start int, g string")
    for chars in (packing.GROUP_CHARS, 50_000):
        out = packing.pack(df, packing.default_tokenizer(), 2048, group_chars=chars).collect()
        assert _round_trip(rows, out, tokenizer, 2048) < 0.01
    assert packing.pack(df.limit(0), packing.default_tokenizer()).isEmpty()
    digest = packing.digest(packing.pack(df, packing.default_tokenizer())).collect()
    ids = np.array(tokenizer.encode("same", add_special_tokens=False).ids + [1], "<u4").tobytes()
    assert {r["ids_crc32"] for r in digest if r["doc_id"] == 9005 and r["length"] == len(ids) // 4} <= {zlib.crc32(ids)}


def test_best_fit_decreasing_equals_a_plain_search():
    rng = np.random.default_rng(0)
    for n, capacity in ((1, 8), (200, 64), (500, 100)):
        lengths = rng.integers(1, capacity + 1, n)
        window, offset = packing.best_fit_decreasing(lengths, capacity)
        room: list[int] = []
        for k in np.argsort(-lengths, kind="stable"):
            fits = [r for r in room if r >= lengths[k]]
            if fits:
                room[room.index(min(fits))] -= lengths[k]
            else:
                room.append(capacity - lengths[k])
        used = np.bincount(window, lengths)
        assert sorted(capacity - used.astype(int)) == sorted(room)
        for w in range(len(used)):
            at = sorted((o, m) for o, m, x in zip(offset, lengths, window) if x == w)
            assert [o for o, _ in at] == np.cumsum([0] + [m for _, m in at[:-1]]).tolist()


# ---- mixing ---------------------------------------------------------------------------------

@pytest.mark.parametrize("weights", [[1], [1, 1, 1], [8, 5, 3, 2] + [1] * 16, [97, 2, 1], [7, 7, 5, 3]])
def test_cycle_deviates_by_less_than_one_block(weights):
    total, owners = sum(weights), pfair_mix.edf_cycle(weights)
    got = np.zeros(len(weights), int)
    for t, i in enumerate(owners, 1):
        got[i] += 1
        assert all(abs(got[k] * total - t * w) < total for k, w in enumerate(weights))
    assert got.tolist() == weights


def test_mix_order_against_sql(spark):
    out = queries.op10_source_mixing(spark, SF)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = con.execute(f"SELECT doc_id, source, block, slot, position FROM ({queries.MIX_SQL})").fetchall()
    got = [tuple(r) for r in out.select("doc_id", "source", "block", "slot", "position").collect()]
    assert sorted(got) == sorted(want)


def test_mix_odd_rows(spark):
    rows = ([(i, "hot") for i in range(300)] + [(1000 + i, None) for i in range(40)] + [(None, "hot"), (7, "hot"), (7, "hot")]
            + [(2000 + i, "n") for i in range(5)] + [(3000, "")])
    df = spark.createDataFrame([(i, s, "t", 1) for i, s in rows], "doc_id long, source string, _doc string, slot int")
    out = pfair_mix.mix(df, {"hot": 3, "n": 2}, block_rows=4).collect()
    assert sorted(r["position"] for r in out) == list(range(len(rows)))
    ordered = sorted(out, key=lambda r: r["position"])
    for s in ("hot", None, "n", ""):
        ids = [r["doc_id"] for r in ordered if r["source"] == s]
        assert ids == sorted(ids, key=lambda i: (i is None, i))
    docs = pfair_mix.mixed_documents(df, {"hot": 3, "n": 2}, block_rows=4)
    assert docs.columns == df.columns and [r["source"] for r in docs.collect()][:12] == [
        r["source"] for r in ordered][:12] and docs.count() == len(rows)
    assert pfair_mix.mix(df.limit(0)).isEmpty()
    with pytest.raises(ValueError):
        pfair_mix.mix(df, {"hot": 0})


# ---- preference formatting -------------------------------------------------------------------

def test_preference_pairs(spark):
    u, a, b = ("user", "hi <|end|>"), ("assistant", "one"), ("assistant", "two")
    rows = [(1, [u, a], [u, b]), (2, [u, a], [u, a]), (3, [u], [u, b]), (4, None, [b]), (5, [], None),
            (None, [(None, None), a], [(None, None), b, u]), (7, [u, a, ("user", "x"), b], [u, a])]
    side = "array<struct<role string, text string>>"
    df = spark.createDataFrame(rows, f"pair_id long, chosen {side}, rejected {side}").withColumn("prompt", F.lit(1))
    got = {r["pair_id"]: r for r in chat_preference.format_pairs(df).collect()}
    head = "<|user|>\nhi < |end|><|end|>\n"
    assert got[1]["prompt"] == head and got[1]["n_common"] == 1 and got[1]["status"] == "ok"
    assert got[1]["chosen"] == "<|assistant|>\none<|end|>\n" and got[1]["rejected"] == "<|assistant|>\ntwo<|end|>\n"
    s, e = got[1]["chosen_mask"][0]
    assert got[1]["chosen"][s:e] == "one<|end|>"
    assert got[2]["status"] == "identical" and got[2]["chosen"] == got[2]["rejected"] == "" and got[2]["n_common"] == 2
    assert got[3]["status"] == "chosen_empty" and got[4]["status"] == "chosen_empty" and got[5]["status"] == "identical"
    assert got[None]["n_common"] == 1 and got[None]["prompt"] == "<|unknown|>\n<|end|>\n"
    assert len(got[7]["chosen_mask"]) == 1 and got[7]["status"] == "rejected_empty"
    s, e = got[7]["chosen_mask"][0]
    assert got[7]["chosen"][s:e] == "two<|end|>"
    assert chat_preference.format_pairs(df.limit(0)).isEmpty()


def test_reply_pairs_against_sql(spark):
    extra = [(90000, 0, "user", "q"), (90000, 1, "assistant", "same"), (90001, 0, "user", "other"),
             (90001, 1, "assistant", "same"), (90002, 0, "assistant", None), (90004, 0, "system", "only"),
             (None, 0, "user", "lost"), (90006, None, "user", "x"), (90006, 1, "assistant", "y"), (90006, 1, "assistant", "y")]
    df = spark.read.parquet(f"{SF}/conversations.parquet").unionByName(spark.createDataFrame(
        extra, "conv_id long, turn long, role string, text string"))
    table = df.toArrow()
    con = duckdb.connect()
    con.register("conversations", table)
    cols = ["pair_id", "n_common", "prompt", "chosen", "rejected", "chosen_mask", "rejected_mask", "status"]
    want = con.execute(f"SELECT {', '.join(cols)} FROM ({queries.PREFERENCE_SQL})").fetchall()
    pairs = chat_preference.format_pairs(chat_preference.reply_pairs(df))
    got = [tuple(",".join(f"{m['start']}-{m['end']}" for m in v) if isinstance(v, list) else v for v in r)
           for r in pairs.select(*cols).collect()]
    assert len(got) > 3 and sorted(got) == sorted(tuple(r) for r in want)


# ---- license scan ------------------------------------------------------------------------------

def test_license_scan(spark):
    apache, mit = license_scan.TEMPLATES["Apache-2.0-notice"], license_scan.TEMPLATES["MIT"]
    edited = apache.replace("obtain a copy", "get one copy").replace("writing,", "plain writing,")
    filler = "Nothing to see here. " * 20
    rows = [(1, filler + apache + filler), (2, filler + edited), (3, filler), (4, None), (5, ""), (6, mit + " " + filler + mit.upper()),
            (None, mit), (7, "Released under some other license"), (8, filler * 2000 + mit)]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, license string")
    out = license_scan.scan_licenses(df).collect()
    by = {}
    for r in out:
        by.setdefault(r["doc_id"], []).append(r)
        text = dict(rows)[r["doc_id"]]
        assert r["start"] == r["spans"][0]["start"] and r["end"] == r["spans"][-1]["end"] <= len(text)
    assert {i: sorted(r["license"] for r in v) for i, v in by.items()} == {
        1: ["Apache-2.0-notice"], 2: ["Apache-2.0-notice"], 6: ["MIT", "MIT"], None: ["MIT"], 8: ["MIT"]}
    assert by[1][0]["coverage"] == 1.0 and by[1][0]["start"] == len(filler)
    assert 0.9 < by[2][0]["coverage"] < 1.0 and len(by[2][0]["spans"]) > 1
    assert license_scan.scan_licenses(df.limit(0)).isEmpty()


def test_banded_alignment_equals_full_alignment():
    rng = np.random.default_rng(6)
    words = [f"v{i}" for i in range(30)]
    for _ in range(30):
        template = list(rng.choice(words, 25))
        copy = [w for w in template if rng.random() > 0.06]
        for _ in range(2):
            copy.insert(int(rng.integers(0, len(copy))), "new")
        lead = list(rng.choice(words, 10))
        doc = lead + copy + list(rng.choice(words, 10))
        pairs = license_scan.align(template, doc, 0, len(doc), len(lead))
        wide = license_scan.align(template, doc, 0, len(doc), len(lead), band=80)
        score = lambda p: len(p)
        assert score(pairs) == score(wide)
        assert all(template[i] == doc[j] for i, j in pairs) and pairs == sorted(pairs)


def test_plan_is_bounded_and_json_safe():
    phases = pfair_mix.plan({"sa": 1000, "sb": 10, "n": 3}, {"sa": 2, "sb": 1, "n": 1}, 16)
    assert len(json.dumps([vars(p) for p in phases])) < 5000
    assert sum(p.end_block - p.first_block for p in phases) == 63 + 1 + 1


def test_license_notices_repeated_at_once():
    index = license_scan.Index(license_scan.TEMPLATES)
    mit, other = license_scan.TEMPLATES["MIT"], license_scan.TEMPLATES["Apache-2.0"]
    for notice, name in ((mit, "MIT"), (other, "Apache-2.0")):
        for between in (" ", " and "):
            for copies in (2, 3, 4):
                text = between.join([notice] * copies)
                found = license_scan.scan(text, index, license_scan.MIN_COVERAGE)
                step = len(notice) + len(between)
                assert [(f[0], f[3]) for f in found] == [(name, k * step) for k in range(copies)]


def test_packing_spreads_rows_of_one_id(spark):
    rows = [(None, "same words here") for _ in range(300)] + [(7, f"text number {i}") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = packing.pack(df, packing.default_tokenizer(), 64, group_chars=500).collect()
    for i in (None, 7):
        groups = [r["sequence_id"] >> 40 for r in out if r["doc_id"] == i]
        assert max(map(groups.count, groups)) < len(groups) / 3
    words = packing.WordIds(open(packing.default_tokenizer(), encoding="utf-8").read())
    assert sum(r["length"] for r in out) == sum(len(words.ids(t)) // 4 + 1 for _, t in rows)


def test_packing_query_encodes_as_the_tokenizer_is_loaded(spark, tmp):
    from tokenizers import Tokenizer
    plain = Tokenizer.from_file(packing.default_tokenizer())
    texts = ["<|endoftext|> ab<|startoftext|>", "Ab<|endoftext|>Cd, plain", "none here.", "a\t<|endoftext|>\n<|endoftext|>"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp}/documents.parquet")
    got = {}
    for r in packing.pack(spark.read.parquet(f"{tmp}/documents.parquet"), packing.default_tokenizer(),
                          special_tokens=True).collect():
        got.setdefault(r["doc_id"], []).append((r["start"], np.frombuffer(r["ids"], "<u4").tolist()))
    want = {i: plain.encode(t, add_special_tokens=False).ids + [packing.END_ID] for i, t in enumerate(texts)}
    assert {i: sum((x for _, x in sorted(p)), []) for i, p in got.items()} == want
    query = queries.op8_packing(spark, tmp).collect()
    assert {r["doc_id"]: r["doc_tokens"] for r in query} == {i: len(w) for i, w in want.items()}
