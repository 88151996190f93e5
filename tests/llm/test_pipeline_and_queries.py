"""The registered queries, and the pipeline stage by stage."""

import duckdb

import __spark_entry__ as entry
import corpus_pipeline
from shelfmart.llm import packing, pfair_mix, queries

SF = "/root/testdata/sf0.001"


def test_every_operator_is_registered_once():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in entry.queries()


def test_link_sql_equals_query(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    cols = "vec_id, n_links, component_id, kept"
    want = con.execute(f"SELECT {cols} FROM ({queries.LINKS_SQL})").fetchall()
    got = [tuple(r) for r in queries.op6_embedding_lsh(spark, SF).selectExpr(*cols.split(", ")).collect()]
    assert sorted(got) == sorted(want)


def test_pipeline_stages(spark, tmp):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(90001, None, "en", "src1", 0), (90002, "123 456", "en", None, 7), (None, "the and of", "en", "src2", 10)],
                                docs.schema)
    docs = docs.unionByName(odd)
    columns, before = docs.columns, docs.count()
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        out.write.parquet(f"{tmp}/{name}")
        out = spark.read.parquet(f"{tmp}/{name}")
        if k + 1 < len(corpus_pipeline.STAGES):
            assert out.columns == columns and 0 < out.count() <= before
            before = out.count()
        if name == "language_id":
            assert out.count() == docs.count() - 2
        if name == "source_mixing":
            assert out.count() == docs.count()
        if name == "suffix_array_dedup":
            assert out.filter("n_chars <> length(text)").isEmpty()
        last, docs = docs, out
    assert {r[0] for r in out.select("doc_id").distinct().collect()} == {r[0] for r in last.select("doc_id").distinct().collect()}


def test_whole_pipeline_on_odd_rows(spark, tmp):
    """run() from table to sequences: copies, repeated rows, nulls, one very long text."""
    from tokenizers import Tokenizer
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    first = docs.filter("lang = 'en' and length(text) > 300").orderBy("doc_id").first()
    long = " ".join(f"{w}{k}" for k, w in enumerate((first["text"] + " ").split() * 400))
    extra = [(first["doc_id"],) + tuple(first)[1:], (90001, first["text"], "en", "src1", 0), (90002, None, "en", "src1", 0),
             (90003, first["text"] + " " + long, None, None, 0), (None, first["text"], "en", "src2", 0)]
    odd = docs.unionByName(spark.createDataFrame(extra, docs.schema))
    odd.write.parquet(f"{tmp}/t/documents.parquet")
    out = [r.asDict() for r in corpus_pipeline.run(spark, f"{tmp}/t").collect()]
    ids = {r["doc_id"] for r in out}
    assert first["doc_id"] in ids and not ids & {90001, 90002, None} and 90003 in ids
    by_doc, by_sequence = {}, {}
    for r in out:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for rows in by_doc.values():
        at = 0
        for r in sorted(rows, key=lambda r: r["start"]):
            assert r["start"] == at
            at += r["length"]
        assert at == rows[0]["doc_tokens"]
    for pieces in by_sequence.values():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at
            at += n
        assert at <= 2048
    kept = Tokenizer.from_file(packing.default_tokenizer())
    plain = len(kept.encode(first["text"], add_special_tokens=False).ids) + 1
    assert by_doc[first["doc_id"]][0]["doc_tokens"] <= plain
    docs.limit(0).write.parquet(f"{tmp}/e/documents.parquet")
    assert corpus_pipeline.run(spark, f"{tmp}/e").isEmpty()


def test_packing_refuses_an_order_it_cannot_know(spark, tmp):
    import os
    import pytest
    spark.range(9).selectExpr("id AS doc_id", "'some words' AS text").coalesce(1).write.parquet(f"{tmp}/t")
    name = next(n for n in os.listdir(f"{tmp}/t") if n.startswith("part-"))
    os.makedirs(f"{tmp}/u")
    with open(f"{tmp}/t/{name}", "rb") as f, open(f"{tmp}/u/extract.parquet", "wb") as g:
        g.write(f.read())
    ordered = packing.pack(spark.read.parquet(f"{tmp}/t"), packing.default_tokenizer(), in_order=True)
    assert ordered.select("doc_id").distinct().count() == 9
    with pytest.raises(ValueError, match="order"):
        packing.pack(spark.read.parquet(f"{tmp}/u"), packing.default_tokenizer(), in_order=True)


def test_mix_decides_the_packed_order(spark, tmp, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    packed, digests = {}, {}
    for name, weights in (("plain", None), ("src0", {"src0": 90}), ("src1", {"src1": 90})):
        monkeypatch.setattr(corpus_pipeline, "MIX_WEIGHTS", weights)
        mixed = corpus_pipeline.source_mixing(spark, docs, SF) if weights else docs
        mixed.write.parquet(f"{tmp}/{name}")
        read = spark.read.parquet(f"{tmp}/{name}")
        digests[name] = sorted(map(tuple, corpus_pipeline.pack_sequences(spark, read, SF).collect()))
        packed[name] = packing.pack(read, packing.default_tokenizer(), group_chars=20_000, in_order=True).collect()
    assert len(set(map(str, digests.values()))) == 3
    first = [{r["doc_id"] for r in v if r["sequence_id"] >> 40 == 0} for v in packed.values()]
    assert first[1] != first[2] != first[0] != first[1]
    every = {r["doc_id"] for r in docs.collect()}
    for name in ("src0", "src1"):
        place = {r["doc_id"]: r["position"] for r in pfair_mix.mix(docs, {name: 90}).collect()}
        spans = {}
        for r in packed[name]:
            spans.setdefault(r["sequence_id"] >> 40, []).append(place[r["doc_id"]])
        groups = sorted(spans)
        assert len(groups) > 3 and all(max(spans[a]) <= min(spans[b]) for a, b in zip(groups, groups[1:]))
        sizes = {}
        for r in packed[name]:
            sizes[r["doc_id"]] = sizes.get(r["doc_id"], 0) + r["length"]
        assert all(sizes[r["doc_id"]] == r["doc_tokens"] for r in packed[name]) and set(sizes) == every
