"""The pipeline's stages against plain versions, each on its own input."""

import itertools
import os
import random
import struct
import zlib
from collections import Counter

import pytest

import corpus_pipeline
from tidemark.llm import quality

SF = "/root/testdata/sf0.001"


@pytest.fixture
def sf_dir(spark, tmp_path):
    """Tables with junk, shared lines, copies and leaks."""
    rng = random.Random(21)
    vocab = ["".join(rng.choice("aeioubcdfg") for _ in range(rng.randint(2, 8))) for _ in range(300)]
    docs, labels = [], []
    item = " ".join(rng.choices(vocab, k=20))
    for i in range(240):
        text = [" ".join(rng.choices(vocab, k=12)) for _ in range(4)]
        poor = i % 5 == 0 and i % 11 != 3  # a near copy is as good as its original
        if i % 3 == 0:
            text.insert(1, "Shared  Line")
        if i % 17 == 0:
            text.append(item.upper())
        text = "\n".join(text)
        if i % 11 == 3:
            text = docs[i - 1][1] + " end"
        docs.append((i, text.upper() + " !!" if poor else text, "en", "s", len(text)))
        labels.append((i, int(not poor), 0))
    docs += [(500, None, None, None, None), (501, "", "en", "s", 0)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


def test_stages(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        out = stage(spark, docs, sf_dir)
        out.write.parquet(f"{tmp_path}/out-{name}")
        docs = spark.read.parquet(f"{tmp_path}/out-{name}")
        seen[name] = (before.collect(), docs.collect())
        if name != "packing":
            assert docs.columns == columns
    old, new = seen["quality_classifier"]
    machine = quality.fit(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scores = {r.row.doc_id: r.score for r in quality.score(spark.read.parquet(f"{sf_dir}/documents.parquet"), machine).collect()}
    assert {r.doc_id for r in new} == {i for i, s in scores.items() if s >= 0.3}
    poor = {i for i in range(240) if i % 5 == 0 and i % 11 != 3}
    assert len(poor & {r.doc_id for r in new}) < 5 and len(new) > 180

    old, new = seen["line_dedup"]
    n = Counter(k for r in old for k in {x.strip().lower() for x in (r.text or "").split("\n")} if k)
    want = {r.doc_id: "\n".join(x for x in (r.text or "").split("\n") if n[x.strip().lower()] < 10) for r in old}
    assert {r.doc_id: r.text or "" for r in new} == want and not any("Shared" in v for v in want.values())
    assert all(r.n_chars == len(r.text) for r in new if r.text and r.doc_id < 500 and r.n_chars != dict((o.doc_id, o.n_chars) for o in old)[r.doc_id])

    old, new = seen["near_duplicates"]
    sets = {}
    for r in old:
        w = (r.text or "").lower().split()
        sets[r.doc_id] = frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if sets[a] and sets[b] and 10 * both >= 8 * (len(sets[a]) + len(sets[b]) - both):
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    assert {r.doc_id for r in new} == {i for i in sets if root(i) == i} and len(new) < len(old)

    old, new = seen["decontamination"]
    item = spark.read.parquet(f"{sf_dir}/benchmark.parquet").first().text.lower()
    assert {r.doc_id for r in old} - {r.doc_id for r in new} == {r.doc_id for r in old if item in (r.text or "").lower()}

    old, new = seen["packing"]
    assert pieces_of(new) == plain_pieces(old)
    check_gapless(new)


def plain_pieces(docs):
    """(doc_id, piece, start, length, crc) of all documents by the tokenizer itself."""
    from tidemark.llm._bpe import WordEncoder
    from tidemark.llm.queries import tokenizer_path

    tokenizer = WordEncoder(tokenizer_path("word_bpe_49k.json")).tokenizer
    out = []
    for r in docs:
        ids = [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 1]
        for k in range(0, len(ids), 4096):
            part = ids[k : k + 4096]
            out.append((r.doc_id, k // 4096, k, len(part), zlib.crc32(struct.pack(f"<{len(part)}I", *part))))
    return sorted(out)


def pieces_of(rows):
    return sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows)


def check_gapless(rows):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        parts.sort()
        assert parts[0][0] == 0 and all(a[0] + a[1] == b[0] for a, b in itertools.pairwise(parts)) and sum(p[1] for p in parts) <= 4096


def test_run_equals_the_stages_one_by_one(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{tmp_path}/alone-{name}")
        docs = spark.read.parquet(f"{tmp_path}/alone-{name}")
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    assert pieces_of(rows) == pieces_of(docs.collect())
    check_gapless(rows)


def test_run_on_the_test_tables(spark):
    if not os.path.isdir(SF):
        pytest.skip("no test tables")
    check_gapless(corpus_pipeline.run(spark, SF).collect())


def test_stages_on_empty_repeated_and_clashing_rows(spark, sf_dir, tmp_path):
    """Every stage on no rows, and on repeated ids, null ids and columns named as in the operators."""
    schema = "doc_id long, text string, uid string, row int, label int, hits int, n_chars long"
    odd = [(1, "some words that are not many", "u", 1, 1, 1, 3), (1, "some words that are not many", "u", 1, 1, 1, 3), (None, "a null id has this text", None, None, None, None, None), (2, None, "u", 1, 1, 1, 0), (2, "word " * 30000, "u", 1, 1, 1, 0)]
    spark.createDataFrame(odd, schema).write.parquet(f"{tmp_path}/odd")
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/none")
    for name, stage in corpus_pipeline.STAGES:
        none, some = (stage(spark, spark.read.parquet(f"{tmp_path}/{x}"), sf_dir) for x in ("none", "odd"))
        assert none.count() == 0
        rows = some.collect()
        if name == "packing":
            assert pieces_of([r for r in rows if r.doc_id]) == pieces_of(rows)[: len(rows)] if all(r.doc_id for r in rows) else len(rows) >= 5
        else:
            assert some.columns == [c.split()[0] for c in schema.split(", ")]
        if name in ("line_dedup", "decontamination"):
            assert len(rows) == 5
        if name == "near_duplicates":
            assert sorted(str(r.doc_id) for r in rows) == ["1", "2", "2", "None"]
