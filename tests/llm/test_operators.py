"""Each operator against a plain version on small fixtures: nulls, empty and long texts, ties, repeats, clashing columns."""

import itertools
import math
import random
import re
import struct
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import ann, decontaminate, html_extract, line_dedup, lm_scoring, near_dup, packing, quality, token_counts, toxicity
from tidemark.llm._bpe import WordEncoder
from tidemark.llm.graph import components
from tidemark.llm.queries import tokenizer_path

WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def written(df, tmp_path, name="in"):
    """Stable rows: operators that number rows want a written table."""
    path = str(tmp_path / name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def vocabulary(rng, n):
    return ["".join(rng.choice("aeioubcdfg") for _ in range(rng.randint(2, 8))) for _ in range(n)]


ODD_TEXTS = [None, "", "  ", "One", "Straße ÉCOLE I'll 42x7 naïve", "a<|endoftext|>b", "ΑΣ Σİ é  x y", "tab\tand\r\nnew\x0bline\x1cq", "x" * 5000, "word " * 9000, "日本語 テスト!!!", "''s 'Re DON'T"]


def clashing(spark, texts):
    rows = [(i, t, 7, "x", 1, "u") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, uid int, row string, piece int, text2 string")


# ---- 1: packing ---------------------------------------------------------------------


def test_ids_equal_the_tokenizer():
    encoder = WordEncoder(tokenizer_path("word_bpe_49k.json"))
    for text in ODD_TEXTS:
        ids = encoder.tokenizer.encode(text or "", add_special_tokens=False).ids
        assert encoder.ids(text or "") == struct.pack(f"<{len(ids)}I", *ids)


def check_packing(rows, capacity):
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= capacity
    return len(by)


def test_packing_round_trip(spark, tmp_path):
    docs = written(clashing(spark, [*ODD_TEXTS, *ODD_TEXTS]), tmp_path)
    path = tokenizer_path("word_bpe_49k.json")
    rows = packing.pack(packing.token_pieces(docs, path)).collect()
    encoder = WordEncoder(path)
    want = []
    for i, t in enumerate([*ODD_TEXTS, *ODD_TEXTS]):
        ids = [*encoder.tokenizer.encode(t or "", add_special_tokens=False).ids, 1]
        for k in range(0, len(ids), 4096):
            part = ids[k : k + 4096]
            want.append((i, k // 4096, k, len(part), zlib.crc32(struct.pack(f"<{len(part)}I", *part))))
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    total = sum(w[3] for w in want)
    assert check_packing(rows, 4096) == -(-total // 4096)


def test_groups_exchange_documents(spark):
    rng = random.Random(1)
    lengths = [rng.choice((rng.randint(1, 100), rng.randint(30, 64))) for _ in range(600)]
    rows = [(i, i, 0, 0, n, 0) for i, n in enumerate(lengths)]
    got = packing.pack(spark.createDataFrame(rows, packing.PIECE_SCHEMA), capacity=100, items=60, rounds=4).collect()
    assert sorted((r.doc_id, r.length) for r in got) == [(i, n) for i, n in enumerate(lengths)]
    used = check_packing(got, 100)
    bound = packing.dff_lower_bound(np.array(lengths), 100)
    one = packing.pack(spark.createDataFrame(rows, packing.PIECE_SCHEMA), capacity=100, items=10**6).collect()
    assert bound <= check_packing(one, 100) <= used <= bound * 1.05 + 2
    assert packing.pack(spark.createDataFrame([], packing.PIECE_SCHEMA)).count() == 0


def optimum(items, capacity):
    best = len(items)

    def place(k, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if k == len(items):
            best = len(bins)
            return
        for i in range(len(bins)):
            if bins[i] + items[k] <= capacity and bins[i] not in bins[:i]:
                place(k + 1, [*bins[:i], bins[i] + items[k], *bins[i + 1 :]])
        place(k + 1, [*bins, items[k]])

    place(0, [])
    return best


def test_lower_bound_never_exceeds_the_optimum():
    rng = random.Random(2)
    tight = 0
    for _ in range(60):
        items = sorted((rng.randint(1, 20) for _ in range(9)), reverse=True)
        best, bound = optimum(items, 20), packing.dff_lower_bound(np.array(items), 20)
        assert bound <= best <= packing.best_fit_decreasing(np.array(items), 20)[2].size
        tight += bound == best
    assert tight > 50
    assert packing.dff_lower_bound(np.array([11] * 7), 20) == 7


# ---- 2: token counts ----------------------------------------------------------------


def test_sections_add_up(spark):
    texts = [*ODD_TEXTS, "a\n\n\nb\n", "\n"]
    rows = token_counts.section_token_counts(clashing(spark, texts), tokenizer_path("byte_bpe_50k.tiktoken")).collect()
    encoding, lengths = token_counts.load_encoding(tokenizer_path("byte_bpe_50k.tiktoken"))
    by = defaultdict(list)
    for r in rows:
        by[r.doc_id].append(r)
    for i, t in enumerate(texts):
        t = t or ""
        lines, ids = t.split("\n"), encoding.encode_ordinary(t)
        got = sorted(by[i], key=lambda r: r.section)
        assert [t[r.start_char : r.end_char].removesuffix("\n") for r in got] == lines
        # plain rule: each token to the line that holds its first byte
        data, at, want = t.encode(), 0, Counter()
        for token in ids:
            want[data[:at].count(b"\n")] += 1
            at += int(lengths[token])
        assert [r.n_tokens for r in got] == [want[k] for k in range(len(lines))] and sum(want.values()) == got[0].doc_tokens == len(ids)
    assert sum(r.n_crossing for r in by[len(texts) - 2]) >= 1


# ---- 3: LM scoring ------------------------------------------------------------------


def held(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1


def plain_lm(docs, mus):
    """Scores by the recursive definition, and by a traversal of an automaton held in dictionaries."""
    order = len(mus) + 1
    n_of = Counter()
    for i, t in docs:
        seq = ("<s>", *words(t), "</s>")
        if not held(i):
            n_of.update(seq[a : a + k] for k in range(1, order + 1) for a in range(len(seq) - k + 1))
    uni = {g[0]: c for g, c in n_of.items() if len(g) == 1 and g != ("<s>",)}
    n, v = sum(uni.values()), len(uni)

    def p(h, w):
        if not h:
            return (uni.get(w, 0) + 0.5) / (n + 0.5 * (v + 1))
        mu, low = mus[len(h) - 1], p(h[1:], w)
        return (n_of[*h, w] + mu * low) / (n_of[h] + mu) if n_of[h] else low

    states = {g for g in n_of if len(g) < order and g[-1] != "</s>"} | {()}
    for h in [*list(states)[:8], ("never", "seen")]:
        assert abs(sum(p(h[-(order - 1) :] if order > 1 else (), w) for w in [*uni, "<unk>"]) - 1) < 1e-9

    def suffix(g):
        while g not in states:
            g = g[1:]
        return g

    arcs = {(g[:-1], g[-1]): (math.log10(p(g[:-1], g[-1])), suffix(g[-(order - 1) :] if order > 1 else ())) for g in n_of if g[:-1] in states}
    unknown = (math.log10(p((), "never seen")), ())
    out = []
    for i, t in docs:
        seq = ["<s>", *words(t), "</s>"]
        plain = sum(math.log10(p(tuple(seq[max(0, a - order + 1) : a]), seq[a])) for a in range(1, len(seq)))
        state, walked = suffix(("<s>",) if order > 1 else ()), 0.0
        for w in seq[1:]:
            while (state, w) not in arcs and state:
                walked += math.log10(mus[len(state) - 1] / (n_of[state] + mus[len(state) - 1]))
                state = state[1:]
            gained, state = arcs.get((state, w), unknown)
            walked += gained
        assert abs(plain - walked) < 1e-6 * max(1, abs(plain))
        base = sum(math.log10((uni.get(w, 0) + 0.5) / (n + 0.5 * (v + 1))) for w in seq[1:])
        out.append((i, held(i), len(seq) - 1, sum(uni.get(w, 0) > 0 for w in seq[1:]), n, base, plain))
    return out


def plain_strength(docs, level):
    """The strength by its definition, from the counts themselves."""
    grams, contexts = Counter(), Counter()
    for i, t in docs:
        seq = ("<s>", *words(t), "</s>")
        if not held(i):
            grams.update(seq[a : a + level] for a in range(len(seq) - level + 1))
            contexts.update(seq[a : a + level - 1] for a in range(len(seq) - level + 2))
    del contexts[("</s>",)]
    once = sum(c == 1 for c in grams.values())
    mass = lambda mu: sum(c * mu / (c - 1 + mu) for c in contexts.values())
    return mass, once


@pytest.mark.parametrize("block,lane,order,fan", [(1 << 24, 256, 3, 256), (400, 3, 3, 256), (300, 1, 3, 2), (400, 2, 2, 3), (400, 2, 1, 2), (700, 5, 4, 4)])
def test_lm_scores(spark, tmp_path, monkeypatch, block, lane, order, fan):
    monkeypatch.setattr(lm_scoring, "BLOCK_BYTES", block)
    monkeypatch.setattr(lm_scoring, "LANE", lane)
    rng = random.Random(3)
    vocab = vocabulary(rng, 12)
    docs = [(i, " ".join(rng.choices(vocab, k=rng.randint(0, 30)))) for i in range(60)] + [(5, "One oNe"), (None, None), (61, "Zz yy Zz"), (61, "Zz yy Zz"), (62, "a b " * 300)]
    df = written(spark.createDataFrame(docs, "doc_id long, text string").withColumn("node", F.lit("x")).withColumn("level", F.lit(1)), tmp_path)
    got = lm_scoring.score(df, order=order, fan=fan).collect()
    rows = [(r.doc_id, r.text) for r in df.collect()]
    want = plain_lm(rows, got[0].strengths)
    key = lambda r: (str(r[0]), *(round(x, 6) for x in r[2:]))
    assert [key(tuple(r)[:7]) for r in sorted(got, key=lambda r: key(tuple(r)[:7]))] == sorted(key(w) for w in want)
    for level, mu in enumerate(got[0].strengths, 2):
        mass, once = plain_strength(rows, level)
        assert mass(mu / 1.05) <= once * 1.01 and mass(mu * 1.05) >= once * 0.99 or mu < 2e-3
    assert lm_scoring.score(written(df.limit(0), tmp_path, "none")).count() == 0


def test_every_state_of_the_automaton_sums_to_one():
    rng = random.Random(31)
    vocab = vocabulary(rng, 15)
    rows = [(i, i % 5 == 0, " ".join(rng.choices(vocab, k=40)).encode()) for i in range(30)]
    block = lm_scoring.Block(rows, 3, 60)
    totals = [block.counts(k) for k in (1, 2, 3)]
    start = block.number[0][0]
    unigram = np.where(np.arange(len(totals[0])) == start, 0, totals[0])
    a = lm_scoring.Automaton(block, totals, int(unigram.sum()), int((unigram > 0).sum()), [1.5, 0.7])
    arcs_of = defaultdict(dict)
    for level in (1, 2, 3):
        for g, arc in enumerate(a.arc_of[level - 1]):
            at = block.at[level - 1][g]
            if arc >= 0 and (level > 1 or g != start):
                source = a.of[level - 2][block.number[level - 2][at - 1]] if level > 1 else 0
                arcs_of[int(source)][int(block.number[0][at])] = a.weight[arc]
    seen = np.flatnonzero((totals[0] > 0) & (np.arange(len(totals[0])) != start))
    assert len(a.fail) == len(a.fail_weight) == len(a.depths) and (a.depths[a.fail[1:]] == a.depths[1:] - 1).all()

    def log_p(state, word):
        lost = 0.0
        while word not in arcs_of[state]:
            lost, state = lost + a.fail_weight[state], int(a.fail[state])
        return lost + arcs_of[state][word]

    unknown = 0.5 / (unigram.sum() + 0.5 * (len(seen) + 1))
    for state in range(0, len(a.fail), 7):
        lost, s = 0.0, state
        while s:
            lost, s = lost + a.fail_weight[s], int(a.fail[s])
        assert abs(sum(10 ** log_p(state, int(w)) for w in seen) + 10**lost * unknown - 1) < 1e-9


def test_keys_of_sub_ranges_nest():
    keys = np.unique(np.random.default_rng(2).integers(0, 1 << 44, 5000, dtype=np.uint64))
    whole = lm_scoring.ranges(keys, 44, 0, 1, 9)
    for part in range(3):
        mine = keys[lm_scoring.ranges(keys, 44, 0, 1, 3)[part] : lm_scoring.ranges(keys, 44, 0, 1, 3)[part + 1]]
        assert (np.diff(lm_scoring.ranges(mine, 44, part, 3, 3)) == np.diff(whole)[3 * part : 3 * part + 3]).all()


def test_sorted_keys_round_trip():
    keys = np.unique(np.random.default_rng(1).integers(0, 2**64, 1000, dtype=np.uint64))
    assert (lm_scoring.unpack_sorted(lm_scoring.pack_sorted(keys)) == keys).all()
    for top in (9, 300, 2**40):
        counts = np.array([0, 1, top])
        assert (lm_scoring.unpack_counts(lm_scoring.pack_counts(counts), 3) == counts).all()


# ---- 4: toxicity --------------------------------------------------------------------


def plain_segments(scores):
    """All maximal-scoring segments by the recursive definition: the best segment, then the same left and right of it."""
    if not scores or max(scores) <= 0:
        return []
    best = max(((round(sum(scores[a:b]), 9), -(b - a), -a) for a in range(len(scores)) for b in range(a + 1, len(scores) + 1)))
    a = -best[2]
    b = a - best[1]
    return plain_segments(scores[:a]) + [(best[0], a, b - 1)] + [(s, x + b, y + b) for s, x, y in plain_segments(scores[b:])]


def test_segments_follow_the_definition():
    rng = random.Random(4)
    for _ in range(200):
        places = sorted(rng.sample(range(14), rng.randint(0, 7)))
        weights = [rng.uniform(0.1, 3) for _ in places]
        scores = [-0.37] * 14
        for p, w in zip(places, weights, strict=True):
            scores[p] = w
        got = [(round(s, 9), a, b) for s, a, b in toxicity.maximal_segments(places, weights, -0.37)]
        assert sorted(got) == sorted(plain_segments(scores))


def labelled(spark, n=400):
    rng = random.Random(5)
    vocab = vocabulary(rng, 200)
    docs, labels = [(-1, None), (-2, ""), (-3, "word " * 20000)], []
    for i in range(n):
        text = rng.choices(vocab, k=60)
        toxic, poor = rng.random() < 0.3, rng.random() < 0.3
        if toxic:
            for w in rng.sample(["vilest", "scumbag", "morons", "idiotic"], 3):
                text[rng.randrange(60)] = w
        text = " ".join(text)
        docs.append((i, text.upper() + "!!" if poor else text))
        labels.append((i, int(not poor), int(toxic)))
    return spark.createDataFrame(docs, "doc_id long, text string").withColumn("score", F.lit("x")), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_toxicity_held_out(spark):
    docs, labels = labelled(spark)
    got = toxicity.score(docs, toxicity.fit(docs, labels))
    rows = {r.doc_id: r.score for r in got.collect()}
    assert len(rows) == 403 and all(0 <= s <= 1 for s in rows.values()) and rows[-1] == rows[-2] < 0.5 and rows[-3] < 0.5
    test = [(rows[r.doc_id] >= 0.5) == bool(r.toxic) for r in labels.collect() if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert sum(test) / len(test) > 0.95


def test_toxic_words_of_a_small_table_with_copies(spark):
    rng = random.Random(51)
    vocab, insults = vocabulary(rng, 200), ["scum", "trash", "moron", "loser"]
    docs, labels = [], []
    for i in range(80):
        text = rng.choices(vocab, k=40)
        if i % 8 == 0:
            text[5:7] = rng.sample(insults, 2)
        docs.append((i, " ".join(text)))
        labels.append((i, int(i % 8 == 0)))
    hot = next(i for i in range(0, 80, 8) if zlib.crc32(str(i).encode()) % 5)
    copies = [(1000 + i, docs[hot][1]) for i in range(300) if zlib.crc32(str(1000 + i).encode()) % 5]
    frame = lambda d, y: (spark.createDataFrame(d, "doc_id long, text string"), spark.createDataFrame(y, "doc_id long, toxic int"))
    plain = toxicity.fit(*frame(docs, labels)).lexicon
    hot_too = toxicity.fit(*frame(docs + copies, labels + [(i, 1) for i, _ in copies])).lexicon
    seen = " ".join(t for i, t in docs if i % 8 == 0 and zlib.crc32(str(i).encode()) % 5).split()
    often = [w for w in insults if seen.count(w) >= 3]
    assert often and all(plain.weight(w) > 0 for w in often)
    assert all(plain.weight(w) == hot_too.weight(w) for w in [*insults, *vocab])


def plain_toxicity(docs, labels):
    """The whole score by plain loops: counts, log-odds, leave-one-out, segments, extreme values, logistic curve."""
    texts = dict(docs)
    train = sorted({(y, texts[i] or "") for i, y in labels if i in texts and zlib.crc32(str(i).encode()) % 5})
    tokens = lambda text: {t for w in toxicity.WORD.findall(text) for t in toxicity.tokens_of(w.lower())}
    n_of, docs_of = Counter(), Counter()
    for y, text in train:
        n_of.update((y, t) for t in tokens(text))
        docs_of[y] += 1

    def odds(t, out=None):
        y, z, n1, n0 = n_of[1, t] - (out == 1), n_of[0, t] - (out == 0), docs_of[1] - (out == 1), docs_of[0] - (out == 0)
        if not n_of[1, t]:
            return 0.0
        y, z, rate = max(y, 0), max(z, 0), (max(y, 0) + max(z, 0)) / (n1 + n0)
        return max(0.0, math.log((y + 1) / (rate * n1 + 1)) - math.log((z + 1) / (rate * n0 + 1)))

    def scores(text, out=None):
        values = [max(odds(t, out) for t in toxicity.tokens_of(w.lower())) - toxicity.DRIFT for w in toxicity.WORD.findall(text)]
        return len(values), plain_segments(values)

    rows = [(y, *scores(text, y)) for y, text in train]
    clean = [(max((s for s, _, _ in segments), default=0.0), max(n, 1)) for y, n, segments in rows if not y]
    above = [s for s, _ in clean if s > 0]
    k, scale = 1e-3, 1.0
    if len(above) >= 10:
        def likelihood(c):
            kk = len(above) / sum(n * math.exp(-c * s) for s, n in clean)
            return sum(math.log(kk * n * c) - c * s - kk * n * math.exp(-c * s) for s, n in clean if s > 0) - sum(kk * n for s, n in clean if not s)

        scale = max((0.02 * 1.002**i for i in range(3450)), key=likelihood)
        k = len(above) / sum(n * math.exp(-scale * s) for s, n in clean)

    def facts(n, segments):
        e = [scale * s - math.log(k * max(n, 1)) for s, _, _ in segments]
        best = max(e, default=-math.log(k * max(n, 1)))
        return [min(max(best, -20), 40) / 10, math.log1p(max((s for s, _, _ in segments), default=0.0)), math.log1p(sum(x for x in e if 1 - math.exp(-math.exp(-x)) < 0.05)), 1.0]

    x, y = np.array([facts(n, segments) for _, n, segments in rows]), np.array([r[0] for r in rows])
    w = np.zeros(4)
    for _ in range(200):  # Newton's steps on the penalised likelihood
        p = 1 / (1 + np.exp(-(x @ w)))
        w -= np.linalg.solve((x.T * (p * (1 - p))) @ x + 0.01 * np.eye(4), x.T @ (p - y) + 0.01 * w)
    out = {}
    for i, text in docs:
        n, segments = scores(text or "")
        out[i] = 1 / (1 + math.exp(-float(np.array(facts(n, segments)) @ w)))
    return out, (k, scale)


def test_whole_toxicity_score_against_plain_loops(spark):
    rng = random.Random(52)
    vocab, insults = vocabulary(rng, 60), ["scum", "trash", "moron", "loserish"]
    docs, labels = [(-1, None), (-2, ""), (-3, "Scum TRASH moron")], []
    for i in range(150):
        text = rng.choices(vocab, k=rng.randint(1, 25))
        if i % 4 == 0:
            text.insert(len(text) // 2, rng.choice(insults))
            text.insert(len(text) // 2, rng.choice(insults).upper())
        elif i % 5 == 0:
            text.insert(0, rng.choice(insults))
        docs.append((i, " ".join(text)))
        labels.append((i, int(i % 4 == 0)))
    docs.append((150, docs[3][1]))
    labels += [(150, labels[0][1]), (999, 1), (7, None)]
    d, y = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.fit(d, y)
    got = {r.doc_id: r for r in toxicity.score(d, model).collect()}
    want, (k, scale) = plain_toxicity(docs, [(i, t) for i, t in labels if t is not None])
    assert abs(model.scale / scale - 1) < 0.01 and abs(model.k / k - 1) < 0.05
    assert all(abs(got[i].score - p) < 0.02 for i, p in want.items()) and max(want.values()) > 0.6 > 0.4 > min(want.values())
    spans = [dict(docs)[-3][p.first : p.last] for p in got[-3].passages]
    assert all(span in "Scum TRASH moron" and set(span.lower().split()) <= set(insults) for span in spans)


def test_extreme_value_law_is_recovered():
    rng = np.random.default_rng(53)
    for k, scale in ((0.05, 0.6), (0.002, 1.7)):
        n = rng.integers(20, 2000, 20_000).astype(float)
        s = np.maximum(np.log(k * n / -np.log(rng.random(20_000))) / scale, 0.0)
        found_k, found = toxicity.gumbel(s, n)
        assert abs(found / scale - 1) < 0.05 and abs(found_k / k - 1) < 0.15
    assert toxicity.gumbel(np.zeros(50), np.ones(50)) == (1e-3, 1.0)


def test_empty_tables_and_repeated_ids_of_labelled_operators(spark, tmp_path, monkeypatch):
    docs, labels = labelled(spark, 40)
    docs = written(docs, tmp_path, "d")
    none = written(docs.limit(0), tmp_path, "none")
    assert toxicity.score(none, toxicity.fit(none, labels)).count() == 0 == quality.score(none, quality.fit(none, labels)).count()
    many = written(spark.createDataFrame([(1, f"text number {i} a", "x", 1) for i in range(3000)] + [(2, "other", "x", 2), (None, "nobody", "x", 3)], "doc_id long, text string, label string, uid int"), tmp_path, "many")
    both = spark.createDataFrame([(1, 1, 0), (1, 0, 1), (2, 0, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")
    monkeypatch.setattr(quality, "SAMPLE_ROWS", 400)
    seen = []
    monkeypatch.setattr(quality, "train", lambda rows, y: seen.append(len(rows)) or quality.Machine(np.zeros((16, 7)), 0.0, np.zeros(quality.BUCKETS + 128), np.zeros((quality.BUCKETS + 128, quality.FACTORS))))
    machine = quality.fit(many, both)
    assert 300 < seen[0] < 500
    assert quality.score(many, machine).count() == 3002 == toxicity.score(many, toxicity.fit(many, both)).count()


def test_labels_of_one_kind(spark):
    docs, labels = labelled(spark, 20)
    for label in (0, 1):
        same = labels.withColumn("toxic", F.lit(label)).withColumn("quality", F.lit(label))
        assert all((r.score > 0.5) == bool(label) for r in toxicity.score(docs, toxicity.fit(docs, same)).collect())
        assert all((r.score > 0.5) == bool(label) for r in quality.score(docs, quality.fit(docs, same)).collect())
    assert toxicity.score(docs, toxicity.fit(docs, labels.limit(0))).count() == docs.count() == quality.score(docs, quality.fit(docs, labels.limit(0))).count()


# ---- 5: HTML extraction -------------------------------------------------------------


@pytest.mark.parametrize(
    "page,text",
    [
        ("", ""),
        ("<html><head><title>T</title></head><body><nav><a>x</a></nav><article><h1>Head</h1><p>a<b>b</b>\n c &amp; d<br>e</p></article><footer>f</footer></body></html>", "Head ab c & d e"),
        ("<article><p>one<script>if (a</p>b) x</script><style>p{}</style><p>two<!-- no > --></article>", "one two"),
        ("<article><p><b>open<br><p>next</article><footer>no", "open next"),
        ("<nav><ul><li>menu<article><p>body</p></article>", "body"),
        ("<article><p>x</p><section class='comments'><article>reply</article></section><form>f</form><aside>s</aside><div class=\"ad\">buy</div></article>", "x"),
        ("<body><div class='sidebar'>s</div><div id=content><p>plain</p><p>page</p></div><div class='cookie-notice'>c</div></body>", "plain page"),
        ("<article>&eacute;&#233;&#xe9; &lt;p&gt; &copy &am</article>", "ééé <p> © &am"),
        ("<ARTICLE><P title='a > b'>x</P></ARTICLE>", "x"),
        ('<body><article class="post has-sidebar"><p>words of it</p></article></body>', "words of it"),
        ('<div class="layout with-sidebar"><main><p>words of it</p></main><div class="sidebar">s</div></div>', "words of it"),
        ('<div id="content" class="search-friendly"><p>words of it</p></div>', "words of it"),
        ('<div class="sidebar"><p>the whole page is in here</p></div><div class="ad">buy</div>', "the whole page is in here"),
        ("<form><div>a page in a form element</div><div class='site-nav'>n</div></form>", "a page in a form element"),
        ('<article><header><h1>Title</h1></header><p>a long body of text</p><section class="related-work"><p>others</p></section><footer>f</footer></article>', "Title a long body of text others"),
        ("<article><p>text<textarea>t</TEXTAREA><br>more</article>", "text more"),
        ("<article><p>1 < 2 and a<b</p></article>", "1 < 2 and a"),
    ],
)
def test_extraction(page, text):
    assert html_extract.extract(page, frozenset()) == text


@pytest.mark.parametrize("part", ["<p <p ", "<script", "<script>", "<", "<!--", "<div>", "</div>", "<div></b>", "<p class='a b", "<p x='>", "<textarea></TEXTAREA>", "<article>", "&"])
def test_a_megabyte_of_malformed_html(part):
    began = time.process_time()
    page = part * (1_000_000 // len(part))
    html_extract.extract(page)
    html_extract.frame(page)
    assert time.process_time() - began < 10  # seconds even on a busy machine; a quadratic scan takes an hour


def plain_templates(pages, share, least):
    """Classes by the definition: tokens with equal vectors of counts over the distinct pages, in enough of them."""
    distinct = {}
    for page in pages:
        distinct.setdefault(html_extract.extract(page), page)
    counts = [Counter(html_extract.tokens(p)) for p in distinct.values()]
    first = {}
    for c in counts:
        for place, t in enumerate(c, 1):
            first[t] = min(first.get(t, place), place)
    classes = defaultdict(list)
    for t in first:
        classes[tuple(c[t] for c in counts)].append(t)
    out = []
    for vector, members in classes.items():
        n = sum(v > 0 for v in vector)
        if n >= least and n >= share * len(counts) and len(members) > 1 and any(t.startswith("t:") for t in members):
            places = Counter(first[t] for t in members)
            out.append((n, [html_extract.token_hash(t) for t in sorted(members, key=lambda t: first[t]) if places[first[t]] == 1]))
    return sorted(out)


def test_classes_of_hosts_against_the_definition(spark, tmp_path):
    rng = random.Random(63)
    vocab = vocabulary(rng, 100)
    hosts = {}
    for h in range(4):
        for i in range(rng.randint(3, 14)):
            parts = [f"<div class='k{h}x'><i>{w}</i></div>" for w in rng.sample(["Top", "Hot", "New", "End"], rng.randint(1, 4))]
            body = f"<p>{' '.join(rng.choices(vocab, k=8))}</p>"
            hosts.setdefault(f"h{h}", []).append("<body>" + "".join(parts[:2]) + body + "".join(parts[2:]) + "</body>")
        hosts[f"h{h}"] += hosts[f"h{h}"][:2]
    rows = [(h, page) for h, pages in hosts.items() for page in pages]
    table = written(spark.createDataFrame(rows, "host string, html string"), tmp_path)
    of_host, _ = html_extract.templates(table)
    got = {r.host: sorted((c["n"], list(c["members"])) for c in r.of_host) for r in of_host.collect()}
    want = {h: plain_templates(pages, html_extract.TEMPLATE_SHARE, html_extract.TEMPLATE_PAGES) for h, pages in hosts.items()}
    assert got == {h: c for h, c in want.items() if c} and any(want.values())


def test_classes_nest_or_are_left_out():
    outer, inside, around, across = (5, [2, 10, 20]), (4, [11, 15]), (3, [1, 25]), (2, [5, 12])
    assert sorted(html_extract.nested([across, outer, inside])) == [1, 2]
    assert sorted(html_extract.nested([outer, inside, around])) == [0, 1, 2]
    assert html_extract.nested([across]) == [0]


def test_repeated_pages_and_kinds_of_one_page(spark, tmp_path):
    page = "<html><body><div>Same words here</div><p>and here</p></body></html>"
    rows = [(i, "http://one.example/a", page) for i in range(9)] + [(9, "http://two.example/b", page), (9, "http://two.example/b", page)]
    pages = written(spark.createDataFrame(rows, "page_id long, url string, html string"), tmp_path)
    assert [r.text for r in html_extract.extract_pages(pages).collect()] == ["Same words here and here"] * 11


def test_template_of_a_host(spark, tmp_path):
    rng = random.Random(6)
    vocab = vocabulary(rng, 300)
    rows, want = [], {}
    for i in range(40):
        body = " ".join(rng.choices(vocab, k=30))
        rows.append((i, f"https://user@Site.example:80/p{i}", f"<html><body><div><p>Top stories today</p></div><div><p>{body}</p></div><div>All rights kept</div></body></html>"))
        want[i] = body
    rows += [(100, None, None), (101, "not a url", "<p>alone</p>"), (102, "http://other/", "<article>" + "x " * 50000 + "</article>")]
    pages = written(spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit(1)), tmp_path)
    got = {r.page_id: r for r in html_extract.extract_pages(pages).collect()}
    assert {i: got[i].text for i in want} == want
    assert (got[100].text, got[101].text, got[102].n_chars) == ("", "alone", 99999)
    assert html_extract.extract_pages(written(pages.limit(0), tmp_path, "none")).count() == 0


def test_template_inside_articles(spark, tmp_path):
    rng = random.Random(61)
    vocab = vocabulary(rng, 300)
    rows, want = [], {}
    for i in range(30):
        want[i] = " ".join(rng.choices(vocab, k=30))
        rows.append((i, f"http://a.example/p{i}", f"<html><body><article><div class='x'>Top stories today</div><p>{want[i]}</p><div>All rights kept</div></article></body></html>"))
    for i in range(30, 40):  # copies of one article are no template
        want[i] = "a copied article in two runs"
        rows.append((i, f"http://b.example/p{i}", f"<nav>{vocab[i]}</nav><article><p>a copied article</p><p>in two runs</p></article>"))
    for i in range(40, 50):  # tokens that change places
        runs = ["first things", "second things"][:: 1 if i % 2 else -1]
        want[i] = f"{runs[0]} {vocab[i]} {runs[1]}"
        rows.append((i, f"http://c.example/p{i}", f"<article><p>{runs[0]}</p><p>{vocab[i]}</p><p>{runs[1]}</p></article>"))
    pages = written(spark.createDataFrame(rows, "page_id long, url string, html string"), tmp_path)
    got = {r.page_id: r.text for r in html_extract.extract_pages(pages).collect()}
    assert got == want


def test_templates_of_kinds_of_pages(spark, tmp_path):
    rng = random.Random(62)
    vocab = vocabulary(rng, 300)
    rows, want = [], {}
    for i in range(60):
        want[i] = " ".join(rng.choices(vocab, k=30))
        kind = ("news", "shop", "wiki")[i % 3]
        rows.append((i, f"http://a.example/p{i}", f"<html><body><div class='{kind}'><p>The {kind} pages</p></div><div><p>{want[i]}</p></div><div>End of {kind}</div></body></html>"))
    pages = written(spark.createDataFrame(rows, "page_id long, url string, html string"), tmp_path)
    assert {r.page_id: r.text for r in html_extract.extract_pages(pages).collect()} == want


# ---- 6: line dedup ------------------------------------------------------------------


def plain_lines(texts, least):
    keys = [[x.strip(" \t\n\x0b\x0c\r").translate(LOWER) for x in (t or "").split("\n")] for t in texts]
    n = Counter(k for ks in keys for k in set(ks) if k)
    return [(len(ks), sum(n[k] >= least for k in ks if k), "\n".join(x for x, k in zip((t or "").split("\n"), ks, strict=True) if not k or n[k] < least)) for t, ks in zip(texts, keys, strict=True)]


@pytest.mark.parametrize("limit", [1 << 20, -1])
def test_line_dedup(spark, tmp_path, monkeypatch, limit):
    monkeypatch.setattr(line_dedup, "BROADCAST_BYTES", limit)
    rng = random.Random(7)
    lines = ["Common Line", " common line\t", "\xa0common line", "", "  ", "ÄRGER", "ärger", *vocabulary(rng, 40)]
    texts = ["\n".join(rng.choices(lines, k=rng.randint(0, 9))) for _ in range(80)] + [None, "", "\n\n", "a\r\nb", "only", "Common Line"]
    docs = written(spark.createDataFrame([(i // 2, t, i) for i, t in enumerate(texts)], "doc_id long, text string, kept int"), tmp_path)
    for least in (3, 10):
        got = sorted((r.row.kept, r.n_lines, r.n_dropped, r.kept) for r in line_dedup.dedup_lines(docs, min_docs=least).collect())
        assert [g[1:] for g in got] == plain_lines(texts, least)


# ---- 7: nearest neighbours ----------------------------------------------------------


def test_neighbours(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ann, "PART_ROWS", 500)
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(12, 16))
    x = (centres[rng.integers(0, 12, 3000)] + 0.3 * rng.normal(size=(3000, 16))).astype(np.float32)
    x[500:1500] = x[500]  # a third of all rows are one vector
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    rows += [(3000, None), (3100, [0.0] * 16), (3200, [float("nan")] + [1.0] * 15), (3300, [None] + [1.0] * 15), (3400, [1.0] * 3), (None, [1.0] * 16), (3500, [float("inf")] * 16)]
    df = written(spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("leaf", F.lit(1)), tmp_path)
    got = defaultdict(list)
    for r in ann.search(df).collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    assert sorted(got) == list(range(0, 3000, 100))
    hits = 0
    y = x.astype(np.float64)
    for q, found in got.items():
        d = np.sqrt(((y - y[q]) ** 2).sum(1))
        d[q] = np.inf
        true = sorted(zip(d.tolist(), range(3000), strict=True))[:10]
        found.sort()
        assert [f[0] for f in found] == list(range(1, 11)) and len({f[1] for f in found}) == 10
        assert all(abs(s - d[v]) < 1e-12 for _, v, s in found) and [(s, v) for _, v, s in found] == sorted((s, v) for _, v, s in found)
        hits += len({v for _, v in true} & {v for _, v, _ in found})
    assert hits / (10 * len(got)) >= 0.9
    few = written(df.where("vec_id IN (0, 1, 2, 100)"), tmp_path, "few")
    assert ann.search(few).count() == 6
    assert ann.search(df.where("vec_id IS NULL")).count() == 0


# ---- 8: quality ---------------------------------------------------------------------


def test_sum_of_squares_identity():
    rng = np.random.default_rng(9)
    m = quality.Machine(np.zeros((16, 7)), 0.3, rng.normal(size=quality.BUCKETS + 128), rng.normal(size=(quality.BUCKETS + 128, quality.FACTORS)))
    i, x = np.array([3, 9, 4000, 8200]), rng.normal(size=4)
    plain = m.bias + sum(m.linear[i] * x) + sum((m.factors[a] @ m.factors[b]) * p * q for (a, p), (b, q) in itertools.combinations(list(zip(i, x, strict=True)), 2))
    assert abs(m.margin(i, x) - plain) < 1e-9


def test_quality_held_out(spark):
    docs, labels = labelled(spark)
    rows = {r.row.doc_id: r.score for r in quality.score(docs, quality.fit(docs, labels)).collect()}
    assert len(rows) == 403 and all(0 <= s <= 1 for s in rows.values())
    test = [(rows[r.doc_id] >= 0.5) == bool(r.quality) for r in labels.collect() if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert sum(test) / len(test) > 0.95


# ---- 9: decontamination -------------------------------------------------------------


def plain_distance(p, t):
    row = [0] * (len(t) + 1)
    for i, c in enumerate(p, 1):
        before, row[0] = row[:], i
        for j, d in enumerate(t, 1):
            row[j] = min(before[j] + 1, row[j - 1] + 1, before[j - 1] + (c != d))
    return min(row)


def test_myers_is_the_edit_distance():
    rng = random.Random(10)
    for _ in range(300):
        p = "".join(rng.choice("abc ") for _ in range(rng.randint(1, 12)))
        t = "".join(rng.choice("abc ") for _ in range(rng.randint(0, 30)))
        masks = {c: sum(1 << i for i, d in enumerate(p) if d == c) for c in p}
        assert decontaminate.myers(masks, len(p), t) == min(plain_distance(p, t), len(p))


@pytest.mark.parametrize("chars", [4_000_000, 300])
def test_contamination(spark, monkeypatch, chars):
    monkeypatch.setattr(decontaminate, "ITEM_CHARS", chars)
    rng = random.Random(11)
    vocab = vocabulary(rng, 60)
    items = [(i, " ".join(rng.choices(vocab, k=15))) for i in range(12)] + [(12, None), (13, " ?! "), (14, "tiny"), (None, "null item identifier words")]
    texts = []
    for _ in range(60):
        text = rng.choices(vocab, k=40)
        if rng.random() < 0.6:
            leak = list(rng.choice(items[:12])[1].upper())
            for _ in range(rng.choice((0, 1, 2, 4, 9))):
                leak[rng.randrange(len(leak))] = rng.choice("xyz ")
            text.insert(rng.randrange(40), "".join(leak) + ".")
        texts.append(" ".join(text))
    texts += [None, "", "tinyest", "a Tiny, b", "null-item identifier; words"]
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, hits int")
    got = {r.row.doc_id: sorted(((h.item_id if h.item_id is not None else -1), h.edits) for h in r.hits) for r in decontaminate.contamination(docs, spark.createDataFrame(items, "item_id long, text string")).collect()}
    for d, t in enumerate(texts):
        want = []
        for i, item in items:
            p, n = decontaminate.normal(item or ""), decontaminate.normal(t or "")
            if p.strip() and (e := plain_distance(p, n)) <= int(len(p) * decontaminate.ERROR_RATE):
                want.append((-1 if i is None else i, e))
        assert got[d] == sorted(want), (d, t)


# ---- 10: near duplicates ------------------------------------------------------------


def plain_classes(texts, percent):
    sets = []
    for t in texts:
        w = words(t)
        sets.append(frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset())
    parent = list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(range(len(texts)), 2):
        n = len(sets[a] & sets[b])
        if sets[a] and sets[b] and 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    return [(len(s), root(i)) for i, s in enumerate(sets)]


def near_texts(seed):
    """Families whose members differ more from the first than from each other, copies, and short texts."""
    rng = random.Random(seed)
    vocab = vocabulary(rng, 500)
    texts = [None, "", " ", "a b", "A  b", "a b c d e", "a b c d f", "a b"]
    for _ in range(6):
        base = rng.choices(vocab, k=rng.choice((12, 60, 200)))
        family = [base]
        for _ in range(14):
            t = list(rng.choice(family))
            for _ in range(max(1, len(t) * rng.choice((0, 1, 2, 3)) // 100)):
                t[rng.randrange(len(t))] = rng.choice(vocab)
            family.append(t)
        texts += [" ".join(t) for t in family]
    return texts + texts[8:12]


@pytest.mark.parametrize("seed,limit,block", [(1, 1 << 20, 512), (2, -1, 3)])
def test_near_duplicates(spark, tmp_path, monkeypatch, seed, limit, block):
    monkeypatch.setattr(near_dup, "BROADCAST_BYTES", limit)
    monkeypatch.setattr(near_dup, "BLOCK", block)
    texts = near_texts(seed)
    docs = written(spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, sid string"), tmp_path)
    for percent in (80, 85):
        rows = near_dup.NearDuplicates(docs, percent=percent).classes().collect()
        assert [(r.n_shingles, r.component_id) for r in sorted(rows, key=lambda r: r.doc_id)] == plain_classes(texts, percent)
        assert all(r.keep_row == (r.doc_id == r.component_id) for r in rows)


def test_finer_bands_meet_in_similar_sets_and_part_unlike_ones():
    rng = np.random.default_rng(13)
    for common, own, meets in ((400, 35, True), (40, 3, True), (12, 1, True), (100, 300, False)):
        met = []
        for _ in range(20):
            shared = rng.integers(0, 2**63, common, dtype=np.uint64)
            x, y = (near_dup.fine_keys(np.unique(np.concatenate([shared, rng.integers(0, 2**63, own, dtype=np.uint64)]))) for _ in range(2))
            met.append(bool((x == y).any()))
        assert all(met) if meets else np.mean(met) < 0.7


def test_a_hot_bucket_of_unlike_documents_loses_no_link(spark, tmp_path, monkeypatch):
    """Boilerplate puts all documents into common buckets; pairs far from every centre are still found."""
    monkeypatch.setattr(near_dup, "BLOCK", 20)
    rng = random.Random(14)
    vocab = vocabulary(rng, 2000)
    common, texts = rng.choices(vocab, k=90), []
    for _ in range(60):
        own = rng.choices(vocab, k=60)
        texts.append(" ".join(common + own))
        if rng.random() < 0.5:
            texts.append(" ".join(common + own[:-3] + rng.choices(vocab, k=2)))
    docs = written(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), tmp_path)
    rows = near_dup.NearDuplicates(docs, percent=85).classes().collect()
    want = plain_classes(texts, 85)
    assert [(r.n_shingles, r.component_id) for r in sorted(rows, key=lambda r: r.doc_id)] == want and len({c for _, c in want}) < len(texts)


def test_null_and_repeated_ids(spark, tmp_path):
    rows = [(None, "same words in both of them"), (4, "same words in both of them"), (4, "same words in both of them"), (None, "quite another text than that"), (None, "quite another text than that")]
    docs = written(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), tmp_path)
    got = near_dup.NearDuplicates(docs).classes().collect()
    assert sorted((str(r.doc_id), str(r.component_id)) for r in got) == [("4", "4"), ("4", "4"), ("None", "4"), ("None", "None"), ("None", "None")]
    assert sum(r.keep_row for r in got) == 2
    assert near_dup.NearDuplicates(written(docs.limit(0), tmp_path, "none")).classes().count() == 0


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(12)
    for common, own in ((400, 70), (170, 30), (40, 7)):
        shared = rng.integers(0, 2**63, common, dtype=np.uint64) * np.uint64(2)
        agree = []
        for _ in range(30):
            salt = np.uint64(rng.integers(1 << 30))
            s = near_dup.mix64(shared + salt)
            x, y = (near_dup.one_permutation(np.unique(np.concatenate([s, near_dup.mix64(rng.integers(0, 2**63, own, dtype=np.uint64))]))) for _ in range(2))
            agree.append((x == y).mean())
        assert abs(np.mean(agree) - common / (common + 2 * own)) < 0.05


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 40)] + [(200, 200)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(1, 61)} | {100 + i: 100 for i in range(1, 40)}
