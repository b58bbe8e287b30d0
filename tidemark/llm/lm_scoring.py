"""LM scoring: a smoothed n-gram model as a weighted backoff automaton, split over the corpus.

States are the contexts seen in training; an arc leaves a state for each n-gram seen
after it, and a failure arc leads to the next shorter context.  With Dirichlet smoothing
of strength ``mu`` the arc of (h, w) has the weight ``log10 p(w | h)``, where ``p(w | h) =
(c(hw) + mu * p(w | shorter h)) / (c(h) + mu)``, and the failure arc of h has
``log10(mu / (c(h) + mu))``.  The empty context is the add-half unigram model over all
training tokens and one unknown token, so the weights of every state add up to one.
Each level has its own ``mu``, the one at which the failure mass that a left-out token
is to expect equals the share of n-grams seen once (see ``strength``).

The automaton is never held in one place.  Texts are read in blocks of bounded size (a
rule of the row order of each input split).  Each block sends its distinct n-grams with
its training counts to the owners of hash ranges, which add up all blocks and send back
the totals: every state and arc that this block can ever meet.  There are ``FAN`` ranges.
Beyond ``FAN`` blocks, blocks are merged in groups of about ``FAN`` first, and the merged
counts are asked for in the same way by finer ranges: messages keep their size, and their
number grows with the text times the (logarithmic) number of such rounds.  A second read
then traverses each document left to right on its block's automaton.  Every n-gram of
every training document counts; nothing is pruned.

Words are known by 64-bit hashes.  Longer n-grams are known by as many bits as make it
less likely than 2**-18 that one shares its number with another (see ``key_bits``).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import WordHasher, arrow_settings, fold, hash_rows, map_batches, materialise, pin_splits, text_of, words_of

ORDER = 3
#: Text of a block, and the number of hash ranges and of blocks merged at once: both bound the memory of a task.
BLOCK_BYTES, FAN = 4 << 20, 256
#: Tokens that a lane of the traversal reads; the state at its start follows from the ORDER - 1 tokens before.
LANE = 256
START, END = np.uint64(0x243F6A8885A308D3), np.uint64(0x13198A2E03707344)
#: Bins of the histogram of counts: 1 to 32 each for itself, then by powers of two.
EXACT, BINS = 32, 64
ASK_SCHEMA = "level int, part long, node long, n int, keys binary, counts binary"
REPLY_SCHEMA = "level int, part long, node long, n int, totals binary, types long, tokens long, once long, hist array<long>"
TEXT_SCHEMA = "node long, place int, doc_ids array<long>, held array<boolean>, sizes array<int>, texts binary"
SCORE_SCHEMA = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def key_bits(size: int) -> int:
    """Bits of an n-gram's key, by the bytes of text (at least twice its tokens)."""
    return min(64, max(40, 17 + math.ceil(math.log2(size + 2))))


def pack_sorted(keys: np.ndarray) -> bytes:
    """Gaps of an ascending uint64 array, byte plane by byte plane, compressed."""
    import zstandard

    gaps = np.diff(keys, prepend=np.uint64(0))
    return zstandard.ZstdCompressor(level=1).compress(gaps.view(np.uint8).reshape(-1, 8).T.tobytes())


def unpack_sorted(data: bytes) -> np.ndarray:
    import zstandard

    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def pack_counts(counts: np.ndarray) -> bytes:
    import zstandard

    top = int(counts.max(initial=0))
    return zstandard.ZstdCompressor(level=1).compress(counts.astype(np.uint8 if top < 1 << 8 else np.uint32 if top < 1 << 32 else np.uint64).tobytes())


def unpack_counts(data: bytes, n: int) -> np.ndarray:
    import zstandard

    raw = zstandard.ZstdDecompressor().decompress(data) if n else b""
    return np.frombuffer(raw, {1: np.uint8, 4: np.uint32, 8: np.uint64}[len(raw) // n] if n else np.uint8).astype(np.int64)


def distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct values, the number of each place's value, and a place of each value."""
    order = np.argsort(values)
    ascending = values[order]
    new = np.ones(len(values), bool)
    new[1:] = ascending[1:] != ascending[:-1]
    number = np.empty(len(values), np.int32)
    number[order] = np.cumsum(new, dtype=np.int32) - 1
    return ascending[new], number, order[new]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list]]:
    """(number, rows) for each block of a split: a block closes when its texts reach ``BLOCK_BYTES``."""
    rows, size, number = [], 0, 0
    for batch in batches:
        for row in zip(batch["doc_id"].to_pylist(), batch["held_out"].to_pylist(), batch["text"].to_pylist(), strict=True):
            rows.append(row)
            size += len(row[2]) + 1
            if size >= BLOCK_BYTES:
                yield number, rows
                rows, size, number = [], 0, number + 1
    if rows:
        yield number, rows


class Block:
    """The n-grams of a block of texts: per level the distinct keys, each place's key number, and a place of each key."""

    def __init__(self, rows: list, order: int, bits: int):
        hasher = WordHasher()
        parts, lengths = [], []
        for _, _, text in rows:
            h = hasher(words_of(text))
            parts += [START.reshape(1), h, END.reshape(1)]
            lengths.append(len(h) + 2)
        self.lengths = np.array(lengths, np.int64)
        seq = np.concatenate(parts)
        self.begin = np.cumsum(self.lengths) - self.lengths
        self.place = (np.arange(len(seq)) - np.repeat(self.begin, self.lengths)).astype(np.int32)  # 0 at START
        self.train = np.repeat(np.array([not r[1] for r in rows]), self.lengths)
        self.is_end = np.zeros(len(seq), bool)
        self.is_end[self.begin + self.lengths - 1] = True
        self.keys, self.number, self.at = [], [], []  # number is -1 where an n-gram would reach into the text before
        for level in range(1, order + 1):
            grams = hash_rows(seq, level) if len(seq) >= level else np.zeros(0, np.uint64)
            if level > 1:
                grams = grams >> np.uint64(64 - bits)
            last = np.flatnonzero(self.place >= level - 1)
            keys, inverse, first = distinct(grams[last - (level - 1)])
            number = np.full(len(seq), -1, np.int32)
            number[last] = inverse
            self.keys.append(keys)
            self.number.append(number)
            self.at.append(last[first])

    def counts(self, level: int) -> np.ndarray:
        mine = self.number[level - 1][self.train]
        return np.bincount(mine[mine >= 0], minlength=len(self.keys[level - 1]))


def ranges(keys: np.ndarray, bits: int, part: int, of: int, fan: int) -> np.ndarray:
    """Places in the sorted ``keys`` of part ``part`` of ``of`` where its ``fan`` equal sub-ranges begin and end."""
    edges = [-(-((part * fan + i) << bits) // (of * fan)) for i in range(1, fan)]
    return np.concatenate([[0], np.searchsorted(keys, np.array(edges, np.uint64)), [len(keys)]]).astype(np.int64)


def _bits_of(level: int, bits: int) -> int:
    return 64 if level == 1 else bits


def _asks(level: int, node: int, keys: np.ndarray, counts: np.ndarray, bits: int, part: int, of: int, fan: int) -> list[tuple]:
    cut = ranges(keys, _bits_of(level, bits), part, of, fan)
    return [(level, part * fan + i, node, int(b - a), pack_sorted(keys[a:b]), pack_counts(counts[a:b])) for i, (a, b) in enumerate(zip(cut[:-1], cut[1:], strict=True)) if b > a]


def _ask_table(rows: list[tuple]) -> dict:
    kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary())
    names = [x.split()[0] for x in ASK_SCHEMA.split(", ")]
    return {n: pa.array(c, t) for n, c, t in zip(names, zip(*rows, strict=True) if rows else [[]] * 6, kinds, strict=True)}


def _node(number: int) -> int:
    from pyspark import TaskContext

    return (TaskContext.get().partitionId() << 24) + number


def _ask(order: int, bits: int, fan: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, rows in _blocks(batches):
            block, node = Block(rows, order, bits), _node(number)
            for level in range(1, order + 1):
                out = _asks(level, node, block.keys[level - 1], block.counts(level), bits, 0, 1, fan)
                for at in range(0, len(out), 64):
                    yield pa.RecordBatch.from_pydict(_ask_table(out[at : at + 64]))

    return run


def _together(table: pa.Table) -> tuple[list[int], np.ndarray, np.ndarray, np.ndarray]:
    """Of asks of one range: their lengths, the distinct keys, each asked key's number, the sums of the counts."""
    n = table["n"].to_pylist()
    keys, number, _ = distinct(np.concatenate([unpack_sorted(k) for k in table["keys"].to_pylist()]))
    counts = np.concatenate([unpack_counts(c, k) for c, k in zip(table["counts"].to_pylist(), n, strict=True)])
    return n, keys, number, np.bincount(number, counts, len(keys)).astype(np.int64)


def _reply(table: pa.Table, n: list[int], number: np.ndarray, total: np.ndarray, types: int = 0, tokens: int = 0, once: int = 0, hist: list[int] | None = None) -> pa.Table:
    replies, at = [], 0
    for k in n:
        replies.append(pack_counts(total[number[at : at + k]]))
        at += k
    first = lambda x: pa.array([x] + [0] * (len(n) - 1), pa.int64())
    hists = pa.array([hist] + [None] * (len(n) - 1), pa.list_(pa.int64()))
    return pa.table({"level": table["level"], "part": table["part"], "node": table["node"], "n": table["n"], "totals": pa.array(replies, pa.binary()), "types": first(types), "tokens": first(tokens), "once": first(once), "hist": hists})


def histogram(totals: np.ndarray) -> list[int]:
    """Per bin the number of n-grams, then per bin the sum of their counts."""
    seen = totals[totals > 0]
    bins = np.where(seen <= EXACT, seen - 1, np.minimum(EXACT + np.log2(np.maximum(seen, 1) / EXACT).astype(np.int64), BINS - 1))
    return [*np.bincount(bins, minlength=BINS).tolist(), *np.bincount(bins, seen, BINS).astype(np.int64).tolist()]


def _answer(table: pa.Table) -> pa.Table:
    """The totals of a range's n-grams for each block, and sums over the range's training n-grams."""
    level = table["level"][0].as_py()
    n, keys, number, total = _together(table)
    no_context = np.isin(keys, hash_rows(END.reshape(1), 1)) if level == 1 else np.zeros(len(keys), bool)
    no_token = np.isin(keys, hash_rows(START.reshape(1), 1)) if level == 1 else np.zeros(len(keys), bool)
    token = (total > 0) & ~no_token
    return _reply(table, n, number, total, int(token.sum()), int(total[token].sum()), int((total == 1).sum()), histogram(total[~no_context]))


def _merge(bits: int, of: int, fan: int):
    """Asks of a group of blocks for one range as one ask for each of its sub-ranges."""

    def run(table: pa.Table) -> pa.Table:
        _, keys, _, total = _together(table)
        return pa.table(_ask_table(_asks(table["level"][0].as_py(), table["super"][0].as_py(), keys, total, bits, table["part"][0].as_py(), of, fan)))

    return run


def _spread(asks: pa.Table, replies: pa.Table) -> pa.Table:
    """The totals of a group for each of its blocks."""
    n, keys, number, _ = _together(asks)
    replies = replies.sort_by("part")
    total = np.concatenate([unpack_counts(t, k) for t, k in zip(replies["totals"].to_pylist(), replies["n"].to_pylist(), strict=True)])
    if len(total) != len(keys):
        raise RuntimeError(f"{len(total)} totals for {len(keys)} n-grams; the input changed between two reads")
    sums = [int(np.sum(replies[c].to_numpy())) for c in ("types", "tokens", "once")]
    hists = [h for h in replies["hist"].to_pylist() if h]
    return _reply(asks, n, number, total, *sums, np.sum(hists, axis=0).tolist() if hists else None)


def resolve(asks: DataFrame, nodes: int, bits: int, fan: int, of: int = 1) -> DataFrame:
    """Replies to all asks.  ``of``: the number of ranges that a sub-range of these asks comes from."""
    if nodes <= fan:
        return materialise(asks.groupBy("level", "part").applyInArrow(_answer, REPLY_SCHEMA), "totals")
    groups = -(-nodes // fan)
    asks = materialise(asks.withColumn("super", F.pmod(F.xxhash64("node"), F.lit(groups))), "asks")
    merged = asks.groupBy("level", "part", "super").applyInArrow(_merge(bits, of * fan, fan), ASK_SCHEMA)
    totals = resolve(merged, groups, bits, fan, of * fan)
    totals = totals.select("level", F.floor(F.col("part") / fan).alias("of_part"), F.col("node").alias("super"), "part", "n", "totals", "types", "tokens", "once", "hist")
    both = asks.groupBy("level", "part", "super").cogroup(totals.groupBy("level", "of_part", "super"))
    return materialise(both.applyInArrow(_spread, REPLY_SCHEMA), "totals")


def strength(once: int, contexts: np.ndarray, tokens: np.ndarray) -> float:
    """The mu at which ``sum c * mu / (c - 1 + mu)`` over contexts of count c equals ``once``.

    The left side is the failure mass that tokens, each left out in turn, are to expect;
    the right side is how many of them the rest has not seen in their context.
    contexts, tokens: per bin the number of contexts and the sum of their counts.
    """
    some = contexts > 0
    c = tokens[some] / contexts[some]
    low, high = math.log(1e-3), math.log(1e6)
    for _ in range(60):
        middle = (low + high) / 2
        mu = math.exp(middle)
        if (tokens[some] * mu / (c - 1 + mu)).sum() > once:
            high = middle
        else:
            low = middle
    return math.exp((low + high) / 2)


class Automaton:
    """States, arcs and failure arcs of the n-grams of a block, from their totals in training.

    A state is a number: 0 the empty context, others by ``of[level]`` of an n-gram's number.
    Arcs are numbered likewise by ``arc_of``; -1 is none.  ``fail`` and ``fail_weight`` are
    by state, ``weight`` and ``next`` by arc.
    """

    def __init__(self, block: Block, totals: list[np.ndarray], tokens: int, types: int, mus: list[float]):
        order = len(totals)
        self.block, self.order, self.depth = block, order, [np.zeros(1, np.int8)]
        self.of: list[np.ndarray] = []
        self.arc_of: list[np.ndarray] = []
        fail, fail_weight, weight, next_ = [np.zeros(1, np.int32)], [np.zeros(1)], [], []
        states, arcs = 1, 0
        p: np.ndarray | None = None
        for level in range(1, order + 1):
            at, total = block.at[level - 1], totals[level - 1]
            shorter = block.number[level - 2][at] if level > 1 else None  # without its first token
            if level == 1:
                p = (total + 0.5) / (tokens + 0.5 * (types + 1))
            else:
                context, mu = totals[level - 2][block.number[level - 2][at - 1]], mus[level - 2]
                p = np.where(context > 0, (total + mu * p[shorter]) / (context + mu), p[shorter])
            back = self.of[-1][shorter] if level > 1 else np.zeros(len(at), np.int32)  # the next shorter context's state
            seen = (total > 0) | (level == 1)
            state = np.full(len(at), -1, np.int32)
            if level < order:
                new = (total > 0) & ~block.is_end[at]
                state[new] = np.arange(states, states + new.sum(), dtype=np.int32)
                states += int(new.sum())
                fail.append(back[new])
                fail_weight.append(np.log10(mus[level - 1] / (total[new] + mus[level - 1])))
                self.depth.append(np.full(int(new.sum()), level, np.int8))
            if level == 1:
                state[state < 0] = 0
            elif level < order:
                state = np.where(state < 0, back, state)
            arc = np.full(len(at), -1, np.int32)
            arc[seen] = np.arange(arcs, arcs + seen.sum(), dtype=np.int32)
            arcs += int(seen.sum())
            weight.append(np.log10(p[seen]))
            next_.append(np.maximum((state if level < order else back)[seen], 0))
            self.of.append(state)
            self.arc_of.append(arc)
        self.fail, self.fail_weight, self.depths = np.concatenate(fail), np.concatenate(fail_weight), np.concatenate(self.depth)
        self.weight, self.next = np.concatenate(weight), np.concatenate(next_)

    def arcs_at(self, places: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """The arc that the token of each place takes from the state of the ``depth`` tokens before it, -1 if none."""
        out = np.full(len(places), -1, np.int32)
        for d in range(self.order):
            mine = depth == d
            number = self.block.number[d][places[mine]]
            out[mine] = np.where(number >= 0, self.arc_of[d][number], -1)
        return out

    def walk(self, lane: int = 0) -> np.ndarray:
        """log10 p of every token (0 at START), from one traversal left to right that carries the state.

        Texts are read in lanes of ``lane`` tokens side by side.  A lane inside a text reads
        the ORDER - 1 tokens before it first: the state after them is the same from any start.
        """
        block, lane = self.block, lane or LANE
        out = np.zeros(len(block.place))
        first = np.concatenate([np.arange(b + 1, b + n, lane) for b, n in zip(block.begin.tolist(), block.lengths.tolist(), strict=True)])
        stop = np.minimum(first + lane, np.repeat(block.begin + block.lengths, -(-(block.lengths - 1) // lane)))
        at = first - np.minimum(self.order - 1, block.place[first])
        state = np.zeros(len(first), np.int32)
        start = block.place[at] == 0  # at START, which is read without a score
        state[start] = self.of[0][block.number[0][at[start]]]
        at = at + start
        while len(at):
            gained = np.zeros(len(at))
            arc = self.arcs_at(at, self.depths[state])
            lost = np.flatnonzero(arc < 0)
            while len(lost):
                gained[lost] += self.fail_weight[state[lost]]
                state[lost] = self.fail[state[lost]]
                arc[lost] = self.arcs_at(at[lost], self.depths[state[lost]])
                lost = lost[arc[lost] < 0]
            scored = at >= first
            out[at[scored]] = (gained + self.weight[arc])[scored]
            state = self.next[arc]
            at = at + 1
            going = at < stop
            if not going.all():
                at, state, first, stop = at[going], state[going], first[going], stop[going]
        return out


def _tag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import zstandard

    names = [x.split()[0] for x in TEXT_SCHEMA.split(", ")]
    kinds = (pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int32()), pa.binary())
    for number, rows in _blocks(batches):
        packed = zstandard.ZstdCompressor(level=1).compress(b"".join(r[2] for r in rows))
        row = (_node(number), 0, [r[0] for r in rows], [r[1] for r in rows], [len(r[2]) for r in rows], packed)
        yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, kinds, strict=True)], names=names)


def _rows_of(texts: pa.Table) -> list[tuple]:
    import zstandard

    rows = []
    for ids, held, sizes, packed in zip(*(texts[c].to_pylist() for c in ("doc_ids", "held", "sizes", "texts")), strict=True):
        data, at = zstandard.ZstdDecompressor().decompress(packed, max_output_size=max(1, sum(sizes))), 0
        for i, h, n in zip(ids, held, sizes, strict=True):
            rows.append((i, h, data[at : at + n]))
            at += n
    return rows


def _score(order: int, bits: int, tokens: int, types: int, mus: list[float]):
    def run(texts: pa.Table, replies: pa.Table) -> pa.Table:
        rows = _rows_of(texts)
        block = Block(rows, order, bits)
        replies = replies.sort_by([("level", "ascending"), ("part", "ascending")])
        levels = replies["level"].to_numpy()
        got = [unpack_counts(t, n) for t, n in zip(replies["totals"].to_pylist(), replies["n"].to_pylist(), strict=True)]
        totals = []
        for level in range(1, order + 1):
            total = np.concatenate([got[i] for i in np.flatnonzero(levels == level)] or [np.zeros(0, np.int64)])
            if len(total) != len(block.keys[level - 1]):
                raise RuntimeError(f"block of {len(rows)} rows: {len(total)} totals for {len(block.keys[level - 1])} n-grams; the input changed between two reads")
            totals.append(total)
        gained = Automaton(block, totals, tokens, types, mus).walk()
        unigram = totals[0][block.number[0]]
        here = block.place > 0
        base = np.where(here, np.log10((unigram + 0.5) / (tokens + 0.5 * (types + 1))), 0.0)
        add = lambda x: np.add.reduceat(x, block.begin)
        return pa.table(
            {
                "doc_id": pa.array([r[0] for r in rows], pa.int64()),
                "held_out": pa.array([r[1] for r in rows], pa.bool_()),
                "n_tokens": pa.array(block.lengths - 1, pa.int64()),
                "n_known": pa.array(add((here & (unigram > 0)).astype(np.int64)), pa.int64()),
                "base_score": pa.array(add(base), pa.float64()),
                "score": pa.array(add(gained), pa.float64()),
            }
        )

    return run


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER, folds: int = 5, held_fold: int = 1, fan: int = FAN) -> DataFrame:
    """Per row: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, strengths`` (mu per level from 2).

    Rows whose crc32(id as text) modulo ``folds`` is ``held_fold`` are held out of
    training.  Null or empty text is the end token alone; a null id hashes as the empty
    text.  Repeated rows train and are scored each; equal texts of one fold get equal
    scores.  A text of any length is read whole.  An empty table gives an empty result.
    Columns other than the two named ones are not read.  Ids are integers.  ``docs`` must
    be a stable source.
    """
    spark = docs.sparkSession
    pin_splits(spark)  # both reads must see the same blocks
    arrow_settings(spark)
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), (fold(folds, f"`{id_col}`") == held_fold).alias("held_out"), text_of(f"`{text_col}`").cast("binary").alias("text"))
    sizes = rows.groupBy(F.spark_partition_id().alias("split")).agg(F.sum(F.length("text") + 1).alias("size"))
    size, nodes = sizes.agg(F.sum("size"), F.sum(F.ceil(F.col("size") / BLOCK_BYTES))).first()
    bits = key_bits(int(size or 0))
    replies = resolve(map_batches(rows, _ask(order, bits, fan), ASK_SCHEMA), int(nodes or 0), bits, fan)
    tokens, types, mus = statistics(replies, order)
    tagged = map_batches(rows, _tag, TEXT_SCHEMA)
    scored = tagged.groupBy("node").cogroup(replies.select("node", "level", "part", "totals", "n").groupBy("node")).applyInArrow(_score(order, bits, tokens, types, mus), SCORE_SCHEMA)
    strengths = F.array(*[F.lit(m) for m in mus]).cast("array<double>")
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"), "base_score", "score", strengths.alias("strengths"))


def statistics(replies: DataFrame, order: int) -> tuple[int, int, list[float]]:
    """Training tokens, distinct ones, and the strength of each level from 2, from sums over all ranges."""
    sums = {r["level"]: r for r in replies.groupBy("level").agg(F.sum("types").alias("types"), F.sum("tokens").alias("tokens"), F.sum("once").alias("once")).collect()}
    bins: dict[int, np.ndarray] = {level: np.zeros(2 * BINS, np.int64) for level in range(1, order + 1)}
    for r in replies.where("hist IS NOT NULL").select("level", F.posexplode("hist").alias("bin", "x")).groupBy("level", "bin").agg(F.sum("x").alias("x")).collect():
        bins[r["level"]][r["bin"]] = r["x"]
    once = lambda level: sums[level]["once"] if level in sums else 0
    mus = [strength(once(level), bins[level - 1][:BINS], bins[level - 1][BINS:]) for level in range(2, order + 1)]
    return (int(sums[1]["tokens"] or 0), int(sums[1]["types"] or 0), mus) if 1 in sums else (0, 0, mus)
