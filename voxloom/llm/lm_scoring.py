"""Language-model scores by context-tree weighting over bytes.

A text is its lower-cased (A-Z) UTF-8 bytes and an end mark. Each byte is eight binary decisions, each with its own tree of contexts: the last 0 to
``DEPTH`` bytes. Every node has a Krichevsky-Trofimov estimate from the training texts; a node's weighted probability
is half its own estimate and half the product of its children's, so predictions mix all depths with weights that the
training texts settle. The sum over a text's decisions is its code length, reported as log10 probability.

The trees are gathered from exact counts of (DEPTH + 1)-byte grams of all documents, held-out ones with count 0, so that
every gram to be scored has a prediction. Grams are dealt by their three nearest context bytes: all deeper nodes of a
tree lie in one partition, and the eight decisions of a byte are worked out one after the other. The nodes above are summed:
at most 2 ** 24 after two bytes, whose shares and estimates are broadcast with those after one and none.

Predictions go to the scoring pass in slices of at most ``SLICE_GRAMS`` grams, each broadcast, scored and let go in turn;
a document's score is the sum over the slices. A model of more than ``MOST_SLICES`` slices is joined instead: documents form
blocks of ``BLOCK_BYTES``, the distinct grams of each block are joined to their predictions and meet the block again,
so that the documents are read once however large the model is. Both ways give the same scores.

The base score needs each token's count. Tokens that make up at least one in ``FREQUENT`` of all tokens are at most
FREQUENT, so they are broadcast; (document, token) pairs of the others are joined to the counts.

Tokens are told apart by 64-bit hashes (two of n tokens agree with a probability of about n * n / 2 ** 65), texts by their MD5.

Defined results: a null or empty text is the end mark alone; a null doc_id counts as the empty text for the fold;
repeated rows each count and each get a score; without training texts c, N and V are 0; other columns are ignored; an
empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import CACHE_BYTES, by_bytes, crc_of, held, join_facts, materialize, mix64, slices, table, utf8

DEPTH = 5
FOLDS, HELD_OUT = 7, 2
SLICE_GRAMS, MOST_SLICES = 1 << 22, 4
#: Bytes of text in a block whose grams are joined to a large model; grams whose trees are worked out at once.
BLOCK_BYTES, TREE_GRAMS = 4 << 20, 200_000
FREQUENT = 1 << 20
#: Bytes of text that a worker turns into grams at once, and distinct keys that it gathers before it sends them on.
_BYTES, _GATHERED = 1 << 20, 600_000
_GRAM = np.uint64((1 << 8 * (DEPTH + 1)) - 1)
#: The end token's hash; no word hashes to it by construction (see _Words).
_END = 0
_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)


class _Words(dict):
    """Token bytes to signed 64-bit hashes, never the end token's; keeps about ``CACHE_BYTES``."""

    room = CACHE_BYTES

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        h = (h - (1 << 64) if h >> 63 else h) or 1
        if self.room > 0:
            self.room -= len(word) + 180
            self[word] = h
        return h


def _grams(data: np.ndarray, at: np.ndarray, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
    """The grams of texts lo..hi (each led by DEPTH zero bytes and followed by one, the end mark) and where each text's begin."""
    sizes = np.diff(at[lo : hi + 1])
    n, total = hi - lo, int(sizes.sum())
    starts = np.concatenate([[0], np.cumsum(sizes + DEPTH + 1)])
    padded = np.zeros(starts[-1] + 8, np.uint8)
    shift = np.repeat(np.arange(n) * (DEPTH + 1) + DEPTH, sizes)
    padded[np.arange(total) + shift] = _LOWER[data[at[lo] : at[hi]]]
    windows = np.ndarray((starts[-1],), "<u8", padded, strides=(1,)) & _GRAM
    keep = np.ones(starts[-1], bool)
    for k in range(DEPTH):  # windows that would begin in the next text's padding
        keep[starts[1:] - 1 - k] = False
    return windows[keep], np.concatenate([[0], np.cumsum(sizes + 1)])


def _counted(values: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values, sorted, and their numbers (or the sums of their weights)."""
    if weights is None:
        values = np.sort(values)
    else:
        order = np.argsort(values)
        values, weights = values[order], weights[order]
    if not len(values):
        return values, np.zeros(0, np.int64)
    first = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
    return values[first], np.diff(np.append(first, len(values))) if weights is None else np.add.reduceat(weights, first)


def _tokens(data: np.ndarray, at: np.ndarray, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of texts lo..hi, each text's end last, and the number of each text's tokens."""
    whole = data[at[lo] : at[hi]].tobytes().lower()
    place = (at[lo : hi + 1] - at[lo]).tolist()
    words = [whole[a:b].split() for a, b in zip(place[:-1], place[1:], strict=True)]
    sizes = np.fromiter(map(len, words), np.int64, hi - lo) + 1
    out = np.full(int(sizes.sum()), _END, np.int64)
    inside = np.ones(len(out), bool)
    inside[np.cumsum(sizes) - 1] = False
    known = held("tokens", _Words).__getitem__
    out[inside] = np.fromiter((h for w in words for h in map(known, w)), np.int64, len(out) - (hi - lo))
    return out, sizes


class _Gathered:
    """Sums by key; hands rows on when many keys have come together."""

    def __init__(self, kind: int):
        self.kind, self.parts, self.size = kind, [], 0

    def add(self, keys: np.ndarray, n: np.ndarray):
        self.parts.append((keys, n))
        self.size += len(keys)
        if self.size > 2 * _GATHERED:
            self.parts = [_counted(*map(np.concatenate, zip(*self.parts, strict=True)))]
            self.size = len(self.parts[0][0])
            if self.size > _GATHERED:
                yield from self.rest()

    def rest(self):
        if self.size:
            keys, n = _counted(*map(np.concatenate, zip(*self.parts, strict=True)))
            yield pa.record_batch([pa.array(np.full(len(keys), self.kind, np.int8)), pa.array(keys), pa.array(n)], names=["kind", "key", "n"])
        self.parts, self.size = [], 0


def counts(docs: DataFrame) -> DataFrame:
    """(kind, key, n): kind 0, all grams with their number in training texts; kind 1, tokens of training texts. Written once.

    ``docs`` has text and held_out.
    """

    def run(batches):
        kinds = (_Gathered(0), _Gathered(1))
        for b in batches:
            data, at = utf8(b.column(0))
            out = np.array(b.column(1).to_pylist(), bool)
            for lo, hi in slices(at, _BYTES):
                grams, starts = _grams(data, at, lo, hi)
                test = np.repeat(out[lo:hi], np.diff(starts))
                seen, n = _counted(grams[~test])
                yield from kinds[0].add(seen.astype(np.int64), n)
                if test.any():
                    unseen = np.setdiff1d(_counted(grams[test])[0], seen, assume_unique=True).astype(np.int64)
                    yield from kinds[0].add(unseen, np.zeros(len(unseen), np.int64))
                words, sizes = _tokens(data, at, lo, hi)
                yield from kinds[1].add(*_counted(words[~np.repeat(out[lo:hi], sizes)]))
        for kind in kinds:
            yield from kind.rest()

    rows = docs.select("text", "held_out").mapInArrow(run, "kind tinyint, key long, n long")
    return materialize(rows.groupBy("kind", "key").agg(F.sum("n").alias("n")), "lm-counts")


def _log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Natural log of the Krichevsky-Trofimov probability of so many zeros and ones."""
    return _lgamma(zeros + 0.5) + _lgamma(ones + 0.5) - _lgamma(zeros + ones + 1.0) - np.log(np.pi)


def _lgamma(x: np.ndarray) -> np.ndarray:
    """log gamma of x > 0, by Stirling's series after a shift by 8."""
    product, y = np.ones_like(x), x.astype(float)
    for k in range(8):
        product = product * (x + k)
    y = y + 8
    series = 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5)
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + series - np.log(product)


def _weighted(own: np.ndarray, children: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """log of (exp(own) + exp(children)) / 2, and the share that the node's own estimate has in it."""
    both = np.logaddexp(own, children) - np.log(2)
    return both, np.exp(own - np.log(2) - both)


def _decision(symbols: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Of a byte's k-th bit from the top: the decision's number (1 to 255) and the bit."""
    return (symbols | 256) >> (8 - k), (symbols >> (7 - k)) & 1


def _levels(grams: np.ndarray, n: np.ndarray, k: int) -> list[dict]:
    """The nodes of depths DEPTH to 3 of decision ``k``, over a set of grams that holds whole subtrees."""
    number, bit = _decision(grams >> (8 * DEPTH), k)
    context, ones, out = grams & ((1 << 8 * DEPTH) - 1), n * bit, []
    for depth in range(DEPTH, 2, -1):
        key, place = np.unique((context >> (8 * (DEPTH - depth)) << 8) | number, return_inverse=True)
        one = np.bincount(place, ones, len(key))
        zero = np.bincount(place, n, len(key)) - one
        weighted, own = _log_kt(zero, one), np.ones(len(key))
        if out:
            below = out[-1]
            parent = np.searchsorted(key, _above(below["key"]))
            weighted, own = _weighted(weighted, np.bincount(parent, below["weighted"], len(key)))
        out.append({"key": key, "zero": zero, "one": one, "weighted": weighted, "own": own, "place": place})
    return out


def _above(key: np.ndarray) -> np.ndarray:
    """The node one byte nearer to the root, without the farthest byte of the context."""
    return ((key >> 16) << 8) | (key & 255)


def _top(key: np.ndarray, zero: np.ndarray, one: np.ndarray, below: np.ndarray) -> dict[str, np.ndarray]:
    """Own shares and estimates of the decisions after two bytes (sorted by ``key``), one (256 x 256) and none (256)."""
    order = np.argsort(key)
    key, zero, one, below = key[order], zero[order], one[order], below[order]
    weighted, own = _weighted(_log_kt(zero, one), below)
    near = _above(key)
    zero1, one1, below1 = (np.bincount(near, x, 1 << 16).reshape(256, 256) for x in (zero, one, weighted))
    weighted1, own1 = _weighted(_log_kt(zero1, one1), below1)
    zero0, one0 = zero1.sum(axis=0), one1.sum(axis=0)
    _, own0 = _weighted(_log_kt(zero0, one0), weighted1.sum(axis=0))
    p = lambda z, o: (o + 0.5) / (o + z + 1)
    return {"key": key.astype(np.int32), "own2": own.astype(np.float32), "p2": p(zero, one).astype(np.float32), "own1": own1, "p1": p(zero1, one1), "own0": own0, "p0": p(zero0, one0)}


def _predict(grams: np.ndarray, n: np.ndarray, top: dict[str, np.ndarray]) -> np.ndarray:
    """log10 of the mixed prediction of each gram's last byte."""
    near2, total = (grams >> (8 * (DEPTH - 2))) & 0xFFFF, np.zeros(len(grams))
    for k in range(8):
        number, bit = _decision(grams >> (8 * DEPTH), k)
        p = None
        for level in _levels(grams, n, k):
            estimate = ((level["one"] + 0.5) / (level["one"] + level["zero"] + 1))[level["place"]]
            own = level["own"][level["place"]]
            p = estimate if p is None else own * estimate + (1 - own) * p
        at = np.searchsorted(top["key"], (near2 << 8) | number)
        for own, estimate in ((top["own2"][at], top["p2"][at]), (top["own1"][near2 >> 8, number], top["p1"][near2 >> 8, number]), (top["own0"][number], top["p0"][number])):
            p = own * estimate + (1 - own) * p
        total += np.log10(np.where(bit == 1, p, 1 - p))
    return total


def _nearest(key: np.ndarray) -> np.ndarray:
    """The three nearest context bytes of grams."""
    return (key >> (8 * (DEPTH - 3))) & 0xFFFFFF


def _subtrees(batches):
    """The (grams, n) of batches that are sorted by three nearest context bytes, in sets of about ``TREE_GRAMS``, each with
    all grams of its contexts. A context has 2 ** 24 grams at most, so a task holds no more, however large its partition."""
    parts, size, wanted = [], 0, TREE_GRAMS
    for b in batches:
        parts.append((b.column(0).to_numpy(), b.column(1).to_numpy()))
        size += b.num_rows
        if size < wanted:
            continue
        key, n = (np.concatenate(x) for x in zip(*parts, strict=True))
        last = int(np.searchsorted(near := _nearest(key), near[-1]))  # its context may go on
        if last:
            yield key[:last], n[:last]
        parts, size = [(key[last:].copy(), n[last:].copy())], len(key) - last
        wanted = max(TREE_GRAMS, 2 * size)
    if size:
        yield tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def predictions(grams: DataFrame) -> DataFrame:
    """(gram, log10p) of (key, n) rows: the mixed prediction of each gram's last byte. Written once."""
    nearest = F.shiftrightunsigned("key", 8 * (DEPTH - 3)).bitwiseAND(F.lit(0xFFFFFF))
    dealt = grams.select("key", "n", nearest.alias("_near")).repartition("_near").sortWithinPartitions("_near").select("key", "n")

    def tops(batches):
        for key, n in _subtrees(batches):
            for k in range(8):
                top = _levels(key, n, k)[-1]
                above, place = np.unique(_above(top["key"]), return_inverse=True)
                yield pa.record_batch([pa.array(above), *(pa.array(np.bincount(place, top[c], len(above))) for c in ("zero", "one", "weighted"))], names=["key", "zero", "one", "weighted"])

    sums = dealt.mapInArrow(tops, "key long, zero double, one double, weighted double").groupBy("key").agg(*(F.sum(c).alias(c) for c in ("zero", "one", "weighted")))
    found = sums.toArrow()  # 2 ** 24 rows at most
    sent = grams.sparkSession.sparkContext.broadcast(_top(*(found.column(c).to_numpy() for c in ("key", "zero", "one", "weighted"))))

    def finish(batches):
        for key, n in _subtrees(batches):
            yield pa.record_batch([pa.array(key), pa.array(_predict(key, n, sent.value).astype(np.float32))], names=["gram", "log10p"])

    return materialize(dealt.mapInArrow(finish, "gram long, log10p float"), "lm-predictions")


class Lookup:
    """Open-addressing table from 64-bit keys to values, probed for whole arrays at once."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        """The last key stands for keys that are not there, and its value is zero."""
        self.keys, self.values, keys = keys, values, keys[:-1]
        self.bits = max(4, int(2 * len(keys)).bit_length())
        self.slots = np.full(1 << self.bits, len(keys), np.int32)
        left = np.arange(len(keys), dtype=np.int32)
        at = self._home(keys)
        while len(left):
            free = self.slots[at] == len(keys)
            self.slots[at[free]] = left[free]
            stay = self.slots[at] != left
            left, at = left[stay], (at[stay] + 1) & ((1 << self.bits) - 1)

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The values of keys; zero for those that are not there."""
        at = self._home(keys)
        found = self.slots[at]
        last = len(self.keys) - 1
        left = np.flatnonzero((self.keys[found] != keys) & (found != last))
        at = at[left]
        while len(left):
            at = (at + 1) & ((1 << self.bits) - 1)
            found[left] = self.slots[at]
            wrong = (self.keys[found[left]] != keys[left]) & (found[left] != last)
            left, at = left[wrong], at[wrong]
        return self.values[found]


_LOOKUPS: dict[str, tuple[str, Lookup]] = {}


def _lookup(use: str, sent) -> Lookup:
    """The table over a broadcast pair of arrays; a worker keeps the last one of each use."""
    name = str(sent._path if sent._path else id(sent))
    if _LOOKUPS.get(use, ("",))[0] != name:
        _LOOKUPS.pop(use, None)
        _LOOKUPS[use] = (name, Lookup(*sent.value))
    return _LOOKUPS[use][1]


def _gather(df: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The two columns as arrays, with the row at the end that ``Lookup`` asks for."""
    t = df.toArrow()
    keys, values = (t.column(k).to_numpy() for k in (0, 1))
    return np.append(keys, -1), np.append(values, np.zeros(1, values.dtype))


def _joined_scores(docs: DataFrame, model: DataFrame) -> DataFrame:
    """(address, score) of every row of (address, text) rows, by joining the distinct grams of each block of them to the model."""

    def number(batches):
        block, size = TaskContext.get().partitionId() << 32, 0
        for b in by_bytes(batches, 1, BLOCK_BYTES):
            block, size = (block + 1, 0) if size > BLOCK_BYTES else (block, size)
            size += b.column(1).nbytes
            yield pa.record_batch([pa.array(np.full(b.num_rows, block)), *b.columns], names=["block", "address", "text"])

    def distinct(batches):
        for b in batches:
            blocks = b.column(0).to_numpy()
            for block in np.unique(blocks):
                data, at = utf8(b.column(1).filter(pa.array(blocks == block)))
                found = [_counted(_grams(data, at, lo, hi)[0])[0] for lo, hi in slices(at, _BYTES)]
                grams = _counted(np.concatenate(found))[0].astype(np.int64)
                yield pa.record_batch([pa.array(np.full(len(grams), block)), pa.array(grams)], names=["block", "gram"])

    def total(texts: pa.Table, found: pa.Table) -> pa.Table:
        table = Lookup(np.append(found["gram"].to_numpy(), -1), np.append(found["log10p"].to_numpy(), np.zeros(1, np.float32)))
        data, at = utf8(texts["text"])
        sums = []
        for lo, hi in slices(at, _BYTES):
            grams, starts = _grams(data, at, lo, hi)
            sums.append(np.add.reduceat(table.get(grams.astype(np.int64)).astype(np.float64), starts[:-1]))
        return pa.table({"address": texts["address"], "score": np.concatenate(sums)})

    blocked = materialize(docs.mapInArrow(number, "block long, address binary, text string"), "lm-blocks")
    needed = materialize(blocked.select("block", "text").mapInArrow(distinct, "block long, gram long").distinct(), "lm-needed")
    found = needed.join(model, "gram").select("block", "gram", "log10p")
    return blocked.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(total, "address binary, score double")


def score(docs: DataFrame, held_out: Column) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), held_out.alias("held_out"))
    both = counts(docs)
    tokens, grams = both.where("kind = 1").select("key", "n"), both.where("kind = 0").select("key", "n")
    total, distinct = tokens.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    model = predictions(grams)
    parts = max(1, -(-model.count() // SLICE_GRAMS))
    frequent = spark.sparkContext.broadcast(_gather(tokens.where(F.col("n") * FREQUENT >= total).select("key", "n")))  # FREQUENT rows at most
    address = F.unhex(F.md5(F.col("text").cast("binary"))).alias("address")

    def slice_scores(sent):
        def run(batches):
            for b in batches:
                data, at = utf8(b.column(1))
                for lo, hi in slices(at, _BYTES):
                    grams, starts = _grams(data, at, lo, hi)
                    sums = np.add.reduceat(_lookup("model", sent).get(grams.astype(np.int64)).astype(np.float64), starts[:-1])
                    yield pa.record_batch([b.column(0)[lo:hi], pa.array(sums)], names=["address", "score"])

        return run

    def token_scores(sent):
        """Sums over the frequent tokens, the others with their numbers, and the score of slice ``sent``, if any."""

        def run(batches):
            common = _lookup("common", frequent)
            names = ["doc_id", "held_out", "address", "n_tokens", "n_known", "base", "score", "rare", "times"]
            for b in batches:
                data, at = utf8(b.column(1))
                for lo, hi in slices(at, _BYTES):
                    sums = np.zeros(hi - lo)
                    if sent is not None:
                        grams, starts = _grams(data, at, lo, hi)
                        sums = np.add.reduceat(_lookup("model", sent).get(grams.astype(np.int64)).astype(np.float64), starts[:-1])
                    words, sizes = _tokens(data, at, lo, hi)
                    first = np.concatenate([[0], np.cumsum(sizes)])
                    c = common.get(words)
                    base = np.add.reduceat(np.log10(c + 1.0), first[:-1])
                    known = np.add.reduceat((c > 0).astype(np.int64), first[:-1])
                    rare, times = [], []
                    for a, e in zip(first[:-1], first[1:], strict=True):
                        r, t = np.unique(words[a:e][c[a:e] == 0], return_counts=True)
                        rare.append(r)
                        times.append(t)
                    lists = [pa.array(x, pa.list_(kind)) for x, kind in ((rare, pa.int64()), (times, pa.int32()))]
                    rows = [b.column(0)[lo:hi], b.column(2)[lo:hi], b.column(3)[lo:hi]]
                    yield pa.record_batch([*rows, pa.array(sizes), pa.array(known), pa.array(base), pa.array(sums), *lists], names=names)

        return run

    def broadcast(k: int):
        part = model if parts == 1 else model.where(F.pmod(F.xxhash64("gram"), F.lit(parts)) == k)
        return spark.sparkContext.broadcast(_gather(part.select("gram", "log10p")))  # SLICE_GRAMS rows or about as many

    sent = broadcast(0) if parts <= MOST_SLICES else None
    schema = "doc_id long, held_out boolean, address binary, n_tokens long, n_known long, base double, score double, rare array<long>, times array<int>"
    first = materialize(docs.select("doc_id", "text", "held_out", address).mapInArrow(token_scores(sent), schema), "lm-tokens")
    texts, more = docs.select(address, "text"), []
    if sent is None:
        more.append(materialize(_joined_scores(texts, model), "lm-scores"))
    for k in range(1, parts if sent else 0):
        sent.unpersist()  # what it gave is written
        sent = broadcast(k)
        more.append(materialize(texts.mapInArrow(slice_scores(sent), "address binary, score double"), "lm-slice"))
    rare = first.select("address", F.explode(F.arrays_zip("rare", "times")).alias("x")).select("address", F.col("x.rare").alias("key"), F.col("x.times").alias("times"))
    seldom = tokens.where(F.col("n") * FREQUENT < total)
    rest = rare.join(seldom, "key").groupBy("address").agg(F.sum(F.col("times") * F.log10(F.col("n") + F.lit(1.0))).alias("more"), F.sum("times").alias("more_known"))
    # of a text's rare tokens there are the sums of all its copies
    copies = first.groupBy("address").agg(F.count("*").alias("copies"))
    facts = rest.join(copies, "address").select("address", (F.col("more") / F.col("copies")).alias("more"), (F.col("more_known") / F.col("copies")).cast("long").alias("more_known"))
    for k, part in enumerate(more):
        facts = facts.join(part.groupBy("address").agg(F.max("score").alias(f"score{k}")), "address", "full")
    rows = join_facts(first.withColumn("_row", F.monotonically_increasing_id()), materialize(facts, "lm-facts"), "address", "_row")
    log_all = F.log10(F.lit(float(total) + distinct + 1))
    whole = sum((F.col(f"score{k}") for k in range(len(more))), F.col("score"))
    return rows.select("doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"), F.lit(total).cast("long").alias("train_tokens"), (F.col("base") + F.coalesce("more", F.lit(0.0)) - F.col("n_tokens") * log_all).alias("base_score"), whole.alias("score"))


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"), crc_of(F.col("doc_id")) % FOLDS == HELD_OUT)


QUERIES = {"op9_lm_scoring": op9_lm_scoring}
SQL: dict[str, str] = {}
