"""LM scoring by deleted interpolation of word n-grams.

A word's probability mixes the maximum-likelihood estimates of its n-gram, of the shorter ones and
of the uniform distribution; the mixture depends on how frequent the context is. The mixtures are
learnt by expectation-maximisation on a part of the training texts that the counts leave out.

Words and n-grams are 64-bit hashes. Tasks turn documents into packs: the distinct hashes with
their counts, sorted and dealt to ranges of the hash space, and each token's place among them. One
shuffle brings a range's packs together, where counts are summed, and one brings the sums back to
the packs they came from. Ranges and packs are bounded, so no task holds a whole vocabulary.
Where there are so many ranges that each pack would be dealt in crumbs, packs are dealt to few
coarse ranges, merged there into packs of their own, and those are dealt on.
"""

from __future__ import annotations

import json
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, functions as F

from quern.llm.storage import discard, materialize

ORDER = 2
#: Tokens of one pack, and tokens that a range of the hash space holds on average.
PACK_TOKENS, RANGE_TOKENS = 350_000, 3_000_000
#: Ranges that a pack is dealt to at once, at most; beyond it packs are dealt in two steps.
WAYS = 4096
#: Tasks that ranges are shared out to, at most; a task takes its ranges one by one.
TASKS = 20_000
#: Remainder of the held-out texts, and of the training texts that learn the mixtures, modulo FOLDS.
FOLDS, HELD_OUT, MIXTURE_FOLD = 10, 0, 1
ROUNDS = 60
ADD = 0.1
#: Estimates are binned by tenths of a decade to learn the mixtures.
BINS = 10
NOTHING = -9999
#: Bits of a hash. Fewer pack better; at this many, sharing one by chance stays rare for 10^9 n-grams.
HASH_BITS = 56
SPARE = np.uint64(64 - HASH_BITS)
MIX = np.uint64(0x9E3779B97F4A7C15)
END, START = np.uint64(1), np.uint64(16)

_pack = zstandard.ZstdCompressor(level=1).compress
_unpack = zstandard.ZstdDecompressor().decompress


def put(values: np.ndarray) -> bytes:
    """An integer array in little space: bytes of one weight side by side, compressed."""
    wide = np.ascontiguousarray(values)
    size = wide.dtype.itemsize
    return bytes([size]) + _pack(wide.view(np.uint8).reshape(-1, size).T.tobytes())


def get(raw: bytes, kind: str) -> np.ndarray:
    size = raw[0]
    planes = np.frombuffer(_unpack(raw[1:]), dtype=np.uint8).reshape(size, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view(f"{kind}{size}")


def small(counts: np.ndarray) -> np.ndarray:
    """Counts in the narrowest unsigned type that holds them."""
    most = int(counts.max(initial=0))
    return counts.astype(np.uint8 if most < 1 << 8 else np.uint16 if most < 1 << 16 else np.uint32 if most < 1 << 32 else np.uint64)


def put_sorted(values: np.ndarray) -> bytes:
    """Sorted hashes as differences."""
    return put(np.diff(values, prepend=values[:1] * 0))


def get_sorted(raw: bytes) -> np.ndarray:
    return np.cumsum(get(raw, "u"), dtype=np.uint64)


def words(text: str | None) -> list[bytes]:
    """Tokens of a text, A-Z lower-cased, parted by ASCII white space."""
    return (text or "").encode("utf-8").lower().split()


def fold(key) -> int:
    """CRC-32 of the key as text (null: empty), modulo FOLDS."""
    return zlib.crc32(("" if key is None else str(key)).encode()) % FOLDS


def mix(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The hash of a context followed by a word."""
    h = (context ^ (context >> np.uint64(29))) * MIX + word
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return (h ^ (h >> np.uint64(32))) >> SPARE


class Pack:
    """Tokens of some documents: keys, tokens of each document, and hashes by token."""

    def __init__(self, keys: list, lengths: np.ndarray, tokens: np.ndarray, order: int):
        self.keys, self.lengths, self.tokens, self.order = keys, lengths, tokens, order
        self.starts = np.cumsum(lengths) - lengths
        self.folds = np.array([fold(k) for k in keys])

    @classmethod
    def of(cls, keys: list, lists: list[list[bytes]], order: int) -> Pack:
        flat = [w for ws in lists for w in ws]
        places = {w: i for i, w in enumerate(dict.fromkeys(flat))}
        hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in places), dtype=np.uint64, count=len(places)) >> SPARE
        lengths = np.array([len(ws) + 1 for ws in lists])
        ends = np.cumsum(lengths) - 1
        tokens = np.full(int(lengths.sum()), END)
        spot = np.ones(len(tokens), dtype=bool)
        spot[ends] = False
        tokens[spot] = hashes[np.fromiter(map(places.__getitem__, flat), dtype=np.int64, count=len(flat))]
        return cls(keys, lengths, tokens, order)

    def grams(self) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
        """(hashes, places, start places): the sorted distinct hashes of all n-grams that end at a
        token, and of contexts at a document's start; then where each token's n-gram is among them,
        by order, and each document's first context, from order 2."""
        grams, firsts = [self.tokens], []
        for n in range(2, self.order + 1):
            context = np.empty_like(self.tokens)
            context[1:] = grams[-1][:-1]
            context[self.starts] = START + np.uint64(n)
            firsts.append(context[self.starts])
            grams.append(mix(context + np.uint64(n), self.tokens))
        hashes, inverse = np.unique(np.concatenate(grams + firsts), return_inverse=True)
        cuts = np.cumsum([len(x) for x in grams + firsts])[:-1]
        places = np.split(inverse, cuts)
        return hashes, places[: self.order], places[self.order :]

    def counts(self, table: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """(n-gram counts, context counts) of each token, for orders 1 up and 2 up; ``table`` has
        the corpus count of each of ``grams()``'s hashes."""
        _, places, firsts = self.grams()
        grams = [table[p] for p in places]
        contexts = []
        for n, first in enumerate(firsts, 2):
            c = np.empty(len(self.tokens), dtype=np.int64)
            c[1:] = grams[n - 2][:-1]
            c[self.starts] = table[first]
            contexts.append(c)
        return grams, contexts

    def dump(self) -> bytes:
        words, places = np.unique(self.tokens, return_inverse=True)
        return _join(json.dumps([None if k is None else str(k) for k in self.keys]).encode(), put(small(self.lengths)), put_sorted(words), put(small(places)))

    @classmethod
    def load(cls, raw: bytes, order: int) -> Pack:
        keys, lengths, words, places = _split(raw)
        return cls(json.loads(keys), get(lengths, "u").astype(np.int64), get_sorted(words)[get(places, "u")], order)


def _make_packs(order: int):
    """Documents (key, text) to rows (kind, pack, body): a pack's 'state', or 'mixture' for texts of
    the mixture fold, which get packs of their own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        waiting = {"state": ([], []), "mixture": ([], [])}
        sizes = dict.fromkeys(waiting, 0)

        def build(kind: str) -> pa.RecordBatch:
            body = Pack.of(*waiting[kind], order).dump()
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in ((kind, pa.string()), (number, pa.int64()), (body, pa.binary()))], names=["kind", "pack", "body"])

        for batch in batches:
            for key, text in zip(batch.column(0), batch.column(1)):
                key = key.as_py()
                kind = "mixture" if fold(key) == MIXTURE_FOLD else "state"
                keys, lists = waiting[kind]
                keys.append(key)
                lists.append(words(text.as_py()))
                sizes[kind] += len(lists[-1]) + 1
                if sizes[kind] >= PACK_TOKENS:
                    yield build(kind)
                    number += 1
                    waiting[kind], sizes[kind] = ([], []), 0
        for kind in waiting:
            if waiting[kind][0]:
                yield build(kind)
                number += 1

    return run


#: What a dealt row comes from: a pack, one of the mixture fold, or several packs merged.
STATE, MIXTURE, MERGED = range(3)


def _edges(low: int, high: int, parts: int) -> list[int]:
    """The bounds of equal parts of a stretch of the hash space."""
    return [low + (high - low) * k // parts for k in range(parts + 1)]


def _dealt(pack: int, origin: int, hashes: np.ndarray, columns: list[np.ndarray], first: int, edges: list[int]) -> dict[str, pa.Array]:
    """A pack's sorted hashes with columns of counts, as a row for each range that has any; the
    ranges are numbered from ``first``."""
    cuts = [0, *np.searchsorted(hashes, np.array(edges[1:-1], dtype=np.uint64)).tolist(), len(hashes)]
    spans = [(first + k, lo, hi) for k, (lo, hi) in enumerate(zip(cuts, cuts[1:])) if lo < hi]
    mark = put(np.uint8([origin]))
    bodies = [_join(mark, put_sorted(hashes[lo:hi]), *(put(small(c[lo:hi])) for c in columns)) for _, lo, hi in spans]
    return {"range": pa.array([r for r, _, _ in spans], pa.int32()), "pack": pa.array([pack] * len(spans), pa.int64()), "body": pa.array(bodies, pa.binary())}


def _make_keys(ranges: int, order: int):
    """Rows of ``_make_packs`` to (range, pack, body): a pack's hashes and their counts by range.

    They go straight to a shuffle; only the packs, which are smaller, are written as a table."""
    edges = _edges(0, 1 << HASH_BITS, ranges)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for kind, number, body in zip(*(batch.column(i) for i in range(3))):
                pack = Pack.load(body.as_py(), order)
                hashes, places, firsts = pack.grams()
                trained = pack.folds != HELD_OUT
                weight = np.concatenate([*[np.repeat(trained, pack.lengths)] * len(places), *[trained] * len(firsts)])
                counts = np.bincount(np.concatenate([*places, *firsts]), weights=weight, minlength=len(hashes)).astype(np.int64)
                is_word = np.zeros(len(hashes), dtype=np.uint8)
                is_word[places[0]] = 1
                origin = MIXTURE if kind.as_py() == "mixture" else STATE
                yield pa.RecordBatch.from_pydict(_dealt(number.as_py(), origin, hashes, [counts, is_word], 0, edges))

    return run


PACKS = "kind string, pack bigint, body binary"
KEYS = "range int, pack bigint, body binary"


def _join(*parts: bytes) -> bytes:
    return b"".join(len(x).to_bytes(8, "little") + x for x in parts)


def _split(raw: bytes) -> list[bytes]:
    out, at = [], 0
    while at < len(raw):
        n = int.from_bytes(raw[at : at + 8], "little")
        out.append(raw[at + 8 : at + 8 + n])
        at += 8 + n
    return out


COUNTED = "pack bigint, range int, body binary, known bigint, tokens bigint, fitted bigint"
MERGES = "member bigint, range int, pack bigint, body binary"
SUMS = "pack bigint, range int, body binary"


class Summed:
    """Rows of one range: the distinct hashes, their counts over all training texts (``total``) and
    over those outside the mixture fold (``fitted``), which are words, and each row's places."""

    def __init__(self, rows: pa.Table):
        self.packs = rows.column("pack").to_pylist()
        parts = [_split(x) for x in rows.column("body").to_pylist()]
        self.origins = [int(get(p[0], "u")[0]) for p in parts]
        hashes = [get_sorted(p[1]) for p in parts]
        counts = [get(p[2], "u").astype(np.int64) for p in parts]
        fitted = [get(p[4], "u").astype(np.int64) if o == MERGED else c * (o != MIXTURE) for p, o, c in zip(parts, self.origins, counts)]
        self.hashes, inverse = np.unique(np.concatenate(hashes), return_inverse=True)
        sum_up = lambda xs: np.bincount(inverse, weights=np.concatenate(xs), minlength=len(self.hashes)).astype(np.int64)
        self.total, self.fitted = sum_up(counts), sum_up(fitted)
        self.is_word = sum_up([get(p[3], "u") for p in parts]) > 0
        self.places = np.split(inverse, np.cumsum([len(h) for h in hashes])[:-1])


def _sums(origin: int, total: np.ndarray, fitted: np.ndarray) -> bytes:
    """What a pack gets back. The mixture fold's are judged by what the others count, and in the end
    scored with all counts, so they get both."""
    return _join(put(small(total))) if origin == STATE else _join(put(small(fitted)), put(small(total)))


def _sum_range(key, rows):
    """Sum one range's packs. Each pack gets back the sums of its hashes, in their order. The first
    row has the range's distinct training words, their tokens, and those outside the mixture fold."""
    found = Summed(rows)
    words = found.is_word
    facts = int((words & (found.total > 0)).sum()), int(found.total[words].sum()), int(found.fitted[words].sum())
    first = lambda v: pa.array([v] + [0] * (len(found.packs) - 1), pa.int64())
    return pa.table({
        "pack": pa.array(found.packs, pa.int64()),
        "range": pa.array([key[0].as_py()] * len(found.packs), pa.int32()),
        "body": pa.array([_sums(o, found.total[at], found.fitted[at]) for o, at in zip(found.origins, found.places)], pa.binary()),
        **{name: first(v) for name, v in zip(("known", "tokens", "fitted"), facts)},
    })


def _merge_packs(coarse: int, fine: int):
    """Packs of one group in a coarse range to one pack, dealt to that range's ``fine`` ones, and a
    row for each member with its places in that pack."""

    def run(key, rows):
        where, group = (k.as_py() for k in key)
        found = Summed(rows)
        number = (where << 40) + group
        low, high = _edges(0, 1 << HASH_BITS, coarse)[where : where + 2]
        keys = _dealt(number, MERGED, found.hashes, [found.total, found.is_word.astype(np.uint8), found.fitted], where * fine, _edges(low, high, fine))
        places = [_join(put(np.uint8([o])), put(small(at))) for o, at in zip(found.origins, found.places)]
        n, m = len(keys["pack"]), len(places)
        return pa.table({
            "member": pa.array([None] * n + found.packs, pa.int64()),
            "range": pa.array(keys["range"].to_pylist() + [where] * m, pa.int32()),
            "pack": pa.array([number] * (n + m), pa.int64()),
            "body": pa.array(keys["body"].to_pylist() + places, pa.binary()),
        })

    return run


def _part_packs(key, rows):
    """A merged pack's members and its sums by fine range to the sums of each member."""
    rows = sorted(rows.to_pylist(), key=lambda r: r["range"])
    sums = [_split(r["body"]) for r in rows if r["member"] is None]
    fitted, total = (np.concatenate([get(x[k], "u").astype(np.int64) for x in sums]) for k in range(2))
    members = [(r["member"], r["range"], *_split(r["body"])) for r in rows if r["member"] is not None]
    parted = [(int(get(o, "u")[0]), get(at, "u")) for _, _, o, at in members]
    return pa.table({
        "pack": pa.array([m[0] for m in members], pa.int64()),
        "range": pa.array([m[1] for m in members], pa.int32()),
        "body": pa.array([_sums(o, total[at], fitted[at]) for o, at in parted], pa.binary()),
    })


def _by_range(keys: DataFrame, ranges: int) -> DataFrame:
    return keys.repartition(min(ranges, TASKS), "range").groupBy("range").applyInArrow(_sum_range, COUNTED)


def _count(packs: DataFrame, ranges: int, order: int, ways: int) -> tuple[DataFrame, DataFrame]:
    """(pack, range, body): each pack's sums; and a table of the ranges' facts.

    Dealt at once, rows are packs times ranges, and both grow with the input. In two steps a pack
    makes a row for each of about the root of ``ranges``, and so does a merged one, which holds as
    much as a pack and of which there are as many.
    """
    if ranges <= ways:
        counted = materialize(_by_range(packs.mapInArrow(_make_keys(ranges, order), KEYS), ranges), "lm-counts")
        return counted, counted
    coarse = math.isqrt(ranges - 1) + 1
    fine = -(-ranges // coarse)
    groups = max(1, -(-packs.count() // coarse))
    keyed = packs.mapInArrow(_make_keys(coarse, order), KEYS).withColumn("group", F.pmod(F.xxhash64("pack"), F.lit(groups)))
    spread = keyed.repartition(min(coarse * groups, TASKS), "range", "group")
    merged = materialize(spread.groupBy("range", "group").applyInArrow(_merge_packs(coarse, fine), MERGES), "lm-merged")
    counted = materialize(_by_range(merged.filter("member is null").select("range", "pack", "body"), coarse * fine), "lm-ranges")
    back = merged.filter("member is not null").union(counted.select(F.lit(None).cast("long").alias("member"), "range", "pack", "body"))
    sums = materialize(back.repartition(min(coarse * groups, TASKS), "pack").groupBy("pack").applyInArrow(_part_packs, SUMS), "lm-counts")
    discard(merged)
    return sums, counted


def bucket(context: np.ndarray) -> np.ndarray:
    """Context-frequency bucket: 0 for none, else 1 + the binary logarithm, up to 40."""
    return np.where(context > 0, np.minimum(40, 1 + np.floor(np.log2(np.maximum(context, 1)))), 0).astype(np.int64)


def estimates(grams, contexts, tokens: int, known: int) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, estimates by token): the uniform, unigram and longer maximum-likelihood estimates.

    The bucket is that of the longest context's count, or of the next shorter one if it is unseen,
    each order with buckets of its own."""
    rows = [np.full(len(grams[0]), 1.0 / (known + 1)), grams[0] / max(1, tokens)]
    where = np.zeros(len(grams[0]), dtype=np.int64)
    for n, (g, c) in enumerate(zip(grams[1:], contexts), 2):
        rows.append(np.where(c > 0, g / np.maximum(c, 1), 0.0))
        where = np.where(c > 0, (n - 2) * 64 + bucket(c), where)
    return where, np.array(rows)


def _expect(binned: dict[tuple[int, ...], float], order: int, rounds: int = ROUNDS) -> dict[int, np.ndarray]:
    """Mixture weights of each bucket by expectation-maximisation on binned held-out estimates."""
    by: dict[int, list[tuple[np.ndarray, float]]] = {}
    for (where, *bins), n in binned.items():
        values = np.array([0.0 if b == NOTHING else 10.0 ** (b / BINS) for b in bins])
        by.setdefault(where, []).append((values, n))
    out = {}
    for where, rows in by.items():
        values, n = np.array([v for v, _ in rows]), np.array([c for _, c in rows])
        weights = np.full(order + 1, 1.0 / (order + 1))
        for _ in range(rounds):
            share = values * weights
            share /= np.maximum(share.sum(axis=1, keepdims=True), 1e-300)
            weights = n @ share / n.sum()
            weights = np.maximum(weights, 1e-6)
            weights /= weights.sum()
        out[where] = weights
    return out


def _weight_table(learnt: dict[int, np.ndarray], order: int) -> np.ndarray:
    """Weights of every bucket; one without held-out tokens takes the nearest learnt one of its order."""
    table = np.zeros((64 * order, order + 1))
    for where in range(len(table)):
        near = [w for w in learnt if w // 64 == where // 64 and (w == 0) == (where == 0)] or list(learnt)
        if near:
            table[where] = learnt[min(near, key=lambda w: (abs(w - where), w))]
        else:
            table[where] = 1.0 / (order + 1)
    table[0, 2:] = 0  # no context was seen, so there is no longer estimate
    return table / table.sum(axis=1, keepdims=True)


def score(docs: DataFrame, key: str = "doc_id", text: str = "text", order: int = ORDER, weights: np.ndarray | None = None, ways: int = WAYS) -> DataFrame:
    """(key, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row.

    Tokens are the words and one end. Texts whose key's CRC-32 leaves HELD_OUT are not learnt from.
    ``base_score`` is the add-ADD unigram score and ``score`` the interpolated model's, both base-10
    logarithms of the whole text's probability. Null texts count as empty, a null key's fold is that
    of the empty text, and repeated rows are texts of their own. An empty table gives no rows.
    ``weights`` (by bucket and estimate) take the place of learnt ones. ``ways`` changes the plan
    alone (see ``_count``).
    """
    kind = docs.schema[key].dataType
    slim = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    size = slim.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = max(6, int(size * order // (6 * RANGE_TOKENS)) + 1)
    packs = materialize(slim.mapInArrow(_make_packs(order), PACKS), "lm-packs")
    counted, facts = _count(packs, ranges, order, ways)
    facts = facts.agg(F.sum("known"), F.sum("tokens"), F.sum("fitted")).first()
    known, tokens, fitted = (int(v or 0) for v in facts)

    def with_counts(states: DataFrame, sums: DataFrame) -> DataFrame:
        """One row for each pack: its state, and its sums by range."""
        both = states.select("pack", F.lit(-1).alias("range"), "body").union(sums.select("pack", "range", "body"))
        return both.groupBy("pack").agg(F.collect_list(F.struct("range", "body")).alias("rows")).select("rows")

    def unpacked(batch: pa.RecordBatch, which: int) -> Iterator[tuple[Pack, list[np.ndarray], list[np.ndarray]]]:
        """Packs with their counts; of the sums that a mixture pack has, the one at ``which``."""
        for row in batch.column(0):
            state, *sums = sorted(row.as_py(), key=lambda r: r["range"])
            pack = Pack.load(state["body"], order)
            table = np.concatenate([get(_split(x["body"])[which], "u").astype(np.int64) for x in sums])
            yield pack, *pack.counts(table)

    def bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, grams, contexts in unpacked(batch, 0):
                where, values = estimates(grams, contexts, fitted, known)
                coded = np.where(values > 0, np.round(np.log10(np.maximum(values, 1e-300)) * BINS), NOTHING).astype(np.int64)
                unique, n = np.unique(np.vstack([where, coded]).T, axis=0, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(unique.tolist(), pa.list_(pa.int64())), pa.array(n, pa.int64())], names=["bin", "n"])

    def run(which: int):
        def to_scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for pack, grams, contexts in unpacked(batch, which):
                    where, values = estimates(grams, contexts, tokens, known)
                    chance = (weights[where].T * values).sum(axis=0)
                    base = np.log10((grams[0] + ADD) / (tokens + ADD * (known + 1)))
                    add = lambda x: np.add.reduceat(x, pack.starts)  # noqa: E731, B023
                    found = {
                        "key": pa.array(pack.keys, pa.string()),
                        "held_out": pa.array(pack.folds == HELD_OUT),
                        "n_tokens": pa.array(pack.lengths, pa.int64()),
                        "n_known": pa.array(add((grams[0] > 0).astype(np.int64)), pa.int64()),
                        "train_tokens": pa.array(np.full(len(pack.keys), tokens), pa.int64()),
                        "base_score": pa.array(add(base), pa.float64()),
                        "score": pa.array(add(np.log10(np.maximum(chance, 1e-300))), pa.float64()),
                    }
                    yield pa.RecordBatch.from_arrays(list(found.values()), names=list(found))

        return to_scores

    mixture = packs.filter("kind = 'mixture'").select("pack", "body")
    others = packs.filter("kind = 'state'").select("pack", "body")
    own = mixture.select("pack").withColumn("mixed", F.lit(True))
    marked = counted.join(own, "pack", "left")
    mixture = with_counts(mixture, marked.filter("mixed"))
    if weights is None:
        seen = mixture.mapInArrow(bins, "bin array<bigint>, n bigint").groupBy("bin").agg(F.sum("n").alias("n"))
        weights = _weight_table(_expect({tuple(r["bin"]): float(r["n"]) for r in seen.collect()}, order), order)
    out = "key string, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    scored = with_counts(others, marked.filter("mixed is null")).mapInArrow(run(0), out).union(mixture.mapInArrow(run(1), out))
    return scored.select(F.col("key").cast(kind).alias(key), "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
