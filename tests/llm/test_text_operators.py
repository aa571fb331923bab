"""The operators on documents against brute force, with nulls, empty and long texts, ties, repeats,
empty tables and clashing columns."""

import base64
import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
import xxhash
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from quern.llm import bpe, components, copies, decontamination, language_model as lm, simhash, spotsigs

RANKS = P.path("byte_bpe_multi_50k.tiktoken")
DOC = "doc_id long, text string"


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def syllables(rng, n, words=60):
    return " ".join("".join(rng.choices(["th", "er", "on", "an", "re", "í", "ß", "Co"], k=rng.randint(1, 3))) + rng.choice(["", "", ",", ".\n"]) for _ in range(n))


ODD = [None, "", " ", "\n\t", "'s 'll  x", "naïve café ☕🧑‍🚀 ​日本語", "a" * 5000, "don't—stop...  123 4567", "\x00\x1f\x85 x"]

# byte-level BPE ---------------------------------------------------------------------------------


def test_bpe_matches_rank_encoder(spark, reference):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(None, "x"), (0, "again"), (0, "again")]
    got = sorted(map(tuple, bpe.round_trip(spark.createDataFrame(rows, DOC), RANKS, P.PATTERN).collect()), key=repr)
    want = []
    for i, t in rows:
        ids = reference.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == sorted(want, key=repr)


@settings(max_examples=150, deadline=None)
@given(st.text())
def test_bpe_any_text(reference, text):
    c = bpe.codec(RANKS, P.PATTERN)
    ids = c.encode(text)
    assert ids == reference.encode_ordinary(text) and c.decode_bytes(ids).decode() == text
    again, spans = c.encode_with_offsets(text)
    owner = [k for k, ch in enumerate(text) for _ in ch.encode()]  # the character of each byte
    ends = np.cumsum([len(c.raw[i]) for i in ids]).astype(int).tolist()
    assert again == ids and spans == [(owner[b - len(c.raw[i])], owner[b - 1] + 1) for i, b in zip(ids, ends)]


def test_bpe_table_is_reversed():
    """Every rank's bytes come back from the library's characters."""
    c, ranks = bpe.codec(RANKS, P.PATTERN), bpe.read_ranks(RANKS)
    assert all(c.raw[rank] == raw for raw, rank in ranks.items()) and len(set(bpe.byte_characters())) == 256


def test_bpe_frames_and_split_characters(spark):
    docs = spark.createDataFrame([(1, "🧑‍🚀 é", "keep"), (2, None, None)], "doc_id long, text string, ids string")
    out = bpe.decode(bpe.encode(docs, RANKS, P.PATTERN), RANKS, P.PATTERN).orderBy("doc_id").collect()
    assert bytes(out[0].decoded).decode() == "🧑‍🚀 é" and out[1].ids == [] and bytes(out[1].decoded) == b""
    assert any(a.start == b.start for a, b in zip(out[0].offsets, out[0].offsets[1:]))
    assert bpe.round_trip(docs.limit(0), RANKS, P.PATTERN).count() == 0


def test_bpe_cache_is_bounded(reference, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_PIECES", 10)
    c, rng = bpe.Codec(RANKS, P.PATTERN), random.Random(1)
    for _ in range(20):
        t = syllables(rng, 30) + " " + "x" * 200
        assert c.encode(t) == reference.encode_ordinary(t)
    assert all(len(p) <= bpe.CACHE_CHARS for p in c.pieces)


# components and SimHash -------------------------------------------------------------------------


def union_find(nodes, edges):
    root = {n: n for n in nodes}

    def top(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in edges:
        x, y = top(a), top(b)
        root[max(x, y)] = min(x, y)
    return {n: top(n) for n in nodes}


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(35)] + [(100 + i, 101 + i) for i in range(20)] + [(200, 201 + i) for i in range(30)] + [(5, 5)]
    got = {r.node: r.component for r in components.connected_components(spark.createDataFrame(edges + [(None, 1)], "u long, v long")).collect()}
    want = union_find({n for e in edges for n in e}, edges)
    assert got == {n: c for n, c in want.items() if n in got} and all(want[n] == n and sum(c == n for c in want.values()) == 1 for n in want if n not in got)


def brute_fingerprint(text):
    w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    shingles = [b" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    hs = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hs) > len(hs))


def test_fingerprints(monkeypatch):
    rng = random.Random(4)
    texts = ODD + ["A b", "a B c", "x\x1cy z"] + [syllables(rng, n) for n in (3, 50, 400)]
    for t in texts:
        assert simhash.fingerprint(t) & (1 << 64) - 1 == brute_fingerprint(t)
    monkeypatch.setattr(simhash, "CHUNK", 7)
    assert simhash.fingerprint(texts[-1]) & (1 << 64) - 1 == brute_fingerprint(texts[-1])


def test_covering_masks_miss_no_pair():
    masks = simhash.masks(3)
    for bits in itertools.combinations(range(64), 3):
        d = sum(1 << b for b in bits)
        assert any(m & d == 0 for m in masks)


@pytest.mark.parametrize("block", [3, 512])
def test_links_match_brute_force(spark, block):
    rng = random.Random(9)
    base = [rng.getrandbits(63) for _ in range(6)]
    values = sorted({b ^ sum(1 << rng.randrange(63) for _ in range(rng.randint(0, 4))) for b in base for _ in range(25)})
    found = simhash.links(spark.createDataFrame([(v,) for v in values], "bits long"), block=block).collect()
    assert all((r.u ^ r.v).bit_count() <= 3 for r in found)
    want = union_find(values, [(a, b) for a, b in itertools.combinations(values, 2) if (a ^ b).bit_count() <= 3])
    assert union_find(values, [(r.u, r.v) for r in found]) == want


def test_near_duplicates(spark):
    rng = random.Random(5)
    one = syllables(rng, 300)
    docs = [(7, one), (3, one + " tail"), (9, one), (9, one), (4, syllables(rng, 300)), (None, one), (11, None), (12, " "), (None, "only null here " * 9)]
    df = spark.createDataFrame([(*r, "x") for r in docs], "doc_id long, text string, bits string")
    got = sorted(map(tuple, simhash.near_duplicates(df).select("doc_id", "component").collect()), key=repr)
    prints = [(k, brute_fingerprint(t)) for k, t in docs]
    cls = union_find({p for _, p in prints}, [(a, b) for a, b in itertools.combinations({p for _, p in prints}, 2) if (a ^ b).bit_count() <= 3])
    least = {}
    for k, p in prints:
        if k is not None:
            least[cls[p]] = min(k, least.get(cls[p], k))
    assert got == sorted([(k, least.get(cls[p])) for k, p in prints], key=repr)
    assert simhash.near_duplicates(df.limit(0)).count() == 0


def five_words(text):
    w = (text or "").encode().lower().split()
    return {b" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))}


def test_sketches_never_differ_in_more_bits_than_members(spark):
    rng = np.random.default_rng(7)
    rows, want = [], []
    for n in (1, 3, 500, 512, 513, 600, 1024, 1100, 5000):
        a = np.unique(rng.integers(-(1 << 63), 1 << 63, n, dtype=np.int64))
        for share in (0.0, 0.1, 0.25, 0.5):
            cut = int(len(a) * share)
            b = np.unique(np.concatenate([a[cut:], rng.integers(-(1 << 63), 1 << 63, cut // 2, dtype=np.int64)]))
            rows.append((copies.sketch(a).tolist(), copies.sketch(b).tolist()))
            want.append(len(np.setxor1d(a, b)))
    got = [r.d for r in spark.createDataFrame(rows, "a array<long>, b array<long>").select(copies.apart(F.col("a"), F.col("b")).alias("d")).collect()]
    assert all(g <= w for g, w in zip(got, want)) and all(g == 0 for g, w in zip(got, want) if w == 0)
    assert got[-1] > 0.5 * want[-1]


def test_near_copies_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(copies, "PART", 1)
    rng = random.Random(12)
    line = syllables(rng, 12)
    docs = [(None, "no key " * 9), (90, None), (91, " "), (92, "a b"), (93, "A  b")]
    for k in range(12):
        words = syllables(rng, 150).split()
        for j in range(5):
            edited = list(words)
            for _ in range(rng.randint(0, 7)):
                edited[rng.randrange(len(edited))] = "edit"
            docs.append((100 + 5 * k + j, " ".join(edited) + " " + line))
    got = copies.near_copies(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    sets = {k: five_words(t) for k, t in docs if k is not None}
    near = [(a, b) for a, b in itertools.combinations(sorted(sets), 2) if 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b])]
    want = union_find(set(sets), near)
    least = {c: min(k for k in sets if want[k] == c) for c in want.values()}
    assert {r.doc_id: r.component for r in got if r.doc_id is not None} == {k: least[want[k]] for k in sets}
    assert [r.component for r in got if r.doc_id is None] == [None] and len(got) == len(docs)
    wide = [(a, b) for a, b in near if (simhash.fingerprint(dict(docs)[a]) ^ simhash.fingerprint(dict(docs)[b])).bit_count() > 3]
    assert wide  # pairs that op10's radius misses
    assert copies.near_copies(spark.createDataFrame(docs, "doc_id long, text string").limit(0)).count() == 0


# decontamination --------------------------------------------------------------------------------

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def item_words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))


def brute_contamination(docs, items):
    windows = {}
    for i, t in items:
        w = item_words(t)
        for k in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[k : k + 10]), set()).add("" if i is None else str(i))
    out = []
    for d, t in docs:
        w, hit, found = item_words(t), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in windows:
                    hit.update(range(k, k + n))
                    found |= windows[tuple(w[k : k + n])]
        out.append((d, len(w), len(hit), len(found), sorted(found)))
    return sorted(out, key=repr)


def contaminated(spark, docs, items):
    df = decontamination.contamination(spark.createDataFrame([(*r, 1) for r in docs], "doc_id long, text string, w int"), spark.createDataFrame(items, "item_id long, text string"))
    return sorted([(r.doc_id, r.n_words, r.n_hit, r.n_items, r.item_ids) for r in df.collect()], key=repr)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_contamination_matches_brute_force(spark, seed, monkeypatch):
    if seed == 3:
        monkeypatch.setattr(decontamination, "BROADCAST_ROWS", 0)
    rng = random.Random(seed)
    word = lambda: rng.choice(["the", "Éa", "of", "x1", "is", "a", "ÑO", "zu"])
    text = lambda n: " ".join(word() + rng.choice(["", ",", "--"]) for _ in range(n))
    items = [(i, text(rng.choice([10, 11, 14, 25, 40]))) for i in range(8)] + [(20, "the the the " * 8), (21, text(40)), (None, text(12)), (22, None), (23, "..."), (100, "lonely words here"), (101, "one"), (9, text(9))]
    docs = []
    for d in range(25):
        parts = [text(rng.randint(0, 30))]
        for _ in range(rng.randint(0, 3)):
            w = item_words(rng.choice(items)[1])
            a = rng.randint(0, max(0, len(w) - 9))
            parts += [" ".join(w[a : a + rng.randint(8, 30)]).upper(), text(rng.randint(0, 5))]
        docs.append((d, " ; ".join(parts)))
    docs += [(3, docs[3][1]), (None, docs[4][1]), (50, None), (51, ""), (52, "the " * 3000), (53, "lonely words here"), (54, "One!")]
    assert contaminated(spark, docs, items) == brute_contamination(docs, items)


def test_contamination_of_empty_tables(spark):
    docs, items = [(1, "a b c")], [(1, "a b c")]
    assert contaminated(spark, [], items) == [] and contaminated(spark, docs, []) == [(1, 3, 0, 0, [])]
    assert contaminated(spark, docs, items) == [(1, 3, 3, 1, ["1"])]


# SpotSigs ---------------------------------------------------------------------------------------


def brute_signatures(text):
    w = [x for x in re.split(r"[\W_]+", (text or "").lower()) if x]
    content = [i for i, x in enumerate(w) if x not in spotsigs.ANCHORS]
    out = set()
    for j, p in enumerate(content):
        for a in w[content[j - 1] + 1 if j else 0 : p]:
            out.add((a, w[p], w[content[j + 1]] if j + 1 < len(content) else None))
    return out or {("", x, w[i + 1] if i + 1 < len(w) else None) for i, x in enumerate(w)} or {text or ""}


def spot_texts():
    rng = random.Random(8)
    words = ["the", "of", "and", "der", "la", "que", "Haus", "river", "stone", "blau", "perro", "fleur", "x"]
    texts = [" ".join(rng.choices(words, k=rng.randint(0, 40))) for _ in range(40)]
    return texts + [texts[3], texts[3] + " the end of it", "the of and", "", "...", "plain words only", None]


@pytest.mark.parametrize("stretch", [4, 512])
def test_edited_likeness(spark, stretch, monkeypatch):
    monkeypatch.setattr(spotsigs, "STRETCH_ROWS", stretch)
    docs = [(i * 3, t) for i, t in enumerate(spot_texts())]
    got = {r.doc_id: r for r in spotsigs.edited_likeness(spark.createDataFrame([(*d, 0) for d in docs], "doc_id long, text string, sigs int")).collect()}
    assert len(got) == len(docs)
    like = lambda a, b: len(a & b) / len(a | b)
    for k, (d, t) in enumerate(docs):
        t, n = t or "", docs[(k + 1) % len(docs)][1] or ""
        half = len(t) // 2
        edited = t[: len(t) - half] + n[:half]
        r = got[d]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert abs(r.near_edited - like(brute_signatures(t), brute_signatures(edited))) < 1e-9
        assert abs(r.near_next - like(brute_signatures(t), brute_signatures(n))) < 1e-9
    assert got[9].fingerprint == got[120].fingerprint


def test_next_with_ties_nulls_and_repeats(spark, monkeypatch):
    monkeypatch.setattr(spotsigs, "STRETCH_ROWS", 2)
    rows = [(None, "n"), (5, "b"), (5, "a"), (5, "b"), (1, "x"), (9, "z"), (2**60, "big"), (-4, "low")]
    got = spotsigs.with_next(spark.createDataFrame(rows, "key long, text string")).collect()
    order = sorted(rows, key=lambda r: (r[0] if r[0] is not None else -(1 << 63), r[1]))
    want = [(*r, order[(i + 1) % len(order)][1]) for i, r in enumerate(order)]
    assert sorted([(r.key, r.text, r.next_text) for r in got], key=repr) == sorted(want, key=repr)
    named = [(str(r[0]) if r[0] is not None else None, r[1]) for r in rows] + [("doc-b", "q"), ("doc-a", "r"), ("é", "s"), ("", "e")]
    got = spotsigs.with_next(spark.createDataFrame(named, "key string, text string")).collect()
    order = sorted(named, key=lambda r: (r[0] is not None, (r[0] or "").encode(), r[1]))
    assert sorted([(r.key, r.text, r.next_text) for r in got], key=repr) == sorted([(*r, order[(i + 1) % len(order)][1]) for i, r in enumerate(order)], key=repr)
    lone = spotsigs.edited_likeness(spark.createDataFrame([(1, "the big tree of it")], DOC)).first()
    assert lone.near_next == 1.0
    assert spotsigs.edited_likeness(spark.createDataFrame([], DOC)).count() == 0


def test_spot_near_duplicates(spark):
    docs = list(enumerate(spot_texts())) + [(100 + i, (spot_texts()[i] or "") + " the small fish") for i in range(40)] + [(None, "q")]
    members, pairs = spotsigs.near_duplicates(spark.createDataFrame(docs, DOC), threshold=0.6)
    sets = {}
    for d, t in docs:
        sets.setdefault(frozenset(brute_signatures(t)), []).append(d)
    names = {s: min((x for x in ds if x is not None), default=None) for s, ds in sets.items()}
    assert sorted(map(tuple, members.collect()), key=repr) == sorted([(d, names[frozenset(brute_signatures(t))]) for d, t in docs], key=repr)
    want = {tuple(sorted((names[a], names[b]))) for a, b in itertools.combinations(sets, 2) if None not in (names[a], names[b]) and len(a & b) / len(a | b) >= 0.6}
    assert {(r.left, r.right) for r in pairs.collect()} == want and want


# language model ---------------------------------------------------------------------------------


def brute_scores(docs, weights, order):
    fold = lambda k: zlib.crc32(("" if k is None else str(k)).encode()) % 10
    tokens = [(k, re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower()) + [None]) for k, t in docs]
    grams, contexts, total = Counter(), Counter(), 0
    padded = lambda ws, i, n: tuple(ws[i - n + 1 : i + 1]) if i >= n - 1 else ("start", *ws[: i + 1])

    def context(ws, i, n):
        return ("begin", n) if i == 0 else padded(ws, i - 1, n - 1)

    for k, ws in tokens:
        if fold(k):
            total += len(ws)
            for i in range(len(ws)):
                for n in range(1, order + 1):
                    grams[context(ws, i, n) if n > 1 else None, ws[i], n] += 1
                    contexts[context(ws, i, n) if n > 1 else None, n] += 1
    known = sum(1 for (_, _, n), c in grams.items() if n == 1 and c)
    out = []
    for k, ws in tokens:
        base = score = 0.0
        seen = 0
        for i, w in enumerate(ws):
            c = grams[None, w, 1]
            seen += c > 0
            base += math.log10((c + 0.1) / (total + 0.1 * (known + 1)))
            values, where = [1 / (known + 1), c / max(1, total)], 0
            for n in range(2, order + 1):
                v = contexts[context(ws, i, n), n]
                values.append(grams[context(ws, i, n), w, n] / v if v else 0.0)
                where = (n - 2) * 64 + min(40, 1 + int(math.log2(v))) if v else where
            score += math.log10(sum(x * y for x, y in zip(weights[where], values)))
        out.append((k, fold(k) == 0, len(ws), seen, total, base, score))
    return out


@pytest.mark.parametrize("order, pack, ways", [(2, 350_000, 4096), (2, 40, 4096), (3, 60, 4096), (2, 40, 2), (3, 60, 5)])
def test_language_model(spark, order, pack, ways, monkeypatch):
    monkeypatch.setattr(lm, "PACK_TOKENS", pack)
    rng = random.Random(order)
    docs = [(i, " ".join(rng.choices(["a", "B", "c", "dd", "eé", "f\tg"], k=rng.randint(0, 25)))) for i in range(60)] + [(None, "a c"), (3, "a a"), (3, "a a"), (77, None)]
    weights = np.abs(np.random.default_rng(0).normal(size=(64 * order, order + 1))) + 0.1
    weights /= weights.sum(axis=1, keepdims=True)
    got = lm.score(spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, pack int"), order=order, weights=weights, ways=ways).collect()
    key = lambda r: (repr(r[0]), r[2], round(r[5], 6))
    for a, b in zip(sorted(map(tuple, got), key=key), sorted(brute_scores(docs, weights, order), key=key), strict=True):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5]) and a[6] == pytest.approx(b[6])


def test_language_model_learns(spark):
    rng = random.Random(2)
    docs = [(i, " ".join(["to be or not", "by and by", "once upon a time"][rng.randrange(3)] for _ in range(15))) for i in range(300)]
    rows = lm.score(spark.createDataFrame(docs, DOC)).filter("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert rows[0] > 0.6 * rows[1]
    assert lm.score(spark.createDataFrame([], DOC)).count() == 0


def test_language_model_in_two_steps_learns_the_same(spark, monkeypatch):
    monkeypatch.setattr(lm, "PACK_TOKENS", 100)
    docs = spark.createDataFrame([(i, f"a b c{i % 7} d{i % 11} a b") for i in range(80)], DOC)
    once, twice = ({r.doc_id: r.score for r in lm.score(docs, ways=w).collect()} for w in (lm.WAYS, 3))
    assert once.keys() == twice.keys() and all(once[k] == pytest.approx(twice[k]) for k in once)
    assert lm.score(docs.limit(0), ways=3).count() == 0


def test_mixture_finds_the_better_estimate():
    got = lm._expect({(1, -30, -20, -1): 90.0, (1, -30, -10, lm.NOTHING): 10.0}, 2)[1]
    assert got.sum() == pytest.approx(1) and got[2] > 0.8
