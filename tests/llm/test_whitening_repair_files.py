"""Whitening, conversation repair and token files against brute force, with nulls, empty and long
values, ties, repeats, empty tables and clashing columns."""

import hashlib
import heapq
import math
import os
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pyarrow.orc
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quern.llm import queries, repair, token_files, whitening

SF = "/root/testdata/sf0.001"
WORDS = P.path("word_bpe_49k.json")
here = pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables aren't here")

# whitening ----------------------------------------------------------------------------------------


def plain(rows, components=16):
    """The contract computed in one place: {position: (deviation, whitened)}, n, explained."""
    fine = [(k, v) for k, v in enumerate(rows) if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([[math.floor(64 * c) + 1_000_000 for c in v] for _, v in fine], dtype=np.int64)
    fit = np.unique(x, axis=0)
    n, total = len(fit), fit.sum(axis=0)
    y = fit - 1_000_000 - (total - 1_000_000 * n) / n
    values, vectors = np.linalg.eigh(y.T @ y / n)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    white = (x - 1_000_000 - (total - 1_000_000 * n) / n) @ vectors / np.sqrt(np.maximum(values, 1e-300))
    deviation = ((n * x - total) ** 2).sum(axis=1)
    return {k: (int(d), w) for (k, _), d, w in zip(fine, deviation, white)}, n, values / np.trace(y.T @ y / n)


def check_whitening(got, rows, keys=None):
    want, n, shares = plain(rows)
    found = defaultdict(dict)
    for r in got:
        assert r["n"] == n and r["identity_error"] <= 1e-4
        assert r["explained"] == pytest.approx(shares[r["component"] - 1], rel=1e-6)
        assert r["component"] not in found[r[0]]
        found[r[0]][r["component"]] = (r["deviation"], r["whitened"])
    assert set(found) == set(want)
    width = len(shares)
    a = np.array([[found[k][c + 1][1] for c in range(width)] for k in sorted(want)])
    b = np.array([want[k][1] for k in sorted(want)])
    assert np.abs(a - b * np.sign((a * b).sum(axis=0))).max() < 1e-7
    assert all(found[k][1][0] == want[k][0] for k in want)


@here
def test_whitening_of_the_table(spark):
    rows = {r["vec_id"]: r["embedding"] for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()}
    keys = sorted(rows)
    assert keys == list(range(len(keys)))
    check_whitening(queries.op11_whitening(spark, SF).collect(), [rows[k] for k in keys])


def test_whitening_in_many_tiles(spark, monkeypatch):
    """Narrow column blocks, small row blocks and several rounds of sums give the same."""
    monkeypatch.setattr(whitening, "NARROWEST", 3)
    monkeypatch.setattr(whitening, "BLOCK_ROWS", 7)
    monkeypatch.setattr(whitening, "FAN_IN", 2)
    rng = np.random.default_rng(1)
    base = rng.normal(size=(150, 20)) @ np.diag(np.linspace(0.5, 3, 20))
    rows = [list(map(float, v)) for v in base] + [list(map(float, base[3]))] * 40
    rows[5], rows[6], rows[7] = None, [None, *rows[6][1:]], [float("nan"), *rows[7][1:]]
    rows[8] = [float("-inf"), *rows[8][1:]]
    df = spark.createDataFrame(list(enumerate(rows)), "vec_id long, embedding array<double>").repartition(5)
    check_whitening(whitening.by_component(df).collect(), rows)


def test_whitening_odd_tables(spark):
    schema = "vec_id long, embedding array<double>, x string, n string, whitened string, dim string"
    odd = lambda rows: spark.createDataFrame([(*r, "a", "b", "c", "d") for r in rows], schema)
    assert whitening.by_component(odd([])).collect() == []
    assert whitening.by_component(odd([(1, None), (2, [None])])).collect() == []
    assert whitening.by_component(odd([(1, [])])).collect() == []
    alone = whitening.by_component(odd([(1, [0.5, 0.25]), (None, [0.5, 0.25])])).collect()
    assert len(alone) == 4 and all(r["whitened"] is None and r["n"] == 1 and r["deviation"] == 0 for r in alone)
    # a short vector counts as if zeros followed, and one without variance in a dimension stays whole
    flat = whitening.by_component(odd([(1, [1.0]), (2, [3.0, 0.0]), (3, [3.0, 0.0]), (4, [2.0])])).collect()
    first = {r["vec_id"]: r["whitened"] for r in flat if r["component"] == 1}
    assert sorted(map(abs, first.values())) == pytest.approx([0.0, 1.5**0.5, 1.5**0.5, 1.5**0.5])
    assert all(r["whitened"] is None and r["explained"] == pytest.approx(0) for r in flat if r["component"] == 2)


def test_whitening_of_huge_entries(spark):
    rows = [(1, [1e300, 0.0]), (2, [-1e300, 1.0]), (3, [0.0, 5.0])]
    got = whitening.by_component(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert len(got) == 6 and {r["deviation"] for r in got if r["vec_id"] == 1} == {None}
    assert all(r["deviation"] == (3 * 320 - 384) ** 2 for r in got if r["vec_id"] == 3)


# repair -------------------------------------------------------------------------------------------

NEXT = {"": "su", "s": "u", "u": "a", "a": "u"}


def cheapest(rows):
    """(cost, audit) by search over whole audits in the order of cost, then of letters."""
    heap, done = [(0, "", 0, "")], set()
    while heap:
        cost, audit, at, state = heapq.heappop(heap)
        if at == len(rows) and state in ("", "a"):
            return cost, audit
        if (at, state) in done:
            continue
        done.add((at, state))
        for role in "ua":
            if role in NEXT[state]:
                heapq.heappush(heap, (cost + 3, audit + "I", at, role))
        if at < len(rows):
            initial, fault = rows[at]
            more = 3 if fault == "truncated" else 0
            heapq.heappush(heap, (cost + 4, audit + "D", at + 1, state))
            if fault not in ("blank", "duplicate"):
                if initial and initial in NEXT[state]:
                    heapq.heappush(heap, (cost + more, audit + "K", at + 1, initial))
                for role in "ua":
                    if role in NEXT[state]:
                        heapq.heappush(heap, (cost + 3 + more, audit + "R", at + 1, role))


def judged(rows):
    """One conversation's result from its original rows, by the contract's words."""
    out = []
    for conv, turn, role, text in rows:
        said = lambda v: " " if v is None else str(v)
        kind = zlib.crc32(f"{said(conv)}:{said(turn)}".encode()) % 20
        role, text = "user" if kind == 4 else said(role), "" if kind == 1 else said(text)
        text = re.sub("[.!?]", "", text) if kind == 2 else text
        out += [] if kind == 0 else [(turn, role, text)] * (2 if kind == 3 else 1)
    out.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
    seen, found = set(), []
    for _, role, text in out:
        shown = re.findall(r"[^\x20\x09-\x0D]", text)
        found.append((role, text, "blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else None))
        seen.add((role, text))
    turns = [t for t, _, _ in out if t is not None]
    cost, audit = cheapest([(r[:1], f) for r, _, f in found])
    rest, state, lines = iter(found), "", []
    for edit in audit:
        role, text, _ = ("", "", None) if edit == "I" else next(rest)
        if edit == "D":
            continue
        role = role if edit == "K" else "assistant" if state == "u" else "user"
        state = role[:1]
        lines.append(f"{role}:{text}")
    count = lambda kind: sum(f == kind for _, _, f in found)
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(found, found[1:]))
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, count("blank"), count("duplicate"), count("truncated"), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


CONV = "conv_id long, turn long, role string, text string"


def check_repair(spark, rows, df=None):
    groups = defaultdict(list)
    for r in rows:
        groups[r[0]].append(r)
    df = spark.createDataFrame(rows, CONV) if df is None else df
    got = repair.repair(df).select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256").collect()
    assert len(got) == len(groups)
    assert {r[0]: tuple(r)[1:] for r in got} == {k: judged(v) for k, v in groups.items()}
    return {r["conv_id"]: r for r in got}


@here
def test_repair_of_the_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = queries.op12_repair(spark, SF)
    assert {"conv_id", "audit", "repaired_sha256"} <= set(got.columns)
    check_repair(spark, rows)


def test_repair_of_odd_rows(spark):
    rng = random.Random(3)
    text = lambda: rng.choice([None, "", " \t", "Yes.", "Yes.", "No", "é?\x0b", "x" * rng.randint(1, 9) + ".", " "])
    role = lambda: rng.choice(["user", "assistant", "system", "tool", "", None, "User", "sys", "ü"])
    rows = [(rng.choice([*range(60), None]), rng.choice([None, *range(12)]), role(), text()) for _ in range(700)]
    check_repair(spark, rows + rows[:30])


def test_repair_of_a_conversation_of_which_nothing_is_left(spark):
    key = next(k for k in range(1000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    got = check_repair(spark, [(key, 0, "user", "Hello.")])
    assert tuple(got[key])[1:8] == (0, 0, 0, 0, 0, 0, "") and got[key]["repaired_sha256"] == hashlib.sha256(b"").hexdigest()


def test_repair_of_a_long_conversation(spark):
    """Longer than a descent of the recursion and than a batch."""
    rng = random.Random(5)
    rows = [(7, t, rng.choice(["user", "assistant"]), f"{t} " + rng.choice(["so.", "so"])) for t in range(1500)]
    check_repair(spark, rows + [(8, 0, "user", "y" * 300_000 + ".")])


def test_repair_of_an_empty_table_and_clashing_names(spark):
    assert repair.repair(spark.createDataFrame([], CONV)).collect() == []
    rows = [(1, 0, "user", "A."), (1, 1, "assistant", "B.")]
    df = spark.createDataFrame(rows, CONV).withColumns({c: F.lit("z") for c in ("conv", "mark", "audit", "signature", "kind", "gone", "cost", "digest")})
    check_repair(spark, rows, df)


def test_repaired_rows_are_dialogues(spark):
    rows = [(c, t, r, f"{c}{t}.") for c in range(30) for t, r in enumerate(["system", "user", "user", "assistant", "tool"])]
    found = defaultdict(list)
    for r in repair.repaired_rows(repair.damage(spark.createDataFrame(rows, CONV))).orderBy("conv", "place").collect():
        found[r["conv"]].append(r["role"])
    assert found and all(re.fullmatch("(s?(ua)+)?", "".join(x[0] for x in v)) for v in found.values())


@settings(max_examples=300, deadline=None)
@given(st.text("suaoxSUAO", max_size=9))
def test_solve_against_search(signature):
    rows = [(m.lower() if m.lower() in "sua" else "?", "blank" if m == "x" else "truncated" if m.isupper() else None) for m in signature]
    assert repair.solve(signature) == cheapest(rows)


# token files --------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def words():
    return Tokenizer.from_file(WORDS)


def in_files(words, rows):
    """The contract in one place, over rows in their order."""
    at, out = 0, []
    for key, text in rows:
        ids = [*words.encode(text or "", add_special_tokens=False).ids, token_files.END]
        out.append((key, at, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        at += len(ids)
    return out


def order(r):
    return (r[0] is not None, r[0] or 0)


ODD = [None, "", " \n", "It's NAÏVE café ☕🧑‍🚀 日本語", "a" * 4000, "é ́x y z", "'ll 12345 !!!", "\x00\x85x"]


@here
def test_token_files_of_the_table(spark, words):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(tuple(r) for r in queries.op13_token_files(spark, SF).select("doc_id", "start", "n_tokens", "ids_crc32").collect())
    assert got == in_files(words, sorted(rows, key=order))


def test_token_files_of_odd_rows(spark, words, monkeypatch):
    """Short rows, so that documents span several and their checksums are joined."""
    monkeypatch.setattr(token_files, "CHUNK", 5)
    rows = [(k, t) for k, t in enumerate(ODD)] + [(3, "again"), (3, "again"), (None, "no key"), (None, "no key at all"), (2, "tie")]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, key int, ids int").coalesce(1)
    got = [tuple(r) for r in token_files.round_trip(df, WORDS).select("doc_id", "start", "n_tokens", "ids_crc32").collect()]
    assert sorted(got, key=lambda r: r[1]) == in_files(words, sorted(rows, key=order))
    assert token_files.round_trip(df.limit(0), WORDS).collect() == []


def test_long_texts_are_cut_where_it_does_not_matter(words):
    rng = random.Random(2)
    text = "".join(rng.choice(["Σας ", "it's\n", "ẹ́ ", " ́q", "\t", "don't  ", "12,5 ", "ΑΣ", "가 "]) for _ in range(3000))
    for limit in (1, 7, 50):
        pieces = list(token_files.segments(text, limit))
        assert "".join(pieces) == text and len(pieces) > 10
        assert [i for p in pieces for i in words.encode(p, add_special_tokens=False).ids] == words.encode(text, add_special_tokens=False).ids
    assert list(token_files.segments("z" * 500, 10)) == ["z" * 500]
    long = "word " * 200_000
    assert token_files.encode([long], WORDS)[0].tolist() == [*words.encode(long, add_special_tokens=False).ids, token_files.END]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from("abAé.,;!\u0301ΣςI\u0130 \n\t'stll1½，.-\u00a0\x1c日🧑\u200d\u0300가")) | st.text(), max_size=4))
def test_any_text(words, texts):
    ids, stops = token_files.encode(texts, WORDS)
    want = [[*words.encode(t, add_special_tokens=False).ids, token_files.END] for t in texts]
    assert ids.tolist() == [i for w in want for i in w] and stops.tolist() == np.cumsum([len(w) for w in want]).astype(int).tolist()


def test_the_table_of_words_is_emptied(words, monkeypatch):
    monkeypatch.setattr(token_files, "WORDS", 20)
    model, rng = token_files.Encoder(WORDS), random.Random(0)
    for _ in range(30):
        text = " ".join(rng.choice("abcdefghij") * rng.randint(1, 3) + "x" * rng.choice([0, 0, 0, 99]) for _ in range(25))
        assert model.ids(token_files.cut(text))[0].tolist() == words.encode(text, add_special_tokens=False).ids
        assert len(model.words) <= 20 + 50


def test_a_word_is_looked_up_once_and_marks_apart(words):
    """op13's CPU: what it costs follows the distinct words of a stretch, marks behind words make no further ones."""
    asked = []

    class Table(dict):
        def get(self, word, other=None):
            asked.append(word)
            return super().get(word, other)

    model = token_files.Encoder(WORDS)
    model.words = Table(model.words)
    text = "Élan vital*** and, élan\tvital%%% and: " * 1000
    assert model.ids(token_files.cut(text))[0].tolist() == words.encode(text, add_special_tokens=False).ids
    assert set(asked) <= {"Élan", "élan", "vital", "and", "***", "%%%", ",", ":", ""} and len(asked) == len(set(asked))


def test_a_full_table_keeps_the_words_in_use(words, monkeypatch):
    monkeypatch.setattr(token_files, "WORDS", 4)
    model, learnt = token_files.Encoder(WORDS), []
    model.ids(["antidisestablishment", "b", "naïveté", "d", "9,5"])
    monkeypatch.setattr(model, "_learn", lambda w, learn=model._learn: (learnt.extend(w), learn(w)))
    said = ["naïveté", "new", "9,5", "antidisestablishment", "new"]
    assert model.ids(said)[0].tolist() == words.encode(" ".join(said), add_special_tokens=False).ids
    assert learnt == ["new"] and len(model.words) == 5


def test_texts_of_awkward_pieces(words):
    rng = random.Random(5)
    pieces = ["a", "Word", "É", "ß", "ÿ", "×", "İ", "Σ", "'", "'s", "'LL", "’", "<|endoftext|>", "<|startoftext|>", "<", "|", ">", "|>", *"!\"#$%&()*+,-./:;=?@[\\]^_`{}~", "***", "\x01", "\x00", "\u0301", "\u0338", "9", "½", "日本"]
    blanks = ["", "", "", " ", "  ", "\n", "\t", "\x0b", "\x0c\r", "\x1c", "\x85", "\u00a0"]
    texts = ["".join(rng.choice(pieces) + rng.choice(blanks) for _ in range(rng.randint(0, 12))) for _ in range(4000)]
    ids, stops = token_files.encode(texts, WORDS)
    got = [i.tolist() for i in np.split(ids, stops[:-1])]
    assert got == [[*words.encode(t, add_special_tokens=False).ids, token_files.END] for t in texts]


@pytest.mark.parametrize("segment, at_once", [(9, 30), (9, 1), (1000, 30)])
def test_texts_in_many_stretches(words, monkeypatch, segment, at_once):
    monkeypatch.setattr(token_files, "SEGMENT", segment)
    monkeypatch.setattr(token_files, "AT_ONCE", at_once)
    rng = random.Random(6)
    texts = [" ".join(rng.choice(["don't", "Élan,", "x", "12,5", "日本***", ""]) for _ in range(rng.choice([0, 1, 3, 40]))) for _ in range(60)]
    ids, stops = token_files.encode(texts, WORDS)
    got = [i.tolist() for i in np.split(ids, stops[:-1])]
    assert got == [[*words.encode(t, add_special_tokens=False).ids, token_files.END] for t in texts]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(max_size=40), max_size=6))
def test_checksums_are_joined(parts):
    assert token_files.joined_crc([(zlib.crc32(p), len(p)) for p in parts]) == zlib.crc32(b"".join(parts))


def test_files_are_indexed_and_looked_up(spark, words, tmp_path):
    rows = [(k * 3, f"document {k} of many") for k in range(6000)]
    where = str(tmp_path / "set")
    token_files.write(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), where, WORDS)
    files = [f for f in os.listdir(f"{where}/ids") if f.endswith(".orc")]
    assert files and all(pyarrow.orc.ORCFile(f"{where}/ids/{f}").row_index_stride == 1000 for f in files)
    assert any(pyarrow.orc.ORCFile(f"{where}/ids/{f}").nrows > 1000 for f in files)
    parts = token_files.read_parts(spark, where).orderBy("part").collect()
    assert sum(p["docs"] for p in parts) == 6000 and all(a["most"] < b["least"] and a["start"] + a["n"] == b["start"] for a, b in zip(parts, parts[1:]))
    found = token_files.lookup(spark, where, [9, 10, 17994])
    assert "PushedFilters: [In(key" in found._jdf.queryExecution().toString()
    assert {r["key"]: list(r["ids"]) for r in found.collect()} == {k: [*words.encode(f"document {k // 3} of many", add_special_tokens=False).ids, 2] for k in (9, 17994)}
    # what the reader hands on for one absent key between present ones: no stretch at all
    scan = token_files.read(spark, where).filter("key = 10").select("key")
    read = scan._jdf.queryExecution().executedPlan()
    scan.collect()
    assert _scanned(read) <= 1000


def _scanned(plan) -> int:
    """Rows that a plan's file scan gave."""
    while not plan.children().isEmpty():
        plan = plan.children().head()
    if plan.getClass().getSimpleName() == "InputAdapter":
        plan = plan.child()
    return plan.metrics().apply("numOutputRows").value()
