"""Identifiers in cells against a search with patterns."""

import random
import re

import pytest
from hypothesis import given, settings, strategies as st

from quern.operators import identifiers, release


def stands(identifier, text):
    """Whether a pattern with boundaries at word ends finds it."""
    word = lambda ch: ch == "_" or ch.isalnum()
    for m in re.finditer(f"(?={re.escape(identifier)})", text):
        a, b = m.start(), m.start() + len(identifier)
        if not (a and word(text[a - 1]) and word(identifier[0])) and not (b < len(text) and word(text[b]) and word(identifier[-1])):
            return True
    return False


IDS = ["P-049", "049", "77", "a.b", "a.b.c", "b.c", "J. Doe", "Doe, J", "#12", "x_1", "É-9", "(7)"]


def test_punctuation_blanks_and_overlaps(spark):
    rng = random.Random(3)
    glue = ["", " ", "-", ".", "_", ",", "x", "é", "(", ")"]
    texts = ["".join(rng.choice(IDS + glue) for _ in range(rng.randint(0, 12))) for _ in range(400)] + [None, "", "P-049", "xP-049", "P-0490", "see P-049, 77."]
    rows = spark.createDataFrame([(t, i % 3, i) for i, t in enumerate(texts + texts[:50])], "text string, n int, column int")
    ids = spark.createDataFrame([(i,) for i in [*IDS, "P-049", "", None, "nowhere"]], "id string")
    got = {(r.column, r.identifier): r.n_rows for r in release.leaked_ids(rows, ["text", "n"], ids, "id").collect()}
    cells = texts + texts[:50]
    want = {("text", i): sum(stands(i, t or "") for t in cells) for i in IDS}
    assert got == {k: v for k, v in want.items() if v} and want["text", "P-049"] > 2


@pytest.mark.parametrize("size", [1, 3, 100])
def test_shards_find_the_same(spark, size):
    rows = spark.createDataFrame([("a.b.c and P-049",), ("(7) #12",)], "text string")
    ids = spark.createDataFrame([(i,) for i in IDS], "id string")
    got = {(r.identifier, r.n_rows) for r in identifiers.find(rows, ["text"], ids, "id", size).collect()}
    assert got == {(i, 1) for i in IDS if stands(i, "a.b.c and P-049") or stands(i, "(7) #12")}
    assert sum(map(len, identifiers.shards(ids, "id", size))) == len(IDS)


def test_nothing_to_find(spark):
    rows, ids = spark.createDataFrame([("x",)], "text string"), spark.createDataFrame([], "id string")
    assert identifiers.find(rows, ["text"], ids, "id").collect() == [] and identifiers.find(rows.limit(0), ["text"], spark.createDataFrame([("x",)], "id string"), "id").collect() == []


def test_a_very_long_cell(spark):
    text = "word " * 400_000 + "P-049"
    assert identifiers.find(spark.createDataFrame([(text,)], "text string"), ["text"], spark.createDataFrame([("P-049",), ("wor",)], "id string"), "id").first().n_rows == 1


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("ab-. _é", min_size=1, max_size=4), min_size=1, max_size=6), st.text("ab-. _é", max_size=20))
def test_any_identifiers(ids, text):
    import ahocorasick

    automaton = ahocorasick.Automaton()
    for i in ids:
        automaton.add_word(i, i)
    automaton.make_automaton()
    assert identifiers.standing(automaton, text) == {i for i in ids if stands(i, text)}
