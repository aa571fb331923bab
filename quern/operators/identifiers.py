"""Real identifiers that stand in cells, whatever punctuation they hold.

All identifiers are looked for in one pass over a cell by an Aho-Corasick automaton: a tree of their
letters with failure links, so overlapping ones are all found. Each task builds the automaton of a
shard of the identifiers (by hash, at most ``SHARD`` of them, which bounds what is broadcast); with
more shards the cells are read once for each. Cells stay where they are: only counts are shuffled.

An identifier counts where no word goes on at its ends: an end that is a letter, digit or underscore
must not stand beside another. Null and empty identifiers and null cells match nothing; repeated
identifiers count once.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: Identifiers of an automaton at most: some tens of megabytes.
SHARD = 100_000

#: A worker's automaton and the name of its shard.
_built: dict[str, object] = {}


def _word(ch: str) -> bool:
    return ch == "_" or ch.isalnum()


def _automaton(name: str, words: Callable[[], list[str]]):
    """The automaton of a shard; a worker keeps the last one."""
    import ahocorasick

    if name not in _built:
        found = ahocorasick.Automaton()
        for identifier in words():
            found.add_word(identifier, identifier)
        found.make_automaton()
        _built.clear()
        _built[name] = found
    return _built[name]


def standing(automaton, text: str) -> set[str]:
    """The identifiers of an automaton that stand in ``text`` between boundaries."""
    found = set()
    for end, identifier in automaton.iter(text):
        first, after = end - len(identifier) + 1, end + 1
        open_left = first == 0 or not (_word(text[first - 1]) and _word(identifier[0]))
        open_right = after == len(text) or not (_word(text[after]) and _word(identifier[-1]))
        if open_left and open_right:
            found.add(identifier)
    return found


def shards(ids: DataFrame, identifier: str, size: int = SHARD) -> Iterator[list[str]]:
    """The distinct identifiers in shards of about ``size`` by hash, one after the other."""
    real = ids.select(F.col(identifier).cast("string").alias("word")).filter("word <> ''").distinct()
    n = real.count()
    many = -(-n // size) if n else 0
    dealt = real.withColumn("shard", F.pmod(F.xxhash64("word"), F.lit(max(many, 1))))
    for k in range(many):
        if words := sorted(r["word"] for r in dealt.filter(F.col("shard") == k).select("word").collect()):
            yield words


def _hits(rows: DataFrame, columns: list[str], words: list[str]) -> DataFrame:
    name, given = uuid.uuid4().hex, rows.sparkSession.sparkContext.broadcast(words)
    cells = rows.select(*[F.col(c).cast("string").alias(f"c{k}") for k, c in enumerate(columns)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton(name, lambda: given.value)
        for batch in batches:
            counts: Counter[tuple[str, str]] = Counter()
            for column, values in zip(columns, batch.columns):
                times = Counter(v for v in values.to_pylist() if v)  # a cell that repeats in a batch is searched once
                for text, n in times.items():
                    for identifier in standing(automaton, text):
                        counts[column, identifier] += n
            if counts:
                yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in counts]), pa.array([k[1] for k in counts]), pa.array(list(counts.values()), pa.int64())], names=["column", "identifier", "n"])

    return cells.mapInArrow(run, "column string, identifier string, n long")


def find(rows: DataFrame, columns: list[str], ids: DataFrame, identifier: str, size: int = SHARD) -> DataFrame:
    """(``column``, ``identifier``, ``n_rows``): identifiers that stand in cells of ``columns``, and in how many rows."""
    found = None
    for words in shards(ids, identifier, size):
        hits = _hits(rows, columns, words)
        found = hits if found is None else found.union(hits)
    if found is None:
        found = rows.sparkSession.createDataFrame([], "column string, identifier string, n long")
    return found.groupBy("column", "identifier").agg(F.sum("n").alias("n_rows"))
