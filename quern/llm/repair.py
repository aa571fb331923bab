"""Conversation structure repair by signatures.

A conversation's roles and faults become one compact string, its signature: one letter for each row.
Conversations that go wrong in the same way share a signature, so each distinct one is solved once, by
memoised recursion over (rest of the signature, state of the dialogue). The edits found, one letter
each, are joined back and replayed over the rows.

Rows of a conversation are read in the order of turn (nulls first), then of role, then of a digest of
the text; rows that tie in all of them are equal. Null roles and texts count as one space, and so do null
keys and turns where text is made of them. Null conv_ids form one conversation. A role that is empty has
no initial and is never kept. A signature, an audit and a repaired digest are each one value of one
conversation, so its rows pass through one task, as a stream: what is held is a letter for each row.
An empty table gives an empty result; columns other than the four are not carried.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from quern.llm.storage import discard, materialize

#: What counts as white space: blank, and the characters from tab to carriage return.
WHITE = " \t\n\x0b\x0c\r"
#: What ends a whole text.
ENDS = ".!?"
#: Costs of the edits (fixed values).
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: Letters of the remaining signature that one descent of the recursion takes at most.
DESCENT = 200
#: Kinds of damage (fixed values): the remainder by 20 that brings each.
DROP, EMPTY, UNENDED, REPEAT, AS_USER = range(5)

# Letters of a signature: s, u, a for a role that starts so, o for another; upper case if truncated;
# x for a row that has to go (blank or duplicate).


def damage(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The rows (``conv``, ``turn``, ``role``, ``text``) with a fifth of them damaged by a hash of key
    and turn, and ``gone`` where a row is dropped."""
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.pmod(F.crc32(F.concat(said(conv), F.lit(":"), said(turn)).cast("binary")), F.lit(20))
    rows = df.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), said(role).alias("role"), said(text).alias("text"), kind.alias("kind"))
    hurt = rows.select(
        "conv", "turn",
        F.when(F.col("kind") == AS_USER, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == EMPTY, "").when(F.col("kind") == UNENDED, F.translate("text", ENDS, "")).otherwise(F.col("text")).alias("text"),
        (F.col("kind") == DROP).alias("gone"),
        F.explode(F.when(F.col("kind") == REPEAT, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    )
    return hurt.drop("copy")


def faults(rows: DataFrame) -> DataFrame:
    """``rows`` without texts and with ``mark``, the letter of the signature, ``fault`` (blank,
    duplicate, truncated or null) and ``illegal`` (the row doesn't follow from the one before)."""
    tail = F.right(F.rtrim(F.col("text"), F.lit(WHITE)), F.lit(1))
    digest = F.unhex(F.sha2("text", 256))
    slim = rows.select("conv", "turn", "role", digest.alias("digest"), F.substring("role", 1, 1).alias("initial"), (tail == "").alias("blank"), (~F.contains(F.lit(ENDS), tail)).alias("cut"), "gone")
    order = [F.col("turn").asc_nulls_first(), "role", "digest"]
    seen = F.row_number().over(Window.partitionBy("conv", "gone", "role", "digest").orderBy(F.col("turn").asc_nulls_first())) > 1
    before = F.lag("initial").over(Window.partitionBy("conv", "gone").orderBy(*order))
    fault = F.when(F.col("blank"), "blank").when(F.col("seen"), "duplicate").when(F.col("cut"), "truncated")
    letter = F.when(F.col("initial").isin("s", "u", "a"), F.col("initial")).otherwise("o")
    mark = F.when(F.col("fault").isin("blank", "duplicate"), "x").when(F.col("fault") == "truncated", F.upper(letter)).otherwise(letter)
    legal = F.concat("before", "initial").isin("su", "ua", "au")
    marked = slim.withColumn("seen", seen).withColumn("before", before).withColumn("fault", fault)
    return marked.select("conv", "turn", "role", "digest", "gone", "fault", mark.alias("mark"), F.coalesce(~legal, F.lit(False)).alias("illegal"))


def signatures(marked: DataFrame) -> DataFrame:
    """One row for each conversation: counts of gaps, faults and illegal neighbours, and
    ``signature``. Rows arrive sorted, so a task holds one conversation's letters at a time."""
    sorted_rows = marked.repartition("conv").sortWithinPartitions("conv", F.col("turn").asc_nulls_first(), "role", "digest")
    slim = sorted_rows.select("conv", "turn", "gone", F.when(~F.col("gone"), F.col("fault")).alias("fault"), "mark", (F.col("illegal") & ~F.col("gone")).alias("illegal"))
    kind = marked.schema["conv"].dataType
    names = ["conv", "gaps", "blank", "duplicate", "truncated", "illegal", "signature"]
    types = [None, pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = object()
        now, key_type = none, None
        low = high = last = None
        distinct, counts, letters = 0, {}, []

        def close() -> tuple:
            gaps = high - low + 1 - distinct if distinct else 0
            return (now, gaps, counts["blank"], counts["duplicate"], counts["truncated"], counts["illegal"], "".join(letters))

        for batch in batches:
            done, key_type = [], batch.column(0).type
            for conv, turn, gone, fault, mark, illegal in zip(*(c.to_pylist() for c in batch.columns)):
                if now is none or conv != now:
                    if now is not none:
                        done.append(close())
                    now, low, high, last, distinct, letters = conv, None, None, None, 0, []
                    counts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
                if gone:
                    continue
                letters.append(mark)
                counts["illegal"] += illegal
                if fault:
                    counts[fault] += 1
                if turn is not None and turn != last:
                    low, high, last, distinct = turn if low is None else low, turn, turn, distinct + 1
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, t or key_type) for c, t in zip(zip(*done), types)], names=names)
        if now is not none:
            yield pa.RecordBatch.from_arrays([pa.array([c], t or key_type) for c, t in zip(close(), types)], names=names)

    out = T.StructType([T.StructField("conv", kind), *[T.StructField(c, T.LongType()) for c in names[1:-1]], T.StructField("signature", T.StringType())])
    return slim.mapInArrow(run, out)


#: The dialogue's states: nothing yet, after a system row, after a user row, after an assistant row.
START, SYSTEM, USER, ASSISTANT = range(4)
#: The state that a row of each letter brings, for those that may follow.
FOLLOWS = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}


def solve(signature: str) -> tuple[int, str]:
    """The cheapest edits of a signature: their cost, and a letter for each (D, I, K, R) in order,
    the least in ASCII among equally cheap ones.

    An edit leads from a state to one other state only, so the first letter settles a tie. Rows
    are taken from the end in short descents, so the recursion stays shallow at any length.
    """
    n = len(signature)
    after = {state: next(b for (a, letter), b in FOLLOWS.items() if a == state and letter in "ua") for state in range(4)}

    @lru_cache(maxsize=None)
    def best(at: int, state: int, inserts: int = 0) -> tuple[int, str]:
        """(cost, first edit) from row ``at`` on; after two inserts in a row a third helps nothing."""
        ways = []
        if at == n and state in (START, ASSISTANT):
            return 0, ""
        if inserts < 2:
            ways.append((INSERT + best(at, after[state], inserts + 1)[0], "I"))
        if at < n:
            mark = signature[at]
            ways.append((DELETE + best(at + 1, state)[0], "D"))
            if mark != "x":
                extra = TRUNCATED if mark.isupper() else 0
                if (state, mark.lower()) in FOLLOWS:
                    ways.append((KEEP + extra + best(at + 1, FOLLOWS[state, mark.lower()])[0], "K"))
                ways.append((REROLE + extra + best(at + 1, after[state])[0], "R"))
        return min(ways) if ways else (1 << 62, "")

    for at in range(n, -1, -DESCENT):
        for state in range(4):
            best(at, state)
    cost, audit, at, state, inserts = best(0, START)[0], [], 0, START, 0
    while edit := best(at, state, inserts)[1]:
        audit.append(edit)
        if edit == "I":
            state, inserts = after[state], inserts + 1
            continue
        if edit != "D":
            state = FOLLOWS[state, signature[at].lower()] if edit == "K" else after[state]
        at, inserts = at + 1, 0
    return cost, "".join(audit)


def solved(found: DataFrame) -> DataFrame:
    """(``signature``, ``cost``, ``audit``): each distinct signature solved once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            answers = [solve(signature) for signature in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([a[0] for a in answers], pa.int64()), pa.array([a[1] for a in answers], pa.string())], names=["signature", "cost", "audit"])

    return found.select("signature").distinct().mapInArrow(run, "signature string, cost long, audit string")


class Replay:
    """Replays one conversation's audit over its rows: digest of the repaired rows, and the rows."""

    def __init__(self, audit: str):
        self.audit, self.at, self.next, self.digest, self.any = audit, 0, "user", hashlib.sha256(), False

    def _put(self, role: str, text: str) -> tuple[str, str]:
        self.digest.update((("\n" if self.any else "") + role + ":" + text).encode())
        self.any = True
        self.next = "user" if role[:1] in ("s", "a") else "assistant"
        return role, text

    def inserts(self) -> Iterator[tuple[str, str]]:
        while self.audit[self.at : self.at + 1] == "I":
            self.at += 1
            yield self._put(self.next, "")

    def row(self, role: str, text: str) -> Iterator[tuple[str, str]]:
        yield from self.inserts()
        edit = self.audit[self.at]
        self.at += 1
        if edit != "D":
            yield self._put(role if edit == "K" else self.next, text)


def _replayed(heads: DataFrame, rows: DataFrame, texts: bool) -> DataFrame:
    """The conversations' heads (audits) and rows in one order, replayed as a stream. With ``texts``
    the repaired rows (``conv``, ``place``, ``role``, ``text``), else (``conv``, ``repaired_sha256``)."""
    head = heads.select("conv", F.lit(0).alias("kind"), F.lit(None).cast(rows.schema["turn"].dataType).alias("turn"), F.lit("").alias("role"), F.col("audit").alias("text"), F.lit(None).cast("binary").alias("digest"))
    row = rows.filter("not gone").select("conv", F.lit(1).alias("kind"), "turn", "role", "text", F.unhex(F.sha2("text", 256)).alias("digest"))
    both = head.union(row).repartition("conv").sortWithinPartitions("conv", "kind", F.col("turn").asc_nulls_first(), "role", "digest").select("conv", "kind", "role", "text")
    names = ["conv", "place", "role", "text"] if texts else ["conv", "repaired_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, replay, place, key_type = None, None, 0, None

        def put(done: list[tuple]) -> pa.RecordBatch:
            types = [key_type, pa.int64(), pa.string(), pa.string()] if texts else [key_type, pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), types)], names=names)

        def close(done: list[tuple]) -> None:
            for pair in replay.inserts():
                note(done, pair)
            if not texts:
                done.append((now, replay.digest.hexdigest()))

        def note(done: list[tuple], pair: tuple[str, str]) -> None:
            nonlocal place
            place += 1
            if texts:
                done.append((now, place, *pair))

        for batch in batches:
            done, key_type = [], batch.column(0).type
            for conv, kind, role, text in zip(*(c.to_pylist() for c in batch.columns)):
                if kind == 0:
                    if replay:
                        close(done)
                    now, replay, place = conv, Replay(text), 0
                else:
                    for pair in replay.row(role, text):
                        note(done, pair)
            if done:
                yield put(done)
        if replay:
            close(done := [])
            if done:
                yield put(done)

    kinds = {"conv": rows.schema["conv"].dataType, "place": T.LongType()}
    return both.mapInArrow(run, T.StructType([T.StructField(c, kinds.get(c, T.StringType())) for c in names]))


def audits(rows: DataFrame) -> DataFrame:
    """Counts, ``cost`` and ``audit`` of each conversation of damaged ``rows``, written once."""
    found = materialize(signatures(faults(rows)), "signatures")
    answers = materialize(solved(found), "audits")
    both = materialize(found.join(answers, "signature"), "conversations")
    discard(found, answers)
    return both


def repaired_rows(rows: DataFrame) -> DataFrame:
    """The rows (``conv``, ``place`` from 1, ``role``, ``text``) of every repaired conversation."""
    return _replayed(audits(rows), rows, True)


def repair(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Damage conversations and judge each: ``conv``, ``gaps``, ``blank``, ``duplicate``,
    ``truncated``, ``illegal``, ``cost``, ``audit``, ``repaired_sha256``. A conversation of which no
    row is left has zeros, an empty audit and the digest of nothing."""
    rows = damage(df, conv, turn, role, text)
    heads = audits(rows)
    digests = _replayed(heads, rows, False)
    joined = heads.join(digests, heads["conv"].eqNullSafe(digests["conv"])).select(heads["conv"].alias(conv), "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    return joined
