"""Chat formatting by quotation linking, in DataFrame functions alone.

Lines that start with quote marks are quoted; their depth is the number of marks. A quoted passage
is a run of lines of one depth. Its normalised text is hashed and joined to the runs of lines that
messages wrote themselves, which tells whom a message answers. Conversations come out in reply
order, the order of a walk through the tree of replies, each message with its quotes removed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from quern.llm.storage import discard, materialize

QUOTED = r"^(?:[ \t]*>)+"


def normalise(text: Column) -> Column:
    """Lower case, with letters and digits alone kept and single spaces between words."""
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def depth(line: Column) -> Column:
    """How many quote marks lead a line."""
    return F.length(F.regexp_replace(F.regexp_extract(line, QUOTED, 0), r"[^>]", ""))


def lines(text: Column) -> Column:
    """array<struct<depth, body>> of a text's lines; quoted text is without its marks."""
    split = F.split(F.coalesce(text, F.lit("")), r"\r\n|\n|\r")
    return F.transform(split, lambda x: F.struct(depth(x).alias("depth"), F.regexp_replace(x, QUOTED + r"[ \t]?", "").alias("body")))


def without_quotes(parsed: Column) -> Column:
    """The lines of depth 0 of a parsed text, blank ends trimmed."""
    own = F.array_join(F.transform(F.filter(parsed, lambda x: x["depth"] == 0), lambda x: x["body"]), "\n")
    return F.regexp_replace(own, r"^\s+|\s+$", "")


def full_lines(parsed: Column) -> Column:
    """The lines of a parsed text that aren't blank."""
    return F.filter(parsed, lambda x: F.length(F.trim(x["body"])) > 0)


def passages(parsed: Column) -> Column:
    """array<struct<place, depth, size, body>>: runs of lines of one depth, blank lines left out;
    ``size`` is how many lines.

    A run starts where the depth changes; each run gathers the lines up to the next start.
    """

    def runs(kept: Column) -> Column:
        places = F.when(F.size(kept) > 0, F.sequence(F.lit(0), F.size(kept) - 1)).otherwise(F.array().cast("array<int>"))
        starts = F.filter(places, lambda i: (i == 0) | (F.get(kept, i - 1)["depth"] != F.get(kept, i)["depth"]))

        def cut(s: Column) -> Column:
            size = lambda p, k: F.coalesce(F.get(s, k + 1), F.size(kept)) - p
            return F.transform(
                s,
                lambda p, k: F.struct(
                    p.alias("place"),
                    F.get(kept, p)["depth"].alias("depth"),
                    size(p, k).alias("size"),
                    F.array_join(F.transform(F.slice(kept, p + 1, size(p, k)), lambda x: x["body"]), "\n").alias("body"),
                ),
            )

        return F.element_at(F.transform(F.array(starts), cut), 1)

    return F.element_at(F.transform(F.array(full_lines(parsed)), runs), 1)


def links(messages: DataFrame) -> DataFrame:
    """Quoted passages with the turn that wrote them: (conv_id, turn, message, place, depth,
    quoted_turn).

    ``messages`` has conv_id, turn, message (which tells apart the messages of a turn) and parsed
    (see ``lines``), each once. A passage of n lines is matched by its normalised text to n lines in
    a row that a message of an earlier turn of its conversation wrote itself, to the latest such
    turn; one without a match has a null quoted_turn. Own lines are only cut into runs of the sizes
    that their conversation quotes. A hash of 256 bits stands for the text.
    """
    key = ["conv_id", "turn", "message"]
    found = messages.select(*key, F.explode(passages(F.col("parsed"))).alias("p")).select(*key, "p.*")
    quoted = materialize(found.filter("depth > 0").select(*key, "place", "depth", "size", F.sha2(normalise(F.col("body")), 256).alias("hash")), "quoted")
    sizes = quoted.groupBy("conv_id").agg(F.collect_set("size").alias("sizes"))
    own = messages.select(*key, F.transform(full_lines(F.filter("parsed", lambda x: x["depth"] == 0)), lambda x: x["body"]).alias("own"))
    own = own.join(sizes, "conv_id").select("conv_id", "turn", "own", F.explode("sizes").alias("size")).filter("size <= size(own)")
    run = lambda i: normalise(F.array_join(F.slice("own", i, F.col("size")), "\n"))
    own = own.select("conv_id", "turn", F.explode(F.transform(F.sequence(F.lit(1), F.size("own") - F.col("size") + 1), run)).alias("body")).filter("body <> ''")
    own = own.select("conv_id", F.sha2("body", 256).alias("hash"), "turn")
    return quoted.join(_latest_before(quoted, own), ["conv_id", "turn", "hash"], "left").select(*key, "place", "depth", "quoted_turn")


def _latest_before(quoted: DataFrame, own: DataFrame) -> DataFrame:
    """(conv_id, hash, turn, quoted_turn): for each of ``quoted`` the latest turn before its own in
    which ``own`` has the hash; no row for a null conv_id or turn.

    Both are sorted together over ranges, so that a passage that very many messages of one
    conversation wrote or quote is spread over tasks; a range takes its own latest turn, and else
    the latest of earlier ranges.
    """
    key = ["conv_id", "hash", "turn"]
    asked = quoted.select(*key, F.lit(False).alias("wrote"))
    both = asked.union(own.select(*key, F.lit(True).alias("wrote"))).filter("conv_id is not null and turn is not null").distinct()
    both = both.withColumn("from_turn", F.when(F.col("wrote"), F.col("turn")))  # a message doesn't quote itself: asking sorts first
    ranged = materialize(both.repartitionByRange(*key, "wrote").withColumn("range", F.spark_partition_id()), "quote-ranges")
    here = Window.partitionBy("range", "conv_id", "hash").orderBy("turn", "wrote").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = Window.partitionBy("conv_id", "hash").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    latest = ranged.groupBy("range", "conv_id", "hash").agg(F.max("from_turn").alias("latest")).select("range", "conv_id", "hash", F.max("latest").over(earlier).alias("latest"))
    near = ranged.withColumn("near", F.max("from_turn").over(here)).filter("not wrote")
    return near.join(latest, ["range", "conv_id", "hash"]).select(*key, F.coalesce("near", "latest").alias("quoted_turn"))


def conversations(messages: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row for each message: conv_id, position, turn, role, reply_to, depth, n_quotes, n_linked,
    body.

    ``reply_to`` is the turn that the message's shallowest linked quote came from, the first of
    them; without one the turn before in the conversation, and null for its first. ``position`` is
    the place in reply order: a message stands before its replies, and a reply with all that follows
    from it before the next reply, replies of one message by turn. Equal turns go by role and text,
    and replies to such a turn are to its first message; rows without a turn come last. ``depth`` is
    the deepest quote. Rows with a null conv_id are one conversation, but quotes of rows without a
    conv_id or turn are only taken off, not counted or linked. Null texts are empty. Repeated rows
    stay, each with its own message's counts.
    """
    base = messages.select(F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(text).alias("text"))
    parsed = base.select("conv_id", "turn", "role", F.xxhash64("text").alias("message"), lines(F.col("text")).alias("parsed"))
    asked = parsed.filter(F.exists("parsed", lambda x: x["depth"] > 0))
    asking = materialize(asked.select("conv_id").distinct(), "quoting")
    threads = parsed.join(asking, "conv_id", "left_semi").groupBy("conv_id", "turn", "message").agg(F.first("parsed").alias("parsed"))
    found = links(threads).groupBy("conv_id", "turn", "message").agg(
        F.count("*").alias("n_quotes"),
        F.count("quoted_turn").alias("n_linked"),
        F.max("depth").alias("depth"),
        F.min(F.when(F.col("quoted_turn").isNotNull(), F.struct("depth", "place", "quoted_turn")))["quoted_turn"].alias("linked"),
    )
    found = materialize(found, "quotes")
    own = parsed.select("conv_id", "turn", "role", "message", without_quotes(F.col("parsed")).alias("body"))
    placed = _positions(own)
    out = placed.join(found, ["conv_id", "turn", "message"], "left")
    walked = reply_order(out.join(asking, "conv_id", "left_semi").select("conv_id", "place", "turn", "linked", "before"))
    out = out.join(walked, ["conv_id", "place"], "left")
    return out.select(
        "conv_id",
        F.coalesce("position", "place").alias("position"),
        "turn",
        "role",
        F.coalesce("linked", "before").alias("reply_to"),
        F.coalesce("depth", F.lit(0)).cast("long").alias("depth"),
        F.coalesce("n_quotes", F.lit(0)).cast("long").alias("n_quotes"),
        F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"),
        "body",
    )


def reply_order(rows: DataFrame) -> DataFrame:
    """(conv_id, place, position) of the conversations in which a reply leaves the order of turns.

    ``rows`` has conv_id, place (1 up, by turn), turn, linked and before (turns). The walk through
    the tree of replies is a list: a message is entered, then its replies, then it is left. Each
    step knows the next one; doubling these steps counts the messages entered from each on, in as
    many rounds as the logarithm of the longest conversation, however deep or wide the tree is.
    """
    rows = materialize(rows, "replies")
    branched = materialize(rows.filter("linked <> before").select("conv_id").distinct(), "branched")
    rows = rows.join(branched, "conv_id", "left_semi")
    firsts = rows.groupBy("conv_id", F.col("turn").alias("linked")).agg(F.min("place").alias("first"))
    parent = F.when(F.col("place") > 1, F.coalesce("first", F.col("place") - 1))
    tree = materialize(rows.join(firsts, ["conv_id", "linked"], "left").select("conv_id", "place", F.coalesce(parent, F.lit(0)).alias("parent")), "reply-tree")
    siblings = _with_following(tree, ["conv_id", "parent", "place"])
    same = (F.col("following.conv_id") == F.col("conv_id")) & (F.col("following.parent") == F.col("parent"))
    first_child = tree.groupBy("conv_id", F.col("parent").alias("place")).agg(F.min("place").alias("child"))
    enter = tree.join(first_child, ["conv_id", "place"], "left").select("conv_id", F.col("place").alias("step"), F.coalesce("child", -F.col("place")).alias("after"), F.lit(1).cast("long").alias("entered"))
    leave = siblings.select("conv_id", (-F.col("place")).alias("step"), F.when(same, F.col("following.place")).when(F.col("parent") > 0, -F.col("parent")).alias("after"), F.lit(0).cast("long").alias("entered"))
    steps = materialize(enter.union(leave), "reply-steps")
    while not steps.filter("after is not null").isEmpty():
        ahead = steps.select("conv_id", F.col("step").alias("after"), F.col("after").alias("then"), F.col("entered").alias("more"))
        jumped = steps.join(ahead, ["conv_id", "after"], "left").select("conv_id", "step", F.col("then").alias("after"), (F.col("entered") + F.coalesce("more", F.lit(0))).alias("entered"))
        longer = materialize(jumped, "reply-steps")
        discard(steps)
        steps = longer
    sizes = steps.groupBy("conv_id").agg(F.max("entered").alias("size"))
    return steps.filter("step > 0").join(sizes, "conv_id").select("conv_id", F.col("step").alias("place"), (F.col("size") - F.col("entered") + 1).alias("position"))


def _with_following(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with ``following``, the struct of ``order`` of the next row in that order.

    Rows are sorted over ranges, and a range's last row takes the first one of the next range, so
    that no group is one task's.
    """
    ranged = materialize(rows.repartitionByRange(*order).withColumn("range", F.spark_partition_id()), "following")
    heads = ranged.groupBy("range").agg(F.min(F.struct(*order)).alias("head"))
    heads = heads.select("range", F.lead("head").over(Window.orderBy("range")).alias("head"))
    here = F.lead(F.struct(*order)).over(Window.partitionBy("range").orderBy(*order))
    return ranged.withColumn("following", here).join(F.broadcast(heads), "range").withColumn("following", F.coalesce("following", "head")).drop("range", "head")


def _positions(own: DataFrame) -> DataFrame:
    """``own`` with ``place``, its number in its conversation by turn, and ``before``, the turn ahead.

    Rows are sorted over ranges, so that a conversation of very many rows is spread over tasks; a
    range numbers its own rows, and the counts of earlier ranges are added.
    """
    keys = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_last(), F.col("role").asc_nulls_first(), F.col("body").asc()]
    ranged = materialize(own.repartitionByRange(*keys).withColumn("range", F.spark_partition_id()), "ranges")
    here = Window.partitionBy("range", "conv_id").orderBy(*keys[1:])
    last = F.max_by("turn", F.struct(F.col("turn").isNull(), "turn"))
    earlier = Window.partitionBy("conv_id").orderBy("range")
    sums = ranged.groupBy("conv_id", "range").agg(F.count("*").alias("n"), last.alias("last"))
    sums = sums.select("conv_id", "range", (F.sum("n").over(earlier) - F.col("n")).alias("ahead"), F.lag("last").over(earlier).alias("last"))
    numbered = ranged.withColumn("place", F.row_number().over(here)).withColumn("prior", F.lag("turn").over(here)).alias("r")
    joined = numbered.join(sums.alias("s"), (F.col("r.range") == F.col("s.range")) & F.col("r.conv_id").eqNullSafe(F.col("s.conv_id")))
    return joined.select("r.conv_id", (F.col("place") + F.col("ahead")).alias("place"), "r.turn", "r.role", "r.message", F.when(F.col("place") == 1, F.col("last")).otherwise(F.col("prior")).alias("before"), "r.body")
