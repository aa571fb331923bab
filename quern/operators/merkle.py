"""A hash tree over numbered records: every record's hash rests on all records before it.

Record i's ``record_hash`` is the root of the tree over records 1 to i, so an edit changes the hashes
of all later records, as in a chain. Unlike a chain it is worked out in rounds: stretches of ``SPAN``
records are built side by side, then stretches of stretches, so a log of n records takes log n to the
base of ``SPAN`` rounds and no task sees more than one stretch. Records are moved to their stretch and
stay there: what a stretch's roots are is worked out twice, first for the rounds above, and only those
are written; hashes and paths are then given to the records where they lie.

A node's hash is over its two children's; a node without a right sibling is passed up unchanged. A
record that is missing from the numbering leaves its place empty, which changes all that follows; of
records with one number the largest hash stands. Null payloads hash as the text that the caller makes
of them. An empty log has no root.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from quern.functions.storage import discard, materialize

#: The binary logarithm of a stretch's length.
BITS = 8
SPAN = 1 << BITS
GENESIS = "0" * 64
#: The hash of a place without a record.
EMPTY = ""


def leaf(payload: Column) -> Column:
    """A record's own hash; leaves and nodes can't be taken for each other."""
    return F.sha2(F.concat(F.lit("leaf\n"), payload), 256)


def node(left: Column, right: Column) -> Column:
    return F.sha2(F.concat(F.lit("node\n"), left, F.lit("\n"), right), 256)


def _stretches(nodes: DataFrame, bits: int, row: str | None = None) -> DataFrame:
    """(group, got, levels) of (pos, hash): each stretch's nodes, and its levels from its leaves up to its
    root. With ``row``, also ``rows``: that column of every node, with its pos."""
    placed = nodes if "group" in nodes.columns else nodes.withColumn("group", F.shiftright("pos", bits))
    rows = [F.collect_list(F.struct("pos", row)).alias("rows")] if row else []
    pairs = placed.groupBy("group").agg(F.array_sort(F.collect_list(F.struct("pos", "hash"))).alias("got"), *rows)
    first = F.shiftleft(F.col("group"), bits)
    last = F.element_at("got", -1)["pos"] - first
    whole = (F.size("got") == last + 1) & (F.size(F.array_distinct(F.transform("got", lambda r: r["pos"]))) == F.size("got"))
    at = lambda k: F.coalesce(F.try_element_at(F.filter("got", lambda r: r["pos"] == first + k), F.lit(-1))["hash"], F.lit(EMPTY))
    level = F.when(whole, F.transform("got", lambda r: r["hash"])).otherwise(F.transform(F.sequence(F.lit(0).cast("long"), last), at))
    up = lambda below: F.transform(
        F.sequence(F.lit(0), F.ceil(F.size(below) / 2).cast("int") - 1),
        lambda j: F.coalesce(node(F.get(below, j * 2), F.get(below, j * 2 + 1)), F.get(below, j * 2)),
    )
    grown = F.aggregate(F.array_repeat(F.lit(0), bits), F.array(level), lambda levels, _: F.concat(levels, F.array(up(F.element_at(levels, -1)))))
    return pairs.select("group", "got", grown.alias("levels"), *(["rows"] if row else []))


def _tops(stretches: DataFrame, bits: int) -> DataFrame:
    """(pos, hash) of the stretches' roots, as the nodes of the next round."""
    return stretches.select(F.col("group").alias("pos"), F.element_at(F.element_at("levels", bits + 1), 1).alias("hash"))


def _rounds(nodes: DataFrame, bits: int) -> tuple[list[DataFrame], DataFrame]:
    """The stretches of each round above the records, up to the round with one stretch, and the last
    round's roots."""
    found, tops = [], materialize(_tops(_stretches(nodes, bits), bits), "merkle")
    while tops.filter("pos > 0").limit(1).count():
        found.append(materialize(_stretches(tops, bits), "merkle"))
        tops = _tops(found[-1], bits)
    return found, tops


def _beside(stretches: DataFrame, above: DataFrame | None, name: str) -> DataFrame:
    """Stretches with ``name``: what the round above gave them (pos, ``name``); nothing in the highest."""
    if above is None:
        return stretches.withColumn(name, F.array().cast("array<string>"))
    # stretches are long and lie by their number already; so the short side alone is moved, and held
    return stretches.join(above.withColumnRenamed("pos", "group").hint("shuffle_hash"), "group")


def _places(stretches: DataFrame) -> DataFrame:
    """A row for each place of a stretch: ``r`` from 0."""
    return stretches.withColumn("r", F.explode(F.sequence(F.lit(0), F.size(F.get("levels", F.lit(0))) - 1)))


def _bits(bits: int) -> Column:
    return F.array(*[F.lit(k) for k in range(bits)])


def _set(number: Column, bit: Column) -> Column:
    return F.call_function("shiftright", number.cast("int"), bit) % 2 == 1


def _peaks(levels: Column, before: Column, bits: int) -> Column:
    """Roots of the whole subtrees that make up the first ``before`` places of a stretch, the last
    one (the smallest) first."""
    chosen = F.filter(_bits(bits + 1), lambda k: _set(before, k))
    return F.transform(chosen, lambda k: F.get(F.get(levels, k), F.call_function("shiftright", before.cast("int"), k) - 1))


def _folded(peaks: Column) -> Column:
    """The root over subtrees that stand in ``peaks`` from the last to the first."""
    return F.aggregate(peaks, F.lit(None).cast("string"), lambda acc, p: F.when(acc.isNull(), p).otherwise(node(p, acc)))


def _ahead(found: list[DataFrame], bits: int) -> DataFrame | None:
    """(pos, ahead): the peaks of all that stands before a stretch of records."""
    above = None
    for round_ in reversed(found):
        places = _places(_beside(round_, above, "ahead"))
        above = places.select((F.shiftleft("group", bits) + F.col("r")).alias("pos"), F.concat(_peaks(F.col("levels"), F.col("r"), bits), "ahead").alias("ahead"))
    return above


def _roots(r: Column, bits: int) -> tuple[Column, Column]:
    """The roots before, and up to, place ``r`` of a stretch (levels, ahead)."""
    before, own = (_folded(F.concat(_peaks(F.col("levels"), r + k, bits), "ahead")) for k in (0, 1))
    return F.coalesce(before, F.lit(GENESIS)).alias("prev_hash"), own.alias("record_hash")


def prefix_roots(leaves: DataFrame, bits: int = BITS) -> DataFrame:
    """(``pos``, ``prev_hash``, ``record_hash``) of ``leaves`` (``pos`` from 0, ``hash``): the roots over
    the places before, and up to, each place. Places without a record get a row too."""
    places = _places(_beside(_stretches(leaves, bits), _ahead(_rounds(leaves, bits)[0], bits), "ahead"))
    return places.select((F.shiftleft("group", bits) + F.col("r")).alias("pos"), *_roots(F.col("r"), bits))


def rooted_stretches(log: DataFrame, pos: Column, hash: Column, bits: int = BITS) -> DataFrame:
    """(``group``, ``rows``): the records of each stretch as array<struct<pos, row, prev_hash, record_hash>>,
    ``row`` being all columns of ``log``. Records without a pos are left out."""
    # records are moved by their stretch's number and hashed there
    placed = log.withColumn("_pos", pos.cast("long")).filter("_pos is not null").withColumn("_group", F.shiftright("_pos", bits)).repartition("_group")
    nodes = placed.select(F.col("_group").alias("group"), F.col("_pos").alias("pos"), F.struct(*log.columns).alias("row"), hash.alias("hash"))
    ahead = _ahead(_rounds(nodes, bits)[0], bits)
    first = F.shiftleft("group", bits)
    given = lambda r: F.struct(r["pos"].alias("pos"), r["row"].alias("row"), *_roots((r["pos"] - first).cast("int"), bits))
    return _beside(_stretches(nodes, bits, "row"), ahead, "ahead").select("group", F.transform("rows", given).alias("rows"))


def _steps(r: Column, bits: int) -> Column:
    """The hashes beside the way from place ``r`` of a stretch (levels, rest) to the root."""
    index = lambda k: F.call_function("shiftright", r, k)
    beside = F.transform(_bits(bits), lambda k: F.concat(F.when(index(k) % 2 == 1, "L").otherwise("R"), F.get(F.get("levels", k), index(k).bitwiseXOR(F.lit(1)))))
    return F.concat(F.filter(beside, lambda s: s.isNotNull()), "rest")


def _rest(found: list[DataFrame], bits: int) -> DataFrame | None:
    """(pos, rest): the way from a stretch of records to the root."""
    above = None
    for round_ in reversed(found):
        places = _places(_beside(round_, above, "rest"))
        above = places.select((F.shiftleft("group", bits) + F.col("r")).alias("pos"), _steps(F.col("r"), bits).alias("rest"))
    return above


def inclusion_paths(leaves: DataFrame, bits: int = BITS) -> DataFrame:
    """(``pos``, ``path``) for each place: the hashes beside the way from its leaf to the root, each
    behind L or R for the side on which it stands."""
    places = _places(_beside(_stretches(leaves, bits), _rest(_rounds(leaves, bits)[0], bits), "rest"))
    return places.select((F.shiftleft("group", bits) + F.col("r")).alias("pos"), _steps(F.col("r"), bits).alias("path"))


def with_paths(leaves: DataFrame, bits: int = BITS) -> DataFrame:
    """``leaves`` (``pos``, ``hash``) with the ``path`` of each; paths are never moved. Those without a pos
    are left out."""
    known = leaves.filter("pos is not null")
    first = F.shiftleft("group", bits)
    given = lambda g: F.struct(g["pos"].alias("pos"), g["hash"].alias("hash"), _steps((g["pos"] - first).cast("int"), bits).alias("path"))
    stretches = _beside(_stretches(known, bits), _rest(_rounds(known, bits)[0], bits), "rest")
    return stretches.select(F.explode(F.transform("got", given)).alias("g")).select("g.*")


def climbed(own: Column, path: Column) -> Column:
    """The root that a leaf's hash and its path lead to."""
    return F.aggregate(path, own, lambda acc, s: F.when(F.substring(s, 1, 1) == "L", node(F.substring(s, 2, 64), acc)).otherwise(node(acc, F.substring(s, 2, 64))))


def root(leaves: DataFrame, bits: int = BITS) -> str | None:
    """The root over all records, or None for an empty log."""
    found, tops = _rounds(leaves, bits)
    top = tops.first()
    discard(*found, tops)
    return top["hash"] if top else None
