"""Prefix trie of conversations by van Emde Boas recursion.

A conversation is the sequence of its turns; each distinct sequence of first d
turns is a node of depth d, under the textless root.  Nothing walks the trie
turn by turn:

1. A stretch of 2^k turns is cut at half depth.  The two halves are named (a
   pair of 64-bit hashes) from their own halves, for all stretches at once.
2. A stretch's root is the name of the prefix before it.  Root and name of the
   upper half name the prefix at the cut, which is the root of the lower half:
   the upper trie and the lower forests below all cut prefixes then go on in
   parallel, down to single turns.  So a prefix of d turns is named after
   log(d) steps, however deep it is.
3. Stretches of up to ``STRETCH`` turns do this inside a task, on arrays of all
   its stretches.  Longer conversations are stretches of stretches: the same
   recursion, a join and a grouping a level.
4. Members of a name are counted by map-side combined aggregates, so a turn
   that a third of all conversations begin with is a row a task.  A node
   belongs to its smallest member.  The nodes of one conversation are the path
   from its first own depth to its end, and the trie is made of such paths.
5. Totals are grafted upward: sums from the ends of each path, and each path's
   total on every node above its top, again as map-side combined sums by name.

Rows are dealt by ranges of (conversation, turn, ...), so a conversation of any
length is spread over tasks; only digests of turns travel after that.  The
conversations that end in a node are digested in id order over range
partitions, a task holding one piece.

Turns are taken by ``turn`` (nulls first), ties by role, then text; null roles
and texts are empty.  Rows with a null conversation id take no part.  Equal rows
are turns of their own.  An empty table has no trie: no rows.  Other columns
are not read.  Two turns are the same when their 128-bit digests of role and
text are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from barrio.llm.runs import in_order, ordered_digests
from barrio.llm.tables import kept, picked
from barrio.llm.words import join2

STRETCH = 1024               # turns of a stretch named inside a task (a power of two)
ROWS = 1 << 16               # turns named at a time
#: The name of the textless root.
ROOT = (1, 2)
_SALT = np.uint64(0xC2B2AE3D27D4EB4F)


def placed(turns: DataFrame) -> DataFrame:
    """conv_id, part, local (place inside the part), a, b (digest), chars of each
    turn, in order: written, so that later steps count on one dealing."""
    place = ["conv_id", "turn", F.substring("role", 1, 64), F.substring("text", 1, 64)]
    rows = in_order(turns, place, ["conv_id", "turn", "role", "text"])
    digest = F.md5(F.concat(F.length("role"), F.lit(":"), "role", "text"))
    half = lambda i: F.conv(F.substring(digest, i, 16), 16, -10).cast("long")
    local = F.row_number().over(W.partitionBy("part", "conv_id").orderBy("at")) - 1
    return (rows.withColumn("at", F.monotonically_increasing_id())
            .select("conv_id", "part", "at", half(1).alias("a"), half(17).alias("b"),
                    F.length("text").cast("long").alias("chars"))
            .withColumn("local", local.cast("long")).drop("at"))


def _combined(root: np.ndarray, name: np.ndarray) -> np.ndarray:
    """Names (a row of two lanes each) of ``root`` followed by a stretch."""
    return np.stack([join2(root[:, 0], name[:, 0]), join2(root[:, 1] ^ _SALT, name[:, 1])], axis=1)


def stretch_names(turns: np.ndarray, first: np.ndarray, size: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Of each level k, the places of whole stretches of 2^k turns, and their names.

    ``turns`` holds the names of all turns, ``first`` and ``size`` the start and
    length of each sequence; a stretch starts at a multiple of its length.
    """
    local = np.arange(len(turns)) - np.repeat(first, size)
    left = np.repeat(size, size) - local
    at, names = np.arange(len(turns)), turns
    levels = [(at, names)]
    while True:
        step = 1 << (len(levels) - 1)
        whole = (local[at] % (2 * step) == 0) & (left[at] >= 2 * step)
        if not whole.any():
            return levels
        upper = np.flatnonzero(whole)
        lower = np.searchsorted(at, at[upper] + step)
        at, names = at[upper], _combined(names[upper], names[lower])
        levels.append((at, names))


def prefix_names(turns: np.ndarray, first: np.ndarray, size: np.ndarray, roots: np.ndarray
                 ) -> tuple[np.ndarray, np.ndarray]:
    """Names of the prefix up to each turn and of the one before it.

    ``roots`` names the prefix before each sequence.  A prefix whose length has
    2^k as its lowest bit is the prefix 2^k shorter, followed by a stretch.
    """
    total = len(turns) + len(first)
    start = first + np.arange(len(first))          # one place more for each sequence
    shift = np.repeat(np.arange(len(first)), size)
    named = np.zeros((total, 2), dtype=np.uint64)
    named[start] = roots
    levels = stretch_names(turns, first, size)
    for k in range(len(levels) - 1, -1, -1):
        at, names = levels[k]
        # the roots of these stretches are known when they start at an even
        # multiple of 2^k (cut prefixes of the level above); they name the next cut
        even = (at - first[shift[at]]) % (2 << k) == 0
        place = at[even] + shift[at[even]]
        named[place + (1 << k)] = _combined(named[place], names[even])
    own = np.arange(len(turns)) + shift
    return named[own + 1], named[own]


def _sequences(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, np.ndarray]]:
    """Whole stretches of rows sorted by (conv_id, stretch), about ROWS rows at a time."""
    rest: dict[str, np.ndarray] | None = None

    def cut(c: dict[str, np.ndarray]) -> np.ndarray:
        new = (np.diff(c["conv_id"]) != 0) | (np.diff(c["stretch"]) != 0)
        return np.r_[0, np.flatnonzero(new) + 1]

    for batch in batches:
        for i in range(0, batch.num_rows, ROWS):
            part = batch.slice(i, ROWS)
            c = {n: v.to_numpy(zero_copy_only=False) for n, v in zip(part.schema.names, part.columns)}
            if rest:
                c = {n: np.concatenate([rest[n], c[n]]) for n in c}
            at = cut(c)
            if at[-1]:
                yield {n: v[:at[-1]] for n, v in c.items()} | {"first": at[:-1]}
            rest = {n: v[at[-1]:] for n, v in c.items()}
    if rest:
        yield rest | {"first": cut(rest)}


def _lanes(c: dict[str, np.ndarray], a: str, b: str) -> np.ndarray:
    return np.stack([c[a].view(np.uint64), c[b].view(np.uint64)], axis=1)


def _arrow(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(v).view(np.int64)) for v in columns.values()],
                                      names=list(columns))


def _whole_stretches(stretch: int):
    """The name of each stretch that is full."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c in _sequences(batches):
            first = c["first"]
            size = np.diff(np.r_[first, len(c["a"])])
            at, names = stretch_names(_lanes(c, "a", "b"), first, size)[-1]
            full = size[np.searchsorted(first, at, "right") - 1] == stretch
            if full.any():
                at, names = at[full], names[full]
                yield _arrow(conv_id=c["conv_id"][at], i=c["stretch"][at], a=names[:, 0], b=names[:, 1])
    return rows


def _prefixes(stretch: int):
    """The name of every prefix, below the names of the stretches' roots."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c in _sequences(batches):
            first = c["first"]
            size = np.diff(np.r_[first, len(c["a"])])
            name, above = prefix_names(_lanes(c, "a", "b"), first, size, _lanes(c, "root_a", "root_b")[first])
            # a whole stretch ends where the next one's root is
            ends = (c["pos"] + 1) % stretch == 0
            name[ends] = _lanes(c, "next_a", "next_b")[ends]
            yield _arrow(conv_id=c["conv_id"], depth=c["pos"] + 1, stretch=c["stretch"], chars=c["chars"],
                         a=name[:, 0], b=name[:, 1], up_a=above[:, 0], up_b=above[:, 1])
    return rows


def _root(*names: str) -> list:
    return [F.lit(r).cast("long").alias(n) for n, r in zip(names, ROOT)]


def stretch_roots(names: DataFrame, convs: DataFrame, last: int) -> DataFrame:
    """(conv_id, i, a, b): the name of the prefix before stretch ``i``, for every
    i up to the number of whole stretches; (conv_id, i, a, b) of ``names`` are
    the whole stretches of ``convs``, i is ``last`` at most.

    The stretches are cut at half depth: pairs of them are the whole stretches
    of the next level, whose roots are found in the same way.
    """
    below = F.expr("xxhash64(a, low_a)").alias("a"), F.expr("xxhash64(b, low_b, 7)").alias("b")
    lower = names.withColumnsRenamed({"a": "low_a", "b": "low_b"})
    if last < 1:
        root = convs.select("conv_id", F.lit(0).cast("long").alias("i"), *_root("a", "b"))
    else:
        pairs = (names.where("i % 2 = 0").join(lower.withColumn("i", F.col("i") - 1), ["conv_id", "i"])
                 .select("conv_id", F.expr("i div 2").alias("i"), *below))
        root = stretch_roots(kept(pairs, "pt-pairs"), convs, last // 2).withColumn("i", F.col("i") * 2)
    # below every whole upper half lies a cut
    cuts = root.join(lower, ["conv_id", "i"]).select("conv_id", (F.col("i") + 1).alias("i"), *below)
    return kept(root.unionByName(cuts), "pt-roots")


def _prefix_table(rows: DataFrame, stretch: int) -> DataFrame:
    """conv_id, depth, stretch, chars, a, b (the prefix's name), up_a, up_b."""
    def dealt(df: DataFrame) -> DataFrame:
        return df.repartition("conv_id", "stretch").sortWithinPartitions("conv_id", "stretch", "pos")

    longest = rows.agg(F.max("pos")).first()[0]
    if longest is None or longest < stretch - 1:
        rows = rows.select("*", *_root("root_a", "root_b"), *_root("next_a", "next_b"))
    else:
        convs = kept(rows.where(f"pos = {stretch - 1}").select("conv_id"), "pt-long")
        names = kept(dealt(rows.join(convs, "conv_id", "left_semi").select("conv_id", "stretch", "pos", "a", "b"))
                     .mapInArrow(_whole_stretches(stretch), "conv_id long, i long, a long, b long"), "pt-stretches")
        roots = stretch_roots(names, convs, longest // stretch)
        here = roots.withColumnsRenamed({"i": "stretch", "a": "root_a", "b": "root_b"})
        after = roots.where("i > 0").select("conv_id", (F.col("i") - 1).alias("stretch"),
                                            F.col("a").alias("next_a"), F.col("b").alias("next_b"))
        rows = rows.join(here, ["conv_id", "stretch"], "left").join(after, ["conv_id", "stretch"], "left")
        root = {n: F.coalesce(n, r) for side in ("root", "next")
                for n, r in zip((f"{side}_a", f"{side}_b"), _root("a", "b"))}
        rows = rows.withColumns(root)
    columns = ["conv_id", "stretch", "pos", "a", "b", "chars", "root_a", "root_b", "next_a", "next_b"]
    return kept(dealt(rows.select(columns)).mapInArrow(
        _prefixes(stretch), "conv_id long, depth long, stretch long, chars long, a long, b long, up_a long, up_b long"),
        "pt-prefixes")


def trie(turns: DataFrame, members: DataFrame, stretch: int = STRETCH) -> tuple[DataFrame, DataFrame]:
    """(nodes, ends) of sequences.

    ``turns`` has conv_id, pos (from 0, without gaps), a, b (digest) and chars;
    ``members`` the conv_id of every sequence, also of those without a turn.
    nodes: conv_id (smallest member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, a, b (the node's name).
    ends: conv_id, a, b of the node that each sequence ends in.
    """
    prefixes = _prefix_table(kept(turns.withColumn("stretch", F.expr(f"pos div {stretch}")), "pt-rows"), stretch)

    # nodes: members by name; a node is its smallest member's
    nodes = kept(prefixes.groupBy("a", "b").agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"),
        *[F.max(c).alias(c) for c in ("depth", "chars", "up_a", "up_b")]), "pt-nodes")
    children = nodes.groupBy(F.col("up_a").alias("a"), F.col("up_b").alias("b")).agg(F.count("*").alias("n_children"))
    nodes = kept(nodes.join(children, ["a", "b"], "left").select(
        "*", F.coalesce("n_children", F.lit(0)).alias("children"), F.expr("cast(n_children IS NULL AS long)").alias("leaf"),
        ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"), F.expr(f"(depth - 1) div {stretch}").alias("stretch")),
        "pt-counted").drop("n_children").withColumnRenamed("children", "n_children")

    # each path: sums from its end, over stretches and then inside them
    path = W.partitionBy("conv_id")
    later = path.orderBy(F.desc("stretch")).rowsBetween(W.unboundedPreceding, -1)
    sums = nodes.groupBy("conv_id", "stretch").agg(
        F.sum("leaf").alias("leaf"), F.sum("saved").alias("saved"), F.min("depth").alias("top"))
    sums = kept(sums.select(
        "conv_id", "stretch", *[F.coalesce(F.sum(c).over(later), F.lit(0)).alias(f"{c}_later") for c in ("leaf", "saved")],
        *[F.sum(c).over(path).alias(f"{c}_all") for c in ("leaf", "saved")], F.min("top").over(path).alias("top")),
        "pt-sums")
    inside = W.partitionBy("conv_id", "stretch").orderBy(F.desc("depth")).rowsBetween(W.unboundedPreceding, 0)
    own = kept(nodes.join(sums, ["conv_id", "stretch"]).select(
        "a", "b", "up_a", "up_b", "conv_id", "depth", "top", "n_convs", "n_children",
        (F.sum("leaf").over(inside) + F.col("leaf_later")).alias("leaves"),
        (F.sum("saved").over(inside) + F.col("saved_later")).alias("saved")), "pt-own")

    # a path's total goes on every node above its top
    paths = sums.groupBy("conv_id").agg(*[F.max(c).alias(c) for c in ("leaf_all", "saved_all", "top")])
    spread = paths.where("top > 1").withColumn("stretch", F.explode(F.expr(f"sequence(0L, (top - 2) div {stretch})")))
    grafted = (prefixes.select("conv_id", "stretch", "depth", "a", "b").join(spread, ["conv_id", "stretch"])
               .where("depth < top").groupBy("a", "b")
               .agg(F.sum("leaf_all").alias("more_leaves"), F.sum("saved_all").alias("more_saved")))
    up = own.select(F.col("a").alias("up_a"), F.col("b").alias("up_b"), F.col("conv_id").alias("parent"))
    tops = own.where("depth = top AND depth > 1").select("a", "b", "up_a", "up_b").join(up, ["up_a", "up_b"])

    smallest, n_members = members.agg(F.min("conv_id"), F.count("*")).first()
    below = (own.join(grafted, ["a", "b"], "left").join(tops.select("a", "b", "parent"), ["a", "b"], "left").select(
        "conv_id", "depth",
        F.when(F.col("depth") > F.col("top"), F.col("conv_id")).when(F.col("depth") == 1, F.lit(smallest).cast("long"))
        .otherwise(F.col("parent")).alias("parent_conv_id"), "n_convs", "n_children",
        (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("n_leaves"),
        (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved_tokens"), "a", "b"))
    root = paths.agg(F.count(F.when(F.col("top") == 1, 1)).alias("n_children"),
                     F.coalesce(F.sum("leaf_all"), F.lit(1)).alias("n_leaves"),
                     F.coalesce(F.sum("saved_all"), F.lit(0)).alias("saved_tokens"))
    root = root.where(F.lit(n_members > 0)).select(
        F.lit(smallest).cast("long").alias("conv_id"), F.lit(0).cast("long").alias("depth"),
        F.lit(None).cast("long").alias("parent_conv_id"), F.lit(n_members).cast("long").alias("n_convs"),
        "n_children", "n_leaves", "saved_tokens", *_root("a", "b"))

    last = prefixes.groupBy("conv_id").agg(F.max(F.struct("depth", "a", "b")).alias("end"))
    ends = members.join(last, "conv_id", "left").select(
        "conv_id", *[F.coalesce(f"end.{n}", r).alias(n) for n, r in zip("ab", _root("a", "b"))])
    return below.unionByName(root), ends


def rebuilt(turns: DataFrame, heads: int = 6, group: int = 100, conv_col: str = "conv_id", turn_col: str = "turn",
            role_col: str = "role", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(turns, members) of conversations that share the beginnings of others.

    Conversation c begins with the first h turns of conversation c - c % group
    (all if it has fewer, none if it is absent) and goes on with its own turns
    after its first h; h is the CRC-32 of the decimal c, modulo ``heads``.
    """
    rows = picked(turns, conv_id=conv_col, turn=turn_col, role=role_col, text=text_col).where("conv_id IS NOT NULL")
    rows = rows.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"),
                       F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = kept(placed(rows), "pt-turns")
    before = W.partitionBy("conv_id").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    parts = kept(rows.groupBy("conv_id", "part").agg(F.count("*").alias("n")).select(
        "conv_id", "part", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")), "pt-parts")
    base = F.col("conv_id") - F.col("conv_id") % group
    # the first turns of a conversation lie in the first parts that hold it
    head = (rows.where((F.col("conv_id") % group == 0) & (F.col("local") < heads))
            .join(parts.where(F.col("offset") < heads), ["conv_id", "part"])
            .select(F.col("conv_id").alias("base"), (F.col("offset") + F.col("local")).alias("pos"), "a", "b", "chars")
            .where(F.col("pos") < heads - 1)
            .groupBy("base").agg(F.array_sort(F.collect_list(F.struct("pos", "a", "b", "chars"))).alias("head")))
    members = kept(parts.select("conv_id").distinct(), "pt-members")
    taken = F.expr("coalesce(slice(head, 1, cast(h as int)), array())")
    begun = kept(members.withColumn("base", base).withColumn("h", F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads)
                 .join(head, "base", "left").select("conv_id", "h", taken.alias("head")), "pt-heads")
    shared = begun.select("conv_id", F.explode("head").alias("t")).select("conv_id", "t.*")
    shift = parts.join(begun.select("conv_id", "h", F.size("head").alias("n_head")), "conv_id")
    own = (rows.join(shift, ["conv_id", "part"]).withColumn("pos", F.col("offset") + F.col("local"))
           .where("pos >= h").select("conv_id", (F.col("pos") - F.col("h") + F.col("n_head")).alias("pos"),
                                     "a", "b", "chars"))
    return shared.unionByName(own), members


def end_digests(ends: DataFrame) -> DataFrame:
    """(a, b, sha256) of the decimal ids, ascending, joined by commas, of the
    conversations that end in each node."""
    return ordered_digests(ends, ["a", "b"], F.col("conv_id"), F.col("conv_id").cast("string"), ",",
                           lambda df: kept(df, "pt-ends"))
