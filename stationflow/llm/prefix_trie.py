"""A prefix trie of conversations, by collapsing whole sequences first.

Turns are named by hashes before anything is shuffled, so no text is. A sequence of turns is named by the sum of what
its turns and their places hash to, so a prefix is named by a running sum, which can be taken over slices of a
conversation. Identical conversations are grouped into one weighted sequence and a list of those that end there;
only the sequences are followed turn by turn. A sequence that is a proper prefix of another is no leaf (anti-join).

Each node belongs to its member of least id. Along a sequence nodes belong to others first and, from one
place on (its branch), to the sequence itself, so that what a subtree adds up to, each node once, is a sum over
sequences: no node is ever paired with those below it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import saved

WORD = r"[^\x20\x09-\x0D]+"

#: Turns of one conversation and so many values of `turn`, or places, meet in one task.
SLICE = 4096
#: Ids of one sequence in so many bits' range make one part of its end list: 65,536 at most.
END_BITS = 16

NAME = ["depth", "one", "two"]


def _running(rows: DataFrame, key: str, piece: Column, order: list, sums: dict[str, Column]) -> DataFrame:
    """Add running sums of `sums` along each key, itself included. Pieces of a key are summed first, in tasks of their own, and `order` refines the order of pieces."""
    rows = rows.withColumn("_piece", piece)
    inside = Window.partitionBy(key, "_piece").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    whole = rows.groupBy(key, "_piece").agg(*[F.sum(c).alias(f"_{n}") for n, c in sums.items()])
    before = Window.partitionBy(key).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    whole = whole.select(key, "_piece", *[F.coalesce(F.sum(f"_{n}").over(before), F.lit(0)).alias(f"_{n}") for n in sums])
    rows = rows.withColumns({n: F.sum(c).over(inside) for n, c in sums.items()}).join(whole, [key, "_piece"])
    return rows.withColumns({n: F.col(n) + F.col(f"_{n}") for n in sums}).drop("_piece", *[f"_{n}" for n in sums])


def numbered(conversations: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, place, a, b, words): the turns of each conversation, from place 1 in the order of `turn` (null first).

    a and b are two hashes of role and text, words the number of words of the text. A null role or text is empty.
    Turns of one number stand in the order of their hashes; equal rows are turns of their own. Rows without a
    conversation id are in no conversation.
    """
    what = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text)]
    rows = conversations.filter(F.col(key).isNotNull()).select(
        F.col(key).cast("long").alias("conv"),
        F.col(turn).alias("turn"),
        F.xxhash64(*what).alias("a"),
        F.xxhash64(F.lit(1), *what).alias("b"),
        F.regexp_count(what[1], F.lit(WORD)).cast("long").alias("words"),
    )
    piece = F.coalesce(F.floor(F.col("turn") / SLICE).cast("long"), F.lit(-(2**63)))
    order = [F.col("turn").asc_nulls_first(), "a", "b"]
    return _running(rows, "conv", piece, order, {"place": F.lit(1)}).select("conv", "place", "a", "b", "words")


def lengths(turns: DataFrame) -> DataFrame:
    """(conv, turns) of each conversation that has any."""
    return turns.groupBy("conv").agg(F.max("place").alias("turns"))


def with_shared_heads(turns: DataFrame, every: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """(turns, ids) of rebuilt conversations: conversation c begins with the first h turns of c - c % every (fewer if it has
    fewer, none if there is none), and goes on with its own turns after its first h; h is crc32(c) % most.

    ids names all conversations, those that are left without turns too. A remainder has the sign of c.
    """
    h = F.crc32(F.col("conv").cast("string").cast("binary")) % most
    convs = saved(lengths(turns).withColumn("h", h).withColumn("base", F.col("conv") - F.col("conv") % every))
    heads = turns.filter((F.col("place") < most) & (F.col("conv") % every == 0)).withColumnRenamed("conv", "base")
    begin = convs.select("conv", "base", "h").filter("h > 0").join(heads, "base").filter("place <= h")
    begin = begin.select("conv", "place", "a", "b", "words")
    of_base = convs.filter(F.col("conv") % every == 0).select(F.col("conv").alias("base"), F.col("turns").alias("of_base"))
    given = convs.join(of_base, "base", "left").select("conv", "h", F.least("h", F.coalesce("of_base", F.lit(0))).alias("given"))
    own = turns.join(given, "conv").filter("place > h")
    own = own.select("conv", (F.col("place") - F.col("h") + F.col("given")).alias("place"), "a", "b", "words")
    return begin.unionByName(own), convs.select("conv")


@dataclass(frozen=True)
class Trie:
    """nodes: depth, one, two (its name), conv_id, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens.

    ends: depth, one, two, part, convs: of each sequence that is a whole conversation, the ids of those in ascending parts.
    """

    nodes: DataFrame
    ends: DataFrame

    def end_digests(self) -> DataFrame:
        """(depth, one, two, ends_sha256) of all nodes at which a conversation ends: of the ids with commas between.

        A task goes through the parts of a list one after the other and keeps none.
        """

        def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            now, state = None, None
            for batch in batches:
                out = []
                for *name, convs in zip(*(batch.column(c).to_pylist() for c in (*NAME, "convs"))):
                    if name == now:
                        state.update(b",")
                    else:
                        if now:
                            out.append([*now, state.hexdigest()])
                        now, state = name, hashlib.sha256()
                    state.update(convs.encode())
                yield _named(out)
            if now:
                yield _named([[*now, state.hexdigest()]])

        parts = self.ends.select(*NAME, "part", F.array_join("convs", ",").alias("convs"))
        parts = parts.repartition(*NAME).sortWithinPartitions(*NAME, "part").select(*NAME, "convs")
        return parts.mapInArrow(digest, "depth long, one long, two long, ends_sha256 string")


def _named(rows: list[list]) -> pa.RecordBatch:
    columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.string()))]
    return pa.RecordBatch.from_arrays(columns, names=[*NAME, "ends_sha256"])


def _lanes() -> dict[str, Column]:
    """Of a turn at its place: 128 bits in four lanes of 32, so that a sum can't overflow."""
    out = {}
    for name in ("a", "b"):
        h = F.xxhash64(name, "place")
        out |= {f"{name}0": F.shiftrightunsigned(h, 32), f"{name}1": h.bitwiseAND(F.lit(0xFFFFFFFF))}
    return out


def _folded(a: str, b: str) -> Column:
    """The low halves of two sums as one long."""
    return F.shiftleft(F.col(a).bitwiseAND(F.lit(0xFFFFFFFF)), 32).bitwiseOR(F.col(b).bitwiseAND(F.lit(0xFFFFFFFF)))


def trie(turns: DataFrame, ids: DataFrame) -> Trie:
    """The trie of the conversations `ids` (conv), whose turns (conv, place, a, b, words) are at places 1, 2, ...

    Every distinct sequence of first turns is a node, from the root without turns; a conversation without turns ends there. No
    conversations have no nodes. A node's n_convs begin with it; its conv_id is the least of these; n_leaves
    and saved_tokens are of its subtree with itself: nodes without children, and (n_convs - 1) times the words of
    each node's last turn. One number, the least id, goes to the driver.
    """
    lanes = _lanes()
    sums = ["a0", "a1", "b0", "b1"]
    whole = turns.groupBy("conv").agg(F.count(F.lit(1)).alias("depth"), F.sum("words").alias("words"), *[F.sum(lanes[s]).alias(s) for s in sums])
    whole = ids.join(whole, "conv", "left").fillna(0)
    whole = saved(whole.select("conv", "depth", "words", _folded("a0", "a1").alias("one"), _folded("b0", "b1").alias("two")))
    grouped = whole.groupBy(*NAME).agg(F.count(F.lit(1)).alias("weight"), F.min("conv").alias("conv"), F.min("words").alias("all_words"))
    sequences = saved(grouped)
    ends = whole.groupBy(*NAME, F.shiftright("conv", END_BITS).alias("part")).agg(F.sort_array(F.collect_list("conv")).alias("convs"))

    # One row for each turn of a sequence, and one for the root: its node's name, its parent's, and the words from it on.
    leads = sequences.select("conv", F.col("depth").alias("turns"), "weight", "all_words")
    steps = turns.join(leads, "conv")
    piece = F.floor(F.col("place") / SLICE).cast("long")
    steps = _running(steps, "conv", piece, ["place"], lanes | {"so_far": F.col("words")})
    for name, parent, s in (("one", "above_one", "a"), ("two", "above_two", "b")):
        steps = steps.withColumn(name, _folded(f"{s}0", f"{s}1"))
        less = {f"_{s}{i}": F.col(f"{s}{i}") - lanes[f"{s}{i}"] for i in (0, 1)}
        steps = steps.withColumns(less).withColumn(parent, _folded(f"_{s}0", f"_{s}1"))
    of_step = ["conv", "depth", "turns", "weight", "one", "two", "above_one", "above_two", "rest"]
    steps = steps.withColumn("depth", F.col("place")).withColumn("rest", F.col("all_words") - F.col("so_far") + F.col("words"))
    zero = F.lit(0).cast("long")
    roots = leads.select("conv", zero.alias("depth"), "turns", "weight", *[zero.alias(c) for c in of_step[4:8]], F.col("all_words").alias("rest"))
    steps = saved(steps.select(*of_step).unionByName(roots))

    owned = saved(steps.groupBy(*NAME).agg(F.min("conv").alias("conv"), F.min_by("rest", "conv").alias("rest"), F.max("turns").alias("longest")))
    inner = owned.filter("longest > depth").select(*NAME)
    leaves = sequences.join(inner, NAME, "left_anti").select("conv", F.lit(1).alias("leaf"))
    branch = owned.groupBy("conv").agg(F.min("depth").alias("branch"), F.min_by("rest", "depth").alias("own_rest"))
    # A sequence that begins one of a lesser id has no node of its own: it would branch beyond its end.
    facts = sequences.select("conv", "depth").join(branch, "conv", "left").join(leaves, "conv", "left")
    facts = saved(facts.select("conv", F.coalesce("branch", F.col("depth") + 1).alias("branch"), F.coalesce("own_rest", F.lit(0)).alias("own_rest"), F.coalesce("leaf", F.lit(0)).alias("leaf")))
    sums = steps.join(facts, "conv").groupBy(*NAME).agg(
        F.min("conv").alias("conv"),
        F.min_by("branch", "conv").alias("branch"),
        F.first("above_one").alias("above_one"),
        F.first("above_two").alias("above_two"),
        F.sum("weight").alias("n_convs"),
        # A child is the next step of the sequence it belongs to.
        F.sum(((F.col("depth") < F.col("turns")) & (F.col("branch") <= F.col("depth") + 1)).cast("long")).alias("n_children"),
        F.sum("leaf").alias("n_leaves"),
        F.sum(F.col("weight") * F.col("rest") - F.when(F.col("depth") >= F.col("branch"), F.col("rest")).otherwise(F.col("own_rest"))).alias("saved_tokens"),
    )
    nodes = saved(sums)

    # Below its branch a sequence is its own parent. At it, the parent is looked up, unless it is the root.
    least = ids.agg(F.min("conv")).first()[0]
    above = owned.select((F.col("depth") + 1).alias("depth"), F.col("one").alias("above_one"), F.col("two").alias("above_two"), F.col("conv").alias("above"))
    at_branch = nodes.filter("depth > 1 AND depth = branch").join(above, ["depth", "above_one", "above_two"])
    others = nodes.filter("NOT (depth > 1 AND depth = branch)")
    others = others.withColumn("above", F.when(F.col("depth") == 1, F.lit(least)).when(F.col("depth") > 1, F.col("conv")))
    columns = [*NAME, F.col("conv").alias("conv_id"), F.col("above").cast("long").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens"]
    return Trie(others.select(*columns).unionByName(at_branch.select(*columns)), ends)
