"""SimHash fingerprints and their neighbours, in DataFrame expressions only.

Every word of a text votes for and against each bit of the fingerprint, by the bits of its hash and with the
word's weight. Four bits are counted in one long, in lanes of 16 bits, over blocks of words whose weights fit in a
lane; so a word makes 32 additions rather than 128. All words of a text are added up in the task that holds it.

Fingerprints within a Hamming radius r are found by tables: the bits are cut into blocks, of which r at
most can differ, so two such fingerprints agree in some choice of the other blocks. There is a table for each choice.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import saved

BITS = 128
_LANES = 0x0001000100010001
SPLIT = r"[\x20\x09-\x0D]+"
#: A word weighs its length, up to this: short words are common to all texts. A text's weights never exceed its length.
MAX_WEIGHT = 12
#: Words of a block: 2048 of weight 12 at most stay below 32,768, so the top lane leaves the sign of its long alone.
_BLOCK_BITS = 11


def fingerprints(texts: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """(keys, fingerprint) of every combination of keys: 32 hex digits, all zero for a text without words.

    Rows whose keys agree are taken together, so let keys tell texts apart. Equal texts have equal fingerprints.
    """
    words = texts.select(*keys, F.posexplode(F.split(F.coalesce(text, F.lit("")), SPLIT)).alias("at", "word"))
    h0 = F.xxhash64("word")
    words = words.select(*keys, F.shiftright("at", _BLOCK_BITS).alias("block"), h0.alias("h0"), F.xxhash64("word", F.lit(1)).alias("h1"), F.least(F.length("word"), F.lit(MAX_WEIGHT)).cast("long").alias("w"))
    sums = [F.sum(F.shiftrightunsigned(f"h{k}", j).bitwiseAND(F.lit(_LANES)) * F.col("w")).alias(f"s{k}_{j}") for k in (0, 1) for j in range(16)]
    blocks = words.groupBy(*keys, "block").agg(F.sum("w").alias("all"), *sums)
    # Few texts have more than one block: the lanes of the others are their votes.
    lanes = [F.sum(F.shiftrightunsigned(f"s{k}_{j}", 16 * lane).bitwiseAND(F.lit(0xFFFF))).alias(f"v{k}_{j + 16 * lane}") for k in (0, 1) for j in range(16) for lane in range(4)]
    votes = blocks.groupBy(*keys).agg(F.sum("all").alias("all"), *lanes)

    def bit(k: int, i: int) -> Column:
        return F.shiftleft((2 * F.col(f"v{k}_{i}") > F.col("all")).cast("long"), i)

    halves = [reduce(Column.bitwiseOR, [bit(k, i) for i in range(64)]) for k in (0, 1)]
    return votes.select(*keys, F.lower(F.concat(*[F.lpad(F.hex(h), 16, "0") for h in halves])).alias("fingerprint"))


def distance(a: Column, b: Column) -> Column:
    """Bits in which two fingerprints differ."""
    return sum(
        (F.bit_count(F.conv(F.substring(a, i, 8), 16, 10).cast("long").bitwiseXOR(F.conv(F.substring(b, i, 8), 16, 10).cast("long"))) for i in range(1, BITS // 4 + 1, 8)),
        F.lit(0),
    )


def likeness(a: Column, b: Column) -> Column:
    """Share of bits that agree."""
    return 1 - distance(a, b) / F.lit(float(BITS))


def within_radius(queries: DataFrame, index: DataFrame, radius: int = 3, blocks: int = 5) -> DataFrame:
    """(fingerprint, other, distance) for each distinct fingerprint of queries and of index that differ in `radius` bits or fewer.

    Both have a column fingerprint. More blocks make longer table keys, and more tables.
    """
    if not 0 <= radius < blocks:
        raise ValueError("there must be more blocks than bits that differ")
    digits = BITS // 4
    edges = [i * digits // blocks for i in range(blocks + 1)]
    parts = [(a + 1, b - a) for a, b in zip(edges, edges[1:])]
    choices = list(combinations(parts, blocks - radius))

    def tables(df: DataFrame, name: str) -> DataFrame:
        keys = [F.struct(F.lit(i).alias("table"), F.concat(*[F.substring("fingerprint", a, n) for a, n in choice]).alias("bits")) for i, choice in enumerate(choices)]
        return df.select("fingerprint").distinct().select(F.col("fingerprint").alias(name), F.explode(F.array(*keys)).alias("key")).select(name, "key.table", "key.bits")

    pairs = tables(queries, "fingerprint").join(tables(index, "other"), ["table", "bits"])
    pairs = pairs.withColumn("distance", distance(F.col("fingerprint"), F.col("other"))).filter(F.col("distance") <= radius)
    return pairs.select("fingerprint", "other", "distance").distinct()


def following(ids: DataFrame) -> DataFrame:
    """(id, next) for distinct long ids: the next larger id, and for the largest the smallest.

    Ids are taken in ranges of 65,536, and ranges of ranges, so that no task sorts more than that many.
    """

    def lead(rows: DataFrame, level: int) -> DataFrame:
        up = F.shiftright("id", 16)
        if level == 3:
            every = Window.orderBy("id")
            first = F.first("low").over(every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
            return rows.select("id", F.coalesce(F.lead("low").over(every), first).alias("next"))
        inside = rows.withColumn("up", up).withColumn("next", F.lead("low").over(Window.partitionBy("up").orderBy("id")))
        above = lead(rows.groupBy(up.alias("id")).agg(F.min("low").alias("low")), level + 1)
        above = above.select(F.col("id").alias("up"), F.col("next").alias("above"))
        return inside.join(above, "up").select("id", F.coalesce("next", "above").alias("next"))

    return lead(ids.select("id", F.col("id").alias("low")), 0)


def compare_with_edits(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprint every text and an edited form of it: the last quarter of its characters replaced by as many of the first
    ones (or all) of the next document, by ascending key; the last is followed by the first.

    Returns key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of every row. A null text
    is empty. Keys are integers; a null key comes first, and stands for one document. Where a key repeats, each row
    is followed by the next key, equal rows give equal ones, and the document's text for those ahead of it is the smallest one.
    """
    lowest = -(2**63)
    rows = docs.select(F.coalesce(F.col(key), F.lit(lowest)).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    ids = saved(rows.groupBy("id").agg(F.max(F.floor(F.length("text") / 4)).alias("need")))
    order = saved(following(ids))
    ahead = order.join(ids, "id").select(F.col("id").alias("owner"), F.col("next").alias("id"), "need")
    # Both joins shuffle the same columns of the texts by id, so Spark shuffles them once.
    heads = rows.join(ahead.hint("merge"), "id").select("owner", F.substring("text", F.lit(1), F.col("need").cast("int")).alias("head"))
    heads = heads.groupBy(F.col("owner").alias("id")).agg(F.min("head").alias("head"))
    n = F.length("text")
    cut = F.floor(n / 4).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - cut), F.substring("head", F.lit(1), cut))
    both = rows.join(heads.hint("merge"), "id").select("id", F.xxhash64("text").alias("name"), n.cast("long").alias("n_chars"), "text", edited.alias("edited"))
    facts = both.select("id", "name", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"))
    kinds = F.explode(F.array(F.struct(F.lit(0).alias("kind"), F.col("text")), F.struct(F.lit(1).alias("kind"), F.col("edited").alias("text")))).alias("x")
    # Equal rows are counted each by itself, as fingerprints takes rows of equal keys together; the number leaves no trace.
    numbered = both.withColumn("row", F.monotonically_increasing_id()).select("id", "name", "row", kinds)
    prints = fingerprints(numbered.select("id", "name", "row", "x.kind", "x.text"), ["id", "name", "row", "kind"])
    prints = prints.groupBy("id", "name").agg(*[F.max(F.when(F.col("kind") == i, F.col("fingerprint"))).alias(c) for i, c in enumerate(("fingerprint", "edited_fingerprint"))])
    out = saved(facts.join(prints, ["id", "name"]))
    theirs = out.groupBy("id").agg(F.min(F.struct("name", "fingerprint"))["fingerprint"].alias("next_fingerprint")).withColumnRenamed("id", "next")
    out = out.join(order, "id").join(theirs, "next")
    return out.select(
        F.when(F.col("id") != lowest, F.col("id")).cast(docs.schema[key].dataType).alias(key),
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )
