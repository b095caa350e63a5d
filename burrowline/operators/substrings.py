"""Which names contain which patterns, by an inverted index of the names' q-grams.

A name that contains a pattern contains each of the pattern's q-grams, so the two meet on one of them, its anchor: the
pattern itself where it is no longer than q, else that of its q-grams which the fewest names of the block have. Names are
taken apart into grams of the sizes that anchors have, and names and patterns meet in an equi-join on block and gram, whose
hot partitions Spark can split. Only candidates of patterns longer than q have to be compared.

Most grams of names are no pattern's anchor. Before grams are moved they are held against a table of WORDS x 64 marks, set by
the hashes of the anchors, which is broadcast: what isn't marked is no anchor, what is marked goes to the join and is judged
there. With more anchors than marks more grams pass it, and nothing is lost.

Work: a name's length times the number of sizes (q at most) where the name is read; the grams that pass the marks are moved,
about as many as there are candidates. Nothing looks at all pairs of a block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from burrowline.sources import shared

Q = 6
#: Marks of anchors are kept in so many words of 64; a broadcast of some 40 MB at most, however many anchors there are.
WORDS = 1 << 20


def grams(text: Column, size: Column | int) -> Column:
    """The distinct substrings of a size."""
    size = F.lit(size) if isinstance(size, int) else size
    starts = F.when(F.length(text) >= size, F.sequence(F.lit(1), F.length(text) - size + 1)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(starts, lambda i: F.substr(text, i, size)))


def _indexed(names: DataFrame, block: list[str], sizes: list[int]) -> DataFrame:
    """block, _name, _g: a row per name and distinct gram of each size."""
    every = F.flatten(F.array(*[grams(F.col("_name"), k) for k in sizes]))
    return names.select(*block, "_name", F.explode(every).alias("_g"))


def _marked(grams_: DataFrame, anchors: DataFrame, block: list[str]) -> DataFrame:
    """Rows of grams_ (block, ..., _g) whose block and gram may be those of an anchor (block, _g)."""
    h = F.xxhash64(*block, "_g")
    word, bit = F.pmod(h, F.lit(WORDS)), F.call_function("shiftleft", F.lit(1).cast("long"), F.call_function("shiftright", h, F.lit(32)).bitwiseAND(F.lit(63)).cast("int"))
    marks = anchors.select(word.alias("_word"), bit.alias("_bit")).groupBy("_word").agg(F.bit_or("_bit").alias("_bits"))
    kept = grams_.withColumns({"_word": word, "_bit": bit}).join(F.broadcast(shared.written(marks, "marks")), "_word")
    return kept.filter(F.col("_bits").bitwiseAND(F.col("_bit")) != 0).drop("_word", "_bit", "_bits")


def candidates(names: DataFrame, patterns: DataFrame, block: list[str], name: str, pattern: str, q: int = Q) -> DataFrame:
    """block, name and pattern of the pairs that share the pattern's anchor, each pair once; patterns that aren't empty."""
    own = names.filter(F.col(name).isNotNull()).select(*block, F.col(name).alias("_name")).distinct()
    asked = patterns.select(*block, F.col(pattern).alias("_p")).filter("_p <> ''").distinct()
    size = F.least(F.length("_p"), F.lit(q))
    found = {r["k"]: r["long"] for r in asked.groupBy(size.alias("k")).agg(F.bool_or(F.length("_p") > q).alias("long")).collect()}  # q rows at most
    if not found:
        return own.select(*block, F.col("_name").alias(name), F.lit(None).cast("string").alias(pattern)).limit(0)
    short = asked.filter(F.length("_p") <= q).select(*block, "_p", F.col("_p").alias("_g"))
    anchored = short
    if found.get(q):
        parts = asked.filter(F.length("_p") > q).select(*block, "_p", F.explode(grams(F.col("_p"), q)).alias("_g"))
        of_names = _marked(_indexed(own, block, [q]).select(*block, "_g"), parts, block)
        often = of_names.groupBy(*block, "_g").agg(F.count("*").alias("_n"))
        rated = parts.join(often, [*block, "_g"], "left")  # a gram that no name has: no name has the pattern
        rare = rated.groupBy(*block, "_p").agg(F.min(F.struct(F.coalesce("_n", F.lit(0)).alias("n"), "_g")).alias("a")).filter("a.n > 0")
        anchored = short.unionByName(shared.written(rare.select(*block, "_p", F.col("a._g").alias("_g")), "anchors"))
    pairs = _marked(_indexed(own, block, sorted(found)), anchored, block).join(anchored, [*block, "_g"])
    return pairs.select(*block, F.col("_name").alias(name), F.col("_p").alias(pattern))


def containing(names: DataFrame, patterns: DataFrame, block: list[str], name: str, pattern: str, q: int = Q) -> DataFrame:
    """block, name and pattern of all pairs of a block of which the name contains the pattern, as `contains` has it: each
    pair of different texts once, nulls nowhere, the empty pattern in every name of its block."""
    hit = candidates(names, patterns, block, name, pattern, q).filter((F.length(pattern) <= q) | F.col(name).contains(F.col(pattern)))
    empty = patterns.filter(F.col(pattern) == "").select(*block, pattern).distinct()
    return hit.unionByName(names.filter(F.col(name).isNotNull()).select(*block, name).distinct().join(empty, block).select(*block, name, pattern))
