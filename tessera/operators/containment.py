"""Two-way containment of labels by a trigram index.

A string lies in another one only if all its trigrams do.  So each string looks
for the longer ones under its *rarest* gram among them, and only what meets
there is compared.  A string with a gram that the other side does not have lies
in none of its strings and meets nothing.  Strings of one or two characters are
their own gram; the empty string lies in every string.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.session import cut_lineage

GRAM = 3


def _grams(s: Column, size: int) -> Column:
    """The distinct grams of ``size`` characters."""
    last = F.length(s) - size + 1
    return F.when(last >= 1, F.array_distinct(F.transform(F.sequence(F.lit(1), last), lambda i: F.substring(s, i, F.lit(size))))).otherwise(
        F.array().cast("array<string>"))


def containment_pairs(strings: DataFrame) -> DataFrame:
    """(side, short, long): strings of different sides where ``long`` holds the rarest gram of ``short`` (of that ``side``).

    That is every pair of which ``short`` is contained in ``long``, and few
    others.  ``strings`` has distinct rows (side, s): two sides, 0 and 1, of
    non-empty strings.  Both directions share one index, and a gram's length
    says whether it serves strings of one, two or more characters.
    """
    s = F.col("s")
    own = F.least(F.length(s), F.lit(GRAM))
    sizes = [r["n"] for r in strings.select(own.alias("n")).distinct().collect()]  # at most GRAM values
    if not sizes:
        return strings.select("side", F.col("s").alias("short"), F.col("s").alias("long"))
    posts = strings.select((1 - F.col("side")).alias("of"), F.col("s").alias("long"), F.explode(F.concat(*[_grams(s, n) for n in sizes])).alias("gram"))
    often = posts.groupBy("of", "gram").agg(F.count(F.lit(1)).alias("c"))
    keys = F.coalesce(*[F.when(own == n, _grams(s, n)) for n in sizes])
    keys = strings.select("side", "s", keys.alias("g")).select("side", "s", F.size("g").alias("wanted"), F.explode("g").alias("gram"))
    keys = keys.join(often.withColumnRenamed("of", "side"), ["side", "gram"])
    keys = keys.groupBy("side", "s", "wanted").agg(F.count(F.lit(1)).alias("met"), F.min(F.struct("c", "gram")).alias("k")).where("met = wanted")
    keys = keys.select("side", F.col("s").alias("short"), F.col("k.gram").alias("gram"))
    return keys.join(posts.withColumnRenamed("of", "side"), ["side", "gram"]).select("side", "short", "long")


def first_containing(names: DataFrame, topics: DataFrame) -> DataFrame:
    """(name, topic): for each distinct ``name`` the first topic (by ``topic_pos``) that contains it or lies in it, case-insensitively.

    ``names`` (name, in lower case), ``topics`` (topic_pos, topic).  Names without a match and null names are absent.
    """
    lower = topics.groupBy(F.lower("topic").alias("s")).agg(F.min(F.struct("topic_pos", "topic")).alias("t"))
    both = names.select(F.col("name").alias("s")).distinct().select(F.lit(0).alias("side"), "s", F.lit(None).cast(lower.schema["t"].dataType).alias("t"))
    both = cut_lineage(both.unionByName(lower.select(F.lit(1).alias("side"), "s", "t")).where("s is not null"))
    held = containment_pairs(both.where("s <> ''").select("side", "s")).where(F.col("long").contains(F.col("short")))
    held = held.select(F.when(F.col("side") == 0, F.col("short")).otherwise(F.col("long")).alias("name"),
                       F.when(F.col("side") == 0, F.col("long")).otherwise(F.col("short")).alias("lt"))
    lower = both.where("side = 1").select(F.col("s").alias("lt"), "t")
    names = both.where("side = 0").select(F.col("s").alias("name"))
    met = held.join(lower, "lt").select("name", "t")
    # the empty string lies in every string: an empty name takes the first topic of all, an empty topic is met by every name
    of_all = F.when(F.col("name") == "", lower.agg(F.min("t")).scalar()).otherwise(lower.where("lt = ''").agg(F.min("t")).scalar())
    met = met.unionByName(names.select("name", of_all.alias("t")))
    return met.where("t is not null").groupBy("name").agg(F.min("t").alias("t")).select("name", F.col("t.topic").alias("topic"))
