"""Mixing sources to target weights by weighted sampling without replacement.

Each document draws the key -ln(u) / w (Efraimidis and Spirakis), u being a hash of its id and w its quality weight.
A source first gives as many complete epochs as its target holds; the rest is filled in the order of the keys up to the
budget, by a running sum of sizes. The document at the edge of the budget is taken if that comes nearer to it.

No source is sorted as a whole: keys fall into ordered buckets, in two steps. Sums of coarse buckets give the one in which
the budget ends, sums of the fine ones in it the next, and only the documents of that, one in millions, are sorted. The
outcome is one cut per source, which every document is compared with; texts are not shuffled.

Defined results: a null text has size 0 and weight 1; documents of size 0 take 0 words; a source of size 0 has the
target 0; null sources form one group, the last; rows without doc_id draw their keys by their place in the scan; rows
that repeat a doc_id share a key and go by size, then by their place; an empty table gives no rows; other columns are kept
by ``copies`` and ignored by ``mix``. Files are scanned in the same order each time, so reruns agree.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelkit.llm import common
from panelkit.sources.staging import stage

#: Coarse buckets of keys in each source, and fine ones in each of them.
BUCKETS, FINE_BITS = 1 << 12, 12
#: Marks that speak against a text; one per word cuts the weight to a fifth.
MARKS = r"[!#$%&*|<>{}]"


@dataclass(frozen=True)
class Mix:
    """Weights of the sources in the order of their names, repeating; the total as a share of all sizes; the most epochs."""

    weights: tuple[float, ...] = (3, 1, 2)
    share: float = 1.5
    epochs: int = 2
    seed: str = "mix"


def size_of(text: Column) -> Column:
    return F.regexp_count(common.text_of(text), F.lit(common.WORD)).cast("long")


def quality_of(text: Column, size: Column) -> Column:
    """Words over words and marks: 1 for plain prose, less for littered text."""
    marks = F.regexp_count(common.text_of(text), F.lit(MARKS))
    return F.when(size > 0, size / (size + 4 * marks)).otherwise(1.0)


def key_of(doc_id: Column, place: Column, weight: Column, seed: str) -> Column:
    """The exponential key; small keys come first."""
    name = F.coalesce(doc_id.cast("string"), F.concat(F.lit("row "), place.cast("string")))
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), name)), 1, 13)
    u = (F.conv(digits, 16, 10).cast("double") + 0.5) / float(1 << 52)
    return -F.ln(u) / weight


def keyed(docs: DataFrame, mix: Mix) -> DataFrame:
    """Documents with mix_size, mix_key, mix_place and the fine mix_bucket; buckets follow the order of the keys."""
    size = docs.withColumns({"mix_size": size_of(F.col("text")), "mix_place": F.monotonically_increasing_id()})
    key = key_of(F.col("doc_id"), F.col("mix_place"), quality_of(F.col("text"), F.col("mix_size")), mix.seed)
    bucket = F.floor((1 - F.exp(-F.col("mix_key"))) * (BUCKETS << FINE_BITS)).cast("int")
    return size.withColumn("mix_key", key).withColumn("mix_bucket", bucket)


def targets(sizes: DataFrame, mix: Mix) -> DataFrame:
    """Target per source: a level times its weight, but its cap at most; the level makes the targets add up.

    Sources in the order of cap over weight: with the first k at their caps, the level is what is left over the weights
    that are left. The first source below its cap at its own level tells the level. One row per source.
    """
    weights = F.array(*[F.lit(float(w)) for w in mix.weights])
    rank = F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1
    own = sizes.withColumn("rank", rank).withColumn("weight", F.get(weights, F.pmod("rank", F.lit(len(mix.weights)))))
    own = own.withColumn("cap", (mix.epochs * F.col("source_size")).cast("double"))
    order = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    everything = Window.partitionBy()
    left = mix.share * F.sum("source_size").over(everything) - (F.sum("cap").over(order) - F.col("cap"))
    weight_left = F.sum("weight").over(everything) - (F.sum("weight").over(order) - F.col("weight"))
    own = own.withColumn("own_level", left / weight_left)
    below = F.when(F.col("own_level") * F.col("weight") <= F.col("cap"), F.col("own_level"))
    level = F.first(below, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return own.withColumn("target", F.least(F.coalesce(level * F.col("weight"), F.col("cap")), F.col("cap"))).select(
        "source", "source_size", "target"
    )


def cuts(rows: DataFrame, mix: Mix) -> DataFrame:
    """Per source: size, target, whole epochs, and the last key that the next epoch takes."""
    coarse = F.shiftright("mix_bucket", FINE_BITS)
    buckets = rows.groupBy("source", coarse.alias("mix_bucket")).agg(F.sum("mix_size").alias("words"))
    buckets = stage(buckets, "mix-buckets")
    goals = targets(buckets.groupBy("source").agg(F.sum("words").alias("source_size")), mix)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    goals = goals.withColumn("epochs", epochs.cast("long"))
    goals = goals.withColumn("budget", F.col("target") - F.col("epochs") * F.col("source_size"))
    goals = stage(goals, "mix-targets")
    edge = bucket_of_edge(buckets, goals.withColumn("before", F.lit(0).cast("long")))
    fine = at_edge(rows, edge, coarse).groupBy("source", "mix_bucket").agg(F.sum("mix_size").alias("words"))
    edge = bucket_of_edge(fine, edge)
    place = struct_of(F.col("mix_key"), F.col("doc_id"), F.col("mix_size"), F.col("mix_place"))
    until = F.sum("mix_size").over(Window.partitionBy("source").orderBy(place).rowsBetween(Window.unboundedPreceding, 0))
    inside = at_edge(rows, edge, F.col("mix_bucket")).withColumn("until", F.col("before") + until).withColumn("place", place)
    inside = inside.filter(2 * F.col("until") - F.col("mix_size") <= 2 * F.col("budget"))
    last = inside.groupBy("source").agg(F.max("place").alias("last"))
    return stage(
        goals.alias("g")
        .join(edge.alias("e"), common.same(F.col("g.source"), F.col("e.source")), "left")
        .join(last.alias("l"), common.same(F.col("g.source"), F.col("l.source")), "left")
        .select(F.col("g.source").alias("cut_source"), "source_size", "target", "epochs", "cut_bucket", "last"),
        "mix-cuts",
    )


def bucket_of_edge(buckets: DataFrame, goals: DataFrame) -> DataFrame:
    """source, cut_bucket, before and budget: the bucket in which the budget ends, the last that begins below it.

    ``goals`` has the budget of each source and what lies before its first bucket.
    """
    earlier = F.sum("words").over(Window.partitionBy("source").orderBy("mix_bucket")) - F.col("words")
    own = buckets.withColumn("earlier", earlier).alias("b").join(goals.alias("g"), common.same(F.col("b.source"), F.col("g.source")))
    own = own.select("b.source", "mix_bucket", (F.col("before") + F.col("earlier")).alias("before"), "budget")
    edge = own.filter(F.col("before") < F.col("budget")).groupBy("source").agg(F.max(F.struct("mix_bucket", "before", "budget")).alias("edge"))
    return stage(edge.select("source", F.col("edge.mix_bucket").alias("cut_bucket"), "edge.before", "edge.budget"), "mix-edges")


def at_edge(rows: DataFrame, edge: DataFrame, bucket: Column) -> DataFrame:
    """The documents of the buckets in which budgets end."""
    ends = common.same(F.col("r.source"), F.col("e.source")) & (bucket == F.col("cut_bucket"))
    return rows.alias("r").join(edge.alias("e"), ends).select("r.source", "doc_id", "mix_size", "mix_key", "mix_place", "mix_bucket", "before", "budget")


def struct_of(key: Column, doc_id: Column, size: Column, place: Column) -> Column:
    return F.struct(key.alias("key"), doc_id.cast("long").alias("doc_id"), size.alias("size"), place.alias("place"))


def applied(rows: DataFrame, cut: DataFrame) -> DataFrame:
    """Documents with source_size, target and mix_times, the number of times the mix holds each."""
    place = struct_of(F.col("mix_key"), F.col("doc_id"), F.col("mix_size"), F.col("mix_place"))
    chosen = (F.col("mix_bucket") < F.col("cut_bucket")) | ((F.col("mix_bucket") == F.col("cut_bucket")) & (place <= F.col("last")))
    return rows.join(cut, common.same(F.col("source"), F.col("cut_source")), "left").withColumn(
        "mix_times", F.col("epochs") + F.coalesce(chosen, F.lit(False)).cast("long")
    )


def mix(docs: DataFrame, how: Mix = Mix()) -> DataFrame:
    """doc_id, size, source_size, target and taken of every document."""
    rows = stage(keyed(docs.select("doc_id", "source", "text"), how).drop("text"), "mix-sizes")
    found = applied(rows, cuts(rows, how))
    return found.select(
        "doc_id",
        F.col("mix_size").alias("size"),
        "source_size",
        "target",
        (F.col("mix_size") * F.col("mix_times")).alias("taken"),
        F.col("source"),
        F.col("mix_times").alias("times"),
    )


def copies(docs: DataFrame, how: Mix = Mix()) -> DataFrame:
    """The mix itself: every document as often as it is taken, with the columns it came with."""
    rows = stage(keyed(docs.select("doc_id", "source", "text"), how).drop("text"), "mix-sizes")
    own = docs.select(F.struct("*").alias("mix_row"), "doc_id", "source", "text")
    found = applied(keyed(own, how), cuts(rows, how)).filter("mix_times > 0")
    return found.select("mix_row", F.explode(F.sequence(F.lit(1), F.col("mix_times")))).select("mix_row.*")


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(common.table(spark, sf_dir, "documents"))


ORACLE_SQL = """
WITH docs AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
    len(regexp_extract_all(coalesce(text, ''), '[!#$%&*|<>{}]')) AS marks,
    (CAST(('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), 'row')), 1, 13)) AS BIGINT) + 0.5::DOUBLE) / 4503599627370496::DOUBLE AS u
  FROM documents),
keys AS (SELECT *, -ln(u) / CASE WHEN size > 0 THEN size::DOUBLE / (size + 4 * marks) ELSE 1::DOUBLE END AS k FROM docs),
sizes AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM docs GROUP BY source),
own AS (SELECT *, [3, 1, 2][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::DOUBLE AS w, (2 * source_size)::DOUBLE AS cap FROM sizes),
-- a source's level is what is left over the weights left when all sources of smaller cap over weight have their caps
levels AS (
  SELECT a.source, (1.5::DOUBLE * (SELECT sum(source_size) FROM own)::DOUBLE
    - coalesce((SELECT sum(b.cap) FROM own b WHERE b.cap / b.w < a.cap / a.w), 0))
    / (SELECT sum(b.w) FROM own b WHERE b.cap / b.w >= a.cap / a.w) AS level, a.cap / a.w AS most FROM own a),
goals AS (
  SELECT source, source_size, least(w * (SELECT arg_min(level, most) FROM levels WHERE level <= most), cap) AS target,
    CASE WHEN source_size > 0 THEN floor(least(w * (SELECT arg_min(level, most) FROM levels WHERE level <= most), cap) / source_size) ELSE 0 END AS epochs
  FROM own),
placed AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY k, doc_id, size) AS until FROM keys)
SELECT p.doc_id, p.size, g.source_size, g.target,
  CAST(p.size * (g.epochs + CASE WHEN 2 * until - p.size <= 2 * (g.target - g.epochs * g.source_size) THEN 1 ELSE 0 END) AS BIGINT) AS taken,
  p.source, CAST(g.epochs + CASE WHEN 2 * until - p.size <= 2 * (g.target - g.epochs * g.source_size) THEN 1 ELSE 0 END AS BIGINT) AS times
FROM placed p JOIN goals g ON p.source IS NOT DISTINCT FROM g.source
"""
