"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Sources in code point order, null last, weigh 5, 2, 1 and so on in turn, and share `share` times all words; a target stops at `most`
times its source's size and the excess goes to the others by weight. A source first gives its complete epochs; the fraction that
is left is a weighted sample without replacement: documents get the key -ln(u) / w, with u from a hash of the id and w from the
document's quality weight, and are taken in the order of (key, doc_id) until the running sum of their words is nearest the budget.

The running sum is never taken over a whole source. Each pass sums words per source and slice of the key's range, and only the
slice in which the budget ends is looked at again, until it is small enough to be ordered. The result compares each row's key
with its source's cut, so documents are not shuffled.

Defined cases: a null or empty text has size 0 and is taken 0 words; rows that repeat an id have the same key and are taken or
left together; a null id hashes as 'null' and comes first among equal keys; an empty table gives an empty result; other columns
pass through. There is one row per source in the table of sources, which one task orders.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moodgauge.llm.tables import small, stored

WEIGHTS = (5, 2, 1)
SLICES = 1024
ORDERED_ROWS = 2_000
SIGNS = "#*$%&|<>!"


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def quality_weight(text: Column, size: Column) -> Column:
    """Words over words and signs: 1 for plain prose, less for text full of signs."""
    signs = F.coalesce(F.length(text) - F.length(F.translate(text, SIGNS, "")), F.lit(0))
    return (size + 1.0) / (size + 1.0 + signs)


def sampling_key(doc_id: Column, weight: Column, seed: int) -> Column:
    name = F.concat(F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit(f":{seed}"))
    number = F.conv(F.substring(F.md5(name.cast("binary")), 1, 13), 16, 10).cast("long")
    return -F.log((number + 0.5) / F.lit(float(1 << 52))) / weight


def source_name(source: Column) -> Column:
    """A name that is never null, so that it can be joined on."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))


def sized(docs: DataFrame, seed: int) -> DataFrame:
    """The documents with the working columns of this module."""
    size = size_of(F.col("text"))
    return (
        docs.withColumn("__mix_size", size)
        .withColumn("__mix_key", sampling_key(F.col("doc_id"), quality_weight(F.col("text"), F.col("__mix_size")), seed))
        .withColumn("__mix_source", source_name(F.col("source")))
    )


def targets(sources: DataFrame, share: float, most: float) -> DataFrame:
    """source, name, source_size -> and target: each source's weighted share, none above `most` times its size."""
    ranked = sources.withColumn("n", F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1)
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("n") % len(WEIGHTS) + 1).cast("int"))
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = Window.orderBy("ratio", "n").rowsBetween(Window.unboundedPreceding, -1)
    filled = (
        ranked.withColumn("weight", weight.cast("double"))
        .withColumn("cap", F.col("source_size") * F.lit(float(most)))
        .withColumn("ratio", F.col("cap") / F.col("weight"))
        .withColumn("all_words", F.sum("source_size").over(everything) * F.lit(float(share)))
        .withColumn("all_weight", F.sum("weight").over(everything))
        .withColumn("cap_before", F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        .withColumn("weight_before", F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        # in the order of cap over weight, a source is full if its share of what those before it leave is above its cap
        .withColumn("full", F.col("cap") * (F.col("all_weight") - F.col("weight_before")) < (F.col("all_words") - F.col("cap_before")) * F.col("weight"))
        .withColumn("full_cap", F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(everything), F.lit(0.0)))
        .withColumn("free_weight", F.sum(F.when(~F.col("full"), F.col("weight"))).over(everything))
    )
    level = F.least(F.col("cap"), (F.col("all_words") - F.col("full_cap")) / F.col("free_weight") * F.col("weight"))
    return filled.select("name", "source_size", F.when(F.col("full"), F.col("cap")).otherwise(level).alias("target"))


def cuts(rows: DataFrame, share: float, most: float) -> DataFrame:
    """Per source: name, source_size, target, epochs, and the key and id up to which the fraction goes.

    rows: doc_id, source, name, size, key.
    """
    sources = rows.groupBy("source", "name").agg(F.sum("size").alias("source_size"))
    spread = targets(sources, share, most).withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
    aims = stored(spread.withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size")), "mix-sources")
    state = stored(aims.select("name", "rest", F.lit(0).cast("long").alias("below"), F.lit(float("-inf")).alias("low"), F.lit(float("inf")).alias("high")), "mix-slice")
    while True:
        inside = rows.join(small(state), "name").filter(F.col("key").between(F.col("low"), F.col("high")))
        bounds = inside.groupBy("name").agg(F.min("key").alias("low"), F.max("key").alias("high"), F.count("*").alias("n"))
        state = stored(state.drop("low", "high").join(bounds, "name"), "mix-slice")
        if (state.agg(F.max(F.when(F.col("low") < F.col("high"), F.col("n")))).first()[0] or 0) <= ORDERED_ROWS:
            break
        place = F.when(F.col("high") > F.col("low"), F.floor((F.col("key") - F.col("low")) / (F.col("high") - F.col("low")) * SLICES)).otherwise(0)
        sums = (
            rows.join(small(state).drop("n"), "name").filter(F.col("key").between(F.col("low"), F.col("high")))
            .groupBy("name", "rest", "below", place.alias("slice"))
            .agg(F.sum("size").alias("words"), F.min("key").alias("low"), F.max("key").alias("high"))
        )
        to_here = F.sum("words").over(Window.partitionBy("name").orderBy("slice")) + F.col("below")
        reached = sums.withColumn("to_here", to_here).withColumn("last", F.row_number().over(Window.partitionBy("name").orderBy(F.desc("slice"))) == 1)
        first = F.row_number().over(Window.partitionBy("name").orderBy("slice")) == 1
        state = stored(
            reached.filter((F.col("to_here") >= F.col("rest")) | F.col("last")).withColumn("first", first).filter("first")
            .select("name", "rest", (F.col("to_here") - F.col("words")).alias("below"), "low", "high"),
            "mix-slice",
        )
    inside = rows.join(small(state).drop("n"), "name").filter(F.col("key").between(F.col("low"), F.col("high")))
    peers = inside.groupBy("name", "rest", "below", "low", "key", "doc_id").agg(F.sum("size").alias("size"))
    order = Window.partitionBy("name").orderBy("key", "doc_id")
    middle = F.col("below") + F.sum("size").over(order) - F.col("size") / 2
    # the middle of a document decides: it is taken if that brings the sum nearer
    taken = peers.withColumn("middle", middle).filter(F.col("middle") <= F.col("rest"))
    last = taken.groupBy("name").agg(F.max(F.struct("key", F.col("doc_id").isNotNull().alias("has_id"), "doc_id")).alias("last"))
    return stored(aims.join(state.select("name", "low"), "name", "left").join(last, "name", "left"), "mix-cuts")


def mixed(docs: DataFrame, share: float = 1.5, most: float = 2.0, seed: int = 1) -> DataFrame:
    """All documents and their columns, with mix_size, mix_source_size, mix_target and mix_copies (how often the mix takes it).

    The columns of the documents must not have these names, nor begin with __mix_.
    """
    rows = sized(docs.select("doc_id", "source", "text"), seed)
    narrow = stored(rows.select("doc_id", "source", F.col("__mix_source").alias("name"), F.col("__mix_size").alias("size"), F.col("__mix_key").alias("key")), "mix-rows")
    cut = small(cuts(narrow, share, most)).select(F.col("name").alias("__mix_source"), "source_size", "target", "epochs", "low", "last")
    cut = cut.select("__mix_source", F.struct("source_size", "target", "epochs", "low", "last").alias("__mix_cut"))
    joined = sized(docs, seed).join(cut, "__mix_source")
    key = F.col("__mix_key")
    here = F.struct(key.alias("key"), F.col("doc_id").isNotNull().alias("has_id"), F.col("doc_id"))
    fraction = F.coalesce((key < F.col("__mix_cut.low")) | (here <= F.col("__mix_cut.last")), key < F.col("__mix_cut.low"), F.lit(False))
    return joined.select(
        *[F.col(f"`{c}`") for c in docs.columns],
        F.col("__mix_size").alias("mix_size"),
        F.col("__mix_cut.source_size").alias("mix_source_size"),
        F.col("__mix_cut.target").alias("mix_target"),
        (F.col("__mix_cut.epochs") + fraction.cast("long")).alias("mix_copies"),
    )


def mixture(docs: DataFrame, **options) -> DataFrame:
    """doc_id, size, source_size, target, taken for every document."""
    return mixed(docs.select("doc_id", "source", "text"), **options).select(
        "doc_id", F.col("mix_size").alias("size"), F.col("mix_source_size").alias("source_size"), F.col("mix_target").alias("target"),
        (F.col("mix_size") * F.col("mix_copies")).alias("taken"),
    )


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each document as often as it is taken, with the columns of the documents, whatever their names."""
    out = mixed(docs.select("doc_id", "source", "text", F.struct("*").alias("row")), **options).filter("mix_copies > 0")
    return out.select("row", F.explode(F.sequence(F.lit(1).cast("long"), "mix_copies"))).select("row.*")


SQL = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         length(coalesce(text, '')) - length(translate(coalesce(text, ''), '#*$%&|<>!', '')) AS signs
  FROM documents),
keyed AS (
  SELECT *, -ln((('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null') || ':1'), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496::DOUBLE)
            / ((size + 1::DOUBLE) / (size + 1::DOUBLE + signs)) AS key FROM sized),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source IS NULL, source) - 1 AS n FROM keyed GROUP BY source),
weighted AS (
  SELECT *, (CASE n % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END)::DOUBLE AS weight, source_size * 2::DOUBLE AS cap FROM sources),
caps AS (
  SELECT *, sum(source_size) OVER () * 1.5::DOUBLE AS all_words, sum(weight) OVER () AS all_weight,
         coalesce(sum(cap) OVER before, 0) AS cap_before, coalesce(sum(weight) OVER before, 0) AS weight_before
  FROM weighted WINDOW before AS (ORDER BY cap / weight, n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
flags AS (SELECT *, cap * (all_weight - weight_before) < (all_words - cap_before) * weight AS is_full FROM caps),
levels AS (
  SELECT *, coalesce(sum(CASE WHEN is_full THEN cap END) OVER (), 0) AS full_cap, sum(CASE WHEN NOT is_full THEN weight END) OVER () AS free_weight FROM flags),
targets AS (
  SELECT source, source_size, CASE WHEN is_full THEN cap ELSE least(cap, (all_words - full_cap) / free_weight * weight) END AS target FROM levels),
aims AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs FROM targets),
running AS (
  SELECT k.doc_id, k.size, a.source_size, a.target, a.epochs, a.target - a.epochs * a.source_size AS rest,
         sum(k.size) OVER (PARTITION BY k.source ORDER BY k.key, k.doc_id) - k.size / 2::DOUBLE AS middle
  FROM keyed k JOIN aims a ON k.source IS NOT DISTINCT FROM a.source)
SELECT doc_id, size, source_size, target, (size * (epochs + CASE WHEN middle <= rest THEN 1 ELSE 0 END))::BIGINT AS taken FROM running
"""
