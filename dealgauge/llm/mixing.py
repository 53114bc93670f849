"""Mixing sources to target weights by capped water-filling, and seeded sampling to the targets.

Sources, ordered by code point with null last, weigh 1, 2, 3, repeating, unless weights are given. A
target is `least(cap, level * weight)` with the cap at `max_epochs` times the source's size and one level
for all sources: what the capped ones cannot take is shared again by weight. Sources in the order of cap
over weight are capped from the front, so the level comes from running sums over one row per source.

Each document is taken `floor(target / size)` times whole, and for the fraction left once more in the
order of a seeded digest until the target is met; the document at the edge is taken in part, so that a
source's words are within one word of its target. Running sums run over digest buckets first, so only the
edge bucket of a source is ordered row by row.

Null text has size 0 (the mix has it once, as an empty text); empty sources have target 0; repeated rows are separate rows that share their fate
in order of the digest; an empty table gives an empty result; extra columns are kept in `mix_documents`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from dealgauge.llm.scratch import Scratch

WHITE_SPACE = r"[\x20\x09-\x0D]+"
MAX_EPOCHS = 3
#: Hexadecimal digits of the digest that make a bucket: 65,536 buckets a source.
BUCKET_DIGITS = 4


def words(text: Column) -> Column:
    """Words of a text as an array; null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WHITE_SPACE), "")


def word_count(text: Column) -> Column:
    """Number of words without building them: a separator run between two words counts once."""
    text = F.coalesce(text, F.lit(""))
    parts = F.size(F.split(text, WHITE_SPACE))
    edges = F.when(text.rlike(r"^[\x20\x09-\x0D]"), 1).otherwise(0) + F.when(text.rlike(r"[\x20\x09-\x0D]\z"), 1).otherwise(0)
    blank = ~text.rlike(r"[^\x20\x09-\x0D]")
    return F.when(blank, F.lit(0)).otherwise(parts - edges).cast("long")


def digest(seed: int, *columns: str) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]).cast("binary"))


def source_targets(sizes: DataFrame, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """One row per source: source_size, weight, target. `sizes` has one row per source: source, source_size."""
    order = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    weighed = sizes.withColumn("weight", ((F.row_number().over(order) - 1) % 3 + 1).cast("long"))
    weighed = weighed.withColumn("cap", F.col("source_size") * max_epochs)
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), F.col("source").cast("binary"))
    before, whole = by_ratio.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    level = (
        (F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0))).cast("double")
        / (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0))).cast("double")
    )
    fits = weighed.withColumn("level", level).withColumn("capped", F.col("cap") <= F.col("level") * F.col("weight"))
    # the first source that stays below its cap sets the level for all that follow
    final = F.first(F.when(~F.col("capped"), F.col("level")), ignorenulls=True).over(
        by_ratio.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return fits.withColumn("final", final).select(
        "source", "source_size", "weight",
        F.when(F.col("final").isNull(), F.col("cap").cast("double"))
        .otherwise(F.least(F.col("cap").cast("double"), F.col("final") * F.col("weight"))).alias("target"))


def mix_sizes(rows: DataFrame, scratch: Scratch, seed: int = 1, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """`rows` (doc_id, source, size and more) with source_size, target and taken added."""
    rows = scratch.write(rows.withColumn("mix_digest", digest(seed, "doc_id", "size")), "mix_rows")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    plan = scratch.write(
        source_targets(sizes, max_epochs)
        .withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
        .withColumn("rest", F.round(F.col("target") - F.col("epochs") * F.col("source_size")).cast("long")), "mix_plan")
    bucket = F.substring("mix_digest", 1, BUCKET_DIGITS)
    rows = rows.withColumn("mix_bucket", bucket)
    by_bucket = Window.partitionBy("source").orderBy("mix_bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = (
        rows.groupBy("source", "mix_bucket").agg(F.sum("size").alias("in_bucket"))
        .withColumn("before", F.coalesce(F.sum("in_bucket").over(by_bucket), F.lit(0)))
        .join(plan.withColumnRenamed("source", "plan_source"), F.col("source").eqNullSafe(F.col("plan_source")))
        .withColumn("need", F.col("rest") - F.col("before"))
        .select(F.col("source").alias("b_source"), F.col("mix_bucket").alias("b_bucket"), "source_size", "target", "epochs",
                "need", "in_bucket"))
    buckets = scratch.write(buckets, "mix_buckets")
    joined = rows.join(buckets, F.col("source").eqNullSafe(F.col("b_source")) & (F.col("mix_bucket") == F.col("b_bucket")))
    edge = (F.col("need") > 0) & (F.col("need") < F.col("in_bucket"))
    in_order = (
        Window.partitionBy("source", "mix_bucket").orderBy("mix_digest", "doc_id", "size")
        .rowsBetween(Window.unboundedPreceding, -1))
    left = F.col("need") - F.coalesce(F.sum("size").over(in_order), F.lit(0))
    at_edge = joined.filter(edge).withColumn("part", F.greatest(F.lit(0), F.least(F.col("size"), left)))
    whole = joined.filter(~edge).withColumn("part", F.when(F.col("need") > 0, F.col("size")).otherwise(0))
    return (
        whole.unionByName(at_edge)
        .withColumn("part", F.col("part").cast("long"))
        .withColumn("taken", (F.col("epochs") * F.col("size") + F.col("part")).cast("long"))
        .drop("mix_digest", "mix_bucket", "b_source", "b_bucket", "need", "in_bucket"))


def mix_documents(documents: DataFrame, seed: int = 1, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """The mixed corpus with the columns of `documents`: a row for each repetition; of the document at the
    edge of a source, the words that the target still allows. Documents without words stay as they are."""
    scratch = Scratch(documents.sparkSession, "mix")
    names = documents.columns
    # the row travels as one column, so its other columns can have any names
    sized = documents.select(F.struct("*").alias("row"), "doc_id", "source", "text", word_count(F.col("text")).alias("size"))
    plan = mix_sizes(sized, scratch, seed, max_epochs)
    whole = F.when(F.col("part") == F.col("size"), F.col("epochs") + 1).otherwise(F.col("epochs"))
    whole = F.when(F.col("size") == 0, F.lit(1)).otherwise(whole)
    cut = (F.col("part") > 0) & (F.col("part") < F.col("size"))
    copies = F.concat(
        F.array_repeat(F.coalesce(F.col("text"), F.lit("")), whole.cast("int")),
        F.when(cut, F.array(F.array_join(F.slice(words(F.col("text")), 1, F.greatest(F.lit(1), F.col("part")).cast("int")), " ")))
        .otherwise(F.array().cast("array<string>")))
    return plan.select("row", F.explode(copies).alias("new")).select(
        *[F.col("new").alias("text") if c == "text" else F.col(f"row.`{c}`") for c in names])
