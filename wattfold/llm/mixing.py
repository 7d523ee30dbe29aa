"""Mixing sources to target weights, with column functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wattfold.llm.common import WORD, running_sum, spread, stored

# Weights of the sources in order of their names, again and again.
WEIGHTS = (5, 2, 1)
# No document is taken more often than this.
EPOCHS = 3
SEED = "mix"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sources: DataFrame, weights: Sequence[int] = WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """``source, source_size`` with the words each source shall give.

    Sources in order of code points, null last, weigh ``weights``, repeating. All sources' words are
    shared out by weight; a source gives ``epochs`` times its words at most, and what it cannot give
    is shared out again. Sorted by what they can give for their weight, the sources that give all
    they can come first, and the others share what is left; running sums show where the line is.
    One row per source goes through a window here, after all its documents are added up.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(
        F.array(*[F.lit(w) for w in weights]), (F.pmod(F.col("place") - 1, F.lit(len(weights))) + 1).cast("int")
    )
    most = F.col("source_size") * F.lit(epochs)
    rows = (
        sources.withColumn("place", F.row_number().over(by_name))
        .withColumn("weight", weight)
        .withColumn("ratio", most / F.col("weight"))
    )
    order = Window.orderBy("ratio", "place")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy(F.lit(0))
    rows = rows.withColumn(
        "level",
        (F.sum("source_size").over(everything) - F.coalesce(F.sum(most).over(before), F.lit(0)))
        / F.sum("weight").over(after),
    ).withColumn(
        "level", F.min_by(F.when(F.col("level") <= F.col("ratio"), F.col("level")),
                          F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "place"))).over(everything)
    )
    target = F.coalesce(F.least(most.cast("double"), F.col("level") * F.col("weight")), F.lit(0.0))
    return rows.select("source", "source_size", target.alias("target"))


def mix(
    spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: Sequence[int] = WEIGHTS, epochs: int = EPOCHS,
) -> DataFrame:
    """How many words of each document the mix takes.

    Returns ``id, source, size, source_size, target, taken``. A document's key is the MD5 digest of
    its id and a seed; within a source, documents are sorted by key, in ranges of the key that one
    task sorts, and the running sum of words says where the budget, the whole words of the target,
    ends. Every document is taken as often as the budget covers the whole source, then once more up
    to the cut; the document at the cut gives its first words only. A null text has no words, null is
    a source, and documents with equal ids are ordered by size. Other columns are not looked at.
    """
    rows = stored(spark, _sized(docs, id_col, text_col, source_col), "mix-rows")
    shares = _shares(spark, rows, weights, epochs)
    return shares.select(F.col("id").alias(id_col), "source", "size", "source_size", "target", "taken")


def _sized(docs: DataFrame, id_col: str, text_col: str, source_col: str, *more: Column) -> DataFrame:
    size = word_count(F.col(text_col)).alias("size")
    return docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), size, *more)


def _key() -> Column:
    return F.md5(F.concat(F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit(SEED)))


def _wanted(spark: SparkSession, sizes: DataFrame, weights: Sequence[int], epochs: int) -> DataFrame:
    """A row per source: its target, the whole epochs ``whole`` and the words ``rest`` beyond them."""
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    wanted = targets(sources, weights, epochs).withColumnRenamed("source", "of")
    some = F.col("source_size") > 0
    rest = F.when(some, F.floor("target").cast("long") % F.col("source_size")).otherwise(F.lit(0))
    whole = F.when(some, F.expr("cast(floor(target) as bigint) div source_size")).otherwise(F.lit(0))
    return stored(spark, wanted.withColumn("rest", rest).withColumn("whole", whole), "mix-targets")


def _placed(sizes: DataFrame, *ties: str) -> DataFrame:
    """``before``: the words of the source's documents with lesser keys."""
    # The first 31 bits of the digest, so that ranges of them are ranges of the key.
    head = F.shiftright(F.conv(F.substring("key", 1, 8), 16, 10).cast("long"), 1)
    keyed = sizes.withColumn("key", _key()).withColumn("at", head)
    return running_sum(keyed, ["source"], "at", ["key", "id", "size", *ties], F.col("size"), "before")


def _shares(
    spark: SparkSession, sizes: DataFrame, weights: Sequence[int], epochs: int
) -> DataFrame:
    """``sizes``, a stored table, with its sources' targets and ``taken``."""
    wanted = _wanted(spark, sizes, weights, epochs)
    once = F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("before")))
    taken = F.col("whole") * F.col("size") + once
    joined = _placed(sizes).join(wanted, F.col("source").eqNullSafe(F.col("of")))
    return joined.withColumn("taken", taken.cast("long"))


def first_words(text: Column, words: Column) -> Column:
    """The text up to the end of its first ``words`` words, as it stands."""
    pieces = F.regexp_extract_all(text, F.lit(r"([\x20\x09-\x0D]*" + WORD + ")"), F.lit(1))
    return F.array_join(F.slice(pieces, F.lit(1), words.cast("int")), "")


def mixed_documents(
    spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: Sequence[int] = WEIGHTS, epochs: int = EPOCHS,
) -> DataFrame:
    """The mix itself, with the columns of ``docs``: a row for each time a document is taken.

    Each document is taken as often, and to the same word, as in ``mix``. Only ids, sizes and a hash of
    the text are sorted. They give one row per source: its whole epochs, and the key at which its last,
    partial epoch is cut. With these, one pass over the documents tells how often each is taken, and
    texts are not shuffled. The last copy of the document at a source's cut has its first words only; of
    rows that repeat its id and text, as many are whole as the budget covers. Nulls and repeated
    ids are as in ``mix``; other columns stay as they are, whatever their names.
    """
    tie = F.xxhash64(text_col).alias("tie")
    sizes = stored(spark, _sized(docs, id_col, text_col, source_col, tie), "mix-rows")
    wanted = _wanted(spark, sizes, weights, epochs)
    order = ["key", "id", "size", "tie"]
    # The row that the budget ends in; where rows tie, the first of them says what is left for all.
    reached = _placed(sizes, "tie").join(wanted.select("of", "rest"), F.col("source").eqNullSafe(F.col("of")))
    reached = reached.where(F.col("before") < F.col("rest"))
    cuts = reached.groupBy("source").agg(F.max(F.struct(*order)).alias("cut"))
    cuts = stored(spark, cuts.withColumnRenamed("source", "cut_of"), "mix-cuts")
    spent = _placed(sizes, "tie").join(
        cuts, F.col("source").eqNullSafe(F.col("cut_of")) & F.struct(*order).eqNullSafe(F.col("cut"))
    )
    spent = spent.groupBy("source").agg(F.min("before").alias("spent")).withColumnRenamed("source", "spent_of")
    plan = wanted.join(cuts, F.col("of").eqNullSafe(F.col("cut_of")), "left").join(
        spent, F.col("of").eqNullSafe(F.col("spent_of")), "left"
    )
    plan = stored(spark, plan.select("of", "whole", "cut", (F.col("rest") - F.col("spent")).alias("left")), "mix-plan")

    rows = docs.select(
        F.col(id_col).alias("id"), F.col(source_col).alias("source"), F.struct(*docs.columns).alias("row")
    )
    rows = rows.withColumn("key", _key()).join(plan, F.col("source").eqNullSafe(F.col("of")))

    def measured(some: DataFrame) -> DataFrame:
        text = F.col("row")[text_col]
        some = some.withColumn("size", word_count(text)).withColumn("tie", F.xxhash64(text))
        return some.withColumn("place", F.struct(*order))

    base = F.col("whole") * F.col("size")
    at_cut = F.col("place").eqNullSafe(F.col("cut"))
    once = F.when(F.col("cut").isNotNull() & (F.col("place") < F.col("cut")), F.col("size")).otherwise(F.lit(0))
    plain = measured(rows).where(~at_cut).select("row", "size", (base + once).alias("taken"))
    # Rows at a cut, one per source unless rows repeat; a number drawn for each before they are stored orders those.
    tied = measured(rows.where(F.col("key").eqNullSafe(F.col("cut.key")))).where(at_cut).select(
        "row", "source", "size", "whole", "left", F.monotonically_increasing_id().alias("no")
    )
    tied = stored(spark, tied.withColumn("at", spread("no")), "mix-tied")
    tied = running_sum(tied, ["source"], "at", ["no"], F.col("size"), "before")
    some = F.greatest(F.lit(0), F.least(F.col("size"), F.col("left") - F.col("before")))
    shares = plain.union(tied.select("row", "size", (base + some).alias("taken"))).where(F.col("taken") > 0)

    copies = F.expr("sequence(1, cast((taken + size - 1) div size as int))")
    shares = shares.select("row", "size", "taken", F.explode(copies).alias("copy"))
    rest = F.col("taken") - (F.col("copy") - 1) * F.col("size")
    text = F.col("row")[text_col]
    cut = F.when(rest < F.col("size"), first_words(text, rest)).otherwise(text)
    return shares.select(*[cut.alias(name) if name == text_col else F.col("row")[name].alias(name) for name in docs.columns])
