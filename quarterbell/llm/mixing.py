"""Mixing sources to target weights.

Every document gets a random key by hashing its id and text. Within a source
documents are ranged by key: a fixed number of key ranges is summed first, the
prefix sums over the ranges find the one range in which the budget of the
source ends, and only the documents of that range are sorted. No task ever
sorts a source, however large.

Results in the odd cases: a null text has size 0 and takes nothing; a null
source is a source of its own, ordered last; documents that share key, id and
text are ordered arbitrarily, but being equal they are interchangeable in any
result; an empty table gives no rows; columns beyond ``doc_id``, ``text`` and
``source`` are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarterbell.llm.tables import saved, table

#: Weights of the sources in code-point order, repeated.
WEIGHTS = (5, 2, 1)
#: Words of the mix, in hundredths of all words.
SHARE_PERCENT = 150
#: A source is repeated so many times at most.
MOST_EPOCHS = 2
#: Hex digits of the key that name a key range: 16^4 ranges a source.
RANGE_DIGITS = 4


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit("[^ \\t-\\r]+")), F.lit(0)).cast("long")


def random_key(doc_id: Column, text: Column) -> Column:
    return F.md5(F.concat_ws("/", F.coalesce(doc_id.cast("string"), F.lit("-")), F.md5(F.coalesce(text, F.lit("")))))


def keyed(documents: DataFrame) -> DataFrame:
    """The documents with their size and random key."""
    return documents.withColumns({
        "_mix_source": F.col("source").cast("string"),
        "_mix_size": word_count(F.col("text")),
        "_mix_key": random_key(F.col("doc_id"), F.col("text")),
    })


def source_targets(sized: DataFrame, weights=WEIGHTS, share_percent=SHARE_PERCENT, most_epochs=MOST_EPOCHS) -> DataFrame:
    """source, source_size, target: a row for each source.

    Resharing what sources cannot take ends at one level: each target is the
    weight times the level, or the cap if that is less. Sources are filled in
    the order of cap over weight, so the level follows from running sums. The
    summary has a row for each source, whatever the number of documents.
    """
    sizes = sized.groupBy(F.col("_mix_source").alias("source")).agg(F.sum("_mix_size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (place % len(weights) + 1).cast("int"))
    everything = Window.partitionBy()
    filled = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    ranked = (
        sizes.withColumn("weight", weight.cast("long"))
        .withColumn("cap", F.col("source_size") * most_epochs)
        .withColumn("words", F.least(F.sum("source_size").over(everything) * share_percent / 100, F.sum("cap").over(everything).cast("double")))
        .withColumn("caps_before", F.coalesce(F.sum("cap").over(filled.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("weights_left", F.sum("weight").over(filled.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("level", (F.col("words") - F.col("caps_before")) / F.col("weights_left"))
        # each stopped source raises the level of those after it; the first that is not stopped has the highest
        .withColumn("final", F.max("level").over(everything))
    )
    return ranked.select(
        "source", "source_size",
        F.least(F.col("cap").cast("double"), F.col("final") * F.col("weight")).alias("target"),
    )


def with_taken(rows: DataFrame, **options) -> DataFrame:
    """Keyed rows with what the mix takes of them: whole epochs and the words of a last part.

    Full epochs take each document once each, and the rest of the budget goes
    to documents in key order; the last one is taken in part, so that a source
    gives exactly the whole words of its target.
    """
    sized = saved(rows.select("_mix_source", "_mix_size", "_mix_key"), "mix-sizes")
    targets = (
        source_targets(sized, **options)
        .withColumn("budget", F.floor(F.col("target")).cast("long"))
        .withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("budget") / F.col("source_size"))).otherwise(0).cast("long"))
        .withColumn("rest", F.col("budget") - F.col("epochs") * F.col("source_size"))
    )
    key_range = F.substring("_mix_key", 1, RANGE_DIGITS)
    before = Window.partitionBy("_mix_source").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = (
        sized.groupBy("_mix_source", key_range.alias("_range")).agg(F.sum("_mix_size").alias("range_size"))
        .withColumn("range_from", F.coalesce(F.sum("range_size").over(before), F.lit(0)))
    )
    # one row for each source: the range in which its rest ends
    cuts = (
        ranges.join(targets, F.col("_mix_source").eqNullSafe(F.col("source")))
        .where((F.col("range_from") <= F.col("rest")) & (F.col("rest") < F.col("range_from") + F.col("range_size")))
        .select("_mix_source", F.col("_range").alias("_mix_cut"), F.col("range_from").alias("_mix_from"))
    )
    marked = saved(
        targets.join(cuts, F.col("source").eqNullSafe(F.col("_mix_source")), "left")
        .select(F.col("source").alias("_mix_of"), F.col("source_size").alias("_mix_total"), F.col("target").alias("_mix_target"),
                F.col("epochs").alias("_mix_epochs"), F.col("rest").alias("_mix_rest"), "_mix_cut", "_mix_from"),
        "mix-targets",
    )
    joined = rows.join(marked, F.col("_mix_source").eqNullSafe(F.col("_mix_of"))).withColumn("_mix_range", key_range)
    inside = F.coalesce(F.col("_mix_range") == F.col("_mix_cut"), F.lit(False))
    in_order = Window.partitionBy("_mix_source", "_mix_range").orderBy("_mix_key", "_mix_size").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("_mix_from") + F.coalesce(F.sum("_mix_size").over(in_order), F.lit(0))
    cut = joined.where(inside).withColumn("_mix_part", F.greatest(F.lit(0), F.least(F.col("_mix_size"), F.col("_mix_rest") - start)))
    # a source without a cut has no rest: its budget is whole epochs
    whole = joined.where(~inside).withColumn(
        "_mix_part", F.when(F.col("_mix_range") < F.col("_mix_cut"), F.col("_mix_size")).otherwise(0))
    return whole.unionByName(cut)


def mix_sources(documents: DataFrame, **options) -> DataFrame:
    """doc_id, size, source_size, target and taken of every document; ``taken`` counts words with repeats."""
    rows = keyed(documents).select(F.col("doc_id").cast("long").alias("doc_id"), "_mix_source", "_mix_size", "_mix_key")
    return with_taken(saved(rows, "mix-rows"), **options).select(
        "doc_id", F.col("_mix_size").alias("size"), F.col("_mix_total").alias("source_size"), F.col("_mix_target").alias("target"),
        (F.col("_mix_epochs") * F.col("_mix_size") + F.col("_mix_part")).cast("long").alias("taken"),
    )


def mixed_documents(documents: DataFrame, **options) -> DataFrame:
    """The rows of the mix: each document as often as it is taken whole, then once cut to the words taken in part.

    All columns are kept. A part that is the whole document keeps its text as it is.
    """
    full = F.col("_mix_epochs") + F.when(F.col("_mix_part") >= F.col("_mix_size"), 1).otherwise(0)
    part = (F.col("_mix_part") > 0) & (F.col("_mix_part") < F.col("_mix_size"))
    rows = (
        with_taken(keyed(documents), **options)
        .where((F.col("_mix_size") > 0) & (F.col("_mix_epochs") + F.col("_mix_part") > 0))
        .withColumn("_mix_full", full)
        .withColumn("_mix_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_mix_full") + F.when(part, 1).otherwise(0))))
    )
    words = F.filter(F.split("text", "[ \\t-\\r]+"), lambda w: w != "")
    cut = F.col("_mix_copy") > F.col("_mix_full")
    text = F.when(cut, F.array_join(F.slice(words, F.lit(1), F.col("_mix_part").cast("int")), " ")).otherwise(F.col("text"))
    rows = rows.withColumn("text", text)
    if "n_chars" in documents.columns:
        rows = rows.withColumn("n_chars", F.when(cut, F.length("text")).otherwise(F.col("n_chars")).cast(documents.schema["n_chars"].dataType))
    return rows.select(*documents.columns)


def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"))


OP7_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, md5(concat_ws('/', coalesce(CAST(doc_id AS VARCHAR), '-'), md5(coalesce(text, '')))) AS key,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size
  FROM documents),
sizes AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS place
  FROM sized GROUP BY source),
weighed AS (
  SELECT *, [5, 2, 1][place % 3 + 1] AS weight, 2 * source_size AS cap, sum(source_size) OVER () * 150 / 100 AS words FROM sizes),
running AS (
  SELECT *, (words - coalesce(sum(cap) OVER (ORDER BY cap / weight, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY cap / weight, source ASC NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed),
levelled AS (SELECT *, max(level) OVER () AS final FROM running),
targets AS (
  SELECT source, source_size, least(CAST(cap AS DOUBLE), final * weight) AS target FROM levelled),
placed AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN CAST(floor(floor(t.target) / t.source_size) AS BIGINT) ELSE 0 END AS epochs,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.size
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(epochs * size + greatest(0, least(size, floor(target) - epochs * source_size - start)) AS BIGINT) AS taken
FROM placed
"""
