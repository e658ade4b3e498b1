"""Mixing sources to target weights by weighted draws without replacement.

A document's key is an exponential draw divided by its quality weight; the
smallest keys come first (Efraimidis and Spirakis). A source gives whole epochs as
long as its target holds them, and then its documents in the order of their keys
until the words left are spent; the last one gives only the words still needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoal.session import stored, wide_partitions

from .words import WORD_PATTERN

#: Weights of the sources by code point, repeating; the share of all words; how often a document may be used.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_EPOCHS = 2


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def letter_quality(text: Column) -> Column:
    """From 0.1 to 1: the share of letters and blanks in the text; 1 for an empty text."""
    kept = F.length(F.regexp_replace(text, r"[^\p{L}\x20\x09-\x0D]+", ""))
    return F.when(F.length(text) > 0, F.lit(0.1) + F.lit(0.9) * kept / F.length(text)).otherwise(F.lit(1.0))


def draw(seed: int, doc_id: Column) -> Column:
    """Uniform in (0, 1), the same in every run, from the first 52 bits of an MD5."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null")))
    bits = F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("double")
    return (bits + F.lit(1.0)) / F.lit(float(2**52 + 1))


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE,
            most: float = MOST_EPOCHS) -> DataFrame:
    """``source, source_size, target``: ``share`` of all words by weight, none above ``most`` times its size.

    What a capped source can't give goes to the others by weight. In ascending order of cap per weight the capped
    sources come first, so running sums settle it. The rows are one per source; they pass one task.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    everything, by_name = Window.partitionBy(F.lit(0)), Window.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())
    by_ratio = Window.partitionBy(F.lit(0)).orderBy((F.col("cap") / F.col("w")), F.col("source").asc_nulls_last())
    listed = F.array(*[F.lit(float(w)) for w in weights])
    per = (per.withColumn("w", F.element_at(listed, ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")))
           .withColumn("cap", F.col("source_size") * F.lit(float(most)))
           .withColumn("all", F.sum("source_size").over(everything) * F.lit(float(share)))
           .withColumn("caps", F.coalesce(F.sum("cap").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
           .withColumn("rest", F.sum("w").over(by_ratio.rowsBetween(0, Window.unboundedFollowing)))
           .withColumn("level", (F.col("all") - F.col("caps")) / F.col("rest"))
           .withColumn("free", F.when(F.col("level") * F.col("w") <= F.col("cap"), F.struct("caps", "rest", "level")))
           # Caps grow along the order, so the first source below its cap settles the level of all behind it.
           .withColumn("first", F.min("free").over(everything)))
    return per.select("source", "source_size", F.when(F.col("caps") >= F.col("first.caps"), F.least(
        "cap", F.col("first.level") * F.col("w"))).otherwise(F.col("cap")).alias("target"))


def shares(docs: DataFrame, seed: int = 42, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE,
           most: float = MOST_EPOCHS, quality: Column | None = None) -> DataFrame:
    """``doc_id, source, nth, digest, size, source_size, target, taken`` of every row of (doc_id, source, text).

    ``digest`` is the MD5 of the text and ``nth`` tells rows apart that agree in id and text. Null texts have no
    words and are taken with none; a null source is a source of its own; null ids draw one key. Equal keys go by
    doc_id, digest and nth. Sums run in slices of the keys, so no source passes one task. An empty table gives no
    rows.
    """
    text = F.col("text")
    base = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source"), F.md5(F.coalesce(text, F.lit("")).cast("binary")).alias("digest"),
        n_words(text).alias("size"),
        (-F.log(draw(seed, F.col("doc_id"))) / (letter_quality(text) if quality is None else quality)).alias("key"))
    twins = Window.partitionBy("doc_id", "digest").orderBy("source", "key")
    base = stored(base.withColumn("nth", F.row_number().over(twins)), "sizes")
    n = min(1024, max(64, wide_partitions(docs.sparkSession)))
    # Bounds of the slices of keys: they share out the rows and do not change the result.
    cut = base.agg(F.percentile_approx("key", [i / n for i in range(1, n)], 10_000)).first()[0] or []
    bounds = F.array(*[F.lit(float(x)) for x in cut]).cast("array<double>")
    base = base.withColumn("slice", F.size(F.filter(bounds, lambda b: b <= F.col("key"))))
    per_slice = base.groupBy("source", "slice").agg(F.sum("size").alias("n"))
    earlier = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    per_slice = per_slice.select("source", "slice", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    inside = (Window.partitionBy("source", "slice").orderBy("key", "doc_id", "digest", "nth")
              .rowsBetween(Window.unboundedPreceding, -1))
    goal = targets(base, weights, share, most)
    plan = (per_slice.alias("p").join(goal.alias("g"), F.col("p.source").eqNullSafe(F.col("g.source")))
            .select("p.source", "slice", "before", "source_size", "target"))
    ranked = base.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    joined = ranked.alias("r").join(plan.alias("p"), F.col("r.source").eqNullSafe(F.col("p.source"))
                                    & (F.col("r.slice") == F.col("p.slice")))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    words = F.round(F.col("target") - F.col("epochs") * F.col("source_size")).cast("long")
    extra = F.greatest(F.lit(0), F.least(F.col("size"), F.col("words") - F.col("before") - F.col("inside")))
    return (joined.withColumn("epochs", epochs.cast("long")).withColumn("words", words)
            .select("doc_id", F.col("r.source").alias("source"), "nth", "digest", "size", "source_size", "target",
                    (F.col("epochs") * F.col("size") + extra).alias("taken")))


def mix(docs: DataFrame, seed: int = 42, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE,
        most: float = MOST_EPOCHS, quality: Column | None = None) -> DataFrame:
    """The rows of the mix, with the columns of ``docs``: a document once for each time it is used.

    A document of which only some words are taken is cut behind them. Texts without words are kept once.
    """
    plan = (shares(docs, seed, weights, share, most, quality)
            .select(F.col("doc_id").alias("_id"), F.col("digest").alias("_digest"), F.col("nth").alias("_nth"),
                    F.col("size").alias("_size"), F.col("taken").alias("_taken")))
    row = F.struct(*[F.col(c) for c in docs.columns]).alias("row")  # whatever its columns are called
    twins = Window.partitionBy("id", "digest").orderBy("source")
    rows = (docs.select(row, F.col("doc_id").cast("long").alias("id"), F.col("source").alias("source"),
                        F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("digest"))
            .withColumn("nth", F.row_number().over(twins)))
    both = rows.join(plan, F.col("id").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_digest"))
                     & (F.col("nth") == F.col("_nth")))
    words = F.col("_size") > 0
    whole = F.when(words, F.floor(F.col("_taken") / F.col("_size"))).otherwise(F.lit(1)).cast("int")
    rest = F.when(words, F.col("_taken") % F.col("_size")).otherwise(F.lit(0))
    uses = F.concat(F.array_repeat(F.lit(-1).cast("long"), whole),
                    F.when(rest > 0, F.array(rest)).otherwise(F.array().cast("array<bigint>")))
    used = both.withColumn("use", F.explode(uses))
    cut = F.concat_ws(" ", F.slice(F.regexp_extract_all(F.col("row.text"), F.lit(WORD_PATTERN), F.lit(0)), F.lit(1), F.col("use").cast("int")))
    columns = {c: F.col("row").getField(c) for c in docs.columns}
    columns["text"] = F.when(F.col("use") < 0, columns["text"]).otherwise(cut)
    if "n_chars" in columns:
        columns["n_chars"] = (F.when(F.col("use") < 0, columns["n_chars"]).otherwise(F.length(cut))
                              .cast(docs.schema["n_chars"].dataType))
    return used.select(*[columns[c].alias(c) for c in docs.columns])
