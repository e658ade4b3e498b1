"""Fingerprints of documents from closed syncmers, in Spark's own functions only.

A text is cut into words; a long word gives way to all its substrings of a few code
points, one from each code point. Of the runs of three words those are kept whose least
word, by hash, stands first or last: closed syncmers over words, and over code points
inside long words. The choice looks at nothing outside the run, so two texts keep the
same runs wherever they agree, with or without blanks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoal.session import wide_partitions

#: Words of a run, code points of the longest word taken whole, code points of a longer one's substrings.
RUN = 3
WHOLE = 16
GRAM = 8
_INK = r"[^\x20\x09-\x0D]"


def _columns(df: DataFrame, text_col: str, prefix: str) -> DataFrame:
    """Adds the hashes of the words and the first words (from 0) of the kept runs."""
    words, kept = f"{prefix}words", f"{prefix}kept"
    # A place in the middle of a surrogate pair is no code point.
    grams = lambda w: F.regexp_extract_all(w, F.lit(rf"(?![\x{{DC00}}-\x{{DFFF}}])(?=({_INK}{{{GRAM}}}))"), F.lit(1))
    found = F.regexp_extract_all(F.coalesce(F.col(text_col), F.lit("")), F.lit(f"{_INK}+"), F.lit(0))
    df = df.withColumn(words, F.flatten(F.transform(found, lambda w: F.when(
        F.char_length(w) > WHOLE, F.transform(grams(w), lambda g: F.xxhash64(g))).otherwise(F.array(F.xxhash64(w))))))
    n = F.size(words)
    at = lambda i, k: F.get(F.col(words), i + k)
    chosen = F.filter(F.sequence(F.lit(0), n - RUN), lambda i: F.least(at(i, 0), at(i, RUN - 1)) <= F.least(
        at(i, 1), *[at(i, k) for k in range(1, RUN - 1)]))
    return df.withColumn(kept, F.when(n >= RUN, chosen).otherwise(F.array().cast("array<int>")))


def _hashes(prefix: str) -> Column:
    """Hash of each kept run; where none is kept, one hash of all words; none for a text without words."""
    words = F.col(f"{prefix}words")
    own = F.transform(F.col(f"{prefix}kept"), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(RUN)]))
    whole = F.aggregate(words, F.lit(0).cast("long"), lambda a, w: F.xxhash64(a, w))
    return F.when(F.size(f"{prefix}kept") > 0, own).when(F.size(words) > 0, F.array(whole)).otherwise(F.array().cast("array<bigint>"))


def with_fingerprint(df: DataFrame, text_col: str, name: str) -> DataFrame:
    """Adds ``name``: the distinct hashes of all kept runs (array of long), and ``{name}_digest``.

    The digest is a SHA-256 of the hashes and places of all kept runs; empty for a text without words.
    """
    prefix = f"_{name}_"
    df = _columns(df, text_col, prefix).withColumn(f"{prefix}all", _hashes(prefix))
    listed = F.concat_ws(";", *[F.concat_ws(",", F.col(f"{prefix}{c}").cast("array<string>")) for c in ("kept", "all")])
    df = df.withColumn(f"{name}_digest", F.when(F.size(f"{prefix}all") > 0, F.sha2(listed.cast("binary"), 256)).otherwise(F.lit("")))
    df = df.withColumn(name, F.array_distinct(f"{prefix}all"))
    return df.drop(*[f"{prefix}{c}" for c in ("words", "kept", "all")])


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two sets of hashes, exactly; 1 for two texts without words."""
    both = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - both
    return F.when(union == 0, F.lit(1.0)).otherwise(both.cast("double") / union)


def anchors(docs: DataFrame) -> DataFrame:
    """``doc_id, position, hash``: each kept run by its first word, for matching texts by place."""
    found = _columns(docs.select("doc_id", "text"), "text", "_a_")
    return (found.select("doc_id", "_a_words", F.explode("_a_kept").alias("position"))
            .select("doc_id", "position", F.xxhash64(*[F.get(F.col("_a_words"), F.col("position") + k) for k in range(RUN)]).alias("hash")))


def _in_order(docs: DataFrame) -> DataFrame:
    """Rows of (doc_id, text, _tie, …) with ``_part``: ranges of ascending ids, one range per task.

    Rows without an id come first, in ranges of their text's hash, as many as their share of the rows. The bounds are
    quantiles; they share out the rows and do not change what comes after what.
    """
    n = min(2048, wide_partitions(docs.sparkSession))
    steps = [i / n for i in range(1, n)] or [0.5]
    nameless = F.col("doc_id").isNull()
    told = docs.agg(F.percentile_approx("doc_id", steps, 10_000).alias("ids"),
                    F.percentile_approx(F.when(nameless, F.col("_tie")), steps, 10_000).alias("ties"),
                    F.count_if(nameless).alias("nameless"), F.count("*").alias("n")).first()
    many = -(-told["nameless"] * n // max(told["n"], 1))
    ties = sorted({told["ties"][min(i * n // many, n - 1) - 1] for i in range(1, many)}) if many > 1 and n > 1 else []
    ids = sorted(set(told["ids"] or [])) if n > 1 else []
    place = lambda bounds, c: F.size(F.filter(F.array(*[F.lit(int(x)) for x in bounds]).cast("array<bigint>"), lambda b: b <= F.col(c)))
    first = len(ties) + 1 if many else 0
    return docs.withColumn("_part", F.when(nameless, place(ties, "_tie")).otherwise(first + place(ids, "doc_id")))


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text, of its edited text, and likeness to the edited and the next text, from all kept runs.

    Per row of (doc_id, text): ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next``. The edited text has the last half of the code points (rounded down) replaced by the first as many
    (or all) of the next text in ascending doc_id; after the last comes the first. Null texts are empty. Rows that
    share an id follow each other by the hash of their text; rows without an id come first. A single row is its own
    next one. An empty table gives no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    rows = _in_order(rows.withColumn("_tie", F.xxhash64("text")))
    # The first row of each range also stands, as a guest, at the end of the range before it: one row per range.
    order = F.struct(F.col("doc_id"), F.col("_tie"))
    first = rows.groupBy("_part").agg(F.min(order).alias("o")).orderBy("_part").collect()
    if not first:
        return docs.sparkSession.createDataFrame([], "doc_id long, n_chars long, edited_sha256 string, fingerprint string,"
                                                     " edited_fingerprint string, near_edited double, near_next double")
    before = [(first[i - 1]["_part"], r["o"]["doc_id"], r["o"]["_tie"]) for i, r in enumerate(first)]
    guests = F.broadcast(docs.sparkSession.createDataFrame(before, "_to int, _id long, _hash long"))  # one row per range
    guest = (rows.join(guests, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_tie") == F.col("_hash")))
             .withColumn("_part", F.col("_to")).drop("_to", "_id", "_hash"))
    # Dealt out before the hashes are made, so that only texts are sent.
    both = rows.withColumn("_guest", F.lit(0)).unionByName(guest.withColumn("_guest", F.lit(1))).repartition("_part")
    both = with_fingerprint(both, "text", "own")
    following = Window.partitionBy("_part").orderBy("_guest", F.col("doc_id").asc_nulls_first(), "_tie")
    half = F.floor(F.col("n_chars") / 2)
    found = (both.withColumn("_next", F.lead("text").over(following)).withColumn("_near", F.lead("own").over(following))
             .filter("_guest = 0").withColumn("n_chars", F.char_length("text").cast("long"))
             .withColumn("_edited", F.concat(F.left("text", (F.col("n_chars") - half).cast("int")), F.left("_next", half.cast("int")))))
    found = with_fingerprint(found, "_edited", "other")
    return found.select("doc_id", "n_chars", F.sha2(F.col("_edited").cast("binary"), 256).alias("edited_sha256"),
                        F.col("own_digest").alias("fingerprint"), F.col("other_digest").alias("edited_fingerprint"),
                        likeness(F.col("own"), F.col("other")).alias("near_edited"),
                        likeness(F.col("own"), F.col("_near")).alias("near_next"))
