"""Token ids in compressed binary files.

Ids are coded with one canonical length-limited Huffman code built from the counts
of the whole corpus. Each document's ids are cut into blocks; a checkpoint holds
the bit at which a block begins, so any block can be decoded without the others.

A file ("shard") holds documents in ascending order of id:

    8 bytes   magic ``IDSHARD1``
    6 int64   documents, blocks, ids, ids per block, symbols, bytes of coded ids
    symbols   uint8   code length of each symbol (the codes are canonical)
    documents uint8   1 where the document has an id, 0 where it is null
    documents int64   document id
    documents int64   number of ids
    blocks    int64   first bit of each block, counted over the shard
    rest              coded ids; a document begins on a byte

All numbers are little-endian. Shards are named by partition and number and their
names sort in the order of the documents.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shoal.session import scratch_path, wide_partitions

from .huffman import MAX_BITS, Coder, code_lengths
from .tokens import batches_of, encoder

MAGIC = b"IDSHARD1"
#: Ids of a block and (about) of a shard.
BLOCK_IDS = 256
SHARD_IDS = 4_000_000
_COUNTS = ", used array<bigint>, times array<bigint>"


def token_rows(docs: DataFrame, vocabulary: str, end_id: int | None, id_col: str = "doc_id", text_col: str = "text",
               counted: bool = False) -> DataFrame:
    """``doc_id``, ``ids`` of each whole text, null texts empty, then ``end_id``.

    Ids are little-endian unsigned 32-bit integers. With ``counted`` they are packed as of ``_narrow`` and columns ``used, times`` are
    added: null but for one more row of each task, which tells how often each id occurs in the task.
    """
    tail = np.array([] if end_id is None else [end_id], dtype="<u4")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tool, total = encoder(vocabulary), np.zeros(0, dtype=np.int64)
        for batch in batches:
            texts = [t if isinstance(t, str) else "" for t in batch["text"]]
            for part in batches_of(texts):
                ids = [np.concatenate([x, tail]) for x in tool.encode(texts[part])]
                frame = pd.DataFrame({"doc_id": batch["doc_id"].iloc[part].array, "ids": [_narrow(x) if counted else x.tobytes() for x in ids]})
                if counted:
                    total = _added(total, np.bincount(np.concatenate(ids)))
                    frame["used"] = frame["times"] = None
                yield frame
        if counted:
            yield _count_row(total)

    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return picked.mapInPandas(run, "doc_id long, ids binary" + (_COUNTS if counted else ""))


def _added(total: np.ndarray, own: np.ndarray) -> np.ndarray:
    if len(own) > len(total):
        total, own = own, total
    total[:len(own)] += own
    return total


def _count_row(total: np.ndarray) -> pd.DataFrame:
    used = np.flatnonzero(total)
    return pd.DataFrame({"doc_id": pd.array([None], dtype="Int64"), "ids": [None], "used": [used], "times": [total[used]]})


def _narrow(ids: np.ndarray) -> bytes:
    small = not len(ids) or int(ids.max()) < 1 << 16
    return (b"\2" + ids.astype("<u2").tobytes()) if small else (b"\4" + ids.astype("<u4").tobytes())


def _wide(data: bytes) -> np.ndarray:
    return np.frombuffer(data, dtype="<u2" if data[:1] == b"\2" else "<u4", offset=1)


def _counted(rows: DataFrame) -> DataFrame:
    """Rows of ``doc_id, ids`` as ``token_rows`` gives them with ``counted``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(0, dtype=np.int64)
        for batch in batches:
            own = [np.frombuffer(x, dtype="<u4") for x in batch["ids"]]
            for part in batches_of(own):
                total = _added(total, np.bincount(np.concatenate(own[part])))
            batch["ids"], batch["used"], batch["times"] = [_narrow(x) for x in own], None, None
            yield batch
        yield _count_row(total)

    return rows.select("doc_id", "ids").mapInPandas(run, "doc_id long, ids binary" + _COUNTS)


def global_counts(counts: DataFrame) -> np.ndarray:
    """How often each id occurs, from the tasks' rows of ``used, times``; the vocabulary bounds the result."""
    pairs = counts.select(F.explode(F.arrays_zip("used", "times")).alias("p"))
    rows = pairs.groupBy(F.col("p.used").alias("id")).agg(F.sum("p.times").alias("n")).toPandas()
    found = np.zeros(int(rows["id"].max()) + 1 if len(rows) else 1, dtype=np.int64)
    found[rows["id"].to_numpy(dtype=np.int64)] = rows["n"].to_numpy(dtype=np.int64)
    return found


def _dealt(kept: DataFrame, parts: int) -> tuple[DataFrame, int]:
    """Rows with ``part``, which ascends with doc_id, and the number of parts; rows without an id come first.

    Bounds share out the rows; an id that spans several bounds, and the rows without an id, are dealt to
    their parts by a hash of the ids' bytes.
    """
    steps = [i / parts for i in range(1, parts)]
    told = kept.agg(F.percentile_approx("doc_id", steps or [0.5], 100 * parts).alias("bounds"), F.count("doc_id").alias("known"),
                    F.count("*").alias("n")).first()
    bounds = sorted(told.bounds or []) if steps else []
    nameless = -(-(told.n - told.known) * parts // max(told.n, 1))
    array = F.array(*[F.lit(b) for b in bounds]).cast("array<bigint>")
    low = F.size(F.filter(array, lambda b: b < F.col("doc_id")))
    high = F.size(F.filter(array, lambda b: b <= F.col("doc_id")))
    spread = F.xxhash64("ids")
    part = F.when(F.col("doc_id").isNull(), F.pmod(spread, F.lit(max(nameless, 1)))).otherwise(nameless + low + F.pmod(spread, high - low + 1))
    return kept.withColumn("part", part.cast("int")), nameless + len(bounds) + 1


def _coded(tokens: DataFrame, lengths: bytes, block: int) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = Coder(np.frombuffer(lengths, dtype=np.uint8))
        for batch in batches:
            own = [_wide(data) for data in batch["ids"]]
            for part in batches_of(own):
                sizes = np.fromiter(map(len, own[part]), dtype=np.int64)
                bits, begin, first, blocks = coder.encode_all(np.concatenate(own[part]), sizes, block)
                bits, first, last = bits.tobytes(), first.astype("<i8"), np.concatenate([[0], np.cumsum(blocks)])
                yield pd.DataFrame({"part": batch["part"].iloc[part].array, "doc_id": batch["doc_id"].iloc[part].astype("Int64").array, "n": sizes,
                                    "first": [first[a:b].tobytes() for a, b in zip(last[:-1], last[1:], strict=True)],
                                    "bits": [bits[a:b] for a, b in zip(begin[:-1], begin[1:], strict=True)]})

    return tokens.mapInPandas(run, "part int, doc_id long, n long, first binary, bits binary")


def _filesystem(folder: str):
    """The file system of the shared folder, for a writer inside a task."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder.replace("s3a://", "s3://", 1))


def _write_shards(coded: DataFrame, folder: str, lengths: bytes, block: int, shard_ids: int) -> DataFrame:
    """Writes the sorted partitions; returns partition, shard, documents and ids of each file.

    A file gets its name when it is complete, so a task that is run again replaces it by the same bytes.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import uuid

        from pyspark import TaskContext

        system, base = _filesystem(folder)
        system.create_dir(base, recursive=True)
        partition, held, n_ids, made = TaskContext.get().partitionId(), [], 0, []

        def flush() -> None:
            nonlocal held, n_ids
            starts = np.cumsum([0, *(len(bits) for _, _, _, bits in held)])
            first = [np.frombuffer(f, dtype="<i8") + 8 * s for (_, _, f, _), s in zip(held, starts, strict=False)]
            head = np.array([len(held), sum(map(len, first)), n_ids, block, len(lengths), starts[-1]], dtype="<i8")
            name = f"ids-{partition:06d}-{len(made):06d}.bin"
            own = f"{base}/_{name}.{uuid.uuid4().hex}"
            with system.open_output_stream(own) as out:
                out.write(MAGIC + head.tobytes() + lengths)
                out.write(np.array([not pd.isna(d) for d, *_ in held], dtype=np.uint8).tobytes())
                out.write(np.array([0 if pd.isna(d) else d for d, *_ in held], dtype="<i8").tobytes())
                out.write(np.array([n for _, n, _, _ in held], dtype="<i8").tobytes())
                out.write(b"".join(f.astype("<i8").tobytes() for f in first))
                for *_, bits in held:
                    out.write(bits)
            system.move(own, f"{base}/{name}")
            made.append((partition, len(made), name, len(held), n_ids))
            held, n_ids = [], 0

        for batch in batches:
            for row in zip(batch["doc_id"].array, batch["n"], batch["first"], batch["bits"], strict=True):
                held.append(row)
                n_ids += int(row[1])
                if n_ids >= shard_ids:
                    flush()
        if held:
            flush()
        yield pd.DataFrame(made, columns=["part", "shard", "name", "n_docs", "n_ids"])

    return coded.mapInPandas(run, "part long, shard long, name string, n_docs long, n_ids long")


def write_token_files(tokens: DataFrame, folder: str, block: int = BLOCK_IDS, shard_ids: int = SHARD_IDS,
                      max_bits: int = MAX_BITS) -> DataFrame:
    """Write (doc_id, ids) as shards in ascending doc_id order under ``folder``; rows with ``times`` as of ``token_rows`` are taken as they are.

    Returns the manifest: ``part, shard, name, n_docs, n_ids, start`` (ids in all shards before). Rows without a
    doc_id come first; rows that share one stand together. An empty table makes no file.
    """
    spark = tokens.sparkSession
    held = scratch_path(spark, "ids")  # written once, with the counts beside the ids
    (tokens if "times" in tokens.columns else _counted(tokens)).write.option("compression", "zstd").parquet(held)
    kept = spark.read.schema("doc_id long, ids binary" + _COUNTS).parquet(held)
    lengths = code_lengths(global_counts(kept.where("times IS NOT NULL")), max_bits).tobytes()
    kept = kept.where("ids IS NOT NULL").select("doc_id", "ids")
    # Shares of the ids are taken from the ids alone; a range partitioning would code all texts once more to sample them.
    dealt, parts = _dealt(kept, wide_partitions(spark))
    ordered = _coded(dealt, lengths, block).repartitionById(parts, "part").drop("part").sortWithinPartitions("doc_id", "n", "bits")
    listed = scratch_path(spark, "manifest")
    _write_shards(ordered, folder, lengths, block, shard_ids).write.parquet(listed)
    manifest = spark.read.parquet(listed)
    # Sums by partition first (as many rows as the shuffle has partitions), then inside each partition.
    totals = manifest.groupBy("part").agg(F.sum("n_ids").alias("n")).orderBy("part").collect()
    before, rows = 0, []
    for r in totals:
        rows.append((r["part"], before))
        before += r["n"]
    offsets = spark.createDataFrame(rows, "part long, part_start long")
    inside = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return (manifest.join(offsets, "part")
            .withColumn("start", F.col("part_start") + F.coalesce(F.sum("n_ids").over(inside), F.lit(0)))
            .drop("part_start"))


def parse_shard(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Whether each document has an id, its id, its number of ids, and all ids of the shard."""
    if data[:8] != MAGIC:
        raise ValueError("not a shard of token ids")
    docs, blocks, _, block, symbols, size = (int(x) for x in np.frombuffer(data, dtype="<i8", count=6, offset=8))
    at = 56
    lengths = np.frombuffer(data, dtype=np.uint8, count=symbols, offset=at)
    at += symbols
    known = np.frombuffer(data, dtype=np.uint8, count=docs, offset=at).astype(bool)
    at += docs
    doc_ids = np.frombuffer(data, dtype="<i8", count=docs, offset=at)
    at += 8 * docs
    counts = np.frombuffer(data, dtype="<i8", count=docs, offset=at)
    at += 8 * docs
    first = np.frombuffer(data, dtype="<i8", count=blocks, offset=at)
    at += 8 * blocks
    coded = np.frombuffer(data, dtype=np.uint8, count=size, offset=at)
    per_doc = -(-counts // block)
    sizes = np.full(blocks, block, dtype=np.int64)
    last = np.cumsum(per_doc) - 1
    sizes[last[counts > 0]] = (counts - (per_doc - 1) * block)[counts > 0]
    return known, doc_ids, counts, Coder(lengths).decode(coded, first, sizes)


def read_token_files(spark: SparkSession, folder: str, manifest: DataFrame, with_ids: bool = False) -> DataFrame:
    """Documents of the shards: ``doc_id, start, n_tokens, ids_crc32`` and, on request, ``ids``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, data in zip(batch["path"], batch["content"], strict=True):
                part, shard = path.rsplit("/", 1)[1].removesuffix(".bin").split("-")[1:]
                known, doc_ids, counts, ids = parse_shard(data)
                ends = np.cumsum(counts)
                raw, begins = ids.astype("<u4"), ends - counts
                pieces = [raw[a:b].tobytes() for a, b in zip(begins, ends, strict=True)]
                frame = {"part": int(part), "shard": int(shard), "doc_id": pd.array(doc_ids, dtype="Int64"),
                         "begin": begins, "n_tokens": counts, "ids_crc32": [zlib.crc32(p) for p in pieces]}
                frame["doc_id"][~known] = pd.NA
                yield pd.DataFrame(frame | ({"ids": pieces} if with_ids else {}))

    found = spark.read.format("binaryFile").option("pathGlobFilter", "ids-*.bin").schema(
        "path string, modificationTime timestamp, length long, content binary").load(folder)
    extra = ", ids binary" if with_ids else ""
    rows = found.select("path", "content").mapInPandas(
        run, "part long, shard long, doc_id long, begin long, n_tokens long, ids_crc32 long" + extra)
    return (rows.join(manifest.select("part", "shard", F.col("start").alias("shard_start")), ["part", "shard"])
            .select("doc_id", (F.col("shard_start") + F.col("begin")).alias("start"), "n_tokens", "ids_crc32",
                    *(["ids"] if with_ids else [])))


def token_files(docs: DataFrame, vocabulary: str, end_id: int = 2) -> DataFrame:
    """Tokenize whole texts, write them as shards in the shared folder and read the shards back.

    Null texts are empty and hold the end id alone; an empty table gives no rows.
    """
    spark, folder = docs.sparkSession, scratch_path(docs.sparkSession, "token-files")
    manifest = write_token_files(token_rows(docs, vocabulary, end_id, counted=True), folder)
    if manifest.isEmpty():
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    return read_token_files(spark, folder, manifest)
