"""Self joins inside groups of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import stored, wide_partitions

# Rows of one group that one task may compare with each other.
BLOCK_ROWS = 2048


def group_sizes(df: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, group_rows``"""
    return df.groupBy(*keys).agg(F.count("*").alias("group_rows"))


def large_groups(sizes: DataFrame, keys: list[str], block_rows: int = BLOCK_ROWS) -> DataFrame | None:
    """``keys, blocks`` of the groups over one block, or None where a check finds none."""
    large = sizes.where(F.col("group_rows") > block_rows).select(
        *keys, F.ceil(F.col("group_rows") / block_rows).cast("int").alias("blocks"))
    return None if large.isEmpty() else stored(large, "large-groups")


def pair_up(df: DataFrame, keys: list[str], member: str, payload: list[str] = (), once: list[str] = (),
            large: DataFrame | None = None) -> DataFrame:
    """Pairs ``member_1 < member_2`` of rows that share ``keys``.

    Groups of one block are joined as they are, both sides from one shuffle. A
    group of b blocks (``large``, see :func:`large_groups`) is spread over a
    b × b grid: the left copy of a row goes to every cell of its row of the grid,
    the right copy to every cell of its column, so two rows meet in exactly one
    cell and no task compares more than block × block rows of it. Nothing is
    capped.

    ``payload`` columns come back as ``c_1`` and ``c_2``; ``once`` columns are
    constant within the group and come back unchanged.
    """
    columns = list(dict.fromkeys([*keys, *once, member, *payload]))
    rows = df.select(*columns)
    width = wide_partitions(df.sparkSession)

    def side(frame: DataFrame, n: int, *extra: str) -> DataFrame:
        kept = [c for c in once if c not in keys] if n == 1 else []
        return frame.select(*keys, *kept, F.col(member).alias(f"{member}_{n}"),
                            *[F.col(c).alias(f"{c}_{n}") for c in payload], *extra)

    def matched(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
        return left.join(right, on).where(F.col(f"{member}_1") < F.col(f"{member}_2"))

    usual = rows if large is None else rows.join(large.select(*keys), keys, "left_anti")
    usual = usual.repartition(width, *keys)
    pairs = matched(side(usual, 1), side(usual, 2), keys)
    if large is None:
        return pairs
    crowded = rows.join(large, keys).withColumn("_block", F.pmod(F.xxhash64(F.col(member)), F.col("blocks")).cast("int"))
    others = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    cell = [*keys, "_row", "_col"]
    left = crowded.withColumn("_row", F.col("_block")).withColumn("_col", others).repartition(width, *cell)
    right = crowded.withColumn("_col", F.col("_block")).withColumn("_row", others).repartition(width, *cell)
    in_cells = matched(side(left, 1, "_row", "_col"), side(right, 2, "_row", "_col"), cell)
    return pairs.unionByName(in_cells.select(*pairs.columns))


def pairs_within(df: DataFrame, keys: list[str], member: str, payload: list[str] = (), block_rows: int = BLOCK_ROWS) -> DataFrame:
    """:func:`pair_up` with the group sizes checked here; ``df`` is read twice."""
    return pair_up(df, keys, member, payload, large=large_groups(group_sizes(df, keys), keys, block_rows))


def co_counts(df: DataFrame, key: str, member: str, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """How many groups hold both members of a pair: ``item_1, item_2, n``."""
    from .cells import block_count, messages, numbered, pair_sums

    kind = df.schema[member].dataType
    rows = stored(df.select(key, F.col(member).cast("string").alias(member)).distinct(), "members")
    members = numbered(rows, member)
    blocks = block_count(rows)
    large = large_groups(group_sizes(rows, [key]), [key], block_rows)
    sent = messages(rows.join(members, member), key, "place", [], blocks, large)
    sums = pair_sums(sent, members, member, blocks, 0, None)
    one, two = F.col("item_1").cast(kind), F.col("item_2").cast(kind)
    return sums.select(F.least(one, two).alias("item_1"), F.greatest(one, two).alias("item_2"), "n")
