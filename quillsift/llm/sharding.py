"""Shards by a hierarchical weighted hash tree.

Rows descend region, rack and shard. Every shard draws a number from the row's key and its own name,
``ln(u) / weight``; the draw of a rack or region is the best of its shards, and at each level the best
draw wins. So children get rows in proportion to the weights below them, and a changed weight changes
one draw: rows move only into or out of the subtrees that hold the shard, and a shard that is added
takes rows only into itself, wherever in the tree it stands.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quillsift.llm.staging import full_text

RACKS_PER_REGION = 2
SHARDS_PER_RACK = 4
ROWS_PER_BLOCK = 5_000
MIN_BLOCKS = 8

_DRAWS = "_draws"


@dataclass(frozen=True)
class HashTree:
    """``regions`` are (id, weight); ``racks[r]`` the racks of region r; ``shards[k]`` of rack k."""

    regions: Sequence[tuple[int, float]]
    racks: Sequence[Sequence[tuple[int, float]]]
    shards: Sequence[Sequence[tuple[int, float]]]

    @classmethod
    def of(
        cls,
        weights: Sequence[float],
        racks_per_region: int = RACKS_PER_REGION,
        shards_per_rack: int = SHARDS_PER_RACK,
    ) -> HashTree:
        """A tree over ``len(weights)`` shards, filled from the left; all weights above zero."""
        if not weights or min(weights) <= 0:
            raise ValueError("a tree needs shards with weights above zero")
        shards = _runs([(i, float(w)) for i, w in enumerate(weights)], shards_per_rack)
        racks = _runs([(k, sum(w for _, w in s)) for k, s in enumerate(shards)], racks_per_region)
        regions = [(r, sum(w for _, w in k)) for r, k in enumerate(racks)]
        return cls(regions, racks, shards)


def _runs(items: list, size: int) -> list[list]:
    return [items[i : i + size] for i in range(0, len(items), size)]


def _unit(key: Column, level: str, child: Column) -> Column:
    """A number between 0 and 1 of 48 hash bits."""
    digest = F.md5(F.concat(F.lit(level), child.cast("string"), F.lit(":"), key))
    return (F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") + 0.5) / float(1 << 48)


def shard_draws(key: Column, weights: Sequence[float]) -> Column:
    """The draw of each shard for a row, as an array. A null key is a key as well."""
    text = F.coalesce(key.cast("string"), F.lit("null"))
    leaves = F.array(
        *[F.struct(F.lit(i).alias("id"), F.lit(float(w)).alias("weight")) for i, w in enumerate(weights)]
    )
    return F.transform(leaves, lambda c: F.log(_unit(text, "shard", c["id"])) / c["weight"])


def _best(draws: Column, shards: Sequence[int]) -> Column:
    return F.array_max(F.array(*[F.get(draws, F.lit(i)) for i in shards]))


def _winner(draws: Column, children: Sequence[tuple[int, Sequence[int]]]) -> Column:
    """The child, given with its shards, whose best draw is the best."""
    pairs = [F.struct(_best(draws, s).alias("draw"), F.lit(i).alias("id")) for i, s in children]
    return F.array_max(F.array(*pairs))["id"]


def descend(df: DataFrame, draws: str, tree: HashTree, prefix: str = "") -> DataFrame:
    """Add ``{prefix}region``, ``{prefix}rack`` and ``{prefix}shard`` by the draws of the shards."""
    region, rack, shard = (f"{prefix}{name}" for name in ("region", "rack", "shard"))
    below = [[i for i, _ in s] for s in tree.shards]
    racks = [[(k, below[k]) for k, _ in r] for r in tree.racks]
    regions = [(r, [i for _, s in racks[r] for i in s]) for r, _ in tree.regions]
    found = F.col(draws)
    df = df.withColumn(region, _winner(found, regions))
    of_region = F.array(*[_winner(found, r) for r in racks])
    df = df.withColumn(rack, F.get(of_region, F.col(region)))
    of_rack = F.array(*[_winner(found, [(i, [i]) for i in s]) for s in below])
    return df.withColumn(shard, F.get(of_rack, F.col(rack)))


def assign(df: DataFrame, key: Column, tree: HashTree, prefix: str = "") -> DataFrame:
    """``df`` with the region, rack and shard of each row's key."""
    weights = [w for s in tree.shards for _, w in s]
    drawn = df.withColumn(_DRAWS, shard_draws(key, weights))
    return descend(drawn, _DRAWS, tree, prefix).drop(_DRAWS)


def shard_documents(docs: DataFrame, n_shards: int = 40) -> DataFrame:
    """Every row of ``docs`` (doc_id, text) with its shard, by the law ``key``.

    Equal ids share a shard, repeated rows get slots of their own; a null text has no bytes; an
    empty table gives no rows; other columns of ``docs`` are not read. Slots are ranks within
    blocks of hashed ids plus the sizes of the blocks before, so that no task sorts a whole shard.
    """
    tree, grown = HashTree.of([1.0] * n_shards), HashTree.of([1.0] * (n_shards + 1))
    blocks = max(MIN_BLOCKS, docs.count() // (n_shards * ROWS_PER_BLOCK))
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    block = F.conv(F.substring(F.md5(key), 13, 8), 16, 10).cast("long") % blocks

    ids = assign(docs.select("doc_id", block.alias("block")), F.col("doc_id"), tree)
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        ids.groupBy("shard", "block")
        .agg(F.count(F.lit(1)).alias("rows"))
        .select("shard", "block", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("before"))
    )
    body = F.encode(full_text(), "UTF-8")
    rows = docs.select(
        "doc_id",
        block.alias("block"),
        (F.octet_length(body).cast("long") + 16).alias("size"),
        F.crc32(body).alias("text_crc32"),
    )
    # The shards of both trees draw alike, but for the one that is added.
    rows = rows.withColumn(_DRAWS, shard_draws(F.col("doc_id"), [1.0] * (n_shards + 1)))
    rows = descend(descend(rows, _DRAWS, tree), _DRAWS, grown, "grown_").drop(_DRAWS)
    within = Window.partitionBy("shard", "block").orderBy("doc_id", "text_crc32", "size")
    rows = rows.withColumn("rank", F.row_number().over(within) - 1)
    return rows.join(starts, ["shard", "block"]).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        "shard",
        (F.col("before") + F.col("rank")).alias("slot"),
        "grown_shard",
        "region",
        "rack",
    )


def oracle_sql(n_shards: int = 40) -> str:
    """The same rows in DuckDB's SQL, but for the CRC, which DuckDB lacks: see ``queries``. The best of
    all draws is found at once here, and racks and regions follow from its shard."""
    unit = "(('0x' || substr(md5('shard' || i || ':' || k), 1, 12))::BIGINT::DOUBLE + 0.5)"
    draws = f"list_transform(range({{0}}), lambda i: ln({unit} / 281474976710656.0))"
    return f"""
WITH base AS (
    SELECT doc_id, coalesce(text, '') AS body, coalesce(doc_id::VARCHAR, 'null') AS k,
        ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null')), 13, 8))::BIGINT
            % (SELECT greatest({MIN_BLOCKS}, count(*) // {n_shards * ROWS_PER_BLOCK})
               FROM documents) AS block
    FROM documents),
drawn AS (
    SELECT *, {draws.format(n_shards)} AS own, {draws.format(n_shards + 1)} AS more FROM base),
placed AS (
    SELECT *, list_position(own, list_max(own)) - 1 AS shard,
        list_position(more, list_max(more)) - 1 AS grown_shard FROM drawn)
SELECT doc_id, octet_length(encode(body)) + 16 AS size, 'key' AS law, shard::INTEGER AS shard,
    row_number() OVER (PARTITION BY shard ORDER BY block, doc_id) - 1 AS slot,
    grown_shard::INTEGER AS grown_shard,
    (shard // {SHARDS_PER_RACK * RACKS_PER_REGION})::INTEGER AS region,
    (shard // {SHARDS_PER_RACK})::INTEGER AS rack
FROM placed"""
