"""Merkle manifest of a table: one tree per group, a tree over the groups, and proofs per row.

Leaf coordinates come from bitmaps. The ids of a group are merged into words of 64 bits, of which
only those with an id are kept; directories of up to 512 words, of 512 directories and so on hold
how many rows come before. The position of a row is one lookup: rows before its word, and the bits
below its own. No sort of the rows is needed; only rows whose id occurs more than once, which a bit
cannot tell apart, are put in order by their leaves.

Rows then meet in arrays keyed by slot, 512 leaves at a time, which is three levels of a tree of
arity eight; their roots are the leaves of the next round. Proofs are handed down the same arrays.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillsift.llm.staging import staged

ARITY, LEVELS = 8, 3
BLOCK = ARITY**LEVELS
#: Bits of an id within a word, and of a word within its directory.
WORD_BITS, FAN_BITS = 6, 9
#: Words count from 1, so that all are positive; rows without an id come first, in word 0.
FIRST_WORD = (1 << 63 - WORD_BITS) + 1
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def leaf(fields: Sequence[Column]) -> Column:
    """The digest of a row: each field as its length in bytes, a colon and its value; ``-`` if null."""
    texts = [c.cast("string") for c in fields]
    marked = [F.concat(F.octet_length(t).cast("string"), F.lit(":"), t) for t in texts]
    return digest(*[F.coalesce(m, F.lit("-")) for m in marked])


def fold(node: Column, path: Column) -> Column:
    """The root that a leaf leads to by the siblings in ``path``."""
    return F.aggregate(path, node, lambda h, p: digest(p["left"], h, p["right"]))


def siblings(path: Column) -> Column:
    """All digests of a proof, level by level, as one text."""
    return F.array_join(F.transform(path, lambda p: F.concat(p["left"], p["right"])), "")


def numbered(spark: SparkSession, rows: DataFrame, order: Sequence[Column]) -> DataFrame:
    """``rows`` with their ``number`` from 0 in the given order, which should end in a column that
    tells rows apart, so that no value holds a range of its own together."""
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = staged(spark, rows.withColumn("_at", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("_at", 33)
    counts = rows.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("n")).collect()
    # One entry per partition, not per row.
    before, starts = 0, []
    for r in sorted(counts):
        starts.append((r._part, before))
        before += r.n
    starts = spark.createDataFrame(starts, "_part LONG, _before LONG")
    within = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    joined = rows.withColumn("_part", part).join(F.broadcast(starts), "_part")
    return joined.withColumn("number", F.col("_before") + within).drop("_at", "_part", "_before")


def _words(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """grp, word, bits, n (rows), before (rows of the group in smaller words), total (of the group)."""
    bit = F.expr("IF(id IS NULL, 0L, shiftleft(1L, CAST(id & 63L AS INT)))")
    words = rows.groupBy("grp", "word").agg(
        F.bit_or(bit).alias("bits"), F.count(F.lit(1)).alias("n")
    )
    words = staged(spark, words, "bitmap-words")
    ends = words.agg(F.min("word").alias("low"), F.max("word").alias("high")).first()
    directories = [words.select("grp", F.col("word").alias("entry"), "n")]
    height = 0
    while ends.low is not None and ends.low >> height != ends.high >> height:
        height += FAN_BITS
        up = F.shiftright("entry", FAN_BITS).alias("entry")
        above = directories[-1].groupBy("grp", up).agg(F.sum("n").alias("n"))
        directories.append(staged(spark, above, "bitmap-directory"))
    top = directories.pop()
    known = top.select("grp", "entry", F.lit(0).cast("long").alias("before"))
    inside = Window.partitionBy("grp", "above").orderBy("entry").rowsBetween(
        Window.unboundedPreceding, -1
    )
    for directory in reversed(directories):
        above = known.select("grp", F.col("entry").alias("above"), F.col("before").alias("base"))
        known = (
            directory.withColumn("above", F.shiftright("entry", FAN_BITS))
            .join(above, ["grp", "above"])
            .withColumn("before", F.col("base") + F.coalesce(F.sum("n").over(inside), F.lit(0)))
            .select("grp", "entry", "before")
        )
    known = known.withColumnRenamed("entry", "word")
    totals = top.select("grp", F.col("n").alias("total"))
    return staged(spark, words.join(known, ["grp", "word"]).join(totals, "grp"), "bitmap-ranks")


def positions(spark: SparkSession, rows: DataFrame) -> tuple[DataFrame, int]:
    """``rows`` (grp, id, node and others) with ``position`` in the group by id, from 0, and
    ``total``, the rows of the group; and the largest total.

    Rows of one id follow each other by their nodes; rows without an id come first.
    """
    word = F.coalesce(F.shiftright("id", WORD_BITS) + F.lit(FIRST_WORD), F.lit(0))
    rows = rows.withColumn("word", word)
    words = _words(spark, rows)
    distinct = F.bit_count("bits")
    facts = words.agg(F.max("total").alias("largest"), F.max(F.col("n") - distinct).alias("more"))
    largest, more = facts.first()
    below = F.expr("bit_count(bits & ~shiftleft(-1L, CAST(id & 63L AS INT)))")
    own = [c for c in rows.columns if c != "word"]
    joined = rows.join(words, ["grp", "word"])
    single = joined.where(F.col("n") == distinct).select(
        *own, "total", (F.col("before") + below).alias("position")
    )
    if not more:
        return single, largest or 0
    repeated = joined.where(F.col("n") > distinct).select(*own, "word", "total", "before")
    salt = F.xxhash64(F.monotonically_increasing_id())
    order = [F.asc_nulls_first(c) for c in ("grp", "word", "id", "node", "salt")]
    repeated = numbered(spark, repeated.withColumn("salt", salt), order)
    first = staged(
        spark, repeated.groupBy("grp", "word").agg(F.min("number").alias("first")), "first-numbers"
    )
    placed = repeated.join(first, ["grp", "word"]).select(
        *own, "total", (F.col("before") + F.col("number") - F.col("first")).alias("position")
    )
    return single.unionByName(placed), largest


def _raised(nodes: Column) -> Column:
    runs = F.sequence(F.lit(0), F.floor((F.size(nodes) - 1) / ARITY).cast("int"))
    run = lambda i: F.sha2(F.array_join(F.slice(nodes, i * ARITY + 1, ARITY), ""), 256)
    return F.transform(runs, run)


def _block_arrays(rows: DataFrame, payload: list[str]) -> DataFrame:
    """Runs of BLOCK neighbours as arrays keyed by slot: grp, block, total, entries, and the nodes
    of each level, level0 to level3. A level above a single node is that node."""
    entry = F.struct("position", "node", *payload)
    blocks = rows.groupBy(
        "grp", F.floor(F.col("position") / BLOCK).cast("long").alias("block"), "total"
    ).agg(F.sort_array(F.collect_list(entry)).alias("entries"))
    blocks = blocks.withColumn("level0", F.col("entries.node"))
    for k in range(LEVELS):
        nodes = F.col(f"level{k}")
        raised = F.when(F.col("total") > ARITY**k, _raised(nodes)).otherwise(nodes)
        blocks = blocks.withColumn(f"level{k + 1}", raised)
    return blocks


def _path(slot: Column) -> Column:
    """The siblings of a slot within its block, level by level."""
    steps = []
    for k in range(LEVELS):
        nodes = F.col(f"level{k}")
        at = F.shiftright(slot, 3 * k)
        run = at - at % ARITY
        steps.append(
            F.struct(
                (F.col("total") > ARITY**k).alias("hashed"),
                F.array_join(F.slice(nodes, run + 1, at - run), "").alias("left"),
                F.array_join(F.slice(nodes, at + 2, run + ARITY - 1 - at), "").alias("right"),
            )
        )
    hashed = F.filter(F.array(*steps), lambda s: s["hashed"])
    return F.transform(hashed, lambda s: F.struct(s["left"], s["right"]))


def _tower(
    spark: SparkSession, rows: DataFrame, largest: int, payload: list[str]
) -> tuple[list[DataFrame], DataFrame]:
    """Blocks of each round from the leaves up, and the roots (grp, node)."""
    floors = []
    while True:
        blocks = staged(spark, _block_arrays(rows, payload), "merkle-blocks")
        floors.append(blocks)
        rows = blocks.select(
            "grp",
            F.col("block").alias("position"),
            F.col(f"level{LEVELS}")[0].alias("node"),
            F.ceil(F.col("total") / BLOCK).cast("long").alias("total"),
        )
        payload, largest = [], -(-largest // BLOCK)
        if largest <= 1:
            return floors, rows.select("grp", "node")


def _proven(names: Sequence[str]):
    """An entry at a slot of its block, with its path in the block and on from there."""

    def entry(e: Column, slot: Column) -> Column:
        kept = [e[n].alias(n) for n in ("position", "node", *names)]
        return F.struct(*kept, F.concat(_path(slot), F.col("path")).alias("path"))

    return entry


def _handed_down(floors: list[DataFrame], above: DataFrame, payload: list[str]) -> DataFrame:
    """Entries of the lowest floor with their whole path; ``above`` gives each group's (grp, path)."""
    floors = list(floors)
    upper = None
    while floors:
        blocks = floors.pop()
        if upper is None:
            blocks = blocks.join(above, "grp")
        else:
            blocks = blocks.join(upper, ["grp", "block"])
        entries = F.transform("entries", _proven(() if floors else payload))
        rows = blocks.select("grp", F.inline(entries))
        upper = rows.select("grp", F.col("position").alias("block"), "path")
    return rows


def manifest(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """A Merkle manifest of ``rows`` (grp STRING, id LONG, node STRING, and payload columns).

    ``node`` is the leaf of a row, a hex digest. Returns the rows with ``position`` in their group,
    ``subroot`` of the group, ``root`` of all groups, and ``path``: the digests left and right of the
    node on each level up to the root, for :func:`fold`.

    Leaves of a group ascend by id; rows without one come first, equal ids go by their leaves, and
    equal rows are leaves of their own. A null group is the first, the others follow bytewise. An
    empty table gives no rows.
    """
    payload = [c for c in rows.columns if c not in ("grp", "id", "node")]
    # A null group as a text that is smaller than those of all others.
    rows = rows.withColumn("grp", F.coalesce(F.concat(F.lit("+"), "grp"), F.lit("")))
    rows = rows.select("grp", "id", "node", F.struct("id", *payload).alias("row"))
    rows = staged(spark, rows, "merkle-leaves")
    placed, largest = positions(spark, rows)
    floors, subroots = _tower(spark, placed, largest, ["row"])

    subroots = numbered(spark, subroots, [F.asc("grp")])
    subroots = staged(spark, subroots.withColumnRenamed("number", "position"), "subroots")
    groups = subroots.count()
    whole = subroots.select(
        F.lit("").alias("grp"), "position", "node", F.lit(groups).cast("long").alias("total"),
        F.struct("grp").alias("row"),
    )
    top_floors, roots = _tower(spark, whole, groups, ["row"])
    none = F.array().cast("array<struct<left:string,right:string>>")
    tops = _handed_down(top_floors, roots.select("grp", none.alias("path")), ["row"])
    # One row per group, with the root that its subroot folds to.
    tops = tops.select(
        "row.grp", F.col("node").alias("subroot"), fold(F.col("node"), F.col("path")).alias("root"),
        "path",
    )
    tops = staged(spark, tops, "merkle-tops")
    proofs = _handed_down(floors, tops.select("grp", "path"), ["row"])
    return proofs.join(tops.drop("path"), "grp").select(
        F.when(F.col("grp") != "", F.substring("grp", 2, 1 << 30)).alias("grp"),
        "row.*", "position", "node", "subroot", "root", "path",
    )


def verify_documents(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Every row of ``docs`` with its leaf, roots and proof, and whether the row, a third of them
    tampered with, still leads to the root.

    Where 3 divides the CRC-32 of the decimal doc_id, tampering puts A-Z of the text in lower case;
    rows without an id are not tampered with. Further columns play no part, whatever their names.
    See :func:`manifest` for nulls, repeated rows and empty tables.
    """
    own = [F.col(c) for c in FIELDS]
    tampered = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    lowered = F.translate("text", LETTERS, LETTERS.lower())
    rows = docs.select(
        F.col("lang").alias("grp"),
        F.col("doc_id").alias("id"),
        leaf(own).alias("node"),
        F.when(tampered, leaf([*own[:-1], lowered])).alias("tampered"),
    )
    proofs = manifest(spark, rows)
    shown = proofs.select(
        F.col("id").alias("doc_id"),
        F.col("node").alias("leaf"),
        "subroot",
        "root",
        F.sha2(siblings(F.col("path")), 256).alias("proof_sha256"),
        fold(F.coalesce("tampered", "node"), F.col("path")).alias("folded_root"),
    )
    return shown.withColumn("verified", F.col("folded_root") == F.col("root"))


def oracle_sql(levels: int = 11) -> str:
    """The same rows for DuckDB, level by level; ``levels`` of arity eight are enough for 8 ** levels
    leaves of a group, and for as many groups."""
    fields = [f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')" for c in FIELDS[:-1]]
    text = "coalesce(strlen({0}) || ':' || {0}, '-')"
    lowered = f"translate(text, '{LETTERS}', '{LETTERS.lower()}')"
    # CRC-32 bit by bit: a code is taken in, each -1 shifts once.
    crc = (
        "xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform("
        "string_split(doc_id::VARCHAR, ''), lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))), "
        "lambda a, b: CASE WHEN b >= 0 THEN xor(a, b) "
        "ELSE xor(a >> 1, (a & 1) * 3988292384) END), 4294967295)"
    )
    parts = [
        f"""rows AS (
    SELECT doc_id, lang, sha256(concat({', '.join(fields)}, {text.format('text')})) AS leaf,
        CASE WHEN {crc} % 3 = 0
            THEN sha256(concat({', '.join(fields)}, {text.format(lowered)})) END AS tampered
    FROM documents),
langs AS (
    SELECT lang, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS g, count(*) OVER () AS n
    FROM (SELECT DISTINCT lang FROM documents)),
a0 AS (
    SELECT r.doc_id, r.leaf, r.tampered, l.g, r.leaf AS h,
        row_number() OVER (PARTITION BY l.g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
        count(*) OVER (PARTITION BY l.g) AS n
    FROM rows r JOIN langs l ON r.lang IS NOT DISTINCT FROM l.lang)"""
    ]

    def rise(a: str, b: str) -> str:
        return f"""{b} AS (
    SELECT g, i // 8 AS i, (any_value(n) + 7) // 8 AS n, any_value(n) > 1 AS hashed,
        list(h ORDER BY i) AS kids,
        CASE WHEN any_value(n) > 1 THEN sha256(string_agg(h, '' ORDER BY i)) ELSE any_value(h) END AS h
    FROM {a} GROUP BY g, i // 8)"""

    parts += [rise(f"a{k}", f"a{k + 1}") for k in range(levels)]
    parts.append(
        f"b0 AS (SELECT 0 AS g, s.g AS i, l.n, s.h FROM a{levels} s JOIN langs l ON l.g = s.g)"
    )
    parts += [rise(f"b{k}", f"b{k + 1}") for k in range(levels)]
    left = "array_to_string({0}.kids[1:({1}) % 8], '')"
    right = "array_to_string({0}.kids[({1}) % 8 + 2:], '')"
    steps = [(f"a{k + 1}", f"x.g = a{k + 1}.g", f"x.i // {8**k}") for k in range(levels)]
    steps += [(f"b{k + 1}", "true", f"x.g // {8**k}") for k in range(levels)]
    joins = "\n    ".join(f"JOIN {t} ON {g} AND {t}.i = ({at}) // 8" for t, g, at in steps)
    path = ",\n        ".join(
        f"CASE WHEN {t}.hashed THEN {left.format(t, at)} || '|' || {right.format(t, at)} END"
        for t, _, at in steps
    )
    parts.append(
        f"""proofs AS (
    SELECT x.*, a{levels}.h AS subroot, b{levels}.h AS root, list_filter([
        {path}], lambda p: p IS NOT NULL) AS path
    FROM a0 x
    {joins})"""
    )
    return (
        "WITH "
        + ",\n".join(parts)
        + """
SELECT doc_id, leaf, subroot, root, folded_root, folded_root = root AS verified,
    sha256(replace(array_to_string(path, ''), '|', '')) AS proof_sha256
FROM (SELECT *, list_reduce(list_concat([coalesce(tampered, leaf)], path),
    lambda h, p: sha256(split_part(p, '|', 1) || h || split_part(p, '|', 2))) AS folded_root
    FROM proofs)"""
    )
