"""URL rules looked up in a cascade of Bloom filters.

The keys of a rule list are host suffixes with path prefixes. Level 1 encodes the listed keys;
level 2 those keys of the corpus that pass level 1 without being listed; level 3 the listed keys
that pass level 2, and so on until no key of the corpus is judged wrongly. The levels then answer
membership of every key that occurs in the corpus exactly, by expressions alone and without a join.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillsift.llm.staging import staged

#: A rule list is held by the driver and sent with the plan; more rules than this are refused.
MAX_RULES = 1_000_000
INNER_ERROR = 0.5
MAX_LEVELS = 64

Rule = tuple[str, str, str]


def rules_of(text: str) -> list[Rule]:
    """Rules from lines such as ``block example.com/en/``: (verdict, host, path)."""
    found = []
    for line in filter(None, map(str.strip, text.split("\n"))):
        verdict, key = line.split(" ", 1)
        host, slash, path = key.partition("/")
        found.append((verdict, host.lower(), slash + path))
    return found


@dataclass(frozen=True)
class Level:
    bits: int
    hashes: int
    seed: int
    words: tuple[int, ...]

    def holds(self, key: Column) -> Column:
        words = F.array(*[F.lit(w).cast("long") for w in self.words])
        tests = []
        for place in _places(key, self.bits, self.hashes, self.seed):
            word = F.element_at(words, F.floor(place / 64).cast("int") + 1)
            tests.append(word.bitwiseAND(_bit(place)) != 0)
        result = tests[0]
        for test in tests[1:]:
            result = result & test
        return result


@dataclass(frozen=True)
class Cascade:
    levels: tuple[Level, ...]

    def holds(self, key: Column) -> Column:
        """Odd levels vote for, even levels against; the first level that lacks the key decides."""
        result = F.lit(len(self.levels) % 2 == 1)
        for depth in range(len(self.levels) - 1, -1, -1):
            missing = F.lit(depth % 2 == 1)
            result = F.when(self.levels[depth].holds(key), result).otherwise(missing)
        return F.coalesce(result, F.lit(False))


def _places(key: Column, bits: int, hashes: int, seed: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(seed * 1000 + i)), F.lit(bits)) for i in range(hashes)]


def _bit(place: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), (place % 64).cast("int"))


def _level(keys: DataFrame, count: int, error: float, seed: int) -> Level:
    """A Bloom filter over ``keys`` (column key), its bits gathered by aggregation."""
    bits = 64 * max(1, math.ceil(-count * math.log(error) / math.log(2) ** 2 / 64))
    hashes = max(1, round(bits / max(count, 1) * math.log(2)))
    hashes = min(hashes, max(1, math.ceil(-math.log2(error))))
    places = keys.select(F.explode(F.array(*_places(F.col("key"), bits, hashes, seed))).alias("at"))
    found = (
        places.groupBy(F.floor(F.col("at") / 64).cast("int").alias("word"))
        .agg(F.bit_or(_bit(F.col("at"))).alias("value"))
        .collect()
    )
    words = [0] * (bits // 64)
    for row in found:
        words[row.word] = row.value
    return Level(bits, hashes, seed, tuple(words))


def build_cascade(spark: SparkSession, listed: Sequence[str], universe: DataFrame) -> Cascade:
    """A cascade that answers every key of ``universe`` (distinct, column key) exactly.

    The first level's error rate is chosen so that level 2 holds about as many keys as are listed,
    whatever the size of the universe; so all levels are bounded by the list.
    """
    if len(listed) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    if not listed:
        return Cascade(())
    inside = spark.createDataFrame([(k,) for k in sorted(set(listed))], "key STRING")
    outside = universe.join(F.broadcast(inside), "key", "left_anti")
    others = outside.count()
    error = min(INNER_ERROR, len(set(listed)) / (math.sqrt(2) * max(others, 1)))
    levels: list[Level] = []
    encode, against, count = inside, outside, len(set(listed))
    while count and len(levels) < MAX_LEVELS:
        level = _level(encode, count, error, len(levels) + 1)
        levels.append(level)
        wrong = against.where(level.holds(F.col("key")))
        wrong = staged(spark, wrong, "cascade")
        encode, against, count, error = wrong, encode, wrong.count(), INNER_ERROR
    if count:
        raise ValueError("the cascade does not end")
    return Cascade(tuple(levels))


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty where the url is null or has no ``://``."""
    start = F.instr(url, "://")
    rest = F.when(start > 0, url.substr(start + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(
        F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1),
        "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
        "abcdefghijklmnopqrstuvwxyz",
    )
    return host, F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)


def _shapes(rules: Sequence[Rule]) -> list[tuple[int, int]]:
    """(labels of the host, length of the path), each once: the only keys a url can match by."""
    return sorted({(host.count(".") + 1, len(path)) for _, host, path in rules})


def _keys(shapes: Sequence[tuple[int, int]]) -> Column:
    labels = F.size(F.split("host", r"\."))
    keys = [
        F.when(
            (labels >= n) & (F.length("path") >= m),
            F.concat(F.substring_index("host", ".", -n), F.substring("path", 1, m)),
        )
        for n, m in shapes
    ]
    return F.array_compact(F.array(*keys))


def _marked_hits(verdict: str, cascade: Cascade) -> Column:
    """The listed ones of a url's keys, longest last when compared."""
    return F.transform(
        F.filter("keys", lambda k: cascade.holds(k)),
        lambda k: F.struct(
            F.length(k).alias("n"), k.alias("rule"), F.lit(verdict).alias("verdict")
        ),
    )


def judge_urls(
    spark: SparkSession, pages: DataFrame, rules: Sequence[Rule], default: str = "allow"
) -> DataFrame:
    """Every page (page_id, url) with host, path, the longest rule that fits, and its verdict.

    Urls that no rule fits, null urls among them, get a null rule and ``default``. Repeated pages
    give repeated rows, an empty table gives none, other columns are not read.
    """
    shapes, verdicts = _shapes(rules), sorted({v for v, _, _ in rules})
    host, path = url_parts(F.col("url"))
    parts = pages.select("page_id", host.alias("host"), path.alias("path"))
    if not rules:
        return parts.select(
            "*", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict")
        )
    parts = parts.withColumn("keys", _keys(shapes))
    universe = staged(spark, parts.select(F.explode("keys").alias("key")).distinct(), "url-keys")
    cascades = {
        v: build_cascade(spark, [h + p for w, h, p in rules if w == v], universe) for v in verdicts
    }
    marked = F.concat(*[_marked_hits(v, cascades[v]) for v in verdicts])
    best = F.array_max(marked)
    return parts.withColumn("best", best).select(
        "page_id",
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce(F.col("best.verdict"), F.lit(default)).alias("verdict"),
    )


def oracle_sql(rules: Sequence[Rule], default: str = "allow") -> str:
    values = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in rules)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""
WITH rules(verdict, rhost, rpath) AS (VALUES {values}),
rest AS (
    SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3)
        ELSE '' END AS rest FROM pages),
parts AS (
    SELECT page_id, row_number() OVER () AS n,
        translate(regexp_extract(rest, '^([^/?#]*)', 1), '{upper}', '{lower}') AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
fits AS (
    SELECT n, arg_max(rhost || rpath, length(rhost || rpath)) AS rule,
        arg_max(verdict, length(rhost || rpath)) AS verdict
    FROM parts JOIN rules ON (host = rhost OR suffix(host, '.' || rhost))
        AND starts_with(path, rpath)
    GROUP BY n)
SELECT page_id, host, path, rule, coalesce(verdict, '{default}') AS verdict
FROM parts LEFT JOIN fits USING (n)"""
