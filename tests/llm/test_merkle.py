"""Merkle manifests against a tree built in plain Python."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

from quillsift.llm import merkle

SCHEMA = "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    values = [row["doc_id"], row["source"], row["lang"], row["n_chars"], text]
    texts = ["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values]
    return h(*texts)


def climb(nodes):
    """The root of some nodes, and for each the left and right siblings by level."""
    paths, where = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, at in enumerate(where):
            run = at - at % 8
            paths[k].append(("".join(nodes[run:at]), "".join(nodes[at + 1 : run + 8])))
            where[k] = at // 8
        nodes = [h(*nodes[i : i + 8]) for i in range(0, len(nodes), 8)]
    return nodes[0], paths


def expected(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r["lang"]].append((r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"]), r))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: climb([e[2] for e in sorted(groups[g], key=lambda e: e[:3])]) for g in order}
    root, tops = climb([trees[g][0] for g in order])
    out = Counter()
    for g, top in zip(order, tops, strict=True):
        for entry, path in zip(sorted(groups[g], key=lambda e: e[:3]), trees[g][1], strict=True):
            row, whole = entry[3], path + top
            folded = entry[2]
            if row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 3 == 0:
                text = row["text"]
                if text is not None:
                    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
                folded = leaf(row, text)
            for left, right in whole:
                folded = h(left, folded, right)
            proof = h(*[x for pair in whole for x in pair])
            found = (row["doc_id"], entry[2], trees[g][0], root, proof, folded, folded == root)
            out[found] += 1
    return out


def found(spark, docs):
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return Counter(tuple(r) for r in merkle.verify_documents(spark, docs).select(*names).collect())


def test_odd_rows(spark, odd_docs, no_docs):
    rows = [r.asDict() for r in odd_docs.collect()]
    assert found(spark, odd_docs) == expected(rows)
    assert merkle.verify_documents(spark, no_docs).count() == 0


def test_trees_of_all_sizes(spark):
    """Groups of one leaf, of whole runs and blocks, and just beyond them; ids far apart."""
    rng = random.Random(5)
    rows = []
    sizes = {None: 9, "": 1, "de": 8, "en": 513, "é": 64, "z": 65, "\U0001f600": 2, "￿": 600}
    for lang, n in sizes.items():
        ids = rng.sample([rng.randrange(-(2**63), 2**63) for _ in range(n)] + list(range(n)), n)
        rows += [(i, f"Text {i} ÄB", lang, rng.choice(["s", None]), i % 7) for i in ids]
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, SCHEMA)
    assert found(spark, docs) == expected([r.asDict() for r in docs.collect()])


def test_ids_that_repeat(spark):
    """One id holds a third of all rows, others come twice, and some rows have none."""
    rows = [(7, f"T{i % 90}", "en", "s", i % 3) for i in range(400)]
    rows += [(i // 2, f"T{i}", "en", "s", 1) for i in range(600)]
    rows += [(None, f"T{i % 50}", "en", "s", 1) for i in range(120)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert found(spark, docs) == expected([r.asDict() for r in docs.collect()])


def test_positions_need_no_sort_of_single_ids(spark):
    rows = spark.range(0, 3000, 3).selectExpr("'+x' AS grp", "id", "string(id) AS node")
    placed, largest = merkle.positions(spark, rows)
    assert largest == 1000
    assert {(r.id, r.position) for r in placed.collect()} == {(i * 3, i) for i in range(1000)}
    plan = placed._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "rangepartitioning" not in plan
