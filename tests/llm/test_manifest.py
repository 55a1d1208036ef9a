"""Merkle manifests against trees built level by level in plain Python."""

from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from qaloom.llm import manifest


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def climb(level, run):
    """All levels of a tree."""
    levels = [level]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i : i + run]) for i in range(0, len(levels[-1]), run)])
    return levels


def path(levels, at, run):
    out = []
    for level in levels[:-1]:
        first = at - at % run
        out += [d for i, d in enumerate(level[first : first + run], first) if i != at]
        at //= run
    return out


def plain(rows, run):
    """(id, leaf, subroot, root, proof) of rows (id, group, leaf)."""
    groups = {}
    for i, g, d in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[2])):
        groups.setdefault(g, []).append((i, d))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: climb([d for _, d in groups[g]], run) for g in order}
    top = climb([trees[g][-1][0] for g in order], run)
    return [
        (i, d, trees[g][-1][0], top[-1][0], "".join(path(trees[g], n, run) + path(top, k, run)))
        for k, g in enumerate(order) for n, (i, d) in enumerate(groups[g])
    ]


@pytest.mark.parametrize("run", [2, 3])
def test_manifest(spark, run, monkeypatch):
    monkeypatch.setattr(manifest, "BLOCK", 9)
    sizes = {None: 1, "": 2, "en": 230, "é": 30, "z": 3, "de": 9, "fr": 10, "x": 28}
    rows = [(n, g, h(str(n), g or "-")) for n, g in enumerate(g for g, size in sizes.items() for _ in range(size))]
    rows += [(5, "en", h("again")), (5, "en", h("again")), (None, "en", h("null"))] + [(9, "en", h("hot"))] * 40
    df = spark.createDataFrame(rows, "tree bigint, pos string, digest string").withColumns({"proof": F.lit(1), "block": F.lit(2), "note": F.lit(3)})
    check = F.when(F.col("tree") % 7 == 0, F.sha2("digest", 256)).otherwise(F.col("digest"))
    got = manifest.manifest(df, F.col("tree"), F.col("pos"), F.col("digest"), check, run).collect()
    key = lambda r: tuple(map(str, r))
    assert sorted([(r["id"], r["leaf"], r["subroot"], r["root"], r["proof"]) for r in got], key=key) == sorted(plain(rows, run), key=key)
    for r in got:
        assert r["verified"] == (r["folded_root"] == r["root"]) == (r["id"] is None or r["id"] % 7 != 0)
    empty = df.limit(0)
    assert manifest.manifest(empty, F.col("tree"), F.col("pos"), F.col("digest"), F.col("digest")).count() == 0
    (one,) = manifest.manifest(df.limit(1), F.col("tree"), F.col("pos"), F.col("digest"), F.col("digest")).collect()
    assert one["leaf"] == one["subroot"] == one["root"] == one["folded_root"] and one["proof"] == ""


def test_leaf(spark):
    long_ = "ä" * 300_000
    rows = [(1, "s", None, 3, "tüv"), (None, "", "en", None, ""), (-7, None, None, 0, long_)]
    df = spark.createDataFrame(rows, "a bigint, b string, c string, d int, e string")
    want = [h("1:1", "1:s", "-", "1:3", "4:tüv"), h("-", "0:", "2:en", "-", "0:"), h("2:-7", "-", "-", "1:0", "600000:", long_)]
    assert [r[0] for r in df.select(manifest.leaf(*map(F.col, df.columns))).collect()] == want


def test_numbered(spark):
    from qaloom.llm.ordered import numbered

    rows = [("a", n % 50, n) for n in range(500)] + [("b", 1, 0)] * 300 + [("c", None, 1)]
    df = spark.createDataFrame(rows, "g string, at bigint, pos_ bigint").repartition(9)
    got = numbered(df, "g", [F.col("at")]).collect()
    for g in "abc":
        own = sorted((r for r in got if r["g"] == g), key=lambda r: r["pos"])
        assert [r["pos"] for r in own] == list(range(len(own))) and {r["total"] for r in own} == {len(own)}
        assert [r["at"] or 0 for r in own] == sorted(r[1] or 0 for r in rows if r[0] == g)
