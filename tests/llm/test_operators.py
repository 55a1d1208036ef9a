"""Every operator against brute force, with nulls, empty and long texts, ties, repeated rows, empty tables and odd columns."""

import hashlib
import io
import random
import re
import zipfile
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from qaloom.llm import covertree, graph, hashing, mixing, neardup, packing, quality, reputation, sharding, suffixes, tokens, topk, warc
from qaloom.llm.columns import word_count

DOCS = "doc_id bigint, text string, source string"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def sentence(rng, n):
    return " ".join(rng.choice("alpha beta gamma delta eps zeta eta theta iota kappa lam mu nu xi".split()) + str(rng.randrange(30)) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    shared = sentence(rng, 20)
    out = [None, "", "  \n", "one", "Two words", "é" * 70, "É" * 70, sentence(rng, 9000)]
    base = [sentence(rng, 60) for _ in range(8)]
    out += base + base[:3] + [b.upper() for b in base[:2]]
    out += [" ".join(w if i != 7 else "changed" for i, w in enumerate(b.split())) for b in base[:5]]
    out += [sentence(rng, 15) + " " + shared + " " + sentence(rng, 15) for _ in range(6)]
    return out


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, [None, "a", "b", "hot", "hot"][i % 5]) for i, t in enumerate(texts)] + [(None, texts[8], "a"), (3, texts[3], "hot")]
    return spark.createDataFrame(rows, DOCS)


def shingle_set(text):
    w = WORDS.findall((text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def test_shingles(texts):
    assert [len(s) for s in hashing.shingle_sets(pa.array(texts))] == [len(shingle_set(t)) for t in texts]


def test_mix(spark, docs):
    sized = docs.withColumn("size", word_count(F.col("text"))).withColumn("target_", F.lit(1))
    targets = mixing.source_targets(sized, "source", "size", [5, 2, 1])
    rows = mixing.mix(sized, "doc_id", "source", "size", targets).collect()
    assert len(rows) == docs.count()
    per = {r["source"]: (r["source_size"], r["target"]) for r in rows}
    assert sum(t for _, t in per.values()) == pytest.approx(sum(s for s, _ in per.values()))
    for source, (size, target) in per.items():
        own = [r for r in rows if r["source"] == source]
        assert target <= 3 * size + 1e-6 and all(0 <= r["copies"] <= 3 for r in own)
        assert abs(sum(r["copies"] for r in own) - len(own) * target / max(1, size)) < 1
    assert sorted(map(str, mixing.mix(sized, "doc_id", "source", "size", targets).collect())) == sorted(map(str, rows))
    assert mixing.emit(mixing.mix(sized, "doc_id", "source", "size", targets)).count() == sum(r["copies"] for r in rows)
    empty = sized.limit(0)
    assert mixing.mix(empty, "doc_id", "source", "size", mixing.source_targets(empty, "source", "size", [5, 2, 1])).count() == 0


def test_shards(spark, docs):
    rows = sharding.shuffle_to_shards(docs.withColumn("_part", F.lit(1)), 4).collect()
    sizes = [sorted(r["slot"] for r in rows if r["shard"] == s) for s in range(4)]
    assert all(x == list(range(len(x))) for x in sizes) and max(map(len, sizes)) - min(map(len, sizes)) <= 1 and len(rows) == docs.count()
    assert sharding.shuffle_to_shards(docs.limit(0), 4).count() == 0
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "50")
    try:
        many = spark.range(0, 1000, 1, 3).select(F.lit("same").alias("text"), "id")
        runs = [sorted((r["id"], r["shard"], r["slot"]) for r in sharding.shuffle_to_shards(many, 4).collect()) for _ in range(2)]
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    assert runs[0] == runs[1] and len({x[1:] for x in runs[0]}) == 1000
    rng = np.random.default_rng(1)
    draws = [sharding.hypergeometric(rng, 30, 70, 20) for _ in range(4000)]
    assert np.mean(draws) == pytest.approx(6, abs=0.15) and np.var(draws) == pytest.approx(20 * 0.3 * 0.7 * 80 / 99, rel=0.1)
    m = np.array(sharding.communication_matrix([5, 0, 17, 9], 3, 1))
    assert m.sum(axis=1).tolist() == [5, 0, 17, 9] and sorted(m.sum(axis=0)) == [10, 10, 11]


def test_top_k(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [int(x) for x in rng.integers(-9, 9, 6)]) for i in range(90)] + [(90 + i, [1, 2, 3, 4, 5, 6]) for i in range(40)] + [(7, [1, 1])]
    df = spark.createDataFrame(rows, "id bigint, vector array<bigint>")
    got = {}
    for r in topk.top_k(df, df.filter("id % 20 = 0"), 5).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    for q, v in rows:
        if q % 20 == 0:
            best = sorted((-int(np.dot(v, w)), i) for i, w in rows if i != q and len(w) == len(v))[:5]
            assert [got[q][k + 1] for k in range(5)] == [(i, -s) for s, i in best]
    assert topk.top_k(df.limit(0), df.limit(0), 5).count() == 0
    odd = spark.createDataFrame([(1, None), (2, [1.0, None]), (3, [float("nan")]), (4, [float("inf")]), (5, []), (6, [1.0])], "i int, v array<double>")
    assert [r["i"] for r in odd.filter(topk.usable(F.col("v"))).collect()] == [6]


def test_near_duplicates(spark, docs, texts):
    got = {(r["doc_id"], r["n_shingles"]): (r["component_id"], r["kept"]) for r in neardup.near_duplicates(docs.withColumn("n", F.lit(0))).collect()}
    sets = [shingle_set(t) for t in texts]
    top = list(range(len(texts)))
    for _ in top:
        for i, a in enumerate(sets):
            for j in range(i):
                if a and 100 * len(a & sets[j]) >= 75 * len(a | sets[j]):
                    top[i] = top[j] = min(top[i], top[j])
    for i, s in enumerate(sets):
        assert got[(i, len(s))] == (top[i], top[i] == i)
    assert got[(None, len(sets[8]))] == (None, True)
    assert neardup.near_duplicates(docs.limit(0)).count() == 0


def test_near_duplicates_of_repeated_ids(spark):
    rng = random.Random(12)
    x, y, z, w = (" ".join(sentence(rng, 60) for _ in range(2)) for _ in range(4))
    rows = [(1, x), (5, x), (5, y), (5, y), (7, y), (9, y + " more"), (20, z), (20, w), (20, z), (30, z + " end"), (31, w + " end"), (40, w), (41, w + " end"), (50, "alone"), (50, None)]
    rows += [(60, " ".join(sentence(rng, 30) for _ in range(2))) for _ in range(40)] + [(61, rows[-1][1])]
    rows += [(62, rows[20][1] + " far"), (63, rows[30][1] + " off")]
    sets = [shingle_set(t) for _, t in rows]
    top = {i: i for i, _ in rows}
    for _ in rows:
        for (i, _), a in zip(rows, sets):
            for (j, _), b in zip(rows, sets):
                if a and 100 * len(a & b) >= 75 * len(a | b):
                    top[i] = top[j] = min(top[i], top[j])
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in got) == sorted((i, len(s), top[i], top[i] == i) for (i, _), s in zip(rows, sets))
    assert top[9] == 1 and top[31] == 20 and top[41] == 20


def test_near_duplicates_of_wide_families(spark, monkeypatch):
    """A ring of passages, one large group of near copies, a hub of a common passage, and a chain, with units of few documents."""
    rng = random.Random(13)
    passage = [" ".join(f"p{i}w{j}" for j in range(12)) for i in range(150)]
    texts = [f"{passage[i]} {passage[(i + 1) % 150]}" for i in range(150)]
    base = sentence(rng, 90).split()
    texts += [" ".join(w if at != i % 90 else f"copy{i}" for at, w in enumerate(base)) for i in range(200)]
    texts += [" ".join(w if at not in (i, 40 + i, 80) else f"far{i}" for at, w in enumerate(base)) for i in range(30)]
    texts += [" ".join(base[:9]) + " " + " ".join(f"c{j}" for j in range(i, i + 30)) for i in range(0, 150, 2)]
    rng.shuffle(texts)
    sets = [shingle_set(t) for t in texts]
    top = list(range(len(texts)))
    pairs = [(i, j) for i in range(len(sets)) for j in range(i) if 4 * len(sets[i] & sets[j]) >= 3 * len(sets[i] | sets[j])]
    while any(top[i] != top[j] for i, j in pairs):
        for i, j in pairs:
            top[i] = top[j] = min(top[i], top[j])
    sizes = []

    def seen(df, name="step", write=neardup.materialize):
        out = write(df, name)
        if name == "units":
            sizes.extend(r["count"] for r in out.groupBy("x", "i", "j").count().collect())
        return out

    monkeypatch.setattr(neardup, "UNIT", 64)
    monkeypatch.setattr(neardup, "materialize", seen)
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(rows).collect()}
    assert [got[i] for i in range(len(texts))] == top and len(set(top)) > 100
    assert max(sizes) <= 2 * 64 and sum(sizes) < 20 * len(texts)
    # A few long texts fill a unit as well as many short ones.
    monkeypatch.setattr(neardup, "SHINGLES", 2000)
    sizes.clear()
    assert {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(rows).collect()} == got
    assert max(sizes) < 64


def test_union_sketch():
    rng = np.random.default_rng(14)
    sets = [np.unique(rng.integers(0, 400, rng.integers(1, 200)).astype(np.uint64)) for _ in range(40)]
    for k in (5, 64):
        size = np.array([min(k, len(x)) for x in sets])
        low = np.full((40, k), np.iinfo(np.uint64).max, np.uint64)
        for row, s in zip(low, sets):
            row[: min(k, len(s))] = s[:k]
        for p in range(40):
            both, of = neardup.shared_of_union(low, size, p, np.arange(40))
            for q in range(40):
                union = np.union1d(sets[p], sets[q])[:k]
                assert of[q] == len(union) and both[q] == len(np.intersect1d(np.intersect1d(sets[p], sets[q]), union))
        assert neardup.common_of(sets, 3, np.arange(40)).tolist() == [len(np.intersect1d(sets[3], s)) for s in sets]


def test_components(spark):
    chain = [(i, i + 1) for i in range(60)] + [(1000, x) for x in range(1001, 1200)] + [(5, 5)]
    got = dict(graph.components(spark.createDataFrame(chain, "a bigint, b bigint")).collect())
    assert got == {**{i: 0 for i in range(1, 61)}, **{x: 1000 for x in range(1001, 1200)}}


def test_quality(spark, texts):
    rows = [(i, (t or "") + (" ### $$$" * 8 if i % 3 == 0 else "")) for i, t in enumerate(texts * 12)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("_stats", F.lit(1))
    labels = spark.createDataFrame([(i, int(i % 3 != 0)) for i, _ in rows], "doc_id bigint, label int")
    model = quality.train(docs, labels)
    got = quality.score(docs.unionByName(spark.createDataFrame([(None, None, 1)], "doc_id bigint, text string, _stats int")), model).collect()
    held = [r for r in got if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert np.mean([(r["score"] >= 0.5) == (r["doc_id"] % 3 != 0) for r in held]) > 0.9 and all(0 <= r["score"] <= 1 for r in got)
    assert quality.score(docs, quality.train(docs, labels.limit(0))).select("score").distinct().collect()[0][0] == 0.5


def test_suffixes(spark, docs, texts):
    rows = [r for r in docs.collect() if r["doc_id"] is not None]
    # Plain reference: the smallest document of every window.
    first = {}
    for r in rows:
        b = (r["text"] or "").encode()
        for p in range(len(b) - 49):
            w = b[p : p + 50]
            first[w] = min(first.get(w, r["doc_id"]), r["doc_id"])
    got = {r["doc_id"]: r for r in suffixes.remove_repeats(docs.withColumn("batch", F.lit(1)), F.struct("source", "batch"), texts=True).collect() if r["doc_id"] is not None}
    for r in rows:
        b = (r["text"] or "").encode()
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - 49):
            if first[b[p : p + 50]] < r["doc_id"]:
                gone[p : p + 50] = True
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        g = got[r["doc_id"]]
        assert (g["n_bytes"], g["n_removed"], g["kept_sha256"], g["rest"]["source"]) == (len(b), int(gone.sum()), hashlib.sha256(kept).hexdigest(), r["source"])
        assert g["n_spans"] == len(re.findall(b"\1+", gone.astype(np.uint8).tobytes())) and g["kept"] == kept.decode("utf-8", "ignore")
    assert suffixes.remove_repeats(docs.limit(0)).count() == 0


def test_merge():
    rng = random.Random(3)
    runs = [sorted({bytes(rng.choice(b"ab") for _ in range(rng.randrange(1, 12))) for _ in range(40)}) for _ in range(7)] + [[]]
    out = list(suffixes.merge([suffixes.decode_run(*suffixes.encode_run(r)) if r else iter(()) for r in runs]))
    assert [x for x, _, _ in out] == sorted(sum(runs, []))
    assert all(n == suffixes.common(a, b) for (a, _, _), (b, n, _) in zip(out, out[1:]))


def test_reputation(spark):
    urls = [None, "no", "http://EXAMPLE.com/de/1", "http://a.example.net/en/x?q", "http://a.net/", "http://a.net", "http://b.org/fr/#t", "ftp://xnet/", "http://bad.org/1?/x"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string").withColumn("_host", F.lit(0))
    pages = pages.union(spark.createDataFrame([(i, "http://bad.org/x", 0) for i in range(100, 160)], pages.schema))
    outcomes = spark.createDataFrame([(i, 1) for i in range(100, 160)] + [(6, 0)], "page_id bigint, bad bigint")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in reputation.judge(pages, outcomes).collect()}
    assert got[0] == got[1] == ("", "", None, "allow") and got[2] == ("example.com", "/de/1", "example.com/de/", "block")
    assert got[3][2:] == ("example.net/en/", "allow") and got[4][2:] == ("net/", "block") and got[5] == ("a.net", "", None, "allow")
    assert got[6] == ("b.org", "/fr/", "org/fr/", "allow") and got[7][2] is None and got[8] == ("bad.org", "/1", None, "block")
    assert reputation.judge(pages.limit(0), outcomes.limit(0)).count() == 0


def test_reputation_of_unlabelled_hosts(spark):
    hosts = [f"h{i}.bad.com" for i in range(40)] + [f"h{i}.good.com" for i in range(40)] + [f"h{i}.bad.gov.xx" for i in range(40)] + [f"h{i}.good.gov.xx" for i in range(40)]
    rows = [(n, f"http://{h}/") for n, h in enumerate(h for h in hosts for _ in range(5))]
    new = {9001: "new.bad.com", 9002: "new.good.com", 9003: "new.other.com", 9004: "a.zz", 9005: "new.bad.gov.xx", 9006: "new.good.gov.xx"}
    pages = spark.createDataFrame(rows + [(i, f"http://{h}/") for i, h in new.items()], "page_id bigint, url string")
    outcomes = spark.createDataFrame([(n, int("bad" in u)) for n, u in rows], "page_id bigint, bad bigint")
    verdict = {r["page_id"]: r["verdict"] for r in reputation.judge(pages, outcomes, rules=(), wide_suffixes=["gov.xx"]).collect()}
    assert all(verdict[n] == ("block" if "bad" in u else "allow") for n, u in rows)
    assert {i: verdict[i] for i in new} == {9001: "block", 9002: "allow", 9003: "allow", 9004: "allow", 9005: "block", 9006: "allow"}
    seen = spark.createDataFrame([("a.x.com", 1), ("a.x.com", 1), ("b.y.com", 0), ("c.z.org", 0)], "host string, bad bigint")
    more = seen.union(spark.createDataFrame([("b.x.com", None), ("x.new.com", None), ("y.new.net", None)], seen.schema))
    few, all_ = ({r["host"]: r for r in reputation.host_reputation(x).collect()} for x in (seen, more))
    assert all(all_[h]["bad_rate"] == pytest.approx(few[h]["bad_rate"]) and all_[h]["bound"] == pytest.approx(few[h]["bound"]) for h in few)
    assert "y.new.net" not in all_ and all_["b.x.com"]["bad_rate"] > all_["x.new.com"]["bad_rate"]


def test_warc(spark):
    long_ = "x" * 5000 + "é"
    rows = [(3, "http://a/\r\n", long_), (1, None, long_), (2, "http://b/", None), (4, "u", "short"), (5, "u", "short"), (None, "n", long_), (6, "v", long_)]
    packages, place = warc.archive(spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("digest", F.lit(1)))
    got = {(r["page_id"], r["payload_digest"][:6]): r for r in warc.read_packages(packages, place).collect()}
    assert len(got) == len(rows)
    for page, _, html in rows:
        raw = (html or "").encode()
        r = got[(page, hashlib.sha256(raw).hexdigest()[:6])]
        first = page if len(raw) < 100 or page == 1 else 1
        assert (r["payload_bytes"], r["record_type"], r["refers_to"]) == (len(raw), "response" if first == page else "revisit", None if first == page else 1)
        assert r["payload"] is None if r["record_type"] == "revisit" else bytes(r["payload"]) == raw


def test_zip64(tmp_path):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        with z.open(zipfile.ZipInfo("a/ä"), "w", force_zip64=True) as f:
            f.write(b"first")
        z.writestr("b", b"second")
    raw = out.getvalue()
    end = raw.rfind(b"PK\x05\x06")
    count, length, at = 2, int.from_bytes(raw[end + 12 : end + 16], "little"), int.from_bytes(raw[end + 16 : end + 20], "little")
    record = b"PK\x06\x06" + (44).to_bytes(8, "little") + bytes(12) + b"".join(x.to_bytes(8, "little") for x in (count, count, length, at))
    locator = b"PK\x06\x07" + bytes(4) + end.to_bytes(8, "little") + (1).to_bytes(4, "little")
    path = tmp_path / "x.zip"
    path.write_bytes(raw[:end] + record + locator + b"PK\x05\x06" + bytes(4) + b"\xff" * 12 + bytes(2))
    store, root = warc.open_store(str(tmp_path))
    with store.open_input_file(f"{root}/x.zip") as f:
        entries = {name: (warc.stored_at(f, local), size) for name, method, size, _, local in warc.directory(f) if not method}
        assert {n: warc._fetch(f, a, s) for n, (a, s) in entries.items()} == {"a/ä": b"first", "b": b"second"}


def test_tokens_and_packing(spark, docs, texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    plain = Tokenizer.from_file(path)
    odd = [t or "" for t in texts] + ["<|endoftext|> a", "Don'T we'Ll ''s'x ½²", "İi Σς\x85", "x" * 300, "日本 テ"]
    odd += ["a\x1cb \x1f", "a\x85b\xa0c\u2003d\u3000e\u2028f", "e\u0301 \u0301e", "A<|startoftext|>b <|END|>", "\x00\x07 \x7f", "ſ K Å İstanbul ǅ", "x\u200by \ufeffz"]
    assert tokens.encode(odd, path) == [np.asarray(plain.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in odd]
    other = public_tokenizers.path("byte_bpe_50k.json")
    whole = Tokenizer.from_file(other)
    assert tokens.by_chunks(path) and not tokens.by_chunks(other)
    assert tokens.encode(odd, other) == [np.asarray(whole.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in odd]
    rows = packing.packed_pieces(docs, path, 256).collect()
    bins = {}
    for r in rows:
        bins.setdefault(r["sequence_id"], []).append(r)
    for own in bins.values():
        own.sort(key=lambda r: r["offset"])
        assert [r["offset"] for r in own] == [sum(x["length"] for x in own[:i]) for i in range(len(own))] and sum(r["length"] for r in own) <= 256
    total = sum(len(plain.encode(r["text"] or "", add_special_tokens=False).ids) + 1 for r in docs.collect())
    assert sum(r["length"] for r in rows) == total
    assert len(bins) <= packing.lower_bound(np.array([r["length"] for r in rows]), 256) + 2
    assert packing.packed_pieces(docs.limit(0), path).count() == 0


def test_lower_bound():
    rng = np.random.default_rng(4)
    for _ in range(50):
        sizes = rng.integers(1, 101, 30)
        bins, offsets, free = packing.best_fit(sizes, 100)
        assert np.bincount(bins, weights=sizes).max() <= 100 and packing.lower_bound(sizes, 100) <= len(free)
    assert packing.lower_bound(np.array([51] * 7 + [49] * 3), 100) == 7 == len(packing.best_fit(np.array([51] * 7 + [49] * 3), 100)[2])


def test_vectors(spark):
    rng = np.random.default_rng(6)
    base = rng.normal(size=(40, 5))
    v = [*base, *(base[:20] + rng.normal(scale=0.05, size=(20, 5))), *[base[0]] * 5, base[1] * 7]
    rows = [(i, [float(x) for x in w], i % 2 if i < 60 else 0) for i, w in enumerate(v)]
    rows += [(900, None, 0), (901, [0.0] * 5, 0), (902, [float("nan")] * 5, 0), (903, [1.0] * 5, None), (None, [1.0] * 5, 0), (904, [1.0, None], 1)]
    got = {r["id"]: r for r in covertree.near_duplicates(spark.createDataFrame(rows, "id bigint, vector array<double>, label int").withColumn("unit", F.lit(1))).collect()}
    for i, (_, a, label) in enumerate(rows[: len(v)]):
        near = [j for j, (_, b, other) in enumerate(rows[: len(v)]) if j != i and label == other and np.dot(a, b) / np.linalg.norm(a) / np.linalg.norm(b) >= 0.98]
        assert got[i]["n_links"] == len(near), i
        assert all(got[j]["component"] == got[i]["component"] <= i for j in near)
    assert all(got[x]["n_links"] == 0 and got[x]["kept"] for x in (900, 901, 902, 903, None, 904))
    x = rng.normal(size=(300, 8))
    x /= np.linalg.norm(x, axis=1)[:, None]
    a, b = covertree.Tree(x[:150]), covertree.Tree(x[150:])
    met = {(int(i), int(j)) for p, q in covertree.dual(a, b, 0.6) for i in p for j in q}
    assert all((i, j) in met for i, j in zip(*np.nonzero(np.linalg.norm(x[:150, None] - x[150:], axis=2) <= 0.6)))


def linked_vectors(rows):
    """Brute force: the links and the component of every id; rows are (id, vector, label)."""
    links, top = {i: 0 for i, _, _ in rows}, {i: i for i, _, _ in rows}
    pairs = []
    for key in {(label, len(v)) for _, v, label in rows}:
        ids = [i for i, v, label in rows if (label, len(v)) == key]
        x = np.array([v for _, v, label in rows if (label, len(v)) == key])
        x /= np.linalg.norm(x, axis=1)[:, None]
        pairs += [(ids[a], ids[b]) for a, b in np.argwhere(x @ x.T >= 0.98).tolist() if a != b]
    for a, b in pairs:
        links[a] += 1
    while any(top[a] != top[b] for a, b in pairs):
        for a, b in pairs:
            top[a] = top[b] = min(top[a], top[b])
    return {i: (links[i], top[i], top[i] == i) for i in links}


def test_vectors_of_many_cells(spark):
    rng = np.random.default_rng(8)
    rows = [(n, rng.normal(size=4).tolist(), n % 2) for n in range(2 * covertree.CELL + 300)] + [(9000, [1.0, 2.0], 0), (9001, [1.0, 2.01], 0), (9002, [1.0] * 7, 1)]
    out = covertree.near_duplicates(spark.createDataFrame(rows, "id bigint, vector array<double>, label int")).collect()
    assert {r["id"]: (r["n_links"], r["component"], r["kept"]) for r in out} == linked_vectors(rows) and len(out) == len(rows)


def test_vectors_of_repeated_ids(spark):
    rng = np.random.default_rng(9)
    rows = [(n % 40 if n % 3 else n, rng.normal(size=3).tolist(), n % 2) for n in range(2 * covertree.CELL + 900)]
    rows += [(0, rows[n][1], rows[n][2]) for n in range(0, 300, 7)] + [rows[5]] * 3
    out = covertree.near_duplicates(spark.createDataFrame(rows, "id bigint, vector array<double>, label int")).collect()
    want = linked_vectors(rows)
    assert all((r["n_links"], r["component"], r["kept"]) == want[r["id"]] for r in out) and len(out) == len(rows)


def test_pivots_of_labels():
    unit = [[1.0, 0.0], [1.0, 0.0], [0.0, 1.0], [0.6, 0.0, 0.8]]
    pivots = [[[1.0, 0.0], [0.0, 1.0]], [[0.0, 1.0], [1.0, 0.0]], [[0.0, 1.0], [1.0, 0.0]], None]
    batch = pa.RecordBatch.from_pydict({"label": ["a", "b", "b", "c"], "node": [1, 2, 3, 4], "id": [1, 2, 3, 4], "rows": [1] * 4, "unit": unit, "cell": [0] * 4, "pivots": pivots})
    for part in (batch, batch.slice(1)):
        (got,) = covertree._assign(iter([part]))
        assert got.column("cell").to_pylist() == [1, 2, 1, 0][-part.num_rows :]


def test_vectors_of_many_tiles(spark, monkeypatch):
    for name, value in (("CELL", 64), ("TILE", 1), ("FAN", 2)):
        monkeypatch.setattr(covertree, name, value)
    rng = np.random.default_rng(10)
    base = rng.normal(size=(30, 6))
    rows = [(n, (base[n % 30] + rng.normal(scale=0.08, size=6)).tolist(), int(n % 30 > 20)) for n in range(1500)] + [(n, [float(n), 1.0], 2) for n in range(40)]
    out = covertree.near_duplicates(spark.createDataFrame(rows, "id bigint, vector array<double>, label int")).collect()
    assert {r["id"]: (r["n_links"], r["component"], r["kept"]) for r in out} == linked_vectors(rows) and len(out) == len(rows)
    heads = [("a", n, [float(10 * (n // 4)), float(n)], 1.0) for n in range(64)]
    pairs = covertree._descended(spark.createDataFrame(heads, "label string, pos bigint, center array<double>, radius double"), 0.5).collect()
    want = {(i, j) for i in range(64) for j in range(i, 64) if np.hypot(10 * (i // 4) - 10 * (j // 4), i - j) <= 2.5}
    assert {(r["a"], r["b"]) for r in pairs} == want and len(pairs) == len(want)


def test_cover_tree_prunes():
    rng = np.random.default_rng(11)
    x = np.repeat(rng.normal(size=(20, 8)), 100, axis=0) + rng.normal(scale=1e-3, size=(2000, 8))
    x /= np.linalg.norm(x, axis=1)[:, None]
    tree = covertree.Tree(x)
    assert sorted(tree.order.tolist()) == list(range(2000)) and len(tree.nodes) > 20
    met = [(p, q) for p, q in covertree.dual(tree, tree, 0.05)]
    assert sum(len(p) * len(q) for p, q in met) < 2000 * 2000 / 8
    seen = {frozenset((int(i), int(j))) for p, q in met for i in p for j in q}
    assert all(frozenset((int(i), int(j))) in seen for i, j in zip(*np.nonzero(np.linalg.norm(x[:, None] - x, axis=2) <= 0.05)))
    other = covertree.Tree(x, tree.nodes, tree.order)
    assert [(p.tolist(), q.tolist()) for p, q in covertree.dual(other, other, 0.05)] == [(p.tolist(), q.tolist()) for p, q in met]
