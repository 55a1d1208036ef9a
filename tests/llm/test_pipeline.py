"""The stages of the pipeline on a small corpus, each against a plain version: null ids, repeated rows, clashing names, no rows."""

import random
from collections import Counter

import numpy as np
import pytest
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline

from .test_operators import WORDS, sentence, shingle_set

#: named like working columns of the operators
EXTRA = ["row", "size", "kept", "copies", "rest", "score", "node", "batch"]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(f"{c} int" for c in EXTRA)


def corpus():
    rng = random.Random(11)
    good = [sentence(rng, rng.randrange(40, 90)).capitalize() + "." for _ in range(60)]
    junk = [" ".join(rng.choice(["###", "$$$ %%%", "&&&", "***"]) for _ in range(40)) + str(i) for i in range(30)]
    shared = " ".join(f"shared{i}" for i in range(12))
    near = [" ".join(w if i != 20 else "other" for i, w in enumerate(t.split())) for t in good[:8]]
    texts = good + near + [good[9]] * 3 + [f"{sentence(rng, 25)} {shared} {sentence(rng, 25)}." for _ in range(5)] + junk + [None, "", sentence(rng, 5000)]
    rows = [(i, t, "en", [None, "a", "b", "hot", "hot"][i % 5], len(t or ""), *range(len(EXTRA))) for i, t in enumerate(texts)]
    rows += [(None, good[3], None, "a", 1, *range(len(EXTRA))), (None, None, None, None, None, *[None] * len(EXTRA)), rows[5], rows[5]]
    labels = [(r[0], int("##" not in r[1] and "$$" not in r[1])) for r in rows if r[0] is not None and r[1]]
    return rows, sorted(set(labels))


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Rows before and after every stage."""
    folder = str(tmp_path_factory.mktemp("tables"))
    rows, labels = corpus()
    docs = spark.createDataFrame(rows, SCHEMA)
    spark.createDataFrame(labels, "doc_id bigint, quality int").write.parquet(f"{folder}/labels.parquet")
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        after = corpus_pipeline.materialize(stage(spark, docs, folder), name)
        assert name == "pack" or after.schema.simpleString() == docs.schema.simpleString()
        out[name] = ([tuple(r) for r in docs.collect()], after.collect())
        docs = after
    return out


def test_quality_keeps_rows_as_they_are(stages):
    before, after = stages["quality"]
    after = [tuple(r) for r in after]
    assert not Counter(after) - Counter(before)
    gone = Counter(before) - Counter(after)
    assert all(not r[1] or "##" in r[1] or "$$" in r[1] or "&&" in r[1] for r in gone)
    assert sum(gone.values()) >= 25 and sum("###" in (r[1] or "") for r in after) <= 3


def test_near_copies_against_all_pairs(stages):
    before, after = stages["near_copies"]
    sets = [(r[0], shingle_set(r[1])) for r in before if r[0] is not None]
    top = {i: i for i, _ in sets}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                x, y = sorted((find(i), find(j)))
                top[y] = x
    want = Counter(r for r in before if r[0] is None or find(r[0]) == r[0])
    assert Counter(tuple(r) for r in after) == want and sum(want.values()) < len(before)


def test_repeats_against_all_windows(stages):
    before, after = stages["repeats"]
    owner = {}
    for r in before:
        b = (r[1] or "").encode()
        for p in range(len(b) - 49):
            if r[0] is not None:
                owner[b[p : p + 50]] = min(owner.get(b[p : p + 50], r[0]), r[0])
    want = Counter()
    for r in before:
        b = (r[1] or "").encode()
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - 49):
            if r[0] is not None and owner[b[p : p + 50]] < r[0]:
                gone[p : p + 50] = True
        kept = bytes(np.frombuffer(b, np.uint8)[~gone]).decode()
        want[(r[0], kept, *r[2:4], len(kept), *r[5:])] += 1
    own = lambda rows: Counter({r: n for r, n in rows.items() if r[0] is not None})
    got = Counter(tuple(r) for r in after)
    assert own(got) == own(want) and sum(got.values()) == len(before)
    assert any("shared" in (r[1] or "") for r in before) and sum("shared5" in (r[1] or "") for r in after) == 1


def test_mix_takes_whole_rows(stages):
    before, after = stages["mix"]
    had, took = Counter(before), Counter(tuple(r) for r in after)
    assert set(took) <= set(had) and all(n <= 3 * had[r] for r, n in took.items())
    words = lambda rows: sum(len(WORDS.findall(r[1] or "")) * n for r, n in rows.items())
    longest = max(len(WORDS.findall(r[1] or "")) for r in before)
    assert abs(words(took) - words(had)) <= 3 * longest


def test_pack_keeps_every_token(stages):
    before, after = stages["pack"]
    plain = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = Counter()
    for r in before:
        want[r[0]] += len(plain.encode(r[1] or "", add_special_tokens=False).ids) + 1
    got, bins = Counter(), {}
    for r in after:
        got[r["doc_id"]] += r["length"]
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert got == want
    for own in bins.values():
        own.sort()
        assert [o for o, _ in own] == [sum(n for _, n in own[:i]) for i in range(len(own))] and sum(n for _, n in own) <= 2048


def test_no_documents(spark, tmp_path):
    spark.createDataFrame([], "doc_id bigint, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.createDataFrame([], SCHEMA)
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialize(stage(spark, docs, str(tmp_path)), name)
    assert docs.count() == 0
