"""The pipeline's stages against brute force on a small corpus, and the shared Viterbi."""

from __future__ import annotations

import random
import re
from collections import Counter
from itertools import product

import numpy as np
import pytest
from test_llm_operators import brute_components, words

import corpus_pipeline
from hazardbook.llm import mixing
from hazardbook.llm.common import viterbi

EN = "the and with that from this have which their would there about other into than".split()


@pytest.fixture(scope="module")
def corpus(spark, docs_of, tmp_path_factory):
    rng = random.Random(99)
    base = [" ".join(rng.choice(EN) + f" {rng.choice('bcdfg')}{rng.choice('aeiou')}{rng.choice('lmnr')}{rng.choice('aeiou')}" for _ in range(60)) for _ in range(40)]
    rows = [(i, t, "en", rng.choice(["a", "b", None])) for i, t in enumerate(base)]
    for i in range(40):
        copy = base[i % 10].split()
        if i % 3:
            copy[rng.randrange(len(copy))] = "changed"
        rows.append((100 + i, " ".join(copy), "en", "a"))
    rows += [(200, None, None, "a"), (201, "", "en", None), (202, "12 34 !!", None, "b"), (203, base[0], "en", "c")]
    folder = str(tmp_path_factory.mktemp("corpus"))
    docs_of(rows).write.parquet(f"{folder}/documents.parquet")
    items = [(1, " ".join(base[20].split()[5:45])), (2, words(rng, 40))]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, rows, items


def ids(docs):
    return sorted(r["doc_id"] for r in docs.select("doc_id").collect())


def test_every_stage_equals_brute_force(spark, corpus):
    folder, rows, items = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    spoken = stages["language_id"](spark, docs, folder)
    assert ids(spoken) == sorted(i for i, t, *_ in rows if t and re.search("[a-z]", t))
    alone = stages["ngram_jaccard_join"](spark, spoken, folder)
    kept = brute_components([(i, t) for i, t, *_ in rows if i in set(ids(spoken))], 5, 80)
    assert ids(alone) == sorted(i for i, (_, component) in kept.items() if i == component)
    clean = stages["benchmark_decontamination"](spark, alone, folder)
    texts = {i: t for i, t, *_ in rows}
    assert ids(clean) == [i for i in ids(alone) if items[0][1] not in texts[i]]
    mixed = stages["mixing"](spark, clean, folder)
    plan = mixing.mix_plan(clean, "doc_id", "text", "source").collect()
    assert Counter(ids(mixed)) == Counter({r["doc_id"]: r["copies"] for r in plan if r["copies"]})
    for target in {r["target"] for r in plan}:
        of = [r for r in plan if r["target"] == target]
        assert abs(sum(r["size"] * r["copies"] for r in of) - target) <= max(r["size"] for r in of)
    dealt = stages["sharding"](spark, mixed, folder).collect()
    assert sorted(r["doc_id"] for r in dealt) == ids(mixed)
    slots: dict[int, list[int]] = {}
    for r in dealt:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert set(slots) <= set(range(corpus_pipeline.SHARDS))


def test_run_applies_the_stages_to_a_whole_corpus(spark, corpus):
    folder, _, _ = corpus
    once, again = (corpus_pipeline.run(spark, folder) for _ in range(2))
    assert once.count() > 0 and sorted(map(repr, once.collect())) == sorted(map(repr, again.collect()))


def test_stages_take_an_empty_table(spark, corpus, docs_of):
    folder, _, _ = corpus
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs_of([]), folder).count() == 0, name


def test_shared_viterbi_equals_brute_force():
    rng = np.random.default_rng(5)
    for _ in range(20):
        moves, opening = rng.normal(size=(3, 3)), rng.normal(size=3)
        runs = [rng.normal(size=(n, 3)) for n in (1, 4, 2, 6, 4)]
        found = viterbi(runs, moves, opening)
        for emit, path in zip(runs, found, strict=True):
            def value(p, emit=emit, moves=moves, opening=opening):
                return opening[p[0]] + sum(emit[t, s] for t, s in enumerate(p)) + sum(moves[a, b] for a, b in zip(p, p[1:], strict=False))

            assert tuple(path) == max(product(range(3), repeat=len(emit)), key=value)
    assert viterbi([], np.zeros((2, 2)), np.zeros(2)) == []
