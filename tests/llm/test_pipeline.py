"""The pipeline's stages against a brute-force version of each, on whole texts."""

from __future__ import annotations

import sys
from pathlib import Path

import numpy as np
import public_tokenizers
import tiktoken
from conftest import DATA

sys.path.insert(0, str(Path(__file__).parent))

from test_exact_and_near import exact_brute, key, near_brute
from test_text_models import basics

import corpus_pipeline as cp
from tallgrass.llm import byte_bpe, common, quality_rules, source_mixing


def test_stages(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    steps = [docs]
    for _, stage in cp.STAGES:
        steps.append(common.stored(stage(spark, steps[-1], DATA)))
        assert steps[-1].columns == docs.columns or len(steps) == len(cp.STAGES) + 1
    rows = [[tuple(r) for r in s.collect()] for s in steps[:-1]]

    def pairs(x):
        return [(r[0], r[1]) for r in x]

    # quality rules: what fails the base rules goes; what stays is what the operator keeps
    kept = {r["doc_id"] for r in quality_rules.quality_rules(docs).where("kept").collect()}
    assert {r[0] for r in rows[1]} == kept
    for i, x in pairs(rows[0]):
        n, *_, repeated = basics(x)
        assert i not in kept or not (n < 20 or 100 * repeated > 30 * n)

    best = exact_brute(pairs(rows[1]))
    assert sorted(r[0] for r in rows[2]) == sorted(k for k, _ in best.values())
    assert len({key(r[1]) for r in rows[2]}) == len(rows[2])

    assert sorted(r[0] for r in rows[3]) == sorted({x[4] for x in near_brute(pairs(rows[2]))})

    words = {r[0]: basics(r[1])[0] for r in rows[3]}
    _, _, targets = source_mixing.mix(steps[3])
    for t in targets.collect():
        got = sum(words[r[0]] for r in rows[4] if r[3] == t["source"])
        assert abs(got - t["target"]) <= max(words.values())
    assert max(sum(r[0] == i for r in rows[4]) for i in words) <= 2

    ranks = {t: i for i, t in enumerate(byte_bpe.read_ranks(public_tokenizers.path(cp.VOCABULARY)))}
    judge = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    text = dict(pairs(rows[4]))
    last = steps[-1].collect()
    assert sorted(r["doc_id"] for r in last) == sorted(r[0] for r in rows[4])
    for r in last:
        assert r["ids"] == judge.encode_ordinary(text[r["doc_id"]]) and r["n_tokens"] == len(r["ids"])
    assert np.sum([r["n_tokens"] for r in last]) > 0

    whole = sorted((r["doc_id"], r["ids_sha256"]) for r in cp.run(spark, DATA).collect())
    assert whole == sorted((r["doc_id"], r["ids_sha256"]) for r in last)


def test_empty(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").limit(0)
    for _, stage in cp.STAGES:
        docs = common.stored(stage(spark, docs, DATA))
    assert docs.count() == 0


def test_odd_rows(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    more = spark.createDataFrame([(None, None, None, None, None), (7, None, "en", None, 0), (7, None, "en", None, 0), (None, "word " * 5, None, "s", 1)], docs.schema)
    docs = docs.unionByName(more).unionByName(docs.limit(5))
    for _, stage in cp.STAGES:
        docs = common.stored(stage(spark, docs, DATA))
    assert docs.count() > 0
