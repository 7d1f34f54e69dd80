"""Every operator and stage on nulls, empty and very long texts, ties, repeated
rows, clashing column names and empty tables."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from dockcast.llm import bpe, decontam, hyperminhash, langid, line_rules, mixing, queries, rff_quality, rlbwt, secret_scan, superkmer

ITEMS = [(1, " ".join(f"w{i}x{i % 13}" for i in range(11))), (2, None), (None, ""), (3, "élève")]


@pytest.fixture(scope="module")
def run(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    labels = spark.createDataFrame([(1, 0, 0), (3, 1, 0), (5, 1, 1), (6, None, 0), (None, 1, 0), (7, 0, 0), (8, 1, 0), (3, 0, 0)], "doc_id long, quality int, toxic int")
    return {1: mixing.mix, 2: superkmer.dedup_words, 3: lambda d: bpe.count_tokens(d, queries.tokenizer_path("word_bpe_49k.json")), 4: lambda d: decontam.find_leaks(d, items),
            5: lambda d: rff_quality.score_quality(d, labels), 6: rlbwt.dedup_bytes, 7: hyperminhash.near_duplicates, 8: secret_scan.find_secrets, 9: line_rules.line_rules, 10: langid.identify}


def by_id(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["doc_id"], []).append(r)
    return out


@pytest.mark.parametrize("op", range(1, 11))
def test_odd_rows(run, make_docs, odd_rows, op):
    plain = run[op](make_docs(odd_rows))
    got = sorted(map(repr, plain.collect()))
    assert len(got) == len(odd_rows)
    clash = run[op](make_docs(odd_rows, clash=True))
    assert clash.columns == plain.columns
    assert sorted(map(repr, clash.collect())) == got


@pytest.mark.parametrize("op", range(1, 11))
def test_empty_table(run, make_docs, op):
    assert run[op](make_docs([])).collect() == []


def test_defined_results(run, make_docs, odd_rows):
    docs = make_docs(odd_rows)
    x = by_id(run[1](docs))
    assert [(r.size, r.taken) for r in x[2]] == [(0, 0)] and len(x[None]) == 2
    x = by_id(run[2](docs))
    assert [r.n_removed for r in x[3]] == [0, 0]  # one id: not a smaller one
    assert x[1][0].n_words == 0 and x[2][0].n_words == 0
    x = by_id(run[3](docs))
    assert (x[2][0].n_bytes, x[2][0].n_tokens, x[2][0].over_limit) == (0, 0, False) and x[3][0].over_limit
    x = by_id(run[4](docs))
    assert x[3][0].contaminated and x[3][0].longest == 11 and x[3][0]["items"] == ["1"]
    assert x[8][0].n_hit == 1 and not x[2][0].contaminated
    x = by_id(run[6](docs))
    assert all(r.n_removed == r.n_bytes for r in x[3])  # repeated rows are occurrences
    assert x[7][0].n_removed == 1000 and x[7][0].n_spans == 1
    x = by_id(run[7](docs))
    assert {r.component_id for r in x[3]} == {3} and x[5][0].component_id == 5 and x[6][0].component_id == 5 and not x[6][0].kept
    assert x[1][0].n_shingles == 0 and x[1][0].kept and all(r.component_id is None and r.kept for r in x[None])
    x = by_id(run[8](docs))
    assert x[2][0].spans == ""
    x = by_id(run[9](docs))
    assert x[2][0].base_failed and not x[2][0].kept and x[3][0].kept and x[7][0].n_repeat_words == 500
    x = by_id(run[10](docs))
    assert x[2][0].lang_pred == "und" and x[4][0].lang_pred == "und" and x[2][0].score == 0.0


def test_no_labels_no_training(spark, make_docs, odd_rows):
    docs = make_docs(odd_rows)
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in rff_quality.score_quality(docs, none).collect()} == {0.5}
    assert {r.lang_pred for r in langid.identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    empty = spark.createDataFrame([], "item_id long, text string")
    assert not any(r.contaminated for r in decontam.find_leaks(docs, empty).collect())


@pytest.mark.parametrize("stage", [s for s, _ in corpus_pipeline.STAGES])
def test_stages(spark, make_docs, odd_rows, stage):
    f = dict(corpus_pipeline.STAGES)[stage]
    sf = "/root/testdata/sf0.001"
    for rows in (odd_rows, []):
        docs = make_docs(rows, clash=True)
        out = f(spark, docs, sf)
        got = out.collect()
        assert len(got) <= len(rows)
        if stage != corpus_pipeline.STAGES[-1][0]:
            assert out.dtypes == docs.dtypes


def test_one_row_of_each_group_stays(spark, make_docs):
    """Copies that share an id, or have none, and links from 0.8 on."""
    base = " ".join(f"w{i}" for i in range(104))  # 100 shingles
    near = " ".join(f"w{i}" if i != 50 else "x" for i in range(104))  # 95 of 105 shingles shared
    loose = " ".join(f"w{i}" if i not in (20, 70) else "y" for i in range(104))  # 90 of 110 shared: 0.818
    rows = [(4, "one two three four five six")] * 4 + [(None, "seven eight nine ten eleven twelve", "de", "s1")] * 5 + [(7, base), (8, near), (9, base), (10, loose), (11, None), (11, None), (12, "")]
    f = dict(corpus_pipeline.STAGES)["MinHash near-dedup"]
    docs = make_docs(rows, clash=True)
    got = f(spark, docs, "/root/testdata/sf0.001")
    assert got.dtypes == docs.dtypes
    assert sorted(map(repr, ((r.doc_id, r.text) for r in got.collect()))) == sorted(map(repr, [(4, rows[0][1]), (None, rows[4][1]), (7, base), (11, None), (12, "")]))


@pytest.mark.parametrize("ids", ["one", "none", "copies"])
def test_mix_meets_its_targets_with_repeated_ids(spark, make_docs, ids):
    import random
    rng = random.Random(6)
    rows = []
    for s in ("a", "b", "c"):
        for i in range(1000):
            text = " ".join(["w"] * rng.randrange(5, 200)) if ids != "copies" or i >= 600 else "same words " * 40
            rows.append(({"one": 5, "none": None, "copies": 5}[ids] if i < 600 else i, text, "en", s))
    got = mixing.mix(make_docs(rows)).groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target")).collect()
    longest = max(len(r[1].split()) for r in rows)
    assert all(abs(r.taken - r.target) <= max(0.01 * r.target, longest) for r in got), got
    assert sorted(map(repr, mixing.mix(make_docs(rows)).collect())) == sorted(map(repr, mixing.mix(make_docs(rows[::-1])).collect()))
