from __future__ import annotations

import random
import re

import corpus_pipeline
import pytest
from pyspark.sql import functions as F
from tests.llm.test_mixing import filled
from tests.llm.test_setsketch import reference_groups

from tidemark.llm import catalog, toxicity

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def written(df, spark, path):
    df.write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def test_stages_are_the_ones_asked_for():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "pii", "mixing", "packing"]


def test_toxic_documents_go(spark, sf_dir, docs):
    kept = corpus_pipeline.toxicity_filter(spark, docs, sf_dir)
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scores = {r[0]: r[1] for r in docs.select("doc_id", toxicity.score("text", model)).collect()}
    assert kept.columns == COLUMNS
    assert sorted(r[0] for r in kept.select("doc_id").collect()) == sorted(i for i, s in scores.items() if s < 0.5)


def test_one_document_of_each_group_stays(spark, sf_dir):
    rng = random.Random(6)
    base = [f"w{rng.randint(0, 50)}" for _ in range(60)]
    rows = [(i, " ".join([*base[:i], f"x{i}", *base[i + 1 :]])) for i in range(8)] + [(30, "lone words that stand alone")]
    rows += [(0, rows[0][1])] * 3 + [(0, rows[1][1])] + [(40, ""), (40, ""), (41, None), (None, None), (None, "same null id text here")] * 2
    full = [(i, t, "en", rng.choice(["a", None]), 1) for i, t in rows]
    docs = spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.near_dedup(spark, docs, sf_dir)
    got = [(r["doc_id"], r["text"]) for r in kept.collect()]
    first = [t for i, t in got if i == 0]
    assert len(first) == 1 and first[0] in {t for i, t in rows if i == 0}
    rest = [(i, t) for i, t in rows if not t] + [(30, "lone words that stand alone"), (None, "same null id text here")]
    assert sorted(map(str, [x for x in got if x[0] != 0])) == sorted(map(str, rest))


def test_personal_data_is_masked(spark, sf_dir, docs):
    out = corpus_pipeline.mask_pii(spark, docs, sf_dir)
    assert out.columns == COLUMNS and out.count() == docs.count()
    pattern = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
    before = {r["doc_id"]: r["text"] for r in docs.collect()}
    changed = 0
    for r in out.collect():
        assert not re.search(pattern, r["text"]) and r["n_chars"] == len(r["text"])
        emails = len(list(re.finditer(pattern, before[r["doc_id"]])))
        assert r["text"].count("[EMAIL]") >= emails
        changed += r["text"] != before[r["doc_id"]]
        if not re.search(r"[0-9@]", before[r["doc_id"]]):
            assert r["text"] == before[r["doc_id"]]
    assert 0 < changed < len(before) / 2


def test_mix_repeats_documents(spark, sf_dir):
    rng = random.Random(8)
    rows = [(i, "w " * rng.randint(0, 9), "en", rng.choice(["a", "b", "c", None]), 1) for i in range(200)]
    rows += [(5000, "p q r", "en", "a", 1)] * 4
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    out = corpus_pipeline.mix_sources(spark, docs, sf_dir)
    assert out.columns == COLUMNS
    sizes, taken = {}, {}
    for _, t, _, s, _ in rows:
        sizes[s] = sizes.get(s, 0) + len(t.split())
    for r in out.collect():
        taken[r["source"]] = taken.get(r["source"], 0) + len(r["text"].split())
    for s, target in filled(sizes, (5, 2, 1), 1.5, 2).items():
        assert abs(taken.get(s, 0) - target) <= 5


CLASHES = """_key _again _alone _rows _copies _own _copy _found base_spans all_spans _toxicity toxicity row key alone again rows
copies own copy group kept row_key size target""".split()


@pytest.mark.parametrize("stage", [f for _, f in corpus_pipeline.STAGES[:-1]])
def test_clashing_columns_pass_unchanged(spark, sf_dir, docs, stage):
    few = docs.where("doc_id < 60")
    clash = few.withColumns({c: F.concat(F.lit(f"{c}-"), F.col("doc_id").cast("string")) for c in CLASHES})
    out = stage(spark, clash, sf_dir)
    assert out.columns == clash.columns
    rows = out.collect()
    assert rows and all(r[c] == f"{c}-{r['doc_id']}" for r in rows for c in CLASHES)
    plain = stage(spark, few, sf_dir)
    assert sorted(map(str, plain.collect())) == sorted(map(str, out.select(*few.columns).collect()))


@pytest.mark.parametrize("stage", [f for _, f in corpus_pipeline.STAGES])
def test_no_documents(spark, sf_dir, docs, stage):
    assert stage(spark, docs.limit(0), sf_dir).count() == 0


def test_run(spark, sf_dir, docs, tmp_path):
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    step = docs
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        step = written(stage(spark, step, sf_dir), spark, str(tmp_path / str(i)))
    assert sorted(map(str, rows)) == sorted(map(str, step.collect()))


def test_query_of_each_operator():
    assert [n.split("_")[0] for n in catalog.QUERIES] == [f"op{i}" for i in range(1, 14)]
    assert set(catalog.ORACLE) <= set(catalog.QUERIES)


def test_dedup_query_equals_all_pairs(spark, sf_dir, docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = [tuple(r) for r in catalog.op3_setsketch_dedup(spark, sf_dir).collect()]
    assert sorted(got, key=str) == reference_groups(rows)
