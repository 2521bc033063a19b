"""The queries of the operators against their SQL, and the pipeline stage by stage."""

import os
import random

import corpus_pipeline as pipeline
import numpy as np
import pytest
from check_queries import compare, connect
from pyspark.sql import functions as F
from repledger.llm.queries import ORACLES, QUERIES
from test_pairs import groups, repeats

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_sql(spark, name):
    ok, message = compare(spark, connect(SF), name, SF)
    assert ok, message


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_native_queries_have_no_python_in_their_plans(spark):
    for name in ("op1_quality", "op4_licences"):
        plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


@pytest.fixture(scope="module")
def kept(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("stages"))
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for k, (_, fn) in enumerate(pipeline.STAGES):
        fn(spark, docs, SF).write.parquet(os.path.join(folder, str(k)))
        docs = spark.read.parquet(os.path.join(folder, str(k)))
        out.append(docs)
    return [spark.read.parquet(f"{SF}/documents.parquet"), *out]


def test_stages_keep_what_they_should(kept):
    tables = [df.toPandas() for df in kept]
    start, language, jaccard, substrings, mixed, pieces = tables
    assert all(list(t.columns) == list(start.columns) for t in tables[1:5])
    letters = start[start.text.map(lambda t: any(c.isalpha() for c in t))]
    assert len(language) >= 0.97 * len(letters) and set(language.doc_id) <= set(letters.doc_id)
    want = {i for i, _, c in groups(list(language.doc_id), list(language.text), percent=80, shingle=5) if i == c}
    assert set(jaccard.doc_id) == want and len(jaccard) == len(want)
    for (_, row), (n, gone, text) in zip(jaccard.iterrows(), repeats(list(jaccard.text), 35)):
        now = substrings[substrings.doc_id == row.doc_id].iloc[0]
        assert now.text == (text if gone else row.text) and now.n_chars == len(now.text)
    size = substrings.text.map(lambda t: len(t.split()))
    assert set(mixed.doc_id) <= set(substrings.doc_id[size > 0]) and mixed.doc_id.value_counts().max() <= 3
    taken = mixed.groupby("source", dropna=False).text.apply(lambda x: x.map(lambda t: len(t.split())).sum()).sum()
    assert taken == pytest.approx(size.sum(), rel=0.1)
    ids = pieces.groupby("sequence_id").length.sum().sort_index()
    assert (ids.iloc[:-1] == 4096).all() and ids.iloc[-1] <= 4096
    assert pieces[pieces.start == 0].doc_id.value_counts().to_dict() == mixed.doc_id.value_counts().to_dict()


def test_near_copies_of_the_pipeline(spark):
    """Texts with their last part replaced: 5-word similarities on either side of 80 per cent."""
    rng = random.Random(8)
    rows, kept = [], set()
    for k, share in enumerate((0.04, 0.08, 0.1, 0.105, 0.13, 0.2)):
        text = [f"w{rng.randint(0, 10**6)}" for _ in range(400)]
        at = round(400 * (1 - share))
        other = text[:at] + [f"v{rng.randint(0, 10**6)}" for _ in range(400 - at)]
        one, two = ({tuple(w[j : j + 5]) for j in range(396)} for w in (text, other))
        kept |= {2 * k} if 100 * len(one & two) >= 80 * len(one | two) else {2 * k, 2 * k + 1}
        rows += [(2 * k, " ".join(text)), (2 * k + 1, " ".join(other))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = pipeline.one_of_each(spark, docs, SF)
    assert sorted(r.doc_id for r in got.collect()) == sorted(kept) and {1, 3, 5, 7} & kept == set() and {9, 11} <= kept


def test_copies_that_share_an_id(spark):
    """Of rows of one id, only those go whose own text is a copy; near copies of one id are one."""
    rng = random.Random(11)
    a, b, c = ([f"w{rng.randint(0, 10**6)}" for _ in range(100)] for _ in range(3))
    near = " ".join([*c, "more"])
    a, b, c = " ".join(a), " ".join(b), " ".join(c)
    rows = [(1, a, "en"), (2, a, "en"), (2, b, "en"), (3, c, "en"), (3, near, "en"), (3, c, "fr"), (4, b, "en"), (None, a, "en"),
            (5, None, "en"), (5, None, "fr"), (5, None, "fr")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = [tuple(r) for r in pipeline.one_of_each(spark, docs, SF).collect()]
    threes = [r for r in got if r[0] == 3]
    assert len(threes) == 1 and threes[0] in rows
    assert sorted(map(str, got)) == sorted(map(str, [(1, a, "en"), (2, b, "en"), *threes, (None, a, "en"), (5, None, "en"), (5, None, "fr")]))


@pytest.mark.parametrize("stage", range(5))
def test_stages_take_any_rows(spark, nasty, stage):
    columns = ["doc_id", "text", "lang", "source"]
    docs = nasty.select(*columns, F.length("text").cast("long").alias("n_chars"), F.lit("x").alias("part"), F.lit(1).alias("n"))
    fn = pipeline.STAGES[stage][1]
    out = fn(spark, docs, SF)
    assert out.count() > 0
    if stage < 4:
        assert out.columns == docs.columns
    assert fn(spark, docs.where("false"), SF).count() == 0


def test_run(spark, kept):
    got = pipeline.run(spark, SF)
    assert got.columns == kept[-1].columns and got.count() == kept[-1].count()
    total = got.agg(F.sum("length")).first()[0]
    assert got.agg(F.max(F.col("sequence_id") * 4096 + F.col("offset") + F.col("length"))).first()[0] == total
    assert np.isfinite(total)
