"""The reconciled edge gate: lost, surplus and unscored rows fail; generated cases."""

from __future__ import annotations

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from textlab.operators.gate import reconciled_edge_gate
from textlab.sources import views
from textlab.sources.readers import read_table

SENT = "id long, case string"
BACK = "id long, case string, prediction int, score double"


def _gate(spark, sent, back):
    rows = reconciled_edge_gate(spark.createDataFrame(sent, SENT), spark.createDataFrame(back, BACK)).collect()
    return {r.rule: (r.observed, r.passed, r.failing) for r in rows}


def test_all_scored_rows_pass_and_a_lost_input_fails_its_rule(spark):
    sent = [(1, "a"), (2, "a"), (None, "b"), (4, "b"), (4, "b")]
    back = [(i, c, k % 2, 0.5) for k, (i, c) in enumerate(sent)]
    good = _gate(spark, sent, back)
    assert good == {
        "scores_a": (2.0, True, 0), "scores_b": (3.0, True, 0), "no_extra_rows": (0.0, True, 0),
        "mixed_batch_ratio": (0.4, True, 0),
    }
    for lost, rule in ((0, "scores_a"), (2, "scores_b"), (4, "scores_b")):
        got = _gate(spark, sent, back[:lost] + back[lost + 1 :])
        assert not got[rule][1] and got[rule][2] == 1
        assert all(p for r, (_, p, _f) in got.items() if r not in (rule, "mixed_batch_ratio"))


def test_surplus_unscored_and_unknown_rows(spark):
    sent = [(1, "a"), (2, "a"), (3, "a")]
    got = _gate(spark, sent, [(1, "a", 1, 1.5), (2, "a", None, 0.5), (3, "a", 0, None), (3, "a", 0, 0.5), (9, "z", 1, 0.5)])
    # of id 3 one of two rows has no score; 1 is out of range, 2 has no prediction
    assert got["scores_a"] == (3.0, False, 3) and got["scores_z"] == (0.0, False, 0)
    assert got["no_extra_rows"] == (2.0, False, 2)
    one_sided = _gate(spark, sent, [(i, c, 1, 0.9) for i, c in sent])
    assert one_sided["mixed_batch_ratio"] == (1.0, False, 0) and one_sided["scores_a"][1]


def test_nothing_sent_and_nothing_scored(spark):
    assert _gate(spark, [], []) == {"no_extra_rows": (0.0, True, 0), "mixed_batch_ratio": (None, False, 0)}
    assert _gate(spark, [(1, "a")], [])["scores_a"] == (1.0, False, 1)


def test_generated_cases(spark):
    docs = read_table(spark, SF_SMALL, "documents")
    cases = views.edge_inputs(spark, SF_SMALL)
    n, other = docs.count(), docs.filter("lang <> 'en'").count()
    got = {r["case"]: r["count"] for r in cases.groupBy("case").count().collect()}
    assert got == {"missing_title": n, "repeated_text": n, "mixed_batch": n, "other_language": other}
    assert cases.filter("case = 'missing_title' and title is not null").count() == 0
    long = cases.filter("case = 'repeated_text'").join(docs.withColumnRenamed("doc_id", "id").drop("text"), "id")
    assert long.filter(F.length("text") != F.lit(200) * (F.least("n_chars", F.lit(40)) + F.lit(1))).count() == 0


def test_scored_rows_are_computed_once(spark):
    def through(batches):
        yield from batches

    sent = spark.createDataFrame([(1, "a"), (2, None)], SENT)
    back = spark.createDataFrame([(1, "a", 1, 0.5)], BACK).mapInArrow(through, BACK)
    plan = reconciled_edge_gate(sent, back)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1
    assert _gate(spark, sent.collect(), back.collect()) == {
        "scores_a": (1.0, True, 0), "scores_no_case": (1.0, False, 1), "no_extra_rows": (0.0, True, 0),
        "mixed_batch_ratio": (1.0, False, 0),
    }


def test_bulk_scores_equal_the_models_own_without_its_stages(spark):
    from textlab.config import TrainConfig
    from textlab.operators.score import model_input, positive_probability, score
    from textlab.plans.train import fit_pipeline

    titles, texts = [None, "", "A  title", "<b>", "é"], [None, "", "  ", "the the", "Good <i>bad</i> ugly!! x1", "ß" * 9, "bad " * 300 + "y" * 70]
    rows = [(i, t, x) for i, (t, x) in enumerate((t, x) for t in titles for x in texts)]
    docs = spark.createDataFrame(rows, "id long, title string, text string").repartition(3)
    train = model_input(docs, "title", "text").withColumn("label", (F.col("id") % 3 == 0).cast("double"))
    model = fit_pipeline(train, TrainConfig(num_features=1 << 10, min_doc_freq=1, max_iter=9), 0.01, 0.0)
    want = {r.id: r for r in model.transform(train).select("id", "prediction", positive_probability().alias("score")).collect()}
    scored = score(docs, model, id_col="id")
    got = scored.collect()
    assert len(got) == len(want) == len(rows)
    for r in got:
        assert r.prediction == want[r.id].prediction and abs(r.score - want[r.id].score) < 1e-12
    assert score(docs.limit(0), model, id_col="id").count() == 0
    assert "UDF" not in scored._jdf.queryExecution().optimizedPlan().toString()


def test_hashed_buckets_equal_hashing_tf(spark):
    import pyarrow as pa
    from pyspark.ml.feature import HashingTF

    from textlab.operators.features import murmur3

    terms = ["", "a", "ab", "abc", "abcd", "abcde", "good", "x" * 1001, "é日本", "same", "same", "0123456789"]
    tf = HashingTF(numFeatures=1 << 16)
    assert (murmur3(pa.array(terms)) % (1 << 16)).tolist() == [tf.indexOf(t) for t in terms]
    assert (murmur3(pa.array(terms).slice(3, 4)) % (1 << 16)).tolist() == [tf.indexOf(t) for t in terms[3:7]]
    assert murmur3(pa.array([], pa.string())).tolist() == []
