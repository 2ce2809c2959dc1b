import numpy as np

from eventfares.llm import langid

WORDS = {
    "aa": "the tion and ing her ere ent tha nth was".split(),
    "bb": "der und die sch ein ich cht ung gen ver".split(),
    "cc": "que los ión ado ent ara est nte con las".split(),
}


def text_of(lang, n, seed):
    pick = np.random.default_rng(seed)
    return " ".join("".join(pick.choice(WORDS[lang], 2)) for _ in range(n))


def corpus(spark, per_language=60):
    rows = [(k * 3 + j, text_of(lang, 40, k * 3 + j), lang) for k in range(per_language) for j, lang in enumerate(WORDS)]
    rows += [(1000, None, "aa"), (1001, "", "bb"), (1002, "12 34 !", "cc"), (1003, "the", None), (None, "und die", "bb")]
    return spark.createDataFrame([(*r, 0.5, "x") for r in rows], "doc_id bigint, text string, lang string, score double, _judged string")


def test_held_out_documents_are_known_and_oddities_defined(spark):
    docs = corpus(spark)
    found = langid.identify(docs, *langid.train(docs)).withColumn("out", langid.held_out(docs.doc_id)).collect()
    assert len(found) == docs.count()
    by_id = {r.doc_id: r for r in found}
    tested = [r for r in found if r.out and r.doc_id is not None and r.doc_id < 1000]
    assert len(tested) > 20 and all(r.lang_pred == r.lang and 0 <= r.score <= 1 for r in tested)
    for i in (1000, 1001, 1002):
        assert (by_id[i].lang_pred, by_id[i].score, by_id[i].lang_set) == ("und", 0.0, [])
    assert by_id[None].lang_pred == "bb" and by_id[None].out


def test_only_other_folds_are_learned_from(spark):
    docs = corpus(spark)
    out = langid.held_out(docs.doc_id)
    spoiled = docs.withColumn("lang", langid.F.when(out, "zz").otherwise(docs.lang))
    names, logs = langid.train(docs)
    assert langid.train(spoiled)[0] == names == ["aa", "bb", "cc"]
    assert np.allclose(langid.train(spoiled)[1], logs)


def test_a_bounded_sample_of_each_language(spark):
    names, logs = langid.train(corpus(spark), docs_per_language=10)
    assert names == ["aa", "bb", "cc"] and np.allclose(np.exp(logs).sum(axis=1), 1)


def test_mixtures_are_taken_apart(spark):
    names, logs = langid.train(corpus(spark))
    model = logs.astype(np.float32)
    mixed = text_of("aa", 300, 1) + " " + text_of("cc", 100, 2)
    lang, score, held = langid._predict(mixed, names, model)
    assert lang == "aa" and sorted(held) == ["aa", "cc"] and abs(score - 0.75) < 0.1
    assert langid._predict(text_of("bb", 400, 3), names, model)[2] == ["bb"]
    assert langid._predict(text_of("bb", 60_000, 3), names, model)[0] == "bb"


def test_proportions_maximise_the_likelihood():
    pick = np.random.default_rng(5)
    logs = np.log(pick.dirichlet(np.ones(30), 2))
    counts = pick.integers(0, 20, 30).astype(float)
    share, fit = langid.mixture(logs, counts, rounds=500)
    grid = [float(counts @ np.log(p * np.exp(logs[0]) + (1 - p) * np.exp(logs[1]))) for p in np.linspace(0, 1, 1001)]
    assert abs(fit - max(grid)) < 1e-2 and abs(share.sum() - 1) < 1e-9


def test_nothing_to_learn_from_and_no_rows(spark):
    none = corpus(spark).where("false")
    names, logs = langid.train(none)
    assert names == [] and langid.identify(none, names, logs).count() == 0
    assert {r.lang_pred for r in langid.identify(corpus(spark, 2), names, logs).collect()} == {"und"}


def test_accuracy_on_held_out_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = langid.op10(spark, sf_dir).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    right = sum(r.lang == r.lang_pred for r in found)
    assert right / len(found) > 0.95
