"""The pipeline keeps documents in any mixture of learned languages and drops texts in none."""

import corpus_pipeline


def test_keeps_mixtures_and_drops_unknown_languages(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    text = {r.lang: r.text for r in docs.filter("n_chars > 1500").collect()}
    mixed = " ".join(text[lang][:n] for lang, n in (("en", 800), ("de", 700), ("fr", 500)))
    even = " ".join(text[lang][:600] for lang in ("en", "de", "fr", "es"))
    unknown = ["Όλοι οι άνθρωποι γεννιούνται ελεύθεροι και ίσοι στην αξιοπρέπεια.", "Все люди рождаются свободными и равными в своем достоинстве.", "xq zvkj wqpt kxzj qqvw jjkz xvbq zzkw pqxj", "12 34"]
    more = [(-1 - i, t, None, "a", len(t)) for i, t in enumerate([mixed, even, *unknown])]
    both = docs.select("doc_id", "text", "lang", "source", "n_chars").unionByName(spark.createDataFrame(more, "doc_id long, text string, lang string, source string, n_chars long"))
    kept = {r.doc_id for r in corpus_pipeline.identify_language(spark, both, data).collect()}
    assert kept == {-1, -2} | {r.doc_id for r in docs.collect()}
