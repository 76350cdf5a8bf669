"""run() against a plain version of its stages, and the driver's contract for this subpackage."""

from __future__ import annotations

import sentencepiece
from pyspark.sql import functions as F
from tests.llm.helpers import brute_components, brute_repeats, fingerprint, words

import corpus_pipeline
from panelmill.llm import decontaminate, pieces, rules

SF = "/root/testdata/sf0.001"


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_duplicates", "repeated_passages", "decontamination", "token_ids"]


def test_run_equals_the_plain_version(spark):
    read = lambda t: spark.read.parquet(f"{SF}/{t}.parquet")
    verdict = {r.doc_id: r.kept for r in rules.judge(read("documents"), read("labels")).collect()}
    left = {r.doc_id: r.text or "" for r in read("documents").collect() if verdict[r.doc_id]}
    component = brute_components({i: fingerprint(t) for i, t in left.items()})
    left = {i: t for i, t in left.items() if component[i] == i}
    cleaned = brute_repeats(list(left.items()), 20)
    left = {i: (t if not cleaned[i, t][1] else cleaned[i, t][2]) for i, t in left.items()}
    items = [decontaminate.words_of(r.text.encode()) for r in read("benchmark").collect()]

    def leaks(t):
        w = decontaminate.words_of(t.encode())
        joined = b" " + b" ".join(w) + b" "
        return any(b" " + b" ".join(x) + b" " in joined for x in items)

    got = {r.doc_id: r for r in corpus_pipeline.run(spark, SF).collect()}
    whole = {i for i, t in left.items() if not leaks(t)}
    assert set(got) <= whole  # verbatim items always go; edited ones may go too
    assert len(got) >= 0.98 * len(whole)
    sp = sentencepiece.SentencePieceProcessor(model_file=pieces.default_model())
    for i, r in got.items():
        assert list(r.ids) == sp.encode(left[i]) and r.n_tokens == len(r.ids)
        assert r.exact and words(left[i]) is not None


def test_stages_keep_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns
    clashing = {c: F.lit(7) for c in ("later_doc_id", "fp", "row", "rest", "shard", "version", "component_id", "kept")}
    more = docs.withColumns(clashing)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, more, SF)
        assert got.columns == more.columns and got.select("row").distinct().collect() == [(7,)]
    none = docs.where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, SF).count() == 0
