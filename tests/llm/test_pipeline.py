"""The corpus pipeline and the registered queries on the smallest tables."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from shoplake.llm import queries as llm_queries
from shoplake.llm.common import staged, table
from shoplake.llm.queries import tokenizer

SF = "/root/testdata/sf0.001"


def test_all_ten_queries_and_the_pipeline_are_registered():
    names = set(entry.queries())
    assert {f"op{n}" for n in range(1, 11)} <= {n.split("_")[0] for n in names} and "pipeline" in names
    assert set(llm_queries.oracle_sql()) <= names


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = table(spark, SF, "documents"), []
    for _, stage in corpus_pipeline.STAGES:
        before, docs = docs, staged(stage(spark, docs, SF), "test_stage")
        out.append((before, docs))
    return out


def test_stages_keep_the_columns_of_documents(spark, stages):
    columns = table(spark, SF, "documents").columns
    assert all(after.columns == columns for _, after in stages[:-1])


def test_quality_stage_drops_labelled_junk_and_keeps_clean_documents(spark, stages):
    before, after = stages[0]
    labels = table(spark, SF, "labels")
    kept = after.join(labels, "doc_id").groupBy("quality").count().collect()
    total = {r["quality"]: r["count"] for r in before.join(labels, "doc_id").groupBy("quality").count().collect()}
    kept = {r["quality"]: r["count"] for r in kept}
    assert kept[1] >= 0.97 * total[1] and kept.get(0, 0) <= 0.3 * total.get(0, 0)


def test_dedup_stage_leaves_one_document_of_each_class(spark, stages):
    before, after = stages[1]
    texts = {r["doc_id"]: r["text"] for r in before.select("doc_id", "text").collect()}
    sets = {}
    for i, t in texts.items():
        w = (t or "").lower().split()
        sets[i] = {tuple(w[j:j + 5]) for j in range(max(1, len(w) - 4))} if w else {()}
    top = {i: i for i in texts}

    def root(i):
        while top[i] != i:
            i = top[i]
        return i

    for i in texts:
        for j in texts:
            if i < j and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)))
                top[b] = a
    assert sorted(r["doc_id"] for r in after.select("doc_id").collect()) == sorted({root(i) for i in texts})


def test_secret_stage_changes_only_documents_with_secrets(stages):
    before, after = stages[2]
    old = {r["doc_id"]: r["text"] for r in before.collect()}
    for r in after.collect():
        if r["text"] != old[r["doc_id"]]:
            assert "[SECRET]" in r["text"] and not re.search(r"[0-9a-f]{24}|AKIA[A-Z0-9]{16}", r["text"])


def test_mixture_and_tokens_follow_their_input(spark, stages):
    import tiktoken

    from shoplake.llm import bpe

    before, after = stages[3]
    assert after.select("doc_id").distinct().join(before, "doc_id", "left_anti").count() == 0
    mixed, tokens = stages[4]
    assert tokens.count() == mixed.count()
    path, pattern = tokenizer()
    ranks = bpe.vocabulary(path, pattern).ranks
    library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    want = sorted((r["doc_id"], library.encode_ordinary(r["text"])) for r in mixed.collect())
    assert sorted((r["doc_id"], list(r["ids"])) for r in tokens.collect()) == want
    texts = sorted((r["doc_id"], r["text"]) for r in mixed.collect())
    assert sorted((r["doc_id"], r["text"]) for r in tokens.collect()) == texts


def test_awkward_rows_go_through_every_stage(spark):
    """Null ids, texts and sources, repeated rows, a long text, and columns that bear the stages' own names."""
    docs = table(spark, SF, "documents")
    clean = docs.filter(F.length("text") > 400).limit(3)
    rows = docs.limit(0)
    for change in ({"text": F.lit(None).cast("string")}, {"doc_id": F.lit(None).cast(docs.schema["doc_id"].dataType)},
                   {"source": F.lit(None).cast("string"), "lang": F.lit(None).cast("string")}, {"text": F.lit("")},
                   {"text": F.concat_ws(" ", F.array_repeat("text", 40))}, {"n_chars": F.lit(None).cast(docs.schema["n_chars"].dataType)}):
        rows = rows.union(clean.withColumns(change).select(*docs.columns))
    rows = rows.union(clean).union(clean).union(docs)
    rows = staged(rows.selectExpr("*", "'s' as score", "1 as size", "2 as row", "true as keep", "'k' as key", "0 as taken"), "test_awkward")
    columns, before = rows.columns, rows
    for name, stage in corpus_pipeline.STAGES:
        after = staged(stage(spark, before, SF), "test_awkward")
        assert name == "tokens" or after.columns == columns
        assert 0 < after.count() <= 4 * before.count()
        before = after
    assert before.columns == ["doc_id", "n_tokens", "ids", "text"]


def test_an_empty_table_goes_through_every_stage(spark):
    docs = table(spark, SF, "documents").filter(F.lit(False))
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0


def test_native_operators_run_no_python(spark):
    for name in ("op4_bloom_cascade", "op5_secret_ownership", "op6_sainte_lague"):
        plan = entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan)
