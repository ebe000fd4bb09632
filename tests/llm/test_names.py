"""Clashing column names, null ids and very long words through every operator and stage."""

import pytest
from pyspark.sql import functions as F

corpus_pipeline = pytest.importorskip("corpus_pipeline")

from ratecraft.llm import bayes_quality, chat_format, decontaminate, fertility, line_dedup, pair_bpe, queries, simhash, warc  # noqa: E402
from ratecraft.llm.common import scratch_path, spare_names  # noqa: E402

SF = "/root/testdata/sf0.001"
CLASHES = ["rejected_id", "rejected_hash", "found_id", "found_hash", "led_hash", "gone_doc", "gone_marks", "own_key", "own_lines",
           "left_text", "lines_removed", "__doc", "__hash", "__key", "__marks", "__lines", "__left", "__found", "__removed", "row", "no",
           "h1", "h2", "first", "bits", "component_id", "item_id", "share", "window", "HOST", "path", "p", "tokens", "line", "chars", "key"]
WORD = "Donaudampfschiff" * 65_000  # one word of a megabyte


@pytest.fixture(scope="module")
def docs(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    more = spark.createDataFrame([(9_000_001, WORD), (9_000_002, WORD), (None, "A line without an id that is long enough to count."),
                                  (None, "A line without an id that is long enough to count."), (None, "Another text."), (9_000_003, None), (9_000_004, "")],
                                 "doc_id long, text string")
    whole = table.unionByName(more, allowMissingColumns=True)
    return whole.withColumns({c: F.concat(F.lit(c), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))) for c in CLASHES})


@pytest.mark.parametrize("stage", range(4))
def test_stages_pass_columns_of_any_name(spark, docs, stage):
    name, of = corpus_pipeline.STAGES[stage]
    out = of(spark, docs, SF)
    assert out.columns == docs.columns
    kept = out.collect()
    assert kept and all(r[c] == f"{c}{'-' if r.doc_id is None else r.doc_id}" for r in kept for c in CLASHES)


def test_last_stage(spark, docs):
    out = corpus_pipeline.STAGES[4][1](spark, docs, SF)
    assert out.count() == docs.count()


def test_operators_read_their_columns_only(spark, docs):
    labels, items = spark.read.parquet(f"{SF}/labels.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    n = docs.count()
    assert fertility.judge(docs, queries.PIECE_BPE).count() == n
    assert bayes_quality.judge(docs, labels).count() == n
    assert pair_bpe.round_trip_digests(docs, queries.BYTE_BPE).count() == n
    groups = simhash.near_duplicate_groups(docs)
    assert groups.count() == n
    assert {r.component_id for r in groups.where("doc_id IN (9000001, 9000002)").collect()} == {9_000_001}
    decontaminate.contaminated(docs, items).collect()


def test_rows_without_an_id_are_documents_of_their_own(spark):
    line = "A line without an id that is long enough to count."
    rows = [(None, f"{line}\nfirst"), (None, f"{line}\nsecond"), (None, f"{line}\nfirst"), (4, "Something else stands here.")]
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sum(line in r.text for r in got) in (1, 2)  # one document keeps it: a row, or the two equal rows
    assert sum("second" in r.text for r in got) == 1 and sum("first" in r.text for r in got) == 2
    with_line = [r.text for r in got if line in r.text]
    assert len(set(with_line)) == 1


def test_archive_and_chat_columns_of_any_name(spark):
    pages = spark.createDataFrame([(1, "http://a", "x" * 1_000_000), (2, "http://b", "x" * 1_000_000)], "page_id long, url string, html string")
    path = scratch_path(spark, "names")
    warc.write_archive(pages.withColumns({c: F.lit("c") for c in CLASHES}), path)
    assert sorted((r.key, r.type) for r in warc.read_archive(spark, path).select("key", "type").collect()) == [(1, "response"), (2, "revisit")]
    talks = spark.createDataFrame([(1, 0, "user", "Hi"), (1, 1, "assistant", WORD)], "conv_id long, turn long, role string, text string")
    assert chat_format.expand_prefix_targets(talks.withColumns({c: F.lit("c") for c in CLASHES})).count() == 1


def test_spare_names(spark):
    df = spark.createDataFrame([(1, 2)], "a int, _A int")
    assert spare_names(df, "a", "b", "b") == ["__a", "b", "_b"]
