"""The pipeline's stages against brute force, and its registration."""

import os
import random
from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline
from issuelens.llm import stages
from issuelens.session import ensure_checkpoint_dir

from .conftest import ODD, SCHEMA, rows_of
from .test_rows import brute_hits, brute_quality
from .test_tables import brute_classes, brute_passages, check_packing

BENCH = [(0, "the quick brown fox jumps over the lazy dog and then it sleeps a while"), (1, "short item")]


def corpus():
    rnd = random.Random(8)
    shared = " ".join(f"sh{rnd.randrange(99)}" for _ in range(60))
    rows = list(ODD)
    for i in range(10, 70):
        words = [f"w{rnd.randrange(3000)}" for _ in range(rnd.randint(12, 120))]
        kind = i % 6
        if kind == 1:
            words = words[:5] * 6
        elif kind == 2:
            words += shared.split()
        elif kind == 3:
            words[5:5] = BENCH[0][1].split()[:11]
        rows.append((i, " ".join(words)))
        if kind == 4:
            rows.append((i + 1000, " ".join([*words, "x", "y"])) if len(words) > 60 else (i + 1000, rows[-1][1]))
    return rows


def test_stages_equal_brute_force(spark, tmp_path):
    rows = corpus()
    sf = str(tmp_path)
    spark.createDataFrame(rows_of(rows), SCHEMA).write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame(BENCH, "item_id bigint, text string").write.parquet(f"{sf}/benchmark.parquet")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    plain = lambda df: Counter((r.doc_id, r.text) for r in df.collect())

    docs = stages.quality_rules(spark, docs, sf)
    rows = [(i, t) for i, t in rows if brute_quality(t)[-1]]
    assert docs.columns == list(stages.COLUMNS) and plain(docs) == Counter(rows)

    docs = stages.near_duplicates(spark, docs, sf)
    classes = brute_classes(rows)
    firsts = {c for _, c, _, _ in classes}
    # one row a class: that of its least doc_id, or any of those without one
    assert len({(i, c) for i, c, _, _ in classes if i == c}) == len(firsts)
    rows = sorted({(i, t) for i, t in rows if i in firsts}, key=str)
    assert plain(docs) == Counter(rows)

    docs = stages.shared_passages(spark, docs, sf)
    cut = {i: (n, gone) for i, n, gone, _ in brute_passages(rows)}
    got = plain(docs)
    assert {i for i, _ in got} == {i for i, _ in rows if cut[i][1] < cut[i][0]}
    assert all(len(t.split()) == cut[i][0] - cut[i][1] for i, t in got)
    assert all((i, t) in got for i, t in rows if not cut[i][1])
    rows = list(got)

    docs = stages.decontamination(spark, docs, sf)
    rows = [(i, t) for i, t in rows if not brute_hits(t, BENCH)[1]]
    assert plain(docs) == Counter(rows) and rows
    check_packing(spark, docs, rows, 4096)

    staged_folder = ensure_checkpoint_dir(spark).rstrip("/") + "/staged"
    before = len(os.listdir(staged_folder))
    whole = corpus_pipeline.run(spark, sf)
    assert len(os.listdir(staged_folder)) == before  # the stages' working tables are gone
    last = stages.packed(spark, docs, sf)
    tables_folder = ensure_checkpoint_dir(spark).rstrip("/") + "/tables"
    tables = len(os.listdir(tables_folder))
    again = corpus_pipeline.run(spark, sf)
    assert len(os.listdir(tables_folder)) == tables + 2  # the last stage's input and its pieces
    assert again.count() == whole.count()
    key = lambda df: Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in df.collect())
    assert key(whole) == key(last)


def test_stages_take_empty_tables(spark, tmp_path, no_docs):
    sf = str(tmp_path)
    spark.createDataFrame(BENCH, "item_id bigint, text string").write.parquet(f"{sf}/benchmark.parquet")
    docs = no_docs
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf)
        assert docs.count() == 0


def test_stages_take_extra_columns_and_an_empty_benchmark(spark, tmp_path, odd_docs):
    """Columns that operators use themselves, odd rows, and no benchmark item: each stage's rows are those of the plain table."""
    sf = str(tmp_path)
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{sf}/benchmark.parquet")
    extra = {c: "x" for c in ("lot", "key", "row", "n_words", "kept", "bucket", "_doc", "_text", "_kind", "node", "class_id", "contaminated", "first", "blocks")}
    plain, clashing = odd_docs.select(*stages.COLUMNS), odd_docs.select(*stages.COLUMNS)
    for name, stage in corpus_pipeline.STAGES:
        clashing = clashing.withColumns({c: F.lit(v) for c, v in extra.items()})
        plain, clashing = stage(spark, plain, sf), stage(spark, clashing, sf)
        assert plain.columns == clashing.columns
        if name != corpus_pipeline.STAGES[-1][0]:
            assert plain.columns == list(stages.COLUMNS)
            assert Counter(map(tuple, plain.collect())) == Counter(map(tuple, clashing.collect()))
    assert plain.count() == clashing.count() > 0


def test_every_dealt_operator_is_registered():
    import __spark_entry__ as entry

    names = list(entry.queries())
    for n in range(1, 14):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert "pipeline" in names and [n for n, _ in corpus_pipeline.STAGES][0] == "quality_rules"
    assert {"op1_decontaminate", "op6_repetition_quality", "op9_seed_extend_dedup", "op10_ngram_jaccard_join", "op12_levelled_lines", "op13_signature_search"} <= set(entry.oracle_sql())
