"""Every registered query of the operators as registered, on whole tables, against brute force."""

import hashlib
import zlib

import public_tokenizers
import pytest
from conftest_llm import CLASHING, FILL, LOWER, SF_DIR, doc, words
from pyspark.sql import functions as F
from test_decontamination import plain
from test_files import brute_tokens, check_pages
from test_katz import Brute
from test_simhash import brute_components, brute_print
from test_substrings import brute
from tokenizers import Tokenizer

import corpus_pipeline
from prefspark.llm import common, katz, queries
from prefspark.sources.tables import exists


def crc(number, n):
    return zlib.crc32(str(number).encode()) % n


def test_op1(spark, texts):
    rows = {r.doc_id: r for r in queries.op1_substring_dedup(spark, SF_DIR).collect()}
    want = sorted(texts.items())
    assert rows.keys() == texts.keys()
    for (doc_id, _), (w, gone) in zip(want, brute(want, 20), strict=True):
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        assert (rows[doc_id].n_words, rows[doc_id].n_removed) == (len(w), sum(gone))
        assert rows[doc_id].kept_sha256 == hashlib.sha256(kept.encode()).hexdigest()


def test_op2(spark, texts):
    prints = {i: brute_print(t) for i, t in texts.items()}
    label = brute_components(prints, 4)
    rows = queries.op2_simhash_neardup(spark, SF_DIR).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows} == {i: (f"{prints[i]:016x}", label[i]) for i in texts}


def test_op3(spark, texts):
    rows = queries.op3_quality_classifier(spark, SF_DIR).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    assert all(r.held_out == (crc(r.doc_id, 3) == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)


def test_op5(spark, texts):
    items = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()
    found = {(r.doc_id, r.item_id) for r in queries.op5_decontamination(spark, SF_DIR).collect()}
    want = {(i, r.item_id) for r in items for i, t in texts.items() if plain(r.text) and f" {plain(r.text)} " in f" {plain(t)} "}
    assert want <= found and {i for i, _ in found} <= texts.keys()


def test_op6(spark, texts):
    tokens = {i: [*words(t.translate(LOWER)), "</s>"] for i, t in texts.items()}
    model = Brute([t for i, t in tokens.items() if crc(i, 7) != 2], katz.ORDER)
    counts, n, v = model.counts[1], model.total, len(model.counts[1])
    rows = queries.op6_language_model(spark, SF_DIR).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    import math

    for r in rows:
        mine = tokens[r.doc_id]
        base = sum(math.log10((counts[(t,)] + 1) / (n + v + 1)) for t in mine)
        known = sum(counts[(t,)] > 0 for t in mine)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (crc(r.doc_id, 7) == 2, len(mine), known, n)
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.score == pytest.approx(model.score(mine), rel=1e-6)


def test_op8(spark):
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()
    check_pages(queries.op8_warc(spark, SF_DIR).collect(), pages)


def test_op9(spark, texts):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = queries.op9_token_files(spark, SF_DIR).collect()
    assert sorted(tuple(r) for r in rows) == brute_tokens(tokenizer, list(texts.items()))


SCHEMA = f"doc_id long, text string, lang string, source string, n_chars long, row long, key long, id_ int, {CLASHING}"


def test_pipeline_stages_on_edges(spark, tmp_path):
    """Empty tables, missing ids, clashing columns: each stage carries the columns it was given."""
    folder = str(tmp_path / "sf")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SF_DIR}/{name}.parquet").write.parquet(f"{folder}/{name}.parquet")
    given = spark.read.parquet(f"{SF_DIR}/documents.parquet").orderBy("doc_id").limit(60).collect()
    rows = [(r.doc_id if k % 5 else None, r.text, r.lang, r.source, r.n_chars, 1, 2, 3, *FILL) for k, r in enumerate(given)]
    rows += [(i, t, "en", s, None, 1, 2, 3, *FILL) for i, t, _, s, *_ in (doc(1, None), doc(None, ""), doc(3, " \n "), doc(3, " \n "), doc(None, None, None))]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    empty = docs.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        assert stage(spark, empty, folder).count() == 0, name
        if name != "sharding":
            assert out.columns == docs.columns and {tuple(r) for r in out.collect()} <= {tuple(r) for r in rows}, name
        else:
            assert out.count() == docs.count()


def test_a_run_on_an_empty_table(spark, tmp_path):
    folder = str(tmp_path / "sf")
    for name in ("labels", "benchmark", "documents"):
        spark.read.parquet(f"{SF_DIR}/{name}.parquet").limit(0).write.parquet(f"{folder}/{name}.parquet")
    assert corpus_pipeline.run(spark, folder).count() == 0


def test_new_documents_are_scored_from_the_tables(spark, documents, texts):
    """Texts that the model was not trained with, by the stored counts and weights alone."""
    held = F.col("doc_id") % 3 == 0
    for order in (2, 3):
        model = katz.train(documents.where(~held), held_out=F.lit(False), order=order)
        plain_model = Brute([[*words(t.translate(LOWER)), "</s>"] for i, t in texts.items() if i % 3], order)
        rows = model.score_texts(documents).collect()
        assert sorted(r.doc_id for r in rows) == sorted(texts)
        for r in rows:
            mine = [*words(texts[r.doc_id].translate(LOWER)), "</s>"]
            assert r.n_tokens == len(mine) and r.score == pytest.approx(plain_model.score(mine), rel=1e-6)
        assert model.score_texts(documents.limit(0)).count() == 0


def test_a_run_leaves_its_result_alone(spark, monkeypatch):
    made = []
    folder = common.new_workdir
    monkeypatch.setattr(common, "new_workdir", lambda *args: made.append(folder(*args)) or made[-1])
    result = corpus_pipeline.run(spark, SF_DIR)
    n = result.count()
    kept = [path for path in made if exists(spark, path)]
    assert n > 0 and len(made) > 20 and kept == [path for path in made if "pipeline-sharding" in path]
    assert result.count() == n
    with pytest.raises(ZeroDivisionError), common.tables_dropped(spark):
        common.written(spark.range(3), "gone")
        raise ZeroDivisionError
    assert not exists(spark, made[-1]) and not common._MADE
