"""The pipeline's stages against plain Python, and on odd rows."""

import re
from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_dedup import _classes
from tests.llm.test_texts import WORD_BPE, _check_pieces, _secrets
from tokenizers import Tokenizer


def _stages(spark, docs, sf_dir, folder):
    out = []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        out.append(docs)
    return out


def _redacted(text):
    out, at = "", 0
    for s in _secrets(text):
        if s["start"] >= at:
            out += text[at : s["start"]] + "[SECRET]"
        at = max(at, s["end"])
    return out + text[at:]


def test_stages_equal_brute_force(spark, sf_dir, texts, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    language, exact, near, clean, packed = _stages(spark, docs, sf_dir, tmp_path)
    assert all(df.columns == docs.columns for df in (language, exact, near, clean))
    kept = {r.doc_id: r.text for r in language.collect()}
    assert set(kept) == {i for i, t in texts.items() if any(c.isalpha() for c in t or "")}
    best = {}
    for i, t in kept.items():
        norm = re.sub("[\x20\x09-\x0d]", "", t)
        best[norm] = min(best.get(norm, (0, i)), (-len(t), i))
    single = {i: kept[i] for _, i in best.values()}
    assert {r.doc_id for r in exact.collect()} == set(single)
    classes = _classes(single)
    assert {r.doc_id for r in near.collect()} == set(classes.values())
    final = {r.doc_id: r for r in clean.collect()}
    assert {i: r.text for i, r in final.items()} == {i: _redacted(single[i]) for i in set(classes.values())}
    assert all(r.n_chars == len(r.text) for r in final.values())
    tokenizer = Tokenizer.from_file(WORD_BPE)
    ids = {i: tokenizer.encode(r.text, add_special_tokens=False).ids + [1] for i, r in final.items()}
    _check_pieces(packed.collect(), ids)


def test_run_gives_the_last_stage(spark, sf_dir):
    found = corpus_pipeline.run(spark, sf_dir)
    assert {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"} == set(found.columns)


def test_odd_documents(spark, odd, tmp_path):
    docs = odd.withColumns({"lang": F.when(F.col("doc_id") != 8, "en"), "source": F.lit(None).cast("string"), "n_chars": F.lit(None).cast("long")})
    language, exact, near, clean, packed = _stages(spark, docs, None, tmp_path / "odd")
    assert all(df.columns == docs.columns for df in (language, exact, near, clean))
    left = Counter(re.sub(r"\s", "", r.text) for r in exact.collect())
    assert set(left.values()) == {1} and "" not in left
    assert packed.count() >= near.count()
    empty = _stages(spark, docs.limit(0), None, tmp_path / "empty")
    assert [df.count() for df in empty] == [0] * 5


