"""Named queries of this subpackage and the DuckDB statements of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txlake.llm import (
    bag_minhash, exact_dedup, flat_graph, hpylm, language_id, license_scan, line_dedup, packing, periodic_runs, ranked_search, secret_scan,
    sentence_spans, sentencepiece_lattice,
)
from txlake.llm.text import documents, fold, whole_text


def op1_hpylm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learns from four folds of five and scores all."""
    scores = hpylm.score(documents(spark, sf_dir), fold() != 1)
    return scores.select(
        "doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encodes all texts and decodes the ids again."""
    model = sentencepiece_lattice.load(public_tokenizers.path("piece_bpe_32k.model"))
    encoded = sentencepiece_lattice.encode(documents(spark, sf_dir), model)
    back = sentencepiece_lattice.decode(F.col("ids"), model)
    return encoded.select(
        "doc_id", "n_ids", F.crc32("ids").alias("ids_crc32"), (back == F.col("text")).alias("round_trip")
    )


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learns from four folds of five and predicts all."""
    docs = documents(spark, sf_dir)
    model = language_id.train(docs.filter(fold() != 0))
    found = docs.select("doc_id", (fold() == 0).alias("held_out"), language_id.predict(F.col("text"), model).alias("p"))
    return found.select("doc_id", "held_out", F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.drop_shared_lines(documents(spark, sf_dir))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack_documents(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.duplicate_groups(documents(spark, sf_dir))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = documents(spark, sf_dir).select("doc_id", secret_scan.find_secrets(whole_text()).alias("spans"))
    base = [rule.kind for rule in secret_scan.BASE_RULES]

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    of_base = F.filter("spans", lambda s: s["kind"].isin(base))
    return found.select(
        "doc_id", *[count(kind) for kind in base], F.sha2(secret_scan.as_text(of_base), 256).alias("base_sha256"),
        secret_scan.as_text(F.col("spans")).alias("spans"),
    )


def op8_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_spans.remove_repeated_spans(documents(spark, sf_dir))


def op9_flat_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat_graph.near_duplicate_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op10_bag_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bag_minhash.near_duplicate_classes(documents(spark, sf_dir)).select("doc_id", "class_id", "class_size", "kept")


def _repeating(docs: DataFrame) -> DataFrame:
    """doc_id and text; every tenth text, by crc32 of its id, has its words from some place on replaced by a period of theirs. A null id counts
    as the empty text. No lambda functions here: Spark does not find a Python function again whose argument holds one."""
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    cut = F.when(h % 10 == 0, F.regexp_extract_all(whole_text(), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    words = docs.select("doc_id", whole_text().alias("text"), cut.alias("words"))
    n, g = F.size("words"), F.floor(h / 10)
    a = (g % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    times = F.ceil((n - a) / p).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(F.slice("words", a + 1, p), times)), 1, n - a)
    periodic = F.array_join(F.concat(F.slice("words", 1, a), tail), " ")
    return words.select("doc_id", F.when(n > 0, periodic).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _repeating(documents(spark, sf_dir)).select("doc_id", periodic_runs.find_runs(F.col("text")).alias("found"))
    runs = F.col("found.runs")
    listed = F.transform(runs, lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    longest = F.array_max(F.transform(runs, lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    rows = found.select("doc_id", F.size(runs).cast("long").alias("n_runs"), longest.alias("longest"), F.array_join(listed, "").alias("listed"), "found.collapsed")
    length, period = F.col("longest.length"), -F.col("longest.period")
    return rows.select(
        "doc_id", "n_runs", (-F.col("longest.start")).alias("start"), length.alias("length"), period.alias("period"),
        F.floor(length * 1000 / period).cast("long").alias("exponent_milli"),
        F.sha2("listed", 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = documents(spark, sf_dir).select("doc_id", license_scan.find_licenses(F.col("text")).alias("found"))
    base = F.filter("found.notices", lambda p: p["base"])

    def labels(of: Column) -> Column:
        return F.array_join(F.sort_array(F.array_distinct(of)), ",")

    every = F.concat(F.col("found.notices.label"), F.flatten("found.expressions.labels"))
    return found.select(
        "doc_id", "found.n_words", F.size(base).cast("long").alias("n_base"),
        F.array_min(base["word"]).alias("first_word"), F.array_max(base["word"]).alias("last_word"),
        labels(base["label"]).alias("base_labels"), labels(every).alias("labels"), license_scan.score(F.col("found")).alias("score"),
        F.size("found.expressions").cast("long").alias("n_expressions"), F.array_max("found.expressions.strength").alias("strength"),
    )


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_hpylm, op2_sentencepiece, op3_language_id, op4_line_dedup, op5_packing, op6_exact_dedup, op7_secret_scan, op8_sentence_spans,
        op9_flat_graph, op10_bag_minhash, op11_periodic_runs, op12_license_scan, op13_ranked_search,
    )
}

ORACLES: dict[str, str] = {
    "op4_line_dedup": r"""
WITH docs AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
positions AS (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS pos FROM docs),
keyed AS (
    SELECT doc_id, pos, lines[pos] AS line,
           translate(regexp_replace(lines[pos], '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM positions
),
shared AS (
    SELECT key, max(doc_id) AS owner FROM keyed WHERE length(key) >= 20
    GROUP BY key HAVING count(DISTINCT doc_id) >= 3
),
marked AS (
    SELECT doc_id, pos, line, owner IS NOT NULL AND doc_id <> owner AS dropped
    FROM keyed LEFT JOIN shared USING (key)
)
SELECT doc_id, count(*)::BIGINT AS n_lines, (count(*) FILTER (WHERE dropped))::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
""",
    "op6_exact_dedup": r"""
WITH docs AS (
    SELECT doc_id, length(coalesce(text, '')) AS n,
           sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
    FROM documents
),
ranked AS (
    SELECT *, row_number() OVER best AS place, first_value(doc_id) OVER best AS keep_id,
           count(*) OVER (PARTITION BY text_sha256) AS group_size
    FROM docs WINDOW best AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id)
)
SELECT doc_id, keep_id, group_size, place = 1 AS kept, text_sha256 FROM ranked
""",
    "op13_ranked_search": r"""
WITH docs AS (
    SELECT row_number() OVER () AS row, doc_id,
           regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM documents
),
total AS (SELECT count(*) AS n, sum(len(terms)) AS terms FROM docs WHERE len(terms) > 0),
items AS (
    SELECT row_number() OVER () AS item, item_id,
           regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM benchmark
),
asked AS (
    SELECT item, item_id, term, count(*) AS times FROM (SELECT item, item_id, unnest(terms) AS term FROM items) GROUP BY ALL
),
held AS (
    SELECT row, doc_id, n, term, count(*) AS tf
    FROM (SELECT row, doc_id, len(terms) AS n, unnest(terms) AS term FROM docs) GROUP BY ALL
),
weights AS (
    SELECT term, floor(1000 * ln((2 * any_value(total.n) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
    FROM held, total GROUP BY term
),
parts AS (
    SELECT row, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * held.n * total.n) // total.terms))) AS part
    FROM held JOIN weights USING (term), total
),
scored AS (
    SELECT item, item_id, row, doc_id, sum(times * part)::BIGINT AS score
    FROM asked JOIN parts USING (term) GROUP BY ALL
),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS place FROM scored WHERE score > 0
)
SELECT item_id, place::INTEGER AS rank, doc_id, score FROM ranked WHERE place <= 10
""",
}
