"""Line, exact, near and sentence-span deduplication against plain Python, and on odd rows."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import DataFrame

from tests.compare import difference
from tests.llm.conftest import fold_ascii
from txlake.llm import bag_minhash, blocks, components, exact_dedup, line_dedup, sentence_spans
from txlake.llm.batches import text_blocks
from txlake.llm.queries import ORACLES, QUERIES
from txlake.llm.text import documents

NATIVE = ["op4_line_dedup", "op6_exact_dedup"]


@pytest.mark.parametrize("name", NATIVE)
def test_native_queries_equal_sql_without_python(spark, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in ("Python", "Arrow", "Pandas", "Cartesian", "NestedLoop") if x in plan]
    assert difference(df, duck, ORACLES[name]) is None


def test_lines_of_odd_rows(odd, odd_rows):
    found = line_dedup.drop_shared_lines(odd).collect()
    assert len(found) == len(odd_rows)
    assert Counter(r.n_lines for r in found if r.kept_text == "") == {1: 3}
    assert all(r.n_dropped == 0 for r in found)


def test_shared_lines_stay_in_the_largest_id(spark):
    shared, short = "  A line that Many documents share ", "short line"
    rows = [(i, f"{shared.upper() if i % 2 else shared}\nown line number {i} of this text\n{short}\n{shared}") for i in range(5)]
    found = {r.doc_id: r for r in line_dedup.drop_shared_lines(spark.createDataFrame(rows, "doc_id int, text string")).collect()}
    assert found[4].n_dropped == 0 and found[4].kept_text == rows[4][1]
    assert all(found[i].kept_text == f"own line number {i} of this text\n{short}" and found[i].n_dropped == 2 for i in range(4))
    two = line_dedup.drop_shared_lines(spark.createDataFrame(rows[:2], "doc_id int, text string")).collect()
    assert all(r.n_dropped == 0 for r in two)


def test_lines_of_repeated_and_null_ids(spark):
    line = "the very same line everywhere"
    rows = [(None, line), (7, line), (7, line), (3, line + "\nand one more line of text")]
    found = line_dedup.drop_shared_lines(spark.createDataFrame(rows, "doc_id int, text string")).collect()
    assert sorted((r.doc_id or 0, r.n_dropped) for r in found) == [(0, 1), (3, 1), (7, 0), (7, 0)]


def test_exact_groups_of_odd_rows(odd, odd_rows):
    found = exact_dedup.duplicate_groups(odd).collect()
    norm = {}
    for i, t in odd_rows:
        norm.setdefault(re.sub("[\x20\x09-\x0d]", "", t or ""), []).append((-len(t or ""), i is not None, i or 0))
    assert len(found) == len(odd_rows)
    by_hash = {hashlib.sha256(n.encode()).hexdigest(): sorted(v) for n, v in norm.items()}
    for r in found:
        group = by_hash[r.text_sha256]
        best = group[0]
        assert r.group_size == len(group) and r.keep_id == (best[2] if best[1] else None)
    assert Counter(r.text_sha256 for r in found if r.kept) == Counter(by_hash.keys())


def test_exact_rows_that_stay(odd, odd_rows):
    kept = exact_dedup.drop_duplicates(odd)
    assert kept.columns == odd.columns
    found = [re.sub("[\x20\x09-\x0d]", "", r.text or "") for r in kept.collect()]
    assert Counter(found) == Counter({re.sub("[\x20\x09-\x0d]", "", t or "") for _, t in odd_rows})


def test_hot_copies_over_many_buckets(spark):
    rows = [(i, "hot copy" if i % 3 else f"other text {i}") for i in range(3000)]
    found = exact_dedup.duplicate_groups(spark.createDataFrame(rows, "doc_id int, text string"))
    hot = [r for r in found.collect() if r.group_size > 1]
    assert len(hot) == 2000 and {r.keep_id for r in hot} == {1} and sum(r.kept for r in hot) == 1


def _bag(text, size=5):
    words = re.findall("[^\x20\x09-\x0d]+", fold_ascii(text or ""))
    if len(words) < size:
        return Counter([tuple(words)] if words else [])
    return Counter(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def _classes(texts, similarity=0.8):
    """Smallest id that links of similar multisets reach."""
    bags, holders = {i: _bag(t) for i, t in texts.items()}, defaultdict(list)
    parent = {i: i for i in texts}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, bag in bags.items():
        overlap = Counter()
        for shingle, n in bag.items():
            for j, m in holders[shingle]:
                overlap[j] += min(n, m)
            holders[shingle].append((i, n))
        for j, both in overlap.items():
            if both >= similarity * (sum(bag.values()) + sum(bags[j].values()) - both):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {i: root(i) for i in texts}


def test_near_classes_equal_brute_force(spark, sf_dir, texts):
    found = {r.doc_id: r for r in QUERIES["op10_bag_minhash"](spark, sf_dir).collect()}
    expected = _classes(texts)
    assert {i: r.class_id for i, r in found.items()} == expected
    size = Counter(expected.values())
    assert all(r.class_size == size[r.class_id] and r.kept == (i == r.class_id) for i, r in found.items())


def test_a_star_of_near_copies_without_links_among_them(spark):
    """Copies that are like the original only, copies that are like nothing, and a chain."""
    rng = np.random.default_rng(3)
    base = [f"w{i}" for i in range(200)]
    texts = {0: " ".join(base)}
    for i in range(1, 60):
        words = list(base)
        for at in rng.choice(200, 4 if i % 2 else 9, replace=False):
            words[at] = f"x{i}.{at}"
        texts[i] = " ".join(words)
    df = spark.createDataFrame(list(texts.items()), "doc_id int, text string")
    found = {r.doc_id: r.class_id for r in bag_minhash.near_duplicate_classes(df).collect()}
    assert found == _classes(texts)


def test_blocks_of_a_large_group(spark, monkeypatch):
    monkeypatch.setattr(bag_minhash, "TASK_BAGS", 7)
    test_a_star_of_near_copies_without_links_among_them(spark)


def test_near_classes_of_odd_rows(odd, odd_rows):
    found = bag_minhash.near_duplicate_classes(odd).collect()
    assert len(found) == len(odd_rows)
    repeated = [r for r in found if r.class_size > 1]
    # Rows that repeat id and text, or differ in case and white space.
    assert sorted(r.doc_id for r in repeated) == [4, 4, 5] and {r.class_id for r in repeated} == {4}
    kept = bag_minhash.drop_near_duplicates(odd)
    assert kept.columns == odd.columns
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == Counter(odd_rows) - Counter([(5, "repeated  ROW")])


def test_signatures_estimate_weighted_jaccard():
    a = " ".join(f"w{i}" for i in range(300)) + " a b c d e f g" * 30
    b = " ".join(f"w{i}" for i in range(60, 300)) + " a b c d e f g" * 22
    (_, block, starts), = text_blocks(pa.array([a, b, None, a.upper()]))
    values = bag_minhash.signatures(*bag_minhash.shingle_counts(block, starts, 5), 4, 16384)
    x, y = _bag(a), _bag(b)
    true = sum((x & y).values()) / sum((x | y).values())
    assert abs((values[0] == values[1]).mean() - true) < 0.02
    assert (values[0] == values[3]).all() and np.isinf(values[2]).all()


def test_components_of_a_path_a_star_and_nothing(spark):
    path = [(i, i + 1) for i in range(40)]
    star = [(100, 100 + i) for i in range(1, 50)] + [(100, 100)]
    found = components.components(spark.createDataFrame(path + star, "u long, v long")).collect()
    assert {(r.node, r.component) for r in found} == {(i, 0) for i in range(41)} | {(100 + i, 100) for i in range(50)}
    assert components.components(spark.createDataFrame([], "u long, v long")).count() == 0


def _without_spans(texts, size=51):
    seen, result = {}, {}
    for i, text in sorted(texts.items()):
        text = text or ""
        placed = [(m.start(), m.end()) for m in re.finditer("[^\x20\x09-\x0d]+", text)]
        words = [fold_ascii(text[a:z]) for a, z in placed]
        n, gone = len(words), set()
        for a in range(n - size + 1):
            span = tuple(words[a : a + size])
            if seen.setdefault(span, i) != i:
                gone |= set(range(a, a + size))
        sentence, of_word = -1, []
        for k in range(n):
            sentence += k == 0 or words[k - 1][-1] in ".!?" or "\n" in text[placed[k - 1][1] : placed[k][0]]
            of_word.append(sentence)
        ends = [a for a, _ in placed[1:]] + [len(text)]
        left = text[: placed[0][0]] if placed else text
        left += "".join(text[a:e] for k, ((a, _), e) in enumerate(zip(placed, ends, strict=True)) if k not in gone)
        result[i] = (sentence + 1, len({of_word[k] for k in gone}), left)
    return result


def test_sentence_spans_equal_brute_force(spark, sf_dir, texts):
    found = {r.doc_id: (r.n_sentences, r.n_removed, r.text) for r in QUERIES["op8_sentence_spans"](spark, sf_dir).collect()}
    assert found == _without_spans(texts)


def test_repeats_of_51_words_are_caught_and_others_left(spark):
    """Against all stretches of 51 words, wherever they begin: documents that repeat one of an earlier document, and all others."""
    folder = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in documents(spark, folder).select("doc_id", "text").collect()}
    seen, repeats = {}, set()
    for i, text in sorted(texts.items()):
        words = re.findall("[^\x20\x09-\x0d]+", fold_ascii(text or ""))
        for k in range(len(words) - 50):
            if seen.setdefault(tuple(words[k : k + 51]), i) != i:
                repeats.add(i)
    found = {r.doc_id for r in QUERIES["op8_sentence_spans"](spark, folder).filter("n_removed > 0").collect()}
    own = {i for i in found if i not in repeats}
    assert len(found & repeats) >= 0.95 * len(repeats) > 50
    assert len(own) <= 0.02 * (len(texts) - len(repeats))
    assert found == repeats


def test_a_repeated_passage_goes_and_clean_texts_stay(spark):
    passage = " ".join(f"Word{i} goes with word{i + 1} and so on." for i in range(10))
    rows = [(1, f"Own beginning one. {passage}\nOwn end one."), (2, f"Other start.\n{passage} Other end."), (3, "Own text. Of no other.")]
    found = {r.doc_id: r for r in sentence_spans.remove_repeated_spans(spark.createDataFrame(rows, "doc_id int, text string")).collect()}
    assert found[1].text == rows[0][1] and found[3].text == rows[2][1]
    assert found[2].text == "Other start.\nOther end." and found[2].removed_words == 70


def test_passages_whatever_stands_around_them(spark):
    """Outer sentences that merge with other words, one long sentence, lines wrapped otherwise; a passage of 50 words stays."""
    inner = [f"w{i}" for i in range(60)]
    merged = " ".join(inner[:20]) + ", " + " ".join(inner[20:40]) + ". " + " ".join(inner[40:])
    wrapped = " ".join(f"v{i}" + (". " if i % 9 == 8 else "") for i in range(70))
    short = " ".join(f"s{i}" + ("," if i % 7 == 0 else "") for i in range(50))
    rows = [
        (1, f"one two {merged} three. {wrapped} {short}"), (2, f"Another start with {merged} and goes on."),
        (3, "x y z. " + wrapped.replace(" v3", "\nv3").replace(" v5", "\n\nv5")), (4, f"a b {short} c d"),
        (5, "again " * 300), (6, "Again " * 100),
    ]
    found = {r.doc_id: r for r in sentence_spans.remove_repeated_spans(spark.createDataFrame(rows, "doc_id int, text string")).collect()}
    assert found[1].n_removed == 0 and found[4].n_removed == 0
    assert found[2].removed_words >= 51 and found[3].removed_words >= 60
    # What a text repeats of itself is no passage of another.
    assert found[5].n_removed == 0 and found[6].text == ""


def test_spans_are_compared_wherever_they_begin(spark):
    """Passages of 51 words without a mark near them, at every distance from the beginning, in texts that share nothing else."""
    passage = " ".join(f"p{i}" for i in range(51))
    rows = [(k, " ".join([f"b{k}x{i}" for i in range(k)] + [passage] + [f"e{k}x{i}" for i in range(40 - k)])) for k in range(3, 23)]
    rows += [(100, "once " + passage.rsplit(" ", 1)[0] + " only fifty of them here"), (101, passage.upper() + "\n" + passage)]
    found = {r.doc_id: r for r in sentence_spans.remove_repeated_spans(spark.createDataFrame(rows, "doc_id int, text string")).collect()}
    assert found[3].text == rows[0][1] and found[100].text == rows[-2][1] and found[101].text == ""
    for k, text in rows[1:20]:
        assert found[k].removed_words == 51 and found[k].text == text.replace(passage + " ", "")


def test_spans_of_odd_rows(odd, odd_rows, nothing):
    found = sentence_spans.remove_repeated_spans(odd).collect()
    assert Counter((r.doc_id, r.text) for r in found if r.doc_id != 6) == Counter((i, t or "") for i, t in odd_rows if i != 6)
    assert sentence_spans.remove_repeated_spans(nothing).count() == 0


def test_empty_tables(nothing):
    assert line_dedup.drop_shared_lines(nothing).count() == 0
    assert exact_dedup.duplicate_groups(nothing).count() == 0
    assert exact_dedup.drop_duplicates(nothing).count() == 0
    assert bag_minhash.near_duplicate_classes(nothing).count() == 0
    assert bag_minhash.drop_near_duplicates(nothing).count() == 0


def test_compared_texts_are_shuffled_compressed(spark, monkeypatch):
    """Bags are read from compressed texts, and no band carries the row that stands for its bag."""
    monkeypatch.setattr(bag_minhash, "UNPACKED_ROWS", 3)
    seen, joined = [], DataFrame.join
    monkeypatch.setattr(DataFrame, "join", lambda df, other, *a, **k: seen.append(df.columns) or joined(df, other, *a, **k))
    rows = [(i, " ".join(f"w{(i // 2) * 31 + k}" for k in range(60)) + (" end" if i % 2 else "")) for i in range(40)] + [(41, None), (42, "")]
    df = spark.createDataFrame(rows, "doc_id int, text string").coalesce(1)
    found = {r.doc_id: r.class_id for r in bag_minhash.near_duplicate_classes(df).collect()}
    assert found == {i: i // 2 * 2 if i < 40 else i for i, _ in rows}
    assert not any("text" in columns or ("at" in columns and "bucket" in columns) for columns in seen)
    whole = pa.record_batch({"doc_id": [1, 2], "row": [5, 6], "text": ["ab " * 500, ""]})
    packed = pa.Table.from_batches(bag_minhash._packed(iter([whole])))
    assert blocks.joined_texts(packed.column("packed"), packed.column("octets").to_pylist()).to_pylist() == ["ab " * 500, ""]
    assert len(packed.column("packed")[0].as_py()) < 100
