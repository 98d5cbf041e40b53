from __future__ import annotations

import random
from itertools import combinations

import pytest

from docforge.llm import history
from docforge.llm.words import bare_words

KIND = "doc_id string, clean_text string, batch_no int, cls string"


def shingles(t):
    w = bare_words(t or "")
    return {tuple(w[i : i + 3]) for i in range(len(w) - 2)}


def jaccard(a, b):
    return len(a & b) / len(a | b) if a and b else 0.0


def corpus(seed: int, n: int):
    random.seed(seed)
    words = [f"w{i}" for i in range(4000)]
    rows = []
    for i in range(n):
        base = random.choices(words, k=random.randint(60, 250))
        rows.append(base)
        for _ in range(random.choice([0, 0, 1, 2])):
            copy = list(base)
            for _ in range(random.randint(0, max(1, len(copy) // 25))):
                k = random.randrange(len(copy))
                if random.random() < 0.5:
                    copy[k] = random.choice(words)
                else:
                    copy[k : k + 1] = []
            rows.append(copy)
    random.shuffle(rows)
    return [(f"{i:05}", " ".join(w), i % 4, "x") for i, w in enumerate(rows)]


def brute(rows, newer_than=0):
    one = {d: (shingles(t), b or 0) for d, t, b, _ in rows}
    return {(a, b): jaccard(one[a][0], one[b][0]) for a, b in combinations(sorted(one), 2) if max(one[a][1], one[b][1]) > newer_than}


def test_pairs_against_brute_force(spark):
    rows = corpus(1, 150)
    want = {p for p, j in brute(rows).items() if j >= 0.6}
    got = [tuple(r) for r in history.near_duplicates(spark.createDataFrame(rows + rows[:20], KIND)).collect()]
    assert len(got) == len(set(got)) and set(got) <= want
    assert len(set(got)) >= 0.97 * len(want) and len(want) > 40


def test_edges(spark):
    long = " ".join(f"Word{i}," for i in range(20_000))
    rows = [("a", "One two, three four five", 0, "x"), ("b", "one TWO three four: five", 1, "x"), ("c", "one two three four five", 0, "x"), ("d", "a b", 1, "x"), ("e", "A B", 1, "x"), ("f", None, 1, "x"), ("g", "  ", 1, "x"), ("h", long, None, "x"), ("i", long.lower(), 2, "x"), ("j", "one two three four five Ã©", 1, "x"), ("k", "quite different text stands here", 1, "x")]
    got = {tuple(r) for r in history.near_duplicates(spark.createDataFrame(rows, KIND)).collect()}
    assert got == {("a", "b"), ("b", "c"), ("h", "i")}
    assert history.near_duplicates(spark.createDataFrame(rows, KIND).limit(0)).count() == 0


def test_hot_copies_make_all_their_pairs(spark):
    rows = [(f"c{i:03}", "the same text in every one of these records " * 5, 1, "x") for i in range(40)] + corpus(2, 20)
    got = {tuple(r) for r in history.near_duplicates(spark.createDataFrame(rows, KIND)).collect()}
    assert sum(a.startswith("c") and b.startswith("c") for a, b in got) == 40 * 39 // 2


def test_batch_by_batch_equals_all_at_once(spark, tmp_path):
    rows = [(d, t, b, c) for d, t, b, c in corpus(3, 80)]
    df = spark.createDataFrame(rows, KIND)
    path = str(tmp_path / "table")
    history.accept(df.where("batch_no = 0"), path, 0)
    found = set()
    for n in (1, 2, 3):
        found |= {tuple(r) for r in history.new_batch(df.where(f"batch_no < {n}"), path, df.where(f"batch_no = {n}"), n).collect()}
    assert found == {tuple(r) for r in history.near_duplicates(df).collect()}
    assert spark.read.parquet(f"{path}/chunks").select("k").distinct().count() == len(rows)


def test_a_chunk_that_all_old_texts_have(spark, tmp_path):
    """Its rows don't leave the tasks that read the table, and one batch makes no pairs of old texts."""
    random.seed(8)
    words = [f"w{i}" for i in range(30_000)]
    common = "every page of this site ends with the same few words "
    own = [" ".join(random.choices(words, k=40)) for _ in range(3000)]
    old = spark.createDataFrame([(f"o{i}", common + t, 0, "x") for i, t in enumerate(own)], KIND)
    new = spark.createDataFrame([(f"n{i}", common + t, 1, "x") for i, t in enumerate(own[:5] + [" ".join(random.choices(words, k=40)) for _ in range(20)])], KIND)
    path = str(tmp_path / "table")
    history.accept(old, path, 0)
    got = {tuple(r) for r in history.new_batch(old, path, new, 1).collect()}
    assert got == {(f"n{i}", f"o{i}") for i in range(5)}
    frequency = history.as_array(spark.read.parquet(f"{path}/counters").select("block", "data"), history.counters_of(spark, path), history.np.uint32, history.np.add)
    frequency = spark.sparkContext.broadcast((frequency, float(frequency.sum())))
    table = spark.read.parquet(f"{path}/chunks")
    fresh = history.deciding(table.where("batch = 1"), frequency)
    wanted = history.filled(fresh.select("chunk"), 1 << 16)
    assert history.deciding(table.where("batch = 0"), frequency, wanted).select("cls").distinct().count() < 400


def test_recall_by_length(spark):
    """Pairs at a similarity of 0.6 to 0.75, from 20 words on, around 80 words, too."""
    random.seed(9)
    words = [f"w{i}" for i in range(4000)]
    rows, want = [], {}
    for length in (20, 40, 78, 80, 82, 120, 300):
        n = 0
        while n < 60:
            base = random.choices(words, k=length)
            copy = list(base)
            for _ in range(max(1, int(length * random.uniform(0.04, 0.12)))):
                k = random.randrange(len(copy))
                copy[k : k + 1] = random.choice(([], [random.choice(words)], [copy[k], random.choice(words)]))
            if 0.6 <= jaccard(shingles(" ".join(base)), shingles(" ".join(copy))) < 0.75:
                name = f"{length:04}-{n:02}"
                rows += [(f"{name}a", " ".join(base), 1, "x"), (f"{name}b", " ".join(copy), 1, "x")]
                want[f"{name}a", f"{name}b"] = length
                n += 1
    got = {tuple(r) for r in history.near_duplicates(spark.createDataFrame(rows, KIND)).collect()}
    recall = {x: sum(want.get(p) == x for p in got) / 60 for x in sorted(set(want.values()))}
    print(recall)
    assert got <= set(want) and all(v >= (0.95 if k < 40 else 0.98) for k, v in recall.items())


def test_full_filters_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(history, "MOST_BITS", 8)
    monkeypatch.setattr(history, "LEAST_BITS", 8)
    rows = corpus(4, 30)
    got = {tuple(r) for r in history.near_duplicates(spark.createDataFrame(rows, KIND)).collect()}
    assert got == {p for p, j in brute(rows).items() if j >= 0.6 and p in got} and got


@pytest.mark.parametrize("least", [0.8])
def test_other_thresholds(spark, least):
    rows = corpus(5, 60)
    got = {tuple(r) for r in history.near_duplicates(spark.createDataFrame(rows, KIND), least=least).collect()}
    assert got <= {p for p, j in brute(rows).items() if j >= least}


def test_scattered_edits_near_the_threshold(spark):
    """Pairs at a similarity of 0.60 to 0.70, of 100 to 500 words, with edits all over the text."""
    random.seed(6)
    words = [f"w{i}" for i in range(4000)]
    rows, want = [], set()
    for length in (100, 150, 250, 500):
        n = 0
        while n < 50:
            base = random.choices(words, k=length)
            copy = list(base)
            for _ in range(int(length * random.uniform(0.06, 0.16))):
                k = random.randrange(len(copy))
                copy[k : k + 1] = random.choice(([], [random.choice(words)], [copy[k], random.choice(words)]))
            if 0.6 <= jaccard(shingles(" ".join(base)), shingles(" ".join(copy))) < 0.7:
                name = f"{length:04}-{n:02}"
                rows += [(f"{name}a", " ".join(base), 1, "x"), (f"{name}b", " ".join(copy), 1, "x")]
                want.add((f"{name}a", f"{name}b"))
                n += 1
    got = {tuple(r) for r in history.near_duplicates(spark.createDataFrame(rows, KIND)).collect()}
    print("found", len(got & want), "of", len(want))
    assert got <= want and len(got) >= 0.98 * len(want)
