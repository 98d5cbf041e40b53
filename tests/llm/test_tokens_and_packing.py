from __future__ import annotations

import random

import numpy as np
import pytest

from docforge.llm import packing, tokens

TEXTS = [
    "", " ", "a", "\n\n\n", "  x", "x  ", "'s's 'll 're x're 're\n", " \n 'tis we'd've it''s 'S", "<|endoftext|> hi", "1²½٣ é́", "a" * 3000 + "'s", "ab" * 5000, " " * 1000,
    "　  x y", "\x00a\x00 b", "﻿‍", "दो भाषाओं में", "Рус 12,5 ₹", "— “x” …", "\r\n\t x\x1c\x85y",
]


@pytest.fixture(scope="module")
def reference():
    tk = pytest.importorskip("tokenizers")
    t = tk.Tokenizer.from_file(f"{tokens.TOKENIZER_DIR}/byte_bpe_50k.json")
    t.encode_special_tokens = True
    return t


def test_ids_are_those_of_the_reference_tokenizer(reference):
    random.seed(0)
    alphabet = list("ab 'sdtrevl\n\t1.é“—दх ")
    texts = TEXTS + ["".join(random.choice(alphabet) for _ in range(random.randint(0, 60))) for _ in range(3000)]
    coder = tokens.bpe("byte_bpe_50k", tokens.TOKENIZER_DIR)
    offsets, ids, slices, first = coder.encode_many(texts)
    want = reference.encode_batch(texts, add_special_tokens=False)
    for i, t in enumerate(texts):
        assert ids[offsets[i] : offsets[i + 1]].tolist() == want[i].ids, t
        assert coder.decode(want[i].ids) == t
        starts = first[slices[i] : slices[i + 1]].tolist()
        assert starts == sorted(set(starts)) and (not t or starts[0] == 0)


def test_own_merging_equals_native_merging():
    coder = tokens.bpe("byte_bpe_50k", tokens.TOKENIZER_DIR)
    if coder.native is None:
        pytest.skip("no native merging here")
    random.seed(1)
    for _ in range(2000):
        piece = bytes(random.choice(b"abtheing \xc3\xa0\xe0") for _ in range(random.randint(1, 120)))
        assert coder.merge(piece) == tuple(coder.native(piece))


def test_table(spark, reference):
    df = spark.createDataFrame([(1, "hello", "x"), (1, "hello", "x"), (2, None, None), (3, "", ""), (None, "a" * 100_000, "y")], "doc_id bigint, text string, ids string")
    got = [(r["doc_id"], len(r["ids"])) for r in tokens.encode_texts(df).collect()]
    assert sorted(got, key=str) == sorted([(1, 1), (1, 1), (2, 0), (3, 0), (None, len(reference.encode("a" * 100_000).ids))], key=str)
    assert tokens.encode_texts(df).dtypes == [("doc_id", "bigint"), ("ids", "array<int>")]
    assert tokens.encode_texts(df.limit(0)).count() == 0


@pytest.mark.parametrize("kind", ["plain", "vector"])
def test_packing_keeps_all_limits(kind):
    rng = np.random.default_rng(3)
    size = rng.integers(0, 100, 800)
    loss = size if kind == "plain" else (size * rng.random(800)).astype(np.int64)
    at = packing.pack(size, loss, 128, segments=9, loss_capacity=100 if kind == "vector" else None)
    used = np.bincount(at, weights=size)
    assert (at >= 0).all() and used.max() <= 128 and np.bincount(at).max() <= 9
    if kind == "vector":
        assert np.bincount(at, weights=loss).max() <= 100
    else:
        assert len(used) <= max(size.sum() / 128, 800 / 9) * 1.03 + 1


@pytest.mark.parametrize("limit", ["tokens", "segments", "loss"])
def test_each_limit_binds(limit):
    """Where one of the limits is scarce, containers are full in that dimension."""
    rng = np.random.default_rng(4)
    size = rng.integers(1, 100, 3000)
    loss = (size * rng.random(3000)).astype(np.int64)
    room = {"tokens": (512, 1000, 512), "segments": (512, 4, 512), "loss": (512, 1000, 110)}[limit]
    at = packing.pack(size, loss, room[0], room[1], room[2])
    n = at.max() + 1
    used = np.bincount(at, weights=size).max(), np.bincount(at).max(), np.bincount(at, weights=loss).max()
    assert all(u <= r for u, r in zip(used, room))
    least = {"tokens": size.sum() / room[0], "segments": 3000 / room[1], "loss": loss.sum() / room[2]}[limit]
    assert n <= least * 1.02 + 1


def test_the_dot_product_decides():
    """With little loss room left, an item of the same size with less loss goes first."""
    size, loss = np.array([6, 6, 4, 4]), np.array([6, 0, 4, 0])
    at = packing.pack(size, loss, 10, loss_capacity=6)
    assert at.max() == 1 and max(np.bincount(at, weights=loss)) <= 6
    rng = np.random.default_rng(5)
    for _ in range(50):  # against a search of all items at each step
        n = int(rng.integers(1, 40))
        size = rng.integers(0, 20, n)
        loss = np.minimum(size, rng.integers(0, 20, n))
        assert len(set(packing.pack(size, loss, 20, 5, 20).tolist())) <= plain(size, loss, 20, 5, 20) * 1.25 + 1


def plain(size, loss, capacity, segments, loss_capacity):
    total = np.array([size.sum() / capacity, len(size) / segments, loss.sum() / loss_capacity])
    scarce, left, n = total / total.sum() if total.sum() else np.ones(3) / 3, list(range(len(size))), 0
    while left:
        room = np.array([capacity, segments, loss_capacity], dtype=float)
        while fits := [i for i in left if size[i] <= room[0] and room[1] >= 1 and loss[i] <= room[2]]:
            i = max(fits, key=lambda i: scarce[0] * size[i] * room[0] / capacity**2 + scarce[2] * loss[i] * room[2] / loss_capacity**2)
            left.remove(i)
            room -= (size[i], 1, loss[i])
        n += 1
    return n


def test_fill_with_prompts(spark):
    docs = spark.createDataFrame([(i, "word " * (5 + i % 30), 0.5 if i % 2 else None) for i in range(400)], "doc_id bigint, text string, loss double")
    specs = spark.createDataFrame([(1, "byte_bpe_50k", 100, 6, 60), (2, "byte_bpe_50k", 100, None, None), (3, "byte_bpe_50k", 8, 4, 4)], "spec_id int, tokenizer string, capacity_tokens int, segments int, loss_capacity int")
    filled = packing.fill(docs, specs, loss_col="loss")
    used = {}
    for r in filled.collect():
        x = used.setdefault((r["spec_id"], r["container"]), [0, 0, 0])
        x[0], x[1], x[2] = x[0] + r["tokens"], x[1] + 1, x[2] + r["loss"]
    for k, most in {1: (100, 6, 60), 2: (100, 400, 100), 3: (8, 4, 4)}.items():
        assert all(a <= b for (s, _), x in used.items() if s == k for a, b in zip(x, most))
    u = {r["spec_id"]: r for r in packing.usage(filled, specs).collect()}
    assert max(u[1]["filled"], u[1]["segments_filled"], u[1]["loss_filled"]) > 0.9 and u[2]["segments_filled"] is None


def test_packing_edges():
    assert packing.pack(np.zeros(0, int), np.zeros(0, int), 5).tolist() == []
    assert packing.pack(np.zeros(4, int), np.zeros(4, int), 5).tolist() == [0, 0, 0, 0]
    assert len(set(packing.pack(np.full(6, 5), np.full(6, 5), 5).tolist())) == 6
    with pytest.raises(ValueError):
        packing.pack(np.array([6]), np.array([6]), 5)


def test_fill(spark):
    docs = spark.createDataFrame([(1, "word " * 30), (2, "a b c"), (3, None), (4, ""), (5, "x y"), (5, "x y")], "doc_id bigint, text string")
    specs = spark.createDataFrame([(1, "byte_bpe_50k", 8), (2, "piece_bpe_32k", 1000)], "spec_id int, tokenizer string, capacity_tokens int")
    got = packing.fill(docs, specs).collect()
    one = [r for r in got if r["spec_id"] == 1]
    sizes = {}
    for r in one:
        sizes[r["container"]] = sizes.get(r["container"], 0) + r["tokens"]
    assert max(sizes.values()) <= 8
    assert sum(r["tokens"] for r in one if r["doc_id"] == 1) == 31 and [r["tokens"] for r in sorted(one, key=lambda r: r["piece_no"]) if r["doc_id"] == 1] == [8, 8, 8, 7]
    assert sum(r["doc_id"] == 5 for r in one) == 2 and {r["doc_id"] for r in one} == {1, 2, 3, 4, 5}
    assert all(r["piece_no"] == 0 for r in one if r["doc_id"] != 1)
    assert {r["container"] for r in got if r["spec_id"] == 2} == {"0-0"}
    assert packing.fill(docs.limit(0), specs).count() == 0 and packing.fill(docs, specs.limit(0)).count() == 0
    u = {r["spec_id"]: r for r in packing.usage(packing.fill(docs, specs), specs).collect()}
    assert u[2]["containers"] == 1 and 0 < u[2]["filled"] < 1


def test_pieces_are_counted_by_word_as_in_whole_texts():
    sentencepiece = pytest.importorskip("sentencepiece")
    model = sentencepiece.SentencePieceProcessor(model_file="/opt/tokenizers/piece_bpe_32k.model")
    texts = [None, "", " ", "  ", "\n", "a▁b", "▁▁", "▁x y", "x　y", "a\tb\n\nc", "ﬁn ½a", "①②", "한국어", "<s> </s> <unk>", "a " * 100, "🙂🙂 ok", "\x00a", "  lead", "trail  ", "a\xa0b", "﻿x", "x" * 5000, "a  b   c", "यदि दो विवरण", "Café “naïve”"]
    got = tokens.PieceCounter(model)(texts)
    assert got.tolist() == [len(model.encode(t or "")) for t in texts]
    whole = tokens.PieceCounter(model)
    whole.by_word = False
    assert whole(texts).tolist() == got.tolist()
