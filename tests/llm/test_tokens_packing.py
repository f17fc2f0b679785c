import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from quirework.llm import packing, tokens

FILE = tokens.vocabulary()
DOCS = "doc_id bigint, text string, ids string, n_tokens string"


def docs(spark, texts):
    return spark.createDataFrame([(i, t, "clash", "clash") for i, t in enumerate(texts)], DOCS)


ODD = [None, "", " ", "\n\n", "<|endoftext|>", "a" * 5000, "é" * 300, "新" * 3000, "x " * 30_000, " " * 3000 + "a", "don't we'll I'd 's 'S", "１２3a٣", "👩🏽‍💻🗂️", "﻿​ a", "\r\n\t x", "12345 67,890.12abc!?'re"]


def test_ids_agree_with_another_library(spark):
    other = Tokenizer.from_file(FILE.replace(".tiktoken", ".json"))
    other.encode_special_tokens = True
    got = {r["doc_id"]: r["ids"] for r in tokens.encode_documents(docs(spark, ODD)).collect()}
    assert len(got) == len(ODD)
    for i, t in enumerate(ODD):
        assert got[i] == (other.encode(t, add_special_tokens=False).ids if t else [])
    assert tokens.round_trip(docs(spark, ODD)).where("NOT same").count() == 0
    assert tokens.encode_documents(docs(spark, ODD).where("false")).count() == 0


ALPHABET = st.sampled_from(list("ab' \n\t1.,-é新👩'sSdtlre") + ["'s", "'ll", "  ", "<|endoftext|>"])


@settings(max_examples=300, deadline=None)
@given(st.lists(ALPHABET, max_size=80).map("".join), st.integers(1, 20))
def test_pieces_do_not_change_ids(text, size):
    enc = tokens.encoder(FILE)
    parts = tokens.pieces(text, size)
    assert "".join(parts) == text
    assert [i for p in parts for i in enc.encode_ordinary(p)] == enc.encode_ordinary(text)


def check(rows, sizes, capacity):
    """Every text once, whole unless it is too long; no container over its capacity."""
    per_doc, used = {}, {}
    for r in rows:
        per_doc.setdefault(r["doc_id"], []).append((r["piece_no"], r["start_token"], r["n_tokens"]))
        used[r["container"]] = used.get(r["container"], 0) + r["n_tokens"]
    assert set(per_doc) == set(range(len(sizes)))
    for i, n in enumerate(sizes):
        parts = sorted(per_doc[i])
        assert [p for p, *_ in parts] == list(range(len(parts)))
        at = 0
        for _, start, k in parts:
            assert start == at
            at += k
        assert at == n and (len(parts) == 1 if n <= capacity else len(parts) == -(-n // capacity))
    assert max(used.values(), default=0) <= capacity
    return used


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 60), max_size=25), st.integers(40, 64))
def test_patterns_place_the_histogram(histogram, capacity):
    found: dict[int, int] = {}
    for count, content in packing.patterns(histogram, capacity):
        assert count > 0 and sum(n * k for n, k in content) <= capacity
        for n, k in content:
            found[n] = found.get(n, 0) + count * k
    assert found == histogram
    ranks: dict[int, int] = {}
    for n, first, last, _, each in packing.slots(packing.patterns(histogram, capacity)):
        assert first == ranks.get(n, 0) and (last - first + 1) % each == 0
        ranks[n] = last + 1
    assert ranks == histogram


def test_the_shortest_pack_takes_the_next_length():
    # best fit would set 3 beside 6, where it leaves the least room
    assert sorted(packing.patterns({6: 1, 5: 1, 3: 1}, 10)) == [(1, [(3, 1), (5, 1)]), (1, [(6, 1)])]
    assert sorted(packing.patterns({7: 4, 6: 2, 2: 3}, 10)) == [(1, [(2, 1), (7, 1)]), (2, [(2, 1), (6, 1)]), (3, [(7, 1)])]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 30), max_size=80))
def test_patterns_are_those_of_one_length_at_a_time(lengths):
    packs: list[list[int]] = []
    for n in sorted(lengths, reverse=True):
        shortest = min(packs, key=sum, default=None)
        if shortest is not None and sum(shortest) + n <= 30:
            shortest.append(n)
        else:
            packs.append([n])
    histogram: dict[int, int] = {}
    for n in lengths:
        histogram[n] = histogram.get(n, 0) + 1
    got = sorted(sum(n * k for n, k in content) for count, content in packing.patterns(histogram, 30) for _ in range(count))
    assert got == sorted(map(sum, packs))


@pytest.mark.parametrize("capacity", [7, 64])
def test_packing(spark, capacity):
    rng = random.Random(capacity)
    sizes = [rng.choice([0, 1, 3, 5, 5, 5, 30, 64, 65, 200, rng.randint(0, 90)]) for _ in range(500)]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(sizes)], "doc_id bigint, n_tokens int")
    used = check(packing.pack(df, capacity).collect(), sizes, capacity)
    bound = -(-sum(sizes) // capacity)
    assert len([c for c, n in used.items() if n]) <= bound * 1.06 + 1


def test_hot_length_is_ranked_in_buckets(spark, monkeypatch):
    monkeypatch.setattr(packing, "RANK_ROWS", 50)
    sizes = [5] * 700 + [3] * 20
    df = spark.createDataFrame([(i, n) for i, n in enumerate(sizes)], "doc_id bigint, n_tokens int")
    check(packing.pack(df, 16).collect(), sizes, 16)
    monkeypatch.setattr(packing, "AT_ONCE", 2)
    both = packing.pack_sizes(df, [(1, 16), (2, 4), (3, 50)]).collect()
    for capacity_id, capacity in ((1, 16), (2, 4), (3, 50)):
        check([r for r in both if r["capacity_id"] == capacity_id], sizes, capacity)


def test_odd_packings(spark):
    empty = spark.createDataFrame([], "doc_id bigint, n_tokens int")
    assert packing.pack(empty, 8).count() == 0
    only_empty = spark.createDataFrame([(0, 0), (1, 0)], "doc_id bigint, n_tokens int")
    assert {r["container"] for r in packing.pack(only_empty, 8).collect()} == {0}
    for bad in (0, -1, None):
        with pytest.raises(ValueError):
            packing.pack(empty, bad)
    same = spark.createDataFrame([(None, 5), (None, 5), (7, 12), (7, 12), (None, None)], "doc_id bigint, n_tokens int").fillna(0, ["n_tokens"])
    used = {}
    for r in packing.pack(same, 8).collect():
        used.setdefault(r["container"], []).append(r["n_tokens"])
    assert sorted(map(sum, used.values())) == [5, 5, 8, 8, 8] or max(map(sum, used.values())) <= 8 and sum(map(sum, used.values())) == 34
    caps = spark.createDataFrame([(1, 4), (2, 100)], "capacity_id int, capacity_tokens int")
    packed = packing.pack_all(docs(spark, ODD), caps)
    assert {r["capacity_id"] for r in packed.select("capacity_id").distinct().collect()} == {1, 2}
    assert packed.where("capacity_id = 2").select("doc_id").distinct().count() == len(ODD)
    assert packing.pack_all(docs(spark, ODD), caps.where("false")).count() == 0
    assert packing.fill(packed).where("capacity_id = 1 AND used > 4").count() == 0
