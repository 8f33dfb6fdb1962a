"""BPE, token counts and substring dedup against brute force."""

import random

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from kestrel.llm import bpe
from kestrel.llm.blocks import pack_arrays
from kestrel.llm.substring import NONE, Index, factors, substring_dedup
from kestrel.llm.token_count import count_tokens
from tests.llm.common import documents, empty, plain

PATTERN = public_tokenizers.PATTERN
RANKS = bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("t", pat_str=PATTERN, mergeable_ranks=RANKS, special_tokens={})


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab1'!s \n\t\u00a0\u2003é漢\x1f\x85")), max_size=24))
def test_words_hold_whole_pre_tokens(text):
    pat = regex.compile(PATTERN)
    pieces = bpe.words(text, pat)
    assert "".join(pieces) == text
    assert [m for p in pieces for m in pat.findall(p)] == pat.findall(text)


@pytest.mark.parametrize("block_bytes", [500, 8 << 20])
def test_bpe_is_the_librarys(spark, library, block_bytes):
    d = documents(spark)
    got = bpe.decode(bpe.encode(d, RANKS, PATTERN, block_bytes=block_bytes), RANKS).collect()
    want = sorted((str(i), t.encode(), np.array(library.encode_ordinary(t), "<u4").tobytes())
                  for i, t in plain(d))
    assert sorted((str(r.id), bytes(r.decoded), bytes(r.ids)) for r in got) == want
    assert all(r.n_tokens * 4 == len(r.ids) for r in got)


def test_decoding_takes_small_batches_of_rows(spark):
    # an Arrow batch would hold 10,000 rows of ids, however long
    out = bpe.decode(bpe.encode(documents(spark), RANKS, PATTERN), RANKS)
    plan = out._jdf.queryExecution().toString()
    assert "BatchEvalPython" in plan and "ArrowEvalPython" not in plan


def test_bpe_empty_table(spark):
    assert bpe.encode(empty(spark), RANKS, PATTERN).count() == 0


@pytest.mark.parametrize("chunk,overlap", [(65_536, 512), (200, 30), (50, 2)])
def test_token_counts_are_the_librarys(spark, chunk, overlap):
    d = documents(spark).union(documents(spark).limit(1).select(
        F.lit(90).cast("long").alias("doc_id"),
        F.lit("x <|endoftext|> y<|startoftext|>z " * 40).alias("text"),
        *documents(spark).columns[2:]))
    t = Tokenizer.from_file(VOCABULARY)
    want = sorted((str(i), len(x.encode()), len(t.encode(x, add_special_tokens=False).ids))
                  for i, x in plain(d))
    got = count_tokens(d, VOCABULARY, chunk_chars=chunk, overlap=overlap).collect()
    assert sorted((str(r.id), r.n_bytes, r.n_tokens) for r in got) == want


def test_token_counts_empty_table(spark):
    assert count_tokens(empty(spark), VOCABULARY).count() == 0


@pytest.mark.parametrize("block_bytes", [600, 16 << 20])
def test_substring_by_brute_force(spark, block_bytes):
    d = documents(spark)
    docs = [(i, t.encode().split()) for i, t in plain(d)]
    first = {}
    for i, w in docs:
        for s in range(len(w) - 12 if i is not None else 0):
            k = tuple(w[s:s + 13])
            first[k] = min(first.get(k, i), i)
    want = []
    for i, w in docs:
        gone = set()
        for s in range(len(w) - 12 if i is not None else 0):
            if first[tuple(w[s:s + 13])] < i:
                gone.update(range(s, s + 13))
        want.append((str(i), len(w), len(gone),
                     b" ".join(x for k, x in enumerate(w) if k not in gone).decode()))
    got = substring_dedup(d, block_bytes=block_bytes).collect()
    assert sorted((str(r.id), r.n_words, r.n_removed, r.kept) for r in got) == sorted(want)
    for r in got:
        covered = {x for f in r.factors for x in range(f.start, f.start + f.length)}
        assert len(covered) == r.n_removed and all(f.length >= 13 for f in r.factors)
    replayed, texts = 0, {}
    for i, w in docs:
        texts.setdefault(i, []).append(w)
    for r in got:                      # rows with the same id: any of their texts
        for f in r.factors:
            from_ref = {tuple(w[f.position:f.position + f.length]) for w in texts[f.reference]}
            mine = {tuple(w[f.start:f.start + f.length]) for w in texts[int(r.id)]}
            assert f.reference < int(r.id) and from_ref & mine
            replayed += 1
    assert replayed


def test_substring_empty_table(spark):
    assert substring_dedup(empty(spark)).count() == 0


def test_factors_end_with_their_reference():
    ref = np.array([NONE, 4, 4, 2, NONE, 7, 7, 7], np.int64)
    at = np.array([0, 8, 9, 10, 0, 1, 5, 6], np.int64)
    assert factors(ref, at, 3) == [(1, 4, 4, 8), (3, 3, 2, 10), (5, 3, 7, 1), (6, 4, 7, 5)]


def test_parse_follows_first_occurrences(spark):
    rng = random.Random(9)
    base = [[f"w{rng.randrange(400)}" for _ in range(120)] for _ in range(6)]
    rows = list(base)
    for _ in range(24):                                # slices of earlier documents
        words = []
        for _ in range(rng.randrange(1, 6)):
            w, at = rng.choice(rows), rng.randrange(100)
            words += [*w[at:at + rng.randrange(5, 60)], *(f"x{rng.randrange(9)}",) * rng.randrange(2)]
        rows.append(words)
    ids = rng.sample(range(1000), len(rows))
    first = {}
    for i, w in sorted(zip(ids, rows, strict=True)):
        for s in range(len(w) - 12):
            first.setdefault(tuple(w[s:s + 13]), (i, s))
    d = spark.createDataFrame([(i, " ".join(w)) for i, w in zip(ids, rows, strict=True)],
                              "doc_id long, text string").repartition(5)
    got = {int(r.id): r for r in substring_dedup(d, block_bytes=900).collect()}
    total = 0
    for i, w in zip(ids, rows, strict=True):
        want, s = [], 0
        while s < len(w) - 12:                         # the greedy parse, word by word
            r, q = first[tuple(w[s:s + 13])]
            if r < i:
                n = 13
                while first.get(tuple(w[s + n - 12:s + n + 1])) == (r, q + n - 12):
                    n += 1
                want.append((s, n, r, q))
                assert rows[ids.index(r)][q:q + n] == w[s:s + n]
                s += n - 12
            else:
                s += 1
        assert [tuple(f) for f in got[i].factors] == want
        total += len(want)
    assert total > 30


def test_order_of_windows_that_share_a_key():
    from kestrel.llm.substring import _order
    keys, checks = np.array([5, 7, 5, 5], np.uint64), np.array([1, 0, 2, 1], np.uint32)
    order, start = _order(keys, checks)
    assert order.tolist() == [0, 3, 2, 1] and start.tolist() == [0, 2, 3]


def test_windows_that_share_a_key_are_told_apart():
    kinds = (np.uint64, np.uint32, np.int64, np.uint32)
    index = Index([pack_arrays(*(np.array(x, k) for x, k in zip(a, kinds, strict=True)))
                   for a in (([5, 9], [1, 1], [20, 40], [3, 4]), ([5], [2], [30], [6]))])
    ref, at = index.look_up(np.array([5, 5, 5, 9, 1], np.uint64),
                            np.array([2, 1, 3, 1, 1], np.uint32))
    assert ref.tolist() == [30, 20, NONE, 40, NONE] and at[[0, 1, 3]].tolist() == [6, 3, 4]
