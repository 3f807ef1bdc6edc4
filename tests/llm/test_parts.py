"""Parts of the operators that work inside tasks."""

from __future__ import annotations

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from claimscope.llm.line_dedup import CuckooFilter
from claimscope.llm.near_dedup import REGISTERS, log_likelihood, may_reach, registers, shingle_set
from claimscope.llm.packing import best_fit_decreasing, bins_needed, piece_bounds
from claimscope.llm.sharding import hilbert_index
from claimscope.llm.toxicity import LexiconAutomaton, choose_terms, quoted


@pytest.mark.parametrize("n", [0, 1, 5, 1000, 60_000])
def test_cuckoo_filter_holds_and_forgets(n):
    dice = np.random.default_rng(n)
    keys = np.unique(dice.integers(0, 1 << 63, n, dtype=np.uint64))
    held = CuckooFilter.from_bytes(CuckooFilter.holding(keys).to_bytes())
    assert held.has(keys).all()
    other = dice.integers(0, 1 << 63, 20_000, dtype=np.uint64)
    assert held.has(other).mean() < 0.002
    held.remove(keys[::2])
    assert held.has(keys[1::2]).all() and held.has(keys[::2]).sum() <= 0.01 * n
    assert held.add(keys[::2]) and held.has(keys).all()


def sets_at(jaccard: float, n: int, dice) -> tuple[np.ndarray, np.ndarray]:
    common = round(n * 2 * jaccard / (1 + jaccard))
    pool = np.unique(dice.integers(0, 1 << 63, 3 * n, dtype=np.uint64))
    dice.shuffle(pool)
    return np.sort(pool[:n]), np.sort(np.r_[pool[:common], pool[n:2 * n - common]])


def test_registers_are_mergeable_and_their_likelihood_finds_the_similarity():
    dice = np.random.default_rng(5)
    grid = np.linspace(0, 1, 101)
    for jaccard in (0.2, 0.5, 0.8, 0.95):
        best = []
        for _ in range(30):
            a, b = sets_at(jaccard, 400, dice)
            x, y = registers(a), registers(b)
            assert (registers(np.union1d(a, b)) == np.maximum(x, y)).all()
            more, less = int((x > y).sum()), int((x < y).sum())
            best.append(grid[np.argmax(log_likelihood(np.full(101, more), np.full(101, less), np.full(101, 0.5), grid))])
            if jaccard >= 0.8:
                assert may_reach(np.array([more]), np.array([less]), np.array([0.5]), 0.8)[0]
            if jaccard <= 0.5:
                assert not may_reach(np.array([more]), np.array([less]), np.array([0.5]), 0.8)[0]
        assert abs(np.mean(best) - jaccard) < 0.03
    assert len(x) == REGISTERS


def test_shingles_of_few_words():
    assert len(shingle_set(None, 2)) == len(shingle_set(" \n", 2)) == 0
    assert len(shingle_set("one", 2)) == 1 and len(shingle_set("a b a b", 2)) == 2
    assert (shingle_set("A B\x0bC", 2) == shingle_set("a b c", 2)).all() and (shingle_set("Ä b", 2) != shingle_set("ä b", 2)).all()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 100), max_size=60))
def test_best_fit_keeps_to_its_bound(lengths):
    sizes = np.array(lengths, np.int64)
    bins, offsets, count = best_fit_decreasing(sizes, 100)
    fill = np.bincount(bins, sizes, minlength=count) if lengths else np.zeros(0)
    assert (fill <= 100).all() and len(fill) == count
    for b in range(count):
        at = sorted((int(o), int(n)) for o, n, x in zip(offsets, sizes, bins, strict=True) if x == b)
        assert [o for o, _ in at] == [sum(n for _, n in at[:i]) for i in range(len(at))]
    bound = bins_needed(np.bincount(sizes, minlength=101) if lengths else np.zeros(101, np.int64), 100)
    assert bound <= count <= 1.5 * bound + 1


def test_bounds_see_more_than_the_sum():
    assert bins_needed(np.bincount([51] * 10, minlength=101), 100) == 10
    assert bins_needed(np.bincount([34] * 9, minlength=101), 100) == 5
    assert bins_needed(np.bincount([60] * 4 + [41] * 4, minlength=101), 100) == 6


def test_piece_bounds():
    assert piece_bounds(5, 10) == [(0, 5)] and piece_bounds(10, 10) == [(0, 10)] and piece_bounds(25, 10) == [(0, 5), (5, 10), (15, 10)]


@pytest.mark.parametrize(("dims", "bits"), [(2, 3), (3, 2), (4, 2)])
def test_the_curve_visits_neighbours(spark, dims, bits):
    from pyspark.sql import functions as F

    cells = spark.range(1 << (dims * bits)).select(*[F.shiftright("id", bits * i).bitwiseAND(F.lit((1 << bits) - 1)).cast("int").alias(f"x{i}") for i in range(dims)])
    rows = cells.withColumn("at", hilbert_index([F.col(f"x{i}") for i in range(dims)], bits)).orderBy("at").collect()
    assert [r["at"] for r in rows] == list(range(1 << (dims * bits)))
    assert all(sum(abs(a[i] - b[i]) for i in range(dims)) == 1 for a, b in zip(rows, rows[1:], strict=False))


def distance(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        last, row[0] = row[0], i + 1
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], min(row[j + 1] + 1, row[j] + 1, last + (x != y))
    return row[-1]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.text("abc", min_size=1, max_size=11), min_size=1, max_size=5), st.text("abcd", max_size=12), st.booleans())
def test_the_automaton_agrees_with_edit_distance(terms, word, edit):
    if edit and len(terms[0]) > 3:
        word = terms[0][:2] + "d" + terms[0][3:]
    found = LexiconAutomaton(terms, ["dab"]).edits_to(word)
    allowed = {t: 0 if len(t) < 5 else 1 if len(t) < 9 else 2 for t in terms}
    near = [distance(t, word) for t in terms if distance(t, word) <= allowed[t]]
    if word.startswith("dab"):
        assert found == 0
    else:
        assert found == min(near, default=-1)


def test_terms_and_quotation():
    rows = [("tra", 60, 1), ("tras", 60, 0), ("trash", 60, 0), ("trash$", 59, 0), ("low", 80, 40), ("lowe", 50, 0), ("lowei", 50, 0), ("loweia", 20, 0), ("loweib", 30, 0), ("the", 500, 900)]
    words, stems = choose_terms(rows, 1000, 4000, 5000)
    assert words == ["trash"] and stems == ["lowei"]
    text = 'He said "you trash" once. You trash!'
    first, second = text.index("trash"), text.rindex("trash")
    assert quoted(text, first, first + 5) and not quoted(text, second, second + 5)
    assert quoted("the word trash is rude", 9, 14)
