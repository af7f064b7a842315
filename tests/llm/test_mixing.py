from __future__ import annotations

import random
import re
from collections import defaultdict

import numpy as np
import pytest

from tillmark.llm import mixing
from tillmark.llm.mixing import fit_lengths, mix, repeat_to_weights, targets


def plain_targets(sizes, weights=(3, 1, 2), share=1.5):
    """Give out by weight, cut what is above twice the source, give out the excess again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    budget, free, out = share * sum(sizes.values()), set(order), {}
    while free:
        rest = budget - sum(out.values())
        part = {s: rest * weight[s] / sum(weight[t] for t in free) for s in free}
        over = {s for s in free if part[s] > 2 * sizes[s]}
        if not over:
            return {**out, **part}
        out.update({s: 2.0 * sizes[s] for s in over})
        free -= over
    return out


@pytest.mark.parametrize("seed", range(6))
def test_targets_equal_repeated_sharing(spark, seed):
    random.seed(seed)
    sizes = {s: random.choice([0, 1, 10, 1000, random.randint(1, 100_000)]) for s in [None, "", "B", "a", "é", "z", "~", "10", "9"]}
    got = {r.source: r.target for r in targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()}
    want = plain_targets(sizes)
    assert got.keys() == want.keys() and all(abs(got[s] - want[s]) < 1e-6 * (1 + want[s]) for s in want)


@pytest.mark.parametrize("seed", range(20))
def test_lengths_come_as_close_as_can_be(seed):
    random.seed(seed)
    lengths = np.array(sorted(random.sample(range(0, 40), 6)))
    counts = np.array([random.randint(1, 4) for _ in lengths])
    budget = random.randint(0, int((lengths * counts).sum()))
    sums = {0}
    for size, count in zip(lengths, counts, strict=True):
        sums = {s + size * k for s in sums for k in range(count + 1)}
    take = fit_lengths(lengths, counts, budget)
    got = int((take * lengths).sum())
    assert (take >= 0).all() and (take <= counts).all() and got <= budget
    # Shares are taken first, so what is best is what the rest can still add up to.
    assert budget - got <= max(lengths) and got in sums


def test_long_documents_and_large_budgets_fit():
    lengths, counts = np.array([1, 7, 900, 50_000, 2_000_000]), np.array([30, 10, 5000, 40, 3])
    for budget in (0, 5, 123_456, 3_333_333, 7_000_000):
        take = fit_lengths(lengths, counts, budget)
        left = budget - int((take * lengths).sum())
        # What is open is less than any document that is left.
        assert (take <= counts).all() and 0 <= left and all(left < size for size, n, t in zip(lengths, counts, take, strict=True) if t < n)


def test_mixture_of_odd_rows(odd, none):
    taken, sizes, wanted = defaultdict(int), defaultdict(int), {}
    found = mix(odd).collect()
    texts = defaultdict(set)
    for r in odd.collect():
        texts[r.doc_id].add(len(re.findall(r"[^\x20\x09-\x0d]+", r.text or "")))
    for r in found:
        assert r["size"] in texts[r.doc_id] and 0 <= r.copies <= 2
        taken[r.source] += r["size"] * r.copies
        sizes[r.source] += r["size"]
        wanted[r.source] = r.target
    assert len(found) == odd.count() and all(r.source_size == sizes[r.source] for r in found)
    want = plain_targets(sizes)
    assert all(abs(wanted[s] - want[s]) < 1e-6 * (1 + want[s]) for s in want)
    assert mix(none).isEmpty() and repeat_to_weights(none).isEmpty()


def test_taken_words_meet_their_targets_again_and_again(make, monkeypatch, rows):
    """A source with most rows, most of them of one length, whose ranks are dealt into many ranges."""
    random.seed(1)
    docs = make([(i, "w " * (5 if i % 3 else random.randint(0, 60)), None, "hot" if i % 4 else f"s{i % 16}") for i in range(3000)])
    monkeypatch.setattr(mixing, "BUCKET", 100)
    found = mix(docs).collect()
    taken, target = defaultdict(int), {}
    for r in found:
        taken[r.source] += r["size"] * r.copies
        target[r.source] = r.target
    assert all(abs(taken[s] - target[s]) <= 5 for s in target)
    again = mix(docs.repartition(5))
    assert rows(again, "doc_id", "copies") == sorted(((r.doc_id, r.copies) for r in found), key=repr)


def test_rows_come_as_often_as_they_are_taken(odd):
    copies = sum(r.copies for r in mix(odd).collect())
    out = repeat_to_weights(odd)
    assert out.columns == odd.columns and out.count() == copies


@pytest.mark.parametrize("seed", range(4))
def test_lengths_of_single_documents_take_part_in_proportion(seed):
    """Mostly lengths that one document has: each band of lengths gives about the share of its documents."""
    random.seed(seed)
    lengths = np.array(sorted(random.sample(range(20, 20_000), 1200)))
    counts = np.array([1 if random.random() < 0.9 else 3 for _ in lengths])
    for share in (0.2, 0.5, 0.8):
        budget = int((lengths * counts).sum() * share)
        take = fit_lengths(lengths, counts, budget, seed=seed)
        assert (take >= 0).all() and (take <= counts).all() and int((take * lengths).sum()) == budget
        for band in np.array_split(np.arange(len(lengths)), 4):
            assert abs(take[band].sum() / counts[band].sum() - share) < 0.05
    other = fit_lengths(lengths, counts, budget, seed=seed + 1)
    assert (other != take).any()


def test_long_lengths_alone_come_close():
    """All lengths exceed FIT: the knapsack runs over several documents all the same."""
    lengths = np.array(sorted(random.Random(3).sample(range(9_000, 60_000), 400)))
    counts = np.ones(400, dtype=int)
    budget = int(lengths.sum() * 0.37)
    left = budget - int((fit_lengths(lengths, counts, budget) * lengths).sum())
    assert 0 <= left < 100
    assert 0 <= 500_000_000 - int((fit_lengths(lengths * 100, counts, 500_000_000) * lengths * 100).sum()) < 900_000
