from __future__ import annotations

import re

import xxhash

from tillmark.llm.components import least_reachable
from tillmark.llm.simhash import fingerprint, keep_one_per_group, near_duplicate_groups, near_links


def plain_fingerprint(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0d]+", text)
    grams = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(items):
    """items: (id, fingerprint); the smallest id of each item's component."""
    groups = []
    for i, f in items:
        near = [g for g in groups if any((f ^ x).bit_count() <= 2 for _, x in g)]
        groups = [g for g in groups if g not in near] + [sum(near, []) + [(i, f)]]
    return {(i, f): min((j for j, _ in g if j is not None), default=None) for g in groups for i, f in g}


def test_groups_equal_brute_force_on_odd_rows(odd, rows):
    want = [(r.doc_id, plain_fingerprint(r.text)) for r in odd.collect()]
    named = plain_components(want)
    got = [(i, b & (2 ** 64 - 1), c) for i, b, c in rows(near_duplicate_groups(odd), "doc_id", "bits", "component_id")]
    assert sorted(got, key=repr) == sorted([(i, f, named[i, f]) for i, f in want], key=repr)


def test_no_rows_give_no_rows(none):
    assert near_duplicate_groups(none).isEmpty() and keep_one_per_group(none).isEmpty()


def test_ties_in_a_bit_leave_it_unset():
    two = [xxhash.xxh64_intdigest(g, 42) for g in (b"a b c", b"b c d")]
    assert fingerprint("A b c d") == two[0] & two[1]


def test_links_of_crowded_buckets_are_all_found(spark):
    """A chain, a cloud around one point and loose points, with buckets of any size and of one member."""
    chain = [sum(1 << b for b in range(n)) for n in range(0, 40, 2)]
    cloud = [(1 << 63) | (1 << b) for b in range(40)]
    values = sorted({x - (1 << 64) if x >> 63 else x for x in [*chain, *cloud, 0x5555555555555555, 0x0F0F0F0F0F0F0F0F]})
    points = spark.createDataFrame([(v,) for v in values], "bits long")
    want = plain_components([(v, v & (2 ** 64 - 1)) for v in values])
    for bucket in (1, 8, 1000):
        roots = {r.node: r.root for r in least_reachable(near_links(points, bucket)).collect()}
        assert {v: roots.get(v, v) for v in values} == {v: c for (v, _), c in want.items()}


def test_long_chains_and_stars_reach_their_least_node(spark):
    links = [(i, i + 1) for i in range(200)] + [(1000, i) for i in range(1001, 1100)] + [(5, 5), (1, 0)]
    found = {r.node: r.root for r in least_reachable(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(201)}, **{i: 1000 for i in range(1000, 1100)}}


def test_one_of_each_group_stays(odd, make):
    kept = keep_one_per_group(odd)
    assert kept.columns == odd.columns
    groups = {r.root for r in near_duplicate_groups(odd).collect()}
    assert kept.count() == len(groups)
    same_id = make([(1, "one two three four", None, None), (1, "five six seven eight", None, None)])
    assert keep_one_per_group(same_id).count() == 2
