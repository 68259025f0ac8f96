"""Jaccard cells: long unlike documents that share a passage don't leave their cells as pairs, long near ones do."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from corvid.llm import jaccard as jc


def members(spark, sets, cells):
    named = [sorted(cells[k])[: jc.NAMED] + [0] * (jc.NAMED - len(cells[k])) for k in range(len(sets))]
    rows = [(c, 0, 0, 0, k, k, len(s), bytearray(jc.sharp_point(s)), named[k]) for k, s in enumerate(sets) for c in cells[k]]
    return spark.createDataFrame(rows, "cell long, block_a long, block_b long, side int, rep long, comp long, n long, point binary, named array<long>")


def test_long_unlike_sets_are_not_paired(spark):
    r = np.random.default_rng(3)
    draw = lambda n: np.unique(r.integers(0, 2**63, n).astype(np.uint64))
    base = draw(6000)
    near = np.unique(np.concatenate([base[:5700], draw(300)]))
    sets = [base, near, *(draw(6000) for _ in range(40))]
    got = jc.cell_pairs(members(spark, sets, [[7]] * len(sets)), 2)
    assert {tuple(x) for x in got.collect()} == {(0, 1)}
    few = [base, near, *sets[2:6]]  # cells of one leaf
    assert {tuple(x) for x in jc.cell_pairs(members(spark, few, [[7]] * len(few)), 2).collect()} == {(0, 1)}


def test_no_link_is_lost_by_the_bounds():
    r = np.random.default_rng(5)
    sets = []
    for n in (40, 300, 1023, 1024, 2047, 2048, 5000, 9000):
        whole = np.unique(r.integers(0, 2**63, n).astype(np.uint64))
        sets += [whole, whole[: int(0.76 * len(whole)) + 1], whole[: int(0.9 * len(whole))]]
    sets.append(np.arange(0, 3000 * 4096, 4096, dtype=np.uint64))  # one group has them all
    sets.append(sets[-1][:2500])
    n = np.array(list(map(len, sets)))
    p = jc.Points(pa.array(list(map(jc.sharp_point, sets))), n)
    excess = jc.excess_of(n, p.coarse)
    i, j = np.triu_indices(len(sets), 1)
    linked = np.array([bool(jc.enough(len(np.intersect1d(sets[a], sets[b])), n[a], n[b])) for a, b in zip(i, j)])
    assert linked.sum() > 8
    assert (p.near(i, j) & jc.enough(jc.overlap_bound(p.coarse[i], p.coarse[j], excess[i], excess[j]), n[i], n[j]))[linked].all()


def test_a_group_just_below_the_bound_is_not_all_its_pairs(spark):
    r = np.random.default_rng(7)
    draw = lambda n: np.unique(r.integers(0, 2**63, n).astype(np.uint64))
    base = draw(396)
    sets = [np.unique(np.concatenate([r.permutation(base)[:357], draw(39)])) for _ in range(40)]
    sets.append(np.unique(np.concatenate([sets[0][:370], draw(26)])))
    links = {(a, b) for b in range(len(sets)) for a in range(b) if jc.enough(len(np.intersect1d(sets[a], sets[b])), len(sets[a]), len(sets[b]))}
    got = {tuple(x) for x in jc.cell_pairs(members(spark, sets, [[7]] * len(sets)), 2).collect()}
    assert links and links <= got and len(got) < 150, len(got)  # of 820
