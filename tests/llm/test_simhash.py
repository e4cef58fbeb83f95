from __future__ import annotations

from collections import defaultdict

import numpy as np
import pytest
from xxhash import xxh64_intdigest

from quillframe.llm.queries import REGISTRY, documents
from quillframe.llm.simhash import BITS, GrayIndex, fingerprint, keep_one_of_each, links, simhash_components


def plain_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(marks, most=3):
    """The smallest identifier that each place reaches, by comparing all."""
    bits = np.array([mark for _, mark in marks], dtype=np.uint64)
    root = list(range(len(bits)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(bits)):
        for j in np.flatnonzero(np.bitwise_count(bits[i] ^ bits[i + 1 :]) <= most) + i + 1:
            a, b = find(i), find(int(j))
            root[max(a, b)] = min(a, b)
    least = defaultdict(list)
    for i, (ident, _) in enumerate(marks):
        least[find(i)].append(ident)
    return [min((x for x in least[find(i)] if x is not None), default=None) for i in range(len(bits))]


def check(found, docs):
    marks = [(d, plain_fingerprint(t)) for d, t in docs]
    expected = sorted(((str(d), f"{mark:016x}", str(c)) for (d, mark), c in zip(marks, plain_components(marks))))
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in found) == expected


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01"])
def test_a_table(spark, scale):
    folder = f"/root/testdata/{scale}"
    check(REGISTRY["op4_simhash"][0](spark, folder).collect(), [(r.doc_id, r.text) for r in documents(spark, folder).collect()])


def test_odd_rows(spark, odd, none):
    check(simhash_components(odd).collect(), [(r.doc_id, r.text) for r in odd.collect()])
    assert simhash_components(none).count() == 0
    kept = keep_one_of_each(odd)
    assert kept.columns == odd.columns
    components = plain_components([(i, plain_fingerprint(r.text)) for i, r in enumerate(odd.collect())])
    assert kept.count() == len(set(components))
    assert keep_one_of_each(none).count() == 0


def test_the_index_against_all_pairs():
    draw = np.random.default_rng(3)
    centres = draw.integers(0, 1 << 63, 12, dtype=np.uint64)
    flips = np.array([sum(1 << int(b) for b in draw.choice(64, draw.integers(0, 5), replace=False)) for _ in range(900)], dtype=np.uint64)
    rows = np.unique(centres[draw.integers(0, 12, 900)] ^ flips)
    groups = np.sort(draw.integers(0, 7, len(rows)))
    index = GrayIndex(rows, groups)
    query, node = index.near(rows, groups, 3)
    found = set(zip(query.tolist(), node.tolist()))
    apart = np.bitwise_count(rows[:, None] ^ rows[None, :])
    assert found == {(i, j) for i, j in zip(*np.nonzero(apart <= 3)) if groups[i] == groups[j]}


def test_a_large_group_of_near_copies_spans_tasks(spark):
    draw = np.random.default_rng(5)
    bits = np.unique(np.array([sum(1 << int(b) for b in draw.choice(64, 2, replace=False)) for _ in range(1500)], dtype=np.uint64) ^ np.uint64(0xF0F0_1234_5678_9ABC)).view(np.int64)
    chain = np.array([(1 << (3 * i)) - 1 for i in range(1, 16)], dtype=np.int64)  # each differs from the next by three bits
    distinct = spark.createDataFrame([(int(x),) for x in np.r_[bits, chain]], "fp long")
    from quillframe.llm.components import connected_components

    roots = {r.node: r.root for r in connected_components(links(distinct, 3, rows_per_task=100)).collect()}
    everything = np.r_[bits, chain]
    expected = plain_components([(i, np.uint64(x)) for i, x in enumerate(everything.view(np.uint64))])
    groups = defaultdict(set)
    for i, x in enumerate(everything.tolist()):
        groups[roots.get(x, x)].add(i)
    wanted = defaultdict(set)
    for i, c in enumerate(expected):
        wanted[c].add(i)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, wanted.values()))


def test_bits():
    assert BITS == 64 and fingerprint(b"", 3) == 0 and fingerprint(b"a B c D", 3) == plain_fingerprint("A b C d")
