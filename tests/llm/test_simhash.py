"""Fingerprints bit by bit, components by brute force."""

from __future__ import annotations

import random
import re
import struct

import numpy as np
import pytest
import xxhash

from driverlens.llm import components, simhash
from driverlens.llm.common import ascii_lower  # noqa: F401
from fixtures import ROWS, frame


def plain_fingerprint(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    found = re.findall("[^\x20\x09-\x0d]+", lower)
    shingles = [" ".join(found[i : i + 3]) for i in range(max(1, len(found) - 2))] if found else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(bits):
    parent = list(range(len(bits)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(bits)):
        for j in range(i):
            if (bits[i] ^ bits[j]).bit_count() <= 2:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(bits))]


@pytest.mark.parametrize("row", ROWS, ids=range(len(ROWS)))
def test_fingerprint(row):
    assert simhash.fingerprint(row[1]) == struct.unpack("<q", struct.pack("<Q", plain_fingerprint(row[1])))[0]


def test_fingerprint_over_many_blocks(monkeypatch):
    monkeypatch.setattr(simhash, "HASHED", 7)
    for row in ROWS[:3]:
        assert simhash.fingerprint(row[1]) & (2**64 - 1) == plain_fingerprint(row[1])


def test_documents(spark):
    out = simhash.near_duplicates(frame(spark)).collect()
    assert len(out) == len(ROWS)
    by_id = {r.doc_id: r for r in out}
    assert by_id[3].fingerprint == by_id[5].fingerprint == "0" * 16
    assert {by_id[i].component_id for i in (3, 4, 5)} == {3}
    assert by_id[0].component_id == by_id[1].component_id == 0
    assert by_id[None].component_id is None
    kept = simhash.deduplicate(frame(spark)).collect()
    assert len(kept) == len({plain for plain in plain_components([plain_fingerprint(r[1]) for r in ROWS])})
    assert set(kept[0].asDict()) == set(frame(spark).columns) and all(r.simhash_row == "r" for r in kept)
    assert [r.doc_id for r in kept].count(7) == 1


def test_empty_table(spark):
    assert simhash.near_duplicates(frame(spark, [])).collect() == []
    assert simhash.deduplicate(frame(spark, [])).collect() == []


def test_index_finds_every_link(spark, monkeypatch):
    rng = random.Random(4)
    for name, value in (("LEAF", 16), ("FANOUT", 2), ("ROOTS", 4), ("BLOCK", 4)):
        monkeypatch.setattr(simhash, name, value)
    bits = {rng.getrandbits(64) for _ in range(150)}
    for seed in list(bits)[:40]:  # chains and dense groups of near fingerprints
        here = seed
        for _ in range(rng.randint(1, 12)):
            here ^= (1 << rng.randrange(64)) | (1 << rng.randrange(64))
            bits.add(here)
    bits = sorted(bits)
    entries = spark.createDataFrame([(struct.unpack("<q", struct.pack("<Q", b))[0],) for b in bits], "bits BIGINT")
    found = components.components(simhash.links(entries)).collect()
    got = {r.node & (2**64 - 1): r.component for r in found}
    want = plain_components(bits)
    groups = {}
    for b, c in zip(bits, want):
        groups.setdefault(c, set()).add(b)
    for group in groups.values():
        assert len({got.get(b, ("alone", b)) for b in group}) == 1
    assert len({got.get(b, ("alone", b)) for b in bits}) == len(groups)


def test_dense_group_returns_a_forest_only():
    bits = np.arange(1 << 10, dtype="<u8")
    x, y = simhash._linked(bits, bits, 2)
    u, _ = simhash._forest(bits, x, y)
    assert len(u) == len(bits) - 1


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 100), (5, 4)], "u BIGINT, v BIGINT")
    got = {r.node: r.component for r in components.components(edges).collect()}
    assert got == {i: 0 for i in range(61)}
