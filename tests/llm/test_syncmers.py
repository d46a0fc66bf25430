"""Syncmer fingerprints against plain Python: anchors from their definition, neighbours from a sorted list."""

import hashlib
import random

import pytest
import xxhash
from pyspark.sql import functions as F

from kasane.llm import syncmers
from kasane.llm.syncmers import K, S

SCHEMA = "doc_id long, text string, range int, guest int, own string, n_chars string"


def signed(data):
    h = xxhash.xxh64(data, seed=42).intdigest()
    return h - 2**64 if h >= 2**63 else h


def anchors_of(text, most=syncmers.ANCHORS):
    """{hash: first place} of the smallest hashes."""
    data, found = b"\0" * (K - 1) + text.encode(), {}
    for i in range(len(data) - K + 1 if text else 0):
        inner = [signed(data[i + j : i + j + S]) for j in range(K - S + 1)]
        if min(inner) in (inner[0], inner[-1]):
            found.setdefault(signed(data[i : i + K]) >> 32, i)
    return dict(sorted(found.items())[:most])


def written(found):
    return "".join(f"{((h << 32) | at) & (2**64 - 1):016x}" for h, at in found.items())


def alike(a, b, most=syncmers.ANCHORS):
    if a == b:
        return 1.0
    sample = sorted({*a, *b})[:most]
    shifts = [b[h] - a[h] for h in sample if h in a and h in b]
    return sum(s == 0 or shifts.count(s) > 1 for s in shifts) / len(sample)


def plain(rows):
    order = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0), r[1].encode()))
    out = []
    for at, (i, t) in enumerate(order):
        after, half = order[(at + 1) % len(order)][1], len(t) // 2
        edited = t[: len(t) - half] + after[:half]
        a, b, c = anchors_of(t), anchors_of(edited), anchors_of(after)
        out.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), written(a), written(b), alike(a, b), alike(a, c)))
    return sorted(out, key=str)


def check(spark, rows):
    found = syncmers.fingerprints(spark.createDataFrame([(i, t, 1, 2, "x", "y") for i, t in rows], SCHEMA).repartition(3))
    assert found.columns == ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    got = sorted((tuple(r) for r in found.collect()), key=str)
    assert got == plain(rows)
    return got


@pytest.mark.parametrize("range_bytes", [1 << 22, 3000])
def test_against_plain_python(spark, rows, monkeypatch, range_bytes):
    """Both in one range of ids and in many, whose borders fall anywhere."""
    monkeypatch.setattr(syncmers, "RANGE_BYTES", range_bytes)
    more = [(80, "a" * 300), (81, "ab"), (82, "x"), (83, "x"), (-5, "漢字" * 40), (2**40, "end " * 30)]
    got = check(spark, [(i, t[:9000] if t else t) for i, t in rows] + more)
    assert any(r[6] == 1.0 for r in got) and any(0 < r[5] < 1 for r in got)


@pytest.mark.parametrize("rows", [[(7, "only one row of text")], [(None, "a b c d e f g"), (None, None), (None, "z")], [(3, "same"), (3, "same"), (3, "same")], [(1, None), (2, "")]])
def test_single_null_and_repeated_ids(spark, rows):
    check(spark, rows)


def test_empty_table(spark, empty):
    assert syncmers.fingerprints(empty).collect() == []


def test_ranges_have_one_neighbour_across_each_border(spark, monkeypatch):
    """Sparse ids beyond 2^53, where borders are not exact numbers, and ids of very uneven distances."""
    monkeypatch.setattr(syncmers, "RANGE_BYTES", 256)
    rng = random.Random(2)
    ids = sorted({*(2**62 + i for i in range(40)), *(rng.randrange(10**6) for _ in range(40)), *(-(10**12) - i * i for i in range(40))})
    check(spark, [(i, f"text number {i} " + "word " * rng.randint(0, 9)) for i in ids])


def test_long_text_in_pieces(spark):
    """The pieces of a long text give the anchors of the whole."""
    rng = random.Random(4)
    text = " ".join(str(rng.random()) for _ in range(2000))
    got = spark.createDataFrame([(text,)], "t string").select(syncmers.written(syncmers.sketch(syncmers.all_anchors(F.col("t"))))).first()[0]
    assert len(text) > 8 * syncmers.PIECE and got == written(anchors_of(text))


def test_anchors_do_not_depend_on_what_surrounds_them():
    rng = random.Random(9)
    passage = " ".join(str(rng.random()) for _ in range(60))
    first, second = (anchors_of(f"{head}{passage}{tail}", 10**6) for head, tail in (("one start ", " an end"), ("quite another beginning ", " and so on")))
    shared = [second[h] - first[h] for h in first if h in second]
    assert len(shared) > 0.9 * len(anchors_of(passage, 10**6)) - 2 * K and max(map(shared.count, shared)) > 0.95 * len(shared)
