"""Manifest proofs, part codes and the metric join against brute-force versions."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from jobnest.llm import jaccard_join, merkle, part_codes
from test_operators import EDGE, clash, docs_frame, prose

H = lambda s: hashlib.sha256(s.encode()).hexdigest()
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# ---- 11 ----------------------------------------------------------------------------------------------------------


def brute_proofs(rows) -> list:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified), by loops."""
    part = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda r, t: H("".join(map(part, (r[0], r[3], r[2], None if r[1] is None else len(r[1]), t))))

    def tree(nodes):
        where, proofs = list(range(len(nodes))), [[] for _ in nodes]
        while len(nodes) > 1:
            for i, w in enumerate(where):
                run = w // 16 * 16
                proofs[i].append(("".join(nodes[run:w]), "".join(nodes[w + 1: run + 16])))
                where[i] = w // 16
            nodes = [H("".join(nodes[i: i + 16])) for i in range(0, len(nodes), 16)]
        return nodes[0], proofs

    sources: dict = {}
    for r in rows:
        sources.setdefault(r[3], []).append((r[0] is not None, r[0] or 0, leaf(r, r[1]), r))
    made = []
    for s in sorted(sources, key=lambda s: (s is not None, (s or "").encode())):
        group = sorted(sources[s], key=lambda x: x[:3])
        made.append((group, *tree([x[2] for x in group])))
    root, above = tree([m[1] for m in made])
    out = []
    for (group, subroot, proofs), up in zip(made, above):
        for (_, _, digest, r), proof in zip(group, proofs):
            tampered = r[0] is not None and r[1] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
            at = leaf(r, r[1].translate(LOW) if tampered else r[1])
            for before, after in proof + up:
                at = H(before + at + after)
            out.append((r[0], digest, subroot, root, H("".join(b + a for b, a in proof + up)), at, at == root))
    return sorted(out, key=repr)


def manifest_rows(n: int, seed: int = 1) -> list:
    """One source with most of the rows, lone ones, a null and an empty one, ids that repeat."""
    rng = random.Random(seed)
    source = lambda: "big" if rng.random() < 0.7 else rng.choice([None, "", "é", "z", "Z", f"lone{rng.randint(0, 40)}"])
    return [(rng.choice([None, rng.randint(-n, n)]) if rng.random() < 0.05 else i, rng.choice([None, "", "MiXed ÄÖ " * rng.randint(1, 4)]), rng.choice([None, "en"]), source()) for i in range(n)]


@pytest.mark.parametrize("rows", [EDGE, EDGE[:1], manifest_rows(700), [(i, "A", "en", "one") for i in range(257)], [(i, "A", "en", f"s{i}") for i in range(40)]], ids=["edge", "lone", "many", "one source", "lone sources"])
def test_proofs_against_loops(spark, rows):
    got = merkle.verified(clash(docs_frame(spark, rows)).repartition(3)).collect()
    assert sorted(map(tuple, got), key=repr) == brute_proofs(rows)
    assert {r.verified for r in got if r.leaf} <= {True, False}


def test_proofs_of_an_empty_table(spark):
    got = merkle.verified(docs_frame(spark, []))
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"] and got.count() == 0


def test_proofs_when_nodes_are_copied(spark, monkeypatch):
    """A node that more than SERVED others point to is dealt in parts."""
    monkeypatch.setattr(merkle, "SERVED", 3)
    rows = [(i, f"T{i}", "en", "one" if i % 50 else f"s{i}") for i in range(1500)]
    assert sorted(map(tuple, merkle.verified(docs_frame(spark, rows)).collect()), key=repr) == brute_proofs(rows)


# ---- 12 ----------------------------------------------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, label int"


def brute_codes(rows) -> list:
    kept = [(r[0], [int(np.floor(1024 * float(np.float32(x)))) for x in r[1]], r[2]) for r in rows if r[1] is not None and all(x is not None and np.isfinite(np.float32(x)) for x in r[1])]
    fits = [k for k in kept if k[1] and len(k[1]) % 4 == 0 and max(map(abs, k[1])) < 2**27]
    width = max(Counter(len(k[1]) for k in fits).items(), key=lambda x: x[::-1])[0] if fits else 0
    fits = sorted((k for k in fits if len(k[1]) == width), key=lambda k: (k[0] is None, k[0] or 0, k[1]))
    d = width // 4
    books = [[k[1][p * d: (p + 1) * d] for k in fits[:256]] for p in range(4)]
    square = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    best = lambda x, book: min((square(x, e), i) for i, e in enumerate(book))
    for _ in range(4):
        for p in range(4):
            parts = [k[1][p * d: (p + 1) * d] for k in fits]
            to = [best(x, books[p])[1] for x in parts]
            for e in set(to):
                mine = [x for x, i in zip(parts, to) if i == e]
                books[p][e] = [sum(c) // len(mine) for c in zip(*mine)]
    sha = H(",".join(str(x) for b in books for e in b for x in e))
    out, errors = [], {}
    for k in kept:
        code = error = None
        if any(k is f for f in fits):
            found = [best(k[1][p * d: (p + 1) * d], books[p]) for p in range(4)]
            code, error = "".join(f"{i:02x}" for _, i in found), sum(x for x, _ in found)
        out.append((k[0], code, error, k[2]))
        if error is not None:
            errors[k[2]] = errors.get(k[2], 0) + error
    return sorted(((i, c, e, errors.get(label), sha) for i, c, e, label in out), key=repr)


def vector_rows(n: int, width: int, seed: int) -> list:
    rng = random.Random(seed)
    return [(i, [rng.choice([0.0, 0.25, rng.gauss(0, 0.2)]) for _ in range(width)], rng.choice([None, 1, 2])) for i in range(n)]


ODD = [(900, None, 1), (901, [0.1] * 7 + [None], 1), (902, [0.1] * 7 + [float("nan")], 1), (903, [float("-inf")] * 8, 2), (904, [], 3), (905, [0.5] * 6, None),
       (906, [1e30] + [0.0] * 7, 4), (907, [0.1] * 12, 1), (None, [0.2] * 8, 2), (5, [0.3] * 8, 2), (5, [0.3] * 8, 2), (908, [-130000.0] * 8, 2)]


@pytest.mark.parametrize("rows", [vector_rows(300, 8, 1) + ODD, vector_rows(3, 4, 2), ODD[:5], vector_rows(400, 64, 3)[:270]], ids=["odd", "few", "none", "wide"])
def test_codes_against_loops(spark, rows):
    from pyspark.sql import functions as F
    df = spark.createDataFrame(rows, VECTORS).select("*", F.lit("x").alias("V"), F.lit(1).alias("code"), F.lit(2).alias("n")).repartition(4)
    coded, books = part_codes.compress(df)
    got = part_codes.digests(coded, books)
    assert sorted(map(tuple, got.collect()), key=repr) == brute_codes(rows)


def test_codes_of_an_empty_table(spark):
    got = part_codes.digests(*part_codes.compress(spark.createDataFrame([], VECTORS)))
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"] and got.count() == 0


def test_grid_gives_what_trying_all_gives():
    """Cells of any width, ties between equal entries, a memo that is emptied, and far fewer entries evaluated."""
    rng = np.random.default_rng(4)
    entries = rng.normal(0, 128, (256, 16)).astype(np.int64)
    entries[77] = entries[12]
    parts = np.concatenate((rng.normal(0, 128, (3000, 16)).astype(np.int64), entries, entries[12:13] + 1, rng.integers(-2**26, 2**26, (20, 16))))
    want = ((parts[:, None] - entries[None]) ** 2).sum(axis=2)
    for width, most in ((1, 10**6), (32, 500), (32, 10**6), (300, 10**6)):
        grid = part_codes.Grid(entries, width, most)
        for i in range(0, len(parts), 400):
            index, best = grid.nearest(parts[i: i + 400])
            assert (best == want[i: i + 400].min(axis=1)).all() and (index == want[i: i + 400].argmin(axis=1)).all()
        assert len(grid.memo) <= most
        if width == 32:
            assert grid.evaluated < 0.2 * want.size
    again = grid.evaluated
    remembered = dict(grid.memo)
    grid.nearest(parts[:400])
    assert grid.memo.keys() == remembered.keys() and grid.evaluated > again


# ---- 13 ----------------------------------------------------------------------------------------------------------


def brute_join(rows, k: int = 5, percent: int = 80) -> list:
    sets = []
    for r in rows:
        w = [x.decode("utf-8", "surrogateescape") for x in (r[1] or "").encode().lower().split()]
        size = min(k, len(w))
        sets.append({tuple(w[i: i + size]) for i in range(len(w) - size + 1)} if w else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, x in enumerate(sets):
        for j in range(i):
            both = len(x & sets[j])
            if both and 100 * both >= percent * (len(x) + len(sets[j]) - both):
                root[find(i)] = find(j)
    ids: dict = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            ids[find(i)] = min(ids.get(find(i), r[0]), r[0])
    return sorted(((r[0], len(s), ids.get(find(i), r[0])) for i, (r, s) in enumerate(zip(rows, sets))), key=repr)


def families(seed: int, n: int, edits: tuple[int, ...], shared: int = 0) -> list:
    """Copies of a few texts with words changed here and there, so that similarities lie on both sides of 0.8; some texts
    hold a common passage."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(3000)]
    bases = [prose(seed * 100 + i, rng.randint(30, 120), vocabulary).split() for i in range(6)]
    passage = prose(seed + 7, 25, vocabulary).split()
    rows = []
    for i in range(n):
        w = list(rng.choice(bases)) if rng.random() < 0.8 else prose(seed * 1000 + i, 60, vocabulary).split()
        for _ in range(rng.choice(edits)):
            w[rng.randrange(len(w))] = rng.choice(vocabulary)
        if rng.random() < 0.1:
            w = w[: rng.randint(1, len(w))]
        if i < shared:
            w += passage
        rows.append((i, " ".join(w), "en", "a"))
    rng.shuffle(rows)
    return rows


def check_join(spark, rows, **kw):
    assert sorted(map(tuple, jaccard_join.join(docs_frame(spark, rows).repartition(4), **kw).collect()), key=repr) == brute_join(rows, kw.get("shingle", 5), kw.get("percent", 80))


def test_join_of_edge_rows(spark):
    got = jaccard_join.join(clash(docs_frame(spark, EDGE)).repartition(3))
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute_join(EDGE)
    assert jaccard_join.join(docs_frame(spark, [])).count() == 0


def test_join_through_rows_without_id(spark):
    w = prose(60, 100, [f"v{i}" for i in range(900)]).split()
    rows = [(3, " ".join(w), "en", "a"), (None, " ".join(w[4:]), "en", "a"), (1, " ".join(w[8:] + ["z"] * 9), "en", "a"), (None, "lone text", "en", "a")]
    check_join(spark, rows)


@pytest.mark.parametrize("seed", range(3))
def test_join_against_all_pairs(spark, monkeypatch, seed):
    """Once as set, once with tiny regions and blocks, so that every round has work: pivots, cells, blocks."""
    rows = families(seed, 150, (0, 1, 2, 3, 4, 6), shared=60)
    if seed:
        monkeypatch.setattr(jaccard_join, "SMALL", 2)
        monkeypatch.setattr(jaccard_join, "BLOCK", 3 if seed == 1 else 12)
        monkeypatch.setattr(jaccard_join, "STARS", seed - 1)
        monkeypatch.setattr(jaccard_join, "COMMON", 5)
    check_join(spark, rows)


@pytest.mark.parametrize("shingle,percent", [(1, 50), (3, 67), (5, 100)])
def test_join_at_other_thresholds(spark, shingle, percent):
    check_join(spark, families(9, 80, (0, 1, 3, 9, 20)), shingle=shingle, percent=percent)


def test_first_pivots_meet():
    """Sets that link share a pivot in any order, also where a bit map with false hits puts shingles last."""
    rng = np.random.default_rng(2)
    for _ in range(300):
        n = int(rng.integers(1, 60))
        a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        b = np.unique(np.concatenate((a[rng.random(len(a)) < 0.9], rng.integers(0, 2**63, int(rng.integers(0, 6))).astype(np.uint64))))
        both = len(np.intersect1d(a, b))
        if both and 100 * both >= 80 * (len(a) + len(b) - both):
            for common in (None, rng.integers(0, 2**63, 64).astype(np.uint64), np.full(64, 2**64 - 1, np.uint64)):
                assert set(jaccard_join.first_pivots(a, 80, common).tolist()) & set(jaccard_join.first_pivots(b, 80, common).tolist())
