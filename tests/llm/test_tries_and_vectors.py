"""Operators 11 to 13 against brute force on small fixtures, and their edge cases."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from riskfeed.llm import centroid_clustering as CC
from riskfeed.llm import conversation_trie as CT
from riskfeed.llm import nearest_neighbours as NN

# ------------------------------------------------------------------ conversations


def _digest(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()


def _brute_trie(rows):
    own = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            r, x = r or "", x or ""
            own[c].append((t is not None, t or 0, _digest(r, x), r, x))
    own = {c: [v[3:] for v in sorted(own[c])] for c in own}
    members, ends, kids = defaultdict(list), defaultdict(list), defaultdict(set)
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        seq = tuple(own.get(base, [])[:h] + own[c][h:])
        ends[seq].append(c)
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
            if d:
                kids[seq[:d - 1]].add(seq[:d])
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, m in members.items():
        for d in range(len(p) + 1):
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1].encode()) if p else 0
            leaves[p[:d]] += not kids[p]
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids[p]), leaves[p], saved[p],
                   hashlib.sha256(",".join(map(str, sorted(ends.get(p, [])))).encode()).hexdigest())
                  for p, m in members.items())


@pytest.fixture(scope="module")
def conversations(spark):
    def make(rows):
        full = [(*r, "clash", 7) for r in rows]
        return spark.createDataFrame(full, "conv_id long, turn long, role string, text string, s string, depth int")
    return make


def _random_conversations(n, seed, words=3, most=12):
    rng = random.Random(seed)
    return [(c, t, rng.choice(["user", "tool"][:1 + t % 2]), f"t{rng.randrange(words)}é")
            for c in range(n) for t in range(rng.randrange(1, most))]


def _trie(conversations, rows):
    return sorted(tuple(r) for r in CT.conversation_trie(conversations(rows)).collect())


def test_trie_is_brute_force(conversations, monkeypatch):
    rows = _random_conversations(120, 1)
    # null and repeated turns, null role and text, conversations without id, ties, negative ids, a very long text
    rows += [(500, None, "user", "a"), (500, 0, None, None), (500, 0, "user", "b"), (500, 0, "user", "b"),
             (None, 0, "user", "lost"), (-3, 0, "user", "n"), (-3, 1, "user", "m"), (-4, 0, "user", "n"),
             (501, 0, "user", "x" * 3_000_000), (502, 0, "us", "erx"), (503, 0, "user", "x")]
    assert _trie(conversations, rows) == _brute_trie(rows)
    monkeypatch.setattr(CT, "BLOCK", 3)  # several blocks a conversation
    assert _trie(conversations, rows) == _brute_trie(rows)


def test_trie_with_hot_groups(conversations, monkeypatch):
    """A third of all conversations are equal, a third share the first turns, one holds a third of all turns."""
    monkeypatch.setattr(CT, "PIECE_IDS", 7)
    rows = [(5 * c, t, "user", f"same {t}") for c in range(200) for t in range(3)]
    rows += [(5 * c, t, "user", f"head {t}" if t < 2 else f"own {c}") for c in range(200, 400) for t in range(4)]
    rows += [(5000, t, "user", f"long {t % 7}") for t in range(700)]
    got = _trie(conversations, rows)
    assert got == _brute_trie(rows)
    assert max(r[3] for r in got if r[1]) >= 200


def test_trie_of_nothing(conversations):
    assert _trie(conversations, []) == []
    assert _trie(conversations, [(None, 0, "user", "a")]) == []


def test_trie_turnless(conversations):
    """A conversation whose base is absent and whose own turns all lie in the head has no turn left."""
    c = next(c for c in range(1, 99) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 1)
    rows = [(c, 0, "user", "gone")]
    assert _trie(conversations, rows) == _brute_trie(rows) == [(c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]


# ------------------------------------------------------------------ vectors

def _unit(n, seed, dim=64, spread=1.0):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(8, dim))
    x = centre[rng.integers(8, size=n)] + spread * rng.normal(size=(n, dim))
    return x / np.linalg.norm(x, axis=1)[:, None]


BAD = [(9001, None), (9002, []), (9003, [0.0] * 64), (9004, [None] + [1.0] * 63), (9005, [float("nan")] + [1.0] * 63),
       (9006, [float("inf")] + [1.0] * 63), (9007, [float("-inf")] + [1.0] * 63)]


@pytest.fixture(scope="module")
def embeddings(spark):
    def make(rows):
        full = [(i, None if v is None else [None if x is None else float(x) for x in v], 1, "clash") for i, v in rows]
        return spark.createDataFrame(full, "vec_id long, embedding array<double>, cluster int, q string")
    return make


def _near(df, k=20):
    got = defaultdict(list)
    for r in NN.nearest(df, df.where("vec_id % 20 = 0"), k=k).collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    return {q: sorted(v) for q, v in got.items()}


def _exact(rows, k=20):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], dtype=float)
    out = {}
    for j in np.flatnonzero(ids % 20 == 0):
        s = np.zeros(len(ids))
        for c in range(x.shape[1]):
            s += x[:, c] * x[j, c]
        out[int(ids[j])] = [(int(ids[a]), s[a]) for a in np.lexsort((ids, -s)) if ids[a] != ids[j]][:k]
    return out


def _recall(got, want):
    hits = [len({v for _, v, _ in got[q]} & {v for v, _ in w}) / len(w) for q, w in want.items()]
    return sum(hits) / len(hits)


@pytest.mark.parametrize("make", [
    lambda: _unit(3000, 1),  # weak clusters
    lambda: _unit(3000, 2, spread=0.05),  # tight ones
    lambda: _unit(3000, 3) * np.random.default_rng(3).lognormal(size=(3000, 1)),  # uneven norms
    lambda: _unit(3000, 4) + 3.0,  # a narrow cone
])
def test_neighbours_recall(embeddings, make, monkeypatch):
    monkeypatch.setattr(NN, "SLICE_VALUES", 1 << 16)  # several slices and rounds
    rows = [(i, v) for i, v in enumerate(make().tolist())]
    got, want = _near(embeddings(rows + BAD)), _exact(rows)
    assert set(got) == set(want)
    assert _recall(got, want) >= 0.95
    scores = dict(rows)
    for q, found in got.items():
        assert [r for r, _, _ in found] == list(range(1, 21))
        assert [v for _, v, _ in found] == [v for v, _ in sorted(((v, s) for _, v, s in found), key=lambda p: (-p[1], p[0]))]
        assert all(abs(s - np.dot(scores[q], scores[v])) <= 1e-9 * max(1, abs(s)) for _, v, s in found)


def test_neighbours_of_many_copies(embeddings):
    """A third of all rows are one vector: its ids come in ascending order, the own one left out."""
    x = _unit(400, 5)
    rows = [(i, v) for i, v in enumerate(x.tolist())] + [(i, x[0].tolist()) for i in range(400, 600)]
    got, want = _near(embeddings(rows)), _exact(rows)
    assert [v for _, v, _ in got[0]] == list(range(400, 420))
    assert [v for _, v, _ in got[400]] == [0, *range(401, 420)]
    assert _recall(got, want) >= 0.95


def test_neighbours_over_many_partitions(spark, embeddings, monkeypatch):
    """Slices and query groups meet in whatever partition they are dealt to."""
    monkeypatch.setattr(NN, "SLICE_VALUES", 1 << 16)
    rows = [(i, v) for i, v in enumerate(_unit(5000, 12).tolist())]
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")
    try:
        got = _near(embeddings(rows))
    finally:
        spark.conf.set(name, "true")
    assert len(got) == 250 and all(len(f) == 20 for f in got.values())
    assert _recall(got, _exact(rows)) >= 0.95


def test_neighbours_edges(embeddings):
    assert _near(embeddings([])) == {} and _near(embeddings(BAD)) == {}
    one = [(0, _unit(1, 6)[0].tolist())]
    assert _near(embeddings(one)) == {}  # no other row
    few = [(i, v) for i, v in enumerate(_unit(5, 7).tolist())]
    assert [v for _, v, _ in _near(embeddings(few))[0]] == [v for v, _ in _exact(few)[0]]
    # a repeated row counts once; other lengths are not compared; rows without an id take no part
    mixed = few + few[:2] + [(40, [1.0, 2.0]), (41, [1.0, 1.0]), (None, few[0][1])]
    got = _near(embeddings(mixed))
    assert [v for _, v, _ in got[0]] == [v for v, _ in _exact(few)[0]] and got[40] == [(1, 41, 3.0)]
    # components near the ends of the range
    wide = [(i, [x * 1e150 for x in v]) for i, v in few]
    assert [v for _, v, _ in _near(embeddings(wide))[0]] == [v for v, _ in _exact(few)[0]]


def test_slice_index_holds_every_code_in_the_radius():
    rng = np.random.default_rng(8)
    base = rng.integers(256, size=(40, 32), dtype=np.uint8)
    flips = np.packbits(rng.random((2000, 256)) < rng.random((2000, 1)) / 2, axis=1)
    codes = base[rng.integers(40, size=2000)] ^ flips
    index = NN.SliceIndex(codes)
    for q in range(20):
        apart = np.bitwise_count(codes ^ base[q]).sum(axis=1)
        for r in (0, 5, 31, 32, 50, 64, 100, 127, 200, 256):
            got = index.within(base[q], base[q].view(np.uint64), r)
            assert got.tolist() == np.flatnonzero(apart <= r).tolist()
    assert len(index.probe(base[0], 5)) < 400  # a small radius touches few rows


def _brute_clusters(rows, k=16, rounds=3, dim=64):
    most = 1 << 26
    kept = [(i, [int(np.floor(max(-most, min(most, 64 * float(x))))) for x in v]) for i, v in rows
            if v is not None and len(v) == dim and all(x is not None and np.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1]))
    c = [v for _, v in kept[:k]]
    for n in range(rounds + 1):
        near = [min((sum((a - b) ** 2 for a, b in zip(v, y)), j) for j, y in enumerate(c)) for _, v in kept]
        if n == rounds:
            break
        for j in range(len(c)):
            own = [v for (_, v), (_, m) in zip(kept, near) if m == j]
            if own:
                c[j] = [sum(col) // len(own) for col in zip(*own)]
    total, per = sum(d for d, _ in near), defaultdict(int)
    for d, j in near:
        per[j] += d
    sha = [hashlib.sha256(",".join(map(str, v)).encode()).hexdigest() for v in c]
    return [(i, j, d, per[j], total, sha[j]) for (i, _), (d, j) in zip(kept, near)]


def _key(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r))


def test_clusters_are_brute_force(embeddings):
    rows = [(i, v) for i, v in enumerate(_unit(300, 9).tolist())]
    rows += [(None, rows[0][1]), (7, rows[7][1]), (7, rows[8][1])] + BAD  # no id, a repeated row, an id twice
    rows += [(1000 + i, rows[3][1]) for i in range(150)]  # a third of all is one vector
    rows += [(2000, [1e30] * 64), (2001, [-1e30] * 64)]  # held within the range
    got = [tuple(r) for r in CC.centroid_clusters(embeddings(rows)).collect()]
    assert _key(got) == _key(_brute_clusters(rows))


def test_clusters_of_few(embeddings):
    assert CC.centroid_clusters(embeddings([])).collect() == []
    assert [r[0] for r in CC.centroid_clusters(embeddings(BAD)).collect()] == [9003]  # zeros are a vector like others
    few = [(i, v) for i, v in enumerate(_unit(5, 10).tolist())]
    assert _key(tuple(r) for r in CC.centroid_clusters(embeddings(few)).collect()) == _key(_brute_clusters(few))
    same = [(i, few[0][1]) for i in range(20)]  # all centroids equal: the smallest number wins
    assert {r["cluster"] for r in CC.centroid_clusters(embeddings(same)).collect()} == {0}


def test_orchard_search_is_exact_with_ties():
    rng = np.random.default_rng(11)
    for k in (1, 2, 7, 40):
        c = rng.integers(-3, 4, size=(k, 3))
        x = rng.integers(-4, 5, size=(500, 3))
        best, dist = CC.Orchard(c).search(x)
        apart = ((x[:, None] - c[None]) ** 2).sum(axis=2)
        assert (best == apart.argmin(axis=1)).all() and (dist == apart.min(axis=1)).all()
