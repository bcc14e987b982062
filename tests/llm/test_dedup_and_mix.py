"""Operators 1 and 5: brute force on small fixtures, the contract's edge cases."""

import hashlib
import re
from collections import defaultdict

import pytest

from riskfeed.llm import exact_dedup as ED
from riskfeed.llm import mix_sources as MX


def _brute_dedup(rows):
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in rows]
    groups = defaultdict(list)
    for (d, _), t in zip(rows, norm):
        groups[t].append(d)
    out = []
    for (d, _), t in zip(rows, norm):
        ids = [x for x in groups[t] if x is not None]
        out.append((d, min(ids) if ids else None, len(groups[t]), hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=str), len(groups)


@pytest.mark.parametrize("support", [1e-3, 0.2])
def test_exact_dedup(docs_of, support):
    rows = [(5, "a  b"), (3, "a\tb"), (9, "a b"), (9, "a b"), (1, None), (2, ""), (4, " "), (None, "lone"),
            (None, "lone"), (7, "x" * 200_000), (6, "x" * 200_000), (8, "é b"), (10, "A b")]
    rows += [(100 + i, "hot copy") for i in range(40)]
    got = ED.exact_dedup(docs_of(rows), support=support).collect()
    want, groups = _brute_dedup(rows)
    assert sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got), key=str) == want
    assert sum(r["kept"] for r in got) == groups
    assert all(r["doc_id"] == r["keep_id"] for r in got if r["kept"])


def test_empty(docs_of):
    assert ED.exact_dedup(docs_of([])).collect() == []
    assert MX.mix_sources(docs_of([])).collect() == []


def _targets(sizes, weights=(5, 2, 1), most=3):
    """The contract's own words: share out, stop at the cap, reshare the excess, again."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, open_ = {}, list(order)
    left = float(sum(sizes.values()))
    while open_:
        share = {s: left * w[s] / sum(w[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > most * sizes[s] + 1e-9]
        if not over:
            target.update(share)
            break
        for s in over:
            target[s] = float(most * sizes[s])
            left -= target[s]
            open_.remove(s)
    return target


def test_mix(docs_of):
    import random
    rng = random.Random(1)
    rows = []
    for i in range(3000):
        src = rng.choice(["a"] * 20 + ["b"] * 3 + ["ba", "Z", "é", None, "tiny"])
        if src == "tiny" and rng.random() < 0.9:
            src = "a"
        rows.append((i, " ".join(["w"] * rng.randint(0, 60)), "en", src))
    rows += [(5, None, "en", "a"), (None, "no id here", "en", "b"), (7, "x", "en", "b"), (7, "x", "en", "b")]
    got = MX.mix_sources(docs_of(rows)).collect()
    assert len(got) == len(rows)
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[3]] += len((r[1] or "").split())
    want, taken = _targets(sizes), defaultdict(int)
    for r in got:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]])
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 60 + 0.03 * want[s], s
    again = MX.mix_sources(docs_of(rows[::-1])).collect()
    key = lambda r: (str(r["doc_id"]), r["size"], r["taken"])
    assert sorted(map(key, got)) == sorted(map(key, again))
