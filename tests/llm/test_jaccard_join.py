"""Operator 9 against brute force: whole table, adversarial groups, edge cases."""

import random
import re

import pytest

from riskfeed.llm import jaccard_join as JJ
from riskfeed.llm.components import connected_components
from riskfeed.llm.queries import queries
from tests.conftest import SF_SMALL

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _set(text, n):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not w:
        return frozenset()
    n = min(n, len(w))
    return frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1))


def brute(rows, n=4, percent=85):
    sets = [_set(t, n) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    order = sorted(range(len(rows)), key=lambda i: len(sets[i]))
    for x, i in enumerate(order):
        for j in order[x + 1:]:
            a, b = sets[i], sets[j]
            if not a:
                break
            if 100 * len(a) < percent * len(b):
                break
            o = len(a & b)
            if 100 * o >= percent * (len(a) + len(b) - o):
                root[find(i)] = find(j)
    best = {}
    for i, (d, _) in enumerate(rows):
        r = find(i)
        if d is not None and (best.get(r) is None or d < best[r]):
            best[r] = d
    return sorted(((d, len(s), best.get(find(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


def _got(df):
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in df.collect()), key=str)


def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    assert _got(queries()["op9_jaccard_join"](spark, SF_SMALL)) == brute(rows)


def near_group(rng, words, edits, count):
    base = [f"b{rng.randrange(10 ** 9)}" for _ in range(words)]
    for _ in range(count):
        t = list(base)
        for _ in range(rng.randint(0, edits)):
            t[rng.randrange(len(t))] = f"e{rng.randrange(10 ** 9)}"
        yield " ".join(t)


@pytest.mark.parametrize("n,percent,tile", [(4, 85, 1024), (5, 80, 16)])
def test_groups_chains_and_edges(docs_of, monkeypatch, n, percent, tile):
    monkeypatch.setattr(JJ, "TILE", tile)
    rng = random.Random(percent)
    texts = [*near_group(rng, 150, 8, 90), *near_group(rng, 30, 2, 30), *near_group(rng, 9, 1, 10)]
    walk = [f"c{i}" for i in range(120)]           # a chain: each a few words from the last
    for i in range(40):
        walk[(i * 7) % 120] = f"d{i}"
        texts.append(" ".join(walk))
    line = " ".join(f"line{i}" for i in range(40))  # one passage in many otherwise different texts
    texts += [f"{line} " + " ".join(f"u{k}x{i}" for i in range(rng.randint(3, 60))) for k in range(60)]
    texts += [" ".join(f"s{i}" for i in range(k)) for k in range(1, 14)]
    texts += ["A B C D E F G", "a b c\td e f g", "w " * 50, "w " * 60, "x" * 100_000, texts[0], texts[0].upper()]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    rows += [(5000, None), (5001, ""), (5002, " \n"), (None, texts[3]), (None, "only nameless one"), (4, "other text of id 4"),
             (7, texts[7])]
    found = JJ.jaccard_classes(docs_of(rows), n, percent)
    assert _got(found) == brute(rows, n, percent)
    stay = JJ.one_per_class(docs_of(rows), n, percent)
    want = brute(rows, n, percent)
    groups = {c for _, s, c in want if s and c is not None}
    blank = sum(1 for _, s, _ in want if not s)
    nameless = 1  # the component without any id
    assert stay.columns == docs_of(rows).columns and stay.count() == len(groups) + blank + nameless


def test_empty(docs_of):
    assert JJ.jaccard_classes(docs_of([])).count() == 0
    assert JJ.one_per_class(docs_of([(1, None)])).count() == 1


def test_components(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 50)] \
        + [(rng.randrange(200, 400), rng.randrange(200, 400)) for _ in range(120)]
    got = {r["node"]: r["component"] for r in connected_components(
        spark.createDataFrame(edges, "x long, y long"), "x", "y").collect()}
    root = {}

    def find(i):
        root.setdefault(i, i)
        while root[i] != i:
            i = root[i]
        return i
    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    assert got == {i: find(i) for i in root if any(i in e and e[0] != e[1] for e in edges)}
