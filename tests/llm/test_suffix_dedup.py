"""Operator 10 against brute force over every start position."""

import hashlib
import random
from collections import Counter

import pytest

from riskfeed.llm import suffix_dedup as SD
from riskfeed.llm.queries import queries
from tests.conftest import SF_SMALL


def brute(rows, n=400):
    raws = [(t or "").encode() for _, t in rows]
    seen = Counter(r[i:i + n] for r in raws for i in range(len(r) - n + 1))
    out = []
    for (d, _), r in zip(rows, raws):
        gone = bytearray(len(r))
        for i in range(len(r) - n + 1):
            if seen[r[i:i + n]] > 1:
                gone[i:i + n] = b"\1" * n
        kept = bytes(b for b, g in zip(r, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((d, len(r), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def _got(df):
    return sorted((tuple(r[c] for c in ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")) for r in df.collect()),
                  key=str)


def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    assert _got(queries()["op10_suffix_dedup"](spark, SF_SMALL)) == brute(rows)


@pytest.mark.parametrize("hot,bucket", [(20_000, 20_000), (3, 50)])
def test_repeats(docs_of, monkeypatch, hot, bucket):
    monkeypatch.setattr(SD, "HOT", hot)
    monkeypatch.setattr(SD, "BUCKET_ROWS", bucket)
    monkeypatch.setattr(SD, "RUN_BYTES", 40_000)
    monkeypatch.setattr(SD, "PIECE", 700)
    rng = random.Random(hot)
    text = lambda n: "".join(rng.choice("abcdé fgh") for _ in range(n))
    passages = [text(k) for k in (380, 398, 399, 400, 401, 500, 700, 1500)]
    rows = []
    for i in range(60):
        parts = [text(rng.randint(0, 500))]
        for _ in range(rng.randint(0, 2)):
            p = rng.choice(passages)
            a = rng.randint(0, 60)
            parts += [p[a:], text(rng.randint(0, 200))]
        rows.append((i, "".join(parts)))
    rows += [(100, "ab" * 700), (101, "x" * 2000), (102, "x" * 401), (103, "abc " * 300), (104, None), (105, ""),
             (106, rows[3][1]), (3, rows[3][1]), (3, "other text"), (None, passages[6]), (107, passages[3] * 2),
             (108, "short"), (109, "short"), (110, passages[3])]
    rng.shuffle(rows)
    assert _got(SD.suffix_dedup(docs_of(rows))) == brute(rows)


def test_empty(docs_of):
    assert SD.suffix_dedup(docs_of([])).count() == 0


def test_loser_tree_orders_and_knows_prefixes():
    rng = random.Random(9)
    for k in (1, 2, 3, 5, 8, 13):
        runs, every = [], []
        for _ in range(k):
            e = [(bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 9))), b"", 0, rng.randrange(99), 0)
                 for _ in range(rng.randint(0, 20))]
            every += e
            runs.append(SD.front_code(e))
        got = list(SD.LoserTree([SD.read_run(r) for r in runs]))
        assert [x[1][1] for x in got] == sorted(x[0] for x in every)
        for (_, p), (same, q) in zip(got, got[1:]):
            assert same == SD.common_prefix(p[1], q[1], 0)
