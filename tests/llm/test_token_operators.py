"""Operators 4, 6, 8: held-out accuracy, exact round trips, the tokenizers library."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest

from riskfeed.llm import language_id as LI
from riskfeed.llm import token_counts as TC
from riskfeed.llm import token_output as TO
from riskfeed.llm.queries import queries
from tests.conftest import SF_ORACLE, SF_SMALL

BPE = public_tokenizers.path("word_bpe_49k.json")
ODD = ["", "  \n\t ", "Don't STOP!! it's 42,000.5 ###", "Éßü œuvre naïve İstanbul ΣΑΣ", "a<|endoftext|>b c",
       "nbsp here   x\u0085y", "日本語 テキスト 🙂🙂", "é ́lone", "x" * 5000, "\x1c\x1d odd\x0bvt\x0cff",
       "ﬁ ligature ½ ² µ", "<|startoftext|>", "'S 'Re we'LL"]


@pytest.mark.parametrize("bits", [1, 5, 8, 13, 16, 17, 20, 31, 32])
def test_pack_round_trip(bits):
    rng = np.random.default_rng(bits)
    for n in (0, 1, 7, 8, 4096, 5000):
        ids = rng.integers(0, 2 ** bits, n, dtype=np.uint64).astype(np.uint32)
        raw = TO.pack(ids, bits)
        assert len(raw) == -(-n * bits // 8)
        assert (TO.unpack(raw, n, bits) == ids).all()


@pytest.mark.parametrize("bits", [11, 16, 19])
def test_shard_random_access(tmp_path, bits):
    ids = np.random.default_rng(1).integers(0, 2 ** bits, 10_001).astype(np.uint32)
    uri = f"file://{tmp_path}/a/s.bin"
    TO.write_shard(uri, [5, None, 7], [4000, 0, 6001], ids, bits)
    s = TO.Shard(uri)
    assert s.doc_ids == [5, None, 7] and s.start.tolist() == [0, 4000, 4000, 10_001]
    for a, b in [(0, 10_001), (4095, 4097), (8191, 10_001), (3, 3), (9999, 10_000)]:
        assert (s.ids(a, b) == ids[a:b]).all()


def _expected_tokens(rows):
    from tokenizers import Tokenizer
    tok, out, at = Tokenizer.from_file(BPE), [], 0
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode()))
    for doc_id, text in order:
        ids = tok.encode(text or "", add_special_tokens=False).ids + [1]
        out.append((doc_id, at, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        at += len(ids)
    return out


def test_token_output_odd_texts(docs_of):
    rows = [(i * 3, t) for i, t in enumerate(ODD)] + [(1, None), (3, "again"), (3, "again"), (None, "no id")]
    got = [tuple(r) for r in TO.token_output(docs_of(rows), BPE).collect()]
    assert sorted(got, key=lambda r: r[1]) == _expected_tokens(rows)


def test_token_output_many_shards(docs_of, monkeypatch):
    rows = [(i, f"word{i} " * (i % 50)) for i in range(300)]
    got = [tuple(r) for r in TO.token_output(docs_of(rows), BPE).collect()]
    assert sorted(got, key=lambda r: r[1]) == _expected_tokens(rows)


def test_token_output_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = [tuple(r) for r in queries()["op6_token_output"](spark, SF_SMALL).collect()]
    assert sorted(got, key=lambda r: r[1]) == _expected_tokens(rows)


@pytest.mark.parametrize("held", [7, 10_000])
def test_word_cache_is_bounded_and_exact(monkeypatch, held):
    monkeypatch.setattr(TO, "CACHE_WORDS", held)
    enc = TO.Encoder(BPE)
    made, make = [], enc.words.make
    enc.words.make = lambda w: made.append(w) or make(w)
    text = " ".join(f"often it's Rare{'abcdefghij'[i % 10]}{i}" for i in range(300))
    ids = np.array(enc.tok.encode(text, add_special_tokens=False).ids, dtype="<u4")
    assert enc.encode(text.encode()) == ids.tobytes()
    assert len(enc.words) <= held and len(enc.pieces) <= held
    if held > 302:  # each distinct word once
        assert len(made) == len(set(made)) == 302


def test_empty_tables(docs_of):
    assert TO.token_output(docs_of([]), BPE).count() == 0
    assert TC.token_counts(docs_of([]), [("<unk>", 0.0)]).count() == 0
    assert LI.predict(docs_of([]), LI.fit(docs_of([]))).count() == 0


# ------------------------------------------------------------------ counts

def _library(vocabulary, fallback):
    from tokenizers import Regex, Tokenizer, models, pre_tokenizers
    tok = Tokenizer(models.Unigram(vocabulary, unk_id=0, byte_fallback=fallback))
    tok.pre_tokenizer = pre_tokenizers.Sequence([
        pre_tokenizers.Split(Regex(r"[\x20\x09-\x0D]+"), "removed"),
        pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=False)])
    return lambda text: len(tok.encode(text, add_special_tokens=False).ids)


@pytest.mark.parametrize("fallback", [True, False])
def test_counts_match_library(spark, docs_of, fallback):
    vocabulary = TC.sentencepiece_vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    count = _library(vocabulary, fallback)
    rows = [(i, t) for i, t in enumerate(ODD)] + [(100, None), (100, "twice"), (None, "no id 🙂🙂🙂")]
    rows += [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = TC.token_counts(docs_of(rows), vocabulary, fallback).collect()
    want = sorted(((d, count(t or "")) for d, t in rows), key=str)
    assert sorted((tuple(r) for r in got), key=str) == want


def test_counts_ties_and_unknowns():
    rng = random.Random(3)
    for case in range(300):
        pieces = {"".join(rng.choice("▁ab") if i == 0 else rng.choice("ab") for i in range(rng.randint(1, 4)))
                  for _ in range(rng.randint(1, 12))}
        vocabulary = [("<unk>", 0.0)] + [(p, float(-rng.randint(1, 3))) for p in sorted(pieces)]
        counter, count = TC.UnigramCounter(vocabulary, False), _library(vocabulary, False)
        for _ in range(5):
            word = "".join(rng.choice("abz") for _ in range(rng.randint(1, 9)))
            assert counter.count_word(word) == count(word), (vocabulary, word)


# ------------------------------------------------------------------ language

def test_language_held_out_accuracy(spark):
    lang = spark.read.parquet(f"{SF_ORACLE}/documents.parquet").select("doc_id", "lang")
    got = queries()["op4_language_id"](spark, SF_ORACLE).join(lang, "doc_id")
    rows = got.where("held_out").collect()
    assert len(rows) > 250
    right = sum(r["lang_pred"] == r["lang"] for r in rows)
    assert right / len(rows) >= 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_edge_cases(docs_of):
    rows = [(i, "the cat and the dog", "en") for i in range(5)] + [(i + 9, "le chat et le chien", "fr") for i in range(4)]
    model = LI.fit(docs_of(rows + [(70, None, "en"), (71, "no label", None)]))
    ask = docs_of([(1, None), (2, ""), (3, "123 !!"), (4, "the"), (4, "the"), (None, "chien"), (5, "le " * 700_000)])
    got = sorted(((r["doc_id"], r["lang_pred"]) for r in LI.predict(ask, model).collect()), key=str)
    assert got == sorted([(1, "und"), (2, "und"), (3, "und"), (4, "en"), (4, "en"), (None, "fr"), (5, "fr")], key=str)
    assert {r["lang_pred"] for r in LI.predict(ask, LI.fit(docs_of([]))).collect()} == {"und"}


def test_rare_language_is_learned_from_a_sample(docs_of):
    rows = [(i, "the quiet river runs past the old mill", "en") for i in range(600)]
    rows += [(9000 + i, "это тихая река у старой мельницы", "ru") for i in range(3)]
    model = LI.fit(docs_of(rows), max_train=20)
    assert model.languages == ["en", "ru"]
    assert model.predict("старая мельница у реки")[0] == "ru" and model.predict("an old river mill")[0] == "en"
