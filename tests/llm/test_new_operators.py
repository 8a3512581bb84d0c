"""Operators 11 to 13 against brute-force versions and the public library, with edge cases."""

from __future__ import annotations

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

from kgloom.llm import divergence, piece_bpe, resampling, textops

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Extra columns whose names the operators use themselves.
CLASH = ["id", "n", "bucket", "weight", "score", "rank", "n_words", "term", "total", "salt", "part", "item", "value", "high", "low", "kept", "__r", "__n", "__p", "n_tokens"]


def awkward(spark):
    """Null ids, null, blank and very long texts, repeated rows, extra columns."""
    rows = [(1, None), (2, ""), (3, " \n\t "), (None, "a row without an id but with words"), (4, "word " * 30_000), (5, "same text of five words here"), (5, "same text of five words here"), (6, "ß é 日本 🎉 \x00 x ▁▁"), (7, "x" * 50_000), (8, " " * 30_000 + "end")]
    df = spark.createDataFrame([(i, t, None if i in (3, 7) else "en", None if i == 5 else "s", None) for i, t in rows], DOCS)
    return df.withColumns({c: F.lit(c) for c in CLASH})


def texts_of(df):
    return [r.text or "" for r in df.select("text").collect()]


def test_distinct_is_exact_when_hashes_collide():
    data = np.frombuffer(b"aa bb aa c aa bb", np.uint8)
    starts, ends = np.array([0, 3, 6, 9, 11, 14]), np.array([2, 5, 8, 10, 13, 16])
    first, which = textops.distinct(data, starts, ends, np.zeros(6, dtype=np.uint64))
    word = lambda i: data[starts[i] : ends[i]].tobytes()
    assert [word(first[k]) for k in which] == [word(i) for i in range(6)]


# --- 11 -----------------------------------------------------------------------


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def runs(words, longest):
    return [" ".join(words[i : i + k]) for k in range(1, longest + 1) for i in range(len(words) - k + 1)]


@pytest.mark.parametrize("wide", [256, 3])
def test_crc_matrices(monkeypatch, wide):
    monkeypatch.setattr(resampling, "WIDE", wide)
    rng = random.Random(1)
    parts = [bytes(rng.randrange(256) for _ in range(rng.randrange(1, 9))) for _ in range(200)] + [b"", b"x" * 300]
    ends = np.cumsum([len(p) for p in parts])
    got = resampling.crc32s(np.frombuffer(b"".join(parts), np.uint8), ends - [len(p) for p in parts], ends)
    assert got.tolist() == [zlib.crc32(p) for p in parts]


def brute_resample(rows, target, percent, least, longest, buckets, seed="2024"):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    feats = [[bucket(f) for f in runs(words_of(t), longest)] for _, t in rows]
    s, t = collections.Counter(b for f in feats for b in f), collections.Counter(bucket(f) for x in target for f in runs(words_of(x), longest))
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (sum(s.values()) + buckets) / ((s[b] + 1) * (sum(t.values()) + buckets)))) for b in range(buckets)}
    out = []
    for (i, text), f in zip(rows, feats):
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        out.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words_of(text))])
    able = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], -1 if r[0] is None else r[0]))
    for k, r in enumerate(able[: percent * len(able) // 100], 1):
        r[4] = k
    return sorted([tuple(r[:5]) for r in out], key=repr)


@pytest.mark.parametrize("longest,percent,buckets", [(1, 10, 10_000), (2, 35, 50), (3, 100, 7)])
def test_resampling_matches_brute_force(spark, longest, percent, buckets):
    rng = random.Random(longest)
    vocab = ["tea", "Über", "go", "x1", "日本", "plain", "o", "word" * 80]
    rows = [(i, " ,.-\n"[rng.randrange(5)].join(rng.choices(vocab, k=rng.randrange(60)))) for i in range(150)]
    rows += [(7, rows[7][1]), (None, rows[9][1]), (900, None), (901, "")]
    target = ["tea go go", None, "日本 plain"]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = resampling.resample(df, spark.createDataFrame([(t,) for t in target], "text string"), percent, 20, longest=longest, buckets=buckets)
    want = brute_resample(rows, [t or "" for t in target], percent, 20, longest, buckets)
    assert sorted([(r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in got.collect()], key=repr) == want


def test_resampling_edges(spark):
    none = spark.createDataFrame([], DOCS)
    target = spark.createDataFrame([("a word",)], "text string")
    assert resampling.resample(none, target).count() == 0
    got = resampling.resample(awkward(spark), none, percent=100, least=1).collect()
    assert len(got) == 10 and got[0].__fields__ == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    assert {r.doc_id for r in got if r["rank"] is None} == {1, 2, 3} and sorted(r["rank"] for r in got if r["rank"]) == list(range(1, 8))
    assert [r["rank"] for r in resampling.resample(awkward(spark), target).collect()] == [None] * 10


# --- 12 -----------------------------------------------------------------------


def brute_audit(rows, least, top):
    rows = [tuple(x or "" for x in r) for r in rows]
    terms = lambda t: re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t))
    out = []
    for lang in {r[0] for r in rows}:
        mine = [(s, terms(t)) for x, s, t in rows if x == lang]
        docs = collections.Counter(w for _, t in mine for w in set(t))
        kept = sorted(w for w, n in docs.items() if n >= least)
        count = {s: collections.Counter() for s, _ in mine}
        for s, t in mine:
            count[s].update(w for w in t if docs[w] >= least)
        every = sum(count.values(), collections.Counter())
        share = lambda c: {w: 1 + 10**9 * (c[w] + 1) // (sum(c.values()) + len(kept)) for w in kept}
        p, q = {s: share(c) for s, c in count.items()}, share(every)
        f = lambda a, b: (a - b) ** 2 // b
        for s in count:
            pairs = [(sum(f(p[s][w], p[o][w]) for w in kept), o) for o in count if o != s]
            best = [(f(p[s][w], q[w]), w) for w in kept if count[s][w] and p[s][w] > q[w]]
            for part, found, n in (("pair", pairs, len(pairs)), ("term", best, top)):
                for k, (v, item) in enumerate(sorted(found, key=lambda x: (-x[0], x[1].encode()))[:n], 1):
                    out.append((lang, s, part, item, v, k))
    return sorted(out)


@pytest.mark.parametrize("block,share", [(1 << 18, 1 << 14), (40, 5)])
def test_audit_matches_brute_force(spark, block, share):
    """Small blocks and salts: many runs a task, terms that go on over batches, pairs summed over salts."""
    rng = random.Random(block)
    vocab = ["".join(rng.choices("abcdefgh", k=rng.randrange(1, 4))) for _ in range(80)] + ["Éa", "日本"]
    rows = [(rng.choice(["en", "de", None]), rng.choice(["s1", "s2", "s3", None, "s5"]), " 1".join(rng.choices(vocab[: 20 + 20 * rng.randrange(4)], k=rng.randrange(30)))) for _ in range(200)]
    rows += [("fr", "only", "alone here"), ("fr", "empty", None), ("en", "silent", "123"), *[rows[0]] * 4]
    df = spark.createDataFrame(rows, "lang string, source string, text string").repartition(3)
    got = divergence.audit(df, 3, 4, block, share)
    assert sorted(tuple(r) for r in got.collect()) == brute_audit(rows, 3, 4)


def test_shares_and_sums_beyond_64_bits():
    count, total = np.array([0, 7, 10**13 - 1]), np.array([10**13] * 3)
    assert divergence.shares(count, total, 5).tolist() == [1 + 10**9 * (int(c) + 1) // (10**13 + 5) for c in count]
    sums = divergence.Sums(1)
    for v in (2**62, 2**62, 2**62, -(2**61), -1):
        sums.add(np.array([0]), np.array([v]), 3)
    assert int(sums.high[0]) * 2**32 + int(sums.low[0]) == 3 * (3 * 2**62 - 2**61 - 1)


def test_audit_edges(spark):
    assert divergence.audit(spark.createDataFrame([], DOCS)).count() == 0
    rows = awkward(spark)
    want = brute_audit([(r.lang, r.source, r.text) for r in rows.collect()], 2, 200)
    assert sorted(tuple(r) for r in divergence.audit(rows, least=2).collect()) == want and len(want) > 0


# --- 13 -----------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def same_as(library, texts):
    codec, k = piece_bpe.Codec.named("piece_bpe_32k.model"), 0
    for ids, bounds in piece_bpe.coded(codec, pa.array(texts, pa.string())):
        for got, decoded in zip(np.split(ids, bounds[1:-1]), codec.decode(ids, bounds)):
            want = library.encode(texts[k], add_bos=True, add_eos=True)
            assert got.tolist() == want, texts[k][:80]
            assert decoded.decode() == library.decode(want), texts[k][:80]
            k += 1
    assert k == len(texts)


def test_pieces_match_the_public_library(library):
    rng = random.Random(13)
    parts = [*"abeth", "the", " ", "  ", "\n", "\t", "▁", "é", "日", "本", "🎉", "ß", "\x00", "ing", "́", "�", "​", "\xa0", "<s>", "<0x41>", "<unk>"]
    same_as(library, ["", "a", " ", "▁", "  ", "a  b", "   a", "a ", "🎉", "🎉 a", "\n", "x" * 3000, "ab" * 500, "the " * 1000])
    for n in (4, 12, 60):
        same_as(library, ["".join(rng.choices(parts, k=rng.randrange(n))) for _ in range(1500)])
    same_as(library, ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(0x80, 0x3000), rng.randrange(0x4E00, 0x9FFF), 32])) for _ in range(40)) for _ in range(500)])


def test_long_words_and_long_runs_of_spaces(library):
    rng = random.Random(3)
    same_as(library, ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=20_000)), " " * 20_000, " " * 1001 + "x", "x" * 20_000, "a" + " " * 300 + "b"])


def test_memory_of_words_starts_anew(library, monkeypatch):
    monkeypatch.setattr(piece_bpe, "MOST", 5)
    monkeypatch.setattr(piece_bpe, "CHUNK", 20)
    same_as(library, [f"some words {i} again and {i % 3} again" for i in range(50)])


def test_decoding_of_any_ids(library):
    codec, rng = piece_bpe.Codec.named("piece_bpe_32k.model"), random.Random(2)
    rows = [[rng.choice([rng.randrange(32_000), rng.randrange(3, 259), 1, 2, 0, 259]) for _ in range(rng.randrange(8))] for _ in range(2000)]
    flat = np.array([i for r in rows for i in r], dtype=np.int32)
    got = codec.decode(flat, np.cumsum([0, *map(len, rows)]))
    assert [g.decode() for g in got] == [library.decode(r) for r in rows]


def test_piece_rows(spark, library):
    df = awkward(spark)
    got = piece_bpe.encode_decode(df).collect()
    assert sorted((r.doc_id or -1, tuple(r.ids), r.n_tokens, r.decoded) for r in got) == sorted((r.doc_id or -1, tuple(i), len(i), library.decode(i)) for r in df.collect() for i in [library.encode(r.text or "", add_bos=True, add_eos=True)])
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = sorted((r.doc_id or -1, len(r.ids), sha(np.array(r.ids, "<u4").tobytes()), sha(r.decoded.encode())) for r in got)
    assert sorted((r.doc_id or -1, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in piece_bpe.code_digests(df).collect()) == want
    assert piece_bpe.code_digests(spark.createDataFrame([], DOCS)).count() == 0
