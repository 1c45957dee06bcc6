"""Encoding, bit packing and packing against plain encodes and brute force."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from llm_helpers import clashing, empty_documents, odd_documents, odd_rows, prose
from odmeter.llm import bitpack, packing, tokens


@pytest.fixture(scope="module")
def plain():
    return tokens.Encoder().tokenizer


ODD = [
    "", " ", "<|endoftext|>.", "a<|endoftext|>b <|ENDOFTEXT|> x", "it's. don'T, O'Neil's!!", "é́. é, ́a",
    "İstanbul. ǅ ǆ, ŉ ſ", "x\ty\rz\x0bq\x1cw\xa0e r", "ﬁne. Ωmega, 東京タワー。 1234.56 a1.b2",
    "''s 's. '' ,'s", "ÿ.Ÿ, ẞ ß.", "a\n\nb", "$%&.'s", "ª. º. µ! ǰ.", "a" * 3000,
]


def test_encoder_equals_plain_encode(plain, monkeypatch):
    rng = random.Random(1)
    texts = ODD + [prose(rng, 300).title() for _ in range(5)] + ["".join(rng.choice("ab'. <|>é́\n,1") for _ in range(80)) for _ in range(300)]
    for keep in (tokens.KEEP, 7):
        monkeypatch.setattr(tokens, "KEEP", keep)
        monkeypatch.setattr(tokens, "KEEP_STEMS", keep)
        encoder = tokens.Encoder()
        for text in texts:
            assert encoder.encode(text).tolist() == plain.encode(text, add_special_tokens=False).ids, text
    assert encoder.encode(None).tolist() == []


@pytest.mark.parametrize("bits", [1, 3, 8, 11, 16, 17, 31, 32])
def test_bits_round_trip_and_random_access(bits):
    draw = np.random.default_rng(bits)
    docs = [draw.integers(0, 1 << bits, n, dtype=np.uint64).astype(np.uint32) for n in (0, 1, 7, 100, 33, 0, 260)]
    data = bitpack.pack_segment([5, None, 7, 8, 9, 9, -1], docs, bits, block=64)
    segment, whole = bitpack.Segment(data), np.concatenate(docs)
    assert segment.doc_ids == [5, None, 7, 8, 9, 9, -1]
    assert all((segment.document(k) == d).all() for k, d in enumerate(docs))
    for a, b in ((0, 0), (0, 1), (63, 65), (64, 128), (100, 401), (0, 401)):
        assert (segment.read(a, b) == whole[a:b]).all()
    if bits not in (8, 16, 32):
        assert len(bitpack.pack_bits(whole, bits)) == -(-len(whole) * bits // 8)
    else:
        single = (whole[:, None].astype(np.uint64) >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)
        assert np.packbits(single.astype(np.uint8).reshape(-1), bitorder="little").tobytes() == bitpack.pack_bits(whole, bits)


def test_width():
    assert [bitpack.width(n) for n in (1, 2, 3, 49_408, 65_536, 65_537)] == [1, 1, 2, 16, 16, 17]
    with pytest.raises(ValueError):
        bitpack.pack_segment([1], [np.array([4], np.uint32)], 2)


def expected_tokens(plain, rows, end):
    out, start = [], 0
    for doc_id, text in rows:
        ids = np.array(plain.encode(text or "", add_special_tokens=False).ids + [end], "<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_token_file(spark, plain, tmp_path):
    docs = clashing(odd_documents(spark), "part", "start")
    path = str(tmp_path / "tokens")
    bitpack.write_token_file(docs, path, segment_ids=500)
    got = sorted((tuple(r) for r in bitpack.read_token_file(spark, path).collect()), key=lambda r: r[1])
    ids = [r[0] for r in got]
    assert ids == sorted(ids, key=lambda d: (d is not None, d))
    want = expected_tokens(plain, [(r[0], r[1]) for r in odd_rows()], 2)
    assert sorted((r[0], r[2], r[3]) for r in got if r[0]) == sorted((r[0], r[2], r[3]) for r in want if r[0])
    assert [r[1] for r in got] == [sum(x[2] for x in got[:k]) for k in range(len(got))]
    assert spark.read.parquet(path).count() > 1
    with_ids = bitpack.read_token_file(spark, path, with_ids=True).where("doc_id = 6").first()["ids"]
    assert with_ids == plain.encode("one two", add_special_tokens=False).ids + [2]


def test_whole_table(spark, sf, plain):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()]
    assert sorted(tuple(r) for r in bitpack.op7_bitpack_tokens(spark, sf).collect()) == expected_tokens(plain, rows, 2)
    got = [tuple(r) for r in packing.op10_best_fit_packing(spark, sf).collect()]
    want = []
    for doc_id, text in rows:
        ids = np.array(plain.encode(text, add_special_tokens=False).ids + [0], "<u4")
        want += [(doc_id, k // 2048, k, len(ids[k : k + 2048]), zlib.crc32(ids[k : k + 2048].tobytes())) for k in range(0, len(ids), 2048)]
    assert sorted(r[:5] for r in got) == sorted(want)
    gapless(got)
    assert len({r[5] for r in got}) <= 1.01 * sum(r[3] for r in got) / 2048 + 1


def gapless(rows):
    bins = defaultdict(list)
    for r in rows:
        bins[r[5]].append((r[6], r[3]))
    for pieces in bins.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048


def test_odd_documents_are_packed(spark):
    got = [tuple(r) for r in packing.pack_documents(clashing(odd_documents(spark), "length", "position")).collect()]
    gapless(got)
    assert len({r[:3] for r in got if r[0] is not None}) >= 15 and sum(r[2] == 0 for r in got) == len(odd_rows())


def test_empty_tables(spark, tmp_path):
    docs = empty_documents(spark)
    bitpack.write_token_file(docs, str(tmp_path / "none"))
    assert bitpack.read_token_file(spark, str(tmp_path / "none")).count() == 0
    assert packing.pack_documents(docs).count() == 0


def test_fullest_against_brute_force():
    rng = random.Random(3)
    for _ in range(200):
        counts = {rng.randrange(1, 30): rng.randrange(1, 4) for _ in range(rng.randrange(1, 6))}
        room = rng.randrange(0, 70)
        items = [n for n, c in counts.items() for _ in range(c)]
        best = max(sum(x for x, used in zip(items, bin(m)[2:].zfill(len(items))) if used == "1") if sum(x for x, used in zip(items, bin(m)[2:].zfill(len(items))) if used == "1") <= room else 0 for m in range(1 << min(len(items), 10))) if len(items) <= 10 else None
        chosen = packing.fullest(counts, room)
        total = sum(n * k for n, k in chosen.items())
        assert total <= room and all(k <= counts[n] for n, k in chosen.items())
        assert best is None or total == best


def test_plan_uses_every_piece_once():
    counts = {2048: 5, 1500: 7, 548: 3, 500: 20, 48: 11, 1: 4000}
    used = defaultdict(int)
    for combination, times in packing.plan(dict(counts)):
        assert sum(n * k for n, k in combination.items()) <= 2048
        for n, k in combination.items():
            used[n] += k * times
    assert dict(used) == counts
