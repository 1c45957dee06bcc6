"""Ranked search, harmonic packing and the conversation trie against brute force and their SQL."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from llm_helpers import clashing, empty_documents, odd_documents, odd_rows, prose
from odmeter.llm import byte_tokens, harmonic, lexical, prefix_trie

ITEMS = "item_id bigint, text string"


def brute_ranks(docs, items, top=10):
    def words(text):
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        return re.findall("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text)

    held = [(i, Counter(words(t))) for i, t in docs if words(t)]
    total, length = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(w for _, c in held for w in c)
    out = []
    for item, text in items:
        found = []
        for doc, c in held:
            n, score = sum(c.values()), 0
            m = 100 - 90 + 90 * n * total // length
            for w in set(words(text)) & set(c):
                score += math.floor(1000 * math.log((2 * total + 2) / (2 * df[w] + 1))) * (1_000_000_000 * c[w] // (1000 * c[w] + 8 * m))
            if score:
                found.append((-score, doc is None, doc or 0))
        out += [(item, k + 1, None if none else doc, -score) for k, (score, none, doc) in enumerate(sorted(found)[:top])]
    return out


@pytest.mark.parametrize("first", [1, 5, 10**6])
@pytest.mark.parametrize("block", [1, 10**6])
def test_search_against_brute_force(spark, first, block):
    rng = random.Random(3)
    docs = [(r[0], r[1]) for r in odd_rows()] + [(100 + k, prose(rng, rng.randrange(1, 90)).title()) for k in range(200)]
    docs += [(400 + k, docs[-1][1]) for k in range(30)]
    items = [(1, docs[40][1]), (2, prose(rng, 30)), (2, "AN, be; Ti! an"), (3, None), (4, ""), (5, "ÀÉ zzz"), (None, "one two"), (1, docs[40][1]), (6, docs[-1][1])]
    frame = clashing(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5), "norm", "n", "ids", "level")
    wanted = clashing(spark.createDataFrame(items, ITEMS), "doc_id", "rank", "item")
    got = lexical.search(frame, wanted, first=first, block_bytes=block).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(brute_ranks(docs, items), key=repr)


def test_search_of_nothing(spark):
    none, some = spark.createDataFrame([], ITEMS), spark.createDataFrame([(1, "one two")], ITEMS)
    assert lexical.search(odd_documents(spark), none).count() == 0
    assert lexical.search(empty_documents(spark), some).count() == 0
    assert lexical.search(spark.createDataFrame([(1, "."), (2, None)], "doc_id bigint, text string"), some).count() == 0


def test_bounds_leave_out_most_documents(spark, sf, monkeypatch):
    """The two rounds and the bounds must save work: few of the documents with a term are offered."""
    rows = spark.read.parquet(f"{sf}/documents.parquet").collect()
    items = [(k, lexical.terms(r["text"].encode())) for k, r in enumerate(spark.read.parquet(f"{sf}/benchmark.parquet").limit(10).collect())]
    vocabulary = {w: k for k, w in enumerate(sorted({w for _, asked in items for w in asked}))}
    counts = [Counter(vocabulary[w] for w in lexical.terms(r["text"].encode()) if w in vocabulary) for r in rows]
    ids = [np.array(sorted(c), "<u4") for c in counts]
    impacts = [np.array([10**5 * c[i] for i in sorted(c)], "<i8") for c in counts]
    norms = np.array([math.sqrt(float((x.astype(float) ** 2).sum())) for x in impacts])
    order = np.argsort(-norms)
    best = lexical.Best(np.zeros(len(items), np.int64), 10)
    offered, offer = [], best.offer
    monkeypatch.setattr(best, "offer", lambda item, d, s: (offered.append(len(d)), offer(item, d, s)))
    for at in range(0, len(order), 20):
        some = order[at : at + 20]
        bucket = lexical.Bucket(some, norms[some], [ids[k].tobytes() for k in some], [impacts[k].tobytes() for k in some], len(vocabulary))
        for item, (_, asked) in enumerate(items):
            bucket.search(item, np.array(sorted({vocabulary[w] for w in asked})), best)
    touched = sum(bool({vocabulary[w] for w in asked} & set(c)) for _, asked in items for c in counts)
    assert sum(offered) < touched / 2


@pytest.mark.parametrize("module,tables,name", [(lexical, ("documents", "benchmark"), "op11_ranked_search"), (prefix_trie, ("conversations",), "op13_prefix_trie")])
def test_twins(spark, sf, module, tables, name):
    duck = duckdb.connect()
    for table in tables:
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf}/{table}.parquet'")
    want = duck.execute(module.ORACLE)
    columns = [c[0] for c in want.description]
    got = getattr(module, name)(spark, sf)
    assert sorted(got.columns) == sorted(columns)
    assert sorted((tuple(r) for r in got.select(columns).collect()), key=repr) == sorted(want.fetchall(), key=repr)


SIGNS = ["a", "Be", " ", "  ", "\n", "\t", "é", "7", "'s", "'", "!", "<|endoftext|>", "\xa0", "\x1c", "\x85", "東", "😀", "́", "​", "don't", "\r\n", " ", "　"]


def test_byte_encoder_equals_plain_encode():
    rng = random.Random(2)
    texts = ["".join(rng.choice(SIGNS) for _ in range(rng.randrange(25))) for _ in range(4000)] + [prose(rng, 400), "x" * 5000]
    for keep in (byte_tokens.KEEP, 7):
        encoder = byte_tokens.ByteEncoder(keep=keep)
        for text in texts:
            assert encoder.encode(text).tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids, text
        assert len(encoder.words) <= keep and len(encoder.others) <= keep
    assert encoder.encode(None).tolist() == []


@pytest.mark.parametrize("capacity,slack", [(2048, 32), (64, 4), (7, 2)])
def test_cuts_fill_their_classes(capacity, slack):
    for total in range(1, 3 * capacity):
        made = harmonic.cuts(total, capacity, slack)
        assert sum(n for n, _ in made) == total
        assert all(0 < n <= capacity // k and (capacity // k - n) * slack <= capacity // k for n, k in made)
        assert len(made) <= total // capacity + 4


def check_packed(rows, texts, capacity=2048):
    """Rows of op12 against plain encodes; returns the padding."""
    plain = byte_tokens.ByteEncoder().tokenizer
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for doc, start, length, crc, tokens, sequence, offset in rows:
        by_doc[doc].append((start, length, crc, tokens))
        by_sequence[sequence].append((offset, length))
    want = Counter()
    for doc, text in texts:
        want[doc, tuple([*plain.encode(text or "", add_special_tokens=False).ids, 1])] += 1
    assert set(by_doc) == {d for d, _ in want}
    for doc in by_doc:
        ids = [(i, n) for (d, i), n in want.items() if d == doc]
        covered = sum(x[1] for x in by_doc[doc])
        assert covered == sum(len(i) * n for i, n in ids)
        for start, length, crc, tokens in by_doc[doc]:
            assert any(tokens == len(i) and crc == zlib.crc32(np.array(i[start : start + length], "<u4").tobytes()) and start + length <= tokens for i, _ in ids)
        if len(ids) == 1 and ids[0][1] == 1:
            at = 0
            for start, length, *_ in sorted(by_doc[doc]):
                assert start == at
                at += length
    padding = 0
    for pieces in by_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
        padding += capacity - at if at & (at - 1) else 0
    return padding


def test_harmonic_packing_of_the_documents(spark, sf):
    texts = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    rows = [tuple(r) for r in harmonic.op12_harmonic_packing(spark, sf).collect()]
    assert check_packed(rows, texts) < 0.01 * sum(r[2] for r in rows)


def test_harmonic_packing_of_odd_documents(spark):
    docs = clashing(odd_documents(spark).repartition(3), "class", "position", "sequence_id", "offset", "length")
    rows = [tuple(r) for r in harmonic.pack_documents(docs).collect()]
    check_packed(rows, [(r[0], r[1]) for r in odd_rows()])
    assert harmonic.pack_documents(empty_documents(spark)).count() == 0


def test_harmonic_sequences_hold_as_many_as_their_class(spark):
    pieces = spark.createDataFrame([(k, 0, n, 0, n, 2048 // n) for k, n in enumerate([400] * 23 + [1000] * 9 + [60] * 100 + [2048] * 3)],
                                   "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, class int")
    held = defaultdict(list)
    for r in harmonic.pack(pieces).collect():
        held[r["sequence_id"]].append(r["length"])
    full = Counter(tuple(sorted(x)) for x in held.values())
    assert full[(400,) * 5] == 4 and full[(1000,) * 2] == 4 and full[(60,) * 34] == 2 and full[(2048,)] == 3
    assert sum(len(x) for x in held.values()) == 135


def test_centroid_sums_of_random_forests():
    rng = random.Random(8)
    for n in [1, 2, 3, 10, 60, 400]:
        for shape in ("any", "deep", "wide"):
            back = {"any": n, "deep": 2, "wide": n}[shape]
            parents = np.array([-1 if k == 0 or rng.random() < 0.05 else rng.randrange(max(0, k - back), k) if shape != "wide" else rng.randrange(min(k, 3)) for k in range(n)])
            values = np.array([[rng.randrange(9), rng.randrange(10**12)] for _ in range(n)])
            want = values.copy()
            for k in range(n - 1, 0, -1):
                if parents[k] >= 0:
                    want[parents[k]] += want[k]
            assert (prefix_trie.centroid_sums(parents, values) == want).all()


def brute_trie(rows):
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            convs[conv].append(((turn is not None, turn or 0, digest), (role, text)))
    own = {c: [x for _, x in sorted(t)] for c, t in convs.items()}
    members, ending = defaultdict(list), defaultdict(list)
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        path = tuple(own.get(c - c % 100, [])[:h] + own[c][h:])
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
        ending[path].append(c)
    out = []
    for node, who in members.items():
        under = [x for x in members if x[: len(node)] == node]
        parents_of = [x[:-1] for x in under if x]
        ends = ",".join(map(str, sorted(ending[node])))
        out.append((
            min(who), len(node), min(members[node[:-1]]) if node else None, len(who), sum(len(x) == len(node) + 1 for x in under),
            sum(x not in parents_of for x in under), sum((len(members[x]) - 1) * len(x[-1][1]) for x in under if x), hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return out


CONVERSATIONS = "conv_id bigint, turn bigint, role string, text string"


@pytest.mark.parametrize("base,stripe", [(1024, 1024), (4, 3), (2, 2)])
def test_trie_against_brute_force(spark, base, stripe):
    rng = random.Random(4)
    texts = ["hi", "", None, "and then é😀", "yes", "no " * 30]
    rows = [(c, t, rng.choice(["user", "bot", None]), rng.choice(texts)) for c in [*range(0, 40), *range(100, 130), *range(530, 540)] for t in range(rng.randrange(1, 7))]
    rows += [(200, t, "user", f"turn {t}") for t in range(40)] + [(c, t, "user", f"turn {t}") for c in range(201, 220) for t in range(rng.randrange(41))]
    rows += [(7, None, "user", "hi"), (7, None, None, None), (7, 2, "user", "hi"), (7, 2, "user", "hi"), (None, 1, "user", "hi"), (0, 1, "x", "y")]
    frame = clashing(spark.createDataFrame(rows, CONVERSATIONS).repartition(4), "node", "parent", "depth", "component", "hash")
    got = prefix_trie.trie(frame, base, stripe).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(brute_trie(rows), key=repr)


def test_trie_of_negative_and_turnless_conversations(spark):
    rows = [(-5, 0, "user", "a"), (0, 0, "user", "b"), (-105, 0, "user", "a"), (301, 1, "user", "c"), (302, 1, "user", "d"), (303, 0, "user", "e"), (304, 9, "u", "f")]
    got = prefix_trie.trie(spark.createDataFrame(rows, CONVERSATIONS)).collect()
    # Spark's remainder takes the sign of the number, so the hundreds below zero begin at their upper end
    assert sum(r["depth"] == 0 for r in got) == 1
    assert next(r["n_convs"] for r in got if r["depth"] == 0) == 7


def test_trie_of_nothing(spark):
    empty = prefix_trie.trie(spark.createDataFrame([], CONVERSATIONS))
    assert empty.count() == 0
    assert empty.columns == prefix_trie.trie(spark.createDataFrame([(1, 1, "a", "b")], CONVERSATIONS)).columns


def test_ends_of_many_ranges_are_hashed_in_order(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "ENDS", 7)
    ids = [*range(-30, 90), 10**12]
    rows = spark.createDataFrame([("n", c, 1, 1) for c in ids] + [("m", 3, 2, 2)], "node string, conv_id bigint, depth bigint, length bigint").repartition(5)
    got = {r["node"]: r["ends_sha256"] for r in prefix_trie.end_hashes(rows).collect()}
    assert got == {"n": hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), "m": hashlib.sha256(b"3").hexdigest()}
