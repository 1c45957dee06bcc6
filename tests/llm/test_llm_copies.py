"""Near copies of texts and vectors, repeated passages, and sorting, against brute force."""

import hashlib
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from llm_helpers import clashing, empty_documents, odd_documents, odd_rows, prose
from odmeter.llm import groups, near_copies, near_vectors, repeats, suffix_sort
from odmeter.llm.hashing import Words, shingles


def components(n, links):
    parent = list(range(n))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return [root(x) for x in range(n)]


def bag(text):
    words = [w for w in (text or "").replace("\n", " ").replace("\t", " ").split(" ") if w]
    return Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else None


def brute_classes(rows):
    bags, holders = [bag(t) for _, t in rows], defaultdict(list)
    for k, b in enumerate(bags):
        for s in b or ():
            holders[s].append(k)
    links = set()
    for at in holders.values():
        for i in range(len(at)):
            for j in range(i):
                links.add((at[j], at[i]))

    def alike(pair):
        a, b = (bags[k] for k in pair)
        both = sum((a & b).values())
        return both >= 0.8 * (sum(a.values()) + sum(b.values()) - both)

    roots = components(len(rows), [x for x in links if alike(x)])
    smallest = {}
    for k, r in enumerate(roots):
        if rows[k][0] is not None:
            smallest[r] = min(smallest.get(r, rows[k][0]), rows[k][0])
    return [(rows[k][0], smallest.get(r), roots.count(r)) for k, r in enumerate(roots)]


def test_near_copies_of_the_documents(spark, sf):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = near_copies.op4_near_copies(spark, sf).collect()
    assert sorted((r["doc_id"], r["cluster_id"], r["cluster_rows"]) for r in got) == sorted(brute_classes(rows))
    assert {r["doc_id"] for r in got if r["kept"]} == {r["cluster_id"] for r in got}


@pytest.mark.parametrize("block", [4096, 7])
def test_chains_of_near_copies_in_small_blocks(spark, monkeypatch, block):
    rng = random.Random(4)
    monkeypatch.setattr(near_copies, "BLOCK", block)
    rows = []
    for family in range(3):
        words = prose(rng, 120).split()
        for step in range(25):
            words[rng.randrange(len(words))] = f"changed{family}x{step}"
            rows.append((len(rows) * 3, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted(tuple(r) for r in near_copies.near_copy_classes(docs).select("doc_id", "cluster_id", "cluster_rows").collect())
    assert got == sorted(brute_classes(rows))


def test_odd_documents_and_the_kept_ones(spark):
    docs = clashing(odd_documents(spark), "key", "cluster_id", "_kept_key")
    rows = [(r[0], r[1]) for r in odd_rows()]
    got = sorted((tuple(r) for r in near_copies.near_copy_classes(docs).select("doc_id", "cluster_id", "cluster_rows").collect()), key=repr)
    assert got == sorted(brute_classes(rows), key=repr)
    kept = near_copies.drop_near_copies(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert ids.count(6) == 1 and 1 in ids and not {20, 21, 40, 41} & set(ids) and {2, 3, 4} <= set(ids)
    assert near_copies.near_copy_classes(empty_documents(spark)).count() == 0
    assert near_copies.drop_near_copies(empty_documents(spark)).count() == 0


def test_signatures_estimate_weighted_similarity():
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(words), " ".join(words[:300]), " ".join(words[:200] * 2), "x", ""]
    doc, element, weight = near_copies.bags([t.encode() for t in texts])
    signature = near_copies.dart_signatures(doc, element, weight, len(texts), k=2000)
    for a in range(3):
        for b in range(a):
            x, y = bag(texts[a]), bag(texts[b])
            both = sum((x & y).values())
            real = both / (sum(x.values()) + sum(y.values()) - both)
            assert abs((signature[a] == signature[b]).mean() - real) < 5 * math.sqrt(0.25 / 2000)
    assert (signature[4] == 0).all() and (signature[:4] != 0).all()


def test_words_and_shingles():
    texts = ["a bc  a\n", "", " x", "a bc a", "\t"]
    words = Words([t.encode() for t in texts])
    assert words.counts.tolist() == [3, 0, 1, 3, 0] and len(set(words.hashes.tolist())) == 3
    found, doc = shingles(words, 2)
    assert doc.tolist() == [0, 0, 2, 3, 3] and found[:2].tolist() == found[3:].tolist() and len(set(found.tolist())) == 3


def test_components_against_union_find(spark):
    rng = random.Random(2)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(230)] + [(k, k + 1) for k in range(400, 460)] + [(7, 7)]
    got = {r["node"]: r["component"] for r in groups.connected_components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    roots = components(500, links)
    assert got == {k: roots[k] for a, b in links if a != b for k in (a, b)}
    assert groups.connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_vectors_with_odd_values(spark, monkeypatch):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(6, 16))
    rows = [(100 + k, (base[k % 6] + rng.normal(0, 0.08, 16) * (k > 20)).tolist(), k % 2 if k % 11 else None) for k in range(120)]
    rows += [(1, None, 0), (2, [0.0] * 16, 0), (3, [float("nan")] + [1.0] * 15, 0), (4, [None] + [1.0] * 15, 0), (5, [float("inf")] * 16, 0), (6, [], 0), (7, [1.0, 2.0], 0), (8, [2.0, 4.0], 0)]
    rows += [(None, rows[30][1], rows[30][2]), (100, rows[0][1], rows[0][2])]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int").selectExpr("*", "'x' AS node", "1 AS side")
    stored = [(r["vec_id"], r["embedding"], r["label"]) for r in table.collect()]

    def links(a, b):
        x, y = (np.array(r[1] if r[1] and None not in r[1] else [np.nan]) for r in (stored[a], stored[b]))
        usable = stored[a][2] is not None and stored[a][2] == stored[b][2] and len(x) == len(y) and np.isfinite(x).all() and np.isfinite(y).all() and x.any() and y.any()
        return bool(usable) and x @ y / math.sqrt((x @ x) * (y @ y)) >= 0.93

    pairs = [(a, b) for a in range(len(stored)) for b in range(a) if links(a, b)]
    roots, count = components(len(stored), pairs), Counter(k for p in pairs for k in p)
    smallest = {}
    for k, r in enumerate(roots):
        if stored[k][0] is not None:
            smallest[r] = min(smallest.get(r, stored[k][0]), stored[k][0])
    want = sorted((str(stored[k][0]), count[k], smallest.get(r)) for k, r in enumerate(roots))
    for block in (2048, 5):
        got = near_vectors.near_vector_components(table, block=block)
        assert sorted((str(r["vec_id"]), r["n_links"], r["component_id"]) for r in got.collect()) == want
    assert near_vectors.near_vector_components(table.limit(0)).count() == 0


def test_one_document_of_a_class_stays_where_its_id_has_several_texts(spark):
    rng = random.Random(2)
    text = prose(rng, 80)
    rows = [(1, text), (1, text + " end"), (2, text + " other"), (None, prose(rng, 70)), (None, prose(rng, 60)), (5, ""), (5, None), (6, " ")]
    kept = near_copies.drop_near_copies(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sum(r["doc_id"] == 1 for r in kept) == 1 and not any(r["doc_id"] == 2 for r in kept)
    assert sum(r["doc_id"] is None for r in kept) == 2
    assert sum(r["doc_id"] in (5, 6) for r in kept) == 2


def test_near_copies_of_a_larger_table(spark):
    """Links at 0.8 over the tenth-scale table, found exactly by shared shingles, against the classes of the operator."""
    sf = "/root/testdata/sf0.01"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = {r["doc_id"]: r["cluster_id"] for r in near_copies.op4_near_copies(spark, sf).collect()}
    want = {d: c for d, c, _ in brute_classes(rows)}
    assert sum(got[d] == (c if c is not None else d) for d, c in want.items()) >= 0.99 * len(want)


def brute_repeats(rows, length):
    strings = Counter()
    for _, t in rows:
        b = (t or "").encode()
        strings.update(b[i : i + length] for i in range(len(b) - length + 1))
    out = []
    for doc_id, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if strings[b[i : i + length]] > 1:
                gone[i : i + length] = True
        spans = sum(gone[i] and not (i and gone[i - 1]) for i in range(len(b)))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((doc_id, len(b), int(gone.sum()), int(spans), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def passages():
    rng = random.Random(6)
    shared = ["".join(rng.choice("abc ") for _ in range(rng.randrange(380, 900))) for _ in range(6)]
    rows = []
    for i in range(90):
        own = "".join(rng.choice("xyz ") for _ in range(rng.randrange(0, 300)))
        p = rng.choice(shared)
        rows.append((i % 70, own + p[rng.randrange(0, len(p) - 100) :] + rng.choice(shared)[: rng.randrange(100, 500)] + own[:50]))
    return rows + [(200, None), (201, ""), (None, "a" * 3000), (203, "ab" * 900), (203, "ab" * 900), (204, "é" * 401)]


@pytest.mark.parametrize("hot", [4096, 3])
def test_repeated_passages(spark, hot):
    rows = passages()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "'x' AS key", "1 AS start", "2 AS gram")
    got = sorted((tuple(r) for r in repeats.remove_repeats(docs, hot=hot).collect()), key=repr)
    assert got == brute_repeats(rows, 400)


def test_runs_of_a_gram_meet_where_partitions_stay_small(spark):
    """Equal strings in texts of different tasks, with a hot gram beside them; adaptive execution keeps all partitions, as on larger tables."""
    rng = random.Random(8)

    def letters(kinds, n):
        return "".join(rng.choice(kinds) for _ in range(n))

    shared, often = [letters("abcdefgh", 420) for _ in range(60)], letters("klm", 64)
    rows = [(2 * i + j, letters("xyz", 50) + s + letters("uvw", 50)) for i, s in enumerate(shared) for j in range(2)]
    rows += [(1000 + i, letters("rst", 200) + often + letters("rst", 200)) for i in range(40)]
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(8)
        got = sorted((tuple(r) for r in repeats.remove_repeats(docs, hot=5).collect()), key=repr)
    finally:
        spark.conf.set(name, before)
    assert got == brute_repeats(rows, 400)
    assert sum(n > 0 for _, _, n, _, _ in got) == 120


def test_texts_whose_sums_of_powers_agree(spark):
    """Thue-Morse words over two chosen letters: sums of bytes times powers of a base modulo 2^64 are equal, the bytes are not."""
    word = [0]
    while len(word) < 64:
        word += [1 - x for x in word]
    one, other = ("".join(("afjf", "jynz")[x ^ flip] for x in word) for flip in (0, 1))
    rng = random.Random(4)
    pad = ["".join(rng.choice("klm ") for _ in range(80)) for _ in range(2)]

    def rows_with(gram):
        return [(1, pad[0] + one + gram + other + pad[1]), (2, pad[0] + other + gram + one + pad[1])]

    # a gram between the words that is the anchor of all strings
    for _ in range(20000):
        rows = rows_with("".join(rng.choice("abcdefgh") for _ in range(64)))
        runs = [repeats.runs_of([t.encode()]) for _, t in rows]
        if all(r["strings"].tolist() == [337] for r in runs):
            break
    assert [len(r["strings"]) for r in runs] == [1, 1] and runs[0]["gram"][0] == runs[1]["gram"][0]
    assert not np.array_equal(runs[0]["content"], runs[1]["content"])
    got = sorted((tuple(r) for r in repeats.remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()), key=repr)
    assert got == brute_repeats(rows, 400)
    assert all(n == 0 for _, _, n, _, _ in got)


def test_segments_of_long_texts(spark, monkeypatch):
    rng = random.Random(7)
    monkeypatch.setattr(repeats, "SEGMENT", 700)
    text = prose(rng, 900)
    rows = [(1, text), (2, prose(rng, 30) + text[1000:1900] + prose(rng, 30)), (3, prose(rng, 500))]
    found = [repeats.runs_of([t.encode()]) for _, t in rows[:1]]
    assert found[0]["strings"].sum() == len(text.encode()) - 399
    got = sorted((tuple(r) for r in repeats.remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()), key=repr)
    assert got == brute_repeats(rows, 400)
    assert repeats.remove_repeats(empty_documents(spark)).count() == 0


def test_deep_shallow_sort():
    rng = random.Random(1)
    for k in range(200):
        texts = [bytes(rng.choice(b"ab") for _ in range(rng.randrange(0, 40))) for _ in range(rng.randrange(0, 60))]
        texts = [b"x" * 30 + t for t in texts] if k % 2 else texts
        order, shared = suffix_sort.deep_shallow_sort(texts)
        assert [texts[i] for i in order] == sorted(texts)
        assert all(shared[j] == suffix_sort.common_prefix(texts[order[j - 1]], texts[order[j]]) for j in range(1, len(texts)))


def test_more_vectors_get_more_bits_and_keep_the_recall():
    assert near_vectors.settings(0) == near_vectors.settings(60_000) == (36, 10)
    rng = np.random.default_rng(0)
    for most in (10**6, 10**8):
        tables, bits = near_vectors.settings(most)
        assert most / 2**bits <= near_vectors.FILL and tables > 36
        agree = (1 - math.acos(0.93) / math.pi) ** bits
        assert (1 - agree) ** tables <= near_vectors.MISS
        # pairs at the cosine itself: nearly all meet in a table
        a = rng.standard_normal((400, 48))
        b = rng.standard_normal((400, 48))
        a /= np.linalg.norm(a, axis=1, keepdims=True)
        b -= (a * b).sum(1, keepdims=True) * a
        b = 0.93 * a + math.sqrt(1 - 0.93**2) * b / np.linalg.norm(b, axis=1, keepdims=True)
        met = (near_vectors.codes(a, tables, bits) == near_vectors.codes(b, tables, bits)).any(1)
        assert met.mean() > 0.99


def test_multikey_quicksort_orders_and_groups():
    rng = np.random.default_rng(5)
    for n, columns, values in ((0, 2, 3), (1, 2, 3), (50, 1, 4), (400, 4, 2), (300, 2, 1), (2000, 3, 50)):
        symbols = rng.integers(0, values, (n, columns)).astype(np.uint64)
        for rows in (symbols, np.sort(symbols, 0), symbols + np.uint64(2**64 - 60)):
            order, bounds = suffix_sort.multikey_quicksort(rows)
            inside = [tuple(map(int, rows[i])) for i in order]
            assert inside == sorted(inside)
            assert [b for x in bounds for b in range(*x)] == list(range(n))
            for (a, b), after in zip(bounds, [*bounds[1:], None]):
                assert len(set(inside[a:b])) == 1 and (after is None or inside[a] < inside[after[0]])


def test_repeats_of_the_documents(spark):
    """The query on all documents of the small table, against brute force over every 400-byte string."""
    sf = "/root/testdata/sf0.01"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = repeats.op8_remove_repeats(spark, sf).collect()
    assert all(r["has_repeat"] == (r["n_removed"] > 0) for r in got)
    seen, texts = Counter(), [(t or "").encode() for _, t in rows]
    for t in texts:
        seen.update(hash(t[i : i + 400]) for i in range(len(t) - 399))
    want = []
    for (doc_id, _), t in zip(rows, texts):
        edge = np.zeros(len(t) + 1, np.int64)
        for i in range(len(t) - 399):
            if seen[hash(t[i : i + 400])] > 1:
                edge[i] += 1
                edge[i + 400] -= 1
        gone = np.cumsum(edge)[:-1] > 0
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        want.append((doc_id, len(t), int(gone.sum()), spans, hashlib.sha256(np.frombuffer(t, np.uint8)[~gone].tobytes()).hexdigest()))
    assert sorted(tuple(r)[:5] for r in got) == sorted(want)


def test_whole_groups_across_batches():
    import pyarrow as pa

    keys = [1, 1, 2, 2, 2, 3, 4, 4, 4, 4, 5]
    for size in range(1, 12):
        batches = [pa.RecordBatch.from_pydict({"g": keys[i : i + size]}) for i in range(0, len(keys), size)]
        out = []
        for table, bounds in groups.whole_groups(iter(batches), "g"):
            values = table.column("g").to_pylist()
            out += [values[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
        assert out == [[1, 1], [2, 2, 2], [3], [4, 4, 4, 4], [5]]
