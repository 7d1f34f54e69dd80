"""Exact dedups and near-duplicate groups against brute force."""

import hashlib
import random

import numpy as np
import pytest

from dockcast.llm import buckets, hyperminhash, rlbwt, superkmer


@pytest.fixture(scope="module")
def repetitive():
    """Texts with shared passages, copies, edits and runs of one word."""
    rng = random.Random(5)
    vocabulary = [f"{a}{b}" for a in "abcdefgh" for b in "xyz"]
    passage = [rng.choice(vocabulary) for _ in range(60)]
    rows = []
    for i in range(60):
        words = [rng.choice(vocabulary) + str(rng.randrange(50)) for _ in range(rng.randrange(0, 80))]
        if i % 3 == 0:
            at, a, b = rng.randrange(len(words) + 1), rng.randrange(20), rng.randrange(30, 60)
            words[at:at] = passage[a:b]
        if i % 7 == 0:
            words += ["the"] * rng.randrange(10, 60)
        rows.append((i if i % 9 else None, " ".join(words)))
        if i % 10 == 0:
            rows.append((200 - i, "\n ".join(words)))
    rows += [(rows[4][0], rows[4][1]), (300, rows[5][1] + "é"), (5, "same id, other text " + " ".join(passage))]
    return rows


def brute_words(rows, w):
    first = {}
    for i, t in rows:
        words = t.split()
        for k in range(len(words) - w + 1):
            key = tuple(words[k:k + w])
            d = 1 << 70 if i is None else i
            first[key] = min(first.get(key, d), d)
    out = []
    for i, t in rows:
        words = t.split()
        gone = {j for k in range(len(words) - w + 1) if first[tuple(words[k:k + w])] < (1 << 70 if i is None else i) for j in range(k, k + w)}
        out.append((i, len(words), len(gone), hashlib.sha256(" ".join(x for j, x in enumerate(words) if j not in gone).encode()).hexdigest()))
    return sorted(map(repr, out))


@pytest.mark.parametrize("options", [{}, {"hot": 1, "bucket_bytes": 1 << 10}, {"k": 1, "hot": 2}])
def test_superkmer(make_docs, repetitive, options):
    got = superkmer.dedup_words(make_docs(repetitive), **options).drop("kept")
    assert sorted(repr(tuple(r)) for r in got.collect()) == brute_words(repetitive, 13)


def brute_bytes(rows, w):
    seen = {}
    for _, t in rows:
        b = t.encode()
        for k in range(len(b) - w + 1):
            seen[b[k:k + w]] = seen.get(b[k:k + w], 0) + 1
    out = []
    for i, t in rows:
        b = t.encode()
        mask = np.zeros(len(b), bool)
        for k in range(len(b) - w + 1):
            if seen[b[k:k + w]] > 1:
                mask[k:k + w] = True
        kept = bytes(x for x, m in zip(b, mask) if not m)
        runs = int((np.diff(np.concatenate([[0], mask.astype(int)])) == 1).sum())
        out.append((i, len(b), int(mask.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(map(repr, out))


@pytest.mark.parametrize("options", [{}, {"hot": 1, "bucket_bytes": 1 << 10}, {"k": 7, "hot": 3}])
def test_rlbwt(make_docs, repetitive, options):
    got = rlbwt.dedup_bytes(make_docs(repetitive), **options).drop("kept")
    assert sorted(repr(tuple(r)) for r in got.collect()) == brute_bytes(repetitive, 200)


@pytest.fixture(scope="module")
def copies(repetitive):
    """Groups of equal texts: with ids, without, with one id for all, shorter than a window; passages shared with others."""
    rows = list(repetitive)
    for n, (i, t) in enumerate(repetitive[3:12]):
        rows += [((None, 7, 1000 + j)[n % 3], t) for j in range(6)] + [(900 + n, t)]
    return rows + [(2000 + j, "few words") for j in range(5)] + [(None, "") for _ in range(5)]


@pytest.mark.parametrize("least", [2, 6])
def test_copies_are_exchanged_once(make_docs, copies, least):
    got = superkmer.dedup_words(make_docs(copies), copies=least).drop("kept")
    assert sorted(repr(tuple(r)) for r in got.collect()) == brute_words(copies, 13)
    got = rlbwt.dedup_bytes(make_docs(copies), copies=least).drop("kept")
    assert sorted(repr(tuple(r)) for r in got.collect()) == brute_bytes(copies, 200)
    _, once = buckets.copied(buckets.row_key(make_docs(copies), "doc_id", "text"), "t", len(copies), 2)
    assert once.count() == len({t for _, t in copies})


def test_partitions_grow_with_the_strings(make_docs, repetitive, monkeypatch):
    monkeypatch.setattr(buckets, "PARTITION_BYTES", 1 << 10)
    got = superkmer.dedup_words(make_docs(repetitive), bucket_bytes=1 << 10).drop("kept")
    assert sorted(repr(tuple(r)) for r in got.collect()) == brute_words(repetitive, 13)
    rows = buckets.row_key(make_docs(repetitive), "doc_id", "text").selectExpr("d", "h", "0L AS at", "CAST(text AS BINARY) AS data")
    for size, parts in ((1 << 16, 64), (1 << 8, None)):
        found = buckets.exchange(rows, superkmer.cutter(13, 3), size, 1 << 10, superkmer.reducer(13, 20))
        n = found.rdd.getNumPartitions()
        assert n == parts if parts else n <= int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def test_places_make_a_key_hot():
    """A string at very many places leaves its bucket, whatever the number of strings."""
    one = np.ones(1, np.uint64)
    held, left = buckets.Held(2), []
    for i in range(300):
        row = next(buckets.block_rows([(one, [b"a b c"], i, i, np.array([i]))], 1))
        left += held.add(buckets.Block(row[1]))
    assert held.places < 2 * buckets.PLACES * 2 and [x[1] for x in left] == list(range(300))[:len(left)] and len(left) + held.places == 300


def test_run_index_statistics():
    rng = random.Random(1)
    for _ in range(60):
        base = bytes(rng.choices(b"ab\0c", k=rng.randint(1, 60)))
        texts = []
        for _ in range(rng.randint(1, 6)):
            t = bytearray(base * rng.randint(1, 3))
            for _ in range(rng.randint(0, 3)):
                t[rng.randrange(len(t))] = rng.choice(b"ab\0c")
            texts.append(bytes(t[rng.randrange(len(t)):]) or b"a")
        index = rlbwt.RunIndex(texts)
        suffixes = [t[i:] for t in texts for i in range(len(t))]

        def common(a, b):
            n = 0
            while n < min(len(a), len(b)) and a[n] == b[n]:
                n += 1
            return n

        want = [max((common(a, b) for j, b in enumerate(suffixes) if j != i), default=0) for i, a in enumerate(suffixes)]
        assert index.matching_statistics().tolist() == want
        assert index.runs <= index.n


def test_no_text_repeats_unseen():
    for p in (b"ab" * 150, b"x" * 201, bytes(range(100)) * 3, b"q" + bytes(range(200)) + b"r"):
        windows = [p[i:i + 200] for i in range(len(p) - 199)]
        if len(set(windows)) < len(windows):
            assert rlbwt.repeats_itself(p, 200)


def brute_groups(rows):
    sets = []
    for _, t in rows:
        w = "".join(c.lower() if c.isascii() else c for c in t or "").split()
        sets.append({tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                up[root(i)] = root(j)
    out = []
    for i, (d, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if root(j) == root(i) and rows[j][0] is not None]
        c = (min(ids) if ids else None) if sets[i] else d
        out.append((d, len(sets[i]), c, d == c))
    return sorted(map(repr, out))


@pytest.fixture(scope="module")
def near(repetitive):
    """Groups whose links are close to the limit, and chains of links."""
    rng = random.Random(9)
    rows = list(repetitive)
    n = 1000
    for size in (6, 7, 9, 20, 60, 300):
        for group in range(4):
            words = [f"{size}g{group}w{i}" for i in range(size + 4)]
            rows.append((n, " ".join(words)))
            for step in range(6):
                w = list(words)
                for _ in range(rng.randrange(0, max(2, size // 12))):
                    w[rng.randrange(len(w))] = f"new{n}{step}"
                if step % 3 == 0:
                    w = w[:len(w) - step // 2]
                if step % 2:
                    words = w  # the chain goes on from here
                n += 1
                rows.append((n, " ".join(w).upper() if step == 4 else " ".join(w)))
            n += 1
    return rows


def test_near_duplicates(make_docs, near):
    got = hyperminhash.near_duplicates(make_docs(near)).drop("d", "h")
    assert sorted(repr(tuple(r)) for r in got.collect()) == brute_groups(near)


def test_near_duplicates_in_blocks(make_docs, near):
    got = hyperminhash.near_duplicates(make_docs(near), block=3).drop("d", "h")
    assert sorted(repr(tuple(r)) for r in got.collect()) == brute_groups(near)


def test_near_duplicates_of_short_texts(make_docs):
    rng = random.Random(2)
    rows = []
    for i in range(300):  # 11 words and their first 10: 7 and 6 shingles, similarity 0.857; then three of them, for a group with two labels
        words = [f"g{i}w{rng.randrange(10 ** 6)}" for _ in range(11)]
        rows += [(3 * i, " ".join(words)), (3 * i + 1, " ".join(words[:10])), (3 * i + 2, " ".join(words[1:]))]
    got = hyperminhash.near_duplicates(make_docs(rows)).drop("d", "h")
    assert sorted(repr(tuple(r)) for r in got.collect()) == brute_groups(rows)


def test_sketch_estimates():
    rng = np.random.default_rng(3)
    probes = hyperminhash.probe_order()
    for n in (40, 400, 4000):
        errors = []
        for share in (0.5, 0.85, 0.95):
            for _ in range(10):
                both = rng.integers(0, 2 ** 64, int(n * share), np.uint64)
                a, b = (np.unique(np.concatenate([both, rng.integers(0, 2 ** 64, int(n * (1 - share) / 2), np.uint64)])) for _ in "ab")
                true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
                equal = (hyperminhash.sketch(a, probes) == hyperminhash.sketch(b, probes)).sum()
                errors.append(float(hyperminhash.estimate(np.array([equal]), [len(a)], [len(b)])[0]) - true)
        assert abs(np.mean(errors)) < 0.03 and np.std(errors) < 0.1
    far = [(hyperminhash.sketch(np.unique(rng.integers(0, 2 ** 64, 3000, np.uint64)), probes) == hyperminhash.sketch(np.unique(rng.integers(0, 2 ** 64, 3000, np.uint64)), probes)).mean() for _ in range(200)]
    assert abs(np.mean(far) - hyperminhash.chance([3000], [3000])[0]) < 2e-4


def test_components(spark):
    chain = [(bytes([0, i]), bytes([0, i + 1])) for i in range(60)] + [(bytes([1, 0]), bytes([1, i])) for i in range(1, 90)] + [(bytes([2, 1]), bytes([2, 0]))]
    got = {bytes(r.v): bytes(r.label) for r in hyperminhash.components(spark.createDataFrame(chain, "a binary, b binary"), "t").collect()}
    assert len(got) == 61 + 90 + 2 and all(label == bytes([v[0], 0]) for v, label in got.items())


def test_part_hashes_depend_on_the_part_only():
    x = np.random.default_rng(0).integers(0, 2 ** 63, 300).astype(np.uint64)
    for k in (1, 2, 3, 5, 13, 40, 200):
        h = buckets.part_hashes(x, k)
        assert len(h) == len(x) - k + 1
        assert all(buckets.part_hashes(x[i:i + k].copy(), k)[0] == h[i] for i in (0, 7, len(h) - 1))
    y = np.random.default_rng(1).integers(0, 1000, 50).astype(np.uint64)
    for w in range(1, 50):
        assert buckets.sliding_min(y, w).tolist() == [int(y[i:i + w].min()) for i in range(len(y) - w + 1)]
