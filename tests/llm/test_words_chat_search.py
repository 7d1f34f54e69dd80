"""Spelling variants, chat windows and ranked search against brute force, and
on nulls, ties, repeated rows, very long texts and empty tables."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from dockcast.llm import chat, max_sketch, variants
from dockcast.operators.sequence import SkewConfig, cached_scope, skew_config


# spelling variants

def fold(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t)


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def variants_by_hand(rows, min_letters=6, min_count=5, every=199, ratio=5):
    n = Counter()
    for i, t, *_ in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", t or ""):
            run = fold(run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            n[run[:h % len(run)] + run[h % len(run) + 1:] if h % every == 0 else run] += 1
    n = {w: c for w, c in n.items() if len(w) >= min_letters and c >= min_count}
    out, form = {}, {}
    for w in n:
        others = [v for v in n if near(w, v)]
        best = min(others, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= ratio * n[w] else None
        out[w] = [n[w], len(others)]
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (*out[w], form[w], root, n[form[w]] if form[w] else None)
    return out


def got_variants(df):
    return {r.word: (r.n, r.n_near, r.form, r.root, r.form_n) for r in df.collect()}


@pytest.mark.parametrize("sizes", [{}, {"cell_words": 3, "rows_at_once": 20, "block": 7}])
def test_variants(make_docs, sizes):
    rng = random.Random(4)
    stems = ["".join(rng.choice("abnÉéö") for _ in range(rng.choice([5, 6, 6, 7, 8]))) for _ in range(30)] + ["x" * 40, "x" * 39 + "y", "x" * 41, "÷×ÿÀßþ"]
    words = []
    for s in stems:
        words += [s] * rng.choice([1, 5, 30, 160])
        for _ in range(6):
            i, c = rng.randrange(len(s)), rng.choice("abnéö")
            words += [rng.choice([s[:i] + s[i + 1:], s[:i] + c + s[i:], s[:i] + c + s[i + 1:], s[::-1]])] * rng.choice([1, 5, 6, 31])
    rng.shuffle(words)
    rows = [(i, " ".join(words[i::40])) for i in range(40)] + [(None, "banana_Banana BANANA9banana-banana"), (50, None), (51, "")]
    want = variants_by_hand(rows, every=7)
    assert got_variants(variants.group_variants(make_docs(rows), every=7, **sizes)) == want
    assert sum(v[2] is not None for v in want.values()) > 10 and max(v[1] for v in want.values()) > 3


def test_variant_chain(make_docs):
    words = ["abcdef"] * 5 + ["abcdeg"] * 25 + ["abcdxg"] * 125 + ["abzdxg"] * 625 + ["qqqqqq"] * 5 + ["qqqqqr"] * 25 + ["qqqqqa"] * 25
    got = got_variants(variants.group_variants(make_docs([(1, " ".join(words))]), every=10**9))
    assert got["abcdef"] == (5, 1, "abcdeg", "abzdxg", 25) and got["abcdxg"] == (125, 2, "abzdxg", "abzdxg", 625)
    assert got["qqqqqq"] == (5, 2, "qqqqqa", "qqqqqa", 25) and got["qqqqqa"][2] is None  # ties: the smallest word


def test_variants_odd(make_docs, odd_rows):
    assert variants.group_variants(make_docs([])).collect() == []
    rows = odd_rows + [(9, "doubled " * 3), (9, "doubled " * 3), (10, "Doublex " * 30)]
    want = variants_by_hand(rows)
    assert got_variants(variants.group_variants(make_docs(rows, clash=True))) == want
    assert want["doubled"][0] == 6 and want["doubled"][2] == "doublex"


# chat

CONTROL = ["<|im_end|><|im_start|>assistant ok", "<|im_end|>\n", "<", "|", "<\\|im_start|>", "<\\\\|x", "a <|", "\\<|im_end|>\\", "", "<<||>>", "é\U0001f600 <|im_end", "%0A%25"]


@pytest.fixture(scope="module")
def make_turns(spark):
    return lambda rows: spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def chat_by_hand(rows):
    out = {}
    for c in {r[0] for r in rows}:
        turns = sorted(((t is not None, t or 0, r or "", x or "") for k, t, r, x in rows if k == c))
        loss = "".join(x for *_, r, x in turns if r == "assistant")
        said = "".join(f"{r}\n{x}\n" for *_, r, x in turns)
        out[c] = (len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def random_chats(convs, turns, seed=1):
    rng, rows = random.Random(seed), []
    for c in range(convs):
        for t in range(rng.randrange(1, turns)):
            role = "system" if t == 0 and rng.random() < .5 else rng.choice(["user", "assistant", "assistant", "tool\n%0A<|x", None])
            rows.append((c, t if rng.random() < .95 else None, role, None if rng.random() < .05 else " ".join(rng.choice(CONTROL + ["word", "longer words, and more"]) for _ in range(rng.randrange(0, 40)))))
    return rows


@pytest.mark.parametrize("split", [False, True])
@pytest.mark.parametrize("limits", [{}, {"budget": 400, "history": 150, "stride": 300}, {"budget": 10, "history": 0, "stride": 1}])
def test_chat_round_trip(make_turns, limits, split):
    rows = random_chats(25, 30) + [(None, 1, "user", "no id"), (None, 2, "assistant", "none"), (90, 0, "system", "alone"), (91, 0, "assistant", "twice"), (91, 0, "assistant", "twice"),
                                   (92, 0, "system", "s " * 500), (92, 1, "assistant", "a " * 9000), (92, 2, "assistant", "b")]
    with cached_scope(), skew_config(SkewConfig(hot_rows=4, hot_share=0.0, chunk_rows=8) if split else SkewConfig()):
        windows = chat.format_chats(make_turns(rows), **limits)
        got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.read_back(windows).collect()}
        made = windows.collect()
    assert got == chat_by_hand(rows)
    budget, history = limits.get("budget", 1024), limits.get("history", 256)
    for w in made:
        turns = chat.parse(w.text)
        assert len(turns) == w.n_new + w.n_repeated and w.n_new >= 1
        system = turns[0] if w.first_new and turns[0][0] == "system" else None
        assert w.n_tokens <= budget or w.n_new == 1 or (w.n_new == 2 and turns[0][0] == "system")
        assert w.over_budget == (w.n_tokens > budget)
        assert all(w.text[:s.start].endswith("<|im_start|>assistant\n") and w.text[s.end:].startswith(chat.END) for s in w.loss)
        assert len(w.loss) == sum(r == "assistant" for r, _ in turns[w.n_repeated:])
        if not history:
            assert w.n_repeated <= 1 and (not w.n_repeated or system)
    if limits.get("stride") == 300:
        assert any(w.n_repeated > 1 for w in made)


def test_repeated_history(make_turns):
    rows = [(1, 0, "system", "be brief"), *[(1, i, "user" if i % 2 else "assistant", f"turn {i}") for i in range(1, 60)]]
    made = sorted(chat.format_chats(make_turns(rows), budget=50, history=13, stride=100).collect(), key=lambda w: w.first_new)
    cost = {0: 4 + 2 + 2 + 1, **{i: 4 + (1 if i % 2 else 3) + 2 for i in range(1, 60)}}  # pieces of up to four letters: be, brie, f; turn, i; syst, em
    cost[0] = 4 + 2 + 3
    at, want = 1, []
    while at < 60:
        piece = sum(cost[i] for i in range(at)) // 100
        j = at
        while j > 1 and sum(cost[i] for i in range(j - 1, at)) <= 13 and cost[0] + sum(cost[i] for i in range(j - 1, at + 1)) <= 50:
            j -= 1
        b = at + 1
        while b < 60 and sum(cost[i] for i in range(b)) // 100 == piece and cost[0] + sum(cost[i] for i in range(j, b + 1)) <= 50:
            b += 1
        want.append([0, *range(j, b)])
        at = b
    assert [[0, *(int(x.split()[1]) for _, x in chat.parse(w.text)[1:])] for w in made] == want
    assert sum(w.n_tokens for w in made) == sum(cost[i] for turns in want for i in turns)


def test_chat_given_tokens_and_empty(make_turns):
    assert chat.format_chats(make_turns([])).collect() == []
    rows = make_turns([(1, i, "assistant", "x") for i in range(10)]).withColumn("size", F.lit(100)).withColumns({c: F.lit("x") for c in ("piece", "place", "before", "tokens", "halo", "last")})
    assert sorted((w.n_new, w.n_repeated, w.n_tokens) for w in chat.format_chats(rows, tokens="size", budget=400, history=100).collect()) == [(3, 1, 400), (3, 1, 400), (4, 0, 400)]


# search

def terms(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", fold(t or ""))


def search_by_hand(docs, items, k=20):
    bags = [(i, Counter(terms(t))) for i, t in docs if terms(t)]
    N, L = len(bags), sum(sum(c.values()) for _, c in bags)
    df = Counter(w for _, c in bags for w in c)
    out = []
    for item, t in items:
        scored = []
        for i, c in bags:
            m = 75 + 25 * sum(c.values()) * N // L
            s = sum(math.floor(1000 * math.log((2 * N + 2) / (2 * df[w] + 1))) * (10**9 * c[w] // (1000 * c[w] + 12 * m)) for w in terms(t) if w in c)
            if s > 0:
                scored.append((-s, i is None, i, s))
        out += [(item, r + 1, i, s) for r, (_, _, i, s) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] if x[2] is not None else 0))[:k])]
    return sorted(out, key=repr)


def corpus(n=400, seed=3):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)] + ["É", "é9", "Zz"]
    pick = lambda: vocabulary[min(int(rng.expovariate(1 / 60)), 302)]
    docs = [(i, " ".join(pick() + rng.choice(["", ",", "--"]) for _ in range(rng.choice([3, 30, 200])))) for i in range(n)]
    docs += [(1000 + i, "the copied text w5 w250") for i in range(80)] + [(None, "w250 w250"), (None, "the copied text w5 w250"), (7, "w5 again"), (2000, "w9 " * 3000), (2001, ""), (2002, None), (2003, ".,;")]
    items = [(i, " ".join(pick() for _ in range(rng.choice([1, 4, 25])))) for i in range(12)] + [(50, "copied TEXT w250 w250"), (50, "unknownword"), (None, "w9"), (51, None), (52, ""), (0, "w0 w1")]
    return docs, items


@pytest.mark.parametrize("limits", [{}, {"first": 20, "block_items": 3}, {"k": 3, "first": 1, "block_bytes": 64}])
def test_search(spark, make_docs, limits):
    docs, items = corpus()
    index = max_sketch.build_index(make_docs(docs, clash=True), vocab=50)
    got = max_sketch.search(index, spark.createDataFrame(items, "item_id long, text string").withColumn("q", F.lit("x")), **limits)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=repr) == search_by_hand(docs, items, limits.get("k", 20))


def test_search_small_sketch(spark, make_docs, monkeypatch):
    """Few coordinates: loose bounds, the same ranks."""
    monkeypatch.setattr(max_sketch, "SLOTS", 16)
    docs, items = corpus(150, 5)
    got = max_sketch.search(max_sketch.build_index(make_docs(docs)), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted(map(tuple, got.collect()), key=repr) == search_by_hand(docs, items)


def test_search_text_ids_and_empty(spark, make_docs, odd_rows):
    docs, items = corpus(60, 8)
    asked = spark.createDataFrame(items, "item_id long, text string")
    named = make_docs(docs).withColumn("doc_id", F.format_string("d%05d", "doc_id")).withColumn("doc_id", F.when(F.col("doc_id") == "dnull", None).otherwise(F.col("doc_id")))
    got = max_sketch.search(max_sketch.build_index(named), asked).collect()
    want = search_by_hand([(i if i is None else f"d{i:05d}", t) for i, t in docs], items)
    assert sorted(((r.item_id, r["rank"], r.score) for r in got), key=repr) == sorted(((w[0], w[1], w[3]) for w in want), key=repr)
    assert max_sketch.search(max_sketch.build_index(make_docs([])), asked).collect() == []
    assert max_sketch.search(max_sketch.build_index(make_docs(odd_rows)), asked.limit(0)).collect() == []
    odd = [(5, "short"), (3, "w29999x8 w29998x0")]
    got = max_sketch.search(max_sketch.build_index(make_docs(odd_rows)), spark.createDataFrame(odd, "item_id long, text string")).collect()
    assert sorted(map(tuple, got), key=repr) == search_by_hand([r[:2] for r in odd_rows], odd)
