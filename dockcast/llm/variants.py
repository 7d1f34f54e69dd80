"""Spelling variants: words one inserted, deleted or replaced letter apart,
found by a frequency-vector trie.

**Words.** Letter runs of whole texts, A-Z lower-cased, are counted natively
(``count_words``); a stated rule deletes one letter of some occurrences.

**Trie.** A word is the vector of its counts of successive letter groups; the
trie's levels are the length, four wide groups (:data:`HEAD`), then the
groups of :data:`LEVELS`. Two words one edit apart differ by a surplus of at
most one and a deficit of at most one: a longer word has one surplus letter,
a word of the same length either no difference or one surplus and one
deficit. So a search walks the trie with a budget of one each. Of a pair only
one word searches: for longer words, and for words of its length whose first
difference is a surplus (or, with equal vectors, that sort after it).

**Spread over tasks.** The upper levels (length and wide groups) are the
shuffle key. A word is sent as a search to each cell that its budget reaches
(at most 16), with what is left of the budget. A cell with more than
``cell_words`` words is cut into parts of that size by hash, and its searches go
to every part. A task walks the rest of the trie depth first, in blocks of partial
searches, so its memory is bounded by a part's words and a block's searches.

**Leaves.** A leaf holds words with equal vectors. One edit leaves a word's
first or second half as it is, so a search looks up its halves among the
hashed halves of the leaf's words and verifies those letter by letter.

Results: one row per word. Null and empty texts have no words; a null id
counts as the empty text in the rule of deletions; repeated rows are further
occurrences; very long texts and runs are read whole; an empty table gives an
empty result. Ties of a form go to the smallest word in code-point order.
Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockcast.llm.common import expand, ship, staged

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LETTERS = r"[A-Za-zÀ-ÿ]"
HEAD = ["aiqy", "bjrz", "cks", "dlt"]
SINGLE = [c for c in LOWER if c not in "".join(HEAD)]
OTHER = 6                               # groups of the letters from U+00C0 on, by code point
LEVELS = len(SINGLE) + OTHER

APART = np.uint64(0xC2B2AE3D27D4EB4F)    # spreads leaves over the hashes
# What is left of a search's budget, as states of the walk.
BOTH, DEFICIT, SURPLUS, NONE = range(4)


def count_words(docs: DataFrame, id: str = "doc_id", text: str = "text", min_letters: int = 6, min_count: int = 5, every: int = 199) -> DataFrame:
    """word, n: the results of letter runs and their occurrences in all texts.
    If ``every`` divides the crc32 h of "<id>:<run>", the run's letter
    h % length is deleted. No Python."""
    run, h, at = F.col("run"), F.col("h"), (F.col("h") % F.length("run")).cast("int")
    runs = docs.select(F.concat(F.coalesce(F.col(id).cast("string"), F.lit("")), F.lit(":")).alias("mark"),
                       F.explode(F.regexp_extract_all(F.col(text).cast("string"), F.lit(f"({LETTERS}{{{min_letters},}})"), F.lit(1))).alias("run"))
    runs = runs.select("mark", F.translate("run", UPPER, LOWER).alias("run")).withColumn("h", F.crc32(F.concat("mark", "run").cast("binary")))
    word = F.when(h % every == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))).otherwise(run)
    return runs.select(word.alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n")) \
        .filter((F.length("word") >= min_letters) & (F.col("n") >= min_count))


# ------------------------------------------------------------------ cells

CELL = ["len", *[f"g{i}" for i in range(len(HEAD))]]


def _reach() -> list[tuple[int, dict[int, int], int]]:
    """(longer by, differences of the wide groups, budget left) of every cell
    that a search reaches."""
    k = range(len(HEAD))
    same = [(0, {}, BOTH), *[(0, {i: 1}, DEFICIT) for i in k], *[(0, {i: 1, j: -1}, NONE) for i in k for j in k if i < j]]
    return same + [(1, {}, SURPLUS), *[(1, {i: 1}, NONE) for i in k]]


def _route(words: DataFrame, cell_words: int) -> DataFrame:
    """Trie rows (kind 0) and searches (kind 1), by cell and part of a cell."""
    w = words.select("word", "n", F.length("word").alias("len"), *[(F.length("word") - F.length(F.translate("word", g, ""))).alias(f"g{i}") for i, g in enumerate(HEAD)])
    wide = w.groupBy(*CELL).agg(F.count(F.lit(1)).alias("c")).filter(F.col("c") > cell_words)
    parts = F.broadcast(wide.select(*CELL, F.ceil(F.col("c") / cell_words).cast("int").alias("parts")))  # at most words / cell_words rows
    at = F.struct(*[F.col(c) for c in CELL], F.lit(0).alias("kind"), F.lit(0).alias("left"))

    def moved(longer: int, diff: dict[int, int], left: int) -> Column:
        return F.struct((F.col("len") + longer).alias("len"), *[(F.col(f"g{i}") + diff.get(i, 0)).alias(f"g{i}") for i in range(len(HEAD))], F.lit(1).alias("kind"), F.lit(left).alias("left"))

    to = F.explode(F.array(at, *[moved(*r) for r in _reach()])).alias("to")
    rows = w.select("word", "n", to).select("word", "n", "to.*")
    for i in range(len(HEAD)):
        rows = rows.filter(F.col(f"g{i}") >= 0)
    rows = rows.join(parts, CELL, "left")
    part = F.when(F.col("parts").isNull(), F.array(F.lit(0))).when(F.col("kind") == 0, F.array(F.pmod(F.xxhash64("word"), F.col("parts")).cast("int"))) \
            .otherwise(F.sequence(F.lit(0), F.col("parts") - 1))
    return rows.select(*CELL, F.explode(part).alias("part"), "kind", "left", "word", "n")


# ------------------------------------------------------------------ search in a task

def level_of() -> np.ndarray:
    """The level of each code point below 256; LEVELS for those of the wide groups."""
    out = np.full(256, LEVELS, np.int64)
    for i, c in enumerate(SINGLE):
        out[ord(c)] = i
    for c in range(0xC0, 0x100):
        out[c] = len(SINGLE) + c % OTHER
    return out


class Words:
    """Words as one array of code points, with the hashes of their parts."""

    def __init__(self, words: list[str]):
        self.words = words
        self.len = np.array([len(w) for w in words], np.int64)
        self.at = np.r_[0, np.cumsum(self.len)]
        self.code = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        place = expand(np.zeros(len(words), np.int64), self.len)
        top = int(self.len.max(initial=0)) + 1
        odd = 0x9E3779B97F4A7C15
        with np.errstate(over="ignore"):
            power = np.cumprod(np.r_[np.uint64(1), np.full(top, odd, np.uint64)])
            self.back = np.cumprod(np.r_[np.uint64(1), np.full(top, pow(odd, -1, 1 << 64), np.uint64)])
            self.sum = np.r_[np.uint64(0), np.cumsum((self.code.astype(np.uint64) + np.uint64(7)) * power[place])]

    def hash(self, rows, start, stop):
        """Of letters start to stop (exclusive) of each of ``rows``."""
        a = self.at[rows]
        with np.errstate(over="ignore"):
            return (self.sum[a + stop] - self.sum[a + start]) * self.back[start]

    def counts(self) -> np.ndarray:
        level = level_of()[self.code]
        row = np.repeat(np.arange(len(self.words)), self.len)
        use = level < LEVELS
        return np.bincount(row[use] * LEVELS + level[use], minlength=len(self.words) * LEVELS).reshape(-1, LEVELS)


class Trie:
    """The lower levels of the trie over the words of some cells: at each
    level, the sorted keys (parent node, count); a key's place is its node."""

    def __init__(self, cell: np.ndarray, counts: np.ndarray):
        self.order = np.lexsort([*counts.T[::-1], cell])
        self.wide = int(counts.max(initial=0)) + 3
        node, self.keys = cell[self.order], []
        for d in range(LEVELS):
            key = node * self.wide + counts[self.order, d] + 1
            new = np.r_[True, key[1:] != key[:-1]] if len(key) else np.zeros(0, bool)
            self.keys.append(key[new])
            node = np.cumsum(new) - 1
        self.leaf = node  # of each word, in order

    def walk(self, cell: np.ndarray, counts: np.ndarray, left: np.ndarray, block: int):
        """Depth-first, a block of partial searches at a time: yields (search,
        leaf, budget left)."""
        stack = [(0, np.arange(len(cell)), cell, left)]
        while stack:
            d, q, node, state = stack.pop()
            if len(q) > block:
                stack += [(d, q[i:i + block], node[i:i + block], state[i:i + block]) for i in range(0, len(q), block)]
                continue
            if d == LEVELS:
                yield q, node, state
                continue
            key = node * self.wide + counts[q, d] + 1
            more, fewer = (state == BOTH) | (state == SURPLUS), state == DEFICIT
            q2 = np.concatenate([q, q[more], q[fewer]])
            key = np.concatenate([key, key[more] + 1, key[fewer] - 1])
            state = np.concatenate([state, np.where(state[more] == BOTH, DEFICIT, NONE), np.full(int(fewer.sum()), NONE)])
            child = np.searchsorted(self.keys[d], key)
            there = child < len(self.keys[d])
            there[there] = self.keys[d][child[there]] == key[there]
            if there.any():
                stack.append((d + 1, q2[there], child[there], state[there]))


def one_edit(a: str, b: str) -> bool:
    """b is a with one letter replaced, or one inserted."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    p = next((i for i in range(len(a)) if a[i] != b[i]), len(a))
    return a[p:] == b[p + 1:]


def near_pairs(words: Words, tries: np.ndarray, searches: np.ndarray, cell: np.ndarray, left: np.ndarray, block: int):
    """(search, word) row pairs one edit apart. ``tries`` and ``searches`` are
    rows of ``words``, ``cell`` their cells, ``left`` the searches' budgets."""
    counts = words.counts()
    trie = Trie(cell[tries], counts[tries])
    rows = tries[trie.order]
    half = (words.len[rows] + 1) // 2
    zero = np.zeros(len(rows), np.int64)
    halves = []  # the leaf's words by hashed half
    for h in (words.hash(rows, zero, half), words.hash(rows, half, words.len[rows])):
        h = h + trie.leaf.astype(np.uint64) * APART
        by = np.argsort(h, kind="stable")
        halves.append((h[by], by))
    for q, leaf, state in trie.walk(cell[searches], counts[searches], left, block):
        found = searches[q]
        longer = (words.len[rows[np.searchsorted(trie.leaf, leaf)]] - words.len[found]) if len(q) else q
        size = words.len[found] + longer
        mid = (size + 1) // 2
        for second, (hashed, at) in enumerate(halves):
            own = (mid - longer, words.len[found]) if second else (np.zeros(len(q), np.int64), mid)
            ask = words.hash(found, *own) + leaf.astype(np.uint64) * APART
            lo, hi = np.searchsorted(hashed, ask), np.searchsorted(hashed, ask, "right")
            cuts = np.r_[0, np.flatnonzero(np.diff(np.cumsum(hi - lo) // block)) + 1, len(q)]
            for i, j in zip(cuts, cuts[1:]):
                n = hi[i:j] - lo[i:j]
                x = at[expand(lo[i:j], n)]
                a, b, s = np.repeat(found[i:j], n), rows[x], np.repeat(state[i:j], n)
                ok = _verified(words, a, b, s, second == 1) & (trie.leaf[x] == np.repeat(leaf[i:j], n))
                if ok.any():
                    yield a[ok], b[ok]


def _verified(words: Words, a, b, state, second: bool) -> np.ndarray:
    """Which candidates are one edit apart, and new: found by the second half
    only if the first doesn't match, and with equal vectors sorted after."""
    ok = np.zeros(len(a), bool)
    la, lb = words.len[a], words.len[b]
    wide = np.maximum(la, lb) > 32
    for i in np.flatnonzero(wide).tolist():
        x, y = words.words[a[i]], words.words[b[i]]
        m = (len(y) + 1) // 2
        ok[i] = one_edit(x, y) and not (second and x[:m] == y[:m]) and (state[i] != BOTH or y > x)
    use = np.flatnonzero(~wide)
    if not len(use):
        return ok
    a, b, la, lb, state = a[use], b[use], la[use], lb[use], state[use]
    step = np.arange(33)
    last = len(words.code) - 1
    x = np.where(step < la[:, None], words.code[np.minimum(words.at[a][:, None] + step, last)], 0)
    y = np.where(step < lb[:, None], words.code[np.minimum(words.at[b][:, None] + step, last)], 0)
    differ = x != y
    first = np.where(differ.any(1), differ.argmax(1), 33)
    shifted = x[:, :-1] == y[:, 1:]
    inserted = (shifted | (step[:-1] < first[:, None])).all(1)
    good = np.where(la == lb, differ.sum(1) == 1, inserted)
    if second:
        good &= first < (lb + 1) // 2
    at = np.minimum(first, 32)
    i = np.arange(len(a))
    good &= (state != BOTH) | (y[i, at] > x[i, at])
    ok[use] = good
    return ok


OUT = "word string, n long, n_near long, best_n long, best string"


def _search(rows_at_once: int, block: int):
    """Map function over rows sorted by cell, part and kind: per word its
    count of near words, and the best of them, as far as seen here."""
    import pyarrow as pa

    def solve(t: pa.Table) -> pa.RecordBatch:
        word, n = t.column("word").to_pylist(), t.column("n").to_numpy()
        kind, left = t.column("kind").to_numpy(), t.column("left").to_numpy()
        new = np.zeros(t.num_rows, bool)
        for c in [*CELL, "part"]:
            v = t.column(c).to_numpy()
            new[1:] |= v[1:] != v[:-1]
        cell = np.cumsum(new)
        searches = np.flatnonzero(kind == 1)
        total = np.zeros(t.num_rows, np.int64)
        best = np.full(t.num_rows, t.num_rows, np.int64)
        place = np.empty(t.num_rows, np.int64)  # by count, then word
        by = sorted(range(t.num_rows), key=word.__getitem__)
        by = np.array(by, np.int64)[np.argsort(-n[by], kind="stable")] if by else np.zeros(0, np.int64)
        place[by] = np.arange(t.num_rows)
        for a, b in near_pairs(Words(word), np.flatnonzero(kind == 0), searches, cell, left[searches], block):
            for x, y in ((a, b), (b, a)):
                total += np.bincount(x, minlength=len(total))
                np.minimum.at(best, x, place[y])
        # a word's own cell names it in any case; trie rows are named again by the searches that find them
        some = np.flatnonzero((total > 0) | ((kind == 1) & (left == BOTH) & (t.column("part").to_numpy() == 0)))
        to = np.where(best[some] < t.num_rows, by[np.minimum(best[some], t.num_rows - 1)], -1) if len(some) else some
        return pa.RecordBatch.from_arrays([pa.array([word[i] for i in some], pa.string()), pa.array(n[some], pa.int64()), pa.array(total[some], pa.int64()),
                                           pa.array([int(n[j]) if j >= 0 else None for j in to], pa.int64()), pa.array([word[j] if j >= 0 else None for j in to], pa.string())],
                                          names=["word", "n", "n_near", "best_n", "best"])

    def run(batches):
        held = None
        for b in batches:
            b = pa.Table.from_batches([b])
            held = b if held is None else pa.concat_tables([held, b])
            if held.num_rows < rows_at_once or not (held.column("kind").to_numpy() == 1).any():
                continue
            yield solve(held)
            # the last cell's words stay for the searches that are still to come
            same = held.column("kind").to_numpy() == 0
            for c in [*CELL, "part"]:
                v = held.column(c).to_numpy()
                same &= v == v[-1]
            held = held.filter(pa.array(same)).combine_chunks()
        if held is not None and held.num_rows:
            yield solve(held)
    return run


def near_words(words: DataFrame, cell_words: int = 100_000, rows_at_once: int = 150_000, block: int = 200_000) -> DataFrame:
    """word, n, n_near, best_n, best: how many words are near, and the one of
    largest n among them (ties: the smallest)."""
    ship(__name__)
    rows = _route(words, cell_words)
    rows = rows.repartition(*[F.col(c) for c in CELL], F.col("part")).sortWithinPartitions(*CELL, "part", "kind")
    found = rows.mapInArrow(_search(rows_at_once, block), OUT)
    best = F.min(F.when(F.col("best").isNotNull(), F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word"))))
    return found.groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), best.alias("b")) \
        .select("word", "n", "n_near", (-F.col("b.n")).alias("best_n"), F.col("b.word").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """word, root of rows (word, form): forms followed to the last, each round
    doubling the distance. A form has ``ratio`` times its word's count, so
    chains are short and the loop ends."""
    at = staged(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = at.select(F.col("word").alias("_w"), F.col("root").alias("_r"))
        at = staged(at.join(on, at["root"] == on["_w"], "left").select("word", F.coalesce("_r", "root").alias("root"), F.col("_r").isNotNull().alias("moved")), "roots")
        if at.filter("moved").isEmpty():
            return at.select("word", "root")


def group_variants(docs: DataFrame, id: str = "doc_id", text: str = "text", min_letters: int = 6, min_count: int = 5, every: int = 199, ratio: int = 5, **kw) -> DataFrame:
    """word, n, n_near, form, form_n, root of every word of ``docs``."""
    words = staged(count_words(docs, id, text, min_letters, min_count, every), "words")
    near = staged(near_words(words, **kw), "near")
    strong = F.col("best_n") >= ratio * F.col("n")
    out = near.select("word", "n", "n_near", F.when(strong, F.col("best")).alias("form"), F.when(strong, F.col("best_n")).alias("form_n"))
    to = roots(out.filter(F.col("form").isNotNull()))
    return out.join(to, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


SQL = r"""
WITH RECURSIVE tab AS (SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, b) ORDER BY b) AS t FROM range(256) AS r(b)),
occ AS (SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
runs AS (SELECT doc_id, run, count(*) AS n FROM occ WHERE length(run) >= 6 GROUP BY ALL),
hex AS (SELECT run, n, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS x FROM runs),
crc AS (SELECT run, n, xor(4294967295, list_reduce(list_transform(range(0, length(x) // 2), lambda i: ('0x' || substr(x, 2 * i + 1, 2))::BIGINT),
               lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295)) AS h FROM hex, tab),
res AS (SELECT n, CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM crc),
words AS (SELECT word, sum(n)::BIGINT AS n FROM res WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
del AS (SELECT DISTINCT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS d FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
pairs AS (SELECT a.word AS a, a.n AS an, b.word AS b, b.n AS bn FROM del a JOIN del b ON a.d = b.d AND a.i = b.i WHERE a.word <> b.word
          UNION SELECT a.word, a.n, b.word, b.n FROM del a JOIN words b ON a.d = b.word
          UNION SELECT b.word, b.n, a.word, a.n FROM del a JOIN words b ON a.d = b.word),
best AS (SELECT a AS word, count(*) AS n_near, arg_min(b, (-bn, b)) AS form, max(bn) AS form_n FROM pairs GROUP BY a),
forms AS (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 5 * n THEN form END AS form, CASE WHEN form_n >= 5 * n THEN form_n END AS form_n FROM words LEFT JOIN best USING (word)),
walk AS (SELECT word, form AS dest FROM forms WHERE form IS NOT NULL UNION ALL SELECT w.word, f.form FROM walk w JOIN forms f ON w.dest = f.word WHERE f.form IS NOT NULL),
last AS (SELECT w.word, w.dest FROM walk w JOIN forms f ON w.dest = f.word WHERE f.form IS NULL)
SELECT word, form, coalesce(dest, word) AS root, n, n_near::BIGINT AS n_near, form_n FROM forms LEFT JOIN last USING (word)
"""
