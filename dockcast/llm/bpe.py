"""Token counts by byte-pair merging with a heap and a linked list.

A text is cut into white-space separated chunks, a chunk into words by the
vocabulary file's split rule. The symbols of a word form a doubly linked list,
its adjacent pairs a heap by merge rank and position; the lowest pair is
popped, merged and its new neighbours pushed until none is left. A word has as
many tokens as it had symbols, less the merges made; no token id is looked
up. Words repeat, so each Python worker remembers counts of chunks in a
table of at most ``cache`` entries (emptied when full).

The counts are those of the vocabulary's own library: strings of added
special tokens inside a text count as one token and split it (the library's
default), nothing is added at either end, nothing is cut or padded. Null and
empty texts have 0 bytes and 0 tokens; repeated rows repeat; a null id stays
null; other columns are ignored. The file's path is a parameter and is read
by the driver; the merge table travels with the tasks as a broadcast of fixed
size (the vocabulary's).
"""

from __future__ import annotations

import heapq
import json
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockcast.llm.common import append_arrow, ship, texts_of

# The split rule and the byte alphabet that the vocabulary file names.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, extra = [""] * 256, 0
    for b in range(256):
        if b in shown:
            out[b] = chr(b)
        else:
            out[b] = chr(256 + extra)
            extra += 1
    return out


def read_rules(path: str) -> dict:
    """What counting needs of a vocabulary file: ranks of merges, which symbols
    exist, the end-of-word mark and the special strings."""
    with open(path, encoding="utf-8") as f:
        d = json.load(f)
    m = d["model"]
    return {"ranks": {tuple(p) if isinstance(p, list) else tuple(p.split(" ")): i for i, p in enumerate(m["merges"])}, "symbols": {s for s in m["vocab"] if len(s.removesuffix(m["end_of_word_suffix"] or "")) == 1},
            "end": m["end_of_word_suffix"] or "", "special": [t["content"] for t in d["added_tokens"]]}


def count_word(symbols: list[str], ranks: dict) -> int:
    """Tokens of one word: symbols less merges."""
    n = len(symbols)
    if n < 2:
        return n
    sym, after, before = symbols, [*range(1, n), -1], [*range(-1, n - 1)]
    heap = []
    for i in range(n - 1):
        r = ranks.get((sym[i], sym[i + 1]))
        if r is not None:
            heap.append((r, i, sym[i], sym[i + 1]))
    heapq.heapify(heap)
    merges = 0
    while heap:
        _, i, a, b = heapq.heappop(heap)
        j = after[i]
        if j < 0 or sym[i] != a or sym[j] != b:
            continue  # a side was merged meanwhile
        sym[i] = a + b
        sym[j] = None
        k = after[j]
        after[i] = k
        merges += 1
        if k >= 0:
            before[k] = i
            r = ranks.get((sym[i], sym[k]))
            if r is not None:
                heapq.heappush(heap, (r, i, sym[i], sym[k]))
        h = before[i]
        if h >= 0:
            r = ranks.get((sym[h], sym[i]))
            if r is not None:
                heapq.heappush(heap, (r, h, sym[h], sym[i]))
    return n - merges


class Counter:
    """Counts tokens of texts under one vocabulary."""

    def __init__(self, rules: dict, cache: int):
        import regex
        self.ranks, self.symbols, self.end, self.cache = rules["ranks"], rules["symbols"], rules["end"], cache
        self.split = regex.compile(SPLIT)
        self.space = regex.compile(r"[\p{White_Space}]+")
        self.special = re.compile("|".join(map(re.escape, sorted(rules["special"], key=len, reverse=True)))) if rules["special"] else None
        self.marks = tuple(rules["special"])
        self.alphabet = byte_alphabet()
        self.known: dict[str, int] = {}
        self.words: dict[str, int] = {}

    def word(self, w: str) -> int:
        n = self.words.get(w)
        if n is None:
            s = [self.alphabet[b] for b in w.encode()]
            s[-1] += self.end
            n = count_word([x for x in s if x in self.symbols], self.ranks)
            if len(self.words) >= self.cache:
                self.words.clear()
            self.words[w] = n
        return n

    def chunk(self, c: str) -> int:
        import unicodedata
        low = unicodedata.normalize("NFC", c)
        # lowered character by character: no special form at a word's end
        low = low.replace("Σ", "σ").lower()
        return sum(map(self.word, self.split.findall(low)))

    def plain(self, text: str) -> int:
        odd = any(x in text for x in "\x1c\x1d\x1e\x1f")
        total, known = 0, self.known
        for c in self.space.split(text) if odd else text.split():
            n = known.get(c)
            if n is None:
                if len(known) >= self.cache:
                    known.clear()
                n = self.chunk(c)
                if len(c) <= 64:
                    known[c] = n
            total += n
        return total

    def count(self, text: str) -> int:
        if self.special is None or not any(m in text for m in self.marks):
            return self.plain(text)
        return len(self.special.findall(text)) + sum(map(self.plain, self.special.split(text)))


def worker_counter(key: str, rules, cache: int) -> Counter:
    """The worker's counter for a vocabulary, kept between its tasks."""
    import sys
    import types
    kept = sys.modules.setdefault("_token_counters", types.ModuleType("_token_counters")).__dict__
    if key not in kept:
        kept[key] = Counter(rules.value, cache)
    return kept[key]


def count_tokens(docs: DataFrame, vocab_path: str, id: str = "doc_id", text: str = "text", limit: int = 2048, cache: int = 500_000) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (n_tokens > limit) of every row."""
    ship(__name__)
    rules = docs.sparkSession.sparkContext.broadcast(read_rules(vocab_path))
    key = f"{vocab_path}:{cache}"

    def run(column):
        c = worker_counter(key, rules, cache)
        return [{"n_bytes": len(b), "n_tokens": c.count(b.decode("utf-8", "replace"))} for b in texts_of(column)]

    d = docs.select(F.col(id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    return append_arrow(d, ["text"], "n", "struct<n_bytes:long,n_tokens:long>", run, drop=("text",)) \
        .select("doc_id", "n.n_bytes", "n.n_tokens", (F.col("n.n_tokens") > limit).alias("over_limit"))
