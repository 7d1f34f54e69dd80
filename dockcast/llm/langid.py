"""Language identification by cross-parsing.

For each language a suffix automaton is built over a bounded sample of
labelled text. A text is parsed against it greedily: each phrase is the
longest string from where the last one ended that occurs in the sample. The
language whose parse needs the fewest phrases, normalised to bits per
character (phrases * log2 of the sample's length / length of the text), wins;
ties go to the name that sorts first.

Learning is bounded by documented parameters: at most ``sample_docs`` rows
(those with the lowest hash of their id) and ``sample_chars`` characters of a
language. Rows are chosen whatever their length; of a text of more than a
quarter of ``sample_chars`` a slice of that length counts, from a place its
hash names, runs of other than letters made one blank. Rows are chosen with a
hash limit made from per-language counts, so no language is sorted whole; the
row of a language's lowest hash is always in, and texts without a letter are
not counted, so each language with one labelled text with a letter is learnt.
The automata have less than 3 * ``sample_chars`` edges a
language, kept in one array of about that many places whatever the alphabet;
they go to the executors as a broadcast. Scoring is one narrow pass over whole
texts. Texts are cut into pieces of ``piece``
characters, each parsed from the start, and all pieces of a batch walk all
automata in step.

Characters: lower case; runs of what is no letter are one blank. Rules. Null
texts and texts without a letter are ``und`` with score 0, and so is all if
there is nothing to learn from. score is the winner's share of the inverse
costs (0 to 1). Null languages are not learnt, null ids hash as the empty
text. Repeated rows each get their result. Empty tables give an empty result.
Other columns are ignored.
"""

from __future__ import annotations


import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dockcast.llm.common import append_arrow, crc_mod5, ship, staged

BLANK, OTHER = 1, 0


def letter_codes() -> np.ndarray:
    """For each code point 1 if it is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), np.uint8, 0x110000)


def cleaned(text: str, letters: np.ndarray) -> np.ndarray:
    """Code points of ``text`` in lower case, runs of other than letters as one blank (0)."""
    cp = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    cp = cp * letters[cp]
    keep = cp > 0
    keep[1:] |= cp[:-1] > 0
    return cp[keep]


def suffix_automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions of each state of the automaton of all substrings; 0 is the root."""
    go, link, length, last = [{}], [-1], [0], 0
    for c in symbols:
        cur = len(go)
        go.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and c not in go[p]:
            go[p][c] = cur
            p = link[p]
        if p >= 0:
            q = go[p][c]
            if length[q] == length[p] + 1:
                link[cur] = q
            else:
                twin = len(go)
                go.append(dict(go[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                while p >= 0 and go[p].get(c) == q:
                    go[p][c] = twin
                    p = link[p]
                link[q] = link[cur] = twin
        last = cur
    return go


def displaced(rows: list[dict[int, int]], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges of all states in one array: the edge of state s for code c, if any,
    is at base[s] + c and holds s << 32 | target (0: none). Rows of several edges
    are laid into the first gap that fits, largest first; single edges fill the
    places left."""
    degree = np.fromiter(map(len, rows), np.int64, len(rows))
    base = np.zeros(len(rows), np.int64)
    order = np.argsort(-degree, kind="stable")
    many, single = order[:int((degree > 1).sum())], np.flatnonzero(degree == 1)
    free = np.ones(2 * width + 2 * int(degree.sum()) + 4096, bool)
    free[:width] = False  # so that no base is negative
    low = width
    for s in many.tolist():
        c = np.array(sorted(rows[s]), np.int64)
        at = low
        while True:
            if at + 1024 + width > len(free):
                free = np.append(free, np.ones(len(free), bool))
            p = at + np.flatnonzero(free[at:at + 1024])
            if at == low and len(p) < 50:  # nearly full: left to single edges
                low += 1024
            for k in (c[1:] - c[0]).tolist():
                p = p[free[p + k]]
                if not len(p):
                    break
            if len(p):
                break
            at += 1024
        base[s] = p[0] - c[0]
        free[base[s] + c] = False
    base[single] = np.flatnonzero(free)[:len(single)] - np.fromiter((next(iter(rows[s])) for s in single.tolist()), np.int64, len(single))
    state = np.repeat(np.arange(len(rows)), degree)
    code = np.fromiter((c for r in rows for c in r), np.int64, len(state))
    edge = np.zeros(int(base.max(initial=0)) + width + 1, np.int64)
    edge[base[state] + code] = state << 32 | np.fromiter((t for r in rows for t in r.values()), np.int64, len(state))
    return base.astype(np.int32), edge


class Model:
    """Automata of all languages, their states numbered on; state 0 is none."""

    def __init__(self, texts: dict[str, list[str]], sample_chars: int):
        self.letters = letter_codes()
        self.langs, parts, sizes = sorted(texts), [], []
        for lang in self.langs:
            got: list[np.ndarray] = []
            n = 0
            for t in texts[lang]:
                cp = cleaned(t, self.letters)
                if 0 < len(cp) <= sample_chars - n:
                    got += [cp, np.zeros(1, np.uint32)]
                    n += len(cp) + 1
            parts.append(np.concatenate(got) if got else np.zeros(1, np.uint32))
            sizes.append(max(2, n))
        self.size = np.array(sizes, np.float64)
        known = np.unique(np.concatenate(parts)) if parts else np.zeros(0, np.uint32)
        known = known[known > 0]
        self.code = np.zeros(0x110000, np.int32)  # code 0: a letter of no sample
        self.code[known] = np.arange(2, len(known) + 2)
        self.code[0] = BLANK
        rows: list[dict[int, int]] = [{}]
        root = []
        for part in parts:
            at = len(rows)
            root.append(at)
            rows += [{c: to + at for c, to in edges.items()} for edges in suffix_automaton(self.code[part].tolist())]
        self.base, self.edge = displaced(rows, len(known) + 2)
        self.root = np.array(root, np.int32)

    def step(self, state: np.ndarray, code: np.ndarray) -> np.ndarray:
        """Next states; 0 where there is no edge."""
        e = self.edge[self.base[state] + code]
        return np.where(e >> 32 == state, e, 0).astype(np.int32)  # the low half is the target

    def phrases(self, docs: list[np.ndarray], piece: int) -> np.ndarray:
        """Phrases of each text (codes) against each language."""
        out = np.zeros((len(self.langs), len(docs)), np.int64)
        cuts = [(d, i) for d, x in enumerate(docs) for i in range(0, len(x), piece)]
        if not cuts or not self.langs:
            return out
        cuts.sort(key=lambda c: -min(piece, len(docs[c[0]]) - c[1]))
        size = np.array([min(piece, len(docs[d]) - i) for d, i in cuts])
        codes = np.zeros((int(size[0]), len(cuts)), np.int32)
        for k, (d, i) in enumerate(cuts):
            codes[:size[k], k] = docs[d][i:i + piece]
        root = np.repeat(self.root[:, None], len(cuts), 1)
        state, count = root.copy(), np.zeros(root.shape, np.int64)
        live = np.searchsorted(-size, -np.arange(int(size[0])), "left")
        for i in range(int(size[0])):
            n = live[i]
            c, s = codes[i, :n], state[:, :n]
            to = self.step(s, c)
            lang, k = np.nonzero(to == 0)
            if len(lang):
                base = self.root[lang]
                count[lang, k] += s[lang, k] != base  # the phrase ends before this character
                again = self.step(base, c[k])
                count[lang, k] += again == 0  # a character of no sample is a phrase
                to[lang, k] = np.where(again == 0, base, again)
            state[:, :n] = to
        count += state != root
        owner = np.array([d for d, _ in cuts])
        for j in range(len(self.langs)):
            out[j] = np.bincount(owner, count[j], len(docs))
        return out

    def predict(self, texts: list[str | None], piece: int) -> list[dict]:
        cps = [cleaned(t, self.letters) if t else np.zeros(0, np.uint32) for t in texts]
        none = [not (x > 0).any() for x in cps]
        n = self.phrases([np.zeros(0, np.int32) if e else self.code[x] for x, e in zip(cps, none)], piece)
        out = []
        for d, (x, e) in enumerate(zip(cps, none)):
            if e or not self.langs:
                out.append({"lang": "und", "score": 0.0, "bits": None})
                continue
            bits = n[:, d] * np.log2(self.size) / len(x)
            best = int(np.argmin(bits))
            inverse = 1 / bits
            out.append({"lang": self.langs[best], "score": float(inverse[best] / inverse.sum()), "bits": float(bits[best])})
        return out


def learn(labelled: DataFrame, sample_docs: int, sample_chars: int) -> Model:
    """From (doc_id, text, lang) without nulls in lang and text."""
    # Python's letters, and what this JVM's tables do not know yet
    d = labelled.filter(F.col("text").rlike(r"[\p{L}\p{Cn}]")).withColumn("h", F.xxhash64("doc_id", "lang"))
    # written first: its size is known when the join is planned, so a small one is
    # broadcast and no text is dealt out by language
    counts = staged(d.groupBy(F.col("lang").alias("of")).agg(F.count("*").alias("count"), F.min("h").alias("least")), "language-counts")
    # about four times the rows asked for, by hash; all of a small language
    share = F.least(F.lit(1.0), F.lit(4.0 * sample_docs) / F.col("count"))
    d = d.join(counts, F.col("lang") == F.col("of")).filter((F.col("h") == F.col("least")) | (F.col("h").cast("double") / F.lit(2.0 ** 64) + F.lit(0.5) <= share))
    most = max(1, sample_chars // 4)
    short = F.regexp_replace("text", r"[^\p{L}\p{Cn}]+", " ")
    at = F.pmod(F.xxhash64("h"), F.greatest(F.lit(1), F.length(short) - most + 1)).cast("int") + 1
    sample = F.when(F.length("text") <= most, F.col("text")).otherwise(F.substring(short, at, F.lit(most)))
    w = Window.partitionBy("lang").orderBy("h", "doc_id", "text")
    rows = d.select("lang", "h", "doc_id", sample.alias("text")).withColumn("i", F.row_number().over(w)).filter(F.col("i") <= sample_docs).sort("lang", "i").collect()
    texts: dict[str, list[str]] = {}
    for r in rows:
        if r["text"] not in texts.setdefault(r["lang"], []):
            texts[r["lang"]].append(r["text"])
    return Model(texts, sample_chars)


def identify(docs: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang", sample_docs: int = 60,
             sample_chars: int = 20_000, piece: int = 1024) -> DataFrame:
    """doc_id, held_out (crc32 of the id mod 5 is 0: not learnt from),
    lang_pred, score and bits (per character, of the winner) of every row."""
    ship(__name__)
    d = docs.select(F.col(id).alias("doc_id"), F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang"))
    d = d.withColumn("held_out", crc_mod5(F.col("doc_id")) == 0)
    sent = d.sparkSession.sparkContext.broadcast(vars(learn(d.filter(~F.col("held_out") & F.col("lang").isNotNull() & F.col("text").isNotNull()), sample_docs, sample_chars)))

    def run(column):
        model = Model.__new__(Model)  # a broadcast carries plain values only: workers need not know the class
        vars(model).update(sent.value)
        return model.predict(column.to_pylist(), piece)

    return append_arrow(d.drop("lang"), ["text"], "p", "struct<lang:string,score:double,bits:double>", run, drop=("text",)) \
        .select("doc_id", "held_out", F.col("p.lang").alias("lang_pred"), "p.score", "p.bits")
