"""Chat formatting in windows of a token budget.

A conversation's turns, in order, become training windows. A turn's tokens
are estimated natively (:func:`pieces`; or given as a column), and prefix
sums of them choose turn-aligned spans:

* a window takes as many whole turns as the budget holds, at least one;
* the system turn (a first turn with that role) is retained in every window;
* of the turns before a window's first new one, the longest suffix of at most
  ``history`` tokens is repeated, less where the new turn needs the room;
* the loss mask covers the texts of assistant turns, each in the one window
  where it is new: repeated turns are masked.

Prefix sums are taken without a task per conversation where one is long
(``operators.sequence``), and a conversation is cut where its prefix sum
passes a multiple of ``stride``, so a group holds a bounded number of tokens
(and at most one turn beyond) however long the conversation; windows don't
cross such a cut, repeated history does.

The template marks turns ``<|im_start|>role\\ntext<|im_end|>\\n``. Inside roles and
texts every ``<`` that backslashes and a ``|`` follow gets one more backslash, so
no control string is left and :func:`parse` restores every text exactly.

Results: null texts and roles count as empty, a null turn sorts first, equal
turn numbers go by role, then text; repeated rows are turns of their own; rows
with a null conv_id are one conversation; a turn above the budget has a window
of its own, uncut; empty tables give an empty result. Other columns are
ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dockcast.llm.common import ship
from dockcast.operators.sequence import prefix_sums

START, END = "<|im_start|>", "<|im_end|>"
MARKS = 4   # tokens of a turn's marks
PIECE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]{1,4}|[\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]"


def pieces(text: Column) -> Column:
    """An estimate of a text's tokens: pieces of up to four letters or digits,
    and single punctuation marks."""
    return F.size(F.regexp_extract_all(text, F.lit(f"({PIECE})"), F.lit(1))).cast("long")


def escape(text: str) -> str:
    return re.sub(r"<(\\*)\|", r"<\\\1|", text)


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def head(role: str) -> str:
    """A turn's opening; line breaks of a role are percent-coded."""
    return f"{START}{escape(role.replace('%', '%25').replace(chr(10), '%0A'))}\n"


def parse(text: str) -> list[tuple[str, str]]:
    """(role, text) of every turn of a formatted window."""
    out, at = [], 0
    while at < len(text):
        if not text.startswith(START, at):
            raise ValueError(f"no turn starts at {at}")
        line = text.index("\n", at)
        end = text.index(END + "\n", line)
        role = unescape(text[at + len(START):line]).replace("%0A", "\n").replace("%25", "%")
        out.append((role, unescape(text[line + 1:end])))
        at = end + len(END) + 1
    return out


# ------------------------------------------------------------------ windows

def spans(before: list[int], tokens: list[int], first: int, cap: int, history: int) -> list[tuple[int, int, int]]:
    """(first repeated turn, first new turn, end) of the windows over turns
    ``first``.. of a piece of a conversation. ``before``: their prefix sums."""
    out, a, n = [], first, len(tokens)
    ends = [p + t for p, t in zip(before, tokens)]
    while a < n:
        j = bisect_left(before, max(before[a] - history, ends[a] - cap), 0, a)
        b = max(a + 1, bisect_right(ends, before[j] + cap, a))
        out.append((j, a, b))
        a = b
    return out


WINDOW = [T.StructField("first_new", T.LongType()), T.StructField("n_new", T.LongType()), T.StructField("n_repeated", T.LongType()), T.StructField("n_tokens", T.LongType()),
          T.StructField("over_budget", T.BooleanType()), T.StructField("text", T.StringType()),
          T.StructField("loss", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])))]


def _windows(budget: int, history: int, learn: str, retain: str):
    """Map function over rows sorted by conversation, piece and turn."""
    import pyarrow as pa

    def of_piece(rows):
        """Windows of one piece: its system turn, repeated turns of the piece before, own turns."""
        top = rows[0] if rows[0]["place"] == 0 and rows[0]["role"] == retain else None
        home = [r for r in rows[1 if top else 0:]]
        owned = top is not None and not top["halo"]  # the system turn is new in the first piece
        new = next((i for i, r in enumerate(home) if not r["halo"]), len(home))
        cap = budget - (top["tokens"] if top else 0)
        cuts = spans([r["before"] for r in home], [r["tokens"] for r in home], new, cap, history)
        if owned and not cuts:
            cuts = [(0, 0, 0)]
        for i, (j, a, b) in enumerate(cuts):
            first = owned and i == 0
            turns = ([(top, first)] if top else []) + [(home[k], k >= a) for k in range(j, b)]
            text, loss, size = [], [], 0
            for r, fresh in turns:
                opening, body = head(r["role"]), escape(r["text"])
                if fresh and r["role"] == learn:
                    loss.append({"start": size + len(opening), "end": size + len(opening) + len(body)})
                text += [opening, body, END, "\n"]
                size += len(opening) + len(body) + len(END) + 1
            tokens = sum(r["tokens"] for r, _ in turns)
            fresh = sum(f for _, f in turns)
            yield (rows[0]["conv_id"], min(r["place"] for r, f in turns if f), fresh, len(turns) - fresh, tokens, tokens > budget, "".join(text), loss)

    def run(batches):
        names, kinds, out, size = None, None, [], 0
        held, key = [], None

        def flush():
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

        for b in batches:
            if names is None:
                from pyspark.sql.pandas.types import to_arrow_type
                names = ["conv_id", *[f.name for f in WINDOW]]
                kinds = [b.schema.field("conv_id").type, *[to_arrow_type(f.dataType) for f in WINDOW]]
            for r in b.to_pylist():
                k = (r["conv_id"], r["piece"])
                if held and k != key:
                    for w in of_piece(held):
                        out.append(w)
                        size += len(w[6])
                    held = []
                    if size > 4 << 20:
                        yield flush()
                        out, size = [], 0
                held.append(r)
                key = k
        if held:
            out.extend(of_piece(held))
        if out:
            yield flush()
    return run


def format_chats(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", tokens: str | None = None,
                 budget: int = 1024, history: int = 256, stride: int = 1 << 16, learn: str = "assistant", retain: str = "system") -> DataFrame:
    """One row per window: conv_id, first_new (place of its first new turn),
    n_new, n_repeated (turns at its head that were new before), n_tokens,
    over_budget, text, loss (spans of code points). ``tokens`` names a column
    of a turn's tokens, marks included; without it they are estimated."""
    ship(__name__)
    if not 0 <= history < stride:
        raise ValueError("history must be less than stride")
    said = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text)]
    cost = F.coalesce(F.col(tokens).cast("long"), F.lit(0)) if tokens else pieces(said[0]) + pieces(said[1]) + MARKS
    t = turns.select(F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), said[0].alias("role"), said[1].alias("text"), cost.alias("tokens"))
    t = prefix_sums(t, "conv_id", ["turn", "role", "text", "tokens"], {"before": F.col("tokens"), "place": F.lit(1)})
    t = t.withColumns({"before": F.col("before") - F.col("tokens"), "place": F.col("place") - 1})
    piece = F.floor(F.col("before") / stride)
    home = F.struct(piece.alias("piece"), F.lit(False).alias("halo"))
    ahead = F.when(F.col("before") >= (piece + 1) * stride - history, F.struct((piece + 1).alias("piece"), F.lit(True).alias("halo")))
    keeps = (F.col("place") == 0) & (F.col("role") == retain)
    rows = t.withColumn("to", F.explode(F.when(keeps, F.array(home)).otherwise(F.array_compact(F.array(home, ahead))))).drop("turn").select("*", "to.*").drop("to")
    # the system turn goes to every later piece of its conversation
    long = t.groupBy("conv_id").agg(F.max(piece).alias("last")).filter(F.col("last") > 0).withColumnRenamed("conv_id", "long_id")
    top = t.filter(keeps).join(long, F.col("conv_id").eqNullSafe(F.col("long_id"))) \
           .select("conv_id", "role", "text", "tokens", "before", "place", F.explode(F.sequence(F.lit(1).cast("long"), "last")).alias("piece"), F.lit(True).alias("halo"))
    rows = rows.unionByName(top).repartition("conv_id", "piece").sortWithinPartitions("conv_id", "piece", "place")
    return rows.mapInArrow(_windows(budget, history, learn, retain), T.StructType([t.schema["conv_id"], *WINDOW]))


# ------------------------------------------------------------------ reading back

READ = [T.StructField(c, k) for c, k in (("n_turns", T.LongType()), ("turns_sha256", T.StringType()), ("loss_chars", T.LongType()), ("loss_sha256", T.StringType()),
                                         ("formatted_chars", T.LongType()), ("n_windows", T.LongType()))]


def _digests():
    """Map function over windows sorted by conversation and place: a running
    digest, whatever the conversation's length."""
    import pyarrow as pa

    def run(batches):
        state, out, kind = None, [], None

        def done():
            return (state[0], state[1], state[2].hexdigest(), state[3], state[4].hexdigest(), state[5], state[6])

        def batch():
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), (kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()))],
                                              names=["conv_id", *[f.name for f in READ]])

        for b in batches:
            kind = b.schema.field("conv_id").type
            for conv, skip, text, loss in zip(b.column("conv_id").to_pylist(), b.column("n_repeated").to_pylist(), b.column("text").to_pylist(), b.column("loss").to_pylist()):
                if state is None or state[0] != conv:
                    if state is not None:
                        out.append(done())
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
                # repeated turns stand at the head; a system turn that is new comes first, before any of them
                for role, said in parse(text)[skip:]:
                    state[1] += 1
                    state[2].update(f"{role}\n{said}\n".encode("utf-8", "replace"))
                for s in loss:
                    said = unescape(text[s["start"]:s["end"]])
                    state[3] += len(said)
                    state[4].update(said.encode("utf-8", "replace"))
                state[5] += len(text)
                state[6] += 1
            if len(out) > 10_000:
                yield batch()
                out = []
        if state is not None:
            out.append(done())
            yield batch()
    return run


def read_back(windows: DataFrame) -> DataFrame:
    """Per conversation, from its windows alone: n_turns and their digest, the
    text under the loss mask as length and digest, formatted_chars, n_windows."""
    ship(__name__)
    rows = windows.select("conv_id", "first_new", "n_repeated", "text", "loss").repartition("conv_id").sortWithinPartitions("conv_id", "first_new")
    return rows.mapInArrow(_digests(), T.StructType([windows.schema["conv_id"], *READ]))


SQL = r"""
WITH RECURSIVE c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok' UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
t AS (SELECT *, 4 + len(regexp_extract_all(role, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]{1,4}|[\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]')) + len(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]{1,4}|[\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]')) AS tokens,
             length('<|im_start|><|im_end|>') + 2 + length(replace(replace(role, '%', '%25'), chr(10), '%0A')) + length(text)
             + len(regexp_extract_all(role, '<\\*\|')) + len(regexp_extract_all(text, '<\\*\|')) AS chars FROM c),
p AS (SELECT *, sum(tokens) OVER w - tokens AS before FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, tokens)),
l AS (SELECT conv_id, count(*) AS n, list(before ORDER BY before, turn) AS p, list(tokens ORDER BY before, turn) AS k, list(chars ORDER BY before, turn) AS s,
             first(role ORDER BY before, turn) = 'system' AS sys,
             sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY before, turn)) AS turns_sha256,
             coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS loss_chars,
             sha256(coalesce(string_agg(text, '' ORDER BY before, turn) FILTER (role = 'assistant'), '')) AS loss_sha256 FROM p GROUP BY conv_id),
f AS (SELECT *, CASE WHEN sys THEN 2 ELSE 1 END AS a0, 1024 - CASE WHEN sys THEN k[1] ELSE 0 END AS cap FROM l),
w AS (SELECT conv_id, a0 AS a, 0 AS chars, 0 AS nth FROM f
  UNION ALL
  SELECT conv_id, b, chars + CASE WHEN sys THEN s[1] ELSE 0 END + list_sum(s[j:b - 1]), nth + 1
  FROM (SELECT *, greatest(a + 1, a + len(list_filter(range(a, n + 1), lambda i: p[i] // 65536 = p[a] // 65536 AND p[i] + k[i] - p[j] <= cap))) AS b
        FROM (SELECT *, a - len(list_filter(range(a0, a), lambda i: p[a] - p[i] <= 256 AND p[a] + k[a] - p[i] <= cap)) AS j
              FROM w JOIN f USING (conv_id) WHERE a <= n)))
SELECT conv_id, n::BIGINT AS n_turns, turns_sha256, loss_chars::BIGINT AS loss_chars, loss_sha256,
       CASE WHEN nth = 0 THEN s[1] ELSE chars END::BIGINT AS formatted_chars, greatest(nth, 1)::BIGINT AS n_windows
FROM (SELECT conv_id, max(chars) AS chars, max(nth) AS nth FROM w GROUP BY conv_id) JOIN f USING (conv_id)
"""
