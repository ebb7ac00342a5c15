"""Spelling variant grouping by finite-state composition.

The vocabulary's minimised acceptor A is composed with the transducer T of exactly one edit and with A again: the pairs
that A . T . A accepts are the near words. A state of the composition is (state of A, edits so far, state of A); while
no edit was made both sides are in one state, and states of a minimised acceptor stand for all prefixes that lead to
them, so the edits that can follow a state are worked out once.

**Partitions of the initial states.** Two words at distance one, the shorter of s code points, are equal in their first
or in their last h = s div 2 code points. So each word goes under its first half and, reversed, under its last half, for
s = its length and s = its length - 1. A task has the acceptor of its words, each behind the mark of its partition;
the composition starts in (p, 0, p) for each state p that a mark leads to.

**Hot partitions.** One with more than ``MOST`` words is replaced: its words go under one more common code point, and,
for edits at that very place, under the word without it. The last kind has no more words than there are code points.
This repeats until all partitions are small.

Words and counts are ordinary aggregates; roots are found by pointer jumping: a form occurs at least ``ratio`` times
as often as its word, so chains have no cycle and few steps.

Defined cases. NULL, empty texts and texts without letters have no words. A NULL id counts as empty text. Rows that
repeat an id count one by one. Very long words are words. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendspark.llm.frames import stored

#: Code points of a word, and the one in so many (id, word) pairs that loses a code point. Fixed values of the query.
LETTERS = r"[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ONE_IN = 199
#: Words of a task's acceptor, on average, and the most of one partition.
TASK_WORDS = 40_000
MOST = 10_000
EDIT = "\x00"
#: Code points that the least and the greatest tail, and so all between, begin with.
COMMON = "cast(array_position(zip_with(split(lo, ''), split(hi, ''), (x, y) -> x <=> y), false) - 1 AS int)"


def vocabulary(docs: DataFrame, min_chars: int = 6, min_count: int = 5, one_in: int | None = ONE_IN) -> DataFrame:
    """(word, n) of the words of ``docs`` (doc_id, text); ``one_in`` as in the module's constant, None: words as they are."""
    ident = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    runs = docs.select(ident.alias("ident"), F.explode(F.expr(f"regexp_extract_all(text, r'{LETTERS}', 0)")).alias("run"))
    runs = runs.where(F.length("run") >= min_chars).select("ident", F.translate("run", UPPER, LOWER).alias("run"))
    word = F.col("run")
    if one_in:
        h = F.crc32(F.concat_ws(":", "ident", "run").cast("binary"))
        at = (h % F.length("run")).cast("int")
        word = F.when(h % one_in == 0, F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))).otherwise(word)
    counted = runs.select(word.alias("word")).where(F.length("word") >= min_chars).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") >= min_count)


class Acceptor:
    """Minimised acyclic acceptor of words added in ascending order."""

    def __init__(self, words: Iterator[str]):
        self.edges: list[dict[str, int]] = [{}]
        self.final: list[bool] = [False]
        self._known: dict[tuple, int] = {}
        open_: list[tuple[int, str]] = []  # the last word's states that may still grow, and the code point out of each
        state, before = 0, ""
        for word in words:
            shared = 0
            while shared < min(len(word), len(before)) and word[shared] == before[shared]:
                shared += 1
            self._close(open_, shared)
            state = open_[-1][0] if open_ else 0
            if open_:
                state = self.edges[state][open_[-1][1]]
            for c in word[shared:]:
                self.edges.append({})
                self.final.append(False)
                self.edges[state][c] = len(self.edges) - 1
                open_.append((state, c))
                state = len(self.edges) - 1
            self.final[state] = True
            before = word
        self._close(open_, 0)
        del self._known

    def _close(self, open_: list[tuple[int, str]], depth: int) -> None:
        """States deeper than ``depth`` are complete: each becomes the known one with the same final mark and edges."""
        while len(open_) > depth:
            parent, c = open_.pop()
            state = self.edges[parent][c]
            key = (self.final[state], tuple(self.edges[state].items()))
            self.edges[parent][c] = self._known.setdefault(key, state)

    def walk(self, word: str) -> int:
        state = 0
        for c in word:
            state = self.edges[state][c]
        return state

    def both(self, p: int, q: int, but: str = "") -> Iterator[str]:
        """The words that are accepted from p and from q, other than those that begin with ``but``."""
        stack = [(p, q, "", but)]
        while stack:
            p, q, word, but = stack.pop()
            if self.final[p] and self.final[q]:
                yield word
            near, far = self.edges[p], self.edges[q]
            for c in near if len(near) <= len(far) else far:
                if c != but and c in near and c in far:
                    stack.append((near[c], far[c], word + c, ""))


class Composition:
    """A . T . A over one acceptor, T being the transducer of one edit."""

    def __init__(self, acceptor: Acceptor):
        self.acceptor = acceptor
        self._edits: dict[int, list[tuple[str, str]]] = {}

    def edits(self, state: int) -> list[tuple[str, str]]:
        """The pairs accepted from (state, 0, state) whose first code points differ: the edit is here."""
        found = self._edits.get(state)
        if found is None:
            a, out = self.acceptor, sorted(self.acceptor.edges[state].items())
            found = [(c + rest, d + rest) for i, (c, p) in enumerate(out) for d, q in out[i + 1 :] for rest in a.both(p, q)]
            found += [(rest, c + rest) for c, p in out for rest in a.both(state, p, but=c)]
            self._edits[state] = found
        return found

    def pairs(self, state: int) -> Iterator[tuple[str, str]]:
        """The pairs accepted from (state, 0, state)."""
        stack = [(state, "")]
        while stack:
            state, prefix = stack.pop()
            for u, v in self.edits(state):
                yield prefix + u, prefix + v
            for c, q in self.acceptor.edges[state].items():
                stack.append((q, prefix + c))


PAIR = pa.schema([("a", pa.string()), ("b", pa.string())])


def _compose(table: pa.Table) -> pa.Table:
    """Near words (a, b) of the partitions of one task: (side, shorter, head, tail, cut) as ``_partitions`` makes them."""
    marked: dict[str, tuple] = {}
    held = []
    for side, shorter, head, tail, cut in zip(*(table.column(c).to_pylist() for c in ("side", "shorter", "head", "tail", "cut")), strict=True):
        mark = f"{side}{shorter}{EDIT}{'' if cut is None else cut}{EDIT}{head}{EDIT}"
        marked[mark] = (side, shorter, head, cut)
        held.append(mark + tail)
    acceptor = Acceptor(iter(sorted(held)))
    composition = Composition(acceptor)
    left, right = [], []
    for mark, (side, shorter, head, cut) in marked.items():
        half = shorter // 2
        for u, v in composition.pairs(acceptor.walk(mark)):
            if cut is None:
                u, v = head + u, head + v
            elif not u and v == head[cut : cut + 1]:  # the first difference is later, and the pair found there
                continue
            else:  # the tail is the code point at ``cut``, or nothing
                u, v = (head[:cut] + x + head[cut:] for x in (u, v))
            if min(len(u), len(v)) != shorter:
                continue
            if side == "S":
                u, v = u[::-1], v[::-1]
                if u[:half] == v[:half]:  # found under the first half
                    continue
            left.append(u)
            right.append(v)
    return pa.Table.from_arrays([pa.array(left, pa.string()), pa.array(right, pa.string())], schema=PAIR)


def _partitions(words: DataFrame, most: int) -> DataFrame:
    """(side, shorter, head, tail, cut) of every word in each of its partitions (side, shorter, head, cut)."""
    n = F.length("word")
    both = words.select(F.explode(F.array(F.struct(F.lit("P").alias("side"), "word"), F.struct(F.lit("S").alias("side"), F.reverse("word").alias("word")))).alias("x"), n.alias("n"))
    keyed = both.select("x.side", "x.word", F.explode(F.array(F.col("n"), F.col("n") - 1)).alias("shorter")).where("shorter > 1")
    half = F.floor(F.col("shorter") / 2).cast("int")
    level = keyed.select("side", "shorter", F.substring("word", F.lit(1), half).alias("head"), F.substring("word", half + 1, F.length("word")).alias("tail"), F.lit(None).cast("int").alias("cut"))
    level = stored(level, "partitions")
    done, group = [], ["side", "shorter", "head"]
    while True:
        sizes = level.groupBy(*group).agg(F.count(F.lit(1)).alias("count"), F.min("tail").alias("lo"), F.max("tail").alias("hi"))
        hot = stored(sizes.where(F.col("count") > most).select(*group, F.expr(COMMON).alias("skip")), "hot-partitions")
        if hot.isEmpty():
            return _union([*done, level])
        done.append(level.join(hot, group, "left_anti").select(level.columns))
        # what all tails begin with can hold no first difference
        more, after = F.substring("tail", F.lit(1), F.col("skip")), F.substring("tail", F.col("skip") + 1, F.length("tail"))
        split = level.join(hot, group).select("side", "shorter", F.concat("head", more).alias("head"), after.alias("tail"))
        split = stored(split, "hot-words")
        at, size = F.length("head"), F.length("head") + F.length("tail")
        first, rest = F.substring("tail", 1, 1), F.substring("tail", F.lit(2), F.length("tail"))
        # the edit is here: the word without its code point here; a shorter word also as it is, for one more code point
        cut = split.where("length(tail) > 0").select("side", "shorter", F.concat("head", rest).alias("head"), first.alias("tail"), at.alias("cut"))
        whole = split.where(size == F.col("shorter")).select("side", "shorter", F.concat("head", "tail").alias("head"), F.lit("").alias("tail"), at.alias("cut"))
        done += [cut, whole]
        # the edit is later
        level = split.where("length(tail) > 0").select("side", "shorter", F.concat("head", first).alias("head"), rest.alias("tail"), F.lit(None).cast("int").alias("cut"))
        level = stored(level, "partitions")


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for more in frames[1:]:
        out = out.unionByName(more)
    return out


def near_words(words: DataFrame, most: int = MOST, task_words: int = TASK_WORDS) -> DataFrame:
    """(a, b) of the words of ``words`` (word, distinct) that differ by exactly one edit, each pair once."""
    parts = _partitions(words.select("word"), most)
    tasks = max(1, -(-4 * words.count() // task_words))
    dealt = parts.withColumn("task", F.pmod(F.xxhash64("side", "shorter", "head", F.coalesce("cut", F.lit(-1))), F.lit(tasks)))
    return dealt.groupBy("task").applyInArrow(_compose, "a string, b string")


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): the end of each chain of forms, by pointer jumping."""
    links = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        far = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        jumped = links.join(far, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        jumped = stored(jumped, "roots")
        if jumped.where("moved").isEmpty():
            return jumped.select("word", "root")
        links = jumped.select("word", "root")


def variants(words: DataFrame, ratio: int = 5, most: int = MOST) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of ``words`` (word, n)."""
    words = stored(words.select("word", "n"), "vocabulary")
    pairs = stored(near_words(words, most), "near-words")
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    near = both.join(words.select(F.col("word").alias("b"), F.col("n").alias("m")), "b")
    best = near.groupBy(F.col("a").alias("word")).agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("m")).alias("less"), F.col("b"))).alias("best"))
    known = words.join(best, "word", "left")
    often = -F.col("best.less") >= ratio * F.col("n")
    known = known.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(often, F.col("best.b")).alias("form"), F.when(often, -F.col("best.less")).alias("form_n"),
    )
    known = stored(known, "forms")
    roots = _roots(known.where("form IS NOT NULL"))
    return known.join(roots, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
