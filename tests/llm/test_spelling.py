import random
import re
import zlib
from collections import Counter

import pytest

from lendspark.llm import spelling
from lendspark.llm.queries import QUERIES


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def neighbours(words):
    """Every pair at distance one, by the words left when one code point goes: exact, and not by halves."""
    cut = {}
    for w in words:
        for i in range(len(w)):
            cut.setdefault((i, w[:i] + w[i + 1 :]), []).append(w)
    pairs = {tuple(sorted((a, b))) for g in cut.values() for a in g for b in g if a != b}
    pairs |= {tuple(sorted((w, w[:i] + w[i + 1 :]))) for w in words for i in range(len(w)) if w[:i] + w[i + 1 :] in words}
    return pairs


def brute(rows):
    n = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= 6 and c >= 5}
    near = {w: [] for w in n}
    for a, b in neighbours(set(n)):
        near[a].append(b)
        near[b].append(a)
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return sorted((w, n[w], len(near[w]), form[w] or "", n.get(form[w], -1), root(w)) for w in n)


def got(frame):
    return sorted((r.word, r.n, r.n_near, r.form or "", -1 if r.form_n is None else r.form_n, r.root) for r in frame.collect())


def test_query_equal_to_brute_force(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = brute(rows)
    assert got(QUERIES["op13_spelling_variants"](spark, sf)) == want and len(want) > 100


@pytest.mark.parametrize(("most", "task_words"), [(10_000, 40_000), (2, 50)])
def test_near_words_of_a_dense_vocabulary(spark, most, task_words):
    random.seed(most)
    words = {"".join(random.choices("abß", k=random.choice([6, 6, 7, 8, 11]))) for _ in range(250)} | {"a" * n for n in range(1, 30)} | {"x" * 70_000, "x" * 70_001}
    frame = spark.createDataFrame([(w,) for w in words], "word string")
    pairs = [tuple(sorted((r.a, r.b))) for r in spelling.near_words(frame, most, task_words).collect()]
    short = {w for w in words if len(w) < 100}
    want = {p for p in neighbours(short) if min(map(len, p)) > 1} | {("x" * 70_000, "x" * 70_001)}
    assert len(pairs) == len(set(pairs)) and set(pairs) == want
    assert all(one_edit(a, b) for a, b in pairs if len(a) < 100)


def test_chain_of_forms(docs):
    text = " ".join(["abcdefgh"] * 5 + ["abcdefgx"] * 30 + ["abcdefyx"] * 150 + ["ABCDEFYZ", "abcdezyz"] * 900)
    rows = got(spelling.variants(spelling.vocabulary(docs([text, None, "", text[:0]]), one_in=None)))
    assert [(r[0], r[5]) for r in rows if r[0] == "abcdefgh"] == [("abcdefgh", "abcdefyz")]
    assert {r[0]: r[3] for r in rows} == {"abcdefgh": "abcdefgx", "abcdefgx": "abcdefyx", "abcdefyx": "abcdefyz", "abcdefyz": "", "abcdezyz": ""}


def test_odd_rows(odd, docs):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert got(spelling.variants(spelling.vocabulary(odd))) == brute(rows)
    assert got(spelling.variants(spelling.vocabulary(docs([])))) == []


def test_acceptor_is_minimal_and_complete():
    words = sorted({"tap", "taps", "top", "tops", "stop", "stops", "t"})
    acceptor = spelling.Acceptor(iter(words))
    reached, stack = set(), [(0, "")]
    accepted = []
    while stack:
        state, word = stack.pop()
        reached.add(state)
        accepted += [word] if acceptor.final[state] else []
        stack += [(q, word + c) for c, q in acceptor.edges[state].items()]
    assert sorted(accepted) == words
    assert len({(acceptor.final[s], tuple(acceptor.edges[s].items())) for s in reached}) == len(reached) == 7
