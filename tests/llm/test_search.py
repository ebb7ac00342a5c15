import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from lendspark.llm import ranked_search
from lendspark.llm.queries import ORACLES, QUERIES
from compare import connect, difference

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(rows, items, k):
    bags = [(i, Counter(terms(t))) for i, t in rows]
    n_docs, total = sum(1 for _, b in bags if b), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(terms(t))
    out = []
    for item, wanted in asked.items():
        scores = []
        for i, b in bags:
            m = 10 + (90 * sum(b.values()) * n_docs) // total if total else 0
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * b[t] // (1000 * b[t] + 8 * m)) for t in wanted if b[t])
            if s > 0:
                scores.append((-s, i is not None, i))
        out += [(item, rank, i, -s) for rank, (s, _, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def got(index, items, **more):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in ranked_search.ranked(index, items, **more).collect()), key=str)


def test_equal_to_sql(spark, sf):
    assert difference(connect(sf), QUERIES["op12_ranked_search"](spark, sf), ORACLES["op12_ranked_search"]) is None


@pytest.fixture
def items(spark):
    return lambda rows: spark.createDataFrame([(i, t, "clutter", 1) for i, t in rows], "item_id long, text string, term string, rank int")


@pytest.mark.parametrize("shard_terms", [10**9, 60])
def test_equal_to_brute_force(docs, items, shard_terms):
    random.seed(shard_terms)
    words = [f"t{i}" for i in range(60)] + ["É", "z9", "ß"]
    rate = [1 / (i + 1) for i in range(len(words))]
    rows = [(500 - i, " ".join(random.choices(words, rate, k=random.choice([1, 3, 30, 120])))) for i in range(300)]
    rows += [(1000 + i, rows[i][1]) for i in range(20)]  # ties
    asked = [(i, ", ".join(random.sample(words, random.choice([1, 2, 8, 30])))) for i in range(30)] + [(0, "T1 t2"), (99, "unknown")]
    index = ranked_search.build_index(docs(rows), shard_terms)
    assert got(index, items(asked)) == brute(rows, asked, 10)
    assert got(index, items(asked), k=3, at_once=5) == brute(rows, asked, 3)


@pytest.mark.parametrize(("block", "span"), [(2, 3), (4, 16), (128, 64)])
def test_shard_rejects_blocks_before_decompression(monkeypatch, block, span):
    random.seed(block)
    monkeypatch.setattr(ranked_search, "BLOCK", block)
    monkeypatch.setattr(ranked_search, "RANGE", span)
    texts = [" ".join(random.choices(["the", "of", "and", "rare", f"x{i}"], [40, 30, 20, 0.2, 5], k=random.randrange(1, 60))) for i in range(600)]
    texts[77] = "rare rare the x7"
    hashes, bounds = ranked_search.term_hashes([t.encode() for t in texts])
    rows = list(ranked_search.shard_rows("0-0", pa.array(range(600)), np.diff(bounds), hashes))
    scoring = ranked_search.Scoring(600, len(hashes))
    bags = [Counter(t.split()) for t in texts]
    df = Counter(t for b in bags for t in b)
    shard = ranked_search.Shard(pa.Table.from_batches(rows), scoring)
    wanted = ["rare", "the", "of", "x7"]
    weights = {int(h.view(np.int64)): ranked_search.weight(600, df[t]) for t, h in zip(wanted, ranked_search.term_hashes([" ".join(wanted).encode()])[0], strict=True)}
    best = shard.best(weights, 10)
    want = [(s, i) for _, _, i, s in sorted(brute(list(enumerate(texts)), [(0, " ".join(wanted))], 10), key=lambda r: r[1])]
    assert best == want
    blocks = sum(-(-df[t] // block) for t in wanted)
    assert shard.decompressed < blocks if block < 128 else shard.decompressed <= blocks


def test_odd_rows(odd, items):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    asked = [(1, "This very line"), (2, None), (3, ""), (None, "same id"), (None, "text"), (4, "ÀÉ 日本 ½"), (5, "word " * 900), (6, "x" * 70_000), (7, "a repeated row")]
    index = ranked_search.build_index(odd)
    assert got(index, items(asked)) == brute(rows, asked, 10)


def test_empty_tables(docs, items):
    none = ranked_search.build_index(docs([]))
    assert got(none, items([(1, "a")])) == []
    assert got(ranked_search.build_index(docs(["a", None])), items([])) == []
    assert got(ranked_search.build_index(docs([None, "!!"])), items([(1, "a")])) == []


def test_varints():
    values = np.array([0, 1, 127, 128, 16383, 16384, 2**40], dtype=np.int64)
    raw, size = ranked_search.to_varints(values)
    assert size.tolist() == [1, 1, 1, 2, 2, 3, 6]
    assert ranked_search.from_varints(raw.tobytes()).tolist() == values.tolist()


def test_a_shard_is_written_in_bounded_pieces(monkeypatch):
    """Rows do not depend on the size of a piece, and no batch holds the postings of a whole shard."""
    rng = np.random.default_rng(5)
    counts = rng.integers(0, 60, 400)
    terms = np.where(rng.random(counts.sum()) < 0.3, 1, rng.integers(2, 900, counts.sum())).astype(np.uint64)
    ids = pa.array(np.arange(400))
    whole = pa.Table.from_batches(ranked_search.shard_rows("s", ids, counts, terms))
    monkeypatch.setattr(ranked_search, "PIECE", 256)
    pieces = list(ranked_search.shard_rows("s", ids, counts, terms))
    assert pa.Table.from_batches(pieces).to_pylist() == whole.to_pylist()
    assert max(sum(b.column("n").to_pylist()) for b in pieces[1:]) <= 256 + ranked_search.BLOCK
    lists = {t: sorted(set(np.repeat(np.arange(400), counts)[terms == t].tolist())) for t in set(terms.tolist())}
    assert sum(whole.column("n").to_pylist()[1:]) == sum(map(len, lists.values()))
    rows = [r for r in whole.to_pylist() if r["term"] == 1]
    assert [r["block"] for r in rows] == list(range(-(-len(lists[1]) // ranked_search.BLOCK)))
    for r, at in zip(rows, range(0, len(lists[1]), ranked_search.BLOCK), strict=True):
        got = ranked_search.from_varints(r["postings"])
        assert (r["last"] - got[0::2]).tolist() == lists[1][at : at + ranked_search.BLOCK]
