import hashlib
import random
from collections import Counter, defaultdict

import pytest

from lendspark.llm import exact_dedup, line_dedup
from lendspark.llm.components import components
from lendspark.llm.jaccard_join import JaccardJoin, jaccard_components
from lendspark.llm.minhash import near_duplicates
from lendspark.llm.queries import ORACLES, QUERIES
from compare import connect, difference


@pytest.mark.parametrize("name", ["op9_line_dedup", "op10_exact_dedup"])
def test_equal_to_sql(spark, sf, name):
    assert difference(connect(sf), QUERIES[name](spark, sf), ORACLES[name]) is None


@pytest.mark.parametrize("k", [1, 4096])
def test_exact_groups_on_odd_rows(odd, k):
    rows = [(r.doc_id, r.text or "") for r in odd.collect()]
    best, n = {}, Counter(t for _, t in rows)
    for i, t in rows:
        best[t] = max((x for x in (best.get(t), i) if x is not None), default=None)
    got = exact_dedup.exact_groups(odd, k).collect()
    want = sorted((str(i), str(best[t]), n[t], i == best[t], hashlib.sha256(t.encode()).hexdigest()) for i, t in rows)
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.kept, r.text_sha256) for r in got) == want


def test_misra_gries_keeps_what_is_frequent():
    random.seed(1)
    stream = [b"hot"] * 400 + [str(random.random()).encode() for _ in range(600)]
    random.shuffle(stream)
    kept = {}
    for i in range(0, 1000, 50):
        kept = exact_dedup.misra_gries(kept, dict(Counter(stream[i : i + 50])), 4)
        assert len(kept) <= 4
    assert 400 - 1000 // 4 <= kept[b"hot"] <= 400


def kept_lines(rows, min_chars=20, min_docs=3):
    key = lambda line: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))
    holders = defaultdict(set)
    for i, t in rows:
        if i is not None:
            for line in (t or "").split("\n"):
                holders[key(line)].add(i)
    drop = lambda i, k: i is not None and len(k) >= min_chars and len(holders[k]) >= min_docs and i < max(holders[k])
    return sorted((str(i), "\n".join(x for x in (t or "").split("\n") if not drop(i, key(x))), (t or "").count("\n") + 1) for i, t in rows)


@pytest.mark.parametrize("hot_share", [2, 4096])
def test_line_dedup_on_odd_rows(odd, hot_share):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    out = line_dedup.apply_bitmaps(odd, line_dedup.keep_bitmaps(odd, hot_share=hot_share)).select("row.doc_id", "dedup.*").collect()
    assert sorted((str(r.doc_id), r.kept_text, r.n_lines) for r in out) == kept_lines(rows)
    assert sum(r.n_dropped for r in out) == 3


@pytest.mark.parametrize("hot_share", [2, 4096])
def test_line_dedup_of_two_texts_of_one_id(docs, hot_share):
    line, unique = "this very line is in three documents", "a unique line that nobody else has"
    rows = [(1, f"{line}\nfoo"), (1, f"{unique}\nbar"), (2, line), (3, line), (3, f"{line}\n{line}"), (1, f"bar\n{line}\n{unique}"), (2, line)]
    out = line_dedup.apply_bitmaps(docs(rows), line_dedup.keep_bitmaps(docs(rows), hot_share=hot_share)).select("row.doc_id", "dedup.*").collect()
    assert sorted((str(r.doc_id), r.kept_text, r.n_lines) for r in out) == kept_lines(rows)
    assert f"{unique}\nbar" in {r.kept_text for r in out}


def shingles(text, k):
    words = [w for w in "".join(c.lower() if c.isascii() else c for c in (text or "")).replace("\n", " ").replace("\t", " ").split(" ") if w]
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def brute_components(rows, k, percent):
    sets = [(i, shingles(t, k)) for i, t in rows if i is not None]
    comp = {i: i for i, _ in sets}
    root = lambda x: x if comp[x] == x else root(comp[x])
    for i, a in sets:
        for j, b in sets:
            if i < j and a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = root(i), root(j)
                comp[max(x, y)] = min(x, y)
    return {i: root(i) for i in comp}


@pytest.mark.parametrize(("k", "percent"), [(3, 90), (2, 50)])
def test_jaccard_components_are_exact(docs, k, percent):
    random.seed(k)
    words = [f"w{i}" for i in range(60)]
    base = [[random.choice(words) for _ in range(random.choice([1, 2, 3, 40, 80]))] for _ in range(25)]
    texts = []
    for i in range(160):
        t = list(random.choice(base))
        for _ in range(random.choice([0, 0, 1, 2, 4])):
            t[random.randrange(len(t))] = random.choice(words)
        texts.append((1000 - i, " ".join(t)))
    got = {r.doc_id: r.component_id for r in jaccard_components(docs(texts), k, percent).collect()}
    assert got == brute_components(texts, k, percent)


def test_all_links_inside_one_component(docs):
    random.seed(8)
    base = [f"w{i}" for i in range(60)]
    texts = []
    for i in range(30):
        t = list(base)
        for _ in range(i % 4):
            t[random.randrange(60)] = f"x{random.randrange(999)}"
        texts.append(" ".join(t))
    join = JaccardJoin(docs(texts), 3, 80)
    rep = {r.doc_id: r.id for r in join.membership().collect()}
    links = {(r.a, r.b) for r in join.all_links().collect()}
    got = {(i, j) for i in rep for j in rep if i < j and (rep[i] == rep[j] or tuple(sorted((rep[i], rep[j]))) in links)}
    sets = [shingles(t, 3) for t in texts]
    want = {(i, j) for i in range(30) for j in range(i + 1, 30) if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])}
    assert got == want and 100 < len(want) < 435
    assert len(links) > join.links().count()


def test_jaccard_on_odd_rows(odd):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    got = jaccard_components(odd, 3, 90).collect()
    assert len(got) == len(rows)
    assert {r.doc_id: r.component_id for r in got if r.doc_id is not None} == brute_components(rows, 3, 90)
    assert [r.component_id for r in got if r.doc_id is None] == [None]
    assert {r.n_shingles for r in got if r.doc_id in (0, 1, 2)} == {0}


def test_near_duplicates_by_bands(spark, docs):
    random.seed(4)
    base = [" ".join(random.choice("abcdefgh") + str(random.randrange(900)) for _ in range(200)) for _ in range(12)]
    texts = base + [t + " tail" for t in base[:6]] + base[:3]
    got = {r.doc_id: (r.component_id, r.n_links) for r in near_duplicates(docs(texts)).collect()}
    assert {i: c for i, (c, _) in got.items()} == brute_components(list(enumerate(texts)), 5, 80)
    assert got[0][1] == 2 and got[11] == (11, 0)


def test_near_duplicates_behind_a_template(docs):
    words = lambda name, n: " ".join(f"{name}{i}" for i in range(n))
    template = words("t", 200)
    texts = [f"{template} {words(f'a{j}x', 34)}" for j in range(20)]  # 0.74 to each other, 0.78 to the last three
    texts += [f"{template} {words(name, 20)}" for name in ("b", "c", "d")]
    texts += [texts[20], None, ""]
    got = {r.doc_id: (r.component_id, r.n_links) for r in near_duplicates(docs(texts)).collect()}
    want = brute_components(list(enumerate(texts)), 5, 80)
    assert {i: c for i, (c, _) in got.items()} == want
    assert {i for i, c in want.items() if c == 20} == {20, 21, 22, 23}
    assert [got[i][1] for i in (0, 20, 21, 22, 23, 24, 25)] == [0, 3, 3, 3, 3, 0, 0]


def test_near_duplicates_of_repeated_ids(odd):
    got = near_duplicates(odd, k=3).collect()
    assert len(got) == odd.count()
    by_id = {r.doc_id: (r.component_id, r.n_links) for r in got}
    assert by_id[4] == by_id[5] == (4, 1) and by_id[6] == (6, 0) and by_id[None] == (None, 0)


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 102), (102, 101), (7, 7)], "a long, b long")
    got = {r.id: r.component for r in components(links).collect()}
    assert got == {i: 0 for i in range(1, 41)} | {101: 100, 102: 100}


def test_empty_tables(docs):
    none = docs([])
    assert exact_dedup.exact_groups(none).count() == 0
    assert line_dedup.apply_bitmaps(none, line_dedup.keep_bitmaps(none)).count() == 0
    assert jaccard_components(none).count() == 0
    assert near_duplicates(none).count() == 0


