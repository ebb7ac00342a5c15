import hashlib
import random
import re
from collections import Counter

import pytest

from lendspark.llm.queries import ORACLES, QUERIES
from lendspark.llm.substring_dedup import SubstringDedup, SuffixAutomaton
from compare import connect, difference


def brute(texts, window):
    """(words, removed, kept text) of each text."""
    split = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    n = Counter(tuple(w[i : i + window]) for w in split for i in range(len(w) - window + 1))
    out = []
    for w in split:
        gone = {i + j for i in range(len(w) - window + 1) if n[tuple(w[i : i + window])] > 1 for j in range(window)}
        out.append((len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def check(frame, texts, window, **options):
    dedup = SubstringDedup(frame, window, **options)
    got = [(r.n_words, r.n_removed, r.kept_text) for r in dedup.kept().collect()]
    assert sorted(got) == sorted(brute(texts, window))
    digests = sorted(r.kept_sha256 for r in dedup.digests().collect())
    assert digests == sorted(hashlib.sha256(t.encode()).hexdigest() for _, _, t in got)


def test_equal_to_sql(spark, sf):
    assert difference(connect(sf), QUERIES["op11_substring_dedup"](spark, sf), ORACLES["op11_substring_dedup"]) is None


@pytest.mark.parametrize(("window", "options"), [(7, {}), (7, {"most": 1, "shard_words": 200}), (3, {"most": 2}), (1, {}), (35, {"most": 1})])
def test_random_texts_of_few_words(docs, window, options):
    random.seed(window)
    phrase = [random.choice("abcdefgh") for _ in range(50)]
    texts = []
    for i in range(40):
        t = [random.choice(["a", "b", "A", f"x{random.randrange(40)}"]) for _ in range(random.randrange(60))]
        at = random.randrange(30)
        t[at:at] = phrase[: random.choice([0, 0, 5, 12, 50])]
        texts.append(random.choice(["  ", "\t", " "]).join(t))
    texts += ["z " * 400, texts[0], texts[1]]
    check(docs(texts), texts, window, **options)


@pytest.mark.parametrize("options", [{}, {"most": 1}])
def test_odd_rows(odd, options):
    check(odd, [r.text for r in odd.collect()], 2, **options)
    assert SubstringDedup(odd, 2).kept().count() == odd.count()


def test_overlap_within_one_document_and_a_hot_passage(docs):
    line = " ".join(f"w{i}" for i in range(40))
    texts = [f"a{i} {line} b{i}" for i in range(60)] + [f"{line} {line} q", "solo " * 3, line.upper()]
    check(docs(texts), texts, 35, most=4)


def test_empty_table(docs):
    assert SubstringDedup(docs([])).digests().count() == 0


def test_automaton_counts_occurrences():
    words = list("abcbcbcab")
    automaton = SuffixAutomaton()
    automaton.add(words, 1)
    automaton.add(list("bcx"), 2)
    automaton.counted()
    for size in (1, 2, 3, 5):
        n = Counter(tuple(w[i : i + size]) for w, c in ((words, 1), (list("bcx"), 2)) for _ in range(c) for i in range(len(w) - size + 1))
        assert list(automaton.repeated(words, size)) == [i for i in range(len(words) - size + 1) if n[tuple(words[i : i + size])] > 1]
    assert list(automaton.repeated(list("zbcqbc"), 2)) == [1, 4]
