import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from test_dedup import brute_components, kept_lines
from lendspark.llm import interpolation, language_id, minhash, mixing, toxicity, trie_bpe
from lendspark.llm.frames import stored
from lendspark.llm.queries import QUERIES, TARGETS, quality_domains
from lendspark.llm.token_files import ByteTokenizer, pack, unpack, written_and_read
from lendspark.llm.trie_bpe import WordTokenizer

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
TEXTS = st.text(st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from("aàé'.st <|endoftx>\n\x1c\x85　")), max_size=60)


def crc(i, mod):
    return zlib.crc32(str("" if i is None else i).encode()) % mod


LIBRARY = {p: Tokenizer.from_file(p) for p in (WORD, BYTE)}
WORDS, BYTES = WordTokenizer(WORD), ByteTokenizer(BYTE)


@settings(max_examples=300, deadline=None)
@given(TEXTS)
def test_encoders_equal_the_library(text):
    for ids, path in ((next(WORDS.encode_batch([text])), WORD), (BYTES.encode(text), BYTE)):
        assert np.frombuffer(ids, "<u4").tolist() == LIBRARY[path].encode(text, add_special_tokens=False).ids


def test_bpe_rows(odd):
    tok = LIBRARY[WORD]
    want = []
    for r in odd.collect():
        ids = tok.encode(r.text or "", add_special_tokens=False).ids
        want.append((str(r.doc_id), len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(tok.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    got = [(str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in trie_bpe.encoded_digests(odd, WORD).collect()]
    assert sorted(got) == sorted(want)
    assert trie_bpe.encoded(odd.where("doc_id = 4"), WORD).first().decoded == "same</w> text</w> here</w>"


@given(st.lists(st.integers(0, 2**32 - 1), max_size=70))
def test_byte_code_round_trip(values):
    ranks = np.array(values, dtype=np.uint32)
    control, data = pack(ranks)
    assert len(control) == (len(values) + 3) // 4
    assert unpack(control, data, len(values)).tolist() == values


def test_token_files(odd, docs):
    rows = sorted(((r.doc_id is not None, r.doc_id or 0, r.text or "") for r in odd.collect()))
    got = written_and_read(odd, BYTE, 2).orderBy(F.asc_nulls_first("doc_id"), "start").collect()
    at = 0
    by_id = {}
    for known, i, text in rows:
        ids = [*LIBRARY[BYTE].encode(text, add_special_tokens=False).ids, 2]
        by_id[i if known else None] = (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    assert len(got) == len(rows) and {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in got} == by_id
    assert written_and_read(docs([]), BYTE, 2).count() == 0


def test_language_held_out(spark, sf):
    got = QUERIES["op1_language_id"](spark, "/root/testdata/sf0.01").where("held_out").join(
        spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    assert all(crc(r.doc_id, 5) == 0 and 0 <= r.score <= 1 for r in got)
    assert sum(r.lang == r.lang_pred for r in got) >= 0.97 * len(got)


def test_language_odd_rows(odd, docs):
    got = {r.doc_id: r for r in language_id.language_id(odd).collect()}
    assert [got[i].lang_pred for i in (0, 1, 2, -5)] == ["und"] * 4 and got[0].score == 0
    assert got[4].lang_pred == "en"
    assert language_id.language_id(docs([])).count() == 0
    code = language_id.codewords(9)
    assert code.shape[0] == 9 and min(int((a != b).sum()) for i, a in enumerate(code) for b in code[:i]) >= 8


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")
    got = QUERIES["op8_toxicity"](spark, sf).join(labels, "doc_id").where("held_out").collect()
    toxic = [r for r in got if r.toxic]
    assert sum(r.predicted for r in toxic) >= 0.7 * len(toxic)
    assert sum(r.predicted for r in got if not r.toxic) <= 0.01 * len(got)


def test_toxicity_odd_rows(spark, odd, docs):
    labels = spark.createDataFrame([(3, 1), (4, 0), (5, None), (None, 1), (9, 0), (9, 1), (11, 1), (13, 0)], "doc_id long, toxic int")
    got = toxicity.toxicity(odd, labels).collect()
    assert len(got) == 14 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert len({r.score for r in got if r.doc_id in (0, 1, 2)}) == 1
    assert toxicity.toxicity(docs([]), labels.where("false")).count() == 0


def test_edited_fingerprints(odd, docs):
    rows = sorted([(r.doc_id, r.text or "") for r in odd.collect() if r.doc_id not in (None, 6)], reverse=True)
    part = docs(rows)
    got = {r.doc_id: r for r in minhash.edited_fingerprints(part).collect()}
    for (i, t), (j, u) in zip(rows, rows[1:] + rows[:1]):
        half = len(t) // 2
        changed = t[: len(t) - half] + u[:half]
        own, other, after = (minhash.signatures([x.encode()]) for x in (t, changed, u))
        r = got[i]
        assert (r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint) == (
            len(t), hashlib.sha256(changed.encode()).hexdigest(), own.tobytes().hex(), other.tobytes().hex())
        assert (r.near_edited, r.near_next) == (minhash.likeness(own, other)[0], minhash.likeness(own, after)[0])
    assert minhash.edited_fingerprints(odd).count() == 14
    assert minhash.edited_fingerprints(docs([])).count() == 0
    assert minhash.edited_fingerprints(docs(["only one text here"])).first().near_next == 1.0


def test_likeness_estimates_jaccard():
    words = [f"w{i}" for i in range(2000)]
    a, b = " ".join(words[:1500]).encode(), " ".join(words[300:1800]).encode()
    x = minhash.signatures([a, b])
    assert minhash.likeness(x[:1], x[1:])[0] == pytest.approx(1196 / 1796, abs=0.2)


def test_lm_base_counts(odd, docs):
    split = re.compile(r"[^\x20\x09-\x0D]+")
    lower = lambda t: "".join(c.lower() if c.isascii() else c for c in t)
    rows = [(r.doc_id, [*split.findall(lower(r.text or "")), None]) for r in odd.collect()]
    count = Counter(w for i, t in rows if crc(i, 10) for w in t)
    n, v = sum(count.values()), len(count)
    got = sorted(interpolation.scores(odd).collect(), key=lambda r: (str(r.doc_id), r.n_tokens))
    for (i, t), r in zip(sorted(rows, key=lambda x: (str(x[0]), len(x[1]))), got, strict=True):
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(t), sum(count[w] > 0 for w in t), n)
        assert r.base_score == pytest.approx(sum(math.log10((count[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t))
        assert r.held_out == (crc(i, 10) == 0) and math.isfinite(r.score) and r.score <= 0
    assert interpolation.scores(docs([])).count() == 0


def test_lm_beats_its_base(spark):
    got = QUERIES["op3_lm_scores"](spark, "/root/testdata/sf0.01").where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert got[0] > 0.9 * got[1]  # both negative


def test_em_recovers_a_mixture():
    cells = np.array([[3, 1, 9, 70], [3, 0, 9, 20], [3, 0, 0, 10]])
    w = interpolation.learn_weights(cells, 999)[3]
    assert w.sum() == pytest.approx(1) and w[0] == pytest.approx(0.6, abs=0.1) and w[2] >= 0.09


def test_mixing_meets_targets(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = mixing.rates(docs, quality_domains(spark, sf), TARGETS, mu=1e-4, steps=60).collect()
    total = sum(r.tokens for r in rows)
    share = np.array([np.array(r.posterior) * r.tokens * r.rate for r in rows]).sum(axis=0) / total
    assert share == pytest.approx([0.1, 0.9], abs=0.01) and min(r.rate for r in rows) >= 0
    p, n, r = np.array([x.posterior for x in rows]), np.array([x.tokens for x in rows]), np.ones(len(rows))
    for _ in range(60):  # the same steps in numpy
        gap = ((p * (n * r)[:, None]).sum(axis=0) / total - [0.1, 0.9]) / ((p * n[:, None]).sum(axis=0) / total)
        r = np.maximum(0, r - (p @ gap + 1e-4 * (r - 1)) / (1 + 1e-4))
    assert np.array([x.rate for x in rows]) == pytest.approx(r, abs=1e-3)


def test_mixing_odd_rows(spark, odd, docs):
    labels = spark.createDataFrame([(3, "a"), (4, "b"), (5, None), (None, "a"), (6, "a"), (6, "b")], "doc_id long, domain string")
    got = mixing.rates(odd, labels, {"a": 0.7, "b": 0.3}).collect()
    assert len(got) == 14 and all(r.rate >= 0 and sum(r.posterior) == pytest.approx(1) for r in got)
    assert mixing.mixed(odd, labels, {"a": 0.7, "b": 0.3}).columns == odd.columns
    assert {r.rate for r in mixing.rates(odd, labels.where("false"), {}).collect()} == {1.0}
    assert mixing.rates(docs([]), labels, {"a": 1.0, "b": 0.0}).count() == 0
    with pytest.raises(ValueError, match="no label"):
        mixing.rates(odd, labels, {"c": 1.0})


def test_toxicity_without_labelled_documents(spark, docs):
    labels = spark.createDataFrame([(i, int(i < 3)) for i in range(12)], "doc_id long, toxic int")
    learned = [i for i in range(12) if crc(i, 5)]
    share = (sum(i < 3 for i in learned) + 0.5) / (len(learned) + 1)
    assert toxicity.toxicity(docs([]), labels).count() == 0
    far = toxicity.toxicity(docs([(100, "a b"), (None, None)]), labels).collect()
    one_kind = toxicity.toxicity(docs([(7, "a b"), (8, "c d")]), labels).collect()
    assert [r.score for r in far + one_kind] == pytest.approx([share] * 4)


def test_toxicity_learns_from_one_text_of_an_id(spark, docs):
    texts = [(i, f"{'vile' if i % 2 else 'kind'} word{i % 7}") for i in range(60)] + [(i, f"other text {i}") for i in range(0, 60, 3)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int")
    a, b = (toxicity.fit(docs(x), labels) for x in (texts, texts[::-1]))
    assert a.places.tolist() == b.places.tolist() and a.weights.tolist() == b.weights.tolist() and a.intercept == b.intercept


def test_pipeline_stages_on_empty_tables_and_odd_columns(spark, sf, docs):
    more = lambda df: df.withColumns({c: F.lit("clutter") for c in ("_text", "mark", "dedup", "lines", "doc", "rate", "domain")})
    line = "this very line is in three documents"
    ids = [r.doc_id for r in spark.read.parquet(f"{sf}/labels.parquet").select("doc_id").collect()]
    some = [(i, f"{line}\n{i}") for i in ids] + [(-1, None), (-2, ""), (ids[2], "another text of this document"), (None, line)]
    for texts in ([], some):
        before = more(docs(texts))
        for name, stage in corpus_pipeline.STAGES[:-1]:
            after = stored(stage(spark, before, sf), f"test-{name}")
            assert after.columns == before.columns and after.where("_text <> 'clutter'").isEmpty(), name
            before = after
        assert corpus_pipeline.STAGES[-1][1](spark, before, sf).count() == before.count()


def test_pipeline_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    before, columns = docs, docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stored(stage(spark, before, sf), f"test-{name}")
        assert after.columns == columns
        ids, was = ({r.doc_id for r in x.select("doc_id").collect()} for x in (after, before))
        assert ids <= was and len(ids) >= 0.8 * len(was), name
        if name == "line_dedup":
            assert after.count() == before.count() and after.where("n_chars <> length(text)").count() == 0
        before = after
    assert corpus_pipeline.STAGES[-1][1](spark, before, sf).count() == before.count() == corpus_pipeline.run(spark, sf).count()


def test_pipeline_stages_by_brute_force(spark, sf, docs):
    words = lambda name, n: " ".join(f"{name}{i}" for i in range(n))
    line = "this very line is in three documents"
    texts = [f"{line}\n{words('a', 60)}", f"{line}\n{words('b', 60)} one", f"{line}\n{words('b', 60)} two", words("c", 30), words("c", 30), None, ""]
    rows = list(enumerate(texts))
    lines = corpus_pipeline.drop_lines(spark, docs(rows), sf).collect()
    assert sorted((str(r.doc_id), r.text or "") for r in lines) == [(i, t) for i, t, _ in kept_lines(rows)]
    assert lines and all(r.n_chars == len(r.text) for r in lines if r.text is not None)
    kept = {r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs(rows), sf).collect()}
    assert kept == {i for i, c in brute_components(rows, 5, 80).items() if i == c} and len(kept) < len(rows)
    encoded = {r.doc_id: r.n_tokens for r in corpus_pipeline.encode(spark, docs(rows), sf).collect()}
    assert encoded == {i: len(LIBRARY[WORD].encode(t or "", add_special_tokens=False).ids) for i, t in rows}


def test_pipeline_follows_its_operators(spark, sf):
    whole = spark.read.parquet(f"{sf}/documents.parquet")
    count = lambda df: Counter(r.doc_id for r in df.select("doc_id").collect())
    toxic = {r.doc_id for r in toxicity.toxicity(whole, spark.read.parquet(f"{sf}/labels.parquet")).where("predicted = 1").collect()}
    assert count(corpus_pipeline.drop_toxic(spark, whole, sf)) == Counter({i: n for i, n in count(whole).items() if i not in toxic})
    r = mixing.rates(whole, quality_domains(spark, sf), TARGETS).select("doc_id", mixing.copies(F.col("rate")).alias("n")).collect()
    assert count(corpus_pipeline.mix_to_targets(spark, whole, sf)) == Counter({x.doc_id: x.n for x in r if x.n})
