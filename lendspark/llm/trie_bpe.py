"""BPE encoding and decoding over a trie of distinct words.

The distinct words of a batch that the worker has not met are put in order, which is a depth-first walk of
their trie: neighbours share the states of their common prefix. The state of a prefix is the last token of
its encoding; it is the one token ending there that may follow the state where it begins. Two tokens may
follow each other if merging their joined text gives just these two. So shared prefixes are encoded once,
and a word's tokens are read backwards along the states. The last character of a word carries the
end-of-word mark, so it is an edge of its own.

Words are cut by the tokenizer's own normaliser and pre-tokeniser (a plain pattern for Latin letters). ids
are joined for each whole text; decoding looks the ids up in the table of token texts.

Defined cases. NULL text counts as empty: no ids, decoded text empty. Special tokens in a text get their ids.
Other columns are ignored; repeated rows are encoded alike.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
from array import array
from collections.abc import Iterator
from os.path import commonprefix

import pyarrow as pa
from pyspark.sql import DataFrame

from lendspark.llm.frames import keyed
from lendspark.llm.vocabulary import LATIN, REMEMBERED, latin_class, tokenizer, visible

END = "</w>"
_FEW = re.compile(r"[\x1c-\x1f]")
_SPACE = re.compile(r"[\t-\r \x85\xa0  -     　]+")


class TrieEncoder:
    """Encodes words of visible characters by the ranked merges of a vocabulary with end-of-word marks."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]]):
        self.vocab = vocab
        self.text = {i: t for t, i in vocab.items()}
        self.rank = {tuple(m): r for r, m in enumerate(merges)}
        self.longest = max(map(len, vocab))
        self.lengths = {i: len(t) for t, i in vocab.items()}
        self.follows: dict[int, bool] = {}
        self.whole = {t: i for t, i in vocab.items() if self.is_whole(i)}  # what merging can give at all

    def merged(self, symbols: list[str]) -> list[str]:
        """The merges in order of rank, leftmost first: the definition, used on short texts."""
        symbols, rank, none = list(symbols), self.rank, 1 << 60
        ranks = [rank.get(pair, none) for pair in zip(symbols, symbols[1:])]
        while ranks:
            least = min(ranks)
            if least == none:
                break
            at = ranks.index(least)
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
            del ranks[at]
            if at < len(ranks):
                ranks[at] = rank.get((symbols[at], symbols[at + 1]), none)
            if at:
                ranks[at - 1] = rank.get((symbols[at - 1], symbols[at]), none)
        return symbols

    def symbols(self, token: int) -> list[str]:
        text = self.text[token]
        if text.endswith(END) and len(text) > len(END):
            body = text[: -len(END)]
            return [*body[:-1], body[-1] + END]
        return list(text)

    def is_whole(self, token: int) -> bool:
        """Merging the token's own text gives the token."""
        return self.merged(self.symbols(token)) == [self.text[token]]

    def may_follow(self, a: int, b: int) -> bool:
        if len(self.follows) >= REMEMBERED:
            self.follows.clear()
        known = self.follows[a << 20 | b] = self.merged(self.symbols(a) + self.symbols(b)) == [self.text[a], self.text[b]]
        return known

    def last_token(self, word: str, end: int, states: list[int], mark: str) -> int:
        """State after ``word[:end]``; ``mark`` is the end-of-word mark at the last character, else empty."""
        whole, follows = self.whole, self.follows
        for start in range(end - 1, max(-1, end - self.longest - 1), -1):
            token = whole.get(word[start:end] + mark if mark else word[start:end])
            if token is not None:
                if start == 0:
                    return token
                known = follows.get(states[start] << 20 | token)
                if known or known is None and self.may_follow(states[start], token):
                    return token
        raise ValueError(f"no token ends {word[:end]!r}")

    def encode(self, words: list[str]) -> Iterator[tuple[str, list[int]]]:
        """(word, ids) of distinct words, in depth-first order of their trie."""
        states: list[int] = [-1]
        before, lengths, mark = "", self.lengths, len(END)
        for word in sorted(words):
            body = word[:-1]  # the last character has the mark: another edge
            shared = len(commonprefix((before, body)))
            del states[shared + 1 :]
            for end in range(shared + 1, len(word)):
                states.append(self.last_token(word, end, states, ""))
            at = len(word)
            token = self.last_token(word, at, states, END)
            ids = [token]
            at -= lengths[token] - mark
            while at:
                token = states[at]
                ids.append(token)
                at -= lengths[token]
            ids.reverse()
            yield word, ids
            before = body


class WordTokenizer:
    """Whole texts to ids and back, with a bounded memory of chunks between white space."""

    def __init__(self, path: str):
        self.library = tokenizer(path)
        with open(path, encoding="utf-8") as f:
            model = json.load(f)
        vocab = model["model"]["vocab"]
        self.trie = TrieEncoder(vocab, [m if isinstance(m, list) else m.split(" ") for m in model["model"]["merges"]])
        self.special = {t["content"]: t["id"] for t in model["added_tokens"]}
        self.split_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        size = 1 + max([*vocab.values(), *self.special.values()])
        self.table = [self.library.id_to_token(i) or "" for i in range(size)]
        letters, digits = latin_class("L"), latin_class("N")
        self.pattern = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{digits}]|[^{letters}{digits}]+")
        self.pieces: dict[str, bytes] = {}
        self.chunks: dict[str, bytes] = {}

    def cut(self, chunk: str) -> list[str]:
        """Pieces of a chunk without white space, in visible characters; special tokens as they are."""
        if max(chunk) < chr(LATIN) and "İ" not in chunk and "<|" not in chunk:
            return [p if p.isascii() and p.isprintable() else visible(p) for p in self.pattern.findall(chunk.lower())]
        out = []
        for part in self.split_special.split(chunk) if self.split_special else [chunk]:
            if part in self.special:
                out.append(part)
            elif part:
                text = self.library.normalizer.normalize_str(part)
                out += [p for p, _ in self.library.pre_tokenizer.pre_tokenize_str(text)]
        return out

    def learn(self, chunks: list[str]) -> None:
        """Encode chunks that are not known yet, their distinct pieces in one walk."""
        if len(self.chunks) + len(chunks) > REMEMBERED:
            self.chunks.clear()
        if len(self.pieces) > REMEMBERED:
            self.pieces.clear()
        cut = {c: self.cut(c) for c in chunks}
        new = {p for pieces in cut.values() for p in pieces if p not in self.pieces}
        for p in new & self.special.keys():
            self.pieces[p] = array("I", [self.special[p]]).tobytes()
        for piece, ids in self.trie.encode([p for p in new if p not in self.special]):
            self.pieces[piece] = array("I", ids).tobytes()
        for c, pieces in cut.items():
            self.chunks[c] = b"".join([self.pieces[p] for p in pieces])

    def encode_batch(self, texts: list[str]) -> Iterator[bytes]:
        """ids of each text as little-endian unsigned 32-bit integers."""
        split = [_SPACE.split(t) if _FEW.search(t) else t.split() for t in texts]
        new = set().union(*split) - self.chunks.keys() - {""}
        if new:
            known = {c: self.chunks[c] for c in set().union(*split) & self.chunks.keys()} if len(self.chunks) + len(new) > REMEMBERED else {}
            self.learn(list(new))
            self.chunks.update(known)
        self.chunks[""] = b""
        for chunks in split:
            yield b"".join(map(self.chunks.__getitem__, chunks))

    def decode(self, ids: bytes) -> str:
        values = array("I")
        values.frombytes(ids)
        return " ".join(map(self.table.__getitem__, values))


@functools.cache
def word_tokenizer(path: str) -> WordTokenizer:
    return WordTokenizer(path)


def _parts(texts: list[str], most: int = 1 << 22) -> Iterator[tuple[int, list[str]]]:
    start = size = 0
    for i, t in enumerate(texts):
        if i > start and size + len(t) > most:
            yield start, texts[start:i]
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield start, texts[start:]


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids binary, decoded string) of every row of ``docs`` (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = word_tokenizer(path)
        for batch in batches:
            for start, texts in _parts([t or "" for t in batch.column("text").to_pylist()]):
                ids = list(tok.encode_batch(texts))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(start, len(texts)), pa.array(ids, pa.binary()), pa.array([tok.decode(i) for i in ids], pa.string())],
                    names=["doc_id", "ids", "decoded"],
                )

    return keyed(docs, "text").mapInArrow(run, "doc_id long, ids binary, decoded string")


def encoded_digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row; only digests leave the Python worker."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = word_tokenizer(path)
        for batch in batches:
            for start, texts in _parts([t or "" for t in batch.column("text").to_pylist()]):
                rows = [
                    (len(i) // 4, hashlib.sha256(i).hexdigest(), hashlib.sha256(tok.decode(i).encode()).hexdigest())
                    for i in tok.encode_batch(texts)
                ]
                n, a, b = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(start, len(texts)), pa.array(n, pa.int64()), pa.array(a), pa.array(b)],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    return keyed(docs, "text").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
