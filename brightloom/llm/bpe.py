"""Byte-level BPE by one walk over a trie of the distinct words.

A word is what the tokenizer's pre-tokenizer leaves whole; merges never cross words. The
merges give every prefix of a word one encoding, and that encoding is told by its last token
alone: before it stands the encoding of a shorter prefix of the same word. So each node of
the trie needs one token as its state:

- the tokens that end at a node are found by walking back up the path in a table of reversed
  tokens; the longest one whose neighbour, the state of the node it starts at, stays apart
  from it is the node's state (only one does);
- two neighbours stay apart if no merge across their border would come before the merges that
  made them; this is read off the merges that made their facing sides.

A trie is its words in sorted order: each adds one edge below the part that it shares with the
word before. Following the edges in that order is the depth-first walk, its stack holds the
states of the open path, and a shared prefix is worked out once. A word is read back from its
last node up.

Words are taken from stretches of text that begin with a single blank between two other
characters: no word of the tokenizer crosses such a place, so equal stretches have equal ids
and each worker meets a distinct one once (as long as it remembers it).

Null and empty texts have no ids; whole texts are encoded, rows that repeat are encoded as
often as they occur, a null doc_id is kept, an empty table gives no rows, other columns are
not read. Strings of the tokenizer's special tokens become their ids, as in the library.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brightloom.llm.words import parts, release, text_column

# Fixed value: the words of byte-level pre-tokenizers.
WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: Stretches remembered by one Python worker, in two generations, and pairs of neighbours.
STRETCHES = 300_000
PAIRS = 500_000
#: Stretches with more bytes of text are not remembered.
STRETCH_BYTES = 100
#: Bytes of text that are worked on together; a longer text is taken alone.
TEXT_BYTES = 4 << 20

_LOADED: dict[str, Bpe] = {}


def byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable Latin-1
    characters for themselves, the other bytes in order from U+0100 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def pieces_of(spec: dict) -> dict[int, bytes]:
    """The bytes of every id of a tokenizer file, special tokens included."""
    letters = byte_letters()
    plain = {i: bytes(letters[c] for c in s) for s, i in spec["model"]["vocab"].items()}
    return plain | {token["id"]: token["content"].encode() for token in spec["added_tokens"]}


def text_of(ids: bytes, pieces: dict[int, bytes]) -> str:
    """The text of little-endian 32-bit ids; bytes that are no UTF-8 become U+FFFD."""
    return b"".join(map(pieces.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


def trie(words: list[bytes]) -> Iterator[tuple[bytes, int]]:
    """Distinct words in depth-first order, each with the depth at which its edge begins."""
    before = b""
    for word in sorted(words):
        depth, most = 0, min(len(before), len(word))
        while depth < most and before[depth] == word[depth]:
            depth += 1
        yield word, depth
        before = word


class Bpe:
    """Tables of one tokenizer file; ``of`` keeps one per worker and path."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, before = spec["model"], spec["pre_tokenizer"]
        if before["type"] != "ByteLevel" or before["add_prefix_space"] or not before["use_regex"] or spec["normalizer"] or model["byte_fallback"] or model["ignore_merges"]:
            raise ValueError(f"{path}: not a plain byte-level BPE")
        vocab = model["vocab"]
        self.pieces = pieces_of(spec)
        self.rank: dict[int, int] = dict.fromkeys(vocab.values(), -1)
        self.halves: dict[int, tuple[int, int]] = {}
        self.merged: dict[int, int] = {}  # rank of the merge of two neighbours
        for rank, merge in enumerate(model["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            made, a, b = vocab[left + right], vocab[left], vocab[right]
            if made in self.halves or max(self.rank[a], self.rank[b]) >= rank:
                raise ValueError(f"{path}: a token is made twice or used before it is made")
            self.rank[made], self.halves[made], self.merged[a << 32 | b] = rank, (a, b), rank
        self.special: dict[str, int] = {}
        for token in spec["added_tokens"]:
            if token["single_word"] or token["lstrip"] or token["rstrip"]:
                raise ValueError(f"{path}: added tokens that take blanks or whole words only")
            self.special[token["content"]] = token["id"]
        self.cut = regex.compile("|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True))) if self.special else None
        self.follow: dict[int, int] = {}  # from a node of the reversed tokens by a byte to the next
        self.token_at = [-1]
        reached: dict[int, bool] = {}
        for token, rank in sorted(self.rank.items(), key=lambda x: x[1]):
            if rank >= 0:
                a, b = self.halves[token]
                reached[token] = reached[a] and reached[b] and self._apart(a, b, rank)
            else:
                reached[token] = len(self.pieces[token]) == 1
            if reached[token]:
                state = 0
                for byte in reversed(self.pieces[token]):
                    state = self.follow.setdefault(state << 8 | byte, len(self.token_at))
                    if state == len(self.token_at):
                        self.token_at.append(-1)
                self.token_at[state] = token
        self.pairs: dict[int, bool] = {}
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    @classmethod
    def of(cls, path: str) -> Bpe:
        if path not in _LOADED:
            _LOADED[path] = cls(path)
        return _LOADED[path]

    def _apart(self, a: int, b: int, limit: int) -> bool:
        """Whether no merge across the border of a and b comes before ``limit``, when
        something else takes one of them up. Going back in time, the later of the two merges
        is undone; of equal ones the right one, as merges of one rank go from left to right."""
        rank, halves, merged = self.rank, self.halves, self.merged
        left = right = limit  # when a and b are taken up
        while True:
            cross = merged.get(a << 32 | b)
            if cross is not None and cross < left and cross <= right and cross < limit:
                return False
            if rank[a] > rank[b]:
                left, a = rank[a], halves[a][1]
            elif rank[b] >= 0:
                right, b = rank[b], halves[b][0]
            else:
                return True

    def apart(self, a: int, b: int) -> bool:
        key = a << 32 | b
        if (known := self.pairs.get(key)) is None:
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            known = self.pairs[key] = self._apart(a, b, 1 << 60)
        return known

    def encode_words(self, words: list[bytes]) -> Iterator[tuple[bytes, bytes]]:
        """Distinct words, not empty, with their ids as 32-bit numbers."""
        follow, token_at, pairs, apart, pieces = self.follow.get, self.token_at, self.pairs.get, self.apart, self.pieces
        states = [-1]
        for word, depth in trie(words):
            del states[depth + 1 :]
            for end in range(depth + 1, len(word) + 1):
                node, at, found = 0, end, []
                while at:
                    at -= 1
                    node = follow(node << 8 | word[at])
                    if node is None:
                        break
                    if token_at[node] >= 0:
                        found.append((token_at[node], at))
                for token, at in reversed(found):
                    if not at:
                        break
                    known = pairs(states[at] << 32 | token)
                    if known or known is None and apart(states[at], token):
                        break
                states.append(token)
            ids, at = [], len(word)
            while at:
                ids.append(states[at])
                at -= len(pieces[states[at]])
            yield word, np.array(ids[::-1], "<u4").tobytes()

    def _stretches(self, distinct: list[str]) -> list[bytes]:
        """Ids of stretches, each remembered if it is not too long."""
        out: list[bytes | None] = [self.young.get(x) for x in distinct]
        missing = []
        for i, x in enumerate(out):
            if x is None:
                if (x := self.old.get(distinct[i])) is not None:
                    out[i] = self.young[distinct[i]] = x
                else:
                    missing.append(i)
        split = {i: WORD.findall(distinct[i]) for i in missing}
        known = {w: self.young.get(w) for ws in split.values() for w in ws}
        new = {w.encode(): w for w, x in known.items() if x is None}
        for word, ids in self.encode_words(list(new)):
            known[new[word]] = ids
            if len(word) <= STRETCH_BYTES:
                self.young[new[word]] = ids
        for i, ws in split.items():
            out[i] = b"".join([known[w] for w in ws])
            if len(distinct[i]) <= STRETCH_BYTES // 4:
                self.young[distinct[i]] = out[i]
        if len(self.young) > STRETCHES // 2:
            self.old, self.young = self.young, {}
        return out

    def encode(self, texts: pa.Array) -> list[bytes]:
        """Ids of each text, little-endian 32-bit."""
        if self.special and pc.any(pc.match_substring_regex(texts, "|".join(regex.escape(s, special_only=True) for s in self.special))).as_py():
            return self._with_special(texts.to_pylist())
        return self._plain(texts)

    def _with_special(self, texts: list[str]) -> list[bytes]:
        parts, owner, marks = [], [], [[] for _ in texts]
        for i, text in enumerate(texts):
            at = 0
            for hit in self.cut.finditer(text):
                parts.append(text[at : hit.start()])
                owner.append(i)
                marks[i].append(np.array([self.special[hit[0]]], "<u4").tobytes())
                at = hit.end()
            parts.append(text[at:])
            owner.append(i)
            marks[i].append(b"")
        out = [b""] * len(texts)
        nth = [iter(m) for m in marks]
        for i, ids in zip(owner, self._plain(pa.array(parts, pa.large_string()))):
            out[i] += ids + next(nth[i])
        return out

    def _plain(self, texts: pa.Array) -> list[bytes]:
        split = pc.split_pattern(texts, " ")
        coded = split.flatten().dictionary_encode()
        names = coded.dictionary.to_pylist()
        codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        upto = split.offsets.to_numpy()
        sound = np.fromiter((bool(x) and not x[0].isspace() and not x[-1].isspace() for x in names), bool, len(names))[codes]
        first = np.zeros(len(codes) + 1, bool)
        first[upto] = True
        first = first[:-1]
        opens = first.copy()
        opens[1:] |= sound[1:] & sound[:-1]
        begin = np.flatnonzero(opens)
        size = np.diff(begin, append=len(codes))
        # a stretch of one piece is told by its code and by whether a blank stands before it
        keys = np.where(size == 1, codes[begin] * 2 + ~first[begin], 0)
        kinds, which = np.unique(keys[size == 1], return_inverse=True)
        distinct = [" " + names[k >> 1] if k & 1 else names[k >> 1] for k in kinds.tolist()]
        number = np.empty(len(begin), np.int64)
        number[size == 1] = which
        joined: dict[str, int] = {}
        for i in np.flatnonzero(size > 1).tolist():
            a = begin[i]
            text = ("" if first[a] else " ") + " ".join([names[c] for c in codes[a : a + size[i]]])
            number[i] = joined.setdefault(text, len(distinct) + len(joined))
        parts = self._stretches([*distinct, *joined])
        chosen = np.array(parts, object)[number].tolist()
        bounds = np.searchsorted(begin, upto).tolist()
        return [b"".join(chosen[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]


def encode(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids) of every document; ids are little-endian 32-bit numbers in one binary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = Bpe.of(path)
        for batch in batches:
            for part in parts(batch, "text", TEXT_BYTES):
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(bpe.encode(text_column(part.column("text"))), pa.binary())], names=["doc_id", "ids"])
        release()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, ids binary")


def decode(coded: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids, text) of rows (doc_id, ids); null ids are no ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with open(path, encoding="utf-8") as file:
            pieces = pieces_of(json.load(file))
        for batch in batches:
            for part in parts(batch, "ids", TEXT_BYTES):
                texts = [text_of(x or b"", pieces) for x in part.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("ids"), pa.array(texts, pa.string())], names=["doc_id", "ids", "text"])
        release()

    return coded.select(F.col("doc_id").cast("long"), "ids").mapInArrow(run, "doc_id long, ids binary, text string")
