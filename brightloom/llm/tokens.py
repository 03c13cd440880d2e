"""Token ids of whole texts by a public tokenizer, a batch at a time.

The ids are those of ``Tokenizer.from_file(path).encode(text, add_special_tokens=False)``.
The tokenizer meets each distinct word once per task, not every text:

- its pre-tokenizer never joins characters across white space, so the ids of a text are the
  ids of its blank-separated words, one after the other;
- it lower-cases, and it always splits between a letter and a comma or full stop, so ASCII
  capitals are lowered and such marks set apart first, which leaves fewer distinct words.
  Texts that may hold one of the tokenizer's special strings skip this second step.

This holds for a tokenizer with these two traits, as word-level BPE has them; ``exact=False``
passes whole texts to any other tokenizer.
"""

from __future__ import annotations

from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words remembered by one Python worker, in two generations: when the younger is full, it
#: becomes the older, and words that are met again move back.
WORDS = 400_000
#: Words with more bytes of ids are not remembered.
WORD_BYTES = 120
#: Stands between words that are encoded together, and how many are.
BETWEEN = "|"
JOINED = 256
#: Texts encoded together.
ROWS = 2048

_LOADED: dict[tuple[str, bool], Encoder] = {}


class Encoder:
    """Texts to ids; ``of`` keeps one per worker and path."""

    def __init__(self, path: str, by_word: bool = True):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.by_word = by_word
        alone = self.model.encode(BETWEEN, add_special_tokens=False).ids
        self.between = alone[0] if len(alone) == 1 else None
        self.last = self._last()
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    @classmethod
    def of(cls, path: str, by_word: bool = True) -> Encoder:
        if (path, by_word) not in _LOADED:
            _LOADED[path, by_word] = cls(path, by_word)
        return _LOADED[path, by_word]

    def _plain(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.model.encode_batch_fast(texts, add_special_tokens=False)]

    def _last(self) -> np.ndarray | None:
        """By id, whether it ends a piece of text; nothing where the tokenizer marks no ends, or
        lacks a mark for one of the bytes."""
        from tokenizers.pre_tokenizers import ByteLevel

        mark = getattr(self.model.model, "end_of_word_suffix", None)
        vocabulary = self.model.get_vocab()
        if not mark or any(x not in vocabulary or x + mark not in vocabulary for x in ByteLevel.alphabet()):
            return None
        last = np.zeros(max(vocabulary.values()) + 1, bool)
        last[[i for x, i in vocabulary.items() if x.endswith(mark)]] = True
        return last

    def _letters(self, words: list[str], out: list[bytes | None]) -> None:
        """Ids of words of letters alone: many in one call, cut behind the ids that end a piece.
        Such a word is one piece at least, so with as many ends as words each is just one; a
        group with more is left."""
        letters = [i for i, w in enumerate(words) if w.isalpha()]
        groups = [letters[at : at + JOINED] for at in range(0, len(letters), JOINED)]
        coded = self.model.encode_batch_fast([" ".join([words[i] for i in g]) for g in groups], add_special_tokens=False)
        for group, encoding in zip(groups, coded):
            ids = np.array(encoding.ids, np.uint32)
            stops = (4 * np.flatnonzero(self.last[ids]) + 4).tolist()
            if len(stops) == len(group) and stops[-1] == 4 * len(ids):
                raw = ids.tobytes()
                for i, a, b in zip(group, [0, *stops], stops):
                    out[i] = raw[a:b]

    def _words(self, words: list[str]) -> list[bytes]:
        """Ids of single words: letters as above, others many in one call, with a word of one id
        between them that none of them holds. Where that word comes out another number of times,
        one by one."""
        out: list[bytes | None] = [None] * len(words)
        if self.last is not None:
            self._letters(words, out)
        calm = [i for i, w in enumerate(words) if out[i] is None and BETWEEN not in w] if self.between is not None else []
        groups = [calm[at : at + JOINED] for at in range(0, len(calm), JOINED)]
        coded = self.model.encode_batch_fast([f" {BETWEEN} ".join([words[i] for i in g]) for g in groups], add_special_tokens=False)
        for group, encoding in zip(groups, coded):
            ids = np.array(encoding.ids, np.uint32)
            cuts = np.flatnonzero(ids == self.between)
            if len(cuts) == len(group) - 1:
                raw = ids.tobytes()
                for i, a, b in zip(group, [0, *(cuts + 1).tolist()], [*cuts.tolist(), len(ids)]):
                    out[i] = raw[4 * a : 4 * b]
        left = [i for i, x in enumerate(out) if x is None]
        for i, x in zip(left, self._plain([words[i] for i in left])):
            out[i] = x
        return out

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids and, per text, where its ids begin (one more entry for the end)."""
        if not self.by_word:
            parts = self._plain(texts.to_pylist())
            lengths = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
            return np.frombuffer(b"".join(parts), np.uint32), np.concatenate([[0], np.cumsum(lengths)])
        if not pc.any(pc.match_substring(texts, "<|")).as_py():
            texts = pc.replace_substring_regex(pc.ascii_lower(texts), "([a-zß-öø-ÿ])([,.])", r"\1 \2")
        split = pc.ascii_split_whitespace(texts)
        coded = split.flatten().dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        parts = list(map(self.young.get, distinct))
        missing = []
        for i in [i for i, x in enumerate(parts) if x is None]:
            if (x := self.old.get(distinct[i])) is not None:
                parts[i] = self.young[distinct[i]] = x
            else:
                missing.append(i)
        for i, x in zip(missing, self._words([distinct[i] for i in missing])):
            parts[i] = x
            if len(x) <= WORD_BYTES:
                self.young[distinct[i]] = x
        if len(self.young) > WORDS // 2:
            self.old, self.young = self.young, {}
        lengths = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
        pool = np.frombuffer(b"".join(parts), np.uint32)
        begin = np.cumsum(lengths) - lengths
        codes = coded.indices.to_numpy(zero_copy_only=False)
        per_word = lengths[codes]
        upto = np.concatenate([[0], np.cumsum(per_word)])
        place = np.int32 if upto[-1] < 1 << 30 else np.int64  # half the memory to move
        ids = pool[np.arange(upto[-1], dtype=place) + np.repeat((begin[codes] - upto[:-1]).astype(place), per_word)]
        return ids, upto[split.offsets.to_numpy()]
