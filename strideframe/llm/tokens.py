"""Token ids from a public tokenizer file, with distinct chunks encoded once.

A text is cut into chunks at places where the tokenizer never joins across; each
distinct chunk of a batch is encoded by the library and the ids are put together
again. The result is the library's own for the whole text.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable
from itertools import chain, compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

#: Text bytes that are encoded at a time: the more, the fewer chunks are looked up twice, and the
#: more memory a worker takes (at 16 MB two of them took an executor to 2,965 MB).
ENCODED_BYTES = 8 * 1024 * 1024
#: Distinct chunks whose ids a worker keeps from batch to batch.
KEPT_CHUNKS = 400_000
_loaded: dict[str, object] = {}


def load(path: str):
    """The tokenizer at ``path``, once for each worker."""
    if path not in _loaded:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _loaded[path] = Tokenizer.from_file(path)
    return _loaded[path]


def _byte_signs() -> list[str]:
    """The sign that byte-level vocabularies use for each byte: itself where it prints,
    else the next one from U+0100 up."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = (b for b in range(256) if b not in prints)
    signs = {b: chr(b) for b in prints} | {b: chr(256 + n) for n, b in enumerate(others)}
    return [signs[b] for b in range(256)]


_BLANK = _byte_signs()[32]
_SIGNS = str.maketrans(dict(enumerate(_byte_signs())))
_LETTER = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"
_CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"
#: No plain chunk holds it.
_APART = "\x01"


def _runs(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of all runs that begin at ``starts``, one run after the other."""
    upto = np.cumsum(sizes)
    at = np.repeat((starts - (upto - sizes)).astype(np.int32), sizes)
    at += np.arange(len(at), dtype=np.int32)
    return at


class ByWord:
    """Words between white space, lower-cased; every digit is a piece."""

    #: Chunks of ASCII and Latin-1 letters; what Unicode rules do to them is plain.
    plain = rf"^[\x21-\x7e{_LETTER}]+$"
    #: Chunks that are one piece.
    word = rf"^[{_LETTER}]+$"
    #: Pieces of plain chunks that ``_APART`` stands between.
    pieces = re.compile(rf"{_CONTRACTIONS}|[{_LETTER}]+|[0-9]|[^{_LETTER}0-9{_APART}]+|{_APART}").findall

    @staticmethod
    def normal(chunk: str) -> str:
        return chunk.lower()

    @staticmethod
    def split(texts: pa.Array) -> pa.ListArray:
        return pc.ascii_split_whitespace(texts)

    blank = ""
    whole = None


class BySpace:
    """A blank and the word after it; case is kept."""

    #: A line end between two of them is a piece of its own.
    plain = rf"^ ?[\x21-\x7e{_LETTER}]+(?:\n[\x21-\x7e{_LETTER}]+)*$"
    word = rf"^ ?[{_LETTER}]+$"
    pieces = re.compile(rf"{_CONTRACTIONS}| ?[{_LETTER}]+| ?[0-9]+| ?[^ \n{_LETTER}0-9{_APART}]+|\n|{_APART}").findall

    @staticmethod
    def normal(chunk: str) -> str:
        return chunk

    @staticmethod
    def split(texts: pa.Array) -> pa.ListArray:
        return pc.split_pattern(texts, " ")

    #: What stands before every chunk of a text but the first.
    blank = " "
    #: Texts that hold this are one chunk.
    whole = "  "


class ChunkEncoder:
    """``encode`` turns texts into one flat array of ids and the number of ids of each.

    Chunks of plain letters and signs are cut into pieces here, and each distinct piece
    goes to the library's model; all others go through the whole of the library.
    """

    def __init__(self, path: str, rule: type = ByWord):
        self.tokenizer, self.rule = load(path), rule
        self.model = self.tokenizer.model
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.known: dict[str, int] = {}
        self._reset()

    def _reset(self) -> None:
        self.known.clear()
        self.starts = np.zeros(0, np.int32)
        self.sizes = np.zeros(0, np.int32)
        self.uses = np.zeros(0, np.int32)
        self.pool = np.zeros(0, np.uint32)

    def _forget(self) -> None:
        """Keep at most half of the chunks, those in most use."""
        least, keep = 2, self.uses >= 2
        while keep.sum() > KEPT_CHUNKS // 2:
            least *= 2
            keep = self.uses >= least
        at = np.flatnonzero(keep)
        starts, sizes, pool, uses = self.starts[at], self.sizes[at], self.pool, self.uses[at]
        place = np.cumsum(keep) - 1
        known = {c: int(place[i]) for c, i in self.known.items() if keep[i]}
        self._reset()
        self.known.update(known)
        self.starts, self.sizes, self.uses = (np.cumsum(sizes) - sizes).astype(np.int32), sizes, uses // 2
        self.pool = pool[_runs(starts, sizes)]

    def _add(self, new: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        """Note the ids of new chunks."""
        base = len(self.sizes)
        self.starts = np.concatenate([self.starts, (len(self.pool) + np.cumsum(sizes) - sizes).astype(np.int32)])
        self.sizes = np.concatenate([self.sizes, sizes.astype(np.int32)])
        self.uses = np.concatenate([self.uses, np.zeros(len(sizes), np.int32)])
        self.pool = np.concatenate([self.pool, ids])
        self.known.update(zip(new, range(base, base + len(new)), strict=True))

    def _piece_ids(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces, one after the other, and how many each has."""
        signs = [p.replace(" ", _BLANK) if p.isascii() and p != "\n" else p.encode().decode("latin-1").translate(_SIGNS) for p in pieces]
        tokens = [self.model.tokenize(p) for p in signs]
        sizes = np.fromiter(map(len, tokens), dtype=np.int64, count=len(tokens))
        return np.fromiter((t.id for own in tokens for t in own), dtype=np.uint32, count=int(sizes.sum())), sizes

    def _learn(self, new: list[str]) -> None:
        """Note the ids of new chunks. A piece is a chunk of its own, and is noted as one, so
        that no other chunk that holds it sends it to the library again."""
        rule, known = self.rule, self.known
        column = pa.array(new, pa.string())
        word, plain = (pc.match_substring_regex(column, x).to_numpy(zero_copy_only=False) for x in (rule.word, rule.plain))
        for mark in self.special:
            plain &= ~pc.match_substring(column, mark).to_numpy(zero_copy_only=False)
        words = list(compress(new, word))
        mixed = list(compress(new, plain & ~word))
        others = list(compress(new, ~(plain | word)))

        lowered = [rule.normal(w) for w in words]
        flat = rule.pieces(_APART.join(map(rule.normal, mixed)))
        fresh = [p for p in dict.fromkeys(chain(lowered, flat)) if p not in known and p != _APART]
        self._add(fresh, *self._piece_ids(fresh))
        whole = [self.tokenizer.encode(c, add_special_tokens=False).ids for c in others]
        self._add(others, np.fromiter(chain.from_iterable(whole), dtype=np.uint32), np.fromiter(map(len, whole), dtype=np.int64, count=len(whole)))

        # words that are not their own piece, then the chunks of several pieces
        turned = [(w, p) for w, p in zip(words, lowered, strict=True) if w != p]
        self._compose([w for w, _ in turned], [p for _, p in turned], np.ones(len(turned), np.int64))
        if mixed:
            ends = np.flatnonzero(np.fromiter(map(_APART.__eq__, flat), dtype=bool, count=len(flat)))
            counts = np.diff(np.concatenate([[-1], ends, [len(flat)]])) - 1
            self._compose(mixed, [p for p in flat if p != _APART], counts)

    def _compose(self, chunks: list[str], pieces: list[str], counts: np.ndarray) -> None:
        """Note the chunks that are made of so many pieces each, but for those that are known
        by now, as they are pieces themselves."""
        at = np.fromiter(map(self.known.__getitem__, pieces), dtype=np.int64, count=len(pieces))
        keep = np.fromiter((c not in self.known for c in chunks), dtype=bool, count=len(chunks))
        at, counts = at[np.repeat(keep, counts)], counts[keep]
        sizes = self.sizes[at]
        upto = np.concatenate([[0], np.cumsum(sizes)])[np.cumsum(counts)]
        self._add(list(compress(chunks, keep)), self.pool[_runs(self.starts[at], sizes)], np.diff(upto, prepend=0))

    def _places(self, chunks: list[str]) -> np.ndarray:
        """Where the ids of each chunk are noted."""
        new = [c for c in chunks if c not in self.known]
        if new:
            self._learn(list(dict.fromkeys(new)))
        return np.fromiter(map(self.known.__getitem__, chunks), dtype=np.int32, count=len(chunks))

    def encode(self, texts: pa.Array | list) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (null as empty), one after the other, and how many each has."""
        if len(self.pool) > 50 * KEPT_CHUNKS:
            self._reset()
        elif len(self.known) > KEPT_CHUNKS:
            self._forget()
        texts = pa.array(texts, pa.string()) if isinstance(texts, list) else texts
        texts = pc.fill_null(texts, "")
        alone = np.zeros(len(texts), dtype=bool)
        if self.rule.whole:
            alone = pc.match_substring(texts, self.rule.whole).to_numpy(zero_copy_only=False)
        lists = self.rule.split(pc.if_else(pa.array(alone), "", texts) if alone.any() else texts)
        counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(counts)
        coded = lists.flatten().dictionary_encode()
        blank = self.rule.blank
        vocabulary = coded.dictionary.to_pylist()
        places = self._places([blank + w for w in vocabulary])
        chunk = places[coded.indices.to_numpy(zero_copy_only=False)] if len(places) else np.zeros(0, np.int32)
        if blank:
            firsts = (ends - counts)[counts > 0]
            chunk[firsts] = self._places([w.as_py() for w in coded.take(pa.array(firsts))])
        for i in np.flatnonzero(alone).tolist():
            # its one chunk, the empty text, gives way to the whole text
            text = texts[i].as_py()
            chunk[ends[i] - 1] = self._places([text])[0]
            del self.known[text]
        self.uses += np.bincount(chunk, minlength=len(self.uses)).astype(np.int32)
        sizes = self.sizes[chunk]
        upto = np.cumsum(sizes)
        flat = self.pool[_runs(self.starts[chunk], sizes)]
        before = np.concatenate([[0], upto])
        return flat, before[ends] - before[ends - counts]


_encoders: dict[tuple[str, type], ChunkEncoder] = {}


def encoder(path: str, rule: type) -> ChunkEncoder:
    """The encoder for a file, kept by the worker from task to task."""
    if (path, rule) not in _encoders:
        _encoders[path, rule] = ChunkEncoder(path, rule)
    return _encoders[path, rule]
