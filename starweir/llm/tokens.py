"""Token ids of whole texts by a public vocabulary, with each word encoded once a worker.

The vocabularies here split text before they merge, so a text's ids are those of its
pieces, one after the other. Cutting is done where that is certain; a text where it is
not is encoded whole.
"""

from __future__ import annotations

import os
import string
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa

from starweir.llm.text import CHECK_BASE, chunks, mix, prefix_hashes, ranges, string_hashes, utf8
from starweir.llm.text import words_of

#: Pieces remembered by a worker by their hashes; beyond, it starts anew.
CACHED_PIECES = 3_000_000
#: Words and endings remembered as such, to put new pieces together.
CACHED_WORDS = 100_000
#: Pieces given to the tokenizer at once; what it returns for each is large.
CALL_PIECES = 5_000
#: New pieces learnt at once.
LEARNT_PIECES = 20_000


def vocabulary_path(name: str) -> str:
    """``name`` itself if it is a path, else the file of that name in public_tokenizers."""
    if os.path.sep in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Encodes by the vocabulary at ``path``.

    With ``plain`` the strings of special tokens are text like any other. With
    ``blank_before`` every text is taken with a blank before it.
    """

    def __init__(self, path: str, plain: bool = False, blank_before: bool = False) -> None:
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain
        self.blank_before = blank_before
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.special = [] if plain else [t.content for t in added]
        size = max(vocabulary.values()) + 1
        ends = np.zeros(size, bool)
        starts = np.zeros(size, bool)
        for token, i in vocabulary.items():
            ends[i] = token.endswith("</w>")
            starts[i] = token.startswith("Ġ")
        #: Words end with a mark and white space is dropped; else a word takes the blank
        #: before it along.
        self.word_ends = bool(ends.any())
        self.marks = ends if self.word_ends else starts
        self.hashes = np.zeros(0, np.uint64)
        self._forget()

    def _forget(self) -> None:
        # Pieces, sorted by hash: where their ids are in the pool, and how many.
        self.hashes = np.zeros(0, np.uint64)
        self.at = np.zeros(0, np.int64)
        self.lengths = np.zeros(0, np.int32)
        self.checks = np.zeros(0, np.uint64)
        self.pool = np.zeros(1 << 16, np.uint32)
        self.used = 0
        self.words: dict[str, list[int]] = {}

    def _store(self, ids: np.ndarray) -> int:
        at = self.used
        while at + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        self.pool[at : at + len(ids)] = ids
        self.used += len(ids)
        return at

    def _encode(self, pieces: list[str]) -> None:
        """Learn pieces that are not known yet."""
        if self.word_ends:
            plain = [p for p in pieces if p.isalpha() and (p.isascii() or p.lower().isalpha())]
        else:
            plain = [p for p in pieces if p[:1] == " " and p[1:].isalpha()]
        for at in range(0, len(plain), CALL_PIECES):
            self._encode_joined(plain[at : at + CALL_PIECES])
        rest = [p for p in pieces if p not in self.words]
        for at in range(0, len(rest), CALL_PIECES):
            few = rest[at : at + CALL_PIECES]
            found = self.tokenizer.encode_batch_fast(few, add_special_tokens=False)
            for piece, own in zip(few, found):
                self.words[piece] = own.ids

    def _encode_joined(self, plain: list[str]) -> None:
        """Learn plain words by one call; every word shows where it ends, or begins."""
        joined = (" " if self.word_ends else "").join(plain)
        (found,) = self.tokenizer.encode_batch_fast([joined], add_special_tokens=False)
        ids = found.ids
        marked = np.flatnonzero(self.marks[ids])
        if len(marked) != len(plain):
            return
        edges = [-1, *marked.tolist()] if self.word_ends else [*marked.tolist(), len(ids)]
        shift = 1 if self.word_ends else 0
        for i, piece in enumerate(plain):
            self.words[piece] = ids[edges[i] + shift : edges[i + 1] + shift]

    def _parts(self, piece: str, first: bool) -> list[str]:
        """What ``piece`` is made of, each encoded by itself. A blank before it belongs to
        it unless it is the ``first``."""
        blank = "" if first or self.word_ends else " "
        if piece.isalpha():
            return [blank + (piece.lower() if self.word_ends and piece.isascii() else piece)]
        if any(s in piece for s in self.special):
            return [blank + piece]
        if "\n" in piece and not self.word_ends:
            lines = piece.split("\n")
            if all(x and not x[0].isspace() and not x[-1].isspace() for x in lines):
                out = self._parts(lines[0], first)
                for line in lines[1:]:
                    out += ["\n", *self._parts(line, True)]
                return out
        core = piece.rstrip(string.punctuation)
        if core.isalpha():
            return [*self._parts(core, first), piece[len(core) :]]
        return [blank + piece]

    def _learn(
        self, hashes: np.ndarray, checks: np.ndarray, pieces: list[tuple[str, bool]]
    ) -> None:
        """Remember new pieces, given with whether they are first."""
        if len(self.words) > CACHED_WORDS:
            self.words = {}
        parts = [self._parts(*piece) for piece in pieces]
        missing = list(dict.fromkeys(p for own in parts for p in own if p not in self.words))
        if missing:
            self._encode(missing)
        words = self.words
        self._remember(
            hashes,
            checks,
            [words[own[0]] if len(own) == 1 else [i for p in own for i in words[p]] for own in parts],
        )

    def _remember(self, hashes: np.ndarray, checks: np.ndarray, found: list[list[int]]) -> None:
        lengths = np.fromiter(map(len, found), np.int32, len(found))
        total = int(lengths.sum())
        at = self._store(np.fromiter(chain.from_iterable(found), np.uint32, total))
        places = np.searchsorted(self.hashes, hashes)
        self.at = np.insert(self.at, places, at + np.cumsum(lengths, dtype=np.int64) - lengths)
        self.lengths = np.insert(self.lengths, places, lengths)
        self.checks = np.insert(self.checks, places, checks)
        self.hashes = np.insert(self.hashes, places, hashes)

    def _cut(self, data: np.ndarray, bounds: np.ndarray):
        """Starts and ends of the pieces, the first one of each row, and two hashes of each."""
        starts, ends, first, hashes, checks = [], [], [np.zeros(1, np.int64)], [], []
        number = 0
        for at, end in chunks(bounds):
            low = bounds[at]
            piece, own = data[low : bounds[end]], bounds[at : end + 1] - low
            if self.word_ends:
                words = words_of(piece, own)
                s, e, f = words.starts, words.ends, words.first
            else:
                blanks = np.flatnonzero(piece == 0x20)
                s = np.sort(np.concatenate([own[:-1], blanks + 1]), kind="stable")
                e = np.sort(np.concatenate([own[1:], blanks]), kind="stable")
                f = np.concatenate([[0], np.cumsum(np.bincount(
                    np.searchsorted(own[1:], blanks, "right"), minlength=end - at) + 1)])
            starts.append(s + low)
            ends.append(e + low)
            first.append(f[1:] + number)
            number += len(s)
            hashes.append(string_hashes(piece, prefix_hashes(piece), s, e))
            sums = prefix_hashes(piece, CHECK_BASE)
            checks.append(string_hashes(piece, sums, s, e, CHECK_BASE))
        if not hashes:
            none = np.zeros(0, np.int64)
            return none, none, np.zeros(1, np.int64), none.view(np.uint64), none.view(np.uint64)
        return (*map(np.concatenate, (starts, ends, first, hashes, checks)),)

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all rows, NULL as empty, and the bounds of the rows' ids."""
        data, rows = utf8(column)
        starts, ends, bounds, hashes, checks = self._cut(data, rows)
        if len(self.hashes) > CACHED_PIECES:
            self._forget()
        whole = np.zeros(0, np.int64)
        first = np.zeros(len(hashes), bool)
        if not self.word_ends:
            # White space that goes on over a cut; a first piece may begin with any.
            odd = np.flatnonzero(_begins_blank(data, starts, ends))
            whole = np.unique(np.searchsorted(bounds, odd, "right") - 1)
            whole = whole[np.diff(bounds)[whole] > 1]
            if not self.blank_before:
                first[bounds[:-1]] = True
                hashes = np.where(first, mix(hashes), hashes)
            keep = np.ones(len(rows) - 1, bool)
            keep[whole] = False
            keep = np.repeat(keep, np.diff(bounds))
            bounds = np.concatenate([[0], np.cumsum(keep)])[bounds]
            starts, ends, first = starts[keep], ends[keep], first[keep]
            hashes, checks = hashes[keep], checks[keep]
        codes, different = pd.factorize(hashes)
        # In order, since many steps through a large table are quicker so.
        order = np.argsort(different)
        different = different[order]
        rank = np.empty_like(order)
        rank[order] = np.arange(len(order))
        codes = rank[codes]
        places = np.searchsorted(self.hashes, different)
        known = places < len(self.hashes)
        known[known] = self.hashes[places[known]] == different[known]
        if not known.all():
            seen = np.zeros(len(different), np.int64)
            seen[codes[::-1]] = np.arange(len(codes))[::-1]
            new = np.flatnonzero(~known)
            at = seen[new]
            text = data.tobytes()
            for few in np.array_split(np.arange(len(new)), len(new) // LEARNT_PIECES + 1):
                words = [
                    (text[s:e].decode(), f)
                    for s, e, f in zip(
                        starts[at[few]].tolist(), ends[at[few]].tolist(), first[at[few]].tolist()
                    )
                ]
                self._learn(different[new[few]], checks[at[few]], words)
            places = np.searchsorted(self.hashes, different)
        if len(codes):
            # Two pieces with one hash: their rows are encoded whole.
            unlike = np.flatnonzero(self.checks[places][codes] != checks)
            whole = np.union1d(whole, _rows_of(unlike, bounds))
        lengths = self.lengths[places][codes].astype(np.int64)
        ids = self.pool[ranges(self.at[places][codes], lengths)]
        out_bounds = np.concatenate([[0], np.cumsum(lengths)])[bounds]
        if len(whole):
            return self._insert(column, whole, ids, out_bounds)
        return ids, out_bounds

    def _encode_whole(self, texts: list[str]) -> list[np.ndarray]:
        blank = " " if self.blank_before else ""
        texts = [blank + t for t in texts]
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, np.uint32) for e in found]

    def _insert(self, column, whole, ids, bounds):
        texts = [t or "" for t in column.take(pa.array(whole)).to_pylist()]
        own = dict(zip(whole.tolist(), self._encode_whole(texts)))
        rows = [own.get(i, ids[bounds[i] : bounds[i + 1]]) for i in range(len(bounds) - 1)]
        return np.concatenate(rows), np.concatenate([[0], np.cumsum([len(r) for r in rows])])


def _rows_of(pieces: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    return np.unique(np.searchsorted(bounds, pieces, "right") - 1)


def _begins_blank(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Pieces that are empty or begin with what may be white space."""
    room = np.concatenate([data, np.zeros(2, np.uint8)])
    one, two = room[starts], room[starts + 1]
    return (
        (starts == ends)
        | ((one >= 0x09) & (one <= 0x0D))
        | ((one >= 0x1C) & (one <= 0x20))
        | ((one == 0xC2) & ((two == 0x85) | (two == 0xA0)))
        | ((one == 0xE1) & (two == 0x9A))
        | ((one == 0xE2) & ((two == 0x80) | (two == 0x81)))
        | ((one == 0xE3) & (two == 0x80))
    )


_encoders: dict[str, Encoder] = {}


def encoder(name: str) -> Encoder:
    """The encoder of a vocabulary, kept by the worker for its later tasks."""
    path = vocabulary_path(name)
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


