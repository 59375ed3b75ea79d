"""Token ids of whole Arrow batches of texts, each distinct word of a batch encoded once.

Holds for tokenizers files whose rules are those named in ``RULES``: composed characters,
any letter in lower case, white space dropped, runs of letters, single digits and runs of
other characters as pieces, byte-level BPE with a mark at a piece's end. For them the ids
of a text are those of its words in turn, so a batch is lowered, cut at ASCII white space
and dictionary-encoded by Arrow, the dictionary's words are merged all at once in numpy,
and their ids are gathered back. Nothing is kept between batches, so memory is bounded by
the batch; texts beyond CHUNK bytes are cut at white space.

Words with other than printable ASCII and Latin-1 letters, or with an apostrophe, and
texts with a special string in either case, go through the library. So does every text if
a file has other rules.
"""

from __future__ import annotations

import contextlib
import functools
import json

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .shingles import bytes_of

CHUNK = 2 << 20
#: What a tokenizers file must say, as fixed values of its format.
RULES = {
    "normalizer": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}],
    "pattern": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+",
    "model": {"type": "BPE", "dropout": None, "unk_token": None, "continuing_subword_prefix": None, "end_of_word_suffix": "</w>", "ignore_merges": False},
}
_NEVER = np.int32(0x7FFFFFFF)
_LETTER, _DIGIT, _SIGN, _OTHER = range(4)
_KIND = np.full(256, _OTHER, np.uint8)
_KIND[33:127] = _SIGN
_KIND[48:58] = _DIGIT
_KIND[97:123] = _LETTER
_KIND[65:91] = _LETTER
_KIND[39] = _OTHER
#: Second bytes of Latin-1 letters after 0xC3: all but the two signs.
_SECOND = np.zeros(256, bool)
_SECOND[0x80:0xC0] = True
_SECOND[[0x97, 0xB7]] = False


def _visible() -> dict[int, str]:
    """The character that a byte-level vocabulary writes for each byte."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in own]
    return {**{b: chr(b) for b in own}, **{b: chr(256 + i) for i, b in enumerate(other)}}


class Merges:
    """Byte-pair merges of many pieces at once."""

    def __init__(self, vocab: dict[str, int], merges: list):
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in merges]
        self.size = max(vocab.values()) + 1
        used: set[int] = set()
        left, right, new = (np.empty(len(pairs), np.int64) for _ in range(3))
        for rank, (a, b) in enumerate(pairs):
            left[rank], right[rank], new[rank] = vocab[a], vocab[b], vocab[a + b]
            # what a merge makes only takes part in later ones, so all merges of one rank in a piece can be done together
            if vocab[a + b] in used:
                raise ValueError("merges aren't in the order of their making")
            used.update((vocab[a], vocab[b]))
        chars = _visible()
        self.inner = np.array([vocab[chars[b]] for b in range(256)], np.int32)
        self.last = np.array([vocab[chars[b] + "</w>"] for b in range(256)], np.int32)
        self.made = new.astype(np.int32)
        self._fill(left * self.size + right)
        b = np.arange(256)
        #: Ranks of pairs of bytes, the second one inside a piece and at its end.
        self.first = np.stack([self.ranks(np.repeat(self.inner, 256), np.tile(x, 256)) for x in (self.inner, self.last)]).reshape(2, 256, len(b))

    def _fill(self, keys: np.ndarray) -> None:
        """An open-addressed table of the merges' keys, at least two thirds empty."""
        bits = int(3 * len(keys) + 1).bit_length()
        self.shift, self.mask = np.uint64(64 - bits), np.int64((1 << bits) - 1)
        self.keys, self.rank = np.full(1 << bits, -1, np.int64), np.full(1 << bits, _NEVER, np.int32)
        rest, slot = np.arange(len(keys)), self._slot(keys)
        while len(rest):
            _, first = np.unique(slot, return_index=True)
            first = first[self.keys[slot[first]] < 0]
            self.keys[slot[first]], self.rank[slot[first]] = keys[rest[first]], rest[first]
            left = np.ones(len(rest), bool)
            left[first] = False
            rest, slot = rest[left], (slot[left] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).view(np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair of ids, _NEVER if it isn't merged."""
        key = left * np.int64(self.size) + right
        slot = self._slot(key)
        there = self.keys[slot]
        out = np.where(there == key, self.rank[slot], _NEVER)
        rest = np.flatnonzero((there != key) & (there >= 0))
        slot = slot[rest]
        while len(rest):
            slot = (slot + 1) & self.mask
            there, want = self.keys[slot], key[rest]
            out[rest] = np.where(there == want, self.rank[slot], _NEVER)
            more = (there != want) & (there >= 0)
            rest, slot = rest[more], slot[more]
        return out

    def apply(self, data: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """For each byte the id that begins there, or -1; ``begins`` marks the first bytes of pieces.

        The symbols of a piece are a chain; each round merges the best pair of every
        piece, and finished pieces are taken out once they are a third of all.
        """
        final = np.full(len(data), -1, np.int32)
        if len(data) == 0:
            return final
        n = len(data)
        end = np.append(begins[1:], True)
        ids, at = np.where(end, self.last[data], self.inner[data]), np.arange(n, dtype=np.int32)
        rank = np.full(n, _NEVER, np.int32)
        inside = np.flatnonzero(~end)
        rank[inside] = self.first[end[inside + 1].view(np.uint8), data[inside], data[inside + 1]]
        # the next symbol of the last one in a piece, and the one before the first, is -1
        after, before = np.arange(1, n + 1, dtype=np.int32), np.arange(-1, n - 1, dtype=np.int32)
        after[end], before[begins] = -1, -1
        start = np.flatnonzero(begins)
        size = np.diff(np.append(start, n))
        while True:
            least = np.minimum.reduceat(rank, start)
            going = least < _NEVER
            if 3 * np.count_nonzero(going) < 2 * len(going):
                mask = np.repeat(going, size)
                done = np.flatnonzero(~mask & (ids >= 0))
                final[at[done]] = ids[done]
                size, least = size[going], least[going]
                if not len(size):
                    return final
                old = start[going]
                start = np.cumsum(size) - size
                move = np.repeat((old - start).astype(np.int32), size)
                ids, at, rank, after, before = ids[mask], at[mask], rank[mask], after[mask], before[mask]
                after -= np.where(after >= 0, move, 0)
                before -= np.where(before >= 0, move, 0)
            hit = (rank == np.repeat(least, size)) & (rank < _NEVER)
            i = np.flatnonzero(hit)
            if not len(i):  # (what is left is finished)
                done = np.flatnonzero(ids >= 0)
                final[at[done]] = ids[done]
                return final
            # of overlapping pairs the first; the others have their turn in the next round
            i = i[~((before[i] >= 0) & hit[before[i]])]
            gone = after[i]
            ids[i] = self.made[rank[i]]
            ids[gone], rank[gone], rank[i] = -1, _NEVER, _NEVER
            following = after[gone]
            after[i] = following
            has = following >= 0
            before[following[has]] = i[has]
            left = before[i]
            pair = np.concatenate([i[has], left[left >= 0]])
            rank[pair] = self.ranks(ids[pair], ids[after[pair]])


class WordIds:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.special = [t.content.lower() for t in self.library.get_added_tokens_decoder().values()]
        rules = json.loads(self.library.to_str())
        self.merges = None
        if self._known(rules):
            with contextlib.suppress(KeyError, ValueError):  # a vocabulary without all bytes, or merges in another order
                self.merges = Merges(rules["model"]["vocab"], rules["model"]["merges"])
        self.width = "<u2" if self.library.get_vocab_size() <= 1 << 16 else "<u4"

    def _known(self, rules: dict) -> bool:
        """Whether the file's rules are those that this module has in numpy."""
        normal, pre = rules.get("normalizer") or {}, (rules.get("pre_tokenizer") or {}).get("pretokenizers") or []
        split, level = pre if len(pre) == 2 else ({}, {})
        return (
            normal.get("normalizers") == RULES["normalizer"]
            and (split.get("type"), split.get("pattern"), split.get("behavior"), split.get("invert")) == ("Split", {"Regex": RULES["pattern"]}, "Removed", True)
            and (level.get("type"), level.get("add_prefix_space"), level.get("use_regex")) == ("ByteLevel", False, False)
            and all(rules["model"].get(k) == v for k, v in RULES["model"].items())
            and rules.get("post_processor") is None
            and len(self.special) <= 16
            and not any(t.normalized or t.lstrip or t.rstrip or t.single_word for t in self.library.get_added_tokens_decoder().values())
        )

    def encode_library(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def of_words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words, n+1 offsets of the words in them); words are lower-case but for letters outside ASCII."""
        data, bounds = bytes_of(words)
        n = len(words)
        kind = _KIND[data]
        lead = data == 0xC3
        second = np.zeros(len(data), bool)
        second[1:] = lead[:-1] & _SECOND[data[1:]]
        kind[second] = _LETTER
        kind[:-1][second[1:]] = _LETTER
        bad = np.concatenate([[0], np.cumsum(kind == _OTHER)])
        odd = bad[bounds[1:]] > bad[bounds[:-1]]
        data = data + (np.uint8(0x20) * (second & (data < 0x9F)))
        if odd.any():
            mask = ~np.repeat(odd, np.diff(bounds))
            data, kind = data[mask], kind[mask]
        size = np.where(odd, 0, np.diff(bounds))
        at = np.concatenate([[0], np.cumsum(size)])
        begins = np.ones(len(data), bool)
        begins[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
        begins[at[:-1][size > 0]] = True
        found = self.merges.apply(data, begins)
        real = found >= 0
        ids, to = found[real], np.concatenate([[0], np.cumsum(real)])[at]
        if odd.any():
            other = self.encode_library(words.filter(pa.array(odd)).to_pylist())
            count = np.diff(to)
            count[odd] = [len(x) for x in other]
            to = np.concatenate([[0], np.cumsum(count)])
            out = np.empty(to[-1], np.int32)
            mask = np.repeat(odd, count)
            out[~mask] = ids
            out[mask] = np.fromiter((i for x in other for i in x), np.int32, int(mask.sum()))
            ids = out
        return ids, to

    def _of_texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The same for texts without special strings."""
        split = pc.ascii_split_whitespace(texts)
        words = split.flatten().dictionary_encode()
        ids, to = self.of_words(words.dictionary)
        which = words.indices.to_numpy()
        at = split.offsets.to_numpy().astype(np.int64)
        count = np.diff(to)[which]
        ends = np.cumsum(count)
        out = ids[np.repeat(to[which] - ends + count, count) + np.arange(ends[-1] if len(ends) else 0)]
        return out, np.concatenate([[0], ends])[at - at[0]]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, n+1 offsets of the texts in them), for texts without nulls."""
        if self.merges is None:
            return _flat(self.encode_library(texts.to_pylist()))
        low = pc.ascii_lower(texts)
        whole = pc.greater(pc.binary_length(texts), CHUNK)
        for x in self.special:
            whole = pc.or_(whole, pc.match_substring(low, x))
        alone = whole.to_numpy(zero_copy_only=False)
        if not alone.any():
            return self._of_texts(low)
        others = iter(_cut(*self._of_texts(low.filter(pc.invert(whole)))))
        every = [self._one(texts[i].as_py()) if alone[i] else next(others) for i in range(len(texts))]
        return np.concatenate(every), np.concatenate([[0], np.cumsum([len(x) for x in every])])

    def _one(self, text: str) -> np.ndarray:
        low = text.lower()
        if any(x in low for x in self.special):
            return np.array(self.encode_library([text])[0], np.int32)
        parts, start = [], 0
        while start < len(text):
            stop = min(len(text), start + CHUNK // 4)
            while stop < len(text) and text[stop] not in " \t\n\v\f\r":
                stop += 1
            parts.append(self._of_texts(pc.ascii_lower(pa.array([text[start:stop]], pa.string())))[0])
            start = stop
        return np.concatenate(parts)


def _flat(ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    to = np.concatenate([[0], np.cumsum([len(x) for x in ids], dtype=np.int64)])
    return np.fromiter((i for x in ids for i in x), np.int32, int(to[-1])), to


def _cut(ids: np.ndarray, to: np.ndarray) -> list[np.ndarray]:
    return [ids[a:b] for a, b in zip(to, to[1:])]


@functools.lru_cache(maxsize=2)
def ids_at(path: str) -> WordIds:
    return WordIds(path)
