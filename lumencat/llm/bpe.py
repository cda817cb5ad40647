"""BPE encoding as a bounded-lookahead streaming transducer, and incremental decoding.

Encoding. A word is fed symbol by symbol (bytes; the last one carries the
end-of-word mark). For every prefix the transducer knows the last token of that
prefix's encoding: it is the only vocabulary entry that ends there and may
follow the last token of the prefix before it. A later token is at most
``lookahead`` symbols long, so it starts at one of the last ``lookahead``
positions: whatever all the back-pointer chains from these positions share can
no longer change and is emitted at once. State is the window since the last
emitted token, independent of the text's length.

The merge list fixes ``lookahead``: the longest token it can build, in symbols.

``Transducer`` runs one word and emits early. ``Lockstep`` runs the same steps
for many words side by side in numpy; words of more than WIDE symbols, whose
windows would grow, go through ``Transducer``. Nothing is kept between groups of
texts but tables of a fixed size, so a worker's memory does not grow with the
corpus' vocabulary.

Decoding. ``TokenDecoder`` takes blocks of ids and emits bytes of text: one
state machine with two modes. ``joined`` is the library's decode() for a file
without a decoder (the tokens' own strings with a space between), ``text``
turns byte symbols back into characters and word ends into spaces.

Defined results: null text encodes like the empty text (no ids, empty decoded
text); repeated rows give repeated results; special strings inside a text
become their special ids, as in the library. A text is cut at white space into
windows of GROUP_BYTES, each encoded on its own; its ids (4 bytes a token) are
hashed and decoded block by block.
"""

from __future__ import annotations

import codecs
import functools
import hashlib
import json
import re
import unicodedata
from collections import deque
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import release_memory, small_batches

#: Bytes of text encoded together, and words that run in lockstep.
GROUP_BYTES = 1 << 19
LOCKSTEP_WORDS = 1 << 15
#: Symbols of a word up to which it runs in lockstep.
WIDE = 40
#: Slots of the table that remembers which token may follow which, and entries of the single transducer's memo.
PAIR_SLOTS = 1 << 20
CACHE_PAIRS = 100_000
#: Ids decoded together.
DECODE_IDS = 1 << 18
SPACE = re.compile(r"[\x20\x09-\x0D]")

OTHER, LETTER, NUMBER = 3, 1, 2  # classes of code points; 0: white space

# What the tokenizer library's Unicode version knows and Python's tables may not yet:
# letters and numbers as ranges, and capitals as (first, last, distance to the small letter).
LATER_LETTERS = (
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4),
    (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3),
    (0x11BC0, 0x11BE0), (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0),
)
LATER_NUMBERS = ((0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79), (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA))
LATER_CAPITALS = (
    (0x1C89, 0x1C89, 1), (0xA7CB, 0xA7CB, 0x264 - 0xA7CB), (0xA7CC, 0xA7CC, 1), (0xA7CE, 0xA7CE, 1), (0xA7D2, 0xA7D2, 1), (0xA7D4, 0xA7D4, 1),
    (0xA7DA, 0xA7DA, 1), (0xA7DC, 0xA7DC, 0x19B - 0xA7DC), (0x10D50, 0x10D65, 0x20), (0x16EA0, 0x16EB8, 0x1B),
)
#: Fixed by the tokenizer file: what its pattern takes for white space, and the endings it splits off after an apostrophe.
WHITE = (*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
SHORT_ENDINGS, LONG_ENDINGS = "stmd", ("re", "ve", "ll")


@functools.cache
def code_tables() -> tuple[np.ndarray, np.ndarray]:
    """The small letter (one code point) and the class of every code point."""
    lower = np.fromiter((ord(chr(c).lower()[0]) for c in range(0x110000)), "<u4", 0x110000)
    kind = np.full(0x110000, OTHER, np.uint8)
    names = np.fromiter((ord(unicodedata.category(chr(c))[0]) for c in range(0x110000)), np.uint8, 0x110000)
    kind[names == ord("L")], kind[names == ord("N")] = LETTER, NUMBER
    for ranges, value in ((LATER_LETTERS, LETTER), (LATER_NUMBERS, NUMBER)):
        for first, last in ranges:
            kind[first : last + 1] = value
    kind[[*WHITE]] = 0
    for first, last, distance in LATER_CAPITALS:
        lower[first : last + 1] = np.arange(first, last + 1) + distance
    return lower, kind


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies.

    Fixed by the file format: printable Latin-1 bytes stand for themselves, the
    others take the code points from 256 on, in order.
    """
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


class MergeTable:
    """Vocabulary and merges of a tokenizers BPE file with an end-of-word mark."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.end = model.get("end_of_word_suffix") or ""
        self.vocab: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.rank = {}
        for i, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.rank[self.vocab[left], self.vocab[right]] = i, self.vocab[left + right]
        self.string = {i: t for t, i in self.vocab.items()} | {i: t for t, i in self.special.items()}
        self.symbols = byte_alphabet()
        self.lookahead = max(len(self._parts(t)) for t in self.vocab)
        self._pairs: dict[int, bool] = {}
        self.split = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")

    def _parts(self, token: str) -> list[str]:
        """The token's base symbols."""
        if self.end and token.endswith(self.end) and token != self.end:
            body = token[: -len(self.end)]
            return [*body[:-1], body[-1] + self.end]
        return [*token]

    def follows(self, left: int, right: int) -> bool:
        """Whether the encoding of both tokens' text is just these two tokens."""
        key = left << 20 | right
        known = self._pairs.get(key)
        if known is None:
            if len(self._pairs) >= CACHE_PAIRS:
                self._pairs.clear()
            ids = [self.vocab[s] for t in (left, right) for s in self._parts(self.string[t])]
            known = self._pairs[key] = self._merge(ids) == [left, right]
        return known

    def _merge(self, ids: list[int]) -> list[int]:
        """Apply merges by rank to a short list of symbols."""
        rank, none = self.rank, (1 << 30, -1)
        while len(ids) > 1:
            best = min(range(len(ids) - 1), key=lambda i: rank.get((ids[i], ids[i + 1]), none)[0])
            if (ids[best], ids[best + 1]) not in rank:
                break
            ids[best : best + 2] = [rank[ids[best], ids[best + 1]][1]]
        return ids


class Transducer:
    """Streaming encoder of one word at a time; push() symbols, finish() the word."""

    def __init__(self, table: MergeTable):
        self.table = table
        self.reset()

    def reset(self) -> None:
        self.text = ""  # symbols since the last emitted token
        self.last: list[tuple[int, int]] = []  # for each prefix of text: its last token, where that starts
        self.before = -1  # the last emitted token

    def _step(self, mark: str) -> None:
        """Find the last token of the text so far: the entry that may follow what stands before it."""
        table, text, last, n = self.table, self.text, self.last, len(self.text)
        find, pairs, follows = table.vocab.get, table._pairs, table.follows
        for start in range(max(0, n - table.lookahead), n):
            token = find(text[start:] + mark)
            if token is not None:
                left = last[start - 1][0] if start else self.before
                if left < 0 or (pairs[key] if (key := left << 20 | token) in pairs else follows(left, token)):
                    last.append((token, start))
                    return
        raise ValueError(f"no token ends at {text[-1]!r}")

    def push(self, symbols: Iterable[str]) -> list[int]:
        """Feed symbols that do not end the word; the tokens that became stable."""
        out: list[int] = []
        for s in symbols:
            self.text += s
            self._step("")
            if len(self.text) >= 2 * self.table.lookahead:
                out += self._stable()
        return out

    def _chain(self, at: int) -> list[tuple[int, int]]:
        """(token, end) of the encoding of text[:at], first token first."""
        out = []
        while at:
            token, start = self.last[at - 1]
            out.append((token, at))
            at = start
        return out[::-1]

    def _stable(self) -> Iterator[int]:
        n = len(self.text)
        chains = [self._chain(at) for at in range(n - self.table.lookahead + 1, n + 1)]
        shared, cut = [], 0
        for step in zip(*chains, strict=False):
            if len({*step}) > 1:
                break
            shared.append(step[0][0])
            cut = step[0][1]
        if cut:
            yield from shared
            self.before = shared[-1]
            self.text = self.text[cut:]
            self.last = [(token, start - cut) for token, start in self.last[cut:]]

    def finish(self, symbol: str) -> list[int]:
        """Feed the word's last symbol; the rest of its tokens."""
        self.text += symbol
        self._step(self.table.end)
        out = [token for token, _ in self._chain(len(self.text))]
        self.reset()
        return out


class IntTable:
    """A fixed map from integers (0 and up) to integers, looked up for whole arrays; -1: not in it."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = max(4, int(8 * len(keys)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.values = np.full(1 << bits, -1, np.int64), np.full(1 << bits, -1, np.int32)
        at, left = self._slot(keys), np.arange(len(keys))
        while len(left):  # one key to a free slot at a time, the others move on
            free = self.keys[at[left]] < 0
            _, first = np.unique(at[left][free], return_index=True)
            put = left[free][first]
            self.keys[at[put]], self.values[at[put]] = keys[put], values[put]
            left = np.setdiff1d(left, put, assume_unique=True)
            at[left] = (at[left] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        at = self._slot(keys)
        have = self.keys[at]
        out = self.values[at]
        other = np.flatnonzero(have != keys)
        out[other] = -1
        other = other[have[other] >= 0]
        at = at[other]
        while len(other):  # occupied by another key: the next slot
            at = (at + 1) & self.mask
            have = self.keys[at]
            hit = have == keys[other]
            out[other[hit]] = self.values[at[hit]]
            on = ~hit & (have >= 0)
            other, at = other[on], at[on]
        return out


class Lockstep:
    """The transducer's steps for many short words side by side.

    A tree of all tokens with links to their longest proper suffixes gives, for
    each prefix of each word, the tokens that end there from the longest on; the
    first that may follow the last token before it is the prefix' last token.
    """

    def __init__(self, table: MergeTable):
        n = max(table.string) + 1
        self.rank, self.left, self.right = np.full(n, -1, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
        parts: dict[int, tuple[int, ...]] = {}
        self.symbol = np.zeros(512, np.int64)  # the token of each byte, and of each byte that ends a word
        for b, c in enumerate(table.symbols):
            for i, token in ((b, table.vocab[c]), (256 + b, table.vocab[c + table.end])):
                self.symbol[i], parts[token] = token, (i,)
        for (a, b), (i, token) in table.rank.items():
            if token in parts or max(self.rank[a], self.rank[b]) >= i:
                raise ValueError("the merge list must build every token once, from tokens built before")
            self.rank[token], self.left[token], self.right[token] = i, a, b
            parts[token] = parts[a] + parts[b]
        a, b = (np.array([p[k] for p in table.rank], np.int64) for k in (0, 1))
        self.merges = IntTable(a << 20 | b, np.array([i for i, _ in table.rank.values()]))
        self.length = np.zeros(n, np.int64)
        for token, p in parts.items():
            self.length[token] = len(p)
        self._tree(parts, n)
        self.pairs = np.full(PAIR_SLOTS, -1, np.int64)

    def _tree(self, parts: dict[int, tuple[int, ...]], n: int) -> None:
        """Nodes (prefixes of tokens) with the longest token that ends in each, and each token's next shorter suffix token."""
        children: dict[int, int] = {}
        parent, depth, own = [0], [0], [-1]
        for token, p in parts.items():
            node = 0
            for s in p:
                key = node << 9 | s
                if key not in children:
                    children[key] = len(depth)
                    parent.append(key)
                    depth.append(depth[node] + 1)
                    own.append(-1)
                node = children[key]
            own[node] = token
        parent, depth, own = np.array(parent, np.int64), np.array(depth), np.array(own, np.int64)
        self.children = IntTable(np.fromiter(children, np.int64, len(children)), np.fromiter(children.values(), np.int64, len(children)))
        self.suffix, self.longest, self.shorter = np.zeros(len(depth), np.int64), own.copy(), np.full(n, -1, np.int64)
        for d in range(1, depth.max() + 1):
            at = np.flatnonzero(depth == d)
            if d > 1:
                self.suffix[at] = self._next(self.suffix[parent[at] >> 9], parent[at] & 511)
            rest = self.longest[self.suffix[at]]
            self.longest[at] = np.where(own[at] < 0, rest, own[at])
            self.shorter[own[at][own[at] >= 0]] = rest[own[at] >= 0]

    def _next(self, node: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """The node of the longest suffix that is in the tree once symbol is fed; every single symbol is."""
        node = node.copy()
        out = self.children.find(node << 9 | symbol)
        left = np.flatnonzero(out < 0)
        while len(left):
            node[left] = self.suffix[node[left]]
            out[left] = self.children.find(node[left] << 9 | symbol[left])
            left = left[out[left] < 0]
        return out.astype(np.int64)

    def follows(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether the encoding of both tokens' text is just these two tokens, for arrays of pairs."""
        key = left << 20 | right
        at = (key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(65 - PAIR_SLOTS.bit_length())).astype(np.int64)
        have = self.pairs[at]
        new = np.flatnonzero(have >> 1 != key)
        if len(new):
            self.pairs[at[new]] = have[new] = key[new] << 1 | self._apart(left[new], right[new])
        return (have & 1).astype(bool)

    def _apart(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Undo both tokens' merges, latest first: no merge across their border may have come before the next of either side."""
        x, y, ok = x.copy(), y.copy(), np.ones(len(x), bool)
        never = 1 << 40
        until_x, until_y = np.full(len(x), never), np.full(len(x), never)
        live = np.arange(len(x))
        while len(live):
            a, b = x[live], y[live]
            r = self.merges.find(a << 20 | b)
            # of equal ranks the leftmost merge comes first
            broken = (r >= 0) & (r < until_x[live]) & (r <= until_y[live])
            ok[live[broken]] = False
            ra, rb = self.rank[a], self.rank[b]
            go = ~broken & ((ra >= 0) | (rb >= 0))
            live, a, b, ra, rb = live[go], a[go], b[go], ra[go], rb[go]
            first = ra > rb
            at = live[first]
            x[at], until_x[at] = self.right[a[first]], ra[first]
            at = live[~first]
            y[at], until_y[at] = self.left[b[~first]], rb[~first]
        return ok

    def encode(self, data: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(token ids of all words one after the other, tokens of each word) of words in a byte array."""
        order = np.argsort(-size, kind="stable")  # at each step the words still open are the first ones
        start, size = start[order], size[order]
        most, n = int(size[0]), len(size)
        tokens = np.empty((most + 1, n), np.int32)
        node, column = np.zeros(n, np.int64), np.arange(n)
        tokens[0] = 0
        for p in range(1, most + 1):
            k = int(np.searchsorted(-size, -p, "right"))
            symbol = data[start[:k] + (p - 1)].astype(np.int64) + 256 * (size[:k] == p)
            node[:k] = reached = self._next(node[:k], symbol)
            token = self.longest[reached]
            open_ = column[:k]
            while True:
                begin = p - self.length[token[open_]]
                ok = (begin == 0) | self.follows(tokens[begin, open_].astype(np.int64), token[open_])
                open_ = open_[~ok]
                if not len(open_):
                    break
                token[open_] = self.shorter[token[open_]]
            tokens[p, :k] = token
        at, live, rounds = size.copy(), column, []
        count = np.zeros(n, np.int64)
        while len(live):
            token = tokens[at[live], live]
            rounds.append((live, token))
            count[live] += 1
            at[live] -= self.length[token]
            live = live[at[live] > 0]
        counts = np.empty(n, np.int64)
        counts[order] = count
        end = np.cumsum(counts)[order]
        out = np.empty(int(counts.sum()), "<u4")
        for i, (live, token) in enumerate(rounds):
            out[end[live] - 1 - i] = token
        return out, counts


class TextEncoder:
    """Ids of whole texts: split into words, equal words of a group encoded once."""

    def __init__(self, path: str):
        self.table = MergeTable(path)
        self.machine, self.single = Lockstep(self.table), Transducer(self.table)

    def batch(self, texts: Iterable[str | None]) -> Iterator[np.ndarray]:
        """Each text's ids (unsigned 32-bit), texts in groups of about GROUP_BYTES characters."""
        group: list[list[str | int]] = []
        size = 0
        for text in texts:
            pieces = self._pieces(text or "")
            if len(text or "") > GROUP_BYTES:
                yield from self._group(group)
                group, size = [], 0
                yield np.concatenate([ids for p in pieces for ids in self._group([[p]])])
                continue
            group.append(pieces)
            size += len(text or "")
            if size > GROUP_BYTES:
                yield from self._group(group)
                group, size = [], 0
        yield from self._group(group)

    def ids(self, text: str | None) -> np.ndarray:
        return next(self.batch([text]))

    def _pieces(self, text: str) -> list[str | int]:
        """Special ids and the texts between them, a long one in windows."""
        parts = self.table.split.split(text) if "<|" in text else [text]
        out: list[str | int] = []
        for part in parts:
            if part in self.table.special:
                out.append(self.table.special[part])
            elif len(part) > GROUP_BYTES:
                out += windows(part, GROUP_BYTES)
            else:
                out.append(part)
        return out

    def _group(self, group: list[list[str | int]]) -> list[np.ndarray]:
        texts = [p for pieces in group for p in pieces if isinstance(p, str)]
        parts = iter(self._encoded(texts))
        # the pieces' ids in order; a text that is one piece needs no joining
        own = [[np.array([p], "<u4") if isinstance(p, int) else next(parts) for p in pieces] for pieces in group]
        return [ids[0] if len(ids) == 1 else np.concatenate(ids) for ids in own]

    def _encoded(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of texts without special strings."""
        lower, kinds = code_tables()
        # NFC, then lower case; one capital has two small code points
        texts = [t if t.isascii() else unicodedata.normalize("NFC", t).replace("\u0130", "i\u0307") for t in texts]
        until = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts)))
        codes = lower[np.frombuffer("\n".join([*texts, ""]).encode("utf-32-le"), "<u4")]
        kind = kinds[codes]
        begins = np.empty(len(codes), bool)
        if not len(codes):
            return []
        begins[0] = kind[0] > 0
        begins[1:] = (kind[1:] > 0) & ((kind[1:] != kind[:-1]) | (kind[1:] == NUMBER))
        self._contractions(codes, kind, begins)
        keep = np.flatnonzero(kind)
        if not len(keep):
            return [np.zeros(0, "<u4")] * len(texts)
        word_at = np.flatnonzero(begins)
        small = codes[keep]
        data = np.frombuffer(small.tobytes().decode("utf-32-le").encode(), np.uint8)
        first = np.flatnonzero(begins[keep])  # of each word, among the kept code points
        if len(data) != len(keep):
            width = 1 + (small > 0x7F) + (small > 0x7FF) + (small > 0xFFFF)
            first = (np.cumsum(width) - width)[first]
        offsets = np.append(first, len(data)).astype(np.int32)
        words = pa.BinaryArray.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(data)]).dictionary_encode()
        ids, counts = self._words(words.dictionary)
        index = words.indices.to_numpy()
        count = counts[index]
        end = np.cumsum(count)
        begin = (np.cumsum(counts) - counts)[index]
        flat = ids[np.repeat(begin - end + count, count) + np.arange(end[-1])]
        cut = np.concatenate(([0], end))[np.searchsorted(word_at, until)]
        return [flat[a:b] for a, b in zip([0, *cut[:-1].tolist()], cut.tolist(), strict=True)]

    @staticmethod
    def _contractions(codes: np.ndarray, kind: np.ndarray, begins: np.ndarray) -> None:
        """Join a lone apostrophe with the ending that follows it, and begin a word after that."""
        at = np.flatnonzero((codes[:-1] == 39) & begins[:-1] & (kind[1:] == LETTER))
        if not len(at):
            return
        padded = np.append(codes, [0, 0])
        a, b = padded[at + 1], padded[at + 2]
        size = np.where(np.isin(a, [ord(c) for c in SHORT_ENDINGS]), 1, 0)
        for x, y in LONG_ENDINGS:
            size[(a == ord(x)) & (b == ord(y))] = 2
        at, size = at[size > 0], size[size > 0]
        begins[at + 1] = False
        after = at + 1 + size
        inside = after < len(codes)
        after = after[inside]
        begins[after[kind[after] == LETTER]] = True

    def _words(self, words: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, tokens of each word) of distinct words."""
        offsets = np.frombuffer(words.buffers()[1], np.int32, len(words) + 1, 4 * words.offset).astype(np.int64)
        data = np.frombuffer(words.buffers()[2], np.uint8)
        start, size = offsets[:-1], np.diff(offsets)
        wide = np.flatnonzero(size > WIDE)
        counts = np.zeros(len(words), np.int64)
        found: list[tuple[np.ndarray, np.ndarray]] = []
        short = np.flatnonzero(size <= WIDE)
        for i in range(0, len(short), LOCKSTEP_WORDS):
            part = short[i : i + LOCKSTEP_WORDS]
            ids, counts[part] = self.machine.encode(data, start[part], size[part])
            found.append((part, ids))
        symbols = self.table.symbols
        for w in wide:
            own = [symbols[b] for b in data[start[w] : start[w] + size[w]]]
            ids = [*self.single.push(own[:-1]), *self.single.finish(own[-1])]
            counts[w] = len(ids)
            found.append((np.array([w]), np.array(ids, "<u4")))
        if not len(wide):
            return np.concatenate([ids for _, ids in found]), counts
        begin = np.cumsum(counts) - counts
        out = np.empty(int(counts.sum()), "<u4")
        for part, ids in found:
            n = counts[part]
            out[np.repeat(begin[part] - np.cumsum(n) + n, n) + np.arange(len(ids))] = ids
        return out, counts


def windows(text: str, size: int) -> Iterator[str]:
    """Consecutive parts of about ``size`` characters, cut before ASCII white space only."""
    start = 0
    while len(text) - start > size and (m := SPACE.search(text, start + size)):
        yield text[start : m.start()]
        start = m.start()
    yield text[start:]


class TokenDecoder:
    """Incremental decoder: blocks of ids in, bytes of UTF-8 text out.

    ``joined``: the tokens' own strings with a space between, as the library's
    decode() gives for a file without a decoder; state: whether a token came
    before. Otherwise byte symbols become characters as soon as they form one
    (undecodable bytes as U+FFFD) and a word end becomes a space; state: the
    bytes of an unfinished character. Unknown ids are left out.
    """

    def __init__(self, table: MergeTable, joined: bool = False):
        self.joined, self.began = joined, False
        self.utf8 = codecs.getincrementaldecoder("utf-8")("replace")
        self.special = {*table.special.values()}
        self.pieces = _token_bytes(table, joined)

    def push(self, ids: np.ndarray | Iterable[int]) -> bytes:
        ids = np.asarray(ids, np.int64)
        known = (ids >= 0) & (ids < len(self.pieces))
        ids = ids if known.all() else ids[known]
        if self.joined:
            out = _joined_bytes(self.pieces.take(pa.array(ids)))
            out, self.began = out if self.began else out[1:], self.began or bool(len(out))
            return out
        made = []
        for i in ids.tolist():
            if i in self.special:
                made.append(self.utf8.decode(b"", True))
            made.append(self.utf8.decode(self.pieces[i].as_py() or b""))
        return "".join(made).encode()

    def finish(self) -> bytes:
        return self.utf8.decode(b"", True).encode()


@functools.lru_cache(4)
def _token_bytes(table: MergeTable, joined: bool) -> pa.BinaryArray:
    """What each id stands for; null for an unknown one. Joined: a space and the token's own string."""
    byte = {c: b for b, c in enumerate(table.symbols)}
    out: list[bytes | None] = [None] * (max(table.string) + 1)
    special = {*table.special.values()}
    for i, t in table.string.items():
        if joined or i in special:
            out[i] = (" " * joined + t).encode()
        else:
            ends = bool(table.end) and t.endswith(table.end)
            out[i] = bytes(byte[c] for c in (t[: -len(table.end)] if ends else t)) + b" " * ends
    return pa.array(out, pa.binary())


def _joined_bytes(pieces: pa.BinaryArray) -> bytes:
    offsets = np.frombuffer(pieces.buffers()[1], np.int32, len(pieces) + 1, 4 * pieces.offset)
    return pieces.buffers()[2].slice(int(offsets[0]), int(offsets[-1] - offsets[0])).to_pybytes() if len(pieces) else b""


_encoders: dict[str, TextEncoder] = {}


def encoder(path: str) -> TextEncoder:
    """The worker's encoder of a file: its tables, of fixed size, are made once."""
    if path not in _encoders:
        _encoders[path] = TextEncoder(path)
    return _encoders[path]


def encoded_rows(enc: TextEncoder, batches: Iterable[pa.RecordBatch], width: int, size: int = 1000) -> Iterator[list[tuple[tuple, np.ndarray]]]:
    """Lists of (row of the first ``width`` columns, ids of the next column's text), texts grouped across batches."""
    rows: deque[tuple] = deque()

    def texts() -> Iterator[str | None]:
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns[:width]]
            for i, t in enumerate(batch.column(width)):
                rows.append(tuple(c[i] for c in columns))
                yield t.as_py()

    done = []
    for ids in enc.batch(texts()):
        done.append((rows.popleft(), ids))
        if len(done) == size:
            yield done
            done = []
    if done:
        yield done
    release_memory()


def bpe_round_trip(docs: DataFrame, path: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",), ids: bool = False) -> DataFrame:
    """keep's columns, n_tokens, ids_sha256, decoded_sha256 and, with ids, the ids of every text.

    One pass over the input without a shuffle; a lost task is just run again.
    """
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for part in encoded_rows(enc, batches, len(keep)):
            count, first, second = [], [], []
            for _, values in part:
                count.append(len(values))
                first.append(hashlib.sha256(values).hexdigest())
                decoder, digest = TokenDecoder(enc.table, joined=True), hashlib.sha256()
                for i in range(0, len(values), DECODE_IDS):
                    digest.update(decoder.push(values[i : i + DECODE_IDS]))
                second.append(digest.hexdigest())
            kept = [pa.array([row[i] for row, _ in part], kinds[i]) for i in range(len(keep))]
            out = [*kept, pa.array(count, pa.int64()), pa.array(first, pa.string()), pa.array(second, pa.string())]
            if ids:
                out.append(pa.array([values.astype(np.int64) for _, values in part], pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays(out, names=names)

    rows = docs.select(*keep, F.col(text).cast("string").alias("text"))
    names = [*keep, "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * ids
    kinds = [to_arrow_type(rows.schema[c].dataType) for c in keep]
    schema = ", ".join([*[f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep], "n_tokens bigint", "ids_sha256 string", "decoded_sha256 string"] + ["ids array<bigint>"] * ids)
    return rows.mapInArrow(run, schema)


def decoded_text(ids: Column, path: str) -> Column:
    """Column of texts that TokenDecoder makes of a column of id lists."""

    @F.pandas_udf("string")
    def run(batch):
        table = encoder(path).table

        def one(values):
            decoder = TokenDecoder(table)
            return (decoder.push(values) + decoder.finish()).decode()

        return batch.map(one, na_action="ignore")

    return run(ids)
