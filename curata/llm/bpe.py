"""Byte-level BPE by a tokenization automaton (operator 3).

``BpeAutomaton.compile`` starts from the trivial automaton (one state, one looping arc
for each byte) and applies one merge gadget for every merge, in order.  The gadget of
the merge (a, b) -> ab

* gives every arc labelled ``a`` a fresh target: its old target without the ``b`` arc,
  because after it ``a b`` would have been merged; and
* adds, beside every arc labelled ``a``, an arc labelled ``ab`` that leads to where the
  ``b`` arc led.

All arcs with one label share their target, so the state after a token is a function of
the token, and a state is its parent state without one arc.  What the gadgets leave is a
deterministic automaton that accepts exactly the token sequences that BPE can produce.
Encoding a pre-split word is a walk: from the state after each prefix, only one token
that ends at the next position has an arc.  Decoding emits the labels of the arcs.

Words are split (GPT-2's public pattern) and walked for whole batches at once.
"""

from __future__ import annotations

import json
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa

from curata.llm.common import KEPT
from curata.llm.words import span_hashes

U = np.uint64
SPECIAL = "<|endoftext|>"
#: Code points with Unicode's White_Space property.
WHITE = [*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
#: Endings that the pattern keeps with their apostrophe.
ENDINGS = ["s", "t", "re", "ve", "m", "ll", "d"]
SPACE_CLASS, LETTER, NUMBER, OTHER = range(4)


@lru_cache(1)
def classes() -> np.ndarray:
    """The class of every code point: white space, letter, number, other."""
    out = np.full(0x110000, OTHER, np.uint8)
    for c in range(0x110000):
        kind = unicodedata.category(chr(c))[0]
        if kind == "L":
            out[c] = LETTER
        elif kind == "N":
            out[c] = NUMBER
    out[WHITE] = SPACE_CLASS
    return out


def byte_alphabet() -> dict[str, int]:
    """The printable stand-in characters of byte-level vocabularies: char -> byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def presplit(texts: list[str]):
    """Split texts as the pattern does.

    Returns (raw UTF-8 bytes, starts, ends, tokens a text, mask of special tokens)."""
    joined = "".join(texts)
    code = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    raw = np.frombuffer(joined.encode("utf-8"), np.uint8)
    lengths = np.array([len(t) for t in texts], np.int64)
    edge = np.concatenate([[0], np.cumsum(lengths)])
    n = len(code)
    if not n:
        z = np.zeros(0, np.int64)
        return raw, z, z, np.zeros(len(texts), np.int64), np.zeros(0, bool)
    cls = classes()[code]
    cut = np.zeros(n + 1, bool)  # a new segment starts here: texts and special tokens
    cut[edge] = True
    special = []
    if SPECIAL in joined:
        for t, base in zip(texts, edge):
            at = t.find(SPECIAL)
            while at >= 0:
                special.append(base + at)
                at = t.find(SPECIAL, at + len(SPECIAL))
        for s in special:
            cut[[s, s + len(SPECIAL)]] = True
    run = cut[:n].copy()
    run[1:] |= cls[1:] != cls[:-1]
    starts = np.flatnonzero(run)
    stops = np.append(starts[1:], n)
    kind = cls[starts]
    space = kind == SPACE_CLASS
    followed = space & ~cut[stops]  # something other than white space follows in the segment
    joins = followed & (code[np.maximum(stops - 1, 0)] == 0x20)
    begin = np.zeros(n + 1, bool)
    begin[starts] = True
    begin[stops[followed] - 1] = True  # the last white space stands alone or joins what follows
    begin[stops[joins]] = False
    # endings after an apostrophe that starts a token
    lone = np.flatnonzero((code[:n] == 0x27) & begin[:n])
    if len(lone):
        for ending in ENDINGS:
            at = lone[lone + len(ending) < n]
            ok = np.ones(len(at), bool)
            for i, c in enumerate(ending):
                ok &= (code[at + 1 + i] == ord(c)) & ~cut[at + 1 + i]
            at = at[ok]
            begin[at + 1] = False
            if len(ending) == 2:
                begin[at + 2] = False
            begin[at + 1 + len(ending)] = True
    if special:
        for s in special:
            begin[s:s + len(SPECIAL)] = False
            begin[s] = True
    begin[n] = False
    tok = np.flatnonzero(begin)
    mask = np.zeros(len(tok), bool)
    if special:
        mask[np.searchsorted(tok, special)] = True
    width = 1 + (code >= 0x80).astype(np.int64) + (code >= 0x800) + (code >= 0x10000)
    at_byte = np.concatenate([[0], np.cumsum(width)])
    b = at_byte[tok]
    e = np.append(b[1:], at_byte[n])
    counts = np.diff(np.searchsorted(tok, edge))
    return raw, b, e, counts, mask


class BpeAutomaton:
    """The automaton and its tables; build it with ``BpeAutomaton.compile(path)``."""

    def __init__(self, labels, left, right, time):
        self.labels = labels            # token -> the bytes that its arcs emit
        self.left, self.right = left, right  # token -> its two parts, -1 for a byte
        self.time = time                # token -> number of its merge gadget, -1 for a byte
        self.ids = {x: i for i, x in enumerate(labels) if x}
        self.longest = max(map(len, labels))
        self._gadgets()
        self._trie()

    @classmethod
    def compile(cls, path: str) -> BpeAutomaton:
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        alphabet = byte_alphabet()
        vocab = model["vocab"]
        size = max(vocab.values()) + 1
        labels = [b""] * size
        for name, i in vocab.items():
            labels[i] = bytes(alphabet[c] for c in name)
        left, right, time = (np.full(size, -1, np.int64) for _ in range(3))
        for k, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            ab = vocab[a + b]
            left[ab], right[ab], time[ab] = vocab[a], vocab[b], k
        return cls(labels, left, right, time)

    def _gadgets(self):
        """Apply the merge gadgets in order.

        ``state[x]`` is the state that all arcs labelled ``x`` lead to.  State s > 0 is
        ``parent[s]`` without the arc ``removed[s]``; state 0 has every arc."""
        size = len(self.labels)
        state = [0] * size
        parent, removed = [0], [-1]
        order = np.flatnonzero(self.time >= 0)[np.argsort(self.time[self.time >= 0], kind="stable")]
        for ab in order.tolist():
            a, b = int(self.left[ab]), int(self.right[ab])
            state[ab] = state[b]           # where the b arc led
            parent.append(state[a])        # the old target of the a arcs ...
            removed.append(b)              # ... without its b arc
            state[a] = len(parent) - 1
        self.state, self.parent, self.removed = map(np.array, (state, parent, removed))
        # The removed arcs, by the label that leads to the state: a hash table (a, b) -> time.
        bits = max(18, int(4 * len(order)).bit_length())
        self._shift = U(64 - bits)
        keys = self.left[order] * size + self.right[order]
        table = np.full(1 << bits, -1, np.int64)
        times = np.zeros(1 << bits, np.int64)
        slot, todo = self._slot(keys), np.arange(len(keys))
        while len(todo):
            free = table[slot[todo]] < 0
            first = np.unique(slot[todo[free]], return_index=True)[1]
            put = todo[free][first]
            table[slot[put]], times[slot[put]] = keys[put], self.time[order][put]
            todo = np.setdiff1d(todo, put)
            slot[todo] = (slot[todo] + 1) & ((1 << bits) - 1)
        self._keys, self._times, self._size = table, times, size

    def _slot(self, key):
        return ((key.astype(U) * U(0x9E3779B97F4A7C15)) >> self._shift).astype(np.int64)

    def _removal(self, a, b):
        """When the gadgets took the arc b from the state after a; -1: never."""
        key = a * self._size + b
        slot = self._slot(key)
        out = np.full(len(key), -1, np.int64)
        todo = np.arange(len(key))
        mask = len(self._keys) - 1
        while len(todo):
            found = self._keys[slot[todo]]
            hit = found == key[todo]
            out[todo[hit]] = self._times[slot[todo[hit]]]
            todo = todo[~hit & (found >= 0)]
            slot[todo] = (slot[todo] + 1) & mask
        return out

    def has_arc(self, last: np.ndarray, token: np.ndarray) -> np.ndarray:
        """Has the state after ``last`` an arc ``token``?  (``last`` -1: the start.)

        A state lost an arc by a gadget on its own label, or inherits the loss from the
        state of its label's right part if that was earlier than the label itself.  An arc
        is lost with the left part that it was added beside, if that went earlier."""
        ok = np.ones(len(last), bool)
        never = np.iinfo(np.int64).max
        rows = np.flatnonzero(last >= 0)
        a, before = last[rows], np.full(len(rows), never)
        while len(rows):
            sub = np.arange(len(rows))
            z, until = token[rows], np.full(len(rows), never)
            while len(sub):
                c = self._removal(a[sub], z[sub])
                ok[rows[sub[(c >= 0) & (c < before[sub]) & (c <= until[sub])]]] = False
                until[sub], z[sub] = self.time[z[sub]], self.left[z[sub]]
                sub = sub[z[sub] >= 0]
            before, a = self.time[a], self.right[a]
            keep = (a >= 0) & ok[rows]
            rows, a, before = rows[keep], a[keep], before[keep]
        return ok

    def _trie(self):
        """The labels' trie as one sorted table: (node, byte) -> node, node -> token."""
        nodes: dict[bytes, int] = {b"": 0}
        keys, targets, token = [], [], [-1]
        for x, i in self.ids.items():
            at = 0
            for k in range(1, len(x) + 1):
                p = x[:k]
                if p not in nodes:
                    nodes[p] = len(token)
                    keys.append(at * 256 + p[-1])
                    targets.append(len(token))
                    token.append(-1)
                at = nodes[p]
            token[at] = i
        order = np.argsort(keys)
        self._arc = np.array(keys)[order]
        self._to = np.array(targets)[order]
        self._token = np.array(token)

    def _step(self, node, byte):
        key = node * 256 + byte
        at = np.minimum(np.searchsorted(self._arc, key), len(self._arc) - 1)
        return np.where(self._arc[at] == key, self._to[at], -1)

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(all ids in order, ids a word): the automaton's only path that spells each."""
        owners, tokens, todo = [], [], []
        whole = [(i, x) for i, w in enumerate(words) if (x := self.ids.get(w)) is not None]
        if whole:  # a merge's own result is reached by one arc
            own, ids = zip(*whole)
            owners.append(np.array(own))
            tokens.append(np.array(ids))
        for i, w in enumerate(words):
            if w in self.ids:
                continue
            if len(w) > 48:
                tokens.append(self._walk_long(w))
                owners.append(np.full(len(tokens[-1]), i))
            else:
                todo.append(i)
        todo.sort(key=lambda i: len(words[i]))
        for lo in range(0, len(todo), 20_000):
            part = todo[lo:lo + 20_000]
            own, ids = self._walk([words[i] for i in part])
            owners.append(np.array(part)[own])
            tokens.append(ids)
        if not owners:
            return np.zeros(0, np.int64), np.zeros(len(words), np.int64)
        owner, token = np.concatenate(owners), np.concatenate(tokens)
        return token[np.argsort(owner, kind="stable")], np.bincount(owner, minlength=len(words))

    def _walk(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(owner, token) of every arc walked, in the order of each word's tokens."""
        n, length = len(words), np.array([len(w) for w in words])
        wide = int(length.max())
        raw = np.zeros((n, wide), np.int64)
        flat = np.frombuffer(b"".join(words), np.uint8)
        raw[np.arange(wide)[None, :] < length[:, None]] = flat
        last = np.full((n, wide + 1), -2, np.int64)  # the token that ends at a position
        last[:, 0] = -1
        start = np.zeros((n, wide + 1), np.int64)
        for j in range(wide):  # tokens that start at j, for all words
            rows = np.flatnonzero(length > j)
            node, from_ = np.zeros(len(rows), np.int64), last[rows, j]
            for end in range(j, min(wide, j + self.longest)):
                node = self._step(node, raw[rows, end])
                live = (node >= 0) & (length[rows] > end)
                rows, node, from_ = rows[live], node[live], from_[live]
                if not len(rows):
                    break
                token = self._token[node]
                may = np.flatnonzero((token >= 0) & (last[rows, end + 1] == -2))
                may = may[self.has_arc(from_[may], token[may])]
                last[rows[may], end + 1] = token[may]
                start[rows[may], end + 1] = j
        at, owners, tokens = length.copy(), [], []
        rows = np.arange(n)
        while len(rows):
            owners.append(rows)
            tokens.append(last[rows, at[rows]])
            at[rows] = start[rows, at[rows]]
            rows = rows[at[rows] > 0]
        return np.concatenate(owners[::-1]), np.concatenate(tokens[::-1])

    def _walk_long(self, w: bytes) -> np.ndarray:
        """One long word: the same walk with a memo of the arcs, in time linear in it."""
        n = len(w)
        last, start = [-1] * (n + 1), [0] * (n + 1)
        memo: dict[tuple[int, int], bool] = {}
        done = [False] * (n + 1)
        for j in range(n):
            for end in range(j + 1, min(n, j + self.longest) + 1):
                if done[end]:
                    continue
                token = self.ids.get(w[j:end])
                if token is None:
                    continue
                key = (last[j], token)
                ok = memo.get(key)
                if ok is None:
                    ok = memo[key] = bool(self.has_arc(np.array([last[j]]), np.array([token]))[0])
                if ok:
                    last[end], start[end], done[end] = token, j, True
        ids, at = [], n
        while at:
            ids.append(last[at])
            at = start[at]
        return np.array(ids[::-1])


class BatchEncoder:
    """Encodes whole batches of texts; known words come from a bounded table.

    A full table keeps the half of its words that stood in most batches, halving their
    counts: words that come up again and again are walked once, rare ones make room."""

    def __init__(self, automaton: BpeAutomaton, special_id: int | None, most_words: int = 2_000_000):
        self.automaton, self.special_id, self.most = automaton, special_id, most_words
        self.hash = np.zeros(0, U)             # sorted
        self.first = np.zeros(0, np.int64)     # where the word's ids start in the pool
        self.size = np.zeros(0, np.int32)
        self.hits = np.zeros(0, np.int32)      # batches that the word stood in
        self.pool = np.zeros(0, np.int32)

    def _forget(self):
        """Leave at most half of the table: the words with most hits."""
        keep = np.flatnonzero(self.hits > np.partition(self.hits, -(self.most // 2 + 1))[-(self.most // 2 + 1)])
        size = self.size[keep]
        first = np.cumsum(size, dtype=np.int64) - size
        self.pool = self.pool[np.repeat(self.first[keep] - first, size) + np.arange(int(size.sum()))]
        self.hash, self.first, self.size, self.hits = self.hash[keep], first, size, self.hits[keep] >> 1

    def _learn(self, hashes, words):
        ids, size = self.automaton.encode_words(words)
        first = len(self.pool) + np.cumsum(size) - size
        self.pool = np.concatenate([self.pool, ids.astype(np.int32)])
        h = np.concatenate([self.hash, hashes])
        order = np.argsort(h, kind="stable")
        self.hash = h[order]
        self.first = np.concatenate([self.first, first])[order]
        self.size = np.concatenate([self.size, size.astype(np.int32)])[order]
        self.hits = np.concatenate([self.hits, np.zeros(len(size), np.int32)])[order]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(all ids in order, ids a text)."""
        raw, b, e, counts, special = presplit(texts)
        if not len(b):
            return np.zeros(0, np.int64), counts
        hashes = span_hashes(raw, b, e)
        if special.any():
            hashes[special] = U(1)  # no word: the special token itself
        distinct, where, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.hash) > self.most:
            self._forget()
        at = np.searchsorted(self.hash, distinct)
        at_ok = np.minimum(at, max(len(self.hash) - 1, 0))
        known = self.hash[at_ok] == distinct if len(self.hash) else np.zeros(len(distinct), bool)
        new = np.flatnonzero(~known)
        if len(new):
            data = raw.tobytes()
            spans = zip(b[where[new]].tolist(), e[where[new]].tolist(), special[where[new]].tolist())
            words = [data[x:y] for x, y, s in spans if not s]
            if special[where[new]].any():
                self.pool = np.append(self.pool, np.int32(self.special_id))
                k = int(np.searchsorted(self.hash, U(1)))
                self.hash = np.insert(self.hash, k, U(1))
                self.first = np.insert(self.first, k, len(self.pool) - 1)
                self.size = np.insert(self.size, k, 1)
                self.hits = np.insert(self.hits, k, 0)
                new = new[~special[where[new]]]
            if words:
                self._learn(distinct[new], words)
            at = np.searchsorted(self.hash, distinct)
        self.hits[at] += 1
        row = at[inverse]
        size = self.size[row]
        total = np.concatenate([[0], np.cumsum(size)])
        spread = np.repeat(self.first[row] - total[:-1], size) + np.arange(total[-1])
        ids = self.pool[spread]
        edge = np.concatenate([[0], np.cumsum(counts)])
        return ids, np.diff(total[edge])


@lru_cache(2)
def encoder(path: str, most_words: int = 2_000_000) -> BatchEncoder:
    """The worker's encoder for a vocabulary file (compiled once a Python worker)."""
    automaton = BpeAutomaton.compile(path)
    with open(path, encoding="utf-8") as f:
        added = {t["content"]: t["id"] for t in json.load(f)["added_tokens"]}
    return BatchEncoder(automaton, added.get(SPECIAL), most_words)


@lru_cache(2)
def emitted(path: str) -> list[bytes]:
    """What an arc emits, by token id."""
    automaton = encoder(path).automaton
    labels = list(automaton.labels)
    special = encoder(path).special_id
    if special is not None:
        labels += [b""] * (special + 1 - len(labels))
        labels[special] = SPECIAL.encode()
    return labels


def _release():
    encoder.cache_clear()
    emitted.cache_clear()


KEPT["bpe"] = _release


def decode(ids: list[int], labels: list[bytes]) -> str:
    """The text of a sequence of ids; broken UTF-8 becomes U+FFFD."""
    return b"".join(map(labels.__getitem__, ids)).decode("utf-8", "replace")


def text_slices(column: pa.Array, chars: int = 4_000_000):
    """Consecutive slices of a string column of about ``chars`` bytes: (from, texts).

    Nulls come as empty texts.  One very long text makes a slice of its own."""
    texts, size, first = [], 0, 0
    for i, t in enumerate(column):
        t = t.as_py() or ""
        if texts and size + len(t) > chars:
            yield first, texts
            texts, size, first = [], 0, i
        texts.append(t)
        size += len(t)
    if texts:
        yield first, texts
