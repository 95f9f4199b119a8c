"""A deterministic automaton of byte-pair tokenizations, built merge by merge.

The automaton reads tokens. It starts as one state with a loop for every byte, so it accepts every
way to spell a text in bytes. Each merge (a, b) is then applied as a gadget: the state that ``a``
leads to is copied without its arc ``b``, the arcs ``a`` go to the copy, and every state with an arc
``a`` gets an arc ``ab`` to where ``b`` led. After the last merge exactly one path spells each
text: its tokenization. All arcs of a token lead to one state, so a state is named by the token
before it.

A copied state stores what it differs in from its original, the arc it lost and when; arcs that
came later follow from the arcs of their first parts. ``arc`` reads such a state through these
tables, and the answers are kept as a flat transition table of bounded size.
"""

from __future__ import annotations

import json
from array import array

from tickframe.llm.byte_model import byte_letters
from tickframe.llm.workers import worker_cache

TABLE_ENTRIES = 1 << 18
START = -1


class MergeAutomaton:
    """``merges``: pairs of byte strings in the order of their rank. ``ids``: token -> number.

    Every part of a merge is a byte or the result of an earlier merge, and results are distinct;
    otherwise the order of merging would not be the order of ranks, and ValueError is raised.
    """

    def __init__(self, merges: list[tuple[bytes, bytes]], ids: dict[bytes, int]):
        self.labels = [bytes([b]) for b in range(256)]
        number = {label: k for k, label in enumerate(self.labels)}
        n = 256 + len(merges)
        self.left, self.right = array("i", [START]) * n, array("i", [START]) * n
        self.born = array("i", [0]) * n  # the merge that made the token, from 1 on
        self.lost: list[dict[int, int] | None] = [None] * n  # arc -> the merge that took it
        self.first_loss = array("i", [n]) * n
        self.alive = [True] * 256
        for k, (a, b) in enumerate(merges, 1):
            if a not in number or b not in number or a + b in number:
                raise ValueError("merges must build on bytes and earlier merges, each result once")
            number[a + b] = c = len(self.labels)
            self.labels.append(a + b)
            self._merge(k, number[a], number[b], c)
        self.ids = [ids.get(label, -1) for label in self.labels]
        if min(self.ids) < 0:
            raise ValueError("every byte and every merge must have a number")
        self.lengths = [len(label) for label in self.labels]
        self.young: dict[int, bool] = {}
        self.old: dict[int, bool] = {}
        self.trie, self.token_at, self.shorter = _trie(self.labels, self.alive)

    def _merge(self, k: int, a: int, b: int, c: int) -> None:
        self.left[c], self.right[c], self.born[c] = a, b, k
        # A merge whose pair no path holds any more changes nothing: its token is never made.
        live = self.alive[a] and self.alive[b] and self._has_arc(a, k, b)
        self.alive.append(live)
        if live:
            if self.lost[a] is None:
                self.lost[a], self.first_loss[a] = {}, k
            self.lost[a][b] = k

    def _has_arc(self, token: int, version: int, arc: int) -> bool:
        """Whether the state after ``token``, as the merges before ``version`` left it, has ``arc``."""
        while token != START:
            lost, made = self.lost[token], self.born[arc]
            if lost is not None:
                at = lost.get(arc)
                if at is not None and at < version:
                    return False
                first = self.first_loss[token]
                if first < version and first <= made:
                    # The copy was there when the arc was made: it has the arc if it had the first part.
                    version, arc = min(version, made + 1), self.left[arc]
                    continue
            # An arc of the state that the copy was made from.
            token, version = self.right[token], self.born[token]
        return True

    def arc(self, state: int, token: int) -> bool:
        """Whether ``token`` may follow the state; it then leads to the state named ``token``."""
        if state == START:
            return True
        key = state << 20 | token
        found = self.young.get(key)
        if found is None:
            found = self.old.get(key)
            if found is None:
                found = self._has_arc(state, len(self.labels), token)
            self.young[key] = found
            if len(self.young) > TABLE_ENTRIES:
                self.young, self.old = {}, self.young
        return found

    def path(self, data: bytes) -> list[int]:
        """The tokens of the one path that spells ``data``.

        At each position the longest arcs are tried first. A prefix has one path, so a position
        from which no arc leads on is never entered again, and the work is linear in ``data``.
        """
        n, at, here = len(data), 0, START
        step, token_at, shorter, arc, lengths = self.trie.get, self.token_at, self.shorter, self.arc, self.lengths
        out, dead = [], set()
        while at < n:
            node, token, i = 0, START, at
            while i < n:
                node = step(node << 8 | data[i])
                if node is None:
                    break
                if token_at[node] >= 0:
                    token = token_at[node]
                i += 1
            while True:
                if token == START:  # no arc left: take back the one before
                    dead.add(at)
                    token = out.pop()
                    at -= lengths[token]
                    here = out[-1] if out else START
                elif at + lengths[token] not in dead and arc(here, token):
                    break
                token = shorter[token]
            out.append(token)
            at += lengths[token]
            here = token
        return out

    def encode(self, data: bytes) -> tuple[bytes, bytes]:
        """(numbers of the tokens as little-endian unsigned 32-bit numbers, their arc labels joined)."""
        tokens = self.path(data)
        return array("I", [self.ids[t] for t in tokens]).tobytes(), b"".join([self.labels[t] for t in tokens])


def _trie(labels: list[bytes], alive: list[bool]) -> tuple[dict[int, int], list[int], array]:
    """Of the tokens that can occur: (node << 8 | byte -> node, token that ends at a node or -1,
    the longest other token that begins a token or -1)."""
    trie: dict[int, int] = {}
    token_at = [-1]
    shorter = array("i", [-1]) * len(labels)
    for token in sorted(range(len(labels)), key=lambda k: len(labels[k])):
        if alive[token]:
            node = 0
            for b in labels[token]:
                step = node << 8 | b
                node = trie.get(step)
                if node is None:
                    node = trie[step] = len(token_at)
                    token_at.append(-1)
                elif token_at[node] >= 0:
                    shorter[token] = token_at[node]
            token_at[node] = token
    return trie, token_at, shorter


def label_bytes(token: str, letters: dict[str, int]) -> bytes:
    """The bytes a token stands for: those of its letters, or its own text where it has others."""
    return bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()


@worker_cache(1)
def automaton(path: str) -> MergeAutomaton:
    """The automaton of a byte-level tokenizer file."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    odd = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
    if model["type"] != "BPE" or any(model.get(k) for k in odd):
        raise ValueError("only plain byte-pair merging can be compiled")
    letters = byte_letters()
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    merges = [(label_bytes(a, letters), label_bytes(b, letters)) for a, b in pairs]
    return MergeAutomaton(merges, {label_bytes(t, letters): i for t, i in model["vocab"].items()})


@worker_cache(1)
def arc_labels(path: str) -> dict[int, bytes]:
    """Number -> bytes of every token of the file, added ones included."""
    with open(path, encoding="utf-8") as f:
        described = json.load(f)
    letters = byte_letters()
    out = {i: label_bytes(t, letters) for t, i in described["model"]["vocab"].items()}
    return out | {a["id"]: label_bytes(a["content"], letters) for a in described["added_tokens"]}
