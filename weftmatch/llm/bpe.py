"""Byte-level BPE from a public vocabulary file, and the tree concatenation of separately encoded parts.

The merge engine is tiktoken's, given the vocabulary and merge order of a tokenizers file. Parts are joined by windows of
ids around the join that are decoded and encoded again, and grow until both sides agree exactly:

- Pieces (what the tokenizer cuts a text into before it merges) are found from left to right without looking back. So a
  window that begins where a piece of the left part begins is cut as the whole text is; as soon as one of its cuts is a cut
  of the right part too, all later ones are. A cut is certain when MARGIN characters behind it are known, or the end is.
- Inside the piece that spans the join, an id sequence is the encoding of its bytes if and only if each two neighbours are
  the encoding of their own bytes. So a window whose outer ids equal those that stood there before fits to both sides.
"""

from __future__ import annotations

import functools
import json
import re

import numpy as np
import regex
import tiktoken

#: The white space and the piece pattern of byte-level BPE.
SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PIECE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_PIECE = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
#: Between a character that isn't white space and one that is, a piece ends wherever the text is cut.
_BREAK = re.compile(rf"[^{SPACE}\x1c-\x1f](?=[ \t\n\r])")
#: Characters of a leaf of the tree, and ids of a window at first on each side of a join.
LEAF_CHARS, WINDOW = 4_096, 8
#: Characters behind a cut of pieces that settle it: contractions look two ahead, white space one.
MARGIN = 3


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _alphabet() -> dict[str, int]:
    """The characters that stand for bytes in vocabulary files: printable Latin-1 for itself, others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    odd = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(odd)}


class ByteBpe:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, byte = spec["model"], _alphabet()
        added = {a["content"]: a["id"] for a in spec["added_tokens"]}
        if model["type"] != "BPE" or spec.get("normalizer") or spec["pre_tokenizer"].get("add_prefix_space") or any(a["lstrip"] or a["rstrip"] or a["single_word"] for a in spec["added_tokens"]):
            raise ValueError(f"{path}: not a plain byte-level BPE")
        ranks = {bytes(byte[c] for c in token): i for token, i in model["vocab"].items() if token not in added}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        made = [model["vocab"][a + b] for a, b in pairs]
        if made != sorted(made):
            raise ValueError(f"{path}: ids do not follow the order of merges")
        self.engine = tiktoken.Encoding("byte_bpe", pat_str=PIECE_PATTERN, mergeable_ranks=ranks, special_tokens=added)
        self.added = added
        self.split = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")") if added else None
        self.special, self.joins, self.windows = set(added.values()), 0, 0
        self.size = np.zeros(max([*ranks.values(), *added.values()]) + 1, np.int64)
        for token, i in ranks.items():
            self.size[i] = len(token)

    def parts(self, text: str) -> list[str]:
        """Text and added tokens in turn: odd places hold added tokens."""
        return self.split.split(text) if self.split and any(a in text for a in self.added) else [text]

    def encode(self, text: str) -> list[int]:
        """As the tokenizers library with add_special_tokens=False; strings of added tokens become their ids."""
        parts = self.parts(text)
        if len(parts) == 1:
            return self.engine.encode_ordinary(text)
        out: list[int] = []
        for k, part in enumerate(parts):
            out += [self.added[part]] if k % 2 else self.engine.encode_ordinary(part)
        return out

    def decode(self, ids: list[int]) -> str:
        """As the tokenizers library with skip_special_tokens=False: bytes that are no UTF-8 become U+FFFD."""
        return self.engine.decode_bytes(ids).decode("utf-8", "replace")

    # ---- tree concatenation ----

    def cuts(self, text: str, size: int) -> list[str]:
        """Parts of a text of about size characters; none begins or ends inside an added token."""
        inside = [(m.start(), m.end()) for m in self.split.finditer(text)] if self.split and any(a in text for a in self.added) else []
        out, at, k = [], 0, 0
        while at < len(text):
            stop = at + size
            while k < len(inside) and inside[k][1] <= stop:
                k += 1
            if k < len(inside) and inside[k][0] < stop:
                stop = inside[k][1]
            out.append(text[at:stop])
            at = stop
        return out

    def encode_tree(self, text: str, leaf: int = LEAF_CHARS) -> list[int]:
        """The ids of a text: leaves are encoded, and joined pairwise, level by level."""
        return self.concatenate([self.encode(x) for x in self.cuts(text, leaf)])

    def concatenate(self, parts: list[list[int]]) -> list[int]:
        while len(parts) > 1:
            parts = [self.join(parts[k], parts[k + 1]) if k + 1 < len(parts) else parts[k] for k in range(0, len(parts), 2)]
        return parts[0] if parts else []

    def join(self, x: list[int], y: list[int]) -> list[int]:
        """The exact encoding of two texts in a row from the ids of each."""
        if not x or not y:
            return x + y
        self.joins += 1
        i = j = WINDOW
        while True:
            i, j = min(i, len(x)), min(j, len(y))
            self.windows += 1
            tail, tail_ids, begun = self._tail(x, i)
            head, head_ids, ended = self._head(y, j)
            if not tail_ids or not head_ids:  # an added token stands at the join
                return x + y
            start = self._last_cut(tail, begun) if tail is not None else None
            if start is None:
                i *= 2
            stop = None
            if start is not None and head is not None:
                stop = self._agree(tail[start:], head, ended)
            if head is None or start is not None and stop is None:
                j *= 2
            if stop is not None:
                break
        left, right = self._ids_of(tail_ids[::-1], tail[start:]), self._ids_of(head_ids, head[:stop])
        cut, middle = len(tail) - start, []
        last = max(m.start() for m in _PIECE.finditer(tail, start)) - start  # the last piece of the left part, and where the first one of the right part ends
        first = cut + next(m.end() for m in _PIECE.finditer(head))
        for m in _PIECE.finditer(tail[start:] + head):  # cut with what follows the window in view; its last cut is where both sides agree
            if m.start() >= cut + stop:
                break
            if (m.start(), m.end()) == (last, first):
                middle += self.join_piece(tail_ids[len(tail_ids) - self._ids_of(tail_ids[::-1], tail[start + last :]) :], head_ids[: self._ids_of(head_ids, head[: first - cut])])
            else:
                middle += self.engine._encode_single_piece(m[0])
        return x[: len(x) - left] + middle + y[right:]

    def join_piece(self, left: list[int], right: list[int]) -> list[int]:
        """Joins the ids of two parts of one piece: the window doubles until its outer ids are those of both sides."""
        i = j = 4
        while True:
            i, j = min(i, len(left)), min(j, len(right))
            self.windows += 1
            window = self.engine._encode_single_piece(self.engine.decode_bytes(left[len(left) - i :] + right[:j]))
            left_fits, right_fits = i == len(left) or window[0] == left[-i], j == len(right) or window[-1] == right[j - 1]
            if left_fits and right_fits:
                return left[: len(left) - i] + window + right[j:]
            i, j = i if left_fits else 2 * i, j if right_fits else 2 * j

    def _tail(self, x: list[int], i: int) -> tuple[str | None, list[int], bool]:
        """The last i ids of a part behind its last added token: their text (None: it begins inside a character), the ids, whether text begins there."""
        ids = x[len(x) - i :]
        special = next((k for k in range(len(ids) - 1, -1, -1) if ids[k] in self.special), None)
        ids = ids if special is None else ids[special + 1 :]
        data = self.engine.decode_bytes(ids)
        begun = special is not None or i == len(x)
        return (None if data and 0x80 <= data[0] < 0xC0 else data.decode()), ids, begun

    def _head(self, y: list[int], j: int) -> tuple[str | None, list[int], bool]:
        """The first j ids of a part before its first added token: their text (None: it ends inside a character), the ids, whether text ends there."""
        ids = y[:j]
        special = next((k for k, t in enumerate(ids) if t in self.special), None)
        ids = ids if special is None else ids[:special]
        try:
            text = self.engine.decode_bytes(ids).decode()
        except UnicodeDecodeError:
            text = None
        return text, ids, special is not None or j == len(y)

    def _last_cut(self, tail: str, begun: bool) -> int | None:
        """The last certain cut of a part before its end, if a place before it is known to be one."""
        at = 0 if begun else next((m.end() for m in _BREAK.finditer(tail)), None)
        if at is None or at == len(tail):
            return None
        return max((m.start() for m in _PIECE.finditer(tail, at) if len(tail) - m.start() >= MARGIN), default=at)

    def _agree(self, left: str, head: str, ended: bool) -> int | None:
        """The first place in head that is a certain cut of the right part and of the window (left: the last piece of the left part)."""
        sure = len(head) if ended else len(head) - MARGIN
        own = {m.end() for m in _PIECE.finditer(head)}
        return next((m.end() - len(left) for m in _PIECE.finditer(left + head) if m.end() >= len(left) and m.end() - len(left) <= sure and (m.end() - len(left) in own)), None)

    def _ids_of(self, ids: list[int], text: str) -> int:
        """How many ids, from the first one on, spell as many bytes as text has."""
        n, k = len(text.encode()), 0
        while n > 0:
            n -= int(self.size[ids[k]])
            k += 1
        return k


@functools.lru_cache(maxsize=4)
def load(path: str) -> ByteBpe:
    """One vocabulary for each process."""
    return ByteBpe(path)
