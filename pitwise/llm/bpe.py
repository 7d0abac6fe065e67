"""Byte-level BPE vocabularies, read once per Python worker.

``encoder`` gives the ids of the library for a vocabulary file;
``HeapCounter`` counts tokens by merging, without emitting ids.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache
from heapq import heapify, heappop, heappush

#: How a byte-level vocabulary splits text before merging (fixed value).
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Texts with characters elsewhere are split by the tokenizers library itself,
#: whose Unicode tables may be older or newer than those of the regex module.
_COMMON = re.compile("[^\x00-՗‐-⁠₠-₿　-ヿ一-龥가-힣]")


@lru_cache(maxsize=1)
def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary.

    Printable bytes stand for themselves; the others take the code points
    from 256 on, in order.
    """
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


#: Runs of white space (Unicode's White_Space, as the splitting pattern has it)
#: from this length on are merged on their own.
LONG_SPACE = 4096
_LONG_SPACE = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{%d,}" % LONG_SPACE)


class Encoder:
    """The ids of a vocabulary file, by tiktoken.

    They equal the tokenizers library's on every text that the tests try
    (every assigned code point among them) at a quarter of the CPU time.

    The splitting pattern looks ahead at the end of a run of white space and
    gives up on runs of a million characters. A long run is therefore taken
    out of the text: before a word all of it but the last character is one
    piece, before the end or a special token all of it is, as the pattern says.
    """

    def __init__(self, path: str) -> None:
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        letters = byte_letters()
        ranks = {bytes(letters[c] for c in piece): i for piece, i in spec["model"]["vocab"].items() if piece not in special}
        self.special = tuple(special)
        self.words = tiktoken.Encoding(path, pat_str=SPLIT, mergeable_ranks=ranks, special_tokens=special)
        #: Takes any text as one piece.
        self.piece = tiktoken.Encoding(f"{path} whole", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
        self.n_vocab = self.words.n_vocab

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        at = 0
        for m in _LONG_SPACE.finditer(text):
            end = m.end()
            if end < len(text) and not text.startswith(self.special, end):
                end -= 1
            out += self.words.encode(text[at : m.start()], allowed_special="all")
            out += self.piece.encode_ordinary(text[m.start() : end])
            at = end
        return out + self.words.encode(text[at:], allowed_special="all") if at else self.words.encode(text, allowed_special="all")


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    return Encoder(path)


class HeapCounter:
    """Counts the tokens of texts by heap-and-linked-list merging.

    The symbols of a piece (its bytes at first) form a linked list, a heap
    holds the rank of each adjacent pair. The lowest rank, leftmost first, is
    popped and merged until no pair of the list is in the merge table; the
    count is the number of bytes less the number of merges.
    """

    #: Counts of so many different pieces are kept per worker.
    KEPT = 400_000
    #: Pieces longer than this are not kept.
    LONGEST_KEPT = 64

    def __init__(self, path: str) -> None:
        import regex
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        ids = spec["model"]["vocab"]
        self.first = [0] * 256
        for letter, byte in byte_letters().items():
            self.first[byte] = ids[letter]
        self.base = max(ids.values()) + 1
        self.merges: dict[int, tuple[int, int]] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.merges[ids[a] * self.base + ids[b]] = (rank, ids[a + b])
        special = [x["content"] for x in spec["added_tokens"]]
        self.special = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.split = regex.compile(SPLIT).findall
        self.library = Tokenizer.from_file(path).pre_tokenizer
        self.kept: dict[str, int] = {}

    def piece(self, piece: str) -> int:
        symbols = [self.first[b] for b in piece.encode()]
        n, base, table = len(symbols), self.base, self.merges
        if n < 2:
            return n
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []
        for i in range(n - 1):
            if (found := table.get(symbols[i] * base + symbols[i + 1])) is not None:
                heap.append((found[0], i))
        heapify(heap)
        count = n
        while heap:
            rank, i = heappop(heap)
            a, j = symbols[i], after[i]
            if a < 0 or j >= n:
                continue
            found = table.get(a * base + symbols[j])
            if found is None or found[0] != rank:
                continue  # the pair has been merged away since
            symbols[i], symbols[j] = found[1], -1
            k = after[i] = after[j]
            count -= 1
            if k < n:
                before[k] = i
                if (found := table.get(symbols[i] * base + symbols[k])) is not None:
                    heappush(heap, (found[0], i))
            if (h := before[i]) >= 0 and (found := table.get(symbols[h] * base + symbols[i])) is not None:
                heappush(heap, (found[0], h))
        return count

    def _plain(self, text: str) -> int:
        if _COMMON.search(text):
            pieces = [text[a:b] for _, (a, b) in self.library.pre_tokenize_str(text)]
        else:
            pieces = self.split(text)
        kept, total = self.kept, 0
        get = kept.get
        for x in pieces:
            n = get(x)
            if n is None:
                n = self.piece(x)
                if len(x) <= self.LONGEST_KEPT:
                    if len(kept) >= self.KEPT:
                        kept.clear()
                    kept[x] = n
            total += n
        return total

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if self.special is None:
            return self._plain(text)
        parts = self.special.split(text)
        return len(parts) - 1 + sum(self._plain(x) for x in parts if x)


@lru_cache(maxsize=2)
def heap_counter(path: str) -> HeapCounter:
    return HeapCounter(path)
