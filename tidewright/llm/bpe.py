"""Byte-level BPE of a public tokenizer file, with caches per Python worker."""

from __future__ import annotations

import base64
import itertools
import operator
from array import array
from functools import lru_cache

import public_tokenizers
import regex
import tiktoken

#: Fixed values of the tokenizer file: its pre-tokenizer pattern and the one special string it matches inside texts.
PATTERN = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
#: The characters of the Unicode property White_Space, by which that pattern goes.
WHITE = frozenset(
    "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
SPECIAL, SPECIAL_ID = "<|endoftext|>", 50256

#: A space beside white space, or at an end: where cutting at every space could part a run. SINGLE: where it can't.
LOOSE = regex.compile(r" (?:\p{White_Space}|$)|\p{White_Space} |^ ")
SINGLE = regex.compile(r"(?<=\P{White_Space}) (?=\P{White_Space})")
#: Marks that end many words; alone each is a pre-token.
MARKS = frozenset(".,;:!?")
#: A step as two bytes, as they are stored.
STEP = {n: array("h", [n]).tobytes() for n in range(-128, 128)}
#: Entries of a cache before it starts anew; at about 0.3 KB an entry up to 160 MB. A worker has up to three that get so large.
CACHE = 1 << 19


@lru_cache(1)
def core():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("byte_bpe_50k", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})._core_bpe, ranks


class _Chunks(dict):
    """Chunk of text between spaces -> what value() makes of its pre-tokens."""

    def __init__(self, value, lead: str):
        self.value, self.lead, self.old = value, lead, {}
        self.mark = {c: value([c]) for c in MARKS}

    def __missing__(self, chunk: str):
        if chunk[-1:] in MARKS and chunk[:-1].isalpha():  # a word and a mark: two pre-tokens, whose values are put together
            return self[chunk[:-1]] + self.mark[chunk[-1]]
        out = self.old.get(chunk)
        if len(self) >= CACHE // 2:  # what was used since the last time stays within reach
            self.old = dict(self)
            self.clear()
        if out is not None:
            self[chunk] = out
            return out
        out = self.value([self.lead + chunk] if chunk.isalpha() else PATTERN.findall(self.lead + chunk))
        if len(chunk) < 64:
            self[chunk] = out
        return out


class Cutter:
    """Cuts a text into chunks whose pre-tokens are those of the whole text.

    A space between two characters that are no white space begins a
    pre-token, so a chunk begins there; what lies within a chunk is left to
    the pre-tokenizer.
    """

    def __init__(self, value):
        self.first, self.rest = _Chunks(value, ""), _Chunks(value, " ")

    def values(self, text: str) -> list:
        head, *tail = SINGLE.split(text) if LOOSE.search(text) else text.split(" ")
        out = [self.first[head]] if head else []
        out.extend(map(self.rest.__getitem__, tail))
        return out


def _ids(pieces: list[str]) -> bytes:
    encode = core()[0].encode_single_piece
    out = array("I")
    for p in pieces:
        out.extend(encode(p.encode()))
    return out.tobytes()


@lru_cache(1)
def _encoder() -> Cutter:
    return Cutter(_ids)


def encode(text: str) -> bytes:
    """The text's ids as little-endian unsigned 32-bit integers."""
    cutter = _encoder()
    if SPECIAL not in text:
        return b"".join(cutter.values(text))
    mark = array("I", [SPECIAL_ID]).tobytes()
    return mark.join(b"".join(cutter.values(x)) for x in text.split(SPECIAL))


class PrefixDP:
    """Token counts of every prefix of a pre-token.

    The encoding of a prefix ends in exactly one token t, the one that stays
    apart from the last token of the prefix before it when both are encoded
    together; its count is that prefix's count plus one.
    """

    LONG = 48

    def __init__(self):
        core_bpe, self.ranks = core()
        self.encode = core_bpe.encode_single_piece
        self.longest = max(map(len, self.ranks))
        self.memo: dict[bytes, tuple[int, bytes, bytes]] = {}
        self.pairs: dict[tuple[bytes, bytes], bool] = {}

    def apart(self, last: bytes, t: bytes) -> bool:
        got = self.pairs.get((last, t))
        if got is None:
            if len(self.pairs) >= CACHE // 2:
                self.pairs.clear()
            got = self.pairs[last, t] = self.encode(last + t) == [self.ranks[last], self.ranks[t]]
        return got

    def count(self, piece: bytes) -> int:
        return self.known(piece)[0] if len(piece) <= self.LONG else self.all_counts(piece)[-1]

    def known(self, piece: bytes) -> tuple[int, bytes, bytes, int, int]:
        """Count, last token, the steps of the prefix counts at the ends of characters, the count at the last
        such end, and the bytes that the character begun still needs. What pieces begin with is remembered."""
        memo = self.memo
        got = memo.get(piece)
        if got is not None:
            return got
        if len(memo) >= CACHE:
            memo.clear()
        i, now = len(piece) - 1, None
        while i > 0 and (now := memo.get(piece[:i])) is None:
            i -= 1
        _, _, steps, base, need = now or (0, b"", b"", 0, 0)
        ranks, pairs = self.ranks, self.pairs
        for at in range(i + 1, len(piece) + 1):
            p, byte = piece[:at], piece[at - 1]
            if p in ranks:
                n, t = 1, p
            else:
                for cut in range(1, at):
                    t = p[cut:]
                    if t in ranks:
                        before = memo[p[:cut]]
                        fits = pairs.get((before[1], t))
                        if fits is None:
                            fits = self.apart(before[1], t)
                        if fits:
                            n = before[0] + 1
                            break
            if byte >= 0x80:
                need = need - 1 if byte < 0xC0 else 1 if byte < 0xE0 else 2 if byte < 0xF0 else 3
            if not need:
                steps += STEP[n - base]
                base = n
            now = memo[p] = (n, t, steps, base, need)
        return now

    def steps(self, piece: str) -> bytes:
        """Steps of a piece's prefix counts, one for each code point."""
        raw = piece.encode()
        if len(raw) <= self.LONG:
            return self.known(raw)[2]
        counts = self.all_counts(raw)
        ends = [counts[end - 1] for end in itertools.accumulate(len(ch.encode()) for ch in piece)]
        return array("h", map(operator.sub, ends, [0, *ends])).tobytes()

    def all_counts(self, piece: bytes) -> list[int]:
        """Counts of piece[:1], piece[:2], ..., piece."""
        states = [(0, b"")]
        for at in range(1, len(piece) + 1):
            for cut in range(max(0, at - self.longest), at):
                t = piece[cut:at]
                if t in self.ranks and (not cut or self.apart(states[cut][1], t)):
                    states.append((states[cut][0] + 1, t))
                    break
        return [n for n, _ in states[1:]]


@lru_cache(1)
def prefix_dp() -> tuple[PrefixDP, Cutter]:
    """The dynamic program, and a cutter to the steps from each prefix count of a chunk to the next, as 16-bit integers."""
    dp = PrefixDP()

    def steps(pieces: list[str]) -> bytes:
        if _parted(pieces):
            return dp.steps(pieces[0]) if len(pieces) == 1 else b"".join(map(dp.steps, pieces))
        counts = _plain(dp, "".join(pieces))
        return array("h", map(operator.sub, counts, [0, *counts])).tobytes()

    return dp, Cutter(steps)


def _steps(text: str) -> bytes:
    """Steps of a text without special strings."""
    return b"".join(prefix_dp()[1].values(text))


def prefix_steps(text: str) -> bytes:
    """For each code point the step of the exact token count when the prefix grows by it, each prefix as if encoded alone."""
    parts = text.split(SPECIAL)
    if len(parts) == 1:
        return _steps(text)
    out = []
    for part in parts[:-1]:
        # a prefix that ends inside the special string is ordinary text; with its last character it is one token
        seen = array("h", _steps(part + SPECIAL[:-1]))
        whole = array("h", _steps(part))
        out.append(seen.tobytes())
        out.append(array("h", [sum(whole) + 1 - sum(seen)]).tobytes())
    return b"".join([*out, _steps(parts[-1])])


def prefix_counts(text: str) -> array:
    """Exact token count of text[:0], text[:1], ..., text[:len(text)], each as if encoded alone."""
    return array("i", itertools.accumulate(array("h", prefix_steps(text)), initial=0))


def _parted(pieces: list[str]) -> bool:
    """Whether each prefix is cut as the whole is: no run of white space, and no contraction."""
    run = False
    for i, p in enumerate(pieces):
        c = p[0]
        if c in WHITE:
            if run or len(p) > 1 and (i or p[-1] in WHITE):
                return False
            run = len(p) == 1
        elif c == "'" and len(p) > 1:
            return False
        else:
            run = False
    return True


def _plain(dp: PrefixDP, text: str) -> list[int]:
    out, base, at = [], 0, 0
    pieces = PATTERN.findall(text)
    run = None  # where a white space run began, and the count before it
    for piece in pieces:
        raw = piece.encode()
        counts = dp.all_counts(raw)
        ends, n = [], 0
        for ch in piece:
            n += len(ch.encode())
            ends.append(counts[n - 1])
        if piece in ("'re", "'ve", "'ll"):
            ends[1] = ends[0] + dp.count(raw[1:2])
        total = ends[-1]
        white = piece[-1] in WHITE  # then all of it is
        if piece[0] in WHITE:
            if run is None:
                run = (at, base)
            # a prefix that ends inside a run holds all of the run as one piece
            for k in range(1, (len(piece) if white else 1) + 1):
                whole = text[run[0] : at + k].encode()
                ends[k - 1] = run[1] - base + dp.count(whole)
        if not white:
            run = None
        out.extend(base + x for x in ends)
        base += total
        at += len(piece)
    return out
