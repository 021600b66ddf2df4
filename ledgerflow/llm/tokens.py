"""Token ids and exact prefix token counts of whole texts, piece by piece, for use inside tasks.

The tokenizer drops white space and splits the rest into pieces by a pattern before it merges, so a
text's tokens are those of its pieces in a row. Texts are cut where no piece can cross: at white
space, and between ASCII characters of different kinds (an apostrophe before a letter is left
alone, since it may begin a contraction). Each distinct piece is encoded once and remembered.
A text that holds the string of a special token is cut at white space only.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from ledgerflow.llm.shared import kept
from ledgerflow.llm.words import LOWER, Words, buffers, ragged, runs, split

# A task has one core; the library's own threads would each keep memory of theirs.
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Bytes of text that are encoded at a time.
ENCODED = 2 << 20
#: Pieces that a worker remembers before it starts anew.
REMEMBERED = 200_000

_KIND = np.full(256, 3, np.uint8)  # ASCII: 1 letter, 2 digit, 3 other; 0 not ASCII
_KIND[128:] = 0
_KIND[ord("0") : ord("9") + 1] = 2
_KIND[ord("A") : ord("Z") + 1] = 1
_KIND[ord("a") : ord("z") + 1] = 1

# Pieces that the tokenizer's pattern takes whole though an apostrophe and letters
# are different kinds, and the white space beyond ASCII that it drops.
CONTRACTIONS = frozenset(["'s", "'t", "'re", "'ve", "'m", "'ll", "'d"])
#: ASCII and accented Latin letters in composed form: such a run is one piece, lower-cased letter by letter.
_LETTERS = re.compile(rb"(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+").fullmatch
_WIDE_SPACE = re.compile("[\u0085   -     　 \t-\r]")


@kept(4)
def tokenizer(path: str) -> Tokenizer:
    return Tokenizer.from_file(path)


@kept(4)
def specials(path: str) -> tuple[str, ...]:
    return tuple(t.content for t in tokenizer(path).get_added_tokens_decoder().values())


def pieces_of(column: pa.Array, special: Iterable[str]) -> tuple[Words, np.ndarray, np.ndarray]:
    """Pieces of each text (see the module's head), the slice's bytes and the texts' places."""
    data, offsets = buffers(column)
    kind = _KIND[data]
    cuts = np.zeros(len(data), bool)
    cuts[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == 2)
    cuts[1:] &= (kind[1:] > 0) & (kind[:-1] > 0) & ~((data[:-1] == ord("'")) & (kind[1:] == 1))
    # A capital before a byte beyond ASCII keeps its case: the two may compose to one character.
    lower = np.ones(len(data), bool)
    lower[:-1] = kind[1:] > 0
    raw = data.tobytes()
    for text in special:
        mark, at = text.encode(), -1
        while (at := raw.find(mark, at + 1)) >= 0:
            d = int(np.searchsorted(offsets, at, "right")) - 1
            cuts[offsets[d] : offsets[d + 1]] = False
            lower[offsets[d] : offsets[d + 1]] = False
            at = max(at, int(offsets[d + 1]) - 1)
    return split(np.where(lower, LOWER[data], data), offsets, cuts), data, offsets


class _Remembered:
    """A list of numbers for each distinct piece, in one flat array."""

    def __init__(self, dtype) -> None:
        self.dtype = dtype
        self.clear()

    def clear(self) -> None:
        self.row: dict[bytes, int] = {}
        self.size = np.zeros(0, np.int64)
        self.start = np.zeros(0, np.int64)
        self.flat = np.zeros(0, self.dtype)

    def rows(self, found: Words, learn) -> np.ndarray:
        """The row of each distinct piece; `learn` gets new pieces, gives flat values and sizes."""
        data, offsets = buffers(found.distinct)
        raw, at = data.tobytes(), offsets.tolist()
        pieces = [raw[a:b] for a, b in zip(at, at[1:], strict=False)]
        if len(self.row) > REMEMBERED:
            self.clear()
        new = [p for p in pieces if p not in self.row]
        if new:
            new, flat, sizes = learn(new)
            self.row.update(zip(new, range(len(self.row), len(self.row) + len(new)), strict=True))
            self.start = np.concatenate([self.start, len(self.flat) + np.cumsum(sizes) - sizes])
            self.size = np.concatenate([self.size, sizes])
            self.flat = np.concatenate([self.flat, flat])
        return np.fromiter(map(self.row.__getitem__, pieces), np.int64, len(pieces))


class TokenIds:
    """Token ids of whole texts as the library gives them, without added special tokens."""

    def __init__(self, path: str) -> None:
        self.library, self.special = tokenizer(path), specials(path)
        words = self.library.get_vocab(with_added_tokens=False)
        self.ends = np.zeros(self.library.get_vocab_size(), bool)
        self.ends[[i for t, i in words.items() if t.endswith("</w>")]] = True
        self.known = _Remembered(np.uint32)

    def _learn(self, new: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        plain, other = [], []
        for p in new:
            (plain if _LETTERS(p) else other).append(p)
        lines = [b" ".join(plain[k : k + 256]).decode() for k in range(0, len(plain), 256)]
        flat = np.concatenate([np.zeros(0, np.uint32), *(np.array(x, np.uint32) for x in self._encoded(lines, 32))])
        last = np.flatnonzero(self.ends[flat])
        more = list(self._encoded([p.decode() for p in other], 4096))
        sizes = np.concatenate([np.diff(last, prepend=-1), np.fromiter(map(len, more), np.int64, len(more))])
        return plain + other, np.concatenate([flat, np.fromiter((i for x in more for i in x), np.uint32)]), sizes

    def _encoded(self, texts: list[str], at_once: int) -> Iterator[list[int]]:
        """Ids of each text; few at a time, since the library's answers are large."""
        for k in range(0, len(texts), at_once):
            yield from (x.ids for x in self.library.encode_batch_fast(texts[k : k + at_once], add_special_tokens=False))

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and the place where each text's begin (one more at the end)."""
        found, _, _ = pieces_of(column, self.special)
        row = self.known.rows(found, self._learn)[found.codes]
        sizes = self.known.size[row]
        places = np.concatenate([np.zeros(1, np.int64), np.cumsum(sizes)])
        return ragged(self.known.flat, self.known.start[row], sizes), places[found.first]


@kept(4)
def token_ids(path: str) -> TokenIds:
    """One per worker, so pieces stay known from task to task."""
    return TokenIds(path)


class PrefixCounts:
    """Exact token counts of every prefix, by dynamic programming over prefixes.

    The tokens of s[:i] are those of s[:j] and one more token s[j:i], for exactly one j: the one
    where the token before j and the token s[j:i] stay apart, that is, where no merge across j
    comes before the merges that make the two. So `last[i]` and `count[i]` follow from shorter
    prefixes. The last token of a piece bears the end mark; the count of s[:i] as a whole piece
    takes a marked token as its last one, and `last` holds unmarked ones. Pieces are worked in
    sorted order: what two neighbours share is not computed again.
    """

    def __init__(self, path: str) -> None:
        self.library, self.special = tokenizer(path), specials(path)
        model = json.loads(self.library.to_str())["model"]
        mark = model["end_of_word_suffix"]
        if model["type"] != "BPE" or not mark:
            raise ValueError("a BPE vocabulary with an end mark is needed")
        ids = model["vocab"]
        parts = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.rank = {(ids[a], ids[b]): k for k, (a, b) in enumerate(parts)}
        made = {}
        for a, b in parts:
            made.setdefault(ids[a + b], (ids[a], ids[b]))
        far = len(parts)
        self.left: dict[int, list] = {}
        self.right: dict[int, list] = {}
        for t in ids.values():
            self.left[t], self.right[t] = self._edge(t, made, 0, far), self._edge(t, made, 1, far)
        self.apart: dict[int, bool] = {}
        self.inner, self.final = {}, {}
        for text, t in ids.items():
            if t in made and not self._apart_inside(t, made):
                continue  # never the result of merging
            (self.final if text.endswith(mark) else self.inner)[text.removesuffix(mark)] = t
        # Every ending of a token's text, with the tokens that it is itself (-1: none).
        endings = {text[k:] for text in [*self.inner, *self.final] for k in range(len(text))}
        self.tails = {text: (self.inner.get(text, -1), self.final.get(text, -1)) for text in endings}
        # The tokenizer writes bytes as printable characters; ASCII letters stand for themselves.
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        shown = {b: chr(b) for b in printable}
        for k, b in enumerate(b for b in range(256) if b not in shown):
            shown[b] = chr(256 + k)
        self.shown = shown
        self.known = _Remembered(np.int16)
        self.s, self.last, self.count, self.whole = "", [-1], [0], [0]

    def _edge(self, t: int, made: dict, side: int, far: int) -> list[tuple[int, int]]:
        """What stands at one edge of token t while it is merged: (token, rank of its end)."""
        out, until = [], far
        while True:
            out.append((t, until))
            if t not in made:
                return out[::-1]
            until = self.rank[made[t]]
            t = made[t][side]

    def _stay_apart(self, a: int, b: int) -> bool:
        """Whether merging leaves the tokens a and b, side by side, as they are."""
        xs, ys, i, j = self.right[a], self.left[b], 0, 0
        rank, far = self.rank, len(self.rank)
        while True:
            (x, x_end), (y, y_end) = xs[i], ys[j]
            r = rank.get((x, y), far)
            if r < x_end and r <= y_end and r < far:
                return False
            if x_end <= y_end:
                if i + 1 == len(xs):
                    return True
                i += 1
            else:
                j += 1

    def _apart_inside(self, t: int, made: dict) -> bool:
        """Whether merging the characters of t gives t: its two parts must stay apart until then."""
        a, b = made[t]
        xs, ys, i, j, end = self.right[a], self.left[b], 0, 0, self.rank[(a, b)]
        while True:
            (x, x_end), (y, y_end) = xs[i], ys[j]
            if (x, y) == (a, b):
                return True
            r = self.rank.get((x, y), end)
            if r < x_end and r <= y_end and r < end:
                return False
            if x_end <= y_end and i + 1 < len(xs):
                i += 1
            elif j + 1 < len(ys):
                j += 1
            else:
                i += 1

    def _extend(self, s: str) -> None:
        """Make the tables those of s."""
        old, n = self.s, 0
        for a, b in zip(old, s, strict=False):
            if a != b:
                break
            n += 1
        last, count, whole = self.last, self.count, self.whole
        del last[n + 1 :], count[n + 1 :], whole[n + 1 :]
        apart, tails = self.apart, self.tails
        for i in range(n + 1, len(s) + 1):
            inner, final = [], []  # tokens that end here, the shortest first
            j = i - 1
            while j >= 0 and (found := tails.get(s[j:i])) is not None:
                if found[0] >= 0:
                    inner.append((j, found[0]))
                if found[1] >= 0:
                    final.append((j, found[1]))
                j -= 1
            for j, t in reversed(inner):
                key = last[j] << 20 | t
                if j == 0 or (apart[key] if key in apart else self._tell(key, last[j], t)):
                    last.append(t)
                    count.append(count[j] + 1)
                    break
            for j, t in reversed(final):
                key = last[j] << 20 | t
                if j == 0 or (apart[key] if key in apart else self._tell(key, last[j], t)):
                    whole.append(count[j] + 1)
                    break
        self.s = s

    def _tell(self, key: int, a: int, b: int) -> bool:
        if len(self.apart) > REMEMBERED:
            self.apart.clear()
        self.apart[key] = said = self._stay_apart(a, b)
        return said

    def _piece(self, text: str) -> list[int]:
        """Counts of each prefix (by characters) of one piece, as the tokenizer's pattern gives it."""
        if text in CONTRACTIONS:
            quote, rest = self._piece("'"), self._piece(text[1:])
            whole = self._symbols(text)[-1:]
            return quote + [quote[0] + c for c in rest[:-1]] + whole
        return self._symbols(text)

    def _symbols(self, text: str) -> list[int]:
        if text.isascii():
            self._extend("".join(self.shown[b] for b in text.encode()) if not text.isalpha() else text)
            return self.whole[1:]
        shown, ends, k = [], [], 0
        for ch in text:
            raw = ch.encode()
            shown += [self.shown[b] for b in raw]
            k += len(raw)
            ends.append(k)
        self._extend("".join(shown))
        return [self.whole[k] for k in ends]

    def _ordinary(self, text: str) -> list[int]:
        """Counts of each prefix of a run without white space and special tokens."""
        normal = self.library.normalizer.normalize_str(text)
        if len(normal) != len(text) or not unicodedata.is_normalized("NFC", text):
            # A prefix may compose to other characters than the whole does: one prefix at a time.
            encode = self.library.encode_batch_fast
            return [len(x.ids) for x in encode([text[:k] for k in range(1, len(text) + 1)], add_special_tokens=False)]
        out, base, at = [], 0, 0
        for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(normal):
            out += [base] * (a - at)
            got = self._piece(normal[a:b])
            out += [base + c for c in got]
            base, at = out[-1], b
        return out + [base] * (len(text) - at)

    def _plain(self, text: str) -> list[int]:
        out, base, at = [], 0, 0
        for gap in [*_WIDE_SPACE.finditer(text), None]:
            end = gap.start() if gap else len(text)
            out += [base + c for c in self._ordinary(text[at:end])] if end > at else []
            base = out[-1] if out else 0
            if gap:
                out.append(base)
                at = gap.end()
        return out

    def of(self, text: str) -> list[int]:
        """The token count of text[:1], text[:2], ... as the library gives them."""
        out, base = [], 0
        while True:
            found = [(text.find(s), -len(s), s) for s in self.special if s in text]
            if not found:
                return out + [base + c for c in self._plain(text)]
            at, _, mark = min(found)
            open_end = self._plain(text[:at] + mark[:-1])
            out += [base + c for c in open_end]
            base += (open_end[at - 1] if at else 0) + 1
            out.append(base)
            text = text[at + len(mark) :]

    def _learn(self, new: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        new = sorted(new)
        counts, sizes = [], []
        for p in new:
            got = self._symbols(p.decode().lower()) if _LETTERS(p) else self.of(p.decode())
            counts += got
            sizes.append(len(got))
        sizes = np.array(sizes, np.int64)
        steps = np.diff(np.array(counts, np.int64), prepend=0)
        first = np.cumsum(sizes) - sizes
        steps[first] = np.array(counts, np.int64)[first]
        return new, steps.astype(np.int16), sizes

    def count_all(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Tokens of each text; the change of the count at each character, of all texts in a row;
        and the place where each text's begin (one more at the end)."""
        found, data, offsets = pieces_of(column, self.special)
        known = self.known
        row = known.rows(found, self._learn)
        total = np.add.reduceat(np.append(known.flat, 0), known.start, dtype=np.int64) if len(known.start) else np.zeros(0, np.int64)
        tokens = found.per_text(total[row][found.codes])
        row = row[found.codes]
        chars = np.concatenate([np.zeros(1, np.int64), np.cumsum((data & 0xC0) != 0x80)])
        steps = np.zeros(int(chars[-1]), np.int16)
        sizes = known.size[row]
        steps[np.repeat(chars[found.start], sizes) + runs(sizes)] = ragged(known.flat, known.start[row], sizes)
        return tokens, steps, chars[offsets]


@kept(4)
def prefix_counts(path: str) -> PrefixCounts:
    """One per worker, so pieces stay known from task to task."""
    return PrefixCounts(path)
