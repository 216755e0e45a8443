"""Texts as sequences of word classes, computed for many texts at once with arrays.

A token is a run of characters of one kind; blanks only separate. Its class says what kind of word it
is: a function word, a number, a content word of some script, a mark, a line end, a link or a tag.
Content words have a degree: how much of their text is made of this very word (or, for words that are
written without blanks, of the same few characters). Links and tags have one too: how much of their text
they make up. Function words are those of ``FunctionWords``, which are learned from prose by their frequency.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

import numpy as np

# Function words of English, for use without a sample of prose.
ENGLISH = (
    "a about after all also an and any are as at be because been before being between both but by can could did do does during each every few for "
    "from had has have he her his how if in into is it its later less may might more most must never no nor not nothing of on once one only or other "
    "our out over per same shall she should since so some still such than that the their them then there these they this those through to too under "
    "until up upon was we were what when where which while who whose why will with within without would yet you your"
).split()
# Characters that serve as function words in Chinese and Japanese, for the same use.
CJK_FUNCTION = "的了在是不和与或及把被将从到由对为以于并而但也都只才就按每其此该各所可能要应须若当后前中内时"

BLANK, LATIN, DIGIT, KANJI, HIRAGANA, KATAKANA, LETTER, LINE, MARK0 = range(9)
ASCII_MARKS = [c for c in range(33, 127) if not chr(c).isalnum()]
CJK_MARKS = [ord(c) for c in "、。「」『』【】（）：；！？・，．·»…—|－～"]
KINDS = MARK0 + len(ASCII_MARKS) + len(CJK_MARKS) + 1

# Classes: function words, content words by script and degree, numbers, line, link, tag, marks.
DEGREES = 4
FUNCTION, CONTENT0 = 1, 2
#: Words of all alphabets are of one class, as a rare script alone is no sign of anything.
SCRIPTS = {LATIN: 0, KANJI: 1, HIRAGANA: 2, KATAKANA: 3, LETTER: 0, DIGIT: 4}
LINE_CLASS = CONTENT0 + (max(SCRIPTS.values()) + 1) * DEGREES
LINK, TAG = LINE_CLASS + 1, LINE_CLASS + 2
MARK_CLASS0 = TAG + 1
LINK_MORE0 = MARK_CLASS0 + KINDS - MARK0  # links, then tags, of degree 1, 2, 3
LISTED = np.array([0.1, 0.3, 0.5])  # shares of a text at which the degree of its links or tags grows
CLASSES = LINK_MORE0 + 2 * len(LISTED)
START = 0


def _kinds() -> np.ndarray:
    kind = np.full(0x110000, LETTER, np.uint8)
    kind[: 0x250] = KINDS - 1
    kind[0x2000:0x2E80] = KINDS - 1
    kind[0x3000:0x3040] = KINDS - 1
    kind[0xFE00:0xFF10] = kind[0xFF1A:0xFF21] = kind[0x1F000:0x1FB00] = KINDS - 1
    for a, b in ((0x41, 0x5B), (0x61, 0x7B), (0xC0, 0x250), (0xFF21, 0xFF5B)):
        kind[a:b] = LATIN
    kind[0x5F] = LATIN  # names of fields hold underscores
    for a, b in ((0x30, 0x3A), (0xFF10, 0xFF1A)):
        kind[a:b] = DIGIT
    for a, b in ((0x3400, 0x4DC0), (0x4E00, 0xA000), (0xF900, 0xFB00), (0x20000, 0x32000)):
        kind[a:b] = KANJI
    kind[0x3005] = KANJI
    kind[0x3041:0x30A0] = HIRAGANA
    kind[0x30A1:0x3100] = kind[0xFF66:0xFFA0] = KATAKANA
    for i, c in enumerate(ASCII_MARKS):
        if c != 0x5F:
            kind[c] = MARK0 + i
    for i, c in enumerate(CJK_MARKS):
        kind[c] = MARK0 + len(ASCII_MARKS) + i
    for c in (0x20, 0x09, 0xA0, 0x3000, *range(0x2000, 0x2010), 0x202F, 0x205F, 0x2060, 0xFEFF, 0xAD, 0):
        kind[c] = BLANK
    for c in (0x0A, 0x0D, 0x0B, 0x0C, 0x85, 0x2028, 0x2029):
        kind[c] = LINE
    return kind


_KIND = _kinds()
_M = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


_LOWER = np.arange(0x250, dtype=np.uint32)
for _c in range(0x250):
    if len(chr(_c).lower()) == 1:
        _LOWER[_c] = ord(chr(_c).lower())


@functools.lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    base = int(_M)
    pair = (np.uint64(base), np.uint64(pow(base, -1, 1 << 64)))
    with np.errstate(over="ignore"):
        return tuple(np.cumprod(np.concatenate([[np.uint64(1)], np.full(n - 1, b)]), dtype=np.uint64) for b in pair)


def _span_hash(codes: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of each span, the same for equal spans wherever they are."""
    with np.errstate(over="ignore"):
        # powers of an odd base give a character its place, inverse powers take the span's own place out again
        power, undo = _powers(1 << max(12, len(codes).bit_length()))
        sums = np.concatenate([[np.uint64(0)], np.cumsum(_mixed(codes.astype(np.uint64) + np.uint64(77)) * power[: len(codes)], dtype=np.uint64)])
        return _mixed((sums[end] - sums[begin]) * undo[begin] + (end - begin).astype(np.uint64) * _M)


def _hash_words(words: list[str]) -> np.ndarray:
    out = []
    for w in words:
        codes = np.array([ord(c) for c in w], np.uint32)
        out.append(_span_hash(codes, np.array([0]), np.array([len(codes)]))[0])
    return np.sort(np.array(out, np.uint64))


class FunctionWords:
    """Hashes of words, and characters of CJK that are words of their own."""

    def __init__(self, hashes: np.ndarray, characters: np.ndarray):
        self.hashes, self.characters = np.sort(hashes), characters

    def table(self) -> np.ndarray:
        out = np.zeros(0x110000, bool)
        out[self.characters] = True
        return out


LISTED_WORDS = FunctionWords(_hash_words(ENGLISH), np.array([ord(c) for c in CJK_FUNCTION]))


def _codes_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(codes of all texts, each with a line end behind it; the same in lower case; lengths)."""
    codes = np.frombuffer(("\n".join(texts) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32)
    small = codes < 0x250
    lower = codes.copy()
    lower[small] = _LOWER[codes[small]]
    return codes, lower, np.array([len(t) for t in texts], np.int64)


def words_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of the words, characters of kanji), each as often as there are texts that have it."""
    codes, lower, lengths = _codes_of(texts)
    kind, doc = _KIND[codes], np.repeat(np.arange(len(texts)), lengths + 1)
    new = np.ones(len(codes), bool)
    new[1:] = (kind[1:] != kind[:-1]) | (doc[1:] != doc[:-1])
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], len(codes))
    words = np.flatnonzero((kind[begin] == LATIN) | (kind[begin] == HIRAGANA) | (kind[begin] == LETTER))
    h = _span_hash(lower, begin[words], end[words])
    pairs = np.unique(np.rec.fromarrays([doc[begin[words]], h]))
    kanji = np.flatnonzero(kind == KANJI)
    signs = np.unique(doc[kanji] * 0x110000 + codes[kanji])
    return np.asarray(pairs.f1), (signs % 0x110000).astype(np.int64)


def _counts(doc: np.ndarray, h: np.ndarray) -> np.ndarray:
    """How often each (doc, hash) occurs, for every element."""
    with np.errstate(over="ignore"):
        key = h ^ _mixed(doc.astype(np.uint64) * _M + np.uint64(5))
    _, place, count = np.unique(key, return_inverse=True, return_counts=True)
    return count[place]


@dataclass
class Tokens:
    """Of a batch of texts: the text's number, class and length of each token, and the texts' lengths without blanks."""

    doc: np.ndarray
    kind: np.ndarray
    size: np.ndarray
    chars: np.ndarray


def tokenize(texts: list[str], function_words: FunctionWords = LISTED_WORDS) -> Tokens:
    codes, lower, lengths = _codes_of(texts)
    ends = np.cumsum(lengths + 1)
    kind = _KIND[codes]
    kind[ends - 1] = LINE
    is_function = function_words.table()
    doc_of = np.repeat(np.arange(len(texts)), lengths + 1)
    # Tokens: runs of one kind; marks and line ends stand alone, kanji that serve as function words too.
    alone = (kind >= LINE) | ((kind == KANJI) & is_function[codes])
    new = np.ones(len(codes), bool)
    new[1:] = (kind[1:] != kind[:-1]) | alone[1:] | alone[:-1]
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], len(codes))
    tk = kind[begin]
    # Links and tags take the whole stretch between blanks.
    gap = (kind == BLANK) | (kind == LINE)
    stretch = np.cumsum(gap)
    is_link = np.zeros(stretch[-1] + 1, bool)
    is_tag = np.zeros(stretch[-1] + 1, bool)
    slash, dot, colon, hash_ = (MARK0 + ASCII_MARKS.index(ord(c)) for c in "/.:#")
    if len(tk) > 3:
        at = np.flatnonzero((tk[:-2] == colon) & (tk[1:-1] == slash) & (tk[2:] == slash) & (end[:-2] == begin[1:-1]))
        is_link[stretch[begin[at]]] = True
        at = np.flatnonzero((tk[:-3] == LATIN) & (tk[1:-2] == dot) & (tk[2:-1] == LATIN) & (tk[3:] == slash))
        at = at[stretch[begin[at]] == stretch[begin[at + 3]]]
        is_link[stretch[begin[at]]] = True
        at = np.flatnonzero((tk[:-1] == hash_) & ((tk[1:] == LATIN) | (tk[1:] == KANJI) | (tk[1:] == KATAKANA) | (tk[1:] == HIRAGANA)) & (end[:-1] == begin[1:]))
        is_tag[stretch[begin[at]]] = True
    part = stretch[begin]
    link, tag = is_link[part] & (tk != LINE) & (tk != BLANK), is_tag[part] & ~is_link[part] & (tk != LINE) & (tk != BLANK)
    joined = link | tag
    doc = doc_of[begin]
    out = np.zeros(len(begin), np.int16)
    marks = tk >= MARK0
    out[marks] = MARK_CLASS0 + tk[marks] - MARK0
    out[tk == LINE] = LINE_CLASS
    # Degrees of content words.
    words = np.flatnonzero((tk >= LATIN) & (tk <= LETTER) & ~joined)
    h = _span_hash(lower, begin[words], end[words])
    latin = tk[words] == LATIN
    function = (tk[words] != KANJI) & np.isin(h, function_words.hashes)
    function |= (tk[words] == KANJI) & is_function[codes[begin[words]]] & (end[words] - begin[words] == 1)
    function |= (tk[words] == HIRAGANA) & (end[words] - begin[words] <= 6)
    count, size = _counts(doc[words], h), end[words] - begin[words]
    share = count * size / np.maximum(1, lengths[doc[words]])
    degree = np.where(count < 4, 0, np.where(share < 0.01, 1, np.where(share < 0.04, 2, 3)))
    # Words that run into each other: a few characters of the word, as often as they occur anywhere in the text.
    wide = np.where(latin, 5, np.where(tk[words] == DIGIT, 99, 2))
    long = np.flatnonzero((size > wide) & ~function & (degree < 3))
    for n in np.unique(wide[long]):
        sel = long[wide[long] == n]
        # every place of the same kind of character, so that the same characters are counted anywhere in a text
        same_kind = (kind == LATIN) if n == 5 else (kind == KANJI) | (kind == KATAKANA)
        pos = np.flatnonzero(same_kind[: len(codes) - n])
        if not len(pos):
            continue
        with np.errstate(over="ignore"):
            salt = _mixed(np.arange(len(texts), dtype=np.uint64) * _M + np.uint64(5))
            uniq, cnt = np.unique(_span_hash(lower, pos, pos + n) ^ salt[doc_of[pos]], return_counts=True)
            best = np.zeros(len(sel))
            first, last = begin[words[sel]], end[words[sel]] - n
            for place in (first, (first + last) // 2, last):
                mine = _span_hash(lower, place, place + n) ^ salt[doc[words[sel]]]
                found = np.minimum(np.searchsorted(uniq, mine), len(uniq) - 1)
                best = np.maximum(best, np.where(uniq[found] == mine, cnt[found], 0))
        share = best * n / np.maximum(1, lengths[doc[words[sel]]])
        degree[sel] = np.maximum(degree[sel], np.where(best < 4, 0, np.where(share < 0.01, 1, np.where(share < 0.04, 2, 3))))
    script = np.array([SCRIPTS.get(k, 0) for k in range(MARK0)])[tk[words]]
    out[words] = np.where(function & (degree < 3), FUNCTION, CONTENT0 + script * DEGREES + degree)
    out[link], out[tag] = LINK, TAG
    size_all = end - begin
    keep = tk != BLANK
    doc, out, size_all, part = doc[keep], out[keep], size_all[keep], part[keep]
    # A link or tag is one token.
    first = np.ones(len(out), bool)
    same = (out[1:] == out[:-1]) & ((out[1:] == LINK) | (out[1:] == TAG)) & (part[1:] == part[:-1])
    first[1:] = ~same
    starts = np.flatnonzero(first)
    size_all = np.add.reduceat(size_all, starts) if len(starts) else size_all
    doc, out = doc[starts], out[starts]
    size_all = np.where(out == LINE_CLASS, 0, size_all)
    chars = np.bincount(doc, size_all, len(texts))
    for place, c in enumerate((LINK, TAG)):
        those = np.flatnonzero(out == c)
        shares = np.bincount(doc[those], size_all[those], len(texts)) / np.maximum(1, chars)
        degree = np.searchsorted(LISTED, shares[doc[those]])
        out[those] = np.where(degree > 0, LINK_MORE0 + place * len(LISTED) + degree - 1, c)
    return Tokens(doc, out, size_all, chars)
