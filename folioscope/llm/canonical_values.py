"""Mapping free-entered values to a canonical list (problem 5).

Method: a symmetric-delete dictionary. Every spelling of a reference entry (its names, with the words
in every rotation) is stored under all strings that come from it by deleting up to ``bound``
characters; a typed value is looked up under the same deletions of its own, which finds every spelling
within the bound without comparing with all of them. Candidates are ranked by weighted
Damerau-Levenshtein distance, then by whether the label fits, then by how often the entry's name was
typed exactly (reference frequency), then by the smaller id. Values without a candidate are misses.

A typed value is reduced to its letters and digits in one case and one form of look-alike characters,
so separators, width, case and the split into words don't matter. Readings of it are tried with words
in brackets left out, with up to one word before and two behind left out (``new``, ``v2``, ``2nd site``),
for Japanese and Chinese up to one character before and four behind, and with shortened words
(``Invo.``) written out from the reference list's own words. Each word left out costs a little, so the
fuller reading wins.

The bound is 2 edits, but 1 where the spelling holds kanji or kana or is shorter than ``SHORT``: there
two edits turn one general word into another. The whole name must match; a value that shares only
general words with an entry is far beyond the bound, and so is a name of an entry's owner with other
general words.

Defined results:

* one row for every input row; null, blank and placeholder names, and empty reference lists, give 0;
* name and alternative name count equally; a null alternative is no name;
* the label decides only between entries at the same distance; a null or unknown label decides nothing;
* repeated rows are mapped each; further columns are ignored, whatever their names.

The entries of the reference list are sent to every task, and a worker builds its index from them once.
An index holds ``INDEX_ENTRIES`` entries at most; a longer list is looked up in one index after another,
each built for a batch and dropped again, and the best answer of all counts, which is the same as that of
one large index. Rows are mapped where they are read, without a shuffle; equal values of a batch are looked
up once. Shortened words are written out entry by entry, so the readings of a name grow with the entries that
have such words, not with the product of what each word may stand for.
"""

from __future__ import annotations

import functools
import itertools
import re
import unicodedata
from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope.llm.look_alikes import character_map

#: About 600 index strings an entry: 300 MB of index in a worker at this number.
INDEX_ENTRIES = 3_000
BOUND, SHORT = 2, 6
LEFT_OUT = 0.3

_OTHER = re.compile(r"[\W_]+")
_BRACKETS = re.compile(r"[(（\[【][^)）\]】]*[)）\]】]")
_CJK = re.compile(r"[぀-ヿ一-鿿㐀-䶿]")

# Other words for labels; an argument of the operator.
LABEL_WORDS = {
    "システム": "system",
    "基幹システム": "system",
    "インターフェース": "interface",
    "インタフェース": "interface",
    "if": "interface",
    "ミドルウェア": "middleware",
    "ミドルウエア": "middleware",
    "mw": "middleware",
    "データエンティティ": "dataentity",
    "エンティティ": "dataentity",
    "api操作": "apioperation",
}


@functools.cache
def _one_form() -> dict[int, str]:
    return dict(zip(map(ord, character_map()[0]), character_map()[1]))


def plain(text: str) -> str:
    """One form of look-alike characters, composed marks, small letters."""
    if text.isascii():
        return text.translate(_one_form()).lower()
    return unicodedata.normalize("NFC", unicodedata.normalize("NFC", text.translate(_one_form()))).lower()


def compact(text: str) -> str:
    return _OTHER.sub("", "".join(c for c in text if unicodedata.category(c) != "Cf"))


def words(text: str) -> list[str]:
    """Words without their separators; a word that was cut short keeps its full stop."""
    return [w + ("." if cut else "") for w, cut in ((compact(p), p.endswith(".")) for p in re.findall(r"[^\s_/\\,;:|\-–—·・]+", text)) if w]


def deletions(text: str, most: int) -> set[str]:
    """All strings that come from ``text`` by deleting up to ``most`` characters."""
    out, last = {text}, {text}
    for _ in range(most):
        last = {s[:i] + s[i + 1 :] for s in last for i in range(len(s))}
        out |= last
    return out


def distance(a: str, b: str, most: float) -> float:
    """Damerau-Levenshtein with weights: a swap of neighbours or a doubled or dropped double letter costs
    less than another edit, an edit of the first letter a little more. Above ``most``: infinity."""
    if abs(len(a) - len(b)) > most + 1:
        return float("inf")
    before, row = None, [0.0] + list(itertools.accumulate(1.1 if j == 0 else 1.0 for j in range(len(b))))
    for i in range(1, len(a) + 1):
        now = [row[0] + (1.1 if i == 1 else 1.0)]
        for j in range(1, len(b) + 1):
            first = 0.1 if i == 1 and j == 1 else 0.0
            best = row[j - 1] + (0.0 if a[i - 1] == b[j - 1] else 1.0 + first)
            best = min(best, row[j] + (0.8 if i > 1 and a[i - 1] == a[i - 2] else 1.0), now[j - 1] + (0.8 if j > 1 and b[j - 1] == b[j - 2] else 1.0))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                best = min(best, before[j - 2] + 0.9)
            now.append(best)
        if min(now) > most:
            return float("inf")
        before, row = row, now
    return row[-1] if row[-1] <= most else float("inf")


def bound_of(spelling: str) -> int:
    return 1 if len(spelling) < SHORT or _CJK.search(spelling) else BOUND


class Dictionary:
    """Entries of the reference list: rows of (id, label, name, alternative name)."""

    def __init__(self, rows: list[tuple], label_words: Mapping[str, str] = LABEL_WORDS):
        self.label_words = label_words
        self.labels = {i: compact(plain(label or "")) for i, label, *_ in rows}
        self.spellings: dict[str, set[int]] = {}
        by_prefix: dict[str, dict[int, set[str]]] = {}
        for i, _, *names in rows:
            for name in filter(None, names):
                parts = [w.rstrip(".") for w in words(plain(name))]
                for w in parts:
                    for n in range(3, 0 if _CJK.search(w) else len(w)):
                        by_prefix.setdefault(w[:n], {}).setdefault(i, set()).add(w)
                for k in range(len(parts)):
                    self.spellings.setdefault("".join(parts[k:] + parts[:k]), set()).add(i)
        self.spellings.pop("", None)
        self.longest = max(map(len, self.spellings), default=0)
        self.most_letters = self.longest + BOUND + 3
        self.index: dict[str, list[str]] = {}
        for s in self.spellings:
            for d in deletions(s, bound_of(s)):
                self.index.setdefault(d, []).append(s)
        # What a shortened word may stand for, by entry.
        self.by_prefix = {p: {i: sorted(w) for i, w in found.items()} for p, found in by_prefix.items()}

    def written_out(self, typed: list[str]) -> set[tuple[str, ...]]:
        """The words as typed, and with the shortened ones written out as the words of one entry or another."""
        bare = tuple(w.rstrip(".") for w in typed)
        short = {k: self.by_prefix.get(w[:-1], {}) for k, w in enumerate(typed) if w.endswith(".")}
        out = {bare}
        for i in set().union(*short.values()):
            out.update(itertools.product(*[short[k][i] if k in short and i in short[k] else (w,) for k, w in enumerate(bare)]))
        return out

    def readings(self, name: str) -> dict[str, float]:
        """Readings of a typed name and what each costs."""
        text = plain(name)
        out: dict[str, float] = {}

        def add(s: str, cost: float) -> None:
            if s and len(s) <= self.longest + BOUND and cost < out.get(s, 9.0):  # longer ones are beyond the bound
                out[s] = cost

        for base, cost in ((text, 0.0), (_BRACKETS.sub(" ", text), LEFT_OUT)):
            typed = words(base)
            if not typed or len(typed) > self.most_letters:
                continue  # more words than any entry has letters
            for parts in self.written_out(typed):
                for lead in range(0, min(2, len(parts))):
                    for tail in range(0, min(3, len(parts) - lead)):
                        add("".join(parts[lead : len(parts) - tail]), cost + LEFT_OUT * (lead + tail))
            whole = "".join(w.rstrip(".") for w in typed)
            if _CJK.search(whole):
                for lead in (0, 1):
                    for tail in range(0, 5):
                        if len(whole) - lead - tail >= SHORT - 2:
                            add(whole[lead : len(whole) - tail], cost + LEFT_OUT * (lead + tail) / 2)
        return out

    def candidates(self, name: str | None) -> tuple[bool, float, list[int]]:
        """(whether no reading is a spelling as it stands, least cost, the entries at that cost)."""
        if name is None or not name.strip():
            return True, float("inf"), []
        best: dict[int, float] = {}
        readings = self.readings(name)
        exact = [r for r in readings if r in self.spellings]
        for r in exact:
            for i in self.spellings[r]:
                best[i] = min(best.get(i, 9.0), readings[r])
        if not exact:
            for r, cost in readings.items():
                met = {s for d in deletions(r, bound_of(r)) for s in self.index.get(d, ())}
                for s in met:
                    most = bound_of(s) + 0.2
                    if (far := distance(r, s, most)) <= most:
                        for i in self.spellings[s]:
                            best[i] = min(best.get(i, 9.0), cost + far)
        if not best:
            return True, float("inf"), []
        least = min(best.values())
        return not exact, round(least, 9), sorted(i for i, c in best.items() if c <= least + 1e-9)

    def label_fits(self, typed: str | None, label: str) -> bool:
        t = compact(plain(typed or ""))
        t = self.label_words.get(t, t)
        if not t or not label:
            return False
        if t == label or t.endswith(label) or (len(t) >= 3 and label.startswith(t)):
            return True
        return distance(t, label, 2.2) <= 2.2

    def resolve(self, name: str | None, label: str | None, frequency: Mapping[int, int]) -> tuple:
        """The best entry as a tuple that orders the answers of several dictionaries; its last item is the id."""
        fuzzy, cost, found = self.candidates(name)
        if not found:
            return True, float("inf"), True, 0, 0
        return min((fuzzy, cost, not self.label_fits(label, self.labels[i]), -frequency.get(i, 0), i) for i in found)


@functools.lru_cache(maxsize=1)
def _dictionary(entries: tuple[tuple, ...], label_words: tuple[tuple[str, str], ...]) -> Dictionary:
    """Kept by a worker from task to task."""
    return Dictionary(list(entries), dict(label_words))


def _mapper(entries: list[tuple], frequency: dict[int, int], label_words: Mapping[str, str], index_entries: int):
    parts = [tuple(entries[a : a + index_entries]) for a in range(0, max(1, len(entries)), index_entries)]
    words_ = tuple(label_words.items())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = list(zip(batch.column("name").to_pylist(), batch.column("label").to_pylist()))
            best: dict[tuple, tuple] = {}
            for part in parts:
                dictionary = _dictionary(part, words_)
                for pair in dict.fromkeys(pairs):
                    found = dictionary.resolve(*pair, frequency)
                    if pair not in best or (found[-1] and (not best[pair][-1] or found < best[pair])):
                        best[pair] = found
            yield pa.RecordBatch.from_arrays([batch.column("row_id"), pa.array([best[p][-1] for p in pairs], pa.int64())], names=["row_id", "ref_id"])

    return run


def map_to_canonical(
    rows: DataFrame,
    reference: DataFrame,
    *,
    row_id: str = "pos",
    name: str = "name",
    label: str = "label",
    ref_id: str = "ref_id",
    ref_names: tuple[str, ...] = ("name", "alt_name"),
    ref_label: str = "label",
    label_words: Mapping[str, str] = LABEL_WORDS,
    index_entries: int = INDEX_ENTRIES,
) -> DataFrame:
    """(row_id, ref_id) of every row; ref_id 0 where no entry fits."""
    entries = reference.select(F.col(ref_id).cast("bigint"), F.col(ref_label), *[F.col(n) for n in ref_names]).collect()
    entries = sorted((tuple(r) for r in entries), key=lambda r: (r[0], *[x or "" for x in r[1:]]))
    # How often each reference name was typed exactly: one small aggregate, at most one row an entry name.
    names = {n for r in entries for n in r[2:] if n}
    frequency: dict[int, int] = {}
    if names:
        listed = rows.sparkSession.createDataFrame([(n,) for n in sorted(names)], "typed string")
        typed = rows.select(F.col(name).alias("typed")).join(F.broadcast(listed), "typed", "left_semi")  # the list is with every worker anyway
        counts = {r.typed: r["count"] for r in typed.groupBy("typed").count().collect()}
        for r in entries:
            frequency[r[0]] = sum(counts.get(n, 0) for n in set(r[2:]) if n)
    given = rows.select(F.col(row_id).cast("bigint").alias("row_id"), F.col(name).cast("string").alias("name"), F.col(label).cast("string").alias("label"))
    return given.mapInArrow(_mapper(entries, frequency, label_words, index_entries), "row_id bigint, ref_id bigint")
