"""Text expressions: normalisation, identifiers, keyword and name extraction, language.

Everything here is a Column built from JVM-side functions. Regular expressions carry ``(?U)`` so that
word characters and blanks mean the Unicode ones.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Names of systems looked for in texts, in this order.
SYSTEM_NAMES = ("SAP", "DataSpider", "ANDPAD", "S4/HANA", "S4HANA", "NTT DATA", "中間F", "中間ファイル")
# API names looked for in texts.
API_NAMES = (
    "発注作成|発注変更|発注取消|発注一覧取得|発注明細|発注ステータス変更|納品一覧取得|納品明細|納品のデータ編集|納品のキャンセル|納品キャンセル"
    "|請負済の取り下げ|請負済のデータ編集|発注情報登録|SAP_EDI_\\w+"
)
# Words that are no search terms.
STOP_WORDS = ("the", "and", "for", "from", "with", "that", "this", "are", "was", "how", "what", "where")
MORE_STOP_WORDS = (*STOP_WORDS, "also", "which", "about", "into")


def strip(c: Column) -> Column:
    """Without Unicode blanks at both ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def safe_str(c: Column) -> Column:
    """'' for null and for the words that stand for a missing value."""
    text = c.cast("string")
    return F.when(text.isNull() | strip(text).isin("nan", "None", "null", "NaN"), F.lit("")).otherwise(text)


def non_blank(c: Column) -> Column:
    """null for null, empty and blank texts."""
    return F.when(strip(c) != "", c)


def normalize_id(c: Column, mode: str = "ascii") -> Column:
    """An identifier part: small letters, digits and single underscores; ``unknown`` if nothing is left.

    ``ascii`` keeps a-z only, so names in other scripts collapse to ``unknown``; ``unicode`` keeps all letters.
    """
    other = {"ascii": r"[^a-z0-9_]", "unicode": r"[^\p{L}\p{N}_]"}[mode]
    text = F.regexp_replace(F.lower(strip(F.coalesce(c, F.lit("")))), other, "_")
    text = F.regexp_replace(F.regexp_replace(text, "_+", "_"), "^_|_$", "")
    return F.when(text == "", F.lit("unknown")).otherwise(text)


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def all_matches(c: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(c, F.lit(pattern), group)


def found_systems(c: Column, names: Sequence[str] = SYSTEM_NAMES) -> Column:
    """The listed names that occur in a text in any case, in the order of the list."""
    return F.array_compact(F.array(*[F.when(F.lower(c).contains(n.lower()), F.lit(n)) for n in names]))


def found_apis(c: Column, pattern: str = API_NAMES) -> Column:
    return F.array_distinct(all_matches(c, f"(?U)(?:{pattern})"))


FIELD_CODE = r"(?m)^### .+?\(`([A-Z]{2}\d{7})`\)"


def field_codes(c: Column) -> Column:
    return F.array_distinct(all_matches(c, FIELD_CODE, 1))


def found_fields(c: Column, most: int = 20) -> Column:
    """Names of numbered table rows, at most ``most``; where there are none, field codes of headings."""
    cells = F.transform(all_matches(c, r"\|\s*(\d+)\s*\|\s*([^\|]{3,50}?)\s*\|", 2), strip)
    names = F.array_distinct(F.filter(cells, lambda x: (F.length(x) > 1) & ~x.startswith("-")))
    return F.slice(F.when(F.size(names) > 0, names).otherwise(field_codes(c)), 1, most)


def leading_section(c: Column) -> Column:
    """The heading of second level a text begins with, else ''."""
    return F.regexp_extract(c, r"\A## .+", 0)


def first_section(c: Column) -> Column:
    """The title of the first heading of second level anywhere in a text, else ''."""
    return strip(F.regexp_extract(c, r"(?m)^## (.*)$", 1))


def share_of(c: Column, characters: str) -> Column:
    """Share of a text's characters that belong to a class; 0 for an empty text."""
    n = F.length(c)
    return F.when(n > 0, F.length(F.regexp_replace(c, f"[^{characters}]", "")) / n).otherwise(F.lit(0.0))


KANA, HAN = r"぀-ヿ", r"一-鿿"


def language_by_share(c: Column, kana: float = 0.02, han: float = 0.05) -> Column:
    """ja, zh or en by the shares of kana and of Chinese characters."""
    return F.when(share_of(c, KANA) > kana, "ja").when(share_of(c, HAN) > han, "zh").otherwise("en")


def language_by_count(c: Column, kana: int = 5, han: int = 10) -> Column:
    """ja, zh or en by how many kana and Chinese characters there are."""
    count = lambda cls: F.length(F.regexp_replace(c, f"[^{cls}]", ""))
    return F.when(count(KANA) > kana, "ja").when(count(HAN) > han, "zh").otherwise("en")


def _without(words: Sequence[str], found: Column) -> Column:
    return F.filter(found, lambda x: ~F.lower(x).isin(*words))


def lexical_keywords(c: Column) -> Column:
    """Runs of CJK characters, then Latin identifiers of two letters or more, joined by blanks."""
    cjk = all_matches(c, r"[　-鿿豈-﫿]+")
    latin = F.filter(all_matches(c, "[A-Za-z_][A-Za-z0-9_]*"), lambda x: F.length(x) > 1)
    return F.array_join(F.concat(cjk, latin), " ")


def search_keywords(c: Column) -> Column:
    """Terms of a lexical search: kanji of two, katakana of three, Latin of two characters or more."""
    return F.array_distinct(
        F.concat(all_matches(c, r"[一-鿿㐀-䶿]{2,}"), all_matches(c, r"[゠-ヿ]{3,}"), all_matches(c, "[A-Za-z][A-Za-z0-9_]+"))
    )


def graph_keywords(c: Column, most: int = 10) -> Column:
    """Terms for names of graph nodes: quoted words, kanji, mixed Japanese, Latin of four characters or more."""
    quoted = F.filter(F.transform(all_matches(c, "`([^`]+)`", 1), strip), lambda x: x != "")
    latin = _without(MORE_STOP_WORDS, all_matches(c, r"(?U)\b[A-Za-z_][A-Za-z0-9_.]{3,}\b"))
    found = F.concat(quoted, all_matches(c, r"[一-鿿]{2,}"), all_matches(c, r"[一-鿿゠-ヿ]{3,}"), latin)
    return F.slice(F.array_distinct(found), 1, most)


def guidance_terms(c: Column, most: int = 12) -> Column:
    """Terms that guide a search through the graph: systems and APIs, upper case, camel case, Japanese, other Latin words."""
    named = F.array_sort(F.array_distinct(F.concat(found_systems(c), found_apis(c))))
    upper, camel = all_matches(c, r"(?U)\b[A-Z][A-Z0-9_]{2,}\b"), all_matches(c, r"(?U)\b[A-Z][a-z]+(?:[A-Z][a-z]+)+\b")
    japanese = F.concat(all_matches(c, r"[゠-ヿ]{2,}"), all_matches(c, r"[一-鿿]{2,}"), all_matches(c, r"[一-鿿゠-ヿ]{3,}"))
    words = _without(STOP_WORDS, all_matches(c, r"(?U)\b[A-Za-z]{3,}\b"))

    def merged(x: Column) -> Column:
        known, lower = F.transform(x["before"], F.lower), F.transform(x["words"], F.lower)
        fresh = F.filter(x["words"], lambda w, i: ~F.array_contains(known, F.lower(w)) & (F.array_position(lower, F.lower(w)) == i + 1))
        return F.slice(F.concat(x["before"], fresh), 1, most)

    return let(F.struct(F.array_distinct(F.concat(named, upper, camel, japanese)).alias("before"), words.alias("words")), merged)


def boost_keywords(c: Column, whole: int = 6) -> Column:
    """Words that raise a hit: the whole query if long enough, kanji, kana, mixed, Latin of four or more."""
    own = F.when(F.length(strip(c)) >= whole, F.array(strip(c))).otherwise(F.array().cast("array<string>"))
    return F.concat(
        own, all_matches(c, r"[一-鿿]{2,}"), all_matches(c, r"[゠-ヿ]{2,}"),
        all_matches(c, r"[一-鿿゠-ヿ]{3,}"), all_matches(c, "[A-Za-z_][A-Za-z0-9_]{3,}"),
    )


def sheet_number(c: Column) -> Column:
    """7 for ``sheet_07``, else null."""
    return F.nullif(F.regexp_extract(c, r"^sheet_(\d+)", 1), F.lit("")).cast("int")


def first_number(c: Column) -> Column:
    return F.regexp_extract(c, r"(\d+)", 1)


def line_breaks(c: Column) -> Column:
    """HTML line breaks as line ends."""
    return F.regexp_replace(c, r"(?i)<br\s*/?>", "\n")


def json_list(c: Column) -> Column:
    """A list that may be stored as JSON or as one plain value."""
    parsed = F.from_json(c, "array<string>")
    plain = F.when(strip(c) == "", F.array().cast("array<string>")).otherwise(F.array(c))
    return F.when(c.isNull(), F.array().cast("array<string>")).when(c.startswith("["), F.coalesce(parsed, plain)).otherwise(plain)
