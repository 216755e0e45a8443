"""Visually identical text with different characters (problem 3).

Two texts look the same if they agree apart from full- and half-width forms, composed or decomposed
marks, characters that show nothing, the kind of a blank and letters of another script drawn like a
Latin letter. Case, accents, number and place of blanks and line breaks, digits against letters and
raised or circled digits stay visible differences.

Method: a character map (JVM side, ``translate``) sends each character to the one it looks like;
mapped texts are then grouped in SQL under Spark's ``UNICODE`` collation, which is sensitive to case
and accents and knows canonical equivalence, so that composed and decomposed marks are equal. Each
class has one canonical member, chosen deterministically, which is joined back.

A collation key costs far more than a hash. So a cheap skeleton comes first: the mapped text without
its marks, composed letters cut to their base. Equal look implies equal skeletons, so only rows whose
skeleton occurs with at least two different stored texts (found by an aggregate over a small table,
then a bounded Bloom filter in the scan) come before the collation. Nothing is lost by it.

Defined results:

* null and blank texts (no visible character) take no part;
* rows with the same stored text are never a pair; repeated rows pair with others one by one;
* a zero-width joiner between two pictographs is visible, elsewhere it shows nothing;
* a carriage return is a line break of its own, a tab is no kind of blank;
* an empty table gives no rows; further columns are ignored, whatever their names.
"""

from __future__ import annotations

import functools
import sys
import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioscope.operators import bloom as bf
from folioscope.runtime import materialize

# Letters of other scripts drawn like a Latin letter, in pairs.
LOOK_ALIKE = (
    # Cyrillic capitals and small letters
    "АA ВB ЕE ЅS ІI ЈJ КK МM НH ОO РP СC ТT УY ХX ҮY ԚQ ԜW аa еe оo рp сc уy хx ѕs іi јj һh ԁd ԛq ԝw ӏl "
    # Greek capitals and small letters
    "ΑA ΒB ΕE ΖZ ΗH ΙI ΚK ΜM ΝN ΟO ΡP ΤT ΥY ΧX οo νv ϳj ϹC ϲc "
    # Armenian
    "ՕO օo ՍU"
).split()

#: Blanks of other kinds than U+0020, each one blank wide.
BLANKS = "\u00A0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u202F\u205F\u3000"

#: Characters that show nothing, as a Java character class.
NOTHING = (
    r"[\u0000-\u0008\u000E-\u001F\u007F-\u0084\u0086-\u009F\u00AD\u034F\u061C\u115F\u1160\u17B4\u17B5\u180B-\u180F"
    r"\u200B-\u200F\u202A-\u202E\u2060-\u206F\u3164\uFE00-\uFE0F\uFEFF\uFFA0\uFFF0-\uFFF8"
    r"\x{1D173}-\x{1D17A}\x{E0000}-\x{E0FFF}]+"
)
#: A joiner between pictographs, which is visible; it is kept as a private character.
JOINER = r"([\p{So}\uFE0F\x{1F3FB}-\x{1F3FF}])\u200D(?=\p{So})"
JOINED = "$1\uE0A0"


@functools.cache
def character_map() -> tuple[str, str]:
    """(from, to): width forms by their compatibility mapping, blanks, look-alike letters."""
    pairs = {a: b for a, b in LOOK_ALIKE} | dict.fromkeys(BLANKS, " ")
    for code in (*range(0xFF01, 0xFFBF), *range(0xFFC2, 0xFFE0), *range(0xFFE0, 0xFFEF)):
        wide = unicodedata.normalize("NFKC", chr(code))
        if len(wide) == 1 and wide != chr(code) and code != 0xFFA0:
            pairs[chr(code)] = wide
    for code in (*range(0x0370, 0x0530), *range(0x1F00, 0x2000)):  # look-alike letters with marks
        base, *marks = unicodedata.normalize("NFD", chr(code))
        latin = unicodedata.normalize("NFC", pairs.get(base, base) + "".join(marks))
        if marks and base in pairs and len(latin) == 1:
            pairs[chr(code)] = latin
    return "".join(pairs), "".join(pairs.values())


@functools.cache
def base_map() -> tuple[str, str]:
    """(from, to): every composed character and the first of its full canonical decomposition."""
    pairs = {}
    for code in range(0xC0, sys.maxunicode + 1):
        if 0xAC00 <= code <= 0xD7A3 or 0xD800 <= code <= 0xDFFF:
            continue
        ch = chr(code)
        if unicodedata.decomposition(ch) and not unicodedata.decomposition(ch).startswith("<"):
            pairs[ch] = unicodedata.normalize("NFD", ch)[0]
    return "".join(pairs), "".join(pairs.values())


@functools.cache
def skeleton_map() -> tuple[str, str]:
    """(from, to): both maps in one, a character sent to the base letter of the one it looks like."""
    look, base = (dict(zip(*m())) for m in (character_map, base_map))
    pairs = {}
    for ch in {*look, *base}:
        to = look.get(ch, ch)
        to = base.get(to, to)
        to = look.get(to, to)
        if to != ch:
            pairs[ch] = to
    return "".join(pairs), "".join(pairs.values())


def shown(text: Column) -> Column:
    """The text without what shows nothing; joiners between pictographs are kept as a character of their own."""
    return F.regexp_replace(F.regexp_replace(text, JOINER, JOINED), NOTHING, "")


def one_form(text: Column) -> Column:
    """The text with every character sent to the one it looks like (marks stay as they are)."""
    return F.translate(shown(text), *character_map())


def skeleton(text: Column) -> Column:
    """What texts of one look have in common: base letters, no marks, no Hangul."""
    return F.regexp_replace(F.translate(shown(text), *skeleton_map()), r"[\p{M}\p{Lm}\p{Sk}\u1100-\u11FF\uAC00-\uD7A3]+", "")


#: A class with more than this part of the members is dealt out.
HOT_SHARE = 32


class LookAlikes:
    """Classes of texts of one table that look the same but differ as stored.

    ``members``: row_id, class_id (the smallest row_id), raw, canonical of every row whose class has
    two or more stored forms.
    """

    def __init__(self, df: DataFrame, *, row_id: str, text: str):
        spark = df.sparkSession
        given = df.select(F.col(row_id).alias("row_id"), F.col(text).alias("raw")).filter(F.col("raw").isNotNull())
        bones = given.select("row_id", F.xxhash64(skeleton(F.col("raw"))).alias("bones"), F.xxhash64("raw").alias("form"))
        small = materialize(bones, "bones")
        several = small.groupBy("bones").agg(F.min("form").alias("a"), F.max("form").alias("b")).filter("a <> b").select("bones")
        wanted = materialize(small.join(several, "bones", "left_semi").select("row_id"), "wanted")
        # The texts of the wanted rows: a bounded Bloom filter in the scan, before any text is mapped or moved.
        blocks = bf.blocks_for(wanted.count())
        passed = bf.probe(given, F.col("row_id"), bf.build(wanted, F.col("row_id"), blocks), blocks, "maybe").filter("maybe")
        near = passed.select("row_id", "raw").join(wanted, "row_id", "left_semi").withColumn("mapped", one_form(F.col("raw")))
        near = materialize(near, "near").filter(F.col("mapped").rlike(r"(?U)\S"))
        # Deterministic member: the one with least foreign characters, then the smallest as stored.
        self.members = spark.sql(
            """
            WITH classes AS (
              SELECT collate(mapped, 'UNICODE') AS look, min(row_id) AS class_id,
                     min(struct(raw <> collate(mapped, 'UTF8_BINARY') AS changed, raw)).raw AS canonical
              FROM {near} GROUP BY collate(mapped, 'UNICODE') HAVING min(raw) <> max(raw))
            SELECT n.row_id, c.class_id, n.raw, c.canonical
            FROM {near} n JOIN classes c ON collate(n.mapped, 'UNICODE') = c.look
            """,
            near=near,
        )

    def pairs(self, salts: int = 16) -> DataFrame:
        """(row_a, row_b): row_a < row_b, same look, different as stored.

        Classes with more than 1/32 of the members (31 at most) are dealt to ``salts`` buckets on one side.
        """
        m = materialize(self.members.select("row_id", "class_id", F.sha2("raw", 256).alias("form")), "members")
        least = max(1000, m.count() // HOT_SHARE)
        hot = F.broadcast(m.groupBy("class_id").count().filter(F.col("count") > least).select("class_id", F.lit(True).alias("hot")))
        m = m.join(hot, "class_id", "left")
        a = m.withColumn("salt", F.when(F.col("hot"), F.pmod(F.xxhash64("row_id"), F.lit(salts))).otherwise(F.lit(0)).cast("int"))
        buckets = F.when(F.col("hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
        b = m.select(F.col("row_id").alias("row_b"), F.col("class_id").alias("class_b"), F.col("form").alias("form_b"), F.explode(buckets).alias("salt_b"))
        near = (F.col("class_id") == F.col("class_b")) & (F.col("salt") == F.col("salt_b")) & (F.col("row_id") < F.col("row_b")) & (F.col("form") != F.col("form_b"))
        return a.join(b, near).select(F.col("row_id").alias("row_a"), "row_b")
