"""Duplicates hidden by formatting differences (problem 1).

Records that differ only in white space, letter case, punctuation or field order are one record.
Method: Merkle-style hashing from the leaves up. A leaf is a text brought to its letters and digits
in lower case; a node's digest is the hash of its children's digests, which are sorted first where
their order carries no meaning; equal root digests make a group, and a full comparison of the
normalised structure confirms it.

For chunks a record is one ordered leaf (its whole content), or, with chunk_type ``field_def``, an
unordered node with a leaf per line. The node's kind is part of its digest, so the two never meet.

Defined results:

* null contents and those without a letter or digit take no part and give no row;
* a null chunk_type is not ``field_def``;
* lines without letters and digits are dropped, repeated lines count (as a bag);
* combining marks are no letters: they are dropped, a composed letter is kept as it is;
* repeated rows are copies like any other; ties on nothing, since positions are unique;
* an empty table gives an empty result; further columns are ignored, whatever their names.

Scale: the text is read once for the digests, which are written as a small table of (pos, root).
Counting copies is an aggregate that combines on the map side, so a group that holds a third of all
rows costs one row per task. Only rows whose root occurs more than once are read again, behind a Bloom filter of
their ids. Groups with more than 1/32 of the rows (31 at most) are dealt to ``salts`` buckets, so that no hot
group ends in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioscope.operators import bloom as bf
from folioscope.runtime import materialize

LINE_ENDS = r"\r\n|[\n\x0B\f\r\x{85}\x{2028}\x{2029}]"
HOT_SHARE = 32
NOT_LETTER_OR_DIGIT = r"[^\p{L}\p{N}]+"


def leaf(text: Column) -> Column:
    """Letters and digits of a text in one case."""
    return F.lower(F.regexp_replace(text, NOT_LETTER_OR_DIGIT, ""))


def unordered_leaves(text: Column) -> Column:
    """The normalised lines of a text as a sorted bag."""
    lines = F.split(text, LINE_ENDS, -1)
    return F.array_sort(F.filter(F.transform(lines, leaf), lambda x: x != ""))


def ordered_node(kind: str, children: Column) -> Column:
    """Digest (64 hex digits) of children whose order counts, given as an array of strings."""
    digests = F.transform(children, lambda x: F.sha2(x, 256))
    return F.sha2(F.concat(F.lit(kind + ":"), F.array_join(digests, "")), 256)


def unordered_node(kind: str, children: Column) -> Column:
    """Digest of children whose order does not count: their digests are sorted first."""
    digests = F.array_sort(F.transform(children, lambda x: F.sha2(x, 256)))
    return F.sha2(F.concat(F.lit(kind + ":"), F.array_join(digests, "")), 256)


def normalised(chunks: DataFrame, *, row_id: str, text: str, kind: str, fields_kind: str) -> DataFrame:
    """row_id, is_fields, leaves: the normalised structure of every record that has one."""
    return chunks.select(
        F.col(row_id).alias("row_id"),
        F.coalesce(F.col(kind) == fields_kind, F.lit(False)).alias("is_fields"),
        F.col(text).alias("text"),
    ).select(
        "row_id",
        "is_fields",
        F.when(F.col("is_fields"), unordered_leaves(F.col("text"))).otherwise(F.filter(F.array(leaf(F.col("text"))), lambda x: x != "")).alias("leaves"),
    ).filter(F.size("leaves") > 0)


def root_digest() -> Column:
    root = F.when(F.col("is_fields"), unordered_node("fields", F.col("leaves"))).otherwise(ordered_node("text", F.col("leaves")))
    return F.unhex(root)


def structure() -> Column:
    """The whole normalised structure as one string, for the full comparison."""
    return F.concat_ws("\n", F.col("is_fields").cast("string"), F.col("leaves"))


class LayoutIndex:
    """The records of one table grouped by normalised structure.

    ``roots``: row_id, root of every record that takes part. ``classes``: root, structure,
    first_row, copies of every class of two or more records, confirmed by full comparison.
    """

    def __init__(self, chunks: DataFrame, *, row_id: str = "pos", text: str = "content", kind: str = "chunk_type", fields_kind: str = "field_def"):
        tree = dict(row_id=row_id, text=text, kind=kind, fields_kind=fields_kind)
        self.roots = materialize(normalised(chunks, **tree).select("row_id", root_digest().alias("root")), "roots")
        per_root = self.roots.groupBy("root").agg(F.count("*").alias("n"))
        wanted = materialize(self.roots.join(per_root.filter("n > 1").select("root"), "root", "left_semi").select("row_id"), "wanted")
        # Only rows that may share a root are brought to their structure: those that pass the filter in the scan.
        blocks = bf.blocks_for(wanted.count())
        given = chunks.select(F.col(row_id).alias("row_id"), F.col(text).alias("text"), F.col(kind).alias("kind"))
        passed = bf.probe(given, F.col("row_id"), bf.build(wanted, F.col("row_id"), blocks), blocks, "maybe").filter("maybe").drop("maybe")
        self._tree = normalised(passed, row_id="row_id", text="text", kind="kind", fields_kind=fields_kind)
        maybe = self._tree.withColumn("root", root_digest())
        grouped = maybe.groupBy("root", structure().alias("structure")).agg(F.min("row_id").alias("first_row"), F.count("*").alias("copies"))
        grouped = materialize(grouped, "grouped")
        self.classes = grouped.filter("copies > 1")
        # Records whose structure, not root, tells them apart. With 256 bits none was ever seen.
        forms = grouped.groupBy("root").agg(F.count("*").alias("forms")).filter("forms > 1").select("root")
        self.clashes = materialize(forms, "clashes")

    def copies(self, salts: int = 16) -> DataFrame:
        """(first_row, row_id) of every record that repeats an earlier one."""
        clashes = self.clashes.select("root")
        least = max(1000, self.roots.count() // HOT_SHARE)
        hot = F.broadcast(self.classes.groupBy("root").agg(F.sum("copies").alias("n")).filter(F.col("n") > least).select("root", F.lit(True).alias("hot")))
        buckets = F.when(F.col("hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
        plain = self.classes.join(clashes, "root", "left_anti").join(hot, "root", "left").select(F.col("root").alias("c_root"), "first_row", F.explode(buckets).alias("c_salt"))
        salt = F.when(F.col("hot"), F.pmod(F.xxhash64("row_id"), F.lit(salts))).otherwise(F.lit(0)).cast("int")
        rows = self.roots.join(hot, "root", "left").withColumn("salt", salt).drop("hot")
        same = (F.col("root") == F.col("c_root")) & (F.col("salt") == F.col("c_salt")) & (F.col("row_id") > F.col("first_row"))
        copies = rows.join(plain, same).select("first_row", "row_id")
        if self.clashes.isEmpty():
            return copies
        told_apart = self.classes.join(clashes, "root", "left_semi").drop("root")
        exact = self._tree.withColumn("structure", structure()).join(told_apart, "structure").filter("row_id > first_row")
        return copies.unionByName(exact.select("first_row", "row_id"))

    def distinct(self) -> DataFrame:
        """(first_row, copies) of every distinct content, unique ones with one copy."""
        repeats = self.copies()
        firsts = self.roots.select("row_id").join(repeats.select("row_id"), "row_id", "left_anti")
        return firsts.join(self.classes.select(F.col("first_row").alias("row_id"), "copies"), "row_id", "left").select(
            F.col("row_id").alias("first_row"), F.coalesce("copies", F.lit(1)).cast("bigint").alias("copies")
        )
