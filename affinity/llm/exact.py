"""Exact duplicates of texts, up to white space, by 128-bit content hashes.

1. *Hash*: a text without its ASCII white space is known by its MD5, 128 bits.
2. *Group*: hashes are counted, and each group's row to keep is chosen, by an aggregation that
   combines before it shuffles: a group with a third of all rows is one row per task.
3. *Compare*: of the hashes that more than one row has, the smallest and the largest text are
   found, byte by byte, again combined first. Where the two are equal, so are all texts of the
   group. Where they are not, hashes have collided, and the rows of these hashes are grouped
   anew by the texts themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinity.llm.common import partitions, small, workspace

# Fixed value: the white space that is not compared.
BLANKS = " \t\n\x0b\x0c\r"
# Hexadecimal digits of the hash that are used: all 128 bits.
DIGITS = 32


def squeezed(text: Column) -> Column:
    """``text`` without white space; null is empty."""
    out = F.coalesce(text, F.lit(""))
    for blank in BLANKS:
        out = F.replace(out, F.lit(blank), F.lit(""))
    return out


def _hashed(docs: DataFrame, digits: int) -> DataFrame:
    """(doc_id, size, hash, sha, body, row): ``row`` holds all columns, ``body`` is compared."""
    rows = docs.select(
        F.struct(*docs.columns).alias("row"), squeezed(F.col("text")).alias("body"),
        F.length(F.coalesce("text", F.lit(""))).alias("size"),
    )
    body = F.col("body").cast("binary")
    return rows.select(
        F.col("row.doc_id").alias("doc_id"), "size", F.unhex(F.substring(F.md5(body), 1, digits)).alias("hash"),
        F.unhex(F.sha2(body, 256)).alias("sha"), "body", "row",
    )


def _repeated(rows: DataFrame, *key: str) -> DataFrame:
    """(*key, n, keep_id, keep_size): of the keys with more rows than one, their number and the kept row."""
    order = F.struct((-F.col("size")).alias("less"), F.col("doc_id").isNull().alias("unnamed"), "doc_id")
    groups = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("first"))
    return groups.filter("n > 1").select(
        *key, "n", F.col("first.doc_id").alias("keep_id"), (-F.col("first.less")).alias("keep_size")
    )


def _collided(texts: DataFrame, repeated: DataFrame, n: int) -> DataFrame:
    """The repeated hashes that different texts have, found by comparing all their bytes."""
    members = texts.select("hash", "body", "doc_id").join(small(repeated.select("hash"), n), "hash")
    if small(repeated, n) is repeated:
        # Joined by shuffle: dealt out again, so that the join may be split at hot hashes.
        salt = F.pmod(F.xxhash64("doc_id"), F.lit(64))
        members = members.repartition(partitions(texts.sparkSession), "hash", salt)
    ends = members.groupBy("hash").agg(F.min("body").alias("low"), F.max("body").alias("high"))
    return ends.filter("low <> high").select("hash")


def _decided(rows: DataFrame, groups: DataFrame, n: int, key: list[str]) -> DataFrame:
    """``rows`` with what their group says; a row without one is a group by itself."""
    alone = F.col("n").isNull()
    is_kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("size") == F.col("keep_size"))
    return rows.join(small(groups, n), key, "left").select(
        "*",
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("chosen"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        (alone | is_kept).alias("kept"),
    )


def _marked(docs: DataFrame, digits: int, columns: list[str]) -> DataFrame:
    """``columns`` of :func:`_hashed` with ``chosen``, ``group_size`` and ``kept``."""
    work = workspace(docs.sparkSession)
    texts = _hashed(docs, digits)
    keyed = work.write("hashed", texts.select("doc_id", "size", "hash", "sha"))
    repeated = work.write("repeated", _repeated(keyed, "hash"))
    n = repeated.count()
    collided = work.write("collided", _collided(texts, repeated, n))
    n_collided = collided.count()
    rows = keyed if "row" not in columns else texts
    if not n_collided:
        return _decided(rows, repeated, n, ["hash"]).select(*columns, "chosen", "group_size", "kept")
    good = repeated.join(small(collided, n_collided), "hash", "left_anti")
    plain = rows.join(small(collided, n_collided), "hash", "left_anti")
    mixed = texts.join(small(collided, n_collided), "hash", "left_semi")
    by_text = work.write("by_text", _repeated(mixed, "hash", "body"))
    out = ["chosen", "group_size", "kept"]
    return (
        _decided(plain, good, n, ["hash"])
        .select(*columns, *out)
        .union(_decided(mixed, by_text, by_text.count(), ["hash", "body"]).select(*columns, *out))
    )


def exact_groups(docs: DataFrame, digits: int = DIGITS) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) for every row of ``docs(doc_id, text)``.

    Texts are equal if they are so without the six ASCII blanks; null counts as empty. Of equal
    texts the row with the most code points stays, then the one with the smallest doc_id, and
    rows without a doc_id come last. ``text_sha256`` is that of the text without blanks, in
    UTF-8. ``digits`` of the hash group the texts; fewer make more collisions and no difference.

    Every row counts in ``group_size``. Rows that repeat a doc_id and have equal texts of one length
    are the same document: all of them are kept, or none. Empty and null texts are
    one group. A text is held by one task at a time, however long. An empty table gives an empty
    result; other columns are not read.
    """
    out = _marked(docs.select("doc_id", "text"), digits, ["doc_id", "sha"])
    return out.select(
        "doc_id", F.col("chosen").alias("keep_id"), "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256")
    )


def drop_copies(docs: DataFrame, digits: int = DIGITS) -> DataFrame:
    """``docs``, all columns, without the rows whose text another row keeps."""
    return _marked(docs, digits, ["row"]).filter("kept").select("row.*")
