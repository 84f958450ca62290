"""Benchmark decontamination with a distributed positional inverted index.

Only DataFrame and SQL functions are used; no Python runs on rows.

1. *Lexicon*: how long the posting list of each benchmark term is in the documents. Terms that
   no test text has are dropped before anything is shuffled.
2. *Probes*: of every test window, the rarest terms. Windows that overlap mostly share them.
3. *Index*: postings (term, document, position) of the probe terms, written in order of terms.
4. *Intersection*: a posting minus the probe's place in the item is an alignment of item and
   document. Offset-adjusted lists meet by (document, item, alignment); where both rarest terms
   of some window are found, the alignment is kept.
5. *Confirmation*: alignments go back to their document, where the words of the item are
   compared in place. Runs of equal words as long as a window are exact phrase matches.

Documents are known by a 64-bit hash of id and text in between. As all words are compared in
the document at the end, and bad documents are left out by their id as well, a collision costs
time but no exactness.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.llm.common import few, small, workspace

WINDOW = 13
# Rarest terms of a window that are intersected before words are compared.
RAREST = 2
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Everything between words: ASCII but digits and letters. Letters of either case are alike.
_BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def split_words(text: str) -> F.Column:
    """Words in their own case; null text has none."""
    found = F.array_remove(F.split(F.col(text), _BETWEEN, -1), "")
    return F.coalesce(found, F.array().cast("array<string>"))


def folded(word: F.Column) -> F.Column:
    """A-Z lower-cased. ``lower`` does the same, and faster, where all letters are ASCII."""
    ascii_only = F.octet_length(word) == F.char_length(word)
    return F.when(ascii_only, F.lower(word)).otherwise(F.translate(word, _UPPER, _LOWER))


def _with_key(docs: DataFrame) -> DataFrame:
    """(key, text, row): the other columns stay together, whatever their names."""
    row = F.struct(*[c for c in docs.columns if c != "text"])
    return docs.select(F.xxhash64("doc_id", "text").alias("key"), "text", row.alias("row"))


def _positions(docs: DataFrame) -> DataFrame:
    """(key, pos, term) of every word; a term is the hash of a folded word."""
    words = docs.select("key", F.posexplode(split_words("text")).alias("pos", "word"))
    return words.select("key", "pos", F.xxhash64(folded(F.col("word"))).alias("term"))


class PhraseIndex:
    """Postings of the documents for the rarest terms of all windows of the items.

    ``docs(doc_id, text)``, ``items(item_id, text)``. Items without an id, or without words,
    are left out; equal items count once. Other columns are not read.
    """

    def __init__(self, docs: DataFrame, items: DataFrame, window: int = WINDOW):
        self.window, self.work = window, workspace(docs.sparkSession)
        self.docs = _with_key(docs)
        self.items = self._items(items)
        self.n_items, n_words = self.items.agg(
            F.count(F.lit(1)), F.coalesce(F.sum(F.size("words")), F.lit(0))
        ).first()
        self.lexicon = self._lexicon()
        self.windows = self.work.write("windows", few(self._windows(), self.n_items))
        # As many as the items have words, at most.
        self.probes = self.work.write("probes", few(self._probes(), n_words))
        self.n_probes = self.probes.count()
        self.postings = self._postings()

    def _items(self, items: DataFrame) -> DataFrame:
        words = F.transform(split_words("text"), folded)
        found = (
            items.select("item_id", "text")
            .filter("item_id is not null")
            .select("item_id", words.alias("words"))
            .filter(F.size("words") > 0)
            .distinct()
            .withColumn("item", F.xxhash64("item_id", "words"))
        )
        return self.work.write("items", found)

    def _terms(self) -> DataFrame:
        return self.items.select("item", F.posexplode("words").alias("place", "word")).select(
            "item", "place", F.xxhash64("word").alias("term")
        )

    def _lexicon(self) -> DataFrame:
        vocabulary = self._terms().select("term").distinct()
        n = vocabulary.count()
        counted = (
            _positions(self.docs)
            .select("term")
            .join(small(vocabulary, n), "term")
            .groupBy("term")
            .agg(F.count(F.lit(1)).alias("postings"))
        )
        return self.work.write("lexicon", few(counted, n))

    def _windows(self) -> DataFrame:
        """(item, words, item_id, windows): the places of the rarest terms of every window."""
        entry = F.struct("place", "term", "postings")
        known = (
            self._terms()
            .join(self.lexicon, "term", "left")
            .withColumn("postings", F.coalesce("postings", F.lit(0)))
            .groupBy("item")
            .agg(F.sort_array(F.collect_list(entry)).alias("terms"))
        )
        width = F.least(F.lit(self.window), F.size("terms"))
        by_rarity = lambda s: F.sort_array(
            F.transform(
                F.slice("terms", s, width),
                lambda t: F.struct(t["postings"].alias("postings"), t["place"].alias("place"), t["term"].alias("term")),
            )
        )
        rarest = F.transform(
            F.sequence(F.lit(1), F.size("terms") - width + 1), lambda s: F.slice(by_rarity(s), 1, RAREST)
        )
        # A window with a term that no document has is found nowhere.
        found = F.filter(rarest, lambda w: w[0]["postings"] > 0)
        return self.items.join(known.select("item", found.alias("windows")), "item")

    def _probes(self) -> DataFrame:
        each = self.windows.select("item", F.explode("windows").alias("window"))
        probe = each.select("item", F.inline("window"))
        return probe.select("item", "place", "term").distinct()

    def _postings(self) -> DataFrame:
        terms = self.probes.select("term").distinct()
        n = terms.count()
        found = _positions(self.docs).join(small(terms, n), "term")
        return self.work.write("postings", found.sortWithinPartitions("term", "key", "pos"))

    def alignments(self) -> DataFrame:
        """(key, item, shift): where both rarest terms of a window stand at their offsets."""
        met = (
            self.postings.join(small(self.probes, self.n_probes), "term")
            .select("key", "item", (F.col("pos") - F.col("place")).alias("shift"), "place")
            .groupBy("key", "item", "shift")
            .agg(F.collect_set("place").alias("places"))
        )
        both = F.exists(
            "windows", lambda w: F.forall(w, lambda t: F.array_contains("places", t["place"]))
        )
        items = self.windows.select("item", "windows")
        return met.join(small(items, self.n_items, 50_000), "item").filter(both).select("key", "item", "shift")

    def phrases(self) -> DataFrame:
        """(key, row, n_words, hits): every row of the documents, with its exact matches.

        ``hits`` are (item_id, start, end) in words, end exclusive, one for each longest run
        of equal words that has a window in it.
        """
        items = self.items.select("item", "item_id", F.col("words").alias("item_words"))
        aligned = self.alignments().join(small(items, self.n_items, 50_000), "item")
        # A document's own alignments; they carry the item's words to it.
        per_doc = aligned.groupBy("key").agg(
            F.collect_list(F.struct("item_id", "item_words", "shift")).alias("found")
        )
        per_doc = self.work.write("per_doc", per_doc)
        met = per_doc.select("key", F.lit(True).alias("met"))
        # Only documents with an alignment bring their text along.
        docs = self.docs.join(small(met, met.count()), "key", "left").select(
            "key", "row", F.size(split_words("text")).cast("long").alias("n_words"),
            F.when(F.col("met"), F.col("text")).alias("text"),
        )
        docs = docs.join(per_doc, "key", "left").select(
            "key", "row", "n_words", split_words("text").alias("words"), "found"
        )
        none = F.array().cast(_runs_type(self.items))
        hits = F.flatten(F.transform("found", lambda f: _runs(F.col("words"), f, self.window, none)))
        return docs.select(
            "key", "row", "n_words",
            F.when(F.col("found").isNull(), none).otherwise(hits).alias("hits"),
        )

    def proximity(self, slop: int) -> DataFrame:
        """(doc_id, item_id, window, distance): the rarest terms of a window near each other.

        For every window of two words or more, in whose documents its two rarest terms stand
        within ``slop`` words of each other in any order: the smallest distance. Positions
        meet by blocks of ``slop`` words, so no document's positions are paired at large.
        """
        pairs = (
            self.windows.select("item", "item_id", F.posexplode("windows").alias("window", "terms"))
            .filter(F.size("terms") == 2)
            .select(
                "item_id", "window", F.col("terms")[0]["term"].alias("first"),
                F.col("terms")[1]["term"].alias("second"),
            )
            .filter("first <> second")
        )
        block = F.floor(F.col("pos") / slop)
        first = self.postings.select("key", F.col("term").alias("first"), F.col("pos").alias("a"), block.alias("block"))
        near = F.explode(F.array(block - 1, block, block + 1))
        second = self.postings.select("key", F.col("term").alias("second"), F.col("pos").alias("b"), near.alias("block"))
        met = (
            pairs.join(first, "first")
            .join(second, ["key", "second", "block"])
            .withColumn("distance", F.abs(F.col("a") - F.col("b")))
            .filter(F.col("distance") <= slop)
            .groupBy("key", "item_id", "window")
            .agg(F.min("distance").alias("distance"))
        )
        return self.docs.select("key", "row.doc_id").join(met, "key").drop("key")


def _runs_type(items: DataFrame) -> str:
    kind = items.schema["item_id"].dataType.simpleString()
    return f"array<struct<item_id:{kind},start:int,end:int>>"


def _runs(words: F.Column, found: F.Column, window: int, none: F.Column) -> F.Column:
    """Longest runs of equal words of one alignment that hold a window."""
    low = F.greatest(F.lit(0), -found["shift"])
    high = F.least(F.size(found["item_words"]), F.size(words) - found["shift"])
    n = F.greatest(high - low, F.lit(0))
    own = F.slice(words, found["shift"] + low + 1, n)
    other = F.slice(found["item_words"], low + 1, n)
    marks = F.array_join(
        F.zip_with(own, other, lambda a, b: F.when(folded(a) == b, "1").otherwise("0")), ""
    )
    width = F.least(F.lit(window), F.size(found["item_words"]))
    parts = F.split(marks, "(?<=0)(?=1)|(?<=1)(?=0)", -1)
    start = F.struct(
        (found["shift"] + low).alias("at"),
        none.alias("runs"),
    )

    def step(state: F.Column, part: F.Column) -> F.Column:
        end = state["at"] + F.length(part)
        run = F.struct(found["item_id"].alias("item_id"), state["at"].alias("start"), end.alias("end"))
        long_enough = part.startswith("1") & (F.length(part) >= width)
        runs = F.when(long_enough, F.array_append(state["runs"], run)).otherwise(state["runs"])
        return F.struct(end.alias("at"), runs.alias("runs"))

    return F.aggregate(parts, start, step, lambda state: state["runs"])


def hit_words(hits: str) -> F.Column:
    """Words covered by any of the runs."""
    spans = F.sort_array(F.transform(hits, lambda h: F.struct(h["start"].alias("start"), h["end"].alias("end"))))
    start = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))

    def step(state: F.Column, span: F.Column) -> F.Column:
        new = F.greatest(span["end"] - F.greatest(span["start"], state["end"]), F.lit(0))
        return F.struct(
            F.greatest(state["end"], span["end"]).alias("end"), (state["n"] + new).alias("n")
        )

    return F.aggregate(spans, start, step, lambda state: state["n"])


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, item_ids, contaminated) for every row of ``docs``.

    Words are runs of digits, letters A-Z (lower-cased) and anything beyond ASCII. A window is
    ``window`` consecutive words of an item, or the whole item if it has fewer. A document's
    word is hit inside any occurrence of a window; it is contaminated if a twentieth of its
    words, and one at least, are hit. ``item_ids`` are the items with occurring windows, as
    strings in their order.

    Null or wordless texts have no words, and are neither hit nor searched for. Rows with a
    null or repeated doc_id are judged each by its own text. Items without an id are left out.
    An empty table of either kind gives zeros. Other columns are not read.
    """
    found = PhraseIndex(docs.select("doc_id", "text"), items, window).phrases()
    ids = F.array_sort(
        F.array_distinct(F.transform("hits", lambda h: h["item_id"].cast("string")))
    )
    n_hit = hit_words("hits")
    return found.select(
        "row.doc_id", "n_words", n_hit.alias("n_hit"), ids.alias("item_ids")
    ).select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"), "item_ids",
        _too_many(F.col("n_hit")).alias("contaminated"),
    )


def _too_many(n_hit: F.Column) -> F.Column:
    return (n_hit > 0) & (20 * n_hit >= F.col("n_words"))


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs``, with all their columns, that are not contaminated."""
    index = PhraseIndex(docs, items, window)
    bad = index.phrases().filter(_too_many(hit_words("hits"))).select("key", "row.doc_id").distinct()
    bad = index.work.write("bad", bad)
    # The id is compared as well: a document whose hash is that of a bad one stays.
    same = (index.docs["key"] == bad["key"]) & index.docs["row.doc_id"].eqNullSafe(bad["doc_id"])
    kept = index.docs.join(small(bad, bad.count()), same, "left_anti")
    columns = [F.col("text") if c == "text" else F.col("row")[c].alias(c) for c in docs.columns]
    return kept.select(*columns)
