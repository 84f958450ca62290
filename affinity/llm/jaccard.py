"""Jaccard join of documents on word shingles by T-occurrence search (DivideSkip).

A pair with similarity t or more shares at least T = ceil(t * n) shingles with either side of
n shingles. From this follow, exactly:

1. **Who can have a partner.** All shingles are counted by hash range (``buckets``), as 32 bits
   each. A document with fewer than T shingles that other documents have as well is done.
   Equal 32-bit keys of different shingles only let more documents pass.
2. **Where partners meet.** Of the others, the n - T + 1 rarest shingles are kept, ordered
   by (documents, key). Linked documents share one of these, so every link is inside a
   connected *block* of documents that do. Documents with equal shingle sets count once.
3. **Search in a block.** For each document, inverted lists of its shingles are divided: the
   n - T + 1 shortest are merged and give the candidates with their counts, the T - 1
   longest are only probed by binary search, for candidates whose count can still reach the
   required overlap. Small blocks are dealt out whole, many to a task.
4. **Large blocks** are never in one task. Their documents are salted, and pivots of the block
   visit every part: the pivots are the index, all documents search it. Rounds go on until
   every document outside the block's largest component has been a pivot; no link between two
   components can then be missed.

Links inside a component are not all found: components are the result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from affinity.llm import buckets, text, worker
from affinity.llm.common import components, few, partitions, small, workspace

WIDTH, PERCENT = 5, 80
# A block with more documents, or more shingles, than this is salted.
BLOCK_DOCS = 4_000
BLOCK_SHINGLES = 1_000_000
# Documents of a large block in one part.
PART_DOCS = 200
# Pivots of a block in a round: at first, and at most.
PIVOTS, MORE_PIVOTS = 256, 4_096
_SENT = "batch long, bucket int, head boolean, docs binary, counts binary, keys binary, sums binary"
_DOCS = "doc_id long, n long, low long, high long, prefix array<long>"


def needed(n, percent: int):
    """The least overlap with any partner of a set of ``n``."""
    return -(-n * percent // 100)


def _table(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary(),
             "array<long>": pa.list_(pa.int64())}
    fields = [f.split() for f in schema.split(", ")]
    columns = zip(*rows, strict=True) if rows else [[]] * len(fields)
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), kinds[k]) for c, (_, k) in zip(columns, fields, strict=True)],
        names=[name for name, _ in fields],
    )


def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, dtype=np.uint64, out=total[1:])
    ends = np.cumsum(sizes)
    return total[ends] - total[ends - sizes]


def _shingles_of(i: int, j: int, data, offsets, width: int):
    words, doc = text.word_hashes(data, offsets[i : j + 1], lower=True)
    return text.shingles(words, doc, j - i, width)


def _send(width: int, n_buckets: int):
    @worker.lean
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = buckets.Batches()
        for batch in batches:
            data, offsets = text.utf8(batch["text"])
            doc_ids = batch["doc_id"].to_numpy(zero_copy_only=False).astype(np.int64)
            for i, j in text.slices(offsets):
                owner, hashes, sizes = _shingles_of(i, j, data, offsets, width)
                number, rows = numbers.next(), []
                keyed = np.zeros(j - i, np.int64)
                order, limits = buckets.by_bucket(buckets.bucket_of(hashes, n_buckets), n_buckets)
                for b in np.flatnonzero(np.diff(limits)):
                    own = order[limits[b] : limits[b + 1]]
                    pairs = np.unique(
                        (owner[own].astype(np.uint64) << np.uint64(32)) | (hashes[own] & np.uint64(0xFFFFFFFF))
                    )
                    docs, counts = buckets.runs((pairs >> np.uint64(32)).astype(np.uint32))
                    keyed[docs] += counts
                    rows.append(
                        (number, int(b), False, buckets.planes(docs), buckets.planes(counts),
                         pairs.astype(np.uint32).tobytes(), None)
                    )
                salt = np.uint64(0x2545F4914F6CDD1D)
                sums = np.stack([_sums(text.mix(hashes + salt), sizes), _sums(text.mix(hashes ^ salt), sizes)])
                rows.append(
                    (number, number % n_buckets, True, doc_ids[i:j].tobytes(), keyed.tobytes(),
                     sizes.astype(np.int64).tobytes(), sums.tobytes())
                )
                yield _table(_SENT, rows)

    return send


@worker.lean
def _count(table: pa.Table) -> pa.Table:
    """Of the keys of one bucket, those in two documents or more, with their number."""
    rows = table.to_pylist()
    out = [tuple(r.values()) for r in rows if r["head"]]
    rows = [r for r in rows if not r["head"]]
    if rows:
        keys = [np.frombuffer(r["keys"], np.uint32) for r in rows]
        every = np.concatenate(keys)
        order = np.argsort(every)
        _, sizes = buckets.runs(every[order])
        count = np.empty(len(every), np.uint32)
        count[order] = np.repeat(sizes, sizes)
        at = 0
        for r, own in zip(rows, keys, strict=True):
            df = count[at : at + len(own)]
            at += len(own)
            docs = np.repeat(buckets.unplanes(r["docs"], np.uint32), buckets.unplanes(r["counts"], np.uint32))
            shared = df > 1
            if shared.any():
                docs, counts = buckets.runs(docs[shared])
                out.append(
                    (r["batch"], r["bucket"], False, buckets.planes(docs), buckets.planes(counts),
                     own[shared].tobytes(), buckets.planes(df[shared]))
                )
    return pa.Table.from_batches([_table(_SENT, out)])


def _prefixes(percent: int):
    @worker.lean
    def choose(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        heads = [r for r in rows if r["head"]]
        out = []
        for head in heads:  # one, as a batch has one
            doc_ids = np.frombuffer(head["docs"], np.int64)
            keyed, sizes = np.frombuffer(head["counts"], np.int64), np.frombuffer(head["keys"], np.int64)
            low, high = np.frombuffer(head["sums"], np.int64).reshape(2, -1)
            owner, key, df = [], [], []
            for r in rows:
                if not r["head"]:
                    counts = buckets.unplanes(r["counts"], np.uint32)
                    owner.append(np.repeat(buckets.unplanes(r["docs"], np.uint32), counts))
                    key.append(np.frombuffer(r["keys"], np.uint32).astype(np.int64) | (r["bucket"] << 32))
                    df.append(buckets.unplanes(r["sums"], np.uint32))
            if owner:
                owner, key, df = map(np.concatenate, (owner, key, df))
            else:
                owner, key, df = (np.zeros(0, np.int64) for _ in range(3))
            shared = np.bincount(owner, minlength=len(doc_ids))
            # Shingles of the document alone are the rarest and come first.
            take = np.maximum(sizes - needed(sizes, percent) + 1 - (keyed - shared), 0)
            take[sizes == 0] = 0
            order = np.lexsort((key, df, owner))
            owner, key = owner[order], key[order]
            begin = np.cumsum(shared) - shared
            kept = np.arange(len(owner)) - begin[owner] < take[owner]
            parts = np.split(key[kept], np.cumsum(np.bincount(owner[kept], minlength=len(doc_ids)))[:-1])
            out += zip(doc_ids.tolist(), sizes.tolist(), low.tolist(), high.tolist(), parts, strict=True)
        return pa.Table.from_batches([_table(_DOCS, out)])

    return choose


@worker.lean
def _leaders(table: pa.Table) -> pa.Table:
    """(document, smallest document it is connected to by keys of this bin).

    Smallest ids go from keys to documents and back until none changes. As documents that
    are alike share keys in most bins, most bins name the same leader.
    """
    doc_ids, doc = np.unique(table["doc_id"].to_numpy(), return_inverse=True)
    _, key = np.unique(table["key"].to_numpy(), return_inverse=True)
    least = np.arange(len(doc_ids))
    while True:
        of_key = np.full(key.max(initial=-1) + 1, len(doc_ids))
        np.minimum.at(of_key, key, least[doc])
        new = least.copy()
        np.minimum.at(new, doc, of_key[key])
        new = new[new]
        if (new == least).all():
            break
        least = new
    own = np.flatnonzero(least != np.arange(len(least)))
    return pa.table({"a": doc_ids[own], "b": doc_ids[least[own]]})


def candidates(
    own: np.ndarray,
    cut: int,
    starts: np.ndarray,
    sizes: np.ndarray,
    members: np.ndarray,
    wanted: Callable[[np.ndarray], np.ndarray] | None = None,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Merge the ``cut`` shortest inverted lists of the shingles ``own``, or their ``wanted`` part.

    Returns the documents met, how often, and the shingles whose lists were skipped.
    """
    order = np.argsort(sizes[own], kind="stable")
    short, skipped = own[order[:cut]], own[order[cut:]]
    n = sizes[short]
    ends = np.cumsum(n)
    at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts[short] - ends + n, n)
    found = members[at]
    if wanted is not None:
        found = found[wanted(found)]
    met, count = np.unique(found, return_counts=True)
    return met, count, np.sort(skipped)


def search(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """A component number for each of the sorted shingle sets, linked by DivideSkip."""
    sizes = np.array([len(s) for s in sets])
    by_size = np.argsort(sizes, kind="stable")
    sets, sizes = [sets[i] for i in by_size], sizes[by_size]
    _, ids = np.unique(np.concatenate(sets), return_inverse=True)
    limits = np.concatenate([[0], np.cumsum(sizes)])
    owner = np.repeat(np.arange(len(sets)), sizes)
    members = owner[np.argsort(ids, kind="stable")]
    lengths = np.bincount(ids)
    starts = np.cumsum(lengths) - lengths
    component = np.arange(len(sets))
    held = {x: [x] for x in range(len(sets))}

    def merge(x: int, y: int) -> None:
        a, b = component[x], component[y]
        if len(held[a]) < len(held[b]):
            a, b = b, a
        component[held[b]] = a
        held[a] += held.pop(b)

    last = -1
    for x, n in enumerate(sizes.tolist()):
        least = needed(n, percent)
        own = ids[limits[x] : limits[x + 1]]
        # Copies come in groups: the last partner is tried first, and members of x's component
        # need not be met again.
        if last >= 0 and sizes[last] >= least:
            both = len(np.intersect1d(own, ids[limits[last] : limits[last + 1]], assume_unique=True))
            if 100 * both >= percent * (n + sizes[last] - both):
                merge(x, last)
        met, count, skipped = candidates(
            own, n - least + 1, starts, lengths, members, lambda y: (y < x) & (component[y] != component[x])
        )
        m = sizes[met]
        # 100 * overlap >= percent * (n + m - overlap)
        required = -(-(percent * (n + m)) // (100 + percent))
        order = np.flatnonzero((m >= least) & (count + len(skipped) >= required))
        for k in order[np.argsort(-count[order], kind="stable")].tolist():
            y = int(met[k])
            if component[x] == component[y]:
                continue
            other = ids[limits[y] : limits[y + 1]]
            at = np.minimum(np.searchsorted(other, skipped), len(other) - 1)
            if count[k] + np.count_nonzero(other[at] == skipped) >= required[k]:
                merge(x, y)
                last = y
    out = np.empty(len(sets), np.int64)
    out[by_size] = component
    return out


def _sets(column, width: int) -> list[np.ndarray]:
    data, offsets = text.utf8(column)
    out = []
    for i, j in text.slices(offsets):
        _, hashes, sizes = _shingles_of(i, j, data, offsets, width)
        out += np.split(hashes, np.cumsum(sizes)[:-1])
    return out


def _search_texts(width: int, percent: int):
    @worker.lean
    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        ids = table["doc_id"].to_numpy()
        number = search(_sets(table["text"], width), percent)
        least = np.full(len(ids), np.iinfo(np.int64).max)
        np.minimum.at(least, number, ids)
        return pa.table({"doc_id": ids, "component": least[number]})

    return run


def _with_sets(width: int):
    @worker.lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = [s.tobytes() for s in _sets(batch["text"], width)]
            yield pa.RecordBatch.from_arrays(
                [batch["block"], batch["doc_id"], pa.array(packed, pa.binary())],
                names=["block", "doc_id", "hashes"],
            )

    return run


def _visit(percent: int):
    """Links of the documents of one part of a block to the pivots that visit it."""

    @worker.lean
    def run(table: pa.Table) -> pa.Table:
        pivot = table["pivot"].to_numpy(zero_copy_only=False).astype(bool)
        ids = table["doc_id"].to_numpy()
        sets = [np.frombuffer(x, np.uint64) for x in table["hashes"].to_pylist()]
        a, b = [], []
        index = np.flatnonzero(pivot)
        if len(index):
            known, numbers = np.unique(np.concatenate([sets[i] for i in index]), return_inverse=True)
            sizes = np.array([len(sets[i]) for i in index])
            members = np.repeat(np.arange(len(index)), sizes)[np.argsort(numbers, kind="stable")]
            lengths = np.bincount(numbers)
            starts = np.cumsum(lengths) - lengths
            limits = np.concatenate([[0], np.cumsum(sizes)])
            for x in np.flatnonzero(~pivot).tolist():
                n = len(sets[x])
                least = needed(n, percent)
                at = np.minimum(np.searchsorted(known, sets[x]), len(known) - 1)
                own = at[known[at] == sets[x]]
                # Shingles that no pivot has are empty lists, the shortest of all.
                cut = max(n - least + 1 - (n - len(own)), 0)
                met, count, skipped = candidates(own, cut, starts, lengths, members)
                required = -(-(percent * (n + sizes[met])) // (100 + percent))
                for k in np.flatnonzero(count + len(skipped) >= required).tolist():
                    other = numbers[limits[met[k]] : limits[met[k] + 1]]
                    near = np.minimum(np.searchsorted(other, skipped), len(other) - 1)
                    if count[k] + np.count_nonzero(other[near] == skipped) >= required[k]:
                        a.append(ids[x])
                        b.append(ids[index[met[k]]])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def _large_blocks(work, big: DataFrame, percent: int) -> DataFrame:
    """(doc_id, component) of the documents ``big(block, doc_id, hashes)`` of large blocks."""
    sizes = big.groupBy("block").agg(F.count(F.lit(1)).alias("docs"))
    parts = work.write(
        "parts", sizes.select("block", F.ceil(F.col("docs") / PART_DOCS).cast("int").alias("parts"))
    )
    found = big.select("doc_id", F.col("doc_id").alias("component"), "block")
    links = pivoted = None
    step, many = 0, PIVOTS
    while True:
        step += 1
        largest = (
            found.groupBy("block", "component")
            .agg(F.count(F.lit(1)).alias("n"))
            .groupBy("block")
            .agg(F.max(F.struct("n", "component")).alias("largest"))
            .select("block", F.col("largest.component").alias("main"))
        )
        left = found.join(largest, "block").filter("component <> main").select("block", "doc_id")
        if pivoted is not None:
            left = left.join(pivoted, "doc_id", "left_anti")
        place = F.row_number().over(Window.partitionBy("block").orderBy(F.xxhash64("doc_id"), "doc_id"))
        chosen = work.write(
            f"pivots_{step}",
            left.withColumn("place", place).filter(F.col("place") <= many).select("block", "doc_id"),
        )
        if not chosen.head(1):
            break
        part = F.pmod(F.xxhash64("doc_id"), F.col("parts")).cast("int")
        docs = big.join(parts, "block").select(
            "block", part.alias("part"), F.lit(False).alias("pivot"), "doc_id", "hashes"
        )
        visitors = (
            big.join(chosen, ["block", "doc_id"])
            .join(parts, "block")
            .select(
                "block", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
                F.lit(True).alias("pivot"), "doc_id", "hashes",
            )
        )
        new = work.write(
            f"links_{step}",
            docs.union(visitors).groupBy("block", "part").applyInArrow(_visit(percent), "a long, b long"),
        )
        links = new if links is None else links.union(new)
        ids = chosen.select("doc_id")
        pivoted = ids if pivoted is None else pivoted.union(ids)
        labels = components(work, f"round_{step}", links.filter("a <> b")).withColumnRenamed("id", "doc_id")
        found = work.write(
            f"found_{step}",
            big.select("block", "doc_id").join(labels, "doc_id", "left")
            .select("doc_id", F.coalesce("component", "doc_id").alias("component"), "block"),
        )
        many = min(4 * many, MORE_PIVOTS)
    return found.select("doc_id", "component")


def jaccard_components(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs(doc_id, text)``.

    Words are runs of anything but the six ASCII blanks, with A-Z lower-cased; a document's
    set is its different shingles of ``width`` words, or all its words as one if it has fewer.
    Two documents link if 100 * intersection >= ``percent`` * union; the component id is the
    smallest doc_id that links lead to. Shingles are identified by 64-bit hashes.

    Null or blank text has no shingles and links with nothing. A row without a doc_id gets
    its number of shingles and a null component, and links with nothing. Rows that repeat a
    doc_id are returned each; they should repeat its text, and share a component in any case.
    An empty table gives an empty result; other columns are not read.

    Batches of documents are numbered as a task reads them, so ``docs`` should be read from
    files: a task that is repeated after a loss then meets the same rows in the same order.
    """
    work = workspace(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    n = min(partitions(docs.sparkSession), 1 << 16)
    named = work.write(
        "docs",
        docs.filter("doc_id is not null")
        .mapInArrow(_send(width, n), _SENT)
        .repartition(n, "bucket")
        .groupBy("bucket")
        .applyInArrow(_count, _SENT)
        .groupBy("batch")
        .applyInArrow(_prefixes(percent), _DOCS),
    )
    equal = work.write(
        "equal",
        named.filter("n > 0").groupBy("n", "low", "high")
        .agg(F.min("doc_id").alias("rep"), F.max(F.size("prefix")).alias("keys")),
    )
    reps = equal.filter("keys > 0").select("rep")
    entries = named.join(reps, named.doc_id == reps.rep, "left_semi").select(
        "doc_id", F.explode("prefix").alias("key")
    )
    edges = (
        entries.withColumn("bin", F.pmod(F.xxhash64("key"), F.lit(n)).cast("int"))
        .groupBy("bin")
        .applyInArrow(_leaders, "a long, b long")
    )
    blocks = components(work, "blocks", edges)
    weights = named.dropDuplicates(["doc_id"]).select(F.col("doc_id").alias("id"), "n")
    n_linked = blocks.count()
    sized = work.write("sized", few(blocks.join(weights, "id"), n_linked))
    per_block = sized.groupBy("component").agg(
        F.count(F.lit(1)).alias("docs"), F.sum("n").alias("shingles")
    )
    members = sized.join(per_block, "component").select(
        F.col("id").alias("doc_id"), F.col("component").alias("block"),
        ((F.col("docs") > BLOCK_DOCS) | (F.col("shingles") > BLOCK_SHINGLES)).alias("large"),
    )
    chosen = work.write("members", few(members, n_linked))
    bodies = docs.join(small(chosen, n_linked), "doc_id").dropDuplicates(["doc_id"])
    inside = (
        bodies.filter("not large")
        .select(F.pmod(F.xxhash64("block"), F.lit(n)).cast("int").alias("bin"), "doc_id", "text")
        .repartition(n, "bin")
        .groupBy("bin")
        .applyInArrow(_search_texts(width, percent), "doc_id long, component long")
    )
    found = work.write("inside", inside)
    large = chosen.filter("large")
    if large.head(1):
        big = work.write(
            "big",
            bodies.filter("large").select("block", "doc_id", "text")
            .mapInArrow(_with_sets(width), "block long, doc_id long, hashes binary"),
        )
        found = found.union(_large_blocks(work, big, percent))
    found = found.select(F.col("doc_id").alias("rep"), "component")
    classes = equal.join(found, "rep", "left").select(
        "n", "low", "high", F.coalesce("component", "rep").alias("component")
    )
    out = named.join(classes, ["n", "low", "high"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.coalesce("component", "doc_id").alias("component_id"),
    )
    unnamed = docs.filter("doc_id is null").mapInArrow(_sizes(width), "n_shingles long")
    return out.union(
        unnamed.select(F.lit(None).cast("long").alias("doc_id"), "n_shingles", F.lit(None).cast("long"))
    )


def _sizes(width: int):
    @worker.lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = [len(s) for s in _sets(batch["text"], width)]
            yield pa.RecordBatch.from_arrays([pa.array(sizes, pa.int64())], names=["n_shingles"])

    return run
