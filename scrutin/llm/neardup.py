"""Operator 4: near-duplicate groups by DartMinHash.

A document is the set of its five-word shingles, each of weight one however
often it occurs.  Every element owns a region, its weight wide, into which
hashed darts fall as a Poisson process in time; the darts that an element's
weight covers are thrown, each names one of K coordinates, and the earliest
dart of each coordinate is kept.  Two documents agree in a coordinate with
the Jaccard similarity of their sets, the one that is verified, as
probability.  Coordinates are joined in
bands; candidate pairs are then verified exactly: a link is a Jaccard
similarity of at least 0.8 between the shingle sets of the whole texts.

Equal texts are one node.  Within a bucket of a band every member is compared
with the hub (the member that meets most others over all its buckets), and the
links are joined to components.  Then each member outside the largest component
of its bucket is compared with a few hashed members of that component, others
in each bucket.  Last, the signatures of all members that are still outside are
compared, block by block, with those of every other component in the bucket,
and the pairs that agree enough are verified.  So no candidate between
components is left out, and no bucket is written out as its pairs.

Defined cases: null and empty texts are equal texts and one group; a text
without words is grouped with equal texts only; repeated rows and ties keep
every row; a group's kept document is that of its least doc_id (null last), of
equal ids that of the least text digest, wherever the rows lie.  Columns beside doc_id and text are carried
by ``deduplicate`` only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scrutin.llm import textbytes as B
from scrutin.llm.common import stored, text_key, unused

BANDS, ROWS = 26, 5
#: Kept coordinates; the first BANDS * ROWS make the bands.
COORDINATES = 2 * BANDS * ROWS
THRESHOLD = 0.8
#: Candidates whose coordinates agree in a smaller share are not verified; with
#: 260 coordinates a pair at 0.8 falls below it with a probability under 1e-8.
LEAST_AGREEMENT = 0.65
#: The same for pairs across the components of a bucket: a pair at exactly 0.8
#: falls below it with a probability of 5e-4, one at 0.82 with 2e-5.
LATE_AGREEMENT = 0.72
#: Outsiders and members of a bucket that meet in one block.
OUTSIDERS, MEMBERS = 512, 2048
#: Members of a bucket's largest component that each outsider is compared with first.
REPRESENTATIVES = 4
_SEEDS = tuple(np.uint64(x) for x in (0x9FB21C651E98DF25, 0xD2B74407B1CE6E93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB))


def distinct_shingles(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text and offsets by text."""
    h, off = B.shingles(B.words(col))
    doc = np.repeat(np.arange(len(col)), np.diff(off))
    by = np.lexsort((h, doc))
    h, doc = h[by], doc[by]
    first = np.ones(len(h), dtype=bool)
    first[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(first)
    return h[at], np.searchsorted(doc[at], np.arange(len(col) + 1))


def dart_minhash(elements: np.ndarray, weights: np.ndarray, offsets: np.ndarray, k: int = COORDINATES) -> np.ndarray:
    """Signatures, one row of k dart hashes per set (zeros for an empty set).

    Region level v of an element spans the weights [0, 1) for v = 0 and
    [2**(v-1), 2**v) beyond; its darts arrive one after the other, the time to
    the next exponential at the rate of the level's width, each at a hashed
    weight and for a hashed coordinate.  So a dart is the same in every set.
    Darts are thrown up to a time at which every coordinate is expected to be
    hit; for sets with an empty coordinate it is doubled.
    """
    sets = len(offsets) - 1
    out = np.zeros((sets, k), np.uint64)
    todo = np.flatnonzero(np.diff(offsets) > 0)
    total = np.add.reduceat(np.append(weights, 0.0), offsets[:-1])
    reach = np.zeros(sets)
    reach[todo] = k * (np.log(k) + 3.0) / total[todo]
    owner = np.repeat(np.arange(sets), np.diff(offsets))
    levels = np.where(weights > 1.0, np.ceil(np.log2(np.maximum(weights, 1.0))), 0.0).astype(np.int64)
    while len(todo):
        wanted = np.zeros(sets, dtype=bool)
        wanted[todo] = True
        cells, ranks, darts = [], [], []
        for v in range(int(levels.max()) + 1):
            low, width = (0.0, 1.0) if v == 0 else (2.0 ** (v - 1), 2.0 ** (v - 1))
            live = np.flatnonzero(wanted[owner] & (levels >= v))
            seed = B.mix(elements[live] + B.times(v, _SEEDS[0]))
            when, j = np.zeros(len(live)), 0
            while len(live):
                dart = B.mix(seed + B.times(j, _SEEDS[1]))
                when = when - np.log(B.unit(dart)) / width
                on = when < reach[owner[live]]
                live, seed, when, dart = live[on], seed[on], when[on], dart[on]
                hit = low + width * B.unit(B.mix(dart ^ _SEEDS[2])) < weights[live]
                own = dart[hit]
                cells.append(owner[live[hit]] * k + (B.mix(own ^ _SEEDS[3]) % np.uint64(k)).astype(np.int64))
                ranks.append(when[hit])
                darts.append(own)
                j += 1
        cell, rank, dart = np.concatenate(cells), np.concatenate(ranks), np.concatenate(darts)
        earliest = np.full(sets * k, np.inf)
        np.minimum.at(earliest, cell, rank)
        keep = rank == earliest[cell]
        flat = np.zeros(sets * k, np.uint64)
        flat[cell[keep]] = dart[keep]
        out[todo] = flat.reshape(sets, k)[todo]
        full = np.isfinite(earliest).reshape(sets, k).all(axis=1)
        todo = todo[~full[todo]]
        reach[todo] *= 2.0
    return out


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, col in B.chunks(batch, size=2 << 20):
            el, off = distinct_shingles(col)
            sig = dart_minhash(el, np.ones(len(el)), off)
            some = np.diff(off) > 0
            bands = np.zeros((len(col), BANDS), np.uint64)
            for r in range(ROWS):
                bands = B.mix(bands + sig[:, r::ROWS][:, :BANDS])
            bands += np.arange(1, BANDS + 1, dtype=np.uint64) * _SEEDS[0]
            lists = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], np.cumsum(np.where(some, BANDS, 0))]).astype(np.int32)),
                pa.array(B.mix(bands[some]).view(np.int64).ravel()))
            short = sig.astype(np.uint8)  # the last byte of each
            yield pa.record_batch(
                [part.column(0), part.column(1), part.column(2), lists, pa.array([x.tobytes() for x in short], pa.binary())],
                names=["rid", "doc_id", "node_key", "bands", "signature"])


def _agree(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose signatures agree in enough coordinates."""
    for batch in batches:
        sig = [np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(-1, COORDINATES) for i in (2, 3)]
        on = (sig[0] == sig[1]).mean(axis=1) >= LEAST_AGREEMENT
        yield batch.select(["a", "b"]).filter(pa.array(on))


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Exact Jaccard similarity of the shingle sets of two texts."""
    for batch in batches:
        a, b, out = batch.column(0), batch.column(1), []
        sides = []
        for name in ("text_a", "text_b"):
            sets = []
            for _, col in B.chunks(batch, name):
                h, off = B.shingles(B.words(col))
                sets += [np.unique(h[i:j]) for i, j in zip(off[:-1], off[1:])]
            sides.append(sets)
        for x, y in zip(*sides):
            both = len(np.intersect1d(x, y, assume_unique=True))
            union = len(x) + len(y) - both
            out.append(both / union if union else 1.0)
        yield pa.record_batch([a, b, pa.array(out, pa.float64())], names=["a", "b", "similarity"])


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for the nodes of ``edges`` (a, b); the component is its
    least node.  Alternating large and small stars, each a partial minimum by
    node, until every node but a component's least has one edge, to it."""
    e = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct()
    while True:
        both = e.union(e.select("v", "u"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = stored(small.union(low.select("u", F.col("m").alias("v"))).distinct(), "edges")
        ends = e.select(F.col("u").alias("node"), F.lit(1).alias("low")).union(e.select("v", F.lit(0)).distinct())
        if ends.groupBy("node").agg(F.sum("low").alias("low"), F.count("*").alias("n")).where("low > 1 or low = 1 and n > 1").isEmpty():
            break
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def near_links(nodes: DataFrame, texts: DataFrame, threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """Verified links (a, b) between ``nodes`` (node, doc_id, node_key, bands,
    signature) and the components (node, component) that they make."""
    spread = nodes.select("node", F.explode("bands").alias("band"))
    sizes = spread.groupBy("band").agg(F.count("*").alias("n")).where("n > 1")
    members = stored(spread.join(sizes, "band").select("band", "node", "n"), "buckets")
    degree = members.groupBy("node").agg(F.sum("n").alias("degree"))
    members = stored(members.join(degree, "node").select("band", "node", "degree"), "members")
    used = nodes.join(degree, "node", "left_semi")
    t = texts.join(used, texts["node_key"].eqNullSafe(used["node_key"]) & texts["doc_id"].eqNullSafe(used["doc_id"]))
    used = stored(t.select("node", "bands", "signature", "text").dropDuplicates(["node"]), "texts")

    hubs = members.groupBy("band").agg(F.min(F.struct(-F.col("degree"), F.col("node").alias("node")))["node"].alias("hub"))
    star = members.join(hubs, "band").where("node <> hub")
    known = stored(verify(agreeing(pairs(star, "node", "hub"), used), used), "links")
    part = components(known.where(F.col("similarity") >= threshold).select("a", "b"))
    for turn in range(2):
        placed, minor = _outside(members, part)
        if turn == 0:  # a few members of the bucket's largest component, others in each bucket
            spread = placed.where("component = largest").select("band", "node", F.xxhash64("node", "band").alias("h"))
            others = (spread.groupBy("band", F.expr(f"pmod(h, {REPRESENTATIVES})"))
                      .agg(F.min(F.struct("h", "node"))["node"].alias("node")).select("band", "node"))
            found = minor.join(others, "band")
            found = agreeing(pairs(found, "x", "node").join(known.select("a", "b"), ["a", "b"], "left_anti"), used)
        else:
            found = crossing(placed, used).join(known.select("a", "b"), ["a", "b"], "left_anti")
        found = stored(verify(found, used), "links")
        known = known.union(found)
        found = found.where(F.col("similarity") >= threshold)
        if not found.isEmpty():
            part = components(part.where("node <> component").toDF("a", "b").union(found.select("a", "b")))
    return known.where(F.col("similarity") >= threshold).select("a", "b"), part


def pairs(df: DataFrame, x: str, y: str) -> DataFrame:
    return df.select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b")).distinct()


def _outside(members: DataFrame, part: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The members of buckets that hold several components, and those of them
    outside the bucket's largest."""
    placed = members.join(part, "node", "left").select("band", "node", F.coalesce("component", "node").alias("component"))
    largest = (placed.groupBy("band", "component").agg(F.count("*").alias("n"))
               .groupBy("band").agg(F.min(F.struct(-F.col("n"), F.col("component").alias("component")))["component"].alias("largest"),
                                    F.max("n").alias("most"), F.sum("n").alias("n"), F.count("*").alias("parts")).where("parts > 1"))
    placed = stored(placed.join(largest.drop("parts"), "band"), "placed")
    minor = (placed.where("component <> largest")
             .select("band", F.col("node").alias("x"), F.col("component").alias("cx")))
    return placed, minor


def crossing(placed: DataFrame, used: DataFrame) -> DataFrame:
    """(a, b): members outside their bucket's largest component and members of
    its other components whose signatures agree enough.

    A bucket's outsiders and its members are dealt in blocks, every block of
    outsiders meets every block of members in one task's memory, and only the
    pairs that agree leave it, each from the first band that it shares.
    """
    signed = placed.join(used.select("node", "bands", "signature"), "node").withColumns({
        "rows": F.ceil((F.col("n") - F.col("most")) / OUTSIDERS), "columns": F.ceil(F.col("n") / MEMBERS), "outer": F.col("component") != F.col("largest")})
    deal = lambda n: F.pmod(F.xxhash64("node", "band"), F.col(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    cols = ["node", "component", "bands", "signature", "outer"]
    asking = signed.where("outer").select("band", deal("rows").alias("row"), every("columns").alias("column"), F.lit(True).alias("asks"), *cols)
    asked = signed.select("band", every("rows").alias("row"), deal("columns").alias("column"), F.lit(False).alias("asks"), *cols)
    return (asking.union(asked).repartition("band", "row", "column").sortWithinPartitions("band", "row", "column")
            .mapInArrow(_crossed, "a long, b long"))


def _crossed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.RecordBatch] = []
    last: tuple = ()
    for batch in batches:
        key = np.column_stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)])
        cuts = [0, *(np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1).tolist(), len(key)]
        for a, b in zip(cuts[:-1], cuts[1:]):
            if held and tuple(key[a]) != last:
                yield _agreeing_in(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = tuple(key[a])
    if held:
        yield _agreeing_in(held)


def _agreeing_in(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    t = pa.Table.from_batches(parts).combine_chunks()
    asks, node, part, outer = (t[c].to_numpy() for c in ("asks", "node", "component", "outer"))
    bands = np.concatenate([c.flatten().to_numpy() for c in t["bands"].chunks]).reshape(-1, BANDS)
    sig = np.frombuffer(b"".join(t["signature"].to_pylist()), np.uint8).reshape(-1, COORDINATES)
    here = t["band"][0].as_py()
    found = []
    asked = np.flatnonzero(~asks)
    for i in np.flatnonzero(asks):
        # of two outsiders the lesser asks
        j = asked[(part[asked] != part[i]) & (~outer[asked] | (node[asked] > node[i]))]
        j = j[(bands[j] == bands[i]).argmax(axis=1) == int(np.argmax(bands[i] == here))]
        j = j[(sig[j] == sig[i]).sum(axis=1) >= LATE_AGREEMENT * COORDINATES]
        found.append(np.column_stack([np.minimum(node[j], node[i]), np.maximum(node[j], node[i])]))
    ab = np.concatenate(found) if found else np.zeros((0, 2), np.int64)
    return pa.record_batch([pa.array(ab[:, 0]), pa.array(ab[:, 1])], names=["a", "b"])


def agreeing(candidates: DataFrame, used: DataFrame) -> DataFrame:
    """The candidate pairs (a, b) whose signatures agree enough."""
    side = lambda name: used.select(F.col("node").alias(name), F.col("signature").alias(f"signature_{name}"))
    return (candidates.join(side("a"), "a").join(side("b"), "b")
            .select("a", "b", "signature_a", "signature_b").mapInArrow(_agree, "a long, b long"))


def verify(candidates: DataFrame, used: DataFrame) -> DataFrame:
    """(a, b, similarity) of candidate pairs from the whole texts of both
    (``used``: node, text)."""
    near = stored(candidates, "near")
    side = lambda name: used.select(F.col("node").alias(name), F.col("text").alias(f"text_{name}"))
    return (near.join(side("a"), "a").join(side("b"), "b")
            .select("a", "b", "text_a", "text_b").mapInArrow(_verified, "a long, b long, similarity double"))


def near_duplicates(documents: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: rid (row number), doc_id, node_key, group (a number
    of its class), keep, group_doc_id, copies (equal texts), group_size.  The
    class's row of the least doc_id (null last), then the least digest of its
    text is kept; rows equal in both are told apart by their number."""
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    signed = stored(
        docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id", text_key().alias("node_key"), "text")
        .mapInArrow(_signed, "rid long, doc_id long, node_key binary, bands array<long>, signature binary"), "signed")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "node_key", "rid"))
    classes = stored(signed.groupBy("node_key").agg(F.min("rid").alias("node"), F.count("*").alias("copies"), first.alias("first")), "classes")
    nodes = signed.join(classes.select(F.col("node").alias("rid")), "rid", "left_semi").withColumnRenamed("rid", "node")
    nodes = stored(nodes, "nodes")
    _, part = near_links(nodes, docs.withColumn("node_key", text_key()), threshold)
    full = classes.join(part, "node", "left").select("node_key", "node", "copies", "first", F.coalesce("component", "node").alias("group"))
    groups = full.groupBy("group").agg(F.sum("copies").alias("group_size"), F.min("first").alias("head"))
    full = stored(full.join(groups, "group").select("node_key", "group", "copies", "group_size", "head"), "groups")
    return (signed.select("rid", "doc_id", "node_key").join(full, "node_key")
            .select("rid", "doc_id", "node_key", "group", (F.col("rid") == F.col("head.rid")).alias("keep"),
                    F.col("head.doc_id").alias("group_doc_id"), "copies", "group_size"))


def deduplicate(documents: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents without all but one of each near-duplicate group; the
    kept row is matched by id and text, and repeated rows of it are one."""
    id_, key, own = unused(documents, "kept_id", "kept_key", "text_key")
    kept = near_duplicates(documents, threshold).where("keep").select(F.col("doc_id").alias(id_), F.col("node_key").alias(key))
    return (documents.withColumn(own, text_key())
            .join(kept, F.col(own).eqNullSafe(F.col(key)) & F.col("doc_id").cast("long").eqNullSafe(F.col(id_)))
            .dropDuplicates([id_, key]).drop(id_, key, own))
