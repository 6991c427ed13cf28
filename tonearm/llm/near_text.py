"""Near-duplicate documents by shingle sets: banded signatures, sequential Bayesian pruning, exact verification.

1. Every document gets the set of its distinct shingles (64-bit hashes), a MinHash signature and band keys.
2. Documents of one set are one class; from here on a class has one node, so exact copies cost nothing more.
3. Nodes that share a band key are candidates. First each node of a bucket is compared with one node of it, the
   bucket's pivot; pivots are drawn by one of several orders of the nodes, so a node meets several pivots. Links found
   are closed to components, order by order, and pairs inside a component are not looked at again. At last the nodes of
   a bucket that still lie in different components are compared with each other, in blocks inside tasks: nodes carry
   their signatures and texts to a block, so no pair but the links is a row. Every pair of a bucket is either compared
   or connected.
4. A pair's signatures are compared in batches. After each batch the pair is dropped if the posterior probability that
   its similarity reaches the threshold falls below the chosen miss probability.
5. Pairs that survive all batches are verified on their full sets. Texts travel to where they are compared and the sets
   are made there: a text takes a third of the bytes of its set of hashes, and less when compressed.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonearm.llm.components import components
from tonearm.llm.files import discard, stored
from tonearm.llm.words import WordMemo, releasing, text_chunks

U64 = np.uint64
#: Odd multipliers of the mixing steps.
MIX = [U64(0x9E3779B97F4A7C15), U64(0xC2B2AE3D27D4EB4F), U64(0x165667B19E3779F9)]
SIGNED = "doc_id long, text_key long, n_shingles long, set_high long, set_low long, bands array<long>"
CANDIDATES = "node long, n_shingles long, signature binary, bands array<long>, text string"
#: Bits that tell which hashes of texts may be in a table: one megabyte of them whatever the table's size.
SLOTS = 1 << 23


@dataclass(frozen=True)
class Near:
    """Shingle width, similarity in percent from which documents are linked, the shape of the signatures, the miss
    probability of pruning, the number of orders by which pivots are drawn, and the shingles of a block.

    ``bands`` times ``band_rows`` hashes: with 32 bands of 6, a pair at 85 percent shares no band once in four million,
    one at 80 percent once in fifteen thousand.
    """

    width: int = 5
    percent: int = 80
    bands: int = 48
    band_rows: int = 5
    batch: int = 48
    miss: float = 1e-9
    orders: int = 9
    block_shingles: int = 2_000_000
    seed: int = 7

    @property
    def hashes(self) -> int:
        return self.bands * self.band_rows


def fold(parts: list[np.ndarray]) -> np.ndarray:
    """One 64-bit hash of several columns of hashes."""
    out = np.zeros_like(parts[0]) + MIX[2]
    for k, part in enumerate(parts):
        out = (out ^ part) * MIX[k % 3]
        out ^= out >> U64(29 + k % 4)
    out *= MIX[1]
    return out ^ (out >> U64(32))


class Shingler(WordMemo):
    """Sets of distinct shingles of texts, ASCII letters in lower case, words cut at ASCII white space.

    A text with fewer words than a shingle has one shingle, its words; a text without words has none.
    """

    def __init__(self, width: int, limit: int = 300_000) -> None:
        super().__init__(limit)
        self.width = width
        self.hashes = np.zeros(0, U64)

    def compute(self, words: list[bytes]) -> None:
        fresh = np.fromiter(map(xxhash.xxh3_64_intdigest, words), U64, len(words))
        self.hashes = np.concatenate([self.hashes, fresh])

    def keep(self, numbers: np.ndarray) -> None:
        self.hashes = self.hashes[numbers]

    def sets(self, texts: list[bytes]) -> list[np.ndarray]:
        words: list[bytes] = []
        counts = []
        for text in texts:
            own = text.lower().split()
            counts.append(len(own))
            words += own
        numbers = self.look_up(words, len(words))
        hashes = self.hashes[numbers]
        self.trim()
        width = self.width
        rolled = fold([hashes[k : len(hashes) - width + 1 + k] for k in range(width)]) if len(hashes) >= width else hashes[:0]
        found, start = [], 0
        for count in counts:
            if count >= width:
                found.append(np.unique(rolled[start : start + count - width + 1]))
            elif count:
                own = hashes[start : start + count]
                found.append(fold([own[k : k + 1] for k in range(count)] + [np.full(1, count, U64)]))
            else:
                found.append(hashes[:0])
            start += count
        return found


class Signer:
    """MinHash signatures and band keys of shingle sets."""

    def __init__(self, near: Near) -> None:
        self.near = near
        random = np.random.default_rng(near.seed)
        self.factors = (random.integers(0, 1 << 32, near.hashes, dtype=np.uint32) | np.uint32(1))[:, None]
        self.shifts = random.integers(0, 1 << 32, near.hashes, dtype=np.uint32)[:, None]
        self.salts = fold([np.arange(near.bands, dtype=U64)])

    def signature(self, shingles: np.ndarray, at_once: int = 2048) -> np.ndarray:
        short = (shingles ^ (shingles >> U64(32))).astype(np.uint32)
        least = np.full(self.near.hashes, np.iinfo(np.uint32).max, np.uint32)
        for first in range(0, len(short), at_once):
            spread = self.factors * short[None, first : first + at_once]
            spread += self.shifts
            np.minimum(least, spread.min(axis=1), out=least)
        return least

    def bands(self, signatures: np.ndarray) -> np.ndarray:
        """Band keys of many signatures; the number of the band is part of the key."""
        cut = signatures.reshape(len(signatures), self.near.bands, self.near.band_rows).astype(U64)
        return fold([np.broadcast_to(self.salts, cut.shape[:2]), *(cut[:, :, k] for k in range(self.near.band_rows))])

    def band_lists(self, signatures: np.ndarray) -> pa.Array:
        keys = self.bands(signatures).astype(np.int64).ravel()
        return pa.ListArray.from_arrays(pa.array(np.arange(0, len(keys) + 1, self.near.bands, dtype=np.int32)), pa.array(keys))


def set_digest(shingles: np.ndarray) -> tuple[int, int]:
    whole = xxhash.xxh3_128_intdigest(shingles.tobytes())
    return tuple(int(np.array(x, U64).astype(np.int64)) for x in (whole >> 64, whole & (1 << 64) - 1))


def sign(docs: DataFrame, near: Near) -> DataFrame:
    """Digest of the shingle set and band keys of each row; stored with a number for each row."""
    names = ["doc_id", "text_key", "n_shingles", "set_high", "set_low", "bands"]

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, signer = Shingler(near.width), Signer(near)
        for batch in batches:
            for first, texts in text_chunks(batch.column(2)):
                sets = shingler.sets(texts)
                digests = [set_digest(s) for s in sets]
                columns = [
                    batch.column(0).slice(first, len(texts)),
                    batch.column(1).slice(first, len(texts)),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([d[0] for d in digests], pa.int64()),
                    pa.array([d[1] for d in digests], pa.int64()),
                    signer.band_lists(np.stack([signer.signature(s) for s in sets])),
                ]
                yield pa.RecordBatch.from_arrays(columns, names)

    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_key"), F.col("text").cast("string"))
    return stored(rows.mapInArrow(releasing(signed), SIGNED).withColumn("row", F.monotonically_increasing_id()), "signed-documents")


@functools.cache
def fewest_matches(near: Near) -> tuple[int, ...]:
    """For each batch the least number of equal hashes up to there with which a pair is kept.

    With a flat prior and m of n hashes equal, the similarity follows a beta distribution with m + 1 and n - m + 1, and
    the probability that it reaches t is that of at most m successes in n + 1 draws with chance t.
    """
    chance = near.percent / 100
    limits = []
    for n in range(near.batch, near.hashes + 1, near.batch):
        total, m = 0.0, -1
        while total < near.miss:
            m += 1
            total += math.comb(n + 1, m) * chance**m * (1 - chance) ** (n + 1 - m)
        limits.append(m)
    return tuple(limits)


def plausible(left: np.ndarray, right: np.ndarray, near: Near) -> np.ndarray:
    """Which rows of two matrices of signatures stay in the running after all batches."""
    alive = np.arange(len(left))
    matches = np.zeros(len(left), np.int64)
    for k, least in enumerate(fewest_matches(near)):
        own = slice(k * near.batch, (k + 1) * near.batch)
        matches[alive] += (left[alive, own] == right[alive, own]).sum(axis=1)
        alive = alive[matches[alive] >= least]
    return alive


def prune(pairs: DataFrame, signatures: DataFrame, near: Near) -> DataFrame:
    """The pairs (a, b, turn) of nodes whose sizes and signatures do not rule a link out; stored."""

    def matrix(column: pa.Array) -> np.ndarray:
        return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), near.hashes)

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = pa.array(plausible(matrix(batch.column(3)), matrix(batch.column(4)), near))
            yield batch.select([0, 1, 2]).take(rows)

    a = signatures.select(F.col("node").alias("a"), F.col("n_shingles").alias("n_a"), F.col("signature").alias("signature_a"))
    b = signatures.select(F.col("node").alias("b"), F.col("n_shingles").alias("n_b"), F.col("signature").alias("signature_b"))
    both = pairs.join(a, "a").join(b, "b").where(100 * F.least("n_a", "n_b") >= near.percent * F.greatest("n_a", "n_b"))
    both = both.select("a", "b", "turn", "signature_a", "signature_b")
    return stored(both.mapInArrow(kept, "a long, b long, turn int"), "plausible-pairs")


def marks(keys: DataFrame) -> DataFrame:
    """The slots that ``text_key`` of any row falls into, 64 a row; at most ``SLOTS`` / 64 rows."""
    slots = keys.select(F.pmod("text_key", F.lit(SLOTS)).alias("slot"))
    bit = F.bit_or(F.expr("shiftleft(1L, cast(slot & 63 as int))")).alias("mark_bits")
    return slots.groupBy(F.shiftright("slot", 6).alias("mark_word")).agg(bit)


def by_marks(rows: DataFrame, text: Column, marked: DataFrame, how: str) -> DataFrame:
    """The rows whose text may be marked (``left_semi``), or those whose text is not (``left_anti``).

    Rows are told apart where they lie, so that only those which may be marked have to be shuffled with their texts.
    """
    slot = F.pmod(F.xxhash64(text), F.lit(SLOTS))
    held = (F.shiftright(slot, 6) == F.col("mark_word")) & (F.getbit("mark_bits", slot.bitwiseAND(F.lit(63))) == 1)
    return rows.join(F.broadcast(marked), held, how)


def candidates(members: DataFrame, classes: DataFrame, docs: DataFrame, near: Near) -> DataFrame:
    """node, n_shingles, signature, bands and whole text of the nodes that share a bucket; stored.

    All later steps read this table, so texts of other documents do not move but for those that share a mark by chance,
    and their signatures never: those of candidates are made again. Of each hash of a signature 8 bits are kept; that two hashes agree in them by chance can
    only keep a pair. doc_id and the hash of the text find the text; a row that is repeated is taken once.
    """

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, signer = Shingler(near.width), Signer(near)
        for batch in batches:
            for first, texts in text_chunks(batch.column(1)):
                sets = shingler.sets(texts)
                signatures = np.stack([signer.signature(s) for s in sets])
                columns = [
                    batch.column(0).slice(first, len(texts)),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([s.tobytes() for s in signatures.astype(np.uint8)], pa.binary()),
                    signer.band_lists(signatures),
                    batch.column(1).slice(first, len(texts)),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["node", "n_shingles", "signature", "bands", "text"])

    nodes = classes.join(members.select("node").distinct(), "node").select("node", "text_id", "text_key")
    nodes = stored(nodes, "candidate-nodes")
    texts = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("text_id"),
        F.xxhash64("text").alias("text_key"),
        F.col("text").cast("string").alias("text"),
    )
    texts = by_marks(texts, F.col("text"), marks(nodes), "left_semi")
    key = ["text_id", "text_key"]
    found = nodes.join(texts, key).dropDuplicates([*key, "node"]).select("node", "text")
    held = stored(found.mapInArrow(releasing(signed), CANDIDATES), "candidates")
    discard(nodes)
    return held


def similar(left: np.ndarray, right: np.ndarray, percent: int) -> bool:
    """Whether two sets, each sorted, are similar enough."""
    if 100 * min(len(left), len(right)) < percent * max(len(left), len(right)):
        return False
    shared = len(np.intersect1d(left, right, assume_unique=True))
    return 100 * shared >= percent * (len(left) + len(right) - shared)


def verify(pairs: DataFrame, texts: DataFrame, near: Near) -> DataFrame:
    """The distinct pairs (a, b) whose full shingle sets are similar enough; stored."""
    pairs = pairs.select("a", "b").distinct()
    own = texts.join(nodes_of(pairs), "node", "left_semi")
    a = own.select(F.col("node").alias("a"), F.col("text").alias("of_a"))
    b = own.select(F.col("node").alias("b"), F.col("text").alias("of_b"))

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(near.width)
        for batch in batches:
            for first, of_a in text_chunks(batch.column(2)):
                rows = batch.slice(first, len(of_a))
                of_b = rows.column(3).cast(pa.binary()).to_pylist()
                sets = zip(shingler.sets(of_a), shingler.sets(of_b))
                found = [k for k, (left, right) in enumerate(sets) if similar(left, right, near.percent)]
                yield rows.select([0, 1]).take(pa.array(found, pa.int64()))

    both = pairs.join(a, "a").join(b, "b").select("a", "b", "of_a", "of_b")
    return stored(both.mapInArrow(releasing(links), "a long, b long"), "links")


def bucket_members(signed: DataFrame, classes: DataFrame, near: Near) -> DataFrame:
    """key, node, first (the bucket's pivot), n and turn (the pivot's order) of all buckets of two nodes or more; stored."""
    nodes = signed.select(F.col("row").alias("node"), "bands").join(classes.select("node"), "node")
    rows = nodes.select("node", F.posexplode("bands").alias("band", "key"))
    rows = rows.select("node", "key", (F.col("band") % near.orders).alias("turn"))
    rank = F.struct(F.hash("node", "turn").alias("rank"), F.col("node"))
    buckets = rows.groupBy("key").agg(F.min(rank).alias("pivot"), F.count(F.lit(1)).alias("n")).where("n > 1")
    buckets = buckets.select("key", F.col("pivot.node").alias("first"), "n")
    return stored(rows.join(buckets, "key").select("key", "node", "first", "n", "turn"), "bucket-members")


def apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs whose nodes are not known to be connected."""
    a = roots.select(F.col("node").alias("a"), F.col("root").alias("root_a"))
    b = roots.select(F.col("node").alias("b"), F.col("root").alias("root_b"))
    both = pairs.join(a, "a", "left").join(b, "b", "left")
    return both.where(F.coalesce("root_a", "a") != F.coalesce("root_b", "b")).select(*pairs.columns)


def block_links(
    key: int,
    of_low: np.ndarray,
    pivot: np.ndarray,
    nodes: np.ndarray,
    roots: np.ndarray,
    signatures: np.ndarray,
    bands: np.ndarray,
    sets: list[np.ndarray],
    near: Near,
) -> list[tuple[int, int]]:
    """The links between nodes of one bucket that lie in different components: of two blocks, or within one.

    Pairs with the bucket's pivot were compared before. A pair is verified in the first bucket only that both share.
    """
    found = []
    numbers = np.unique(np.concatenate(sets), return_inverse=True)[1].astype(np.int32)
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    numbered = np.split(numbers, np.cumsum(sizes)[:-1])
    own = np.zeros(int(numbers.max()) + 1 if len(numbers) else 1, bool)
    high = np.flatnonzero(~of_low & ~pivot)
    within = bool(of_low.all())
    for i in np.flatnonzero(of_low & ~pivot).tolist():
        others = np.flatnonzero(~pivot[i + 1 :]) + i + 1 if within else high
        others = others[roots[others] != roots[i]]
        smaller, larger = np.minimum(sizes[others], sizes[i]), np.maximum(sizes[others], sizes[i])
        others = others[100 * smaller >= near.percent * larger]
        if not len(others):
            continue
        left = np.broadcast_to(signatures[i], (len(others), near.hashes))
        others = others[plausible(left, signatures[others], near)]
        shared = bands[others] == bands[i]
        others = others[bands[i][shared.argmax(axis=1)] == key]
        if not len(others):
            continue
        own[numbered[i]] = True
        of_others = np.concatenate([numbered[j] for j in others.tolist()])
        common = np.add.reduceat(own[of_others].astype(np.int64), np.cumsum(sizes[others]) - sizes[others])
        own[numbered[i]] = False
        linked = others[100 * common >= near.percent * (sizes[i] + sizes[others] - common)]
        found += [tuple(sorted((int(nodes[i]), int(nodes[j])))) for j in linked.tolist()]
    return found


def across(members: DataFrame, roots: DataFrame, held: DataFrame, near: Near) -> DataFrame:
    """Links (a, b) between nodes that share a bucket of three nodes or more but not a component; stored.

    A bucket is dealt into blocks of about ``block_shingles`` shingles, and each two blocks meet in one task. A node goes
    once to each of its bucket's blocks.
    """
    labelled = stored(
        members.where("n > 2")
        .join(roots, "node", "left")
        .join(held.select("node", "n_shingles"), "node")
        .select("key", "node", (F.col("node") == F.col("first")).alias("pivot"), F.coalesce("root", "node").alias("root"), "n_shingles"),
        "labelled-members",
    )
    split = labelled.groupBy("key").agg(
        F.min("root").alias("low"), F.max("root").alias("high"), F.sum(F.col("n_shingles") + near.hashes).alias("size")
    )
    blocks = F.ceil(F.col("size") / near.block_shingles).cast("int")
    split = split.where("low <> high").select("key", blocks.alias("blocks"))
    open_ = stored(labelled.join(split, "key").drop("n_shingles"), "open-members")
    discard(labelled)
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    others = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = open_.select("key", "node", "pivot", "root", own.alias("own"), others.alias("other"))
    dealt = dealt.select("key", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "pivot", "node", "root")
    rows = dealt.join(held, "node")
    of_low = (F.col("own") == F.col("low")).alias("of_low")
    rows = rows.select("key", "low", "high", of_low, "pivot", "node", "root", "signature", "bands", "text")

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(near.width)
        own: list[pa.RecordBatch] = []
        now = None

        def close() -> pa.RecordBatch:
            block = pa.Table.from_batches(own).combine_chunks()
            column = {name: block.column(name).chunk(0) for name in block.schema.names}
            flags = (column[c].to_numpy(zero_copy_only=False) for c in ("of_low", "pivot"))
            found = block_links(
                now[0],
                *flags,
                column["node"].to_numpy(),
                column["root"].to_numpy(),
                np.frombuffer(b"".join(column["signature"].to_pylist()), np.uint8).reshape(len(block), near.hashes),
                column["bands"].flatten().to_numpy().reshape(len(block), near.bands),
                [shingles for _, chunk in text_chunks(column["text"]) for shingles in shingler.sets(chunk)],
                near,
            )
            return pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], ["a", "b"])

        for batch in batches:
            marks = np.stack([batch.column(k).to_numpy().astype(np.int64) for k in range(3)], axis=1)
            cuts = (np.flatnonzero((marks[1:] != marks[:-1]).any(axis=1)) + 1).tolist()
            for first, last in zip([0, *cuts], [*cuts, len(batch)]):
                if first == last:
                    continue
                mark = tuple(marks[first].tolist())
                if own and mark != now:
                    yield close()
                    own.clear()
                now = mark
                own.append(batch.slice(first, last - first))
        if own:
            yield close()

    meeting = rows.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high", "node")
    links = stored(meeting.mapInArrow(releasing(compared), "a long, b long"), "links-across")
    discard(open_)
    return links


def nodes_of(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()


def connect(members: DataFrame, classes: DataFrame, docs: DataFrame, near: Near) -> DataFrame:
    """node and root of all nodes that a link connects to a smaller one."""
    held = candidates(members, classes, docs, near)
    pairs = members.where("node <> first").select(F.least("first", "node").alias("a"), F.greatest("first", "node").alias("b"), "turn")
    open_ = prune(pairs.groupBy("a", "b").agg(F.min("turn").cast("int").alias("turn")), held, near)
    texts = held.select("node", "text")
    links = verify(open_.where("turn = 0"), texts, near)
    roots = components(links)
    low = 1
    while low < near.orders:  # fewer and fewer pairs are left, so more orders go at once
        own = open_.where((F.col("turn") >= low) & (F.col("turn") < 3 * low))
        links = links.unionByName(verify(apart(own, roots), texts, near))
        roots = components(links)
        low *= 3
    discard(open_)
    links = links.unionByName(across(members, roots, held, near))
    discard(held)
    return components(links)


def near_duplicates(docs: DataFrame, near: Near = Near()) -> DataFrame:
    """doc_id, text_key (hash of the text), n_shingles, component_id and kept, one row per row of ``docs``.

    component_id is the smallest doc_id that links reach, kept whether it is the row's own. Texts that are null or
    without words have no shingles, are linked with nothing and kept. Rows of one doc_id and text are kept or dropped
    together. A row without a doc_id is kept only if nothing linked to it has one. No documents give no rows; further
    columns are not looked at.
    """
    signed = sign(docs, near)
    key = ["set_high", "set_low"]
    node = F.min(F.struct("row", F.coalesce("doc_id", F.lit(0)).alias("text_id"), "text_key")).alias("node")
    sets = signed.where("n_shingles > 0").groupBy(*key).agg(node, F.min("doc_id").alias("least_id"))
    node = (F.col("node")[name].alias(alias) for name, alias in (("row", "node"), ("text_id", "text_id"), ("text_key", "text_key")))
    classes = stored(sets.select(*key, *node, "least_id"), "shingle-classes")
    roots = connect(bucket_members(signed, classes, near), classes, docs, near)
    rooted = classes.join(roots, "node", "left").select(*key, "least_id", F.coalesce("root", "node").alias("root"))
    least = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    of_class = stored(rooted.join(least, "root").select(*key, "component_id"), "class-components")
    rows = signed.select("doc_id", "text_key", "n_shingles", *(F.when(F.col("n_shingles") > 0, F.col(k)).alias(k) for k in key))
    found = rows.join(of_class, key, "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    result = found.select("doc_id", "text_key", "n_shingles", component.alias("component_id"))
    return result.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def keep_one(docs: DataFrame, near: Near = Near()) -> DataFrame:
    """``docs`` without the documents that are near copies of one with a smaller doc_id; all columns stay, of any name.

    Only documents whose text shares a mark with a dropped one are shuffled to be compared by key.
    """
    dropped = near_duplicates(docs, near).where("not kept").select("doc_id", "text_key")
    dropped = stored(dropped.distinct(), "near-copies")
    marked = marks(dropped)
    dropped = dropped.select(F.struct("doc_id", "text_key").alias("dropped"))
    rows = docs.select(F.struct("*").alias("doc"))
    text = F.col("doc")["text"]
    unlike, alike = (by_marks(rows, text, marked, how) for how in ("left_anti", "left_semi"))
    same = F.col("doc")["doc_id"].cast("long").eqNullSafe(F.col("dropped.doc_id"))
    same = same & (F.xxhash64(text) == F.col("dropped.text_key"))
    return unlike.unionByName(alike.join(dropped, same, "left_anti")).select("doc.*")
