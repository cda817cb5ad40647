"""Exact Jaccard join of word n-grams: T-occurrence search with DivideSkip inside shards.

Two sets of sizes x <= y with a Jaccard similarity of at least t share at least
T = ceil(t / (1 + t) * (x + y)) shingles. In a shard, the T-occurrence search
has an inverted list for each shingle. A document that asks sets its L long
lists aside, merges the short ones on a heap with skips, keeps what is in T - L
of them, and probes these candidates in the long lists. Long are lists that
more than one in LONG_SHARE of the shard's documents are in; they are kept as a
bitmap, so the probes of many documents are one matrix product. Where L
reaches T, every document of a fitting size is a candidate, and the short lists
are counted.

Shards. Sets that link differ in at most H = x * (1 - t) / t shingles. So when
shingles are dealt to more than H bands by their hash, at least one band holds
the same shingles in both sets. A set has a key for each band: the hash of what
the band holds. The number of bands follows from the size's class; a set near a
class' lower end also has the keys of the class below, where its smaller
partners are. SPARE bands on top allow to leave empty bands out: sets with more
empty bands than that have keys for them too. No link can be missed, and sets
that only share some passages, however common, rarely agree on a whole band.

1. Documents become (size, hash of the set, keys) in one pass; equal sets are one node.
2. Keys that only one node has are dropped. Keys that many rows have, as a
   sample tells, are counted with partial sums; the others by a window.
3. A node goes to the shard of its centre, the least node that shares a key with
   it: each set travels once or twice, and near copies become classes. A large
   shard is cut into slices that all hold the centre.
4. Keys that still have nodes of different classes are open: their nodes go to
   the shard of the key's least class, which they visit or are at home in. All
   pairs that are not of one class meet there. A large shard is cut into blocks
   of its home and its visitors, and every pair of blocks is a task.

Links are those that connect (a search stops where two nodes are of one class
already), so no group of copies is ever expanded into its pairs. Shingles and
sets are compared as 64-bit hashes.

Defined results: null text and texts without words: an empty set, linked with
nothing; fewer words than the n-gram: the whole sequence is one shingle; null
doc_id: the row has its class' id but never names a class; repeated doc_id:
each row has its own class; empty table: no rows.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed, release_memory, small_batches, stored
from .components import class_ids, components

#: A size class ends at this multiple of its start.
CLASS_RATIO = 1.5
#: Bands beyond those needed: so many, and one more for each hundred.
SPARE = 2
#: Rows whose keys are looked at to find hot ones, and the count there from which a key is hot.
SAMPLE_ROWS = 20_000
HOT_IN_SAMPLE = 20
#: Hashes in a slice or block of a shard: 16 MB.
SHARD_HASHES = 2_000_000
#: A list is long if it holds more documents than LONG_LIST and than one of LONG_SHARE of its shard.
LONG_LIST = 8
LONG_SHARE = 8
#: Documents of a shard that ask at once, and most cells of their probes.
ASKING_ROWS = 256
PROBES = 1 << 22
#: Bits of a bitmap of wanted keys, and of one row of it.
MOST_BITS = 1 << 27
PAGE_BITS = 1 << 15
#: Bytes of a text that are cut into words at once.
CHUNK = 1 << 20

_FOLD = bytes(0x20 if b == 0x20 or 0x09 <= b <= 0x0D else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: bytes | None, n: int = 3) -> np.ndarray:
    """The sorted distinct hashes of a text's word n-grams."""
    folded, parts, at = (text or b"").translate(_FOLD), [], 0
    while at < len(folded):
        end = folded.find(b" ", at + CHUNK)
        end = len(folded) if end < 0 else end
        words = folded[at:end].split()
        parts.append(np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)))
        at = end
    words = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    if not len(words):
        return words
    size = min(n, len(words))
    count = len(words) - size + 1
    total = np.full(count, size, np.uint64)
    for i in range(size):
        total += words[i : count + i] * (mixed(np.array([i + 1], np.uint64)) | np.uint64(1))  # a weight for each place
    total = np.sort(mixed(total))
    return total[np.concatenate(([True], total[1:] != total[:-1]))]


def size_classes(largest: int, smallest: int) -> list[tuple[int, int]]:
    """(least, greatest size) of consecutive classes from ``smallest`` on."""
    out, low = [], smallest
    while low <= largest:
        out.append((low, int(low * CLASS_RATIO)))
        low = out[-1][1] + 1
    return out


def band_keys(hashes: np.ndarray, percent: int = 90) -> np.ndarray:
    """The keys of a set for all size classes that a partner smaller or equal may be in."""
    n, keys, scrambled = len(hashes), [], mixed(hashes)
    smallest = -(-percent // (100 - percent))  # below, only equal sets link
    for low, high in size_classes(n, smallest):
        if high < -(-percent * n // 100):
            continue
        spare = SPARE + high * (100 - percent) // percent // 100
        bands = high * (100 - percent) // percent + 1 + spare
        band = ((hashes >> np.uint64(32)) * np.uint64(bands)) >> np.uint64(32)  # hashes are sorted, so bands are runs
        starts = np.flatnonzero(np.concatenate(([True], band[1:] != band[:-1])))
        content, number = np.add.reduceat(scrambled, starts), band[starts]
        if bands - len(starts) > spare:
            empty = np.setdiff1d(np.arange(bands, dtype=np.uint64), number)
            content, number = np.concatenate([content, np.zeros(len(empty), np.uint64)]), np.concatenate([number, empty])
        keys.append(mixed(content + mixed(number * _GOLDEN + mixed(np.array([low], np.uint64)))))
    return np.unique(np.concatenate(keys)) if keys else np.zeros(0, np.uint64)


def _signed(hashes: np.ndarray) -> np.ndarray:
    return hashes.view(np.int64)


def profiles(docs: DataFrame, n: int, percent: int, doc_id: str, text: str) -> DataFrame:
    """doc_id, text_key, n_shingles, node (hash of the set, null if empty) and keys of every row."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, nodes, keys = [], [], []
            for x in batch.column(2):
                hashes = shingle_set(x.as_py(), n)
                sizes.append(len(hashes))
                nodes.append(xxhash.xxh3_64_intdigest(hashes.tobytes()) if len(hashes) else None)
                keys.append(_signed(band_keys(hashes, percent)))
            ends = np.concatenate(([0], np.cumsum([len(k) for k in keys])))
            node = pa.array([0 if v is None else v for v in nodes], pa.uint64(), mask=np.array([v is None for v in nodes], bool))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int64), *keys])))
            columns = [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), node.view(pa.int64()), lists]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "text_key", "n_shingles", "node", "keys"])
        release_memory()

    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.xxhash64(F.col(text).cast("string")).alias("text_key"), F.col(text).cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, text_key bigint, n_shingles bigint, node bigint, keys array<bigint>")


def shared_keys(rows: DataFrame) -> DataFrame:
    """key, node, least: the keys that several nodes have, and the least of those nodes."""
    rows = rows.where(F.size("keys") > 0)
    held = rows.select("node", F.explode("keys").alias("key"))
    share = max(rows.count() // SAMPLE_ROWS, 1)
    sampled = rows.where(F.pmod(F.xxhash64("doc_id", "node"), F.lit(share)) == 0).select(F.explode("keys").alias("key"))
    # few: a key of a sampled row has to be in HOT_IN_SAMPLE of the about SAMPLE_ROWS rows
    hot = stored(sampled.groupBy("key").count().where(F.col("count") >= HOT_IN_SAMPLE).select("key"))
    every = Window.partitionBy("key")
    cold = held.join(hot, "key", "left_anti").withColumns({"least": F.min("node").over(every), "most": F.max("node").over(every)}).where("least < most")
    busy = held.join(hot, "key", "left_semi")
    several = busy.groupBy("key").agg(F.min("node").alias("least"), F.max("node").alias("most")).where("least < most").select("key", "least")
    return cold.select("key", "node", "least").unionByName(busy.join(several, "key").select("key", "node", "least")).distinct()


def sifted(rows: DataFrame, key: str, wanted: DataFrame, wanted_key: str) -> DataFrame:
    """rows without most of those whose key (a hash) is not wanted, before a join shuffles them.

    A bitmap of the wanted keys goes to every task: 32 bits a key, MOST_BITS
    (16 MB) at most, beyond which it lets more rows pass.
    """
    bits = 1 << min(max(32 * wanted.count(), 1 << 15) - 1, MOST_BITS - 1).bit_length()
    place = lambda c: F.pmod(F.col(c), F.lit(bits))
    page = lambda c: F.floor(place(c) / PAGE_BITS)
    maps = wanted.groupBy(page(wanted_key).alias("page")).agg(F.bitmap_construct_agg(place(wanted_key) % PAGE_BITS).alias("map"))
    at = place(key) % PAGE_BITS
    byte = F.conv(F.hex(F.substring("map", (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    known = F.expr(f"shiftright(byte_of_map, cast(pmod(pmod({key}, {bits}L), 8) as int)) & 1") == 1
    return rows.join(F.broadcast(maps), page(key) == F.col("page")).withColumn("byte_of_map", byte).where(known).select(*rows.columns)


def node_sets(docs: DataFrame, rows: DataFrame, nodes: DataFrame, n: int, doc_id: str, text: str) -> DataFrame:
    """node, n_shingles, hashes of the wanted nodes, from one row of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [_signed(shingle_set(x.as_py(), n)) for x in batch.column(1)]
            ends = np.concatenate(([0], np.cumsum([len(s) for s in sets])))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int64), *sets])))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(ends), pa.int64()), lists], names=["node", "n_shingles", "hashes"])
        release_memory()

    # copies of one text meet in partial sums before the shuffle
    first = rows.where(F.col("node").isNotNull()).groupBy("node", "text_key").agg(F.min("doc_id").alias("id")).join(nodes, "node", "left_semi")
    pick = F.min(F.struct("text_key", "id")).alias("pick")
    wanted = stored(first.groupBy("node").agg(pick).select("node", F.col("pick.text_key").alias("wanted_key"), F.col("pick.id").alias("wanted_id")))
    texts = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.xxhash64(F.col(text).cast("string")).alias("text_key"), F.col(text).cast("binary").alias("text"))
    found = sifted(texts, "text_key", wanted, "wanted_key").join(wanted, (F.col("text_key") == F.col("wanted_key")) & F.col("doc_id").eqNullSafe(F.col("wanted_id")))
    return found.select("node", "text").mapInArrow(run, "node bigint, n_shingles bigint, hashes array<bigint>").dropDuplicates(["node"])


def merge_skip(lists: list[tuple[int, int]], documents: list[int], least: int, low: int, high: int) -> Iterator[tuple[int, int]]:
    """(document, in how many lists) of the documents from low to below high in at least ``least`` lists (runs of ``documents``)."""
    heap = [(documents[at], at, end) for start, end in lists if (at := bisect_left(documents, low, start, end)) < end]
    heapify(heap)
    while len(heap) >= least and heap[0][0] < high:
        top, taken = heap[0][0], []
        while heap and heap[0][0] == top:
            taken.append(heappop(heap))
        if len(taken) >= least:
            yield top, len(taken)
            goal = top + 1
        else:
            # what lies before the next value on the heap is in fewer than ``least`` lists
            while heap and len(taken) < least - 1:
                taken.append(heappop(heap))
            if not heap:
                return
            goal = max(heap[0][0], top + 1)
        for _, at, end in taken:
            if (at := bisect_left(documents, goal, at, end)) < end:
                heappush(heap, (documents[at], at, end))


class Shard:
    """The inverted lists of a shard's sets, its documents by size; lists longer than a share of the shard are kept as a bitmap."""

    def __init__(self, members: list[np.ndarray]) -> None:
        self.sizes = np.array([len(m) for m in members], np.int64)
        found, self.inverse, self.counts = np.unique(np.concatenate(members), return_inverse=True, return_counts=True)
        self.first = np.concatenate(([0], np.cumsum(self.sizes)))
        self.postings = np.repeat(np.arange(len(members)), self.sizes)[np.argsort(self.inverse, kind="stable")]
        self.ends = np.cumsum(self.counts)
        self.long = self.counts > max(LONG_LIST, len(members) // LONG_SHARE)
        self.column = np.cumsum(self.long) - 1
        self.bitmap = np.zeros((len(members), int(self.long.sum())), np.float32)
        at = self.long[self.inverse]
        self.bitmap[np.repeat(np.arange(len(members)), self.sizes)[at], self.column[self.inverse[at]]] = 1
        self.documents = self.postings.tolist()

    def lists(self, i: int) -> np.ndarray:
        """The lists of a document that hold others too."""
        own = self.inverse[self.first[i] : self.first[i + 1]]
        return own[self.counts[own] > 1]

    def runs(self, lists: np.ndarray) -> list[tuple[int, int]]:
        return list(zip((self.ends[lists] - self.counts[lists]).tolist(), self.ends[lists].tolist(), strict=True))


def linked_nodes(nodes: np.ndarray, sets: list[np.ndarray], labels: list[int], home: list[bool], percent: int, centre: int | None = None) -> list[tuple[int, int]]:
    """Links (places in nodes) that connect all of a shard that are similar enough and not of one class, home with home left out."""
    order = sorted(range(len(nodes)), key=lambda i: (len(sets[i]), nodes[i]))
    members = [sets[i] for i in order]
    sizes = np.array([len(m) for m in members], np.int64)
    label = np.unique([labels[i] for i in order], return_inverse=True)[1]
    out: list[tuple[int, int]] = []

    def overlap(x: int, y: np.ndarray | int) -> np.ndarray | int:
        return -(-percent * (x + y) // (100 + percent))

    def link(i: int, others: np.ndarray) -> None:
        """One link to each class that others are in."""
        known, at = np.unique(label[others], return_index=True)
        out.extend((order[i], order[j]) for j in others[at].tolist())
        label[np.isin(label, known)] = label[i]

    asking = np.flatnonzero(~np.array([home[i] for i in order], bool))
    if centre is not None:
        # all meet the centre first: its near copies are one class and need not ask
        c = order.index(centre)
        for i, own in enumerate(members):
            if i != c and 100 * min(sizes[i], sizes[c]) >= percent * max(sizes[i], sizes[c]):
                place = np.minimum(np.searchsorted(members[c], own), sizes[c] - 1)
                if int((members[c][place] == own).sum()) >= overlap(int(sizes[i]), int(sizes[c])) and label[i] != label[c]:
                    link(c, np.array([i]))
        asking = asking[label[asking] != label[c]]
    if not len(asking):
        return out
    shard = Shard(members)
    step = max(1, min(ASKING_ROWS, PROBES // len(members)))
    for begin in range(0, len(asking), step):
        block = asking[begin : begin + step]
        probed = shard.bitmap[block] @ shard.bitmap.T
        for i, in_long in zip(block.tolist(), probed, strict=True):
            x = int(sizes[i])
            low, high = np.searchsorted(sizes, -(-percent * x // 100)), np.searchsorted(sizes, 100 * x // percent, "right")
            needed, own = overlap(x, -(-percent * x // 100)), shard.lists(i)
            if len(own) < needed or (label[low:high] == label[i]).all():
                continue
            goal, short = overlap(x, sizes), own[~shard.long[own]]
            least = needed - (len(own) - len(short))
            if least > 0:
                found = [j for j, seen in merge_skip(shard.runs(short), shard.documents, least, low, high) if label[j] != label[i] and seen + in_long[j] >= goal[j]]
                hits = np.array(found, np.int64)
            else:
                # the long lists alone may suffice: every document of a fitting size is a candidate
                parts = [shard.postings[a:b] for a, b in shard.runs(short)]
                seen = np.bincount(np.concatenate(parts), minlength=len(order)) if parts else 0
                fits = (in_long + seen >= goal) & (label != label[i])
                hits = low + np.flatnonzero(fits[low:high])
            if len(hits):
                link(i, hits)
    return out


def _links(found: pa.Table, percent: int, centre: int | None) -> pa.Table:
    nodes = found["node"].to_numpy()
    sets = [x.values.to_numpy().view(np.uint64) for x in found["hashes"]]
    labels, home = found["label"].to_pylist(), found["home"].to_pylist()
    at = None if centre is None else int(np.flatnonzero(nodes == centre)[0])
    pairs = np.array(linked_nodes(nodes, sets, labels, home, percent, at), np.int64).reshape(-1, 2)
    release_memory()
    return pa.table({"a": nodes[pairs[:, 0]], "b": nodes[pairs[:, 1]]})


def centre_links(keys: DataFrame, sets: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """(a, b): links found in the shards of centres; and node, centre, slice: where each node went."""
    centres = keys.groupBy("node").agg(F.min("least").alias("centre"))
    sized = centres.join(sets.select("node", "n_shingles"), "node")
    slices = sized.groupBy("centre").agg(F.ceil(F.sum("n_shingles") / SHARD_HASHES).cast("int").alias("slices"))
    placed = stored(sized.join(slices, "centre").select("node", "centre", F.pmod(F.xxhash64("node"), F.col("slices")).cast("int").alias("slice")))
    hosts = slices.select(F.col("centre").alias("node"), "centre", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"))
    shards = placed.unionByName(hosts).distinct().join(sets.select("node", "hashes"), "node")

    def search(key: tuple, found: pa.Table) -> pa.Table:
        return _links(found, percent, key[0].as_py())

    shards = shards.withColumns({"label": F.col("node"), "home": F.lit(False)})
    return shards.groupBy("centre", "slice").applyInArrow(search, "a bigint, b bigint"), placed


def class_links(keys: DataFrame, placed: DataFrame, classes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): links between nodes of different classes that share a key and did not all meet in one shard before."""
    where = placed.join(classes, "node", "left").select("node", "centre", "slice", F.coalesce("root", "node").alias("label"))
    known = checkpointed(keys.join(where, "node"))
    # all of a key met if its least node is the centre of the others, which have one slice
    other = F.col("node") != F.col("least")
    met = (F.max(F.when(other, F.col("centre") != F.col("least"))) == F.lit(False)) & (F.min(F.when(other, F.col("slice"))) == F.max(F.when(other, F.col("slice"))))
    open_keys = known.groupBy("key").agg(F.min("label").alias("owner"), F.max("label").alias("last"), met.alias("met")).where("owner < last AND NOT met").select("key", "owner")
    guests = known.join(open_keys, "key").select("owner", "node", "label").distinct().withColumn("home", F.col("label") == F.col("owner"))
    guests = checkpointed(guests.join(sets.select("node", "n_shingles"), "node"))
    part = lambda home: F.greatest(F.ceil(F.sum(F.when(home, F.col("n_shingles")).otherwise(0)) / SHARD_HASHES), F.lit(1)).cast("int")
    blocks = guests.groupBy("owner").agg(part(F.col("home")).alias("homes"), part(~F.col("home")).alias("visits"))
    own = F.pmod(F.xxhash64("node"), F.when(F.col("home"), F.col("homes")).otherwise(F.col("visits"))).cast("int")
    numbers = lambda n: F.sequence(F.lit(0), n - 1)
    task = lambda i, j: F.struct(i.cast("int").alias("i"), j.cast("int").alias("j"))
    at_home = F.transform(numbers(F.col("visits")), lambda v: task(F.col("own"), v))
    visiting = F.transform(numbers(F.col("homes")), lambda h: task(h, F.col("own")))
    pairs = F.transform(F.filter(numbers(F.col("visits")), lambda v: v != F.col("own")), lambda v: task(-1 - F.least(v, F.col("own")), F.greatest(v, F.col("own"))))
    tasks = guests.join(blocks, "owner").withColumn("own", own).withColumn("task", F.explode(F.when(F.col("home"), at_home).otherwise(F.concat(visiting, pairs))))
    shards = tasks.select("owner", "task.i", "task.j", "node", "label", "home").join(sets.select("node", "hashes"), "node")

    def search(found: pa.Table) -> pa.Table:
        return _links(found, percent, None)

    return shards.groupBy("owner", "i", "j").applyInArrow(search, "a bigint, b bigint")


def jaccard_join(docs: DataFrame, n: int = 3, percent: int = 90, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id of every row: the smallest doc_id that its set reaches by links."""
    rows = stored(profiles(docs, n, percent, doc_id, text))
    keys = stored(shared_keys(rows))
    sets = stored(node_sets(docs, rows.select("doc_id", "text_key", "node"), keys.select("node").distinct(), n, doc_id, text))
    links, placed = centre_links(keys, sets, percent)
    links = checkpointed(links)
    classes = components(links)
    more = checkpointed(class_links(keys, placed, classes, sets, percent))
    if not more.isEmpty():
        classes = components(links.unionByName(more))
    return class_ids(rows.select("doc_id", "n_shingles", "node"), "node", classes)
