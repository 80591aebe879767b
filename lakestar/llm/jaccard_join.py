"""Near duplicates by n-gram Jaccard: a join over vertical fragments of the global n-gram order.

The global order is the order of the n-grams' 64-bit hashes. It is cut into fragments; a document's set
falls into one segment per fragment. Two sets that are similar enough differ in few n-grams, so with more
fragments than that some segment is equal in both: documents with an equal segment are candidates. For
candidates, overlaps are counted in each of ``PARTS`` coarse fragments on its own and summed per pair.

Links are only needed as far as they connect. Documents with an equal set are one node. N-grams that no other
candidate has bound every overlap from above, which excludes most nodes and pairs. The nodes that share a
segment are compared with one of them, its leader; linked ones need no comparison with each other. Where a
segment's nodes end in several components, the pairs across components are compared too. All pairs are screened
by bitmaps, which bound differences from below, and sets are moved only for those that pass. So the components
are exactly those of all links.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestar.llm.common import narrow_join, release_memory, stored, without_rows
from lakestar.llm.tokenizer_words import groups_of_text

# Coarse fragments, a power of two, in which overlaps are counted.
PARTS = 8
# Signatures per bucket, the work of one task.
BUCKET_SIGNATURES = 1_000_000
# Characters of texts whose sets are held at a time while they are cut.
SIGNED_CHARS = 1_000_000
# Members of a segment that one task compares with each other or with as many others.
BLOCK_MEMBERS = 2_000
# Steps in which the n-grams of the coarse fragments are counted, so that the disk holds a share of them at a time.
CORE_STEPS = 2
# Other cuts of the order for sets that leave too many fragments empty.
LEVELS = 4
_K = np.uint64(0x9E3779B97F4A7C15)


def mixed(h: np.ndarray) -> np.ndarray:
    """A 64-bit mix of each number."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def gram_sets(texts: list[str], n: int) -> list[np.ndarray]:
    """The sorted distinct hashes of the word n-grams of each text.

    Words are runs without ASCII white space, A-Z in lower case. A text of fewer words is one n-gram as a
    whole; without words its set is empty.
    """
    split = [t.encode("utf-8", "surrogatepass").lower().split() for t in texts]
    sizes = [len(s) for s in split]
    digest = xxhash.xxh3_64_intdigest
    words = mixed(np.fromiter((digest(w) for s in split for w in s), dtype=np.uint64, count=sum(sizes)))
    whole = max(0, len(words) - n + 1)
    grams = words[:whole]
    for j in range(1, n):
        grams = mixed(grams * _K + words[j : whole + j])
    out, start = [], 0
    for size in sizes:
        if size >= n:
            own = np.sort(grams[start : start + size - n + 1])
            out.append(own[np.concatenate([[True], own[1:] != own[:-1]])])
        elif size:
            short = words[start : start + 1]
            for j in range(1, size):
                short = mixed(short * _K + words[start + j : start + j + 1])
            out.append(mixed(short + np.uint64(size)))
        else:
            out.append(grams[:0])
        start += size
    return out


def node_of(grams: np.ndarray) -> int | None:
    """A signed 64-bit hash of a set; None for the empty one."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(grams.tobytes())).view(np.int64)) if len(grams) else None


@dataclass(frozen=True)
class SizeClasses:
    """Classes of set sizes, such that sets that can link lie in one class or in neighbouring ones.

    ``starts`` are the least sizes of the classes, ``most`` the largest possible symmetric difference of a
    linked pair whose smaller set is in the class, ``fragments`` the number of fragments for such pairs.
    """

    starts: np.ndarray
    most: np.ndarray
    fragments: np.ndarray

    def of(self, sizes: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, sizes, side="right") - 1


@lru_cache(maxsize=4)
def size_classes(percent: int) -> SizeClasses:
    """Classes for links at 100 * intersection >= percent * union."""
    starts = [1]
    while starts[-1] < 1 << 40:
        starts.append(max(starts[-1] + 1, (starts[-1] - 1) * 100 // percent + 1))
    most, fragments = [], []
    for low, high in zip(starts, starts[1:]):
        total = (high - 1) + (high - 1) * 100 // percent
        differ = total * (100 - percent) // (100 + percent)
        cut = differ + 1
        # Enough fragments that the smallest set of the class fills more than `differ` almost surely.
        while differ and cut < 4 * (differ + 1):
            empty = cut * math.exp(-low / cut)
            if cut - empty - 2 * math.sqrt(empty) > differ:
                break
            cut += max(1, cut // 64)
        most.append(differ)
        fragments.append(cut)
    return SizeClasses(np.array(starts[:-1]), np.array(most), np.array(fragments))


def signatures(sets: list[np.ndarray], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(signature, place of its set) of the segments by which linked sets find each other.

    A set takes part in its own size class and, as the larger one, in the class below. A segment's
    signature hashes its n-grams, its fragment and its class. Empty segments say nothing; a set with so many
    of them that a linked set might share no other segment also takes part in the next cut of the order, and
    in the last cut with its empty segments.
    """
    classes = size_classes(percent)
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    kept = np.flatnonzero(sizes)
    own = classes.of(sizes[kept])
    below = own > 0
    below[below] = 100 * (classes.starts[own[below]] - 1) >= percent * sizes[kept[below]]
    place = np.concatenate([kept, kept[below]])
    group = np.concatenate([own, own[below] - 1])
    some = classes.most[group] > 0  # without room for a difference only equal sets link
    place, group = place[some], group[some]
    found, owners = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for level in range(LEVELS):
        if not len(place):
            break
        sets_here = [sets[i] for i in place]
        if level:
            sets_here = [np.sort(mixed(s + np.uint64(level * int(_K) % (1 << 64)))) for s in sets_here]
        lengths = sizes[place]
        grams = np.concatenate(sets_here)
        row = np.repeat(np.arange(len(place)), lengths)
        cut = classes.fragments[group]
        fragment = ((grams >> np.uint64(32)) * cut[row].astype(np.uint64)) >> np.uint64(32)
        starts = np.flatnonzero((np.diff(row, prepend=-1) != 0) | (np.diff(fragment.astype(np.int64), prepend=-1) != 0))
        segment = np.add.reduceat(mixed(grams), starts)
        at = row[starts]
        kind = mixed(group.astype(np.uint64) * np.uint64(LEVELS) + np.uint64(level) + _K)
        found.append(mixed(mixed(segment) + mixed(kind[at] + fragment[starts])))
        owners.append(place[at])
        filled = np.bincount(at, minlength=len(place))
        weak = filled <= classes.most[group]
        if level == LEVELS - 1:
            for i in np.flatnonzero(weak):
                empty = np.setdiff1d(np.arange(cut[i]), fragment[starts][at == i]).astype(np.uint64)
                found.append(mixed(mixed(np.zeros(len(empty), np.uint64)) + mixed(kind[i] + empty)))
                owners.append(np.full(len(empty), place[i]))
        place, group = place[weak], group[weak]
    return np.concatenate(found), np.concatenate(owners)


def _members(documents: DataFrame, n: int) -> DataFrame:
    """``doc_id, mark, n_shingles, node`` of each row; ``mark`` is a hash of the text."""

    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, nodes = [], []
            for group in groups_of_text(batch["text"].to_pylist(), SIGNED_CHARS):
                sets = gram_sets(group, n)
                sizes += [len(s) for s in sets]
                nodes += [node_of(s) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["mark"], pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64())],
                names=["doc_id", "mark", "n_shingles", "node"])
            release_memory()

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("mark"), "text")
    return rows.mapInArrow(measure, "doc_id long, mark long, n_shingles long, node long")


def _packed(columns: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    buckets, *arrays = zip(*columns)
    return pa.RecordBatch.from_arrays(
        [pa.array(buckets, pa.int32()), *(pa.array([a.tobytes() for a in some], pa.binary()) for some in arrays)],
        names=["bucket", "signatures", "leaders", "members"])


def _candidates(documents: DataFrame, n: int, percent: int, buckets: int) -> DataFrame:
    """Stars of the segments that several nodes share: ``a`` (leader), ``b`` and the signature.

    A task sends each of its signatures once, with the least of its nodes; its other nodes are paired with
    that one where they are read. So a segment that very many nodes share arrives once per task.
    """

    def sign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, batch in enumerate(batches):
            nodes, found, owners = [], [], []
            for group in groups_of_text(batch["text"].to_pylist(), SIGNED_CHARS):
                sets = {node_of(s): s for s in gram_sets(group, n) if len(s)}
                some, places = signatures(list(sets.values()), percent)
                nodes.append(np.fromiter(sets, dtype=np.int64, count=len(sets)))
                found.append(some)
                owners.append(nodes[-1][places])
            found, owner = np.concatenate([np.zeros(0, np.uint64), *found]), np.concatenate([np.zeros(0, np.int64), *owners])
            if not len(found):
                continue
            del owners, nodes
            order = np.lexsort((owner, found))
            found, owner = found[order], owner[order]
            del order
            again = np.zeros(len(found), dtype=bool)
            again[1:] = (found[1:] == found[:-1]) & (owner[1:] == owner[:-1])
            found, owner = found[~again], owner[~again]
            starts = np.flatnonzero(np.concatenate([[True], found[1:] != found[:-1]]))
            leader = np.repeat(owner[starts], np.diff(np.append(starts, len(found))))
            where = (found[starts] >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
            edges = np.searchsorted(where, np.arange(buckets + 1).astype(np.uint64))
            rows = [(b, found[starts[low:high]], owner[starts[low:high]], np.zeros(0, np.int64))
                    for b, (low, high) in enumerate(zip(edges, edges[1:])) if low < high]
            pairs = leader != owner
            if pairs.any():
                rows.append((-1 - (int(owner[0]) + number) % buckets, found[pairs], leader[pairs], owner[pairs]))
            yield _packed(rows)
            release_memory()

    def stars(table: pa.Table) -> pa.Table:
        def joined(name, kind):
            return np.frombuffer(b"".join(table[name].to_pylist()), dtype=kind)

        found, leaders, members = joined("signatures", "<u8"), joined("leaders", "<i8"), joined("members", "<i8")
        if not len(members):
            order = np.lexsort((leaders, found))
            found, members = found[order], leaders[order]
            starts = np.flatnonzero(np.concatenate([[True], found[1:] != found[:-1]]))
            leaders = np.repeat(members[starts], np.diff(np.append(starts, len(found))))
            pairs = leaders != members
            found, leaders, members = found[pairs], leaders[pairs], members[pairs]
        return pa.table({"a": pa.array(leaders), "b": pa.array(members), "signature": pa.array(found.view(np.int64))})

    packed = documents.select("text").mapInArrow(
        sign, "bucket int, signatures binary, leaders binary, members binary")
    return packed.groupBy("bucket").applyInArrow(stars, "a long, b long, signature long")


def parity_bits(grams: np.ndarray, percent: int) -> np.ndarray:
    """A bitmap of a set in which each n-gram flips one bit.

    Two sets differ in at least as many n-grams as their bitmaps differ in bits. It has about four bits per
    n-gram in which a linked set may differ; halves of a longer bitmap are folded by exclusive or.
    """
    room = 4 * len(grams) * (100 - percent) // percent
    bits = 1 << max(9, min(16, room.bit_length()))
    place = (mixed(grams ^ _K) & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits(np.bincount(place, minlength=bits) & 1, bitorder="little").view(np.int64)


def _segments(documents: DataFrame, members: DataFrame, wanted: DataFrame, n: int, percent: int) -> DataFrame:
    """``node, part, grams``: the sets of wanted nodes, cut into coarse fragments; part -1 is the bitmap.

    Sets are read from the first row of each node and shuffled only where ids repeat, to keep one of each.
    """

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges = np.arange(1, PARTS).astype(np.uint64) << np.uint64(64 - (PARTS - 1).bit_length())
        for batch in batches:
            for group in groups_of_text(batch["text"].to_pylist(), SIGNED_CHARS):
                nodes, parts, grams = [], [], []
                for own in gram_sets(group, n):
                    if len(own):
                        node = node_of(own)
                        nodes.append(node)
                        parts.append(-1)
                        grams.append(parity_bits(own, percent))
                        for part, piece in enumerate(np.split(own, np.searchsorted(own, edges))):
                            if len(piece):
                                nodes.append(node)
                                parts.append(part)
                                grams.append(piece.view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(nodes, pa.int64()), pa.array(parts, pa.int32()), pa.array(grams, pa.list_(pa.int64()))],
                    names=["node", "part", "grams"])
            release_memory()

    firsts, same = wanted.select(F.col("first").alias("__first")), F.col("doc_id").eqNullSafe(F.col("__first"))
    rows = narrow_join(documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), firsts, same, "left_semi")
    cuts = rows.select("text").mapInArrow(cut, "node long, part int, grams array<bigint>")
    cuts = narrow_join(cuts, wanted.select("node"), ["node"], "left_semi")
    read = narrow_join(narrow_join(members, firsts, same, "left_semi"), wanted.select("node"), ["node"], "left_semi")
    if read.count() == wanted.count():
        return cuts
    return cuts.groupBy("node", "part").agg(F.first("grams").alias("grams"))


def _folded_to(bits: Column, length: Column) -> Column:
    """A bitmap at a shorter length, see `parity_bits`."""
    folded = F.transform(F.sequence(F.lit(1), length), lambda i: F.aggregate(
        F.sequence(i, F.size(bits), length), F.lit(0).cast("long"),
        lambda mixed_bits, at: mixed_bits.bitwiseXOR(F.element_at(bits, at))))
    return F.when(F.size(bits) == length, bits).otherwise(folded)


def _screened(pairs: DataFrame, bitmaps: DataFrame, percent: int) -> DataFrame:
    """The pairs whose bitmaps allow them to link; only bitmaps are moved, no sets."""
    left = bitmaps.select(F.col("node").alias("a"), F.col("bits").alias("abits"))
    right = bitmaps.select(F.col("node").alias("b"), F.col("bits").alias("bbits"))
    length = F.least(F.size("abits"), F.size("bbits"))
    differing = F.zip_with(
        _folded_to(F.col("abits"), length), _folded_to(F.col("bbits"), length),
        lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    differ = F.aggregate(differing, F.lit(0), lambda total, bits: total + bits)
    close = differ * (100 + percent) <= (100 - percent) * (F.col("na") + F.col("nb"))
    return pairs.join(left, "a").join(right, "b").filter(close).select("a", "b", "na", "nb")


def _links(pairs: DataFrame, segments: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` that link: overlaps are counted per part and summed per pair.

    Only sets of the pairs' nodes are moved.
    """
    paired = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    segments = narrow_join(segments, paired, ["node"], "left_semi")
    left = segments.select(F.col("node").alias("a"), "part", F.col("grams").alias("ga"))
    right = segments.select(F.col("node").alias("b"), "part", F.col("grams").alias("gb"))
    counted = pairs.join(left, "a").join(right, ["b", "part"]).select(
        "a", "b", "na", "nb", F.size(F.array_intersect("ga", "gb")).alias("shared"))
    summed = counted.groupBy("a", "b", "na", "nb").agg(F.sum("shared").alias("shared"))
    return summed.filter(100 * F.col("shared") >= percent * (F.col("na") + F.col("nb") - F.col("shared"))).select("a", "b")


def _cores(candidates: DataFrame, segments: DataFrame, percent: int) -> DataFrame:
    """``node, n, core`` of the candidates that can link at all.

    The core of a set is what is left without the n-grams that no other candidate has. An overlap is at
    most as large as either core.
    """
    counts = None
    for step in range(CORE_STEPS):
        grams = segments.filter(F.col("part") % CORE_STEPS == step).select("node", F.explode("grams").alias("gram"))
        alone = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("node")).filter("n = 1")
        some = stored(alone.groupBy("node").agg(F.count(F.lit(1)).alias("alone")), "jaccard-alone")
        counts = some if counts is None else counts.unionByName(some)
    counts = counts.groupBy("node").agg(F.sum("alone").alias("alone"))
    cores = candidates.join(counts, "node", "left").select(
        "node", "n", (F.col("n") - F.coalesce("alone", F.lit(0))).alias("core"))
    return cores.filter(100 * F.col("core") >= percent * F.col("n"))


def _may_link(n: Column, core: Column, other_n: Column, other_core: Column, percent: int) -> Column:
    """Whether the sizes and cores of two sets allow the overlap that a link needs."""
    return (100 + percent) * F.least(n, other_n, core, other_core) >= percent * (n + other_n)


def _stars(members: DataFrame, leaders: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs ``a, b, na, nb`` of each signature's leader and the members that may link with it."""
    led = leaders.select(
        "signature", F.col("node").alias("leader"), F.col("n").alias("ln"), F.col("core").alias("lcore"),
        F.col("root").alias("lroot"))
    on = (members["signature"] == led["signature"]) & (members["root"] != led["lroot"]) & _may_link(
        members["n"], members["core"], led["ln"], led["lcore"], percent)
    return _ordered(members.join(led, on), "node", "n", "leader", "ln")


def _ordered(pairs: DataFrame, node: str, n: str, other: str, other_n: str) -> DataFrame:
    """Distinct pairs with the lesser node first."""
    first = F.col(node) < F.col(other)
    return pairs.select(
        F.least(node, other).alias("a"), F.greatest(node, other).alias("b"),
        F.when(first, F.col(n)).otherwise(F.col(other_n)).alias("na"),
        F.when(first, F.col(other_n)).otherwise(F.col(n)).alias("nb")).distinct()


def _across(members: DataFrame, bitmaps: DataFrame, percent: int) -> DataFrame:
    """The pairs of a signature's members in different components that sizes, cores and bitmaps allow to link.

    The members of a signature are dealt to blocks of bounded size; each task compares two blocks in arrays
    and returns only the pairs that pass, which are few besides those that link.
    """
    counts = members.groupBy("signature").agg((F.ceil(F.count(F.lit(1)) / BLOCK_MEMBERS)).cast("int").alias("blocks"))
    rows = members.join(counts, "signature").join(bitmaps, "node")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select(
        "signature", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
        "block", "node", "n", "core", "root", "bits")
    keys = ("signature", "low", "high")
    rows = rows.repartition(*keys).sortWithinPartitions(*keys)

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            # Groups are consecutive; the last one of a batch may go on in the next.
            held.append(batch)
            table = pa.Table.from_batches(held)
            starts = _group_starts(table)
            for low, high in zip(starts, starts[1:]):
                yield from _pairs_of(table.slice(low, high - low), percent)
            held = table.slice(starts[-1]).combine_chunks().to_batches() if len(starts) else []
        if held:
            yield from _pairs_of(pa.Table.from_batches(held), percent)

    pairs = rows.mapInArrow(compare, "x long, nx long, y long, ny long")
    return _ordered(pairs, "x", "nx", "y", "ny")


def _group_starts(table: pa.Table) -> list[int]:
    """Where each run of equal (signature, low, high) begins."""
    if not table.num_rows:
        return []
    changed = np.zeros(table.num_rows, dtype=bool)
    changed[0] = True
    for name in ("signature", "low", "high"):
        values = table[name].to_numpy()
        changed[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(changed).tolist()


def _folded(bitmaps: list[np.ndarray]) -> np.ndarray:
    """The bitmaps at the length of the shortest."""
    least = min(map(len, bitmaps))
    return np.stack([np.bitwise_xor.reduce(b.reshape(-1, least), axis=0) for b in bitmaps]).view(np.uint64)


def _pairs_of(group: pa.Table, percent: int) -> Iterator[pa.RecordBatch]:
    """The pairs of one group that may link, see `_across`."""
    node, n, core, root, block = (group[c].to_numpy() for c in ("node", "n", "core", "root", "block"))
    if not len(node) or (root == root[0]).all():
        return
    bits = _folded([np.asarray(v, dtype=np.int64) for v in group["bits"].to_pylist()])
    low, high = group["low"][0].as_py(), group["high"][0].as_py()
    mine = np.flatnonzero(block == low)
    theirs = mine if low == high else np.flatnonzero(block == high)
    step = max(1, (1 << 21) // max(1, bits.shape[1] * len(theirs)))
    for at in range(0, len(mine), step):
        i = mine[at : at + step, None]
        j = theirs[None, :]
        total = n[i] + n[j]
        able = (root[i] != root[j]) & (
            (100 + percent) * np.minimum(np.minimum(n[i], n[j]), np.minimum(core[i], core[j])) >= percent * total)
        if low == high:
            able &= i < j
        p, q = np.nonzero(able)
        p, q = mine[at + p], theirs[q]
        differ = np.bitwise_count(bits[p] ^ bits[q]).sum(axis=1, dtype=np.int64)
        close = differ * (100 + percent) <= (100 - percent) * (n[p] + n[q])
        p, q = p[close], q[close]
        if len(p):
            yield pa.RecordBatch.from_arrays(
                [pa.array(a) for a in (node[p], n[p], node[q], n[q])], names=["x", "nx", "y", "ny"])


def components(edges: DataFrame) -> DataFrame:
    """``node, root``: the least node of the component, for the nodes of the edges ``a, b``.

    Large and small stars in turn: every node links its larger neighbours, then its smaller ones, to the
    least node that it knows, until nothing changes. Each round is a written table.
    """
    edges = stored(edges.filter("a <> b").select("a", "b").distinct(), "component-edges")
    seen = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        smallest = large.groupBy("a").agg(F.min("b").alias("m"))
        met = large.join(smallest, "a")
        small = met.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.unionByName(smallest.select("a", F.col("m").alias("b")))
        edges = stored(small.distinct(), "component-edges")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == seen:
            roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
        seen = now


def _unresolved(members: DataFrame, roots: DataFrame) -> DataFrame:
    """The members, with their present roots, of the signatures whose members are in several components."""
    rooted = members.drop("root").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    several = rooted.groupBy("signature").agg(F.min("root").alias("x"), F.max("root").alias("y")).filter("x <> y")
    return rooted.join(several.select("signature"), "signature", "left_semi").select(*members.columns)


def _leaders(members: DataFrame) -> DataFrame:
    """One member of each signature: the one whose n-grams are shared most, of equal ones the least."""
    first = F.struct((F.col("core") - F.col("n")).alias("alone"), (-F.col("n")).alias("size"), -F.col("node"))
    row = F.struct("node", "n", "core", "root")
    return members.groupBy("signature").agg(F.max_by(row, first).alias("l")).select("signature", "l.*")


def near_duplicates(documents: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """One row per document row: ``doc_id, mark, n_shingles, node, component_id, stays``.

    ``n_shingles`` is the size of its set of word n-grams; documents link when 100 * intersection >=
    percent * union; ``component_id`` is the least id reachable by links. Null and empty texts have the empty
    set, link with nothing and are their own component; equal sets, repeated rows and ties link. Null ids
    are never the least. ``stays`` marks one row per component, or more if rows repeat id and text, and all
    rows with an empty set. Other columns are ignored; an empty table gives no rows.
    """
    members = stored(_members(documents, n), "jaccard-members")
    nodes = stored(members.filter("node is not null").groupBy("node").agg(
        F.max("n_shingles").alias("n"), F.min("doc_id").alias("first")), "jaccard-nodes")
    total = members.agg(F.sum("n_shingles").alias("n")).first()["n"] or 0
    buckets = max(1, math.ceil(total * min(1.0, 3 * (100 - percent) / (100 + percent)) * 1.5 / BUCKET_SIGNATURES))
    stars = stored(_candidates(documents, n, percent, buckets), "jaccard-stars")
    members_of = stars.select("signature", F.col("a").alias("node")).unionByName(
        stars.select("signature", F.col("b").alias("node"))).distinct()
    candidates = stored(nodes.join(members_of.select("node").distinct(), "node", "left_semi"), "jaccard-wanted")
    cuts = stored(_segments(documents, members, candidates, n, percent), "jaccard-segments")
    segments = cuts.filter("part >= 0")
    bitmaps = cuts.filter("part < 0").select("node", F.col("grams").alias("bits"))
    cores = _cores(candidates, segments, percent).withColumn("root", F.col("node"))
    live = stored(members_of.join(cores, "node").select("signature", "node", "n", "core", "root"), "jaccard-live")

    pairs = stored(_screened(_stars(live, _leaders(live), percent), bitmaps, percent), "jaccard-pairs")
    links = stored(_links(pairs, segments, percent), "jaccard-links")
    roots = stored(components(links), "jaccard-roots")
    left = stored(_unresolved(live, roots), "jaccard-unresolved")
    fresh = stored(_across(left, bitmaps, percent).join(pairs, ["a", "b"], "left_anti"), "jaccard-pairs")
    if not fresh.isEmpty():
        links = links.unionByName(_links(fresh, segments, percent))
        roots = stored(components(links), "jaccard-roots")

    rooted = nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    placed = stored(rooted.join(least, "root").select("node", "component_id", "root"), "jaccard-components")
    found = narrow_join(members, placed, ["node"], "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    found = found.select("doc_id", "mark", "n_shingles", "node", component.alias("component_id"), "root")
    keepers = found.filter("root is not null").groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "mark")).alias("keeper"))
    keepers = stored(keepers, "jaccard-keepers")
    found = narrow_join(found, keepers, ["root"], "left")
    stays = F.col("root").isNull() | (
        F.col("doc_id").eqNullSafe(F.col("keeper.doc_id")) & F.col("mark").eqNullSafe(F.col("keeper.mark")))
    return found.select("doc_id", "mark", "n_shingles", "node", "component_id", stays.alias("stays"))


def drop_near_duplicates(documents: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """The documents of which one per component is left, the one of least id, with all their columns."""
    decided = stored(near_duplicates(documents, n, percent), "jaccard-decided")
    keys: dict[str, Column] = {"doc_id": F.col("doc_id").cast("long"), "mark": F.xxhash64("text")}
    return without_rows(documents, decided.filter(~F.col("stays")).select(*keys).distinct(), keys)
