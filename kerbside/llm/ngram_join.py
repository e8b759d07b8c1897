"""Jaccard self-join of documents on word shingles, and the groups of documents it links.

Two documents link when their sets of distinct shingles have a Jaccard similarity of at least
`percent` / 100. Equal sets are one class first. Classes are dealt into size bands so that partners lie
in the same or the next band; a tile holds a band and the one above. Sets that link differ in few
elements, at most d in a tile, and each of these changes one hashed part: of any d + 1 parts one at
least is equal in both. There are about twice as many parts as that, and each class files a hash
of every one that is not empty under its tile.

A part that more than `CROWD` classes file is crowded, such as those that lie wholly inside a passage that many
documents share. Spark counts them, and each class leaves all but its d + 1 rarest parts: as all classes
rank parts alike, by how many file them, the rarest one that two linked classes share is left by neither.
So a passage makes candidates of its documents only where the rest of a document touches d parts or
fewer: of few where it is half of their shingles, of about half where it is two thirds, at a similarity
of 0.8. These meet in blocks.

Classes that share a part are tied to the smallest of them, their hub: linear in the number of parts.
Two classes that share a part have a hub in common, so it is enough to compare around hubs, and only
what is not yet joined, so that a group of near copies never becomes all its pairs:

1. Each class against its nearest (smallest) hub; links are joined to components.
2. Classes with the same nearest hub against each other, in blocks, if their components differ.
3. Around every hub, classes with different nearest hubs, if their components still differ.

A comparison first bounds the overlap: both sets are hashed to bitmap signatures, and every differing
bit is a shingle of one set only. Blocks meet as signatures first, a few per cent of the sets; only
rows with a possible partner are sent again, as sorted arrays, and decided by intersection.

Results: null, empty and white texts have the empty set, which links with nothing. A text of fewer
words than a shingle is one shingle. Rows without doc_id link with nothing and get no component. Rows
that share a doc_id are one document, which links where any of its texts does.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbside.llm.common import by_bucket, components, cut, id_text, let_go, mix, near, runs, shingles, slices, text_bytes, text_column, utf8
from kerbside.session import Scratch

#: Records that a task gathers before it packs them.
GATHERED = 250_000
#: Documents that may share a part before it is crowded.
CROWD = 16
#: Parts for each element in which linked sets may differ.
TIMES = 2
#: Text bytes for each bucket of records.
BUCKET_BYTES = 4 << 20
#: Members of a block in a comparison, and ids up to which a set of them is sent to all executors.
BLOCK = 256
#: Members of a block up to which its pairs are compared together with those of other blocks, and rows of
#: blocks that are dealt to one bucket.
SMALL = 48
BUCKET_ROWS = 8_000
BROADCAST_ROWS = 500_000

_BLOB = "bucket long, part binary, doc binary, spare binary, n binary, crowd_part binary, crowd_doc binary, crowd_spare binary"
_WHICH = np.uint64(1)
_SET = "doc_id long, n long, a long, b long, bits binary"
_ROW = ["hub", "i", "j", "side", "doc_id", "label", "kind"]


class Bands:
    """Size bands: band k ends at `ends[k]`, and a set of it links into band k or k + 1 only."""

    def __init__(self, percent: int, largest: int):
        ends = [1]
        while ends[-1] < largest:
            ends.append(max(ends[-1] + 1, ends[-1] * 100 // percent))
        ends.append(max(ends[-1] + 1, ends[-1] * 100 // percent))
        self.ends = np.array(ends, np.int64)
        total = self.ends[:-1] + self.ends[1:]
        #: Elements in which linked sets of a tile differ at most, and parts.
        self.differ = total * (100 - percent) // (100 + percent)
        self.parts = TIMES * self.differ + 2

    def of(self, sizes: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.ends, sizes)


def _digest(row: np.ndarray, hashed: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Size and two order-free sums of each set: equal sets have equal digests."""
    n = np.bincount(row, minlength=rows).astype(np.int64)
    a, b = np.zeros(rows, np.uint64), np.zeros(rows, np.uint64)
    filled = np.flatnonzero(n)
    if len(filled):
        first = np.cumsum(n)[filled] - n[filled]
        a[filled] = np.add.reduceat(mix(hashed + np.uint64(0x51ED)), first)
        b[filled] = np.add.reduceat(mix(hashed ^ np.uint64(0xA5A5F00DFACE)), first)
    return n, a.view(np.int64), b.view(np.int64)


def _width(n: np.ndarray) -> np.ndarray:
    """Bits of a signature: a power of two, two for each element at least, from 64 to 32,768. A longer
    set has a weaker bound, so more of its comparisons go on to the exact one."""
    return np.clip(2 ** np.ceil(np.log2(np.maximum(2 * n, 2))).astype(np.int64), 64, 1 << 15)


def _signatures(row: np.ndarray, hashed: np.ndarray, n: np.ndarray) -> list[bytes]:
    """A hashed bitmap of each set; one of half the width is its two halves laid over each other."""
    width = _width(n)
    base = np.cumsum(width) - width
    bits = np.zeros(int(width.sum()), np.uint8)
    bits[base[row] + ((hashed >> np.uint64(7)).astype(np.int64) & (width[row] - 1))] = 1
    packed = np.packbits(bits, bitorder="little")
    return [packed[b // 8 : (b + w) // 8].tobytes() for b, w in zip(base.tolist(), width.tolist(), strict=True)]


def _folded(signatures: list[bytes]) -> np.ndarray:
    """Signatures as words, all of the least width among them."""
    words = min(map(len, signatures)) // 8
    return np.stack([np.bitwise_or.reduce(np.frombuffer(s, np.uint64).reshape(-1, words), axis=0) for s in signatures])


def sets(documents: DataFrame, words: int) -> DataFrame:
    """(doc_id, n, a, b, bits) of every row: size, digest and signature of its shingle set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            row, hashed = shingles(*utf8(batch.column(1)), words)
            n, a, b = _digest(row, hashed, batch.num_rows)
            bits = pa.array(_signatures(row, hashed, n), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n), pa.array(a), pa.array(b), bits], ["doc_id", "n", "a", "b", "bits"])

    return id_text(documents).mapInArrow(run, _SET)


def _parts(row: np.ndarray, hashed: np.ndarray, sizes: np.ndarray, bands: Bands) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row, hash, spare) of every part of every set, in its own tile and in the tile below, which the lowest
    bit of the hash tells. `spare` is the number of parts that the set may leave there."""
    band = bands.of(sizes)
    for which, tile in enumerate((band, band - 1)):
        here = (tile >= 0) & (sizes > 0)
        here[here] = bands.differ[tile[here]] > 0  # else only equal sets link
        count = np.where(here, bands.parts[np.maximum(tile, 0)], 0)
        base = np.cumsum(count) - count
        use = here[row]
        r, h = row[use], hashed[use]
        if not len(r):
            continue
        part = ((h >> np.uint64(24)) % count[r].astype(np.uint64)).astype(np.int64)
        total = int(count.sum())
        filled = np.bincount(base[r] + part, minlength=total) > 0
        sums = np.zeros(total, np.uint64)
        np.add.at(sums, base[r] + part, mix(h + np.uint64(0xC0FFEE)))
        owner = np.repeat(np.arange(len(sizes)), count)
        within = np.arange(total) - base[owner]
        # Linked sets may share nothing but empty parts where all others can differ: these sets file all.
        some = np.bincount(owner[filled], minlength=len(sizes))
        spare = np.where(here, some - bands.differ[np.maximum(tile, 0)] - 1, 0)
        out = filled | (spare < 0)[owner]
        salt = mix((tile[owner[out]] * 1_000_003 + within[out]).astype(np.uint64))
        yield owner[out], mix(sums[out] + salt) & ~_WHICH | np.uint64(which), np.clip(spare, 0, 65535).astype(np.uint16)[owner[out]]


def _grouped(part: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The order by part, then document; in it, where parts begin, and of each entry the number of its part."""
    key = part & ~_WHICH
    order = np.lexsort((doc, key))
    first = runs(key[order])
    return order, np.flatnonzero(first), np.cumsum(first) - 1


def _pack(words: int, bands: Bands, buckets: int):
    def flush(gathered: list) -> Iterator[pa.RecordBatch]:
        part, doc, spare = (np.concatenate(x) for x in zip(*gathered, strict=True))
        order, begin, group = _grouped(part, doc)
        size = np.diff(np.append(begin, len(order)))
        crowded = (size > CROWD)[group]
        first = np.zeros(len(order), bool)
        first[begin] = True
        # Of a part that is crowded in this task alone, one entry goes to its bucket, with their number. The
        # others ride along with any bucket: no bucket gets all entries of a frequent part.
        n = np.ones(len(part), np.uint32)
        n[order[begin]] = np.where(size > CROWD, size, 1)
        kept, riding = np.sort(order[first | ~crowded]), order[crowded & ~first]
        bucket = ((part[kept] >> np.uint64(20)) % np.uint64(buckets)).astype(np.int64)
        rows = [(b, kept[at]) for b, at in by_bucket(bucket, buckets)]
        rides = np.array_split(riding, len(rows))
        columns = [
            pa.array([b for b, _ in rows], pa.int64()),
            pa.array([part[at].tobytes() for _, at in rows], pa.binary()),
            pa.array([np.diff(doc[at], prepend=0).tobytes() for _, at in rows], pa.binary()),
            *(pa.array([x[at].tobytes() for _, at in rows], pa.binary()) for x in (spare, n)),
            *(pa.array([x[at].tobytes() for at in rides], pa.binary()) for x in (part, doc, spare)),
        ]
        yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _BLOB.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered, size = [], 0
        known: set = set()
        for batch in slices(batches):
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            row, hashed = shingles(*utf8(batch.column(1)), words)
            n, a, b = _digest(row, hashed, batch.num_rows)
            # Copies within the gathered rows file nothing: they belong to the same class.
            new = np.zeros(batch.num_rows, bool)
            for k, key in enumerate(zip(n.tolist(), a.tolist(), b.tolist(), strict=True)):
                if key[0] and key not in known:
                    known.add(key)
                    new[k] = True
            use = new[row]
            for owner, hashes, spare in _parts(row[use], hashed[use], np.where(new, n, 0), bands):
                gathered.append((hashes, ids[owner], spare))
                size += len(hashes)
            if size >= GATHERED:
                yield from flush(gathered)
                gathered, size = [], 0
                known.clear()
                let_go()
        if size:
            yield from flush(gathered)

    return run


_TIE, _ENTRY, _TOTAL = 0, 1, 2


def _meet(table: pa.Table) -> pa.Table:
    """Of a bucket: documents that share a part tied to the smallest; or, where it is crowded, its entries
    (part, document, spare) and their number."""
    let_go()
    gathered = lambda c, kind: np.frombuffer(b"".join(table.column(c).to_pylist()), kind)
    part, spare, n = gathered("part", np.uint64), gathered("spare", np.uint16), gathered("n", np.uint32)
    doc = np.concatenate([np.cumsum(np.frombuffer(b, np.int64)) for b in table.column("doc").to_pylist()])
    order, begin, group = _grouped(part, doc)
    total = np.add.reduceat(n[order].astype(np.int64), begin)
    hub, member = doc[order][begin][group], doc[order]
    crowded = (total > CROWD)[group]
    ties = np.unique(np.stack([hub, member], axis=1)[~crowded & (hub != member)], axis=0)
    entries = order[crowded]
    busy = begin[total > CROWD]
    columns = [
        (_TIE, ties[:, 0], ties[:, 1], np.zeros(len(ties))),
        (_ENTRY, part[entries].view(np.int64), doc[entries], spare[entries]),
        (_ENTRY, gathered("crowd_part", np.int64), gathered("crowd_doc", np.int64), gathered("crowd_spare", np.uint16)),
        (_TOTAL, (part[order[busy]] & ~_WHICH).view(np.int64), total[total > CROWD], np.zeros(len(busy))),
    ]
    kinds = np.concatenate([np.full(len(a), kind, np.int32) for kind, a, _, _ in columns])
    a, b, c = (np.concatenate([x[k] for x in columns]) for k in (1, 2, 3))
    return pa.table({"kind": kinds, "a": a, "b": b, "spare": c.astype(np.int32)})


def candidates(documents: DataFrame, words: int, bands: Bands, buckets: int, several: DataFrame, scratch: Scratch) -> DataFrame:
    """(hub, member) of distinct documents: any two that share a part which neither leaves have a hub in
    common or are one. Documents in `several` (doc_id) have several sets and leave nothing."""
    packed = documents.mapInArrow(_pack(words, bands, buckets), _BLOB)
    met = scratch.cut(packed.groupBy("bucket").applyInArrow(_meet, "kind int, a long, b long, spare int"), "kind")
    few = met.filter(F.col("kind") == _TIE).select(F.col("a").alias("hub"), F.col("b").alias("member"))
    totals = met.filter(F.col("kind") == _TOTAL).select(F.col("a").alias("part"), F.col("b").alias("total"))
    part = F.col("a").bitwiseAND(F.lit(-2))
    entries = met.filter(F.col("kind") == _ENTRY).select(part.alias("part"), F.col("b").alias("doc_id"), (F.col("a") % 2 != 0).alias("below"), "spare")
    ranked = entries.join(totals, "part").join(near(several.withColumn("several", F.lit(True)), BROADCAST_ROWS), "doc_id", "left")
    place = F.row_number().over(Window.partitionBy("doc_id", "below").orderBy(F.desc("total"), "part"))
    left = ranked.withColumn("place", place).filter("several OR place > spare")
    left = scratch.cut(left.select("part", "doc_id").distinct())
    hubs = left.groupBy("part").agg(F.min("doc_id").alias("hub"))
    crowded = left.join(hubs, "part").select("hub", F.col("doc_id").alias("member"))
    return few.unionByName(crowded).filter("hub <> member").distinct()


def _may_link(sizes: np.ndarray, maps: np.ndarray, labels: np.ndarray, kinds: np.ndarray, i: int, right: np.ndarray, percent: int) -> np.ndarray:
    """The rows of `right` that row i may link with: of another label (component) and kind, of a size
    that allows it, and with signatures that differ in few enough bits. Each of those stands for an
    element that only one of the sets has, so the overlap is (total - bits) / 2 at most."""
    others = right[(labels[right] != labels[i]) & (kinds[right] != kinds[i]) & (sizes[right] * 100 >= percent * sizes[i]) & (sizes[i] * 100 >= percent * sizes[right])]
    differ = np.bitwise_count(maps[others] ^ maps[i]).sum(axis=1, dtype=np.int64)
    total = sizes[others] + sizes[i]
    # A link needs overlap * (100 + percent) >= percent * total.
    return others[(total - differ) * (100 + percent) >= 2 * percent * total]


def _sides(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the two sides of a block; a block with one side meets itself."""
    side = table.column("side").to_numpy()
    left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    return left, right if len(right) else left


def _small(table: pa.Table, begin: np.ndarray, size: np.ndarray, percent: int) -> np.ndarray:
    """Of rows in small blocks (`begin`, `size`; rows of side 0 first): those that may link, by all pairs at once."""
    labels, kinds, sizes, side = (table.column(c).to_numpy() for c in ("label", "kind", "n", "side"))
    alive = np.zeros(table.num_rows, bool)
    ones = np.concatenate([[0], np.cumsum(side)])
    right = ones[begin + size] - ones[begin]
    left = size - right
    # Every row of side 0 against the rows of side 1, or against those behind it if there are none.
    block = np.repeat(np.arange(len(begin)), left)
    first = begin[block] + np.arange(len(block)) - np.repeat(np.cumsum(left) - left, left)
    end = begin[block] + size[block]
    start = np.where(right[block] > 0, end - right[block], first + 1)
    count = end - start
    a = np.repeat(first, count)
    b = np.repeat(start, count) + np.arange(len(a)) - np.repeat(np.cumsum(count) - count, count)
    fits = (labels[a] != labels[b]) & (kinds[a] != kinds[b])
    fits &= (sizes[a] * 100 >= percent * sizes[b]) & (sizes[b] * 100 >= percent * sizes[a])
    a, b = a[fits], b[fits]
    rows = np.unique(np.concatenate([a, b]))
    signatures = table.column("bits").take(pa.array(rows)).to_pylist()
    width = np.zeros(table.num_rows, np.int64)
    width[rows] = [len(s) for s in signatures]
    narrow = np.minimum(width[a], width[b])
    for w in np.unique(narrow):
        here = np.flatnonzero(narrow == w)
        used = np.unique(np.concatenate([a[here], b[here]]))
        place = np.searchsorted(rows, used)
        maps = np.stack([np.bitwise_or.reduce(np.frombuffer(signatures[k], np.uint64).reshape(-1, w // 8), axis=0) for k in place])
        for part in np.array_split(here, -(-len(here) * int(w) // (16 << 20))):
            x, y = a[part], b[part]
            differ = np.bitwise_count(maps[np.searchsorted(used, x)] ^ maps[np.searchsorted(used, y)]).sum(axis=1, dtype=np.int64)
            near = (sizes[x] + sizes[y] - differ) * (100 + percent) >= 2 * percent * (sizes[x] + sizes[y])
            alive[x[near]] = alive[y[near]] = True
    return alive


def _bounded(percent: int):
    """The rows of each block that may link with any other one, by their signatures; a table has many blocks."""

    def run(table: pa.Table) -> pa.Table:
        let_go()
        table = table.sort_by([(c, "ascending") for c in ("hub", "i", "j", "side")])
        begin = np.flatnonzero(runs(*(table.column(c).to_numpy() for c in ("hub", "i", "j"))))
        size = np.diff(np.append(begin, table.num_rows))
        small = size <= SMALL
        alive = _small(table, begin[small], size[small], percent)
        for at, n in zip(begin[~small].tolist(), size[~small].tolist(), strict=True):
            block = table.slice(at, n)
            labels, kinds, sizes = (block.column(c).to_numpy() for c in ("label", "kind", "n"))
            maps = _folded(block.column("bits").to_pylist())
            left, right = _sides(block)
            for i in left:
                partners = _may_link(sizes, maps, labels, kinds, i, right, percent)
                alive[at + partners] = True
                alive[at + i] |= len(partners) > 0
        return table.select(_ROW).filter(pa.array(alive))

    return run


def _exact(percent: int):
    """Links in a block, as few as join the components that they link."""

    def run(table: pa.Table) -> pa.Table:
        ids, labels, kinds = (table.column(c).to_numpy() for c in ("doc_id", "label", "kind"))
        arrays = [np.frombuffer(x, np.uint64) for x in table.column("hashed").to_pylist()]
        sizes = np.array([len(a) for a in arrays])
        row = np.repeat(np.arange(len(arrays)), sizes)
        maps = _folded(_signatures(row, np.concatenate(arrays), np.full(len(arrays), 4 * sizes.max())))
        left, right = _sides(table)
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while parent.get(x, x) != x:
                x = parent[x]
            return x

        links = []
        for i in left:
            for j in _may_link(sizes, maps, labels, kinds, i, right, percent):
                a, b = root(int(labels[i])), root(int(labels[j]))
                if a == b:
                    continue
                overlap = len(np.intersect1d(arrays[i], arrays[j], assume_unique=True))
                if overlap * (100 + percent) >= percent * (sizes[i] + sizes[j]):
                    parent[max(a, b)] = min(a, b)
                    links.append((int(ids[i]), int(ids[j])))
        return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([y for _, y in links], pa.int64())})

    return run


def _send(words: int):
    """Rows of a block: every text joined with the blocks it goes to, as its sorted shingle hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            row, hashed = shingles(*utf8(batch.column("text")), words)
            edges = np.searchsorted(row, np.arange(batch.num_rows + 1))
            sets_ = pa.array([hashed[edges[k] : edges[k + 1]].tobytes() for k in range(batch.num_rows)], pa.binary())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in _ROW), sets_], [*_ROW, "hashed"])

    return run


def _links(documents: DataFrame, members: DataFrame, blocks: DataFrame, words: int, percent: int, scratch: Scratch) -> DataFrame:
    """(a, b): links found in the blocks (hub, i, j, side, doc_id, label, kind).

    Signatures come first: they are a fraction of the sets, and rows without a possible partner in
    their block go no further. Only what is left is joined with its text and compared exactly.
    """
    key = ["hub", "i", "j"]
    kinds = "hub long, i long, j long, side int, doc_id long, label long, kind long"
    blocks = scratch.cut(blocks)
    buckets = max(int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-blocks.count() // BUCKET_ROWS))
    dealt = blocks.withColumn("bucket", F.pmod(F.xxhash64(*key), F.lit(buckets)))
    signed = dealt.join(members.filter("n > 0").select("doc_id", "n", "bits"), "doc_id").select("bucket", *_ROW, "n", "bits")
    # Only ids are broadcast; texts that take part are shuffled to their blocks.
    left = scratch.cut(signed.groupBy("bucket").applyInArrow(_bounded(percent), kinds).distinct())
    texts = documents.join(near(scratch.cut(left.select("doc_id").distinct()), BROADCAST_ROWS), "doc_id", "left_semi")
    sent = texts.join(left, "doc_id").select(*_ROW, "text")
    return scratch.cut(sent.mapInArrow(_send(words), f"{kinds}, hashed binary").groupBy(*key).applyInArrow(_exact(percent), "a long, b long"))


def _blocks(around: DataFrame, compared: DataFrame, scratch: Scratch) -> DataFrame:
    """Blocks in which members of a hub meet all others of another kind, if they have several labels:
    those not of the most frequent kind are dealt to blocks against that kind and among themselves.
    A hub with one member needs none if the two are in `compared` (hub, member)."""
    per = around.groupBy("hub", "kind").agg(F.count("*").alias("rows"), F.min("label").alias("low"), F.max("label").alias("high"))
    most = F.max(F.struct("rows", "kind")).alias("most")
    hubs = per.groupBy("hub").agg(F.count("*").alias("kinds"), F.sum("rows").alias("rows"), most, F.min("low").alias("low"), F.max("high").alias("high"))
    hubs = hubs.filter("kinds > 1 AND low < high")
    single = compared.groupBy("hub").agg(F.count("*").alias("known")).filter("known = 1")
    hubs = hubs.join(single, "hub", "left").filter("NOT (rows = 2 AND known IS NOT NULL)")
    hubs = scratch.cut(hubs.select("hub", F.col("most.kind").alias("main"), F.col("most.rows").alias("inside"), (F.col("rows") - F.col("most.rows")).alias("outside")))
    rest = around.select("hub", "member", "label", "kind").join(hubs, "hub")
    blocks_in, blocks_out = (F.ceil(F.col(c) / BLOCK) for c in ("inside", "outside"))
    row = ["member", "label", "kind"]
    inside = rest.filter("kind = main").select("hub", F.explode(F.sequence(_zero(), blocks_out - 1)).alias("i"), _spread("member", "inside").alias("j"), F.lit(1).alias("side"), *row)
    outside = rest.filter("kind <> main").withColumn("own", _spread("member", "outside"))
    against = outside.select("hub", F.col("own").alias("i"), F.explode(F.sequence(_zero(), blocks_in - 1)).alias("j"), F.lit(0).alias("side"), *row)
    # Blocks of the others among themselves: pairs i <= j, numbered below zero.
    among = outside.select("hub", "own", F.explode(F.sequence(_zero(), blocks_out - 1)).alias("other"), *row).select(
        "hub", F.least("own", "other").alias("i"), (-1 - F.greatest("own", "other")).alias("j"), (F.col("own") > F.col("other")).cast("int").alias("side"), *row
    )
    return inside.unionByName(against).unionByName(among).withColumnRenamed("member", "doc_id")


def _zero() -> Column:
    return F.lit(0).cast("long")


def _spread(column: str, count: str) -> Column:
    """One of as many blocks as `count` members need."""
    return F.pmod(F.xxhash64(column), F.ceil(F.col(count) / BLOCK))


def linked(documents: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row."""
    texts = id_text(documents)
    with Scratch(documents.sparkSession) as scratch:
        members = scratch.cut(sets(documents, words))
        joined = _components(texts, members, words, percent, scratch)
        return cut(
            members.join(joined.withColumnRenamed("id", "doc_id"), "doc_id", "left").select(
                "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id")
            )
        )


def _components(texts: DataFrame, members: DataFrame, words: int, percent: int, scratch: Scratch) -> DataFrame:
    """(id, component) of all documents with a link."""
    spark = texts.sparkSession
    filled = members.filter("n > 0 AND doc_id IS NOT NULL")
    largest = filled.agg(F.max("n")).first()[0]
    if largest is None:
        return spark.createDataFrame([], "id long, component long")
    buckets = max(2 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-text_bytes(texts) // BUCKET_BYTES))

    # Classes of equal sets, in two steps: first within a share of the rows, as one may be very frequent.
    key = ["n", "a", "b"]
    shared = filled.withColumn("share", F.pmod(F.xxhash64("doc_id"), F.lit(64)))
    some = scratch.cut(shared.groupBy(*key, "share").agg(F.min("doc_id").alias("some"), F.count("*").alias("rows")))
    every = scratch.cut(some.groupBy(*key).agg(F.min("some").alias("class"), F.sum("rows").alias("rows")).filter("rows > 1"))
    same = some.join(every.select(*key, "class"), key)
    copies = shared.join(same.select(*key, "share", "class"), [*key, "share"]).filter("doc_id <> class")
    copies = scratch.cut(copies.select(F.col("doc_id").alias("id"), "class").distinct())

    # One row of each class files its parts. (A doc_id with several texts may stand for several classes.)
    spare = copies.groupBy("id").agg(F.count("*").alias("classes")).filter("classes = 1").select(F.col("id").alias("doc_id"))
    several = scratch.cut(filled.groupBy("doc_id").agg(F.count_distinct(*key).alias("texts")).filter("texts > 1").select("doc_id"))
    spare = scratch.cut(spare.join(several, "doc_id", "left_anti"))
    filing = texts.filter(F.col("doc_id").isNotNull()).join(near(spare, BROADCAST_ROWS), "doc_id", "left_anti")
    ties = scratch.cut(candidates(filing, words, Bands(percent, largest), buckets, several, scratch))

    # First round: every class against the smallest it met.
    nearest = scratch.cut(ties.groupBy("member").agg(F.min("hub").alias("hub")))
    crowded = nearest.groupBy("hub").agg(F.count("*").alias("rows")).filter(F.col("rows") > BLOCK)
    placed = nearest.join(crowded, "hub", "left").withColumn("i", F.coalesce(_spread("member", "rows"), F.lit(0)).cast("long"))
    first = placed.select("hub", "i", _zero().alias("j"), F.lit(1).alias("side"), F.col("member").alias("doc_id"), F.col("member").alias("label"), F.col("member").alias("kind"))
    hubs = placed.select("hub", "i").distinct()
    first = first.unionByName(hubs.select("hub", "i", _zero().alias("j"), F.lit(0).alias("side"), F.col("hub").alias("doc_id"), F.col("hub").alias("label"), F.col("hub").alias("kind")))
    edges = copies.select(F.col("id").alias("a"), F.col("class").alias("b")).unionByName(_links(texts, members, first, words, percent, scratch))
    joined = components(edges)

    # Component and nearest hub of each class; one without an entry is its own.
    known = joined.select(F.col("id").alias("member"), "component").join(nearest, "member", "full")
    known = scratch.cut(known.select("member", F.coalesce("component", "member").alias("label"), F.coalesce("hub", "member").alias("kind")))

    def marked(meetings: DataFrame) -> DataFrame:
        """(hub, member, label, kind) of the members of every hub, itself included."""
        every = meetings.select("hub", "member").unionByName(meetings.select("hub", F.col("hub").alias("member")).distinct())
        return every.join(known, "member", "left").select("hub", "member", F.coalesce("label", "member").alias("label"), F.coalesce("kind", "member").alias("kind"))

    # Second round: all classes with the same nearest one, against each other.
    around = scratch.cut(marked(nearest).withColumn("kind", F.col("label")))
    second = _links(texts, members, _blocks(around, nearest, scratch), words, percent, scratch)

    # Third round: around each hub, classes with different nearest ones. What the second round has joined
    # was of the same nearest one, so the components need not be brought up to date in between.
    around = scratch.cut(marked(ties))
    third = _links(texts, members, _blocks(around, nearest, scratch), words, percent, scratch)
    edges = joined.select(F.col("id").alias("a"), F.col("component").alias("b")).unionByName(second).unionByName(third)
    return components(edges)


def without_copies(documents: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The rows but for those linked to one with a smaller doc_id. Rows that share a doc_id but not their
    text are documents of their own, by a hash of the text the smaller of two that link; of rows that
    share both one stays, the smallest in its other columns. Rows without doc_id all stay."""
    rows, ids = documents.agg(F.count("doc_id"), F.count_distinct("doc_id")).first()
    if ids == rows:
        dropped = cut(linked(documents, words, percent).filter("component_id <> doc_id").select("doc_id"))
        return documents.join(near(dropped, BROADCAST_ROWS), "doc_id", "left_anti").select(*documents.columns)

    # Numbers in the order of doc_id and hash stand for the documents.
    key, number = (max(documents.columns, key=len) + end for end in ("_key", "_number"))
    hashed = documents.withColumn(key, F.xxhash64(text_column()))
    parts = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    named = hashed.filter("doc_id IS NOT NULL").select("doc_id", key).distinct()
    named = named.repartitionByRange(parts, "doc_id", key).sortWithinPartitions("doc_id", key)
    named = cut(named.withColumn(number, F.monotonically_increasing_id()))
    found = linked(hashed.select("doc_id", key, "text").join(named, ["doc_id", key]).select(F.col(number).alias("doc_id"), "text"), words, percent)
    dropped = found.filter("component_id <> doc_id").select(F.col("doc_id").alias(number)).distinct()
    dropped = cut(named.join(dropped, number).select("doc_id", key))
    kept = hashed.join(near(dropped, BROADCAST_ROWS), ["doc_id", key], "left_anti")
    row = F.min(F.struct(*(f"`{c}`" for c in documents.columns))).alias(number)
    one = kept.filter("doc_id IS NOT NULL").groupBy("doc_id", key).agg(row)
    return one.select(*(F.col(f"{number}.`{c}`") for c in documents.columns)).unionByName(kept.filter("doc_id IS NULL").select(*documents.columns))
