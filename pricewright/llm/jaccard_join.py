"""Exact n-gram Jaccard self-join: size-banded tiles, hashed bitmap signatures, sorted-array intersection.

Two sets of similarity t or more share a token among the first ``n - ceil(t n) + 1`` of each, under
any order of all tokens (prefix filter). The order puts tokens that fill their slot of a corpus-wide
counting sketch far above the mean last, so passages that many documents share seldom are prefixes.

Documents that share a prefix token meet in tiles: a crowded token's documents in those of neighbouring
size bands, dealt out in blocks. In a first look at a tile, sizes, places and bitmap signatures (which
differ in no more bits than two sets in tokens) settle nearly all pairs; only the documents of the
others come back, with their sorted arrays, and are intersected exactly within the tile. No pair ever
leaves a task: a tile tells a forest of its links, and of each document how many it has. A pair is
counted only in the tile of the first token that it shares.

Equal sets are one class from the start. If links are not to be counted, groups of near copies are
first joined by stars (each document with just the least one of a token), and documents of one
component are passed over.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import windows as W
from .common import BROADCAST_ROWS, Scratch, columns, partitions, private, read, sliced, text_keys, trim, without, written
from .components import components
from .shingles import shingle_set

#: Least and most slots of the counting sketch (powers of two; there is one for each eight to sixteen tokens), those of one shuffled block, and blocks summed by one task.
LEAST_SLOTS, MOST_SLOTS, BLOCK, SUMMED = 1 << 18, 1 << 24, 1 << 15, 256
#: Rounds of stars at most, and the mean number of partners of an entry from which another round pays; what stars leave apart meets in tiles.
ROUNDS, CROWDED = 3, 64
#: Bits of a signature, and those of it that first tiles hold (its first half folded onto the second).
BITS, TILE_BITS = 2048, 1024
#: Documents of a block of a token, their tokens, and entries of a tile; a token of more documents than BANDED is parted by size bands.
TILE, TILE_TOKENS, TILE_ROWS, BANDED = 512, 1 << 20, 1024, 64
#: Prefix entries of one group of the shuffle, and bytes of sets of one task.
GROUP, TASK_BYTES = 250_000, 64 << 20


def _texts(column) -> Iterator[bytes]:
    for x in column:
        yield (x.as_buffer().to_pybytes() if x.is_valid else b"")


def _signature(tokens: np.ndarray) -> np.ndarray:
    """Parity bitmap: each token flips one bit, so two bitmaps differ in no more bits than the sets in tokens."""
    bits = np.bincount((W.mix(tokens) % np.uint64(BITS)).astype(np.int64), minlength=BITS) & 1
    return np.packbits(bits.astype(np.uint8), bitorder="little").view(np.int64)


def _name(tokens: np.ndarray) -> tuple[int, int]:
    """Two 64-bit hashes of a set; the first also serves as the id of its class."""
    return tuple(np.frombuffer(xxhash.xxh3_128_digest(tokens.tobytes()), np.int64).tolist())


def _packed(part: np.ndarray, at: np.ndarray) -> bytes:
    """A block's counts: a bitmap of the slots in use and the count of each, compressed to a bit or two for a slot in use."""
    kind = np.uint8 if part.max() < 256 else np.int64
    return zlib.compress(np.packbits(part > 0).tobytes() + part[at].astype(kind).tobytes(), 1)


def _unpacked(packed) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(zlib.decompress(packed), np.uint8)
    at, rest = np.flatnonzero(np.unpackbits(raw[: BLOCK // 8])), raw[BLOCK // 8 :]
    return at, rest if len(rest) == len(at) else rest.view(np.int64)


def _describe(words: int, slots: int):
    """One row per document, and the sketch's counts of the whole task."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(slots, np.int32)
        names = ["k1", "k2", "n", "c1", "c2", "bits", "block", "counts"]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.int32(), pa.binary()]
        for batch in sliced(batches, 2):
            n, c1, c2, bits = [], [], [], []
            for text in _texts(batch.column(2)):
                tokens = shingle_set(text, words)
                np.add.at(counts, (tokens & np.uint64(slots - 1)).astype(np.int64), 1)
                name = _name(tokens)
                n.append(len(tokens))
                c1.append(name[0])
                c2.append(name[1])
                bits.append(_signature(tokens))
            size = len(n)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, kinds[2]), pa.array(c1, kinds[3]), pa.array(c2, kinds[4]), pa.array(bits, kinds[5]), pa.nulls(size, kinds[6]), pa.nulls(size, kinds[7])], names=names)
        for block in range(slots // BLOCK):
            part = counts[block * BLOCK : (block + 1) * BLOCK]
            at = np.flatnonzero(part)
            if len(at):
                packed = _packed(part, at)
                yield pa.RecordBatch.from_arrays([*(pa.nulls(1, k) for k in kinds[:6]), pa.array([block], kinds[6]), pa.array([packed], kinds[7])], names=names)
        trim()

    return step


DESCRIBED = "k1 long, k2 long, n long, c1 long, c2 long, bits array<long>, block int, counts binary"


def _heavy_slots(scratch: Scratch, sketch: DataFrame, slots: int) -> bytes:
    """Packed bitmap of the slots that hold far more than the mean; MOST_SLOTS / 8 bytes at most, whatever the input.

    Blocks of map tasks are summed as they stream in, first SUMMED or so at a time, so no task holds or reads many.
    """

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, block = np.zeros(BLOCK, np.int64), None
        for batch in batches:
            block = batch.column("block")[0].as_py()
            for x in batch.column("counts"):
                at, part = _unpacked(x.as_buffer())
                counts[at] += part
        yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([_packed(counts, np.flatnonzero(counts))], pa.binary())], names=["block", "counts"])

    slices = max(1, sketch.count() * BLOCK // slots // SUMMED)
    sliced_ = sketch.withColumn("slice", F.pmod(F.xxhash64("counts"), F.lit(slices)))
    summed = sliced_.groupBy("block", "slice").applyInArrow(total, "block int, counts binary") if slices > 1 else sketch
    summed = scratch.written(summed.groupBy("block").applyInArrow(total, "block int, counts binary"), "sketch")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([int(_unpacked(x.as_buffer())[1].sum(dtype=np.int64)) for x in b.column(1)], pa.int64())], names=["n"])

    mean = (summed.mapInArrow(each, "n long").agg(F.sum("n")).first()[0] or 0) / slots
    least = mean + 6 * mean**0.5 + 16

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for x in b.column(1):
                at, part = _unpacked(x.as_buffer())
                bits = np.zeros(BLOCK, bool)
                bits[at] = part >= least
                out.append(np.packbits(bits, bitorder="little").tobytes())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary())], names=["block", "bits"])

    out = bytearray(slots // 8)
    for row in summed.mapInArrow(mark, "block int, bits binary").collect():
        out[row.block * BLOCK // 8 : (row.block + 1) * BLOCK // 8] = row.bits
    return bytes(out)


def _heavy(tokens: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """1 for each token in a marked slot."""
    slot = (tokens & np.uint64(8 * len(marks) - 1)).astype(np.int64)
    return (marks[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1


def _prefixes(words: int, percent: int, heavy: bytes, buckets: int):
    """Prefix tokens, packed by bucket; entries of heavy tokens are dealt out evenly, marked by ``hot``."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = np.frombuffer(heavy, np.uint8)
        for batch in sliced(batches, 0):
            seen, tokens, ids, sizes, places, hot = set(), [], [], [], [], []
            for text in _texts(batch.column(0)):
                t = shingle_set(text, words)
                if not len(t) or (c := _name(t)[0]) in seen:
                    continue
                seen.add(c)
                p = len(t) - -(-percent * len(t) // 100) + 1
                h = _heavy(t, marks)
                first = np.argsort(h, kind="stable")[:p]
                tokens.append(t[first])
                hot.append(h[first])
                ids.append(np.full(len(first), c, np.int64))
                sizes.append(np.full(len(first), len(t), np.int32))
                places.append(np.arange(len(first), dtype=np.int32))
            if not tokens:
                continue
            token, i, n, pos, h = (np.concatenate(x) for x in (tokens, ids, sizes, places, hot))
            spread = np.where(h == 1, W.mix(token ^ i.view(np.uint64)), token >> np.uint64(1))
            bucket = (spread % np.uint64(buckets)).astype(np.int32) * 2 + h
            order = np.argsort(bucket, kind="stable")
            bucket = bucket[order]
            cut = np.append(np.flatnonzero(np.diff(bucket, prepend=-1)), len(bucket))
            rows = [(int(bucket[a]) // 2, bool(bucket[a] & 1), token[o].tobytes(), i[o].tobytes(), n[o].tobytes(), pos[o].tobytes()) for a, b in zip(cut[:-1], cut[1:]) for o in (order[a:b],)]
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), (pa.int32(), pa.bool_(), pa.binary(), pa.binary(), pa.binary(), pa.binary()))], names=["bucket", "hot", "token", "id", "n", "pos"])
        trim()

    return step


def _meeting(table: pa.Table) -> pa.Table:
    """Entries of tokens that two documents or more have in their prefixes."""
    flag = np.concatenate([np.full(len(t.as_buffer()) // 8, h.as_py()) for t, h in zip(table["token"], table["hot"])])
    # equal entries come from copies in several batches
    token, i = (np.concatenate([np.frombuffer(x.as_buffer(), np.int64) for x in table[c]]) for c in ("token", "id"))
    n, pos = (np.concatenate([np.frombuffer(x.as_buffer(), np.int32) for x in table[c]]) for c in ("n", "pos"))
    order = np.lexsort((i, token))
    order = order[np.concatenate(([True], (np.diff(token[order]) != 0) | (np.diff(i[order]) != 0)))]
    t = token[order]
    new = np.concatenate(([True], t[1:] != t[:-1]))
    group = np.cumsum(new) - 1
    keep = order[(np.bincount(group) > 1)[group] | flag[order]]
    trim()
    return pa.table({"token": pa.array(token[keep]), "id": pa.array(i[keep]), "n": pa.array(n[keep]), "pos": pa.array(pos[keep])})


OPEN = "tile long, side int, home boolean, id long, root long, n int, tokens binary"


def _open_in_tiles(percent: int):
    """The documents of a tile that sizes, places and bitmaps leave in some pair, each with its tokens of such pairs.

    Side 0 meets side 1, side 2 meets itself. A pair of different size bands meets in the greater one's
    tile, one of the same band in its own: one of the two is at home there.
    """

    def step(table: pa.Table) -> pa.Table:
        tile, token, i, n, pos, root, side, home = (table[c].to_numpy() for c in ("tile", "token", "id", "n", "pos", "root", "side", "home"))
        bits = table["bits"].combine_chunks().flatten().to_numpy().view(np.uint64).reshape(len(i), -1)
        left_open = np.zeros(len(i), bool)
        order = np.lexsort((n, token, tile))
        same = (np.diff(token[order]) == 0) & (np.diff(tile[order]) == 0)
        cut = np.concatenate(([0], np.flatnonzero(~same) + 1, [len(order)])) if len(order) else np.zeros(1, int)
        for a, b in zip(cut[:-1], cut[1:]):
            o = order[a:b]
            one = side[o[0]] == 2
            left, right = (o, o) if one else (o[side[o] == 0], o[side[o] == 1])
            for lo in range(0, len(left), 256):
                l = left[lo : lo + 256]
                small, large = np.minimum(n[l][:, None], n[right][None, :]).astype(np.int64), np.maximum(n[l][:, None], n[right][None, :])
                # were this the first token they share, no more could follow it than stand behind it in both
                behind = np.minimum((n[l] - pos[l])[:, None], (n[right] - pos[right])[None, :])
                can = (root[l][:, None] != root[right][None, :]) & (100 * small >= percent * large) & ((100 + percent) * behind >= percent * (small + large)) & (home[l][:, None] | home[right][None, :])
                if one:
                    can &= i[l][:, None] < i[right][None, :]
                p, q = np.nonzero(can)
                for at in range(0, len(p), 1 << 16):
                    u, v = l[p[at : at + (1 << 16)]], right[q[at : at + (1 << 16)]]
                    differ = np.bitwise_count(bits[u] ^ bits[v]).sum(axis=1, dtype=np.int64)
                    ok = _room(n[u], n[v], differ, percent)
                    left_open[u[ok]] = left_open[v[ok]] = True
        o = np.flatnonzero(left_open)
        o = o[np.lexsort((token[o], i[o], tile[o]))]
        new = np.concatenate(([True], (np.diff(tile[o]) != 0) | (np.diff(i[o]) != 0))) if len(o) else np.zeros(0, bool)
        at = np.flatnonzero(new)
        first, data = o[at], token[o]
        tokens = [data[x:y].tobytes() for x, y in zip(at, [*at[1:], len(o)])]
        trim()
        return pa.table([pa.array(x[first]) for x in (tile, side, home, i, root, n)] + [pa.array(tokens, pa.binary())], names=["tile", "side", "home", "id", "root", "n", "tokens"])

    return step


def _room(n, m, differ, percent: int):
    """Whether sets of these sizes can link if they differ in ``differ`` tokens or more."""
    total = n.astype(np.int64) + m
    most = (total - differ) // 2
    return 100 * most >= percent * (total - most)


WHOLE = "tile long, side int, home boolean, id long, root long, copies long, tokens binary, set binary"


def _sets_to_tiles(words: int, heavy: bytes):
    """The set of each text, in the order of prefixes, for each tile that asks for it."""
    names = [x.split()[0] for x in WHOLE.split(", ")]
    kinds = [{"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary()}[x.split()[1]] for x in WHOLE.split(", ")]

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, marks, rows, size = None, np.frombuffer(heavy, np.uint8), [], 0
        for batch in sliced(batches, "text"):
            ids, tiles = batch.column("id").to_pylist(), batch.column("tiles")
            for c, text, asked in zip(ids, _texts(batch.column("text")), tiles):
                if c == before:  # copies stand one below the other
                    continue
                before, t = c, shingle_set(text, words)
                data = t[np.argsort(_heavy(t, marks), kind="stable")].tobytes()
                for x in asked.as_py():
                    rows.append((x["tile"], x["side"], x["home"], c, x["root"], x["copies"], x["tokens"], data))
                    size += len(data)
                    if size > 8 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*rows), kinds)], names=names)
                        rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*rows), kinds)], names=names)
        trim()

    return step


SETTLED = "a long, b long, n long"


def _links_in_tiles(percent: int, heavy: bytes, count: bool):
    """Rows of one tile stand together; of each: a forest (a, b) of its links, and if asked (a, null, documents that link with a)."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks, held = np.frombuffer(heavy, np.uint8), []
        for batch in batches:
            tile = batch.column("tile").to_numpy()
            cut = np.concatenate(([0], np.flatnonzero(np.diff(tile)) + 1, [len(tile)])) if len(tile) else [0]
            for a, b in zip(cut[:-1], cut[1:]):
                if held and held[0].column("tile")[0].as_py() != tile[a]:
                    yield _settled(pa.Table.from_batches(held), percent, marks, count)
                    held = []
                held.append(batch.slice(a, b - a))
        if held:
            yield _settled(pa.Table.from_batches(held), percent, marks, count)
        trim()

    return step


def _settled(table: pa.Table, percent: int, marks: np.ndarray, count: bool) -> pa.RecordBatch:
    ids, at = np.unique(table["id"].to_numpy(), return_index=True)  # a set may come twice, from copies that two tasks met
    side, home, copies = (table[c].to_numpy(zero_copy_only=False)[at] for c in ("side", "home", "copies"))
    label = np.unique(table["root"].to_numpy()[at], return_inverse=True)[1]
    sets, tokens = ([np.frombuffer(table[c][int(k)].as_buffer(), np.uint64) for k in at] for c in ("set", "tokens"))
    n = np.array([len(x) for x in sets])
    bits = np.array([_signature(x) for x in sets]).view(np.uint64)
    order = np.argsort(n, kind="stable")
    one = side[0] == 2
    left = order if one else order[side[order] == 0]
    links, forest = np.zeros(len(ids), np.int64), []
    for rank, u in enumerate(left):
        v = order[rank + 1 :] if one else order[side[order] == 1]
        v = v[((label[v] != label[u]) | count) & (home[v] | home[u]) & (100 * np.minimum(n[u], n[v]) >= percent * np.maximum(n[u], n[v]))]
        if len(v):
            v = v[_room(n[v], n[u], np.bitwise_count(bits[v] ^ bits[u]).sum(axis=1, dtype=np.int64), percent)]
        own = np.sort(sets[u])
        while len(v):
            some, v = v[:64], v[64:]
            cat = np.concatenate([sets[k] for k in some])
            begin = np.cumsum(n[some]) - n[some]
            hit = own[np.minimum(np.searchsorted(own, cat), len(own) - 1)] == cat
            shared = np.add.reduceat(hit, begin, dtype=np.int64)
            linked = 100 * shared >= percent * (n[u] + n[some] - shared)
            if count and linked.any():
                # sets stand in the order of prefixes, so the first hit is the first token that both have
                hits = np.flatnonzero(hit)
                first = cat[hits[np.minimum(np.searchsorted(hits, begin), len(hits) - 1)]]
                linked &= np.isin(first, tokens[u])
                links[u] += copies[some[linked]].sum()
                links[some[linked]] += copies[u]
            for k in some[linked]:
                if label[k] != label[u]:
                    forest.append((ids[u], ids[k]))
                    label[label == label[k]] = label[u]
            if not count:
                v = v[label[v] != label[u]]
    told = np.flatnonzero(links)
    a = [x for x, _ in forest] + ids[told].tolist()
    b = [x for _, x in forest] + [None] * len(told)
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array([None] * len(forest) + links[told].tolist(), pa.int64())], names=["a", "b", "n"])


ADDED = ("n_shingles", "class_key", "root", "n_links")


def jaccard_components(docs: DataFrame, words: int = 5, percent: int = 80, text: str = "text", count: bool = False) -> DataFrame:
    """``docs`` with ``n_shingles``, ``class_key`` and ``root``: rows of equal root reach one another by links.

    Words are runs of bytes other than ASCII white space, A-Z lower-cased; a document's set has its
    distinct ``words``-word shingles, or its whole sequence if it has fewer words. Two documents
    link if 100 * intersection >= percent * union. With ``count`` there is ``n_links`` too: the number
    of other rows that the row links with, copies included; every link is then looked for, where
    components alone need only enough of them to join their documents.

    Nulls, blanks: rows with a null or blank text have an empty set, link with nothing and get a null
    root and no links. Ties, repeated rows: rows with equal sets share class_key and root, and link. Very
    long texts are read whole. An empty table gives an empty one. Columns of ``docs`` of the names
    added are replaced; others, doc_id too, may hold anything.
    """
    added = ADDED if count else ADDED[:-1]
    with Scratch(docs.sparkSession) as scratch:
        about = _classes(docs, words, percent, text, scratch, count)
    return _beside(without(docs, *added), about, text).select(*columns(without(docs, *added)), *added)


def _beside(docs: DataFrame, about: DataFrame, text: str) -> DataFrame:
    """``docs`` with the columns of ``about`` that are not its keys, by the keys of its texts."""
    k1, k2 = private(docs, "k1", "k2")
    h1, h2 = text_keys(F.col(f"`{text}`"))
    return docs.withColumns({k1: h1, k2: h2}).join(about.withColumnsRenamed({"k1": k1, "k2": k2}), [k1, k2], "left").drop(k1, k2)


def _classes(docs: DataFrame, words: int, percent: int, text: str, scratch: Scratch, count: bool) -> DataFrame:
    """(k1, k2, n_shingles, class_key, root, n_links) of every distinct text."""
    spark = docs.sparkSession
    k1, k2 = text_keys(F.col(f"`{text}`"))
    keyed = docs.select(k1.alias("k1"), k2.alias("k2"), F.col(f"`{text}`").alias("text"))
    size = keyed.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    slots = min(MOST_SLOTS, max(LEAST_SLOTS, 1 << (int(size) // 96).bit_length()))
    described = scratch.written(keyed.mapInArrow(_describe(words, slots), DESCRIBED), "described")
    rows = described.filter("block is null")
    heavy = _heavy_slots(scratch, described.filter("block is not null").select("block", "counts"), slots)
    # one text stands for each class; of equal sets none is looked at twice
    classes = scratch.written(rows.filter("n > 0").groupBy("c1", "c2").agg(*[F.first(x).alias(x) for x in ("k1", "k2", "n", "bits")], F.count("*").alias("copies")), "classes", large=True).withColumnRenamed("c1", "id")
    entries = classes.agg(F.sum(F.col("n") - F.ceil(F.col("n") * percent / 100) + 1)).first()[0] or 0
    buckets = max(2 * partitions(spark), -(-int(entries) // GROUP))
    packed = keyed.select("text").mapInArrow(_prefixes(words, percent, heavy, buckets), "bucket int, hot boolean, token binary, id binary, n binary, pos binary")
    meeting = scratch.written(packed.groupBy("bucket").applyInArrow(_meeting, "token long, id long, n int, pos int"), "meeting", large=True)

    def settled(open_: DataFrame, count: bool) -> DataFrame:
        """Links of the documents that stand in a tile together. Their sets are made from the texts, and sent to the tiles, once."""
        asked = open_.join(classes.select("id", "k1", "k2", "copies"), "id").groupBy("k1", "k2", "id").agg(F.collect_list(F.struct("tile", "side", "home", "root", "copies", "tokens")).alias("tiles"))
        # a table, so that the join deals out both sides and a hot text's rows can be split
        asked = scratch.written(asked, "asked")
        needed = open_.select("id").distinct().join(classes.select("id", "k1", "k2"), "id").select("k1", "k2")
        few = needed.count() <= BROADCAST_ROWS
        texts = keyed.join(F.broadcast(needed), ["k1", "k2"], "left_semi") if few else keyed
        # a merge join, so that copies of a text stand one below the other
        whole = texts.join(asked.hint("merge"), ["k1", "k2"]).select("id", "text", "tiles").mapInArrow(_sets_to_tiles(words, heavy), WHOLE)
        bytes_ = open_.agg(F.sum(F.col("n") * F.lit(8))).first()[0] or 0
        by_tile = whole.repartition(max(partitions(spark), -(-int(bytes_) // TASK_BYTES)), "tile").sortWithinPartitions("tile")
        return scratch.written(by_tile.mapInArrow(_links_in_tiles(percent, heavy, count), SETTLED), "settled", large=True)

    links, placed = None, meeting.withColumn("root", F.col("id"))
    if not count:
        links, placed = _stars(placed, classes, settled, percent, scratch)
    open_ = scratch.written(_tiles(placed, classes, percent).groupBy("bucket").applyInArrow(_open_in_tiles(percent), OPEN), "open", large=True)
    scratch.drop(meeting, placed) if links is not None else scratch.drop(meeting)
    told = settled(open_, count)
    more = told.filter("b is not null").select("a", "b")
    roots = scratch.written(components(more if links is None else links.unionByName(more), scratch), "roots")
    about = rows.groupBy("k1", "k2").agg(F.first("n").alias("n_shingles"), F.first("c1").alias("class_key")).join(roots.select(F.col("node").alias("class_key"), "root"), "class_key", "left").withColumn("root", F.when(F.col("n_shingles") > 0, F.coalesce("root", "class_key")))
    if count:
        sums = told.filter("b is null").groupBy(F.col("a").alias("class_key")).agg(F.sum("n").alias("links"))
        about = about.join(classes.select(F.col("id").alias("class_key"), "copies"), "class_key", "left").join(sums, "class_key", "left")
        about = about.withColumn("n_links", F.when(F.col("n_shingles") > 0, F.col("copies") - 1 + F.coalesce("links", F.lit(0))).otherwise(0)).drop("copies", "links")
    return written(about, "about")


def _stars(placed: DataFrame, classes: DataFrame, settled, percent: int, scratch: Scratch) -> tuple[DataFrame | None, DataFrame]:
    """Links of each document with one other: of those that are least in a token of it and elsewhere placed, the one in most tokens."""
    signs, links, meeting = classes.select("id", "bits", "n"), None, placed.select("token", "id", "n", "pos")

    def verified(pairs: DataFrame) -> DataFrame:
        differ = F.expr("aggregate(zip_with(abits, bbits, (x, y) -> bit_count(x ^ y)), 0, (s, x) -> s + x)")
        both = pairs.join(signs.select(F.col("id").alias("a"), F.col("bits").alias("abits"), F.col("n").alias("an")), "a").join(signs.select(F.col("id").alias("b"), F.col("bits").alias("bbits"), F.col("n").alias("bn")), "b")
        # at most (an + bn - differ) / 2 shared
        can = both.withColumn("most", F.floor((F.col("an") + F.col("bn") - differ) / 2)).filter(f"100 * most >= {percent} * (an + bn - most)").select("a", "an", "b", "bn")
        can = scratch.written(can, "candidates")
        # a star's centre and some of its documents make a tile
        parts = can.groupBy("a").agg(F.ceil(F.greatest(F.count("*") / TILE, F.sum("bn") / TILE_TOKENS)).alias("parts"))
        dealt = can.join(parts, "a").withColumn("tile", F.xxhash64("a", F.pmod(F.xxhash64("b"), F.col("parts"))))
        ends = [dealt.select("tile", F.lit(side).alias("side"), F.lit(True).alias("home"), F.col(x).alias("id"), F.col(x).alias("root"), F.col(f"{x}n").alias("n"), F.lit(b"").alias("tokens")) for side, x in enumerate("ab")]
        return settled(scratch.written(ends[0].distinct().unionByName(ends[1]), "stars"), False).select("a", "b")

    for _ in range(ROUNDS):
        least = placed.groupBy("token").agg(F.min("root").alias("first"), F.max("root").alias("last"), F.min(F.struct("root", "id")).getField("id").alias("a")).filter("first <> last").select("token", "first", "a")
        often = placed.join(least, "token").filter("root <> first").groupBy("id", "a").agg(F.count("*").alias("c"))
        stars = verified(often.groupBy(F.col("id").alias("b")).agg((-F.max(F.struct("c", (-F.col("a")).alias("a"))).getField("a")).alias("a")))
        if stars.isEmpty():
            break
        links = stars if links is None else links.unionByName(stars)
        joined = scratch.written(components(links, scratch), "joined")
        placed = scratch.written(meeting.join(joined.withColumnRenamed("node", "id"), "id", "left").select("token", "id", "n", "pos", F.coalesce("root", "id").alias("root")), "placed", large=True)
        crowd = placed.groupBy("token").agg(F.min("root").alias("r0"), F.max("root").alias("r1"), F.count("*").alias("c")).filter("r0 <> r1").agg(F.sum(F.col("c") * F.col("c")) / F.sum("c")).first()[0]
        if (crowd or 0) < CROWDED:
            break
    return links, placed


def _tiles(placed: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Entries of tokens that more than one component has, by tile, in buckets of about GROUP entries.

    A tile belongs to the tokens of one least document (lead) that are about as crowded, so that a pair
    that shares many meets in few tiles; leads of very many entries have several tiles. An entry goes
    to as many tiles as its own token has blocks (parts), and twice as many if the token is banded.
    """
    apart = placed.groupBy("token").agg(F.min("root").alias("r0"), F.max("root").alias("r1"), F.min("id").alias("lead"), F.count("*").alias("c"), F.sum("n").alias("total")).filter("r0 <> r1")
    parts = F.pow(F.lit(2.0), F.ceil(F.log2(F.greatest(F.col("c") / TILE, F.col("total") / TILE_TOKENS, F.lit(1.0))))).cast("int")
    apart = apart.select("token", "lead", "c", parts.alias("parts"), (F.col("c") > BANDED).alias("banded"))
    salts = apart.groupBy("lead", "parts").agg(F.ceil(2 * F.sum("c") / F.col("parts") / TILE_ROWS).alias("salts"))
    apart = apart.join(salts, ["lead", "parts"])
    buckets = max(8 * partitions(placed.sparkSession), -(-int(apart.agg(F.sum(F.col("c") * F.col("parts") * F.when(F.col("banded"), 2).otherwise(1))).first()[0] or 0) // GROUP))
    fold = F.transform(F.sequence(F.lit(1), F.lit(TILE_BITS // 64)), lambda k: F.element_at("bits", k).bitwiseXOR(F.element_at("bits", k + TILE_BITS // 64)))
    entries = placed.join(apart, "token").join(classes.select("id", fold.alias("bits")), "id")
    # neighbouring size bands meet: an entry stands in its own band's tile and the next one's
    band = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100 / percent + 1e-9)))
    stood = F.when(F.col("banded"), F.array(F.struct(band.alias("band"), F.lit(True).alias("home")), F.struct((band + 1).alias("band"), F.lit(False).alias("home")))).otherwise(F.array(F.struct(F.lit(-1).cast("long").alias("band"), F.lit(True).alias("home"))))
    own = F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")
    dealt = entries.withColumn("stood", F.explode(stood)).withColumn("part", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    tile = F.xxhash64("lead", "parts", "stood.band", F.least("part", "other"), F.greatest("part", "other"), F.pmod(F.xxhash64("token"), F.col("salts")))
    side = F.when(F.col("part") == F.col("other"), 2).when(F.col("part") < F.col("other"), 0).otherwise(1)
    return dealt.select(tile.alias("tile"), "token", "id", "n", "pos", "root", "bits", side.alias("side"), "stood.home").withColumn("bucket", F.pmod(F.xxhash64("tile"), F.lit(buckets)).cast("int"))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, n_shingles, component_id, n_links) of every document: shingles of 4 words, similarity of 0.85 or more."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return component_ids(jaccard_components(docs, 4, 85, count=True), "doc_id").select("doc_id", "n_shingles", "component_id", "n_links")


def component_ids(placed: DataFrame, key: str) -> DataFrame:
    """``placed`` with ``component_id``: the least ``key`` of the rows with its root, its own if the root is null."""
    # a table, so that the join deals out both sides and a hot component's rows can be split
    least = written(placed.filter("root is not null").groupBy("root").agg(F.min(key).alias("component_id")), "least")
    return placed.join(least, "root", "left").withColumn("component_id", F.when(F.col("root").isNull(), F.col(key)).otherwise(F.col("component_id")))


def one_of_each(docs: DataFrame, key: str, words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` but for all save one of each component: the row of least ``key``, of equal keys one.

    Rows without words stay, whether or not they are equal. A null key counts as greater than any other;
    of rows that share the least key the one stays whose text, then whose whole row, has the least
    hash. An empty table gives an empty one. All columns stay as they are, whatever their names.
    """
    with Scratch(docs.sparkSession) as scratch:
        about = _classes(docs, words, percent, "text", scratch, False)
    root, order, best = private(docs, "root", "order", "best")
    whole = F.xxhash64(*columns(docs))
    placed = _beside(docs, about.select("k1", "k2", F.col("root").alias(root)), "text")
    k1, k2 = text_keys(F.col("text"))
    ranked = placed.withColumn(order, F.struct(F.col(f"`{key}`").isNull(), F.col(f"`{key}`"), k1, k2, whole))
    same = ranked.filter(F.col(root).isNotNull()).groupBy(root, order).agg(F.count("*").alias("rows"))
    least = written(same.groupBy(root).agg(F.min(F.struct(F.col(order).alias("order"), "rows")).alias(best)), "chosen")
    kept = ranked.join(least, root, "left").filter(F.col(root).isNull() | F.col(order).eqNullSafe(F.col(f"{best}.order")))
    repeated = F.coalesce(F.col(f"{best}.rows") > 1, F.lit(False))
    if least.filter(f"{best}.rows > 1").isEmpty():
        return kept.select(*columns(docs))
    # rows that repeat as a whole
    copy = private(kept, "copy")[0]
    one = kept.filter(repeated).withColumn(copy, F.row_number().over(Window.partitionBy(root).orderBy(order))).filter(F.col(copy) == 1)
    return kept.filter(~repeated).select(*columns(docs)).unionByName(one.select(*columns(docs)))
