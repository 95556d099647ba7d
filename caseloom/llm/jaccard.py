"""Exact similarity join of documents on word shingles, and its connected groups.

Documents with equal shingle sets form a class. The shingle universe of a size band is dealt
by hash into more parts than two linked sets can differ in, so linked classes agree in a whole
part: the classes that agree in one part of one band form a tile, and only they can link. Tiles
are gathered by the class that most of their members agree with. In each gathering short hashed
bitmaps bound the overlap of pairs from above, which leaves clusters of classes that may link.
The members of a cluster are compared in units of bounded size, on wider bitmaps and then on
their sorted shingle arrays; pairs that are already connected are not compared. A unit emits the
links that connect, at most one less than its members, and never a pair that does not link.
"""

from __future__ import annotations

import hashlib
import itertools
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caseloom.llm.common import removed, small_side, written
from caseloom.llm.wordhash import mixed, shingle_sets

cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass(frozen=True)
class Threshold:
    """Two sets link when ``den * intersection >= num * union``."""

    num: int
    den: int

    def differences(self, a: int, b: int) -> int:
        """Most shingles that two linked sets of these sizes do not share."""
        return (a + b) * (self.den - self.num) // (self.den + self.num)

    def most(self, size: int) -> int:
        """Most differences between a set of this size and any set it links to."""
        return self.differences(size, size * self.den // self.num)

    def linked(self, shared, a, b):
        return self.den * shared >= self.num * (a + b - shared)


BAND_RATIO = 0.7
#: Empty parts a set may have before its empty parts count as agreement.
SPARE_PARTS = 3
#: Classes and shingles of a block; a unit of work compares one block, or two of one gathering.
BLOCK_CLASSES = 2_048
BLOCK_SHINGLES = 2_000_000
#: Classes of a block when only short bitmaps are compared, and their bits a shingle.
FILTER_CLASSES = 8_192
SHORT_BITS = 2
#: Bytes that the bitmaps of a unit may take.
BITMAP_BYTES = 64 * 1024 * 1024


def size_bands(limit: int) -> list[int]:
    """Lower bounds of the size bands up to a size, with one bound beyond."""
    bounds = [1]
    while bounds[-1] <= limit:
        bounds.append(max(bounds[-1] + 1, int(np.ceil(bounds[-1] / BAND_RATIO))))
    return bounds


def band_signatures(shingles: np.ndarray, t: Threshold) -> list[tuple[np.ndarray, int]]:
    """For each band a set stands in: hashes of its (band, part, content) combinations, and how
    many of them it can spare.

    Of two linked sets of sizes a and b, at least ``spare + 1`` of the first
    ``differences(a, b) + 1 + spare`` parts are equal. Empty parts count where both sets have
    more than ``spare`` of them, and then stand for themselves; else as many of the equal parts
    are lost as a set has empty ones. So two linked sets share more hashes than either can spare.
    """
    size = len(shingles)
    differ = t.most(size)
    if not differ:
        return []
    bounds = size_bands(size)
    own = len(bounds) - 2
    bands = [own]
    if size * t.den >= t.num * bounds[-1]:
        bands.append(own + 1)
        bounds.append(max(bounds[-1] + 1, int(np.ceil(bounds[-1] / BAND_RATIO))))
    found = []
    content = mixed(shingles)
    for band in bands:
        largest = t.most(bounds[band + 1] - 1)
        spare = SPARE_PARTS + largest // 16
        parts, own_parts = largest + 1 + spare, differ + 1 + spare
        part = (content % np.uint64(parts)).astype(np.int64)
        sums = np.zeros(parts, np.uint64)
        np.add.at(sums, part, mixed(content))
        counts = np.bincount(part, minlength=parts)[:own_parts]
        named = mixed(np.uint64(band << 32) + np.arange(own_parts, dtype=np.uint64) + np.uint64(1))
        signed = mixed(sums[:own_parts] ^ named)
        n_empty = int((counts == 0).sum())
        found.append((signed, 0) if n_empty > spare else (signed[counts > 0], spare - n_empty))
    return found


def tile_signatures(shingles: np.ndarray, t: Threshold) -> np.ndarray:
    """The hashes of all bands."""
    return np.concatenate([np.empty(0, np.uint64), *(found for found, _ in band_signatures(shingles, t))])


def bitmap(shingles: np.ndarray, bits: int = 8) -> bytes:
    """Bit set of the low hash bits; its width is a power of two, so many bits a shingle or more."""
    width = 1 << min(20, max(6, int(bits * len(shingles) - 1).bit_length()))
    bits = np.zeros(width, np.uint8)
    bits[(shingles & np.uint64(width - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def overlap_bound(a: bytes, b: bytes, size_a: int, size_b: int) -> int:
    """Upper bound of the shared shingles: a bit only one side has stands for a shingle it alone has."""
    width = min(len(a), len(b))
    x, y = folded(a, width), folded(b, width)
    only_a = int(np.bitwise_count(x & ~y).sum())
    only_b = int(np.bitwise_count(y & ~x).sum())
    return min(size_a - only_a, size_b - only_b)


def _digest(shingles: np.ndarray) -> bytes:
    """The name of a class: 128 bits of its shingle set."""
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def _described(n: int, t: Threshold):
    """Rows (id, key, n_shingles, class, alias, short, bands) of rows (id, key, text)."""
    band = pa.struct([("signatures", pa.list_(pa.int64())), ("spare", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()  # a copy in the same task need not stand in the tiles again
        for batch in batches:
            sizes, classes, aliases, shorts, signed = [], [], [], [], []
            for _, shingles in shingle_sets(batch.column("text"), n):
                sizes.append(len(shingles))
                name = _digest(shingles) if len(shingles) else None
                classes.append(name)
                aliases.append(name and int.from_bytes(name[:8], "little", signed=True))
                shorts.append(None if name is None or name in seen else bitmap(shingles, SHORT_BITS))
                signed.append(None if name is None or name in seen else [
                    {"signatures": found.view(np.int64), "spare": spare}
                    for found, spare in band_signatures(shingles, t)])
                seen.add(name)
            yield pa.RecordBatch.from_arrays([
                batch.column("id"), batch.column("key"), pa.array(sizes, pa.int64()),
                pa.array(classes, pa.binary()), pa.array(aliases, pa.int64()),
                pa.array(shorts, pa.binary()), pa.array(signed, pa.list_(band))],
                ["id", "key", "n_shingles", "class", "alias", "short", "bands"])
    return run


def folded(bits: bytes, width: int) -> np.ndarray:
    """A bitmap brought to a smaller width (in bytes) by laying its halves over each other."""
    found = np.frombuffer(bits, np.uint8)
    while len(found) > width:
        found = found[: len(found) // 2] | found[len(found) // 2:]
    return found


def _class_sets(n: int):
    """Rows (class, shingles as sorted 64-bit integers in bytes) of rows (text), a class once a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            classes, sets = [], []
            for _, shingles in shingle_sets(batch.column("text"), n):
                name = _digest(shingles)
                if name not in seen:
                    seen.add(name)
                    classes.append(name)
                    sets.append(shingles.tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(classes, pa.binary()), pa.array(sets, pa.binary())], ["class", "shingles"])
    return run


def _bitmaps(sets: list[np.ndarray]) -> np.ndarray:
    """One row of 64-bit words per set, as wide as the largest set asks for and memory allows."""
    largest = max(map(len, sets))
    width = 1 << min((BITMAP_BYTES * 8 // len(sets)).bit_length() - 1, max(6, (8 * largest - 1).bit_length()))
    rows = np.zeros((len(sets), max(64, width) // 64), np.uint64)
    for row, shingles in zip(rows, sets):
        at = shingles & np.uint64(64 * len(row) - 1)
        np.bitwise_or.at(row, (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))
    return rows


def _shared(a: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """How many shingles the sorted array has in common with each of the others (none empty)."""
    every = np.concatenate(others)
    at = np.searchsorted(a, every)
    at[at == len(a)] = 0
    starts = np.cumsum([0, *map(len, others[:-1])])
    return np.add.reduceat(a[at] == every, starts, dtype=np.int64)


def connecting_links(sets: list[np.ndarray], places: np.ndarray, first_half: int, t: Threshold) -> list[tuple[int, int]]:
    """Links (i, j) between the sets of one unit that connect what was not connected before.

    ``places`` are the components known so far. With ``first_half`` > 0 only pairs of one of the
    first so many sets with one of the others count, else all pairs. The first set of a unit
    is the one its tiles were gathered by: copies connect to it, and only the rest is compared
    with each other.
    """
    sizes, bits = np.array([len(s) for s in sets], np.int64), _bitmaps(sets)
    roots = np.unique(places, return_inverse=True)[1]
    links: list[tuple[int, int]] = []

    def connect(i: int, js: np.ndarray) -> None:
        linked = t.linked(_shared(sets[i], [sets[j] for j in js]), sizes[i], sizes[js])
        for j in js[linked]:
            if roots[i] != roots[j]:
                links.append((i, int(j)))
                roots[roots == roots[j]] = roots[i]

    for i in range(first_half or len(sets)):
        js = np.arange(first_half or i + 1, len(sets))
        js = js[(roots[js] != roots[i])
                & (t.den * np.minimum(sizes[js], sizes[i]) >= t.num * np.maximum(sizes[js], sizes[i]))]
        if not len(js):
            continue
        only_i = np.bitwise_count(bits[i] & ~bits[js]).sum(axis=1, dtype=np.int64)
        only_j = np.bitwise_count(bits[js] & ~bits[i]).sum(axis=1, dtype=np.int64)
        bound = np.minimum(sizes[i] - only_i, sizes[js] - only_j)
        able = t.linked(bound, sizes[i], sizes[js])
        js, bound = js[able], bound[able]
        if len(js):  # the likeliest of each component first, then what is still apart
            order = np.argsort(-bound / (sizes[i] + sizes[js] - bound), kind="stable")
            js = js[order]
            likeliest = np.unique(roots[js], return_index=True)[1]
            connect(i, js[likeliest])
            rest = np.delete(js, likeliest)
            rest = rest[roots[rest] != roots[i]]
            if len(rest):
                connect(i, rest)
    return links


def likely_clusters(sizes: np.ndarray, maps: list[bytes], t: Threshold) -> tuple[np.ndarray, np.ndarray]:
    """Clusters of sets whose short bitmaps let them link, as labels, and how many each may link to.

    Linked sets differ so little in size that their bitmaps are as wide or one twice as wide.
    """
    widths, degree = np.array([len(m) for m in maps]), np.zeros(len(maps), np.int64)
    labels = np.arange(len(maps))
    rows = {w: np.flatnonzero(widths == w) for w in np.unique(widths)}
    bits = {w: np.stack([np.frombuffer(maps[k], np.uint8) for k in at]).view(np.uint64) for w, at in rows.items()}
    for w, at in rows.items():
        wider = rows.get(2 * w, at[:0])
        half = bits[w].shape[1]
        others = np.concatenate([at, wider])
        held = np.concatenate([bits[w], bits[2 * w][:, :half] | bits[2 * w][:, half:]]) if len(wider) else bits[w]
        for k, i in enumerate(at):
            js = np.arange(k + 1, len(others))
            size = sizes[others[js]]
            js = js[t.den * np.minimum(size, sizes[i]) >= t.num * np.maximum(size, sizes[i])]
            if not len(js):
                continue
            size = sizes[others[js]]
            only_i = np.bitwise_count(held[k] & ~held[js]).sum(axis=1, dtype=np.int64)
            only_j = np.bitwise_count(held[js] & ~held[k]).sum(axis=1, dtype=np.int64)
            able = others[js[t.linked(np.minimum(sizes[i] - only_i, size - only_j), sizes[i], size)]]
            if len(able):
                degree[i] += len(able)
                degree[able] += 1
                apart = np.unique(labels[able])
                labels[np.isin(labels, apart[apart != labels[i]])] = labels[i]
    return labels, degree


def _clusters(t: Threshold):
    """Rows (gathering, class) of rows sorted by unit (gathering, low, high): clusters, by their leader.

    The leader is the class that may link to most others, so copies gather by their original.
    """
    def unit(rows: list[tuple]) -> Iterator[tuple[bytes, bytes]]:
        rows = sorted({r[3]: r for r in rows}.values(), key=lambda r: r[3])
        if len(rows) < 2:
            return
        labels, degree = likely_clusters(np.array([r[4] for r in rows], np.int64), [r[5] for r in rows], t)
        order = np.lexsort((-degree, labels))
        starts = np.flatnonzero(np.diff(labels[order], prepend=-1))
        for members in np.split(order, starts[1:]):
            if len(members) > 1:
                yield from ((rows[members[0]][3], rows[k][3]) for k in members)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        columns = ("gathering", "low", "high", "class", "n_shingles", "short")
        for batch in batches:
            yield from zip(*(batch.column(c).to_pylist() for c in columns))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in itertools.groupby(each(batches), key=lambda r: r[:3]):
            found = list(unit(list(rows)))
            if found:
                yield _edges(found).rename_columns(["gathering", "class"])
    return run


def _unit_links(t: Threshold):
    """Rows (a, b) of rows sorted by unit (gathering, low, high): components that link."""
    def unit(rows: list[tuple]) -> list[tuple[bytes, bytes]]:
        low, high = rows[0][1], rows[0][2]
        rows = list({r[3:6]: r for r in rows}.values())  # repeated rows may bring a class again
        rows.sort(key=lambda r: (r[3] != low, not r[4], r[5]))
        first_half = sum(r[3] == low for r in rows) if low != high else 0
        if first_half == len(rows) or len({r[6] for r in rows}) < 2:
            return []
        sets = [np.frombuffer(r[7], np.uint64) for r in rows]
        names = np.array([r[6].hex() for r in rows])
        found = connecting_links(sets, names, first_half, t)
        return [(rows[i][6], rows[j][6]) for i, j in found]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        columns = ("gathering", "low", "high", "block", "leads", "class", "component", "shingles")
        for batch in batches:
            yield from zip(*(batch.column(c).to_pylist() for c in columns))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple[bytes, bytes]] = []
        for _, rows in itertools.groupby(each(batches), key=lambda r: r[:3]):
            found += unit(list(rows))
            if len(found) > 10_000:
                yield _edges(found)
                found = []
        yield _edges(found)
    return run


def _edges(found: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
    a, b = zip(*found) if found else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])


def connected(edges: DataFrame) -> DataFrame:
    """(node, component) for all nodes of edges (a, b); a component is one of its nodes.

    Every node moves to the smallest of its neighbours and itself, edges are contracted, and
    so on until none is left. Node names are hashes, so the rounds are few. Each round is
    written; nothing of it passes through the driver but the number of edges left.
    """
    edges = written(edges.where("a != b").distinct(), "edges")
    places = None
    while edges.count():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        moves = written(both.groupBy(F.col("a").alias("node")).agg(
            F.least(F.first("a"), F.min("b")).alias("to")), "moves")
        if places is None:
            places = moves.select("node", F.col("to").alias("component"))
        else:
            step = moves.select(F.col("node").alias("component"), "to")
            places = written(places.join(step, "component", "left").select(
                "node", F.coalesce("to", "component").alias("component")), "places")
        a, b = (moves.select(F.col("node").alias(c), F.col("to").alias(f"to_{c}")) for c in "ab")
        edges = written(edges.join(a, "a").join(b, "b").select(
            F.col("to_a").alias("a"), F.col("to_b").alias("b")).where("a != b").distinct(), "edges")
    if places is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return places


class Join:
    """The steps of one join; see ``similar_groups``."""

    def __init__(self, docs: DataFrame, t: Threshold, n: int, id_col: str, text_col: str):
        self.t, self.n = t, n
        self.rows = docs.select(F.col(id_col).cast("long").alias("id"),
                                F.xxhash64(text_col).alias("key"),
                                F.col(text_col).cast("string").alias("text"))
        self.described = written(self.rows.mapInArrow(
            _described(n, t), "id long, key long, n_shingles long, class binary, alias long, "
                              "short binary, bands array<struct<signatures: array<long>, spare: int>>"), "described")
        self.classes = self.described.where(F.col("class").isNotNull()).groupBy("class").agg(
            F.first("alias").alias("alias"), F.first("n_shingles").alias("n_shingles"),
            F.min("id").alias("least_id"), F.min(F.struct("id", "key")).alias("row"), F.count("*").alias("n_rows"))

    def tiles(self) -> DataFrame:
        """(signature, alias, n) of tiles that hold several classes; n counts their rows.

        Each class leaves the largest of its tiles, in one order for all, as many as it can
        spare: two linked classes share more tiles than that, so the last of those in this
        order keeps both. What texts share by a common passage stands in large tiles.
        An alias is half of a class's name. Should two classes have the same, they stand in
        each other's tiles, which costs comparisons and nothing else.
        """
        bands = self.described.select("alias", F.posexplode("bands").alias("band", "held"))
        each = bands.select("alias", "band", "held.spare", F.explode("held.signatures").alias("signature"))
        shared = written(each.groupBy("signature").agg(
            F.min("alias").alias("least"), F.max("alias").alias("most"), F.count("*").alias("n"))
            .where("least != most").select("signature", "n"), "shared")
        met = each.join(small_side(shared, shared.count(), 24), "signature").distinct()
        order = Window.partitionBy("alias", "band").orderBy(F.desc("n"), "signature")
        return written(met.withColumn("place", F.row_number().over(order)).where("place > spare")
                       .select("signature", "alias", "n"), "tiles")

    def gatherings(self) -> DataFrame:
        """(gathering, class, n_shingles, short): the classes of all tiles with the same leader.

        The rank of a class is how many rows its tiles hold: the text that others are copies
        of agrees with them in most parts, so it ranks highest among them and leads their tiles.
        Linked classes share a tile, so they stand in one gathering.
        """
        tiles = self.tiles()
        ranks = written(tiles.groupBy("alias").agg(F.sum("n").alias("rank")), "ranks")
        ranked = tiles.join(small_side(ranks, ranks.count(), 24), "alias")
        leaders = written(ranked.groupBy("signature").agg(
            F.max(F.struct("rank", "alias")).alias("top"), F.count("*").alias("n")).where("n > 1").select(
            "signature", F.col("top.alias").alias("gathering")), "leaders")
        met = written(tiles.join(small_side(leaders, leaders.count(), 24), "signature")
                      .select("gathering", "alias").distinct(), "met")
        held = self.described.where(F.col("short").isNotNull()).select("alias", "class", "n_shingles", "short").join(
            met.select("alias").distinct(), "alias", "left_semi").dropDuplicates(["class"])
        return met.join(held, "alias").drop("alias")

    def clusters(self) -> DataFrame:
        """(gathering, class, n_shingles, leads): classes that may link, by short bitmaps.

        Two classes that may link stand in one cluster, whose leader names the gathering.
        Gatherings of more than ``FILTER_CLASSES`` are compared block by block.
        """
        members = written(self.gatherings(), "members")
        sizes = members.groupBy("gathering").agg(F.count("*").alias("n")).where("n > 1").select(
            "gathering", F.ceil(F.col("n") / FILTER_CLASSES).cast("int").alias("blocks"))
        sizes = written(sizes, "sizes")
        dealt = members.join(small_side(sizes, sizes.count(), 24), "gathering").withColumn(
            "block", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int"))
        other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
        units = dealt.select("gathering", "class", "n_shingles", "short", "block", other).select(
            "gathering", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
            "class", "n_shingles", "short")
        units = units.repartition("gathering", "low", "high").sortWithinPartitions("gathering", "low", "high")
        found = written(units.mapInArrow(_clusters(self.t), "gathering binary, class binary").distinct(), "found")
        classes = written(self.classes.join(found.select("class").distinct(), "class", "left_semi")
                          .select("class", "n_shingles", "row"), "held")
        n_classes = classes.count()
        self.sets = self.class_sets(classes.select("row"), n_classes)
        return written(found.join(small_side(classes.select("class", "n_shingles"), n_classes, 48), "class")
                       .select("gathering", "class", "n_shingles",
                               (F.col("class") == F.col("gathering")).alias("leads")), "clusters")

    def class_sets(self, chosen: DataFrame, n_chosen: int) -> DataFrame:
        """(class, shingles) of the classes that the chosen rows (id, key) stand for."""
        at = chosen.select(F.col("row.id").alias("at"), F.col("row.key").alias("at_key"))
        texts = self.rows.join(small_side(at, n_chosen, 32),
                               F.col("id").eqNullSafe(F.col("at")) & (F.col("key") == F.col("at_key")), "left_semi")
        return written(texts.select("text").mapInArrow(_class_sets(self.n), "class binary, shingles binary"), "sets")

    def linked(self, units: DataFrame) -> DataFrame:
        """Edges (a, b) between components, of rows (gathering, low, high, block, leads, class, component)."""
        units = written(units, "units")  # names only; the sets move once, to their units
        held = self.sets.join(small_side(units, units.count(), 120), "class")
        dealt = held.repartition("gathering", "low", "high").sortWithinPartitions("gathering", "low", "high")
        return dealt.mapInArrow(_unit_links(self.t), "a binary, b binary")

    def class_components(self) -> DataFrame:
        """(class, component) for classes that link to others."""
        members = self.clusters()
        blocks = written(members.groupBy("gathering").agg(
            F.count("*").alias("n"), F.sum("n_shingles").alias("s")).where("n > 1").select("gathering", F.greatest(
                F.ceil(F.col("n") / BLOCK_CLASSES), F.ceil(F.col("s") / BLOCK_SHINGLES)).cast("int").alias("blocks")),
            "blocks")
        n_gatherings, n_large = blocks.agg(F.count("*"), F.count_if(F.col("blocks") > 1)).first()
        dealt = members.join(small_side(blocks, n_gatherings, 24), "gathering").withColumn(
            "block", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int"))
        # Every block also has the leader, that copies connect to.
        everywhere = F.when(F.col("leads"), F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array("block"))
        own = dealt.select("gathering", "class", "leads", F.explode(everywhere).alias("block"),
                           F.col("class").alias("component"))
        places = connected(self.linked(own.select(
            "gathering", F.col("block").alias("low"), F.col("block").alias("high"), "block", "leads", "class",
            "component"))).withColumnRenamed("node", "class")
        places = self.across(dealt.where("blocks > 1"), places) if n_large else places
        removed(self.sets)  # the largest table in between, read for the last time
        return places

    def across(self, dealt: DataFrame, places: DataFrame) -> DataFrame:
        """``places`` after comparing the blocks of large gatherings with each other.

        Only pairs of blocks that hold several components are units of work.
        """
        rows = written(dealt.join(places, "class", "left").withColumn(
            "component", F.coalesce("component", "class")), "large")
        blocks = rows.groupBy("gathering", "block").agg(
            F.min("component").alias("least"), F.max("component").alias("most"))
        x, y = (blocks.select("gathering", *[F.col(c).alias(f"{c}_{k}") for c in ("block", "least", "most")])
                for k in "xy")
        work = x.join(y, "gathering").where(
            "block_x < block_y and not (least_x = most_y and most_x = least_y)").select(
            "gathering", F.col("block_x").alias("low"), F.col("block_y").alias("high"))
        halves = work.select("*", F.explode(F.array("low", "high")).alias("block"))
        edges = self.linked(rows.join(halves, ["gathering", "block"]).select(
            "gathering", "low", "high", "block", "leads", "class", "component"))
        moved = written(connected(edges), "moved")
        fresh = moved.select(F.col("node").alias("class"), F.col("node").alias("component"))
        everywhere = places.unionByName(fresh.join(places.select("class"), "class", "left_anti"))
        return written(everywhere.join(
            moved.select(F.col("node").alias("component"), F.col("component").alias("whole")),
            "component", "left").select("class", F.coalesce("whole", "component").alias("component")), "places")


def similar_groups(docs: DataFrame, t: Threshold = Threshold(85, 100), n: int = 4,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document row: id, ``n_shingles``, ``component_id``, ``class``, ``text_key``.

    ``component_id`` is the smallest id reachable over links, the document itself included.
    Documents with equal sets link; a null text or one without words has an empty set, no
    class, and links with nothing. Rows without an id take part and may get a null component
    if no id is reachable. Repeated rows are copies of each other.
    """
    join = Join(docs, t, n, id_col, text_col)
    places = join.class_components()
    # A class of one row that links to no other keeps its row's id and needs no lookup.
    named = join.classes.select("class", "least_id", "n_rows").join(places, "class", "left").where(
        "n_rows > 1 or component is not null").withColumn("component", F.coalesce("component", "class"))
    named = written(named, "named")
    least = named.groupBy("component").agg(F.min("least_id").alias("component_id"))
    groups = written(named.join(least, "component").select("class", "component", "component_id"), "groups")
    found = (join.described.select("id", "key", "n_shingles", "class")
             .join(small_side(groups, groups.count(), 80), "class", "left"))
    return found.select(F.col("id").alias(id_col), "n_shingles",
                        F.when(F.col("component").isNull(), F.col("id")).otherwise(F.col("component_id"))
                        .alias("component_id"), "class", F.coalesce("component", "class").alias("component"),
                        F.col("key").alias("text_key"))


def one_per_group(docs: DataFrame, t: Threshold = Threshold(80, 100), n: int = 5,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of similar documents; rows without words all stay.

    The row with the smallest id stays (null ids after all others, then the smallest text
    hash). All columns are kept.
    """
    groups = written(similar_groups(docs, t, n, id_col, text_col).select(
        F.col(id_col).alias("__id"), F.col("text_key").alias("__key"), "component"), "groups")
    order = F.struct(F.col("__id").isNull().alias("none"), F.col("__id").alias("id"),
                     F.col("__key").alias("key"))
    first = groups.where(F.col("component").isNotNull()).groupBy("component").agg(
        F.min(order).alias("first"), F.count("*").alias("n")).where("n > 1")
    joined = groups.join(first, "component")
    is_first = (F.col("__id").eqNullSafe(F.col("first.id")) & (F.col("__key") == F.col("first.key")))
    dropped = written(joined.where(~is_first).select("__id", "__key").distinct(), "dropped")
    same = F.col(id_col).cast("long").eqNullSafe(F.col("__id")) & (F.xxhash64(text_col) == F.col("__key"))
    kept = docs.join(small_side(dropped, dropped.count(), 24), same, "left_anti")
    twice = joined.where(is_first).groupBy("__id", "__key").count().where("count > 1").drop("count")
    if twice.isEmpty():
        return kept
    twice = written(twice, "repeated")
    twice = small_side(twice, twice.count(), 24)
    again = kept.join(twice, same, "left_semi").dropDuplicates([id_col, text_col])
    return kept.join(twice, same, "left_anti").unionByName(again)
