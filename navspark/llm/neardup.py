"""MinHash near-duplicates: HyperMinHash sketches, banding, exact confirmation.

1. One Arrow pass sketches every text (:mod:`navspark.llm.minhash`); texts with
   the same shingle set fall into one class, and only its smallest id goes on.
2. Each band key is a bucket. Every member is compared with the bucket's hub,
   the member that shares most buckets with others, so a group of n copies
   makes n - 1 candidates. Candidates pass the collision-corrected Jaccard
   estimate and are then confirmed on full shingle sets.
3. Buckets whose members are still in several components are compared member by
   member, in tiles of bounded size, on sketches inside the tasks. What passes
   names pairs of blocks, and the exact comparison of two blocks again happens
   inside one task, which returns a spanning forest of the links it finds. No
   step emits the pairs of a group and none skips a candidate.

With 32 bands of 4 registers two texts at the threshold 0.75 share no bucket
with probability (1 - 0.75^4)^32 = 5e-6; the estimate is cut 4.5 standard
deviations below the threshold (3e-6).
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from navspark.llm import minhash
from navspark.llm.blocks import consecutive_groups, frugal, list_values
from navspark.llm.components import components_table
from navspark.llm.shipping import ship
from navspark.llm.textops import NOT_SPACE, shingle_hashes, utf8_slices, word_bounds, word_hashes
from navspark.plans.materialize import Stored

WORDS = 5
PERCENT = 75
MARGIN = 4.5 * math.sqrt(0.75 * 0.25 / minhash.REGISTERS)
#: Members of a bucket that one task compares with one another: up to so many, a
#: sketch travels once for each of its open buckets.
TILE = 1024
BLOCK_DOCS = 1024
BLOCK_SHINGLES = 200_000

SKETCH_SCHEMA = "doc_id bigint, n bigint, digest binary, bands array<bigint>"
SET_SCHEMA = "node bigint, shingles array<bigint>"


def text_shingles(texts: pa.Array) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text of a column."""
    for first, last, data, offsets in utf8_slices(texts):
        starts, ends, bounds = word_bounds(data, offsets, NOT_SPACE)
        words = word_hashes(data, starts, ends)
        for i in range(last - first):
            yield shingle_hashes(words[bounds[i] : bounds[i + 1]], WORDS)


def _digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def _sketch_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n, digest, bands = [], [], []
        for s in text_shingles(batch.column(1)):
            n.append(len(s))
            digest.append(_digest(s) if len(s) else None)
            bands.append(minhash.band_keys(minhash.sketch(s)) if len(s) else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n, pa.int64()), pa.array(digest, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
            names=["doc_id", "n", "digest", "bands"],
        )


def _set_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: set[int] = set()
    for batch in batches:
        nodes, want = batch.column(0).to_pylist(), batch.column(2).to_pylist()
        out_nodes, out_sets, size = [], [], 0
        for node, digest, s in zip(nodes, want, text_shingles(batch.column(1)), strict=True):
            if node in seen or _digest(s) != digest:
                continue
            seen.add(node)
            out_nodes.append(node)
            out_sets.append(s.view(np.int64))
            size += len(s)
            if size > 1_000_000:
                yield _set_batch(out_nodes, out_sets)
                out_nodes, out_sets, size = [], [], 0
        if out_nodes:
            yield _set_batch(out_nodes, out_sets)


def _set_batch(nodes: list, sets: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(nodes, pa.int64()), pa.array(sets, pa.list_(pa.int64()))], names=["node", "shingles"]
    )


def equal_registers(a: Column, b: Column) -> Column:
    """How many 16-bit registers of two band-key arrays are equal."""

    def lanes(x: Column, y: Column) -> Column:
        d = x.bitwiseXOR(y)
        return sum(
            ((F.shiftrightunsigned(d, 16 * k).bitwiseAND(F.lit(0xFFFF))) == 0).cast("int") for k in range(minhash.ROWS)
        )

    return F.aggregate(F.zip_with(a, b, lanes), F.lit(0), lambda s, x: s + x)


def jaccard_estimate(a: Column, b: Column, n: Column, m: Column) -> Column:
    """Collision-corrected estimate, the column form of :func:`minhash.estimate`."""
    ratio = F.least(n, m) / F.greatest(n, m)
    chance = 0.16991948715973909 * 2.0**-minhash.MANTISSA_BITS * 4 * ratio / ((1 + ratio) * (1 + ratio))
    return (equal_registers(a, b) / F.lit(float(minhash.REGISTERS)) - chance) / (1 - chance)


def _may_link(n: Column, m: Column) -> Column:
    """Sets whose sizes alone allow the threshold."""
    return 100 * F.least(n, m) >= PERCENT * F.greatest(n, m)


def _tile_of(*parts) -> Column:
    return F.xxhash64(*parts)


def _block_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of blocks that hold an estimated link between components, per tile."""
    floor = PERCENT / 100 - MARGIN
    seen: set[tuple[int, int]] = set()
    for tile in consecutive_groups(batches, "tile"):
        comp = tile.column("component").to_numpy()
        blk = tile.column("blk").to_numpy()
        n = tile.column("n").to_numpy()
        values, _ = list_values(tile.column("bands"))
        regs = minhash.registers_of(values.reshape(len(comp), minhash.BANDS))
        low, high = [], []
        for i in range(len(comp) - 1):
            others = i + 1 + np.flatnonzero(comp[i + 1 :] != comp[i])
            if not len(others):
                continue
            same = (regs[others] == regs[i]).sum(axis=1)
            sized = 100 * np.minimum(n[i], n[others]) >= PERCENT * np.maximum(n[i], n[others])
            hit = others[sized & (minhash.estimate(same, n[i], n[others]) >= floor)]
            for b in np.unique(blk[hit]):
                pair = (min(int(blk[i]), int(b)), max(int(blk[i]), int(b)))
                if pair not in seen:
                    seen.add(pair)
                    low.append(pair[0])
                    high.append(pair[1])
        if low:
            yield pa.RecordBatch.from_arrays([pa.array(low, pa.int64()), pa.array(high, pa.int64())], names=["a", "b"])


def _find(parent: dict, x: int) -> int:
    while parent.setdefault(x, x) != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


def _block_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A spanning forest of the exact links inside each pair of blocks."""
    for tile in consecutive_groups(batches, "tile"):
        node = tile.column("node").to_numpy()
        comp = tile.column("component").to_numpy()
        values, offsets = list_values(tile.column("shingles"))
        sizes = np.diff(offsets)
        ids, inverse = np.unique(values, return_inverse=True)
        mark = np.zeros(len(ids), dtype=np.int32)
        parent: dict[int, int] = {}
        out: list[tuple[int, int]] = []
        names, counts = np.unique(comp, return_counts=True)
        common = names[np.argmax(counts)]
        for i in np.flatnonzero(comp != common):
            mine = inverse[offsets[i] : offsets[i + 1]]
            mark[mine] = 1
            both = np.add.reduceat(mark[inverse], offsets[:-1])
            mark[mine] = 0
            hit = np.flatnonzero((100 * both >= PERCENT * (sizes[i] + sizes - both)) & (comp != comp[i]))
            for j in hit:
                a, b = _find(parent, int(comp[i])), _find(parent, int(comp[j]))
                if a != b:
                    parent[a] = b
                    out.append((int(node[i]), int(node[j])))
        if out:
            u, v = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])


def _shuffled(df: DataFrame, key: str) -> DataFrame:
    return df.repartition(key).sortWithinPartitions(key)


class Tables:
    """Stored tables that one result needs on its way, deleted together."""

    def __init__(self) -> None:
        self._all: list[Stored] = []

    def keep(self, df: DataFrame, wide: bool = False) -> DataFrame:
        self._all.append(Stored(df, wide))
        return self._all[-1].df

    def components(self, edges: DataFrame) -> DataFrame:
        self._all.append(components_table(edges))
        return self._all[-1].df

    def drop(self) -> None:
        for t in self._all:
            t.drop()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)``, one row per input row.

    Documents are linked where ``100 * intersection >= 75 * union`` of their
    sets of five-word shingles; ``component_id`` is the smallest id reachable.
    Null and wordless texts have no shingles and link with nothing. Rows that
    share an id are one document, linked by any of them; a null id links with
    nothing (component null, kept). Repeated rows give repeated results. Other
    columns are ignored, so their names cannot clash. Empty in, empty out.
    """
    ship(docs.sparkSession)
    base = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    signed = Stored(base.mapInArrow(frugal(_sketch_batches), SKETCH_SCHEMA), wide=True).df
    full = signed.where(F.col("digest").isNotNull() & F.col("doc_id").isNotNull())

    tables = Tables()
    classes = tables.keep(
        full.groupBy("digest").agg(
            F.min("doc_id").alias("node"), F.first("n").alias("n"), F.first("bands").alias("bands")
        ),
        wide=True,
    )
    links = _links(base, classes, tables)
    member = full.join(classes.select("digest", "node"), "digest")
    copies = member.where(F.col("doc_id") != F.col("node")).select(
        F.col("doc_id").alias("u"), F.col("node").alias("v")
    ).distinct()
    comps = components_table(links.union(copies)).df
    tables.drop()
    label = signed.select("doc_id", F.col("n").alias("n_shingles")).join(
        comps.withColumnRenamed("node", "doc_id"), "doc_id", "left"
    )
    component = F.coalesce("component", "doc_id")
    return label.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        (F.col("doc_id").isNull() | (F.col("doc_id") == component)).alias("kept"),
    )


def _links(base: DataFrame, classes: DataFrame, tables: Tables) -> DataFrame:
    """Exact links ``(u, v)`` between class representatives that connect what is linked."""
    bands = classes.select("node", F.posexplode("bands").alias("band", "key"))
    sizes = bands.groupBy("band", "key").agg(F.count("*").alias("size")).where("size > 1")
    buckets = tables.keep(bands.join(sizes, ["band", "key"]))

    degree = buckets.groupBy("node").agg(F.sum("size").alias("degree"))
    ranked = buckets.join(degree, "node")
    hubs = ranked.groupBy("band", "key").agg(F.max(F.struct("degree", (-F.col("node")).alias("hub"))).alias("top"))
    starred = tables.keep(
        buckets.join(hubs.select("band", "key", (-F.col("top.hub")).alias("hub")), ["band", "key"])
    )

    sketches = classes.select("node", "n", "bands")
    of_hub = sketches.select(F.col("node").alias("hub"), F.col("n").alias("hub_n"), F.col("bands").alias("hub_bands"))
    stars = starred.where("node <> hub").select("node", "hub").distinct()
    likely = (
        stars.join(sketches, "node")
        .join(of_hub, "hub")
        .where(
            _may_link(F.col("n"), F.col("hub_n"))
            & (jaccard_estimate(F.col("bands"), F.col("hub_bands"), F.col("n"), F.col("hub_n")) >= PERCENT / 100 - MARGIN)
        )
        .select("node", "hub")
    )

    wanted = buckets.select("node").distinct().join(classes.select("node", "digest"), "node")
    text = base.join(wanted, base["doc_id"] == wanted["node"]).select("node", "text", "digest")
    sets = tables.keep(text.mapInArrow(frugal(_set_batches), SET_SCHEMA), wide=True)

    starlinks = tables.keep(_confirmed(likely, sets))
    return starlinks.union(_residual_links(starred, sketches, sets, tables.components(starlinks), tables))


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs ``(node, hub)`` that are links on their full sets, as ``(u, v)``."""
    both = F.size(F.array_intersect("shingles", "hub_shingles"))
    union = F.size("shingles") + F.size("hub_shingles") - both
    return (
        pairs.join(sets, "node")
        .join(sets.select(F.col("node").alias("hub"), F.col("shingles").alias("hub_shingles")), "hub")
        .where(100 * both >= PERCENT * union)
        .select(F.col("node").alias("u"), F.col("hub").alias("v"))
    )


def _residual_links(
    starred: DataFrame, sketches: DataFrame, sets: DataFrame, comps: DataFrame, tables: Tables
) -> DataFrame:
    """Links between components that still share a bucket after the hub comparison."""
    own = starred.join(comps, "node", "left").withColumn("component", F.coalesce("component", "node"))
    of_hub = comps.select(F.col("node").alias("hub"), F.col("component").alias("hub_component"))
    own = own.join(of_hub, "hub", "left").withColumn("major", F.col("component") == F.coalesce("hub_component", "hub"))
    open_buckets = (
        own.groupBy("band", "key")
        .agg(
            F.sum(F.col("major").cast("int")).alias("n_major"),
            F.sum((~F.col("major")).cast("int")).alias("n_minor"),
        )
        .where("n_minor > 0")
    )
    rest = tables.keep(
        own.join(open_buckets, ["band", "key"])
        .withColumn("a_blocks", F.ceil(F.col("n_minor") / TILE))
        .withColumn("b_blocks", F.ceil(F.col("n_major") / TILE))
        .drop("hub_component")
    )

    # Blocks of the exact comparison: members of one hub's group, those linked
    # with the hub apart from the others, cut by number and by shingles.
    home = rest.groupBy("node").agg(
        F.max(F.struct("size", (-F.col("hub")).alias("hub"), "major")).alias("at"), F.first("component").alias("component")
    )
    nodes = home.join(sketches.select("node", "n"), "node").select(
        "node", "n", "component", F.col("at.hub").alias("home"), F.col("at.major").alias("near")
    )
    group = nodes.groupBy("home", "near").agg(F.count("*").alias("c"), F.sum("n").alias("total"))
    salts = group.select(
        "home", "near", F.greatest(F.ceil(F.col("c") / BLOCK_DOCS), F.ceil(F.col("total") / BLOCK_SHINGLES)).alias("salts")
    )
    nodes = tables.keep(
        nodes.join(salts, ["home", "near"]).select(
            "node",
            "n",
            "component",
            F.xxhash64("home", "near", F.pmod(F.xxhash64("node"), F.col("salts"))).alias("blk"),
        )
    )

    # Tiles: minor blocks against one another and against the major blocks.
    h = F.xxhash64("node", "band")
    mine = F.when(F.col("major"), F.pmod(h, F.col("b_blocks"))).otherwise(F.pmod(h, F.col("a_blocks")))
    upto = lambda c: F.sequence(F.lit(0).cast("bigint"), F.col(c) - 1)
    with_minor = F.transform(
        upto("a_blocks"), lambda j: _tile_of("band", "key", F.lit(0), F.least(j, mine), F.greatest(j, mine))
    )
    with_major = F.when(
        F.col("b_blocks") > 0, F.transform(upto("b_blocks"), lambda j: _tile_of("band", "key", F.lit(1), mine, j))
    ).otherwise(F.array().cast("array<bigint>"))
    of_major = F.transform(upto("a_blocks"), lambda i: _tile_of("band", "key", F.lit(1), i, mine))
    tiles = rest.select(
        "node", F.explode(F.when(F.col("major"), of_major).otherwise(F.concat(with_minor, with_major))).alias("tile")
    )
    tiles = tiles.join(nodes, "node").join(sketches.select("node", "bands"), "node")
    pairs = _shuffled(tiles, "tile").mapInArrow(frugal(_block_pairs), "a bigint, b bigint").distinct()

    pairs = tables.keep(pairs).withColumn("tile", F.xxhash64("a", "b"))
    held = pairs.select("tile", F.col("a").alias("blk")).union(
        pairs.where("a <> b").select("tile", F.col("b").alias("blk"))
    )
    exact = held.join(nodes, "blk").select("tile", "node", "component").join(sets, "node")
    return _shuffled(exact, "tile").mapInArrow(frugal(_block_links), "u bigint, v bigint")
