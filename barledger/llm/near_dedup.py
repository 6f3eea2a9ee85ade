"""Near-duplicate groups by SetSketch registers, verified on full shingle sets.

A register is the exponentially spaced, truncated minimum of exponential hash values of a document's shingles: registers
of a union are maxima of registers, and equal registers get likelier with the Jaccard similarity. Documents with equal
sets are one node. Nodes that agree in a band of registers are candidates; a likelihood over all registers, with both
set sizes known, estimates their similarity, and what may reach the threshold is verified on the sets. Within a band's
bucket nodes are compared with one leader, so that a group of thousands needs thousands of comparisons, and again with
the one that has fewest shingles of its own. What other components such a bucket still holds is settled without pairs of
all its nodes: sets that reach the similarity share one of their rarest shingles, and too many shingles that a node has
alone, or that only come after it, rule a pair out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barledger.llm.bytework import SPACE_WORDS, Texts, U64, Words, bounded, mixed, release, windows
from barledger.llm.shared import bound_batches, stored

WIDTH, PERCENT = 5, 80
#: Sizes of one class differ by this factor at most.
CLASS_RATIO = 1.02
BANDS, ROWS = 32, 4
REGISTERS = BANDS * ROWS
#: Base and rate of the registers' exponential spacing; registers are 16 bits wide.
SPACING, RATE = 1.02, 20.0
#: Standard errors by which an estimate may miss the threshold before a pair is dropped unverified.
MARGIN = 6.0
#: Ids of documents whose sets are needed that may be broadcast; beyond, texts are shuffled.
IDS = 500_000
#: Rows of edges that one task writes.
ROWS_A_TASK = 500_000


def shingle_sets(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles (56-bit hashes, ascending for each text) and the number of each text's."""
    texts = Texts(column, lower=True)
    words = Words(texts, SPACE_WORDS)
    whole = windows(words.hashes, width)
    at = np.flatnonzero(words.doc[: len(whole)] == words.doc[width - 1 :]) if len(whole) else np.zeros(0, np.int64)
    values, doc = [whole[at]], [words.doc[at]]
    for short in np.flatnonzero((words.counts > 0) & (words.counts < width)):
        a, b = words.first[short], words.first[short + 1]
        values.append(windows(words.hashes[a:b], b - a) ^ U64(b - a))
        doc.append(np.array([short]))
    values, doc = mixed(np.concatenate(values)) >> U64(8), np.concatenate(doc)
    out, counts = [], np.zeros(texts.n, dtype=np.int64)
    for low in range(0, texts.n, 256):  # a text's number within 256 fits above its shingles
        here = (doc >= low) & (doc < low + 256)
        keys = np.unique(values[here] | ((doc[here] - low).astype(U64) << U64(56)))
        of = (keys >> U64(56)).astype(np.int64)
        counts[low : low + 256] = np.bincount(of, minlength=256)[: texts.n - low]
        out.append(keys & U64((1 << 56) - 1))
    return np.concatenate(out) if out else np.zeros(0, dtype=U64), counts


def hash_family(m: int) -> tuple[np.ndarray, np.ndarray]:
    """Odd factors and summands of m hash functions."""
    seeds = mixed(np.arange(1, 2 * m + 1, dtype=U64))
    return seeds[:m] | U64(1), seeds[m:]


def registers_of(sets: np.ndarray, counts: np.ndarray, m: int = REGISTERS) -> np.ndarray:
    """m registers for each set that is not empty."""
    full = counts[counts > 0]
    if not len(full):
        return np.zeros((0, m), dtype=np.uint16)
    starts = np.cumsum(full) - full
    low = np.empty((len(full), m), dtype=U64)
    spread = mixed(sets)
    work = np.empty(len(sets), dtype=U64)
    with np.errstate(over="ignore"):
        for j, (factor, summand) in enumerate(zip(*hash_family(m), strict=True)):
            np.multiply(spread, factor, out=work)
            work += summand
            low[:, j] = np.minimum.reduceat(work, starts)
    share = (low.astype(np.float64) + 0.5) / 2.0**64
    value = -np.log1p(-np.minimum(share, 1 - 1e-15)) / RATE
    return np.clip(np.floor(1 - np.log(value) / np.log(SPACING)), 0, 65535).astype(np.uint16)


def differing(x: np.ndarray) -> np.ndarray:
    """The probability that a register exceeds the other one where the share x of the union's elements decides it."""
    return -np.log1p(-np.clip(x, 0, 1) * (SPACING - 1) / SPACING) / np.log(SPACING)


def estimates(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """The likeliest Jaccard similarity of each pair, on a grid, from the registers that are larger, smaller and equal."""
    more, less = (a > b).sum(axis=1), (a < b).sum(axis=1)
    same = a.shape[1] - more - less
    u, v = (n_a / (n_a + n_b))[:, None], (n_b / (n_a + n_b))[:, None]
    grid = np.linspace(0, 1, 101)[None, :] * np.minimum(u / v, v / u)
    up, down = differing(u - v * grid), differing(v - u * grid)
    tiny = 1e-12
    chance = (
        more[:, None] * np.log(np.maximum(up, tiny)) + less[:, None] * np.log(np.maximum(down, tiny))
        + same[:, None] * np.log(np.maximum(1 - up - down, tiny))
    )
    return np.take_along_axis(grid, chance.argmax(axis=1)[:, None], axis=1)[:, 0]


def text_key(text: str) -> Column:
    """A hash that tells texts under one id apart; of null it differs from that of the empty text."""
    return F.xxhash64(text, F.col(text).isNull())


def sketched(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, key, n, node (null for empty sets), registers of each row of docs (doc_id, text)."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def sketch(batches):
        release("packing")
        for batch in bounded(batches, 1):
            sets, counts = shingle_sets(batch.column(1), width)
            full = np.flatnonzero(counts)
            registers = registers_of(sets, counts)
            ends = np.cumsum(counts)
            node = np.zeros(len(counts), dtype=U64)
            with np.errstate(over="ignore"):
                if len(full):
                    total = np.add.reduceat(mixed(sets ^ U64(0x5851F42D4C957F2D)), (ends - counts)[full])
                    node[full] = mixed(total ^ mixed(counts[full].astype(U64)))
            blobs = np.full(len(counts), None, dtype=object)
            blobs[full] = [row.tobytes() for row in registers]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(2), pa.array(counts, pa.int64()),
                    pa.array(node.view(np.int64), mask=counts == 0), pa.array(blobs.tolist(), pa.binary()),
                ],
                ["doc_id", "key", "n", "node", "registers"],
            )

    return docs.select("doc_id", "text", text_key("text").alias("key")).mapInArrow(
        sketch, f"doc_id {kind}, key bigint, n bigint, node bigint, registers binary"
    )


def band_keys(registers: str = "registers") -> Column:
    """An array of one hash for each band."""
    return F.array(*(
        F.xxhash64(F.lit(i), F.substring(registers, 2 * ROWS * i + 1, 2 * ROWS)) for i in range(BANDS)
    ))


def alike(n_a: str, n_b: str, percent: int) -> Column:
    """Whether the sizes allow the similarity."""
    return F.least(n_a, n_b) * 100 >= F.greatest(n_a, n_b) * percent


def likely(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose estimate is within the margin of the threshold."""
    side = lambda x: nodes.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("registers").alias(f"r_{x}"))
    joined = pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b")
    bar = percent / 100
    bar -= MARGIN * np.sqrt(bar * (1 - bar) / REGISTERS)

    def keep(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = (
                np.frombuffer(b"".join(batch.column(x).to_pylist()), dtype=np.uint16).reshape(-1, REGISTERS)
                for x in ("r_a", "r_b")
            )
            n_a, n_b = batch.column("n_a").to_numpy(), batch.column("n_b").to_numpy()
            mask = estimates(a, b, n_a.astype(np.float64), n_b.astype(np.float64)) >= bar
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(mask))

    fits = alike("n_a", "n_b", percent)
    return joined.where(fits).mapInArrow(keep, "a bigint, b bigint")


def sets_of(wanted: DataFrame, docs: DataFrame, width: int) -> DataFrame:
    """node and set (ascending 64-bit integers in bytes) of the wanted (node, rep, key), one row for each node.

    Ids may be null or repeated, so that a node's text is found by its id and the key of the text.
    """
    wanted = stored(wanted, "wanted")
    few = wanted.limit(IDS + 1).count() <= IDS
    keyed = docs.select("doc_id", "text", text_key("text").alias("text_key"))
    same = keyed["doc_id"].eqNullSafe(wanted["rep"]) & (keyed["text_key"] == wanted["key"])
    kept = keyed.join(F.broadcast(wanted) if few else wanted, same)

    def build(batches):
        seen = set()
        for batch in bounded(batches, 1):
            fresh = []
            for node in batch.column(0).to_pylist():
                fresh.append(node not in seen)
                seen.add(node)
            batch = batch.filter(pa.array(fresh, pa.bool_()))
            sets, counts = shingle_sets(batch.column(1), width)
            pieces = np.split(sets, np.cumsum(counts)[:-1]) if len(counts) else []
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([x.tobytes() for x in pieces], pa.binary())], ["node", "set"]
            )

    sets = stored(kept.select("node", "text").mapInArrow(build, "node bigint, set binary"), "sets")
    again = sets.groupBy("node").agg(F.count(F.lit(1)).alias("times")).where("times > 1")
    # rows that repeat an id and text in several tasks
    return stored(sets.dropDuplicates(["node"]), "sets") if again.take(1) else sets


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets reach the similarity."""
    side = lambda x: sets.select(F.col("node").alias(x), F.col("set").alias(f"set_{x}"))

    def link(batches):
        for batch in batches:
            mask = []
            for a, b in zip(batch.column("set_a").to_pylist(), batch.column("set_b").to_pylist(), strict=True):
                a, b = np.frombuffer(a, dtype=U64), np.frombuffer(b, dtype=U64)
                both = np.sort(np.concatenate([a, b]))
                inner = int((both[1:] == both[:-1]).sum())
                mask.append(100 * inner >= percent * (len(a) + len(b) - inner))
            out = pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"])
            yield out.filter(pa.array(mask, pa.bool_()))

    return pairs.join(side("b"), "b").join(side("a"), "a").mapInArrow(link, "a bigint, b bigint").distinct()


def is_forest_of_stars(edges: DataFrame) -> bool:
    """Whether each u of the edges (u, v < u) has one v and none is itself a v: then v is its component's smallest."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("u").alias("node"), F.lit(1).alias("up")),
                                          F.struct(F.col("v").alias("node"), F.lit(0).alias("up")))).alias("e"))
    seen = ends.groupBy("e.node").agg(F.sum("e.up").alias("ups"), F.min("e.up").alias("least"))
    return seen.where("ups > 1 OR (ups = 1 AND least = 0)").limit(1).count() == 0


def components(edges: DataFrame) -> DataFrame:
    """node, root (the smallest node reachable) of each node with an edge, by alternating star contraction.

    Contraction never adds edges, so the tables are written by as many tasks as the first has rows for.
    """
    edges = stored(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v"), "edges")
    parts = 1 + edges.count() // ROWS_A_TASK
    while not is_forest_of_stars(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stored(large.distinct().coalesce(parts), "large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e"))
        small = small.select(F.col("e.v").alias("u"), F.col("e.m").alias("v")).where("u <> v").distinct()
        edges = stored(small.coalesce(parts), "small")
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    centres = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return stored(roots.unionByName(centres).coalesce(parts), "roots")


def rooted(rows: DataFrame, roots: DataFrame | None) -> DataFrame:
    """rows (node, …) with the root of the node's component."""
    if roots is None:
        return rows.withColumn("root", F.col("node"))
    joined = rows.join(roots, "node", "left")
    return joined.withColumn("root", F.coalesce("root", "node"))


def open_buckets(entries: DataFrame) -> DataFrame:
    """entries (band, node, root, …) of bands that hold more than one component."""
    several = entries.groupBy("band").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y")
    return entries.join(stored(several.select("band"), "several"), "band", "left_semi")


def star_pairs(entries: DataFrame, order: Column, percent: int) -> DataFrame:
    """For each node the leader of other components, first in order in its bands, that it meets in most bands."""
    lead = F.struct(order.alias("order"), "node", "n", "root")
    leaders = stored(entries.groupBy("band").agg(F.min(lead).alias("lead")), "leaders")
    met = entries.join(leaders, "band").where((F.col("root") != F.col("lead.root")) & alike("n", "lead.n", percent))
    counted = met.groupBy("node", F.col("lead.node").alias("leader")).agg(F.count(F.lit(1)).alias("bands"))
    best = counted.groupBy("node").agg(F.max_by("leader", F.struct("bands", "leader")).alias("leader"))
    return best.select(F.col("leader").alias("a"), F.col("node").alias("b"))


def rarest(nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """node, n, own, first of the nodes (node, n) that may have a link among them.

    `own` counts the shingles that no other node has. A set of n that reaches the similarity with another one has at
    least percent of n shingles in common with it, so of its n - that + 1 rarest ones both have one; `first` are those
    of them that are not its own, rarest first.
    """

    def explode(batches):
        for batch in batches:
            pieces = [np.frombuffer(x, dtype=np.int64) for x in batch.column(1).to_pylist()]
            of = np.repeat(np.arange(len(pieces)), [len(x) for x in pieces])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(of)), pa.array(np.concatenate([*pieces, np.zeros(0, np.int64)]))],
                ["node", "band"],
            )

    rows = sets.join(nodes.select("node"), "node", "left_semi").mapInArrow(explode, "node bigint, band bigint")
    rows = stored(rows, "shingles")
    # rare is relative to the nodes that are compared
    times = stored(rows.groupBy("band").agg(F.count(F.lit(1)).alias("times")).where("times > 1"), "times")
    shared = rows.join(times, "band").groupBy("node").agg(
        F.sort_array(F.collect_list(F.struct("times", "band"))).alias("shared")
    )
    need = F.ceil(F.col("n") * percent / 100)
    size = F.size("shared")
    return shared.join(nodes, "node").where(size >= need).select(
        "node", "n", (F.col("n") - size).alias("own"), F.slice("shared", 1, (size - need + 1).cast("int")).alias("first")
    )


def prefixes(rare: DataFrame) -> DataFrame:
    """band (a shingle), node, n, root, rest for the rows of rare, with roots.

    No more than the `rest` shingles from the row's one on are in common with a node that shares none before it.
    """
    return rare.select("node", "n", "root", "own", F.posexplode("first").alias("at", "one")).select(
        F.col("one.band").alias("band"), "node", "n", "root", (F.col("n") - F.col("own") - F.col("at")).alias("rest")
    )


def usable(entries: DataFrame, percent: int) -> DataFrame:
    """entries (band, node, n, root, rest) with `own_class` and `other`, once for each class of sizes they may meet.

    A class holds sizes within CLASS_RATIO. What a node may reach with the smallest size and the largest `rest` of a
    class under its band decides before any pair is made: nodes of one size that share a template, but less of it than
    the similarity needs, meet nobody.
    """
    sized = entries.withColumn("own_class", F.floor(F.log("n") / F.log(F.lit(CLASS_RATIO))))
    classes = sized.groupBy("band", F.col("own_class").alias("other")).agg(
        F.min("n").alias("least"), F.max("rest").alias("most"), F.min("root").alias("x"), F.max("root").alias("y")
    )
    reach = F.least("rest", "most")
    fits = reach * 100 >= (F.col("n") + F.greatest("least", reach) - reach) * percent
    # a class of one component alone has no pair within it
    another = (F.col("other") != F.col("own_class")) | (F.col("x") != F.col("y"))
    met = sized.join(stored(classes, "classes"), "band").where(fits & another)
    return met.select("band", "node", "n", "root", "rest", "own_class", "other")


def cross_pairs(entries: DataFrame, percent: int) -> DataFrame:
    """Pairs of nodes of different components under one band whose sizes allow the similarity.

    Only nodes outside the component that has most of a band's nodes are joined with the others.
    """
    entries = stored(usable(entries, percent), "usable")
    by_root = entries.groupBy("band", "root").agg(F.count(F.lit(1)).alias("c"))
    main = by_root.groupBy("band").agg(F.max_by("root", F.struct("c", "root")).alias("main"))
    outside = entries.join(stored(main, "main"), "band").where("root <> main")
    outside = outside.select(
        "band", *(F.col(c).alias(f"{c}_x") for c in ("node", "n", "root", "rest")), F.col("own_class").alias("other"),
        F.col("other").alias("own_class"),
    )
    most = F.least("rest", "rest_x")
    fits = (F.col("root") != F.col("root_x")) & (most * 100 >= (F.col("n") + F.col("n_x") - most) * percent)
    pairs = stored(outside, "outside").join(entries, ["band", "own_class", "other"]).where(fits)
    return pairs.select(F.least("node_x", "node").alias("a"), F.greatest("node_x", "node").alias("b")).distinct()


def link_nodes(nodes: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame | None:
    """Roots of all nodes with a link, None without any."""
    exploded = nodes.select(F.explode(band_keys()).alias("band"), "node", "n")
    shared = exploded.groupBy("band").agg(F.min("node").alias("x"), F.max("node").alias("y")).where("x <> y")
    entries = stored(exploded.join(stored(shared.select("band"), "bands"), "band", "left_semi"), "entries")
    if not entries.take(1):
        return None
    nodes = stored(nodes.join(entries.select("node").distinct(), "node", "left_semi"), "candidates")
    sets = sets_of(nodes.select("node", "rep", "key"), docs, width)
    edges, roots, rare = None, None, None
    for turn in ("any leader", "central leader", "rare shingles"):
        if turn == "any leader":
            pairs = star_pairs(rooted(entries, None), F.xxhash64("node"), percent)
        else:
            held = stored(open_buckets(rooted(entries, roots)), "held")
            if not held.take(1):
                break
            if turn == "central leader":
                rare = stored(rarest(held.select("node", "n").distinct(), sets, percent), "rare")
                central = stored(held.join(rare.select("node", "own"), "node"), "central")
                pairs = star_pairs(central, F.col("own") / F.col("n"), percent)
            else:
                kept = rare.join(held.select("node").distinct(), "node", "left_semi")
                pairs = cross_pairs(stored(open_buckets(stored(prefixes(rooted(kept, roots)), "first")), "open"), percent)
        pairs = stored(likely(stored(pairs, "met"), nodes, percent), "pairs")
        found = stored(verified(pairs, sets, percent), "links")
        if found.take(1):
            edges = found if edges is None else edges.unionByName(found)
            roots = components(edges)
    return roots


def group(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, percent: int = PERCENT
) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row for each row of docs.

    Words are split at white space, A-Z lower-cased; a text of fewer than `width` words is one shingle. Two texts are
    linked if 100 * shared >= percent * united shingles; component_id is the smallest doc_id reachable over links, and
    kept says whether it is the row's own. Null and empty texts, and texts of white space, have no shingles and are kept
    alone. Rows with equal sets are linked without comparison; rows that repeat an id and text are all kept or none.
    A null doc_id comes last in the order of ids, a group of them keeps all. Other columns are not read. An empty table
    gives no rows.
    """
    return keyed_groups(docs, id_col, text_col, width, percent).drop("key")


def keyed_groups(docs: DataFrame, id_col: str, text_col: str, width: int, percent: int) -> DataFrame:
    """The rows of group with the key of each row's text, by which rows under one id are told apart."""
    bound_batches(docs.sparkSession)
    picked = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows = stored(sketched(picked, width), "sketches")
    nodes = rows.where("node IS NOT NULL").groupBy("node").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "key")).alias("least"),
        F.first("n").alias("n"), F.first("registers").alias("registers"),
    ).select("node", F.col("least.doc_id").alias("rep"), F.col("least.key").alias("key"), "n", "registers")
    nodes = stored(nodes, "nodes")
    roots = link_nodes(nodes, picked, width, percent)
    linked = rooted(nodes.select("node", "rep"), roots)
    least = linked.groupBy("root").agg(F.min("rep").alias("least"))
    labels = stored(linked.join(least, "root").select("node", "least"), "labels")
    joined = rows.select("doc_id", "key", "n", "node").join(labels, "node", "left")
    component = F.coalesce("least", "doc_id")
    return joined.select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"), "key",
    )
