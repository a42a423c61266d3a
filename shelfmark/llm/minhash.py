"""MinHash near-duplicates by SuperMinHash.

A document's set is its distinct shingles. SuperMinHash gives every shingle a
random permutation of the signature's places; in step j it bids j plus a random
fraction for the j-th place of its permutation, and a place keeps the least bid.
Two signatures agree at a place with the sets' Jaccard similarity, as with
MinHash, but as one shingle spreads over different places the estimate varies
less. A place that got a bid in step j can't get a lower one later, so a document
is finished as soon as all its places have one: a few steps for long texts.

Documents with equal sets are one node. Signatures are cut into bands; nodes that
agree in a whole band share a bucket and may be linked. A pair at the threshold of
0.85 misses all 32 bands of 5 places with probability 7e-9, one at 0.9 with 3e-13.
Links are confirmed on the full sets, in three steps that never write out all
pairs of a bucket:

1. In every bucket each node is compared with one of them, its hub. Linked nodes
   are grouped (union-find by star contraction). This makes one group of most
   nodes of a large cluster, at a comparison per node and bucket.
2. Hubs have met everybody and leave; buckets that are one group by now are
   settled: what links are left in them would join nothing.
3. Nodes of the others are compared with all they share a bucket with, in cells
   of two blocks of bounded size: by bucket, or by family (all that buckets
   connect), whichever ships fewer rows. A cell counts the shingles that two nodes
   share by an inverted index and gives at most one link a node.

So every link between different groups is found wherever a band agrees, and work
follows the pairs in doubt.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import give_back_memory, stored
from shelfmark.llm.components import connected_components

SHINGLE_WORDS = 3
PERCENT = 85
BANDS, ROWS = 32, 5
PLACES = BANDS * ROWS
SEED = 12
BLOCK_NODES = 1024
BLOCK_SHINGLES = 1 << 20
# Texts are first told apart by so many values of their hash: few enough to be sent to every task.
SLOTS = 1 << 20
ELEMENTS_AT_ONCE = 1 << 16
# The constants of the splitmix64 generator; fixed values.
GOLDEN, MIX_1, MIX_2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
FREE = np.uint64((1 << 64) - 1)
HALF = np.uint64(32)
LOW = np.uint64((1 << 32) - 1)

SIGNED = pa.schema(
    [
        ("doc_id", pa.int64()), ("text_key", pa.int64()), ("n_shingles", pa.int64()),
        ("set_a", pa.int64()), ("set_b", pa.int64()), ("bands", pa.list_(pa.int64())),
    ]
)
SIGNED_DDL = "doc_id long, text_key long, n_shingles long, set_a long, set_b long, bands array<long>"


def shingle_hashes(text: str | None, words_per_shingle: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles; with too few words the whole sequence is one."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    rest = [words[i:] for i in range(min(words_per_shingle, len(words)))]
    digest = xxhash.xxh3_64_digest
    return np.unique(np.frombuffer(b"".join([digest(b" ".join(s)) for s in zip(*rest)]), ">u8").astype(np.uint64))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * MIX_1
    x = (x ^ (x >> np.uint64(27))) * MIX_2
    return x ^ (x >> np.uint64(31))


def stepped(elements: np.ndarray, step: int) -> np.ndarray:
    """The random number of each element in a step."""
    return _mixed(elements + np.uint64((SEED + int(GOLDEN) * (step + 1)) % (1 << 64)))


def _bids(elements: np.ndarray, owners: np.ndarray, n: int, places: int) -> np.ndarray:
    """Signatures of ``n`` sets from (element, owner): step in the upper, fraction in the lower half of a number."""
    out = np.full(n * places, FREE)
    order = np.tile(np.arange(places, dtype=np.uint16), (len(elements), 1))
    active = np.arange(len(elements))
    for step in range(places):
        x = stepped(elements[active], step)
        drawn = (step + (((x & LOW) * np.uint64(places - step)) >> HALF)).astype(np.int64)
        place = order[active, drawn]
        order[active, drawn] = order[active, step]
        np.minimum.at(out, owners[active] * places + place, np.uint64(step << 32) | (x >> HALF))
        open_ = (out.reshape(n, places) == FREE).any(axis=1)
        active = active[open_[owners[active]]]
        if not len(active):
            break
    return out.reshape(n, places)


def signatures(sets: list[np.ndarray], places: int = PLACES) -> np.ndarray:
    """SuperMinHash of each set, a row of ``places`` numbers. Long sets go in parts, of which the least bids count."""
    out = np.full((len(sets), places), FREE)
    pieces, held = [], 0

    def finish() -> None:
        owners = [i for i, _ in pieces]
        sizes = [len(p) for _, p in pieces]
        got = _bids(np.concatenate([p for _, p in pieces]), np.repeat(np.arange(len(pieces)), sizes), len(pieces), places)
        np.minimum.at(out, owners, got)
        pieces.clear()

    for i, one in enumerate(sets):
        for start in range(0, len(one), ELEMENTS_AT_ONCE):
            piece = one[start : start + ELEMENTS_AT_ONCE]
            if pieces and held + len(piece) > ELEMENTS_AT_ONCE:
                finish()
                held = 0
            pieces.append((i, piece))
            held += len(piece)
    if pieces:
        finish()
    return out


def band_keys(signature: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """One 64-bit number per row and band; equal if all places of the band are."""
    places = signature.reshape(len(signature), bands, -1)
    keys = np.broadcast_to(_mixed(np.arange(1, bands + 1, dtype=np.uint64) * GOLDEN), places.shape[:2])
    for r in range(places.shape[2]):
        keys = _mixed((keys ^ places[:, :, r]) * MIX_2 + GOLDEN)
    return keys.view(np.int64)


def _identity(shingles: np.ndarray) -> np.ndarray:
    return np.frombuffer(xxhash.xxh3_128_digest(shingles.tobytes(), SEED), np.int64)


def _signed(words_per_shingle: int):
    def sign(batches):
        for batch in batches:
            texts = batch.column("text")
            for start in range(0, len(batch), 256):
                sets = [shingle_hashes(t, words_per_shingle) for t in texts[start : start + 256].to_pylist()]
                keys = band_keys(signatures(sets))
                names = np.array([_identity(s) for s in sets]).reshape(len(sets), 2)
                part = batch.slice(start, len(sets))
                full = [len(s) > 0 for s in sets]
                offsets = np.concatenate([[0], np.cumsum(np.where(full, BANDS, 0))]).astype(np.int32)
                bands = pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys[full].ravel()))
                columns = [part.column("doc_id"), part.column("text_key"), pa.array([len(s) for s in sets], pa.int64())]
                columns += [pa.array(names[:, 0]), pa.array(names[:, 1]), bands]
                yield pa.RecordBatch.from_arrays(columns, schema=SIGNED)
        give_back_memory()

    return sign


def _full_sets(words_per_shingle: int):
    out = pa.schema([("node", pa.int64()), ("shingles", pa.list_(pa.int64()))])

    def read(batches):
        for batch in batches:
            wanted = zip(*(batch.column(c).to_pylist() for c in ("node", "set_a", "set_b")))
            for text, (node, a, b) in zip(batch.column("text"), wanted):
                shingles = shingle_hashes(text.as_py(), words_per_shingle)
                if tuple(_identity(shingles)) != (a, b):
                    continue  # another text with the same hash
                held = pa.ListArray.from_arrays(pa.array([0, len(shingles)], pa.int32()), pa.array(shingles.view(np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array([node]), held], schema=out)
        give_back_memory()

    return read


def _sets_of(rows: DataFrame, wanted: DataFrame, words_per_shingle: int) -> DataFrame:
    """(node, shingles) of the wanted nodes, from their texts, stored.

    Most texts are passed over where they are read, by a table of hash values that
    has at most SLOTS rows; copies are dropped before a text is read again.
    """
    slot = F.pmod("text_key", F.lit(SLOTS)).cast("int")
    slots = wanted.select(slot.alias("slot")).distinct()
    texts = rows.withColumn("slot", slot).join(F.broadcast(slots), "slot", "left_semi").join(wanted, "text_key")
    once = texts.select("node", "set_a", "set_b", "text").dropDuplicates(["node", "text"])
    return stored(once.mapInArrow(_full_sets(words_per_shingle), "node long, shingles array<long>"), "sets")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(u, v) of the pairs whose full sets are similar enough; sizes are compared first."""
    sizes = sets.select("node", F.size("shingles").alias("n"))
    fit = (
        pairs.join(sizes.withColumnsRenamed({"node": "u", "n": "n_u"}), "u")
        .join(sizes.withColumnsRenamed({"node": "v", "n": "n_v"}), "v")
        .where(100 * F.least("n_u", "n_v") >= percent * F.greatest("n_u", "n_v"))
    )
    both = fit.join(sets.withColumnsRenamed({"node": "u", "shingles": "s_u"}), "u").join(
        sets.withColumnsRenamed({"node": "v", "shingles": "s_v"}), "v"
    )
    shared = F.size(F.array_intersect("s_u", "s_v"))
    return (
        both.select("u", "v", "n_u", "n_v", shared.alias("shared"))
        .where(100 * F.col("shared") >= percent * (F.col("n_u") + F.col("n_v") - F.col("shared")))
        .select("u", "v")
    )


def _unsettled(members: DataFrame, links: DataFrame) -> DataFrame:
    """``members`` of the buckets that hold several groups; stored."""
    roots = stored(connected_components(links), "groups").withColumnRenamed("node", "rooted")
    labelled = members.join(roots, F.col("node") == F.col("rooted"), "left").select(
        "bucket", "node", F.coalesce("root", "node").alias("group")
    )
    labelled = stored(labelled, "labelled")
    groups = labelled.groupBy("bucket").agg(F.min("group").alias("least"), F.max("group").alias("most"))
    mixed = stored(groups.where("least < most").select("bucket"), "mixed")
    return stored(labelled.join(mixed, "bucket").select("bucket", "node"), "unsettled")


def _hubs(members: DataFrame) -> DataFrame:
    """(bucket, hub): one node of each, by one order for all buckets, so that pairs repeat.

    Written: a join with an aggregate under it could not split a hot bucket.
    """
    one = F.min(F.struct(F.xxhash64("node").alias("rank"), "node")).alias("hub")
    return stored(members.groupBy("bucket").agg(one).select("bucket", F.col("hub.node").alias("hub")), "hubs")


def _star(members: DataFrame, hubs: DataFrame) -> DataFrame:
    """(u, v): each node with the hub of its bucket."""
    met = members.join(hubs, "bucket").where(F.col("node") != F.col("hub"))
    return met.select(F.least("node", "hub").alias("u"), F.greatest("node", "hub").alias("v")).distinct()


class Groups:
    """Union-find over any labels."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def find(self, x: int) -> int:
        root = x
        while (above := self.up.get(root, root)) != root:
            root = above
        while x != root:
            self.up[x], x = root, self.up.get(x, x)
        return root

    def unite(self, x: int, y: int) -> bool:
        x, y = self.find(x), self.find(y)
        if x != y:
            self.up[max(x, y)] = min(x, y)
        return x != y


def linked_in_cell(rows: list[tuple], across: bool, percent: int):
    """(u, v): each node with the first of its group; rows are (node, block, sorted distinct shingles).

    ``across``: only pairs of different blocks; those of one block have a cell of
    their own. All overlaps of a node are counted at once, by the lists of nodes
    that hold its shingles.
    """
    sizes = np.array([len(r[2]) for r in rows])
    blocks = np.array([r[1] for r in rows])
    _, words = np.unique(np.concatenate([r[2] for r in rows]), return_inverse=True)
    owners = np.repeat(np.arange(len(rows)), sizes)
    order = np.argsort(words, kind="stable")
    holders = owners[order]
    ends = np.cumsum(np.bincount(words))
    starts = ends - np.bincount(words)
    at, groups = 0, Groups()
    for v in range(len(rows)):
        mine = words[at : at + sizes[v]]
        at += sizes[v]
        spans = ends[mine] - starts[mine]
        places = np.arange(spans.sum()) - np.repeat(np.cumsum(spans) - spans, spans) + np.repeat(starts[mine], spans)
        shared = np.bincount(holders[places], minlength=len(rows))[:v]
        alike = 100 * shared >= percent * (sizes[:v] + sizes[v] - shared)
        if across:
            alike &= blocks[:v] != blocks[v]
        for u in np.flatnonzero(alike).tolist():
            groups.unite(u, v)
    for v in range(len(rows)):
        if (u := groups.find(v)) != v:
            yield rows[u][0], rows[v][0]


def _cells(percent: int):
    out = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def found(cell, rows):
        links = list(linked_in_cell(rows, cell[-1] != cell[-2], percent))
        return pa.RecordBatch.from_arrays([pa.array([p[k] for p in links], pa.int64()) for k in (0, 1)], schema=out)

    def compare(batches):
        cell, rows = None, []
        for batch in batches:
            keys = list(zip(*(batch.column(c).to_pylist() for c in ("by_family", "unit", "low", "high"))))
            nodes, blocks = (batch.column(c).to_pylist() for c in ("node", "block"))
            lists = batch.column("shingles")
            flat, offsets = lists.values.to_numpy(), lists.offsets.to_numpy()
            for i, key in enumerate(keys):
                if key != cell:
                    if rows:
                        yield found(cell, rows)
                    cell, rows = key, []
                rows.append((nodes[i], blocks[i], flat[offsets[i] : offsets[i + 1]].copy()))
        if rows:
            yield found(cell, rows)
        give_back_memory()

    return compare


def _units(unsettled: DataFrame, sizes: DataFrame) -> DataFrame:
    """(by_family, unit, blocks, node): the nodes to compare with each other, stored.

    A family, all nodes that unsettled buckets connect, is one unit or a unit for
    each of its buckets: what makes fewer rows, counting every row once for each
    block that its unit is cut into.
    """
    family = stored(connected_components(_star(unsettled, _hubs(unsettled))), "families")
    roots = family.groupBy("root").agg(F.count("*")).select(F.col("root").alias("node"), "root")
    family = stored(family.unionByName(roots), "family-of")
    blocks = F.ceil(F.count("*") / BLOCK_NODES + F.sum("n") / BLOCK_SHINGLES).cast("int")
    labelled = stored(unsettled.join(family, "node").join(sizes, "node"), "labelled")
    by_bucket = stored(
        labelled.groupBy("bucket", "root").agg(blocks.alias("blocks"), F.count("*").alias("held")), "bucket-blocks"
    )
    apart = by_bucket.groupBy("root").agg(F.sum(F.col("held") * F.col("blocks")).alias("apart"))
    together = family.join(sizes, "node").groupBy("root").agg(blocks.alias("blocks"), F.count("*").alias("held"))
    choice = stored(
        together.join(apart, "root").select(
            "root", (F.col("held") * F.col("blocks") <= F.col("apart")).alias("by_family"), "blocks"
        ),
        "choice",
    )
    whole = family.join(choice.where("by_family"), "root").select("by_family", F.col("root").alias("unit"), "blocks", "node")
    split = (
        labelled.select("bucket", "root", "node")
        .join(choice.where("not by_family").select("root", "by_family"), "root")
        .join(by_bucket.select("bucket", "blocks"), "bucket")
        .select("by_family", F.col("bucket").alias("unit"), "blocks", "node")
    )
    return stored(whole.unionByName(split), "units")


def _in_cells(unsettled: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(u, v): links among the nodes of each unsettled bucket, block by block."""
    units = _units(unsettled, sets.select("node", F.size("shingles").alias("n")))
    dealt = (
        units.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "by_family", "unit", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
            "node", "block",
        )
    )
    cell = ["by_family", "unit", "low", "high"]
    full = dealt.join(sets, "node")
    return full.repartition(*cell).sortWithinPartitions(*cell).mapInArrow(_cells(percent), "u long, v long")


def near_duplicates(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id",
    words_per_shingle: int = SHINGLE_WORDS, percent: int = PERCENT,
) -> DataFrame:
    """A row per document: doc_id, n_shingles, component_id, kept.

    Documents are linked when the sets of their distinct shingles (words in a row,
    A-Z lower-cased; the whole sequence where there are fewer words) have a
    Jaccard similarity of ``percent`` or more. component_id is the smallest doc_id
    that links reach, itself included; kept is doc_id = component_id.

    Null texts and those without words have an empty set, are linked with nothing
    and kept. Null ids take part but are nobody's component_id, which is null where
    a component has no other; such rows are kept. Rows with a repeated id are
    documents of their own. Shingles are told apart by 64-bit hashes, sets by 128
    bits. No rows: no rows.
    """
    rows = docs.select(
        F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.xxhash64(F.col(f"`{text}`")).alias("text_key"),
        F.col(f"`{text}`").alias("text"),
    )
    signed = stored(rows.mapInArrow(_signed(words_per_shingle), SIGNED_DDL), "signatures")
    name = ["set_a", "set_b"]
    nodes = signed.where("n_shingles > 0").groupBy(*name).agg(
        F.min("doc_id").alias("least_id"), F.min("text_key").alias("text_key"), F.first("bands").alias("bands")
    )
    nodes = stored(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")

    posted = nodes.select("node", F.explode("bands").alias("bucket"))
    shared = posted.groupBy("bucket").agg(F.min("node").alias("a"), F.max("node").alias("b")).where("a < b")
    members = stored(posted.join(stored(shared.select("bucket"), "buckets"), "bucket"), "members")

    wanted = nodes.join(members.select("node"), "node", "left_semi").select("node", "text_key", *name)
    sets = _sets_of(rows, stored(wanted, "wanted"), words_per_shingle)

    hubs = _hubs(members)
    links = stored(_confirmed(stored(_star(members, hubs), "met"), sets, percent), "links")
    # A hub has met all others of its bucket.
    others = members.join(hubs, "bucket").where(F.col("node") != F.col("hub")).select("bucket", "node")
    unsettled = _unsettled(stored(others, "others"), links)
    links = stored(links.unionByName(_in_cells(unsettled, sets, percent)), "links")

    roots = stored(connected_components(links), "roots").withColumnRenamed("node", "rooted")
    rooted = stored(
        nodes.join(roots, F.col("node") == F.col("rooted"), "left").select(
            *name, "least_id", F.coalesce("root", "node").alias("root")
        ),
        "rooted",
    )
    least = stored(rooted.groupBy("root").agg(F.min("least_id").alias("component_id")), "components")
    classes = stored(rooted.join(least, "root").select(*name, "component_id"), "classes")
    empty = F.col("n_shingles") == 0
    own = F.when(empty, F.col("doc_id")).otherwise(F.col("component_id"))
    return (
        signed.join(classes, name, "left")
        .withColumn("component_id", own)
        .select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
    )


NEAR_SQL = r"""
with recursive words as (
  select doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
  from documents
), sets as (
  select doc_id, list_distinct(case when len(w) >= 3
    then list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])
    when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as s
  from words
), flat as (
  select doc_id, len(s) as n, unnest(s) as shingle from sets
), links as (
  select a.doc_id as u, b.doc_id as v
  from flat a join flat b on a.shingle = b.shingle and a.doc_id <> b.doc_id
  group by a.doc_id, b.doc_id, a.n, b.n having 100 * count(*) >= 85 * (a.n + b.n - count(*))
), reached as (
  select doc_id, doc_id as other from sets
  union
  select r.doc_id, l.v from reached r join links l on r.other = l.u
)
select s.doc_id, len(any_value(s.s)) as n_shingles, min(r.other) as component_id, s.doc_id = min(r.other) as kept
from sets s join reached r using (doc_id) group by s.doc_id
"""
