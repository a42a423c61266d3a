"""The trie of conversation prefixes, in balanced parentheses.

A conversation is the list of its turns' 16-byte digests, so that sorted lists
are the trie in preorder. They are dealt by ranges of (list, id): a shard holds
one stretch of the order, also of equal conversations, however many there are.

A shard writes its part of the trie as parentheses, one pair a node. The excess
(open minus closed) is kept in blocks with a tree of their least and greatest
values: ``findclose`` looks for the first place where the excess falls below
that of an opening, in its own block, then up and down the tree to the block
that holds it. A node and its close delimit the subtree; leaves in it are a
difference of ranks of "()", members and savings differences of cumulative
arrays in preorder.

Nodes that a shard may share with others are the prefixes of its first and of
its last conversation, its spines. Everything else is whole and final. Spines
are merged by the digest of their prefix; what hangs off them is summed up
along them in rounds that double the distance.

A conversation's digests (16 bytes a turn, and a number) must fit into one value.
"""

from __future__ import annotations

import hashlib
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import give_back_memory, stored

DIGEST = 16
BLOCK = 64
SHARD_TURNS = 1 << 20
ENDS_A_ROW = 4096
EMPTY = hashlib.sha256(b"").hexdigest()
# A whole node, the part of a spine node, ids that end at a spine node.
NODE, SPINE, ENDS = 0, 1, 2

PARTS = pa.schema(
    [
        ("kind", pa.int32()), ("key", pa.binary()), ("parent", pa.binary()), ("conv_id", pa.int64()),
        ("depth", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()),
        ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("chars", pa.int64()), ("ends_sha256", pa.string()),
        ("ids", pa.list_(pa.int64())),
    ]
)
PARTS_DDL = (
    "kind int, key binary, parent binary, conv_id long, depth long, parent_conv_id long, n_convs long, "
    "n_children long, n_leaves long, saved_tokens long, chars long, ends_sha256 string, ids array<long>"
)
RESULT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


class Parentheses:
    """Balanced parentheses with a range min-max tree over blocks of their excess."""

    def __init__(self, opens: np.ndarray):
        self.opens = opens
        excess = np.cumsum(np.where(opens, 1, -1), dtype=np.int64)
        blocks = -(-len(excess) // BLOCK)
        # What follows the end is higher than anything looked for.
        self.excess = np.full((blocks, BLOCK), len(opens) + 1, np.int64)
        self.excess.reshape(-1)[: len(excess)] = excess
        self.least, self.most = [self.excess.min(axis=1)], [self.excess.max(axis=1)]
        while len(self.least[-1]) > 1:
            pairs = np.arange(0, len(self.least[-1]), 2)
            self.least.append(np.minimum.reduceat(self.least[-1], pairs))
            self.most.append(np.maximum.reduceat(self.most[-1], pairs))

    def _holds(self, level: int, node: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        inside = node < len(self.least[level])
        at = np.where(inside, node, 0)
        return inside & (self.least[level][at] <= wanted) & (wanted <= self.most[level][at])

    def _in_block(self, block: np.ndarray, after: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        """The first place past ``after`` in the block with the wanted excess, or -1."""
        out = np.empty(len(block), np.int64)
        places = np.arange(BLOCK)
        for start in range(0, len(block), 1 << 14):
            part = slice(start, start + (1 << 14))
            hit = (self.excess[block[part]] == wanted[part, None]) & (places > after[part, None])
            out[part] = np.where(hit.any(axis=1), hit.argmax(axis=1), -1)
        return out

    def findclose(self, at: np.ndarray) -> np.ndarray:
        """For each opening in ``at`` the place of its closing parenthesis."""
        block, wanted = at // BLOCK, self.excess.reshape(-1)[at] - 1
        place = self._in_block(block, at % BLOCK, wanted)
        out = block * BLOCK + place
        far = np.flatnonzero(place < 0)
        wanted, node = wanted[far], block[far].copy()
        found_at = np.full(len(far), -1)
        for level in range(len(self.least)):  # up, to the first block on the right that holds it
            here = (found_at < 0) & (node % 2 == 0) & self._holds(level, node + 1, wanted)
            found_at[here] = level
            node[here] += 1
            rising = found_at < 0
            node[rising] //= 2
        for level in range(len(self.least) - 1, 0, -1):  # down, to its leftmost part
            down = np.flatnonzero(found_at >= level)
            left = 2 * node[down]
            node[down] = np.where(self._holds(level - 1, left, wanted[down]), left, left + 1)
        out[far] = node * BLOCK + self._in_block(node, np.full(len(far), -1), wanted)
        return out

    def leaf_rank(self) -> np.ndarray:
        """How many pairs "()" open before each place."""
        leaves = self.opens[:-1] & ~self.opens[1:]
        return np.concatenate([[0], np.cumsum(leaves)])


def common(a: bytes, b: bytes) -> int:
    """How many digests a and b begin with alike."""
    low, high = 0, min(len(a), len(b)) // DIGEST
    while low < high:
        middle = (low + high + 1) // 2
        at = DIGEST * low, DIGEST * middle
        low, high = (middle, high) if a[slice(*at)] == b[slice(*at)] else (low, middle - 1)
    return low


class Shard:
    """The trie of one sorted stretch of conversations; arrays by node, in preorder."""

    def __init__(self, paths: list[bytes], ids: np.ndarray, chars: list[np.ndarray]):
        depth = np.array([len(p) // DIGEST for p in paths])
        shared = np.array([0] + [common(a, b) for a, b in zip(paths, paths[1:])])
        fresh = depth - shared
        before = np.concatenate([[0], depth[:-1]])
        counts = np.column_stack([before - shared, fresh]).ravel()
        runs = np.concatenate([[1], counts, [depth[-1] + 1]])
        kinds = np.concatenate([[True], np.tile([False, True], len(paths)), [False]])
        self.parens = Parentheses(np.repeat(kinds, runs))

        n = 1 + int(fresh.sum())
        starts = 1 + np.concatenate([[0], np.cumsum(fresh)])
        self.parent, self.depth = np.arange(-1, n - 1), np.zeros(n, np.int64)
        stack = [0]
        for i in range(len(paths)):
            first, end, base = starts[i], starts[i + 1], shared[i]
            if end > first:
                self.parent[first] = stack[base]
                stack[base + 1 :] = range(first, end)
                self.depth[first:end] = np.arange(base + 1, depth[i] + 1)
        self.chars = np.concatenate([[0], *(c[s:] for c, s in zip(chars, shared))]).astype(np.int64)
        self.first, self.last = np.arange(depth[0] + 1), np.array(stack[: depth[-1] + 1])
        self.paths, self.ids = paths, ids

        at = np.flatnonzero(self.parens.opens)
        close = self.parens.findclose(at)
        after = np.arange(n) + (close - at + 1) // 2  # where the subtree ends in preorder
        rank = self.parens.leaf_rank()
        self.leaves = rank[close] - rank[at]
        ended = np.cumsum(np.bincount(starts[1:] - 1, minlength=n))
        self.members_from = np.concatenate([[0], ended])[:-1]
        members_to = ended[after - 1]
        self.ends = np.diff(np.concatenate([[0], ended]))
        self.n_convs = members_to - self.members_from
        own = (self.n_convs - 1) * self.chars
        total = np.concatenate([[0], np.cumsum(own)])
        self.saved = total[after] - total[:-1]
        spans = np.column_stack([self.members_from, members_to]).ravel()
        self.conv_id = np.minimum.reduceat(np.append(ids, np.iinfo(np.int64).max), spans)[::2]
        self.children = np.bincount(self.parent[1:], minlength=n)

    def ids_at(self, node: int) -> np.ndarray:
        """Ids of the conversations that end at the node, ascending."""
        start = self.members_from[node]
        return self.ids[start : start + self.ends[node]]

    def keys(self) -> dict[int, bytes]:
        """Of every spine node the digest of its prefix."""
        out = {}
        for nodes, path in ((self.first, self.paths[0]), (self.last, self.paths[-1])):
            running = hashlib.md5(usedforsecurity=False)
            for d, node in enumerate(nodes.tolist()):
                running.update(path[DIGEST * (d - 1) : DIGEST * d] if d else b"")
                out[node] = running.digest()
        return out

    def parts(self) -> pa.RecordBatch:
        """Whole nodes, the parts of spine nodes and the ids that end at these."""
        keys = self.keys()
        spine = np.array(sorted(keys))
        shared = np.zeros(len(self.parent), bool)
        shared[spine] = True
        whole = np.flatnonzero(~shared)
        hung = whole[shared[self.parent[whole]]] if len(whole) else whole
        under = [np.zeros(len(shared), np.int64) for _ in range(3)]
        for sums, values in zip(under, (np.ones(len(hung), np.int64), self.leaves[hung], self.saved[hung])):
            np.add.at(sums, self.parent[hung], values)
        chunks = [
            (keys[i], ids[start : start + ENDS_A_ROW])
            for i in spine.tolist()
            for ids in [self.ids_at(i)]
            for start in range(0, len(ids), ENDS_A_ROW)
        ]
        a, b, c = len(whole), len(spine), len(chunks)
        none = np.zeros(c, np.int64)

        def numbers(of_whole, of_spine):
            return pa.array(np.concatenate([of_whole, of_spine, none]).astype(np.int64))

        over = self.parent[whole]
        whole_parent = np.concatenate([self.conv_id[over], np.zeros(b + c, np.int64)])
        unknown = np.concatenate([shared[over], np.ones(b + c, bool)])
        digests = [
            EMPTY if not self.ends[i] else hashlib.sha256(",".join(map(str, self.ids_at(i).tolist())).encode()).hexdigest()
            for i in whole.tolist()
        ]
        columns = [
            pa.array(np.repeat([NODE, SPINE, ENDS], [a, b, c]).astype(np.int32)),
            pa.array([keys.get(p) for p in over.tolist()] + [keys[i] for i in spine.tolist()] + [k for k, _ in chunks], pa.binary()),
            pa.array([None] * a + [keys.get(p) for p in self.parent[spine].tolist()] + [None] * c, pa.binary()),
            pa.array(np.concatenate([self.conv_id[whole], self.conv_id[spine], np.array([i[0] for _, i in chunks], np.int64)])),
            numbers(self.depth[whole], self.depth[spine]),
            pa.array(whole_parent, mask=unknown),
            numbers(self.n_convs[whole], self.n_convs[spine]),
            numbers(self.children[whole], under[0][spine]),
            numbers(self.leaves[whole], under[1][spine]),
            numbers(self.saved[whole], under[2][spine]),
            numbers(self.chars[whole], self.chars[spine]),
            pa.array(digests + [None] * (b + c), pa.string()),
            pa.array([None] * (a + b) + [i.tolist() for _, i in chunks], pa.list_(pa.int64())),
        ]
        return pa.RecordBatch.from_arrays(columns, schema=PARTS)


def _sharded(batches):
    paths, ids, chars, turns = [], [], [], 0
    for batch in batches:
        lists = batch.column("chars")
        flat, offsets = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
        for i, (path, conv_id) in enumerate(zip(batch.column("path").to_pylist(), batch.column("conv_id").to_pylist())):
            paths.append(path)
            ids.append(conv_id)
            chars.append(flat[offsets[i] : offsets[i + 1]])
            turns += 1 + len(chars[-1])
            if turns >= SHARD_TURNS:
                yield Shard(paths, np.array(ids, np.int64), chars).parts()
                paths, ids, chars, turns = [], [], [], 0
    if paths:
        yield Shard(paths, np.array(ids, np.int64), chars).parts()
    give_back_memory()


def _hashed_ends(batches):
    """sha256 of each key's ids, which come in order; only the running hash is held."""
    key, running = None, None
    out = pa.schema([("key", pa.binary()), ("ends_sha256", pa.string())])

    def row():
        return pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([running.hexdigest()])], schema=out)

    for batch in batches:
        for k, ids in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist()):
            if running is None or k != key:
                if running is not None:
                    yield row()
                key, running = k, hashlib.sha256()
            else:
                running.update(b",")
            running.update(",".join(map(str, ids)).encode())
    if running is not None:
        yield row()


def turns_of(
    conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """(conv_id, turns): a row per conversation, turns an array of (digest in hex, code points of the text).

    Turns are ordered by number, null first, those with one number by digest.
    Null roles and texts are empty. Rows with a null conversation id belong to no
    conversation and take no part.
    """
    who, what = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role, text))
    number = F.col(f"`{turn}`")
    rows = conversations.where(F.col(f"`{conv_id}`").isNotNull()).select(
        F.col(f"`{conv_id}`").cast("long").alias("conv_id"),
        F.struct(
            number.isNotNull().alias("numbered"),
            number.alias("number"),
            # The length keeps role and text apart.
            F.md5(F.concat(F.octet_length(who).cast("string"), F.lit(":"), who, what)).alias("digest"),
            F.length(what).alias("chars"),
        ).alias("one"),
    )
    ordered = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("one")).alias("all"))
    return ordered.select(
        "conv_id", F.transform("all", lambda t: F.struct(t["digest"].alias("digest"), t["chars"].alias("chars"))).alias("turns")
    )


def respun(turns: DataFrame, family: int = 100, most: int = 6) -> DataFrame:
    """Each conversation c with the first h turns of conversation c - c % family before its own after the first h.

    h is crc32 of c as text, modulo ``most``. All turns of the other where it has
    fewer, none where it is absent.
    """
    of = F.col("conv_id") - F.col("conv_id") % family
    heads = turns.where(F.col("conv_id") % family == 0).select(
        F.col("conv_id").alias("family"), F.slice("turns", 1, most - 1).alias("head")
    )
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int")
    own = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0)))
    head = F.when(F.col("head").isNotNull(), F.slice("head", F.lit(1), F.col("h"))).otherwise(F.slice("turns", F.lit(1), F.lit(0)))
    joined = turns.withColumn("family", of).withColumn("h", h).join(heads, "family", "left")
    return joined.select("conv_id", F.concat(head, own).alias("turns"))


def _summed_along(spine: DataFrame) -> DataFrame:
    """n_leaves and saved_tokens of each spine node with those of all spine nodes under it.

    After round k a node has the sums of those under it to the distance 2^k.
    """
    rows = stored(spine.select("key", F.col("parent").alias("up"), "n_leaves", "saved_tokens"), "spine")
    while rows.where(F.col("up").isNotNull()).limit(1).count():
        under = stored(
            rows.where(F.col("up").isNotNull())
            .groupBy(F.col("up").alias("of"))
            .agg(F.sum("n_leaves").alias("more_leaves"), F.sum("saved_tokens").alias("more_saved")),
            "under",
        )
        above = rows.select(F.col("key").alias("at"), F.col("up").alias("farther"))
        rows = stored(
            rows.join(under, F.col("key") == F.col("of"), "left")
            .join(above, F.col("up") == F.col("at"), "left")
            .select(
                "key",
                F.col("farther").alias("up"),
                (F.col("n_leaves") + F.coalesce("more_leaves", F.lit(0))).alias("n_leaves"),
                (F.col("saved_tokens") + F.coalesce("more_saved", F.lit(0))).alias("saved_tokens"),
            ),
            "spine",
        )
    return rows.drop("up")


def _merged(parts: DataFrame) -> DataFrame:
    """One row per spine node: key, parent and all columns of the result but parent_conv_id."""
    sums = ("n_convs", "n_children", "n_leaves", "saved_tokens")
    spine = stored(
        parts.where(F.col("kind") == SPINE)
        .groupBy("key")
        .agg(
            F.min("parent").alias("parent"), F.min("depth").alias("depth"), F.min("conv_id").alias("conv_id"),
            F.max("chars").alias("chars"), *[F.sum(c).alias(c) for c in sums],
        ),
        "spine-nodes",
    )
    inner = spine.where(F.col("parent").isNotNull()).groupBy(F.col("parent").alias("of")).agg(F.count("*").alias("inner"))
    children = F.col("n_children") + F.coalesce("inner", F.lit(0))
    grown = stored(
        spine.join(inner, F.col("key") == F.col("of"), "left")
        .withColumn("n_children", children)
        .withColumn("n_leaves", F.col("n_leaves") + (F.col("n_children") == 0).cast("long"))
        .withColumn("saved_tokens", F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("chars"))
        .drop("of", "inner", "chars"),
        "spine-children",
    )
    ends = (
        parts.where(F.col("kind") == ENDS)
        .select("key", "conv_id", "ids")
        .repartition("key")
        .sortWithinPartitions("key", "conv_id")
        .drop("conv_id")
        .mapInArrow(_hashed_ends, "key binary, ends_sha256 string")
    )
    whole = grown.drop("n_leaves", "saved_tokens").join(_summed_along(grown), "key").join(stored(ends, "ends"), "key", "left")
    return stored(whole.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(EMPTY))), "spine-merged")


def prefix_trie(turns: DataFrame) -> DataFrame:
    """A row per distinct prefix of the conversations in ``turns`` (conv_id, turns as of ``turns_of``).

    conv_id (the smallest member), depth, parent_conv_id (the parent's conv_id,
    null for the root), n_convs (conversations that begin so), n_children,
    n_leaves (childless nodes of the subtree, itself included), saved_tokens (sum
    over the subtree of (n_convs - 1) times the code points of the node's last
    text), ends_sha256 (of the ids of the conversations that end here, ascending,
    joined by commas). Conversations without turns end at the root. Equal turns
    are told apart by 128-bit digests. No conversations: no rows. The ids ending
    at one node are hashed in one stream, which holds none of them.
    """
    paths = turns.select(
        F.unhex(F.array_join(F.col("turns.digest"), "")).alias("path"),
        "conv_id",
        F.col("turns.chars").alias("chars"),
    )
    order = ["path", "conv_id"]
    dealt = stored(paths, "paths").repartitionByRange(*order).sortWithinPartitions(*order)
    parts = stored(dealt.mapInArrow(_sharded, PARTS_DDL), "parts")
    spine = _merged(parts)
    over = spine.select(F.col("key").alias("over"), F.col("conv_id").alias("over_id"))
    nodes = parts.where(F.col("kind") == NODE)
    return (
        nodes.where(F.col("key").isNull())
        .select(*RESULT)
        .unionByName(
            nodes.where(F.col("key").isNotNull())
            .join(over, F.col("key") == F.col("over"))
            .withColumn("parent_conv_id", F.col("over_id"))
            .select(*RESULT)
        )
        .unionByName(
            spine.join(over, F.col("parent") == F.col("over"), "left")
            .withColumn("parent_conv_id", F.col("over_id"))
            .select(*RESULT)
        )
    )


TRIE_SQL = """
with recursive numbers as (
  select distinct conv_id from conversations where conv_id is not null
), crcs as (
  select conv_id, list_reduce(
    list_prepend(4294967295::bigint, list_transform(range(0, 8 * length(conv_id::varchar)), lambda i: i)),
    lambda crc, i: case when xor(crc, case when i % 8 = 0 then ascii(substr(conv_id::varchar, i // 8 + 1, 1)) else 0 end) % 2 = 1
      then xor(xor(crc, case when i % 8 = 0 then ascii(substr(conv_id::varchar, i // 8 + 1, 1)) else 0 end) // 2, 3988292384)
      else xor(crc, case when i % 8 = 0 then ascii(substr(conv_id::varchar, i // 8 + 1, 1)) else 0 end) // 2 end) as crc
  from numbers
), own as (
  select conv_id, list({'role': coalesce(role, ''), 'body': coalesce(text, '')}
    order by turn nulls first, md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) as turns
  from conversations where conv_id is not null group by conv_id
), spun as (
  select c.conv_id, list_concat(coalesce(b.turns[1:h], []), c.turns[h + 1:]) as turns
  from (select own.*, cast(xor(crc, 4294967295) % 6 as integer) as h from own join crcs using (conv_id)) c
  left join own b on b.conv_id = c.conv_id - c.conv_id % 100
), members as (
  select conv_id, d as depth, turns[1:d] as prefix, d = len(turns) as ends
  from spun, unnest(range(0, len(turns) + 1)) as _(d)
), nodes as (
  select depth, prefix, min(conv_id) as conv_id, count(*) as n_convs,
    sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (ends), '')) as ends_sha256
  from members group by depth, prefix
), kids as (
  select depth - 1 as depth, prefix[1:depth - 1] as prefix, count(*) as n_children from nodes where depth > 0 group by all
), told as (
  select n.*, coalesce(k.n_children, 0) as n_children,
    case when n.depth = 0 then 0 else (n_convs - 1) * length(n.prefix[n.depth].body) end as saved
  from nodes n left join kids k on n.depth = k.depth and n.prefix = k.prefix
), sums as (
  select d as depth, prefix[1:d] as prefix, sum(saved) as saved_tokens, count(*) filter (n_children = 0) as n_leaves
  from told, unnest(range(0, depth + 1)) as _(d) group by all
)
select t.conv_id, cast(t.depth as bigint) as depth, p.conv_id as parent_conv_id, t.n_convs, cast(t.n_children as bigint) as n_children,
  cast(s.n_leaves as bigint) as n_leaves, cast(s.saved_tokens as bigint) as saved_tokens, t.ends_sha256
from told t join sums s on t.depth = s.depth and t.prefix = s.prefix
left join nodes p on p.depth = t.depth - 1 and p.prefix = t.prefix[1:t.depth - 1]
"""
