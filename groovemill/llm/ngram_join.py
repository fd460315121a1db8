"""N-gram Jaccard join by grouped prefixes, as connected components of all links."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import IdFilter, bounded_batches, documents, give_back, is_small, sized, staged
from .graph import components
from .shingles import WORDS, mix, of_batch, signatures

#: Links are sets whose intersection has at least PERCENT hundredths of their union.
PERCENT = 80
#: Tokens and documents of a block that is dealt at once; a document's place in its block has 16 bits.
BLOCK_TOKENS = 1_000_000
BLOCK_DOCS = 20_000
#: Bytes of tokens that a range should have, and the least and most ranges that tokens are dealt to.
RANGE_BYTES = 16 << 20
RANGES = (256, 1 << 19)
#: A token in the prefixes of more groups than this joins them by size classes instead of by pairs.
PAIR_GROUPS = 16
#: Tokens and documents of a cell; larger clusters are split into cells.
CELL_TOKENS = 500_000
CELL_DOCS = 3_000
#: Ratio of sizes of a class; sets that link differ by 1.25 at most and so are in one class or in neighbouring ones.
CLASS_RATIO = 1.26
_LOW40 = np.uint64((1 << 40) - 1)
_NARROW = pa.schema([("key", pa.int64()), ("block", pa.int64()), *[(k, pa.binary()) for k in "abcde"]])
_FIELDS = "key long, block long, a binary, b binary, c binary, d binary, e binary"
_RANKED = pa.schema([("node", pa.int64()), ("n", pa.int64()), ("grp", pa.int64()), ("lead", pa.int64()), ("tokens", pa.binary())])


def least_shared(n: np.ndarray | int) -> np.ndarray | int:
    """The tokens that a set of size n shares with any set it links with, at least."""
    return (n * PERCENT + 99) // 100


def _row(*values) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, _NARROW, strict=True)], schema=_NARROW)


def _table(rows: list[tuple]) -> pa.Table:
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _NARROW, strict=True)], schema=_NARROW)


def range_bits(size: int) -> int:
    """Bits of the number of ranges for texts of so many bytes, at about six bytes a token that come to seven when dealt."""
    return (min(max(RANGES[0], size * 7 // 6 // RANGE_BYTES), RANGES[1]) - 1).bit_length()


class _Block:
    """Sets of some documents, their tokens ascending, with what repeats among them and where each range of tokens begins."""

    def __init__(self, sets: list[np.ndarray], sizes: list[np.ndarray], bits: int):
        self.n = np.concatenate(sizes)
        h, place = np.concatenate(sets), np.repeat(np.arange(len(self.n), dtype=np.uint16), self.n)
        order = np.argsort(h, kind="stable")
        self.h, self.place = h, place = h[order], place[order]
        self.many, self.head = np.zeros(len(h), bool), np.ones(len(h), bool)
        same = h[1:] == h[:-1]
        self.many[1:] = same
        self.many[:-1] |= same
        self.head[1:] = ~same
        edges = np.searchsorted(h, np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits)).tolist()
        self.ranges = [(part, a, b) for part, (a, b) in enumerate(zip([0, *edges], [*edges, len(h)], strict=True)) if a < b]


def _blocks(batches: Iterator[pa.RecordBatch], bits: int, only: IdFilter | None = None) -> Iterator[tuple[int, np.ndarray, _Block, np.ndarray, np.ndarray]]:
    """(number, keys, block, signatures) of the documents that a task reads, only those whose key passes the filter."""
    block, most = TaskContext.get().partitionId() << 32, max(BLOCK_TOKENS, min(16 << bits, 8 * BLOCK_TOKENS))
    ids, sets, sizes, signs = [], [], [], []
    held = docs = 0
    for batch in batches:
        if only is not None:
            batch = batch.filter(pa.array(only.has(batch.column(0).to_numpy(zero_copy_only=False))))
        keys = batch.column(0).to_numpy(zero_copy_only=False).astype("<i8")
        for first, h, offsets in of_batch(batch.column(1)):
            ids.append(keys[first : first + len(offsets) - 1])
            sets.append(h)
            sizes.append(np.diff(offsets))
            signs.append(signatures(h, offsets))
            held, docs = held + len(h), docs + len(offsets) - 1
            if held >= most or docs >= BLOCK_DOCS:
                yield block, np.concatenate(ids), _Block(sets, sizes, bits), *(np.concatenate(x).astype("<i8") for x in zip(*signs, strict=True))
                block, held, docs = block + 1, 0, 0
                ids, sets, sizes, signs = [], [], [], []
    if ids:
        yield block, np.concatenate(ids), _Block(sets, sizes, bits), *(np.concatenate(x).astype("<i8") for x in zip(*signs, strict=True))
    give_back()


def _deal(bits: int):
    """Blocks of documents: a row with what is known of them, and one for each range of tokens. A token that a block has
    in several documents is sent once; the others go with their document's place in the block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, ids, b, s1, s2 in _blocks(batches, bits):
            short = ((b.h >> np.uint64(24 - bits)) & _LOW40).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]
            for part, x, y in b.ranges:
                one, more = ~b.many[x:y], (b.many & b.head)[x:y]
                yield _row(part, block, short[x:y][one].tobytes(), b.place[x:y][one].astype("<u2").tobytes(), short[x:y][more].tobytes(), None, None)
            local = np.bincount(b.place[b.many], minlength=len(b.n)).astype("<i4")
            yield _row(-1 - block, block, ids.tobytes(), b.n.astype("<i4").tobytes(), s1.tobytes(), s2.tobytes(), local.tobytes())

    return run


def _wide(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 5, 8), np.uint8)
    out[:, :5] = np.frombuffer(raw, np.uint8).reshape(-1, 5)
    return out.view("<u8").ravel()


def _tally(table: pa.Table) -> pa.Table:
    """For a range of tokens: how many of each document's tokens are in another document as well. Rows that describe a
    block pass through."""
    rows = table.to_pylist()
    if rows[0]["key"] < 0:
        return table
    ones, more = [_wide(r["a"]) for r in rows], [_wide(r["c"]) for r in rows]
    edges = np.cumsum([len(x) for x in ones])
    h = np.concatenate([*ones, *more])
    order = np.argsort(h, kind="stable")
    s = h[order]
    same = s[1:] == s[:-1]
    twice = np.zeros(len(s), bool)
    twice[1:] = same
    twice[:-1] |= same
    shared = np.empty(len(s), bool)
    shared[order] = twice
    out = []
    for r, b, x in zip(rows, edges, ones, strict=True):
        place = np.frombuffer(r["b"], "<u2")[shared[b - len(x) : b]]
        have, n = np.unique(place, return_counts=True)
        out.append((r["key"], r["block"], have.astype("<u2").tobytes(), n.astype("<i4").tobytes(), None, None, None))
    del ones, more, h, order, s, same, twice, shared
    give_back()
    return _table(out)


def _settle(table: pa.Table) -> pa.Table:
    """The documents of a block, with whether enough of their tokens are in other documents for any link."""
    rows = table.to_pylist()
    own = next(r for r in rows if r["key"] < 0)
    ids, n, s1, s2, shared = (np.frombuffer(own[k], t) for k, t in (("a", "<i8"), ("b", "<i4"), ("c", "<i8"), ("d", "<i8"), ("e", "<i4")))
    shared = shared.astype(np.int64)
    for r in rows:
        if r["key"] >= 0:
            shared[np.frombuffer(r["a"], "<u2")] += np.frombuffer(r["b"], "<i4")
    return pa.table({"doc_id": ids.astype(np.int64), "n": n.astype(np.int64), "s1": s1.astype(np.int64), "s2": s2.astype(np.int64), "active": (n > 0) & (shared >= least_shared(n.astype(np.int64)))})


def _deal_nodes(bits: int, only: IdFilter):
    """As _deal(), of the documents that pass the filter and with whole tokens: the row of a block has the tokens that
    several of its documents have, with their places; a range has how many of the block's documents have them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, _, b, s1, _ in _blocks(batches, bits, only):
            heads = np.flatnonzero(b.head)
            times = np.diff(np.append(heads, len(b.h)))
            for part, x, y in b.ranges:
                one, more = ~b.many[x:y], (b.many & b.head)[x:y]
                count = times[np.searchsorted(heads, x + np.flatnonzero(more))].astype("<i4")
                yield _row(part, block, b.h[x:y][one].astype("<u8").tobytes(), b.place[x:y][one].astype("<u2").tobytes(), None, b.h[x:y][more].astype("<u8").tobytes(), count.tobytes())
            yield _row(-1 - block, block, s1.tobytes(), b.n.astype("<i4").tobytes(), b.h[b.many].astype("<u8").tobytes(), b.place[b.many].astype("<u2").tobytes(), None)

    return run


def _tally_nodes(table: pa.Table) -> pa.Table:
    """For a range of tokens: how many documents have each; tokens of one document alone go."""
    rows = table.to_pylist()
    if rows[0]["key"] < 0:
        return table
    ones, more = ([np.frombuffer(r[k], "<u8") for r in rows] for k in "ad")
    h = np.concatenate([*ones, *more])
    times = np.concatenate([np.ones(sum(map(len, ones)), np.int64), *[np.frombuffer(r["e"], "<i4") for r in rows]])
    _, code = np.unique(h, return_inverse=True)
    have = np.bincount(code, times).astype(np.int64)[code]
    out, at, end = [], 0, sum(map(len, ones))
    for r, x, y in zip(rows, ones, more, strict=True):
        own, both = np.minimum(have[at : at + len(x)], 2**31 - 1).astype("<i4"), np.minimum(have[end : end + len(y)], 2**31 - 1).astype("<i4")
        keep = own > 1
        out.append((r["key"], r["block"], x[keep].tobytes(), np.frombuffer(r["b"], "<u2")[keep].tobytes(), own[keep].tobytes(), y.tobytes(), both.tobytes()))
        at, end = at + len(x), end + len(y)
    del ones, more, h, times, code, have
    give_back()
    return _table(out)


def _settle_nodes(table: pa.Table) -> pa.Table:
    """The documents of a block that can link with another: node, size, group of equal sizes and prefixes, how many tokens
    of the prefix other documents have, and all such tokens, the rarest first, then by value."""
    rows = sorted(table.to_pylist(), key=lambda r: r["key"])
    own, rows = rows[0], rows[1:]
    node, n = np.frombuffer(own["a"], "<i8"), np.frombuffer(own["b"], "<i4").astype(np.int64)
    read = lambda k, t: np.concatenate([np.frombuffer(r[k], t) for r in rows] or [np.empty(0, t)])
    both, place = np.frombuffer(own["c"], "<u8"), np.frombuffer(own["d"], "<u2")
    token = np.concatenate([read("a", "<u8"), both])
    have = np.concatenate([read("c", "<i4"), read("e", "<i4")[np.searchsorted(read("d", "<u8"), both)]])
    place = np.concatenate([read("b", "<u2"), place])
    order = np.lexsort((token, have, place))
    token = token[order]
    shared = np.bincount(place, minlength=len(n))
    ends = np.cumsum(shared)
    lead = shared - least_shared(n) + 1  # of the first n - least_shared(n) + 1 tokens those that no other document has come first
    out = []
    for i in np.flatnonzero((n > 0) & (lead > 0)).tolist():
        own = token[ends[i] - shared[i] : ends[i]]
        name = mix(np.array([mix(own[: lead[i]] + np.uint64(7)).sum() + np.uint64(n[i])], np.uint64) + np.uint64(shared[i])).view(np.int64)[0]
        out.append((int(node[i]), int(n[i]), int(name), int(lead[i]), own.tobytes()))
    give_back()
    return pa.Table.from_arrays([pa.array([r[k] for r in out], f.type) for k, f in enumerate(_RANKED)], schema=_RANKED)


def _postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(token, group, size, place in the set) for each token of groups' prefixes."""
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            grp, n, shared, prefix = batch.slice(at, 500).columns
            found = [np.frombuffer(x.as_buffer(), "<i8") for x in prefix]
            many = np.array([len(x) for x in found])
            n, alone = n.to_numpy(), n.to_numpy() - shared.to_numpy()
            place = np.concatenate([np.arange(a, a + m) for a, m in zip(alone, many, strict=True)])
            cols = [np.concatenate(found).astype(np.int64), np.repeat(grp.to_numpy(), many), np.repeat(n, many), place.astype(np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["token", "grp", "n", "place"])


def _near_groups(postings: DataFrame) -> DataFrame:
    """(u, v): pairs of groups whose connected parts hold all links between members of different groups.

    A token in few prefixes pairs their groups. Pairs whose sizes differ too much, or whose sets can't share enough after
    their first common token or beyond their prefixes, go. A token in many prefixes joins the groups of a class of sizes,
    and neighbouring classes, each by a smallest member: partial sums, so no list of a token is gathered anywhere. Links
    that have such a token in both prefixes are kept by it, others have all that their prefixes share in the pairs.
    """
    kind = F.floor(F.log("n") / F.log(F.lit(CLASS_RATIO))).cast("int")
    known = postings.groupBy("token").agg(F.count("*").alias("groups")).filter("groups > 1")
    few = postings.join(known.filter(F.col("groups") <= PAIR_GROUPS).drop("groups"), "token")
    side = lambda x: few.select(F.col("token").alias(f"token_{x}"), *[F.col(c).alias(f"{c}_{x}") for c in ("grp", "n", "place")])
    below = (F.col("n_x") < F.col("n_y")) | ((F.col("n_x") == F.col("n_y")) & (F.col("grp_x") < F.col("grp_y")))
    met = side("x").join(side("y"), (F.col("token_x") == F.col("token_y")) & below & (100 * F.col("n_x") >= PERCENT * F.col("n_y")))
    met = met.groupBy("grp_x", "grp_y").agg(F.count("*").alias("hits"), *[F.min(c).alias(c) for c in ("n_x", "n_y", "place_x", "place_y")])
    need = F.ceil(PERCENT * (F.col("n_x") + F.col("n_y")) / (100 + PERCENT))
    after = F.least(F.col("n_x") - F.col("place_x"), F.col("n_y") - F.col("place_y"))
    beyond = F.greatest(least_shared_column("n_x"), least_shared_column("n_y")) - 1
    pairs = met.filter((need <= after) & (need <= F.col("hits") + beyond)).select(F.col("grp_x").alias("u"), F.col("grp_y").alias("v"))
    many = postings.join(known.filter(F.col("groups") > PAIR_GROUPS).drop("groups"), "token").withColumn("kind", kind)
    heads = many.groupBy("token", "kind").agg(F.min("grp").alias("head"), F.min("n").alias("low"), F.max("n").alias("high"))
    same = many.join(heads.select("token", "kind", "head"), ["token", "kind"]).select(F.col("grp").alias("u"), F.col("head").alias("v"))
    above = heads.select("token", (F.col("kind") - 1).alias("kind"), F.col("head").alias("v"), F.col("low").alias("v_low"))
    next_ = heads.join(above, ["token", "kind"]).filter(100 * F.col("high") >= PERCENT * F.col("v_low")).select(F.col("head").alias("u"), "v")
    return pairs.unionByName(same).unionByName(next_).filter("u <> v").distinct()


def least_shared_column(n: str):
    return F.floor((F.col(n) * PERCENT + 99) / 100)


def _runs(starts: np.ndarray, values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The values of the lists at the places `at`, one after another."""
    first, size = starts[at], starts[at + 1] - starts[at]
    ends = np.cumsum(size)
    return values[np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - ends + size, size)]


def _index(keys: np.ndarray, values: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(starts, values) of the lists of values of each key below n."""
    order = np.argsort(keys, kind="stable")
    return np.concatenate([[0], np.cumsum(np.bincount(keys, minlength=n))]), values[order]


def links_within(n: np.ndarray, lead: np.ndarray, tokens: np.ndarray, offsets: np.ndarray, label: np.ndarray) -> list[tuple[int, int]]:
    """Links that join the sets into the components which all links among them make.

    n: sizes; tokens: those that others have as well, in one order for all sets, the first lead of each being its prefix;
    label: sets with equal ones are known to be joined. Sets with equal prefixes and sizes are one group; prefix tokens
    find pairs of groups, sizes and the shared part of the prefixes filter them, and the members of the pairs that remain
    are verified on their whole sets, those that share the most of their prefixes first, unless they are joined already.
    """
    _, code, count = np.unique(tokens, return_inverse=True, return_counts=True)
    docs = np.repeat(np.arange(len(n), dtype=np.int32), np.diff(offsets))
    prefix = [code[a : a + p] for a, p in zip(offsets[:-1].tolist(), lead.tolist(), strict=True)]
    groups: dict[tuple, int] = {}
    by_size = np.argsort(n, kind="stable")
    group, leader = np.empty(len(n), np.int32), []
    for i in by_size.tolist():
        g = group[i] = groups.setdefault((int(n[i]), prefix[i].tobytes()), len(groups))
        if g == len(leader):
            leader.append(i)
    del groups
    place = np.empty(len(n), np.int64)
    place[by_size] = np.arange(len(n))
    firsts = np.array(leader)
    keys = np.concatenate([prefix[i] for i in leader])
    heads, in_prefix = _index(keys, np.repeat(np.arange(len(leader), dtype=np.int32), lead[firsts]), len(count))
    posts, in_set = _index(code, docs, len(count))
    spans, members = _index(group, np.arange(len(n)), len(leader))
    beyond = least_shared(n) - 1
    root = np.unique(label, return_inverse=True)[1]
    out: list[tuple[int, int]] = []
    for i in by_size.tolist():
        own = prefix[i]
        near, hits = np.unique(_runs(heads, in_prefix, own[count[own] > 1]), return_counts=True)
        size = n[firsts[near]]
        need = -(-PERCENT * (n[i] + size) // (100 + PERCENT))
        fit = (size <= n[i]) & (size * 100 >= PERCENT * n[i]) & (hits + np.maximum(beyond[i], beyond[firsts[near]]) >= need)
        near = near[fit][np.argsort(-hits[fit], kind="stable")]
        if group[i] not in near:
            near = np.append(near, group[i])
        cand = _runs(spans, members, near)
        cand = cand[(place[cand] < place[i]) & (root[cand] != root[i])]
        mine, step = code[offsets[i] : offsets[i + 1]], 8
        while len(cand):
            now, cand = cand[:step], cand[step:]
            if len(now) > 64:
                common = np.bincount(_runs(posts, in_set, mine[count[mine] > 1]), minlength=len(n))[now]
            else:
                common = np.array([len(np.intersect1d(mine, code[offsets[j] : offsets[j + 1]], assume_unique=True)) for j in now.tolist()], np.int64)
            for j in now[100 * common >= PERCENT * (n[i] + n[now] - common)].tolist():
                if root[j] != root[i]:
                    out.append((i, j))
                    root[root == root[j]] = root[i]
            cand, step = cand[root[cand] != root[i]], step * 8
    return out


def _verify(table: pa.Table) -> pa.Table:
    node, n, lead, label = (table[c].to_numpy() for c in ("node", "n", "lead", "label"))
    sets = [np.frombuffer(x.as_buffer(), "<u8") for x in table["tokens"]]
    found = links_within(n, lead, np.concatenate(sets), np.concatenate([[0], np.cumsum([len(x) for x in sets])]), label)
    u, v = (np.array([node[p[k]] for p in found], np.int64) for k in (0, 1))
    del sets
    give_back()
    return pa.table({"u": u, "v": v})


def _against(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(u, v) of the rows of node, size, tokens and another node, its size and tokens that link."""
    for batch in batches:
        u, n, tokens, v, m, others = batch.columns
        common = np.array([len(np.intersect1d(np.frombuffer(a.as_buffer(), "<u8"), np.frombuffer(b.as_buffer(), "<u8"), assume_unique=True)) for a, b in zip(tokens, others, strict=True)], np.int64)
        link = pa.array(100 * common >= PERCENT * (n.to_numpy() + m.to_numpy() - common))
        yield pa.RecordBatch.from_arrays([u.filter(link), v.filter(link)], names=["u", "v"])


def _split(large: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with their tasks, links) of the members of large clusters.

    Each class of sizes of a cluster has a leader, the member with the fewest tokens of its own. All members of its class
    and the neighbouring ones are held against it, and those that link get its label: in a family of copies that is
    nearly all. Labels and what is left are dealt into cells, and two cells meet in a task unless they are of
    one label or of classes too far apart.
    """
    kind = F.floor(F.log("n") / F.log(F.lit(CLASS_RATIO))).cast("int")
    large = staged(large.withColumn("kind", kind), "large")
    alone = F.col("n") - F.octet_length("tokens") / 8
    leaders = large.groupBy("cluster", "kind").agg(F.min_by(F.struct("node", "n", "tokens"), F.struct(alone, "node")).alias("l"))
    leaders = leaders.select(F.col("cluster").alias("l_cluster"), F.col("kind").alias("l_kind"), F.col("l.node").alias("l_node"), F.col("l.n").alias("l_n"), F.col("l.tokens").alias("l_tokens"))
    close = (F.col("cluster") == F.col("l_cluster")) & (F.abs(F.col("kind") - F.col("l_kind")) <= 1) & (F.col("node") != F.col("l_node"))
    links = staged(large.join(leaders, close).select("node", "n", "tokens", "l_node", "l_n", "l_tokens").mapInArrow(_against, "u long, v long"), "leaders")
    label = components(links).withColumnsRenamed({"node": "l_node", "component": "known"})
    large = large.join(label, F.col("node") == F.col("l_node"), "left").drop("l_node")
    cuts = large.groupBy("cluster", "kind", "known").agg(F.greatest(F.ceil(F.sum("n") / CELL_TOKENS), F.ceil(F.count("*") / CELL_DOCS)).cast("int").alias("cells"))
    cuts = staged(cuts, "cells")
    name = F.xxhash64("cluster", "kind", F.coalesce("known", F.lit(0)), F.col("known").isNull(), "cell")
    cells = cuts.withColumn("cell", F.explode(F.sequence(F.lit(0), F.col("cells") - 1))).select("cluster", "kind", "known", name.alias("cell"))
    other = cells.select(*[F.col(c).alias(f"o_{c}") for c in cells.columns])
    apart = F.col("known").isNull() | F.col("o_known").isNull() | (F.col("known") != F.col("o_known"))
    meet = cells.join(other, (F.col("cluster") == F.col("o_cluster")) & (F.abs(F.col("kind") - F.col("o_kind")) <= 1) & (F.col("cell") <= F.col("o_cell")) & apart)
    meet = meet.select(F.xxhash64("cell", "o_cell").alias("task"), F.explode(F.array_distinct(F.array("cell", "o_cell"))).alias("at"))
    own = large.join(cuts, (cuts["cluster"] == large["cluster"]) & (cuts["kind"] == large["kind"]) & cuts["known"].eqNullSafe(large["known"]))
    own = own.select(large["cluster"], large["kind"], large["known"], "node", "n", "lead", "tokens", F.pmod(F.xxhash64("node", F.lit(3)), F.col("cells")).cast("int").alias("cell"))
    own = own.withColumn("cell", name)
    rows = own.join(meet, F.col("cell") == F.col("at")).select("task", "node", "n", "lead", F.coalesce("known", "node").alias("label"), "tokens")
    return rows, links


def _linked(members: DataFrame, clusters: DataFrame) -> DataFrame:
    """(u, v): links that join members(node, n, lead, tokens, cluster) as all links within their clusters do. Small clusters
    are dealt whole to tasks, large ones in cells. clusters: (cluster, docs, total) of at least two documents."""
    small = (F.col("total") <= CELL_TOKENS) & (F.col("docs") <= CELL_DOCS)
    sums = clusters.agg(*[F.coalesce(F.sum(F.when(small, F.col(c))), F.lit(0)).alias(c) for c in ("total", "docs")], F.count_if(~small).alias("large")).first()
    tasks = max(1, int(sums["total"]) // CELL_TOKENS + 1, int(sums["docs"]) // CELL_DOCS + 1)
    rows = members.join(sized(clusters), "cluster")
    whole = rows.filter(small).select(F.pmod(F.xxhash64("cluster"), F.lit(tasks)).alias("task"), "node", "n", "lead", F.col("node").alias("label"), "tokens")
    if not sums["large"]:
        return whole.groupBy("task").applyInArrow(_verify, "u long, v long")
    split, links = _split(rows.filter(~small).drop("docs", "total"))
    return whole.unionByName(split).groupBy("task").applyInArrow(_verify, "u long, v long").unionByName(links)


def profile(docs: DataFrame, bits: int) -> DataFrame:
    """doc_id, n, s1, s2 and active of docs(doc_id, text), written to the shared folder: set size, signature of the set,
    and whether at least PERCENT hundredths of the set are in other documents, without which no link is possible."""
    dealt = docs.mapInArrow(_deal(bits), _FIELDS).groupBy("key").applyInArrow(_tally, _FIELDS)
    known = dealt.groupBy("block").applyInArrow(_settle, "doc_id long, n long, s1 long, s2 long, active boolean")
    return staged(known, "profile")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id for each row of docs(doc_id, text).

    A document's set is its distinct shingles of five words with A-Z lower-cased, a shorter text's whole sequence, or
    empty without words. Documents link if 100 * |intersection| >= 80 * |union|; component_id is the smallest doc_id
    that links reach, the document's own included. Equal sets are one node. No link is lost: what can't link by
    the share of its tokens that other documents have is set aside; the rest are ordered by how many nodes have each
    token, the rarest first, documents with equal prefixes and sizes are one group, filtered pairs of groups make
    clusters, and the members of a cluster are verified on whole sets. Components are those of verified links alone.
    Empty sets link with nothing. Rows with a null doc_id get a null component_id and link with nothing; rows that
    repeat a doc_id are judged each by its text. An empty table gives no rows; other columns are left out.
    """
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.coalesce(docs["doc_id"].cast("long"), F.lit(-(2**63))).alias("doc_id"), "text")
    bits = range_bits(rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0)
    known = profile(rows, bits)
    named = known.filter(F.col("active") & (F.col("doc_id") > -(2**63)))
    nodes = staged(named.groupBy("s1", "s2", "n").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies")), "nodes")
    reps = nodes.select(F.col("rep").alias("gm_rep"))
    only = IdFilter.of(reps)
    if not only.sharp:
        rows = rows.join(reps, F.col("doc_id") == F.col("gm_rep"), "left_semi")
    dealt = rows.mapInArrow(_deal_nodes(bits, only), _FIELDS).groupBy("key").applyInArrow(_tally_nodes, _FIELDS)
    sets = staged(dealt.groupBy("block").applyInArrow(_settle_nodes, "node long, n long, grp long, lead long, tokens binary"), "sets")
    groups = sets.select("grp", "n", F.expr("octet_length(tokens) div 8").alias("shared"), F.expr("substring(tokens, 1, int(8 * lead))").alias("prefix")).dropDuplicates(["grp"])
    postings = staged(groups.mapInArrow(_postings, "token long, grp long, n long, place long"), "postings")
    met = components(_near_groups(postings)).withColumnsRenamed({"node": "g", "component": "met"})
    members = sets.join(sized(met), F.col("grp") == F.col("g"), "left").select("node", "n", "lead", "tokens", F.coalesce("met", "grp").alias("cluster"))
    clusters = staged(members.groupBy("cluster").agg(F.count("*").alias("docs"), F.sum("n").alias("total")).filter("docs > 1"), "clusters")
    joined = components(_linked(members, clusters))
    label = staged(nodes.join(joined, nodes["s1"] == joined["node"], "left").select("s1", "s2", "rep", "copies", F.coalesce("component", "s1").alias("label")), "labels")
    least = label.groupBy("label").agg(F.min("rep").alias("component_id"))
    final = label.join(least, "label").filter("copies > 1 OR rep <> component_id").select(F.col("s1").alias("k1"), F.col("s2").alias("k2"), "component_id")
    final = staged(final, "components")
    out = known.join(F.broadcast(final) if is_small(final) else final, (F.col("s1") == F.col("k1")) & (F.col("s2") == F.col("k2")) & F.col("active"), "left")
    doc = F.when(F.col("doc_id") > -(2**63), F.col("doc_id"))
    return out.select(doc.alias("doc_id"), F.col("n").alias("n_shingles"), F.when(doc.isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))


def op4(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))


OP4_SQL = r"""
WITH RECURSIVE w AS MATERIALIZED (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w FROM documents
), s AS MATERIALIZED (
  SELECT DISTINCT doc_id, s FROM (
    SELECT doc_id, array_to_string(w[i:i + 4], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM w WHERE len(w) >= 5)
    UNION ALL SELECT doc_id, array_to_string(w, ' ') FROM w WHERE len(w) BETWEEN 1 AND 4)
), n AS MATERIALIZED (
  SELECT w.doc_id, count(s.s) AS n FROM w LEFT JOIN s USING (doc_id) GROUP BY w.doc_id
), p AS MATERIALIZED (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
), l AS MATERIALIZED (
  SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 80 * (nx.n + ny.n - c)
), r(doc_id, y) AS (
  SELECT doc_id, doc_id FROM w UNION SELECT r.doc_id, l.y FROM r JOIN l ON r.y = l.x
)
SELECT n.doc_id, n.n AS n_shingles, min(r.y) AS component_id FROM n JOIN r USING (doc_id) GROUP BY ALL
"""
