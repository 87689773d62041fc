"""N-gram Jaccard self-join by token-combination prefixes.

A document's set holds its distinct word shingles.  Two sets link when
``den * |intersection| >= num * |union|``.

1. Counting.  Every task counts the shingles of its own documents and passes on those it
   saw twice or more; the largest sums (at most ``frequent`` shingles, a bound on what is
   broadcast) are the *frequent* class, all other shingles the *rare* one.  The classes
   only steer how selective the index is: any choice gives the same links.
2. Prefixes.  In the global order rare shingles come first, by hash, then frequent ones by
   count.  A linked partner lacks at most tau = n - ceil(num/den * n) of a set's shingles.  A
   rare shingle is indexed alone, and a set with enough of them has its prefix extended by
   slack(n) shingles: linked sets then share k entries, not one.  Frequent shingles fall into
   hashed sub-classes and are indexed as pairs within a sub-class, so that losing a sub-class
   of m prefix members takes m - 1 missing shingles; the prefix is extended until losing
   every index entry would take more than tau, and k is 1.
3. Second prefix.  Grouping by entry gives each entry's exact number of sets.  Of the s
   entries that a set shares with any other it keeps the s - k + 1 of fewest sets: linked
   sets share k, hence one of those kept.  A set with fewer than k has no partner.
4. Candidates.  The pairs of an entry of NARROW sets or fewer, made distinct, are compared by
   parity bitmaps: each differing shingle flips one bit, so a Hamming distance above the
   largest symmetric difference that a link allows disproves it.  Wider entries are cut
   into blocks of sets, and a pair of blocks reports a spanning forest of its sets that may
   link, never all pairs.  The components of all these are the clusters in which all links lie.
5. Verification.  Clusters are cut into bounded blocks.  First the true sets of each block are
   compared with each other and with a few pivots of the cluster, which settles most
   clusters.  Where several components remain, the sets outside the largest are compared
   with all sets of the cluster, block by block.

Equal sets are one node throughout, so that exact copies cost one row each.
Sets are compared by 64-bit hashes of shingles; a node is a 64-bit hash of a set.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import wordhash
from .common import Forest, connected_components, discard, frugal, join_rows, marked, sieve, store, stream_groups, workspace

_U = np.uint64
#: Bits of a parity bitmap, by set size, at most.
MOST_BITS = 1 << 14
#: Sets of an entry whose pairs are listed, at most; sets of one block of a wider entry, about.
NARROW, ENTRY_BLOCK = 16, 4096
#: Sets and shingles of one block of a cluster, about; pivots of a cluster of several blocks.
BLOCK_SETS, BLOCK_SHINGLES = 1024, 1_000_000  # of each of the two blocks in a task
PIVOTS = 4
#: A prefix is extended by one in so many of a set's shingles.
SLACK = 50


def _allowed_missing(n: int, num: int, den: int) -> int:
    """Shingles of a set of n that a linked partner may lack."""
    return n - -(-num * n // den)


def slack(n: int, num: int, den: int) -> int:
    """Shingles by which the prefix of a set of n is extended (never fewer for larger sets)."""
    return min(n // SLACK, -(-num * n // den) - 1)


def _sets(batch: pa.RecordBatch, width: int, fold: bool) -> Iterator[list[np.ndarray]]:
    raw, off = wordhash.column_buffers(batch.column("text"))
    for i, j in wordhash.blocks(raw, off):
        h, doc, _, _ = wordhash.words(raw, off[i : j + 1], fold)
        yield wordhash.shingles(h, doc, j - i, width)


def _node(s: np.ndarray) -> int:
    """A set's 64-bit hash, as a signed number."""
    with np.errstate(over="ignore"):
        a = s.sum(dtype=_U) + wordhash.mix(s ^ _U(0x5851F42D4C957F2D)).sum(dtype=_U) * _U(3) + _U(len(s))
        return int(wordhash.mix(np.array([a], _U)).view(np.int64)[0])


def _bits(n: int) -> int:
    return min(MOST_BITS, max(256, 1 << (n - 1).bit_length()))


def _bitmap(s: np.ndarray) -> bytes:
    b = _bits(len(s))
    return np.packbits((np.bincount((s & _U(b - 1)).astype(np.int64), minlength=b) & 1).astype(np.uint8)).tobytes()


def _survey(width: int, fold: bool):
    """Of each document: node, set size, bitmap; at the end the task's repeated shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending: list[np.ndarray] = []
        size = 0
        kept_h, kept_c = np.zeros(0, _U), np.zeros(0, np.int64)
        known: set[int] = set()

        def tally() -> tuple[np.ndarray, np.ndarray]:
            u, c = np.unique(np.concatenate([*pending, np.zeros(0, _U)]), return_counts=True)
            more = c >= 2
            h, n = np.concatenate([kept_h, u[more]]), np.concatenate([kept_c, c[more]])
            u, at = np.unique(h, return_inverse=True)
            return u, np.bincount(at, weights=n, minlength=len(u)).astype(np.int64)

        for batch in batches:
            ids, keys = batch.column("doc_id"), batch.column("key")
            nodes, sizes, maps = [], [], []
            for sets in _sets(batch, width, fold):
                for s in sets:
                    sizes.append(len(s))
                    if not len(s):
                        nodes.append(None)
                        maps.append(None)
                        continue
                    k = _node(s)
                    nodes.append(k)
                    if k in known:  # a copy adds nothing to the counts and has its bitmap already
                        maps.append(None)
                        continue
                    known.add(k)
                    maps.append(_bitmap(s))
                    pending.append(s)
                    size += len(s)
            if size > 1_000_000:
                kept_h, kept_c = tally()
                pending, size = [], 0
            n = len(nodes)
            yield pa.RecordBatch.from_arrays([ids, keys, pa.array(nodes, pa.int64()), pa.array(sizes, pa.int64()), pa.array(maps, pa.binary()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64())], ["doc_id", "key", "node", "n_shingles", "bitmap", "shingle", "seen"])
        h, c = tally()
        for k in range(0, len(h), 50_000):
            m = len(h[k : k + 50_000])
            yield pa.RecordBatch.from_arrays([*(pa.nulls(m, pa.int64()) for _ in range(4)), pa.nulls(m, pa.binary()), pa.array(h[k : k + 50_000].view(np.int64)), pa.array(c[k : k + 50_000])], ["doc_id", "key", "node", "n_shingles", "bitmap", "shingle", "seen"])

    return run


def index_entries(s: np.ndarray, count: np.ndarray, num: int, den: int) -> tuple[np.ndarray, int]:
    """(index entries of one sorted set, k: entries that it shares with a linked set at least).

    count: its shingles' counts in the frequent table, 0 for rare ones.
    """
    n = len(s)
    need = _allowed_missing(n, num, den) + 1
    rare = s[count == 0]
    if len(rare) >= need:
        out = rare[: need + slack(n, num, den)]
        return out, 1 + min(len(out) - need, slack(-(-num * n // den), num, den))
    often = np.flatnonzero(count > 0)
    often = often[np.lexsort((s[often], count[often]))]
    tokens = s[often]
    out = [rare]
    # Sub-classes depend on the size's power of two; a set near a border of sizes is indexed under both.
    short = need - len(rare)
    for scale in range((-(-num * n // den)).bit_length(), (den * n // num).bit_length() + 1):
        if scale < 5:  # small sets: single shingles throughout
            out.append(wordhash.mix(tokens[:short] ^ _U(scale)))
            continue
        classes = max(1, (1 << scale) // 16)
        cls = (tokens >> _U(20)) % _U(classes)
        sub, at = np.unique(cls, return_inverse=True)
        # The k-th member of its sub-class within the prefix adds nothing for k = 1, else one more needed loss.
        order = np.argsort(at, kind="stable")
        starts = np.concatenate([[0], np.cumsum(np.bincount(at, minlength=len(sub)))])[:-1]
        rank = np.empty(len(tokens), np.int64)
        rank[order] = np.arange(len(tokens)) - starts[at[order]]
        gained = np.cumsum(rank > 0)  # reaches `short`: there are fewer sub-classes than shingles any link keeps
        upto = int(np.searchsorted(gained, short)) + 1
        order = order[order < upto]
        for g in np.split(order, np.flatnonzero(np.diff(at[order])) + 1):
            if len(g) > 1:
                t = np.sort(tokens[g])
                i, j = np.triu_indices(len(t), 1)
                with np.errstate(over="ignore"):
                    out.append(wordhash.mix(t[i] * _U(0x9FB21C651E98DF25) + t[j] + _U(scale)))
    return np.concatenate(out), 1


def _index(width: int, fold: bool, num: int, den: int, frequent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, counts = frequent.value
        sieve = np.zeros(1 << 22, bool)
        sieve[(table & _U((1 << 22) - 1)).astype(np.int64)] = True
        known: set[int] = set()
        for batch in batches:
            for sets in _sets(batch, width, fold):
                entries, nodes, least = [], [], []
                for s in sets:
                    if not len(s) or (k := _node(s)) in known:
                        continue
                    known.add(k)
                    count = np.zeros(len(s), np.int64)
                    maybe = np.flatnonzero(sieve[(s & _U((1 << 22) - 1)).astype(np.int64)])
                    if len(maybe) and len(table):
                        p = np.minimum(np.searchsorted(table, s[maybe]), len(table) - 1)
                        count[maybe] = np.where(table[p] == s[maybe], counts[p], 0)
                    e, share = index_entries(s, count, num, den)
                    entries.append(e)
                    nodes.append(np.full(len(e), k, np.int64))
                    least.append(np.full(len(e), share, np.int32))
                if entries:
                    e, k, m = np.concatenate(entries).view(np.int64), np.concatenate(nodes), np.concatenate(least)
                    for a in range(0, len(e), 100_000):
                        yield pa.RecordBatch.from_arrays([pa.array(x[a : a + 100_000]) for x in (e, k, m)], ["entry", "node", "k"])

    return run


def _unpack(maps: list[bytes]) -> list[np.ndarray]:
    return [np.frombuffer(m, np.uint64) for m in maps]


def _may_link(x: np.ndarray, y: np.ndarray, nx: int, ny: int, num: int, den: int) -> bool:
    """False only if the bitmaps or sizes disprove a link."""
    if den * min(nx, ny) < num * max(nx, ny):
        return False
    if len(x) > len(y):
        x, y = y, x
    while len(y) > len(x):
        h = len(y) // 2
        y = y[:h] ^ y[h:]
    # |x ^ y| <= (nx + ny)(den - num)/(den + num) for linked sets
    return int(np.bitwise_count(x ^ y).sum()) * (den + num) <= (nx + ny) * (den - num)


def _narrow(num: int, den: int):
    """Rows sorted by entry, each with its entry's number of sets: pairs (a, b) of narrow entries, sizes permitting; rows of wide ones as they are."""

    def pairs(e: np.ndarray, k: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        found = []
        for d in range(1, min(NARROW, len(e))):
            low, high = np.minimum(n[:-d], n[d:]), np.maximum(n[:-d], n[d:])
            at = np.flatnonzero((e[:-d] == e[d:]) & (den * low >= num * high))
            found.append(np.stack([np.minimum(k[at], k[at + d]), np.maximum(k[at], k[at + d])], 1))
        if found:
            a, b = np.unique(np.concatenate(found), axis=0).T
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), *(pa.nulls(len(a), pa.int64()) for _ in range(3))], ["a", "b", "entry", "node", "sets"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int64)] * 3
        for batch in batches:
            far = pc.greater(batch.column("sets"), NARROW)
            wide = batch.filter(far)
            if wide.num_rows:
                yield pa.RecordBatch.from_arrays([pa.nulls(wide.num_rows, pa.int64()), pa.nulls(wide.num_rows, pa.int64()), *(wide.column(c) for c in ("entry", "node", "sets"))], ["a", "b", "entry", "node", "sets"])
            near = batch.filter(pc.invert(far))
            held = [np.concatenate([h, near.column(c).to_numpy()]) for h, c in zip(held, ("entry", "node", "n_shingles"), strict=True)]
            if len(held[0]):  # the last entry may go on in the next batch
                cut = int(np.append(-1, np.flatnonzero(held[0] != held[0][-1]))[-1]) + 1
                yield from pairs(*(h[:cut] for h in held))
                held = [h[cut:] for h in held]
        yield from pairs(*held)

    return run


def _likely(num: int, den: int):
    """Of pairs (a, b, their sizes and bitmaps), those that may link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, maps = [batch.column(c).to_pylist() for c in ("na", "nb")], [_unpack(batch.column(c).to_pylist()) for c in ("ma", "mb")]
            ok = [_may_link(x, y, n, m, num, den) for x, y, n, m in zip(*maps, *sizes, strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return run


def _forests(num: int, den: int):
    """Spanning edges of the sets of each pair of blocks of an entry that may link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[tuple[int, int]] = set()
        for group in stream_groups(batches, ["entry", "left", "right"]):
            nodes, first = np.unique(group["node"].to_numpy(), return_index=True)
            left, right = (group[c][0].as_py() for c in ("left", "right"))
            part = group["part"].to_numpy()[first]
            sizes = group["n_shingles"].to_numpy()[first]
            maps = _unpack(group["bitmap"].take(pa.array(first)).to_pylist())
            forest = Forest(len(nodes))
            by_bits: dict[int, list[int]] = {}
            for i, m in enumerate(maps):
                by_bits.setdefault(len(m), []).append(i)
            for bits, own in by_bits.items():
                near = [i for b, other in by_bits.items() if bits <= b <= 4 * bits for i in other]
                folded = []
                for i in near:
                    y = maps[i]
                    while len(y) > bits:
                        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
                    folded.append(y)
                near = np.array(near)
                # Of two blocks, the sets of one meet those of the other only.
                for a, b in {(left, right), (right, left)}:
                    mine, theirs = [i for i in own if part[i] == a], np.flatnonzero(part[near] == b)
                    if not mine or not len(theirs):
                        continue
                    grid, met = np.stack([folded[j] for j in theirs.tolist()]), near[theirs]
                    m = sizes[met]
                    for i in mine:
                        n = int(sizes[i])
                        dist = np.bitwise_count(grid ^ maps[i]).sum(1, dtype=np.int64)
                        ok = (dist * (den + num) <= (m + n) * (den - num)) & (den * np.minimum(m, n) >= num * np.maximum(m, n))
                        for j in met[ok].tolist():
                            forest.join(i, j)
            root = forest.roots()
            off = np.flatnonzero(root != np.arange(len(nodes)))
            new = [p for p in zip(nodes[off].tolist(), nodes[root[off]].tolist(), strict=True) if p not in done]
            if len(done) > 1_000_000:
                done.clear()
            done.update(new)
            if new:
                yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in new], pa.int64()), pa.array([p[1] for p in new], pa.int64())], ["a", "b"])

    return run


def block_links(sets: list[np.ndarray], num: int, den: int) -> np.ndarray:
    """The root of each set in the forest of this block's links (all pairs, in column slabs)."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets], np.int64)
    u, at, c = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    dense = np.cumsum(c > 1) - 1
    owner = np.repeat(np.arange(n), sizes)
    shared = c[at] > 1
    owner, col = owner[shared], dense[at[shared]]
    both = np.zeros((n, n), np.float32)
    total, slab = int((c > 1).sum()), max(256, 8_000_000 // n)
    order = np.argsort(col, kind="stable")
    owner, col = owner[order], col[order]
    for a in range(0, total, slab):
        i, j = np.searchsorted(col, [a, a + slab])
        m = np.zeros((n, min(slab, total - a)), np.float32)
        m[owner[i:j], col[i:j] - a] = 1
        both += m @ m.T
    inter = np.rint(both).astype(np.int64)
    union = sizes[:, None] + sizes[None, :] - inter
    linked = den * inter >= num * union
    label = np.arange(n)
    for i in range(n):
        join_rows(label, i, np.flatnonzero(linked[i]))
    return label


def _verify(width: int, fold: bool, num: int, den: int):
    """Spanning edges (a, b) of the links among the sets of each task (cluster, left, right)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in stream_groups(batches, ["cluster", "left", "right"]):
            known: dict[int, np.ndarray] = {}
            for batch in group.to_batches(max_chunksize=1024):
                of = iter(batch.column("node").to_pylist())
                # A text of another node is another row of a repeated key.
                known |= {k: s for sets in _sets(batch, width, fold) for s, k in zip(sets, of) if len(s) and _node(s) == k}  # noqa: B905
            if len(known) < 2:
                continue
            nodes = np.array(sorted(known), np.int64)
            root = block_links([known[k] for k in nodes.tolist()], num, den)
            off = np.flatnonzero(root != np.arange(len(nodes)))
            if len(off):
                yield pa.RecordBatch.from_arrays([pa.array(nodes[off]), pa.array(nodes[root[off]])], ["a", "b"])

    return run


def _candidates(shared: DataFrame, nodes: DataFrame, at: str, num: int, den: int) -> DataFrame:
    """Edges (a, b) whose components hold all links; shared: the second prefixes (entry, node, n_shingles)."""
    w = Window.partitionBy("entry")
    counted = shared.withColumn("sets", F.count("*").over(w)).filter("sets > 1").sortWithinPartitions("entry")
    found = store(counted.mapInArrow(frugal(_narrow(num, den)), "a long, b long, entry long, node long, sets long"), at, "found")
    maps = nodes.select("node", "n_shingles", "bitmap")
    pairs = found.filter("a IS NOT NULL").select("a", "b").distinct()
    for side in ("a", "b"):
        pairs = pairs.join(maps.select(F.col("node").alias(side), F.col("n_shingles").alias(f"n{side}"), F.col("bitmap").alias(f"m{side}")), side)
    blocks = F.ceil(F.col("sets") / ENTRY_BLOCK).cast("long")
    wide = found.filter("entry IS NOT NULL").select("entry", "node", blocks.alias("blocks")).join(maps, "node").withColumn("part", F.pmod(F.xxhash64("node"), F.col("blocks")))
    wide = wide.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    wide = wide.select("entry", F.least("part", "other").alias("left"), F.greatest("part", "other").alias("right"), "part", "node", "n_shingles", "bitmap")
    task = ["entry", "left", "right"]
    forests = wide.repartition(*task).sortWithinPartitions(*task).mapInArrow(frugal(_forests(num, den)), "a long, b long")
    return pairs.mapInArrow(frugal(_likely(num, den)), "a long, b long").union(forests)


def _compared(rows: DataFrame, texts: DataFrame, width: int, fold: bool, num: int, den: int) -> DataFrame:
    """Edges (a, b) of the links within each task; rows: cluster, left, right, node and the key of a row with its text."""
    # Texts without candidates are not shuffled; of rows that are repeated one counts.
    own = marked(texts, "key", sieve(rows, "key"), "near").filter("near").groupBy("key").agg(F.first("text").alias("text"))
    task = ["cluster", "left", "right"]
    met = rows.join(own, "key").select(*task, "node", "text")
    return met.repartition(*task).sortWithinPartitions(*task).mapInArrow(frugal(_verify(width, fold, num, den)), "a long, b long")


def _links(clusters: DataFrame, nodes: DataFrame, texts: DataFrame, at: str, width: int, fold: bool, num: int, den: int) -> DataFrame:
    """(node, component) of the nodes that link; clusters: node, cluster; texts: key, text."""

    def blocks(count: Column) -> Column:
        return F.greatest(F.ceil(count / BLOCK_SETS), F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES)).cast("long")

    rows = clusters.join(nodes.select("node", "n_shingles", "key"), "node")
    about = rows.groupBy("cluster").agg(blocks(F.count("*")).alias("parts"), *[F.min(F.xxhash64("node", F.lit(k))).alias(f"p{k}") for k in range(PIVOTS)])
    pivot = F.lit(False)
    for k in range(PIVOTS):
        pivot = pivot | (F.xxhash64("node", F.lit(k)) == F.col(f"p{k}"))
    part = F.pmod(F.xxhash64("node"), F.col("parts"))
    members = store(rows.join(about, "cluster").select("cluster", "parts", part.alias("part"), (pivot & (F.col("parts") > 1)).alias("pivot"), "node", "n_shingles", "key"), at, "members")
    own = members.withColumn("left", F.explode(F.when(F.col("pivot"), F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).otherwise(F.array("part")))).withColumn("right", F.col("left"))
    first = connected_components(_compared(own, texts, width, fold, num, den), at, "first")

    # Clusters of several blocks that are not one component yet: those outside its largest one against all.
    open_ = members.filter("parts > 1").join(first, "node", "left").withColumn("component", F.coalesce("component", "node"))
    groups = open_.groupBy("cluster", "component").agg(F.count("*").alias("n"))
    several = groups.groupBy("cluster").agg(F.max(F.struct("n", "component")).alias("top"), F.count("*").alias("n")).filter("n > 1").select("cluster", F.col("top.component").alias("largest"))
    rest = open_.join(several, "cluster").withColumn("out", F.col("component") != F.col("largest"))
    rest = store(rest, at, "rest")
    if rest.isEmpty():
        return first
    outside = rest.filter("out").groupBy("cluster").agg(blocks(F.count("*")).alias("lots"))
    lot = F.pmod(F.xxhash64("node", F.lit("lot")), F.col("lots"))
    both = rest.join(outside, "cluster")
    columns = [F.col(c) for c in ("cluster", "left", "right", "node", "key")]
    met = both.withColumn("left", F.explode(F.sequence(F.lit(0).cast("long"), F.col("lots") - 1))).withColumn("right", F.col("part")).select(*columns)
    mine = both.filter("out").withColumn("left", lot).withColumn("right", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))).select(*columns)
    second = _compared(met.union(mine), texts, width, fold, num, den)
    return connected_components(first.select(F.col("node").alias("a"), F.col("component").alias("b")).union(second), at, "second")


def jaccard_components(docs: DataFrame, width: int = 5, num: int = 80, den: int = 100, fold: bool = True, frequent: int = 1 << 19) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of docs (doc_id, text; other columns are ignored).

    width: words of a shingle; a link takes num/den similarity; fold: A-Z count as a-z;
    frequent: shingles of the frequent class at most (16 bytes each are broadcast).
    Words are runs of characters other than space and 0x09-0x0D.  A text of fewer than
    `width` words has its whole sequence as its one shingle; a null, empty or wordless
    text has none and is its own component.  Repeated doc_ids keep their rows; a row of null
    doc_id links like any other, and its component_id is the smallest id of its class, null without one.
    """
    if not den <= 2 * num <= 2 * den:
        raise ValueError("the similarity must be from 0.5 to 1")
    spark = docs.sparkSession
    at = workspace(spark, "jaccard")
    text = F.col("text").cast("string")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("doc_id").cast("long"), text).alias("key"), text.alias("text"))
    survey = store(texts.mapInArrow(frugal(_survey(width, fold)), "doc_id long, key long, node long, n_shingles long, bitmap binary, shingle long, seen long"), at, "survey")
    rows = survey.filter("shingle IS NULL")
    sums = store(survey.filter("shingle IS NOT NULL").groupBy("shingle").agg(F.sum("seen").alias("seen")).withColumn("step", F.floor(16 * F.log2("seen")).cast("int")), at, "sums")
    # At most a thousand steps of counts: the lowest one from which no more than `frequent` shingles remain.
    total, least = 0, 1 << 30
    for step, n in sorted(map(tuple, sums.groupBy("step").count().collect()), reverse=True):
        total += n
        if total > frequent:
            break
        least = step
    top = sums.filter(F.col("step") >= least).select("shingle", "seen").toArrow()
    table = top["shingle"].to_numpy().view(_U)
    order = np.argsort(table)
    shared_table = spark.sparkContext.broadcast((table[order], top["seen"].to_numpy()[order]))
    del top, table, order

    # Each entry's sets, then each set's second prefix. A set can come from several tasks.
    entries = texts.select("doc_id", "text").mapInArrow(frugal(_index(width, fold, num, den, shared_table)), "entry long, node long, k int")
    w = Window.partitionBy("entry")
    once = F.coalesce(F.lag("node").over(w.orderBy("node")) != F.col("node"), F.lit(True))
    shared = entries.withColumn("sets", F.count("*").over(w)).withColumn("lo", F.min("node").over(w)).withColumn("hi", F.max("node").over(w)).withColumn("once", once).filter("lo < hi AND once")
    shared = store(shared.select("entry", "node", "k", "sets"), at, "shared")
    discard(spark, at, "sums")
    own = Window.partitionBy("node")
    kept = shared.withColumn("s", F.count("*").over(own)).filter("s >= k").withColumn("place", F.row_number().over(own.orderBy("sets", "entry"))).filter("place <= s - k + 1").select("entry", "node")
    nodes = store(rows.filter("node IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("rep"), F.max("n_shingles").alias("n_shingles"), F.max("bitmap").alias("bitmap"), F.min("key").alias("key")), at, "nodes")
    candidates = _candidates(kept.join(nodes.select("node", "n_shingles"), "node"), nodes, at, num, den)
    clusters = connected_components(candidates, at, "clusters").withColumnRenamed("component", "cluster")
    discard(spark, at, "shared", "found")
    component = _links(clusters, nodes, texts.select("key", "text"), at, width, fold, num, den)
    named = nodes.select("node", "rep").join(component, "node", "left").select("node", "rep", F.coalesce("component", "node").alias("component"))
    smallest = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    named = store(named.join(smallest, "component").select("node", "component_id"), at, "named")
    discard(spark, at, "members", "rest")
    return rows.join(named, "node", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
