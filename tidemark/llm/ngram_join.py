"""N-gram Jaccard join by token-combination prefixes.

A document is the set of its distinct k-word shingles. Two documents link when
``100 * |intersection| >= percent * |union|``, in whole numbers.

1. Equal sets collapse to one representative (smallest id) by a 128-bit digest and the set's size, with
   map-side partial aggregation, so thousands of copies cost one row for each task.
2. Shingles fall into frequency classes by a count sketch of fixed size (``SKETCH_BITS``) over all documents: class 1
   is rare, class 2 and 3 are frequent. The sketch only orders shingles; any order gives the same links.
3. Each set is ordered by the sketch's count, rarest first, then hash; classes are ranges of that count. Its prefix is extended until its coverage,
   ``sum over classes max(0, p_c - (c - 1))``, is above what a partner may lack, n - ceil(percent * n / 100). Class 1
   gives single shingles as signatures; class c gives its c-shingle combinations. Two linked sets share a
   signature: else their common shingles in the prefix that ends first are fewer than c in each class, and the
   rest of that set can't hold the others. To keep combinations few in long texts, a frequent class is cut by hash
   into as many subclasses as suit the set's size stratum; a set is signed for its own stratum and the next, as
   partners differ by one stratum at most.
   A set of ``SMALL_SET`` or more with enough rare shingles for a prefix longer by ``SHARED - 1`` shares ``SHARED`` of them with
   each partner whose prefix ends later; for other sets one shared signature is enough.
4. Of lists of sets with one signature of up to ``SMALL_LIST`` all pairs are counted, and those with enough shared signatures are
   candidates (a pair that shares a longer list is found there as well). In a longer list each member first meets one pivot, the member of most
   long lists. From then on, a list's largest component is its home; lists with one home are put together, so that two sets meet once and not in each list that they share. Sets
   outside a home are pivots, in rounds of ``PIVOTS``, and meet all members, each over the lists put together or one by one, whatever are
   fewer meetings, until the members that were no pivot are all in one component. A pair
   within one component needs no comparison, as only components are asked for; no other pair is left out. Sizes and 256-bit
   parity bitmaps rule out pairs inside the joins: they differ in no more bits than the sets differ in items.
5. Candidates are verified on whole sets (64-bit shingle hashes). Texts whose sets are needed are picked by a bitmap of fixed size
   (``WANTED_BITS``) in one more pass, so that no other text is shuffled.

Null, empty and blank texts have no set: n_shingles 0, linked with nothing, each its own component. Each row is a node of its own, rows that repeat an
id and rows without one too; a component's id is the smallest doc_id in it, null if none has one. An empty table gives an empty result. Other columns
are ignored, whatever their names.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import kernel as K
from tidemark.llm.common import Workspace, blocks, hash_bitmap, in_bitmap, merged, text_buffers, trimmed
from tidemark.llm.graph import components

SKETCH_BITS = 22
WANTED_BITS = 24
SMALL_LIST = 32
PIVOTS = 1024
MEETINGS = 1_000_000
SHARED = 3
SMALL_SET = 32
BITS = ("b0", "b1", "b2", "b3")
U = np.uint64
_NONE = np.zeros(0, U)


def _sets(raw, off, k):
    h, counts = K.words(raw, off)
    return K.distinct_sorted(*K.shingles(h, counts, k))


def _count_sketch(docs: DataFrame, k: int) -> np.ndarray:
    """Counts of shingles by hash bucket over all documents: 2**SKETCH_BITS numbers, whatever the input's size."""

    def count(batches):
        total = np.zeros(1 << SKETCH_BITS, np.uint32)
        for batch in batches:
            raw, off = text_buffers(batch.column(0))
            for a, b in blocks(off):
                v, _ = _sets(raw, off[a : b + 1], k)
                at, n = np.unique((v >> U(64 - SKETCH_BITS)).astype(np.int32), return_counts=True)
                total[at] += n.astype(np.uint32)
        return total

    def add(a, b):
        return a + np.minimum(b, ~a)  # up to the largest number

    return merged(docs.select("text"), count, 1 << SKETCH_BITS, np.uint32, add)


def levels_of(counts: np.ndarray) -> tuple[np.ndarray, int, int]:
    """Rank of every sketch bucket's count, in steps of a quarter of a power of two, and the first ranks of class 2
    and class 3: rare is up to four times the mean load, and 64."""
    rare = max(64, 4 * int(counts.mean(dtype=np.float64) + 1))
    level = lambda x: np.floor(4 * np.log2(np.maximum(x, 1))).astype(np.uint8)
    return level(counts), int(level(np.array([rare]))[0]) + 1, int(level(np.array([64 * rare]))[0]) + 1


def stratum(n: np.ndarray, percent: int) -> np.ndarray:
    """Size stratum: sets of sizes n <= m with 100 n >= percent m are in one or in neighbouring strata."""
    return np.floor(np.log(np.maximum(n, 1)) / -np.log(percent / 100) + 1e-9).astype(np.int64)


def signatures(v: np.ndarray, level: np.ndarray, second: int, third: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of one set, those of which ``SHARED`` must be shared and those of which one is enough: ``v`` its hashes, ``level`` the ranks of their counts, by which they are ordered."""
    n = len(v)
    need = n - -(-percent * n // 100) + 1
    if 100 * n < percent * (n + 1):
        return _NONE, _NONE  # only equal sets can link
    order = np.lexsort((v, level))
    v, level = v[order], level[order]
    cls = (level >= second).astype(np.int8) + (level >= third)
    rare = v[cls == 0]
    if n >= SMALL_SET and len(rare) >= need + SHARED - 1:
        return K.mix(rare[: need + SHARED - 1] + K.MULT[40]), _NONE
    if len(rare) >= need:
        return _NONE, K.mix(rare[:need] + K.MULT[40])
    out, rest = [], need - len(rare)
    own = int(stratum(np.array([n]), percent)[0])
    for variant in (own, own + 1):
        left, groups = rest, max(1, int((percent / 100) ** -variant) // 48)
        for c in (1, 2):
            x = v[cls == c]
            if left <= 0 or not len(x):
                continue
            part = ((x * K.MULT[41]) >> U(33)).astype(np.int64) % groups
            taken: dict[int, list[int]] = {}
            for g, value in zip(part.tolist(), x.tolist()):
                if left <= 0:
                    break
                mine = taken.setdefault(g, [])
                mine.append(value)
                left -= len(mine) > c
            combos = [y for m in taken.values() for y in combinations(m, c + 1)]
            if combos:
                m = np.array(combos, U)
                h = np.full(len(m), (variant * 64 + c * 16) & 0xFFFFFFFF, U)
                for j in range(c + 1):
                    h = K.mix(h + m[:, j] * K.MULT[42 + j])
                out.append(h)
        if left > 0:
            raise AssertionError("a set's classes don't cover its prefix")
    return _NONE, np.unique(np.concatenate([K.mix(rare + K.MULT[40]), *out]))


_PROFILE = f"doc_id long, h long, n long, d1 long, d2 long, {', '.join(f'{b} long' for b in BITS)}, sigs array<long>, combos array<long>"


def _profile(rows: DataFrame, k: int, percent: int, sketch) -> DataFrame:
    """(doc_id, h, n, d1, d2, bits, sigs, combos) of every row."""

    def run(batches):
        rank, second, third = sketch.value
        for batch in batches:
            (raw, off) = text_buffers(batch.column(2))
            for a, b in blocks(off):
                v, m = _sets(raw, off[a : b + 1], k)
                c = rank[(v >> U(64 - SKETCH_BITS)).astype(np.int64)]
                edge = np.concatenate(([0], np.cumsum(m))).tolist()
                sigs = [signatures(v[x:y], c[x:y], second, third, percent) for x, y in zip(edge[:-1], edge[1:])]
                lists = [
                    pa.ListArray.from_arrays(
                        pa.array(np.concatenate(([0], np.cumsum([len(s[i]) for s in sigs]))), pa.int32()),
                        pa.array(np.concatenate([s[i] for s in sigs]).view(np.int64), pa.int64()),
                    )
                    for i in (0, 1)
                ]
                cell = np.repeat(np.arange(b - a), m) * 256 + ((v * K.MULT[51]) >> U(56)).astype(np.int64)
                odd = (np.bincount(cell, minlength=(b - a) * 256) & 1).astype(np.uint8)
                bits = np.packbits(odd.reshape(b - a, 256), axis=1).view(np.int64)
                sums = [pa.array(K.sums(x, m).view(np.int64)) for x in (v, K.mix(v ^ K.MULT[50]))]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), pa.array(m, pa.int64()), *sums, *[pa.array(bits[:, i].copy()) for i in range(4)], *lists],
                    ["doc_id", "h", "n", "d1", "d2", *BITS, "sigs", "combos"],
                )

    return rows.mapInArrow(trimmed(run), _PROFILE)


def _set_table(rows: DataFrame, k: int, bitmap) -> DataFrame:
    """(doc_id, h, items): the sorted shingle hashes, as bytes, of the rows whose key is in the bitmap."""

    def run(batches):
        for batch in batches:
            due = in_bitmap(bitmap.value, np.asarray(batch.column(3)).view(U), WANTED_BITS)
            batch = batch.filter(pa.array(due))
            raw, off = text_buffers(batch.column(2))
            for a, b in blocks(off):
                v, m = _sets(raw, off[a : b + 1], k)
                edge = np.concatenate(([0], np.cumsum(m))).tolist()
                items = pa.array([v[x:y].tobytes() for x, y in zip(edge[:-1], edge[1:])], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), items], ["doc_id", "h", "items"])

    return rows.select("doc_id", "h", "text", _row_key("doc_id", "h").alias("key")).mapInArrow(trimmed(run), "doc_id long, h long, items binary")


def _row_key(doc_id: str, h: str):
    return F.xxhash64(F.col(doc_id), F.col(h))


def _verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that link. Hot partners are split by the adaptive skew join."""

    def run(batches):
        for batch in batches:
            x, y = batch.column(2), batch.column(3)
            keep = []
            for i in range(batch.num_rows):
                p, q = np.frombuffer(x[i].as_buffer(), U), np.frombuffer(y[i].as_buffer(), U)
                if len(p) > len(q):
                    p, q = q, p
                at = np.searchsorted(q, p)
                at[at == len(q)] = 0
                common = int((q[at] == p).sum()) if len(q) else 0
                keep.append(100 * common >= percent * (len(p) + len(q) - common))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], ["a", "b"])

    left = sets.select(F.col("id").alias("a"), F.col("items").alias("x"))
    right = sets.select(F.col("id").alias("b"), F.col("items").alias("y"))
    return pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(trimmed(run), "a long, b long")


def jaccard_components(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, text_hash, n_shingles, component_id, class_id, component) for every row of ``docs`` (doc_id long, text string).

    class_id is the smallest id with an equal set, and component a number of the component, null for a row without a set. ``percent`` from 80 to 100: below, a small
    set's classes may leave too little coverage.
    """
    if not 80 <= percent <= 100:
        raise ValueError("percent must be from 80 to 100")
    spark = docs.sparkSession
    ws = Workspace(spark, "ngram_join")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("text").cast("string")).alias("h"), F.col("text").cast("string").alias("text"))
    sketch = spark.sparkContext.broadcast(levels_of(_count_sketch(rows, k)))
    profile = ws.put(_profile(rows, k, percent, sketch), "profile")
    sketch.destroy()

    key = ["n", "d1", "d2"]
    # Equal sets have equal signatures, so any row of a class gives them. A node is a class; its number is fixed once it is written.
    who = F.min(F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "h")).alias("who")
    classes = profile.where("n > 0").groupBy(*key).agg(who, *[F.first(c).alias(c) for c in (*BITS, "sigs", "combos")])
    classes = ws.put(classes.select(F.monotonically_increasing_id().alias("rep"), "who", *key, *BITS, "sigs", "combos"), "classes")
    signed = F.concat(F.transform("sigs", lambda x: F.struct(x.alias("sig"), F.lit(1).alias("w"))), F.transform("combos", lambda x: F.struct(x.alias("sig"), F.lit(SHARED).alias("w"))))
    posts = classes.select("rep", F.col("n").cast("int").alias("n"), F.inline(signed))
    lists = posts.groupBy("sig").agg(F.count("*").alias("members")).where("members > 1")
    posts = ws.put(posts.join(lists, "sig"), "posts")

    bits = classes.select("rep", *BITS)
    near = _near(percent)
    small = posts.where(f"members <= {SMALL_LIST}").select("sig", "rep", "n", "w").join(bits, "rep")
    other = small.select("sig", F.col("rep").alias("other"), F.col("n").alias("m"), F.col("w").alias("w2"), *[F.col(b).alias(f"c{b}") for b in BITS])
    pairs = (
        small.join(other, "sig").where(near & (F.col("rep") < F.col("other"))).groupBy(F.col("rep").alias("a"), F.col("other").alias("b"))
        .agg(F.sum(F.greatest("w", "w2")).alias("shared")).where(f"shared >= {SHARED}").select("a", "b")
    )
    pairs = ws.put(pairs, "pairs")
    large = posts.where(f"members > {SMALL_LIST}").select("sig", "rep", "n")
    degree = large.groupBy("rep").agg(F.count("*").alias("degree"))
    large = ws.put(large.join(degree, "rep").join(bits, "rep").select("sig", "rep", "n", "degree", *BITS), "large0")
    most = large.count()  # no later table of members of long lists has more rows
    ws.drop("posts")
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("rep")).union(large.select("rep")).distinct()
    wanted = ws.put(wanted.join(classes.select("rep", "who"), "rep").select("rep", "who.doc_id", "who.h", _row_key("who.doc_id", "who.h").alias("key")), "wanted")
    nodes = wanted.count()  # nor any of components
    bitmap = spark.sparkContext.broadcast(hash_bitmap(wanted, "key", WANTED_BITS))
    sets = _set_table(rows, k, bitmap).withColumnsRenamed({"doc_id": "doc_id2", "h": "h2"})
    sets = sets.join(wanted, F.col("doc_id2").eqNullSafe(F.col("doc_id")) & (F.col("h2") == F.col("h"))).groupBy(F.col("rep").alias("id")).agg(F.first("items").alias("items"))
    sets = ws.put(sets, "sets")
    bitmap.destroy()
    ws.drop("wanted")

    comp = None
    for rnd in range(1 << 30):
        if not rnd:
            met = large.join(_first_pivots(large), "sig").where(near & (F.col("rep") != F.col("pivot")))
            met = pairs.union(_ordered(met))
        else:
            large = ws.put(_open(large, comp), f"large{rnd}", most)
            ws.drop(f"large{rnd - 1}")
            if large.isEmpty():
                break
            pivots = ws.put(_pivots(ws, large, most), "pivots", most)
            met = _met(ws, large, pivots, near, most)
        found = ws.put(_verify(met.distinct(), sets, percent), "links")
        if rnd:
            large = ws.put(large.select("sig", "rep", "n", "degree", *BITS).join(pivots.select("sig", "rep"), ["sig", "rep"], "left_anti"), f"rest{rnd}", most)
            ws.drop(f"rest{rnd - 1}" if rnd > 1 else "pairs")
        new = ws.put(_merge(ws, comp, found, rnd, nodes), f"comp{rnd}", nodes)
        ws.drop("links", f"comp{rnd - 1}")
        comp = new

    named = classes.select(F.col("rep").alias("node"), "who").join(comp.withColumnRenamed("id", "node"), "node")
    named = named.groupBy("component").agg(F.min("who").alias("least"))
    label = comp.join(named, "component").select(F.col("id").alias("rep"), "component", F.col("least.doc_id").alias("smallest"), F.lit(True).alias("linked"))
    of = classes.select("rep", *key, F.col("who.doc_id").alias("class_id")).join(label, "rep", "left")
    of = of.select(*key, "class_id", F.coalesce("component", "rep").alias("component"), F.when(F.col("linked"), F.col("smallest")).otherwise(F.col("class_id")).alias("component_id"), F.lit(True).alias("live"))
    out = profile.select("doc_id", "h", *key).join(of, key, "left").select(
        "doc_id", F.col("h").alias("text_hash"), F.col("n").alias("n_shingles"), F.when(F.col("live"), F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.when(F.col("live"), F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"), "component",
    )
    out = ws.put(out, "result")
    ws.keep("result")
    return out


def _ordered(met: DataFrame) -> DataFrame:
    return met.select(F.least("rep", "pivot").alias("a"), F.greatest("rep", "pivot").alias("b"))


def _merge(ws: Workspace, comp: DataFrame | None, links: DataFrame, rnd: int, nodes: int) -> DataFrame:
    """(id, component) after new links: they join components that are known by now, so each round's graph holds only what it has found."""
    if comp is None:
        return components(ws, links, f"cc{rnd}_")
    a, b = (comp.select(F.col("id").alias(x), F.col("component").alias(f"c{x}")) for x in ("a", "b"))
    edges = links.join(a, "a", "left").join(b, "b", "left").select("a", "b", F.coalesce("ca", "a").alias("ca"), F.coalesce("cb", "b").alias("cb"))
    moved = ws.put(components(ws, edges.select(F.col("ca").alias("a"), F.col("cb").alias("b")), f"cc{rnd}_"), f"moved{rnd}", nodes)
    moved = moved.select(F.col("component").alias("to"), F.col("id").alias("component"))
    every = comp.union(links.select(F.explode(F.array("a", "b")).alias("id")).distinct().join(comp, "id", "left_anti").select("id", F.col("id").alias("component")))
    return every.join(moved, "component", "left").select("id", F.coalesce("to", "component").alias("component"))


def _open(large: DataFrame, comp: DataFrame) -> DataFrame:
    """Members of lists that still span components, with their components."""
    named = large.join(comp.withColumnRenamed("id", "rep"), "rep", "left").withColumn("c", F.coalesce("component", "rep")).drop("component")
    spans = named.groupBy("sig").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo < hi").select("sig")
    return named.join(spans, "sig")


def _first_pivots(large: DataFrame) -> DataFrame:
    """(sig, pivot, ...): the member of most long lists."""
    who = F.struct((-F.col("degree")).alias("d"), F.xxhash64("rep").alias("r"), "rep", "n", *BITS)
    return large.groupBy("sig").agg(F.min(who).alias("w")).select("sig", *_as_pivot("w"))


def _as_pivot(w: str) -> list:
    return [F.col(f"{w}.rep").alias("pivot"), F.col(f"{w}.n").alias("m"), *[F.col(f"{w}.{b}").alias(f"c{b}") for b in BITS]]


def _pivots(ws: Workspace, large: DataFrame, most: int) -> DataFrame:
    """(sig, home, rep, ..., apart): the pivots of each home, and how many members each would meet list by list. Of the sets outside of their list's
    largest component, all where they are at most ``PIVOTS``, else the first for each of so many salts."""
    sizes = large.groupBy("sig", "c").agg(F.count("*").alias("k"))
    home = sizes.groupBy("sig").agg(F.max(F.struct("k", "c")).alias("big"), F.sum("k").alias("members")).select("sig", F.col("big.c").alias("home"), "members")
    out = large.join(home, "sig").where("c <> home")
    one = out.groupBy("home", "rep").agg(F.sum("members").alias("apart"), F.max("degree").alias("degree"))
    outside = ws.put(one.groupBy("home").agg(F.count("*").alias("outside")), "outside", most)  # of known size, so that members are not dealt by home for it
    salt = F.when(F.col("outside") <= PIVOTS, F.col("rep")).otherwise(F.pmod(F.xxhash64("rep"), F.lit(PIVOTS)))
    best = F.min(F.struct((-F.col("degree")).alias("d"), F.xxhash64("rep").alias("r"), "rep", "apart")).alias("w")
    chosen = one.join(outside, "home").groupBy("home", salt.alias("salt")).agg(best).select("home", "w.rep", "w.apart")
    return out.join(chosen, ["home", "rep"]).select("sig", "home", "rep", "n", "c", "degree", *BITS, "apart")


def _met(ws: Workspace, large: DataFrame, pivots: DataFrame, near, most: int) -> DataFrame:
    """Pairs (a, b) of pivots and members of another component, over all lists of a home or list by list, whatever is less."""
    lists = pivots.select("sig", "home").distinct()
    together = large.join(lists, "sig").groupBy("home", "rep").agg(*[F.first(c).alias(c) for c in ("n", "c", *BITS)])
    number = together.groupBy("home").agg(F.count("*").alias("together")).join(pivots.groupBy("home").agg(F.count_distinct("rep").alias("meet")), "home")
    number = number.select("home", "together", F.least(F.lit(PIVOTS), F.ceil(F.col("meet") * F.col("together") / MEETINGS)).cast("int").alias("parts"))
    number = ws.put(number, "number", most)
    pivots = pivots.join(number, "home").withColumn("wide", F.col("apart") > F.col("together"))
    who = F.struct("rep", "n", *BITS)
    wide = pivots.where("wide").groupBy("home", "rep").agg(F.first(who).alias("w"), F.first("c").alias("pc"), F.first("parts").alias("parts"))
    wide = wide.select("home", F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int").alias("part"), "pc", *_as_pivot("w"))
    together = together.join(number, "home").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))  # a home of very many meetings is split
    narrow = pivots.where("not wide").select("sig", F.col("c").alias("pc"), who.alias("w")).select("sig", "pc", *_as_pivot("w"))
    apart = near & (F.col("c") != F.col("pc"))
    return _ordered(together.join(wide, ["home", "part"]).where(apart)).union(_ordered(large.join(narrow, "sig").where(apart)))


def _near(percent: int):
    """What two sets (n, bits) and (m, cbits) must fulfil to link, cheap to test: sizes, and the parity bitmaps, which differ in no more bits than
    the sets differ in items."""
    differ = F.lit(0)
    for b in BITS:
        differ = differ + F.bit_count(F.col(b).bitwiseXOR(F.col(f"c{b}")))
    sizes = F.expr(f"100 * least(n, m) >= {percent} * greatest(n, m)")
    # 100 i >= percent (n + m - i): i is at least the ceiling, so the sets differ in at most n + m - 2 i items
    return sizes & (differ <= F.expr(f"n + m - 2 * ceil({percent} * (n + m) / {100.0 + percent} - 1e-9)"))
