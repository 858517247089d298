"""Benchmark decontamination by template canonicalisation.

A text is a sequence of tokens: words without punctuation at their ends, in lower case (ASCII and Latin-1 letters; sharp s
is ss, as upper-casing makes it). Words without a letter or digit are left out. Tokens are then typed: a number (digits, no
letters) becomes ``<num>``, a name (capitalised but not in capitals, not at the start of a sentence) ``<name>``, a unit right after
a number ``<unit>``. A template window is ``WINDOW`` typed tokens with at least ``LITERALS`` untyped ones; an item without one has
windows of the least doubled size that holds as many, else all its tokens as one template (its first and last tokens, met together), for which
``WHOLE`` untyped tokens are enough if it has ``LITERALS`` tokens. An item with fewer has no template and is found by its exact tokens. All items also have windows of exact tokens without regard to case, of
template windows with names as they are (for copies in lower case or in capitals), and with the first word as a name (for copies that begin
within a sentence); documents have windows of typed and of exact tokens. A shorter benchmark
item is one window of all its tokens, and documents have windows of each such item's length too (``WINDOW`` - 1 lengths at most), so
that a short item is found anywhere in a text. An item of one token is found in every document that holds it.

Windows of benchmark and documents are equi-joined by hash. A bitmap of fixed size (``BITMAP_BITS``) of the benchmark's windows is
broadcast first, so that few other windows are shuffled. Pairs come from each item's rarest windows only, as many as a match can't do without. A match carries the fillers of its slots. Matches of one
document and item at one shift are an occurrence; it is consistent if each filler of the item stands for one filler of the
document throughout. A document is contaminated by an item if consistent occurrences cover at least half of the item's
template windows or of its windows of ``WINDOW`` tokens, or ``ENOUGH`` of either; the better of the two covers is reported.

Null and empty texts have no windows. Repeated rows and repeated passages count once; rows of one id and different texts are documents (or items) of their
own, rows without an id too, whose id is null in the result. Empty tables give an empty result. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import kernel as K
from tidemark.llm.common import Workspace, blocks, hash_bitmap, in_bitmap, text_buffers, trimmed

WINDOW = 8
LITERALS = 5
WHOLE = 3
ENOUGH = 6
BITMAP_BITS = 24
U = np.uint64
#: Unit words.
UNITS = "mm cm m km g kg mg t lb lbs oz ml cl l mi ft yd in s ms min mins h hr hrs minute minutes second seconds hour hours day days week weeks month months year years euro euros eur usd dollar dollars cent cents percent degree degrees meter meters metre metres kilometer kilometers kilometre kilometres mile miles liter liters litre litres gram grams kilogram kilograms pound pounds inch inches foot feet".split()
_KIND = np.zeros(256, np.int64)
_KIND[48:58] = 1
_ALNUM = np.zeros(256, bool)
_ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_STOP = np.zeros(256, bool)
_STOP[[33, 46, 58, 59, 63, 34, 41]] = True


def folded(raw: np.ndarray) -> np.ndarray:
    """Bytes in lower case, of the same number: A-Z, and U+00C0 to U+00DE; sharp s becomes ss."""
    out = K._LOWER.astype(np.uint8)[raw]
    lead = np.flatnonzero(raw[:-1] == 0xC3)
    tail = raw[lead + 1]
    up = lead[(tail >= 0x80) & (tail <= 0x9E) & (tail != 0x97)]
    out[up + 1] += 0x20
    sharp = lead[tail == 0x9F]
    out[sharp] = 115
    out[sharp + 1] = 115
    return out


def _unit_hashes() -> np.ndarray:
    raw = np.frombuffer(" ".join(UNITS).encode(), np.uint8)
    s, e, _ = K.word_spans(raw, np.array([0, len(raw)]))
    return np.sort(K.span_hash(raw, s, e, K.BYTE_EXACT))


_UNITS = _unit_hashes()
_SLOT = {1: K.MULT[20], 2: K.MULT[21], 3: K.MULT[22]}


def typed(raw: np.ndarray, off: np.ndarray):
    """(template hash, own hash, type 0..3, whether it could be a name) of every token, and the number of tokens of each text."""
    part, own = raw[off[0] : off[-1]], off - off[0]
    starts, ends, counts = K.word_spans(part, own)
    ink = np.flatnonzero(_ALNUM[part])
    a, b = np.searchsorted(ink, starts), np.searchsorted(ink, ends)
    real = b > a
    head = np.zeros(len(starts), bool)
    first = np.concatenate(([0], np.cumsum(counts)))[:-1][counts > 0]
    head[first] = True
    ender = _STOP[part[ends - 1]] if len(ends) else np.zeros(0, bool)
    opens = head.copy()
    opens[1:] |= ender[:-1]
    text_of = np.repeat(np.arange(len(counts)), counts)[real]
    opens = opens[real]
    s, e = ink[a[real]], ink[b[real] - 1] + 1
    low = folded(part)
    h = K.span_hash(low, s, e, K.BYTE_EXACT)
    digits = np.concatenate(([0], np.cumsum((part >= 48) & (part <= 57))))
    marks = np.concatenate(([0], np.cumsum(_ALNUM[part])))
    upper = np.concatenate(([0], np.cumsum(low != part)))
    n_digit, n_mark, n_up = digits[e] - digits[s], marks[e] - marks[s], upper[e] - upper[s]
    number = (n_digit > 0) & (n_digit == n_mark)
    wide = (part[s] == 0xC3).astype(np.int64)
    starts_up = (upper[s + 1 + wide] - upper[s]) > 0
    able = starts_up & (n_up == 1) & (e - s > 1 + wide) & ~number
    name = able & ~opens
    unit = np.zeros(len(h), bool)
    if len(h):
        spot = np.searchsorted(_UNITS, h)
        spot[spot == len(_UNITS)] = 0
        unit[1:] = (_UNITS[spot] == h)[1:] & number[:-1] & (text_of[1:] == text_of[:-1])
    kind = number * 1 + (name & ~unit) * 2 + (unit & ~number) * 3
    t = h.copy()
    for k, x in _SLOT.items():
        t[kind == k] = x
    return t, h, kind, able, np.bincount(text_of, minlength=len(counts))


def places(counts, size: int, which=None):
    """(token place in all, text, place in text) of every window of ``size`` tokens."""
    edge = np.concatenate(([0], np.cumsum(counts)))
    n = np.maximum(counts - size + 1, 0)
    if which is not None:
        n = np.where(which, n, 0)
    lead = np.concatenate(([0], np.cumsum(n)[:-1]))
    text = np.repeat(np.arange(len(counts)), n)
    place = np.arange(int(n.sum())) - np.repeat(lead, n)
    return edge[:-1][text] + place, text, place


def window_hash(t, at, size: int):
    """Hashes of the windows of ``size`` tokens at ``at``; the size enters the hash. Beyond ``WINDOW`` it is doubled ones."""
    if size > WINDOW:
        g, m = np.zeros(len(t), U), WINDOW
        pad = np.concatenate((t, np.zeros(WINDOW, U)))
        for j in range(WINDOW):
            g = g + pad[j : j + len(t)] * K.MULT[j]
        while m < size:
            g = K.mix(g * K.MULT[24] + np.concatenate((g[m:], np.zeros(m, U)))[: len(g)] * K.MULT[25])
            m *= 2
        return K.mix(g[at] + np.full(len(at), size, U) * K.MULT[23])
    h = np.full(len(at), size, U) * K.MULT[23]
    for j in range(size):
        h = h + t[at + j] * K.MULT[j]
    return K.mix(h)


def literals(kind, at, size: int):
    """Number of untyped tokens of windows."""
    run = np.concatenate(([0], np.cumsum(kind == 0)))
    return run[at + size] - run[at]


def _least(size: int) -> int:
    """Untyped tokens that a template of this size must have; one below ``WINDOW`` is a whole item."""
    return size if size < LITERALS else WHOLE if size < WINDOW else LITERALS


def _fillers(own, kind, at, size: int) -> list[list[int]]:
    return [[int(x) for x in own[i : i + size][kind[i : i + size] > 0].view(np.int64)] for i in at.tolist()]


def _item_rows(batches):
    """Windows of benchmark items. ``cover``: bit 0 counts as a window of exact tokens, bit 1 as a template window; ``need``: the
    template windows that one occurrence must have at least; ``item_fixed``: typed tokens that stand as they are."""
    for batch in batches:
        ids = np.asarray(batch.column(0)).astype(np.int64)
        raw, off = text_buffers(batch.column(1))
        for a, b in blocks(off):
            t, own, kind, able, counts = typed(raw, off[a : b + 1])
            none = np.zeros(len(kind), np.int64)
            names = (kind == 2) * 1
            plain_t, plain_kind = np.where(kind == 2, own, t), np.where(kind == 2, 0, kind)  # names as they are: a copy in one case has none

            def rows(t, slot, fixed, at, text, place, size, cover, need=1):
                return pa.RecordBatch.from_arrays(
                    [pa.array(ids[a:b][text]), pa.array(window_hash(t, at, size).view(np.int64)), pa.array(place.astype(np.int64)), pa.array(np.full(len(at), size, np.int32))]  # noqa: B023
                    + [pa.array(np.broadcast_to(x, len(at)).astype(np.int32)) for x in (cover, need)]
                    + [pa.array(_fillers(own, x, at, size), pa.list_(pa.int64())) for x in (slot, fixed)],  # noqa: B023
                    ["item", "w", "item_at", "size", "cover", "need", "item_slots", "item_fixed"],
                )

            def templates(at, text, place, size, cover, need=1):
                cover, need = np.broadcast_to(cover, len(at)), np.broadcast_to(need, len(at))
                yield rows(t, kind, none, at, text, place, size, cover, need)  # noqa: B023
                # the first word as a name, for a document where no sentence starts there; it must be the same if literals are few
                head = (place == 0) & able[at] & (kind[at] == 0)  # noqa: B023
                x, named_t, named, same = at[head], t.copy(), kind.copy(), none.copy()  # noqa: B023
                named_t[x], named[x] = _SLOT[2], 2
                same[x] = literals(named, x, size) < _least(size)
                yield rows(named_t, named, same, x, text[head], place[head], size, cover[head], need[head])

            def uncased(at, text, place, size, cover, need=1):
                cover, need = np.broadcast_to(cover, len(at)), np.broadcast_to(need, len(at))
                n, n_plain = literals(kind, at, size), literals(plain_kind, at, size)  # noqa: B023
                both = (n < n_plain) & (n_plain < size) & (n_plain >= _least(size) * (size <= WINDOW))
                yield rows(plain_t, plain_kind, names, at[both], text[both], place[both], size, cover[both], need[both])  # noqa: B023

            poor = counts > 0  # items without a template window yet
            for size in range(1, WINDOW + 1):
                mine = np.minimum(counts, WINDOW) == size
                at, text, place = places(counts, size, mine)
                n = literals(kind, at, size)
                rich = n >= _least(size)
                yield from templates(at[rich], text[rich], place[rich], size, 3)
                yield from uncased(at, text, place, size, 1 + 2 * rich)
                poor[text[rich]] = False
                bare = n < size
                yield rows(own, none, kind, at[bare], text[bare], place[bare], size, (1 + 2 * rich)[bare])
            # longer windows where those of WINDOW tokens have too few literals; sizes double, so that documents need few of them
            run = np.concatenate(([0], np.cumsum(kind == 0)))
            edge = np.concatenate(([0], np.cumsum(counts)))
            poor &= (counts >= WINDOW) & (run[edge[1:]] - run[edge[:-1]] >= WHOLE)
            size, top = 2 * WINDOW, int(counts[poor].max(initial=0))
            while size <= top:
                at, text, place = places(counts, size, poor)
                rich = literals(kind, at, size) >= LITERALS
                at, text, place = at[rich], text[rich], place[rich]
                yield from templates(at, text, place, size, 2)
                yield from uncased(at, text, place, size, 2)
                poor[text] = False
                size *= 2
            # else the whole item, as its first and its last tokens, which must be met together
            size = WINDOW
            while size <= top:
                text = np.flatnonzero(poor & (counts >= size) & (counts < 2 * size))
                tail = counts[text] - size
                more = tail > 0
                need = np.concatenate((1 + more, 1 + more[more]))
                place = np.concatenate((0 * tail, tail[more]))
                text = np.concatenate((text, text[more]))
                yield from templates(edge[text] + place, text, place, size, 2, need)
                size *= 2


def _doc_rows(bitmap, sizes: list[int]):
    """Windows of documents, of each size that the benchmark holds, as far as the bitmap has them."""

    def run(batches):
        for batch in batches:
            raw, off = text_buffers(batch.column(2))
            for a, b in blocks(off):
                t, own, kind, _, counts = typed(raw, off[a : b + 1])
                for size in sizes:
                    every = places(counts, size)
                    slotted = literals(kind, every[0], size) < size if size <= WINDOW else np.zeros(len(every[0]), bool)
                    for exact in (False, True):
                        at, text, place = [x[slotted] for x in every] if exact else every
                        w = window_hash(own if exact else t, at, size)
                        hit = np.flatnonzero(in_bitmap(bitmap.value, w, BITMAP_BITS))
                        w, at, text, place = w[hit], at[hit], text[hit], place[hit]
                        if size < WINDOW:  # the whole item: of a text's windows without slots one is enough
                            once = np.zeros(len(at), bool) if exact else literals(kind, at, size) < size
                            once[np.unique(np.column_stack([text.astype(U), w]), axis=0, return_index=True)[1]] = True
                            w, at, text, place = w[once], at[once], text[once], place[once]
                        slots = [[]] * len(at) if exact else _fillers(own, kind, at, size)
                        own_row = pa.array(a + text)
                        yield pa.RecordBatch.from_arrays(
                            [batch.column(0).take(own_row), batch.column(1).take(own_row), pa.array(w.view(np.int64)), pa.array(place.astype(np.int64)), pa.array(slots, pa.list_(pa.int64()))], ["doc", "h", "w", "doc_at", "doc_slots"]
                        )

    return run


def matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, matched, windows, coverage, text_hash) of every contaminated pair."""
    spark = docs.sparkSession
    ws = Workspace(spark, "decontaminate")
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).distinct()
    items = ws.put(items.select(F.monotonically_increasing_id().alias("item"), "item_id", "text"), "items")
    bench = items.select("item", "text").mapInArrow(trimmed(_item_rows), "item long, w long, item_at long, size int, cover int, need int, item_slots array<long>, item_fixed array<long>")
    bench = ws.put(bench, "bench")
    bitmap = spark.sparkContext.broadcast(hash_bitmap(bench, "w", BITMAP_BITS))
    lengths = sorted(r["size"] for r in bench.select("size").distinct().collect())  # up to WINDOW, and doubled ones
    exact, template = (F.when(F.col("cover").bitwiseAND(bit) > 0, F.col("item_at")) for bit in (1, 2))
    sizes = bench.groupBy("item").agg(F.countDistinct(exact).alias("n0"), F.countDistinct(template).alias("n1"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("text").cast("string")).alias("h"), F.col("text").cast("string").alias("text"))
    hits = texts.mapInArrow(trimmed(_doc_rows(bitmap, lengths)), "doc long, h long, w long, doc_at long, doc_slots array<long>")
    hits = ws.put(hits.select(F.struct("doc", "h").alias("d"), "w", "doc_at", "doc_slots"), "hits")
    bitmap.destroy()
    pairs = ws.put(_candidates(hits, bench), "pairs")
    fixed = F.transform("item_fixed", lambda x: F.struct(x.alias("item_slots"), x.alias("doc_slots")))
    met = hits.join(pairs, "d").join(bench, ["item", "w"])
    met = met.select("d", "item", (F.col("doc_at") - F.col("item_at")).alias("shift"), "item_at", "cover", "need", F.concat(F.arrays_zip("item_slots", "doc_slots"), fixed).alias("pairs"))
    found = met.groupBy("d", "item", "shift").agg(F.collect_set(exact).alias("p0"), F.collect_set(template).alias("p1"), F.max("need").alias("need"), F.array_distinct(F.flatten(F.collect_set("pairs"))).alias("pairs"))
    fillers = F.size(F.array_distinct(F.transform("pairs", lambda p: p["item_slots"])))
    found = found.where(F.size("pairs") == fillers).withColumn("p1", F.when(F.size("p1") >= F.col("need"), F.col("p1")))
    count = lambda p: F.size(F.array_distinct(F.flatten(F.collect_set(p)))).cast("long")
    whole = found.groupBy("d", "item").agg(count("p0").alias("m0"), count("p1").alias("m1")).join(sizes, "item")

    def cover(m, n):
        m, n = F.col(m), F.col(n)
        return F.struct(((n > 0) & (m > 0) & ((m * 2 >= n) | (m >= ENOUGH))).alias("enough"), F.when(n > 0, m / n).otherwise(0.0).alias("coverage"), m.alias("matched"), n.alias("windows"))

    best = whole.select("d", "item", F.greatest(cover("m0", "n0"), cover("m1", "n1")).alias("c")).where("c.enough")
    best = best.join(items.select("item", "item_id"), "item").groupBy(F.col("d.doc").alias("doc_id"), F.col("d.h").alias("text_hash"), "item_id").agg(F.max("c").alias("c"))
    out = ws.put(best.select("doc_id", "item_id", "c.matched", "c.windows", "c.coverage", "text_hash"), "result")
    ws.keep("result")
    return out


def _candidates(hits: DataFrame, bench: DataFrame) -> DataFrame:
    """(d, item): pairs of a document and an item that may match. A match holds ``min(half, ENOUGH)`` of an item's n windows of either kind, so one at least of any n + 1
    less these; those that the fewest documents' windows meet are taken. A template that very many items and documents share is so left out unless an item has little else."""
    seen = hits.groupBy("w").agg(F.count("*").alias("f"))
    probes = None
    for bit in (1, 2):
        spots = bench.where(F.col("cover").bitwiseAND(bit) > 0).join(seen, "w", "left").groupBy("item", "item_at").agg(F.sum(F.coalesce("f", F.lit(0))).alias("f"))
        every = Window.partitionBy("item")
        n = F.count("*").over(every)
        spots = spots.withColumn("most", n - F.least(F.ceil(n / 2), F.lit(ENOUGH)) + 1).withColumn("rank", F.row_number().over(every.orderBy("f", "item_at")))
        few = spots.where("rank <= most").select("item", "item_at", F.lit(bit).alias("bit"))
        probes = few if probes is None else probes.union(few)
    probes = bench.join(probes, ["item", "item_at"]).where(F.col("cover").bitwiseAND(F.col("bit")) > 0).select("w", "item").distinct()
    return hits.select("d", "w").distinct().join(probes, "w").select("d", "item").distinct()
