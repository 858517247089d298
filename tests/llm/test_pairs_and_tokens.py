import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tests.llm import brute_templates
from tests.llm.data import DOCS, frame, odd_rows
from pyspark.sql import functions as F

from tidemark.llm import common, decontaminate, exact_dedup, mixing, ngram_join, token_store
from tidemark.llm.common import Workspace
from tidemark.llm.graph import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def low(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t)


def shingles(t, k):
    w = WORD.findall(low(t or ""))
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def brute_components(docs, k, percent):
    """{doc_id: (n, component)}"""
    ids = sorted(docs)
    s = {i: shingles(docs[i], k) for i in ids}
    top = {i: i for i in ids}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a in ids:
        for b in ids:
            if a < b and s[a] and s[b]:
                c = len(s[a] & s[b])
                if 100 * c >= percent * (len(s[a]) + len(s[b]) - c):
                    x, y = find(a), find(b)
                    top[max(x, y)] = min(x, y)
    return {i: (len(s[i]), find(i)) for i in ids}


def near_copies(seed, n_groups=6, size=40):
    """Groups of near copies with up to six edits, common passages, and exact copies."""
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(4))
    common = [word() for _ in range(30)]
    rows, i = [], 10_000
    for _ in range(n_groups):
        base = [word() for _ in range(rnd.choice([8, 12, 40, 90, 200]))] + common * rnd.randint(0, 1)
        for _ in range(size):
            w = list(base)
            for _ in range(rnd.randint(0, 6)):
                w[rnd.randrange(len(w))] = word()
            rows.append((i, " ".join(w), "a"))
            i += 1
    for _ in range(60):
        rows.append((i, " ".join([word() for _ in range(rnd.randint(1, 30))] + common), "b"))
        i += 1
    return rows


@pytest.mark.parametrize("k,percent,bits", [(3, 90, 22), (5, 80, 12)])
def test_jaccard_components(spark, monkeypatch, k, percent, bits):
    # a small sketch makes most shingles frequent, short lists bring pivots into play
    monkeypatch.setattr(ngram_join, "SMALL_LIST", 4 if bits == 12 else 32)
    monkeypatch.setattr(ngram_join, "PIVOTS", 8)
    monkeypatch.setattr(ngram_join, "MEETINGS", 50 if bits == 12 else 1_000_000)
    rows = odd_rows() + near_copies(k)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.jaccard_components(frame(spark, rows), k, percent).collect() if r.doc_id is not None}
    assert got == brute_components({i: t for i, t, _ in rows if i is not None}, k, percent)


@pytest.mark.parametrize("small", [2, 32])
def test_family_of_near_copies(spark, monkeypatch, small):
    """One large family whose members don't all link, a chain through it, and a passage that many other documents share."""
    monkeypatch.setattr(ngram_join, "SMALL_LIST", small)
    rnd = random.Random(small)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(5))
    base, passage = [word() for _ in range(120)], [word() for _ in range(60)]
    rows, chain = [], list(base)
    for i in range(250):
        w = list(base)
        for _ in range(rnd.randint(0, 9)):
            w[rnd.randrange(len(w))] = word()
        rows.append((i, " ".join(w), "a"))
    for i in range(300, 330):
        chain[rnd.randrange(len(chain))] = word()
        rows.append((i, " ".join(chain), "a"))
    for i in range(400, 520):
        rows.append((i, " ".join([word() for _ in range(rnd.randint(0, 40))] + passage + [word() for _ in range(rnd.randint(0, 40))]), "a"))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.jaccard_components(frame(spark, rows), 5, 80).collect()}
    want = brute_components({i: t for i, t, _ in rows}, 5, 80)
    assert got == want and 30 < len({c for _, c in want.values()}) < 300


def test_rows_that_repeat_an_id_or_have_none(spark):
    base = " ".join(f"w{i}" for i in range(60))
    other, third = base.replace("w7 ", "x7 "), " ".join(f"v{i}" for i in range(60))
    rows = [(7, base, "a"), (7, third, "a"), (3, third.replace("v5 ", "y "), "a"), (9, other, "a"), (None, other, "a"), (None, "quite alone", "a"), (None, None, "a"), (7, base, "a")]
    got = sorted(((r.doc_id or 0, r.component_id or 0, r.n_shingles, r.component is None) for r in ngram_join.jaccard_components(frame(spark, rows), 5, 80).collect()))
    assert got == sorted([(7, 7, 56, False), (7, 3, 56, False), (3, 3, 56, False), (9, 7, 56, False), (0, 7, 56, False), (0, 0, 1, False), (0, 0, 0, True), (7, 7, 56, False)])


def test_signatures_lose_no_link():
    """Sets of every class share a signature if they link."""
    rnd = np.random.default_rng(1)
    for case in range(300):
        n = int(rnd.integers(9, 300))
        level = rnd.choice([5, 30, 60], size=n, p=rnd.dirichlet([1, 1, 1])).astype(np.uint8)
        v = np.sort(rnd.integers(0, 2**63, n).astype(np.uint64))
        gone = int(rnd.integers(0, max(1, n // 10) + 1))
        keep = np.sort(rnd.permutation(n)[gone:])
        more = int(rnd.integers(0, n // 12 + 1))
        w = np.concatenate([v[keep], rnd.integers(0, 2**63, more).astype(np.uint64)])
        lw = np.concatenate([level[keep], rnd.choice([5, 30, 60], size=more).astype(np.uint8)])
        common = len(keep)
        if 100 * common < 90 * (n + len(w) - common) or (len(keep) == n and not more):
            continue
        (a1, a2), (b1, b2) = ngram_join.signatures(v, level, 25, 50, 90), ngram_join.signatures(w, lw, 25, 50, 90)
        both = lambda x, y: len(np.intersect1d(x, y))
        score = both(a1, b1) + 3 * (both(a1, b2) + both(a2, b1) + both(a2, b2))
        assert score >= 3, (case, n, gone, more)


def test_components_of_chains(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, 200), (200, 300), (5, 5), (None, 1)] + [(1000, x) for x in range(1001, 1050)]
    got = {r.id: r.component for r in components(Workspace(spark, "t"), spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {got[i] for i in range(1, 61)} == {1} and got[300] == 100 and got[1049] == 1000 and len(got) == 60 + 3 + 50
    assert components(Workspace(spark, "t"), spark.createDataFrame([], "a long, b long")).count() == 0


def test_empty_tables(spark):
    none = spark.createDataFrame([], DOCS)
    bench = spark.createDataFrame([], "item_id long, text string")
    assert ngram_join.jaccard_components(none).count() == 0
    assert mixing.mix(none).count() == 0
    assert token_store.encode_documents(none, tokenizer()).count() == 0
    assert decontaminate.matches(none, bench).count() == 0
    assert decontaminate.matches(frame(spark, odd_rows()), bench).count() == 0


def brute_targets(sizes, share=1.5, most=2.0):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, full = share * sum(sizes.values()), set()
    while True:
        left = total - sum(most * sizes[s] for s in full)
        open_ = [s for s in names if s not in full]
        t = {s: left * w[s] / sum(w[x] for x in open_) for s in open_}
        over = [s for s in open_ if t[s] > most * sizes[s]]
        if not over:
            return t | {s: most * sizes[s] for s in full}
        full |= set(over)


def test_mix(spark):
    rows = odd_rows(3, 400)
    got = mixing.mix(frame(spark, rows)).collect()
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len(WORD.findall(t or ""))
    want = brute_targets(sizes)
    assert len(got) == len(rows)
    most = max(r["size"] for r in got)
    for s, t in want.items():
        mine = [r for r in got if r.source == s]
        assert all(abs(r.target - t) < 1e-6 * max(1, t) and r.source_size == sizes[s] for r in mine)
        assert abs(sum(r.taken for r in mine) - t) <= most / 2 + 1
        assert all(r.taken in (0, r["size"], 2 * r["size"]) for r in mine)
        # complete epochs first: nobody is taken twice while another is not taken at all
        times = {r.taken // r["size"] for r in mine if r["size"]}
        assert max(times) - min(times) <= 1
    again = mixing.mix(frame(spark, rows)).collect()
    key = lambda r: (r.doc_id or -1, r["size"], r.taken)
    assert sorted(map(key, got)) == sorted(map(key, again))


def test_mix_reruns_agree_whatever_the_order(spark):
    """Rows without an id, rows of one id, and ties: any order and any partitions give the same rows."""
    rnd = random.Random(6)
    words = ["ja", "nee", "!!", "wel"]
    rows = [(None, " ".join(rnd.choices(words, k=rnd.randint(1, 9))), rnd.choice("ab")) for _ in range(60)]
    rows += [(3, " ".join(rnd.choices(words, k=5)), "a") for _ in range(30)] + [(5, "same text", "b")] * 300 + [(None, None, "a"), (6, "", None)]
    runs = []
    for seed in (1, 2, 3):
        random.Random(seed).shuffle(rows)
        got = mixing.mix(frame(spark, rows).repartition(seed)).collect()
        runs.append(sorted((r.doc_id or 0, r.text_hash, r.source or "", r["size"], r.taken) for r in got))
    assert runs[0] == runs[1] == runs[2] and len(runs[0]) == len(rows)


def brute_taken(rows, most=2):
    """taken of each row, in key order, by one loop for each source; rows from ``measure`` and targets by hand."""
    sizes = {}
    for r in rows:
        sizes[r.source] = sizes.get(r.source, 0) + r["size"]
    want, out = brute_targets(sizes), []
    for s, target in want.items():
        epochs = int(target // sizes[s]) if sizes[s] else 0
        rest, before = target - epochs * sizes[s], 0
        for r in sorted((r for r in rows if r.source == s), key=lambda r: (r["rank"], r.doc_id is not None, r.doc_id, r["size"], r.h)):
            out.append((r.doc_id, s, r["size"], epochs * r["size"] + (r["size"] if rest - before >= r["size"] / 2 else 0)))
            before += r["size"]
    return out


def test_mix_takes_what_brute_force_takes(spark, monkeypatch):
    monkeypatch.setattr(mixing, "COPIES", 7)
    rows = odd_rows(9, 500) + [(77, "one row many times", "b")] * 50
    df = frame(spark, rows)
    key = lambda x: tuple(-1 if y is None else y for y in x)
    got = sorted(((r.doc_id, r.source or "", r["size"], r.taken) for r in mixing.mix(df).collect()), key=key)
    want = sorted(((i, s or "", n, t) for i, s, n, t in brute_taken(mixing.measure(df).collect())), key=key)
    assert got == want


@pytest.mark.parametrize("file_rows", [200_000, 30])
def test_mix_writes_no_file_for_each_shuffle_partition(spark, monkeypatch, file_rows):
    """Many partitions of the shuffle that nothing merges: files by cores and rows, and the rows are those of brute force."""
    monkeypatch.setattr(mixing, "FILE_ROWS", file_rows, raising=False)
    rows = odd_rows(9, 500) + [(77, "one row many times", "b")] * 50
    df = frame(spark, rows)
    conf = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        out = mixing.mix(df)
        files, got = len(out.inputFiles()), out.collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert files <= max(spark.sparkContext.defaultParallelism, 1 + len(rows) // file_rows)
    key = lambda x: tuple(-1 if y is None else y for y in x)
    want = sorted(((i, s or "", n, t) for i, s, n, t in brute_taken(mixing.measure(df).collect())), key=key)
    assert sorted(((r.doc_id, r.source or "", r["size"], r.taken) for r in got), key=key) == want


@pytest.mark.parametrize("seed", [2, 9, 31])
def test_rows_of_the_mix(spark, monkeypatch, seed):
    """The repeated rows are those that the mix takes, also where the last key's row stands many times."""
    monkeypatch.setattr(mixing, "COPIES", 7)
    rows = odd_rows(seed, 120) + [(77, "one row many times over", "d")] * 40 + [(78, "a b", "d")] * (seed % 3) + [(None, "x y z", "e")] * 9 + [(8000 + i, "w " * 40, "f") for i in range(90)]
    df = frame(spark, rows)
    want, got = {}, {}
    for r in mixing.mix(df).collect():
        if r["size"]:
            k = (r.doc_id, r.source, r.text_hash)
            want[k] = want.get(k, 0) + r.taken // r["size"]
    out = mixing.repeated(df)
    assert out.columns == df.columns
    for r in out.select("doc_id", "source", F.xxhash64("text").alias("h")).collect():
        k = (r.doc_id, r.source, r.h)
        got[k] = got.get(k, 0) + 1
    assert got == {k: n for k, n in want.items() if n}
    assert mixing.repeated(df.limit(0)).count() == 0


def test_rows_that_go(spark, monkeypatch):
    rows = [(i if i % 7 else None, f"t{i % 40}", "a") for i in range(400)]
    df = frame(spark, rows)
    gone = spark.createDataFrame([(r[0], r[1]) for r in rows[::3]] + [(None, "t35"), (5, None), (None, "other")], "id long, t string")
    left = {(r[0], r[1]) for r in rows} - {tuple(r) for r in gone.collect()}
    for bits in (15, 16, 24):
        monkeypatch.setattr(common, "MAYBE_BITS", bits)
        got = common.without(df, lambda: [F.col("doc_id"), F.col("text")], gone, lambda: [F.col("id"), F.col("t")])
        assert got.columns == df.columns
        assert sorted((r.doc_id or 0, r.text) for r in got.collect()) == sorted((i or 0, t) for i, t, _ in rows if (i, t) in left)
        assert common.without(df, lambda: [F.col("doc_id")], gone.limit(0), lambda: [F.col("id")]).count() == 400


def test_mix_prefers_quality(spark):
    rows = [(i, ("good words " if i % 2 else "!! ?? ") * 10, "a") for i in range(2000)] + [(10_000, "word " * 200_000, "b")]
    got = mixing.mix(frame(spark, rows), weights=(1, 20)).where("source = 'a'").collect()
    good, bad = (sum(r.taken > 0 for r in got if r.doc_id % 2 == x) for x in (1, 0))
    assert good > 2 * bad > 0


def tokenizer():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def texts(seed=1):
    rnd = random.Random(seed)
    al = ["a", " ", "  ", "\n", "é", " ", "　", "'s", "12", "!!", " the", "ß", "<|endoftext|>", "\t", "Ж", " Ж", " ", "  x", "日本"]
    return ["".join(rnd.choice(al) for _ in range(rnd.randint(0, 40))) for _ in range(500)] + ["", " ", "  a", " a", "a ", "the cat sat on the mat. " * 500]


def test_token_round_trip(spark):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizer())
    rows = [(7 * i % 1009, t, "a") for i, t in enumerate(texts())] + [(-5, None, "a"), (5000, "again", "a"), (5000, "again", "a")]
    got = sorted(tuple(r) for r in token_store.encode_documents(frame(spark, rows), tokenizer()).collect())
    at, want = 0, []
    for i, t in sorted((i, t or "") for i, t, _ in rows):
        ids = tok.encode(t, add_special_tokens=False).ids + [0]
        want.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4"))))
        at += len(ids)
    assert got == sorted(want)


def test_repair_random_access():
    rnd = np.random.default_rng(3)
    lengths = rnd.integers(0, 400, 80)
    ids = rnd.choice(30, int(lengths.sum())).astype(np.int32)
    b = token_store.Block(token_store.pack(np.arange(80), ids, lengths))
    assert (b.all_ids() == ids).all() and len(b.symbols) < len(ids) and len(b.left)
    edge = np.concatenate(([0], np.cumsum(lengths)))
    for i in range(80):
        assert (b.document(i) == ids[edge[i] : edge[i + 1]]).all()
    for j in range(len(b.left)):
        assert len(token_store.expand(np.array([token_store.BASE + j]), b.left, b.right)) == b.sizes[j]
    same = np.zeros(1001, np.int32)
    assert (token_store.Block(token_store.pack(np.arange(1), same, np.array([1001]))).all_ids() == same).all()


def frequent_pairs(symbols, counts):
    """The most often that a pair is met in the symbols, without overlap and within documents."""
    seen, before, at = {}, {}, 0
    for n in counts:
        for i in range(at, at + n - 1):
            pair = (symbols[i], symbols[i + 1])
            if before.get(pair) != i - 1:
                seen[pair], before[pair] = seen.get(pair, 0) + 1, i
        at += n
    return max(seen.values(), default=0)


def test_repair_to_the_end():
    rnd = np.random.default_rng(5)
    phrase = rnd.integers(0, 40_000, 500)
    some = [np.concatenate((rnd.integers(0, 40_000, rnd.integers(0, 9)), phrase)) for _ in range(20)]
    some += [rnd.choice(12, 3000), np.zeros(1001, np.int64), np.zeros(0, np.int64), np.array([5])]
    ids, lengths = np.concatenate(some).astype(np.int32), np.array([len(x) for x in some])
    symbols, counts, left, right, size = token_store.repair(ids, lengths)
    assert frequent_pairs(symbols.tolist(), counts.tolist()) < token_store.LEAST and size.max() >= 500
    assert (token_store.expand(symbols, left, right) == ids).all() and len(size) == len(left)


def test_encoder_small_blocks():
    from tokenizers import Tokenizer

    from tidemark.llm.common import blocks, text_buffers

    tok, enc, tx = Tokenizer.from_file(tokenizer()), token_store.Encoder(tokenizer()), texts(9)
    raw, off = text_buffers(pa.array(tx))
    got = []
    for a, b in blocks(off, 64):
        ids, n = enc.encode(raw, off[a : b + 1], 0)
        got += [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])]
    assert got == [tok.encode(t, add_special_tokens=False).ids + [0] for t in tx]


def test_encoder_slots_that_collide(monkeypatch):
    """With two slots for all units, and joined strings of all lengths, ids are those of whole texts."""
    from tokenizers import Tokenizer

    from tidemark.llm.common import text_buffers

    tok = Tokenizer.from_file(tokenizer())
    monkeypatch.setattr(token_store, "SLOT_BITS", 1)
    monkeypatch.setattr(token_store, "CACHE_IDS", 500)
    some = [*texts(4), "", " ", "a  ", "  x", "\0", "a\0", "a", "a\0\0", " a", " a\0", "x" * 40 + " " + "x" * 41, " " + "y" * 16, " " + "y" * 15, "z " * 70_000]
    for joined in (1, 2, 7, 256):
        monkeypatch.setattr(token_store, "JOINED", joined)
        enc = token_store.Encoder(tokenizer())
        for part in (some, some[::-1], some[::3]):
            ids, n = enc.encode(*text_buffers(pa.array(part)), 0)
            assert [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])] == [tok.encode(t, add_special_tokens=False).ids + [0] for t in part]


def test_other_tokenizers_encode_whole_texts(tmp_path):
    from tokenizers import Tokenizer, models, pre_tokenizers

    from tidemark.llm.common import text_buffers

    tok = Tokenizer(models.WordLevel({"a": 1, "b": 2, "?": 3}, unk_token="?"))
    tok.pre_tokenizer = pre_tokenizers.Whitespace()
    tok.save(str(tmp_path / "words.json"))
    enc = token_store.Encoder(str(tmp_path / "words.json"))
    ids, n = enc.encode(*text_buffers(pa.array(["a b", "", None, "b c a"])), 0)
    assert ids.tolist() == [1, 2, 0, 0, 0, 2, 3, 1, 0] and n.tolist() == [3, 1, 1, 4]


ITEMS = [
    (1, "If Anna buys 12 red apples for 30 dollars and then eats 4 of the apples on the way, how much did each one cost her?"),
    (2, "short item of six words only"),
    (3, None), (4, ""), (None, "an item without any id"),
    (5, "A train leaves Berlin at 9 and goes 80 km every hour until it has gone 400 km in all before noon."),
]


def test_decontaminate(spark):
    filler = "some plain words that belong to nothing in particular and go on for a while"
    rows = [
        (1, f"{filler}. {ITEMS[0][1]} {filler}", "a"),
        (2, f"{filler}. " + ITEMS[0][1].upper() + f" {filler}", "a"),
        (3, f"{filler}. If Bob buys 15 red apples for 45 dollars and then eats 6 of the apples on the way, how much did each one cost her?", "a"),
        (4, f"{filler}. A train leaves Paris at 7 and goes 90 km every hour until it has gone 450 km in all before noon.", "a"),
        (5, "Short item of six words only!", "a"),
        (6, filler * 30, "a"), (7, None, "a"), (8, "", "a"), (9, "a train leaves", "a"), (None, ITEMS[0][1], "a"),
        (10, f"{ITEMS[0][1]} {filler} {ITEMS[0][1]}", "a"), (10, f"{ITEMS[0][1]} {filler} {ITEMS[0][1]}", "a"),
    ]
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.matches(frame(spark, rows), bench).collect()}
    assert got == {(1, 1), (2, 1), (3, 1), (4, 5), (5, 2), (10, 1), (None, 1)}


def test_slots_must_be_consistent(spark):
    item = "Take 3 coins from the left box, put 3 coins in the right box and 3 coins in the middle box, then count the coins."
    good, bad = item.replace("3", "8"), item.replace("3 coins from", "8 coins from")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    rows = [(1, good, "a"), (2, bad, "a")]
    assert {r.doc_id for r in decontaminate.matches(frame(spark, rows), bench).collect()} == {1}


def contaminated(spark, items, docs):
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    return {(r.doc_id, r.item_id) for r in decontaminate.matches(frame(spark, [(i, t, "a") for i, t in enumerate(docs)]), bench).collect()}


def test_short_items_inside_documents(spark):
    filler = "some plain words that belong to nothing in particular and go on for a while"
    items = ["six words that are never alone", "three blue lamps", "seven quick foxes jump over Vienna tonight", "lamps"]
    docs = [f"{filler} six words that are never alone {filler}", f"{filler}. Three blue lamps, {filler} three blue lamps", f"{filler} seven quick foxes jump over Berlin tonight", "three blue", f"{filler} three red lamps"]
    assert contaminated(spark, items, docs) == {(0, 0), (1, 1), (1, 3), (2, 2), (4, 3)}


def test_items_rich_in_slots(spark):
    filler = "some plain words that belong to nothing in particular and go on for a while"
    items = [
        "Solve 3 x + 12 = 48 - 6 x", "Anna Smith met Bob Jones in Paris on 12 May 2020",
        "Count 3 and 4 then 5 and 6 by 7 or 8 now",  # the whole item as a template
        " ".join(f"w{i}a {i} {i + 50} {i + 100} w{i}b {i + 150} {i + 200}" for i in range(7)),  # windows of 16 tokens
        "Paris has 5 boroughs",  # too few tokens for a template: exact
        "What is 12 plus 30?", "Compute 12 times 7 and add 45", "If 3 kg cost 12 euros then 5 kg cost 20 euros",
    ]
    far = " ".join(f"w{i}a {i + 300} {i + 350} {i + 400} w{i}b {i + 450} {i + 500}" for i in range(7))
    docs = [f"{filler}. {x}. {filler}" for x in items]
    docs += [f"{filler}. Solve 4 x + 13 = 49 - 7 x", f"{filler}. Count 13 and 14 then 15 and 16 by 17 or 18 now", f"{filler}. Count 13 and 14 then 15 and 16 by 17 {filler}", f"{filler}. {far}.", f"{filler}. Paris has 6 boroughs"]
    docs += [f"{filler}. {x}" for x in ("What is 5 plus 7?", "Compute 1 times 2 and add 3", "If 8 kg cost 9 euros then 4 kg cost 1 euros", "What is 5 minus 7?", "If 8 kg cost 9 euros then 4 km cost 1 euros", "If 8 kg cost 9 euros then 8 kg cost 9 euros")]
    assert contaminated(spark, items, docs) == {(i, i) for i in range(8)} | {(8, 0), (9, 2), (11, 3), (13, 5), (14, 6), (15, 7), (18, 7)}


def test_copies_in_another_case(spark):
    filler = "some plain words that belong to nothing in particular and go on for a while"
    items = ["Which river flows through Vienna and Budapest before it reaches Belgrade", "What is the height of tower 12 downtown", "How many of the 30 trains from Graz stop here", "Few cats chase 3 dogs 4 mice 5"]
    docs = [f"{filler}. {items[0].lower()} {filler}", f"{filler}. {items[0].upper()} {filler}", f"see also {items[1]}, {filler}", f"see also {items[1].replace('12', '14')}, {filler}", f"{filler}. {items[2].lower().replace('30', '40')} {filler}"]
    docs += [f"see also {items[3].replace('3', '7')} {filler}", f"see also {items[3].replace('Few', 'Big').replace('3', '7')} {filler}", f"{filler}. {items[2].lower().replace('graz', 'linz')} {filler}"]
    assert contaminated(spark, items, docs) == {(0, 0), (1, 0), (2, 1), (3, 1), (4, 2), (5, 3)}


@pytest.mark.parametrize("seed", [1, 2])
def test_decontaminate_against_brute_force(spark, seed):
    """Short, slot-heavy, long and odd items; documents that hold them verbatim, with other slots, in another case, cut, or mixed."""
    rnd = random.Random(seed)
    words, names, units = ["red", "blue", "box", "how", "many", "old", "ship", "lamp", "goes", "über", "to"], ["Anna", "Bob", "Vienna", "Ödön", "X"], ["kg", "km", "hours"]

    def phrase(n, slots):
        out = []
        while len(out) < n:
            x = rnd.random()
            if x < slots / 2:
                out += [str(rnd.randint(1, 30))] + ([rnd.choice(units)] if rnd.random() < 0.5 else [])
            elif x < slots:
                out.append(rnd.choice(names))
            else:
                out.append(rnd.choice(words) + rnd.choice(["", "", "", ",", ".", "?"]))
        return " ".join(out[:n])

    def other_slots(text):
        to = {}
        return " ".join(to.setdefault(w, rnd.choice(names)) if w in names and rnd.random() < 0.9 else to.setdefault(w, str(rnd.randint(31, 60))) if w.isdigit() else w for w in text.split())

    items = [phrase(rnd.randint(1, 7), rnd.choice([0, 0.3, 0.6])) for _ in range(25)] + [phrase(rnd.randint(8, 45), rnd.choice([0, 0.3, 0.6, 0.8, 0.9])) for _ in range(45)]
    items += ["What is 12 plus 30?", "Compute 12 times 7 and add 45", "If 3 kg cost 12 euros then 5 kg cost 20 euros", "", "--- !!", None, "Solve 3 x + 12 = 48 - 6 x"]
    docs = []
    for item in items:
        item = item or ""
        w = item.split()
        for change in (item, other_slots(item), item.lower(), item.upper(), " ".join(w[: len(w) // 2]), " ".join(w[1:]), " ".join(rnd.sample(w, len(w)))):
            docs.append(f"{phrase(rnd.randint(0, 12), 0.2)} {change} {phrase(rnd.randint(0, 12), 0.2)}".strip())
    docs += [phrase(rnd.randint(1, 30), 0.4) for _ in range(60)] + [None, ""]
    want = {(i, j) for i, d in enumerate(docs) for j, x in enumerate(items) if brute_templates.contaminated(d, x)}
    got = contaminated(spark, items, docs)
    assert got == want, (sorted(got - want)[:5], sorted(want - got)[:5])
    # a verbatim copy with the same sentence starts is found, whatever the item
    assert all((7 * j, j) in got for j, x in enumerate(items) if brute_templates.tokens(x) and docs[7 * j].startswith(x)) and len(got) > 300


def test_decontaminate_rows_without_id(spark):
    bench = spark.createDataFrame([(None, "seven old men sail slowly to the far island"), (1, "two"), (1, "wholly other words of the same id"), (1, "two")], "item_id long, text string")
    rows = [(None, "say seven old men sail slowly to the far island again", "a"), (None, "nothing here", "a"), (4, "two", "a"), (4, "x wholly other words of the same id", "a")]
    got = sorted((r.doc_id or 0, r.item_id or 0, r.matched) for r in decontaminate.matches(frame(spark, rows), bench).collect())
    assert got == [(0, 0, 2), (4, 1, 1), (4, 1, 1)]


def test_decontaminate_long_text_and_repeated_passages(spark):
    item = "why did the seven old men sail slowly to the far island"
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    rows = [(1, "a b c " * 100_000 + item, "a"), (2, f"{item} " * 3000, "a"), (3, "z" * 1_500_000 + " " + item, "a"), (4, "y" * 3_000_000, "a")]
    assert sorted(r.doc_id for r in decontaminate.matches(frame(spark, rows), bench).collect()) == [1, 2, 3]


def test_exact_dedup(spark, tmp_path):
    rows = odd_rows(5) + [(50, "one ", "a"), (51, "one\n", "a"), (52, " one", "a"), (53, "  one", "a")]
    src = str(tmp_path / "docs.parquet")
    frame(spark, rows).repartition(4).write.parquet(src)
    for per in (1, 1000):
        got = exact_dedup.dedup(spark, src, per).collect()
        norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
        groups = {}
        for i, t, _ in rows:
            groups.setdefault(norm(t), []).append(i)
        assert len(got) == len(rows) and sum(r.kept for r in got) == len(groups)
        import hashlib

        sha = {hashlib.sha256(t.encode()).hexdigest(): v for t, v in groups.items()}
        for r in got:
            mine = sha[r.text_sha256]
            ids = [x for x in mine if x is not None]
            assert r.group_size == len(mine) and r.keep_id == (min(ids) if ids else None)
            assert not r.kept or r.doc_id == r.keep_id


def test_exact_dedup_goes_on_from_its_state(spark, tmp_path):
    """A second call reads new files only, and the result is that of all rows; hot digests are joined apart."""
    src, state = str(tmp_path / "docs.parquet"), f"file://{tmp_path}/state"
    old, new = [(i, f"text {i % 30}", "a") for i in range(90)], [(i, f"text {i % 37}", "b") for i in range(-3, 60)]
    frame(spark, old).write.parquet(src)
    one = exact_dedup.dedup(spark, src, state=state).collect()
    assert sorted((r.doc_id, r.keep_id, r.group_size, r.kept) for r in one) == [(i, i % 30, 3, i < 30) for i in range(90)]
    frame(spark, new).write.mode("append").parquet(src)
    got = exact_dedup.dedup(spark, src, state=state).collect()
    groups = {}
    for i, t, _ in old + new:
        groups.setdefault(t, []).append(i)
    of = {i: t for i, t, _ in new}
    want = sorted((min(v), len(v)) for v in groups.values() for _ in v)
    assert sorted((r.keep_id, r.group_size) for r in got) == want and sum(r.kept for r in got) == len(groups) and -3 in of
    assert all(r.doc_id == r.keep_id for r in got if r.kept)
    assert exact_dedup.dedup(spark, src, state=state).count() == len(old) + len(new)


def test_exact_dedup_checks_full_bytes(spark, tmp_path, monkeypatch):
    """With a digest that collides, texts are still told apart."""
    from pyspark.sql import functions as F

    real = F.sha2
    monkeypatch.setattr(exact_dedup.F, "sha2", lambda c, n: F.substring(real(c, n), 1, 1))
    rows = [(i, f"text {i % 30}", "a") for i in range(90)]
    src = str(tmp_path / "docs.parquet")
    frame(spark, rows).write.parquet(src)
    got = exact_dedup.dedup(spark, src).collect()
    assert sorted((r.doc_id, r.keep_id, r.group_size, r.kept) for r in got) == [(i, i % 30, 3, i < 30) for i in range(90)]


def test_exact_dedup_empty(spark, tmp_path):
    src = str(tmp_path / "docs.parquet")
    spark.createDataFrame([], DOCS).write.parquet(src)
    assert exact_dedup.dedup(spark, src).count() == 0
