import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as P
from tests.llm import brute_templates
from tests.llm.data import frame
from tests.llm.test_pairs_and_tokens import brute_components, brute_taken, low, tokenizer
from tests.llm.test_texts import corpus
from tidemark.llm import mixing

ITEM = "Which of these five wooden boxes holds the red lamp that the old captain left behind in the harbour last winter?"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """A small directory of tables: junk, toxic rows, exact and near copies, and a benchmark passage."""
    root = str(tmp_path_factory.mktemp("sf"))
    docs, labels, _ = corpus(500, 8)
    rnd = random.Random(1)
    docs = [(i, t, rnd.choice("abc")) for i, t, _ in docs]
    clean = [t for i, t, _ in docs if not any(x in t for x in ("zzgrob", "moron", "scum", "!!", "%%%")) and t.split()[0] != t.split()[1]]
    for j, t in enumerate(clean[:40]):
        w = t.split()
        w[3] = "edited"
        docs += [(1000 + j, t, "a"), (2000 + j, " ".join(w), "b")]
    docs += [(3000 + j, f"{t} {ITEM} {t}", "c") for j, t in enumerate(clean[40:50])] + [(4000, None, "a"), (4001, "", None)]
    plain = frame(spark, docs, clash=False)
    plain.write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    spark.createDataFrame([(1, ITEM), (2, None)], "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    return root, {i: t for i, t, _ in docs}


def test_stages(spark, tables):
    root, texts = tables
    docs = spark.read.parquet(f"{root}/documents.parquet").withColumn("score", F.lit("clash"))
    kept = P.quality_stage(spark, docs, root)
    assert tuple(kept.columns) == P.COLUMNS
    ids = {r.doc_id for r in kept.collect()}
    bad = {i for i, t in texts.items() if not (t or "").strip() or any(x in t for x in ("zzgrob", "moron", "scum", "!!", "%%%"))}
    assert not ids & bad and len(ids) > 0.95 * (len(texts) - len(bad)) - 60

    again = kept.union(kept.limit(5))
    once = P.near_duplicate_stage(spark, again, root)
    want = {i for i, (_, c) in brute_components({i: texts[i] for i in ids}, 5, 80).items() if c == i}
    got = [r.doc_id for r in once.collect()]
    assert sorted(got) == sorted(want)

    free = {r.doc_id for r in P.decontamination_stage(spark, once, root).collect()}
    assert free == {i for i in want if low(ITEM) not in low(texts[i])} and free != want

    mixed = [r.doc_id for r in P.mixing_stage(spark, once.where(F.col("doc_id").isin(list(free))), root).collect()]
    assert set(mixed) <= free and max(mixed.count(i) for i in set(mixed)) <= 2

    rows = P.token_stage(spark, once, root).collect()
    assert sorted(r.doc_id for r in rows) == sorted(want) and min(r.start for r in rows) == 0


def brute_rest(spark, rows, items):
    """What the stages after the classifier make of (doc_id, text, source) rows with ids of their own, by loops."""
    texts = {i: t for i, t, _ in rows}
    sources = {i: s for i, _, s in rows}
    left = [i for i, (_, c) in brute_components(texts, 5, 80).items() if c == i]
    left = [i for i in left if not any(brute_templates.contaminated(texts[i], x) for x in items)]
    sized = mixing.measure(frame(spark, [(i, texts[i], sources[i]) for i in left], clash=False)).collect()
    tok, at, out = Tokenizer.from_file(tokenizer()), 0, []
    for i, _, size, taken in sorted(brute_taken(sized), key=lambda r: r[0]):
        for _ in range(taken // size if size else 0):
            ids = tok.encode(texts[i], add_special_tokens=False).ids + [0]
            out.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4"))))
            at += len(ids)
    return out


def test_run_equals_brute_force(spark, tables):
    root, texts = tables
    docs = spark.read.parquet(f"{root}/documents.parquet")
    kept = [(r.doc_id, r.text, r.source) for r in P.quality_stage(spark, docs, root).collect()]
    got = [tuple(r) for r in P.run(spark, root).orderBy("start").collect()]
    want = brute_rest(spark, kept, [ITEM, None])
    assert got == want and 100 < len({r[0] for r in got}) < len(kept) < len(texts)


def test_stages_on_odd_rows(spark, tables, tmp_path):
    """Repeated ids with other texts, rows without an id, very long and empty texts, ties, and columns of any name, in every stage."""
    root, texts = tables
    clean = [t for i, t in texts.items() if t and i < 500 and not any(x in t for x in ("zzgrob", "moron", "scum", "!!", "%%%")) and len(t.split()) > 40 and t.split()[0] != t.split()[1]][:8]
    long = " ".join(f"{a} {b}" for a, b in zip((clean[0] + " ") .split() * 900, (clean[1] + " ").split() * 900))
    rows = [(1, clean[0], "a"), (1, clean[1], "a"), (1, clean[1], "a"), (None, clean[2], "b"), (None, clean[2], "b"), (None, clean[3], None), (2, clean[0], "b"), (3, long, "c"), (4, None, "a"), (5, "", "c"), (6, " \n", None)]
    rows += [(None, f"{clean[4]} {ITEM}", "a"), (7, f"{clean[5]} {ITEM}", "a"), (7, clean[5], "a")]
    odd = frame(spark, rows)
    for c in ("key", "item", "item_id", "source_size", "taken", "times", "text_hash", "component", "component_id", "id", "ids", "payload", "h", "row", "_maybe", "last", "of"):
        odd = odd.withColumn(c, F.lit("x"))
    near = P.near_duplicate_stage(spark, odd, root)
    got = sorted((r.doc_id or 0, r.text or "") for r in near.collect())
    assert got == sorted([(1, clean[0]), (1, clean[1]), (0, clean[2]), (0, clean[3]), (3, long), (4, ""), (5, ""), (6, " \n"), (0, f"{clean[4]} {ITEM}"), (7, f"{clean[5]} {ITEM}"), (7, clean[5])])
    free = sorted((r.doc_id or 0, r.text or "") for r in P.decontamination_stage(spark, odd, root).collect())
    assert free == sorted((i or 0, t or "") for i, t, _ in rows if ITEM not in (t or ""))
    mixed = P.mixing_stage(spark, odd, root)
    words = {(i, t) for i, t, _ in rows if (t or "").split()}
    assert mixed.columns == list(P.COLUMNS) and {(r.doc_id, r.text) for r in mixed.collect()} <= words
    read = P.token_stage(spark, odd, root).collect()
    assert len(read) == len(rows) and sorted(r.n_tokens for r in read)[:3] == [1, 1, 3]
    kept = P.quality_stage(spark, odd, root)
    assert kept.columns == list(P.COLUMNS) and not {4, 5, 6} & {r.doc_id for r in kept.collect()}


def test_empty(spark, tables, tmp_path):
    root, _ = tables
    docs = spark.read.parquet(f"{root}/documents.parquet").limit(0)
    for _, stage in P.STAGES:
        assert stage(spark, docs, root).count() == 0
