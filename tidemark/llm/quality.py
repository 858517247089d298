"""Quality classifier from weak labels.

Heuristic labellers vote reject or abstain on each document (one votes keep), and overlap: shouting, symbol noise, tables of
fragments, repeated words, words of a lexicon that the caller may give, words and stems learned from toxic labelled rows, plain prose, and the labels themselves where there are
any. Expectation-maximisation over the counts of vote patterns of all documents (at most 3**8 of them) estimates each
labeller's rates on documents to keep and to reject, and the share to reject. The posteriors of a bounded sample of labelled
rows (``SAMPLE`` rows, smallest hashes of doc_id, up to ``SAMPLE_BYTES`` of text) train a linear scorer over hashed words, hashed word stems and the labellers'
measures; executors turn the sample's texts into hashed features, and the driver gets only these. The scorer then scores every document, over its whole text; a document is rejected if the scorer's probability of rejection is above one half.

Null, empty and blank texts have no features and no votes: their score is 1 and they are rejected. Conflicting and repeated labels of one
document: reject wins. Without any label nothing is sampled: the score is the posterior of the document's votes. Repeated rows are scored alike; of rows that repeat an id one text is
sampled, the one with the smallest hash. An empty table gives an empty
result. ``scores`` keeps all other columns, whatever their names; its own replace columns named score and kept.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import kernel as K
from tidemark.llm.common import Workspace, blocks, give_back, text_buffers, trimmed

SAMPLE = 4000
SAMPLE_BYTES = 64 << 20
HASH_BITS = 18
STEMS = (4, 5)
EPOCHS = 150
RIDGE = 3e-4
COMMON = 0.02
TF, SURE = 10.0, 5.0
U = np.uint64
LABELLERS = ("shout", "symbols", "table", "repeat", "lexicon", "stems", "prose", "label")
N_DENSE = 7
_NO_WORDS = np.zeros(0, U)
_UP = np.zeros(256, np.int64)
_UP[65:91] = 1
_LETTER = np.zeros(256, np.int64)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 1


def _lexicon(words) -> np.ndarray:
    """Sorted hashes of a list of words."""
    raw = np.frombuffer(" ".join(words).encode(), np.uint8)
    s, e, _ = K.word_spans(raw, np.array([0, len(raw)]))
    return np.sort(K.span_hash(raw, s, e))


def _among(h: np.ndarray, sorted_: np.ndarray) -> np.ndarray:
    if not len(sorted_):
        return np.zeros(len(h), bool)
    at = np.searchsorted(sorted_, h)
    at[at == len(sorted_)] = 0
    return sorted_[at] == h


class Features:
    """Words of a block of texts: hashed features of each word, and dense measures of each text."""

    def __init__(self, raw: np.ndarray, off: np.ndarray, stems: np.ndarray, lexicon: np.ndarray):
        part, own = raw[off[0] : off[-1]], off - off[0]
        starts, ends, counts = K.word_spans(part, own)
        self.counts = counts
        ink = np.flatnonzero(_LETTER[part])
        a, b = np.searchsorted(ink, starts), np.searchsorted(ink, ends)
        has = b > a
        s = np.where(has, ink[np.minimum(a, len(ink) - 1)] if len(ink) else 0, starts)
        e = np.where(has, ink[b - 1] + 1 if len(ink) else 0, ends)
        power = K.span_hash(part, s, e)
        self.columns = [power]
        for n in STEMS:
            self.columns.append(np.where(e - s > n, K.span_hash(part, s, np.minimum(e, s + n)) ^ U(n), U(0)))
        ups = np.concatenate(([0], np.cumsum(_UP[part])))
        letters = np.concatenate(([0], np.cumsum(_LETTER[part])))
        n_up, n_letter = ups[e] - ups[s], letters[e] - letters[s]
        text = np.repeat(np.arange(len(counts)), counts)
        total = lambda x: np.bincount(text, x, len(counts))
        share = lambda x: total(x) / np.maximum(counts, 1)
        more = lambda x, few=1: np.maximum(total(x) - few, 0) / np.maximum(counts, 1)  # noqa: E731  a few are no evidence
        same = np.zeros(len(starts), bool)
        same[1:] = (power[1:] == power[:-1]) & (text[1:] == text[:-1])
        tail = ends - np.maximum(e, starts)
        lex = _among(power, stems)
        for x in self.columns[1:]:
            lex |= _among(x, stems)
        self.dense = np.column_stack([
            share((n_up >= 2) & (n_up * 2 > n_letter)), share(tail >= 3), share((ends - starts == 1) & (part[starts] == 124) if len(starts) else np.zeros(0)),
            more(same, 2), more(_among(power, lexicon)), more(lex), share((n_letter > 0) & (tail <= 1) & (n_up <= 1)),
        ])

    def votes(self) -> np.ndarray:
        """Votes of all labellers but the labels: 0 abstain, 1 reject, 2 keep."""
        d = self.dense
        v = np.column_stack([d[:, 0] > 0.2, d[:, 1] > 0.2, d[:, 2] > 0.1, d[:, 3] > 0.1, d[:, 4] > 0.002, d[:, 5] > 0.002, d[:, 6] > 0.8]).astype(np.int64)
        v[:, 6] *= 2
        v[:, 6] *= (v[:, 3:6] == 0).all(1)  # plain prose repeats no words and holds none that are listed
        return v

    def hashed(self) -> list[np.ndarray]:
        """Hashed feature of every word for each kind; a word too short for a stem has the last bucket, which has no weight."""
        return [np.where(x == 0, (1 << HASH_BITS) - 1, (K.mix(x ^ K.MULT[30 + i]) >> U(64 - HASH_BITS)).astype(np.int64)) for i, x in enumerate(self.columns)]


def learn_stems(rows: DataFrame) -> np.ndarray:
    """Words and stems that a share ``COMMON`` of the sample's toxic documents hold, 5 at least, and (nearly) no other; ``rows`` (toxic, words) have distinct ones."""
    toxic = rows.agg(F.sum(F.greatest("toxic", F.lit(0)))).first()[0] or 0
    each = rows.select("toxic", F.explode("words").alias("word")).where("word <> 0").groupBy("word").agg(F.sum((F.col("toxic") > 0).cast("int")).alias("n"), F.sum((F.col("toxic") <= 0).cast("int")).alias("clean"))
    found = each.where((F.col("n") >= max(5, COMMON * toxic)) & (F.col("clean") * 50 <= F.col("n"))).select("word").collect()  # few: each is common
    return np.sort(np.array([r["word"] for r in found], np.int64).view(U))


def fit_votes(patterns: dict[tuple, int], rounds: int = 200) -> tuple[dict[tuple, float], np.ndarray]:
    """EM over vote patterns: the posterior of rejection of each pattern, and rates[labeller, class, vote]."""
    keys = list(patterns)
    v = np.array(keys, np.int64)
    n = np.array([patterns[k] for k in keys], np.float64)
    m = v.shape[1]
    q = np.clip(np.where((v == 1).any(1), 0.95, 0.03), 0.01, 0.99)
    rates = np.zeros((m, 2, 3))
    for _ in range(rounds):
        old = q
        prior = float((n * q).sum() / n.sum())
        for j in range(m):
            for c, w in ((1, n * q), (0, n * (1 - q))):
                got = np.bincount(v[:, j], w, 3) + np.array([0.5, 0.05, 0.05])
                rates[j, c] = got / got.sum()
        log = np.stack([np.log(max(p, 1e-9)) + sum(np.log(rates[j, c][v[:, j]]) for j in range(m)) for c, p in ((0, 1 - prior), (1, prior))])
        q = 1 / (1 + np.exp(np.clip(log[0] - log[1], -50, 50)))
        if np.abs(q - old).max() < 1e-7:
            break
    return dict(zip(keys, q.tolist())), rates


def fit_linear(rows: list[tuple[np.ndarray, np.ndarray]], dense: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of the hashed features, of the dense ones, and the intercept, by full-batch Adam on soft labels."""
    nnz = [len(i) for i, _ in rows]
    idx, val = np.concatenate([i for i, _ in rows]), np.concatenate([x for _, x in rows])
    rows.clear()
    row = np.repeat(np.arange(len(nnz), dtype=np.int32), nnz)
    live = np.flatnonzero(np.bincount(idx, minlength=1 << HASH_BITS))
    spot = np.zeros(1 << HASH_BITS, np.int32)
    spot[live] = np.arange(len(live))
    idx = spot[idx]
    d = np.column_stack([dense, np.ones(len(dense))])
    w = np.zeros(len(live) + d.shape[1])
    m1, m2 = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, EPOCHS + 1):
        z = np.bincount(row, val * w[idx], len(y)) + d @ w[len(live) :]
        err = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / len(y)
        g = np.concatenate([np.bincount(idx, val * err[row], len(live)), d.T @ err]) 
        g[: len(live)] += RIDGE * w[: len(live)]
        m1, m2 = 0.9 * m1 + 0.1 * g, 0.99 * m2 + 0.01 * g * g
        w -= 0.1 * (m1 / (1 - 0.9**t)) / (np.sqrt(m2 / (1 - 0.99**t)) + 1e-8)
    out = np.zeros((1 << HASH_BITS) + d.shape[1])
    out[live] = w[: len(live)]
    out[1 << HASH_BITS :] = w[len(live) :]
    return out


_HALF = np.array([0.1, 0.1, 0.05, 0.05, 0.002, 0.002, 0.5])


def saturated(dense: np.ndarray) -> np.ndarray:
    """Measures on a scale from 0 to SURE that saturates where a labeller is sure."""
    return SURE * (1 - np.exp(-dense / _HALF))


def _sample(texts: DataFrame, known: DataFrame, rows: int, bytes_: int) -> DataFrame:
    """(text, bad, toxic) of up to ``rows`` labelled rows, in the order of a hash of their ids, of up to ``bytes_`` in all."""
    picked = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    some = texts.join(F.broadcast(picked), "doc_id").where("text is not null")
    some = some.groupBy("doc_id", "bad", "toxic").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    before = Window.orderBy(F.xxhash64("doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return some.withColumn("end", F.sum(F.octet_length("text")).over(before)).where(F.col("end") <= bytes_).select("doc_id", "text", "bad", "toxic")


def _hashed_rows(sample: DataFrame) -> DataFrame:
    """(doc_id, bad, toxic, words, features, counts): distinct words and stems, and hashed features, of the sampled texts that have words."""

    def run(batches):
        for batch in batches:
            raw, off = text_buffers(batch.column(1))
            for i in range(batch.num_rows):
                f = Features(raw, off[i : i + 2], np.zeros(0, U), np.zeros(0, U))
                if not f.counts[0]:
                    continue
                x, n = np.unique(np.concatenate(f.hashed()), return_counts=True)
                keep = x != (1 << HASH_BITS) - 1
                lists = [np.unique(np.concatenate(f.columns)).view(np.int64), x[keep].astype(np.int32), (n[keep] * (TF / f.counts[0])).astype(np.float32)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, 1), batch.column(2).slice(i, 1), batch.column(3).slice(i, 1), *[pa.array([x]) for x in lists]], ["doc_id", "bad", "toxic", "words", "features", "counts"]
                )

    return sample.mapInArrow(trimmed(run), "doc_id long, bad int, toxic int, words array<long>, features array<int>, counts array<float>")


def _voted(rows: DataFrame, stems, lexicon: np.ndarray) -> DataFrame:
    """(doc_id, code, dense): all votes but the labels' as one number, -1 for texts without words, and the dense measures."""

    def run(batches):
        for batch in batches:
            ids, (raw, off) = batch.column(0), text_buffers(batch.column(1))
            for a, b in blocks(off):
                f = Features(raw, off[a : b + 1], stems.value, lexicon)
                code = np.where(f.counts > 0, f.votes() @ (3 ** np.arange(len(LABELLERS) - 1)), -1)
                dense = pa.FixedSizeListArray.from_arrays(pa.array(f.dense.ravel()), N_DENSE).cast(pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([ids.slice(a, b - a), pa.array(code, pa.int64()), dense], ["doc_id", "code", "dense"])

    return rows.select("doc_id", "text").mapInArrow(trimmed(run), "doc_id long, code long, dense array<double>")


def _unpacked(code: int) -> tuple:
    return tuple((code // 3**j) % 3 for j in range(len(LABELLERS)))


def train(docs: DataFrame, labels: DataFrame | None, ws: Workspace, bound: int = SAMPLE, lexicon: np.ndarray = _NO_WORDS):
    """(learned stems, weights or None, posterior of each vote pattern, labellers' rates) from vote counts of all documents and a bounded sample of labelled rows."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    spark = docs.sparkSession
    known = None
    if labels is not None:
        bad = ((F.coalesce("quality", F.lit(1)) == 0) | (F.coalesce("toxic", F.lit(0)) == 1)).cast("int")
        known = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(bad).alias("bad"), F.max(F.coalesce("toxic", F.lit(0))).cast("int").alias("toxic"))
        known = ws.put(known, "known")
        if known.isEmpty():
            known = None
    rows, sample, stems, got = [], None, np.zeros(0, U), None
    if known is not None:
        sample = ws.put(_sample(texts, known, bound, SAMPLE_BYTES), "sample")
        hashed = ws.put(_hashed_rows(sample), "hashed")
        stems = learn_stems(hashed)
        got = hashed.select("doc_id", "bad", "features", "counts").toArrow()
        column = lambda c: got.column(c).combine_chunks()
        pieces = lambda c: [x.values.to_numpy(zero_copy_only=False) for x in column(c)]
        rows = sorted(zip(column("doc_id").to_pylist(), column("bad").to_pylist(), pieces("features"), pieces("counts")), key=lambda r: r[0])

    shared = spark.sparkContext.broadcast(stems)
    votes = _voted(texts, shared, lexicon).where("code >= 0").select("doc_id", "code")
    if known is not None:
        votes = votes.join(known.select("doc_id", F.when(F.col("bad") == 1, 1).otherwise(2).alias("said")), "doc_id", "left")
        code = F.col("code") + F.coalesce("said", F.lit(0)) * 3 ** (len(LABELLERS) - 1)
    else:
        code = F.col("code")
    counts = votes.groupBy(code.alias("code")).agg(F.count("*").alias("n")).collect()  # 3**8 patterns at most
    patterns = {_unpacked(r["code"]): r["n"] for r in counts}
    weights = posterior = rates = None
    if patterns:
        own = {r["doc_id"]: r for r in _voted(sample, shared, lexicon).collect()} if rows else {}
        mine = [(*_unpacked(own[r[0]]["code"])[:-1], 1 if r[1] else 2) for r in rows]
        for p in mine:
            patterns.setdefault(tuple(p), 1)
        posterior, rates = fit_votes(patterns)
        if rows:
            y = np.array([posterior[tuple(p)] for p in mine])
            dense = np.array([own[r[0]]["dense"] for r in rows])
            weights = fit_linear([(r[2], r[3]) for r in rows], saturated(dense), y)
    shared.destroy()
    ws.keep()
    rows = got = None
    give_back()
    return stems, weights, posterior, rates


def scores(docs: DataFrame, labels: DataFrame | None, bound: int = SAMPLE, lexicon: tuple[str, ...] = ()) -> DataFrame:
    """``docs`` with score (probability of rejection) and kept, in place of columns of these names; all others stay."""
    ws = Workspace(docs.sparkSession, "quality")
    listed = _lexicon(lexicon) if lexicon else _NO_WORDS
    stems, weights, posterior, _ = train(docs, labels, ws, bound, listed)
    table = np.ones(3 ** (len(LABELLERS) - 1))  # without a scorer: the posterior of each pattern, the label abstaining
    if posterior:
        for i in range(len(table)):
            table[i] = posterior.get(_unpacked(i), 1.0)
    model = docs.sparkSession.sparkContext.broadcast((stems, weights, table))
    docs = docs.drop("score", "kept")
    names = docs.columns
    at = names.index("text")

    def run(batches):
        own, w, by_votes = model.value
        for batch in batches:
            raw, off = text_buffers(batch.column(at).cast(pa.string()))
            out = []
            for a, b in blocks(off):
                f = Features(raw, off[a : b + 1], own, listed)
                if w is None:
                    out.append(np.where(f.counts > 0, by_votes[f.votes() @ (3 ** np.arange(len(LABELLERS) - 1))], 1.0))
                    continue
                text = np.repeat(np.arange(len(f.counts)), f.counts)
                each = sum(w[x] for x in f.hashed()) if len(text) else np.zeros(0)
                z = np.bincount(text, each, len(f.counts)) * (TF / np.maximum(f.counts, 1)) + saturated(f.dense) @ w[1 << HASH_BITS : -1] + w[-1]
                out.append(np.where(f.counts > 0, 1 / (1 + np.exp(-np.clip(z, -30, 30))), 1.0))
            p = np.concatenate(out) if out else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(p), pa.array(p <= 0.5)], [*names, "score", "kept"])

    from pyspark.sql import types as T

    schema = T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("kept", T.BooleanType())])
    return docs.mapInArrow(trimmed(run), schema)
