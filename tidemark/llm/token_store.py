"""Token-ID files with Re-Pair grammar compression.

Documents are dealt into files by ranges of doc_id, sorted, encoded and cut into blocks of about ``BLOCK_IDS``
ids; a block is the shard that has a grammar of its own, so memory is bounded by a block and any block is read alone. In each block, frequent pairs of neighbouring ids are replaced by nonterminals, all frequent pairs of a
round at once, until none is met ``LEAST`` times without overlap; no pair crosses a document. A block keeps its rules, the expansion length of every
nonterminal, the sequence, and for each document its id, its place in the sequence and its number of ids, so any
document is decoded alone.

A file is Parquet with one row for each block (shard, block, first id's place in the shard, counts, payload); Spark's
commit protocol makes a retried task harmless. Payload, little-endian: magic ``TMRP0001``; u32 documents, rules, symbols; i64 doc_id
of each; u32 place in the sequence of each, and the end; u32 ids of each; u32 left, right, expansion length of each rule; u32 symbols.
Symbols below ``2**24`` are token ids, others rules.

Texts are encoded by units: a text is cut before every single space between two other characters, where the
byte-level pre-tokenizer always cuts, and each different unit is encoded once for a batch and kept (up to ``CACHE_IDS`` ids). A kept unit is
known by its bytes, not by a hash, so a hit can't be another unit's; longer units are encoded each time. Units that are new are joined into
strings of ``JOINED``, whose ids are dealt out by the tokens' lengths in bytes. The ids
are those of the whole text. Tokenizers that are not byte-level, or that normalise, encode whole texts.

Null texts are empty: the end id alone. Null ids sort first and are stored as the smallest long. Repeated rows are documents of their own. Other columns are ignored.
"""

from __future__ import annotations

import json
import struct
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import kernel as K
from tidemark.llm.common import CACHES, Workspace, blocks, text_buffers, trimmed

MAGIC = b"TMRP0001"
BLOCK_IDS = 1 << 20
BASE = 1 << 24
END_ID = 0
SLOT_BITS = 21
CACHE_IDS = 1 << 23
WORD = 8
JOINED = 256
ROUNDS = 3
LEAST = 6
PAIR_BITS = 20
NO_ID = -(2**63)
U = np.uint64
_FIRST = np.array([(1 << 8 * n) - 1 for n in range(WORD + 1)], U)


def _joinable(path: str) -> np.ndarray | None:
    """Length in bytes of every token id of a byte-level tokenizer without a normaliser, to which ids of joined units are dealt out; else None."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    pre, vocab = spec.get("pre_tokenizer") or {}, (spec.get("model") or {}).get("vocab")
    plain = pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space", True)
    if not plain or spec.get("normalizer") or not isinstance(vocab, dict) or any(t["lstrip"] or t["rstrip"] for t in spec.get("added_tokens", [])):
        return None
    added = {t["id"]: len(t["content"].encode()) for t in spec.get("added_tokens", [])}
    size = np.zeros(1 + max([*vocab.values(), *added]), np.int64)
    size[list(vocab.values())] = list(map(len, vocab))  # in the byte-level alphabet a character is a byte
    size[list(added)] = list(added.values())
    return size


class Encoder:
    """Ids of texts by one tokenizer file, with a bounded memory of units of up to ``2 * WORD`` bytes, which are told apart by all their bytes."""

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.bytes_of = _joinable(path)
        self._clear()

    def _clear(self):
        self.slots = np.zeros((1 << SLOT_BITS, 3), U)  # a unit's bytes; place and number of ids, and its length. Of units that share a slot, the last stays
        self.ids = np.zeros(1 << 20, np.int32)
        self.used = 1

    def _whole(self, raw: np.ndarray, off: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """The same by whole texts, for other kinds of tokenizers."""
        texts = [raw[s:e].tobytes().decode() for s, e in zip(off[:-1].tolist(), off[1:].tolist())]
        got = [[*x.ids, end_id] for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        n = np.fromiter(map(len, got), np.int64, len(got))
        return np.fromiter(chain.from_iterable(got), np.int32, int(n.sum())), n

    def _encode_units(self, part: np.ndarray, starts: np.ndarray, ends: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all units, how many each has). Units that begin with a single space before another character are joined, as the pre-tokenizer
        cuts before each whatever it follows; another unit begins a string."""
        raw = part.tobytes()
        pieces = [raw[s:e] for s, e in zip(starts.tolist(), ends.tolist())]
        heads = np.flatnonzero((part[starts] != 32) | (ends - starts < 2) | ~after[np.minimum(starts + 1, len(part) - 1)])
        cuts = np.unique(np.concatenate((np.arange(0, len(starts), JOINED), heads))).tolist()
        strings = [b"".join(pieces[x:y]).decode() for x, y in zip(cuts, cuts[1:] + [len(pieces)])]
        got = [x.ids for x in self.tokenizer.encode_batch_fast(strings, add_special_tokens=False)]
        flat = np.fromiter(chain.from_iterable(got), np.int32, sum(map(len, got)))
        edge = np.searchsorted(np.cumsum(self.bytes_of[flat]), np.cumsum(ends - starts)) + 1
        return flat, np.diff(edge, prepend=0)

    def encode(self, raw: np.ndarray, off: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, each text's followed by the end id, and how many each has with it."""
        if self.bytes_of is None:
            return self._whole(raw, off, end_id)
        part, own = raw[off[0] : off[-1]], off - off[0]
        if not len(part):
            return np.full(len(off) - 1, end_id, np.int32), np.ones(len(off) - 1, np.int64)
        ink = (part < 128) & ~K.SPACE[part]
        two = (part >= 0xC3) & (part <= 0xDF)  # first bytes of two-byte characters without white space among them
        before, after = ink.copy(), ink | two
        before[1:] |= two[:-1]
        cut = np.zeros(len(part), bool)
        cut[1:-1] = (part[1:-1] == 32) & before[:-2] & after[2:]
        inner = own[(own > 0) & (own < len(part))]
        cut[inner - 1] = False
        cut[own[own < len(part)]] = True
        cut[0] = True
        starts = np.flatnonzero(cut)
        size = np.diff(starts, append=len(part))
        padded = np.concatenate((part, np.zeros(2 * WORD, np.uint8)))
        words = np.ndarray(len(part) + WORD, "<u8", padded.data, strides=(1,))  # the WORD bytes from each place
        low, high = words[starts] & _FIRST[np.minimum(size, WORD)], words[starts + WORD * (size > WORD)] & _FIRST[np.clip(size - WORD, 0, WORD)]
        short = size <= 2 * WORD
        h = (low * K.MULT[57] + high * K.MULT[58] + size.astype(U)) * K.MULT[59]
        slot = ((h ^ (h >> U(31))) * K.MULT[56] >> U(64 - SLOT_BITS)).astype(np.int64)
        if self.used > CACHE_IDS:
            self._clear()
        row = self.slots[slot]
        miss = np.flatnonzero((row[:, 0] != low) | (row[:, 1] != high) | ((row[:, 2] & U(0xFF)) != size.astype(U)) | ~short)
        at, n = (row[:, 2] >> U(24)).astype(np.int64), ((row[:, 2] >> U(8)) & U(0xFFFF)).astype(np.int64)
        if len(miss):
            # equal units once, if their bytes are within reach
            order = miss[np.argsort(h[miss], kind="stable")]
            new = np.ones(len(order), bool)
            new[1:] = (low[order[1:]] != low[order[:-1]]) | (high[order[1:]] != high[order[:-1]]) | (size[order[1:]] != size[order[:-1]]) | ~short[order[1:]]
            unit = order[new]
            flat, new_n = self._encode_units(part, starts[unit], starts[unit] + size[unit], after)
            new_at = self.used + np.cumsum(new_n) - new_n
            while self.used + len(flat) > len(self.ids):
                self.ids = np.concatenate((self.ids, np.zeros(len(self.ids), np.int32)))
            self.ids[self.used : self.used + len(flat)] = flat
            self.used += len(flat)
            kept = short[unit]
            own_unit = unit[kept]
            self.slots[slot[own_unit]] = np.column_stack([low[own_unit], high[own_unit], (new_at[kept] << 24 | new_n[kept] << 8 | size[own_unit]).astype(U)])
            back = np.cumsum(new) - 1
            at[order], n[order] = new_at[back], new_n[back]
        lead = np.searchsorted(starts, own)
        self.ids[0] = end_id  # the first place is held for it
        at, n = np.insert(at, lead[1:], 0), np.insert(n, lead[1:], 1)
        first = np.concatenate(([0], np.cumsum(n)))
        where = np.repeat((at - first[:-1]).astype(np.int32), n)
        where += np.arange(len(where), dtype=np.int32)
        return np.take(self.ids, where), np.diff(first[lead + np.arange(len(lead))])


_ENCODERS: dict[str, Encoder] = CACHES.setdefault("encoders", {})


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def repair(ids: np.ndarray, lengths: np.ndarray, rounds: int = ROUNDS, least: int = LEAST):
    """Re-Pair over one block: (symbols, number of symbols of each document, left, right, expansion lengths).

    After ``rounds`` rounds by hash slots, pairs are counted exactly until none is met ``least`` times without overlap."""
    seq = ids.astype(np.int64)
    last = np.zeros(len(seq), bool)
    last[np.cumsum(lengths)[lengths > 0] - 1] = True
    left, right, size = [], [], np.zeros(0, np.int64)

    def put(spots, here, pair, used):
        """Replace the pairs ``pair[here]`` at ``spots`` by new symbols; the mask of places that are left."""
        nonlocal seq, last, size
        name = np.cumsum(used) - 1 + BASE + len(size)
        a, b = pair[used] >> 32, pair[used] & 0xFFFFFFFF
        length = lambda s: np.where(s >= BASE, size[np.where(s >= BASE, s - BASE, 0)], 1) if len(size) else np.ones(len(s), np.int64)
        left.append(a)
        right.append(b)
        size = np.concatenate((size, length(a) + length(b)))
        seq[spots] = name[here]
        last[spots] = last[spots + 1]
        gone = np.ones(len(seq), bool)
        gone[spots + 1] = False
        seq, last = seq[gone], last[gone]
        return gone

    for turn in range(rounds):
        if len(seq) < 2:
            break
        code = (seq[:-1] << 32) | seq[1:]
        slot = ((code.view(U) * K.MULT[61 + turn % 3]) >> U(64 - PAIR_BITS)).astype(np.int32)
        often = np.bincount(slot, minlength=1 << PAIR_BITS) >= least
        spots = np.flatnonzero(often[slot] & ~last[:-1])
        # a slot names one pair; another pair of the same slot waits for a later round, with other slots
        pair = np.zeros(1 << PAIR_BITS, np.int64)
        here, own = slot[spots], code[spots]
        pair[here] = own
        same = pair[here] == own
        spots, here = spots[same], here[same]
        if not len(spots):
            break
        # of overlapping spots every other one stays, from the left
        run = np.concatenate(([True], np.diff(spots) > 1))
        head = spots[np.maximum.accumulate(np.where(run, np.arange(len(spots)), 0))]
        stays = (spots - head) % 2 == 0
        spots, here = spots[stays], here[stays]
        used = np.bincount(here, minlength=1 << PAIR_BITS) >= least
        keep = used[here]
        spots, here = spots[keep], here[keep]
        if not len(spots):
            break
        put(spots, here, pair, used)
    # a pair of old symbols that is too rare stays so: later rounds look at frequent pairs and at new symbols only
    code = (seq[:-1] << 32) | seq[1:]
    slot = ((code.view(U) * K.MULT[60]) >> U(64 - PAIR_BITS)).astype(np.int32)
    spots = np.flatnonzero((np.bincount(slot, minlength=1 << PAIR_BITS) >= least)[slot] & ~last[:-1])
    while len(spots):
        twin = seq[spots] == seq[spots + 1]
        run = np.concatenate(([True], (np.diff(spots) > 1) | ~twin[1:] | ~twin[:-1]))
        head = spots[np.maximum.accumulate(np.where(run, np.arange(len(spots)), 0))]
        whole, spots = spots, spots[(spots - head) % 2 == 0]
        pair, here, n = np.unique((seq[spots] << 32) | seq[spots + 1], return_inverse=True, return_counts=True)
        often = n >= least
        if not often.any():
            break
        keep = often[here]
        spots, here = spots[keep], here[keep]
        # of overlapping spots the more frequent pair's stays, so that the most frequent one always gets its rule
        rank = np.empty(len(n), np.int64)
        rank[np.argsort(n, kind="stable")] = np.arange(len(n))
        r, close = rank[here], np.diff(spots) == 1
        wins = np.ones(len(spots), bool)
        wins[1:] &= ~close | (r[1:] > r[:-1])
        wins[:-1] &= ~close | (r[:-1] > r[1:])
        used = np.bincount(here[wins], minlength=len(n)) >= least
        wins &= used[here]
        again = np.zeros(len(seq), bool)
        again[spots] = True
        again[whole[seq[whole] == seq[whole + 1]]] = True
        new = np.zeros(len(seq), bool)
        new[spots[wins]] = True
        gone = put(spots[wins], here[wins], pair, used)
        again, new = again[gone], new[gone]
        again |= new
        again[:-1] |= new[1:]
        spots = np.flatnonzero(again[:-1] & ~last[:-1])
    ends = np.flatnonzero(last) + 1
    count = np.zeros(len(lengths), np.int64)
    count[lengths > 0] = np.diff(np.concatenate(([0], ends)))
    cat = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
    return seq, count, cat(left), cat(right), size


def _sizes(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Expansion lengths of rules; a rule's symbols are older than itself."""
    size = np.zeros(len(left), np.int64)
    for i, (x, y) in enumerate(zip(left.tolist(), right.tolist())):
        size[i] = sum(size[z - BASE] if z >= BASE else 1 for z in (x, y))
    return size


def expand(seq: np.ndarray, left: np.ndarray, right: np.ndarray, size: np.ndarray | None = None) -> np.ndarray:
    """Token ids of symbols. Each round takes only the rules that are left, to their places."""
    size = _sizes(left, right) if size is None else size
    n = np.ones(len(seq), np.int64)
    rule = np.flatnonzero(seq >= BASE)
    n[rule] = size[seq[rule] - BASE]
    at = np.cumsum(n) - n
    out = np.empty(int(n.sum()), seq.dtype)
    while len(seq):
        rule = seq >= BASE
        out[at[~rule]] = seq[~rule]
        own, at = seq[rule] - BASE, at[rule]
        a, b = left[own], right[own]
        deep = np.flatnonzero(a >= BASE)
        n = np.ones(len(a), np.int64)
        n[deep] = size[a[deep] - BASE]
        seq, at = np.concatenate((a, b)), np.concatenate((at, at + n))
    return out


def pack(doc_ids: np.ndarray, ids: np.ndarray, lengths: np.ndarray) -> bytes:
    seq, count, left, right, size = repair(ids, lengths)
    parts = [doc_ids.astype("<i8"), np.concatenate(([0], np.cumsum(count))).astype("<u4"), lengths.astype("<u4")]
    parts += [left.astype("<u4"), right.astype("<u4"), size.astype("<u4"), seq.astype("<u4")]
    return MAGIC + struct.pack("<3I", len(doc_ids), len(left), len(seq)) + b"".join(x.tobytes() for x in parts)


class Block:
    """A block opened for reading."""

    def __init__(self, data: bytes):
        if data[:8] != MAGIC:
            raise ValueError("not a token block")
        docs, rules, symbols = struct.unpack("<3I", data[8:20])
        at = 20

        def take(kind, n):
            nonlocal at
            x = np.frombuffer(data, kind, n, at)
            at += x.nbytes
            return x

        self.doc_ids, self.place, self.lengths = take("<i8", docs), take("<u4", docs + 1), take("<u4", docs)
        self.left, self.right, self.sizes = take("<u4", rules), take("<u4", rules), take("<u4", rules)
        self.symbols = take("<u4", symbols)

    def all_ids(self) -> np.ndarray:
        return expand(self.symbols, self.left, self.right, self.sizes)

    def document(self, i: int) -> np.ndarray:
        """Ids of the i-th document, without decoding any other."""
        return expand(self.symbols[self.place[i] : self.place[i + 1]], self.left, self.right, self.sizes)


def write(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = END_ID) -> None:
    """Encode every text of ``docs`` (doc_id, text) and write the blocks to ``path``, in ascending doc_id order."""

    def run(batches):
        shard, block, start = TaskContext.get().partitionId(), 0, 0
        enc = encoder(tokenizer_path)
        held_docs: list[np.ndarray] = []
        held_ids: list[np.ndarray] = []
        held_n: list[np.ndarray] = []
        held = 0

        def flush():
            nonlocal block, start, held
            names, ids, n = np.concatenate(held_docs), np.concatenate(held_ids), np.concatenate(held_n)
            out = pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32()), pa.array([block], pa.int32()), pa.array([start], pa.int64()), pa.array([len(names)], pa.int64()), pa.array([len(ids)], pa.int64()), pa.array([pack(names, ids, n)], pa.binary())],
                ["shard", "block", "shard_start", "docs", "ids", "payload"],
            )
            block, start, held = block + 1, start + len(ids), 0
            for x in (held_docs, held_ids, held_n):
                x.clear()
            return out

        for batch in batches:
            names = np.asarray(batch.column(0).fill_null(NO_ID)).astype(np.int64)
            raw, off = text_buffers(batch.column(1))
            for a, b in blocks(off, 1 << 21):
                ids, n = enc.encode(raw, off[a : b + 1], end_id)
                held_docs.append(names[a:b])
                held_ids.append(ids)
                held_n.append(n)
                held += len(ids)
                if held >= BLOCK_IDS:
                    yield flush()
        if held_docs:
            yield flush()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))
    out = rows.mapInArrow(trimmed(run, "encoders"), "shard int, block int, shard_start long, docs long, ids long, payload binary")
    out.write.mode("overwrite").option("compression", "zstd").parquet(path)


def read(spark, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files."""
    files = spark.read.schema("shard int, block int, shard_start long, docs long, ids long, payload binary").parquet(path)
    totals = files.groupBy("shard").agg(F.sum("ids").alias("n"))  # one row for each shard
    before = totals.select("shard", (F.sum("n").over(Window.orderBy("shard")) - F.col("n")).alias("before"))

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                b = Block(batch.column(1)[i].as_py())
                ids = b.all_ids().astype("<u4")
                edge = np.concatenate(([0], np.cumsum(b.lengths, dtype=np.int64)))
                crc = [zlib.crc32(ids[x:y]) for x, y in zip(edge[:-1].tolist(), edge[1:].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(b.doc_ids, mask=b.doc_ids == NO_ID), pa.array(edge[:-1] + batch.column(0)[i].as_py()), pa.array(b.lengths.astype(np.int64)), pa.array(crc, pa.int64())],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    rows = files.join(F.broadcast(before), "shard").select((F.col("shard_start") + F.col("before")).alias("first"), "payload")
    return rows.mapInArrow(trimmed(run, "encoders"), "doc_id long, start long, n_tokens long, ids_crc32 long")


def encode_documents(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, as read back from files that go with the session."""
    ws = Workspace(docs.sparkSession, "tokens")
    write(docs, ws.path("blocks"), tokenizer_path)
    return read(docs.sparkSession, ws.path("blocks"))
